"""Main text of web pages by two-pass block rules.

A page is cut into blocks at its block-level tags. Pass one decides each block by its link density,
its length and its share of stop words, or leaves it undecided. Pass two lets undecided blocks, mostly
short ones, take the label of their nearest decided neighbours: the common one if both sides agree,
else that of the neighbour in the same container, else the nearer one.

Containers narrow the choice: blocks inside menus, headers, footers, sidebars, notices, adverts, forms
and comments, told by their tags or by the words of their class, id or role, are not text. Whole names
tell a container for certain; a name that only has such a word in it counts where the container's blocks
are short or linked. A form, or a container whose name says how a page is laid out, may be around the
page itself: one that holds most of the page's text, with no article outside of it, is none. Inside an
article or main element nothing else speaks against a block, and neighbours there decide blocks of
links; elsewhere links do. Few stop words leave a block undecided (tables, code, lists). Where a whole
page has few, as in languages whose words are not listed, they tell nothing: the page is read like an
article, but for its blocks of links.

Defined cases: null, empty and text-free pages give an empty text; unclosed tags end where an element
around them ends, unclosed comments and scripts at the end of the page; repeated rows get equal rows;
empty tables give empty results; further columns are not read.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from larder.llm.common import texts_of

MAX_LINK_DENSITY = 0.35
SHORT = 70
STOPWORDS_HIGH = 0.12

# Frequent words of the languages expected.
STOPWORDS = frozenset(
    """
    the of and to in a is that for it as was with be by on not he his but at are this have from or
    an they which one you were all her she there would their we him been has when who will no more
    der die das und in den von zu mit sich des auf für ist im dem nicht ein eine als auch es an er
    aus bei nach wie war so oder aber einer um am sind noch zum über nur wird
    de la le et les des en un une du que est dans qui par pour au il sur ne se pas plus avec son ce
    sont aux ou mais nous elle leur ont cette être
    el los las y del se una con por su para como más pero sus al lo este sí porque esta entre cuando
    muy sin sobre también me hasta hay donde
    """.split()  # noqa: SIM905
)
# In place of the number of an article: a page read like one.
PAGE = -1
# Elements whose insides are not markup.
DROPPED = "script|style|textarea|iframe"
CONTAINERS = frozenset(
    """
    nav footer aside menu dialog header head title noscript template svg object canvas select button
    """.split()  # noqa: SIM905
)
# What a head may hold; anything else ends it.
IN_HEAD = frozenset("title meta link base noscript template".split())
MAIN = frozenset(("article", "main"))
INLINE = frozenset(
    """
    a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s
    samp small span strike strong sub sup time tt u var wbr img
    """.split()  # noqa: SIM905
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
# Elements that end where one of a kind begins, as their end tags may be left out.
ENDED_BY = {
    "li": frozenset(["li"]),
    "dt": frozenset(["dt", "dd"]),
    "dd": frozenset(["dt", "dd"]),
    "tr": frozenset(["tr"]),
    "td": frozenset(["td", "th", "tr"]),
    "th": frozenset(["td", "th", "tr"]),
}
# Words of a class, id or role that mark a container as no text, in any layout.
MARKS = frozenset(
    """
    ad ads adsense adslot breadcrumb breadcrumbs commentlist comment comments disqus replies respond
    cookie cookies consent gdpr newsletter subscribe signup login menu nav navbar navigation footer
    pagination pager toolbar masthead complementary contentinfo copyright
    """.split()  # noqa: SIM905
)
MARK_BEGINS = ("advert", "sponsor", "recommend")
# The same for words that may also say how the page around them is laid out.
LAYOUT_MARKS = frozenset(
    """
    sidebar side-bar banner promo promotion related notice alert popup modal overlay share sharing
    social widget search skip legal hidden
    """.split()  # noqa: SIM905
)
# What a marking name may have besides such words.
FRAME = frozenset(
    """
    area bar block box bottom container footer group header inner item items left link links list
    main outer page panel post posts primary right row section secondary site slot top unit wrap
    wrapper
    """.split()  # noqa: SIM905
)
# Names that begin so tell what a container has or lacks, not what it is.
NOT_ITSELF = frozenset("has no not with without is are if".split())
CERTAIN, LAYOUT, HINT = range(3)
ATTRIBUTES = re.compile(r"""(?:^|\s)(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
# A comment, a dropped element, a tag, or any other markup.
MARKUP = re.compile(
    r"<!--.*?(?:-->|\Z)"
    rf"|<({DROPPED})\b(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+>.*?(?:</\1\s*>|\Z)"
    r"|<(/?)([a-z][^\s/>]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>"
    r"|<(/?)([a-z][^\s/>]*+)([^>]*+)>"
    r"|<[!?][^>]*+>",
    re.S | re.I,
)
WORD = re.compile(r"[^\W\d_]+")


def mark_of(names: str) -> int | None:
    """What the class, id and role of a container say: ``CERTAIN`` or ``LAYOUT`` mark, ``HINT``, or
    nothing."""
    found = []
    for name in names.lower().split():
        parts = [part for part in re.split(r"[-_]+", name.replace("side-bar", "sidebar")) if part]
        if not parts or parts[0] in NOT_ITSELF:
            continue
        kinds = {_mark_word(part) for part in parts}
        if kinds & {CERTAIN, LAYOUT}:
            whole = all(_mark_word(p) is not None or p in FRAME for p in parts)
            found.append(min(kinds - {None}) if whole else HINT)
    return min(found, default=None)


def _mark_word(word: str) -> int | None:
    if word in MARKS or word.startswith(MARK_BEGINS):
        return CERTAIN
    return LAYOUT if word in LAYOUT_MARKS else None


@dataclass
class Block:
    """Text of one block; ``main`` is the number of the article it is in, ``PAGE``, or 0, and
    ``marks`` are those containers around it that are not certain to be no text."""

    barred: bool
    main: int
    marks: tuple[int, ...] = ()
    parts: list[str] = field(default_factory=list)
    linked: list[str] = field(default_factory=list)

    @property
    def text(self) -> str:
        return " ".join("".join(self.parts).split())

    @property
    def words(self) -> list[str]:
        return WORD.findall(self.text.lower())

    @property
    def links(self) -> int:
        return len(" ".join("".join(self.linked).split()))

    def verdict(self) -> bool | None:
        """Pass one: text, no text, or undecided."""
        if self.barred:
            return False
        text, links = self.text, self.links
        if links > MAX_LINK_DENSITY * len(text):
            return None if self.main else False
        stop = _stop_share(self.words)
        return True if len(text) >= SHORT and stop >= STOPWORDS_HIGH else None


def _stop_share(words: list[str]) -> float:
    return sum(w in STOPWORDS for w in words) / max(1, len(words))


@dataclass(frozen=True)
class _Place:
    """An open element: what holds for the text in it."""

    name: str
    barred: bool = False
    main: int = 0
    marks: tuple[int, ...] = ()


class _Page:
    """Blocks of a page, and the open elements around the current place."""

    def __init__(self) -> None:
        self.blocks: list[Block] = []
        self.open: list[_Place] = []
        self.kinds: list[int] = []
        self.mains = 0
        # How many elements are open around the open link, if there is one.
        self.link: int | None = None
        self.fresh = True

    def text(self, raw: str) -> None:
        if not raw:
            return
        if self.fresh:
            at = self.open[-1] if self.open else _Place("")
            self.blocks.append(Block(at.barred, at.main, at.marks))
            self.fresh = False
        self.blocks[-1].parts.append(raw)
        if self.link is not None:
            self.blocks[-1].linked.append(raw)

    def close(self, at: int) -> None:
        """End the open elements from the given one on, and a link that began inside of them."""
        del self.open[at:]
        if self.link is not None and self.link > at:
            self.link = None

    def begin(self, name: str, attributes: str) -> None:
        if name == "br":
            self.text(" ")
        elif name == "a":
            self.link = len(self.open)
        if name in VOID or name in INLINE:
            if name in VOID and name not in INLINE and name != "br":
                self.fresh = True
            return
        self.fresh = True
        while self.open and self._ends(self.open[-1].name, name):
            self.close(len(self.open) - 1)
        around = self.open[-1] if self.open else _Place("")
        barred, main, marks = around.barred, around.main, around.marks
        if name in MAIN:
            self.mains += 1
            main = self.mains
        # The header of an article holds its title.
        elif name in CONTAINERS and not (name == "header" and main):
            barred = True
        kind = LAYOUT if name == "form" else None
        if name not in ("html", "body", *MAIN) and attributes:
            names = " ".join("".join(found) for found in ATTRIBUTES.findall(attributes))
            said = mark_of(names) if names else None
            kind = said if kind is None or said == CERTAIN else kind
        if kind == CERTAIN:
            barred = True
        elif kind is not None:
            marks += (len(self.kinds),)
            self.kinds.append(kind)
        self.open.append(_Place(name, barred, main, marks))

    @staticmethod
    def _ends(opened: str, name: str) -> bool:
        if opened == "p":
            return True
        if opened == "head":
            return name not in IN_HEAD
        return name in ENDED_BY.get(opened, ())

    def end(self, name: str) -> None:
        if name == "a":
            self.link = None
        if name in INLINE:
            return
        self.fresh = True
        for at in range(len(self.open) - 1, -1, -1):
            if self.open[at].name == name:
                self.close(at)
                break

    def decided(self) -> list[Block]:
        """The blocks that hold more than white space, barred also by the marks that prove true."""
        blocks = [block for block in self.blocks if block.text]
        if self.kinds:
            self._weigh(blocks)
        return blocks

    def _weigh(self, blocks: list[Block]) -> None:
        plain = [b for b in blocks if not b.barred]
        total, articles = 0, set()
        found = [_Weight() for _ in self.kinds]
        for block in plain:
            size, links = len(block.text), block.links
            total += size
            articles |= {block.main} - {0}
            for mark in block.marks:
                found[mark].add(size, links, block.main)
        true = set()
        for mark, (kind, of) in enumerate(zip(self.kinds, found, strict=True)):
            holds_page = 2 * of.size > total and of.articles == articles
            prose = of.links <= MAX_LINK_DENSITY * of.size and of.size >= SHORT * of.blocks
            if not (holds_page or kind == HINT and prose):
                true.add(mark)
        for block in plain:
            block.barred = not true.isdisjoint(block.marks)


@dataclass
class _Weight:
    """What a marked container holds."""

    size: int = 0
    links: int = 0
    blocks: int = 0
    articles: set[int] = field(default_factory=set)

    def add(self, size: int, links: int, main: int) -> None:
        self.size += size
        self.links += links
        self.blocks += 1
        self.articles |= {main} - {0}


def blocks_of(page: str) -> list[Block]:
    """The blocks of a page that hold more than white space, in order."""
    parsed, at = _Page(), 0
    for markup in MARKUP.finditer(page):
        parsed.text(html.unescape(page[at : markup.start()]))
        at = markup.end()
        name = (markup[3] or markup[6] or "").lower()
        if name and (markup[2] or markup[5]):
            parsed.end(name)
        elif name:
            parsed.begin(name, markup[4] or markup[7] or "")
    parsed.text(html.unescape(page[at:]))
    return parsed.decided()


def _together(one: Block, other: Block) -> bool:
    """Whether both are in one article, outside of what is barred there."""
    return bool(one.main) and one.main == other.main and one.barred == other.barred


def settle(blocks: list[Block], first: list[bool | None]) -> list[bool]:
    """Pass two: undecided blocks follow their nearest decided neighbours."""

    def nearest(step: int) -> list[int | None]:
        """Of each block the nearest decided one on one side."""
        found: list[int | None] = [None] * len(blocks)
        last = None
        for i in range(len(blocks))[::step]:
            found[i] = last
            if first[i] is not None:
                last = i
        return found

    labels = []
    for i, (left, right) in enumerate(zip(nearest(1), nearest(-1), strict=True)):
        sides = [k for k in (left, right) if k is not None]
        if (own := first[i]) is not None:
            labels.append(own)
        elif inside := [k for k in sides if _together(blocks[k], blocks[i])]:
            labels.append(any(first[k] for k in inside))
        elif blocks[i].main or not sides:
            labels.append(True)
        else:
            labels.append(bool(first[min(sides, key=lambda k: abs(k - i))]))
    return labels


def _read_like_article(blocks: list[Block]) -> None:
    """Mark the blocks outside of articles, but for links, of a page with few stop words."""
    if any(not (block.main or block.barred) for block in blocks):
        plain = [b for b in blocks if not b.barred and b.links <= MAX_LINK_DENSITY * len(b.text)]
        if _stop_share([word for block in plain for word in block.words]) < STOPWORDS_HIGH:
            for block in plain:
                block.main = block.main or PAGE


def main_text(page: str | None) -> str:
    blocks = blocks_of(page or "")
    _read_like_article(blocks)
    labels = settle(blocks, [block.verdict() for block in blocks])
    return " ".join(b.text for b, good in zip(blocks, labels, strict=True) if good)


def extract(pages: DataFrame) -> DataFrame:
    """``page_id, url, text, n_chars`` for every row of ``pages`` (``page_id, url, html``)."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            texts = [main_text(page) for page in texts_of(rows, "html")]
            yield pa.RecordBatch.from_arrays(
                [
                    rows.column("page_id"),
                    rows.column("url"),
                    pa.array(texts, pa.string()),
                    pa.array([len(t) for t in texts], pa.int64()),
                ],
                names=["page_id", "url", "text", "n_chars"],
            )

    columns = pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), "html")
    return columns.mapInArrow(read, "page_id long, url string, text string, n_chars long")
