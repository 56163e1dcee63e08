"""Collocations by vertical partitioning: suffix subtrees of bounded size, built one by one.

1. Texts become strings of word numbers in chunks, each with its own short dictionary. Words found at
   least ``LEAST`` times get numbers for the whole corpus; any other word ends the phrases around it.
2. Suffixes are divided by their first word. A word that begins more of them than a subtree may hold is
   prolonged by the next word, and again while that is still too many: no prefix left is over the
   budget, unless it is a whole phrase, whose copies are one leaf per chunk. Prefixes are dealt into as
   many groups as the budget asks for, so a group is expected to fill half of it.
3. Every group builds its subtree on its own, down to ``LONGEST`` words. A node's count is the sum of the
   leaves below it, and a branch ends where that falls under ``LEAST``.
4. Cuts, longer phrases and ranks follow from joins of the frequent phrases.

Chunks combine equal suffixes before they are shuffled, and suffixes travel as arrays in order, packed, a
row for each group that a chunk has any for. The prolonged prefixes are all that tasks are sent: at most one per
``GROUP`` words of the corpus and length.

Defined cases: null texts count as empty, a null language as ``und``; texts without words have no
phrase; repeated rows count again; an empty table gives an empty result; further columns are not read.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window, functions as F

from larder.operators.ids import row_ids
from larder.workspace import keep, scratch_scope, stage

LEAST = 100
LONGEST = 5
TOP = 2_000
# Suffixes in a subtree, and bytes of text in a chunk: what bounds a task's memory.
GROUP = 2_000_000
CHUNK = 4 << 20
# Shares that a language's phrases are ranked in before their leaders meet in one task.
SHARES = 64

_U = np.uint64
_UPPER, _LOWER = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz"
_ENDS = b".,;:!?\x0a\x0b\x0c\x0d"
_SIGNS = bytes.maketrans(_UPPER + _ENDS + b"\t", _LOWER + b"\n" * len(_ENDS) + b" ")


def _chunks(docs: DataFrame) -> DataFrame:
    """``chunk, lang, words, counts, places``: a piece's end is 0 in ``places``, words count from 1."""
    texts = docs.select(
        F.coalesce("lang", F.lit("und")).alias("lang"),
        F.coalesce(F.col("text").cast("binary"), F.lit(b"")).alias("data"),
    )

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, tuple[dict[bytes, int], list[np.ndarray]]] = {}
        held = 0
        for rows in batches:
            for lang, data in zip(rows.column("lang").to_pylist(), rows.column("data"), strict=True):
                if lang not in known:
                    # Numbers are given in order of appearance; blanks between words are dropped below.
                    numbers: dict[bytes, int] = defaultdict()
                    numbers.default_factory = numbers.__len__
                    numbers[b"\n"], numbers[b""] = 0, 1
                    known[lang] = numbers, []
                numbers, found = known[lang]
                text = data.as_buffer().to_pybytes().translate(_SIGNS)
                words = text.replace(b"\n", b" \n ").split(b" ")
                places = np.fromiter(map(numbers.__getitem__, words), np.uint32, len(words))
                found += [places[places != 1], np.zeros(1, np.uint32)]
                held += len(text)
                if held >= CHUNK:
                    yield chunk(known)
                    known, held = {}, 0
        if known:
            yield chunk(known)

    def chunk(known: dict) -> pa.RecordBatch:
        columns: list[list] = [[], [], [], []]
        for lang, (numbers, found) in known.items():
            places = np.concatenate(found)
            places -= places > 1
            counts = np.bincount(places, minlength=len(numbers) - 1)[1:]
            words = [w for w in numbers if w not in (b"\n", b"")]
            for column, value in zip(
                columns, (lang, words, counts.tolist(), places.tobytes()), strict=True
            ):
                column.append(value)
        kinds = (pa.string(), pa.list_(pa.binary()), pa.list_(pa.int64()), pa.binary())
        return pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
            names=["lang", "words", "counts", "places"],
        )

    return texts.mapInArrow(
        encode, "lang string, words array<binary>, counts array<long>, places binary"
    ).withColumn("chunk", F.monotonically_increasing_id())


def _numbered(chunks: DataFrame, words: DataFrame) -> DataFrame:
    """``lang, ids``: the chunks in numbers of the whole corpus, 0 where phrases end."""
    local = chunks.select("chunk", "lang", F.posexplode("words").alias("place", "word"))
    # Looked up, not matched: a chunk's word has one number or none, so the join makes as many rows as
    # the chunks' dictionaries have, however many words have become frequent. Nulls are not collected.
    looked_up = local.join(words.select("lang", "word", "id"), ["lang", "word"], "left")
    known = (
        looked_up.groupBy("chunk")
        .agg(F.collect_list(F.when(F.col("id").isNotNull(), F.struct("place", "id"))).alias("found"))
        .select("chunk", F.col("found.place").alias("known"), F.col("found.id").alias("ids"))
    )

    def translate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            out = []
            for place, known, ids in zip(
                *(rows.column(c) for c in ("places", "known", "ids")), strict=True
            ):
                places = np.frombuffer(place.as_buffer(), np.uint32)
                table = np.zeros(int(places.max(initial=0)) + 1, np.uint32)
                table[known.values.to_numpy() + 1] = ids.values.to_numpy()
                found = table[places]
                # Of ends in a row one is enough.
                stays = (found != 0) | (np.roll(found, 1) != 0)
                out.append(found[stays].tobytes())
            yield pa.RecordBatch.from_arrays(
                [rows.column("lang"), pa.array(out, pa.binary())], names=["lang", "ids"]
            )

    return (
        chunks.join(known, "chunk").select("lang", "places", "known", "ids")
        .mapInArrow(translate, "lang string, ids binary")
    )


def _suffixes(ids: bytes, longest: int) -> np.ndarray:
    """A row per suffix of two words and more, up to ``longest`` words, then zeros."""
    found = np.concatenate([np.frombuffer(ids, np.uint32), np.zeros(longest, np.uint32)])
    count = len(found) - longest
    at = np.flatnonzero((found[:count] != 0) & (found[1 : count + 1] != 0))
    out = np.empty((longest, len(at)), np.uint32)
    for k in range(longest):
        out[k] = found[at + k]
        if k:
            out[k][out[k - 1] == 0] = 0
    return out


def _mixed(numbers: np.ndarray) -> np.ndarray:
    numbers = (numbers ^ (numbers >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    numbers = (numbers ^ (numbers >> _U(27))) * _U(0x94D049BB133111EB)
    return numbers ^ (numbers >> _U(31))


def _prefixes(lang: str, suffixes: np.ndarray) -> Iterator[np.ndarray]:
    """Hashes of the first word of each suffix, of its first two, and so on."""
    found = np.full(suffixes.shape[1], _U(xxhash.xxh3_64_intdigest(lang)))
    for words in suffixes:
        found = _mixed((found ^ words) * _U(0x9E3779B97F4A7C15))
        yield found


def _distinct(order: np.ndarray, suffixes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of suffixes that differ from the one before in ``order``, and how many are alike."""
    ordered = suffixes[:, order]
    new = np.ones(len(order), bool)
    new[1:] = (ordered[:, 1:] != ordered[:, :-1]).any(axis=0)
    first = np.flatnonzero(new)
    return order[first], np.diff(first, append=len(order))


def _too_many(coded: DataFrame, words: DataFrame, longest: int, group: int) -> tuple[np.ndarray, DataFrame | None]:
    """Hashes of the prefixes to be prolonged; and of those with two words and more, their counts."""
    hot: list[np.ndarray] = []
    counted: DataFrame | None = None
    over = words.filter(F.col("n") > group).select("lang", F.array("id").alias("gram")).collect()
    for length in range(1, longest):
        if not over:
            break
        for row in over:
            gram = np.array(row["gram"], np.uint32)[:, None]
            hot.append(list(_prefixes(row["lang"], gram))[-1])
        if length + 1 == longest:
            break
        known = np.sort(np.concatenate(hot))

        def longer(batches: Iterator[pa.RecordBatch], length=length, known=known) -> Iterator[pa.RecordBatch]:
            for rows in batches:
                for lang, ids in zip(rows.column("lang").to_pylist(), rows.column("ids"), strict=True):
                    suffixes = _suffixes(ids.as_buffer().to_pybytes(), longest)[: length + 1]
                    *_, before, found = _prefixes(lang, suffixes)
                    mine = np.flatnonzero(np.isin(before, known) & (suffixes[length] != 0))
                    mine, alike = _distinct(mine[np.argsort(found[mine])], suffixes)
                    yield _grams(lang, suffixes[:, mine], alike)

        step = (
            coded.mapInArrow(longer, "lang string, gram array<int>, n long")
            .groupBy("lang", "gram").agg(F.sum("n").alias("n")).filter(F.col("n") > group)
        )
        step = stage(step, "prolonged")
        counted = step if counted is None else counted.union(step)
        over = step.collect()
    return np.sort(np.concatenate(hot)) if hot else np.empty(0, _U), counted


def _grams(lang: str, grams: np.ndarray, counts: np.ndarray) -> pa.RecordBatch:
    length, count = grams.shape
    flat = pa.array(np.ascontiguousarray(grams.T).ravel().view(np.int32))
    ends = pa.array(np.arange(0, length * count + 1, length, dtype=np.int32))
    return pa.RecordBatch.from_arrays(
        [
            pa.array([lang] * count, pa.string()),
            pa.ListArray.from_arrays(ends, flat),
            pa.array(counts.astype(np.int64)),
        ],
        names=["lang", "gram", "n"],
    )


def _dealt(coded: DataFrame, hot: np.ndarray, groups: int, longest: int) -> DataFrame:
    """``lang, depth, part, leaves``: each chunk's distinct suffixes, by the group of their prefix.

    ``depth`` is the length of the prefix. Leaves are columns of words and one of counts, as ``_packed``
    has them, in the order of their words.
    """

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            for lang, ids in zip(rows.column("lang").to_pylist(), rows.column("ids"), strict=True):
                suffixes = _suffixes(ids.as_buffer().to_pybytes(), longest)
                if not suffixes.size:
                    continue
                open_ = np.ones(suffixes.shape[1], bool)
                depth = np.zeros(len(open_), np.int64)
                prefix = np.zeros(len(open_), _U)
                for found in _prefixes(lang, suffixes):
                    prefix[open_] = found[open_]
                    depth += open_
                    if not len(hot):
                        break
                    open_ &= np.isin(found, hot)
                part = (prefix % _U(groups)).astype(np.int64) * longest + depth - 1
                # By the first words first: the last key counts most.
                keys = [*_pairs(suffixes)[::-1], part]
                order = np.lexsort(keys if groups > 1 or len(hot) else keys[:-1])
                at, alike = _distinct(order, np.vstack([suffixes, part.astype(np.uint32)]))
                part, found = part[at], np.vstack([suffixes[:, at], alike.astype(np.uint32)])
                first = np.flatnonzero(np.diff(part, prepend=-1))
                leaves = [
                    _packed(found[:, a:b]) for a, b in zip(first, [*first[1:], len(part)], strict=True)
                ]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([lang] * len(first), pa.string()),
                        pa.array((part[first] % longest + 1).astype(np.int32)),
                        pa.array(part[first] // longest),
                        pa.array(leaves, pa.binary()),
                    ],
                    names=["lang", "depth", "part", "leaves"],
                )

    return coded.mapInArrow(deal, "lang string, depth int, part long, leaves binary")


def _pairs(suffixes: np.ndarray) -> list[np.ndarray]:
    """Numbers that order suffixes as their words do, two words in each."""
    odd = suffixes[2::2] if len(suffixes) % 2 else suffixes[1::2]
    even = suffixes[1::2] if len(suffixes) % 2 else suffixes[0::2]
    first = [suffixes[0].astype(_U)] if len(suffixes) % 2 else []
    return first + [a.astype(_U) << _U(32) | b for a, b in zip(even, odd, strict=True)]


def _packed(columns: np.ndarray) -> bytes:
    """Columns of sorted rows. The first two, which hardly change from row to row, as differences; all
    byte by byte, so that equal bytes lie together."""
    columns = np.array(columns, np.uint32, order="C")
    for column in columns[:2]:
        column[1:] -= column[:-1].copy()
    planes = columns.view(np.uint8).reshape(-1, 4).T.tobytes()
    return len(planes).to_bytes(8, "little") + pa.compress(planes, codec="zstd", asbytes=True)


def _unpacked(leaves: bytes, columns: int) -> np.ndarray:
    size = int.from_bytes(leaves[:8], "little")
    planes = pa.decompress(leaves[8:], decompressed_size=size, codec="zstd", asbytes=True)
    flat = np.frombuffer(planes, np.uint8).reshape(4, -1).T.copy(order="C")
    found = flat.view(np.uint32).reshape(columns, -1)
    for column in found[:2]:
        np.cumsum(column, dtype=np.uint32, out=column)
    return found


def subtree(
    leaves: list[np.ndarray], counts: np.ndarray, least: int
) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Nodes of two words and more, level by level, with the sums of the leaves below them.

    ``leaves`` are the suffixes' first words, second words and so on; a branch ends at zeros and where
    its sum is under ``least``. Columns are let go of as the tree grows past them.
    """
    node, rest = leaves[0].astype(_U), list(leaves[1:])
    grams = None
    while rest:
        word = rest.pop(0)
        there = np.flatnonzero(word)
        keys = node[there] << _U(32) | word[there]
        del node, word
        found, at = np.unique(keys, return_inverse=True)
        del keys
        total = np.bincount(at, counts[there], len(found)).astype(np.int64)
        often = total >= least
        parent, last = found[often] >> _U(32), (found[often] & _U(0xFFFFFFFF)).astype(np.uint32)
        before = parent.astype(np.uint32)[None] if grams is None else grams[:, parent.astype(np.int64)]
        grams = np.vstack([before, last[None]])
        yield grams, total[often]
        stays = often[at]
        node = (np.cumsum(often) - 1)[at[stays]].astype(_U)
        there = there[stays]
        counts, rest = counts[there], [column[there] for column in rest]


def _counted(dealt: DataFrame, longest: int, least: int) -> DataFrame:
    """``lang, gram, n``: the frequent phrases of every group's subtree."""

    def build(rows: pa.Table) -> pa.Table:
        lang, depth = rows.column("lang")[0].as_py(), rows.column("depth")[0].as_py()
        parts = [x.as_buffer().to_pybytes() for x in rows.column("leaves")]
        sizes = [int.from_bytes(part[:8], "little") for part in parts]
        ends = np.cumsum([0, *(size // (4 * (longest + 1)) for size in sizes)])
        found = np.empty((longest + 1, ends[-1]), np.uint32)
        for part, start, end in zip(parts, ends[:-1], ends[1:], strict=True):
            found[:, start:end] = _unpacked(part, longest + 1)
        leaves, counts = list(found[:longest]), found[longest]
        del found, parts
        out = [
            _grams(lang, grams, counts)
            for grams, counts in subtree(leaves, counts, least)
            if len(grams) >= depth
        ]
        none = _grams(lang, np.empty((1, 0), np.uint32), np.empty(0))
        return pa.Table.from_batches([none, *out])

    return dealt.groupBy("lang", "depth", "part").applyInArrow(
        build, "lang string, gram array<int>, n long"
    )


def frequent(
    docs: DataFrame, least: int = LEAST, longest: int = LONGEST, group: int = GROUP
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Phrases, words and totals: ``(lang, gram, n)`` with all phrases of one to ``longest`` words found
    ``least`` times and more, as word numbers; ``(lang, word, id, n)``; ``(lang, total)`` words."""
    chunks = stage(_chunks(docs), "chunks")
    totals = stage(
        chunks.select("lang", F.expr("aggregate(counts, 0L, (a, b) -> a + b)").alias("n"))
        .groupBy("lang").agg(F.sum("n").alias("total")),
        "totals",
    )
    vocabulary = (
        chunks.select("lang", F.explode(F.arrays_zip("words", "counts")).alias("x"))
        .groupBy("lang", F.col("x.words").alias("word")).agg(F.sum("x.counts").alias("n"))
    )
    words = stage(row_ids(vocabulary.filter(F.col("n") >= least), "id").withColumn("id", F.col("id").cast("int")), "words")
    coded = stage(_numbered(chunks, words), "coded")
    hot, prolonged = _too_many(coded, words, longest, group)
    total = words.agg(F.sum("n")).first()[0] or 0
    counted = _counted(_dealt(coded, hot, max(1, -(-2 * total // group)), longest), longest, least)
    if prolonged is not None:
        counted = counted.union(prolonged)
    single = words.select("lang", F.array("id").alias("gram"), "n")
    return stage(counted.union(single), "frequent"), words, totals


def _exact(number: Column) -> Column:
    return number.cast("decimal(19,0)")


def scored(grams: DataFrame, totals: DataFrame) -> DataFrame:
    """``lang, gram, a, l, r, n, score`` of the phrases of two words and more that no longer one covers.

    Products are decimals of 38 digits: exact while 1000 a and n are under 10^19.
    """
    whole = grams.filter(F.size("gram") > 1).withColumnRenamed("n", "a")
    cuts = whole.select("lang", "gram", "a", F.explode(F.sequence(F.lit(1), F.size("gram") - 1)).alias("k"))
    cuts = cuts.withColumn("head", F.expr("slice(gram, 1, k)")).withColumn(
        "tail", F.expr("slice(gram, k + 1, size(gram) - k)")
    )
    for part, name in (("head", "l"), ("tail", "r")):
        of = grams.select("lang", F.col("gram").alias(part), F.col("n").alias(name))
        cuts = cuts.join(of, ["lang", part])
    cuts = cuts.join(totals.select("lang", F.col("total").alias("n")), "lang")
    product = _exact(F.col("a") * 1000) * _exact(F.col("n"))
    cuts = cuts.withColumn("over", product).withColumn("under", _exact(F.col("l")) * _exact(F.col("r")))
    lowest = cuts.groupBy("lang", "gram").agg(
        F.first("a").alias("a"),
        F.first("n").alias("n"),
        F.min(F.struct(F.expr("over div under").alias("score"), "k", "l", "r")).alias("cut"),
    )
    # What is one word longer covers whatever is longer still does.
    longer = whole.filter(F.size("gram") > 2).select(
        "lang",
        F.explode(F.array(F.expr("slice(gram, 1, size(gram) - 1)"), F.expr("slice(gram, 2, size(gram) - 1)"))).alias("gram"),
        F.col("a").alias("longer"),
    )
    covers = longer.groupBy("lang", "gram").agg(F.max("longer").alias("longer"))
    return (
        lowest.join(covers, ["lang", "gram"], "left")
        .filter(F.col("longer").isNull() | (F.col("longer") < F.col("a")))
        .select("lang", "gram", "a", "cut.l", "cut.r", "n", "cut.score")
    )


def collocations(
    docs: DataFrame, least: int = LEAST, longest: int = LONGEST, top: int = TOP, group: int = GROUP
) -> DataFrame:
    """Each language's first ``top`` phrases of ``docs`` (``text, lang``): ``lang, rank, phrase, a, l,
    r, n, score``."""
    with scratch_scope(docs.sparkSession):
        grams, words, totals = frequent(docs, least, longest, group)
        # Phrases are spelled out for the leading ones only, ties with the last included. Each share of
        # a language is ranked first, so the last ranking reads a bounded number of rows and ties.
        leading = scored(grams, totals).withColumn("share", F.pmod(F.xxhash64("gram"), F.lit(SHARES)))
        for of in (["lang", "share"], ["lang"]):
            by_score = Window.partitionBy(*of).orderBy(F.desc("score"), F.desc("a"))
            leading = leading.withColumn("before", F.rank().over(by_score))
            leading = leading.filter(F.col("before") <= top)
        leading = stage(leading, "leading")
        spelled = (
            leading.select("lang", "gram", F.posexplode("gram").alias("place", "id"))
            .join(words.select("id", F.col("word").cast("string").alias("word")), "id")
            .groupBy("lang", "gram")
            .agg(F.sort_array(F.collect_list(F.struct("place", "word"))).alias("words"))
        )
        named = leading.join(spelled, ["lang", "gram"]).withColumn(
            "phrase", F.array_join("words.word", " ")
        )
        order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
        found = named.withColumn("rank", F.row_number().over(order).cast("long"))
        return keep(
            found.filter(F.col("rank") <= top).select("lang", "rank", "phrase", "a", "l", "r", "n", "score"),
            "collocations",
        )
