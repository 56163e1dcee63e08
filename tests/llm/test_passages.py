"""Conversation repair, collocations and repeated passages against plain versions of themselves."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict
from functools import cache

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from larder.llm import conversations, grammar, language, phrases, repeats

from .conftest import LONG, ODD


# Grammars


@settings(max_examples=200, deadline=None)
@given(sequences=st.lists(st.lists(st.integers(0, 3), min_size=1, max_size=40), max_size=8))
def test_grammars_give_their_sequences_back(sequences):
    rules, left = grammar.re_pair(sequences, 4)

    def spelled(symbols):
        out = []
        for s in symbols:
            out += [s] if s < 4 else spelled(rules[s - 4])
        return out

    assert [spelled(s) for s in left] == sequences
    # No pair is left that stands in two places apart from each other.
    pairs = defaultdict(list)
    for n, s in enumerate(left):
        for i in range(len(s) - 1):
            pairs[s[i], s[i + 1]].append((n, i))
    for (a, b), at in pairs.items():
        apart = [p for p, q in zip(at[1:], at) if a != b or p[0] != q[0] or p[1] != q[1] + 1]
        assert not apart


@settings(max_examples=200, deadline=None)
@given(parts=st.lists(st.binary(max_size=50), max_size=12), other=st.lists(st.binary(max_size=50), max_size=12))
def test_ropes_compare_as_their_texts(parts, other):
    def rope(texts):
        out = grammar.Rope()
        for t in texts:
            out = out + grammar.Rope(t)
        return out

    a, b = rope(parts), rope(other)
    assert bytes(a) == b"".join(parts)
    assert (a < b) == (b"".join(parts) < b"".join(other))
    assert (a + b < a + a) == (bytes(a) + bytes(b) < bytes(a) * 2)


# Conversations

BLANKS = " \t\n\x0b\x0c\r"
LEADS = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}


def plain_damage(rows):
    out = []
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        shown = [" " if x is None else str(x) for x in (conv, turn)]
        kind = zlib.crc32(":".join(shown).encode()) % 20
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        role = "user" if kind == 4 else role
        out += [(conv, turn, role, text)] * {0: 0, 3: 2}.get(kind, 1)
    return out


def plain_repair(rows):
    """All edits of one conversation tried with memory: the contract, read literally."""
    rows = sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[2], hashlib.sha256(r[3].encode()).digest()))
    turns = [r[1] for r in rows if r[1] is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    seen, faults = set(), []
    for _, _, role, text in rows:
        end = text.strip(BLANKS)[-1:]
        fault = "b" if not end else "d" if (role, text) in seen else "" if end in ".!?" else "t"
        faults.append(fault)
        seen.add((role, text))
    initials = [r[2][:1] for r in rows]
    illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))

    @cache
    def go(i, state, inserts):
        ways = [(0, "", ())] if i == len(rows) and state in (0, 3) else []

        def way(cost, letter, line, rest):
            if rest is not None:
                ways.append((cost + rest[0], letter + rest[1], (line,) * (line is not None) + rest[2]))

        if inserts < 3:
            role = "assistant" if state == 2 else "user"
            way(5, "I", f"{role}:", go(i, LEADS[state, role[0]], inserts + 1))
        if i < len(rows):
            _, _, role, text = rows[i]
            way(2, "D", None, go(i + 1, state, 0))
            if faults[i] not in ("b", "d"):
                extra = 5 * (faults[i] == "t")
                for new, cost, letter in ((role, 0, "K"), ("user", 1, "R"), ("assistant", 1, "R")):
                    if (to := LEADS.get((state, new[:1]))) is not None:
                        way(cost + extra, letter, f"{new}:{text}", go(i + 1, to, 0))
        return min(ways, default=None)

    cost, audit, lines = go(0, 0, 0)
    sha = hashlib.sha256("\n".join(lines).encode()).hexdigest()
    return gaps, faults.count("b"), faults.count("d"), faults.count("t"), illegal, cost, audit, sha


TURNS = "conv_id long, turn long, role string, text string"


def random_turns(seed, conversations=60):
    pick = random.Random(seed)
    texts = ["Yes.", "No!", "cut off", "", " \t", "What?", "Yes.  ", None, "é…", "a. \x0b"]
    roles = ["user", "assistant", "system", "user", "assistant", "tool", "", None, "User"]
    rows = []
    for conv in [None, *range(conversations)]:
        for turn in range(pick.choice([1, 2, 5, 9, 30])):
            turn = pick.choice([turn, turn, turn, turn + 3, None])
            rows.append((conv, turn, pick.choice(roles), pick.choice(texts) if pick.random() < 0.5 else f"{pick.random()}."))
    return rows + pick.sample(rows, 20)


def expected(rows, of=None):
    by = {r[0]: [] for r in (of or rows)}
    for r in rows:
        by[r[0]].append(tuple(" " if x is None and i > 1 else x for i, x in enumerate(r)))
    return {conv: plain_repair(found) for conv, found in by.items()}


@pytest.mark.parametrize("damage", [False, True])
def test_repairs_are_the_cheapest(spark, monkeypatch, damage):
    rows = random_turns(1)
    # Short segments, so that one conversation is made of several matrices.
    monkeypatch.setattr(conversations, "SEGMENT", 4)
    table = spark.createDataFrame(rows, TURNS).repartition(5).withColumn("kind", F.lit("x"))
    found = conversations.summaries(conversations.damaged(table) if damage else table, table)
    got = {r[0]: tuple(r)[1:] for r in found.collect()}
    assert got == expected(plain_damage(rows) if damage else rows, rows)


def test_a_conversation_with_most_rows_is_spread(spark, conf):
    conf("spark.sql.adaptive.coalescePartitions.enabled", "false")
    rows = [(7, i, "user" if i % 3 else "assistant", f"{i % 50}.") for i in range(240)]
    rows += [(i, 0, "user", "a.") for i in range(100, 150)]
    table = spark.createDataFrame(rows, TURNS)
    segments = conversations._segments(conversations.symbols(table)).filter("conv_id = 7")
    assert segments.select("part").distinct().count() > 4
    got = {r[0]: tuple(r)[1:] for r in conversations.summaries(table).collect()}
    assert got == expected(rows)


def test_repaired_turns_alternate(spark):
    rows = random_turns(2, 20)
    found = conversations.repaired(spark.createDataFrame(rows, TURNS)).collect()
    by = defaultdict(list)
    for r in found:
        by[r["conv_id"]].append((r["place"], r["role"], r["text"]))
    want = expected(rows)
    for conv, (*_, sha) in want.items():
        lines = sorted(by[conv])
        assert [n for n, _, _ in lines] == list(range(len(lines)))
        assert re.fullmatch("(s?(ua)+)?", "".join(role[0] for _, role, _ in lines))
        assert hashlib.sha256("\n".join(f"{r}:{t}" for _, r, t in lines).encode()).hexdigest() == sha


def test_no_conversations(spark):
    none = spark.createDataFrame([], TURNS)
    assert conversations.summaries(conversations.damaged(none), none).count() == 0
    gone = spark.createDataFrame([(1, t, "user", "a.") for t in range(40)], TURNS)
    lost = [t for t in range(40) if zlib.crc32(f"1:{t}".encode()) % 20 == 0]
    gone = gone.filter(F.col("turn").isin(lost))
    empty = hashlib.sha256(b"").hexdigest()
    found = conversations.summaries(conversations.damaged(gone), gone).collect()
    assert [tuple(r) for r in found] == [(1, 0, 0, 0, 0, 0, 0, "", empty)]


# Collocations


def plain_phrases(rows, least, top):
    counts, total = defaultdict(Counter), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split("[.,;:!?\x0a-\x0d]", text):
            words = re.findall("[^\x20\x09]+", piece)
            total[lang] += len(words)
            for i in range(len(words)):
                for j in range(i + 1, min(i + 5, len(words)) + 1):
                    counts[lang][tuple(words[i:j])] += 1
    out = []
    for lang, f in counts.items():
        often = {g: a for g, a in f.items() if a >= least and len(g) > 1}
        covered = {
            g[i:j]
            for g, a in often.items()
            for i in range(len(g))
            for j in range(i + 2, len(g) + 1)
            if j - i < len(g) and a >= f[g[i:j]]
        }
        ranked = []
        for g, a in often.items():
            if g not in covered:
                score, k = min((1000 * a * total[lang] // (f[g[:k]] * f[g[k:]]), k) for k in range(1, len(g)))
                ranked.append((-score, -a, " ".join(g).encode(), f[g[:k]], f[g[k:]]))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(ranked)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, total[lang], -score))
    return sorted(out)


def random_prose(seed):
    pick = random.Random(seed)
    words = ["the", "The", "of", "é", "x", "\x00", "--", "(a)", "İ", "z" * 3_000, "b\x1cc"]
    joints = [" "] * 8 + ["  ", "\t", ". ", ",", "\n", "\x0b", " | "]
    rows = []
    for _ in range(120):
        text = "".join(pick.choice(words) + pick.choice(joints) for _ in range(pick.choice([0, 3, 90])))
        rows.append((text, pick.choice(["en", "en", "de", None, "und", ""])))
    return rows + [("the of the of " * 400, "en"), ("x x x x x x", "de")] * 2 + [(None, "en"), (None, None)]


@pytest.mark.parametrize("group", [50, 1_000, 1_000_000])
def test_collocations(spark, monkeypatch, group):
    rows = random_prose(3)
    monkeypatch.setattr(phrases, "CHUNK", 5_000)
    docs = spark.createDataFrame(rows, "text string, lang string").repartition(3).withColumn("gram", F.lit(1))
    for least, top in ((4, 40), (20, 5)):
        found = phrases.collocations(docs, least=least, top=top, group=group).collect()
        assert sorted(tuple(r) for r in found) == plain_phrases(rows, least, top)


def test_no_collocations(spark, empty, odd):
    assert phrases.collocations(empty).count() == 0
    want = plain_phrases([(r[1], r[2]) for r in ODD], 3, 50)
    found = phrases.collocations(odd, least=3, top=50).collect()
    assert sorted(tuple(r) for r in found) == want


@settings(max_examples=100, deadline=None)
@given(st.lists(st.tuples(*[st.integers(1, 3)] * 4), min_size=1, max_size=60), st.integers(1, 4))
def test_subtrees_sum_their_leaves(rows, least):
    leaves = np.array(rows, np.uint32).T
    want = Counter(r[:k] for r in rows for k in range(2, 5))
    got = {}
    for grams, counts in phrases.subtree(list(leaves), np.ones(len(rows), np.int64), least):
        got.update(zip(map(tuple, grams.T.tolist()), counts.tolist()))
    assert got == {g: n for g, n in want.items() if n >= least}


@pytest.mark.parametrize("longest, groups", [(5, 1), (5, 3), (4, 2)])
def test_leaves_travel_in_order_and_packed(spark, longest, groups):
    words = np.random.default_rng(5).zipf(1.3, 60_000) % 3_000
    coded = spark.createDataFrame([("en", bytearray(words.astype(np.uint32).tobytes()))], "lang string, ids binary")
    rows = phrases._dealt(coded, np.empty(0, np.uint64), groups, longest).collect()
    assert len({r["part"] for r in rows}) == groups
    found, want = {}, {}
    for r in rows:
        leaves = phrases._unpacked(bytes(r["leaves"]), longest + 1)
        assert len(r["leaves"]) < leaves.nbytes / 2
        alike = [tuple(x) for x in leaves[:longest].T.tolist()]
        assert alike == sorted(set(alike))
        found |= dict(zip(alike, leaves[longest].tolist(), strict=True))
    for suffix in phrases._suffixes(words.astype(np.uint32).tobytes(), longest).T.tolist():
        want[tuple(suffix)] = want.get(tuple(suffix), 0) + 1
    assert found == want


def test_packing_gives_back_any_leaves():
    rng = np.random.default_rng(6)
    for rows in (0, 1, 2, 1_000):
        columns = rng.integers(0, 2**32, (6, rows), dtype=np.uint32)
        assert (phrases._unpacked(phrases._packed(columns), 6) == columns).all()


def test_numbers_are_looked_up(spark):
    """Every chunk is translated, also one without a frequent word: rows follow the dictionaries."""
    docs = spark.createDataFrame([("a b. c", "en"), ("a d", "de")], "text string, lang string")
    chunks = phrases.stage(phrases._chunks(docs.repartition(1)), "chunks")
    for numbered, want in (([("en", b"a", 7), ("en", b"c", 9)], {"en": [7, 0, 9, 0], "de": []}), ([], {"en": [], "de": []})):
        words = spark.createDataFrame(numbered, "lang string, word binary, id int")
        got = {r["lang"]: np.frombuffer(r["ids"], np.uint32).tolist() for r in phrases._numbered(chunks, words).collect()}
        assert got == want


def test_scores_past_64_bits(spark):
    rows = [("x", [1], 3_000_000_007), ("x", [2], 2_000_000_011), ("x", [1, 2], 1_999_999_973)]
    grams = spark.createDataFrame(rows, "lang string, gram array<int>, n long")
    total = 9_007_199_254_740_993
    totals = spark.createDataFrame([("x", total)], "lang string, total long")
    found = phrases.scored(grams, totals).first()
    assert found["score"] == 1000 * 1_999_999_973 * total // (3_000_000_007 * 2_000_000_011)


# Repeated passages


def plain_cuts(texts, size):
    starts = defaultdict(int)
    for t in texts:
        for i in range(len(t) - size + 1):
            starts[t[i : i + size]] += 1
    out = []
    for t in texts:
        gone = bytearray(len(t))
        for i in range(len(t) - size + 1):
            if starts[t[i : i + size]] > 1:
                gone[i : i + size] = b"\x01" * size
        kept = bytes(b for b, g in zip(t, gone) if not g)
        spans = sum(1 for i in range(len(t)) if gone[i] and not (i and gone[i - 1]))
        out.append((len(t), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return out


def random_texts(seed, size):
    pick = random.Random(seed)
    letters = "abcdé "

    def noise(n):
        return "".join(pick.choice(letters) for _ in range(n))

    shared = [noise(pick.choice([size - 1, size, size + 1, 3 * size, 9 * size])) for _ in range(6)]
    texts = [None, "", "a", "ab" * 3 * size, "a" * 5 * size, "a" * (size + 1)]
    for _ in range(60):
        parts = [noise(pick.randrange(2 * size)) for _ in range(pick.randrange(3))]
        parts += pick.sample(shared, pick.randrange(3))
        pick.shuffle(parts)
        texts.append("".join(parts))
    # Near copies: one letter differs.
    for t in [t for t in texts[6:] if t][:15]:
        i = pick.randrange(len(t))
        texts.append(t[:i] + "#" + t[i + 1 :])
    return texts + texts[6:12]


@pytest.mark.parametrize("size, piece", [(8, 64), (40, 1 << 18), (40, 200), (101, 512)])
def test_repeated_passages(spark, monkeypatch, size, piece):
    monkeypatch.setattr(repeats, "PIECE", piece)
    texts = random_texts(size, size)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    docs = docs.withColumn("text_key", F.lit("x")).withColumn("low", F.lit(1))
    want = plain_cuts([(t or "").encode() for t in texts], size)
    got = {r[0]: tuple(r)[1:] for r in repeats.digest(docs, size).collect()}
    assert got == dict(enumerate(want))
    kept = {r["row"]["doc_id"]: bytes(r["kept"]) for r in repeats.without_repeats(docs, size).collect()}
    assert {i: hashlib.sha256(k).hexdigest() for i, k in kept.items()} == {i: w[3] for i, w in enumerate(want)}


def test_repeated_passages_of_odd_rows(odd, empty):
    assert repeats.digest(empty).count() == 0
    found = sorted((tuple(r) for r in repeats.digest(odd).collect()), key=str)
    want = plain_cuts([(r[1] or "").encode() for r in ODD if r[1] not in (LONG, LONG + " tail")], 400)
    short = [r[0] for r in ODD if r[1] not in (LONG, LONG + " tail")]
    sha = hashlib.sha256(LONG.encode()).hexdigest()
    assert [r for r in found if r[0] not in (7, 8)] == sorted(((i, *w) for i, w in zip(short, want)), key=str)
    both = {r[0]: r for r in found}
    size = len(LONG)
    gone = hashlib.sha256(b"").hexdigest()
    tail = hashlib.sha256(b" tail").hexdigest()
    assert sha and both[7] == (7, size, size, 1, gone) and both[8] == (8, size + 5, size, 1, tail)


@pytest.mark.parametrize("name", ["op11_conversations", "op12_collocations", "op13_repeats"])
def test_queries_on_the_tables(spark, sf_dir, name):
    from larder.llm.queries import QUERIES

    got = sorted(tuple(r) for r in QUERIES[name](spark, sf_dir).collect())
    table = "conversations" if name.startswith("op11") else "documents"
    rows = spark.read.parquet(f"{sf_dir}/{table}.parquet").collect()
    if name.startswith("op11"):
        turns = [tuple(r) for r in rows]
        want = sorted((conv, *of) for conv, of in expected(plain_damage(turns), turns).items())
    elif name.startswith("op12"):
        want = plain_phrases([(r["text"], r["lang"]) for r in rows], 100, 2_000)
    else:
        cuts = plain_cuts([(r["text"] or "").encode() for r in rows], 400)
        want = sorted((r["doc_id"], *c) for r, c in zip(rows, cuts))
    assert got == want


# Languages


def plain_language(learned, texts):
    """Every score from counts, as the module says it, with nothing kept back."""
    import math

    words = {lang: Counter(w for t in of for w in language.words_of(t)) for lang, of in learned.items()}
    langs, vocabulary = sorted(words), {w for c in words.values() for w in c}
    spelt = {lang: Counter() for lang in langs}
    for lang in langs:
        for w, n in words[lang].items():
            for size in language.SIZES:
                for g in language.grams(w, size):
                    spelt[lang][g] += n
    known = {g for c in spelt.values() for g in c}
    sizes = {n: [g for g in known if len(g) == n] for n in language.SIZES}
    total = {(lang, n): sum(spelt[lang][g] for g in sizes[n]) for lang in langs for n in sizes}

    def word_score(lang, w):
        if w in vocabulary:
            return math.log((words[lang][w] + 0.5) / (sum(words[lang].values()) + 0.5 * len(vocabulary)))
        marked, found = f"<{w}>", []
        for i in range(len(marked)):
            for n in range(min(5, len(marked) - i), 0, -1):
                g = marked[i : i + n]
                if g in known:
                    log = math.log((spelt[lang][g] + 0.5) / (total[lang, n] + 0.5 * len(sizes[n])))
                    found.append(log + (5 - n) * language.BACKOFF)
                    break
        return sum(found) / len(found) if found else 0.0

    out = []
    for text in texts:
        spoken = language.words_of(text)
        level = [sum(word_score(lang, w) for w in spoken) / math.sqrt(len(spoken)) for lang in langs]
        shares = [math.exp(x - max(level)) for x in level]
        out.append((langs[level.index(max(level))], max(shares) / sum(shares)))
    return out


def spoken(pick, letters, n):
    return " ".join("".join(pick.choice(letters) for _ in range(pick.randrange(1, 7))) for _ in range(n))


def test_scores_are_what_counts_say(spark):
    pick = random.Random(5)
    kinds = {"aa": "abcde", "bb": "cdefgh", "cc": "fghijé"}
    learned = {lang: [spoken(pick, letters, 30) for _ in range(12)] for lang, letters in kinds.items()}
    rows = [(t, lang) for lang, of in learned.items() for t in of]
    docs = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "doc_id long, text string, lang string")
    model = language.train(docs)
    texts = [spoken(pick, "abcdefghijéxyz", pick.choice([1, 2, 5, 40])) for _ in range(80)] + ["zzz", "A B"]
    asked = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in language.predict(asked, model).collect()}
    for i, (lang, score) in enumerate(plain_language(learned, texts)):
        assert got[i][1] == pytest.approx(score, abs=1e-4)
        assert got[i][0] == lang or score < 0.51


def test_every_label_can_be_predicted(spark):
    """However many there are, and however rare one is."""
    rows = [(i, f"w{chr(97 + i % 7)}{'x' * (i % 5)} common", "big") for i in range(300)]
    spell = lambda n: "".join(chr(97 + int(d)) for d in f"{n:04}")
    rows += [(1_000 + n, f"q{spell(n)} q{spell(n)}z common", f"l{n:03}") for n in range(150)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = language.train(docs, words_per_language=3, grams_per_language=40)
    assert len(model.languages) == 151
    asked = spark.createDataFrame([(n, f"q{spell(n)} q{spell(n)}z") for n in range(150)], "doc_id long, text string")
    got = {r["doc_id"]: r["lang_pred"] for r in language.predict(asked, model).collect()}
    assert got == {n: f"l{n:03}" for n in range(150)}
    # What one language keeps is counted in all.
    assert all((model.word_logs[row] > -20).all() for row in model.words.values())
    common = model.word_logs[model.words["common"]]
    assert (common > model.word_logs[model.words["q" + spell(0)]].min()).all()
