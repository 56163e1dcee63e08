"""Near-duplicates by HyperMinHash: compressed registers, banded, estimated, then verified in full.

A document is the set of its distinct shingles of ``WORDS`` words; with fewer words, the whole
sequence is its one shingle. Each shingle hash falls into one of ``REGISTERS`` buckets, and a bucket
keeps its smallest hash as the number of leading zeros and the first ``MANTISSA`` bits after them: two
bytes. Buckets that got nothing borrow from others by a fixed order of probes, so short documents fill
all registers too.

1. Documents with equal sets become one class, whatever their number.
2. Registers are cut into bands; classes that agree on a band are candidates. In each crowded band all
   are paired with its smallest and its largest class only, so pairs grow with members.
3. Pairs are compared by sizes, then by the estimated similarity (registers that agree, corrected for
   those that agree by chance), with a margin of ``DEVIATIONS`` standard deviations, then on their
   full sets. Links make components.
4. Bands that still hold several components are compared member by member inside tasks, in blocks of
   bounded size: pairs from different components by registers, in the first band they share, and
   those that pass on their full sets. Of the links found a task puts out those that join components
   not yet joined, so their number is bounded by the members'. So a band's members are in one
   component or have all been compared, and no band is too crowded to be looked at.

With the bands here a pair at the threshold of 0.8 is missed by banding with a chance of 3 in a
million, one at 0.85 with 3 in a billion.

Defined cases: documents without words are in no pair and their own component; null ids take part
and are the smallest only where no other id is; repeated rows get equal rows; empty tables give empty
results; further columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from larder.llm import bits
from larder.llm.common import Memo, row_of, texts_of
from larder.llm.components import components
from larder.workspace import keep, scratch_scope, stage

WORDS = 5
SIMILARITY = 0.8
BUCKET_BITS = 8
REGISTERS = 1 << BUCKET_BITS
MANTISSA = 10
PER_BAND = 6
BANDS = REGISTERS // PER_BAND
# How far below the threshold an estimate may lie, in standard deviations, to be verified still.
DEVIATIONS = 5
# Members of a crowded band, and shingles of theirs, that make a block; a task compares two blocks.
BLOCK = 2_048
BLOCK_SHINGLES = 8_000_000
# Distinct words whose hashes a task remembers; past it the memory starts anew.
WORDS_KEPT = 300_000
# Probes of a bucket that got nothing before it takes its nearest neighbour's.
PROBES = 16

_U = np.uint64
_STEPS = [_U(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)]
_PROBES = np.random.default_rng(20).integers(0, REGISTERS, (PROBES, REGISTERS))


def word_hashes() -> Memo:
    return Memo(xxhash.xxh3_64_intdigest, WORDS_KEPT)


def shingles(text: str, hashes: Memo) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the shingles of a text."""
    # On bytes, lower() is of A-Z alone and split() of ASCII white space alone.
    words = text.encode().lower().split()
    found = np.array(hashes.all(words), _U)
    size = min(WORDS, len(words))
    if not size:
        return found
    count = len(words) - size + 1
    mixed = np.full(count, size, _U)
    for k in range(size):
        mixed = (mixed ^ found[k : k + count]) * _STEPS[0]
        mixed ^= mixed >> _U(32)
    mixed *= _STEPS[1]
    mixed ^= mixed >> _U(29)
    mixed *= _STEPS[2]
    mixed ^= mixed >> _U(32)
    return np.unique(mixed)


def registers(sets: list[np.ndarray]) -> np.ndarray:
    """A row of ``REGISTERS`` 16-bit numbers per set: leading zeros, then mantissa; 0 if empty."""
    table = np.zeros((len(sets), REGISTERS), np.uint16)
    for row, found in zip(table, sets, strict=True):
        if not len(found):
            continue
        bucket = (found >> _U(64 - BUCKET_BITS)).astype(np.int64)
        # Sorted hashes: the first of each bucket is its smallest.
        first = np.flatnonzero(np.diff(bucket, prepend=-1))
        rest = (found[first] << _U(BUCKET_BITS)) >> _U(11)
        width = np.frexp(rest.astype(np.float64))[1]
        shift = width - 1 - MANTISSA
        tail = np.where(
            shift >= 0,
            rest >> np.maximum(shift, 0).astype(_U),
            rest << np.maximum(-shift, 0).astype(_U),
        )
        mantissa = tail & _U((1 << MANTISSA) - 1)
        row[bucket[first]] = 1 + ((53 - width) << MANTISSA) + mantissa.astype(np.int64)
    return _fill(table)


def _fill(table: np.ndarray) -> np.ndarray:
    """Empty registers take the first non-empty one that their probes meet, else the next."""
    full = table.copy()
    for probe in _PROBES:
        full = np.where(full == 0, table[:, probe], full)
    while (short := (full == 0) & (full.any(axis=1, keepdims=True))).any():
        full = np.where(short, np.roll(full, -1, axis=1), full)
    return full


def by_chance(n: np.ndarray, m: np.ndarray) -> np.ndarray:
    """Share of registers in which unrelated sets of ``n`` and ``m`` agree, for these mantissas."""
    n, m = np.asarray(n, float), np.asarray(m, float)
    return 0.1699195 * 2.0**-MANTISSA * 4 * n * m / (n + m) ** 2


def estimate(agree: np.ndarray, n: np.ndarray, m: np.ndarray) -> np.ndarray:
    """Jaccard similarity from the share of registers that agree."""
    chance = by_chance(n, m)
    return (agree - chance) / (1 - chance)


def margin(similarity: float, n: np.ndarray, m: np.ndarray) -> np.ndarray:
    """``DEVIATIONS`` standard deviations of the estimate; a short set has few free registers."""
    free = np.minimum(np.minimum(n, m), REGISTERS)
    return DEVIATIONS * np.sqrt(similarity * (1 - similarity) / np.maximum(free, 1))


def _sketch(docs: DataFrame) -> DataFrame:
    """``doc_id, text_hash, n_shingles, digest, sketch``; digest and sketch null without words."""

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = word_hashes()
        for rows in batches:
            sets = [shingles(text, hashes) for text in texts_of(rows)]
            table = registers(sets)
            yield pa.RecordBatch.from_arrays(
                [
                    rows.column("doc_id"),
                    rows.column("text_hash"),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array(
                        [xxhash.xxh3_128_digest(s) if len(s) else None for s in sets], pa.binary()
                    ),
                    pa.array(
                        [r.tobytes() if len(s) else None for r, s in zip(table, sets, strict=True)],
                        pa.binary(),
                    ),
                ],
                names=["doc_id", "text_hash", "n_shingles", "digest", "sketch"],
            )

    return _texts(docs).mapInArrow(
        sketch, "doc_id long, text_hash long, n_shingles long, digest binary, sketch binary"
    )


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(
        F.col("doc_id").cast("long"), "text", F.xxhash64("doc_id", "text").alias("text_hash")
    )


def _classes(sketches: DataFrame) -> DataFrame:
    """One row per distinct set: ``node``, its size, sketch, smallest id, and a text that has it."""
    return (
        sketches.filter("n_shingles > 0")
        .groupBy("digest")
        .agg(
            F.min("place").alias("node"),
            F.min_by(F.struct("doc_id", "text_hash"), "place").alias("of"),
            F.first("n_shingles").alias("n"),
            F.first("sketch").alias("sketch"),
            F.min("doc_id").alias("least_id"),
        )
    )


def _bands(classes: DataFrame) -> DataFrame:
    width = 2 * PER_BAND
    keys = [
        F.xxhash64(F.lit(k), F.substring("sketch", width * k + 1, width)) for k in range(BANDS)
    ]
    return classes.select("node", "n", F.posexplode(F.array(*keys)).alias("slot", "band"))


def _crowded(members: DataFrame, *by: Column) -> DataFrame:
    return members.groupBy("band").agg(
        F.count(F.lit(1)).alias("members"), F.sum("n").alias("shingles"), *by
    )


def _pairs(members: DataFrame) -> DataFrame:
    """Each member with the ends of its band, smaller node first, once."""
    ends = members.select("node", F.explode(F.array("low", "high")).alias("end"))
    return _ordered(ends.select("node", "end"))


def _ordered(pairs: DataFrame) -> DataFrame:
    a, b = (F.col(c) for c in pairs.columns)
    return (
        pairs.select(F.least(a, b).alias("a"), F.greatest(a, b).alias("b"))
        .filter("a < b")
        .distinct()
    )


def _plausible(pairs: DataFrame, classes: DataFrame, similarity: float) -> DataFrame:
    """Pairs whose sizes and estimated similarity allow a link."""

    def end(name: str) -> DataFrame:
        return classes.select(
            F.col("node").alias(name), F.col("n").alias(f"{name}_n"), F.col("sketch").alias(f"{name}_sketch")
        )

    near_in_size = F.least("a_n", "b_n") >= F.lit(similarity) * F.greatest("a_n", "b_n") - 1e-6
    both = pairs.join(end("a"), "a").join(end("b"), "b").filter(near_in_size)

    def near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            n, m = (rows.column(f"{c}_n").to_numpy() for c in "ab")
            a, b = (_table(rows.column(f"{c}_sketch")) for c in "ab")
            likely = estimate((a == b).mean(axis=1), n, m) >= similarity - margin(similarity, n, m)
            yield rows.select(["a", "b"]).filter(pa.array(likely))

    return both.select("a", "b", "a_n", "b_n", "a_sketch", "b_sketch").mapInArrow(
        near, "a long, b long"
    )


def _table(sketches: pa.Array) -> np.ndarray:
    joined = b"".join(s.as_py() for s in sketches)
    return np.frombuffer(joined, np.uint16).reshape(len(sketches), REGISTERS)


def _member_texts(docs: DataFrame, nodes: DataFrame, classes: DataFrame) -> DataFrame:
    """``(node, text)`` for every class in ``nodes``.

    A Bloom filter of the texts wanted keeps all others out of the shuffle.
    """
    wanted = stage(
        classes.join(nodes, "node").select("node", "of.doc_id", F.col("of.text_hash").alias("key")),
        "wanted",
    )
    blocks = bits.blocks_for(wanted.count())
    seen = stage(bits.set_bits(wanted, blocks), "bits")
    found = bits.mark(_texts(docs).withColumnRenamed("text_hash", "key"), seen, blocks, "found")
    same = found["doc_id"].eqNullSafe(wanted["doc_id"]) & (found["key"] == wanted["key"])
    return (
        found.filter("found").join(wanted, same).groupBy("node").agg(F.first("text").alias("text"))
    )


def _verified(
    pairs: DataFrame, docs: DataFrame, classes: DataFrame, similarity: float
) -> DataFrame:
    """The pairs ``(a, b)`` whose full shingle sets are as similar as asked."""
    likely = stage(_plausible(pairs, classes, similarity), "likely")
    nodes = likely.select(F.col("a").alias("node")).union(likely.select("b")).distinct()
    texts = stage(_member_texts(docs, nodes, classes), "texts")
    percent = round(100 * similarity)

    def end(name: str) -> DataFrame:
        return texts.select(F.col("node").alias(name), F.col("text").alias(f"{name}_text"))

    def confirm(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = word_hashes()
        last: tuple[str, np.ndarray] | None = None
        for rows in batches:
            linked = []
            for a, b in zip(texts_of(rows, "a_text"), texts_of(rows, "b_text"), strict=True):
                if last is None or last[0] != b:
                    last = b, shingles(b, hashes)
                one, other = shingles(a, hashes), last[1]
                shared = len(np.intersect1d(one, other, assume_unique=True))
                linked.append(100 * shared >= percent * (len(one) + len(other) - shared))
            yield rows.select(["a", "b"]).filter(pa.array(linked, pa.bool_()))

    both = likely.join(end("a"), "a").join(end("b"), "b")
    return both.select("a", "b", "a_text", "b_text").mapInArrow(confirm, "a long, b long")


def _leftover(
    members: DataFrame, roots: DataFrame, docs: DataFrame, classes: DataFrame, similarity: float
) -> DataFrame:
    """Links ``(a, b)`` that join different components, from bands of four members and more.

    Smaller bands were compared in whole with their two ends. Members are dealt into blocks, and a
    task gets two blocks of one band.
    """
    percent = round(100 * similarity)
    rooted = members.join(roots.withColumnRenamed("parent", "root"), "node", "left")
    of = stage(rooted.withColumn("root", F.coalesce("root", "node")), "rooted")
    blocks = F.greatest(
        F.ceil(F.col("members") / BLOCK), F.ceil(F.col("shingles") / BLOCK_SHINGLES)
    )
    open_bands = stage(
        _crowded(of, F.min("root").alias("r"), F.max("root").alias("s"))
        .filter("members > 3 and r < s")
        .select("band", blocks.cast("int").alias("blocks")),
        "open",
    )
    inside = stage(of.join(open_bands, "band"), "inside")
    texts = stage(_member_texts(docs, inside.select("node").distinct(), classes), "texts")
    dealt = (
        inside.drop("n")
        .join(classes.select("node", "n", "sketch"), "node")
        .join(texts, "node")
        .withColumn("own", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
        .withColumn("other", F.explode(F.expr("sequence(0, blocks - 1)")))
        .withColumn("left", F.least("own", "other"))
        .withColumn("right", F.greatest("own", "other"))
        .select("band", "left", "right", "slot", "own", "node", "root", "n", "sketch", "text")
    )

    def compare(rows: pa.Table) -> pa.Table:
        own, node, root, n = (rows.column(c).to_numpy() for c in ("own", "node", "root", "n"))
        left, right, slot = (rows.column(c)[0].as_py() for c in ("left", "right", "slot"))
        table = _table(rows.column("sketch").combine_chunks())
        hashes, sets = word_hashes(), {}
        joined: dict[int, int] = {}

        def top(x: int) -> int:
            while (up := joined.get(x, x)) != x:
                x = up
            return x

        def full(i: int) -> np.ndarray:
            if i not in sets:
                sets[i] = shingles(rows.column("text")[i].as_py(), hashes)
            return sets[i]

        links = []
        a, b = np.flatnonzero(own == left), np.flatnonzero(own == right)
        for at in range(0, len(a), 64):
            part = a[at : at + 64, None]
            agree = table[part] == table[b][None]
            size, other = n[part], n[b][None]
            likely = estimate(agree.mean(axis=2), size, other)
            near = likely >= similarity - margin(similarity, size, other)
            near &= np.minimum(size, other) >= similarity * np.maximum(size, other) - 1e-6
            near &= root[part] != root[b][None]
            if left == right:
                near &= node[part] < node[b][None]
            i, j = np.nonzero(near)
            # A pair is looked at in the first band it shares, and nowhere else.
            whole = agree[i, j, : BANDS * PER_BAND].reshape(-1, BANDS, PER_BAND).all(axis=2)
            mine = whole.argmax(axis=1) == slot
            for x, y in zip(part[i[mine], 0].tolist(), b[j[mine]].tolist(), strict=True):
                one, two = top(root[x]), top(root[y])
                if one == two:
                    continue
                shared = len(np.intersect1d(full(x), full(y), assume_unique=True))
                if 100 * shared >= percent * (n[x] + n[y] - shared):
                    joined[max(one, two)] = min(one, two)
                    links.append((node[x], node[y]))
        pairs = np.array(links, np.int64).reshape(-1, 2)
        return pa.table({"a": pa.array(pairs[:, 0]), "b": pa.array(pairs[:, 1])})

    return dealt.groupBy("band", "left", "right").applyInArrow(compare, "a long, b long")


def near_duplicates(docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """One row per document of ``docs`` (``doc_id, text``): ``doc_id, n_shingles, component_id,
    kept``, and ``text_hash`` = ``xxhash64(doc_id, text)``.

    ``component_id`` is the smallest id reachable over links of at least ``similarity``; the row
    with that id is kept.
    """
    spark = docs.sparkSession
    with scratch_scope(spark):
        sketches = stage(
            _sketch(docs).withColumn("place", F.monotonically_increasing_id()), "sketches"
        )
        classes = stage(_classes(sketches), "classes")
        bands = _bands(classes)
        crowded = stage(
            _crowded(bands, F.min("node").alias("low"), F.max("node").alias("high")).filter("members > 1").drop("members", "shingles"),
            "crowded",
        )
        members = stage(bands.join(crowded, "band"), "members")
        first = stage(_pairs(members), "pairs")
        links = stage(_verified(first, docs, classes, similarity), "links")
        roots = components(links)
        rest = _leftover(members.drop("low", "high"), roots, docs, classes, similarity)
        rest = stage(rest, "more-links")
        if not rest.isEmpty():
            roots = components(links.unionByName(rest))
        of_class = stage(_named(classes, roots), "named")
        answer = sketches.join(of_class, "digest", "left").withColumn(
            "component_id", F.coalesce("component_id", "doc_id")
        )
        return keep(
            answer.select(
                "doc_id",
                "n_shingles",
                "component_id",
                F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"),
                "text_hash",
            ),
            "near-duplicates",
        )


def _named(classes: DataFrame, roots: DataFrame) -> DataFrame:
    """``(digest, component_id)``: the smallest id in the component of each class."""
    rooted = classes.join(roots, "node", "left").select(
        "digest", "least_id", F.coalesce("parent", "node").alias("root")
    )
    least = rooted.groupBy("root").agg(F.min("least_id").alias("component_id"))
    return rooted.join(least, "root").select("digest", "component_id")


def drop_near_duplicates(docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """The rows of ``docs``, all columns, one document of each component.

    The id is what tells documents apart: further rows with the kept id stay with it, and rows
    without an id stay unless a document with one is in their component.
    """
    found = near_duplicates(docs, similarity)
    gone = keep(
        found.filter(~F.col("kept")).select("doc_id", F.col("text_hash").alias("key")).distinct(),
        "gone",
    )
    # A Bloom filter of the rows to go lets nearly all others pass without a shuffle.
    blocks = bits.blocks_for(gone.count())
    seen = keep(bits.set_bits(gone, blocks), "gone-bits")
    rows = row_of(docs).withColumn("key", F.xxhash64("row.doc_id", "row.text"))
    marked = bits.mark(rows, seen, blocks, "maybe")
    same = (marked["key"] == gone["key"]) & F.col("row.doc_id").eqNullSafe(gone["doc_id"])
    staying = marked.filter("maybe").join(gone, same, "left_anti")
    return marked.filter(~F.col("maybe")).select("row.*").unionByName(staying.select("row.*"))
