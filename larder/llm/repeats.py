"""Repeated passages by a depth-limited radix sort of suffixes, most significant digits first.

Only the first ``size`` bytes of a suffix count, so equal groups are exactly the repeated windows. The
order is that of these digits, each a pass that deals suffixes into groups; groups of one drop out, and
no pass reads further:

1. The anchor: of the ``size - k + 1`` short strings of ``k`` bytes in a window the one with the least
   hash, the leftmost of equal ones. Equal windows have equal anchors at equal places. Neighbouring
   suffixes share their anchor, so a stretch of them is one row until a later pass splits it. Stretches
   equal as a whole are repeated as a whole.
2. Of stretches that share an anchor but are not equal one of each kind goes on, in blocks of ``BLOCK``
   suffixes: the next digit is what all windows of a block have in common and where the anchor lies.
   Blocks equal as a whole are repeated as a whole.
3. The blocks that are left are split into suffixes, and the last digit is the rest of the window.

Groups are only counted, never gathered, so a passage in a third of all documents is a row per task.
Hashes of at least 128 bits in all decide equality; anchors pick candidates alone. Texts are read whole,
long ones in pieces that overlap by a window. Equal texts are worked on once.

Defined cases: null counts as empty; texts shorter than a window keep all; repeated rows and equal
texts lose all they share; an empty table gives an empty result; further columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from larder.llm import bits
from larder.llm.common import row_of
from larder.workspace import keep, scratch_scope, stage

SIZE = 400
# Suffixes in a block of the second pass.
BLOCK = 32
# Bytes hashed at once; a window must be much shorter.
PIECE = 1 << 18
_PLACE_BITS = 20

_U = np.uint64
_BASE = 0x9E3779B97F4A7C15
_MASK = _U((1 << _PLACE_BITS) - 1)


@cache
def _powers() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A number for each byte, and powers of an odd base and of its inverse modulo 2^64."""
    numbers = np.random.default_rng(13).integers(0, 1 << 63, 256, dtype=_U) * _U(2) + _U(1)

    def powers(base: int) -> np.ndarray:
        out = np.ones(1 << _PLACE_BITS, _U)
        out[1:] = _U(base)
        return np.multiply.accumulate(out)

    return numbers, powers(_BASE), powers(pow(_BASE, -1, 1 << 64))


def _sums(data: np.ndarray) -> np.ndarray:
    """Running sums from which the hash of any stretch of ``data`` follows."""
    numbers, up, _ = _powers()
    out = np.zeros(len(data) + 1, _U)
    np.cumsum(numbers[data] * up[: len(data)], out=out[1:])
    return out


def _hashes(sums: np.ndarray, size: int) -> np.ndarray:
    """The hash of each stretch of ``size`` bytes; it depends on the bytes alone."""
    found = (sums[size:] - sums[:-size]) * _powers()[2][: len(sums) - size]
    found ^= found >> _U(29)
    found *= _U(0xBF58476D1CE4E5B9)
    found ^= found >> _U(32)
    return found


def _short(size: int) -> int:
    return max(1, size // 4)


def stretches(
    data: np.ndarray, parts: list[tuple[int, int]], size: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """First and last start, anchor and anchor's hash of every stretch of windows within ``parts``."""
    k = _short(size)
    reach = size - k + 1
    none = np.empty(0, np.int64)
    starts = [np.arange(a, b - size + 1) for a, b in parts if b - a >= size]
    if not starts:
        return none, none, none, none.astype(_U)
    start = np.concatenate(starts)
    short = _hashes(_sums(data), k)
    ranked = short * _U(0x94D049BB133111EB)
    ranked = (ranked & ~_MASK) | np.arange(len(ranked), dtype=_U)
    # The least of each window is the lesser of a suffix and a prefix minimum of two blocks.
    rows = -(-len(ranked) // reach)
    padded = np.full(rows * reach, ~_U(0))
    padded[: len(ranked)] = ranked
    grid = padded.reshape(rows, reach)
    ahead = np.minimum.accumulate(grid, axis=1).ravel()
    behind = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    anchor = (np.minimum(behind[start], ahead[start + reach - 1]) & _MASK).astype(np.int64)
    # Within a part anchors only move on, and parts share none.
    first = np.flatnonzero(np.diff(anchor, prepend=-1))
    last = np.append(first[1:] - 1, len(start) - 1)
    return start[first], start[last], anchor[first], short[anchor[first]]


def _pieces(offsets: np.ndarray, size: int) -> Iterator[list[tuple[int, int, int]]]:
    """Texts laid end to end, as lists of ``(text, from, to)`` of about ``PIECE`` bytes each."""
    open_: list[tuple[int, int, int]] = []
    held = 0
    for i, (a, b) in enumerate(zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)):
        while b - a >= size:
            end = min(b, a + PIECE)
            if open_ and end - open_[0][1] > 2 * PIECE:
                yield open_
                open_, held = [], 0
            open_.append((i, a, end))
            held += end - a
            if held >= PIECE:
                yield open_
                open_, held = [], 0
            if end == b:
                break
            a = end - size + 1
    if open_:
        yield open_


def _bytes_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a binary column, end to end, and where each value begins."""
    column = column.cast(pa.large_binary())
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset :][: len(column) + 1]
    data = column.buffers()[2]
    return np.frombuffer(data, np.uint8) if data else np.empty(0, np.uint8), offsets


def _scan(texts: DataFrame, size: int) -> DataFrame:
    """``text_key, low, high, anchor, short, whole``: the first digit of every stretch."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            data, offsets = _bytes_of(rows.column("data"))
            keys = rows.column("text_key")
            for parts in _pieces(offsets, size):
                base, end = parts[0][1], parts[-1][2]
                view = data[base:end]
                # Texts too short for a window lie between parts and are not in any.
                low, high, anchor, short = stretches(
                    view, [(a - base, b - base) for _, a, b in parts], size
                )
                text = np.array([i for i, _, _ in parts])
                begins = np.array([a - base for _, a, _ in parts])
                of = text[np.searchsorted(begins, low, side="right") - 1]
                shift = offsets[of] - base
                raw = memoryview(view)
                whole = [
                    xxhash.xxh3_128_digest(raw[a:b])
                    for a, b in zip(low.tolist(), (high + size).tolist(), strict=True)
                ]
                yield pa.RecordBatch.from_arrays(
                    [
                        keys.take(pa.array(of)),
                        pa.array(low - shift),
                        pa.array(high - shift),
                        pa.array(anchor - shift),
                        pa.array(short.view(np.int64)),
                        pa.array(whole, pa.binary()),
                    ],
                    names=["text_key", "low", "high", "anchor", "short", "whole"],
                )

    return texts.mapInArrow(
        scan, "text_key binary, low long, high long, anchor long, short long, whole binary"
    )


def _blocks(texts: DataFrame, size: int) -> DataFrame:
    """Blocks of the stretches in column ``kinds``: the second digit, and hashes for the third.

    ``core``: what the block's windows have in common and where their anchor lies; ``whole``: all its
    bytes; ``near, far``: how far its windows begin before the anchor; ``tails``: their hashes.
    """
    schema = (
        "text_key binary, anchor long, near int, far int, undecided boolean, "
        "core long, whole binary, tails binary"
    )

    def rows_of(data: np.ndarray, kinds: list[dict]) -> Iterator[tuple]:
        for kind in kinds:
            anchor = kind["anchor"]
            nearest, farthest = anchor - kind["high"], anchor - kind["low"]
            at = anchor - farthest
            view = data[at : anchor - nearest + size]
            raw = memoryview(view)
            tails = _hashes(_sums(view), size)
            for b in range(nearest // BLOCK, farthest // BLOCK + 1):
                near, far = max(nearest, b * BLOCK), min(farthest, b * BLOCK + BLOCK - 1)
                first, last = farthest - b * BLOCK - BLOCK + 1 + size, farthest - b * BLOCK
                core = xxhash.xxh3_64_intdigest(raw[max(last, 0) : max(first, 0)], seed=b)
                a, z = farthest - far, farthest - near
                seed = near * 65_537 + far
                whole = xxhash.xxh3_128_digest(raw[a : z + size], seed=seed)
                yield anchor, near, far, kind["undecided"], _signed(core), whole, tails[a : z + 1][::-1].tobytes()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            for key, data, kinds in zip(
                *(rows.column(c) for c in ("text_key", "data", "kinds")), strict=True
            ):
                found = list(rows_of(np.frombuffer(data.as_buffer(), np.uint8), kinds.as_py()))
                columns = list(zip(*found, strict=True))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([key.as_py()] * len(found), pa.binary()),
                        pa.array(columns[0], pa.int64()),
                        pa.array(columns[1], pa.int32()),
                        pa.array(columns[2], pa.int32()),
                        pa.array(columns[3], pa.bool_()),
                        pa.array(columns[4], pa.int64()),
                        pa.array(columns[5], pa.binary()),
                        pa.array(columns[6], pa.binary()),
                    ],
                    names=["text_key", "anchor", "near", "far", "undecided", "core", "whole", "tails"],
                )

    return texts.select("text_key", "data", "kinds").mapInArrow(cut, schema)


def _signed(number: int) -> int:
    return number - (1 << 64) if number >> 63 else number


def _suffixes(blocks: DataFrame) -> DataFrame:
    """One row per suffix of a block, with its last digit."""

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            near = rows.column("near").to_numpy()
            count = rows.column("far").to_numpy() - near + 1
            row = np.repeat(np.arange(len(count)), count)
            within = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
            before = near[row] + within
            tails = b"".join(t.as_py() for t in rows.column("tails"))
            pick = pa.array(row)
            yield pa.RecordBatch.from_arrays(
                [
                    rows.column("core").take(pick),
                    pa.array(before.astype(np.int32)),
                    pa.array(np.frombuffer(tails, np.int64)),
                    rows.column("text_key").take(pick),
                    pa.array(rows.column("anchor").to_numpy()[row] - before),
                    rows.column("undecided").take(pick),
                ],
                names=["core", "before", "tail", "text_key", "start", "undecided"],
            )

    return blocks.select("core", "near", "far", "tails", "text_key", "anchor", "undecided").mapInArrow(
        split, "core long, before int, tail long, text_key binary, start long, undecided boolean"
    )


def _keyed(docs: DataFrame) -> DataFrame:
    data = F.coalesce(F.col("text").cast("binary"), F.lit(b""))
    return docs.select("doc_id", data.alias("data")).withColumn(
        "sha", F.unhex(F.sha2("data", 256))
    ).withColumn("text_key", _key(F.col("sha")))


def _key(sha: Column) -> Column:
    return F.substring(sha, 1, 16)


def _starts(keyed: DataFrame, size: int) -> tuple[DataFrame, DataFrame]:
    """Starts of repeated windows, as ``text_key, low, high``; and each text that has any."""
    spans = stage(_scan(keyed.select("text_key", "data"), size), "spans")
    shared = stage(
        spans.groupBy("short").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select(F.col("short").alias("key")),
        "shared",
    )
    # A Bloom filter of the shared anchors drops nearly all other stretches before they are shuffled.
    blocks = bits.blocks_for(shared.count())
    seen = stage(bits.set_bits(shared, blocks), "shared-bits")
    suspects = stage(
        bits.mark(spans.withColumn("key", F.col("short")), seen, blocks, "maybe").filter("maybe").drop("key", "maybe"),
        "suspects",
    )
    kinds = stage(
        suspects.groupBy("short", "whole").agg(
            F.count(F.lit(1)).alias("n"),
            F.min(F.struct("text_key", "low", "high", "anchor")).alias("of"),
        ),
        "kinds",
    )
    several = kinds.groupBy("short").agg(F.count(F.lit(1)).alias("kinds")).filter("kinds > 1").select("short")
    mixed = stage(
        kinds.join(several, "short").select("of.*", (F.col("n") == 1).alias("undecided")), "mixed"
    )
    equal = suspects.join(kinds.filter("n > 1").select("short", "whole"), ["short", "whole"])
    settled = stage(equal.select("text_key", "low", "high").distinct(), "settled")
    texts = stage(_texts(keyed, settled.select("text_key").union(mixed.select("text_key"))), "texts")

    listed = mixed.groupBy("text_key").agg(
        F.collect_list(F.struct("low", "high", "anchor", "undecided")).alias("kinds")
    )
    cut = stage(_blocks(texts.join(listed, "text_key"), size), "blocks")
    cores = cut.groupBy("core").agg(
        F.count(F.lit(1)).alias("n"), F.max("undecided").alias("any")
    )
    alive = cut.join(cores.filter("n > 1 and any").select("core"), "core")
    same = alive.groupBy("whole").agg((F.count(F.lit(1)) > 1).alias("equal"))
    alive = stage(alive.join(same, "whole").withColumn("open", F.expr("undecided and not equal")), "alive")
    more = alive.filter("undecided and equal").select(
        "text_key", (F.col("anchor") - F.col("far")).alias("low"), (F.col("anchor") - F.col("near")).alias("high")
    )
    split = alive.groupBy("core").agg(F.max("open").alias("any")).filter("any").select("core")
    # Blocks equal as a whole have equal suffixes: one of them stands for all.
    last = alive.join(split, "core").dropDuplicates(["whole"])
    suffixes = stage(_suffixes(last.withColumn("undecided", F.col("open"))), "suffixes")
    groups = suffixes.groupBy("core", "before", "tail").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    single = suffixes.filter("undecided").join(groups, ["core", "before", "tail"])
    found = settled.union(more).union(single.select("text_key", "start", "start"))
    return found, texts


def _texts(keyed: DataFrame, wanted: DataFrame) -> DataFrame:
    """``text_key, data`` once for each text wanted; others stay out of the shuffle."""
    keys = stage(wanted.distinct().withColumn("key", F.xxhash64("text_key")), "wanted")
    blocks = bits.blocks_for(keys.count())
    seen = stage(bits.set_bits(keys, blocks), "wanted-bits")
    rows = keyed.select("text_key", "data", F.xxhash64("text_key").alias("key"))
    maybe = bits.mark(rows, seen, blocks, "maybe").filter("maybe")
    return (
        maybe.groupBy("text_key").agg(F.first("data").alias("data"))
        .join(keys.select("text_key"), "text_key", "left_semi")
    )


def covered(starts: list[tuple[int, int]], size: int) -> list[tuple[int, int]]:
    """Maximal runs of bytes under windows that start in any of the closed ranges."""
    runs: list[list[int]] = []
    for low, high in sorted(starts):
        if runs and low <= runs[-1][1]:
            runs[-1][1] = max(runs[-1][1], high + size)
        else:
            runs.append([low, high + size])
    return [(a, b) for a, b in runs]


def _cut_texts(starts: DataFrame, texts: DataFrame, size: int) -> DataFrame:
    """``text_key, removed, kept``: the runs to go, and the bytes that stay."""
    listed = starts.groupBy("text_key").agg(F.collect_list(F.struct("low", "high")).alias("starts"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            removed, kept = [], []
            for data, starts in zip(rows.column("data"), rows.column("starts"), strict=True):
                runs = covered([(s["low"], s["high"]) for s in starts.as_py()], size)
                text, out, at = memoryview(data.as_buffer()), bytearray(), 0
                for a, b in runs:
                    out += text[at:a]
                    at = b
                kept.append(bytes(out + text[at:]))
                removed.append([{"start": a, "end": b} for a, b in runs])
            run = pa.struct([("start", pa.int64()), ("end", pa.int64())])
            yield pa.RecordBatch.from_arrays(
                [rows.column("text_key"), pa.array(removed, pa.list_(run)), pa.array(kept, pa.binary())],
                names=["text_key", "removed", "kept"],
            )

    return texts.join(listed, "text_key").select("text_key", "data", "starts").mapInArrow(
        cut, "text_key binary, removed array<struct<start: long, end: long>>, kept binary"
    )


def repeated(docs: DataFrame, size: int = SIZE) -> DataFrame:
    """``text_key, removed, kept`` of each distinct text of ``docs`` (``doc_id, text``) with a window
    of ``size`` bytes that also starts elsewhere. ``removed`` are the maximal runs of covered bytes,
    ends excluded; ``kept`` the other bytes; ``text_key`` the first half of the text's SHA-256."""
    with scratch_scope(docs.sparkSession):
        return keep(_cut_texts(*_starts(_keyed(docs), size), size), "repeats")


def without_repeats(docs: DataFrame, size: int = SIZE) -> DataFrame:
    """Every row of ``docs`` as ``row``, with ``kept``: its text's bytes that are not repeated."""
    rows = row_of(docs)
    data = F.coalesce(F.col("row.text").cast("binary"), F.lit(b""))
    rows = rows.withColumn("text_key", _key(F.unhex(F.sha2(data, 256))))
    found = repeated(docs, size).select("text_key", "kept")
    return rows.join(found, "text_key", "left").select("row", F.coalesce("kept", data).alias("kept"))


def digest(docs: DataFrame, size: int = SIZE) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept_sha256`` of every document."""
    with scratch_scope(docs.sparkSession):
        keyed = _keyed(docs)
        found = _cut_texts(*_starts(keyed, size), size).select(
            "text_key",
            F.expr("aggregate(removed, 0L, (n, r) -> n + r.end - r.start)").alias("n_removed"),
            F.size("removed").cast("long").alias("n_spans"),
            F.sha2("kept", 256).alias("kept_sha256"),
        )
        found = stage(found, "cut")
        rows = stage(keyed.select("doc_id", "sha", "text_key", F.octet_length("data").cast("long").alias("n_bytes")), "rows")
        answer = rows.join(found, "text_key", "left").select(
            "doc_id",
            "n_bytes",
            F.coalesce("n_removed", F.lit(0).cast("long")).alias("n_removed"),
            F.coalesce("n_spans", F.lit(0).cast("long")).alias("n_spans"),
            F.coalesce("kept_sha256", F.lower(F.hex("sha"))).alias("kept_sha256"),
        )
        return keep(answer, "repeats")
