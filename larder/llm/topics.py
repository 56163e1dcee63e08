"""Topics for corpora that come without: spherical k-means over hashed word counts.

Centres are fitted on all documents: each round a task adds up the vectors nearest to each centre, and
only the sums, a number for each centre and slot, reach the driver. Vectors and centres are whole
numbers, so sums do not depend on the order of rows.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from larder.llm.common import Memo

TOPICS = 8
SLOTS = 1_024
ROUNDS = 20
# Length of vectors, whose values take 16 bits, and of centres; products of them stay exact in doubles.
UNIT = 1 << 15
CENTRE = 1 << 20
# Distance (1 - cosine) from a centre up to which a vector counts as equal to it.
LEAST_DISTANCE = 1e-5
# Distinct tokens whose slots a task remembers; past it the memory starts anew.
WORDS_KEPT = 200_000

WORD = re.compile(r"[^\W\d_]{2,}")


# Candidates for centres that a pass over the vectors draws.
DRAWN = 16


def _slot(word: str) -> int:
    return zlib.crc32(word.encode()) % SLOTS


def _slots_of(token: bytes) -> int | tuple[int, ...]:
    """The slot of the word in a token between white space; ``SLOTS`` for none, all slots for several."""
    found = [_slot(word) for word in WORD.findall(token.decode("utf-8", "replace").lower())]
    return found[0] if len(found) == 1 else tuple(found) if found else SLOTS


def _vector(tokens: list[bytes], slots: Memo) -> bytes | None:
    """Root word counts by hashed slot, of length ``UNIT``: pairs of slot and value; None without
    words."""
    at = slots.all(tokens)
    try:
        counts = np.bincount(np.array(at, np.int64), minlength=SLOTS + 1)[:SLOTS] if at else None
    except (TypeError, ValueError):
        # Some token has several words.
        single = [s for s in at if type(s) is int]
        several = [s for many in at if type(many) is tuple for s in many]
        counts = np.bincount(single + several, minlength=SLOTS + 1)[:SLOTS]
    words = 0 if counts is None else int(counts.sum())
    if not words:
        return None
    pairs = np.empty((np.count_nonzero(counts), 2), "<u2")
    pairs[:, 0] = found = np.flatnonzero(counts)
    pairs[:, 1] = np.rint(np.sqrt(counts[found] / words) * UNIT)
    return pairs.tobytes()


def _points(vectors: list[bytes]) -> np.ndarray:
    """A row per vector."""
    pairs = np.frombuffer(b"".join(vectors), "<u2").reshape(-1, 2)
    sizes = np.fromiter(map(len, vectors), np.int64, len(vectors)) // 4
    points = np.zeros(len(vectors) * SLOTS)
    points[np.repeat(np.arange(len(vectors)) * SLOTS, sizes) + pairs[:, 0]] = pairs[:, 1]
    return points.reshape(-1, SLOTS)


def _nearest(vectors: list[bytes | None], centres: np.ndarray) -> list[int | None]:
    found: list[int | None] = [None] * len(vectors)
    known = [i for i, v in enumerate(vectors) if v]
    if known and len(centres):
        products = _points([vectors[i] for i in known]) @ centres.T
        for i, k in zip(known, products.argmax(axis=1).tolist(), strict=True):
            found[i] = k
    return found


def _centres(sums: np.ndarray) -> np.ndarray:
    """Sums scaled to the length of centres, in whole numbers."""
    return np.rint(sums / np.linalg.norm(sums, axis=1, keepdims=True) * CENTRE)


def _distances(points: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Of each vector from the nearest centre; 1 if there is none."""
    if not len(centres):
        return np.ones(len(points))
    lengths = np.linalg.norm(points, axis=1) * CENTRE
    return 1 - (points @ centres.T).max(axis=1) / lengths


def _drawn(known: DataFrame, centres: np.ndarray) -> list[tuple[float, bytes]]:
    """Up to ``DRAWN`` different vectors with their distances from the centres so far, drawn one after
    the other with a chance in proportion to it; none if all vectors are centres."""

    def race(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: dict[bytes, tuple[float, float]] = {}
        for rows in batches:
            if not rows.num_rows:
                continue
            vectors = rows.column("vector").to_pylist()
            draws = (np.array(rows.column("draw")).astype(np.uint64) >> np.uint64(11)) + 0.5
            distance = _distances(_points(vectors), centres) if len(centres) else np.ones(len(vectors))
            late = np.full(len(vectors), np.inf)
            far = distance > LEAST_DISTANCE
            late[far] = -np.log(draws[far] / (1 << 53)) / distance[far]
            worst = max(best.values())[0] if len(best) == DRAWN else np.inf
            for i in np.flatnonzero(late < worst):
                best[vectors[i]] = float(late[i]), float(distance[i])
            if len(best) > DRAWN:
                first = sorted(best.items(), key=lambda e: (e[1][0], e[0]))[:DRAWN]
                best = dict(first)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([late for late, _ in best.values()], pa.float64()),
                pa.array([d for _, d in best.values()], pa.float64()),
                pa.array(list(best), pa.binary()),
            ],
            names=["late", "distance", "vector"],
        )

    drawn = known.withColumn("draw", F.xxhash64("vector", F.lit(len(centres))))
    # Equal vectors have equal draws: of those one takes part.
    found = drawn.mapInArrow(race, "late double, distance double, vector binary").distinct()
    rows = found.orderBy("late", "vector").limit(DRAWN).collect()
    return [(row["distance"], bytes(row["vector"])) for row in rows]


def _more_centres(known: DataFrame, centres: np.ndarray, topics: int) -> np.ndarray:
    """``centres`` with one or more of the vectors drawn in a pass.

    The first is taken. Each further one was drawn by its distance from the centres before; it is taken
    with the chance of what its distance is now to what it was then, so it is drawn by the former.
    """
    for was, vector in _drawn(known, centres):
        if len(centres) == topics:
            break
        point = _points([vector])
        now = float(_distances(point, centres)[0])
        chance = (zlib.crc32(vector, len(centres)) + 0.5) / (1 << 32)
        if now > LEAST_DISTANCE and chance * was < now:
            centres = np.vstack([centres, _centres(point)])
    return centres


def _sums(known: DataFrame, centres: np.ndarray) -> np.ndarray:
    """The sum of the vectors nearest to each centre."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((len(centres), SLOTS))
        for rows in batches:
            points = _points(rows.column("vector").to_pylist())
            nearest = (points @ centres.T).argmax(axis=1)
            total += (nearest == np.arange(len(centres))[:, None]).astype(float) @ points
        total = total.ravel()
        at = np.flatnonzero(total)
        arrays = [pa.array(at, pa.int32()), pa.array(total[at].astype(np.int64))]
        yield pa.RecordBatch.from_arrays(arrays, names=["at", "total"])

    parts = known.mapInArrow(add, "at int, total long").groupBy("at")
    total = np.zeros(len(centres) * SLOTS)
    for row in parts.agg(F.sum("total").alias("total")).collect():
        total[row["at"]] = row["total"]
    return total.reshape(-1, SLOTS)


def fit(vectors: DataFrame, topics: int = TOPICS) -> np.ndarray:
    """Centres, a row per topic, from all rows of a written table with the column ``vector``."""
    known = vectors.select("vector").filter("vector is not null")
    centres = np.zeros((0, SLOTS))
    while len(centres) < topics and len(more := _more_centres(known, centres, topics)) > len(centres):
        centres = more
    for _ in range(ROUNDS if len(centres) else 0):
        sums, before = _sums(known, centres), centres
        kept = sums.any(axis=1)
        centres = centres.copy()
        centres[kept] = _centres(sums[kept])
        if (centres == before).all():
            break
    return centres


def measured(texts: Column) -> Column:
    """``tokens`` between ASCII white space and the ``vector`` of a text, given as binary, in one read.

    The vector is null for texts without words.
    """
    @F.pandas_udf("tokens long, vector binary")
    def measure(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        slots = Memo(_slots_of, WORDS_KEPT)
        for values in batches:
            tokens = [value.split() if value else [] for value in values]
            yield pd.DataFrame(
                {
                    "tokens": [len(t) for t in tokens],
                    "vector": pd.Series([_vector(t, slots) for t in tokens], dtype=object),
                }
            )

    # Said not to be deterministic, so that the optimiser never runs it twice for a row.
    return measure.asNondeterministic()(texts)


def topic_of_vector(vector: Column, centres: np.ndarray) -> Column:
    """The number of the nearest centre; null for null, or without centres."""
    @F.pandas_udf("int")
    def nearest(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for vectors in batches:
            yield pd.Series(_nearest(list(vectors), centres), dtype="Int32")

    return nearest.asNondeterministic()(vector)


def topic_of(text: Column, centres: np.ndarray) -> Column:
    """The number of the nearest centre; null for texts without words, or without centres."""
    @F.pandas_udf("int")
    def nearest(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        slots = Memo(_slots_of, WORDS_KEPT)
        for texts in batches:
            found = _nearest([_vector(value.split() if value else [], slots) for value in texts], centres)
            yield pd.Series(found, dtype="Int32")

    return nearest.asNondeterministic()(text.cast("binary"))
