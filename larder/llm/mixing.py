"""Mixing sources to target weights: raking, then sampling by calibrated probabilities.

The tokens of each (source, language, topic) cell are counted over all documents. Iterative
proportional fitting scales the cells until their marginals meet the targets for sources, languages
and topics. A document's probability is its cell's fitted over its actual tokens, scaled so that the
sample holds the share of tokens asked for; probabilities are at most 1, and what that cuts off is
made up by the other cells. Documents are drawn by a hash of their id, so a run can be repeated and
a larger share only adds documents.

Without targets every level has one of its own, and nulls are the level ``OTHER``; where targets are
given, levels without one share ``OTHER``. Few cells are raked on the driver, more in Spark, where the
driver sees no more than sums; both ways do the same steps.

Defined cases: tokens are words between white space, at least 1 a document, so empty and null texts
are sampled too; null sources and languages count as ``OTHER``; rows with one id are drawn together;
targets for absent levels are dropped and the rest scaled up; empty tables give empty results.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

import numpy as np
from pyspark.sql import Column, DataFrame, Row, functions as F

from larder.llm import topics
from larder.llm.common import row_of
from larder.workspace import keep, scratch_scope, stage

OTHER = "other"
KEYS = ("source", "lang", "topic")
# Cells up to which they are raked on the driver and broadcast.
CELLS_ON_DRIVER = 100_000
# Exponent of the default targets: 1 keeps the corpus as it is, 0 makes all levels equal.
FLATTEN = 0.5
SHARE = 0.6
ROUNDS = 200
TOLERANCE = 1e-9
SEED = 9

Targets = Mapping[str, Mapping[str, float]]
Topic = Callable[[Column], Column]


def tokens(text: Column) -> Column:
    """Words between ASCII white space, at least 1."""
    words = F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+"))
    return F.greatest(F.coalesce(words, F.lit(0)), F.lit(1)).cast("long")


def rake(actual: np.ndarray, levels: list[np.ndarray], wanted: list[np.ndarray]) -> np.ndarray:
    """Cells scaled to the wanted marginals.

    ``levels[k]`` numbers the level of key ``k`` in each cell, ``wanted[k]`` has the share of each
    level. Keeps the total; levels without tokens have no share.
    """
    if not len(actual):
        return actual
    fitted = actual.astype(float).copy()
    total = fitted.sum()
    shares = []
    for at, want in zip(levels, wanted, strict=True):
        present = np.bincount(at, actual, len(want)) > 0
        share = np.where(present, want, 0.0)
        shares.append(share / share.sum() if share.sum() else present / max(1, present.sum()))
    for _ in range(ROUNDS):
        off = 0.0
        for at, share in zip(levels, shares, strict=True):
            now = np.bincount(at, fitted, len(share))
            factor = np.divide(share * total, now, out=np.zeros_like(now), where=now > 0)
            off = max(off, float(np.abs(now - share * total).max(initial=0.0)))
            fitted *= factor[at]
        if off <= TOLERANCE * total:
            break
    return fitted


def calibrate(actual: np.ndarray, fitted: np.ndarray, share: float) -> np.ndarray:
    """Probabilities by cell, in proportion to fitted over actual, of at most 1, that keep
    ``share`` of the tokens (fewer only where cells without weight leave no more)."""
    ratio = np.divide(fitted, actual, out=np.zeros(len(actual)), where=actual > 0)
    budget = share * actual.sum()
    full = np.zeros(len(actual), bool)
    while True:
        weight = (ratio * actual)[~full].sum()
        scale = (budget - actual[full].sum()) / weight if weight > 0 else 0.0
        over = ~full & (scale * ratio >= 1)
        if not over.any():
            return np.where(full, 1.0, np.clip(scale * ratio, 0.0, 1.0))
        full |= over


def _level(key: str, targets: Targets | None) -> Column:
    value = F.coalesce(F.col(key).cast("string"), F.lit(OTHER))
    if not targets:
        return value
    return F.when(value.isin(list(targets[key])), value).otherwise(F.lit(OTHER))


def probabilities(
    cells: DataFrame, targets: Targets | None, share: float, flatten: float = FLATTEN
) -> DataFrame:
    """``source, lang, topic, weight, probability`` for every cell. Without ``targets`` they are the
    token shares of all levels to the power ``flatten``."""
    grouped = (
        cells.select(*[_level(key, targets).alias(key) for key in KEYS], "tokens")
        .groupBy(*KEYS)
        .agg(F.sum("tokens").alias("tokens"))
    )
    rows = grouped.limit(CELLS_ON_DRIVER + 1).collect()
    if len(rows) > CELLS_ON_DRIVER:
        return _raked_in_spark(grouped, targets, share, flatten)
    return F.broadcast(_raked_here(cells, sorted(rows), targets, share, flatten))


def _raked_here(
    cells: DataFrame, rows: list[Row], targets: Targets | None, share: float, flatten: float
) -> DataFrame:
    actual = np.array([row["tokens"] for row in rows], float)
    levels, wanted = [], []
    for key in KEYS:
        names = sorted({row[key] for row in rows})
        number = {name: i for i, name in enumerate(names)}
        levels.append(np.array([number[row[key]] for row in rows], int))
        if targets:
            wanted.append(np.array([targets[key].get(name, 0.0) for name in names]))
        else:
            wanted.append(np.bincount(levels[-1], actual, len(names)) ** flatten)
    fitted = rake(actual, levels, wanted)
    chance = calibrate(actual, fitted, share)
    found = [
        (*[row[key] for key in KEYS], float(f / a), float(p))
        for row, f, a, p in zip(rows, fitted, actual, chance, strict=True)
    ]
    schema = "source string, lang string, topic string, weight double, probability double"
    return cells.sparkSession.createDataFrame(found, schema)


def _shares(cells: DataFrame, key: str, targets: Targets | None, flatten: float) -> DataFrame:
    """The share wanted of each level of ``key`` that there is."""
    counts = cells.groupBy(key).agg(F.sum("tokens").alias("n"))
    if targets:
        given = [(level, float(want)) for level, want in targets[key].items()]
        table = cells.sparkSession.createDataFrame(given, f"{key} string, want double")
        levels = counts.join(table, key, "left").select(key, F.coalesce("want", F.lit(0.0)).alias("want"))
    else:
        levels = counts.select(key, F.pow("n", F.lit(flatten)).alias("want"))
    levels = stage(levels, "levels")
    wanted, number = levels.agg(F.sum("want"), F.count("*")).first()
    share = F.col("want") / wanted if wanted > 0 else F.lit(1.0) / number
    return levels.select(key, share.alias("share"))


def _scaled(cells: DataFrame, factors: Mapping[str, DataFrame], keys: list[str]) -> DataFrame:
    """``cells`` with ``weight``, the product of the factors of their levels of ``keys``."""
    weight = F.lit(1.0)
    for key in keys:
        cells = cells.join(factors[key], key)
        weight = weight * F.col(f"{key}_factor")
    return cells.select(*KEYS, "tokens", weight.alias("weight"))


def _raked_in_spark(
    cells: DataFrame, targets: Targets | None, share: float, flatten: float
) -> DataFrame:
    """``rake`` and ``calibrate`` on tables: a cell's weight is the product of a factor for each of its
    levels, and each step makes the factors of one key anew. The driver sees the convergence value
    and sums over all cells."""
    with scratch_scope(cells.sparkSession):
        cells = stage(cells, "levels")
        total = float(cells.agg(F.sum("tokens")).first()[0])
        wanted = {key: _shares(cells, key, targets, flatten) for key in KEYS}
        factors = {
            key: wanted[key].select(key, F.lit(1.0).alias(f"{key}_factor")) for key in KEYS
        }
        for _ in range(ROUNDS):
            off = 0.0
            for key in KEYS:
                others = _scaled(cells, factors, [k for k in KEYS if k != key])
                now = others.groupBy(key).agg(F.sum(F.col("tokens") * F.col("weight")).alias("now"))
                want = F.col("share") * total
                factor = F.when(F.col("now") > 0, want / F.col("now")).otherwise(0.0)
                missed = F.abs(F.col("now") * F.col(f"{key}_factor") - want)
                step = now.join(wanted[key], key).join(factors[key], key)
                step = step.select(key, factor.alias(f"{key}_factor"), missed.alias("missed"))
                step = stage(step, "factors")
                off = max(off, step.agg(F.max("missed")).first()[0])
                factors[key] = step.drop("missed")
            if off <= TOLERANCE * total:
                break
        fitted = stage(_scaled(cells, factors, list(KEYS)), "fitted")
        weight, least = F.col("weight"), float("inf")
        while True:
            # Cells of the weight ``least`` and more are kept in full.
            full = weight >= F.lit(least)
            sums = fitted.agg(
                F.sum(F.when(~full, weight * F.col("tokens"))),
                F.sum(F.when(full, F.col("tokens"))),
                F.max(F.when(~full, weight)),
            ).first()
            rest, whole, top = (float(value or 0) for value in sums)
            scale = (share * total - whole) / rest if rest > 0 else 0.0
            if scale * top < 1:
                break
            least = min(1 / scale, top)
        partly = F.greatest(F.lit(0.0), F.least(F.lit(1.0), weight * scale))
        chance = F.when(full, 1.0).otherwise(partly)
        return keep(fitted.select(*KEYS, "weight", chance.alias("probability")), "chances")


def draw(doc_id: Column, seed: int = SEED) -> Column:
    """A number in [0, 1) from the id."""
    bits = F.shiftrightunsigned(F.xxhash64(doc_id, F.lit(seed)), 11)
    return bits.cast("double") / F.lit(float(1 << 53))


def _measured(rows: DataFrame, topic: Column) -> DataFrame:
    """``row`` with its tokens and the values of the keys."""
    return rows.select(
        "row",
        tokens(F.col("row.text")).alias("tokens"),
        F.col("row.source").alias("source"),
        F.col("row.lang").alias("lang"),
        topic.cast("string").alias("topic"),
    )


def _given_topic(docs: DataFrame, topic: Topic | None) -> Column | None:
    """What tells a row's topic without fitting: ``topic``, or else the column of that name."""
    if topic:
        return topic(F.col("row.text"))
    named = any(name.lower() == "topic" for name in docs.columns)
    return F.col("row.topic") if named else None


def _vectors(rows: DataFrame) -> DataFrame:
    """The measures of ``rows`` that come from texts, written: their ids, tokens, keys and vectors."""
    read = rows.select("row", topics.measured(F.col("row.text").cast("binary")).alias("found"))
    return stage(
        read.select(
            F.struct("row.doc_id").alias("row"),
            F.greatest("found.tokens", F.lit(1).cast("long")).alias("tokens"),
            "row.source",
            "row.lang",
            "found.vector",
        ),
        "vectors",
    )


def _with_topics(vectors: DataFrame, centres: np.ndarray) -> DataFrame:
    topic = topics.topic_of_vector(F.col("vector"), centres).cast("string")
    return vectors.select("row", "tokens", "source", "lang", topic.alias("topic"))


def _decided(
    measured: DataFrame, cells: DataFrame, targets: Targets | None, share: float, seed: int
) -> DataFrame:
    """``measured`` with the levels of its keys, ``weight``, ``probability`` and ``kept``."""
    chances = probabilities(cells, targets, share)
    levels = measured.select("row", "tokens", *[_level(key, targets).alias(key) for key in KEYS])
    return levels.join(chances, list(KEYS)).withColumn(
        "kept", draw(F.col("row.doc_id"), seed) < F.col("probability")
    )


def _cells(measured: DataFrame) -> DataFrame:
    return measured.groupBy(*KEYS).agg(F.sum("tokens").alias("tokens"))


def mix(
    docs: DataFrame,
    targets: Targets | None = None,
    share: float = SHARE,
    topic: Topic | None = None,
    seed: int = SEED,
) -> DataFrame:
    """``doc_id, tokens, source, lang, topic, weight, probability, kept`` for every row of ``docs``
    (``doc_id, text, source, lang``).

    ``weight`` is the cell's fitted over its actual tokens. Without ``targets`` the shares of the
    corpus are flattened. Without ``topic``, an expression of a text, the column ``topic`` counts, and
    without that topics are fitted on all documents. Texts are read once for all counts; the rest
    works on the measures.
    """
    rows, given = row_of(docs), _given_topic(docs, topic)
    with scratch_scope(docs.sparkSession):
        if given is None:
            vectors = _vectors(rows)
            read = _with_topics(vectors, topics.fit(vectors))
        else:
            read = _measured(rows, given)
        measured = stage(
            read.select(F.struct("row.doc_id").alias("row"), "tokens", *KEYS), "measured"
        )
        cells = stage(_cells(measured), "cells")
        decided = _decided(measured, cells, targets, share, seed)
        result = ("tokens", *KEYS, "weight", "probability", "kept")
        return keep(decided.select("row.doc_id", *result), "mixed")


def sample(
    docs: DataFrame,
    targets: Targets | None = None,
    share: float = SHARE,
    topic: Topic | None = None,
    seed: int = SEED,
) -> DataFrame:
    """The rows of ``docs`` that are drawn, all columns. Texts are read twice; they are shuffled only
    where there are more than ``CELLS_ON_DRIVER`` cells."""
    rows, given = row_of(docs), _given_topic(docs, topic)
    if given is None:
        with scratch_scope(docs.sparkSession):
            vectors = _vectors(rows)
            centres = topics.fit(vectors)
            cells = keep(_cells(_with_topics(vectors, centres)), "cells")
        read = _measured(rows, topics.topic_of(F.col("row.text"), centres))
    else:
        read = _measured(rows, given)
        cells = keep(_cells(read), "cells")
    return _decided(read, cells, targets, share, seed).filter("kept").select("row.*")
