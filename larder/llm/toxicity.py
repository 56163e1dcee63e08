"""Toxicity by non-negative positive-unlabelled learning.

Confirmed toxic documents are the positives; documents drawn from the whole corpus, labels unseen, are
the unlabelled. With the class prior p, the risk of taking toxic text for clean is p times the mean
loss of positives, and the risk of the reverse is the mean loss of unlabelled text as clean less p
times that of positives as clean. That difference estimates a number that cannot be negative; where
the sample makes it so, the step is taken back instead of following it, which keeps a flexible model
from fitting noise.

Features are the words of a text and their beginnings of four to six letters, present or not, so that
inflected forms share weight. Spark counts in how many documents each occurs; the ``FEATURES`` whose
frequency differs most between the two samples are kept, and with them as many words that begin like one. A linear classifier over them is fitted with
numpy. Samples are bounded: at most ``POSITIVES`` and ``UNLABELLED`` documents, those with the
lowest hash of their id, each text once. The prior is the share of toxic among learnable labels.

Defined cases: null and empty texts have no features and score the bias; without positives every
score is the prior; several labels of an id count as toxic if any is; null labels are ignored;
repeated rows get equal rows; empty tables give empty results; further columns are not read.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from larder.llm.common import Memo, texts_of
from larder.workspace import scratch_scope, stage

POSITIVES = 6_000
UNLABELLED = 12_000
FEATURES = 4_000
# Least log-likelihood ratio of a feature: about one in 2,000 by chance; the fit outweighs such few.
LEAST_RATIO = 12.0
BEGINNINGS = (4, 5, 6)
DEFAULT_PRIOR = 0.1
ROUNDS = 1_000
RATE = 0.05
DECAY = 1e-4
THRESHOLD = 0.7
# Distinct words whose features a task remembers; past it the memory starts anew.
WORDS_KEPT = 300_000

WORD = re.compile(r"[^\W\d_]+")


def features_of_word(word: str) -> list[str]:
    return [word, *(word[:n] + "-" for n in BEGINNINGS if len(word) > n)]


def words_of(text: str) -> list[str]:
    """Distinct runs of letters in lower case."""
    return list(set(WORD.findall(text.lower())))


@dataclass
class Model:
    places: dict[str, int]
    weights: np.ndarray
    bias: float

    def memo(self) -> Memo:
        def known(word: str) -> tuple[int, ...]:
            found = (self.places.get(f) for f in features_of_word(word))
            return tuple(f for f in found if f is not None)

        return Memo(known, WORDS_KEPT)

    def score(self, text: str, memo: Memo) -> float:
        hits = list(set(chain.from_iterable(memo.all(words_of(text)))))
        return 1 / (1 + math.exp(-max(-60.0, min(60.0, self.bias + self.weights[hits].sum()))))


def _draw(docs: DataFrame, learns: Column, labels: DataFrame) -> DataFrame:
    """``positive, text`` of the two samples. Ids are drawn first, so no text is shuffled for it; of an
    id with several texts the first in order is taken."""
    ids = docs.filter(learns).select("doc_id").filter("doc_id is not null").distinct()
    drawn = ids.withColumn("draw", F.xxhash64("doc_id"))
    toxic = labels.filter("toxic = 1")
    positive = drawn.join(toxic, "doc_id", "left_semi").orderBy("draw", "doc_id").limit(POSITIVES)
    unlabelled = drawn.orderBy("draw", "doc_id").limit(UNLABELLED)
    chosen = stage(
        positive.select("doc_id", F.lit(True).alias("positive")).union(
            unlabelled.select("doc_id", F.lit(False).alias("positive"))
        ),
        "chosen",
    )
    rows = docs.select("doc_id", "text").filter("text is not null")
    drawn_rows = rows.join(F.broadcast(chosen), "doc_id").groupBy("positive", "doc_id")
    return drawn_rows.agg(F.min("text").alias("text")).select("positive", "text").distinct()


def _frequencies(sample: DataFrame) -> DataFrame:
    """``feature, p, u``: documents of each sample that have it."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of_word = Memo(features_of_word, WORDS_KEPT)
        for rows in batches:
            counts: tuple[Counter[str], Counter[str]] = Counter(), Counter()
            for text, positive in zip(texts_of(rows), rows.column("positive"), strict=True):
                found = set(chain.from_iterable(of_word.all(words_of(text))))
                counts[positive.as_py()].update(found)
            names = list(counts[0].keys() | counts[1].keys())
            yield pa.RecordBatch.from_pydict(
                {
                    "feature": pa.array(names, pa.string()),
                    "p": pa.array([counts[1][f] for f in names], pa.int64()),
                    "u": pa.array([counts[0][f] for f in names], pa.int64()),
                }
            )

    found = sample.mapInArrow(count, "feature string, p long, u long")
    return found.groupBy("feature").agg(F.sum("p").alias("p"), F.sum("u").alias("u"))


def _ratio(p: Column, u: Column, positives: int, unlabelled: int) -> Column:
    """Log-likelihood ratio of a feature's frequencies in the two samples."""

    def part(seen: Column, expected: Column) -> Column:
        return F.when(seen > 0, 2 * seen * F.log(seen / expected)).otherwise(0.0)

    rate = (p + u) / F.lit(float(positives + unlabelled))
    total = F.lit(0.0)
    for seen, size in ((p, positives), (u, unlabelled)):
        total = total + part(seen, rate * size) + part(size - seen, (1 - rate) * size + 1e-9)
    return total


def _selected(frequencies: DataFrame) -> list[str]:
    """Features that tell the samples apart, and the words that such a beginning stands for: a clean
    word with the beginning of a toxic one needs a weight of its own."""
    telling = stage(
        frequencies.filter(F.col("ratio") >= LEAST_RATIO)
        .orderBy(F.desc("ratio"), "feature")
        .limit(FEATURES)
        .select("feature"),
        "telling",
    )
    beginnings = F.array(*[F.concat(F.substring("feature", 1, n), F.lit("-")) for n in BEGINNINGS])
    words = frequencies.filter(~F.col("feature").endswith("-") & (F.col("p") + F.col("u") >= 3))
    known = telling.withColumnRenamed("feature", "beginning")
    related = (
        words.withColumn("beginning", F.explode(beginnings))
        .join(F.broadcast(known), "beginning", "left_semi")
        .select("feature", (F.col("p") + F.col("u")).alias("n"))
        .distinct()
        .orderBy(F.desc("n"), "feature")
        .limit(FEATURES)
        .select("feature")
    )
    return sorted({row["feature"] for row in telling.union(related).collect()})


def nonnegative_risk_fit(
    rows: np.ndarray, places: np.ndarray, positive: np.ndarray, width: int, prior: float
) -> tuple[np.ndarray, float]:
    """Weights and bias of a linear classifier on present features.

    Document ``rows[i]`` has feature ``places[i]``. Logistic loss, Adam steps on all documents.
    """
    n_p, n_u = positive.sum(), (~positive).sum()
    parameters = np.zeros(width + 1)
    parameters[width] = math.log(prior / (1 - prior))
    first, second = np.zeros(width + 1), np.zeros(width + 1)
    count = len(positive)
    for step in range(1, ROUNDS + 1):
        score = np.bincount(rows, parameters[places], count) + parameters[width]
        chance = 1 / (1 + np.exp(-np.clip(score, -60, 60)))
        as_clean = np.logaddexp(0, score)
        reverse = as_clean[~positive].mean() - prior * as_clean[positive].mean()
        # Slopes of the losses: as toxic chance - 1, as clean chance.
        toxic_part = np.where(positive, prior * (chance - 1) / n_p, 0.0)
        clean_part = np.where(positive, -prior * chance / n_p, chance / n_u)
        slope = toxic_part + clean_part if reverse >= 0 else -clean_part
        gradient = np.append(np.bincount(places, slope[rows], width), slope.sum())
        gradient[:width] += DECAY * parameters[:width]
        first = 0.9 * first + 0.1 * gradient
        second = 0.999 * second + 0.001 * gradient**2
        change = first / (1 - 0.9**step) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
        parameters -= RATE * change
    return parameters[:width], float(parameters[width])


def train(docs: DataFrame, labels: DataFrame, learns: Column) -> Model:
    """Learn from rows of ``docs`` (``doc_id, text``) and ``labels`` (``doc_id, toxic``) where
    ``learns`` holds, an expression of ``doc_id``."""
    known = labels.filter(learns & F.col("toxic").isNotNull() & F.col("doc_id").isNotNull())
    known = known.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    with scratch_scope(docs.sparkSession):
        known = stage(known, "labels")
        share = known.agg(F.avg(F.col("toxic").cast("double"))).collect()[0][0]
        prior = DEFAULT_PRIOR if share is None or share >= 1 else min(0.9, max(0.005, share))
        sample = stage(
            _draw(docs, learns, known).withColumn("row", F.monotonically_increasing_id()), "sample"
        )
        sizes = {r["positive"]: r["count"] for r in sample.groupBy("positive").count().collect()}
        if not sizes.get(True) or not sizes.get(False):
            return Model({}, np.zeros(0), math.log(prior / (1 - prior)))
        ratio = _ratio(F.col("p"), F.col("u"), sizes[True], sizes[False])
        names = _selected(stage(_frequencies(sample).withColumn("ratio", ratio), "frequencies"))
        places = {name: i for i, name in enumerate(names)}
        model = Model(places, np.zeros(len(places)), 0.0)

        def present(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            memo = model.memo()
            for rows in batches:
                hits = [
                    sorted(set(chain.from_iterable(memo.all(words_of(text)))))
                    for text in texts_of(rows)
                ]
                yield pa.RecordBatch.from_arrays(
                    [rows.column("row"), rows.column("positive"), pa.array(hits, pa.list_(pa.int32()))],
                    names=["row", "positive", "hits"],
                )

        seen = sample.select("row", "positive", "text").mapInArrow(
            present, "row long, positive boolean, hits array<int>"
        )
        learned = sorted(seen.collect(), key=lambda r: r["row"])
    hits = [np.array(r["hits"], int) for r in learned]
    model.weights, model.bias = nonnegative_risk_fit(
        np.repeat(np.arange(len(hits)), [len(h) for h in hits]),
        np.concatenate(hits),
        np.array([r["positive"] for r in learned], bool),
        len(places),
        prior,
    )
    return model


def score(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id, score, predicted`` for every row of ``docs`` (``doc_id, text``)."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def rate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo = shared.value.memo()
        for rows in batches:
            scores = np.array([shared.value.score(text, memo) for text in texts_of(rows)], float)
            yield pa.RecordBatch.from_arrays(
                [
                    rows.column("doc_id"),
                    pa.array(scores),
                    pa.array((scores >= THRESHOLD).astype(np.int32)),
                ],
                names=["doc_id", "score", "predicted"],
            )

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        rate, "doc_id long, score double, predicted int"
    )
