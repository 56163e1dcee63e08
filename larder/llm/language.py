"""Language identification by words first and character n-grams for words never seen.

Training counts words per language over a bounded sample of labelled documents (at most
``DOCS_PER_LANGUAGE`` each, those with the lowest hash of their id). A known word scores by its
log frequency in each language. A word that no language has seen scores by its character n-grams
of up to five letters; where none of these is known at a place, by the next shorter one, each step
at a fixed penalty. The language with the largest sum wins; the score is its share of the summed
likelihoods, per word, so that long texts do not all score 1.

Defined cases: ``und`` with score 0 for null texts, texts without a letter, and an empty model; ties
go to the first language in order; labels that are null or blank teach nothing; repeated rows get
equal rows; further columns are not read.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from larder.llm.common import Memo, row_of, texts_of
from larder.workspace import scratch_scope, stage

UNKNOWN = "und"
# Bounds of the model for each language: what is learned from, and what is kept of it. Whatever one
# language keeps is counted in all.
DOCS_PER_LANGUAGE = 2_000
WORDS_PER_LANGUAGE = 20_000
GRAMS_PER_LANGUAGE = 50_000
# Lengths of n-grams, longest first.
SIZES = (5, 4, 3, 2, 1)
BACKOFF = math.log(0.4)
# A document whose language is less certain is left out by keep_known.
LEAST_SCORE = 0.4
# Distinct unseen words whose scores a task remembers; past it the memory starts anew.
WORDS_KEPT = 150_000

WORD = re.compile(r"[^\W\d_]+")


# Language, word or n-gram, how often.
Count = tuple[str, str, int]


def words_of(text: str) -> list[str]:
    """Runs of letters in lower case."""
    return WORD.findall(text.lower())


def grams(word: str, n: int) -> list[str]:
    """Character n-grams of a word with its ends marked."""
    marked = f"<{word}>"
    return [marked[i : i + n] for i in range(len(marked) - n + 1)]


def gram_counts(words: Iterable[Count]) -> Counter[tuple[str, str]]:
    """How often each n-gram occurs in words of each language."""
    counts: Counter[tuple[str, str]] = Counter()
    for language, word, n in words:
        for size in SIZES:
            for gram in grams(word, size):
                counts[language, gram] += n
    return counts


class Model:
    """Log frequencies of words and n-grams: for each a row of a matrix, a column per language."""

    def __init__(self, words: Iterable[Count], counted_grams: Iterable[Count]) -> None:
        words, counted_grams = list(words), list(counted_grams)
        self.languages = sorted({language for language, _, _ in words})
        self.words, table = _table(words, self.languages)
        self.word_logs = _logs(table, table.sum(axis=0))
        self.grams, table = _table(counted_grams, self.languages)
        self.gram_logs = np.zeros_like(table, dtype=np.float32)
        sizes = np.array([len(g) for g in self.grams], int)
        for n in SIZES:
            same = sizes == n
            self.gram_logs[same] = _logs(table[same], table[same].sum(axis=0))

    def unseen(self, word: str) -> tuple[float, ...]:
        """Mean over the word's places of the longest known n-gram that begins there."""
        marked, known = f"<{word}>", self.grams.get
        at, steps, longest, end = [], 0, SIZES[0], len(word) + 2
        for i in range(end):
            for n in range(min(longest, end - i), 0, -1):
                row = known(marked[i : i + n])
                if row is not None:
                    at.append(row)
                    steps += longest - n
                    break
        if not at:
            return (0.0,) * len(self.languages)
        return tuple(((self.gram_logs[at].sum(axis=0) + steps * BACKOFF) / len(at)).tolist())

    def memo(self) -> Memo:
        """Scores of unseen words, for one task."""
        return Memo(self.unseen, WORDS_KEPT)

    def predict(self, text: str | None, unseen: Memo) -> tuple[str, float]:
        counts = Counter(words_of(text or ""))
        # Signs such as a superscript count as parts of words, but are no letters.
        lettered = any(sign.isalpha() for word in counts for sign in word)
        if not lettered or not self.languages:
            return UNKNOWN, 0.0
        rows = list(map(self.words.get, counts))
        times = np.fromiter(counts.values(), np.float32, len(counts))
        if None in rows:
            seen = np.array([row is not None for row in rows])
            new = unseen.all([w for w, row in zip(counts, rows, strict=True) if row is None])
            sums = times[~seen] @ np.array(new, np.float32)
            rows, times = [row for row in rows if row is not None], times[seen]
        else:
            sums = np.zeros(len(self.languages), np.float32)
        if rows:
            sums = sums + times @ self.word_logs[rows]
        # Divided by the root of the number of words: short texts stay in doubt, long ones do not.
        level = sums / math.sqrt(sum(counts.values()))
        shares = np.exp(level - level.max())
        best = int(sums.argmax())
        return self.languages[best], float(shares[best] / shares.sum())


def _table(counts: list[Count], languages: list[str]) -> tuple[dict[str, int], np.ndarray]:
    """Row numbers of the keys, and their counts by language."""
    rows: dict[str, int] = {}
    for _, key, _ in counts:
        rows.setdefault(key, len(rows))
    columns = {language: i for i, language in enumerate(languages)}
    table = np.zeros((len(rows), len(languages)))
    for language, key, n in counts:
        table[rows[key], columns[language]] += n
    return rows, table


def _logs(counts: np.ndarray, totals: np.ndarray) -> np.ndarray:
    return np.log((counts + 0.5) / (totals + 0.5 * max(1, len(counts)))).astype(np.float32)


def _word_counts(sample: DataFrame) -> DataFrame:
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            counts: Counter[tuple[str, str]] = Counter()
            for language, text in zip(rows.column("lang"), texts_of(rows), strict=True):
                name = language.as_py()
                counts.update((name, w) for w in words_of(text))
            yield pa.RecordBatch.from_pydict(
                {
                    "lang": pa.array([k[0] for k in counts], pa.string()),
                    "word": pa.array([k[1] for k in counts], pa.string()),
                    "n": pa.array(list(counts.values()), pa.int64()),
                }
            )

    counted = sample.mapInArrow(count, "lang string, word string, n long")
    return counted.groupBy("lang", "word").agg(F.sum("n").alias("n"))


def train(
    docs: DataFrame,
    learns: Column | None = None,
    docs_per_language: int = DOCS_PER_LANGUAGE,
    words_per_language: int = WORDS_PER_LANGUAGE,
    grams_per_language: int = GRAMS_PER_LANGUAGE,
) -> Model:
    """Learn from the rows of ``docs`` (``doc_id, text, lang``) where ``learns`` holds.

    From every label's documents ``docs_per_language`` are learned from at most. What is known of a
    language are its ``words_per_language`` commonest words and ``grams_per_language`` n-grams, and what
    other languages keep: so the model grows with the labels and not with the corpus.
    """
    labelled = docs.filter(
        F.col("text").isNotNull() & (F.trim("lang") != "") & (F.lit(True) if learns is None else learns)
    )
    with scratch_scope(docs.sparkSession):
        drawn = labelled.withColumn("draw", F.xxhash64("doc_id"))
        lowest = Window.partitionBy("lang").orderBy("draw")
        last = (
            drawn.select("lang", "draw")
            .distinct()
            .withColumn("rank", F.row_number().over(lowest))
            .filter(F.col("rank") <= docs_per_language)
            .groupBy("lang")
            .agg(F.max("draw").alias("last"))
        )
        # At most docs_per_language rows of a language, also where one id repeats.
        sample = (
            drawn.join(F.broadcast(last), "lang")
            .filter(F.col("draw") <= F.col("last"))
            .groupBy("lang", "draw")
            .agg(F.min("text").alias("text"))
        )
        counts = stage(_word_counts(sample), "words")
        top = stage(_commonest(counts, "word", words_per_language), "top-words")
        spelt = stage(_gram_counts(top), "grams")
        kept = _commonest(spelt, "gram", grams_per_language)
        return Model(_local(top, "word"), _local(kept, "gram"))


def _commonest(counts: DataFrame, key: str, most: int) -> DataFrame:
    """The counts, in all languages, of the keys that are among the ``most`` commonest of one."""
    by_count = Window.partitionBy("lang").orderBy(F.desc("n"), key)
    ranked = counts.withColumn("rank", F.row_number().over(by_count)).filter(F.col("rank") <= most)
    return counts.join(ranked.select(key).distinct(), key, "left_semi")


def _gram_counts(words: DataFrame) -> DataFrame:
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            counts = gram_counts(zip(*(rows.column(c).to_pylist() for c in ("lang", "word", "n"))))
            yield pa.RecordBatch.from_pydict(
                {
                    "lang": pa.array([k[0] for k in counts], pa.string()),
                    "gram": pa.array([k[1] for k in counts], pa.string()),
                    "n": pa.array(list(counts.values()), pa.int64()),
                }
            )

    found = words.select("lang", "word", "n").mapInArrow(count, "lang string, gram string, n long")
    return found.groupBy("lang", "gram").agg(F.sum("n").alias("n"))


def _local(counts: DataFrame, key: str) -> Iterator[Count]:
    """A bounded table of counts, in order of its keys, a batch at a time."""
    for rows in counts.select("lang", key, "n").orderBy(key, "lang").toArrow().to_batches():
        yield from zip(*(column.to_pylist() for column in rows.columns), strict=True)


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id, lang_pred, score`` for every row of ``docs`` (``doc_id, text``)."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def label(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unseen = shared.value.memo()
        for rows in batches:
            found = [shared.value.predict(text, unseen) for text in texts_of(rows)]
            yield pa.RecordBatch.from_arrays(
                [
                    rows.column("doc_id"),
                    pa.array([f[0] for f in found], pa.string()),
                    pa.array([f[1] for f in found], pa.float64()),
                ],
                names=["doc_id", "lang_pred", "score"],
            )

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        label, "doc_id long, lang_pred string, score double"
    )


def keep_known(docs: DataFrame, model: Model, least_score: float = LEAST_SCORE) -> DataFrame:
    """The rows of ``docs``, all columns, whose language is known with at least ``least_score``.

    A missing ``lang`` is filled in.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("lang string, score double")
    def label(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        unseen = shared.value.memo()
        for texts in batches:
            found = [shared.value.predict(text, unseen) for text in texts]
            yield pd.DataFrame(found, columns=["lang", "score"])

    # Said not to be deterministic, so that the optimiser never runs it twice for a row.
    label = label.asNondeterministic()
    found = row_of(docs).withColumn("found", label(F.col("row.text")))
    known = found.filter(
        (F.col("found.lang") != UNKNOWN) & (F.col("found.score") >= least_score)
    )
    filled = F.coalesce("row.lang", "found.lang")
    return known.select(F.col("row").withField("lang", filled).alias("row")).select("row.*")
