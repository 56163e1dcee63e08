"""Quality rules with thresholds that follow the corpus, in DataFrame operations only.

Two fixed rules fail a document outright (``base_failed``). Four measures are then held against
fences around two quantiles of its language and source: more than ``FENCE`` times the distance between
them below the lower or above the upper is rejected. So a fence lies where the documents of the source
lie, and is as wide as they are spread.

Every document has a length of words, and prose has no symbols: there the quantiles are the eighths of
all documents, which noise of up to an eighth does not move. Most documents repeat nothing, which does
not tell how much repetition is usual: there the quantiles are the quarters of the documents that do.
Distances count as ``LEAST_SPREAD`` at least, for sources whose documents are all alike.

Quantiles come from mergeable sketches: counts by value, kept to ``SKETCH_BITS`` leading bits, so a
sketch has a bounded size, is off by at most one part in 32, and merges by adding. Counts combine
before any shuffle. Sketches of a language's sources merge into the language's, those into the
corpus's; where fewer than ``ENOUGH`` documents of a source tell a quantile, its language's is taken,
and the corpus's where that has fewer. Sketches count all documents that pass the fixed rules.

Defined cases: null and empty texts have no words and fail; null languages and sources are groups of
their own; repeated rows get equal rows; empty tables give empty results; further columns are not
read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from larder.workspace import keep, scratch_scope, stage

GAP = r"[\x20\x09-\x0D]+"
WORD_SIGN = r"[^\x20\x09-\x0D]"
GAP_SIGNS = "\x20\x09\x0a\x0b\x0c\x0d"
SYMBOLS = "#*$%&|<>"
WINDOW = 5
MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20

SKETCH_BITS = 6
ENOUGH = 100
FENCE = 3
# Of a thousand: symbols among characters of words, words in repeated windows, repeated lines among
# lines; and hundredths of a character a word.
LEAST_SPREAD = {"symbols": 40, "word_length": 25, "repeats": 20, "lines": 30}
# Measures of which only documents that have any tell what is usual.
SHOWN_ONLY = ("repeats", "lines")
# The lower quantile is one part in this many, the upper as many from the top.
PARTS_OF_ALL, PARTS_OF_SHOWN = 8, 4


def _repeat_words() -> Column:
    """Words in windows that occur twice or more, from ``windows`` and ``sorted`` (hash, place)."""
    here = F.transform(
        "sorted",
        lambda x, k: F.when(
            (x["hash"] == F.get("sorted", k - 1)["hash"])
            | (x["hash"] == F.get("sorted", k + 1)["hash"]),
            x["place"],
        ),
    )
    return F.array_sort(F.filter(here, lambda x: x.isNotNull()))


def _covered() -> Column:
    """Length of the union of the windows that begin at ``places``."""
    steps = F.transform(
        "places",
        lambda p, k: F.coalesce(F.least(F.get("places", k + 1) - p, F.lit(WINDOW)), F.lit(WINDOW)),
    )
    return F.aggregate(steps, F.lit(0), lambda total, step: total + step)


def base_counts(docs: DataFrame) -> DataFrame:
    """``doc_id, lang, source, n_words, word_chars, n_symbols, n_lines, n_dup_lines,
    n_repeat_words``."""
    text = F.coalesce("text", F.lit(""))
    rows = docs.select(
        "doc_id",
        "lang",
        "source",
        F.length(F.translate(text, GAP_SIGNS, "")).cast("long").alias("word_chars"),
        (F.length(text) - F.length(F.translate(text, SYMBOLS, ""))).cast("long").alias("n_symbols"),
        F.filter(F.split(text, "\n"), lambda line: line.rlike(WORD_SIGN)).alias("lines"),
        F.filter(F.split(text, GAP), lambda word: word != "").alias("words"),
    )
    rows = rows.withColumn("n_words", F.size("words")).withColumn(
        "n_dup_lines", (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long")
    )
    starts = F.sequence(F.lit(0), F.col("n_words") - WINDOW)
    hashes = F.transform(
        starts, lambda i: F.xxhash64(*[F.get("words", i + k) for k in range(WINDOW)])
    )
    none = F.array().cast("array<bigint>")
    rows = rows.withColumn("windows", F.when(F.col("n_words") >= WINDOW, hashes).otherwise(none))
    # Few documents repeat a window: only theirs are sorted.
    repeats = F.size(F.array_distinct("windows")) < F.size("windows")
    pairs = F.transform("windows", lambda h, i: F.struct(h.alias("hash"), i.alias("place")))
    rows = rows.withColumn("sorted", F.when(repeats, F.array_sort(pairs)))
    rows = rows.withColumn("places", F.when(F.col("sorted").isNotNull(), _repeat_words()))
    return rows.select(
        "doc_id",
        "lang",
        "source",
        F.col("n_words").cast("long").alias("n_words"),
        "word_chars",
        "n_symbols",
        F.size("lines").cast("long").alias("n_lines"),
        "n_dup_lines",
        F.when(F.col("places").isNotNull(), _covered()).otherwise(0).cast("long").alias("n_repeat_words"),
    )


def measures() -> dict[str, Column]:
    """Whole numbers, so that results do not depend on how sums are ordered."""
    return {
        "symbols": F.expr("1000 * n_symbols div greatest(word_chars, 1)"),
        "word_length": F.expr("100 * word_chars div greatest(n_words, 1)"),
        "repeats": F.expr("1000 * n_repeat_words div greatest(n_words, 1)"),
        "lines": F.expr("1000 * n_dup_lines div greatest(n_lines, 1)"),
    }


def _rounded(value: Column) -> Column:
    """``value`` with all but its leading ``SKETCH_BITS`` bits zero."""
    drop = F.greatest(F.length(F.bin(value)) - SKETCH_BITS, F.lit(0))
    return F.call_function("shiftleft", F.call_function("shiftright", value, drop), drop)


def sketches(counts: DataFrame) -> DataFrame:
    """``lang, source, measure, value, n``: the sketch of each language, source and measure."""
    values = F.array(
        *[F.struct(F.lit(name).alias("measure"), m.alias("value")) for name, m in measures().items()]
    )
    rows = counts.select("lang", "source", F.explode(values).alias("m"))
    return (
        rows.groupBy("lang", "source", F.col("m.measure").alias("measure"), _rounded(F.col("m.value")).alias("value"))
        .agg(F.count(F.lit(1)).alias("n"))
    )


def merged(sketch: DataFrame, *by: str) -> DataFrame:
    """Sketches added up over all but the keys in ``by``."""
    return sketch.groupBy(*by, "measure", "value").agg(F.sum("n").alias("n"))


def quantiles(sketch: DataFrame, *by: str) -> DataFrame:
    """``by, measure, docs, low, high`` of each sketch, ``docs`` being those that tell the quantiles; a
    sketch has a bounded number of values."""
    group = Window.partitionBy(*by, "measure")
    shown_only = F.col("measure").isin(*SHOWN_ONLY)
    telling = sketch.withColumn("n", F.when(shown_only & (F.col("value") == 0), 0).otherwise(F.col("n")))
    running = telling.withColumn("upto", F.sum("n").over(group.orderBy("value"))).withColumn(
        "docs", F.sum("n").over(group)
    )
    parts = F.when(shown_only, PARTS_OF_SHOWN).otherwise(PARTS_OF_ALL)
    told = running.withColumn("parts", parts).filter("n > 0 or docs = 0")
    return told.groupBy(*by, "measure").agg(
        F.max("docs").alias("docs"),
        F.min(F.expr("if(parts * upto >= docs, value, null)")).alias("low"),
        F.min(F.expr("if(parts * upto >= (parts - 1) * docs, value, null)")).alias("high"),
    )


def spreads(sketch: DataFrame) -> DataFrame:
    """``lang, source, measure, low, high, spread`` for every language and source: its quantiles, or
    those it is held against for want of documents, and how far apart they count as."""
    cells = quantiles(sketch, "lang", "source").alias("c")
    langs = quantiles(merged(sketch, "lang"), "lang").alias("l")
    corpus = quantiles(merged(sketch)).alias("g")
    same = F.col("c.measure") == F.col("l.measure")
    joined = cells.join(langs, F.col("c.lang").eqNullSafe(F.col("l.lang")) & same).join(
        corpus, F.col("c.measure") == F.col("g.measure")
    )

    def backed(q: str) -> Column:
        return (
            F.when(F.col("c.docs") >= ENOUGH, F.col(f"c.{q}"))
            .when(F.col("l.docs") >= ENOUGH, F.col(f"l.{q}"))
            .otherwise(F.col(f"g.{q}"))
        )

    least = F.create_map(*[F.lit(x) for pair in LEAST_SPREAD.items() for x in pair])
    return joined.select(
        "c.lang", "c.source", "c.measure", backed("low").alias("low"), backed("high").alias("high")
    ).withColumn("spread", F.greatest(F.col("high") - F.col("low"), least[F.col("measure")]))


def thresholds(sketch: DataFrame) -> DataFrame:
    """``lang, source, <measure>_low, <measure>_high`` for every language and source."""
    reach = FENCE * F.col("spread")
    fenced = spreads(sketch).select(
        "lang", "source", "measure",
        (F.col("low") - reach).alias("low"), (F.col("high") + reach).alias("high"),
    )
    # Too much repetition is a fault, too little is none.
    fenced = fenced.withColumn("low", F.when(F.col("measure").isin(*SHOWN_ONLY), 0).otherwise(F.col("low")))
    return fenced.groupBy("lang", "source").agg(
        *[
            F.max(F.when(F.col("measure") == name, F.col(end))).alias(f"{name}_{end}")
            for name in LEAST_SPREAD
            for end in ("low", "high")
        ]
    )


def judge(docs: DataFrame) -> DataFrame:
    """``doc_id``, the counts, ``base_failed`` and ``kept`` for every row of ``docs`` (``doc_id,
    text, lang, source``)."""
    failed = (F.col("n_words") < MIN_WORDS) | (
        100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words")
    )
    with scratch_scope(docs.sparkSession):
        counts = stage(base_counts(docs).withColumn("base_failed", failed), "counts")
        fences = stage(thresholds(sketches(counts.filter(~F.col("base_failed")))), "fences")
        fences = fences.withColumnsRenamed({"lang": "f_lang", "source": "f_source"})
        cell = F.col("lang").eqNullSafe(F.col("f_lang")) & F.col("source").eqNullSafe(
            F.col("f_source")
        )
        within = F.lit(True)
        for name, value in measures().items():
            within = within & value.between(F.col(f"{name}_low"), F.col(f"{name}_high"))
        judged = counts.join(fences, cell, "left").select(
            "doc_id",
            "n_words",
            "word_chars",
            "n_symbols",
            "n_dup_lines",
            "n_repeat_words",
            "base_failed",
            (~F.col("base_failed") & F.coalesce(within, F.lit(False))).alias("kept"),
        )
        return keep(judged, "judged")


# The same rules in SQL over the table documents.
ORACLE = r"""
WITH d AS (
    SELECT rowid_, doc_id, lang, source, t,
           regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS w,
           list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l
    FROM (SELECT row_number() OVER () AS rowid_, *, coalesce(text, '') AS t FROM documents)
),
places AS (
    SELECT rowid_, w, unnest(range(1, len(w) - 3)) AS i FROM d
),
windows AS (
    SELECT rowid_, i, count(*) OVER (PARTITION BY rowid_, w[i:i + 4]) AS times FROM places
),
covered AS (
    SELECT rowid_, count(DISTINCT i + k) AS n_repeat_words
    FROM windows, range(0, 5) AS r(k) WHERE times > 1 GROUP BY rowid_
),
counts AS (
    SELECT d.rowid_, doc_id, lang, source,
           len(w)::BIGINT AS n_words,
           length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g'))::BIGINT AS word_chars,
           (length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
           len(l)::BIGINT AS n_lines,
           (len(l) - len(list_distinct(l)))::BIGINT AS n_dup_lines,
           coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words
    FROM d LEFT JOIN covered USING (rowid_)
),
based AS (
    SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM counts
),
measured AS (
    SELECT rowid_, lang, source, base_failed, m.measure AS measure, m.value AS value, m.least AS least
    FROM (
        SELECT *, unnest([
            {'measure': 'symbols', 'value': 1000 * n_symbols // greatest(word_chars, 1), 'least': 40},
            {'measure': 'word_length', 'value': 100 * word_chars // greatest(n_words, 1), 'least': 25},
            {'measure': 'repeats', 'value': 1000 * n_repeat_words // greatest(n_words, 1), 'least': 20},
            {'measure': 'lines', 'value': 1000 * n_dup_lines // greatest(n_lines, 1), 'least': 30}
        ]) AS m FROM based
    )
),
rounded AS (
    SELECT lang, source, measure, least,
           (value >> greatest(length(bin(value)) - 6, 0)) << greatest(length(bin(value)) - 6, 0) AS v
    FROM measured WHERE NOT base_failed
),
told AS (
    -- Most documents repeat nothing: only those that do tell how much is usual.
    SELECT *, measure IN ('repeats', 'lines') AS shown FROM rounded
),
cells AS (SELECT DISTINCT lang, source, measure, least, shown FROM told),
cell AS (
    SELECT lang, source, measure, count(*) AS docs,
           CASE WHEN shown THEN quantile_disc(v, 0.25) ELSE quantile_disc(v, 0.125) END AS low,
           CASE WHEN shown THEN quantile_disc(v, 0.75) ELSE quantile_disc(v, 0.875) END AS high
    FROM told WHERE NOT shown OR v > 0 GROUP BY lang, source, measure, shown
),
lang AS (
    SELECT lang, measure, count(*) AS docs,
           CASE WHEN shown THEN quantile_disc(v, 0.25) ELSE quantile_disc(v, 0.125) END AS low,
           CASE WHEN shown THEN quantile_disc(v, 0.75) ELSE quantile_disc(v, 0.875) END AS high
    FROM told WHERE NOT shown OR v > 0 GROUP BY lang, measure, shown
),
corpus AS (
    SELECT measure,
           CASE WHEN shown THEN quantile_disc(v, 0.25) ELSE quantile_disc(v, 0.125) END AS low,
           CASE WHEN shown THEN quantile_disc(v, 0.75) ELSE quantile_disc(v, 0.875) END AS high
    FROM told WHERE NOT shown OR v > 0 GROUP BY measure, shown
),
chosen AS (
    SELECT k.lang, k.source, k.measure, k.least, k.shown,
           CASE WHEN c.docs >= 100 THEN c.low WHEN l.docs >= 100 THEN l.low ELSE coalesce(g.low, 0) END AS low,
           CASE WHEN c.docs >= 100 THEN c.high WHEN l.docs >= 100 THEN l.high ELSE coalesce(g.high, 0) END AS high
    FROM cells k
    LEFT JOIN cell c ON k.lang IS NOT DISTINCT FROM c.lang
                    AND k.source IS NOT DISTINCT FROM c.source AND k.measure = c.measure
    LEFT JOIN lang l ON k.lang IS NOT DISTINCT FROM l.lang AND k.measure = l.measure
    LEFT JOIN corpus g ON k.measure = g.measure
),
fences AS (
    SELECT lang, source, measure,
           CASE WHEN shown THEN 0 ELSE low - 3 * greatest(high - low, least) END AS lowest,
           high + 3 * greatest(high - low, least) AS highest
    FROM chosen
),
verdict AS (
    SELECT m.rowid_, bool_and(coalesce(m.value BETWEEN lowest AND highest, false)) AS fine
    FROM measured m LEFT JOIN fences f
      ON m.lang IS NOT DISTINCT FROM f.lang AND m.source IS NOT DISTINCT FROM f.source
     AND m.measure = f.measure
    GROUP BY m.rowid_
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND fine AS kept
FROM based JOIN verdict USING (rowid_)
"""
