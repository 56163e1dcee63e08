"""Exact de-duplication behind a two-pass Bloom filter, in DataFrame operations only.

Pass one sets bits for the hash of every text and keeps the bits that were set at least twice.
Pass two tests every row against those bits. A row with a bit that nothing else set has no copy and
goes straight through; only the others are shuffled and grouped.

Of 1000 texts without a copy about 5 are shuffled in vain. A filter too large to broadcast is joined
instead (see ``bits``).

Defined cases: null text counts as empty; a null id is smaller than any other; of rows equal in text
and id one stays; empty tables give empty results; further columns pass through unread.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from larder.llm.bits import blocks_for, mark, set_bits
from larder.llm.common import row_of
from larder.workspace import keep, scratch_scope, stage


def _sha(text: Column) -> Column:
    return F.unhex(F.sha2(F.coalesce(text, F.lit("")), 256))


def _key(sha: Column) -> Column:
    return F.xxhash64(sha)


def copy_groups(docs: DataFrame) -> DataFrame:
    """One row per document: ``doc_id, keep_id, group_size, kept, text_sha256``.

    ``docs`` has ``doc_id`` and ``text``. Of equal texts the largest ``doc_id`` stays. The text is
    read once, for its hash; everything after works on ids and hashes.
    """
    spark = docs.sparkSession
    with scratch_scope(spark):
        rows = stage(
            docs.select("doc_id", _sha(F.col("text")).alias("sha")).select(
                "doc_id", "sha", F.monotonically_increasing_id().alias("row_number")
            ),
            "hashes",
        )
        keyed = rows.withColumn("key", _key(F.col("sha")))
        blocks = blocks_for(rows.count())
        seen = set_bits(keyed, blocks, at_least=2)
        marked = stage(mark(keyed, seen, blocks, "suspect").drop("key"), "marked")
        suspects = marked.filter("suspect")
        # Copies combine in each task first, so one huge group is a row per task here. Written, so
        # that the join back shuffles both sides itself and Spark can split a hot text there.
        groups = stage(
            suspects.groupBy("sha").agg(
                F.max(F.struct("doc_id", "row_number")).alias("top"), F.count(F.lit(1)).alias("n")
            ),
            "groups",
        )
        grouped = suspects.join(groups, "sha").select(
            "doc_id",
            F.col("top.doc_id").alias("keep_id"),
            F.col("n").alias("group_size"),
            (F.col("top.row_number") == F.col("row_number")).alias("kept"),
            F.lower(F.hex("sha")).alias("text_sha256"),
        )
        single = marked.filter(~F.col("suspect")).select(
            "doc_id",
            F.col("doc_id").alias("keep_id"),
            F.lit(1).cast("long").alias("group_size"),
            F.lit(True).alias("kept"),
            F.lower(F.hex("sha")).alias("text_sha256"),
        )
        return keep(single.unionByName(grouped), "copies")


def drop_copies(docs: DataFrame) -> DataFrame:
    """The rows of ``docs``, all columns, without copies: of equal texts the largest ``doc_id``.

    Rows that pass the filter keep their place. Of the others each task sends on one row per text.
    """
    keys = docs.select(_key(_sha(F.col("text"))).alias("key"))
    blocks = blocks_for(keys.count())
    seen = keep(set_bits(keys, blocks, at_least=2), "bits")
    rows = row_of(docs).withColumn("sha", _sha(F.col("row.text")))
    marked = mark(rows.withColumn("key", _key(F.col("sha"))), seen, blocks, "suspect")
    single = marked.filter(~F.col("suspect")).select("row.*")
    best = (
        marked.filter("suspect")
        .groupBy("sha")
        .agg(F.max_by("row", F.struct("row.doc_id")).alias("row"))
        .select("row.*")
    )
    return single.unionByName(best)
