"""Landing only what has changed since the last time.

Every raw file lands in a partition of its own, named after its path, size and time: what a partition
holds never changes. A manifest says which partitions are current. The next landing compares it with
the folder as it is now: new and changed files get new partitions, the partitions of files that are
gone or have changed leave the manifest, and files that are as they were are not opened.

Whoever reads the landed rows can keep the partitions it has worked on, and so find out at any time
which are new to it and which have been withdrawn.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

from larder.operators.stable import open_or_empty
from larder.schema import all_strings
from larder.sources.inventory import list_files
from larder.sources.raw_csv import SPLIT_ABOVE_BYTES, Headers, land_files, path_key
from larder.sources.versioned import Versioned
from larder.workspace import stage

MANIFEST = "file_key string, path string, bytes long, modified timestamp, names array<string>"
NEW, CHANGED, GONE, SAME = "new", "changed", "gone", "same"
# Files scanned by one job, which bounds the paths that the driver hands to Spark at once.
FILES_PER_JOB = 10_000


def compare(now: DataFrame, before: DataFrame) -> DataFrame:
    """(path, state, bytes, modified): the files of both inventories by what became of them."""
    old = before.select("path", F.col("bytes").alias("old_bytes"), F.col("modified").alias("old_modified"))
    both = now.select("path", "bytes", "modified").join(old, "path", "full")
    same = (F.col("bytes") == F.col("old_bytes")) & (F.col("modified") == F.col("old_modified"))
    state = (
        F.when(F.col("old_bytes").isNull(), NEW)
        .when(F.col("bytes").isNull(), GONE)
        .when(same, SAME)
        .otherwise(CHANGED)
    )
    return both.select("path", state.alias("state"), "bytes", "modified")


@dataclass(frozen=True)
class Landing:
    """Raw files landed as Parquet under ``root``, one partition each."""

    spark: SparkSession
    root: str

    @property
    def data(self) -> str:
        return f"{self.root}/data"

    @property
    def manifest(self) -> Versioned:
        return Versioned(self.spark, f"{self.root}/manifest", MANIFEST)

    def keys(self) -> DataFrame:
        """``file_key`` of every current partition."""
        return self.manifest.read().select("file_key")

    def changes(self, path: str) -> DataFrame:
        """What a landing of ``path`` would do, file by file."""
        return compare(list_files(self.spark, path).filter("bytes > 0"), self.manifest.read())

    def land(self, path: str, split_above: int = SPLIT_ABOVE_BYTES) -> DataFrame:
        """Land the new and changed CSV files at ``path``; returns ``changes`` as they were found.

        A landing that fails half way leaves the manifest as it was: the next one does those files
        again, into the same partitions.
        """
        found = stage(self.changes(path), "changes")
        state = F.concat_ws("|", "path", "bytes", F.unix_micros("modified"))
        fresh = found.filter(F.col("state").isin(NEW, CHANGED)).select(
            F.substring(F.sha2(state, 256), 1, 24).alias("file_key"), "path", "bytes", "modified"
        )
        paths = [r["path"] for r in fresh.select("path").orderBy("path").collect()]
        named = []
        for at in range(0, len(paths), FILES_PER_JOB):
            some = paths[at : at + FILES_PER_JOB]
            files = fresh.filter(F.col("path").between(some[0], some[-1]))
            headers = land_files(self.spark, some, self.data, split_above, keys=files)
            named.append(_named(files, headers))
        if not found.filter(F.col("state") != SAME).isEmpty():
            same = found.filter(F.col("state") == SAME).select("path")
            current = self.manifest.read().join(same, "path", "left_semi")
            for part in named:
                current = current.unionByName(part)
            self.manifest.write(current)
        return found

    def names(self) -> list[str]:
        """Columns of any current file, in the order of headers first met."""
        rows = self.manifest.read().groupBy("names").agg(F.min("path").alias("path"))
        ordered = rows.orderBy("path").collect()
        return list(dict.fromkeys(name for r in ordered for name in r["names"]))

    def read(self, files: DataFrame | None = None) -> DataFrame:
        """The current rows with their ``file_key``; only those of ``files`` (``file_key``) if given.

        Other partitions are pruned by the join: their files are not opened.
        """
        current = self.keys()
        if files is not None:
            current = current.join(files.select("file_key"), "file_key", "left_semi")
        schema = all_strings(*self.names(), "file_key")
        rows = open_or_empty(self.spark, self.data, schema)
        return rows.join(current, "file_key", "left_semi").select(*schema.names)


def _named(files: DataFrame, headers: Headers) -> DataFrame:
    """``files`` with the columns that each has."""
    columns = [F.array(*map(F.lit, schema.names)) for schema in headers.schemas]
    if headers.of_file is None:
        return files.withColumn("names", columns[0])
    numbers = headers.of_file.select(path_key("file").alias("_key"), "header")
    of = F.get(F.array(*columns), F.col("header"))
    keyed = files.withColumn("_key", path_key("path")).join(numbers, "_key")
    return keyed.withColumn("names", of).drop("header", "_key")
