"""What lies in a raw zone: files, sizes, totals, missing files."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F


def list_files(spark: SparkSession, path: str | Sequence[str], pattern: str | None = None) -> DataFrame:
    """(path, directory, file, bytes, modified) of every file below ``path``.

    Only file status is read: the content column is pruned from the scan.
    """
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    return reader.load(path).select(
        "path",
        F.regexp_extract("path", "^(.*)/[^/]*$", 1).alias("directory"),
        F.element_at(F.split("path", "/"), -1).alias("file"),
        F.col("length").alias("bytes"),
        F.col("modificationTime").alias("modified"),
    )


def rows_per_file(df: DataFrame) -> DataFrame:
    """(path, n_rows) of every file that a table is read from."""
    path = F.url_decode(F.replace("_metadata.file_path", F.lit("+"), F.lit("%2B")))
    return df.select(path.alias("path")).groupBy("path").agg(F.count(F.lit(1)).alias("n_rows"))


def directory_totals(files: DataFrame) -> DataFrame:
    """(directory, n_files, bytes) per directory."""
    return files.groupBy("directory").agg(
        F.count(F.lit(1)).alias("n_files"), F.sum("bytes").alias("bytes")
    )


def missing_files(files: DataFrame, expected: Sequence[str]) -> DataFrame:
    """Expected file names (a short list) that are not there."""
    wanted = files.sparkSession.createDataFrame([(f,) for f in expected], "file string")
    return wanted.join(files.select("file"), "file", "left_anti")
