"""Writing and loading curated tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from larder.functions.casting import typed_from_text
from larder.sources.raw_csv import scan_csv

# The writer would otherwise trim blanks and escape quotes with a backslash, and the file would
# not read back as it was.
CSV_SINK_OPTIONS = {
    "header": True,
    "escape": '"',
    "ignoreLeadingWhiteSpace": False,
    "ignoreTrailingWhiteSpace": False,
}
# With the default null value, "", the reader takes a quoted empty field for NULL too.
NOT_IN_TEXT = "\u0000"


def write_csv(df: DataFrame, path: str, single_file: bool = False) -> None:
    """CSV with header at ``path``, replacing what is there; one part file per task.

    ``single_file`` gives one part file, which a single task writes whatever the size.
    """
    if single_file:
        df = df.coalesce(1)
    df.write.mode("overwrite").options(**CSV_SINK_OPTIONS).csv(path)


def load_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """CSV columns under their declared types; blank or malformed gives NULL.

    Matched by name in every file's own header; a column that no file has is an error.

    In text columns an empty field is NULL and a quoted empty field is an empty string, which is
    how ``write_csv`` writes the two.
    """
    text = scan_csv(spark, path, nullValue=NOT_IN_TEXT)
    return text.select(
        *[typed_from_text(f.name, f.dataType).alias(f.name) for f in schema.fields]
    )


def in_schema(df: DataFrame, schema: T.StructType) -> DataFrame:
    """The schema's columns in the schema's order and types."""
    return df.select(*[F.col(f.name).cast(f.dataType) for f in schema.fields])


def replace_table(df: DataFrame, path: str, schema: T.StructType) -> DataFrame:
    """Write ``df`` as a Parquet table of the declared shape; returns the written table.

    Further uses read the table, so no plan is computed twice.
    """
    in_schema(df, schema).write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(schema).parquet(path)


def replace_catalog_table(df: DataFrame, name: str, schema: T.StructType) -> DataFrame:
    """``replace_table`` under a catalog name."""
    in_schema(df, schema).write.mode("overwrite").format("parquet").saveAsTable(name)
    return df.sparkSession.table(name)
