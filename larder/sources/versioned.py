"""A small table that is replaced as a whole while its last state is being read.

States alternate between two folders, and a log says which is the last one complete. So a job that dies
while it writes leaves the state before in place, and what may be read is never overwritten.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from larder.operators.stable import open_or_empty

_LOG = T.StructType([T.StructField("version", T.LongType())])


@dataclass(frozen=True)
class Versioned:
    spark: SparkSession
    root: str
    schema: str

    def _log(self) -> DataFrame:
        return open_or_empty(self.spark, f"{self.root}/log", _LOG)

    def version(self) -> int:
        """How often the table has been replaced."""
        return self._log().agg(F.max("version")).first()[0] or 0

    def _folder(self, version: int) -> str:
        return f"{self.root}/state-{version % 2}"

    def read(self) -> DataFrame:
        schema = T.StructType.fromDDL(self.schema)
        version = self.version()
        if not version:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(self._folder(version))

    def write(self, df: DataFrame) -> None:
        """Replace the table by ``df``, which may be made from its last state."""
        version = self.version() + 1
        schema = T.StructType.fromDDL(self.schema)
        df.select(*schema.names).write.mode("overwrite").parquet(self._folder(version))
        done = self.spark.createDataFrame([(version,)], _LOG)
        done.coalesce(1).write.mode("append").parquet(f"{self.root}/log")
