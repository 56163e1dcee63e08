"""What the training-data operators share: input columns, Arrow batches, word rules."""

from __future__ import annotations

import tempfile
import zipfile
from collections.abc import Callable, Iterator
from pathlib import Path
from typing import Any

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

import larder

# Rows handed to Python at once. Texts can be long, so batches are kept far below Spark's default.
ROWS_PER_BATCH = 512


_shipped: set[str] = set()


def prepare(spark: SparkSession) -> None:
    """Make a session fit for tasks in Python: small batches of long texts, and this package on
    every executor, wherever the driver has loaded it from. A smaller batch already set stays."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    now = int(spark.conf.get(key))
    if now <= 0 or now > ROWS_PER_BATCH:
        spark.conf.set(key, ROWS_PER_BATCH)
    context = spark.sparkContext
    if context.applicationId not in _shipped:
        context.addPyFile(_zipped())
        _shipped.add(context.applicationId)


def _zipped() -> str:
    """The package as an archive in the driver's own temporary folder, from where Spark sends it."""
    root = Path(larder.__file__).parent
    path = str(Path(tempfile.mkdtemp(prefix="larder-code-")) / "larder_code.zip")
    with zipfile.ZipFile(path, "w") as archive:
        for file in sorted(root.rglob("*.py")):
            archive.write(file, file.relative_to(root.parent))
    return path


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def fold(doc_id: str = "doc_id") -> Column:
    """The remainder that splits learning rows (0, 2) from held-out rows (1); null ids learn."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 3, F.lit(0))


class Memo:
    """Remembers what ``work`` makes of each key, for up to ``limit`` keys; then starts anew.

    Values compare with None, as arrays would not.

    A plain dict asked through ``map`` is several times as fast as one with ``__missing__``.
    """

    def __init__(self, work: Callable[[Any], Any], limit: int) -> None:
        self.work, self.limit = work, limit
        self.known: dict[Any, Any] = {}

    def one(self, key: Any) -> Any:
        value = self.known.get(key)
        if value is None:
            value = self.known[key] = self.work(key)
        return value

    def all(self, keys: list) -> list:
        if len(self.known) > self.limit:
            self.known.clear()
        found = list(map(self.known.get, keys))
        if None in found:
            for i, value in enumerate(found):
                if value is None:
                    found[i] = self.one(keys[i])
        return found


def texts_of(rows: pa.RecordBatch, name: str = "text") -> Iterator[str]:
    """The texts of a batch one by one; null counts as empty."""
    for text in rows.column(name):
        yield text.as_py() or ""


def row_of(docs: DataFrame) -> DataFrame:
    """Whole rows as one column ``row``, so that added columns cannot clash with theirs."""
    return docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("row"))
