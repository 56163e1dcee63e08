"""Scan and shuffle widths from the amount of data."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession, functions as F

from larder.sources.inventory import list_files

MB = 1024 * 1024
# Data one shuffle task should hold, so that it sorts and hashes in memory, and one scan task reads.
BYTES_PER_TASK = 256 * MB
SCAN_BYTES = 128 * MB
# Every scan task writes a block per shuffle task; as many scan tasks as this still make blocks of a
# useful size, so scans of more data read more per task.
SCAN_TASKS = 100_000


def shuffle_partitions(input_bytes: int, at_least: int, per_task: int = BYTES_PER_TASK) -> int:
    return max(at_least, -(-input_bytes // per_task))


def scan_bytes(input_bytes: int, tasks: int = SCAN_TASKS) -> int:
    return max(SCAN_BYTES, -(-input_bytes // tasks))


@contextmanager
def sized_for(spark: SparkSession, *paths: str) -> Iterator[None]:
    """Session widths that inputs at ``paths`` need, inside the block; never narrower than set.

    AQE merges partitions that turn out small but, outside skewed joins, does not split big ones,
    so the width has to be enough for the largest shuffle: the raw data.
    """
    total = sum(list_files(spark, p).agg(F.sum("bytes")).collect()[0][0] or 0 for p in paths)
    keys = ("spark.sql.shuffle.partitions", "spark.sql.files.maxPartitionBytes")
    before = {key: spark.conf.get(key) for key in keys}
    width = int(before["spark.sql.shuffle.partitions"])
    spark.conf.set("spark.sql.shuffle.partitions", shuffle_partitions(total, width))
    if scan_bytes(total) > SCAN_BYTES:
        spark.conf.set("spark.sql.files.maxPartitionBytes", scan_bytes(total))
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
