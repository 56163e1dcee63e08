"""Dense ids 1..N in sort order, without a single-partition window."""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

from larder.workspace import stage

# monotonically_increasing_id() is (partition << 33) + position within the partition.
POSITION_BITS = 33


def _sorted_positions(df: DataFrame, order: Sequence[str]) -> DataFrame:
    """``df`` range-partitioned and sorted by ``order``, written with each row's place in it.

    Written because range bounds come from a sample: offsets counted in one run must not be added
    to positions from another.
    """
    ranged = df.repartitionByRange(*order).sortWithinPartitions(*order)
    placed = ranged.withColumn("_place", F.monotonically_increasing_id())
    return stage(placed, "positions").withColumn(
        "_part", F.shiftrightunsigned("_place", POSITION_BITS)
    )


def _offsets(positions: DataFrame) -> Column:
    """Rows before each partition, by its number. One row per partition reaches the driver."""
    sizes = positions.groupBy("_part").agg(F.count(F.lit(1)).alias("n")).collect()
    by_part = {row["_part"]: row["n"] for row in sizes}
    offsets, before = [], 0
    for part in range(max(by_part, default=-1) + 1):
        offsets.append(before)
        before += by_part.get(part, 0)
    # One literal, however many partitions there are.
    return F.from_json(F.lit(json.dumps(offsets)), "array<bigint>")


def _numbered(
    positions: DataFrame, columns: Sequence[str], id_column: str, id_type: T.DataType | None
) -> DataFrame:
    before = F.element_at(_offsets(positions), (F.col("_part") + 1).cast("int"))
    position = F.col("_place").bitwiseAND((1 << POSITION_BITS) - 1)
    number = (before + position + 1).cast(id_type or T.LongType())
    return positions.select(number.alias(id_column), *columns)


def dense_ids(
    df: DataFrame, order: Sequence[str], id_column: str, id_type: T.DataType | None = None
) -> DataFrame:
    """Add ``id_column`` = 1..N by ``order``, which is unique per row.

    Two narrow passes: sort by range and note positions, then add the number of rows in the
    partitions before. Equal to ``row_number()`` over the global order.
    """
    return _numbered(_sorted_positions(df, order), df.columns, id_column, id_type)


def row_ids(df: DataFrame, id_column: str, id_type: T.DataType | None = None) -> DataFrame:
    """Add ``id_column`` = 1..N in no particular order, without a shuffle.

    Rows are written where they are, with their places; what is read back has the same ids on
    every retry.
    """
    placed = stage(df.withColumn("_place", F.monotonically_increasing_id()), "rows")
    part = F.shiftrightunsigned("_place", POSITION_BITS)
    return _numbered(placed.withColumn("_part", part), df.columns, id_column, id_type)
