"""A blocked Bloom filter as a table, built and tested with DataFrame operations only.

All bits of a key lie in one block of 4 KB, so a row looks up a single block. Blocks are rows of a
table ``(block, bits)`` made with Spark's bitmap aggregates, and are broadcast while the filter is at
most ``BROADCAST_BYTES``. Larger filters are joined by block, which shuffles the rows tested: hand
over narrow ones.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

# Bits of one bitmap, as bitmap_construct_agg makes them.
BLOCK_BITS = 32_768
BITS_PER_KEY = 16
HASHES = 3
# Largest filter sent to every executor: enough for 134 million keys.
BROADCAST_BYTES = 256 << 20


def blocks_for(keys: int) -> int:
    return max(1, -(-keys * BITS_PER_KEY // BLOCK_BITS))


def _block(key: Column, blocks: int) -> Column:
    return F.pmod(key, F.lit(blocks))


def _positions(key: Column) -> list[Column]:
    """``HASHES`` bit numbers within a block, from a hash of the key independent of its block."""
    mixed = F.xxhash64(key)
    return [F.shiftrightunsigned(mixed, 15 * i).bitwiseAND(BLOCK_BITS - 1) for i in range(HASHES)]


def set_bits(keys: DataFrame, blocks: int, at_least: int = 1) -> DataFrame:
    """``(block, bits)`` of the bits that the hashes in column ``key`` set ``at_least`` times.

    Counts combine in each task before the shuffle, so copies cost no more than one row per task.
    """
    bits = keys.select(
        _block(F.col("key"), blocks).alias("block"),
        F.explode(F.array(*_positions(F.col("key")))).alias("bit"),
    )
    return (
        bits.groupBy("block", "bit")
        .agg(F.count(F.lit(1)).alias("n"))
        .filter(F.col("n") >= at_least)
        .groupBy("block")
        .agg(F.bitmap_construct_agg("bit").alias("bits"))
    )


def _bit_set(bits: Column, position: Column) -> Column:
    byte = F.conv(F.hex(F.substring(bits, (position / 8).cast("int") + 1, F.lit(1))), 16, 10)
    return F.getbit(byte.cast("int"), (position % 8).cast("int")) == 1


def mark(rows: DataFrame, seen: DataFrame, blocks: int, name: str) -> DataFrame:
    """``rows`` with ``name``, true wherever all bits of ``key`` are in ``seen``."""
    if blocks * BLOCK_BITS // 8 <= BROADCAST_BYTES:
        seen = F.broadcast(seen)
    hit = F.lit(True)
    for position in _positions(F.col("key")):
        hit = hit & _bit_set(F.col("bits"), position)
    return (
        rows.withColumn("block", _block(F.col("key"), blocks))
        .join(seen, "block", "left")
        .withColumn(name, F.coalesce(hit, F.lit(False)))
        .drop("block", "bits")
    )
