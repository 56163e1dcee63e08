"""Reproducible shuffle into shards by a Feistel permutation of global row numbers.

Rows are numbered 0..N-1 in the order of id, size and checksum. A Feistel network permutes the next
larger power of four; numbers that come out at N or above go through again until they fall below
(cycle walking, fewer than four rounds on average). Row p of the permuted order is slot ``p // shards``
of shard ``p % shards``: so shards differ by one row at most, slots have no gaps, and both can be
computed from a row number, or a row number from both, without any table.

Defined cases: a null text has no bytes and the checksum of an empty one; null ids come first;
repeated rows get places of their own; empty tables give empty results; further columns are not read.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from larder.operators.ids import dense_ids
from larder.workspace import keep, scratch_scope, stage

SHARDS = 8
SEED = 5
ROUNDS = 6

_U = np.uint64


def _keys(seed: int) -> list[np.uint64]:
    return [_U(k) for k in np.random.default_rng(seed).integers(1, 1 << 63, ROUNDS)]


def _half_bits(n: int) -> int:
    """Bits of half a number, for the smallest power of four that holds ``n`` rows."""
    return max(1, -(-max(1, n - 1).bit_length() // 2))


def _mix(half: np.ndarray, key: np.uint64, bits: int) -> np.ndarray:
    mixed = (half + key) * _U(0x9E3779B97F4A7C15)
    mixed = (mixed ^ (mixed >> _U(31))) * _U(0xD6E8FEB86659FD93)
    return (mixed ^ (mixed >> _U(32))) & _U((1 << bits) - 1)


def _network(numbers: np.ndarray, bits: int, keys: list[np.uint64], back: bool) -> np.ndarray:
    left, right = numbers >> _U(bits), numbers & _U((1 << bits) - 1)
    for key in reversed(keys) if back else keys:
        if back:
            left, right = right ^ _mix(left, key, bits), left
        else:
            left, right = right, left ^ _mix(right, key, bits)
    return (left << _U(bits)) | right


def permute(numbers: np.ndarray, n: int, seed: int = SEED, back: bool = False) -> np.ndarray:
    """Where each row number in 0..n-1 goes, or with ``back`` where it came from."""
    bits, keys = _half_bits(n), _keys(seed)
    out = _network(np.asarray(numbers, _U), bits, keys, back)
    while (far := out >= _U(n)).any():
        out[far] = _network(out[far], bits, keys, back)
    return out.astype(np.int64)


def row_at(shard: int, slot: int, n: int, shards: int = SHARDS, seed: int = SEED) -> int:
    """The row number that ``shard_rows`` puts there."""
    return int(permute(np.array([slot * shards + shard]), n, seed, back=True)[0])


def permuted(number: Column, n: int, seed: int) -> Column:
    @F.pandas_udf("long")
    def place(numbers: pd.Series) -> pd.Series:
        return pd.Series(permute(numbers.to_numpy(), n, seed))

    return place(number)


def shard_rows(docs: DataFrame, shards: int = SHARDS, seed: int = SEED) -> DataFrame:
    """``doc_id, size, text_crc32, law, shard, slot, grown_shard, row_number`` for every row of
    ``docs`` (``doc_id, text``). The law is ``rows``: shards differ by one row at most.

    Only ids, sizes and checksums are sorted; the texts stay where they are.
    """
    text = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    with scratch_scope(docs.sparkSession):
        rows = stage(
            docs.select(
                F.col("doc_id").cast("long"),
                (F.octet_length(text) + 1).cast("long").alias("size"),
                F.crc32(text).alias("text_crc32"),
                F.monotonically_increasing_id().alias("place"),
            ),
            "sizes",
        )
        numbered = dense_ids(rows, ["doc_id", "size", "text_crc32", "place"], "row_number")
        placed = numbered.withColumn("row_number", F.col("row_number") - 1).withColumn(
            "permuted", permuted(F.col("row_number"), rows.count(), seed)
        )
        return keep(
            placed.select(
                "doc_id",
                "size",
                "text_crc32",
                F.lit("rows").alias("law"),
                (F.col("permuted") % shards).cast("int").alias("shard"),
                F.expr(f"permuted div {shards}").alias("slot"),
                F.lit(None).cast("int").alias("grown_shard"),
                "row_number",
            ),
            "shards",
        )
