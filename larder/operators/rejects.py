"""What a typed load refuses, and why (P2, P3, S4): a second output of the same scan."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

from larder.operators.conform import conform_field

MALFORMED, OUT_OF_RANGE, NO_ID = "malformed", "out of range", "no id"
_ENTRY = "struct<column_name: string, raw_text: string, reason: string>"
# A number in plain digits, as the casts read it: too big for its type rather than no number.
NUMBER = r"^\s*[+-]?[0-9]+\s*$"


def _entry(f: T.StructField, raw: str | None, value: Column, is_id: bool) -> Column:
    """Why a field is not as it was given; NULL if it is."""
    if raw is None:
        return F.lit(None).cast(_ENTRY)
    text = F.col(raw)
    given = text.isNotNull() & (F.trim(text) != "")
    reason = F.lit(MALFORMED)
    if isinstance(f.dataType, T.IntegralType):
        reason = F.when(F.rlike(text, F.lit(NUMBER)), OUT_OF_RANGE).otherwise(MALFORMED)
    lost = F.when(given & value.isNull(), reason)
    if is_id:
        lost = F.when(~F.coalesce(given, F.lit(False)), NO_ID).otherwise(lost)
    return F.when(
        lost.isNotNull(), F.struct(F.lit(f.name).alias("column_name"), text.alias("raw_text"), lost.alias("reason"))
    )


def checked(
    raw: DataFrame,
    schema: T.StructType,
    columns: Mapping[str, str],
    id_offset: int = 0,
    carry: Sequence[str] = (),
    **constants: str,
) -> DataFrame:
    """``conform`` without loss: (row, kept, rejects) for every row of ``raw``, in one scan.

    ``row`` is the typed row, ``kept`` whether ``conform`` would keep it, ``rejects`` what was given
    and did not fit: (column_name, raw_text, reason). Columns to ``carry`` come along, to say where a
    value is from. Stage it, then read ``rows_kept`` and ``rejected_values`` from what is written.
    """
    fields = {f.name: conform_field(f, columns, id_offset, constants) for f in schema}
    ids = [name for name in fields if name.endswith("_id")]
    entries = [
        _entry(f, columns.get(f.name) if f.name not in constants else None, fields[f.name], f.name in ids)
        for f in schema
    ]
    kept = F.lit(True)
    for name in ids:
        kept = kept & fields[name].isNotNull()
    return raw.select(
        F.struct(*[c.alias(name) for name, c in fields.items()]).alias("row"),
        kept.alias("kept"),
        F.filter(F.array(*entries), lambda e: e.isNotNull()).alias("rejects"),
        *carry,
    )


def rows_kept(found: DataFrame) -> DataFrame:
    """What ``conform`` gives."""
    return found.filter("kept").select("row.*")


def rejected_values(found: DataFrame, carry: Sequence[str] = ()) -> DataFrame:
    """(column_name, raw_text, reason, dropped) and what was carried, one row per value refused.

    ``dropped`` says whether the whole row went with it.
    """
    return found.select(*carry, (~F.col("kept")).alias("dropped"), F.explode("rejects").alias("e")).select(
        *carry, "e.column_name", "e.raw_text", "e.reason", "dropped"
    )


def loss_summary(found: DataFrame) -> DataFrame:
    """One row: rows in, kept, dropped, and values refused in rows that were kept."""
    lost = F.when(F.col("kept"), F.size("rejects")).otherwise(0)
    return found.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if(F.col("kept")).alias("n_kept"),
        F.count_if(~F.col("kept")).alias("n_dropped"),
        F.coalesce(F.sum(lost.cast("long")), F.lit(0)).alias("n_values_lost"),
    )
