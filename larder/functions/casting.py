"""Lenient casts (P2, P3, P5, E10): malformed text becomes NULL under ANSI mode as well."""

from __future__ import annotations

from pyspark.sql import Column, functions as F, types as T


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def to_type(c: Column | str, data_type: T.DataType | str) -> Column:
    """``c`` as ``data_type``, NULL where it does not parse or does not fit."""
    return _col(c).try_cast(data_type)


def to_date(c: Column | str) -> Column:
    """Text to date, NULL where it is not one."""
    return F.try_to_date(_col(c))


def blank_to_null(c: Column | str) -> Column:
    return F.nullif(_col(c), F.lit(""))


def typed_null(data_type: T.DataType | str) -> Column:
    return F.lit(None).cast(data_type)


def lenient(c: Column | str, data_type: T.DataType) -> Column:
    """A text column as ``data_type``: text as it is, anything else NULL where malformed."""
    if isinstance(data_type, T.StringType):
        return _col(c)
    return to_date(c) if isinstance(data_type, T.DateType) else to_type(c, data_type)


def typed_from_text(c: Column | str, data_type: T.DataType) -> Column:
    """``lenient``, with blank giving NULL in anything but text."""
    return lenient(c if isinstance(data_type, T.StringType) else blank_to_null(c), data_type)
