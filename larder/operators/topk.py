"""Top-k helpers that read wide columns only for the rows that can win (O1-O3)."""

from __future__ import annotations

from collections.abc import Sequence

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

from larder.steps import step
from larder.workspace import stage

# Candidates looked at beyond k before giving up on the short way.
SLACK = 200
# Most rows brought to the driver to be looked up one by one.
MAX_LEADERS = 1_000


def any_of(column: str, values: Sequence[int]) -> Column:
    """``column`` is one of ``values``, so that a Parquet scan skips what holds none of them.

    The reader tests a list against a row group by its ends only, but a chain of equalities one
    by one. The list comes first as it is the cheap test for a row. Written as SQL text, which is
    one call for hundreds of literals.
    """
    if not values:
        return F.lit(False)
    one_by_one = " OR ".join(f"{column} = {v}" for v in values)
    return F.expr(f"{column} IN ({', '.join(map(str, values))}) AND ({one_by_one})")


def join_existing(candidates: DataFrame, lookup: DataFrame, key: str) -> DataFrame:
    """Rows of ``candidates`` whose key is in ``lookup``, joined to it.

    The candidates are written first, once. So Spark knows their size when it plans the join, and
    does not shuffle a big ``lookup`` for a few of them.
    """
    return stage(step(candidates, "candidates"), "candidates").join(lookup, key)


def top_k_existing(
    candidates: DataFrame, lookup: DataFrame, key: str, order: Sequence[Column], k: int
) -> DataFrame:
    """First ``k`` rows of ``candidates`` by ``order`` whose key is in ``lookup``, joined to it.

    ``key`` is a number, unique in ``lookup``; ``order`` is total over ``candidates`` up to equal
    rows.

    As the join drops orphans, a limit before it could come out short. So the first k + SLACK
    candidates are taken without a shuffle and looked up by a pushed-down key filter, first 2 k of
    them. If there were no more candidates, or k are found, that is the answer: whatever was left
    out sorts behind. Otherwise the full join runs.
    """
    everything = candidates.join(lookup, key).orderBy(*order).limit(k)
    if k > MAX_LEADERS:
        return everything
    reach = k + SLACK
    leaders = step(candidates.orderBy(*order).limit(reach + 1), "leading candidates").toArrow()

    def wanted(rows: pa.Table) -> DataFrame:
        return lookup.filter(any_of(key, pc.unique(rows[key].drop_null()).to_pylist()))

    if leaders.num_rows <= reach:
        local = lookup.sparkSession.createDataFrame(leaders, schema=candidates.schema)
        return wanted(leaders).join(F.broadcast(local), key).orderBy(*order).limit(k)
    # Few orphans are the rule, so few keys are asked for first. At most k + SLACK rows of either
    # side, so they are put together here.
    for some in (min(2 * k, reach), reach):
        first = leaders.slice(0, some)
        rows = _joined(first, step(wanted(first), "rows of leading candidates").toArrow(), key).slice(0, k)
        if rows.num_rows == k:
            return lookup.sparkSession.createDataFrame(rows, schema=everything.schema)
    return everything


def _joined(first: pa.Table, found: pa.Table, key: str) -> pa.Table:
    """Inner join of a few rows, in the order of ``first``."""
    at = {value: i for i, value in enumerate(found[key].to_pylist())}
    pairs = [(i, at[v]) for i, v in enumerate(first[key].to_pylist()) if v in at]
    left = first.take(pa.array([i for i, _ in pairs], pa.int64()))
    right = found.take(pa.array([j for _, j in pairs], pa.int64()))
    columns = {key: left[key]} | {c: left[c] for c in first.column_names if c != key}
    return pa.table(columns | {c: right[c] for c in found.column_names if c != key})


def lowest_k(df: DataFrame, column: str, tiebreak: str, k: int) -> DataFrame:
    """The ``k`` rows with the lowest ``column``, ties by ``tiebreak``; NULLs left out.

    A first pass over the one narrow column finds the k-th lowest value; the scan of the other
    columns then gets that value as a pushed-down bound.
    """
    present = df.filter(F.col(column).isNotNull())
    bound = present.select(column).orderBy(column).limit(k).agg(F.max(column)).scalar()
    return present.filter(F.col(column) <= bound).orderBy(column, tiebreak).limit(k)
