"""Integrity audits: what a schema declares and Spark does not enforce.

Each audit returns violations or counts as a DataFrame and fails nothing.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F, types as T

from larder.schema import RULES, TableRules


def row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """(tbl, n), one row per table."""
    counts = [
        df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("tbl"), "n")
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionAll, counts)


def null_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row: how many NULLs each column holds, ``<column>_nulls``."""
    return df.agg(*[F.count_if(F.col(c).isNull()).alias(f"{c}_nulls") for c in columns])


def too_long_counts(df: DataFrame, max_lengths: Mapping[str, int]) -> DataFrame:
    """One row: how many values exceed each column's bound, ``<column>_too_long``."""
    return df.agg(
        *[F.count_if(F.length(c) > n).alias(f"{c}_too_long") for c, n in max_lengths.items()]
    )


def duplicate_keys(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """Key values held by more than one row, with their row counts."""
    return df.groupBy(*key).agg(F.count(F.lit(1)).alias("n_rows")).filter("n_rows > 1")


def key_summary(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """One row: rows, distinct keys, keys that repeat, rows with a NULL in the key.

    Counts per key first, so there is one shuffle and common keys combine on the map side.
    """
    has_null = reduce(lambda a, b: a | b, [F.col(c).isNull() for c in key])
    per_key = df.groupBy(*key).agg(F.count(F.lit(1)).alias("n"))
    return per_key.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("n_rows"),
        F.count_if(~has_null).alias("n_keys"),
        F.count_if(~has_null & (F.col("n") > 1)).alias("n_repeated"),
        F.coalesce(F.sum(F.when(has_null, F.col("n"))), F.lit(0)).alias("n_null_keys"),
    )


def _column_rules(tbl: str, df: DataFrame, rules: TableRules) -> DataFrame:
    """NOT NULL and length rules of one table, all in a single scan."""
    checks = {f"not null {c}": F.count_if(F.col(c).isNull()) for c in rules.required}
    for c, n in rules.max_lengths.items():
        checks[f"length {c} <= {n}"] = F.count_if(F.length(c) > n)
    counted = df.agg(
        F.map_from_arrays(
            F.array(*[F.lit(name) for name in checks]), F.array(*checks.values())
        ).alias("checks")
    )
    return counted.select(
        F.lit(tbl).alias("tbl"), F.explode("checks").alias("rule", "violations")
    )


def _claims(df: DataFrame, entries: Sequence[tuple[int, Sequence[str], bool]], width: int) -> DataFrame:
    """Every row of a table once per entry (rule, key, is_parent): the rule's number and the exact key.

    Whole numbers of a key go to ``n0 ...`` and anything else as text to ``s0 ...``, so that rules of
    any types can be counted together.
    """

    def entry(rule: int, key: Sequence[str], is_parent: bool) -> Column:
        whole = [isinstance(df.schema[c].dataType, T.IntegralType) for c in key]
        numbers = [F.col(c).cast("long") if w else F.lit(None).cast("long") for c, w in zip(key, whole)]
        texts = [F.lit(None).cast("string") if w else F.col(c).cast("string") for c, w in zip(key, whole)]
        numbers += [F.lit(None).cast("long")] * (width - len(key))
        texts += [F.lit(None).cast("string")] * (width - len(key))
        return F.struct(
            F.lit(rule).alias("rule"),
            F.lit(is_parent).alias("is_parent"),
            *[c.alias(f"n{i}") for i, c in enumerate(numbers)],
            *[c.alias(f"s{i}") for i, c in enumerate(texts)],
        )

    return df.select(F.explode(F.array(*[entry(*e) for e in entries])).alias("c")).select("c.*")


def _key_rules(tables: Mapping[str, DataFrame], rules: Mapping[str, TableRules]) -> DataFrame:
    """(tbl, rule, violations) of all keys and foreign keys of all tables: one scan of each, one shuffle.

    Rows are expanded once per key they must not repeat, per value they refer to and per value others
    refer to. Equal keys combine in each task, so common values weigh nothing in the shuffle.
    """
    declared: list[tuple[int, str, str]] = []
    entries: dict[str, list[tuple[int, Sequence[str], bool]]] = {tbl: [] for tbl in rules}
    for tbl, of in rules.items():
        for key in of.keys:
            entries[tbl].append((len(declared), key, False))
            declared.append((len(declared), tbl, f"unique ({', '.join(key)})"))
    first_reference = len(declared)
    for tbl, of in rules.items():
        for fk in of.foreign_keys:
            entries[tbl].append((len(declared), (fk.column,), False))
            entries[fk.parent].append((len(declared), (fk.parent_column,), True))
            declared.append((len(declared), tbl, f"{fk.column} -> {fk.parent}.{fk.parent_column}"))
    width = max((len(key) for of in entries.values() for _, key, _ in of), default=1)
    claims = [_claims(tables[tbl], of, width) for tbl, of in entries.items() if of]
    spark = next(iter(tables.values())).sparkSession
    names = spark.createDataFrame(declared, "number int, tbl string, rule string")
    if not claims:
        return names.select("tbl", "rule", F.lit(0).cast("long").alias("violations"))
    key = [f"{kind}{i}" for kind in "ns" for i in range(width)]
    per_key = (
        reduce(DataFrame.unionAll, claims)
        .groupBy("rule", *key)
        .agg(
            F.count_if(~F.col("is_parent")).alias("n_rows"),
            F.max("is_parent").alias("has_parent"),
        )
    )
    # NULL refers to nothing; in a key it is a value like another.
    lost = ~F.col("has_parent") & F.coalesce(*[F.col(c).cast("string") for c in key]).isNotNull()
    broken = F.when(
        F.col("rule") < first_reference, (F.col("n_rows") > 1).cast("long")
    ).otherwise(F.when(lost, F.col("n_rows")).otherwise(0))
    found = per_key.groupBy(F.col("rule").alias("number")).agg(F.sum(broken).alias("violations"))
    return names.join(found, "number", "left").select(
        "tbl", "rule", F.coalesce("violations", F.lit(0).cast("long")).alias("violations")
    )


def audit(
    tables: Mapping[str, DataFrame], rules: Mapping[str, TableRules] = RULES
) -> DataFrame:
    """(tbl, rule, violations) for every rule declared on the given tables.

    A key counts once per repeated value, a foreign key once per orphan row. However many rules a
    table has, it is scanned once for its columns and once for its keys.
    """
    columns = [_column_rules(tbl, tables[tbl], table_rules) for tbl, table_rules in rules.items()]
    return reduce(DataFrame.unionAll, [*columns, _key_rules(tables, rules)])
