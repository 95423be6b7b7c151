"""Sums over many keys. NULL keys form groups; an all-NULL measure sums to 0."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F


def _sum(c: Column | str) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return F.coalesce(F.sum(c.cast("bigint")), F.lit(0).cast("bigint"))


def sum_cube(df: DataFrame, keys: Sequence[str], measures: Sequence[str], flags: Sequence[str] = ()) -> DataFrame:
    """Sums over ``keys`` and ``flags``; a flag is a grouping key whose result column is its sum."""
    names = {f: f"__flag_{f}" for f in flags}
    wide = df.withColumns({n: F.col(f) for f, n in names.items()}) if names else df
    out = wide.groupBy(*keys, *names.values()).agg(*[_sum(m).alias(m) for m in [*measures, *flags]])
    return out.drop(*names.values())


def resum(df: DataFrame, keys: Sequence[str], measures: Sequence[str] | Mapping[str, str]) -> DataFrame:
    """Sum again over coarser keys: ``measures`` may map a column to its new name."""
    pairs = dict(measures) if isinstance(measures, Mapping) else {m: m for m in measures}
    return df.groupBy(*keys).agg(*[_sum(m).alias(n) for m, n in pairs.items()])


def in_even_parts(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows shuffled into parts of the advisory size, those of one group together unless they are many.

    Where almost every row is a group of its own, a sum holds as many groups as its task has rows; files are split by
    their compressed bytes, so that such a task grows with the table. The hash is no grouping key: sums stay in two steps.
    """
    return df.withColumn("__part", F.xxhash64(*keys)).hint("rebalance", "__part").drop("__part")


def row_metrics(df: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Row count and number of columns, per group when asked."""
    width = len(df.columns)
    counted = df.groupBy(*by).agg(F.count(F.lit(1)).alias("n_rows"))
    return counted.withColumn("n_columns", F.lit(width).cast("bigint"))


def any_row(df: DataFrame, cond: Column, by: Sequence[str] = (), name: str = "any_row") -> DataFrame:
    """Does some row of the group meet the condition?"""
    return df.groupBy(*by).agg(F.bool_or(F.coalesce(cond, F.lit(False))).alias(name))


def distinct_counts(df: DataFrame, keys: Sequence[str], columns: Mapping[str, str]) -> DataFrame:
    """Exact numbers of distinct values per key: ``{column: new name}``.

    Spark expands and pre-aggregates each (key, value) pair before counting, so a heavy
    key is spread over its values.
    """
    return df.groupBy(*keys).agg(*[F.count_distinct(c).alias(n) for c, n in columns.items()])
