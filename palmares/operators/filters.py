"""Row filters, rule-driven deletes, membership tests and set-wide gates."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.nulls import as_col, holds, is_blank, pd_ne
from .lookups import bounded, left_lookup


def exclude(df: DataFrame, col: str, value) -> DataFrame:
    """Drop rows equal to ``value``; NULL rows stay."""
    return df.filter(pd_ne(col, value))


def keep_any(df: DataFrame, conds: Sequence[Column]) -> DataFrame:
    """Keep rows for which at least one condition is true."""
    return df.filter(reduce(lambda a, b: a | b, conds))


def remove_where(df: DataFrame, cond: Column) -> DataFrame:
    """Drop rows for which the condition is true; an unknown condition keeps the row."""
    return df.filter(~holds(cond))


def keep_positive(df: DataFrame, col: str) -> DataFrame:
    return df.filter(F.col(col) > 0)


def delete_by_rules(df: DataFrame, rules: DataFrame, shapes: Sequence[tuple[str | None, Sequence[str]]]) -> DataFrame:
    """Delete rows named by a rule table with several key forms.

    ``shapes`` lists ``(deciding column, key columns)``: a rule takes the first form
    whose deciding column is not blank; a form with ``None`` takes the rest. Each form
    is one anti join, so the forms cannot multiply rows, and the shuffled variant of an
    anti join keeps its skew splitting (no de-duplication sits between exchange and join).
    """
    left = F.lit(True)
    for decider, keys in shapes:
        mine = left if decider is None else left & ~is_blank(decider)
        part = rules.filter(mine).select(*keys)
        df = df.join(bounded(part), list(keys), "left_anti")
        if decider is not None:
            left = left & is_blank(decider)
    return df


def semi_by_attribute(df: DataFrame, dim: DataFrame, on: str, attr: str, value) -> DataFrame:
    """Keep rows whose dimension member has ``attr = value``."""
    members = dim.filter(F.col(attr) == value).select(on)
    return df.join(bounded(members), on, "left_semi")


def unknown_to(df: DataFrame, col: str, dim: DataFrame, key: str, value: str) -> DataFrame:
    """Replace codes that are not in the dimension (NULL included) by ``value``."""
    known = dim.select(F.col(key), F.lit(True).alias("__known"))
    marked = left_lookup(df, known, {col: key}, ["__known"])
    return marked.withColumn(col, F.when(F.col("__known"), F.col(col)).otherwise(F.lit(value))).drop("__known")


def if_any(
    df: DataFrame,
    cond: Column,
    then: Callable[[DataFrame, Column], DataFrame],
    by: Sequence[str],
) -> DataFrame:
    """Apply ``then`` to the groups in which some row meets ``cond``.

    ``then`` receives the frame and the gate column. The gate is a map-side combined
    ``bool_or`` per group (a handful of (source, year) pairs), joined back by broadcast
    when its size allows.
    """
    names = [f"__g{i}" for i in range(len(by))]
    gates = df.groupBy(*[F.col(c).alias(n) for c, n in zip(by, names)]).agg(F.bool_or(holds(cond)).alias("__gate"))
    on = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(n)) for c, n in zip(by, names)])
    gated = df.join(bounded(gates), on, "left").drop(*names)
    return then(gated, holds(as_col("__gate"))).drop("__gate")
