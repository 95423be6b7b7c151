"""Unions, distinct projections and column-set checks."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, functions as F

from ..functions.nulls import is_missing
from .schema import columns_like


def union_named(*dfs: DataFrame) -> DataFrame:
    """Union by column name; a column absent from one side is NULL there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), dfs)


def distinct_rows(df: DataFrame) -> DataFrame:
    return df.distinct()


def distinct_combos(df: DataFrame, pattern: str, extra: Sequence[str]) -> DataFrame:
    """Distinct combinations of ``extra`` and of every column whose name holds ``pattern``."""
    named = columns_like(df, pattern)
    cols = sorted({*named, *[c for c in extra if c in df.columns]})
    return df.select(*cols).distinct()


def project_sorted(df: DataFrame, cols: Iterable[str]) -> DataFrame:
    return df.select(*sorted(cols))


def column_diff(df: DataFrame, model: Iterable[str]) -> tuple[list[str], list[str]]:
    """Columns the frame lacks, and columns the model does not name, both sorted."""
    have, want = set(df.columns), set(model)
    return sorted(want - have), sorted(have - want)


def failed_casts(df: DataFrame, types: Mapping[str, str], keys: Sequence[str]) -> DataFrame:
    """Rows (keys, column, value, type): every cell that is no missing one and does not fit the type of its column.

    What ``cast_present`` and ``conform`` turn into NULL is listed here, in one pass over the listed columns; texts take part as they stand.
    """
    have = {c: t for c, t in types.items() if c in df.columns}
    cells = [
        F.when(~is_missing(F.col(f"`{c}`").cast("string")) & F.col(f"`{c}`").try_cast(t).isNull(),
               F.struct(F.lit(c).alias("column"), F.col(f"`{c}`").cast("string").alias("value"), F.lit(t).alias("type")))
        for c, t in have.items()]
    none = F.lit(None).cast("struct<column:string,value:string,type:string>")
    return df.select(*keys, F.inline(F.array_compact(F.array(none, *cells))))


def quarantined(df: DataFrame, types: Mapping[str, str], keys: Sequence[str], folder: str) -> tuple[DataFrame, dict[str, int]]:
    """``df`` cast, and the number of failed cells by column; the failed cells are written to ``folder`` first.

    A later step can refuse to go on when a number is too high; nothing of the facts is collected but these counts.
    """
    from .schema import cast_present

    failed_casts(df, types, keys).write.mode("overwrite").parquet(folder)
    counts = df.sparkSession.read.parquet(folder).groupBy("column").count().collect()
    return cast_present(df, types), {c: 0 for c in types if c in df.columns} | {r["column"]: r["count"] for r in counts}
