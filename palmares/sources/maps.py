"""Code-to-label maps as two-column tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def map_to_rows(df: DataFrame, map_col: Column | str, key: str, value: str, keep: tuple[str, ...] = ()) -> DataFrame:
    """One row per map entry, next to the ``keep`` columns."""
    return df.select(*keep, F.explode(map_col).alias(key, value))


def parent_units(df: DataFrame, map_col: str = "RATTACH_MAP", year: str = "RENTREE") -> DataFrame:
    """Component to parent unit, per year."""
    return map_to_rows(df, map_col, "COMPOS", "RATTACH", (year,))


def unit_communes(df: DataFrame, map_col: str = "COMCOMP_MAP", year: str = "RENTREE") -> DataFrame:
    """Establishment to commune, per year."""
    return map_to_rows(df, map_col, "UAI", "COMCODE", (year,))
