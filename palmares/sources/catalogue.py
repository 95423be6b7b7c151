"""Which sources exist in which year, and where a (source, year) lives."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession

from ..operators.lookups import small_table

# The first entry year of each source.
FIRST_YEAR = {
    "result": 2015,
    "ens": 2015,
    "inge": 2015,
    "priv": 2015,
    "mana": 2018,
    "enq": 2019,
    "culture": 2019,
}
YEARS = tuple(range(2015, 2022))


def sources_of(year: int) -> list[str]:
    if year < 2015:
        raise ValueError(f"no source before 2015: {year}")
    return [s for s, first in FIRST_YEAR.items() if year >= first]


def catalogue(spark: SparkSession, years: Iterable[int] = YEARS) -> DataFrame:
    """One row per (SOURCE, RENTREE)."""
    rows = [(s, str(y)) for y in years for s in sources_of(y)]
    return small_table(spark, rows, "SOURCE string, RENTREE string")


def landing_name(source: str, year: int, corrected: bool = False) -> str:
    """File name of a landed year: two-digit year for raw files, four digits once corrected."""
    stem = source if source == "result" else f"dip{source}26bis" if source == "enq" else f"dip{source}"
    return f"corrected_{stem}{year}_ssa.parquet" if corrected else f"{stem}{str(year)[2:]}_ssa.parquet"


def fact_path(root: str, source: str, year: int) -> str:
    """Folder of one (source, year) in the partitioned layout."""
    return f"{root.rstrip('/')}/SOURCE={source}/RENTREE={year}"


def missing_partitions(wanted: DataFrame, present: DataFrame, keys: Sequence[str] = ("SOURCE", "RENTREE")) -> DataFrame:
    """Wanted partitions that do not exist yet."""
    return wanted.join(present.select(*keys), list(keys), "left_anti")
