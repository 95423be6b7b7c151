"""Landing job: decoded yearly files to one typed, partitioned table; only what is missing."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..operators.quality import union_named
from ..sources.catalogue import YEARS, catalogue, landing_name, missing_partitions
from ..sources.contracts import RAW_COLUMNS, raw_contract
from ..sources.facts import PARTITIONS, land, read_fact, write_fact


def wanted_partitions(spark: SparkSession, present: DataFrame | None, years=YEARS) -> list[tuple[str, int]]:
    """(source, year) pairs still to land: the catalogue minus what the table holds."""
    wanted = catalogue(spark, years)
    todo = wanted if present is None else missing_partitions(wanted, present.select(*PARTITIONS).distinct())
    return [(r.SOURCE, int(r.RENTREE)) for r in todo.collect()]


def landed(spark: SparkSession, root: str) -> DataFrame | None:
    """The (source, year) pairs that a fact holds; None before anything was written. Only partition values are read."""
    path = spark._jvm.org.apache.hadoop.fs.Path(root)
    if not path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path):
        return None
    return read_fact(spark, root).select(*PARTITIONS).distinct()


def land_missing(
    spark: SparkSession,
    landing: str,
    root: str,
    present: DataFrame | None = None,
    years=YEARS,
    columns=RAW_COLUMNS,
    locate: Callable[[str, int], str] = landing_name,
) -> int:
    """Land the missing files in one write; a file that is not there fails the job.

    What ``root`` holds is present, unless ``present`` states something else (an empty table: land everything again).
    """
    todo = wanted_partitions(spark, landed(spark, root) if present is None else present, years)
    if not todo:
        return 0
    contract = raw_contract(columns)
    files = [land(spark, f"{landing.rstrip('/')}/{locate(s, y)}", s, y, contract) for s, y in todo]
    write_fact(union_named(*files), root)
    return len(todo)
