"""From landed files to the published CSV in one call."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

from ..sources.catalogue import YEARS
from ..sources.facts import read_fact, write_fact
from ..sources.opendata import write_open_csv
from . import correct, ingest, publish


def run(
    spark: SparkSession, landing: str, root: str, sheets: Mapping[str, DataFrame], parents: DataFrame, unit_communes: DataFrame,
    years=YEARS, parents_to_bac: bool = False,
) -> str:
    """Land what ``root`` lacks, correct, publish; the folder of the CSV, with a sub-folder for each year.

    Below ``root`` every step leaves its table: ``raw``, ``normalised``, ``corrected`` and ``od``. A run that
    fails can be repeated: landed partitions are not landed again, and the other steps replace what they write.
    """
    raw, normalised, corrected, csv = (f"{root.rstrip('/')}/{name}" for name in ("raw", "normalised", "corrected", "od"))
    ingest.land_missing(spark, landing, raw, years=years)
    facts = correct.correct_table(spark, read_fact(spark, raw), sheets, parents, unit_communes, normalised, parents_to_bac)
    write_fact(facts, corrected)
    write_open_csv(publish.publish(read_fact(spark, corrected), sheets), csv, year="rentree")
    return csv
