"""Publication from kept partial sums.

The sums over published codes are stored for each (source, year). When facts of some of them change, only these are
summed again; the publication adds up the stored sums, which are far fewer rows than the facts.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..operators.aggregate import in_even_parts, resum
from ..operators.schema import relabel
from ..sources.facts import PARTITIONS, write_fact
from ..sources.sheets import StoredSheets
from .publish import MEASURES, PUBLISHED_NAMES, ROLLUP_KEYS, UNPUBLISHED, in_scope, labelled_sums, publication_codes


def partial_sums(facts: DataFrame, sheets: Mapping[str, DataFrame]) -> DataFrame:
    """Sums over the published codes, with the source of the facts as a further key."""
    keys = list(dict.fromkeys([*PARTITIONS, *[k for k in ROLLUP_KEYS if k not in UNPUBLISHED]]))
    codes = publication_codes(in_scope(facts, sheets)).select(*keys, *MEASURES)
    return resum(in_even_parts(codes, keys), keys, MEASURES)


def refresh(facts: DataFrame, sheets: Mapping[str, DataFrame], root: str, changed: Iterable[tuple[str, str]] | None = None) -> None:
    """Bring the stored sums up to date with the ``changed`` (source, year) pairs of the facts; with all of them if None.

    Only the folders of these pairs are read and written. A pair that has no rows left keeps no sums.
    """
    if changed is None:
        write_fact(partial_sums(facts, sheets), root)
        return
    pairs = sorted({(str(s), str(y)) for s, y in changed})
    if not pairs:
        return
    wanted = reduce(lambda a, b: a | b, [(F.col("SOURCE") == s) & (F.col("RENTREE") == y) for s, y in pairs])
    write_fact(partial_sums(facts.filter(wanted), sheets), root)
    _drop_empty(facts.filter(wanted), root, pairs)


def _drop_empty(facts: DataFrame, root: str, pairs: list[tuple[str, str]]) -> None:
    """Dynamic overwriting leaves the folder of a pair alone that has no rows any more: remove it."""
    spark = facts.sparkSession
    left = {(r.SOURCE, r.RENTREE) for r in facts.select(*PARTITIONS).distinct().collect()}
    for source, year in set(pairs) - left:
        gone = spark._jvm.org.apache.hadoop.fs.Path(f"{root.rstrip('/')}/SOURCE={source}/RENTREE={year}")
        gone.getFileSystem(spark._jsc.hadoopConfiguration()).delete(gone, True)


def read_sums(spark: SparkSession, root: str) -> DataFrame:
    df = spark.read.parquet(root)
    return df.withColumns({p: F.col(p).cast("string") for p in PARTITIONS})


def publish_sums(sums: DataFrame, sheets: Mapping[str, DataFrame], names: bool = True) -> DataFrame:
    """The published table from stored sums; the same as ``publish.publish`` of the facts."""
    sheets = StoredSheets(sheets).ahead()
    table = labelled_sums(sums.drop("SOURCE"), sheets)
    return relabel(table, PUBLISHED_NAMES) if names else table
