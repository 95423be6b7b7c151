"""Landing with a ledger: what was landed from which file, told by content.

Every landing writes to a folder of its own; the ledger, one small table, says which folder holds each (source, year) and what
its file was: bytes, columns, rows and a digest of the rows. A file whose digest changed is landed again. Readers follow the ledger, and a new
ledger appears by one rename after the data is complete, so a half-written landing is never seen.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..operators.quality import union_named
from ..sources.catalogue import landing_name
from ..sources.contracts import RAW_COLUMNS, raw_contract
from ..sources.facts import PARTITIONS, land

SCHEMA = "SOURCE string, RENTREE string, bytes bigint, columns array<string>, n_rows bigint, digest string, folder string"


def _fs(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def _ledgers(spark: SparkSession, root: str) -> list[int]:
    """Numbers of the complete ledgers, ascending."""
    fs, where = _fs(spark, f"{root}/_ledger")
    if not fs.exists(where):
        return []
    return sorted(int(s.getPath().getName()) for s in fs.listStatus(where) if s.getPath().getName().isdigit())


def read_ledger(spark: SparkSession, root: str) -> DataFrame:
    """The ledger in force; empty before the first landing."""
    root = root.rstrip("/")
    found = _ledgers(spark, root)
    return spark.read.schema(SCHEMA).parquet(f"{root}/_ledger/{found[-1]}") if found else spark.createDataFrame([], SCHEMA)


def file_state(spark: SparkSession, path: str, source: str, year: int) -> DataFrame:
    """One row that tells a landed file: bytes, sorted columns, rows, and a digest of its rows that does not depend on their order.

    The digest adds two hashes of every row as exact decimals, so each task gives one row.
    """
    fs, where = _fs(spark, path)
    size = fs.getContentSummary(where).getLength()
    df = spark.read.parquet(path)
    columns = sorted(df.columns)
    sums = [F.coalesce(F.sum(F.xxhash64(F.lit(seed), *[F.col(f"`{c}`") for c in columns]).cast("decimal(38,0)")), F.lit(0).cast("decimal(38,0)")) for seed in (1, 2)]
    told = df.agg(F.count(F.lit(1)).alias("n_rows"), F.sha2(F.concat_ws("|", *[s.cast("string") for s in sums], F.count(F.lit(1)).cast("string"), F.lit("|".join(columns))), 256).alias("digest"))
    return told.select(F.lit(source).alias("SOURCE"), F.lit(str(year)).alias("RENTREE"), F.lit(size).cast("bigint").alias("bytes"),
                       F.array(*[F.lit(c) for c in columns]).cast("array<string>").alias("columns"), "n_rows", "digest")


def compare(present: DataFrame, ledger: DataFrame) -> DataFrame:
    """``present`` files with their ``state``: new, changed or same as in the ledger."""
    known = ledger.select(*PARTITIONS, F.col("digest").alias("__digest"))
    state = F.when(F.col("__digest").isNull(), "new").when(F.col("__digest") == F.col("digest"), "same").otherwise("changed")
    return present.join(F.broadcast(known), list(PARTITIONS), "left").withColumn("state", state).drop("__digest")


def land_changed(
    spark: SparkSession, landing: str, root: str, files: Sequence[tuple[str, int]], columns=RAW_COLUMNS, locate: Callable[[str, int], str] = landing_name,
) -> DataFrame:
    """Land the files (source, year) that are new or changed, in one write; the states of all files."""
    root, landing = root.rstrip("/"), landing.rstrip("/")
    ledger = read_ledger(spark, root)
    present = union_named(*[file_state(spark, f"{landing}/{locate(s, y)}", s, y) for s, y in files])
    # one row a file: the states decide what is read next
    states = spark.createDataFrame(compare(present, ledger).collect(), "SOURCE string, RENTREE string, bytes bigint, columns array<string>, n_rows bigint, digest string, state string")
    todo = [(r.SOURCE, int(r.RENTREE)) for r in states.filter("state <> 'same'").collect()]
    if todo:
        contract = raw_contract(columns)
        folder = f"land={uuid.uuid4().hex}"
        made = union_named(*[land(spark, f"{landing}/{locate(s, y)}", s, y, contract) for s, y in todo])
        made.write.partitionBy(*PARTITIONS).parquet(f"{root}/{folder}")
        entries = states.filter("state <> 'same'").drop("state").withColumn("folder", F.lit(folder))
        kept = ledger.join(F.broadcast(entries.select(*PARTITIONS)), list(PARTITIONS), "left_anti")
        commit(spark, root, kept.unionByName(entries))
    return states


def commit(spark: SparkSession, root: str, ledger: DataFrame) -> None:
    """Write a ledger aside and put it in force by one rename; two landings at once cannot both succeed."""
    number = (_ledgers(spark, root) or [0])[-1] + 1
    draft = f"{root}/_ledger/_draft-{uuid.uuid4().hex}"
    ledger.coalesce(1).write.parquet(draft)
    fs, where = _fs(spark, draft)
    goal = spark._jvm.org.apache.hadoop.fs.Path(f"{root}/_ledger/{number}")
    moved = not fs.exists(goal) and fs.rename(where, goal)
    # some file systems move a folder into one that another landing has put there meanwhile
    if not moved or fs.exists(spark._jvm.org.apache.hadoop.fs.Path(goal, where.getName())):
        raise OSError(f"ledger {number} of {root} exists already: land again")


def read_landed(spark: SparkSession, root: str, sources: Sequence[str] | None = None, years: Sequence[int] | None = None) -> DataFrame:
    """The facts that the ledger names; other folders are not even listed."""
    root = root.rstrip("/")
    rows = [r for r in read_ledger(spark, root).collect() if (sources is None or r.SOURCE in sources) and (years is None or int(r.RENTREE) in years) and r.n_rows]
    if not rows:
        raise ValueError(f"{root} holds nothing that was asked for")
    paths = [f"{root}/{r.folder}/SOURCE={r.SOURCE}/RENTREE={r.RENTREE}" for r in rows]
    parts = spark.read.option("basePath", root).parquet(*paths).drop("land")
    return parts.withColumns({p: F.col(p).cast("string") for p in PARTITIONS})
