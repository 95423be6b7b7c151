"""Published tables: semicolon-separated UTF-8 text with a header."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

# The published dialect. Blanks at the ends of a cell are part of it.
FORMAT = {
    "sep": ";", "encoding": "UTF-8", "quote": '"', "escape": '"',
    "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False,
}


def write_open_csv(df: DataFrame, path: str, year: str | None = None) -> None:
    """Write part files, each with a header; NULL is empty and quotes are doubled.

    With ``year``, each year gets its own sub-folder (the column stays in the files too),
    so one job yields both the yearly tables and, read from the root, the whole table. Rows are brought
    together by year first, heavy years in several parts: not every task writes a file into every folder.
    """
    writer = df
    if year is not None:
        writer = df.withColumn("year_folder", F.col(year)).hint("rebalance", "year_folder")
    out = writer.write.mode("overwrite").options(header=True, nullValue="", emptyValue="", **FORMAT)
    if year is not None:
        out = out.option("partitionOverwriteMode", "dynamic").partitionBy("year_folder")
    out.csv(path)


def write_year_files(df: DataFrame, path: str, year: str) -> list[str]:
    """One CSV a year, ``<path>/<year>.csv`` with one header, however many tasks wrote it; the names of the files.

    Tasks write their parts in parallel, without headers, and the file system joins them: by moving blocks where it
    can (``concat``), else by a stream of fixed size. Nothing is gathered into one task or held whole.
    """
    spark = df.sparkSession
    folder = f"{path.rstrip('/')}/_parts-{uuid.uuid4().hex}"
    parts = df.withColumn("year_folder", F.coalesce(F.col(year).cast("string"), F.lit("")))
    # at most a few files a year: a heavy year is split, a light one is not
    parts.hint("rebalance", "year_folder").write.options(header=False, nullValue="", emptyValue="", **FORMAT).partitionBy("year_folder").csv(folder)
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    top = jvm.org.apache.hadoop.fs.Path(folder)
    fs = top.getFileSystem(conf)
    written = []
    for status in fs.listStatus(top):
        name = status.getPath().getName()
        if name.startswith("year_folder="):
            files = sorted(f.getPath().toString() for f in fs.listStatus(status.getPath()) if f.getPath().getName().startswith("part-"))
            target = f"{path.rstrip('/')}/{name.removeprefix('year_folder=')}.csv"
            join_files(spark, files, target, ";".join(_cell(c) for c in df.columns) + "\n")
            written.append(target)
    fs.delete(top, True)
    return sorted(written)


def _cell(text: str) -> str:
    return '"' + text.replace('"', '""') + '"' if any(c in text for c in ';"\r\n') else text


def join_files(spark: SparkSession, files: Sequence[str], target: str, head: str = "", foot: str = "") -> None:
    """``head``, the files in order and ``foot`` as one file, which appears whole or not at all. The files may be moved into it."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    path = jvm.org.apache.hadoop.fs.Path
    goal, draft = path(target), path(f"{target}.{uuid.uuid4().hex}.tmp")
    fs = goal.getFileSystem(conf)
    out = fs.create(draft)
    out.write(bytearray(head.encode("utf-8")))
    moved = False
    if fs.getScheme() == "hdfs" and not foot and files:
        out.close()
        sources = spark.sparkContext._gateway.new_array(path, len(files))
        for i, f in enumerate(files):
            sources[i] = path(f)
        fs.concat(draft, sources)
        moved = True
    if not moved:
        for f in files:
            part = fs.open(path(f))
            jvm.org.apache.hadoop.io.IOUtils.copyBytes(part, out, 1 << 20, False)
            part.close()
        out.write(bytearray(foot.encode("utf-8")))
        out.close()
    fs.delete(goal, False)
    if not fs.rename(draft, goal):
        raise OSError(f"cannot put {target} in place")


def read_open_csv(spark: SparkSession, path: str) -> DataFrame:
    """Read it back, all text, empty cells as NULL. No schema inference pass."""
    return spark.read.options(header=True, **FORMAT).csv(path).drop("year_folder")
