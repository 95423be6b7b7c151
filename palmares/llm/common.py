"""Helpers of the operators: written intermediates, words, and expressions that are evaluated once."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable
from functools import reduce

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: White space that separates words, as a regular expression and as characters.
BLANKS = r"[\x20\x09-\x0D]+"
BLANK_CHARS = " \t\n\x0b\x0c\r"

#: A side of a join is broadcast by hint only when it was counted and has at most so many rows and bytes.
BROADCAST_ROWS = 100_000
BROADCAST_BYTES = 16 << 20


def shared_folder(spark: SparkSession, name: str) -> str:
    """A fresh path below ``spark.checkpoint.dir``; removed when the JVM of the session ends.

    Only a local session without that setting (tests) gets a temporary folder of this machine.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = tempfile.gettempdir() + "/palmares-work"
    path = f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"
    jvm = spark._jvm
    folder = jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(folder)
    return path


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet in the shared folder and read back: lineage ends there."""
    path = shared_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` evaluated once per row, also when ``body`` uses it inside lambdas."""
    return F.element_at(F.transform(F.array(value), body), 1)


def total(values: Column) -> Column:
    """Sum of an array of longs; 0 for an empty one."""
    return F.aggregate(values, F.lit(0).cast("long"), lambda a, x: a + x)


def words(text: Column) -> Column:
    """Words ``[^\\x20\\x09-\\x0D]+`` of a text in order; an empty array for null or blank texts."""
    core = F.btrim(F.coalesce(text, F.lit("")), F.lit(BLANK_CHARS))
    return F.when(core == "", F.array().cast("array<string>")).otherwise(F.split(core, BLANKS, -1))


def lower_ascii(text: Column) -> Column:
    """A-Z in lower case; every other character as it is."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def crc_fold(doc_id: Column) -> Column:
    """crc32 of the id as text, modulo 3; null for a null id."""
    return F.pmod(F.crc32(F.encode(doc_id.cast("string"), "utf-8")), F.lit(3))


def free_name(df: DataFrame, name: str) -> str:
    """``name``, lengthened until no column of ``df`` has it (without regard to case)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def join_labels(labels: np.ndarray, x: np.ndarray, y: np.ndarray) -> None:
    """Link the pairs of positions (x, y) in ``labels``, in place: each position has the least position of its tree."""
    while True:
        u, v = labels[x], labels[y]
        apart = u != v
        if not apart.any():
            return
        x, y, u, v = x[apart], y[apart], u[apart], v[apart]
        np.minimum.at(labels, np.maximum(u, v), np.minimum(u, v))
        while not np.array_equal(deeper := labels[labels], labels):
            labels[:] = deeper


def _row_bytes(df: DataFrame) -> Column:
    """Bytes of a row in a broadcast table: texts, arrays and maps by their length."""
    parts = [F.lit(0).cast("long")]
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.StringType, T.BinaryType)):
            parts.append(F.coalesce(F.octet_length(c), F.lit(0)) + 24)
        elif isinstance(f.dataType, (T.ArrayType, T.MapType)):
            parts.append(F.greatest(F.size(c), F.lit(0)) * (8 if f.dataType == T.ArrayType(T.DoubleType()) else 96) + 24)
        else:
            parts.append(F.lit(16))
    return reduce(lambda a, b: a + b, parts)


def small(df: DataFrame) -> DataFrame:
    """``df`` (a written table) with a broadcast hint if its counted rows and their measured bytes allow it."""
    rows, size = df.agg(F.count("*"), F.coalesce(F.sum(_row_bytes(df)), F.lit(0))).first()
    return F.broadcast(df) if rows <= BROADCAST_ROWS and size <= BROADCAST_BYTES else df


#: Keys with at least a share of 1 / HOT_KEYS of all rows, of which there are HOT_KEYS at the most.
HOT_KEYS = 256


def join_hot(rows: DataFrame, per_key: DataFrame, key: str, weight: str) -> DataFrame:
    """Inner join of ``rows`` with ``per_key`` (written; unique, non-null keys; ``weight``: rows of each) in which no task meets a hot key.

    The at most ``HOT_KEYS`` keys that weigh most are broadcast; no key that is left for the shuffle has a larger share.
    """
    total = per_key.agg(F.sum(weight)).first()[0] or 0
    hot = per_key.where(F.col(weight) * HOT_KEYS >= total)
    rest = rows.join(F.broadcast(hot.select(key)), key, "left_anti")
    return rows.join(F.broadcast(hot), key).unionByName(rest.join(per_key, key))
