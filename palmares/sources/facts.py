"""Parquet facts, partitioned by source and entry year."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from ..functions.nulls import norm_text
from ..operators.schema import conform, sort_columns, upper_names
from .contracts import with_file_columns

PARTITIONS = ("SOURCE", "RENTREE")


def normalise_landing(df: DataFrame) -> DataFrame:
    """A freshly decoded file: upper-case sorted names, whole floats as integers, clean text."""
    df = sort_columns(upper_names(df))
    out = []
    for f in df.schema.fields:
        c = F.col(f.name)
        if isinstance(f.dataType, (T.FloatType, T.DoubleType)):
            c = c.cast("bigint")
        elif isinstance(f.dataType, T.StringType):
            c = norm_text(c, tokens=("nan",), missing="")
        out.append(c.alias(f.name))
    return df.select(*out)


def land(spark: SparkSession, path: str, source: str, year: int, contract: T.StructType) -> DataFrame:
    """One landed file, normalised, brought to the common contract and tagged, with the names of its own columns."""
    df = conform(with_file_columns(normalise_landing(spark.read.parquet(path))), contract)
    return df.withColumns({"SOURCE": F.lit(source), "RENTREE": F.lit(str(year))})


def read_fact(
    spark: SparkSession,
    root: str,
    sources: Iterable[str] | None = None,
    years: Iterable[int] | None = None,
    contract: T.StructType | None = None,
    partitions: Sequence[str] = PARTITIONS,
) -> DataFrame:
    """Read partitions of a fact; both filters are on partition columns, so other folders are not listed.

    With a ``contract`` the schema is given, not inferred, and partition values stay text.
    """
    source_col, year_col = partitions
    reader = spark.read
    if contract is not None:
        schema = T.StructType([f for f in contract.fields if f.name not in partitions])
        for p in partitions:
            schema = schema.add(p, T.StringType())
        reader = reader.schema(schema)
    df = reader.parquet(root)
    if sources is not None:
        df = df.filter(F.col(source_col).isin(*sources))
    if years is not None:
        text = isinstance(df.schema[year_col].dataType, T.StringType)
        df = df.filter(F.col(year_col).isin(*[str(y) if text else int(y) for y in years]))
    return df.withColumns({p: F.col(p).cast("string") for p in partitions if dict(df.dtypes)[p] != "string"})


def write_fact(df: DataFrame, root: str, partitions: Sequence[str] = PARTITIONS, rebalance: bool = False) -> None:
    """Replace exactly the partitions present in ``df``.

    ``rebalance`` evens out file sizes with a shuffle that splits heavy partitions; without
    it every task writes the partitions it already holds.
    """
    if rebalance:
        df = df.hint("rebalance", *[F.col(p) for p in partitions])
    (df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
       .partitionBy(*partitions).parquet(root))
