"""Left lookups into dimensions.

A lookup never changes the row count. Its physical form depends on the checked size of
the dimension: small ones are broadcast; larger ones are joined by a shuffle, whose heavy
fact keys adaptive execution spreads over several tasks. The uniqueness of the dimension
key is enforced inside the plan by a filter that no pruning of columns removes, so a
duplicate fails with its key even if only fact columns are read. ``stored`` writes a
dimension once: lookups into it neither count it nor work it out again.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F, types as T

from ..functions.nulls import is_blank
from ..session import work_dir

# A dimension is broadcast only when it has at most this many bytes.
BROADCAST_BYTES = 16 * 1024 * 1024


def estimated_bytes(df: DataFrame) -> int:
    """Size estimate of Catalyst for the plan: file sizes at the leaves, never a row sample."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


# Bytes of the rows of the tables that ``stored`` wrote, by folder.
_STORED: dict[str, int] = {}


def stored(df: DataFrame, name: str, keys: Sequence[str] = ()) -> DataFrame:
    """``df`` written once to a work folder and read back; the bytes of its rows are measured on the way.

    With ``keys`` nothing is written that holds two rows under one key: the write fails.
    """
    spark = df.sparkSession
    if keys:
        df = assert_unique(df, keys)
    folder = work_dir(spark, name)
    size = Observation(name)
    df.observe(size, F.coalesce(F.sum(_row_bytes(df.schema)), F.lit(0)).alias("bytes")).write.parquet(folder)
    _STORED[folder.rstrip("/").rsplit("/", 1)[-1]] = size.get["bytes"]
    return spark.read.schema(df.schema).parquet(folder)


def size_is_known(df: DataFrame) -> bool:
    """Is the table local rows or files that are only filtered and projected?"""
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    return not any(node in plan for node in ("Generate", "Join", "Aggregate", "Union", "Expand", "Window"))


def checked_bytes(df: DataFrame) -> int:
    """Size of a table that may be broadcast: measured for a stored one, the estimate where it holds, else its counted rows.

    An estimate holds for local rows and for files that are only filtered and projected; files count
    fourfold, for they are compressed. Past an explode, join, union or aggregate it says little, so
    the rows are counted.
    """
    if size_is_known(df):
        folders = {f.rsplit("/", 2)[-2] for f in df.inputFiles()}
        if folders and folders <= _STORED.keys():
            return sum(_STORED[f] for f in folders)
        return estimated_bytes(df) * (4 if folders else 1)
    return df.count() * sum(_width(f.dataType) for f in df.schema.fields)


def _row_bytes(schema: T.StructType) -> Column:
    """Bytes a row takes in a broadcast table: texts and arrays by their length, everything else by its type."""
    parts = [F.lit(0).cast("bigint")]
    for f in schema.fields:
        c = F.col(_quoted(f.name))
        if isinstance(f.dataType, T.StringType):
            parts.append(F.coalesce(F.octet_length(c), F.lit(0)) + 24)
        elif isinstance(f.dataType, T.ArrayType):
            parts.append(F.greatest(F.size(c), F.lit(0)) * 128 + 24)
        else:
            parts.append(F.lit(_width(f.dataType)))
    return reduce(lambda a, b: a + b, parts)


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _width(kind: T.DataType) -> int:
    """Bytes a value takes in a broadcast table, on the generous side."""
    return 48 if isinstance(kind, T.StringType) else 16 if isinstance(kind, T.AtomicType) else 256


def small_table(spark: SparkSession, rows: Sequence[Sequence], schema: T.StructType | str) -> DataFrame:
    """Rows of the driver as a local relation, whose size the optimiser knows.

    A table made from plain rows has no statistics and would count as huge.
    """
    from pyspark.sql.pandas.types import to_arrow_schema

    schema = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    columns = list(zip(*rows)) if rows else [[] for _ in schema.fields]
    arrow = to_arrow_schema(schema)
    arrays = [pa.array(list(c), type=f.type) for c, f in zip(columns, arrow)]
    return spark.createDataFrame(pa.Table.from_arrays(arrays, schema=arrow), schema=schema)


def bounded(df: DataFrame, limit: int | None = None) -> DataFrame:
    """Hint a broadcast only when the checked size allows it; else leave the choice to Spark."""
    limit = BROADCAST_BYTES if limit is None else limit
    return F.broadcast(df) if checked_bytes(df) <= limit else df


def assert_unique(dim: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Exact duplicates collapse; two different rows under one key fail, whatever columns of the join are read.

    The test is a filter over the grouped rows: a projected value would vanish with its column. The values pass an
    ``inline`` of one row, past which the optimiser cannot tell that keys are unique: it would drop a left join whose
    values nobody reads, and the test with it. (It still does so below a ``distinct`` of fact columns alone.)
    """
    values = [c for c in dim.columns if c not in keys]
    if not values:
        return dim.distinct()
    row = F.struct(*values)
    grouped = dim.groupBy(*keys).agg(F.min(row).alias("__lo"), F.max(row).alias("__hi"))
    return enforced(grouped, keys, F.col("__lo").eqNullSafe(F.col("__hi")), F.col("__lo"))


def enforced(grouped: DataFrame, keys: Sequence[str], sound: Column, row: Column) -> DataFrame:
    """The keys and the fields of ``row``; a key for which ``sound`` does not hold fails with its name."""
    message = F.concat(F.lit("lookup key with several values: "), F.to_json(F.struct(*keys)))
    single = F.when(sound, F.lit(True)).otherwise(F.raise_error(message).cast("boolean"))
    return grouped.filter(single).select(*keys, F.inline(F.array(row)))


def left_lookup(
    df: DataFrame,
    dim: DataFrame,
    on: str | Sequence[str] | Mapping[str, str],
    cols: Sequence[str] | Mapping[str, str],
    *,
    unique: str = "check",
    null_safe: bool = False,
    limit: int | None = None,
) -> DataFrame:
    """Add dimension columns to the fact.

    ``on``: key names, or ``{fact column: dimension column}``. ``cols``: names, or
    ``{dimension column: new name}``. ``unique``: ``check`` fails on a key with several
    values, ``trust`` skips that check for a declared key, ``fanout`` allows several
    matches. ``null_safe`` lets a NULL key meet a NULL key.
    """
    if isinstance(on, str):
        on = [on]
    pairs = dict(on) if isinstance(on, Mapping) else {k: k for k in on}
    outs = dict(cols) if isinstance(cols, Mapping) else {c: c for c in cols}
    clash = [c for c in outs.values() if c in df.columns]
    if clash:
        raise ValueError(f"lookup would duplicate columns {clash}")
    if unique not in ("check", "trust", "fanout"):
        raise ValueError(f"unknown uniqueness policy {unique!r}")
    keys = list(pairs)
    dim_keys = [f"__k{i}" for i in range(len(keys))]
    side = dim.select(
        *[F.col(d).alias(k) for d, k in zip(pairs.values(), dim_keys)],
        *[F.col(c).alias(n) for c, n in outs.items()],
    )
    small = checked_bytes(side) <= (BROADCAST_BYTES if limit is None else limit)
    if unique == "check":
        side = assert_unique(side, dim_keys)
    cond = reduce(
        lambda a, b: a & b,
        [F.col(k).eqNullSafe(F.col(d)) if null_safe else F.col(k) == F.col(d) for k, d in zip(keys, dim_keys)],
    )
    return df.join(F.broadcast(side) if small else side.hint("merge"), cond, "left").drop(*dim_keys)


def co_located(df: DataFrame, key: str, name: str, buckets: int) -> DataFrame:
    """``df`` saved in ``buckets`` buckets of ``key``, sorted, in a work folder, and read back as a table of the session.

    Tables with the same number of buckets of one key lie together: several large lookups on that key then cost no
    shuffle of the facts, and grouping a dimension by its key costs none either.
    """
    table = f"{name}_{uuid.uuid4().hex}"
    df.repartition(buckets, key).write.bucketBy(buckets, key).sortBy(key).format("parquet").option("path", work_dir(df.sparkSession, table)).saveAsTable(table)
    return df.sparkSession.table(table)


def co_located_lookup(df: DataFrame, dim: DataFrame, on: Mapping[str, str], cols: Sequence[str] | Mapping[str, str], **how) -> DataFrame:
    """``left_lookup`` between tables that ``co_located`` saved by their keys: never broadcast, so the buckets are met."""
    return left_lookup(df, dim, on, cols, limit=-1, **how)


def coalesced_lookup(df: DataFrame, dim: DataFrame, on, col: str, target: str, fallback: str, **how) -> DataFrame:
    """Lookup into ``target``; a blank result takes the value of ``fallback``."""
    found = left_lookup(df, dim, on, {col: "__found"}, **how)
    value = F.when(is_blank("__found"), F.col(fallback)).otherwise(F.col("__found"))
    return found.withColumn(target, value).drop("__found")


def tiered_lookup(
    df: DataFrame, dim: DataFrame, on: Sequence[str], col: str, tier: str, tiers: Sequence[str], **how
) -> DataFrame:
    """First tier that knows the key wins: one join, with the tiers laid side by side first."""
    on = list(on)
    side = dim.filter(F.col(tier).isin(*tiers)).select(*on, tier, col)
    side = assert_unique(side, [*on, tier])
    wide = side.groupBy(*on).agg(*[F.max(F.when(F.col(tier) == t, F.col(col))).alias(f"__t{i}") for i, t in enumerate(tiers)])
    best = wide.select(*on, F.coalesce(*[F.col(f"__t{i}") for i in range(len(tiers))]).alias(col))
    how.setdefault("unique", "trust")
    return left_lookup(df, best, on, [col], **how)


def role_lookup(df: DataFrame, dim: DataFrame, roles: Sequence[tuple], **how) -> DataFrame:
    """One dimension in several roles: each role is ``(on, cols)`` of a lookup."""
    for on, cols in roles:
        df = left_lookup(df, dim, on, cols, **how)
    return df


def country_lookup(df: DataFrame, dim: DataFrame, nation: str = "NATION", key: str = "PAYS",
                   labels: Sequence[str] = ("CONTINENT",), flags: Sequence[str] = (), unknown: str = "999", **how) -> DataFrame:
    """Country attributes: codes outside the list become ``unknown``, flags become integers.

    The membership test and the attributes share one join; the attributes of the unknown
    member itself, if the list has one, come from a second, one-row lookup.
    """
    marked = left_lookup(df, dim.withColumn("__in", F.lit(True)), {nation: key}, {"__in": "__in"}, **how)
    marked = marked.withColumn(nation, F.when(F.col("__in").isNull(), F.lit(unknown)).otherwise(F.col(nation))).drop("__in")
    out = left_lookup(marked, dim, {nation: key}, [*labels, *flags], **how)
    return out.withColumns({f: F.col(f).try_cast("bigint") for f in flags}) if flags else out


def star_join(df: DataFrame, specs: Sequence[tuple], **how) -> DataFrame:
    """A chain of lookups: each spec is ``(dimension, on, cols)``."""
    for dim, on, cols in specs:
        df = left_lookup(df, dim, on, cols, **how)
    return df


def conflicts(dim: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """Keys that lead to more than one value, with the number of distinct values."""
    pairs = dim.select(*keys, value).distinct()
    return pairs.groupBy(*keys).agg(F.count(value).alias("n_values")).filter(F.col("n_values") > 1)


def check_unique(dim: DataFrame, keys: Sequence[str], value: str, show: int = 5) -> DataFrame:
    """Fail with a few offending keys, else return the dimension unchanged."""
    bad = conflicts(dim, keys, value).limit(show).collect()
    if bad:
        raise ValueError(f"keys with several {value}: {[tuple(r)[:-1] for r in bad]}")
    return dim
