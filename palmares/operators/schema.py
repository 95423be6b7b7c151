"""Projection, naming and type operators."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping

from pyspark.sql import Column, DataFrame, functions as F, types as T

from ..functions.nulls import cut_at, norm_text
from ..functions.scalars import academic_year, session


def _unique(names: Iterable[str]) -> list[str]:
    names = list(names)
    seen: dict[str, str] = {}
    for n in names:
        if n.lower() in seen:
            raise ValueError(f"columns {seen[n.lower()]!r} and {n!r} differ only by case")
        seen[n.lower()] = n
    return names


def upper_names(df: DataFrame) -> DataFrame:
    return df.toDF(*_unique(c.upper() for c in df.columns))


def sort_columns(df: DataFrame) -> DataFrame:
    return df.select(*sorted(df.columns))


def cast_present(df: DataFrame, types: Mapping[str, str], strict: bool = False) -> DataFrame:
    """Cast the listed columns that exist; ``strict`` fails on a value that does not fit."""
    have = {c: t for c, t in types.items() if c in df.columns}
    if not have:
        return df
    return df.withColumns({c: (F.col(c).cast(t) if strict else F.col(c).try_cast(t)) for c, t in have.items()})


def conform(df: DataFrame, contract: T.StructType, strict: bool = False, keep_extra: bool = True) -> DataFrame:
    """Apply a type contract: cast what exists, add what is absent as a typed NULL.

    Columns outside the contract pass through unless ``keep_extra`` is off.
    """
    have = set(df.columns)
    out: list[Column] = []
    for f in contract.fields:
        if f.name not in have:
            out.append(F.lit(None).cast(f.dataType).alias(f.name))
        else:
            c = F.col(f.name)
            out.append((c.cast(f.dataType) if strict else c.try_cast(f.dataType)).alias(f.name))
    if keep_extra:
        named = set(contract.fieldNames())
        out += [F.col(c) for c in df.columns if c not in named]
    return df.select(*out)


def flag_text(df: DataFrame, col: str) -> DataFrame:
    """A flag column as text, cut at ``.0``; no change when it is absent."""
    return df.withColumn(col, cut_at(F.col(col).cast("string"))) if col in df.columns else df


def rename_present(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """Rename the columns that exist; a target that already exists is filled, not duplicated."""
    for old, new in mapping.items():
        if old not in df.columns:
            continue
        if new in df.columns:
            df = df.withColumn(new, F.coalesce(F.col(new), F.col(old))).drop(old)
        else:
            df = df.withColumnRenamed(old, new)
    return df


def swap_columns(df: DataFrame, mapping: Mapping[str, str], drop: Iterable[str]) -> DataFrame:
    """Drop one set of columns and let another set take their names, in one projection."""
    gone = set(drop)
    kept = [c for c in df.columns if c not in gone]
    names = _unique(mapping.get(c, c) for c in kept)
    return df.select(*[F.col(c).alias(n) for c, n in zip(kept, names)])


def beside(df: DataFrame, columns: Iterable[str], step: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """``step`` over ``columns`` (those that exist); the others pass it as one value.

    A lookup copies every column of its rows. In a chain of lookups over wide rows that copying is most of the work;
    columns that the chain neither reads nor writes go into one struct, which is copied as a block.
    """
    wanted = set(columns)
    rest = [c for c in df.columns if c not in wanted]
    if len(rest) < 2:
        return step(df)
    out = step(df.select(*[c for c in df.columns if c in wanted], F.struct(*rest).alias("__rest")))
    made = [c for c in out.columns if c != "__rest"]
    clash = sorted(set(made) & set(rest))
    if clash:
        raise ValueError(f"the step would duplicate columns {clash}")
    kept = [c for c in df.columns if c in rest or c in made]
    names = [*kept, *[c for c in made if c not in kept]]
    return out.select(*[F.col("__rest").getField(c).alias(c) if c in rest else F.col(c) for c in names])


def add_defaults(df: DataFrame, defaults: Mapping[str, object]) -> DataFrame:
    """Add absent columns with a constant; existing ones are left alone."""
    new = {c: F.lit(v) for c, v in defaults.items() if c not in df.columns}
    return df.withColumns(new) if new else df


def add_nulls(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    new = {c: F.lit(None).cast(t) for c, t in types.items() if c not in df.columns}
    return df.withColumns(new) if new else df


def with_provenance(df: DataFrame, year: str = "RENTREE") -> DataFrame:
    """Academic year and session labels from the year of the partition."""
    return df.withColumns({"ANNEE_UNIVERSITAIRE": academic_year(year), "SESSION": session(year)})


def align(df: DataFrame, model: Iterable[str], add_missing: bool = False, dtype: str = "string") -> DataFrame:
    """Keep only the model's columns; ``add_missing`` adds the absent ones as NULL."""
    have = set(df.columns)
    out = []
    for c in model:
        if c in have:
            out.append(F.col(c))
        elif add_missing:
            out.append(F.lit(None).cast(dtype).alias(c))
    return df.select(*out)


def alias_columns(df: DataFrame, copies: Mapping[str, str]) -> DataFrame:
    """Add copies: ``{new: existing}``."""
    return df.withColumns({new: F.col(old) for new, old in copies.items()})


def finalise_types(
    df: DataFrame,
    text: Iterable[str] = (),
    zero_ints: Iterable[str] = (),
    ints: Iterable[str] = (),
) -> DataFrame:
    """End-of-cleaning harmonisation in one projection.

    ``text``: to text, cut at the first dot, whole-cell tokens to ``''``. ``zero_ints``:
    to bigint, NULL to 0. ``ints``: to bigint. Every text NULL ends as ``''``.
    """
    text, zero_ints, ints = set(text), set(zero_ints), set(ints)
    out = []
    for f in df.schema.fields:
        c = F.col(f.name)
        if f.name in text:
            c = F.coalesce(norm_text(c.cast("string"), cut=".", missing=""), F.lit(""))
        elif f.name in zero_ints:
            c = F.coalesce(c.try_cast("bigint"), F.lit(0).cast("bigint"))
        elif f.name in ints:
            c = c.try_cast("bigint")
        elif isinstance(f.dataType, T.StringType):
            c = F.coalesce(c, F.lit(""))
        out.append(c.alias(f.name))
    return df.select(*out)


def relabel(df: DataFrame, labels: Mapping[str, str]) -> DataFrame:
    """Rename all at once, by position: a label may equal another source name ignoring case."""
    return df.toDF(*_unique(labels.get(c, c) for c in df.columns))


def pick(df: DataFrame, cols: Iterable[str], optional: Iterable[str] = ()) -> DataFrame:
    have = set(df.columns)
    return df.select(*cols, *[c for c in optional if c in have])


def columns_like(df: DataFrame, pattern: str) -> list[str]:
    return [c for c in df.columns if pattern in c]
