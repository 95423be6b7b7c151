"""Type contracts of the facts, stated as rules.

Every code is text. The few numeric columns are bigint, whatever the file says; files of
different years disagree on some of them, and one type per column is what lets all years
live in one partitioned table.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, functions as F, types as T

# Numeric columns of the raw and of the corrected facts.
RAW_INTS = ("ANBAC", "ANETAB", "ANINSC", "ANNAIS", "DUREE", "DUREER", "DUREER2", "EFFECTIF", "FLAG_EPE", "NBACH", "NET")
COUNTRY_FLAGS = ("UE_27", "UE_28", "UE_EURO", "OCDE_MEMBRES", "OCDE_OBS", "BOLOGNE", "BRICS")
CORRECTED_INTS = ("FLAG_EPE", "NBACH", "NET", "EFFECTIF_R", "EFFECTIF_INT", "EFFECTIF_TOT", *COUNTRY_FLAGS)

# Raw columns the cleaning reads.
RAW_COLUMNS = (
    "ACABAC", "ACARESPA", "ANBAC", "ANINSC", "ANNAIS", "BAC", "BAC_RGRP", "COMPOS", "COMPOSR", "CONV", "CURSUS_LMD",
    "CURSUS_LMDR", "CYCLE", "CYCLER", "DEPBAC", "DEPRESPA", "DIPDER", "DIPINT", "DIPLOM", "DIPLOMR", "DISCIPLI",
    "DISCIPLINT", "DISCIPLR", "ETABLI", "ETABLI_DIFFUSION", "ETATINS", "FLAG_DIP", "FLAG_MEEF", "FLAG_RES",
    "FR_ETR", "GROUPE", "GROUPER", "GROUPINT", "IDETU", "IDETU1", "NATION", "NBACH", "NET", "NIVEAU", "NIVEAUR",
    "NUMED", "PAYS_MOBPCO", "PCSPAR", "PCSPAR2", "REGIME", "RESDIP", "RESINT", "SECTDIS", "SECTDISR", "SECTINT",
    "SEXE", "SITUPRE", "TYPE_MOBPCO", "TYP_DIPINT", "TYP_DIPL", "TYP_DIPR", "VOIE", "VOIER",
)

# Sources whose files carry an intermediate degree.
INTERMEDIATE_SOURCES = ("result", "ens", "inge", "priv")

# Column of the facts that tells which columns the file of a row had, one bit for each of RAW_COLUMNS by its place
# there. In one table over all sources an absent column is a NULL like any other, so rules that mean "column absent"
# read it. It is one number a file: stored it takes next to nothing, and a test is one operation on a long.
FILE_COLUMNS = "FILE_COLUMNS"


def contract(columns: Iterable[str], ints: Iterable[str] = RAW_INTS) -> T.StructType:
    ints = set(ints)
    return T.StructType([T.StructField(c, T.LongType() if c in ints else T.StringType()) for c in columns])


def raw_contract(columns: Iterable[str] = RAW_COLUMNS) -> T.StructType:
    return contract(columns, RAW_INTS)


def has_intermediate(source: str = "SOURCE") -> Column:
    """Does the row come from a source with intermediate degrees?"""
    return F.coalesce(F.col(source).isin(*INTERMEDIATE_SOURCES), F.lit(False))


def column_bit(col: str) -> int:
    """The bit of a raw column in FILE_COLUMNS."""
    if col not in RAW_COLUMNS:
        raise ValueError(f"{col} is no raw column: its presence is not noted")
    return 1 << RAW_COLUMNS.index(col)


def columns_mask(columns: Iterable[str]) -> int:
    """The bits of all raw columns among ``columns``."""
    return sum(column_bit(c) for c in set(columns) & set(RAW_COLUMNS))


def with_file_columns(df: DataFrame) -> DataFrame:
    """Note the columns of a file on its rows; facts that have the note keep it."""
    if FILE_COLUMNS in df.columns:
        return df
    return df.withColumn(FILE_COLUMNS, F.lit(columns_mask(df.columns)).cast("bigint"))


def file_has(col: str) -> Column:
    """Did the file of the row have this column?"""
    return F.coalesce(F.col(FILE_COLUMNS).bitwiseAND(F.lit(column_bit(col)).cast("bigint")) != 0, F.lit(False))
