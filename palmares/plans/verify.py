"""Verification job: what the corrected facts hold, per source, next to the reference tables."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, functions as F, types as T

from ..functions.nulls import norm_text
from ..functions.scalars import zero_pad
from ..operators.quality import distinct_combos, distinct_rows, project_sorted
from ..operators.schema import sort_columns, upper_names
from ..sources.contracts import has_intermediate

# Columns compared.
COMBO_COLUMNS = ("SOURCE", "RESDIP", "RESINT", "TYP_DIPL", "TYP_DIPINT", "NIVEAU", "CURSUS_LMDR", "CURSUS_LMD_INT")
ENTITY_COLUMNS = (
    "ID_PAYSAGE", "ID_PAYSAGE_ACTUEL", "UO_LIB", "TYPE", "TYPOLOGIE_D_UNIVERSITES_ET_ASSIMILES", "ANCIENS_CODES_UAI",
    "IDENTIFIANT_WIKIDATA", "IDENTIFIANT_ROR", "COM_CODE",
)


def reread(df: DataFrame) -> DataFrame:
    """Clean text, padded degree types, no duplicate row, sorted columns."""
    df = upper_names(df)
    out = {f.name: norm_text(f.name, tokens=("nan",), missing="") for f in df.schema.fields
           if isinstance(f.dataType, T.StringType)}
    for col in ("TYP_DIPL", "TYP_DIPR", "TYP_DIPINT"):
        if col in df.columns:
            text = F.coalesce(out[col], F.lit(""))
            out[col] = zero_pad(F.when(text == "None", F.lit("")).otherwise(text))
    return sort_columns(distinct_rows(df.withColumns(out)))


def combinations(df: DataFrame) -> DataFrame:
    """Distinct outcomes, degree types, levels, cycles and entity IDs of each source.

    All sources in one pass; intermediate columns are NULL where the source has none. The
    projection precedes the de-duplication, so only these columns are read and shuffled.
    """
    for col in ("TYP_DIPINT", "CURSUS_LMD_INT"):
        df = df.withColumn(col, F.when(has_intermediate(), F.col(col)))
    return distinct_combos(df, "PAYSAGE", COMBO_COLUMNS)


def entities(sheets: Mapping[str, DataFrame]) -> DataFrame:
    return project_sorted(sheets["C_ETABLISSEMENTS"], ENTITY_COLUMNS)
