"""Derived indicators: headcounts, degree groups, lateness, proximity, mobility.

Each derivation reads one snapshot of the row and writes its columns in one projection;
an ordered list of overrides becomes one flat CASE with the last override first.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.nulls import as_col, holds, is_blank, pd_ne
from ..functions.scalars import diff_int


def last_wins(base: Column, steps: Sequence[tuple[Column, object]]) -> Column:
    """Ordered overrides that all read the same snapshot: the last true one gives the value."""
    case = None
    for cond, value in reversed(steps):
        value = value if isinstance(value, Column) else F.lit(value)
        case = F.when(cond, value) if case is None else case.when(cond, value)
    return base if case is None else case.otherwise(base)


def headcount(c: Column | str, yes: Sequence[str] = ("O", "1")) -> Column:
    """1 for an awarded degree, else 0."""
    return F.when(as_col(c).isin(*yes), F.lit(1)).otherwise(F.lit(0)).cast("bigint")


def total_headcount(df: DataFrame, final: str = "EFFECTIF_R", inter: str = "EFFECTIF_INT", out: str = "EFFECTIF_TOT") -> DataFrame:
    """Sum of both headcounts; the final one alone where there is no intermediate column."""
    value = F.col(final) if inter not in df.columns else F.col(final) + F.col(inter)
    return df.withColumn(out, value)


def default_group(df: DataFrame, cols: Sequence[str], value: str = "AUTRES") -> DataFrame:
    return df.withColumns({c: F.when(is_blank(c), F.lit(value)).otherwise(F.col(c)) for c in cols})


# Degrees outside the grouping, and degrees that form a group of their own.
UNGROUPED_DEGREES = ("6001000", "6004000", "8000010")
REBOND_DEGREES = ("9610007", "9610070", "9610171", "9610062", "9610006")
PAREO_DEGREES = (
    "9630001", "9630067", "9630123", "9630127", "9630133", "9630162", "9630163", "9630166", "9630167",
    "9630170", "9630190",
)
OTHER_MASTERS = (
    "2212622", "2212634", "2215257", "2215267", "2215490", "2215491", "2215493", "2215496", "2216535",
    "2216536", "2216986", "2216988", "2216989", "2217038", "2217039",
)
HEALTH_ACCESS_PATH = "0001291"


def degree_group(df: DataFrame, has_intermediate: Column | None = None, other: str = "AUTRES") -> DataFrame:
    """Fine degree groups LMDDONT / LMDDONTBIS, and their intermediate roles where they apply."""
    degree, kind, path = F.col("DIPLOM"), F.col("TYP_DIPL"), F.col("PAR_TYPE")
    out_of_scope = degree.isin(*UNGROUPED_DEGREES)

    def filled(col: str, steps: list) -> Column:
        kept = F.when(is_blank(col), F.lit(other)).otherwise(F.col(col))
        return last_wins(kept, [(out_of_scope, other), *steps])

    out = {
        "LMDDONT": filled("LMDDONT", []),
        "LMDDONTBIS": filled("LMDDONTBIS", [
            (F.col("DNDU") == "DU", "DU"),
            ((kind == "XA") & (path == HEALTH_ACCESS_PATH), "LIC_L_LAS"),
            ((kind == "XA") & pd_ne(path, HEALTH_ACCESS_PATH), "LIC_L_AUT"),
            ((kind == "61") & degree.isin(*REBOND_DEGREES), "REBOND"),
            ((kind == "63") & degree.isin(*PAREO_DEGREES), "PAREO"),
            ((kind == "XC") & degree.isin(*OTHER_MASTERS), "MAS_AUT"),
        ]),
    }
    if "TYP_DIPINT" in df.columns:
        applies = F.lit(True) if has_intermediate is None else has_intermediate
        for col, steps in (("LMDDONT_INT", []), ("LMDDONTBIS_INT", [(F.col("DNDU_INT") == "DU", "DU")])):
            out[col] = F.when(applies, filled(col, steps)).otherwise(F.col(col))
    return df.withColumns(out)


def late_early(df: DataFrame) -> DataFrame:
    """Age at the baccalaureate and the late / early flags (O, N, or X when not applicable).

    Two regimes: entry years up to 2011 treat group 6 with its own thresholds; later
    years treat all groups alike. Comparisons with an unknown age are unknown, so they
    set neither O nor N. Columns RETARD and AVANCE are created when absent.
    """
    group = F.when(is_blank("BAC_RGRP") & F.col("BAC").isin("0031", "0032"), F.lit("7")).otherwise(F.col("BAC_RGRP"))
    known = F.col("ANBAC").isNotNull()
    computed = diff_int("ANBAC", "ANNAIS")
    age = F.when(known, computed).otherwise(F.col("AGE_BAC")) if "AGE_BAC" in df.columns else F.when(known, computed)
    df = df.withColumns({"BAC_RGRP": group, "AGE_BAC": age})

    a, g, year = F.col("AGE_BAC"), F.col("BAC_RGRP"), F.col("RENTREE").cast("int")
    early_regime, late_regime = year < 2012, year > 2011
    general = g.isin("1", "2", "3", "4", "5")
    counted = g.isin("1", "2", "3", "4", "5", "6", "A")
    six = g == "6"
    no_age_old = early_regime & (~known | holds(g.isin("7", "9")))
    no_age_new = late_regime & (~known | ~holds(counted))
    old = {c: F.col(c) if c in df.columns else F.lit(None).cast("string") for c in ("RETARD", "AVANCE")}
    late = last_wins(old["RETARD"], [
        (early_regime & general & (a > 18), "O"),
        (early_regime & general & (a <= 18), "N"),
        (early_regime & six & (a > 19), "O"),
        (early_regime & six & (a < 20), "N"),
        (no_age_old, "X"),
        (late_regime & counted & (a > 18), "O"),
        (late_regime & counted & (a <= 18), "N"),
        (no_age_new, "X"),
    ])
    early = last_wins(old["AVANCE"], [
        (early_regime & general & (a < 18), "O"),
        (early_regime & general & (a >= 18), "N"),
        (early_regime & six & (a <= 18), "O"),
        (early_regime & six & (a > 18), "N"),
        (no_age_old, "X"),
        (late_regime & counted & (a < 18), "O"),
        (late_regime & counted & (a >= 18), "N"),
        (no_age_new, "X"),
    ])
    group_after = F.when((g == "9") & ~known, F.lit("7")).otherwise(g)
    return df.withColumns({"RETARD": late, "AVANCE": early, "BAC_RGRP": group_after})


def proximity_fix(df: DataFrame) -> DataFrame:
    """Proximity labels for unknown places and for entrants without a baccalaureate."""
    g = F.col("BAC_RGRP")
    no_place = (is_blank("DEPBAC") | (F.col("DEPBAC") == "000")) & pd_ne(g, "7")
    out = {
        "PROXBAC": last_wins(F.col("PROXBAC"), [
            ((g == "9") & is_blank("PROXBAC"), "5 - NR"),
            (g == "7", "9 - non-bachelier"),
            (no_place, "5 - NR"),
        ]),
        "PROXREGBAC": last_wins(F.col("PROXREGBAC"), [
            (g == "7", "9 - non-bachelier"),
            ((g == "9") & is_blank("PROXREGBAC"), "3 - NR"),
            (no_place, "3 - NR"),
        ]),
        "OUTREMER": F.when(g == "7", F.lit("non-bachelier")).otherwise(F.col("OUTREMER")),
    }
    return df.withColumns(out)


def mobility(df: DataFrame, has_intermediate: Column | None = None) -> DataFrame:
    """Foreign baccalaureate, foreign student, international mobility, merged groups, cycle fixes."""
    bac, nation = F.col("BAC"), F.col("NATION")
    foreign_bac = holds(bac.isin("0001", "0002", "0031"))
    mobile = pd_ne(nation, "100") & (holds(F.col("ACABAC") == "00") | holds(bac == "0031"))
    out = {
        "NATION_BAC": F.when(foreign_bac, F.lit("E")).otherwise(F.lit("F")),
        "NATION_VRAI": F.when(foreign_bac & holds(F.col("FR_ETR") == "2"), F.lit("E")).otherwise(F.lit("F")),
        "MOBINTERN": F.when(mobile, F.lit("M")).otherwise(F.lit("X")),
        "BAC_RGRP": F.when(F.col("BAC_RGRP").isin("1", "2", "3"), F.lit("A")).otherwise(F.col("BAC_RGRP")),
        "DNDU": F.when(is_blank("DNDU"), F.lit("DN")).otherwise(F.col("DNDU")),
        "CURSUS_LMD": _cycle("TYP_DIPL", "CURSUS_LMD"),
    }
    if "TYP_DIPINT" in df.columns:
        fixed = _cycle("TYP_DIPINT", "CURSUS_LMD_INT")
        out["CURSUS_LMD_INT"] = fixed if has_intermediate is None else F.when(has_intermediate, fixed).otherwise(F.col("CURSUS_LMD_INT"))
    return df.withColumns(out)


def _cycle(kind: str, cycle: str) -> Column:
    return last_wins(F.col(cycle), [
        ((F.col(kind) == "XA") & pd_ne(cycle, "L"), "L"),
        ((F.col(kind) == "DU") & (F.col(cycle) == "D"), "M"),
    ])


def certificate_flag(df: DataFrame, has_intermediate: Column | None = None,
                     kind: str = "TYP_DIPINT", out: str = "DNDU_INT") -> DataFrame:
    """Intermediate national / university flag: blank type gives ``''``, any type but DU gives DN."""
    k = F.col(kind)
    fixed = last_wins(F.col(out), [(k == "", ""), (~holds(k.isin("", "DU")), "DN")])
    return df.withColumn(out, fixed if has_intermediate is None else F.when(has_intermediate, fixed).otherwise(F.col(out)))

