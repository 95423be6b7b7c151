"""P: projection, naming and type operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import quality, schema as P
from ..session import work_dir
from ..sources.contracts import contract
from .base import query, table, view


@query("p1_upper_names", 'SELECT n_nationkey AS "N_NATIONKEY", n_name AS "N_NAME", n_regionkey AS "N_REGIONKEY" FROM nation')
def p1(spark, sf):
    return P.upper_names(table(spark, sf, "nation"))


@query("p2_sort_columns", "SELECT c_acctbal, c_custkey, c_mktsegment, c_name, c_nationkey FROM customer")
def p2(spark, sf):
    return P.sort_columns(table(spark, sf, "customer"))


@query("p3_nullable_year_cast", "SELECT k, TRY_CAST(born AS BIGINT) AS born FROM cus", ["cus"])
def p3(spark, sf):
    return P.cast_present(view(spark, sf, "cus").select("k", "born"), {"born": "bigint", "absent": "bigint"})


@query("p4_type_contract", """
SELECT k, TRY_CAST(born AS BIGINT) AS born, CAST(nation AS VARCHAR) AS nation, CAST(NULL AS BIGINT) AS extra, segment
FROM cus""", ["cus"])
def p4(spark, sf):
    df = view(spark, sf, "cus").select("k", "born", "nation", "segment")
    return P.conform(df, contract(["k", "born", "nation", "extra"], ["k", "born", "extra"]))


@query("p5_flag_text", "SELECT k, trim(split_part(flag, '.0', 1)) AS flag FROM cus", ["cus"])
def p5(spark, sf):
    return P.flag_text(view(spark, sf, "cus").select("k", "flag"), "flag")


@query("p6_rename_with_fallback", "SELECT k, name AS ident, coalesce(flag, born) AS flag FROM cus", ["cus"])
def p6(spark, sf):
    df = view(spark, sf, "cus").select("k", "name", "flag", "born")
    return P.rename_present(df, {"name": "ident", "born": "flag", "absent": "x"})


@query("p4_failed_casts", """
SELECT k, 'born' AS "column", born AS value, 'int' AS type FROM cus WHERE born = 'abc' UNION ALL SELECT k, 'segment', segment, 'bigint' FROM cus""", ["cus"])
def p4_failed_casts(spark, sf):
    """Every cell that a cast would turn into NULL, as quarantine keeps it; the counts agree with it."""
    folder = work_dir(spark, "quarantine")
    df, counts = quality.quarantined(view(spark, sf, "cus"), {"born": "int", "segment": "bigint", "absent": "int"}, ["k"], folder)
    found = spark.read.parquet(folder)
    if found.count() != sum(counts.values()) or df.filter("segment IS NOT NULL").count():
        raise ValueError("the counts of failed casts do not agree")
    return found


@query("p7_swap_columns", "SELECT k, name AS code, kind, size AS brand FROM prt", ["prt"])
def p7(spark, sf):
    df = view(spark, sf, "prt").select("k", "name", "kind", "size", "code", "brand")
    return P.swap_columns(df, {"name": "code", "size": "brand"}, ["code", "brand"])


@query("p8_add_missing_defaults", "SELECT k, status, '' AS \"COMUI\", '' AS \"CONV\" FROM ord", ["ord"])
def p8(spark, sf):
    return P.add_defaults(view(spark, sf, "ord").select("k", "status"), {"status": "", "COMUI": "", "CONV": ""})


@query("p9_default_outcomes", "SELECT k, \"RESDIP\", 'N' AS \"RESINT\" FROM deg", ["deg"])
def p9(spark, sf):
    return P.add_defaults(view(spark, sf, "deg").select("k", "RESDIP"), {"RESDIP": "O", "RESINT": "N"})


@query("p10_provenance", """
SELECT k, "SOURCE", "RENTREE", "RENTREE" || '-' || substr(CAST(CAST("RENTREE" AS INT) + 1 AS VARCHAR), 3, 2)
  AS "ANNEE_UNIVERSITAIRE", CAST(CAST("RENTREE" AS INT) + 1 AS VARCHAR) AS "SESSION" FROM deg""", ["deg"])
def p10(spark, sf):
    return P.with_provenance(view(spark, sf, "deg").select("k", "SOURCE", "RENTREE"))


@query("p11_align_to_model", 'SELECT "RENTREE", CAST(NULL AS VARCHAR) AS "ANNEE", "BAC", "DIPLOM" FROM deg', ["deg"])
def p11(spark, sf):
    return P.align(view(spark, sf, "deg"), ["RENTREE", "ANNEE", "BAC", "DIPLOM"], add_missing=True)


@query("p12_prune_to_model", 'SELECT "RENTREE", "BAC", "DIPLOM" FROM deg', ["deg"])
def p12(spark, sf):
    return P.align(view(spark, sf, "deg"), ["RENTREE", "ANNEE", "BAC", "DIPLOM"])


@query("p13_alias_columns", 'SELECT k, "ETABLI", "ETABLI" AS "ETABLI_ORI_UAI", "COMPOS" AS "UI" FROM deg', ["deg"])
def p13(spark, sf):
    df = P.alias_columns(view(spark, sf, "deg"), {"ETABLI_ORI_UAI": "ETABLI", "UI": "COMPOS"})
    return df.select("k", "ETABLI", "ETABLI_ORI_UAI", "UI")


@query("p14_final_types", """
SELECT k, coalesce(CAST("ANBAC" AS VARCHAR), '') AS "ANBAC",
  CASE WHEN "COMINS" IS NULL OR "COMINS" = 'None' THEN '' ELSE "COMINS" END AS "COMINS",
  coalesce(TRY_CAST("FLAG_MEEF" AS BIGINT), 0) AS "FLAG_MEEF", TRY_CAST("FR_ETR" AS BIGINT) AS "FR_ETR",
  coalesce("BAC", '') AS "BAC" FROM deg""", ["deg"])
def p14(spark, sf):
    df = view(spark, sf, "deg").select("k", "ANBAC", "COMINS", "FLAG_MEEF", "FR_ETR", "BAC")
    return P.finalise_types(df, text=["ANBAC", "COMINS"], zero_ints=["FLAG_MEEF"], ints=["FR_ETR"])


@query("p15_publication_labels", """
SELECT "CURSUS_LMD" AS "CURSUS_LMD_R", "CURSUS_LMD_INT" AS "Cycle universitaire intermédiaire", count(*) AS "cursus_lmd_int"
FROM deg GROUP BY 1, 2""", ["deg"])
def p15(spark, sf):
    df = view(spark, sf, "deg").groupBy("CURSUS_LMD", "CURSUS_LMD_INT").agg(F.count(F.lit(1)).alias("N"))
    return P.relabel(df, {"CURSUS_LMD": "CURSUS_LMD_R", "CURSUS_LMD_INT": "Cycle universitaire intermédiaire", "N": "cursus_lmd_int"})


@query("p16_publication_subset", 'SELECT "RENTREE", "SEXE", "DNDU_INT" FROM deg', ["deg"])
def p16(spark, sf):
    return P.pick(view(spark, sf, "deg"), ["RENTREE", "SEXE"], ["DNDU_INT", "ABSENT"])


@query("p17_columns_by_pattern", 'SELECT "TYP_DIPL", "TYP_DIPR", "TYP_DIPINT" FROM deg', ["deg"])
def p17(spark, sf):
    df = view(spark, sf, "deg")
    return df.select(*P.columns_like(df, "TYP_"))
