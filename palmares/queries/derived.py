"""D: derivations; A: aggregations; U: unions, distinct projections and checks."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import aggregate as A, derive as D, quality as Q
from .base import TABLES, blank, query, table, view
from .lookups import STAR_SQL, star
from .scalars import BLANKS

# Derivations ---------------------------------------------------------------


@query("d1_final_headcount", 'SELECT k, CASE WHEN "RESDIP" IN (\'O\', \'1\') THEN 1 ELSE 0 END AS "EFFECTIF_R" FROM deg', ["deg"])
def d1(spark, sf):
    return view(spark, sf, "deg").select("k", D.headcount("RESDIP").alias("EFFECTIF_R"))


@query("d2_intermediate_headcount", """
SELECT "SOURCE", CAST(sum(CASE WHEN "RESINT" IN ('O', '1') THEN 1 ELSE 0 END) AS BIGINT) AS n FROM deg GROUP BY 1""", ["deg"])
def d2(spark, sf):
    return view(spark, sf, "deg").groupBy("SOURCE").agg(F.sum(D.headcount("RESINT")).alias("n"))


@query("d3_default_groups", f"""
SELECT k, CASE WHEN {blank('"LMDDONT"')} THEN 'AUTRES' ELSE "LMDDONT" END AS "LMDDONT",
  CASE WHEN {blank('"PAR_TYPE"')} THEN 'AUTRES' ELSE "PAR_TYPE" END AS "PAR_TYPE" FROM deg""", ["deg"])
def d3(spark, sf):
    return D.default_group(view(spark, sf, "deg"), ["LMDDONT", "PAR_TYPE"]).select("k", "LMDDONT", "PAR_TYPE")


OUT_OF_SCOPE = "\"DIPLOM\" IN ('6001000', '6004000', '8000010')"


@query("d4_degree_group", f"""
SELECT k, CASE WHEN {OUT_OF_SCOPE} OR {blank('"LMDDONT"')} THEN 'AUTRES' ELSE "LMDDONT" END AS "LMDDONT",
  CASE WHEN "TYP_DIPL" = 'XC' AND "DIPLOM" = '2217038' THEN 'MAS_AUT'
    WHEN "TYP_DIPL" = '63' AND "DIPLOM" = '9630163' THEN 'PAREO'
    WHEN "TYP_DIPL" = '61' AND "DIPLOM" = '9610007' THEN 'REBOND'
    WHEN "TYP_DIPL" = 'XA' THEN CASE WHEN "PAR_TYPE" = '0001291' THEN 'LIC_L_LAS' ELSE 'LIC_L_AUT' END
    WHEN "DNDU" = 'DU' THEN 'DU' WHEN {OUT_OF_SCOPE} OR {blank('"LMDDONTBIS"')} THEN 'AUTRES' ELSE "LMDDONTBIS" END AS "LMDDONTBIS",
  CASE WHEN {OUT_OF_SCOPE} OR {blank('"LMDDONT_INT"')} THEN 'AUTRES' ELSE "LMDDONT_INT" END AS "LMDDONT_INT",
  CASE WHEN "DNDU_INT" = 'DU' THEN 'DU' WHEN {OUT_OF_SCOPE} OR {blank('"LMDDONTBIS_INT"')} THEN 'AUTRES' ELSE "LMDDONTBIS_INT" END AS "LMDDONTBIS_INT"
FROM deg""", ["deg"])
def d4(spark, sf):
    return D.degree_group(view(spark, sf, "deg")).select("k", "LMDDONT", "LMDDONTBIS", "LMDDONT_INT", "LMDDONTBIS_INT")


@query("d5_late_early", """
WITH a AS (SELECT k, CAST("RENTREE" AS INT) < 2012 AS old, "ANBAC" IS NULL AS no_year, "ANBAC" - "ANNAIS" AS age,
  CASE WHEN ("BAC_RGRP" IS NULL OR "BAC_RGRP" = '') AND "BAC" IN ('0031', '0032') THEN '7' ELSE "BAC_RGRP" END AS g FROM deg)
SELECT k, CAST(age AS BIGINT) AS "AGE_BAC", CASE WHEN g = '9' AND no_year THEN '7' ELSE g END AS "BAC_RGRP",
  CASE WHEN old THEN CASE WHEN no_year OR g IN ('7', '9') THEN 'X'
      WHEN g IN ('1', '2', '3', '4', '5') THEN CASE WHEN age > 18 THEN 'O' WHEN age <= 18 THEN 'N' END
      WHEN g = '6' THEN CASE WHEN age > 19 THEN 'O' WHEN age < 20 THEN 'N' END END
    WHEN no_year OR g IS NULL OR g NOT IN ('1', '2', '3', '4', '5', '6', 'A') THEN 'X'
    WHEN age > 18 THEN 'O' WHEN age <= 18 THEN 'N' END AS "RETARD",
  CASE WHEN old THEN CASE WHEN no_year OR g IN ('7', '9') THEN 'X'
      WHEN g IN ('1', '2', '3', '4', '5') THEN CASE WHEN age < 18 THEN 'O' WHEN age >= 18 THEN 'N' END
      WHEN g = '6' THEN CASE WHEN age <= 18 THEN 'O' WHEN age > 18 THEN 'N' END END
    WHEN no_year OR g IS NULL OR g NOT IN ('1', '2', '3', '4', '5', '6', 'A') THEN 'X'
    WHEN age < 18 THEN 'O' WHEN age >= 18 THEN 'N' END AS "AVANCE" FROM a""", ["deg"])
def d5(spark, sf):
    return D.late_early(view(spark, sf, "deg")).select("k", "AGE_BAC", "BAC_RGRP", "RETARD", "AVANCE")


NO_PLACE = "((\"DEPBAC\" IS NULL OR \"DEPBAC\" IN ('', '000')) AND (\"BAC_RGRP\" IS NULL OR \"BAC_RGRP\" <> '7'))"


@query("d6_proximity_fix", f"""
SELECT k, CASE WHEN {NO_PLACE} THEN '5 - NR' WHEN "BAC_RGRP" = '7' THEN '9 - non-bachelier'
    WHEN "BAC_RGRP" = '9' AND {blank('"PROXBAC"')} THEN '5 - NR' ELSE "PROXBAC" END AS "PROXBAC",
  CASE WHEN {NO_PLACE} THEN '3 - NR' WHEN "BAC_RGRP" = '7' THEN '9 - non-bachelier'
    WHEN "BAC_RGRP" = '9' AND {blank('"PROXREGBAC"')} THEN '3 - NR' ELSE "PROXREGBAC" END AS "PROXREGBAC",
  CASE WHEN "BAC_RGRP" = '7' THEN 'non-bachelier' ELSE "OUTREMER" END AS "OUTREMER" FROM deg""", ["deg"])
def d6(spark, sf):
    return D.proximity_fix(view(spark, sf, "deg")).select("k", "PROXBAC", "PROXREGBAC", "OUTREMER")


@query("d7_mobility", f"""
WITH a AS (SELECT *, coalesce("BAC" IN ('0031', '0001', '0002'), FALSE) AS fb FROM deg)
SELECT k, CASE WHEN fb THEN 'E' ELSE 'F' END AS "NATION_BAC", CASE WHEN fb AND "FR_ETR" = '2' THEN 'E' ELSE 'F' END AS "NATION_VRAI",
  CASE WHEN "NATION" = '100' THEN 'X' WHEN "ACABAC" = '00' OR "BAC" = '0031' THEN 'M' ELSE 'X' END AS "MOBINTERN",
  CASE WHEN "BAC_RGRP" IN ('1', '2', '3') THEN 'A' ELSE "BAC_RGRP" END AS "BAC_RGRP",
  CASE WHEN {blank('"DNDU"')} THEN 'DN' ELSE "DNDU" END AS "DNDU",
  CASE WHEN "TYP_DIPL" = 'XA' THEN 'L' WHEN "TYP_DIPL" = 'DU' AND "CURSUS_LMD" = 'D' THEN 'M' ELSE "CURSUS_LMD" END AS "CURSUS_LMD",
  CASE WHEN "TYP_DIPINT" = 'XA' THEN 'L' WHEN "TYP_DIPINT" = 'DU' AND "CURSUS_LMD_INT" = 'D' THEN 'M' ELSE "CURSUS_LMD_INT" END AS "CURSUS_LMD_INT"
FROM a""", ["deg"])
def d7(spark, sf):
    return D.mobility(view(spark, sf, "deg")).select(
        "k", "NATION_BAC", "NATION_VRAI", "MOBINTERN", "BAC_RGRP", "DNDU", "CURSUS_LMD", "CURSUS_LMD_INT")


@query("d8_total_headcount", """
SELECT k, CASE WHEN "RESDIP" IN ('O', '1') THEN 1 ELSE 0 END + CASE WHEN "RESINT" IN ('O', '1') THEN 1 ELSE 0 END AS "EFFECTIF_TOT" FROM deg""", ["deg"])
def d8(spark, sf):
    df = view(spark, sf, "deg").withColumns({"EFFECTIF_R": D.headcount("RESDIP"), "EFFECTIF_INT": D.headcount("RESINT")})
    return D.total_headcount(df).select("k", "EFFECTIF_TOT")


# Aggregations --------------------------------------------------------------


@query("a1_cube_with_flag_sums", """
SELECT rflag, lstatus, ship_year, CAST(sum(qty) AS BIGINT) AS qty, CAST(sum(cents) AS BIGINT) AS cents,
  CAST(coalesce(sum(flag_s), 0) AS BIGINT) AS flag_s, CAST(sum(even_part) AS BIGINT) AS even_part
FROM lin GROUP BY rflag, lstatus, ship_year, lin.flag_s, lin.even_part""", ["lin"])
def a1(spark, sf):
    return A.sum_cube(view(spark, sf, "lin"), ["rflag", "lstatus", "ship_year"], ["qty", "cents"], ["flag_s", "even_part"])


@query("a2_resum_of_cube", """
SELECT rflag, ship_year, CAST(sum(qty) AS BIGINT) AS qty_total, CAST(coalesce(sum(flag_s), 0) AS BIGINT) AS flag_total
FROM lin GROUP BY rflag, ship_year""", ["lin"])
def a2(spark, sf):
    cube = A.sum_cube(view(spark, sf, "lin"), ["rflag", "lstatus", "ship_year"], ["qty", "cents"], ["flag_s", "even_part"])
    return A.resum(cube, ["rflag", "ship_year"], {"qty": "qty_total", "flag_s": "flag_total"})


@query("a3_publication_sums", f"""
WITH s AS ({STAR_SQL})
SELECT outcome, segment, cust_region, cust_nation, supp_region, supp_nation, count(*) AS n_lines,
  CAST(sum(CASE WHEN outcome = 'F' THEN 1 ELSE 0 END) AS BIGINT) AS n_final FROM s GROUP BY 1, 2, 3, 4, 5, 6""", ["lin"])
def a3(spark, sf):
    df = star(spark, sf).withColumns({"n_lines": F.lit(1), "n_final": D.headcount("outcome", ("F",))})
    keys = ["outcome", "segment", "cust_region", "cust_nation", "supp_region", "supp_nation"]
    return A.resum(df, keys, ["n_lines", "n_final"])


@query("a4_distinct_key_count", """
SELECT rflag, count(DISTINCT part) AS n_parts, count(DISTINCT supp) AS n_supps FROM lin GROUP BY rflag""", ["lin"])
def a4(spark, sf):
    return A.distinct_counts(view(spark, sf, "lin"), ["rflag"], {"part": "n_parts", "supp": "n_supps"})


@query("a5_row_metrics", " UNION ALL ".join(
    f"SELECT '{t}' AS name, count(*) AS n_rows, CAST((SELECT count(*) FROM (DESCRIBE SELECT * FROM {t})) AS BIGINT) AS n_columns FROM {t}" for t in TABLES))
def a5(spark, sf):
    parts = [A.row_metrics(table(spark, sf, t)).withColumn("name", F.lit(t)) for t in TABLES]
    return Q.union_named(*parts)


@query("a6_exists_any", """
SELECT "SOURCE", "RENTREE", max(CASE WHEN "DEPBAC" IS NULL OR "DEPBAC" <> '000' THEN 1 ELSE 0 END) AS any_row FROM deg GROUP BY 1, 2""", ["deg"])
def a6(spark, sf):
    from ..functions.nulls import pd_ne

    df = A.any_row(view(spark, sf, "deg"), pd_ne("DEPBAC", "000"), ["SOURCE", "RENTREE"])
    return df.withColumn("any_row", F.col("any_row").cast("int"))


# Unions, distinct, checks ----------------------------------------------------


@query("u1_union_of_sources", """
SELECT k, name, segment, NULL AS nation FROM cus UNION ALL SELECT s_suppkey, s_name, NULL, CAST(s_nationkey AS BIGINT) FROM supplier""", ["cus"])
def u1(spark, sf):
    s = table(spark, sf, "supplier").select(
        F.col("s_suppkey").alias("k"), F.col("s_name").alias("name"), F.col("s_nationkey").cast("bigint").alias("nation"))
    return Q.union_named(view(spark, sf, "cus").select("k", "name", "segment"), s)


@query("u2_union_of_years", """
SELECT ship_year, rflag, count(*) AS n, CAST(sum(cents) AS BIGINT) AS cents FROM lin GROUP BY 1, 2""", ["lin"])
def u2(spark, sf):
    """The tables of all years come from one job over all years: the year is a key, not a loop."""
    return A.resum(view(spark, sf, "lin").withColumn("n", F.lit(1)), ["ship_year", "rflag"], ["n", "cents"])


@query("u3_split_and_reunite", """
SELECT k, status, CASE WHEN status IN ('F', 'O') THEN 'matched' ELSE 'rest' END AS side FROM ord""", ["ord"])
def u3(spark, sf):
    df = view(spark, sf, "ord").select("k", "status")
    hit = F.coalesce(F.col("status").isin("F", "O"), F.lit(False))
    return Q.union_named(df.filter(hit).withColumn("side", F.lit("matched")), df.filter(~hit).withColumn("side", F.lit("rest")))


@query("u4_distinct_rows", 'SELECT DISTINCT status, prio, year_text, flag FROM ord', ["ord"])
def u4(spark, sf):
    return Q.distinct_rows(view(spark, sf, "ord").select("status", "prio", "year_text", "flag"))


def reread_sql(c: str) -> str:
    """A text as the verification job reads it again."""
    cut = f"trim(split_part({c}, '.0', 1), {BLANKS})"
    return f"CASE WHEN {cut} = 'nan' THEN '' ELSE trim(replace({cut}, chr(160), ' '), {BLANKS}) END"


def reread_type_sql(c: str) -> str:
    text = f"coalesce({reread_sql(c)}, '')"
    return f"CASE WHEN {text} = 'None' THEN '' WHEN regexp_full_match({text}, '[0-9]') THEN '0' || {text} ELSE {text} END"


@query("u4_reread_facts", f"""
SELECT DISTINCT "SOURCE", {reread_sql('"SEXE"')} AS "SEXE", {reread_type_sql('"TYP_DIPL"')} AS "TYP_DIPL", {reread_type_sql('"TYP_DIPINT"')} AS "TYP_DIPINT" FROM deg""",
       ["deg"])
def u4_reread(spark, sf):
    from ..plans.verify import reread

    return reread(view(spark, sf, "deg").select("SOURCE", "SEXE", "TYP_DIPL", "TYP_DIPINT"))


@query("u5_distinct_combinations", """
SELECT DISTINCT "SOURCE", "RESDIP", "RESINT", "TYP_DIPL", CASE WHEN "SOURCE" IN ('result', 'ens', 'inge', 'priv') THEN "TYP_DIPINT" END AS "TYP_DIPINT",
  CASE WHEN "SOURCE" IN ('result', 'ens', 'inge', 'priv') THEN "CURSUS_LMD_INT" END AS "CURSUS_LMD_INT", "CURSUS_LMDR", "ID_PAYSAGE_ED" FROM deg""", ["deg"])
def u5(spark, sf):
    from ..plans.verify import combinations

    return combinations(view(spark, sf, "deg"))


@query("u6_sorted_projection", "SELECT p_brand, p_size, p_type FROM part")
def u6(spark, sf):
    return Q.project_sorted(table(spark, sf, "part"), ["p_type", "p_brand", "p_size"])


@query("u7_column_set_difference", """
SELECT 'p_mfgr' AS name, 'missing' AS side, count(*) AS n_rows FROM part UNION ALL SELECT 'p_name', 'surplus', count(*) FROM part
UNION ALL SELECT 'p_retailprice', 'surplus', count(*) FROM part""")
def u7(spark, sf):
    df = table(spark, sf, "part")
    missing, surplus = Q.column_diff(df, ["p_partkey", "p_mfgr", "p_brand", "p_type", "p_size"])
    names = [(n, "missing") for n in missing] + [(n, "surplus") for n in surplus]
    tagged = F.explode(F.array(*[F.struct(F.lit(n).alias("name"), F.lit(s).alias("side")) for n, s in names]))
    counted = A.row_metrics(df).drop("n_columns").select(tagged.alias("t"), "n_rows")
    return counted.select("t.name", "t.side", "n_rows")
