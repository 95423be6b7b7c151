"""R: rule-driven corrections."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.nulls import is_missing
from ..operators import rule_tables as RT, rules as R
from ..operators.lookups import left_lookup, small_table, stored
from ..plans import correct
from ..sources.contracts import FILE_COLUMNS, columns_mask
from .base import blank, miss, query, table, view

WITH_INT = "\"SOURCE\" IN ('result', 'ens', 'inge', 'priv')"


def deg(spark, sf):
    return view(spark, sf, "deg")


@query("r1_fill_component", """
SELECT k, CASE WHEN "ETABLI" IS NOT NULL AND ("COMPOS" IS NULL OR length("COMPOS") < 3) THEN "ETABLI" ELSE "COMPOS" END AS "COMPOS"
FROM deg""", ["deg"])
def r1(spark, sf):
    return R.fill_component(deg(spark, sf)).select("k", "COMPOS")


# Year-range rules made from the data: one per pair of customers, open or bounded.
RANGE_SHEET = """(SELECT CAST(c_custkey AS VARCHAR) AS "IN", CASE WHEN c_custkey % 3 = 0 THEN 'abc' ELSE c_name END AS "OUT",
  CASE WHEN c_custkey % 4 = 0 THEN '' ELSE CAST(1992 + c_custkey % 5 AS VARCHAR) END AS lo,
  CAST(1996 + c_custkey % 4 AS VARCHAR) AS hi FROM customer)"""


def range_sheet(spark, sf):
    c = F.col("c_custkey")
    return table(spark, sf, "customer").select(
        c.cast("string").alias("IN"), F.when(c % 3 == 0, "abc").otherwise(F.col("c_name")).alias("OUT"),
        F.when(c % 4 == 0, "").otherwise((1992 + c % 5).cast("string")).alias("RENTREE_START"),
        (1996 + c % 4).cast("string").alias("RENTREE_END"))


@query("r2_replace_by_year_and_code", f"""
WITH s AS {RANGE_SHEET}
SELECT o.k, CASE WHEN length(s."OUT") > 3 THEN s."OUT" ELSE CAST(o.cust + o.h1 % 3 * 1000000 AS VARCHAR) END AS etabli
FROM ord o LEFT JOIN s ON s."IN" = CAST(o.cust + o.h1 % 3 * 1000000 AS VARCHAR) AND CASE WHEN s.lo = '' THEN TRUE
  ELSE o.y BETWEEN CAST(s.lo AS INT) AND CAST(s.hi AS INT) END""", ["ord"])
def r2(spark, sf):
    """Two of three orders carry a code that no rule has."""
    code = (F.col("cust") + F.col("h1") % 3 * 1000000).cast("string")
    df = view(spark, sf, "ord").select("k", F.col("y").cast("string").alias("RENTREE"), code.alias("etabli"))
    return R.replace_in_spans(df, R.span_map(range_sheet(spark, sf), "IN"), "etabli", "etabli").select("k", "etabli")


SOURCE_SHEET = """(SELECT CASE p_partkey % 3 WHEN 0 THEN '' WHEN 1 THEN 'result' ELSE 'priv' END AS source,
  CASE WHEN p_partkey % 2 = 0 THEN 'E' || p_partkey ELSE '' END AS "IN", 'C' || p_partkey AS compos,
  'N' || p_name || p_partkey AS "OUT", CASE WHEN p_partkey % 5 = 0 THEN '' ELSE '2014' END AS lo, '2018' AS hi FROM part)"""


@query("r3_replace_by_source_wildcards", f"""
WITH s AS {SOURCE_SHEET},
f AS (SELECT k, "SOURCE" AS source, CAST("RENTREE" AS INT) AS y, 'E' || h1 % 500 AS etabli, 'C' || h2 % 500 AS compos,
  'C' || h3 % 500 AS rattach FROM deg),
a AS (SELECT f.*, coalesce(s."OUT", f.etabli) AS e1 FROM f LEFT JOIN s ON s."IN" = f.etabli AND s."IN" <> ''
  AND (s.source = '' OR s.source = f.source) AND (s.lo = '' OR f.y BETWEEN 2014 AND 2018)),
b AS (SELECT a.*, coalesce(s."OUT", a.e1) AS e2 FROM a LEFT JOIN s ON s.compos = a.compos AND s."IN" = ''
  AND (s.source = '' OR s.source = a.source) AND (s.lo = '' OR a.y BETWEEN 2014 AND 2018))
SELECT b.k, b.compos AS "COMPOS", coalesce(s."OUT", b.e2) AS "ETABLI" FROM b LEFT JOIN s ON s.compos = b.rattach AND s."IN" = ''
  AND (s.source = '' OR s.source = b.source) AND (s.lo = '' OR b.y BETWEEN 2014 AND 2018)""",
       ["deg"])
def r3(spark, sf):
    p = F.col("p_partkey")
    key = p.cast("string")
    sheet = table(spark, sf, "part").select(
        F.when(p % 3 == 0, "").when(p % 3 == 1, "result").otherwise("priv").alias("SOURCE"),
        F.when(p % 2 == 0, F.concat(F.lit("E"), key)).otherwise("").alias("IN"), F.concat(F.lit("C"), key).alias("COMPOS"),
        F.concat(F.lit("N"), "p_name", key).alias("OUT"), F.when(p % 5 == 0, "").otherwise("2014").alias("RENTREE_START"),
        F.lit("2018").alias("RENTREE_END"))
    code = lambda letter, h: F.concat(F.lit(letter), (F.col(h) % 500).cast("string"))
    df = deg(spark, sf).select("k", "SOURCE", "RENTREE", code("E", "h1").alias("ETABLI"), code("C", "h2").alias("COMPOS"),
                               code("C", "h3").alias("RATTACH"))
    return R.replace_by_sources(df, sheet).select("k", "COMPOS", "ETABLI")


COMINS_SHEET = [
    {"TYP_DIPL": "rien", "COMPOS": "rien", "RENTREE": "rien", "IN": "75056", "OUT": "75101"},
    {"TYP_DIPL": "rien", "COMPOS": "0755555A", "RENTREE": "rien", "IN": "rien", "OUT": "13001"},
    {"TYP_DIPL": "rien", "COMPOS": "0755555A", "RENTREE": "2016", "IN": "crochet", "OUT": "never"},
    {"TYP_DIPL": "rien", "COMPOS": "0684045X", "RENTREE": "2016", "IN": "crochet", "OUT": "69001"},
    {"TYP_DIPL": "rien", "COMPOS": "0684045X", "RENTREE": "2016", "IN": "69001", "OUT": "69002"},
    {"TYP_DIPL": "rien", "COMPOS": "0753364Z", "RENTREE": "2017", "IN": "rien", "OUT": "75102"},
    {"TYP_DIPL": "rien", "COMPOS": "0011312W", "RENTREE": "rien", "IN": "06840", "OUT": "06841"},
    {"TYP_DIPL": "XA", "COMPOS": "0753364Z", "RENTREE": "2017", "IN": "x", "OUT": "75103"},
    {"TYP_DIPL": "rien", "COMPOS": "rien", "RENTREE": "rien", "IN": "75103", "OUT": "75104"},
]


@query("r4_commune_registration_rules", f"""
WITH a AS (SELECT k, "COMPOS" AS c, "RENTREE" AS y, "TYP_DIPL" AS t, CASE WHEN "COMINS" = '75056' THEN '75101' ELSE "COMINS" END AS v FROM deg),
b AS (SELECT k, c, y, t, CASE WHEN c = '0755555A' THEN '13001' WHEN c = '0684045X' AND y = '2016' AND ({miss('v')} OR v = '69001')
  THEN '69002' WHEN c = '0753364Z' AND y = '2017' THEN '75102' WHEN c = '0011312W' AND v = '06840' THEN '06841' ELSE v END AS v FROM a)
SELECT k, CASE WHEN t = 'XA' AND c = '0753364Z' AND y = '2017' THEN '75104' WHEN v = '75103' THEN '75104' ELSE v END AS "COMINS" FROM b""",
       ["deg"])
def r4(spark, sf):
    return R.fold_rules(deg(spark, sf), R.commune_registration_rules(COMINS_SHEET), "COMINS").select("k", "COMINS")


@query("r5_commune_establishment_rules", f"""
WITH a AS (SELECT k, CASE WHEN "ETABLI" = '0912423P' AND "RENTREE" = '2018' THEN '91001' ELSE "COMINS" END AS v, "ETABLI", "RENTREE", "PAR_TYPE" FROM deg),
b AS (SELECT k, CASE WHEN {miss('v')} AND "ETABLI" = '0755555A' AND "RENTREE" = '2019' THEN '75056' ELSE v END AS v, "RENTREE", "PAR_TYPE" FROM a)
SELECT k, CASE WHEN "PAR_TYPE" = '0001291' AND "RENTREE" = '2019' THEN '99999' ELSE v END AS "COMETAB" FROM b""", ["deg"])
def r5(spark, sf):
    sheet = [
        {"ETABLI": "0912423P", "ID_PAYSAGE": "", "RENTREE": "2018", "IN": "rien", "OUT": "91001"},
        {"ETABLI": "0755555A", "ID_PAYSAGE": "", "RENTREE": "2019", "IN": "crochet", "OUT": "75056"},
        {"ETABLI": "rien", "ID_PAYSAGE": "0001291", "RENTREE": "2019", "IN": "rien", "OUT": "99999"},
    ]
    df = deg(spark, sf).withColumns({"COMETAB": F.col("COMINS"), "ID_PAYSAGE": F.col("PAR_TYPE")})
    return R.fold_rules(df, R.commune_establishment_rules(sheet), "COMETAB").select("k", "COMETAB")


@query("r6_commune_unit_rules", f"""
WITH a AS (SELECT k, "COMPOS" AS c, "RENTREE" AS y, "COMINS" AS v FROM deg),
b AS (SELECT k, c, y, CASE WHEN {miss('v')} AND c = '0684045X' AND y = '2015' THEN '68001' ELSE v END AS v FROM a)
SELECT k, CASE WHEN v = '75056' AND c = '0753364Z' AND y = '2016' THEN '75105' WHEN v = '68001' AND c = '0684045X' AND y = '2015'
  THEN '68002' ELSE v END AS "COMUI" FROM b""", ["deg"])
def r6(spark, sf):
    sheet = [
        {"COMPOS": "0684045X", "RENTREE": "2015", "IN": "crochet", "OUT": "68001"},
        {"COMPOS": "0753364Z", "RENTREE": "2016", "IN": "75056", "OUT": "75105"},
        {"COMPOS": "0684045X", "RENTREE": "2015", "IN": "68001", "OUT": "68002"},
    ]
    rules = R.wildcard_rules(sheet, "COMUI", ("COMPOS", "RENTREE"), any_word=None)
    return R.fold_rules(deg(spark, sf).withColumn("COMUI", F.col("COMINS")), rules, "COMUI").select("k", "COMUI")


def generic(var1, value1, out, new, var2="", value2=""):
    return {"VAR1_IN": var1, "VALUE1_IN": value1, "VAR2_IN": var2, "VALUE2_IN": value2, "VAR_OUT": out, "VALUE_OUT": new}


def run_generic(spark, sf, sheet, cols, output=None, **how):
    rules = R.compile_rules(R.generic_rules(sheet, output, **how))
    return R.apply_rules(deg(spark, sf), rules).select("k", *cols)


@query("r7_one_condition_rules", """
WITH a AS (SELECT k, CASE WHEN "BAC" = '0037' THEN '7' WHEN "BAC" = 'ES' THEN '2' ELSE "BAC_RGRP" END AS g, "NATION" AS n FROM deg)
SELECT k, g AS "BAC_RGRP", CASE WHEN g = '7' THEN '777' ELSE n END AS "NATION" FROM a""", ["deg"])
def r7(spark, sf):
    sheet = [generic("BAC", "0037", "BAC_RGRP", "6"), generic("ABSENT", "1", "BAC_RGRP", "0"), generic("BAC", "ES", "BAC_RGRP", "2"),
             generic("BAC", "0037", "BAC_RGRP", "7"), generic("BAC_RGRP", "7", "NATION", "777")]
    return run_generic(spark, sf, sheet, ["BAC_RGRP", "NATION"])


@query("r8_two_condition_rules", f"""
SELECT k, CASE WHEN "SOURCE" = 'priv' AND "DEPBAC" = '075' THEN '01' WHEN "SOURCE" = 'ens' AND "DEPBAC" = '000' THEN '02'
  ELSE "ACABAC" END AS "ACABAC", CASE WHEN "SOURCE" = 'inge' AND {miss('"FR_ETR"')} THEN '9' ELSE "FR_ETR" END AS "FR_ETR" FROM deg""",
       ["deg"])
def r8(spark, sf):
    honoured = R.generic_rules([generic("SOURCE", "priv", "ACABAC", "01", "DEPBAC", "075"), generic("SOURCE", "ens", "ACABAC", "02", "DEPBAC", "000")])
    null_test = R.generic_rules([generic("SOURCE", "inge", "FR_ETR", "9", "FR_ETR", "any")], second_is_null=True)
    return R.apply_rules(deg(spark, sf), R.compile_rules(honoured + null_test)).select("k", "ACABAC", "FR_ETR")


@query("r9_rule_sheet_dispatch", """
WITH a AS (SELECT k, "SOURCE", CASE WHEN "TYP_DIPL" = 'XA' THEN 'G1' WHEN "TYP_DIPL" = 'XB' THEN 'G2' ELSE "LMDDONT" END AS g FROM deg)
SELECT k, CASE WHEN "SOURCE" = 'priv' AND g = 'G1' THEN 'G3' ELSE g END AS "LMDDONT" FROM a""", ["deg"])
def r9(spark, sf):
    sheet = [generic("SOURCE", "priv", "LMDDONT", "G3", "LMDDONT", "G1"), generic("TYP_DIPL", "XA", "LMDDONT", "G1"),
             generic("TYP_DIPL", "XB", "LMDDONT", "G2")]
    return run_generic(spark, sf, sheet, ["LMDDONT"])


@query("r9b_rules_of_one_output", """
SELECT k, CASE WHEN "BAC" = '0031' THEN '099' WHEN "DEPBAC" = '2A' THEN '02A' ELSE "DEPBAC" END AS "DEPBAC", "ACABAC" FROM deg""", ["deg"])
def r9b(spark, sf):
    sheet = [generic("DEPBAC", "2A", "DEPBAC", "02A"), generic("DEPBAC", "2A", "ACABAC", "27"), generic("BAC", "0031", "DEPBAC", "099")]
    return run_generic(spark, sf, sheet, ["DEPBAC", "ACABAC"], output="DEPBAC")


@query("r9c_year_bound_rules", """
WITH a AS (SELECT k, "RENTREE" AS y, CASE WHEN "RENTREE" = '2016' AND "DEPBAC" = '075' THEN '76' ELSE "ACABAC" END AS v, "DEPBAC" AS d FROM deg)
SELECT k, v AS "ACABAC", CASE WHEN y = '2016' AND v = '76' THEN '750' ELSE d END AS "DEPBAC" FROM a""", ["deg"])
def r9c(spark, sf):
    sheet = [{"RENTREE": "2016", "VAR_IN": "DEPBAC", "VALUE_IN": "075", "VAR_OUT": "ACABAC", "VALUE_OUT": "76"},
             {"RENTREE": "2016", "VAR_IN": "ACABAC", "VALUE_IN": "76", "VAR_OUT": "DEPBAC", "VALUE_OUT": "750"}]
    return R.apply_rules(deg(spark, sf), R.compile_rules(R.year_rules(sheet))).select("k", "ACABAC", "DEPBAC")


@query("r10_name_to_id", f"""
WITH s AS (SELECT n_name AS name, CASE WHEN n_nationkey % 5 = 0 THEN '' ELSE 'ID' || n_nationkey END AS id FROM nation
  UNION ALL SELECT 'UNIVERSITE LA REUNION', 'REU' UNION ALL SELECT 'ESPE ACADEMIE DE NOUVELLE CALE', 'ESP' UNION ALL SELECT 'UNIVERSITE NELLE CALEDONIE', ''),
a AS (SELECT k, "RENTREE" AS y, "FLAG_MEEF" AS m, CASE WHEN h4 % 3 = 0 THEN 'VF' ELSE "TYP_DIPL" END AS t, "PAR_TYPE" AS old,
  CASE h1 % 4 WHEN 0 THEN 'UNIVERSITE NELLE CALEDONIE' WHEN 1 THEN 'ESPE ACADEMIE DE NOUVELLE CALE' WHEN 2 THEN 'ESPE ACADEMIE DE REUNION'
    ELSE 'NATION_' || h2 % 40 END AS name FROM deg),
b AS (SELECT *, CASE WHEN y = '2014' AND name = 'UNIVERSITE NELLE CALEDONIE' AND m = '1' THEN 'ESPE ACADEMIE DE NOUVELLE CALE'
  WHEN y = '2014' AND name = 'ESPE ACADEMIE DE NOUVELLE CALE' AND m = '0' THEN 'UNIVERSITE NELLE CALEDONIE'
  WHEN name = 'ESPE ACADEMIE DE REUNION' AND t = 'VF' THEN 'UNIVERSITE LA REUNION' ELSE name END AS fixed FROM a)
SELECT k, fixed AS name, CASE WHEN s.id IS NULL OR s.id = '' THEN b.old ELSE s.id END AS formens FROM b LEFT JOIN s ON s.name = b.fixed""", ["deg"])
def r10(spark, sf):
    """Names of the full list, names outside it, and the job's own three fixes of names."""
    n, h = F.col("n_nationkey"), F.col("h1") % 4
    ids = table(spark, sf, "nation").select(
        F.col("n_name").alias("IN"), F.when(n % 5 == 0, "").otherwise(F.concat(F.lit("ID"), n.cast("string"))).alias("OUT"))
    own = small_table(spark, [("UNIVERSITE LA REUNION", "REU"), ("ESPE ACADEMIE DE NOUVELLE CALE", "ESP"), ("UNIVERSITE NELLE CALEDONIE", "")], "IN string, OUT string")
    name = (F.when(h == 0, "UNIVERSITE NELLE CALEDONIE").when(h == 1, "ESPE ACADEMIE DE NOUVELLE CALE").when(h == 2, "ESPE ACADEMIE DE REUNION")
            .otherwise(F.concat(F.lit("NATION_"), (F.col("h2") % 40).cast("string"))))
    df = deg(spark, sf).withColumns({
        "ETABLI_DIFFUSION": name, "ID_PAYSAGE_FORMENS": F.col("PAR_TYPE"), "TYP_DIPL": F.when(F.col("h4") % 3 == 0, "VF").otherwise(F.col("TYP_DIPL"))})
    out = correct.publication_names(df, ids.union(own))
    return out.select("k", F.col("ETABLI_DIFFUSION").alias("name"), F.col("ID_PAYSAGE_FORMENS").alias("formens"))


FORMATIONS = [
    {"TYP_DIPL_IN": "XA", "NIVEAU_IN": "02", "DIPLOM_IN": "", "TYP_DIPL_OUT": "XB", "SECTDIS_OUT": "21"},
    {"TYP_DIPL_IN": "XB", "NIVEAU_IN": "", "DIPLOM_IN": "6001000", "TYP_DIPL_OUT": "XC", "SECTDIS_OUT": ""},
    {"TYP_DIPL_IN": "XC", "NIVEAU_IN": "02", "DIPLOM_IN": "6001000", "TYP_DIPL_OUT": "DU", "SECTDIS_OUT": "44"},
    {"TYP_DIPL_IN": "PE", "NIVEAU_IN": "[empty]", "DIPLOM_IN": "", "TYP_DIPL_OUT": "PF", "SECTDIS_OUT": ""},
]


@query("r11_multi_output_rules", """
WITH a AS (SELECT k, "NIVEAUR" AS n, "DIPLOM" AS d, CASE WHEN "TYP_DIPL" = 'XA' AND "NIVEAUR" = '02' THEN 'XB' ELSE "TYP_DIPL" END AS t,
  CASE WHEN "TYP_DIPL" = 'XA' AND "NIVEAUR" = '02' THEN '21' ELSE "SECTDIS" END AS s FROM deg),
b AS (SELECT k, n, d, s, CASE WHEN t = 'XB' AND d = '6001000' THEN 'XC' ELSE t END AS t FROM a),
c AS (SELECT k, n, CASE WHEN t = 'XC' AND n = '02' AND d = '6001000' THEN 'DU' ELSE t END AS t,
  CASE WHEN t = 'XC' AND n = '02' AND d = '6001000' THEN '44' ELSE s END AS s FROM b)
SELECT k, CASE WHEN t = 'PE' AND n = '' THEN 'PF' ELSE t END AS "TYP_DIPL", s AS "SECTDIS" FROM c""", ["deg"])
def r11(spark, sf):
    df = deg(spark, sf).withColumn("NIVEAU", F.col("NIVEAUR"))
    return R.apply_rules(df, R.compile_rules(R.formation_rules(FORMATIONS))).select("k", "TYP_DIPL", "SECTDIS")


@query("r11_many_rules_joined", """
WITH p AS (SELECT p_partkey, p_brand, p_type, p_size FROM part)
SELECT l.k, l.line, coalesce(p.p_brand, '') || '/' || coalesce(p.p_type, '') AS code,
  CASE WHEN p.p_size % 2 = 0 THEN 'even' ELSE 'odd' END AS parity FROM lin l JOIN p ON p.p_partkey = l.part""", ["lin"])
def r11_many(spark, sf):
    """Sheets of thousands of rules (one per brand and type, one per size) that stay tables."""
    part = table(spark, sf, "part")
    sheet = part.select("p_brand", "p_type").distinct().select(
        F.col("p_brand").alias("BRAND_IN"), F.col("p_type").alias("TYPE_IN"), F.concat_ws("/", "p_brand", "p_type").alias("CODE_OUT"))
    sizes = part.select("p_size").distinct().select(
        F.col("p_size").cast("string").alias("SIZE_IN"), F.when(F.col("p_size") % 2 == 0, "even").otherwise("odd").alias("PARITY_OUT"))
    dim = part.select("p_partkey", F.col("p_brand").alias("BRAND"), F.col("p_type").alias("TYPE"), F.col("p_size").cast("string").alias("SIZE"))
    df = left_lookup(view(spark, sf, "lin").select("k", "line", "part"), dim, {"part": "p_partkey"}, ["BRAND", "TYPE", "SIZE"])
    out = RT.apply_sheets(df, [("formation", sheet), ("formation", sizes)])
    return out.select("k", "line", F.col("CODE").alias("code"), F.col("PARITY").alias("parity"))


@query("r4_folded_rule_table", f"""
SELECT k, CASE WHEN "COMPOS" = '0011312W' THEN 'end' WHEN "COMPOS" = '0753364Z' OR "COMINS" = '75056' THEN 'v25'
  WHEN {miss('"COMINS"')} AND "COMPOS" = '0684045X' AND "RENTREE" = '2016' THEN 'v25' ELSE "COMINS" END AS "COMINS" FROM deg""", ["deg"])
def r4_table(spark, sf):
    """Rules that stay a table: a chain over all nations, entered from its beginning, from the middle by a unit and from a missing value; a last unit ends it."""
    n = F.col("n_nationkey").cast("int")
    rien = F.lit("rien")
    nation = table(spark, sf, "nation")

    def rows(place, unit, year, value, out, where="TRUE"):
        return nation.filter(where).select(
            F.format_string("%03d", place).alias(R.ROW), rien.alias("TYP_DIPL"), unit.alias("COMPOS"), year.alias("RENTREE"), value.alias("IN"), out.alias("OUT"))

    step = lambda i: F.concat(F.lit("v"), i.cast("string"))
    sheet = rows(n * 2, rien, rien, F.when(n == 0, "75056").otherwise(step(n)), step(n + 1)).union(
        rows(n * 2 + 1, F.lit("0753364Z"), rien, rien, step(n + 1), "n_nationkey = 11")).union(
        rows(n * 2 + 1, F.lit("0684045X"), F.lit("2016"), F.lit("crochet"), step(n + 23), "n_nationkey = 1")).union(
        rows(n + 99, F.lit("0011312W"), rien, rien, F.lit("end"), "n_nationkey = 0"))
    return RT.fold_sheet(deg(spark, sf), "registration", sheet, "COMINS").select("k", "COMINS")


BY_TYPE = """(SELECT typ, CASE WHEN typ IN ('XA', 'TB') THEN 'L' WHEN typ = 'XB' THEN 'M' ELSE '' END AS cyc
  FROM (SELECT DISTINCT "TYP_DIPL" AS typ FROM deg))"""


def by_type(spark, sf):
    t = F.col("TYP_DIPL")
    kinds = deg(spark, sf).select("TYP_DIPL")
    return kinds.select("TYP_DIPL", F.when(t.isin("XA", "TB"), "L").when(t == "XB", "M").otherwise("").alias("CURSUS_LMD_OUT"))


@query("r12_cycle_by_type", f"""
WITH t AS {BY_TYPE}
SELECT d.k, CASE WHEN length(a.cyc) > 0 AND ({miss('d."CURSUS_LMD"')} OR d."CURSUS_LMD" = 'X') THEN a.cyc ELSE d."CURSUS_LMD" END AS "CURSUS_LMD",
  CASE WHEN length(b.cyc) > 0 THEN b.cyc ELSE d."CURSUS_LMD_INT" END AS "CURSUS_LMD_INT"
FROM deg d LEFT JOIN t a ON a.typ = d."TYP_DIPL" LEFT JOIN t b ON b.typ = d."TYP_DIPINT" """, ["deg"])
def r12(spark, sf):
    t, df = by_type(spark, sf), deg(spark, sf)
    df = R.override_tiers(df, [(t, {"TYP_DIPL": "TYP_DIPL"}, is_missing("CURSUS_LMD") | (F.col("CURSUS_LMD") == "X"))], "CURSUS_LMD", "CURSUS_LMD_OUT")
    df = R.override_tiers(df, [(t, {"TYP_DIPINT": "TYP_DIPL"}, None)], "CURSUS_LMD_INT", "CURSUS_LMD_OUT")
    return df.select("k", "CURSUS_LMD", "CURSUS_LMD_INT")


FINER = """(SELECT DISTINCT "TYP_DIPL" AS typ, "DIPLOM" AS dip, coalesce("NIVEAUR", '') AS niv,
  CASE WHEN coalesce("NIVEAUR", '') = '' THEN 'B' WHEN "NIVEAUR" = '1' THEN '' ELSE 'F' || "NIVEAUR" END AS cyc FROM deg WHERE "DIPLOM" IS NOT NULL)"""


@query("r13_cycle_override_tiers", f"""
WITH f AS {FINER}
SELECT d.k, CASE WHEN length(b.cyc) > 0 THEN b.cyc WHEN length(a.cyc) > 0 THEN a.cyc ELSE d."CURSUS_LMD" END AS "CURSUS_LMD",
  CASE WHEN length(y.cyc) > 0 THEN y.cyc WHEN length(x.cyc) > 0 THEN x.cyc ELSE d."CURSUS_LMD_INT" END AS "CURSUS_LMD_INT"
FROM deg d LEFT JOIN f a ON a.typ = d."TYP_DIPL" AND a.dip = d."DIPLOM" AND a.niv = d."NIVEAUR" AND a.niv <> ''
LEFT JOIN f b ON b.typ = d."TYP_DIPL" AND b.dip = d."DIPLOM" AND b.niv = ''
LEFT JOIN f x ON x.typ = d."TYP_DIPINT" AND x.dip = d."DIPLOM" AND x.niv = d."NIVEAUR" AND x.niv <> ''
LEFT JOIN f y ON y.typ = d."TYP_DIPINT" AND y.dip = d."DIPLOM" AND y.niv = '' """, ["deg"])
def r13(spark, sf):
    df = deg(spark, sf)
    n = F.coalesce(F.col("NIVEAUR"), F.lit(""))
    # a sheet over all types, degrees and levels of the facts, written once: four lookups read it
    sheet = stored(df.filter("DIPLOM IS NOT NULL").select(
        "TYP_DIPL", "DIPLOM", n.alias("NIVEAU"),
        F.when(n == "", "B").when(n == "1", "").otherwise(F.concat(F.lit("F"), n)).alias("CURSUS_LMD_OUT")).distinct(), "cycles")
    by_level, by_degree = sheet.filter("NIVEAU <> ''"), sheet.filter("NIVEAU = ''").drop("NIVEAU")
    for kind, cycle in (("TYP_DIPL", "CURSUS_LMD"), ("TYP_DIPINT", "CURSUS_LMD_INT")):
        df = R.override_tiers(df, [
            (by_level, {kind: "TYP_DIPL", "DIPLOM": "DIPLOM", "NIVEAUR": "NIVEAU"}, None),
            (by_degree, {kind: "TYP_DIPL", "DIPLOM": "DIPLOM"}, None)], cycle, "CURSUS_LMD_OUT")
    return df.select("k", "CURSUS_LMD", "CURSUS_LMD_INT")


OLD_LICENCE = "r = 'O' AND tr = 'XA' AND t IN ('01', '10', 'CC', 'XA') AND n = '02'"
MISS = {c: miss(c) for c in ("r", "t", "i")}

# The rules on outcomes one step after the other. Files of years before 2012 have no outcome columns.
OUTCOMES = f"""o0 AS (SELECT k, "SOURCE" AS s, {WITH_INT} AS w, CASE WHEN "RENTREE" < '2012' THEN 'O' ELSE "RESDIP" END AS d,
  CASE WHEN "RENTREE" < '2012' THEN 'N' ELSE "RESINT" END AS r, "TYP_DIPL" AS tl, "TYP_DIPR" AS tr, "TYP_DIPINT" AS t, "NIVEAUR" AS n,
  "DIPINT" AS i, "SECTINT" AS si, "DISCIPLINT" AS di, "FLAG_MEEF" AS f FROM deg),
o1 AS (SELECT * REPLACE (CASE WHEN s = 'priv' AND r = 'O' AND d = 'N' AND n = '02' AND {MISS['t']} AND tr IN ('XA', 'XB')
    THEN CASE tr WHEN 'XA' THEN 'CP' ELSE 'EP' END ELSE t END AS t,
  CASE WHEN s = 'result' AND i = '5000770' AND si = '07' THEN '11' ELSE di END AS di,
  CASE WHEN w AND {MISS['r']} AND {MISS['t']} THEN 'N' ELSE r END AS r) FROM o0),
o2 AS (SELECT * REPLACE (CASE WHEN s = 'inge' AND (d IS NULL OR d <> 'N') THEN 'O' WHEN s = 'ens' THEN CASE WHEN {MISS['i']} THEN 'O' ELSE 'N' END
    WHEN s IN ('mana', 'enq', 'culture') THEN 'O' ELSE d END AS d,
  CASE WHEN s = 'ens' THEN CASE WHEN {MISS['i']} THEN 'N' ELSE 'O' END WHEN s IN ('mana', 'enq', 'culture') THEN '' ELSE r END AS r,
  CASE WHEN s IN ('result', 'priv') THEN f ELSE '0' END AS f) FROM o1),
o3 AS (SELECT * REPLACE (CASE WHEN NOT w THEN t WHEN d = 'O' AND t = '10' THEN 'CP' WHEN d = 'O' AND t = '20' THEN 'EP'
    WHEN d = 'O' AND {MISS['t']} AND tl = 'PE' THEN 'CZ' ELSE t END AS t) FROM o2),
o4 AS (SELECT * REPLACE (CASE WHEN w AND {OLD_LICENCE} THEN 'CP' ELSE t END AS t) FROM o3),
o5 AS (SELECT * REPLACE (CASE WHEN w AND (r IS NULL OR r <> 'N') AND {MISS['t']} THEN 'N' ELSE r END AS r) FROM o4),
o6 AS (SELECT * REPLACE (CASE WHEN w AND {OLD_LICENCE} THEN 'CP' WHEN w AND d = 'N' AND r = 'O' AND (i IS NULL OR i <> '') AND t IN ('10', '20')
  THEN CASE t WHEN '10' THEN 'CP' ELSE 'EP' END WHEN w AND t = 'CC' AND tr = 'XA' AND r = 'O' THEN 'CP' ELSE t END AS t) FROM o5),
o7 AS (SELECT * REPLACE (CASE WHEN w AND d = 'O' AND r = 'O' AND NOT {MISS['t']} AND NOT {MISS['i']} THEN 'N' ELSE d END AS d) FROM o6)"""


def outcomes(spark, sf):
    """The job's outcome step; files of years before 2012 lack the outcome columns."""
    both = F.lit(columns_mask(("RESDIP", "RESINT")))
    return correct.outcomes(deg(spark, sf).withColumn(FILE_COLUMNS, F.when(F.col("RENTREE") >= "2012", both).otherwise(F.lit(0)).cast("bigint")))


@query("r14_read_time_recodes", f'WITH {OUTCOMES} SELECT k, t AS "TYP_DIPINT", di AS "DISCIPLINT", r AS "RESINT" FROM o7', ["deg"])
def r14(spark, sf):
    return outcomes(spark, sf).select("k", "TYP_DIPINT", "DISCIPLINT", "RESINT")


@query("r15_outcome_by_source", f'WITH {OUTCOMES} SELECT k, d AS "RESDIP", r AS "RESINT", f AS "FLAG_MEEF" FROM o7', ["deg"])
def r15(spark, sf):
    return outcomes(spark, sf).select("k", "RESDIP", "RESINT", "FLAG_MEEF")


@query("r16_sector_recode", """
SELECT k, CASE WHEN "SECTDIS" IN ('2A', '2B', '2C', '2E') THEN '21' WHEN "SECTDIS" = '2D' THEN '27' ELSE "SECTDIS" END AS "SECTDIS",
  CASE WHEN "SECTDIS" IN ('2A', '2B', '2C', '2E', '2D') THEN '04' ELSE "DISCIPLI" END AS "DISCIPLI" FROM deg""", ["deg"])
def r16(spark, sf):
    return correct.recode_sectors(deg(spark, sf), "SECTDIS", "DISCIPLI").select("k", "SECTDIS", "DISCIPLI")


@query("r17_intermediate_type_recodes", f'WITH {OUTCOMES} SELECT k, s AS "SOURCE", t AS "TYP_DIPINT" FROM o7', ["deg"])
def r17(spark, sf):
    return outcomes(spark, sf).select("k", "SOURCE", "TYP_DIPINT")


@query("r17_outcome_consistency", f'WITH {OUTCOMES} SELECT k, t AS "TYP_DIPINT", r AS "RESINT", d AS "RESDIP" FROM o7', ["deg"])
def r17_consistency(spark, sf):
    return outcomes(spark, sf).select("k", "TYP_DIPINT", "RESINT", "RESDIP")


@query("r18_units_as_establishments", """
SELECT k, CASE WHEN "COMPOS" = '0753364Z' THEN "COMPOS" ELSE "ETABLI" END AS "ETABLI",
  CASE WHEN "COMPOS" = '0753364Z' THEN "COMPOS" ELSE "ETABLI" END AS "ETABLI_ORI_UAI" FROM deg""", ["deg"])
def r18(spark, sf):
    df = deg(spark, sf).withColumn("ETABLI_ORI_UAI", F.col("ETABLI"))
    return correct.units_as_establishments(df).select("k", "ETABLI", "ETABLI_ORI_UAI")



@query("r19_private_flags", f"""
SELECT k, CASE WHEN "SOURCE" = 'priv' AND {blank('"PAR_TYPE"')} THEN '1' ELSE "FLAG_MEEF" END AS "FLAG_MEEF",
  CASE WHEN "SOURCE" = 'priv' AND {blank('"PAR_TYPE"')} THEN 0 END AS "EFF_SS_ESPE" FROM deg""", ["deg"])
def r19(spark, sf):
    df = deg(spark, sf).withColumn("ID_PAYSAGE_FORMENS", F.col("PAR_TYPE"))
    return correct.private_flags(df).select("k", "FLAG_MEEF", "EFF_SS_ESPE")



@query("r20_literal_overrides", f"""
SELECT k, CASE "COMPOS" WHEN '0011312W' THEN '0694121E' WHEN '0133479L' THEN '0131844J' END AS "UR",
  CASE WHEN "BAC" IN ('0037', '0031') THEN '7' WHEN "BAC" = 'ES' THEN '2' ELSE "BAC_RGRP" END AS "BAC_RGRP",
  CASE WHEN {blank('"FR_ETR"')} THEN '9' ELSE "FR_ETR" END AS "SITUPRE", CASE WHEN "NATION" IN ('600', '900', '993', '996', '998', '$') THEN '999' ELSE "NATION" END AS "NATION",
  CASE WHEN CAST("RENTREE" AS INT) - 5 BETWEEN 2004 AND 2008 THEN '99' ELSE "ACABAC" END AS "PCSPAR2" FROM deg""", ["deg"])
def r20(spark, sf):
    """Years are moved back by five, so some are the years of the second occupation's rule."""
    df = deg(spark, sf).withColumns({
        "PCSPAR2": F.col("ACABAC"), "SITUPRE": F.col("FR_ETR"), "RENTREE": (F.col("RENTREE").cast("int") - 5).cast("string")})
    return correct.origin_codes(correct.parent_unit(df)).select("k", "UR", "BAC_RGRP", "SITUPRE", "NATION", "PCSPAR2")


@query("r21_private_cycles", """
WITH a AS (SELECT k, "SOURCE" = 'priv' AND "CURSUS_LMD_INT" = 'X' AND "RESINT" = 'O' AS open, "CURSUS_LMD_INT" AS c, "TYP_DIPINT" AS t, "TYP_DIPL" AS l FROM deg)
SELECT k, CASE WHEN open AND t = 'CP' THEN 'L' WHEN open AND (t = 'EP' OR t = '' AND l = 'XB') THEN 'M'
  WHEN open AND t = '' AND l IN ('TB', 'TE') THEN 'D' ELSE c END AS "CURSUS_LMD_INT", t AS "TYP_DIPINT" FROM a""", ["deg"])
def r21(spark, sf):
    return correct.private_cycles(deg(spark, sf)).select("k", "CURSUS_LMD_INT", "TYP_DIPINT")


@query("r22_blank_intermediate_columns", """
SELECT k, CASE WHEN c THEN '' ELSE "TYP_DIPINT" END AS "TYP_DIPINT", CASE WHEN c THEN '' ELSE "DIPINT" END AS "DIPINT",
  CASE WHEN c THEN '' ELSE "CURSUS_LMD_INT" END AS "CURSUS_LMD_INT", CASE WHEN c THEN '' ELSE "SECTINT" END AS "SECTINT",
  CASE WHEN c THEN '' ELSE "DISCIPLINT" END AS "DISCIPLINT", CASE WHEN c THEN '' ELSE "BAC" END AS "GROUPINT",
  CASE WHEN c THEN '' ELSE "LMDDONTBIS_INT" END AS "LMDDONTBIS_INT",
  CASE WHEN c THEN 0 ELSE h1 END AS "EFFECTIF_INT" FROM (SELECT *, coalesce("RESDIP" = 'O' AND "RESINT" IN ('N', 'X'), FALSE) AS c FROM deg)""", ["deg"])
def r22(spark, sf):
    df = deg(spark, sf).withColumns({"EFFECTIF_INT": F.col("h1"), "GROUPINT": F.col("BAC")})
    return correct.blank_intermediate(df).select("k", *correct.INTERMEDIATE_COLUMNS, "EFFECTIF_INT")


@query("r23_engineers_and_doctoral_schools", """
WITH a AS (SELECT * REPLACE (CASE WHEN "TYP_DIPL" = 'UT' THEN 'JD' ELSE "TYP_DIPL" END AS "TYP_DIPL"),
  coalesce("SOURCE" = 'inge' AND "RESDIP" = 'O' AND "DIPLOM" = '6000361' AND "TYP_DIPL" = '99', FALSE) AS e FROM deg),
b AS (SELECT k, CASE WHEN e THEN 'M' ELSE "CURSUS_LMDR" END AS c, CASE WHEN e THEN '16' ELSE "SECTDIS" END AS s,
  CASE WHEN e THEN '15' ELSE "DISCIPLI" END AS di, CASE WHEN e THEN 'FI' ELSE "TYP_DIPL" END AS t, "ID_PAYSAGE_ED" AS ed FROM a)
SELECT k, s AS "SECTDIS", di AS "DISCIPLI", t AS "TYP_DIPL", CASE WHEN c IS NULL OR c <> 'D' THEN '' ELSE ed END AS "ID_PAYSAGE_ED",
  CASE WHEN t = 'JD' AND c = 'L' THEN 'M' ELSE c END AS "CURSUS_LMDR" FROM b""", ["deg"])
def r23(spark, sf):
    kind = F.when(F.col("TYP_DIPL") == "UT", "JD").otherwise(F.col("TYP_DIPL"))
    df = correct.doctoral_schools(correct.engineers(deg(spark, sf).withColumn("TYP_DIPL", kind)))
    return df.select("k", "SECTDIS", "DISCIPLI", "TYP_DIPL", "ID_PAYSAGE_ED", "CURSUS_LMDR")


@query("r24_swap_double_award", """
SELECT k, CASE WHEN c THEN 'O' ELSE "RESDIP" END AS "RESDIP", CASE WHEN c THEN 'X' ELSE "RESINT" END AS "RESINT",
  CASE WHEN c THEN 1 ELSE h1 END AS "EFFECTIF_R", CASE WHEN c THEN 0 ELSE h2 END AS "EFFECTIF_INT"
FROM (SELECT *, coalesce("TYP_DIPINT" = 'UT' AND "RESDIP" = 'X' AND "RESINT" = 'O' AND "ETABLI" = '0912423P' AND "TYP_DIPL" = 'UT', FALSE) AS c FROM deg)""",
       ["deg"])
def r24(spark, sf):
    df = deg(spark, sf).withColumns({"EFFECTIF_R": F.col("h1"), "EFFECTIF_INT": F.col("h2"), "ETABLI_ORI_UAI": F.col("ETABLI")})
    return correct.swap_double_award(df).select("k", "RESDIP", "RESINT", "EFFECTIF_R", "EFFECTIF_INT")


@query("r25_commune_of_unit", """
SELECT k, CASE WHEN "COMINS" = substr("COMPOS", 1, 5) AND NOT coalesce(ui IN ('9730224F'), FALSE) THEN ''
  WHEN "COMINS" IS NULL OR "COMINS" <> '' THEN "COMINS" ELSE "DEPBAC" END AS "COMUI"
FROM (SELECT k, "COMPOS", "DEPBAC", CASE WHEN h1 % 4 = 0 THEN '9730224F' ELSE "COMPOS" END AS ui,
  CASE WHEN h3 % 5 = 0 THEN substr("COMPOS", 1, 5) ELSE "COMINS" END AS "COMINS" FROM deg)""", ["deg"])
def r25(spark, sf):
    df = deg(spark, sf).withColumns({
        "COMINS": F.when(F.col("h3") % 5 == 0, F.substring("COMPOS", 1, 5)).otherwise(F.col("COMINS")), "COMUI": F.col("DEPBAC"),
        "UI": F.when(F.col("h1") % 4 == 0, "9730224F").otherwise(F.col("COMPOS"))})
    return correct.commune_of_unit(df).select("k", "COMUI")
