"""C: scalar functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import scalars as S
from ..functions.nulls import cut_at, norm_text
from ..operators.rules import year_bounds
from ..sources.maps import map_to_rows
from .base import miss, query, table, view

BLANKS = "concat(' ', chr(9), chr(10), chr(13), chr(11), chr(12), chr(160))"


@query("c1_cut_and_trim", f"SELECT k, trim(split_part(name, '.0', 1), {BLANKS}) AS name, "
       f"trim(split_part(code, '.0', 1), {BLANKS}) AS code FROM prt", ["prt"])
def c1(spark, sf):
    return view(spark, sf, "prt").select("k", cut_at("name").alias("name"), cut_at("code").alias("code"))


@query("c2_missing_tokens", """
SELECT k, CASE WHEN status IN ('nan', 'None', '<NA>') THEN NULL ELSE status END AS to_null,
  CASE WHEN year_text IN ('nan', 'None', '<NA>') THEN '' ELSE year_text END AS to_empty FROM ord""", ["ord"])
def c2(spark, sf):
    return view(spark, sf, "ord").select(
        "k", norm_text("status", cut=None).alias("to_null"), norm_text("year_text", cut=None, missing="").alias("to_empty"))


@query("c3_nbsp_to_space", f"""
SELECT doc_id, md5(trim(replace(trim(text, {BLANKS}), chr(160), ' '), {BLANKS})) AS text_md5 FROM documents""")
def c3(spark, sf):
    return table(spark, sf, "documents").select("doc_id", F.md5(norm_text("text", cut=None, tokens=())).alias("text_md5"))


@query("c4_zero_pad", """
SELECT k, CASE WHEN length(code) = 1 AND code BETWEEN '0' AND '9' THEN concat('0', code) ELSE code END AS code FROM prt""",
       ["prt"])
def c4(spark, sf):
    return view(spark, sf, "prt").select("k", S.zero_pad("code").alias("code"))


@query("c5_strip_one_zero", """
WITH t AS (SELECT s_suppkey AS k, CASE s_suppkey % 5 WHEN 0 THEN NULL WHEN 1 THEN 'HORS' WHEN 2 THEN '0HORS'
  ELSE lpad(CAST(s_suppkey AS VARCHAR), 4, '0') END AS code FROM supplier),
u AS (SELECT k, CASE WHEN code LIKE '0%' THEN substr(code, 2) ELSE code END AS code FROM t)
SELECT k, CASE WHEN code = 'HORS' THEN '' ELSE code END AS code FROM u""")
def c5(spark, sf):
    k = F.col("s_suppkey")
    code = (F.when(k % 5 == 0, None).when(k % 5 == 1, "HORS").when(k % 5 == 2, "0HORS")
            .otherwise(F.lpad(k.cast("string"), 4, "0")))
    return table(spark, sf, "supplier").select(k.alias("k"), S.strip_zero(code).alias("code"))


@query("c6_exact_recode", """
SELECT k, CASE WHEN "NATION" IN ('20', '600', '$') THEN '999' ELSE "NATION" END AS nation,
  CASE WHEN "ETABLI" = '0352771X' THEN '0352692L' WHEN "ETABLI" = '9730224F' THEN '0694045X' ELSE "ETABLI" END AS etabli
FROM deg""", ["deg"])
def c6(spark, sf):
    return view(spark, sf, "deg").select(
        "k", S.recode("NATION", {"20": "999", "600": "999", "$": "999"}).alias("nation"),
        S.recode("ETABLI", {"0352771X": "0352692L", "9730224F": "0694045X"}).alias("etabli"))


@query("c7_default_for_missing", f"""
SELECT k, CASE WHEN {miss('status')} THEN '$' ELSE status END AS status,
  CASE WHEN {miss('prio')} THEN '9' ELSE prio END AS prio,
  CASE WHEN {miss('year_text')} THEN '9999' ELSE year_text END AS year_text FROM ord""", ["ord"])
def c7(spark, sf):
    return view(spark, sf, "ord").select(
        "k", S.default_missing("status", "$").alias("status"), S.default_missing("prio", "9").alias("prio"),
        S.default_missing("year_text", "9999").alias("year_text"))


@query("c8_suffix_code", """
SELECT k, CASE WHEN "BAC" IN ('A2-8', 'A6', 'A6-8', 'A7', 'A7-8')
  THEN CASE WHEN "BAC" LIKE '%-%' THEN "BAC" || '5' ELSE "BAC" || '-85' END ELSE "BAC" END AS bac FROM deg""", ["deg"])
def c8(spark, sf):
    codes = ("A2-8", "A6", "A6-8", "A7", "A7-8")
    return view(spark, sf, "deg").select("k", S.suffix_code("BAC", codes).alias("bac"))


@query("c9_prefix_and_window", "SELECT k, substr(brand, 1, 5) AS head, substr(name, 2, 3) AS middle FROM prt", ["prt"])
def c9(spark, sf):
    return view(spark, sf, "prt").select("k", S.prefix("brand", 5).alias("head"), S.prefix("name", 3, 2).alias("middle"))


@query("c10_length_tests", """
SELECT kind, CAST(sum(CASE WHEN length(code) < 3 THEN 1 ELSE 0 END) AS BIGINT) AS n_short,
  CAST(sum(CASE WHEN length(name) > 12 THEN 1 ELSE 0 END) AS BIGINT) AS n_long FROM prt GROUP BY kind""", ["prt"])
def c10(spark, sf):
    short = F.col("code").isNotNull() & ~S.len_at_least("code", 3)
    return view(spark, sf, "prt").groupBy("kind").agg(
        F.sum(F.when(short, 1).otherwise(0)).alias("n_short"),
        F.sum(F.when(S.len_at_least("name", 13), 1).otherwise(0)).alias("n_long"))


@query("c11_academic_year", """
SELECT y, CAST(y AS VARCHAR) || '-' || substr(CAST(y + 1 AS VARCHAR), 3, 2) AS academic_year,
  CAST(y + 1 AS VARCHAR) AS session, count(*) AS n FROM ord GROUP BY y""", ["ord"])
def c11(spark, sf):
    counts = view(spark, sf, "ord").groupBy("y").agg(F.count(F.lit(1)).alias("n"))
    return counts.select("y", S.academic_year("y").alias("academic_year"), S.session("y").alias("session"), "n")


@query("c12_join_codes", "SELECT k, status || prio AS pair FROM ord", ["ord"])
def c12(spark, sf):
    return view(spark, sf, "ord").select("k", S.join_codes("status", "prio").alias("pair"))


@query("c13_breadcrumb", """
SELECT k, CASE WHEN a IS NULL OR b IS NULL OR c IS NULL THEN NULL ELSE
  a || CASE WHEN a = b THEN '' ELSE '>' || b END || CASE WHEN b = c THEN '' ELSE '>' || c END END AS path
FROM (SELECT k, kind AS a, CASE WHEN size % 3 = 0 THEN kind WHEN size % 11 = 0 THEN NULL ELSE brand END AS b,
  CASE WHEN size % 2 = 0 THEN brand ELSE CAST(size AS VARCHAR) END AS c FROM prt)""", ["prt"])
def c13(spark, sf):
    size = F.col("size")
    levels = view(spark, sf, "prt").select(
        "k", F.col("kind").alias("a"),
        F.when(size % 3 == 0, F.col("kind")).when(size % 11 == 0, None).otherwise(F.col("brand")).alias("b"),
        F.when(size % 2 == 0, F.col("brand")).otherwise(size.cast("string")).alias("c"))
    return levels.select("k", S.breadcrumb("a", "b", "c").alias("path"))


@query("c14_yes_no_and_sex", """
SELECT k, CASE WHEN "RESDIP" = 'O' THEN 'Oui' ELSE 'Non' END AS obtained,
  CASE "SEXE" WHEN '1' THEN 'M' WHEN '2' THEN 'F' ELSE "SEXE" END AS sex,
  CASE "SEXE" WHEN '1' THEN 'Homme' WHEN '2' THEN 'Femme' ELSE 'Inconnu' END AS sex_label FROM deg""", ["deg"])
def c14(spark, sf):
    return view(spark, sf, "deg").select(
        "k", S.yes_no("RESDIP").alias("obtained"), S.recode("SEXE", {"1": "M", "2": "F"}).alias("sex"),
        S.recode("SEXE", {"1": "Homme", "2": "Femme"}, default=F.lit("Inconnu")).alias("sex_label"))


@query("c15_integer_difference", """
SELECT k, CAST("ANBAC" AS BIGINT) - CAST("ANNAIS" AS BIGINT) AS age FROM deg""", ["deg"])
def c15(spark, sf):
    return view(spark, sf, "deg").select("k", S.diff_int("ANBAC", "ANNAIS").alias("age"))


@query("c16_integer_sum", "SELECT k, line, qty + even_part AS total, even_part + flag_s AS flags FROM lin", ["lin"])
def c16(spark, sf):
    return view(spark, sf, "lin").select(
        "k", "line", S.total("qty", "even_part").alias("total"), S.total(F.col("even_part"), "flag_s").cast("bigint").alias("flags"))


@query("c17_year_range", """
WITH r AS (SELECT cust, CASE WHEN cust % 4 = 0 THEN '' ELSE CAST(min(y) AS VARCHAR) END AS lo,
  CAST(max(y) AS VARCHAR) AS hi FROM ord GROUP BY cust),
s AS (SELECT cust, CASE WHEN lo = '' THEN (SELECT min(y) FROM ord) ELSE CAST(lo AS BIGINT) END AS a,
  CASE WHEN lo = '' THEN (SELECT max(y) FROM ord) ELSE CAST(hi AS BIGINT) END AS b FROM r)
SELECT cust, CAST(unnest(generate_series(a, b)) AS VARCHAR) AS year FROM s""", ["ord"])
def c17(spark, sf):
    orders = view(spark, sf, "ord")
    ranges = orders.groupBy("cust").agg(F.min("y").alias("lo"), F.max("y").alias("hi"))
    start = F.when(F.col("cust") % 4 == 0, F.lit("")).otherwise(F.col("lo").cast("string"))
    return ranges.select("cust", F.explode(S.year_range(start, F.col("hi").cast("string"), *year_bounds(orders, "y"))).alias("year"))


@query("c18_flatten_lists", """
SELECT vec_id, len(list_concat(embedding, embedding)) AS n, 
  len(list_filter(list_concat(embedding, embedding), lambda x: x > 0)) AS n_positive FROM embeddings""")
def c18(spark, sf):
    flat = S.flatten_lists(F.array("embedding", "embedding"))
    positive = F.size(F.filter(flat, lambda x: x > 0)).cast("bigint")
    return table(spark, sf, "embeddings").select("vec_id", F.size(flat).cast("bigint").alias("n"), positive.alias("n_positive"))


@query("c19_map_to_rows", """
SELECT event_id, key AS name, json_extract_string(props, '$."' || key || '"') AS value
FROM (SELECT event_id, props, unnest(json_keys(props)) AS key FROM events)""")
def c19(spark, sf):
    return map_to_rows(table(spark, sf, "events"), S.json_map("props"), "name", "value", ("event_id",))


@query("c20_json_round_trip", """
SELECT event_id, json_extract_string(props, '$.k') AS k, '{"kind":"' || event_type || '","user":' || user_id || '}' AS packed
FROM events""")
def c20(spark, sf):
    packed = F.to_json(F.struct(F.col("event_type").alias("kind"), F.col("user_id").alias("user")))
    return table(spark, sf, "events").select(
        "event_id", F.try_element_at(S.json_map("props"), F.lit("k")).alias("k"), packed.alias("packed"))
