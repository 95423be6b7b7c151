"""S: sources and sinks. Each query writes what it needs to a fresh work folder and reads it back."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.scalars import json_map
from ..operators.lookups import bounded
from ..plans import correct, ledger
from ..sources import catalogue as cat
from ..sources.contracts import RAW_COLUMNS, contract, raw_contract
from ..sources.documents import read_document
from ..sources.facts import land, normalise_landing, read_fact, write_fact
from ..sources.maps import parent_units, unit_communes
from ..sources.opendata import FORMAT, join_files, read_open_csv, write_open_csv, write_year_files
from ..sources.sheets import normalise_cells, read_sheet_folder, read_sheets, write_sheets
from ..session import work_dir
from .base import query, table, view
from .scalars import BLANKS

IN_CATALOGUE = """("SOURCE" IN ('result', 'ens', 'inge', 'priv') AND "RENTREE" >= '2015'
  OR "SOURCE" = 'mana' AND "RENTREE" >= '2018' OR "SOURCE" IN ('enq', 'culture') AND "RENTREE" >= '2019')"""


def facts(spark, sf):
    return view(spark, sf, "deg").select("SOURCE", "RENTREE", "k", "RESDIP", "DIPLOM")


def written(spark, sf):
    root = work_dir(spark, "facts")
    write_fact(facts(spark, sf), root)
    return root


@query("s1_source_catalogue", f"""
SELECT "SOURCE", "RENTREE", count(*) AS n FROM deg WHERE {IN_CATALOGUE} GROUP BY 1, 2""", ["deg"])
def s1(spark, sf):
    known = facts(spark, sf).join(bounded(cat.catalogue(spark)), ["SOURCE", "RENTREE"], "left_semi")
    return known.groupBy("SOURCE", "RENTREE").agg(F.count(F.lit(1)).alias("n"))


@query("s2_locate_partition", """
SELECT k, "RESDIP", "DIPLOM" FROM deg WHERE "SOURCE" = 'enq' AND "RENTREE" = '2019'""", ["deg"])
def s2(spark, sf):
    return spark.read.parquet(cat.fact_path(written(spark, sf), "enq", 2019))


@query("s3_scan_raw_fact", """
SELECT "SOURCE", "RENTREE", k, "RESDIP", "DIPLOM", CAST(NULL AS BIGINT) AS "ANBAC" FROM deg
WHERE "SOURCE" IN ('result', 'ens') AND "RENTREE" IN ('2015', '2016')""", ["deg"])
def s3(spark, sf):
    schema = contract(["k", "RESDIP", "DIPLOM", "ANBAC"], ["k", "ANBAC"])
    return read_fact(spark, written(spark, sf), ["result", "ens"], [2015, 2016], schema)


@query("s4_scan_corrected_fact", """
SELECT "SOURCE", "RENTREE", k, "RESDIP", "DIPLOM" FROM deg WHERE "RENTREE" = '2020'""", ["deg"])
def s4(spark, sf):
    return read_fact(spark, written(spark, sf), years=[2020])


@query("s5_parquet_sink", """
SELECT "SOURCE", "RENTREE", k, CASE WHEN "RENTREE" = '2021' THEN 'Z' ELSE "RESDIP" END AS "RESDIP", "DIPLOM" FROM deg""",
       ["deg"])
def s5(spark, sf):
    root = written(spark, sf)
    last_year = facts(spark, sf).filter(F.col("RENTREE") == "2021").withColumn("RESDIP", F.lit("Z"))
    write_fact(last_year, root, rebalance=True)
    return read_fact(spark, root)


@query("s6_csv_sink", """
SELECT CAST(k AS VARCHAR) || ';' || coalesce(status, '') || ';' || coalesce('"' || prio || '"";x"', '') AS line
FROM (SELECT k, status, prio FROM ord)""", ["ord"])
def s6(spark, sf):
    df = view(spark, sf, "ord").select("k", "status", F.concat("prio", F.lit('";x')).alias("prio"))
    root = work_dir(spark, "csv")
    write_open_csv(df, root)
    return spark.read.text(root).filter(F.col("value") != "k;status;prio").select(F.col("value").alias("line"))


@query("s6_one_file_a_year", """
SELECT CAST(k AS VARCHAR) AS k, nullif(status, '') AS "Éta;pe", nullif('"' || prio || '";x', '') AS prio, CAST(y AS VARCHAR) AS y, CAST(y AS VARCHAR) || '.csv' AS file FROM ord""", ["ord"])
def s6_years(spark, sf):
    """One file a year with one header, from parts of many tasks."""
    df = view(spark, sf, "ord").select("k", F.col("status").alias("Éta;pe"), F.concat(F.lit('"'), "prio", F.lit('";x')).alias("prio"), "y").repartition(5)
    root = work_dir(spark, "years")
    files = write_year_files(df, root, "y")
    name = F.element_at(F.split(F.col("_metadata.file_path"), "/"), -1).alias("file")
    return spark.read.options(header=True, **FORMAT).csv(files).select("*", name)


@query("s7_csv_scan", """
SELECT CAST(k AS VARCHAR) AS k, nullif(status, '') AS "Étape", CAST(y AS VARCHAR) AS y FROM ord""", ["ord"])
def s7(spark, sf):
    root = work_dir(spark, "csv")
    write_open_csv(view(spark, sf, "ord").select("k", F.col("status").alias("Étape"), "y"), root, year="y")
    return read_open_csv(spark, root)


@query("s8_multi_table_json", """
SELECT 'BRANDS' AS sheet, p_brand AS a, p_type AS b FROM part GROUP BY p_brand, p_type
UNION ALL SELECT 'SIZES', CAST(p_size AS VARCHAR), '' FROM part GROUP BY p_size""")
def s8(spark, sf):
    brand = F.struct(F.col("p_brand").alias("a"), F.col("p_type").alias("b"))
    size = F.struct(F.concat(F.col("p_size").cast("string"), F.lit(".0")).alias("a"), F.lit(None).cast("string").alias("b"))
    docs = table(spark, sf, "part").select(F.array(brand).alias("BRANDS"), F.array(size).alias("SIZES"))
    root = work_dir(spark, "sheets")
    docs.write.option("ignoreNullFields", False).mode("overwrite").json(root)
    sheets = read_sheets(spark, root, whole=False)
    named = [sheets[n].select(F.lit(n).alias("sheet"), F.col("A").alias("a"), F.col("B").alias("b")) for n in ("BRANDS", "SIZES")]
    return named[0].unionByName(named[1])


@query("s8_document_in_parts", """
SELECT 'BRANDS' AS sheet, p_brand || '}"{\\,]' || p_type AS a, CASE WHEN p_size % 3 = 0 THEN '' ELSE CAST(p_size AS VARCHAR) END AS b FROM part GROUP BY ALL
UNION ALL SELECT 'SIZES', CAST(p_size AS VARCHAR), '' FROM part GROUP BY p_size
UNION ALL SELECT 'BRANDS', '-', '-' UNION ALL SELECT 'SIZES', '-', '-'""")
def s8_parts(spark, sf):
    """One JSON document, cut at bytes by the reader: braces, quotes and backslashes stand in its texts."""
    part, root = table(spark, sf, "part"), work_dir(spark, "document")
    first = part.select(F.concat("p_brand", F.lit('}"{\\,]'), "p_type").alias("a"), F.when(F.col("p_size") % 3 != 0, F.col("p_size")).alias("b"))
    second = part.select(F.concat(F.col("p_size").cast("string"), F.lit(".0")).alias("a"), F.lit(None).cast("string").alias("b"))
    halves = []
    for name, rows, head in (("brands", first, '{"EMPTY": [], "BRANDS": [ {"a": "-", "b": "-"}\n'), ("sizes", second, '], "SIZES" : [\n{"a": "-", "b": "-"}\n')):
        rows.select(F.concat(F.lit(", "), F.to_json(F.struct("a", "b"), {"ignoreNullFields": "false"}))).write.text(f"{root}/{name}")
        parts = sorted(f for f in spark.read.text(f"{root}/{name}").inputFiles())
        join_files(spark, parts, f"{root}/{name}.half", head, "]}\n" if name == "sizes" else "")
        halves.append(f"{root}/{name}.half")
    join_files(spark, halves, f"{root}/document.json")
    sheets = read_document(spark, f"{root}/document.json")
    named = [sheets[n].select(F.lit(n).alias("sheet"), F.col("A").alias("a"), F.col("B").alias("b")) for n in ("BRANDS", "SIZES")]
    return named[0].unionByName(named[1])


@query("s9_multi_table_json_sink", """
SELECT 'CUS' AS sheet, CAST(c_custkey AS VARCHAR) AS key, c_name AS name FROM customer
UNION ALL SELECT 'SUP', CAST(s_suppkey AS VARCHAR), s_name FROM supplier""")
def s9(spark, sf):
    root = work_dir(spark, "sheets")
    write_sheets({
        "CUS": table(spark, sf, "customer").select(F.col("c_custkey").alias("key"), F.col("c_name").alias("name")),
        "SUP": table(spark, sf, "supplier").select(F.col("s_suppkey").alias("key"), F.col("s_name").alias("name")),
    }, root)
    back = read_sheet_folder(spark, root, ["CUS", "SUP"])
    named = [back[n].select(F.lit(n).alias("sheet"), F.col("KEY").alias("key"), F.col("NAME").alias("name")) for n in back]
    return named[0].unionByName(named[1])


@query("s10_workbook_cells", f"""
SELECT CAST(k AS VARCHAR) AS k, coalesce(trim(split_part(name, '.0', 1), {BLANKS}), '') AS name,
  coalesce(trim(split_part(code, '.0', 1), {BLANKS}), '') AS code FROM prt""", ["prt"])
def s10(spark, sf):
    return normalise_cells(view(spark, sf, "prt").select("k", "name", "code"))


@query("s11_parent_unit_map", """
SELECT CAST(year(ts) AS VARCHAR) AS "RENTREE", 'U' || event_id AS "COMPOS", json_extract_string(props, '$.k') AS "RATTACH"
FROM events""")
def s11(spark, sf):
    maps = table(spark, sf, "events").select(
        F.year("ts").cast("string").alias("RENTREE"),
        F.transform_keys(json_map("props"), lambda k, v: F.concat(F.lit("U"), F.col("event_id").cast("string"))).alias("RATTACH_MAP"))
    return parent_units(maps)


@query("s12_unit_commune_map", """
SELECT CAST(month(ts) AS VARCHAR) AS "RENTREE", json_extract_string(props, '$.k') AS "COMCODE",
  event_type || '-' || event_id AS "UAI" FROM events""")
def s12(spark, sf):
    unit = F.concat_ws("-", "event_type", F.col("event_id").cast("string"))
    maps = table(spark, sf, "events").select(
        F.month("ts").cast("string").alias("RENTREE"),
        F.transform_keys(json_map("props"), lambda k, v: unit).alias("COMCOMP_MAP"))
    return unit_communes(maps)


@query("p9_outcomes_by_file", """
SELECT k AS "IDETU", '2014' AS "RENTREE", nullif("RESDIP", 'None') AS "RESDIP", nullif("RESINT", 'None') AS "RESINT" FROM deg WHERE "RESDIP" = 'O' OR "RESINT" = 'O'
UNION ALL SELECT k, '2022', 'O', 'N' FROM deg""", ["deg"])
def p9_by_file(spark, sf):
    """Two landed files, with and without outcome columns, in years that no list names: what a file holds stays, the rest is awarded."""
    root = work_dir(spark, "landing")
    both = view(spark, sf, "deg").select(F.col("k").cast("string").alias("idetu"), F.lit("ZZ").alias("typ_dipint"), "RESDIP", "RESINT")
    both.write.parquet(f"{root}/with")
    both.drop("RESDIP", "RESINT").write.parquet(f"{root}/without")
    raw = land(spark, f"{root}/with", "result", 2014, raw_contract(RAW_COLUMNS)).unionByName(land(spark, f"{root}/without", "result", 2022, raw_contract(RAW_COLUMNS)))
    out = correct.normalise(raw)
    return out.select(F.col("IDETU").cast("bigint").alias("IDETU"), "RENTREE", "RESDIP", "RESINT")


@query("s13_missing_partitions", f"""
WITH have AS (SELECT DISTINCT "SOURCE", CAST(CAST("RENTREE" AS INT) - 2 AS VARCHAR) AS "RENTREE" FROM deg),
want AS (SELECT DISTINCT "SOURCE", "RENTREE" FROM deg WHERE {IN_CATALOGUE})
SELECT * FROM want EXCEPT SELECT * FROM have""", ["deg"])
def s13(spark, sf):
    df = view(spark, sf, "deg")
    have = df.select("SOURCE", (F.col("RENTREE").cast("int") - 2).cast("string").alias("RENTREE"))
    return cat.missing_partitions(cat.catalogue(spark), have)


def landed_twice(spark, sf):
    """Three files in two landings: one stays, one changes, one is new. A landing that was never put in force lies beside them."""
    root = work_dir(spark, "ledger")
    landing, target = f"{root}/landing", f"{root}/raw"

    def put(source, outcome, **how):
        rows = view(spark, sf, "deg").filter((F.col("SOURCE") == source) & (F.col("RENTREE") == "2016"))
        rows.select(F.col("k").cast("string").alias("idetu"), F.lit(outcome).alias("resdip"), "DIPLOM").write.mode("overwrite").parquet(f"{landing}/{cat.landing_name(source, 2016)}")

    put("result", "O")
    put("ens", "O")
    ledger.land_changed(spark, landing, target, [("result", 2016), ("ens", 2016)])
    put("ens", "N")
    put("inge", "O")
    view(spark, sf, "deg").withColumns({"SOURCE": F.lit("result"), "RENTREE": F.lit("2016")}).write.partitionBy("SOURCE", "RENTREE").parquet(f"{target}/land=torn")
    return target, ledger.land_changed(spark, landing, target, [("result", 2016), ("ens", 2016), ("inge", 2016)])


LANDED = """SELECT k, "SOURCE", "RENTREE", "DIPLOM" FROM deg WHERE "RENTREE" = '2016' AND "SOURCE" IN ('result', 'ens', 'inge')"""


@query("s13_landing_states", f"""
SELECT "SOURCE", "RENTREE", count(*) AS n_rows, CASE "SOURCE" WHEN 'result' THEN 'same' WHEN 'ens' THEN 'changed' ELSE 'new' END AS state, 3 AS n_columns FROM ({LANDED}) GROUP BY 1, 2""", ["deg"])
def s13_states(spark, sf):
    _, states = landed_twice(spark, sf)
    return states.select("SOURCE", "RENTREE", "n_rows", "state", F.size("columns").alias("n_columns"))


@query("s5_landed_by_ledger", f"""
SELECT CAST(k AS VARCHAR) AS "IDETU", "SOURCE", "RENTREE", CASE "SOURCE" WHEN 'ens' THEN 'N' ELSE 'O' END AS "RESDIP", nullif("DIPLOM", 'nan') AS "DIPLOM" FROM ({LANDED})""", ["deg"])
def s5_ledger(spark, sf):
    """What the ledger names: the changed file once, in its last state, and nothing of the torn landing."""
    target, _ = landed_twice(spark, sf)
    return ledger.read_landed(spark, target).select("IDETU", "SOURCE", "RENTREE", "RESDIP", "DIPLOM")


@query("s14_landing_text", f"""
SELECT doc_id AS "DOC_ID", lang AS "LANG", n_chars AS "N_CHARS", source AS "SOURCE", md5(CASE WHEN t = 'nan' THEN '' ELSE
  trim(replace(t, chr(160), ' '), {BLANKS}) END) AS "TEXT"
FROM (SELECT *, trim(split_part(text, '.0', 1), {BLANKS}) AS t FROM documents)""")
def s14(spark, sf):
    return normalise_landing(table(spark, sf, "documents")).withColumn("TEXT", F.md5("TEXT"))


@query("s14_landing_numbers", """
SELECT c_custkey AS "C_CUSTKEY", c_name AS "C_NAME", c_nationkey AS "C_NATIONKEY",
  CAST(trunc(c_acctbal) AS BIGINT) AS "C_ACCTBAL", c_mktsegment AS "C_MKTSEGMENT" FROM customer""")
def s14_numbers(spark, sf):
    return normalise_landing(table(spark, sf, "customer"))
