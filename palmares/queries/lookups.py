"""F: filters; L: lookups."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.nulls import pd_ne
from ..functions.scalars import breadcrumb
from ..operators import filters as flt, lookups as L, rules as R
from ..plans import correct
from .base import miss, query, table, view

# Filters ------------------------------------------------------------------


@query("f1_null_tolerant_exclusion", "SELECT k, flag, status FROM ord WHERE (flag IS NULL OR flag <> '1') "
       "AND (status IS NULL OR status <> 'F')", ["ord"])
def f1(spark, sf):
    return flt.exclude(flt.exclude(view(spark, sf, "ord"), "flag", "1"), "status", "F").select("k", "flag", "status")


@query("f2_keep_any", """
SELECT k FROM deg WHERE "SOURCE" NOT IN ('result', 'priv') OR "RESDIP" = 'O' OR "RESINT" = 'O'""", ["deg"])
def f2(spark, sf):
    conds = [~F.col("SOURCE").isin("result", "priv"), F.col("RESDIP") == "O", F.col("RESINT") == "O"]
    return flt.keep_any(view(spark, sf, "deg"), conds).select("k")


@query("f3_remove_empty_results", f"""
SELECT k FROM deg WHERE NOT coalesce({miss('"DIPLOM"')} AND "TYP_DIPR" = '99' AND {miss('"DIPINT"')}
  AND {miss('"TYP_DIPINT"')}, FALSE)""", ["deg"])
def f3(spark, sf):
    df = view(spark, sf, "deg").withColumn("DIPLOMR", F.col("DIPLOM"))
    return correct.drop_empty_results(df).select("k")


DELETE_RULES = """
SELECT s_suppkey, CASE WHEN s_suppkey % 4 = 0 THEN 'A' ELSE '' END AS rflag, CAST(s_suppkey AS VARCHAR) AS supp,
  CASE WHEN s_suppkey % 4 = 1 THEN 'O' ELSE '' END AS lstatus, CAST(1994 + s_suppkey % 8 AS VARCHAR) AS ship_year,
  CASE WHEN s_suppkey % 4 = 2 THEN '1' ELSE '' END AS line
FROM supplier"""


@query("f4_rule_delete", f"""
WITH r AS ({DELETE_RULES}),
l AS (SELECT k, line, CAST(supp AS VARCHAR) AS supp, rflag, lstatus, CAST(ship_year AS VARCHAR) AS ship_year,
  CAST(line AS VARCHAR) AS line_text FROM lin)
SELECT k, line FROM l WHERE NOT EXISTS (SELECT 1 FROM r WHERE r.supp = l.supp AND r.ship_year = l.ship_year AND (
  CASE WHEN r.rflag <> '' THEN r.rflag = l.rflag WHEN r.lstatus <> '' THEN r.lstatus = l.lstatus
       WHEN r.line <> '' THEN r.line = l.line_text ELSE TRUE END))""", ["lin"])
def f4(spark, sf):
    s = F.col("s_suppkey")
    rules = table(spark, sf, "supplier").select(
        F.when(s % 4 == 0, "A").otherwise("").alias("rflag"), s.cast("string").alias("supp"),
        F.when(s % 4 == 1, "O").otherwise("").alias("lstatus"), (1994 + s % 8).cast("string").alias("ship_year"),
        F.when(s % 4 == 2, "1").otherwise("").alias("line_text"))
    df = view(spark, sf, "lin").select(
        "k", "line", F.col("supp").cast("string").alias("supp"), "rflag", "lstatus",
        F.col("ship_year").cast("string").alias("ship_year"), F.col("line").cast("string").alias("line_text"))
    shapes = [(c, (c, "supp", "ship_year")) for c in ("rflag", "lstatus", "line_text")] + [(None, ("supp", "ship_year"))]
    return flt.delete_by_rules(df, rules, shapes).select("k", "line")


@query("f5_positive_measure", 'SELECT k, cents FROM cus WHERE cents > 0', ["cus"])
def f5(spark, sf):
    return flt.keep_positive(view(spark, sf, "cus"), "cents").select("k", "cents")


@query("f6_semi_by_attribute", """
SELECT k, cust FROM ord WHERE cust IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')""", ["ord"])
def f6(spark, sf):
    dim = table(spark, sf, "customer").withColumnRenamed("c_custkey", "cust")
    return flt.semi_by_attribute(view(spark, sf, "ord"), dim, "cust", "c_mktsegment", "BUILDING").select("k", "cust")


@query("f7_single_key_exclusion", """
SELECT k, "ETABLI" FROM deg WHERE "ETABLI" IS NULL OR "ETABLI" <> '0755555A'""", ["deg"])
def f7(spark, sf):
    return flt.exclude(view(spark, sf, "deg"), "ETABLI", "0755555A").select("k", "ETABLI")


@query("f8_targeted_suppression", f"""
SELECT k FROM deg WHERE NOT coalesce("SOURCE" = 'inge' AND "RENTREE" = '2020' AND "RESDIP" = 'O' AND "RESINT" = 'N'
  AND "DIPLOM" IN ('2500203', '2500164')
  AND "ETABLI" IN ('0597131F', '0632033T'), FALSE)""", ["deg"])
def f8(spark, sf):
    df = view(spark, sf, "deg").withColumn("ETABLI_ORI_UAI", F.col("ETABLI"))
    return flt.remove_where(df, correct.double_counted_codes()).select("k")


KNOWN_NATIONS = "(SELECT DISTINCT CAST(n_nationkey AS VARCHAR) AS code FROM nation)"


@query("f9_unknown_member", f"""
SELECT k, CASE WHEN CAST(c.nation + k % 3 * 20 AS VARCHAR) IN {KNOWN_NATIONS} AND k % 6 <> 0 THEN CAST(c.nation + k % 3 * 20 AS VARCHAR)
  ELSE '999' END AS nation FROM cus c""", ["cus"])
def f9(spark, sf):
    dim = table(spark, sf, "nation").select(F.col("n_nationkey").cast("string").alias("code"))
    nation = F.when(F.col("k") % 6 != 0, (F.col("nation") + F.col("k") % 3 * 20).cast("string"))
    return flt.unknown_to(view(spark, sf, "cus").select("k", nation.alias("nation")), "nation", dim, "code", "999")


@query("f10_gate_any", """
WITH g AS (SELECT cust, max(CASE WHEN prio IS NULL OR prio <> '1-URGENT' THEN 1 ELSE 0 END) AS open FROM ord GROUP BY cust)
SELECT k, CASE WHEN g.open = 1 AND status = 'O' THEN 'open' ELSE status END AS status FROM ord JOIN g USING (cust)""", ["ord"])
def f10(spark, sf):
    layers = R.compile_rules([R.rule({"status": "O"}, {"status": "open"})])
    df = view(spark, sf, "ord").select("k", "cust", "prio", "status")
    gated = flt.if_any(df, pd_ne("prio", "1-URGENT"), lambda d, gate: R.apply_rules(d, layers, gate), ["cust"])
    return gated.select("k", "status")


# Lookups ------------------------------------------------------------------

NATIONS = "(SELECT CAST(n_nationkey AS BIGINT) AS code, n_name, CAST(n_regionkey AS BIGINT) AS region FROM nation)"


def nations(spark, sf):
    return table(spark, sf, "nation").select(
        F.col("n_nationkey").cast("bigint").alias("code"), "n_name", F.col("n_regionkey").cast("bigint").alias("region"))


@query("l1_lookup_with_fallback", f"""
SELECT c.k, CASE WHEN n.n_name IS NULL OR n.n_name = '' THEN c.name ELSE n.n_name END AS parent FROM cus c
LEFT JOIN {NATIONS} n ON c.nation + c.k % 3 * 20 = n.code""", ["cus"])
def l1(spark, sf):
    dim = nations(spark, sf)
    df = view(spark, sf, "cus").select("k", "name", (F.col("nation") + F.col("k") % 3 * 20).alias("nation"))
    return L.coalesced_lookup(df, dim, {"nation": "code"}, "n_name", "parent", "name").select("k", "parent")


TIERS = """(SELECT CAST(n_nationkey AS BIGINT) AS code, 'result' AS tier, 'R' || n_name AS id FROM nation
  UNION ALL SELECT CAST(n_nationkey + 10 AS BIGINT), 'inscri', 'I' || n_name FROM nation)"""


@query("l2_tiered_lookup", f"""
WITH t AS {TIERS}
SELECT c.k, coalesce(a.id, b.id) AS id FROM cus c LEFT JOIN t a ON a.code = c.nation + c.k % 3 * 20 AND a.tier = 'result'
LEFT JOIN t b ON b.code = c.nation + c.k % 3 * 20 AND b.tier = 'inscri'""", ["cus"])
def l2(spark, sf):
    n = nations(spark, sf)
    tiers = n.select(F.col("code").alias("nation"), F.lit("result").alias("tier"), F.concat(F.lit("R"), "n_name").alias("id"))
    tiers = tiers.unionByName(n.select(
        (F.col("code") + 10).alias("nation"), F.lit("inscri").alias("tier"), F.concat(F.lit("I"), "n_name").alias("id")))
    df = view(spark, sf, "cus").select("k", (F.col("nation") + F.col("k") % 3 * 20).alias("nation"))
    return L.tiered_lookup(df, tiers, ["nation"], "id", "tier", ["result", "inscri"]).select("k", "id")


@query("l3_successor_entity", """
WITH s AS (SELECT s_suppkey AS supp, s_suppkey % 5 AS y5, CASE WHEN s_suppkey % 3 = 0 THEN '' ELSE s_name END AS parent FROM supplier)
SELECT l.k, l.line, CAST(l.supp AS VARCHAR) AS own,
  CASE WHEN s.parent IS NULL OR s.parent = '' THEN CAST(l.supp AS VARCHAR) ELSE s.parent END AS entity
FROM lin l LEFT JOIN s ON s.supp = l.supp AND s.y5 = l.ship_year % 5""", ["lin"])
def l3(spark, sf):
    s = F.col("s_suppkey")
    dim = table(spark, sf, "supplier").select(
        s.alias("supp"), (s % 5).alias("y5"), F.when(s % 3 == 0, "").otherwise(F.col("s_name")).alias("parent"))
    df = view(spark, sf, "lin").select("k", "line", "supp", (F.col("ship_year") % 5).alias("y5"), F.col("supp").cast("string").alias("own"))
    return L.coalesced_lookup(df, dim, ["supp", "y5"], "parent", "entity", "own").select("k", "line", "own", "entity")


COMMUNES = "(SELECT brand || '-' || CAST(size AS VARCHAR) AS uai, min(kind) AS comcode FROM prt GROUP BY 1)"


def communes(spark, sf):
    return view(spark, sf, "prt").groupBy(F.concat_ws("-", "brand", F.col("size").cast("string")).alias("uai")).agg(F.min("kind").alias("comcode"))


@query("l4_commune_of_registration", f"""
WITH c AS {COMMUNES}
SELECT p.k, c.comcode AS comins FROM prt p LEFT JOIN c ON c.uai = p.brand || '-' || CAST(p.size % 7 AS VARCHAR)""", ["prt"])
def l4(spark, sf):
    df = view(spark, sf, "prt").withColumn("unit", F.concat_ws("-", "brand", (F.col("size") % 7).cast("string")))
    return L.left_lookup(df, communes(spark, sf), {"unit": "uai"}, {"comcode": "comins"}).select("k", "comins")


@query("l5_commune_of_establishment", """
WITH s AS (SELECT DISTINCT "RENTREE" AS y, "ETABLI" AS e, CASE WHEN "ETABLI" LIKE '09%' THEN substr("ETABLI", 2, 5) ELSE substr("ETABLI", 1, 5) END AS code FROM deg
  WHERE "ETABLI" IS NOT NULL AND CAST("RENTREE" AS INT) % 4 <> 0)
SELECT k, CASE WHEN "ETABLI" = '9730224F' OR code IS NULL OR code <> substr("ETABLI", 1, 5) THEN code END AS "COMETAB"
FROM deg LEFT JOIN s ON s.y = "RENTREE" AND s.e = "ETABLI" """, ["deg"])
def l5(spark, sf):
    """The job's own step after its lookup; most codes repeat the head of their establishment, overseas they count all the same."""
    df = view(spark, sf, "deg").select("k", "RENTREE", "ETABLI")
    code = F.when(F.col("ETABLI").startswith("09"), F.substring("ETABLI", 2, 5)).otherwise(F.substring("ETABLI", 1, 5))
    seats = df.filter("ETABLI IS NOT NULL AND CAST(RENTREE AS INT) % 4 <> 0").select("RENTREE", F.col("ETABLI").alias("UAI"), code.alias("COMCODE")).distinct()
    found = L.left_lookup(df, L.stored(seats, "seats", ["RENTREE", "UAI"]), {"RENTREE": "RENTREE", "ETABLI": "UAI"}, ["COMCODE"])
    return correct.commune_of_establishment(found).select("k", "COMETAB")


@query("l1_co_located_lookups", """
SELECT l.k, l.line, p.p_brand AS brand, p.p_type AS kind, p.p_size AS size, q.p_name AS name FROM lin l LEFT JOIN part p ON p.p_partkey = l.part
LEFT JOIN part q ON q.p_partkey = l.part AND q.p_partkey % 3 <> 0""", ["lin"])
def l1_co_located(spark, sf):
    """Three lookups on one key between tables in the same buckets: the facts are shuffled once, when they are saved."""
    fact = L.co_located(view(spark, sf, "lin").select("k", "line", "part"), "part", "lines", 8)
    part = table(spark, sf, "part")
    sides = [part.select("p_partkey", F.col("p_brand").alias("brand"), F.col("p_type").alias("kind")), part.select("p_partkey", F.col("p_size").alias("size")),
             part.filter("p_partkey % 3 <> 0").select("p_partkey", F.col("p_name").alias("name"))]
    for n, side in enumerate(sides):
        fact = L.co_located_lookup(fact, L.co_located(side, "p_partkey", f"side{n}", 8), {"part": "p_partkey"}, [c for c in side.columns if c != "p_partkey"])
    return fact.drop("part")


@query("l6_commune_attributes_two_roles", """
SELECT l.k, l.line, substr(a.s_name, 2, 3) AS depins, CAST(a.s_nationkey AS BIGINT) AS uucrins, CAST(b.s_nationkey AS BIGINT) AS uucretab
FROM lin l LEFT JOIN supplier a ON a.s_suppkey = l.supp LEFT JOIN supplier b ON b.s_suppkey = l.part""", ["lin"])
def l6(spark, sf):
    dim = table(spark, sf, "supplier").select(
        "s_suppkey", F.substring("s_name", 2, 3).alias("dep"), F.col("s_nationkey").cast("bigint").alias("uucr"))
    roles = [({"supp": "s_suppkey"}, {"dep": "depins", "uucr": "uucrins"}), ({"part": "s_suppkey"}, {"uucr": "uucretab"})]
    return L.role_lookup(view(spark, sf, "lin").select("k", "line", "supp", "part"), dim, roles).drop("supp", "part")


PAIRS = """(SELECT CAST(a.n_nationkey AS BIGINT) AS ui, CAST(b.n_nationkey AS BIGINT) AS par,
  CASE WHEN a.n_nationkey = b.n_nationkey THEN 'same' WHEN a.n_regionkey = b.n_regionkey THEN 'near' ELSE 'far' END AS prox
  FROM nation a JOIN nation b ON a.n_regionkey = b.n_regionkey)"""


@query("l7_pair_proximity", f"""
WITH p AS {PAIRS}
SELECT l.k, l.line, p.prox AS proximite, q.prox AS proxbac FROM lin l
LEFT JOIN p ON p.ui = l.supp % 25 AND p.par = l.part % 25 LEFT JOIN p q ON q.ui = l.supp % 25 AND q.par = l.k % 25""", ["lin"])
def l7(spark, sf):
    a, b = nations(spark, sf), nations(spark, sf)
    pairs = a.alias("a").join(b.alias("b"), F.col("a.region") == F.col("b.region")).select(
        F.col("a.code").alias("ui"), F.col("b.code").alias("par"),
        F.when(F.col("a.code") == F.col("b.code"), "same").when(F.col("a.region") == F.col("b.region"), "near").otherwise("far").alias("prox"))
    df = view(spark, sf, "lin").select("k", "line", (F.col("supp") % 25).alias("d"), (F.col("part") % 25).alias("p"), (F.col("k") % 25).alias("b"))
    roles = [({"d": "ui", "p": "par"}, {"prox": "proximite"}), ({"d": "ui", "b": "par"}, {"prox": "proxbac"})]
    return L.role_lookup(df, pairs, roles).drop("d", "p", "b")


@query("l8_country_attributes", """
WITH p AS (SELECT CAST(n_nationkey AS VARCHAR) AS pays, 'R' || n_regionkey AS continent, n_regionkey % 2 AS ue FROM nation
  UNION ALL SELECT '999', 'other', 0),
c AS (SELECT k, CASE WHEN k % 6 <> 0 THEN CAST(nation + k % 3 * 20 AS VARCHAR) END AS nation FROM cus),
f AS (SELECT k, CASE WHEN nation IN (SELECT pays FROM p) THEN nation ELSE '999' END AS nation FROM c)
SELECT f.k, f.nation, p.continent, CAST(p.ue AS BIGINT) AS ue FROM f LEFT JOIN p ON p.pays = f.nation""", ["cus"])
def l8(spark, sf):
    dim = nations(spark, sf).select(
        F.col("code").cast("string").alias("PAYS"), F.concat(F.lit("R"), F.col("region").cast("string")).alias("continent"),
        (F.col("region") % 2).cast("string").alias("ue"))
    dim = dim.unionByName(L.small_table(spark, [("999", "other", "0")], dim.schema))
    df = view(spark, sf, "cus").select("k", F.when(F.col("k") % 6 != 0, (F.col("nation") + F.col("k") % 3 * 20).cast("string")).alias("nation"))
    return L.country_lookup(df, dim, "nation", "PAYS", ["continent"], ["ue"])


def simple_lookup(name, left, key, dim_table, dim_key, attr, out, as_text=False):
    """Queries of the single-key lookups: one fact key, one attribute."""
    value = f"CAST(d.{attr} AS VARCHAR)" if as_text else f"d.{attr}"
    extra = ", f.line" if left == "lin" else ""

    @query(name, f"SELECT f.k{extra}, {value} AS {out} FROM {left} f LEFT JOIN {dim_table} d ON f.{key} = d.{dim_key}", [left])
    def run(spark, sf):
        dim = table(spark, sf, dim_table)
        dim = dim.select(dim_key, F.col(attr).cast("string").alias(attr) if as_text else F.col(attr))
        cols = ["k", "line", key] if left == "lin" else ["k", key]
        df = view(spark, sf, left).select(*cols)
        return L.left_lookup(df, dim, {key: dim_key}, {attr: out}).drop(key)

    return run


l9 = simple_lookup("l9_doctoral_school", "lin", "supp", "supplier", "s_suppkey", "s_name", "id_ed")
l14 = simple_lookup("l14_speciality", "lin", "part", "part", "p_partkey", "p_type", "speciut")
l15 = simple_lookup("l15_broad_discipline", "ord", "cust", "customer", "c_custkey", "c_mktsegment", "gddisc")


def composite_lookup(name, outs):
    """Composite-key lookups (year, unit, component) with several IDs."""
    picked = ", ".join(f"d.{o} AS {o}" for o in outs)
    made = ", ".join(f"'{o}-' || min(prio) AS {o}" for o in outs)

    @query(name, f"""
WITH d AS (SELECT y, cust, {made} FROM ord GROUP BY y, cust)
SELECT f.k, {picked} FROM ord f LEFT JOIN d ON d.y = f.y AND d.cust = f.cust + f.h1 % 2""", ["ord"])
    def run(spark, sf):
        df = view(spark, sf, "ord")
        dim = df.groupBy("y", "cust").agg(F.min("prio").alias("m"))
        dim = dim.select("y", "cust", *[F.concat(F.lit(f"{o}-"), "m").alias(o) for o in outs])
        keyed = df.select("k", "y", (F.col("cust") + F.col("h1") % 2).alias("cust"))
        return L.left_lookup(keyed, dim, ["y", "cust"], outs).drop("y", "cust")

    return run


l10 = composite_lookup("l10_technology_institute", ["iut", "campus", "pole"])
l11 = composite_lookup("l11_engineering_school", ["ing", "ing_campus"])

TYPES = """(SELECT typ, 'G' || typ AS lmd, CASE WHEN typ = 'DU' THEN 'DU' ELSE 'DN' END AS dndu
  FROM (SELECT DISTINCT "TYP_DIPL" AS typ FROM deg WHERE "TYP_DIPL" IS NOT NULL))"""
# every fifth final type is one that the list lacks
SHIFTED = """(SELECT k, CASE WHEN k % 5 = 0 THEN "TYP_DIPL" || 'Q' ELSE "TYP_DIPL" END AS "TYP_DIPL", "TYP_DIPINT" FROM deg)"""


def types(spark, sf):
    d = view(spark, sf, "deg").filter(F.col("TYP_DIPL").isNotNull()).select(F.col("TYP_DIPL").alias("typ"))
    return d.select("typ", F.concat(F.lit("G"), "typ").alias("lmd"), F.when(F.col("typ") == "DU", "DU").otherwise("DN").alias("dndu"))


def shifted(spark, sf):
    typ = F.when(F.col("k") % 5 == 0, F.concat("TYP_DIPL", F.lit("Q"))).otherwise(F.col("TYP_DIPL"))
    return view(spark, sf, "deg").select("k", typ.alias("TYP_DIPL"), "TYP_DIPINT")


@query("l12_degree_group_two_roles", f"""
WITH t AS {TYPES}
SELECT d.k, a.lmd AS lmd, b.lmd AS lmd_int FROM {SHIFTED} d LEFT JOIN t a ON a.typ = d."TYP_DIPL" LEFT JOIN t b ON b.typ = d."TYP_DIPINT" """,
       ["deg"])
def l12(spark, sf):
    roles = [({"TYP_DIPL": "typ"}, ["lmd"]), ({"TYP_DIPINT": "typ"}, {"lmd": "lmd_int"})]
    return L.role_lookup(shifted(spark, sf), types(spark, sf), roles).select("k", "lmd", "lmd_int")


@query("l13_certificate_flag_two_roles", f"""
WITH t AS {TYPES}
SELECT d.k, a.dndu AS dndu, CASE WHEN d."TYP_DIPINT" = '' THEN '' WHEN d."TYP_DIPINT" = 'DU' THEN b.dndu ELSE 'DN' END AS "DNDU_INT"
FROM {SHIFTED} d LEFT JOIN t a ON a.typ = d."TYP_DIPL" LEFT JOIN t b ON b.typ = d."TYP_DIPINT" """, ["deg"])
def l13(spark, sf):
    from ..operators.derive import certificate_flag

    roles = [({"TYP_DIPL": "typ"}, ["dndu"]), ({"TYP_DIPINT": "typ"}, {"dndu": "DNDU_INT"})]
    df = shifted(spark, sf)
    return certificate_flag(L.role_lookup(df, types(spark, sf), roles)).select("k", "dndu", "DNDU_INT")


@query("l16_department_to_region", f"""
SELECT c.k, a.region AS regrespa, CASE WHEN b.region = 1 THEN 9 ELSE b.region END AS regrespa16
FROM cus c LEFT JOIN {NATIONS} a ON a.code = c.nation + c.k % 3 * 20 LEFT JOIN {NATIONS} b ON b.code = c.nation + c.k % 3 * 20""", ["cus"])
def l16(spark, sf):
    n = nations(spark, sf)
    new = n.withColumn("region", F.when(F.col("region") == 1, F.lit(9)).otherwise(F.col("region")).cast("bigint"))
    df = view(spark, sf, "cus").select("k", (F.col("nation") + F.col("k") % 3 * 20).alias("nation"))
    df = L.left_lookup(df, n, {"nation": "code"}, {"region": "regrespa"})
    return L.left_lookup(df, new, {"nation": "code"}, {"region": "regrespa16"}).drop("nation")


STAR_SQL = """
SELECT l.k, l.line, o.o_orderstatus AS outcome, c.c_mktsegment AS segment, n.n_name AS cust_nation, r.r_name AS cust_region,
  s.s_name AS supp_name, m.n_name AS supp_nation, q.r_name AS supp_region
FROM lin l LEFT JOIN orders o ON o.o_orderkey = l.k LEFT JOIN customer c ON c.c_custkey = o.o_custkey
LEFT JOIN nation n ON n.n_nationkey = c.c_nationkey LEFT JOIN region r ON r.r_regionkey = n.n_regionkey
LEFT JOIN supplier s ON s.s_suppkey = l.supp LEFT JOIN nation m ON m.n_nationkey = s.s_nationkey
LEFT JOIN region q ON q.r_regionkey = m.n_regionkey"""


def star(spark, sf):
    t = {n: table(spark, sf, n) for n in ("orders", "customer", "nation", "region", "supplier")}
    specs = [
        (t["orders"], {"k": "o_orderkey"}, {"o_orderstatus": "outcome", "o_custkey": "cust"}),
        (t["customer"], {"cust": "c_custkey"}, {"c_mktsegment": "segment", "c_nationkey": "cn"}),
        (t["nation"], {"cn": "n_nationkey"}, {"n_name": "cust_nation", "n_regionkey": "cr"}),
        (t["region"], {"cr": "r_regionkey"}, {"r_name": "cust_region"}),
        (t["supplier"], {"supp": "s_suppkey"}, {"s_name": "supp_name", "s_nationkey": "sn"}),
        (t["nation"], {"sn": "n_nationkey"}, {"n_name": "supp_nation", "n_regionkey": "sr"}),
        (t["region"], {"sr": "r_regionkey"}, {"r_name": "supp_region"}),
    ]
    return L.star_join(view(spark, sf, "lin").select("k", "line", "supp"), specs, unique="trust")


@query("l17_star_denormalise", STAR_SQL, ["lin"])
def l17(spark, sf):
    return star(spark, sf).drop("supp", "cust", "cn", "cr", "sn", "sr")


@query("l18_label_lists", """
SELECT d.k, CASE d."SEXE" WHEN '1' THEN 'Homme' WHEN '2' THEN 'Femme' ELSE 'Inconnu' END AS sexe_lib,
  CASE WHEN d."CURSUS_LMD" IN ('L', 'M', 'D', 'X', '', 'nan') THEN 'cycle ' || d."CURSUS_LMD" END AS cursus_lib,
  CASE WHEN d."CURSUS_LMD_INT" IN ('L', 'M', 'D', 'X', '', 'nan') THEN 'cycle ' || d."CURSUS_LMD_INT" END AS cursus_lib_int
FROM deg d""", ["deg"])
def l18(spark, sf):
    df = view(spark, sf, "deg").select("k", "SEXE", "CURSUS_LMD", "CURSUS_LMD_INT")
    cycles = df.filter(F.col("CURSUS_LMD").isNotNull()).select("CURSUS_LMD", F.concat(F.lit("cycle "), "CURSUS_LMD").alias("lib"))
    sexes = L.small_table(spark, [("1", "Homme"), ("2", "Femme")], "SEXE string, lib string")
    specs = [(sexes, "SEXE", {"lib": "sexe_lib"}), (cycles, "CURSUS_LMD", {"lib": "cursus_lib"}),
             (cycles, {"CURSUS_LMD_INT": "CURSUS_LMD"}, {"lib": "cursus_lib_int"})]
    out = L.star_join(df, specs).withColumn("sexe_lib", F.coalesce("sexe_lib", F.lit("Inconnu")))
    return out.select("k", "sexe_lib", "cursus_lib", "cursus_lib_int")


@query("l19_lookup_conflicts", """
SELECT part, rflag, count(DISTINCT supp) AS n_values FROM lin GROUP BY part, rflag HAVING count(DISTINCT supp) > 1""", ["lin"])
def l19(spark, sf):
    return L.conflicts(view(spark, sf, "lin"), ["part", "rflag"], "supp")


@query("l17_star_shuffled_hot_keys", STAR_SQL, ["lin"])
def l17_shuffled(spark, sf):
    """The same star with every dimension forced through the shuffled form."""
    t = {n: table(spark, sf, n) for n in ("orders", "customer", "nation", "region", "supplier")}
    how = {"limit": 0, "unique": "check"}
    df = view(spark, sf, "lin").select("k", "line", "supp")
    for name, on, cols in [
        ("orders", {"k": "o_orderkey"}, {"o_orderstatus": "outcome", "o_custkey": "cust"}),
        ("customer", {"cust": "c_custkey"}, {"c_mktsegment": "segment", "c_nationkey": "cn"}),
        ("nation", {"cn": "n_nationkey"}, {"n_name": "cust_nation", "n_regionkey": "cr"}),
    ]:
        df = L.left_lookup(df, t[name], on, cols, **how)
    rest = [
        (t["region"], {"cr": "r_regionkey"}, {"r_name": "cust_region"}),
        (t["supplier"], {"supp": "s_suppkey"}, {"s_name": "supp_name", "s_nationkey": "sn"}),
        (t["nation"], {"sn": "n_nationkey"}, {"n_name": "supp_nation", "n_regionkey": "sr"}),
        (t["region"], {"sr": "r_regionkey"}, {"r_name": "supp_region"}),
    ]
    return L.star_join(df, rest).drop("supp", "cust", "cn", "cr", "sn", "sr")


@query("flagship_degrees_by_place", """
SELECT o.o_orderstatus AS outcome, CAST(year(o.o_orderdate) AS VARCHAR) || '-' ||
    substr(CAST(year(o.o_orderdate) + 1 AS VARCHAR), 3, 2) AS academic_year,
  r.r_name || '>' || n.n_name || '>' || c.c_mktsegment AS place, count(*) AS n_degrees,
  CAST(sum(CASE WHEN o.o_orderstatus = 'F' THEN 1 ELSE 0 END) AS BIGINT) AS n_final
FROM orders o LEFT JOIN customer c ON c.c_custkey = o.o_custkey LEFT JOIN nation n ON n.n_nationkey = c.c_nationkey
LEFT JOIN region r ON r.r_regionkey = n.n_regionkey
WHERE o.o_orderpriority IS NULL OR o.o_orderpriority <> '5-LOW' GROUP BY 1, 2, 3""")
def flagship(spark, sf):
    """Null-tolerant filter, headcount flag, academic year, places and path, published sums.

    The orders are summed per customer key first, so the place lookups meet one row per
    (customer, year, outcome) and a heavy customer is already folded before any join.
    """
    from ..functions.scalars import academic_year
    from ..operators.aggregate import resum
    from ..operators.derive import headcount

    orders = flt.exclude(table(spark, sf, "orders"), "o_orderpriority", "5-LOW").select(
        F.col("o_custkey").alias("cust"), F.col("o_orderstatus").alias("outcome"),
        academic_year(F.year("o_orderdate")).alias("academic_year"),
        F.lit(1).alias("n_degrees"), headcount("o_orderstatus", ("F",)).alias("n_final"))
    sums = resum(orders, ["cust", "outcome", "academic_year"], ["n_degrees", "n_final"])
    df = L.star_join(sums, [
        (table(spark, sf, "customer"), {"cust": "c_custkey"}, {"c_mktsegment": "segment", "c_nationkey": "nk"}),
        (table(spark, sf, "nation"), {"nk": "n_nationkey"}, {"n_name": "nation", "n_regionkey": "rk"}),
        (table(spark, sf, "region"), {"rk": "r_regionkey"}, {"r_name": "region"}),
    ], unique="trust")
    placed = df.withColumn("place", breadcrumb("region", "nation", "segment"))
    return resum(placed, ["outcome", "academic_year", "place"], ["n_degrees", "n_final"])
