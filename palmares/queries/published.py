"""The jobs themselves over degree facts derived from the supplied tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..operators import derive
from ..operators.derive import headcount, total_headcount
from ..operators.rules import ROW
from ..operators.schema import add_nulls
from ..plans import correct, cubes, publish
from ..sources.contracts import FILE_COLUMNS, RAW_COLUMNS, RAW_INTS, column_bit, columns_mask
from ..sources.opendata import read_open_csv, write_open_csv
from ..sources.sheets import SHEETS, StoredSheets, as_sheet
from ..session import work_dir
from .base import blank, miss, query, table, view
from .rules import OUTCOMES, WITH_INT

# Corrected facts and reference tables made from the supplied ones ------------

CORRECTED = """SELECT "SOURCE", "RENTREE", CAST(CAST("RENTREE" AS INT) + 1 AS VARCHAR) AS "SESSION", 'S' || h1 % 50 AS "ID_PAYSAGE",
  CASE WHEN h2 % 5 = 0 THEN NULL ELSE 'S' || h2 % 40 END AS "ID_PAYSAGE_EPE_ETAB_COMPOS", 'S' || h3 % 60 AS "ID_PAYSAGE_FORMENS",
  "ETABLI" AS "ETABLI_ORI_UAI", CAST(h4 % 30 AS VARCHAR) AS "COMUI", CAST(h1 % 27 AS VARCHAR) AS "COMETAB", "SEXE", "BAC_RGRP",
  CASE WHEN h1 % 2 = 0 THEN 'O' ELSE 'N' END AS "RETARD", CASE WHEN h2 % 7 = 0 THEN NULL WHEN h2 % 2 = 0 THEN 'X' ELSE 'N' END AS "AVANCE",
  "PROXBAC", "PROXREGBAC", CASE WHEN h3 % 2 = 0 THEN 'E' ELSE 'F' END AS "NATION_VRAI", CASE WHEN h4 % 2 = 0 THEN 'M' ELSE 'X' END AS "MOBINTERN",
  "DNDU", "DNDU_INT", "CURSUS_LMD", "CURSUS_LMDR", "CURSUS_LMD_INT", "LMDDONTBIS", "LMDDONTBIS_INT", "RESDIP", "RESINT", "SECTDIS", "SECTINT",
  "PAR_TYPE" AS "SPECIUT", "NIVEAUR" AS "NIVEAU", "ID_PAYSAGE_ED", CASE WHEN h1 % 9 = 0 THEN NULL ELSE h1 % 2 END AS "UE_27", h2 % 2 AS "OCDE_MEMBRES",
  h3 % 2 AS "BOLOGNE", h4 % 2 AS "BRICS", CASE WHEN "RESDIP" IN ('O', '1') THEN 1 ELSE 0 END AS "EFFECTIF_R",
  CASE WHEN "RESINT" IN ('O', '1') THEN 1 ELSE 0 END AS "EFFECTIF_INT"
  FROM deg"""

CONSTANTS = ("ID_PAYSAGE_ING", "ID_PAYSAGE_ING_CAMPUS", "ID_PAYSAGE_IUT", "ID_PAYSAGE_IUT_CAMPUS", "ID_PAYSAGE_IUT_POLE", "OPTIUT", "PARCOURSBUT")


def corrected(spark: SparkSession, sf: str) -> DataFrame:
    h = {i: F.col(f"h{i}") for i in (1, 2, 3, 4)}

    def code(i, n, letter="S"):
        return F.concat(F.lit(letter), (h[i] % n).cast("string"))

    df = view(spark, sf, "deg").withColumns({
        "SESSION": (F.col("RENTREE").cast("int") + 1).cast("string"), "ID_PAYSAGE": code(1, 50),
        "ID_PAYSAGE_EPE_ETAB_COMPOS": F.when(h[2] % 5 != 0, code(2, 40)), "ID_PAYSAGE_FORMENS": code(3, 60),
        "ETABLI_ORI_UAI": F.col("ETABLI"), "COMUI": code(4, 30, ""), "COMETAB": code(1, 27, ""),
        "RETARD": F.when(h[1] % 2 == 0, "O").otherwise("N"),
        "AVANCE": F.when(h[2] % 7 == 0, None).when(h[2] % 2 == 0, "X").otherwise("N"),
        "NATION_VRAI": F.when(h[3] % 2 == 0, "E").otherwise("F"), "MOBINTERN": F.when(h[4] % 2 == 0, "M").otherwise("X"),
        "SPECIUT": F.col("PAR_TYPE"), "NIVEAU": F.col("NIVEAUR"), "UE_27": F.when(h[1] % 9 != 0, h[1] % 2),
        "OCDE_MEMBRES": h[2] % 2, "BOLOGNE": h[3] % 2, "BRICS": h[4] % 2,
        "EFFECTIF_R": headcount("RESDIP"), "EFFECTIF_INT": headcount("RESINT"),
        **{c: F.lit("") for c in CONSTANTS},
    })
    return total_headcount(df)


def entities(spark, sf):
    s = F.col("s_suppkey")
    key = s.cast("string")
    return table(spark, sf, "supplier").select(
        F.concat(F.lit("S"), key).alias("ID_PAYSAGE"), F.concat(F.lit("S"), (s % 10).cast("string")).alias("ID_PAYSAGE_ACTUEL"),
        F.col("s_name").alias("UO_LIB"), F.concat(F.lit("T"), (s % 3).cast("string")).alias("TYPE"),
        F.concat(F.lit("Y"), (s % 4).cast("string")).alias("TYPOLOGIE_D_UNIVERSITES_ET_ASSIMILES"),
        F.concat(F.lit("U"), key).alias("ANCIENS_CODES_UAI"), F.concat(F.lit("Q"), key).alias("IDENTIFIANT_WIKIDATA"),
        F.concat(F.lit("R"), key).alias("IDENTIFIANT_ROR"), F.when(s % 6 != 0, "O").otherwise("N").alias("OPERATEUR_LOLF_150"),
        F.col("s_nationkey").cast("string").alias("COM_CODE"))


def places(spark, sf):
    n, r = table(spark, sf, "nation"), table(spark, sf, "region")
    k = F.col("n_nationkey")
    return n.join(r, n.n_regionkey == r.r_regionkey).select(
        k.cast("string").alias("COM_CODE"), F.col("n_name").alias("COM_NOM"), F.concat(F.lit("U"), (k % 8).cast("string")).alias("UUCR_ID"),
        F.when(k % 4 == 0, F.col("n_name")).otherwise(F.concat(F.lit("Urban "), (k % 8).cast("string"))).alias("UUCR_NOM"),
        F.concat(F.lit("D"), k.cast("string")).alias("DEP_ID"), F.when(k % 3 == 0, F.col("r_name")).otherwise(F.concat(F.lit("Dep "), k.cast("string"))).alias("DEP_NOM"),
        F.concat(F.lit("A"), (k % 5).cast("string")).alias("ACA_ID"), F.when(k % 2 == 0, F.col("r_name")).otherwise(F.concat(F.lit("Aca "), (k % 5).cast("string"))).alias("ACA_NOM"),
        F.concat(F.lit("R"), F.col("r_regionkey").cast("string")).alias("REG_ID"), F.col("r_name").alias("REG_NOM"))


def code_list(df, col, attributes):
    """A label list with one row per code of the facts: each attribute is its name and the code."""
    codes = df.select(F.col(col).alias("code")).filter(F.col("code").isNotNull()).distinct()
    return codes.select(F.col("code").alias(col), *[F.concat(F.lit(f"{a} "), "code").alias(a) for a in attributes])


def reference_tables(spark, sf):
    df = publish.publication_codes(corrected(spark, sf))
    sheets = {"C_ETABLISSEMENTS": entities(spark, sf), "LES_COMMUNES": places(spark, sf)}
    sheets["E_FORM_ENS"] = entities(spark, sf).select("ID_PAYSAGE", F.concat(F.lit("Training "), "UO_LIB").alias("UO_LIB"))
    sheets["F_RENTREES"] = code_list(df, "RENTREE", ["ANNEE_UNIVERSITAIRE"])
    for sheet, key, _, cols in publish.LABELS:
        if sheet not in sheets and key == sheet:
            sheets[sheet] = code_list(df, key, cols)
    # Secondary roles look codes up in the list of the first role.
    return sheets


def label_sql():
    """Columns of the label lists: an attribute is its name and the code, when the list has the code."""
    out = []
    for sheet, key, sheet_key, cols in publish.LABELS:
        known = f'c."{key}"' if key == sheet_key else f'CASE WHEN c."{key}" IN (SELECT "{sheet_key}" FROM c) THEN c."{key}" END'
        for attribute, name in cols.items():
            value = f"'{attribute} ' || {known}"
            out.append(f"coalesce({value}, 'Inconnu') AS \"{name}\"" if name == "SEXE_LIB" else f'{value} AS "{name}"')
    return ", ".join(out)


def path_sql(p):
    levels = [f"{p}.reg", f"{p}.aca", f"{p}.dep", f"{p}.uu", f"{p}.com"]
    return levels[0] + "".join(f" || CASE WHEN {a} = {b} THEN '' ELSE '>' || {b} END" for a, b in zip(levels, levels[1:]))


PLACE_SQL = """SELECT CAST(n_nationkey AS VARCHAR) AS code, n_name AS com, 'U' || n_nationkey % 8 AS uid,
  CASE WHEN n_nationkey % 4 = 0 THEN n_name ELSE 'Urban ' || n_nationkey % 8 END AS uu, 'D' || n_nationkey AS did,
  CASE WHEN n_nationkey % 3 = 0 THEN r_name ELSE 'Dep ' || n_nationkey END AS dep, 'A' || n_nationkey % 5 AS aid,
  CASE WHEN n_nationkey % 2 = 0 THEN r_name ELSE 'Aca ' || n_nationkey % 5 END AS aca, 'R' || r_regionkey AS rid, r_name AS reg
  FROM nation JOIN region ON n_regionkey = r_regionkey"""


def place_sql(p, role):
    names = {"com": "COMMUNE", "uid": "ID_UUCR", "uu": "UUCR", "did": "ID_DEPARTEMENT", "dep": "DEPARTEMENT", "aid": "ID_ACADEMIE",
             "aca": "ACADEMIE", "rid": "ID_REGION", "reg": "REGION"}
    return ", ".join(f'{p}.{c} AS "{role}_{n}"' for c, n in names.items()) + f', {path_sql(p)} AS "{role}_LOCALISATION"'


PUBLISH_SQL = f"""
WITH f AS ({CORRECTED}),
g AS (SELECT f.*, "EFFECTIF_R" + "EFFECTIF_INT" AS "EFFECTIF_TOT" FROM f),
c AS (SELECT g.* REPLACE (CASE "SEXE" WHEN '1' THEN 'M' WHEN '2' THEN 'F' ELSE "SEXE" END AS "SEXE"), "AVANCE" || "RETARD" AS "AVANCE_RETARD",
  "NATION_VRAI" AS "ATTRAC_INTERN", CASE WHEN "RESDIP" = 'O' THEN 'Oui' ELSE 'Non' END AS "OBTENU_DIPLOME",
  CASE WHEN "RESINT" = 'O' THEN 'Oui' ELSE 'Non' END AS "OBTENU_DIPINT" FROM g),
p AS ({PLACE_SQL}),
e AS (SELECT 'S' || s_suppkey AS id, 'S' || s_suppkey % 10 AS cur, s_name AS lib, s_suppkey AS s FROM supplier),
w AS (SELECT c.*, 'ANNEE_UNIVERSITAIRE ' || c."RENTREE" AS "ANNEE_UNIVERSITAIRE", {label_sql()},
  c."ID_PAYSAGE" AS "ETABLISSEMENT_ID_PAYSAGE", c."ID_PAYSAGE_EPE_ETAB_COMPOS" AS "ETABLISSEMENT_COMPOS_ID_PAYSAGE",
  c."ID_PAYSAGE_FORMENS" AS "FORM_ENS_ID_PAYSAGE", c."COMETAB" AS "ETABLISSEMENT_CODE_COMMUNE", c."COMUI" AS "IMPLANTATION_CODE_COMMUNE",
  c."ETABLI_ORI_UAI" AS "ETABLISSEMENT_ID_UAI_SOURCE", e.lib AS "ETABLISSEMENT_LIB", 'T' || e.s % 3 AS "ETABLISSEMENT_TYPE",
  'Y' || e.s % 4 AS "ETABLISSEMENT_TYPOLOGIE", 'U' || e.s AS "ETABLISSEMENT_ID_UAI", 'Q' || e.s AS "ETABLISSEMENT_ID_WIKIDATA",
  'R' || e.s AS "ETABLISSEMENT_ID_ROR", e.cur AS "ETABLISSEMENT_ID_PAYSAGE_ACTUEL", e2.lib AS "ETABLISSEMENT_ACTUEL_LIB",
  e3.lib AS "ETABLISSEMENT_COMPOS_LIB", 'Training ' || e4.lib AS "FORM_ENS_LIB", {place_sql('p', 'ETABLISSEMENT')}, {place_sql('q', 'IMPLANTATION')}
  FROM c JOIN e ON e.id = c."ID_PAYSAGE" AND e.s % 6 <> 0 LEFT JOIN e e2 ON e2.id = e.cur LEFT JOIN e e3 ON e3.id = c."ID_PAYSAGE_EPE_ETAB_COMPOS"
  LEFT JOIN e e4 ON e4.id = c."ID_PAYSAGE_FORMENS" LEFT JOIN p ON p.code = c."COMETAB" LEFT JOIN p q ON q.code = c."COMUI" WHERE c."EFFECTIF_TOT" > 0)
SELECT {', '.join(f'"{k}"' for k in publish.PUBLISHED_KEYS)}, CAST(sum("EFFECTIF_R") AS BIGINT) AS "EFFECTIF_R",
  CAST(sum("EFFECTIF_INT") AS BIGINT) AS "EFFECTIF_INT", CAST(sum("EFFECTIF_TOT") AS BIGINT) AS "EFFECTIF_TOTAL",
  CAST(coalesce(sum("UE_27"), 0) AS BIGINT) AS "ATTRAC_INTERN_UE_27", CAST(sum("OCDE_MEMBRES") AS BIGINT) AS "ATTRAC_INTERN_OCDE_MEMBRES",
  CAST(sum("BOLOGNE") AS BIGINT) AS "ATTRAC_INTERN_BOLOGNE", CAST(sum("BRICS") AS BIGINT) AS "ATTRAC_INTERN_BRICS"
FROM w GROUP BY ALL"""


@query("a3_published_table", PUBLISH_SQL, ["deg"])
def published_table(spark, sf):
    return publish.publish(corrected(spark, sf), reference_tables(spark, sf), names=False)


@query("a3_published_from_sums", PUBLISH_SQL, ["deg"])
def published_from_sums(spark, sf):
    """Sums kept by source and year: first of facts whose year 2016 is wrong and whose year 2017 is too long, then only these are summed again."""
    sheets = StoredSheets(reference_tables(spark, sf))
    right, root = corrected(spark, sf), work_dir(spark, "sums")
    wrong = right.withColumn("EFFECTIF_R", F.when(F.col("RENTREE") == "2016", F.lit(5)).otherwise(F.col("EFFECTIF_R")))
    extra = right.filter("RENTREE = '2017'").withColumn("SOURCE", F.lit("gone"))
    cubes.refresh(wrong.unionByName(extra), sheets, root)
    sources = [r.SOURCE for r in right.select("SOURCE").distinct().collect()]
    cubes.refresh(right, sheets, root, [(s, y) for s in [*sources, "gone"] for y in ("2016", "2017")])
    return cubes.publish_sums(cubes.read_sums(spark, root), sheets, names=False)


@query("p15_published_csv", f"""
WITH t AS ({PUBLISH_SQL.strip()})
SELECT {', '.join(f'nullif(CAST("{k}" AS VARCHAR), {chr(39) * 2}) AS "{publish.PUBLISHED_NAMES.get(k, k)}"' for k in (*publish.PUBLISHED_KEYS, *publish.MEASURES))} FROM t""",
       ["deg"])
def published_csv(spark, sf):
    """The published table written as yearly CSV folders under their French names and read back."""
    root = work_dir(spark, "published")
    write_open_csv(publish.publish(corrected(spark, sf), reference_tables(spark, sf)), root, year="rentree")
    return read_open_csv(spark, root)


@query("l18_all_label_lists", f"""
WITH f AS ({CORRECTED.replace('SELECT "SOURCE"', 'SELECT k, "SOURCE"', 1)}),
c AS (SELECT f.* REPLACE (CASE "SEXE" WHEN '1' THEN 'M' WHEN '2' THEN 'F' ELSE "SEXE" END AS "SEXE"), "AVANCE" || "RETARD" AS "AVANCE_RETARD",
  "NATION_VRAI" AS "ATTRAC_INTERN", "MOBINTERN" AS "MOBILITE_INTERN" FROM f)
SELECT k, {label_sql()}, {', '.join(f"'lib ' || c.{chr(34)}{n}{chr(34)} AS {chr(34)}{n}_LIB{chr(34)}" for n in publish.OTHER_LABELS)},
  CASE WHEN c."DNDU_INT" IN (SELECT "DNDU" FROM c) THEN 'DN_DE ' || c."DNDU_INT" END AS "DN_DE_INT",
  CASE WHEN c."DNDU_INT" IN (SELECT "DNDU" FROM c) THEN 'DN_DE_LIB ' || c."DNDU_INT" END AS "DN_DE_LIB_INT" FROM c""", ["deg"])
def all_label_lists(spark, sf):
    """Every list in every role that ``label`` knows, those of unpublished codes included."""
    names = [n for _, _, _, cols in publish.LABELS for n in cols.values()]
    df = publish.publication_codes(corrected(spark, sf).withColumn("MOBILITE_INTERN", F.col("MOBINTERN"))).drop(*names)
    sheets = reference_tables(spark, sf)
    for name in publish.OTHER_LABELS:
        sheets[name] = code_list(df, name, ["lib"]).withColumnRenamed("lib", f"{name}_LIB")
    out = publish.label(df, sheets, (*publish.OTHER_LABELS, *publish.OTHER_ROLES))
    return out.select("k", *names, *[f"{n}_LIB" for n in publish.OTHER_LABELS], "DN_DE_INT", "DN_DE_LIB_INT")


@query("a1_full_code_cube", f"""
WITH f AS ({CORRECTED}), g AS (SELECT f.*, "EFFECTIF_R" + "EFFECTIF_INT" AS "EFFECTIF_TOT", {', '.join(f"'' AS {chr(34)}{c}{chr(34)}" for c in CONSTANTS)} FROM f)
SELECT {', '.join(f'"{k}"' for k in publish.CUBE_KEYS)}, CAST(sum("EFFECTIF_INT") AS BIGINT) AS "EFFECTIF_INT", CAST(sum("EFFECTIF_R") AS BIGINT) AS "EFFECTIF_R",
  CAST(sum("EFFECTIF_TOT") AS BIGINT) AS "EFFECTIF_TOT", {', '.join(f'CAST(coalesce(sum("{c}"), 0) AS BIGINT) AS "{c}"' for c in publish.CUBE_FLAGS)}
FROM g GROUP BY {', '.join(f'"{k}"' for k in publish.CUBE_KEYS)}, {', '.join(f'g."{c}"' for c in publish.CUBE_FLAGS)}""", ["deg"])
def full_cube(spark, sf):
    return publish.first_cube(corrected(spark, sf))


# The correction job over raw facts made from the orders ----------------------


def raw_facts(spark, sf):
    df = view(spark, sf, "deg")
    df = df.withColumns({
        "TYP_DIPR": F.col("TYP_DIPL"), "DIPLOMR": F.col("DIPLOM"), "COMPOSR": F.col("COMPOS"), "SECTDISR": F.col("SECTDIS"),
        "DISCIPLR": F.col("DISCIPLI"), "NUMED": F.col("PAR_TYPE"), "ETABLI_DIFFUSION": F.col("LMDDONT"),
        "ANBAC": F.col("ANBAC").cast("bigint"), "ANNAIS": F.col("ANNAIS").cast("bigint"),
    }).drop("h1", "h2", "h3", "h4", "cents", "PAR_TYPE", "DNDU", "DNDU_INT", "LMDDONT", "LMDDONTBIS", "LMDDONT_INT", "LMDDONTBIS_INT",
            "PROXBAC", "PROXREGBAC", "OUTREMER", "CURSUS_LMD", "CURSUS_LMD_INT", "COMINS", "ID_PAYSAGE_ED")
    # files of some years lack columns, as real ones do
    lacking = [(F.col("RENTREE") < "2012", "RESDIP"), (F.col("RENTREE") > "2019", "DEPBAC"), (F.col("SOURCE") == "culture", "NIVEAUR")]
    absent = sum((F.when(where, F.lit(column_bit(c))).otherwise(F.lit(0)) for where, c in lacking), F.lit(0))
    df = df.withColumn(FILE_COLUMNS, (F.lit(columns_mask(RAW_COLUMNS)) - absent).cast("bigint"))
    return add_nulls(df, {c: "bigint" if c in RAW_INTS else "string" for c in RAW_COLUMNS})


def correction_sheets(spark, sf):
    """Sheets of the correction job, cut from the supplied tables; every one has the columns the job reads and meets some facts."""
    nation, supplier = table(spark, sf, "nation"), table(spark, sf, "supplier")
    deg = view(spark, sf, "deg")
    empty = F.lit("")

    def codes(col, **attributes):
        have = deg.select(F.col(col).alias("c")).filter("c IS NOT NULL").distinct()
        return have.select(F.col("c").alias(col), *[e.alias(n) for n, e in attributes.items()])

    def one_of(*cases, other):
        """A value for each of the first nations by key, else ``other``."""
        out = other
        for i, value in reversed(list(enumerate(cases))):
            out = F.when(k == i, F.lit(value)).otherwise(out)
        return out

    k = F.col("n_nationkey")
    n = k.cast("string")
    c = F.col("c")
    row = F.format_string("%03d", k.cast("int")).alias(ROW)
    year = (F.lit(2000) + k).cast("string").alias("RENTREE")
    town = (F.lit(70) + k).cast("string")
    etabs = deg.select("RENTREE", "SOURCE", "ETABLI").filter("ETABLI IS NOT NULL").distinct()
    parent = F.when(F.col("UI") == "0011312W", "0694121E").otherwise(F.col("UI"))
    units = deg.select("RENTREE", F.col("COMPOS").alias("UI")).filter("UI IS NOT NULL").distinct().withColumn("UR", parent)
    rules = nation.select(
        row, F.lit("DEPBAC").alias("VAR1_IN"), F.when(k % 5 == 0, "075").when(k % 5 == 1, "2A").otherwise(n).alias("VALUE1_IN"), empty.alias("VAR2_IN"), empty.alias("VALUE2_IN"),
        F.lit("ACABAC").alias("VAR_OUT"), n.alias("VALUE_OUT"))
    flags = {f: (F.length("c") % 2).cast("string") for f in correct.COUNTRY_FLAGS}
    sheets = {
        "deleter": supplier.select(
            (2009 + F.col("s_suppkey") % 13).cast("string").alias("RENTREE"), F.lit("mana").alias("SOURCE"), empty.alias("DIPLOM"),
            F.when(F.col("s_suppkey") % 2 == 0, "0755555A").otherwise(F.col("s_name")).alias("ETABLI"), empty.alias("ETABLI_ORI_UAI"), empty.alias("ETABLI_DIFFUSION")).distinct(),
        "ETABLI": nation.select(one_of("0597131F", "0755555A", other=F.concat(F.lit("X"), n)).alias("IN"), one_of("0755555A", "abc", other=F.lit("0912423P")).alias("OUT"),
                                one_of("2015", other=F.lit("")).alias("RENTREE_START"), F.lit("2016").alias("RENTREE_END")),
        "A_UAI": etabs.select("RENTREE", "SOURCE", "ETABLI", F.lit("result").alias("TYPE"), F.concat(F.lit("P"), "ETABLI").alias("ID_PAYSAGE")),
        "D_EPE": etabs.select("RENTREE", F.concat(F.lit("P"), "ETABLI").alias("ID_PAYSAGE"), F.when(F.col("ETABLI") == "0912423P", "EPE1").otherwise("").alias("ID_PAYSAGE_EPE")),
        "ETABLI_DIFFUSION_ID": nation.select(one_of("LMD_A", other=F.col("n_name")).alias("IN"), n.alias("OUT")),
        "COMINS": nation.select(row, F.lit("rien").alias("TYP_DIPL"), one_of("0753364Z", other=F.lit("rien")).alias("COMPOS"), F.lit("rien").alias("RENTREE"), town.alias("IN"),
                                (F.lit(70) + (k + 1) % 25).cast("string").alias("OUT")),
        "COMETAB": nation.select(row, F.lit("0912423P").alias("ETABLI"), empty.alias("ID_PAYSAGE"), year, F.lit("rien").alias("IN"), n.alias("OUT")),
        "COMUI": nation.select(row, F.lit("crochet").alias("IN"), F.lit("0684045X").alias("COMPOS"), year, town.alias("OUT")),
        "DEP_ACA_RESPA_CORRECTIF": nation.select(row, year, F.lit("DEPBAC").alias("VAR_IN"), F.lit("000").alias("VALUE_IN"), F.lit("ACABAC").alias("VAR_OUT"), n.alias("VALUE_OUT")),
        "RESTE_DEPRESPA_CORRECTIF": rules, "DEP_CORRECTIF": rules.withColumn("VAR_OUT", F.lit("DEPBAC")), "ACA_CORRECTIF": rules,
        "GROUPE_CORRECTIF": rules.withColumns({"VAR_OUT": F.lit("GROUPE"), "VALUE1_IN": F.col("VALUE_OUT")}),
        "FORMATIONS_CORRECTIF": nation.select(
            row, one_of("XA", "XB", "XA", other=F.col("n_name")).alias("TYP_DIPL_IN"), one_of("6001000", "", "2217038", other=empty).alias("DIPLOM_IN"),
            one_of("31", "", "32", other=F.lit("33")).alias("SECTDIS_OUT"), one_of("", "XA", other=empty).alias("TYP_DIPL_OUT")),
        "CORRLMD": codes("TYP_DIPL", CURSUS_LMD_OUT=F.when(c == "XA", "L").when(c == "XB", "M").otherwise("")),
        "CURSUS_LMD_CORRECTIF": nation.select(F.lit("DU").alias("TYP_DIPL"), one_of("6001000", "9610007", "2217038", other=n).alias("DIPLOM"), one_of("", "02", other=empty).alias("NIVEAU"),
                                              one_of("D", "M", "X", other=F.lit("D")).alias("CURSUS_LMD_OUT")),
        "LES_COMMUNES": places(spark, sf).withColumn("COM_CODE", (F.lit(70) + F.col("COM_CODE").cast("int")).cast("string")),
        "H_PROXIMITE": nation.select(n.alias("DEPARTEMENT_UI"), F.when(k % 2 == 0, "0").otherwise("1").alias("DEPARTEMENT_PARENTS"), F.concat(n, F.lit(" - near")).alias("PROXIMIT_"),
                                     F.lit("1 - same").alias("PROX_R_GIONS"), F.lit("metropole").alias("OUTREMER")),
        "G_PAYS": codes("NATION", PAYS=c, CONTINENT=F.concat(F.lit("K"), c), **flags).drop("NATION"),
        "L_ED": codes("PAR_TYPE", NUMED=F.regexp_replace("c", "^0", ""), ID_PAYSAGE_ED=F.concat(F.lit("ED"), c)).drop("PAR_TYPE"),
        "M_IUT": units.withColumns({o: F.concat(F.lit(o), "UI") for o in ("ID_PAYSAGE_IUT", "ID_PAYSAGE_IUT_CAMPUS", "ID_PAYSAGE_IUT_POLE")}),
        "N_ING": units.withColumns({o: F.concat(F.lit(o), "UI") for o in ("ID_PAYSAGE_ING", "ID_PAYSAGE_ING_CAMPUS")}),
        "J_LMDDONT": codes("TYP_DIPL", LMDDONT=F.concat(F.lit("G"), c), LMDDONTBIS=F.concat(F.lit("B"), c)),
        "I_DNDU": codes("TYP_DIPL", DNDU=F.when(c == "DU", "DU").otherwise("DN")),
        "O_DUTBUT": codes("DIPLOM", CORRESPONDANCEIUT=c, SPECIUT=c, OPTIUT=empty, PARCOURSBUT=c),
        "DISCIPLINES_SISE": codes("SECTDIS", GDDISC=F.concat(F.lit("GD"), c)),
        "DEPTOREG": nation.select(n.alias("IN"), F.col("n_regionkey").cast("string").alias("OUT")),
        "DEPTOREGNEW": nation.select(n.alias("IN"), F.col("n_regionkey").cast("string").alias("OUT")),
    }
    known = set(SHEETS)
    return {name: as_sheet(v) for name, v in sheets.items() if name in known}


def unit_maps(spark, sf):
    deg = view(spark, sf, "deg")
    parents = deg.select("RENTREE", "COMPOS").filter("COMPOS <> ''").distinct().withColumn("RATTACH", F.concat(F.lit("R"), "COMPOS"))
    seats = deg.select("RENTREE", F.col("ETABLI").alias("UAI")).filter("UAI IS NOT NULL").distinct()
    return parents, seats.withColumn("COMCODE", F.substring("UAI", 2, 2))


# Raw columns of ``raw_facts`` by the expression they come from; the other raw columns are absent.
RAW_SQL = {c: f'"{c}"' for c in (
    "RESDIP", "RESINT", "TYP_DIPL", "TYP_DIPINT", "NIVEAUR", "DIPINT", "SECTINT", "DISCIPLINT", "SECTDIS", "DISCIPLI", "DIPLOM", "BAC", "BAC_RGRP", "ANBAC",
    "ANNAIS", "DEPBAC", "ACABAC", "NATION", "FR_ETR", "SEXE", "CURSUS_LMDR", "FLAG_MEEF", "ETABLI", "COMPOS")} | {
    "TYP_DIPR": '"TYP_DIPL"', "DIPLOMR": '"DIPLOM"', "COMPOSR": '"COMPOS"', "SECTDISR": '"SECTDIS"', "DISCIPLR": '"DISCIPLI"', "NUMED": '"PAR_TYPE"',
    "ETABLI_DIFFUSION": '"LMDDONT"'}


def cleaned_sql(column: str) -> str:
    """A raw column after the text clean-up."""
    if column in RAW_INTS:
        return RAW_SQL[column]
    text = f"CASE WHEN {RAW_SQL[column]} NOT IN ('nan', 'None', '<NA>') THEN {RAW_SQL[column]} END"
    if column not in ("TYP_DIPL", "TYP_DIPR", "TYP_DIPINT"):
        return text
    padded = f"CASE WHEN regexp_full_match({RAW_SQL[column]}, '[0-9]') THEN '0' || {RAW_SQL[column]} ELSE coalesce({text}, '') END"
    return padded if column != "TYP_DIPINT" else f"CASE WHEN {WITH_INT} THEN {padded} END"


def with_default(column: str, value: str) -> str:
    return f"CASE WHEN {miss(f'c.{chr(34)}{column}{chr(34)}')} THEN '{value}' ELSE c.\"{column}\" END"


BAC_SQL = with_default("BAC", "9999")
NORMALISED_SQL = {
    "RESDIP": "o.d", "RESINT": "o.r", "TYP_DIPINT": "o.t", "DISCIPLINT": "o.di", "FLAG_MEEF": "o.f", "DIPDER": "CASE WHEN o.w THEN '$' END", "VOIER": "'9'",
    "PCSPAR": "'99'", "BAC_RGRP": with_default("BAC_RGRP", "9"), "FR_ETR": with_default("FR_ETR", "9"), "SEXE": with_default("SEXE", "9"),
    "NUMED": f"CASE {with_default('NUMED', '')} WHEN '050' THEN '50' ELSE {with_default('NUMED', '')} END",
    "NATION": f"CASE WHEN {with_default('NATION', '$')} IN ('20', '22', '86') THEN '999' ELSE {with_default('NATION', '$')} END",
    "BAC": f"CASE {BAC_SQL} WHEN 'A2-8' THEN 'A2-85' WHEN 'A6' THEN 'A6-85' WHEN 'A6-8' THEN 'A6-85' WHEN 'A7' THEN 'A7-85' WHEN 'A7-8' THEN 'A7-85' ELSE {BAC_SQL} END",
    "SECTDISR": "CASE WHEN c.\"SECTDISR\" IN ('2A', '2B', '2C', '2E') THEN '21' WHEN c.\"SECTDISR\" = '2D' THEN '27' ELSE c.\"SECTDISR\" END",
    "DISCIPLR": "CASE WHEN c.\"SECTDISR\" IN ('2A', '2B', '2C', '2D', '2E') THEN '04' ELSE c.\"DISCIPLR\" END",
}


def normalised_sql(column: str) -> str:
    absent = f"CAST(NULL AS {'BIGINT' if column in RAW_INTS else 'VARCHAR'})"
    return NORMALISED_SQL.get(column, f'c."{column}"' if column in RAW_SQL else absent)


@query("normalise_facts", f"""
WITH cleaned AS (SELECT k, "SOURCE", "RENTREE", {', '.join(f'{cleaned_sql(c)} AS "{c}"' for c in RAW_SQL)} FROM deg),
{OUTCOMES.replace("FROM deg)", "FROM cleaned)")}
SELECT c.k, "SOURCE", "RENTREE", CAST(CAST("RENTREE" AS INT) + 1 AS VARCHAR) AS "SESSION",
  "RENTREE" || '-' || substr(CAST(CAST("RENTREE" AS INT) + 1 AS VARCHAR), 3, 2) AS "ANNEE_UNIVERSITAIRE",
  {', '.join(f'{normalised_sql(c)} AS "{c}"' for c in RAW_COLUMNS)}
FROM cleaned c JOIN o7 o ON o.k = c.k WHERE "SOURCE" NOT IN ('result', 'priv') OR o.d = 'O' OR o.r = 'O'""", ["deg"])
def normalise_facts(spark, sf):
    """The first half of the job, every column."""
    df = correct.normalise(raw_facts(spark, sf))
    return df.select("k", "SOURCE", "RENTREE", "SESSION", "ANNEE_UNIVERSITAIRE", *RAW_COLUMNS)


# The second half of the job, step by step ------------------------------------

NORMALISED = f"""cleaned AS (SELECT k, "SOURCE", "RENTREE", {', '.join(f'{cleaned_sql(c)} AS "{c}"' for c in RAW_SQL)} FROM deg),
{OUTCOMES.replace("FROM deg)", "FROM cleaned)")},
norm AS (SELECT c.k, "SOURCE", "RENTREE", CAST(CAST("RENTREE" AS INT) + 1 AS VARCHAR) AS "SESSION",
  "RENTREE" || '-' || substr(CAST(CAST("RENTREE" AS INT) + 1 AS VARCHAR), 3, 2) AS "ANNEE_UNIVERSITAIRE",
  {', '.join(f'{normalised_sql(c)} AS "{c}"' for c in RAW_COLUMNS)}
  FROM cleaned c JOIN o7 o ON o.k = c.k WHERE "SOURCE" NOT IN ('result', 'priv') OR o.d = 'O' OR o.r = 'O')"""


def texts(values):
    return "(" + ", ".join(f"'{v}'" for v in values) + ")"


def padded_sql(*columns):
    return ", ".join(f"CASE WHEN regexp_full_match(\"{c}\", '[0-9]') THEN '0' || \"{c}\" ELSE \"{c}\" END AS \"{c}\"" for c in columns)


def cycle_sql(kind, cycle, guard):
    """Cycle by type, by degree and level, by degree, the last that is found; in place of the column."""
    return f"""CASE WHEN "{kind}" = 'DU' AND "DIPLOM" = '6001000' THEN 'D' WHEN "{kind}" = 'DU' AND "DIPLOM" = '2217038' THEN 'X'
    WHEN "{kind}" = 'DU' AND "DIPLOM" = '9610007' AND "NIVEAU" = '02' THEN 'M'
    WHEN "{kind}" = 'XA' AND {guard} THEN 'L' WHEN "{kind}" = 'XB' AND {guard} THEN 'M' ELSE "{cycle}" END AS "{cycle}\""""


WITHIN = "coalesce(\"SOURCE\" IN ('result', 'ens', 'inge', 'priv'), FALSE)"
OPEN_CYCLE = f"({miss('CURSUS_LMD')} OR CURSUS_LMD = 'X')"
OLD_YEARS, COUNTED = 'CAST("RENTREE" AS INT) < 2012', "coalesce(\"BAC_RGRP\" IN ('1', '2', '3', '4', '5', '6', 'A'), FALSE)"
GENERAL = "\"BAC_RGRP\" IN ('1', '2', '3', '4', '5')"
NO_PLACE = f"(({blank('DEPBAC')} OR DEPBAC = '000') AND (BAC_RGRP IS NULL OR BAC_RGRP <> '7'))"


def age_flag(late, six_late):
    """O or N by age, X where it does not apply; unknown ages leave both open. The last rule that holds counts."""
    return f"""CASE WHEN NOT {OLD_YEARS} AND ("ANBAC" IS NULL OR NOT {COUNTED}) THEN 'X'
    WHEN NOT {OLD_YEARS} AND {COUNTED} AND "AGE_BAC" IS NOT NULL THEN CASE WHEN "AGE_BAC" {late} THEN 'O' ELSE 'N' END
    WHEN {OLD_YEARS} AND ("ANBAC" IS NULL OR "BAC_RGRP" IN ('7', '9')) THEN 'X'
    WHEN {OLD_YEARS} AND "BAC_RGRP" = '6' AND "AGE_BAC" IS NOT NULL THEN CASE WHEN "AGE_BAC" {six_late} THEN 'O' ELSE 'N' END
    WHEN {OLD_YEARS} AND {GENERAL} AND "AGE_BAC" IS NOT NULL THEN CASE WHEN "AGE_BAC" {late} THEN 'O' ELSE 'N' END END"""


# Columns of the corrected facts: texts without NULL, texts whose missing tokens are blanked, numbers.
CORRECTED_TEXTS = (
    "RENTREE", "DIPLOM", "SOURCE", "ETABLI", "ETABLI_ORI_UAI", "ETABLI_DIFFUSION", "RESDIP", "RESINT", "TYP_DIPL", "TYP_DIPINT", "NIVEAU", "DIPINT", "SECTINT", "DISCIPLINT",
    "BAC", "BAC_RGRP", "DEPBAC", "ACABAC", "NATION", "FR_ETR", "SEXE", "CURSUS_LMDR", "FLAG_MEEF", "COMPOS", "SECTDIS", "DISCIPLI", "NUMED", "CONV", "CURSUS_LMD", "CYCLE",
    "DIPDER", "ETATINS", "FLAG_DIP", "FLAG_RES", "GROUPE", "GROUPINT", "IDETU", "IDETU1", "PAYS_MOBPCO", "PCSPAR", "PCSPAR2", "REGIME", "SITUPRE", "TYPE_MOBPCO", "VOIE",
    "ANNEE_UNIVERSITAIRE", "SESSION", "ID_PAYSAGE_FORMENS", "COMUI", "PAR_TYPE", "ETABLIESPE", "UI", "RATTACH", "UR", "ID_PAYSAGE", "ID_PAYSAGE_EPE_ETAB_COMPOS", "ID_PAYSAGE_EPE",
    "COMCODE", "UAI", "CURSUS_LMD_INT", "DEPINS", "UUCRINS", "UUCRETAB", "PROXREG", "PROXIMITE", "PROXBAC", "PROXREGBAC", "OUTREMER", "CONTINENT", "ID_PAYSAGE_ED",
    "ID_PAYSAGE_IUT", "ID_PAYSAGE_IUT_CAMPUS", "ID_PAYSAGE_IUT_POLE", "ID_PAYSAGE_ING", "ID_PAYSAGE_ING_CAMPUS", "LMDDONT", "LMDDONTBIS", "LMDDONT_INT", "LMDDONTBIS_INT",
    "DNDU", "DNDU_INT", "CORRESPONDANCEIUT", "SPECIUT", "OPTIUT", "PARCOURSBUT", "GDDISC", "RETARD", "AVANCE", "REGRESPA", "REGRESPA16", "NATION_BAC", "NATION_VRAI", "MOBINTERN")
CODED = ("COMETAB", "DEPRESPA", "ACARESPA", "COMINS", "ANNAIS", "ANBAC", "AGE_BAC")
NUMBERS = ("ANINSC", "EFFECTIF_R", "EFFECTIF_INT", "EFF_SS_ESPE", *correct.COUNTRY_FLAGS)
UNIT_IDS = ", ".join(
    f"CASE WHEN \"COMPOS\" = '0011312W' AND u.y IS NOT NULL THEN '{c}0011312W' END AS \"{c}\""
    for c in ("ID_PAYSAGE_IUT", "ID_PAYSAGE_IUT_CAMPUS", "ID_PAYSAGE_IUT_POLE", "ID_PAYSAGE_ING", "ID_PAYSAGE_ING_CAMPUS"))
UNGROUPED = "coalesce(\"DIPLOM\" IN " + texts(derive.UNGROUPED_DEGREES) + ", FALSE)"
AS_TEXT = {c: f'CAST("{c}" AS VARCHAR)' for c in CODED}

CORRECT_SQL = f"""
WITH {NORMALISED},
kinds AS (SELECT DISTINCT "TYP_DIPL" AS c FROM deg WHERE "TYP_DIPL" IS NOT NULL),
c0 AS (SELECT * REPLACE (CASE WHEN NOT {miss('DIPLOMR')} THEN "DIPLOMR" END AS "DIPLOMR", CASE WHEN NOT {miss('DIPINT')} THEN "DIPINT" END AS "DIPINT",
    CASE WHEN NOT {miss('TYP_DIPINT')} THEN "TYP_DIPINT" END AS "TYP_DIPINT")
  FROM norm WHERE NOT coalesce({miss('DIPLOMR')} AND "TYP_DIPR" = '99' AND {miss('DIPINT')} AND {miss('TYP_DIPINT')}, FALSE)),
c1 AS (SELECT * EXCLUDE ("SECTDIS", "COMPOS", "DISCIPLI", "DIPLOM", "CYCLE", "GROUPE", "NIVEAU", "TYP_DIPL", "VOIE", "SECTDISR", "COMPOSR", "DISCIPLR", "DIPLOMR", "CYCLER", "GROUPER",
    "NIVEAUR", "TYP_DIPR", "VOIER"),
  "SECTDISR" AS "SECTDIS", "COMPOSR" AS "COMPOS", "DISCIPLR" AS "DISCIPLI", "DIPLOMR" AS "DIPLOM", "CYCLER" AS "CYCLE", "GROUPER" AS "GROUPE",
  CASE WHEN "SOURCE" = 'culture' THEN "NIVEAU" ELSE "NIVEAUR" END AS "NIVEAU", "TYP_DIPR" AS "TYP_DIPL", "VOIER" AS "VOIE", "ANBAC" - "ANNAIS" AS "AGE_BAC",
  CASE WHEN "RESDIP" IN ('O', '1') THEN 1 ELSE 0 END AS "EFFECTIF_R", CASE WHEN "RESINT" IN ('O', '1') THEN 1 ELSE 0 END AS "EFFECTIF_INT" FROM c0),
c2 AS (SELECT * REPLACE (CASE WHEN "ETABLI" IS NOT NULL AND ("COMPOS" IS NULL OR length("COMPOS") < 3) THEN "ETABLI" ELSE "COMPOS" END AS "COMPOS",
    CASE WHEN regexp_replace("NUMED", '^0', '') = 'HORS' THEN '' ELSE regexp_replace("NUMED", '^0', '') END AS "NUMED",
    CASE WHEN "ETABLI" = '0352771X' THEN '0352692L' ELSE "ETABLI" END AS "ETABLI", CASE WHEN "RENTREE" > '2019' THEN '' ELSE "DEPBAC" END AS "DEPBAC") FROM c1),
c3 AS (SELECT *, "ETABLI" AS "ETABLI_ORI_UAI", "COMPOS" AS "UI", '' AS "ID_PAYSAGE_FORMENS", '' AS "COMUI", '' AS "PAR_TYPE", '' AS "ETABLIESPE",
    CASE WHEN "SOURCE" = 'priv' THEN 0 END AS "EFF_SS_ESPE", CASE "COMPOS" WHEN '0011312W' THEN '0694121E' WHEN '0133479L' THEN '0131844J' END AS "UR"
  FROM c2 WHERE NOT coalesce("SOURCE" = 'mana' AND "ETABLI" = '0755555A' AND "RENTREE" IN (SELECT CAST(2009 + s_suppkey % 13 AS VARCHAR) FROM supplier WHERE s_suppkey % 2 = 0), FALSE)),
c4 AS (SELECT c3.* REPLACE (CASE WHEN "COMPOS" IN {texts(correct.UNITS_AS_ESTABLISHMENTS)} THEN "COMPOS" ELSE "ETABLI" END AS "ETABLI",
    CASE WHEN "COMPOS" IN {texts(correct.UNITS_AS_ESTABLISHMENTS)} THEN "COMPOS" ELSE "ETABLI_ORI_UAI" END AS "ETABLI_ORI_UAI",
    CASE WHEN "SOURCE" = 'priv' THEN '1' ELSE "FLAG_MEEF" END AS "FLAG_MEEF", CASE WHEN "COMPOS" = '0684045X' THEN '0694045X' ELSE "UI" END AS "UI"),
    coalesce('R' || p.c, "COMPOS") AS "RATTACH"
  FROM c3 LEFT JOIN (SELECT DISTINCT "RENTREE" AS y, "COMPOS" AS c FROM deg WHERE "COMPOS" <> '') p ON p.y = "RENTREE" AND p.c = "COMPOS"),
c5 AS (SELECT * REPLACE (CASE WHEN "ETABLI" = '0597131F' AND "RENTREE" IN ('2015', '2016') THEN '0755555A' ELSE "ETABLI" END AS "ETABLI") FROM c4),
c6 AS (SELECT c5.*, 'P' || a.e AS "ID_PAYSAGE" FROM c5 LEFT JOIN (SELECT DISTINCT "RENTREE" AS y, "SOURCE" AS s, "ETABLI" AS e FROM deg WHERE "ETABLI" IS NOT NULL) a
  ON a.y = "RENTREE" AND a.s = "SOURCE" AND a.e = "ETABLI"),
c7 AS (SELECT c6.* REPLACE (CASE WHEN d.e = '0912423P' THEN 'EPE1' ELSE "ID_PAYSAGE" END AS "ID_PAYSAGE",
    CASE WHEN "ETABLI_DIFFUSION" = 'LMD_A' THEN '0' WHEN n_name IS NOT NULL THEN CAST(n_nationkey AS VARCHAR) ELSE "ID_PAYSAGE_FORMENS" END AS "ID_PAYSAGE_FORMENS"),
    'P' || d.e AS "ID_PAYSAGE_EPE_ETAB_COMPOS", CASE WHEN d.e = '0912423P' THEN 'EPE1' WHEN d.e IS NOT NULL THEN '' END AS "ID_PAYSAGE_EPE"
  FROM c6 LEFT JOIN (SELECT DISTINCT "RENTREE" AS y, "ETABLI" AS e FROM deg WHERE "ETABLI" IS NOT NULL) d ON d.y = "RENTREE" AND 'P' || d.e = "ID_PAYSAGE"
  LEFT JOIN nation ON n_name = "ETABLI_DIFFUSION" AND n_nationkey > 0),
seats AS (SELECT DISTINCT "RENTREE" AS y, "ETABLI" AS uai, substr("ETABLI", 2, 2) AS code FROM deg WHERE "ETABLI" IS NOT NULL),
c8 AS (SELECT c7.*, s.code AS found, t.code AS "COMCODE", t.uai AS "UAI" FROM c7 LEFT JOIN seats s ON s.y = "RENTREE" AND s.uai = "COMPOS" LEFT JOIN seats t ON t.y = "RENTREE" AND t.uai = "ETABLI"),
c9 AS (SELECT * EXCLUDE (found), CASE WHEN TRY_CAST(found AS INT) BETWEEN 71 AND 94 OR found = '70' AND "COMPOS" = '0753364Z' THEN '70' ELSE found END AS "COMINS",
    CASE WHEN "ETABLI" = '0912423P' AND CAST("RENTREE" AS INT) BETWEEN 2000 AND 2024 THEN CAST(CAST("RENTREE" AS INT) - 2000 AS VARCHAR)
      WHEN "ETABLI" IN {texts(correct.OVERSEAS_ESTABLISHMENTS)} OR "COMCODE" IS NULL OR "ETABLI" IS NULL OR "COMCODE" <> substr("ETABLI", 1, 5) THEN "COMCODE" END AS "COMETAB" FROM c8),
c10 AS (SELECT * REPLACE (CASE WHEN "COMINS" = substr("COMPOS", 1, 5) AND NOT coalesce("UI" IN {texts(correct.OVERSEAS_UNITS)}, FALSE) THEN ''
    WHEN "COMINS" IS NULL OR "COMINS" <> '' THEN "COMINS" ELSE "COMUI" END AS "COMUI") FROM c9),
c11 AS (SELECT * REPLACE (CASE WHEN {miss('COMUI')} AND "COMPOS" = '0684045X' AND CAST("RENTREE" AS INT) BETWEEN 2000 AND 2024 THEN CAST(CAST("RENTREE" AS INT) - 1930 AS VARCHAR)
    ELSE "COMUI" END AS "COMUI") FROM c10),
c12 AS (SELECT * REPLACE (CASE WHEN {blank('SITUPRE')} THEN '9' ELSE "SITUPRE" END AS "SITUPRE",
    CASE WHEN "BAC" IN ('0037', '0031') THEN '7' WHEN "BAC" = 'ES' THEN '2' ELSE "BAC_RGRP" END AS "BAC_RGRP",
    CASE WHEN "NATION" IN {texts(correct.VAGUE_NATIONS)} THEN '999' ELSE "NATION" END AS "NATION",
    CASE "DEPBAC" WHEN '000' THEN CAST(CAST("RENTREE" AS INT) - 2000 AS VARCHAR) WHEN '075' THEN '20' WHEN '2A' THEN '21' ELSE "ACABAC" END AS "ACABAC",
    CASE "DEPBAC" WHEN '075' THEN '0' WHEN '2A' THEN '1' ELSE "DEPBAC" END AS "DEPBAC") FROM c11),
c14 AS (SELECT * REPLACE ({padded_sql(*correct.PADDED_CODES)}) FROM c12),
c15 AS (SELECT * REPLACE (CASE WHEN "TYP_DIPL" IN ('XA', 'XB') AND "DIPLOM" = '2217038' THEN '32' WHEN "TYP_DIPL" = 'XA' AND "DIPLOM" = '6001000' THEN '31' ELSE "SECTDIS" END AS "SECTDIS",
    CASE WHEN "TYP_DIPL" = 'XB' THEN 'XA' ELSE "TYP_DIPL" END AS "TYP_DIPL") FROM c14),
c16 AS (SELECT * REPLACE (CASE WHEN "SECTDIS" IN {texts(correct.MERGED_SECTORS)} THEN '39' ELSE "SECTDIS" END AS "SECTDIS"), CAST(NULL AS VARCHAR) AS "CURSUS_LMD_INT" FROM c15),
c17 AS (SELECT * REPLACE ({cycle_sql('TYP_DIPL', 'CURSUS_LMD', OPEN_CYCLE)}, {cycle_sql('TYP_DIPINT', 'CURSUS_LMD_INT', 'TRUE')}) FROM c16),
c18 AS (SELECT * REPLACE (CASE WHEN "SOURCE" = 'priv' AND "CURSUS_LMD_INT" = 'X' AND "RESINT" = 'O' THEN CASE WHEN "TYP_DIPINT" = 'CP' THEN 'L' WHEN "TYP_DIPINT" = 'EP' THEN 'M'
      WHEN "TYP_DIPINT" = '' AND "TYP_DIPL" = 'XB' THEN 'M' WHEN "TYP_DIPINT" = '' AND "TYP_DIPL" IN ('TB', 'TE') THEN 'D' ELSE "CURSUS_LMD_INT" END ELSE "CURSUS_LMD_INT" END AS "CURSUS_LMD_INT",
    CASE WHEN "DEPBAC" IN ('0', '1') THEN "DEPBAC" ELSE "GROUPE" END AS "GROUPE", CASE WHEN {blank('REGIME')} THEN '99' ELSE "REGIME" END AS "REGIME") FROM c17),
towns AS (SELECT CAST(70 + n_nationkey AS VARCHAR) AS code, CAST(n_nationkey AS VARCHAR) AS dep, 'U' || n_nationkey % 8 AS uu, CASE WHEN n_nationkey % 2 = 0 THEN '0' ELSE '1' END AS other FROM nation),
c19 AS (SELECT c18.* REPLACE (CASE WHEN "NATION" IN (SELECT "NATION" FROM deg WHERE "NATION" IS NOT NULL) THEN "NATION" ELSE '999' END AS "NATION"), a.dep AS "DEPINS", a.uu AS "UUCRINS", b.uu AS "UUCRETAB",
    CAST(NULL AS VARCHAR) AS "PROXREG", CAST(NULL AS VARCHAR) AS "PROXIMITE", CASE WHEN "DEPBAC" = a.other THEN a.dep || ' - near' END AS "PROXBAC",
    CASE WHEN "DEPBAC" = a.other THEN '1 - same' END AS "PROXREGBAC", CASE WHEN "DEPBAC" = a.other THEN 'metropole' END AS "OUTREMER"
  FROM c18 LEFT JOIN towns a ON a.code = "COMUI" LEFT JOIN towns b ON b.code = "COMETAB"),
c20 AS (SELECT c19.*, 'K' || "NATION" AS "CONTINENT", {', '.join(f'length("NATION") % 2 AS "{f}"' for f in correct.COUNTRY_FLAGS)},
    'ED' || e.c AS "ID_PAYSAGE_ED", {UNIT_IDS}, 'G' || g.c AS "LMDDONT", 'B' || g.c AS "LMDDONTBIS", 'G' || h.c AS "LMDDONT_INT", 'B' || h.c AS "LMDDONTBIS_INT",
    CASE WHEN g.c = 'DU' THEN 'DU' WHEN g.c IS NOT NULL THEN 'DN' END AS "DNDU", CASE WHEN h.c = 'DU' THEN 'DU' WHEN h.c IS NOT NULL THEN 'DN' END AS "DNDU_INT",
    CASE WHEN "DIPLOM" IN (SELECT "DIPLOM" FROM deg WHERE "DIPLOM" IS NOT NULL) THEN "DIPLOM" ELSE 'AUTRES' END AS iut
  FROM c19 LEFT JOIN (SELECT DISTINCT "PAR_TYPE" AS c FROM deg WHERE "PAR_TYPE" IS NOT NULL) e ON regexp_replace(e.c, '^0', '') = "NUMED"
  LEFT JOIN kinds g ON g.c = "TYP_DIPL" LEFT JOIN kinds h ON h.c = "TYP_DIPINT"
  LEFT JOIN (SELECT DISTINCT "RENTREE" AS y FROM deg WHERE "COMPOS" = '0011312W') u ON u.y = "RENTREE"),
c21 AS (SELECT * EXCLUDE (iut) REPLACE (CASE WHEN NOT {WITHIN} THEN "DNDU_INT" WHEN "TYP_DIPINT" = '' THEN '' WHEN "TYP_DIPINT" = 'DU' THEN "DNDU_INT" ELSE 'DN' END AS "DNDU_INT"),
    iut AS "CORRESPONDANCEIUT", iut AS "SPECIUT", 'AUTRES' AS "OPTIUT", iut AS "PARCOURSBUT" FROM c20),
c22 AS (SELECT * REPLACE (CASE WHEN {UNGROUPED} OR {blank('LMDDONT')} THEN 'AUTRES' ELSE "LMDDONT" END AS "LMDDONT",
    CASE WHEN "TYP_DIPL" = 'XC' AND "DIPLOM" IN {texts(derive.OTHER_MASTERS)} THEN 'MAS_AUT' WHEN "TYP_DIPL" = '63' AND "DIPLOM" IN {texts(derive.PAREO_DEGREES)} THEN 'PAREO'
      WHEN "TYP_DIPL" = '61' AND "DIPLOM" IN {texts(derive.REBOND_DEGREES)} THEN 'REBOND' WHEN "TYP_DIPL" = 'XA' THEN 'LIC_L_AUT' WHEN "DNDU" = 'DU' THEN 'DU'
      WHEN {UNGROUPED} OR {blank('LMDDONTBIS')} THEN 'AUTRES' ELSE "LMDDONTBIS" END AS "LMDDONTBIS",
    CASE WHEN NOT {WITHIN} THEN "LMDDONT_INT" WHEN {UNGROUPED} OR {blank('LMDDONT_INT')} THEN 'AUTRES' ELSE "LMDDONT_INT" END AS "LMDDONT_INT",
    CASE WHEN NOT {WITHIN} THEN "LMDDONTBIS_INT" WHEN "DNDU_INT" = 'DU' THEN 'DU' WHEN {UNGROUPED} OR {blank('LMDDONTBIS_INT')} THEN 'AUTRES' ELSE "LMDDONTBIS_INT" END AS "LMDDONTBIS_INT"),
    CASE WHEN "SECTDIS" IN (SELECT "SECTDIS" FROM deg WHERE "SECTDIS" IS NOT NULL) THEN 'GD' || "SECTDIS" END AS "GDDISC" FROM c21),
c23 AS (SELECT * REPLACE (CASE WHEN {blank('BAC_RGRP')} AND "BAC" IN ('0031', '0032') THEN '7' ELSE "BAC_RGRP" END AS "BAC_RGRP",
    CASE WHEN "ANBAC" IS NOT NULL THEN "ANBAC" - "ANNAIS" ELSE "AGE_BAC" END AS "AGE_BAC") FROM c22),
c24 AS (SELECT * REPLACE (CASE WHEN "BAC_RGRP" = '9' AND "ANBAC" IS NULL THEN '7' ELSE "BAC_RGRP" END AS "BAC_RGRP"), {age_flag('> 18', '> 19')} AS "RETARD", {age_flag('< 18', '<= 18')} AS "AVANCE" FROM c23),
c25 AS (SELECT * REPLACE (
    CASE WHEN {NO_PLACE} THEN '5 - NR' WHEN "BAC_RGRP" = '7' THEN '9 - non-bachelier' WHEN "BAC_RGRP" = '9' AND {blank('PROXBAC')} THEN '5 - NR' ELSE "PROXBAC" END AS "PROXBAC",
    CASE WHEN {NO_PLACE} THEN '3 - NR' WHEN "BAC_RGRP" = '9' AND {blank('PROXREGBAC')} THEN '3 - NR' WHEN "BAC_RGRP" = '7' THEN '9 - non-bachelier' ELSE "PROXREGBAC" END AS "PROXREGBAC",
    CASE WHEN "BAC_RGRP" = '7' THEN 'non-bachelier' ELSE "OUTREMER" END AS "OUTREMER"), CAST(NULL AS VARCHAR) AS "REGRESPA", CAST(NULL AS VARCHAR) AS "REGRESPA16" FROM c24),
c26 AS (SELECT * REPLACE (CASE WHEN "BAC_RGRP" IN ('1', '2', '3') THEN 'A' ELSE "BAC_RGRP" END AS "BAC_RGRP", CASE WHEN {blank('DNDU')} THEN 'DN' ELSE "DNDU" END AS "DNDU",
    CASE WHEN "TYP_DIPL" = 'DU' AND "CURSUS_LMD" = 'D' THEN 'M' WHEN "TYP_DIPL" = 'XA' THEN 'L' ELSE "CURSUS_LMD" END AS "CURSUS_LMD",
    CASE WHEN NOT {WITHIN} THEN "CURSUS_LMD_INT" WHEN "TYP_DIPINT" = 'DU' AND "CURSUS_LMD_INT" = 'D' THEN 'M' WHEN "TYP_DIPINT" = 'XA' THEN 'L' ELSE "CURSUS_LMD_INT" END AS "CURSUS_LMD_INT"),
    CASE WHEN "BAC" IN ('0001', '0002', '0031') THEN 'E' ELSE 'F' END AS "NATION_BAC", CASE WHEN "BAC" IN ('0001', '0002', '0031') AND "FR_ETR" = '2' THEN 'E' ELSE 'F' END AS "NATION_VRAI",
    CASE WHEN ("NATION" IS NULL OR "NATION" <> '100') AND (coalesce("ACABAC" = '00', FALSE) OR coalesce("BAC" = '0031', FALSE)) THEN 'M' ELSE 'X' END AS "MOBINTERN" FROM c25),
c27 AS (SELECT k, {', '.join(f'coalesce("{c}", {chr(39) * 2}) AS "{c}"' for c in CORRECTED_TEXTS)}, {', '.join(f"CASE WHEN {miss(t)} THEN '' ELSE {t} END AS {chr(34)}{c}{chr(34)}" for c, t in AS_TEXT.items())},
    {', '.join(f'"{c}"' for c in NUMBERS)}, coalesce("NBACH", 0) AS "NBACH", coalesce("NET", 0) AS "NET" FROM c26),
c28 AS (SELECT *, "RESDIP" = 'O' AND "RESINT" IN ('N', 'X') AS final_only, "SOURCE" = 'inge' AND "RESDIP" = 'O' AND "DIPLOM" = '6000361' AND "TYP_DIPL" = '99' AS engineer FROM c27),
c29 AS (SELECT * EXCLUDE (final_only, engineer) REPLACE ({', '.join(f'CASE WHEN final_only THEN {chr(39) * 2} ELSE "{c}" END AS "{c}"' for c in correct.INTERMEDIATE_COLUMNS)},
    CASE WHEN final_only THEN 0 ELSE "EFFECTIF_INT" END AS "EFFECTIF_INT", CASE WHEN engineer THEN 'M' ELSE "CURSUS_LMDR" END AS "CURSUS_LMDR", CASE WHEN engineer THEN '16' ELSE "SECTDIS" END AS "SECTDIS",
    CASE WHEN engineer THEN '15' ELSE "DISCIPLI" END AS "DISCIPLI", CASE WHEN engineer THEN 'FI' ELSE "TYP_DIPL" END AS "TYP_DIPL") FROM c28),
c30 AS (SELECT * REPLACE (CASE WHEN "CURSUS_LMDR" <> 'D' THEN '' ELSE "ID_PAYSAGE_ED" END AS "ID_PAYSAGE_ED", CASE WHEN "TYP_DIPL" = 'JD' AND "CURSUS_LMDR" = 'L' THEN 'M' ELSE "CURSUS_LMDR" END AS "CURSUS_LMDR"),
    "EFFECTIF_R" + "EFFECTIF_INT" AS "EFFECTIF_TOT" FROM c29
  WHERE NOT ("SOURCE" = 'inge' AND "RENTREE" = '2020' AND "RESDIP" = 'O' AND "RESINT" = 'N' AND "DIPLOM" IN ('2500203', '2500164') AND "ETABLI_ORI_UAI" IN ('0597131F', '0632033T'))),
job AS (SELECT * FROM c30 WHERE "EFFECTIF_TOT" > 0)
"""


def corrected_job(spark, sf):
    return correct.correct_table(spark, raw_facts(spark, sf), correction_sheets(spark, sf), *unit_maps(spark, sf))


@query("correct_facts", CORRECT_SQL + "SELECT * FROM job", ["deg"])
def correct_facts_rows(spark, sf):
    """The whole correction job, every row and column."""
    return corrected_job(spark, sf)


@query("correct_facts_by_source", CORRECT_SQL + """SELECT "SOURCE", "RENTREE", "CURSUS_LMD", "LMDDONTBIS", "RETARD", "AVANCE", "MOBINTERN",
  CAST(sum("EFFECTIF_TOT") AS BIGINT) AS n_degrees, count(*) AS n_rows FROM job GROUP BY ALL""", ["deg"])
def correct_facts(spark, sf):
    """The whole correction job, summed per source and year."""
    sums = corrected_job(spark, sf).groupBy("SOURCE", "RENTREE", "CURSUS_LMD", "LMDDONTBIS", "RETARD", "AVANCE", "MOBINTERN")
    return sums.agg(F.sum("EFFECTIF_TOT").alias("n_degrees"), F.count(F.lit(1)).alias("n_rows"))
