"""Registry and input views of the queries.

The supplied tables are clean, so each view injects missing tokens and domain codes by
deterministic expressions over the whole table. A view is one SQL text that both engines
read; what is under test (the operator) is written with the library on one side and by
hand in SQL on the other.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings",
    "pages", "benchmark", "labels", "conversations",
)


@dataclass(frozen=True)
class Query:
    run: Callable[[SparkSession, str], DataFrame]
    sql: str | None


REGISTRY: dict[str, Query] = {}


def pick(by: str, *values: str | None) -> str:
    """SQL: one of ``values`` (texts, NULL for None) by ``by`` modulo their number.

    ``by`` appears once in the text, so views stay small when expressions are stacked on them.
    """
    listed = "|".join("~" if v is None else v for v in values)
    part = f"split_part('{listed}', '|', CAST(({by}) % {len(values)} + 1 AS INT))"
    return f"nullif({part}, '~')" if None in values else part


def miss(c: str) -> str:
    """SQL: is the text cell missing?"""
    return f"({c} IS NULL OR {c} IN ('', 'None', 'nan', '<NA>'))"


def blank(c: str) -> str:
    return f"({c} IS NULL OR {c} = '')"


# Mixed residues of the keys: every combination of codes occurs, on every row of the table.
_MIX = """SELECT o_orderkey AS k, o_custkey AS cust, o_orderstatus AS status, o_orderpriority AS prio,
  CAST(year(o_orderdate) AS BIGINT) AS y, CAST(round(o_totalprice * 100) AS BIGINT) AS cents,
  (o_orderkey * 7919 + o_custkey * 104729) % 9973 AS h1, (o_orderkey * 6101 + o_custkey * 15137) % 9967 AS h2,
  (o_orderkey * 3571 + o_custkey * 32029) % 9949 AS h3, (o_orderkey * 911 + o_custkey * 7027) % 9941 AS h4
  FROM {orders}"""

SOURCES = ("result", "ens", "inge", "priv", "mana", "enq", "culture")

VIEWS = {
    # One degree record per order, with the codes the domain rules test.
    "deg": f"""SELECT k, h1, h2, h3, h4, cents,
  {pick('h1', *SOURCES)} AS "SOURCE",
  CAST(2009 + h2 % 13 AS STRING) AS "RENTREE",
  {pick('h3', 'O', 'N', 'X', None, '1', 'None', 'O', 'O')} AS "RESDIP",
  {pick('h4', 'O', 'N', 'X', None, '', 'None', 'O', 'N')} AS "RESINT",
  {pick('h1 + h2', 'XA', 'XB', '61', '63', 'XC', 'DU', '99', 'PE', '7', 'TB', '', 'UT')} AS "TYP_DIPL",
  {pick('h2 + h3', 'XA', 'XB', '99', 'PE', None)} AS "TYP_DIPR",
  {pick('h3 + h4', None, '', 'None', '10', '20', 'CC', '01', 'XA', 'DU', 'CP', 'EP', 'UT')} AS "TYP_DIPINT",
  {pick('h1 + h3', '02', '01', '1', None, '')} AS "NIVEAUR",
  {pick('h2 + h4', None, '', '5000770', '8', '2500203', 'None')} AS "DIPINT",
  {pick('h1 + h4', '07', '08', None)} AS "SECTINT",
  {pick('h3', '11', '12', None)} AS "DISCIPLINT",
  {pick('h4', '2A', '2B', '2D', '44', '5', '21', None)} AS "SECTDIS",
  {pick('h1', '01', '04', None)} AS "DISCIPLI",
  {pick('h2 * 3 + h1', '6001000', '9610007', '9630163', '2217038', '6000361', '2500203', '1111111', None)} AS "DIPLOM",
  {pick('h3 + h2', '0001291', '0000001', '', None)} AS "PAR_TYPE",
  {pick('h4 + h3', 'DU', 'DN', '', None)} AS "DNDU",
  {pick('h1 + h4', 'DU', 'DN', '', None)} AS "DNDU_INT",
  {pick('h1', 'LMD_A', '', None)} AS "LMDDONT",
  {pick('h2', 'LMD_B', '', None)} AS "LMDDONTBIS",
  {pick('h3', 'LMD_C', '', None)} AS "LMDDONT_INT",
  {pick('h4', 'LMD_D', '', None)} AS "LMDDONTBIS_INT",
  {pick('h1 + h2 + h3', '0031', '0032', '0001', '0037', 'ES', 'A6', 'A2-8', '', None, '0500')} AS "BAC",
  {pick('h2', '1', '2', '3', '4', '5', '6', '7', '9', 'A', '', None)} AS "BAC_RGRP",
  CASE WHEN h3 % 11 = 0 THEN NULL ELSE 2005 + h1 % 12 END AS "ANBAC",
  CASE WHEN h4 % 13 = 0 THEN NULL ELSE 1985 + h1 % 12 + h4 % 5 END AS "ANNAIS",
  {pick('h4', '000', '075', '', None, '2A')} AS "DEPBAC",
  {pick('h3', '00', '01', '', None)} AS "ACABAC",
  {pick('h1', '1 - same', '', None)} AS "PROXBAC",
  {pick('h2', '2 - far', '', None)} AS "PROXREGBAC",
  {pick('h3', 'metropole', '', None)} AS "OUTREMER",
  {pick('h1 + h2', '100', '999', '20', '$', '600', '', None, '350')} AS "NATION",
  {pick('h2', '1', '2', '', None)} AS "FR_ETR",
  {pick('h3', '1', '2', 'M', None, 'nan')} AS "SEXE",
  {pick('h4', 'L', 'M', 'D', 'X', '', 'nan', None)} AS "CURSUS_LMD",
  {pick('h1', 'L', 'M', 'D', 'X', None)} AS "CURSUS_LMD_INT",
  {pick('h2', 'L', 'M', 'D')} AS "CURSUS_LMDR",
  {pick('h3', '0', '1', None)} AS "FLAG_MEEF",
  {pick('h1', '0352771X', '0912423P', '0597131F', '9730224F', '0755555A', None)} AS "ETABLI",
  {pick('h2 + h1', '0684045X', '0753364Z', '0011312W', 'AB', '', None, '0755555A')} AS "COMPOS",
  {pick('h4', '75056', '', '06840', None, 'None')} AS "COMINS",
  {pick('h3', 'E1', '', None)} AS "ID_PAYSAGE_ED"
  FROM ({_MIX}) AS m""",
    # Orders with missing tokens in their text columns.
    "ord": f"""SELECT k, cust, y, cents, h1, h2, h3,
  CASE h1 % 8 WHEN 0 THEN NULL WHEN 1 THEN 'None' WHEN 2 THEN '' WHEN 3 THEN 'nan' ELSE status END AS status,
  CASE h2 % 9 WHEN 0 THEN NULL WHEN 1 THEN '' ELSE prio END AS prio,
  CASE h3 % 7 WHEN 0 THEN NULL WHEN 1 THEN '<NA>' ELSE CAST(y AS STRING) END AS year_text,
  CASE WHEN h1 % 5 = 0 THEN '1' WHEN h1 % 5 = 1 THEN NULL WHEN h1 % 5 = 2 THEN '' ELSE '0' END AS flag
  FROM ({_MIX}) AS m""",
    # Parts with padded, cut and NBSP texts.
    "prt": """SELECT p_partkey AS k, p_size AS size, p_brand AS brand, p_type AS kind,
  CASE p_partkey % 6 WHEN 0 THEN NULL WHEN 1 THEN 'nan' WHEN 2 THEN concat(' ', p_name, '.0 ')
    WHEN 3 THEN concat(p_name, chr(160), 'x') WHEN 4 THEN 'None' ELSE p_name END AS name,
  CASE p_partkey % 5 WHEN 0 THEN NULL WHEN 1 THEN concat(CAST(p_size AS STRING), '.0') WHEN 2 THEN 'A.0B'
    ELSE CAST(p_size % 12 AS STRING) END AS code
  FROM {part}""",
    # Customers with text numbers and shifting keys.
    "cus": """SELECT c_custkey AS k, c_name AS name, c_mktsegment AS segment,
  CAST(c_nationkey AS BIGINT) AS nation, CAST(round(c_acctbal * 100) AS BIGINT) AS cents,
  CASE c_custkey % 9 WHEN 0 THEN NULL WHEN 1 THEN 'abc' ELSE CAST(1990 + c_custkey % 30 AS STRING) END AS born,
  CASE c_custkey % 4 WHEN 0 THEN NULL WHEN 1 THEN '1.0' WHEN 2 THEN '0' ELSE ' 1 ' END AS flag
  FROM {customer}""",
    # Line items with integer measures and dirty flags.
    "lin": """SELECT l_orderkey AS k, CAST(l_linenumber AS BIGINT) AS line, l_partkey AS part, l_suppkey AS supp,
  CAST(l_quantity AS BIGINT) AS qty, CAST(round(l_extendedprice * 100) AS BIGINT) AS cents,
  CAST(year(l_shipdate) AS BIGINT) AS ship_year,
  CASE WHEN (l_orderkey + l_linenumber) % 9 = 0 THEN NULL ELSE l_returnflag END AS rflag,
  CASE WHEN (l_orderkey * 3 + l_partkey) % 11 = 0 THEN '' ELSE l_linestatus END AS lstatus,
  CASE WHEN l_partkey % 3 = 0 THEN 1 ELSE 0 END AS even_part,
  CASE WHEN l_suppkey % 4 = 0 THEN NULL WHEN l_suppkey % 4 = 1 THEN 1 ELSE 0 END AS flag_s
  FROM {lineitem}""",
}


def path(sf_dir: str, table: str) -> str:
    return f"{sf_dir.rstrip('/')}/{table}.parquet"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(path(sf_dir, name))


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    text = VIEWS[name].replace('"', "`")
    for t in TABLES:
        text = text.replace("{" + t + "}", f"parquet.`{path(sf_dir, t)}`")
    return spark.sql(text)


def oracle(sql: str, views: Sequence[str]) -> str:
    """The SQL twin with the views it reads as leading common table expressions."""
    parts = []
    for v in views:
        text = VIEWS[v]
        for t in TABLES:
            text = text.replace("{" + t + "}", t)
        parts.append(f"{v} AS ({text})")
    if not parts:
        return sql
    body = sql.strip()
    if body.upper().startswith("WITH "):
        return "WITH " + ", ".join(parts) + ", " + body[5:]
    return "WITH " + ", ".join(parts) + " " + body


def query(name: str, sql: str | None = None, views: Sequence[str] = ()):
    """Register a query under ``<operator id>_<name>``."""

    def add(fn):
        if name in REGISTRY:
            raise ValueError(f"query {name} registered twice")
        REGISTRY[name] = Query(fn, None if sql is None else oracle(sql, views))
        return fn

    return add
