"""Documents in parts, year files, the landing ledger, kept sums, quarantine and co-located tables."""

import json
import os
import random

import pytest
from pyspark.sql import functions as F

from conftest import values
from palmares.operators import lookups as L, quality, rules
from palmares.plans import cubes, ledger, publish
from palmares.queries import published as P
from palmares.session import work_dir
from palmares.sources.catalogue import landing_name
from palmares.sources.documents import read_document, records
from palmares.sources.facts import read_fact, write_fact
from palmares.sources.opendata import FORMAT, write_year_files
from palmares.sources.sheets import read_sheets

SF = "/root/testdata/sf0.001"
NASTY = ["", "a", "x}y", '"', "\\", 'é"}{', "[{,", "\n", "]}", "1.0", "\\\"}", "n" * 50]


@pytest.fixture
def small_blocks(spark):
    old = spark.conf.get("spark.sql.files.maxPartitionBytes"), spark.conf.get("spark.sql.files.openCostInBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2000")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    yield
    spark.conf.set("spark.sql.files.maxPartitionBytes", old[0])
    spark.conf.set("spark.sql.files.openCostInBytes", old[1])


@pytest.mark.parametrize("indent", [None, 2])
def test_one_document_is_read_by_many_tasks(spark, tmp_path, small_blocks, indent):
    """Texts full of braces, quotes and backslashes, cut anywhere, against the JSON reader of Python."""
    rng = random.Random(indent)
    doc = {f"S{k}": [{"A": rng.choice(NASTY) + str(i), "B": rng.choice([None, 1, 2.5, True, rng.choice(NASTY)])} for i in range(n)] for k, n in enumerate((0, 120, 1, 300, 0, 40))}
    path = tmp_path / "doc.json"
    path.write_text(json.dumps(doc, indent=indent, ensure_ascii=bool(indent)))
    assert spark.read.option("lineSep", "}").text(str(path)).rdd.getNumPartitions() >= 8
    got = {}
    for r in records(spark, str(path)).orderBy("number").collect():
        got.setdefault(r.sheet, []).append(json.loads(r.record))
    assert got == {k: v for k, v in doc.items() if v}
    parts, whole = read_document(spark, str(path)), read_sheets(spark, str(path))
    for name in got:
        assert values(parts[name], "A", "B") == values(whole[name], "A", "B")
        one, two = (rules.all_records({name: s}, [name], limit=1000)[name] for s in (parts[name], whole[name]))
        assert one == two


def test_documents_that_have_no_flat_records(spark, tmp_path):
    for text in ("{}", '{"A": []}\n', "", '{"A": [], "B": []}'):
        (tmp_path / "doc.json").write_text(text)
        assert read_document(spark, str(tmp_path / "doc.json")) == {}
    for text in ('{"A": [{"x": {"y": 1}}]}', '{"A": [{"x": 1}, {"x": [{"y": 1}]}]}', '{"A": [{"x": [{"y": 1}]}]}'):
        (tmp_path / "doc.json").write_text(text)
        with pytest.raises(ValueError, match="flat"):
            read_document(spark, str(tmp_path / "doc.json"))


def test_one_file_a_year(spark, tmp_path):
    df = spark.range(900).select(F.col("id").cast("string").alias("a;b"), (2015 + F.col("id") % 4).cast("string").alias("y"), F.when(F.col("id") % 5 == 0, 'q";').alias("c")).repartition(7)
    for _ in range(2):  # a second run replaces the files
        files = write_year_files(df, str(tmp_path), "y")
    assert sorted(os.listdir(tmp_path)) == sorted([f"{y}.csv" for y in range(2015, 2019)] + [f".{y}.csv.crc" for y in range(2015, 2019) if os.path.exists(tmp_path / f".{y}.csv.crc")])
    for f in files:
        lines = open(f, encoding="utf-8").read().splitlines()
        assert lines[0] == '"a;b";y;c' and len(lines) == 226
    assert values(spark.read.options(header=True, **FORMAT).csv(files)) == values(df)


def deg(spark, source, year):
    return P.view(spark, SF, "deg").filter((F.col("SOURCE") == source) & (F.col("RENTREE") == year)).select(F.col("k").cast("string").alias("idetu"), "RESDIP", "DIPLOM")


def test_ledger_tells_new_same_and_changed(spark, tmp_path):
    landing, root = str(tmp_path / "in"), str(tmp_path / "raw")
    files = [("result", 2015), ("ens", 2015)]

    def put(source, df):
        df.write.mode("overwrite").parquet(f"{landing}/{landing_name(source, 2015)}")

    def states():
        return {r.SOURCE: r.state for r in ledger.land_changed(spark, landing, root, files).collect()}

    put("result", deg(spark, "result", "2015"))
    put("ens", deg(spark, "ens", "2015"))
    assert states() == {"result": "new", "ens": "new"} and states() == {"result": "same", "ens": "same"}
    before = values(ledger.read_landed(spark, root), "IDETU", "SOURCE", "RESDIP")
    put("result", deg(spark, "result", "2015").repartition(3).orderBy(F.rand(3)))  # other files and order, the same rows
    assert states() == {"result": "same", "ens": "same"}
    one = deg(spark, "ens", "2015")
    put("ens", one.withColumn("RESDIP", F.when(F.col("idetu") == one.first().idetu, "Z").otherwise(F.col("RESDIP"))))
    os.makedirs(f"{root}/_ledger/_draft-x")  # a landing that broke off
    assert states() == {"result": "same", "ens": "changed"}
    after = ledger.read_landed(spark, root)
    assert after.count() == len(before) and after.filter("RESDIP = 'Z'").count() == 1 and ledger.read_ledger(spark, root).count() == 2
    put("ens", one.withColumnRenamed("DIPLOM", "DIPLOMR"))
    assert states() == {"result": "same", "ens": "changed"}
    assert ledger.read_landed(spark, root, sources=["ens"], years=[2015]).filter("DIPLOM IS NOT NULL").isEmpty()
    with pytest.raises(ValueError, match="nothing"):
        ledger.read_landed(spark, root, years=[1999])


def test_a_landing_that_fails_leaves_the_old_state(spark, tmp_path, monkeypatch):
    landing, root = str(tmp_path / "in"), str(tmp_path / "raw")
    path = f"{landing}/{landing_name('result', 2015)}"
    deg(spark, "result", "2015").write.parquet(path)
    ledger.land_changed(spark, landing, root, [("result", 2015)])
    want = values(ledger.read_landed(spark, root), "IDETU", "RESDIP")
    deg(spark, "ens", "2015").write.mode("overwrite").parquet(path)

    def broken(*_):
        raise OSError("lost")

    monkeypatch.setattr(ledger, "commit", broken)
    with pytest.raises(OSError):
        ledger.land_changed(spark, landing, root, [("result", 2015)])
    assert values(ledger.read_landed(spark, root), "IDETU", "RESDIP") == want


def test_kept_sums_read_changed_partitions_alone(spark):
    sheets = P.reference_tables(spark, SF)
    facts_at, sums_at = work_dir(spark, "facts"), work_dir(spark, "sums")
    right = P.corrected(spark, SF)
    write_fact(right.withColumn("EFFECTIF_R", F.when(F.col("RENTREE") == "2016", F.lit(9)).otherwise(F.col("EFFECTIF_R"))), facts_at)
    cubes.refresh(read_fact(spark, facts_at), sheets, sums_at)
    write_fact(right.filter("RENTREE = '2016' AND SOURCE = 'result'"), facts_at)
    stamps = lambda: {os.path.join(d, f): os.path.getmtime(os.path.join(d, f)) for d, _, fs in os.walk(sums_at.removeprefix("file:")) for f in fs if f.endswith(".parquet")}
    before = stamps()
    cubes.refresh(read_fact(spark, facts_at), sheets, sums_at, [("result", "2016")])
    moved = {f for f in before.keys() ^ stamps().keys()}
    assert moved and all("SOURCE=result/RENTREE=2016" in f for f in moved)
    plan = cubes.partial_sums(read_fact(spark, facts_at).filter("SOURCE = 'result' AND RENTREE = '2016'"), sheets)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "RENTREE" in plan.split("PartitionFilters: [")[1][:200]
    want = publish.publish(read_fact(spark, facts_at), sheets, names=False)
    assert values(cubes.publish_sums(cubes.read_sums(spark, sums_at), sheets, names=False), *want.columns) == values(want)


def test_failed_casts_are_listed(frame, tmp_path):
    df = frame([(1, "7", "x"), (2, "seven", ""), (3, None, "8"), (4, "nan", "1e3")], "k int, a string, b string")
    out, counts = quality.quarantined(df, {"a": "bigint", "b": "bigint", "c": "int"}, ["k"], str(tmp_path / "q"))
    assert values(out) == sorted([(1, 7, None), (2, None, None), (3, None, 8), (4, None, None)], key=repr)
    assert counts == {"a": 1, "b": 2} and values(quality.failed_casts(df, {"a": "bigint", "b": "bigint"}, ["k"])) == [
        (1, "b", "x", "bigint"), (2, "a", "seven", "bigint"), (4, "b", "1e3", "bigint")]


def test_co_located_lookups_move_no_fact(spark):
    """Three large lookups on one key: no exchange anywhere in the plan, and the rows of the plain lookup."""
    lines = spark.read.parquet(f"{SF}/lineitem.parquet").select("l_orderkey", "l_linenumber", "l_partkey")
    part = spark.read.parquet(f"{SF}/part.parquet")
    fact = L.co_located(lines, "l_partkey", "lines", 4)
    plain = lines
    for n, col in enumerate(("p_brand", "p_type", "p_size")):
        dim = part.select("p_partkey", col)
        fact = L.co_located_lookup(fact, L.co_located(dim, "p_partkey", f"side{n}", 4), {"l_partkey": "p_partkey"}, [col])
        plain = L.left_lookup(plain, dim, {"l_partkey": "p_partkey"}, [col])
    plan = fact._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Exchange" not in plan
    assert values(fact) == values(plain)
