import pytest
from pyspark.sql import functions as F

from conftest import values
from palmares.operators import aggregate as A, filters as flt, lookups as L, quality as Q, schema as P
from palmares.operators.rules import expand_years
from palmares.sources.contracts import contract, file_has, raw_contract, with_file_columns


# Schema ---------------------------------------------------------------------


def test_upper_names_rejects_collisions(frame):
    with pytest.raises(ValueError, match="differ only by case"):
        P.relabel(frame([(1, 2)], "a int, b int"), {"a": "X", "b": "x"})


def test_relabel_is_simultaneous(frame):
    df = P.relabel(frame([(1, 2)], "CURSUS_LMD_LIB_INT int, CURSUS_LMD_INT int"),
                   {"CURSUS_LMD_LIB_INT": "cursus_lmd_int", "CURSUS_LMD_INT": "Cycle"})
    assert df.columns == ["cursus_lmd_int", "Cycle"] and values(df) == [(1, 2)]


def test_conform_adds_casts_and_keeps(frame):
    df = P.conform(frame([("12", "x", 1)], "ANBAC string, BAC string, Z int"), contract(["ANBAC", "NBACH", "BAC"], ["ANBAC", "NBACH"]))
    assert df.dtypes == [("ANBAC", "bigint"), ("NBACH", "bigint"), ("BAC", "string"), ("Z", "int")]
    assert values(df) == [(12, None, "x", 1)]


def test_conform_strict_fails_on_bad_number(frame):
    df = P.conform(frame([("x",)], "ANBAC string"), contract(["ANBAC"], ["ANBAC"]), strict=True)
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        df.collect()


def test_finalise_types(frame):
    df = P.finalise_types(frame([("<NA>", None, "3", None), ("75056.0", "4", None, "x")], "a string, n string, f string, t string"),
                          text=["a"], zero_ints=["n"], ints=["f"])
    assert values(df) == [("", 0, 3, ""), ("75056", 4, None, "x")]


def test_swap_columns_is_one_projection(frame):
    df = P.swap_columns(frame([("r", "e", 1)], "DIPLOMR string, DIPLOM string, k int"), {"DIPLOMR": "DIPLOM"}, ["DIPLOM"])
    assert df.columns == ["DIPLOM", "k"] and values(df) == [("r", 1)]


def test_presence_of_columns_by_file(frame):
    one = with_file_columns(frame([("x",)], "RESDIP string")).withColumn("SOURCE", F.lit("a"))
    two = with_file_columns(frame([("y",)], "CONV string")).withColumn("SOURCE", F.lit("b"))
    df = one.unionByName(two, allowMissingColumns=True).unionByName(frame([(None,)], "SOURCE string"), allowMissingColumns=True)
    assert [r.v for r in df.select(file_has("RESDIP").alias("v")).collect()] == [True, False, False]
    assert with_file_columns(df).columns == df.columns
    assert {f.dataType.simpleString() for f in raw_contract()} == {"string", "bigint"}


# Filters --------------------------------------------------------------------


def test_exclude_keeps_null(frame):
    assert values(flt.exclude(frame([("1",), ("0",), ("",), (None,)], "f string"), "f", "1")) == [("",), ("0",), (None,)]


def test_remove_where_keeps_unknown(frame):
    df = frame([("a", "1"), (None, "1"), ("a", None)], "x string, y string")
    assert len(values(flt.remove_where(df, (F.col("x") == "a") & (F.col("y") == "1")))) == 2


def test_delete_by_first_filled_form(frame):
    df = frame([("2016", "D1", "E1"), ("2016", "D1", "E2"), ("2016", "D2", "E3"), (None, "D1", "E1")], "y string, d string, e string")
    rules = frame([("2016", "D1", "E1"), ("2016", "D2", "")], "y string, d string, e string")
    left = flt.delete_by_rules(df, rules, [("e", ("y", "d", "e")), (None, ("y", "d"))])
    assert values(left, "y", "d", "e") == [("2016", "D1", "E2"), (None, "D1", "E1")]


def test_gate_is_per_group(frame):
    df = frame([("a", "000"), ("a", "000"), ("b", "000"), ("b", None)], "g string, dep string")
    out = flt.if_any(df, F.col("dep").isNull() | (F.col("dep") != "000"), lambda d, g: d.withColumn("on", g), ["g"])
    assert values(out, "g", "on") == [("a", False), ("a", False), ("b", True), ("b", True)]


def test_unknown_member(frame):
    df = frame([("100",), ("x",), (None,)], "n string")
    assert values(flt.unknown_to(df, "n", frame([("100",), ("100",)], "p string"), "p", "999")) == [("100",), ("999",), ("999",)]


# Lookups --------------------------------------------------------------------


FACTS = [(1, "a"), (2, "b"), (3, None), (4, "z"), (5, "")]


def test_lookup_keeps_rows_and_unmatched(frame):
    out = L.left_lookup(frame(FACTS, "i int, k string"), frame([("a", "A"), ("b", "B"), ("a", "A")], "k string, v string"), "k", ["v"])
    assert values(out, "i", "v") == [(1, "A"), (2, "B"), (3, None), (4, None), (5, None)]


def test_lookup_fails_on_two_values_and_names_the_key(frame):
    out = L.left_lookup(frame(FACTS, "i int, k string"), frame([("a", "A"), ("a", "B")], "k string, v string"), "k", ["v"])
    with pytest.raises(Exception, match="several values"):
        out.collect()


def test_lookup_fanout_on_request(frame):
    out = L.left_lookup(frame(FACTS, "i int, k string"), frame([("a", "A"), ("a", "B")], "k string, v string"), "k", ["v"], unique="fanout")
    assert out.count() == 6


def test_null_safe_lookup(frame):
    dim = frame([(None, "N"), ("a", "A")], "k string, v string")
    out = L.left_lookup(frame(FACTS, "i int, k string"), dim, "k", ["v"], null_safe=True)
    assert (3, "N") in values(out, "i", "v")


def test_shuffled_form_equals_broadcast_form(spark, frame):
    """A key with a third of all rows, in both forms; a lookup costs the facts one shuffle and reads them once."""
    fact = spark.range(0, 3000, 1, 6).selectExpr("id", "CASE WHEN id % 3 = 0 THEN 'hot' WHEN id % 7 = 0 THEN NULL ELSE concat('k', id % 50) END AS k")
    dim = frame([("hot", "H")] + [(f"k{i}", f"v{i}") for i in range(0, 50, 2)], "k string, v string")
    small = L.left_lookup(fact, dim, "k", ["v"])
    large = L.left_lookup(fact, dim, "k", ["v"], limit=0)
    assert values(small, "id", "k", "v") == values(large, "id", "k", "v") and large.count() == 3000
    chained = L.left_lookup(large.withColumnRenamed("v", "w"), dim, {"w": "k"}, ["v"], limit=0)
    plan = chained._jdf.queryExecution().executedPlan().toString()
    assert plan.count("SortMergeJoin") == 2 and plan.count("Range (") == 1


def test_size_check_decides_the_broadcast(spark, frame):
    big = spark.read.parquet("/root/testdata/sf0.001/orders.parquet").select("o_orderkey")
    assert L.checked_bytes(frame([(1,)], "a int")) < 1000 < L.checked_bytes(big)
    hinted = L.bounded(big, limit=10)._jdf.queryExecution().logical().toString()
    assert "UnresolvedHint" not in hinted and "ResolvedHint" not in hinted


def test_size_check_counts_what_an_estimate_cannot_know(spark, frame):
    """A small sheet that expands past the limit is not broadcast; a short list made from a large table is."""
    fact = frame([("E1", "2015")], "e string, y string")
    sheet = frame([(f"E{i}", "LONG", "", "") for i in range(50)], "IN string, OUT string, RENTREE_START string, RENTREE_END string")
    wide = expand_years(sheet, 1000, 1999)
    assert L.estimated_bytes(wide) < 100_000 < L.checked_bytes(wide)
    def plan(dim, on):
        return L.left_lookup(fact, dim, on, {"OUT": "o"}, limit=100_000)._jdf.queryExecution().optimizedPlan().toString()
    assert "strategy=broadcast" not in plan(wide, {"e": "IN", "y": "RENTREE"})
    lines = spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet")
    few = lines.groupBy(F.col("l_returnflag").alias("IN")).agg(F.max("l_linestatus").alias("OUT"))
    assert L.checked_bytes(few) < 1000 and "strategy=broadcast" in plan(few, {"e": "IN"})


def test_tiered_lookup_order(frame):
    dim = frame([("a", "inscri", "2"), ("a", "result", "1"), ("b", "inscri", "3"), ("c", "other", "4")], "k string, t string, v string")
    out = L.tiered_lookup(frame([("a",), ("b",), ("c",)], "k string"), dim, ["k"], "v", "t", ["result", "inscri"])
    assert values(out) == [("a", "1"), ("b", "3"), ("c", None)]


def test_conflicts_and_check(frame):
    dim = frame([("a", "1"), ("a", "2"), ("b", "1"), ("b", "1")], "k string, v string")
    assert values(L.conflicts(dim, ["k"], "v")) == [("a", 2)]
    with pytest.raises(ValueError, match="a"):
        L.check_unique(dim, ["k"], "v")
    L.check_unique(dim.filter("k = 'b'"), ["k"], "v")


# Aggregates and quality -------------------------------------------------------


def test_flag_is_key_and_sum(frame):
    df = frame([("x", 1, 5), ("x", 1, 5), (None, 0, None), (None, None, None)], "k string, f int, m int")
    assert values(A.sum_cube(df, ["k"], ["m"], ["f"]), "k", "m", "f") == [("x", 10, 2), (None, 0, 0), (None, 0, 0)]


def test_union_fills_missing_columns(frame):
    out = Q.union_named(frame([("a", 1)], "s string, n int"), frame([("b",)], "s string"))
    assert values(out, "s", "n") == [("a", 1), ("b", None)]


def test_distinct_combos_and_diff(frame):
    df = frame([("1", "p", "x"), ("1", "p", "y")], "R string, ID_PAYSAGE string, other string")
    assert values(Q.distinct_combos(df, "PAYSAGE", ["R", "absent"])) == [("p", "1")]
    assert Q.column_diff(df, ["R", "Z"]) == (["Z"], ["ID_PAYSAGE", "other"])


@pytest.mark.parametrize("limit", [None, 0], ids=["broadcast", "shuffle"])
def test_two_values_under_a_key_fail_whatever_is_read(frame, limit):
    """The check survives the pruning of the looked-up columns."""
    fact = frame([("a", 1), ("b", 2), ("b", 2)], "k string, v int")
    found = L.left_lookup(fact, frame([("a", "x"), ("a", "y"), ("b", "z")], "k string, w string"), "k", ["w"], limit=limit)
    for read in (lambda: found.select("v").collect(), found.count, lambda: found.groupBy("v").count().collect(), lambda: found.filter("w = 'z'").collect()):
        with pytest.raises(Exception, match="several values"):
            read()
    sound = L.left_lookup(fact, frame([("a", "x"), ("a", "x"), ("b", "z")], "k string, w string"), "k", ["w"], limit=limit)
    assert sound.count() == 3 and values(sound, "k", "w") == [("a", "x"), ("b", "z"), ("b", "z")]


def test_stored_table_knows_its_bytes_and_keys(frame):
    dim = frame([("a", "x" * 1000, 1), ("b", "", 2)], "k string, w string, n int")
    kept = L.stored(dim, "dim")
    assert values(kept) == values(dim)
    assert L.checked_bytes(kept.filter("n = 1").select("k")) == L.checked_bytes(kept) == 1002 + 4 * 24 + 2 * 16
    with pytest.raises(Exception, match="several values"):
        L.stored(frame([("a", "x"), ("a", "y")], "k string, w string"), "dim", ["k"])
