import pytest
from pyspark.sql import functions as F

from palmares.functions import nulls as N, scalars as S

TEXTS = [None, "", " ", "nan", "None", "<NA>", "12.0", "1.05", "A.0B", "a b", "7", "Fernando", " x ", "nan.0"]


def run(frame, expr, cells):
    df = frame([(i, c) for i, c in enumerate(cells)], "i int, c string").select("i", expr.alias("v"))
    return [r.v for r in df.orderBy("i").collect()]


def test_norm_text(frame):
    want = [None, "", "", None, None, None, "12", "1", "A", "a b", "7", "Fernando", "x", None]
    assert run(frame, N.norm_text("c"), TEXTS) == want


def test_norm_text_to_empty_keeps_null(frame):
    got = run(frame, N.norm_text("c", tokens=("nan",), missing=""), TEXTS)
    assert got[:5] == [None, "", "", "", "None"] and got[11] == "Fernando"


def test_is_missing_is_never_null(frame):
    assert run(frame, N.is_missing("c"), TEXTS)[:7] == [True, True, False, True, True, True, False]


def test_null_tolerant_comparisons(frame):
    df = frame([("1", None), ("0", "0"), ("", "1"), (None, None)], "a string, b string")
    assert [r.v for r in df.select(N.pd_ne("a", "1").alias("v")).collect()] == [False, True, True, True]
    assert [r.v for r in df.select(N.pd_ne("a", F.col("b")).alias("v")).collect()] == [True, False, True, True]
    assert [r.v for r in df.select(N.eq_true("a", F.col("b")).alias("v")).collect()] == [False, True, False, False]


def test_pd_ne_reaches_the_parquet_reader(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/orders.parquet").filter(N.pd_ne("o_orderstatus", "F"))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Or(IsNull(o_orderstatus),Not(EqualTo(o_orderstatus,F)))" in plan


@pytest.mark.parametrize("expr, cells, want", [
    (lambda: S.zero_pad("c"), ["7", "07", "x", "²", None, ""], ["07", "07", "x", "²", None, ""]),
    (lambda: S.strip_zero("c"), ["0123", "00", "HORS", "12", None], ["123", "0", "", "12", None]),
    (lambda: S.suffix_code("c", ("A6", "A2-8")), ["A6", "A2-8", "A7", None], ["A6-85", "A2-85", "A7", None]),
    (lambda: S.recode("c", {"a": "x", "b": "x", "c": "y"}), ["a", "b", "c", "d", None], ["x", "x", "y", "d", None]),
    (lambda: S.default_missing("c", "$"), [None, "", "nan", "0"], ["$", "$", "$", "0"]),
    (lambda: S.academic_year("c"), ["2019", "1999", None], ["2019-20", "1999-00", None]),
    (lambda: S.session("c"), ["2019", None], ["2020", None]),
    (lambda: S.yes_no("c"), ["O", "N", None, ""], ["Oui", "Non", "Non", "Non"]),
    (lambda: S.len_at_least("c", 3), ["abc", "ab", None], [True, False, False]),
    (lambda: S.prefix("c", 3, 2), ["D075", "D", None], ["075", "", None]),
    (lambda: S.json_map("c"), ['{"a": 1, "b": "x"}', None], [{"a": "1", "b": "x"}, None]),
    (lambda: S.json_rows("c"), ['[{"a": 1}]', None], [[{"a": "1"}], None]),
])
def test_scalars(frame, expr, cells, want):
    assert run(frame, expr(), cells) == want


def test_breadcrumb(frame):
    df = frame([("R", "A", "D"), ("R", "R", "D"), ("R", "R", "R"), ("R", None, "D"), (None, "A", "D"), ("R", "A", None)],
               "a string, b string, c string")
    assert [r.v for r in df.select(S.breadcrumb("a", "b", "c").alias("v")).collect()] == ["R>A>D", "R>D", "R", None, None, None]


def test_year_range(frame):
    df = frame([("2016", "2018"), ("", ""), (None, None), ("2019", "2018")], "a string, b string")
    got = [r.v for r in df.select(S.year_range("a", "b", 2015, 2021).alias("v")).collect()]
    every = [str(y) for y in range(2015, 2022)]
    assert got == [["2016", "2017", "2018"], every, every, []]
