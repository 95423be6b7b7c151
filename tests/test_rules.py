"""The rule compiler against plain sequential application."""

import random

import pytest
from pyspark.sql import functions as F

from conftest import values
from palmares.functions.nulls import MISSING_TOKENS
from palmares.operators import rule_tables as RT, rules as R

COLS = ("a", "b", "c")
CELLS = [None, "", "None", "x", "y", "z"]


def sequential(row, rules):
    row = dict(row)
    for r in rules:
        met = all(
            (row[c] is None or row[c] in MISSING_TOKENS) if v is R.MISSING else row[c] == v for c, v in r.conds)
        if met:
            row.update(r.writes)
    return row


def random_rules(rng, n, read_cols=COLS, write_cols=COLS):
    rules = []
    for _ in range(n):
        conds = {c: rng.choice(["", "x", "y", "z", R.MISSING]) for c in rng.sample(read_cols, rng.randint(0, len(read_cols)))}
        outs = {c: rng.choice(["", "x", "y", "z", "it's \\"]) for c in rng.sample(write_cols, rng.randint(1, len(write_cols)))}
        rules.append(R.rule(conds, outs))
    return rules


def every_row():
    return [(i, a, b, c) for i, (a, b, c) in enumerate((a, b, c) for a in CELLS for b in CELLS for c in CELLS)]


def expected(rules):
    out = []
    for i, a, b, c in every_row():
        row = sequential({"a": a, "b": b, "c": c}, rules)
        out.append((i, row["a"], row["b"], row["c"]))
    return sorted(out, key=repr)


@pytest.mark.parametrize("seed", range(8))
@pytest.mark.parametrize("inline", [200, 0], ids=["case", "join"])
def test_compiled_rules_equal_sequential(frame, seed, inline):
    rules = random_rules(random.Random(seed), 7)
    df = frame(every_row(), "i int, a string, b string, c string")
    got = R.apply_rules(df, R.compile_rules(rules), inline=inline)
    assert values(got, "i", "a", "b", "c") == expected(rules)


def test_compiler_model_on_many_rule_sets():
    """Layers applied to snapshots, in Python: thousands of rule sets without a Spark job each."""
    rng = random.Random(7)
    rows = [dict(zip(COLS, r[1:])) for r in every_row()]
    for _ in range(1500):
        rules = random_rules(rng, rng.randint(1, 8))
        layers = R.compile_rules(rules)
        assert sum(map(len, layers)) <= len(rules)  # rules that can never fire are left out
        for row in rng.sample(rows, 12):
            got = dict(row)
            for layer in layers:
                snap = dict(got)
                for r in layer:
                    if all((snap[c] is None or snap[c] in MISSING_TOKENS) if v is R.MISSING else snap[c] == v for c, v in r.conds):
                        got.update(r.writes)
            assert got == sequential(row, rules)


@pytest.mark.parametrize("seed", range(6))
def test_fold_equals_sequential(frame, seed):
    rng = random.Random(100 + seed)
    rules = []
    for _ in range(9):
        conds = {c: rng.choice(["x", "y", ""]) for c in rng.sample(("a", "b"), rng.randint(0, 2))}
        current = rng.choice(["any", "x", "y", "", R.MISSING])
        if current != "any":
            conds["c"] = current
        rules.append(R.rule(conds, {"c": rng.choice(["x", "y", "z", ""])}))
    df = frame(every_row(), "i int, a string, b string, c string")
    assert values(R.fold_rules(df, rules, "c"), "i", "a", "b", "c") == expected(rules)


def test_disjoint_rules_share_a_layer():
    rules = [R.rule({"d": str(i), "t": "1"}, {"t": "2"}) for i in range(300)]
    assert len(R.compile_rules(rules)) == 1
    chained = [R.rule({"t": str(i)}, {"t": str(i + 1)}) for i in range(5)]
    assert len(R.compile_rules(chained)) == 5


def test_recodes_of_one_column_share_a_layer():
    """A sheet that recodes a column by its own values: the second rule for a value never fires, and no layer is made for it."""
    rules = [R.rule({"t": f"old{i % 30}"}, {"t": f"new{i}"}) for i in range(90)]
    assert [len(layer) for layer in R.compile_rules(rules)] == [30]
    back = [R.rule({"t": "a"}, {"t": "b"}), R.rule({"t": "b"}, {"t": "a"}), R.rule({"t": "a"}, {"t": "c"})]
    assert [len(layer) for layer in R.compile_rules(back)] == [1, 1, 1]


def test_a_long_chain_of_layers_is_planned_in_parts(frame):
    """Forty rules of which each reads what the one before wrote: without cuts the optimiser never ends."""
    rules = [R.rule({"t": str(i), "u": "x"}, {"t": str(i + 1)}) for i in range(40)] + [R.rule({"t": "40"}, {"u": "end"})]
    assert len(R.compile_rules(rules)) == 41
    got = R.apply_rules(frame([("0", "x"), ("7", "x"), ("3", "y")], "t string, u string"), R.compile_rules(rules))
    assert values(got, "t", "u") == [("3", "y"), ("40", "end"), ("40", "end")]


def test_absent_columns(frame):
    df = frame([("x",)], "a string")
    rules = [R.rule({"zz": "x"}, {"a": "no"}), R.rule({"a": "x"}, {"new": "yes"})]
    assert values(R.apply_rules(df, R.compile_rules(rules)), "a", "new") == [("x", "yes")]


def test_gate_limits_rules(frame):
    df = frame([("x", True), ("x", False)], "a string, g boolean")
    out = R.apply_rules(df, R.compile_rules([R.rule({"a": "x"}, {"a": "y"})]), F.col("g"))
    assert values(out, "a") == [("x",), ("y",)]


def test_formation_rules_strict_suffix_and_empty():
    rules = R.formation_rules([{"A_IN": "[empty]", "B_INT_OUT": "v", "C_IN": "", "D_OUT": ""}, {"A_IN": "1"}])
    assert rules == [R.rule({"A": ""}, {"B_INT": "v"})]


def test_sheet_bound(frame):
    with pytest.raises(ValueError, match="apply it as a table"):
        R.sheet_records(frame([("a",), ("b",)], "x string"), limit=1)


def test_replace_by_key_needs_length(frame):
    df = frame([("2016", "E1"), ("2016", "E2"), ("2016", "E3")], "RENTREE string, e string")
    sheet = frame([("E1", "LONG", "2015", "2017"), ("E2", "abc", "", "")], "IN string, OUT string, RENTREE_START string, RENTREE_END string")
    out = R.replace_by_key(df, R.expand_years(sheet, *R.year_bounds(df)), {"RENTREE": "RENTREE", "e": "IN"}, "e")
    assert values(out, "e") == [("E2",), ("E3",), ("LONG",)]
    assert values(R.replace_in_spans(df, R.span_map(sheet, "IN"), "e", "e"), "e") == [("E2",), ("E3",), ("LONG",)]


@pytest.mark.parametrize("seed", range(4))
def test_spans_equal_expansion(frame, seed):
    """Spans searched in the row against a row a year and source, on random sheets whose codes have one value at a time."""
    rng = random.Random(seed)
    sources, sheet = ["a", "b"], []
    for code in "pqrs":
        for source in rng.choice([[""], ["a", "b"], ["a"]]):
            year = 2010
            while year < 2020:
                start, end = year + rng.randint(0, 2), year + rng.randint(0, 5)
                sheet.append((code, f"{code}{source}{start}xx", str(start), str(end), source))
                year = max(start, end) + 1
    sheet += [("open", "anytime", "", "1900", ""), ("open", "anytime", "None", "", "a"), ("", "blank", "", "", "")]
    rules = frame(sheet, "IN string, OUT string, RENTREE_START string, RENTREE_END string, SOURCE string")
    rows = [(y, s, c) for y in range(2008, 2024) for s in ("a", "b") for c in ("p", "q", "r", "s", "open", "", "none", None)]
    df = frame([(str(y), s, c) for y, s, c in rows], "RENTREE string, SOURCE string, e string")
    want = {}
    for code, out, start, end, source in sheet:
        years = range(2008, 2024) if start in ("", "None") else range(int(start), int(end) + 1)
        want.update({(y, s, code): out for y in years for s in sources if source in ("", s) and code})
    got = R.replace_in_spans(df.withColumn("t", F.lit("old")), R.span_map(rules, "IN", source="SOURCE"), "e", "t", source="SOURCE")
    expected = sorted((str(y), s, c, want.get((y, s, c), "old")) for y, s, c in rows if c is not None)
    assert values(got.filter("e IS NOT NULL"), "RENTREE", "SOURCE", "e", "t") == sorted(expected, key=repr)
    assert {r.t for r in got.filter("e IS NULL").collect()} == {"old"}


def test_open_spans_stay_one_broadcast(frame):
    df = frame([("2016", "E1")], "RENTREE string, e string")
    sheet = frame([(f"E{i}", "LONG", "", "") for i in range(50)], "IN string, OUT string, RENTREE_START string, RENTREE_END string")
    spans = R.span_map(sheet, "IN")
    assert spans.count() == 50
    plan = R.replace_in_spans(df, spans, "e", "e")._jdf.queryExecution().optimizedPlan().toString()
    assert "strategy=broadcast" in plan and "Generate" not in plan


def test_two_values_in_one_year_fail(frame):
    sheet = frame([("E1", "one", "2010", "2012"), ("E1", "two", "2012", "2014")], "IN string, OUT string, RENTREE_START string, RENTREE_END string")
    with pytest.raises(Exception, match="several values"):
        R.span_map(sheet, "IN")


# Rules that stay tables ---------------------------------------------------------


@pytest.mark.parametrize("seed", range(8))
def test_rule_table_equals_sequential(frame, spark, seed):
    """The same random rules as above, layered by windows; ``d`` is a column that no rule writes."""
    rng = random.Random(500 + seed)
    rules = random_rules(rng, 5) + [
        R.rule({**dict(r.conds), **({"i": str(rng.randint(0, 3))} if rng.random() < 0.6 else {})}, dict(r.outs)) for r in random_rules(rng, 4)]
    df = frame([(str(i % 5), *r[1:]) for i, r in enumerate(every_row())], "i string, a string, b string, c string")
    got = RT.apply_rule_table(df, RT.rule_table(spark, rules))
    want = [sequential(dict(zip(("i", "a", "b", "c"), (str(i % 5), *r[1:]))), rules) for i, r in enumerate(every_row())]
    assert values(got, "i", "a", "b", "c") == sorted(((w["i"], w["a"], w["b"], w["c"]) for w in want), key=repr)


@pytest.mark.parametrize("seed", range(6))
def test_folded_table_equals_sequential(frame, spark, seed):
    rng = random.Random(900 + seed)
    rules = []
    for _ in range(14):
        conds = {c: rng.choice(["x", "y", ""]) for c in rng.sample(("a", "b"), rng.choice([0, 0, 0, 1, 2]))}
        current = rng.choice(["any" if conds or rng.random() < 0.2 else "z", "x", "y", "", R.MISSING])
        if current != "any":
            conds["c"] = current
        rules.append(R.rule(conds, {"c": rng.choice(["x", "y", "z", ""])}))
    df = frame(every_row(), "i int, a string, b string, c string")
    assert values(RT.fold_rule_table(df, RT.rule_table(spark, rules), "c"), "i", "a", "b", "c") == expected(rules)


def test_sheets_of_either_size_give_the_same(frame, spark):
    """Every kind of sheet as a list on the driver and as a table."""
    rng = random.Random(4)
    pick = lambda *v: rng.choice(v)
    cells = ["", "x", "y", "None", "rien", "crochet"]
    df = frame([(a, b, c, y, t) for a in CELLS for b in ("x", "rien", "") for c in CELLS for y in ("2016", "2017") for t in ("x", "XA")],
               "COMPOS string, ETABLI string, COMINS string, RENTREE string, TYP_DIPL string")
    df = df.withColumns({"ID_PAYSAGE": F.col("COMPOS"), "k": F.monotonically_increasing_id()})
    places = [f"{i:03}" for i in range(12)]
    generic = [{R.ROW: p, "VAR1_IN": pick("COMPOS", "ETABLI", "COMINS", "absent"), "VALUE1_IN": pick("x", "y", ""), "VAR2_IN": pick("RENTREE", "COMINS"),
                "VALUE2_IN": pick("", "2016", "x"), "VAR_OUT": pick("COMINS", "ETABLI"), "VALUE_OUT": pick("x", "y")} for p in places]
    year = [{R.ROW: p, "RENTREE": pick("2016", "2017"), "VAR_IN": pick("COMPOS", "COMINS"), "VALUE_IN": pick("x", ""), "VAR_OUT": "COMINS", "VALUE_OUT": pick("x", "z")} for p in places]
    formation = [{R.ROW: p, "COMPOS_IN": pick("", "x", "[empty]"), "COMINS_IN": pick("", "y"), "COMINS_OUT": pick("", "z"), "new_OUT": pick("", "n")} for p in places]
    commune = [{R.ROW: p, "TYP_DIPL": pick("rien", "rien", "XA"), "COMPOS": pick("rien", "x", "y"), "RENTREE": pick("rien", "2016"), "IN": pick(*cells), "OUT": pick("x", "w", "")}
               for p in places]
    seat = [{R.ROW: p, "ETABLI": pick("rien", "x"), "ID_PAYSAGE": pick("x", "y"), "RENTREE": pick("2016", "2017"), "IN": pick("rien", "crochet"), "OUT": pick("p", "q")} for p in places]

    def table(records):
        return frame([tuple(r.values()) for r in rng.sample(records, len(records))], ", ".join(f"{c} string" for c in records[0]))

    for kind, records, how in (("generic", generic, {}), ("generic", generic, {"output": "ETABLI"}), ("generic", generic, {"second_is_null": True}),
                               ("year", year, {}), ("formation", formation, {})):
        one = RT.apply_sheets(df, [(kind, records, how)])
        two = RT.apply_sheets(df, [(kind, table(records), how)])
        assert sorted(one.columns) == sorted(two.columns) and values(one, *sorted(one.columns)) == values(two, *sorted(one.columns)), (kind, how)
    for kind, records, how in (("registration", commune, {}), ("establishment", seat, {}), ("wildcard", commune, {"keys": ("COMPOS", "RENTREE"), "any_word": None}),
                               ("wildcard", commune, {"keys": ("COMPOS", "RENTREE")})):
        one, two = RT.fold_sheet(df, kind, records, "COMINS", **how), RT.fold_sheet(df, kind, table(records), "COMINS", **how)
        assert values(one, "k", "COMINS") == values(two, "k", "COMINS"), (kind, how)
    # sheets without places are ordered by their cells, in both forms
    plain = [{k: v for k, v in r.items() if k != R.ROW} | {"VALUE1_IN": v} for r, v in zip(generic, ["a", "aA", "a b", "x", "x", "xX"] * 2)]
    one = R.all_records({"S": table(plain)}, ["S"])["S"]
    assert values(RT.apply_sheets(df, [("generic", one)]), "k", "COMINS", "ETABLI") == values(RT.apply_sheets(df, [("generic", table(plain))]), "k", "COMINS", "ETABLI")
    mixed = [("year", year), ("generic", table(generic))]
    assert values(RT.apply_sheets(df, mixed), "k", "COMINS", "ETABLI") == values(RT.apply_sheets(df, [("year", year), ("generic", generic)]), "k", "COMINS", "ETABLI")


def test_a_million_rules_are_never_collected(spark, frame):
    """A sheet of a million rules, among them a chain, against a dictionary."""
    n = 1_000_000
    made = spark.range(n).select(
        F.format_string("%08d", "id").alias(R.ROW), F.when(F.col("id") < n - 3, "d").otherwise("t").alias("VAR1_IN"),
        F.when(F.col("id") < n - 3, F.col("id").cast("string")).otherwise(F.concat(F.lit("v"), (F.col("id") - (n - 3)).cast("string"))).alias("VALUE1_IN"),
        F.lit("").alias("VAR2_IN"), F.lit("").alias("VALUE2_IN"), F.when(F.col("id") < n - 3, "t").otherwise("u").alias("VAR_OUT"),
        F.concat(F.lit("v"), (F.col("id") % 5).cast("string")).alias("VALUE_OUT"))
    assert isinstance(R.all_records({"S": made}, ["S"])["S"], type(made))
    df = frame([(str(i * 997), "old", "none") for i in range(1500)], "d string, t string, u string")
    got = RT.apply_sheets(df, [("generic", made)])
    want = []
    for i in range(1500):
        d = i * 997
        t = f"v{d % 5}" if d < n - 3 else "old"
        u = {f"v{k}": f"v{(n - 3 + k) % 5}" for k in range(3)}.get(t, "none")
        want.append((str(d), t, u))
    assert values(got, "d", "t", "u") == sorted(want, key=repr)


def test_unmatched_name_policies(frame):
    df = frame([("n1", "old"), ("n2", "old"), ("n3", "old")], "n string, t string")
    ids = frame([("n1", "id"), ("n2", "")], "IN string, OUT string")
    assert values(R.replace_by_name(df, ids, "n", "t"), "t") == [("id",), ("old",), ("old",)]
    assert values(R.replace_by_name(df, ids, "n", "t", keep_unmatched=False), "t") == [("id",), ("old",), (None,)]
