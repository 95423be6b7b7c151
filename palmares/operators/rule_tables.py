"""Rule sheets of any size: the rules stay rows of a table.

``rules`` compiles a sheet on the driver, which is quick for a sheet edited by hand. Here the same semantics, ordered rules of
which each sees the output of the earlier ones, are worked out by joins, so nothing of a sheet is collected but the sets of
columns that its rules read and write:

* ``apply_rule_table``: a window over the rules finds the last earlier rule that can change whether a rule matches. Where one
  lies in the current layer, a new layer begins. Inside a layer every condition shape is one table, key to latest hit.
* ``fold_rule_table``: sheets that test the column they write. Each key carries its ordered rules together with the
  unkeyed rules that their results lead to; what a row meets is folded over its value.

A rule table has the columns ``rank`` (any order), ``conds`` (col, missing, value) and ``outs`` (col, value).
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from ..functions.nulls import MISSING_TOKENS, eq_true, is_blank, is_missing
from . import rules
from .lookups import left_lookup, small_table, stored
from .rules import ANY_WORD, MISSING, MISSING_WORD, ROW, Rule

SCHEMA = "rank bigint, conds array<struct<col:string,missing:boolean,value:string>>, outs array<struct<col:string,value:string>>"
# Start of a row whose value is NULL, and of every row below an unconditional rule.
NULL_START, ANY_START = "\x00null", "\x00any"

Sheet = Sequence[Mapping[str, str]] | DataFrame


# ---------------------------------------------------------------- sheets to rule tables


def _order(sheet: DataFrame) -> Column:
    """Place of a row in its sheet; a sheet without places is ordered by its cells."""
    return F.col(ROW) if ROW in sheet.columns else F.to_json(F.struct(*sorted(sheet.columns)))


def _cell(sheet: DataFrame, name: str) -> Column:
    return F.coalesce(F.col(name), F.lit("")) if name in sheet.columns else F.lit("")


def _cond(col: Column, value: Column, missing: Column | None = None) -> Column:
    missing = F.lit(False) if missing is None else missing
    return F.struct(col.alias("col"), missing.alias("missing"), F.when(~missing, value).alias("value"))


def _table(sheet: DataFrame, conds: Sequence[Column], outs: Sequence[Column], first: Column | None = None) -> DataFrame:
    """``conds`` and ``outs``: structs, NULL where a rule has none. ``first`` goes before the place in the order."""
    place = _order(sheet) if first is None else F.struct(first, _order(sheet).alias("place"))
    out = sheet.select(place.alias("rank"), F.array_compact(F.array(*conds)).alias("conds"), F.array_compact(F.array(*outs)).alias("outs"))
    return out.filter(F.size("outs") > 0)


def _output(col: Column, value: Column) -> Column:
    return F.struct(col.alias("col"), value.alias("value"))


def generic_table(sheet: DataFrame, output: str | None = None, second_is_null: bool = False) -> DataFrame:
    """``rules.generic_rules`` over a table."""
    if output is not None:
        sheet = sheet.filter(F.col("VAR_OUT") == output)
    two = _cell(sheet, "VALUE2_IN") != ""
    again = two & (F.col("VAR1_IN") == _cell(sheet, "VAR2_IN"))
    first, second = _cond(F.col("VAR1_IN"), F.col("VALUE1_IN")), _cond(_cell(sheet, "VAR2_IN"), _cell(sheet, "VALUE2_IN"), F.lit(second_is_null))
    return _table(sheet, [F.when(~again, first), F.when(two, second)], [_output(F.col("VAR_OUT"), F.col("VALUE_OUT"))], two.cast("int").alias("two"))


def year_table(sheet: DataFrame, year: str = "RENTREE") -> DataFrame:
    """``rules.year_rules`` over a table."""
    bound = F.when(F.col("VAR_IN") != year, _cond(F.lit(year), F.col(year)))
    return _table(sheet, [bound, _cond(F.col("VAR_IN"), F.col("VALUE_IN"))], [_output(F.col("VAR_OUT"), F.col("VALUE_OUT"))])


def formation_table(sheet: DataFrame, empty: str = "[empty]") -> DataFrame:
    """``rules.formation_rules`` over a table."""
    def parts(suffix: str, make: Callable[[Column, Column], Column], value: Callable[[Column], Column]) -> list[Column]:
        return [F.when(~is_blank(c), make(F.lit(c[: -len(suffix)].strip()), value(F.col(c)))) for c in sheet.columns if c.endswith(suffix)]

    conds = parts("_IN", _cond, lambda c: F.replace(c, F.lit(empty), F.lit("")))
    outs = parts("_OUT", _output, lambda c: c)
    if not conds or not outs:
        return small_table(sheet.sparkSession, [], SCHEMA)
    return _table(sheet, conds, outs).filter(F.size("conds") > 0)


def _unless(col: str, any_word: str | None) -> Column:
    cond = _cond(F.lit(col), F.col(col))
    return cond if any_word is None else F.when(F.col(col) != any_word, cond)


def _current(sheet: DataFrame, target: str, any_word: str | None, missing: Column) -> Column:
    """The condition on the current value: column ``IN``, unless it is the wildcard."""
    if "IN" not in sheet.columns:
        return F.lit(None)
    cond = _cond(F.lit(target), F.col("IN"), missing)
    return cond if any_word is None else F.when(F.col("IN") != any_word, cond)


def wildcard_table(sheet: DataFrame, target: str, keys: Sequence[str], any_word: str | None = ANY_WORD, missing_word: str | None = MISSING_WORD) -> DataFrame:
    """``rules.wildcard_rules`` over a table."""
    missing = F.lit(False) if missing_word is None else F.col("IN") == missing_word
    conds = [_unless(k, any_word) for k in keys if k in sheet.columns] + [_current(sheet, target, any_word, missing)]
    return _table(sheet, conds, [_output(F.lit(target), F.col("OUT"))])


def registration_table(sheet: DataFrame, target: str = "COMINS") -> DataFrame:
    """``rules.commune_registration_rules`` over a table."""
    by_type, by_unit = F.col("TYP_DIPL") != ANY_WORD, F.col("COMPOS") != ANY_WORD
    plain = ~by_type & ~by_unit
    missing = by_unit & (F.col("RENTREE") != ANY_WORD) & (F.col("IN") == MISSING_WORD)
    conds = [
        F.when(by_type, _cond(F.lit("TYP_DIPL"), F.col("TYP_DIPL"))), F.when(by_type | by_unit, _cond(F.lit("COMPOS"), F.col("COMPOS"))),
        F.when(by_type | (by_unit & (F.col("RENTREE") != ANY_WORD)), _cond(F.lit("RENTREE"), F.col("RENTREE"))),
        F.when(plain | (~by_type & (F.col("IN") != ANY_WORD)), _cond(F.lit(target), F.col("IN"), missing))]
    return _table(sheet, conds, [_output(F.lit(target), F.col("OUT"))])


def establishment_table(sheet: DataFrame, target: str = "COMETAB") -> DataFrame:
    """``rules.commune_establishment_rules`` over a table."""
    by_etab = F.col("ETABLI") != ANY_WORD
    conds = [
        F.when(by_etab, _cond(F.lit("ETABLI"), F.col("ETABLI"))).otherwise(_cond(F.lit("ID_PAYSAGE"), F.col("ID_PAYSAGE"))),
        _cond(F.lit("RENTREE"), F.col("RENTREE")), F.when(by_etab & (F.col("IN") != ANY_WORD), _cond(F.lit(target), F.lit(""), F.lit(True)))]
    return _table(sheet, conds, [_output(F.lit(target), F.col("OUT"))])


def rule_table(spark: SparkSession, listed: Sequence[Rule]) -> DataFrame:
    """Rules of the driver as a table."""
    rows = [
        (i, [{"col": c, "missing": v is MISSING, "value": None if v is MISSING else v} for c, v in r.conds], [{"col": c, "value": v} for c, v in r.outs])
        for i, r in enumerate(listed) if r.outs]
    return small_table(spark, rows, SCHEMA)


def in_turn(*tables: DataFrame) -> DataFrame:
    """The rules of several tables, one table after the other."""
    parts = [numbered(t).select(F.struct(F.lit(k).alias("sheet"), F.col("rank").alias("place")).alias("rank"), "conds", "outs") for k, t in enumerate(tables)]
    return reduce(DataFrame.union, parts)


def numbered(table: DataFrame) -> DataFrame:
    """The table stored in order, with whole numbers as ranks."""
    return stored(table.orderBy("rank").select(F.monotonically_increasing_id().alias("rank"), "conds", "outs"), "rules")


# ---------------------------------------------------------------- layers


def _shape(conds: Column) -> Column:
    return F.array_sort(F.transform(conds, lambda c: F.struct(c["col"].alias("col"), c["missing"].alias("missing"))))


def _of(parts: str, col: str) -> Column:
    """The last condition or output of a rule on one column, or NULL."""
    return F.try_element_at(F.filter(parts, lambda x: x["col"] == col), F.lit(-1))


def _usable(df: DataFrame, table: DataFrame) -> DataFrame:
    """Rules that read columns of the facts only; the others are skipped, and the columns that they lack are logged."""
    lacking = table.select(F.explode("conds.col").alias("col")).filter(~F.col("col").isin(*df.columns)).distinct().collect()
    if lacking:
        rules.log.warning("rules are skipped: the facts lack %s", sorted(r.col for r in lacking))
    return table.filter(F.forall("conds", lambda c: c["col"].isin(*df.columns)))


def _earlier_writer(table: DataFrame, shapes: Sequence[tuple[frozenset, frozenset]]) -> DataFrame:
    """(rank, earlier): the last earlier rule that may change whether a rule matches; rules without one are left out.

    ``shapes``: the sets of columns read and written. An earlier rule that writes a column which a rule reads is harmless
    if the two ask for different values of a column that no rule writes: they never meet on a row. So rules are
    compared only where they agree on the unwritten columns that both test: one window per such set of values. Of these an earlier rule
    is harmless too if it asks for another value of the column and does not write the one that is asked for: so the window is also by
    that value, as asked and as written; one that does not test the column at all is met by every reader.
    """
    spark = table.sparkSession
    written = sorted(set().union(*[w for _, w in shapes]))
    pairs = {
        (c, ",".join(sorted(ra - set(written))), ",".join(sorted(rb - set(written))), tuple(sorted((ra & rb) - set(written))))
        for ra, wa in shapes for rb, _ in shapes for c in wa & rb}
    meets = small_table(spark, [(c, a, b, list(j)) for c, a, b, j in sorted(pairs)], "col string, a string, b string, shared array<string>")
    fixed = F.filter("conds", lambda c: ~c["col"].isin(*written))
    # a test for a missing cell can agree with a test for one of the texts that mean it
    value = lambda c: F.when(c["missing"] | c["value"].isin(*MISSING_TOKENS), F.lit("missing")).otherwise(F.concat(F.lit("="), c["value"]))
    narrow = table.select(
        "rank", F.array_join(F.array_sort(F.transform(fixed, lambda c: c["col"])), ",").alias("tests"),
        F.map_from_entries(F.transform(fixed, lambda c: F.struct(c["col"], value(c)))).alias("asked"),
        F.transform("outs", lambda o: F.struct(o["col"].alias("col"), F.lit(False).alias("missing"), o["value"].alias("value"))).alias("writes"), F.col("conds").alias("reads"))

    def events(parts: str, side: str) -> DataFrame:
        """A row for every column, kind of partner and way to meet; ``key`` is the same for rules that can meet."""
        one = narrow.select("rank", "tests", "asked", "reads", F.explode(parts).alias("part")).withColumn("col", F.col("part.col"))
        met = one.join(F.broadcast(meets), (one["col"] == meets["col"]) & (one["tests"] == meets[side]))
        own = F.filter("reads", lambda c: c["col"] == F.col("part.col"))
        asks = F.try_element_at(own, F.lit(-1))
        way = lambda how, v: F.concat(F.lit(how), v)
        asked = F.when(asks.isNull(), F.lit("any")).otherwise(way("in ", value(asks)))
        ways = F.array(asked, way("out ", value(F.col("part")))) if side == "a" else F.array(F.lit("any"), way("in ", value(asks)), way("out ", value(asks)))
        spread = met.select("rank", meets["col"], "a", "b", F.transform("shared", lambda c: F.element_at("asked", c)).alias("values"), F.explode(ways).alias("way"))
        return spread.select("rank", F.to_json(F.struct("col", "a", "b", "values", "way")).alias("key"))

    both = events("writes", "a").withColumn("writer", F.col("rank")).unionByName(events("reads", "b").withColumn("writer", F.lit(None).cast("bigint")))
    before = Window.partitionBy("key").orderBy("rank").rangeBetween(Window.unboundedPreceding, -1)
    seen = both.withColumn("earlier", F.max("writer").over(before)).filter("writer IS NULL AND earlier IS NOT NULL")
    return seen.groupBy("rank").agg(F.max("earlier").alias("earlier"))


def layer_starts(table: DataFrame, shapes: Sequence[tuple[frozenset, frozenset]]) -> list[int]:
    """First rank of every layer but the first: one small query a layer over a stored table."""
    if not any(w & r for r, _ in shapes for _, w in shapes):
        return []
    earlier = stored(_earlier_writer(table, shapes), "earlier")
    starts, begin = [], 0
    while (begin := earlier.filter(F.col("earlier") >= begin).agg(F.min("rank")).first()[0]) is not None:
        starts.append(begin)
    return starts


def apply_rule_table(df: DataFrame, table: DataFrame, where: Column | None = None) -> DataFrame:
    """Apply the rules of a table. Rules that read an absent column are skipped; absent outputs are added."""
    table = numbered(_usable(df, table).filter(F.size("outs") > 0))
    kinds = table.select(_shape("conds").alias("shape"), F.array_sort(F.transform("outs", lambda o: o["col"])).alias("writes")).distinct().collect()
    if not kinds:
        return df
    starts = layer_starts(table, [(frozenset(c.col for c in k["shape"]), frozenset(k["writes"])) for k in kinds])
    layer = F.size(F.filter(F.array(*[F.lit(s) for s in starts]).cast("array<bigint>"), lambda s: s <= F.col("rank")))
    table = table.withColumns({"layer": layer, "shape": _shape("conds")})
    found: dict[int, dict[tuple, set[str]]] = {}
    for r in table.select("layer", "shape", F.explode(F.transform("outs", lambda o: o["col"])).alias("col")).distinct().collect():
        found.setdefault(r["layer"], {}).setdefault(tuple((c.col, c.missing) for c in r["shape"]), set()).add(r["col"])
    for k, number in enumerate(sorted(found)):
        if k and k % rules.LAYERS_A_PLAN == 0:
            df = rules.written(df)
        df = _apply_layer(df, table.filter(F.col("layer") == number), found[number], where)
    return df


def _apply_layer(df: DataFrame, layer: DataFrame, shapes: Mapping[tuple, set[str]], where: Column | None) -> DataFrame:
    hits: dict[str, list[Column]] = {}
    temps: list[str] = []
    for n, (shape, writes) in enumerate(sorted(shapes.items())):
        cols = sorted(writes)
        eq, empty = [c for c, missing in shape if not missing], [c for c, missing in shape if missing]
        wanted = F.array(*[F.struct(F.lit(c).alias("col"), F.lit(m).alias("missing")) for c, m in shape])
        mine = layer.filter(F.col("shape") == wanted) if shape else layer.filter(F.size("shape") == 0)
        names = {c: f"__r{n}_{i}" for i, c in enumerate(cols)}
        hit = {c: _of("outs", c) for c in cols}
        latest = [F.max(F.when(hit[c].isNotNull(), F.struct("rank", hit[c]["value"].alias("value")))).alias(names[c]) for c in cols]
        keyed = mine.groupBy(*[_of("conds", c)["value"].alias(f"__e{i}") for i, c in enumerate(eq)]).agg(*latest)
        if eq:
            df = left_lookup(df, stored(keyed, "layer"), {c: f"__e{i}" for i, c in enumerate(eq)}, list(names.values()), unique="trust")
            temps += names.values()
            values = {c: F.col(names[c]) for c in cols}
        else:
            only = keyed.first()
            values = {c: F.struct(F.lit(only[names[c]]["rank"]).cast("bigint").alias("rank"), F.lit(only[names[c]]["value"]).alias("value")) for c in cols}
        guard = reduce(lambda a, b: a & b, [is_missing(c) for c in empty], F.lit(True))
        for c in cols:
            hits.setdefault(c, []).append(F.when(guard, values[c]) if empty else values[c])
    return rules.take_hits(df, hits, where).drop(*temps)


# ---------------------------------------------------------------- folds


def fold_rule_table(df: DataFrame, table: DataFrame, target: str) -> DataFrame:
    """Sequential rules that test and write ``target``, from a table; the other tests are for equality.

    Of the rules without other tests a row meets only those that its values lead to: from each value and place the next
    rule that fits is found once, and the paths along these are attached to the keys and values that they start from.
    """
    table = _usable(df if target in df.columns else df.withColumn(target, F.lit(None).cast("string")), table)
    odd = table.filter(F.exists("outs", lambda o: o["col"] != target) | F.exists("conds", lambda c: c["missing"] & (c["col"] != target))).first()
    if odd is not None:
        raise ValueError(f"every rule must write {target} only, and only {target} may be tested for a missing value")
    test = _of("conds", target)
    others = F.array_sort(F.filter("conds", lambda c: c["col"] != target), lambda a, b: F.when(a["col"] < b["col"], -1).when(a["col"] > b["col"], 1).otherwise(0))
    flat = numbered(table).select(
        "rank", F.when(test.isNull(), "any").when(test["missing"], "missing").otherwise("value").alias("kind"), test["value"].alias("seen"),
        F.element_at("outs", -1)["value"].alias("out"), F.transform(others, lambda c: c["col"]).alias("shape"), F.transform(others, lambda c: c["value"]).alias("key"))
    # nothing before the last rule without any test has an effect
    last = flat.filter("kind = 'any' AND size(shape) = 0").agg(F.max("rank")).first()[0]
    if last is not None:
        flat = flat.filter(F.col("rank") >= last)
    flat = stored(flat, "steps")
    step = F.struct("rank", "kind", "seen", "out")
    loose, keyed = flat.filter("size(shape) = 0"), flat.filter("size(shape) > 0")
    paths = _paths(loose.filter("kind <> 'any'"))
    # where values come from: the rules themselves and the values of the rows
    spark = df.sparkSession
    starts = loose.filter("kind = 'value'").select("seen").union(small_table(spark, [(t,) for t in MISSING_TOKENS], "seen string")).distinct()
    begin = small_table(spark, [(NULL_START,)], "start string").select("start", F.lit(None).cast("string").alias("value")).union(starts.select("seen", "seen"))
    begin = begin.select("start", "value", F.lit(-1).cast("bigint").alias("rank"), F.array().cast(STEPS).alias("own"))
    if last is not None:
        begin = loose.filter("kind = 'any'").select(F.lit(ANY_START).alias("start"), F.col("out").alias("value"), "rank", F.array(step).alias("own"))
    opening = _with_paths(begin, loose, paths).groupBy("start").agg(F.flatten(F.collect_list("steps")).alias("__first"))
    entry = F.lit(ANY_START) if last is not None else F.coalesce(F.col(target), F.lit(NULL_START)) if target in df.columns else F.lit(NULL_START)
    df = left_lookup(df.withColumn("__start", entry), stored(opening, "opening"), {"__start": "start"}, ["__first"], unique="trust").drop("__start")
    temps = ["__first"]
    shapes = [tuple(r["shape"]) for r in keyed.select("shape").distinct().collect()]
    follow = _with_paths(keyed.select("shape", "key", F.col("out").alias("value"), "rank", F.array(step).alias("own")), loose, paths)
    for n, shape in enumerate(sorted(shapes)):
        mine = follow.filter(F.col("shape") == F.array(*[F.lit(c) for c in shape]))
        side = mine.groupBy(*[F.col("key")[i].alias(f"__e{i}") for i in range(len(shape))]).agg(F.flatten(F.collect_list("steps")).alias(f"__f{n}"))
        df = left_lookup(df, stored(side, "folds"), {c: f"__e{i}" for i, c in enumerate(shape)}, [f"__f{n}"], unique="trust")
        temps.append(f"__f{n}")
    ordered = F.array_sort(F.array_distinct(F.concat(*[F.coalesce(F.col(t), F.array().cast(STEPS)) for t in temps])))

    def apply_step(value: Column, s: Column) -> Column:
        fits = (s["kind"] == "any") | ((s["kind"] == "missing") & is_missing(value)) | ((s["kind"] == "value") & eq_true(value, s["seen"]))
        return F.when(fits, s["out"]).otherwise(value)

    old = F.col(target) if target in df.columns else F.lit(None).cast("string")
    return df.withColumn(target, F.aggregate(ordered, old, apply_step)).drop(*temps)


STEPS = "array<struct<rank:bigint,kind:string,seen:string,out:string>>"


def _next_rule(places: DataFrame, loose: DataFrame) -> DataFrame:
    """``places`` (value, rank and others) with ``next``: the rank of the first later rule that fits the value, or NULL."""
    missing = F.col("value").isNull() | F.col("value").isin(*MISSING_TOKENS)
    numbered_places = places.withColumn("__n", F.monotonically_increasing_id())
    held = stored(numbered_places, "places")
    asks = held.select("__n", "rank", F.explode(F.array_compact(F.array(
        F.when(F.col("value").isNotNull(), F.concat(F.lit("="), "value")), F.when(missing, F.lit("missing"))))).alias("met"))
    tests = loose.filter("kind <> 'any'").select("rank", F.when(F.col("kind") == "missing", "missing").otherwise(F.concat(F.lit("="), "seen")).alias("met"))
    both = asks.withColumn("later", F.lit(None).cast("bigint")).unionByName(
        tests.select(F.lit(None).cast("bigint").alias("__n"), "rank", "met", F.col("rank").alias("later")))
    after = Window.partitionBy("met").orderBy("rank").rangeBetween(1, Window.unboundedFollowing)
    first = both.withColumn("next", F.min("later").over(after)).filter("__n IS NOT NULL").groupBy("__n").agg(F.min("next").alias("next"))
    return held.join(first, "__n", "left").drop("__n")


def _paths(loose: DataFrame) -> DataFrame:
    """(rank, path): every rule without other tests with the rules that its result leads to, in order. Paths double in each round."""
    step = F.struct("rank", "kind", "seen", "out")
    state = stored(_next_rule(loose.withColumn("value", F.col("out")), loose).select("rank", F.array(step).alias("path"), F.col("next").alias("jump")), "paths")
    while not state.filter("jump IS NOT NULL").isEmpty():
        ahead = state.select(F.col("rank").alias("jump"), F.col("path").alias("rest"), F.col("jump").alias("further"))
        moved = state.join(ahead, "jump", "left")
        state = stored(moved.select("rank", F.concat("path", F.coalesce("rest", F.array().cast(STEPS))).alias("path"), F.col("further").alias("jump")), "paths")
    return state.drop("jump")


def _with_paths(places: DataFrame, loose: DataFrame, paths: DataFrame) -> DataFrame:
    """``places`` (value, rank, own) with ``steps``: the own steps and those of the path that the value leads to."""
    onward = paths.select(F.col("rank").alias("next"), "path")
    return _next_rule(places, loose).join(onward, "next", "left").withColumn("steps", F.concat("own", F.coalesce("path", F.array().cast(STEPS))))


# ---------------------------------------------------------------- one call for sheets of either size

KINDS: dict[str, tuple[Callable, Callable]] = {
    "generic": (rules.generic_rules, generic_table), "year": (rules.year_rules, year_table), "formation": (rules.formation_rules, formation_table),
    "wildcard": (rules.wildcard_rules, wildcard_table), "registration": (rules.commune_registration_rules, registration_table),
    "establishment": (rules.commune_establishment_rules, establishment_table)}


def as_table(spark: SparkSession, kind: str, sheet: Sheet, **how) -> DataFrame:
    """The rule table of a sheet, which may be a table or a list of records."""
    listed, table = KINDS[kind]
    return table(sheet, **how) if isinstance(sheet, DataFrame) else rule_table(spark, listed(sheet, **how))


def apply_sheets(df: DataFrame, parts: Sequence[tuple], where: Column | None = None) -> DataFrame:
    """Apply sheets one after the other: ``(kind, sheet)`` or ``(kind, sheet, options)``. Lists are compiled on the driver; with a table among them all become tables."""
    parts = [(kind, sheet, *(rest or ({},))) for kind, sheet, *rest in parts]
    if not any(isinstance(sheet, DataFrame) for _, sheet, _ in parts):
        return rules.apply_rules(df, rules.compile_rules([r for kind, sheet, how in parts for r in KINDS[kind][0](sheet, **how)]), where)
    tables = [as_table(df.sparkSession, kind, sheet, **how) for kind, sheet, how in parts]
    return apply_rule_table(df, tables[0] if len(tables) == 1 else in_turn(*tables), where)


def fold_sheet(df: DataFrame, kind: str, sheet: Sheet, target: str, **how) -> DataFrame:
    """Fold a sheet that tests the column it writes, compiled on the driver or as a table."""
    if isinstance(sheet, DataFrame):
        return fold_rule_table(df, as_table(df.sparkSession, kind, sheet, target=target, **how), target)
    return rules.fold_rules(df, KINDS[kind][0](sheet, target=target, **how), target)
