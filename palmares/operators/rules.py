"""Correction rules held as data.

A rule sheet is an ordered list: every rule sees the output of the earlier ones and the
last rule that matches wins. Nothing is applied row by row and no CASE is nested in
itself. Three forms cover all sheets:

* ``compile_rules`` / ``apply_rules``: rules are put in as few layers as their order
  allows. Inside a layer all rules read the layer's input, so a layer is one projection
  with one flat CASE per output column, or, when it holds many rules, one join per
  condition shape.
* ``fold_rules``: sheets in which a rule tests the column it writes. The rules that fit
  the other keys of a row are attached as an ordered array and folded over the value.
* ``replace_in_spans`` / ``replace_by_key`` / ``override_tiers``: pure key-to-value sheets, as joins.
"""

from __future__ import annotations

import json
import logging
from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F, types as T

from ..functions.nulls import MISSING_TOKENS, eq_true, holds, is_blank, is_missing
from ..functions.scalars import len_at_least, year_range
from ..session import work_dir
from .lookups import enforced, left_lookup, small_table, stored


log = logging.getLogger(__name__)


class _Missing:
    def __repr__(self) -> str:
        return "MISSING"


# Condition value that is met by a missing cell.
MISSING = _Missing()

# Column that keeps the place of a row in its sheet.
ROW = "SHEET_ROW"
# A sheet of up to so many rows is compiled on the driver; larger ones stay tables (``rule_tables``).
SHEET_ROWS = 2_000
# A layer with more rules than this becomes joins instead of one CASE.
INLINE_RULES = 200
# So many layers are chained in one plan; then the facts are written and read again, for the optimiser takes the expressions of
# projections that read each other apart again and again.
LAYERS_A_PLAN = 8


@dataclass(frozen=True)
class Rule:
    """``conds``: (column, literal or MISSING), all needed. ``outs``: (column, literal)."""

    conds: tuple[tuple[str, object], ...]
    outs: tuple[tuple[str, str], ...]

    @property
    def reads(self) -> dict[str, object]:
        return dict(self.conds)

    @property
    def writes(self) -> dict[str, str]:
        return dict(self.outs)


def rule(conds: Mapping[str, object], outs: Mapping[str, str]) -> Rule:
    return Rule(tuple(conds.items()), tuple(outs.items()))


def sheet_records(sheet: DataFrame | Iterable[Mapping[str, str]], limit: int = SHEET_ROWS) -> list[dict[str, str]]:
    """The rows of a small rule sheet on the driver, in order, after a check of their number."""
    if not isinstance(sheet, DataFrame):
        return [dict(r) for r in sheet]
    rows = sheet.limit(limit + 1).collect()
    if len(rows) > limit:
        raise ValueError(f"rule sheet holds over {limit} rows: apply it as a table")
    return _in_order([r.asDict() for r in rows])


def _in_order(records: list[dict[str, str]]) -> list[dict[str, str]]:
    """By the place in the sheet; rows without one by their cells, so that the result never depends on the cluster."""
    ordered = sorted(records, key=lambda r: (r.get(ROW) or "", json.dumps(r, sort_keys=True, ensure_ascii=False)))
    return [{c: v for c, v in r.items() if c != ROW} for r in ordered]


def all_records(sheets: Mapping[str, DataFrame], names: Iterable[str], limit: int = SHEET_ROWS) -> dict[str, list[dict[str, str]] | DataFrame]:
    """The rows of several sheets of texts, collected by one job; a sheet over ``limit`` rows stays the table that it is."""
    parts = [
        sheets[n].limit(limit + 1).select(F.lit(n).alias("sheet"), F.to_json(F.struct(*sheets[n].columns), {"ignoreNullFields": "false"}).alias("row")) for n in names]
    found: dict[str, list[dict[str, str]]] = {n: [] for n in names}
    for r in reduce(DataFrame.union, parts).collect():
        found[r.sheet].append(json.loads(r.row))
    return {n: _in_order(rows) if len(rows) <= limit else sheets[n] for n, rows in found.items()}


# ---------------------------------------------------------------- compile and apply


def agree(a: object, b: object) -> bool:
    """Can one cell pass both tests?"""
    if a is MISSING or b is MISSING:
        other = b if a is MISSING else a
        return other is MISSING or other in MISSING_TOKENS
    return a == b


def misses(earlier: Rule, r: Rule) -> bool:
    """Does a row that ``earlier`` has just written fail a test of ``r``?"""
    return any(c in earlier.writes and not agree(earlier.writes[c], v) for c, v in r.conds)


def shadows(earlier: Rule, r: Rule) -> bool:
    """Every row that fits ``r`` fits ``earlier``, which then makes it unfit."""
    return set(earlier.conds) <= set(r.conds) and misses(earlier, r)


class _Layer:
    """Rules that may all read one snapshot, with indexes that keep the test cheap."""

    def __init__(self) -> None:
        self.rules: list[Rule] = []
        self.writers: dict[str, set[int]] = {}
        self.by_value: dict[tuple[str, object], set[int]] = {}
        self.readers: dict[str, set[int]] = {}

    def conflicts(self, r: Rule) -> list[Rule]:
        """Earlier rules of the layer that may change whether ``r`` matches.

        A rule that writes a column which ``r`` reads is harmless if the two differ on a column that no rule of the layer writes:
        they never meet on a row. It is harmless too if they ask for different values of some column, so that only one of
        them can match the snapshot, and what it writes does not fit ``r`` either.
        """
        writers: set[int] = set()
        for col in r.reads:
            writers |= self.writers.get(col, set())
        for col, value in r.conds:
            if not writers:
                return []
            if col in self.writers:
                continue
            same = self._may_agree(col, value)
            writers = {i for i in writers if i in same or i not in self.readers.get(col, set())}
        found = []
        for i in sorted(writers):
            earlier = self.rules[i]
            apart = any(c in earlier.reads and not agree(earlier.reads[c], v) for c, v in r.conds)
            if not (apart and misses(earlier, r)):
                found.append(earlier)
        return found

    def _may_agree(self, col: str, value: object) -> set[int]:
        """Rules whose test on ``col`` can hold together with ``value``."""
        agree = set(self.by_value.get((col, value), set()))
        if value is MISSING:
            for token in MISSING_TOKENS:
                agree |= self.by_value.get((col, token), set())
        elif value in MISSING_TOKENS:
            agree |= self.by_value.get((col, MISSING), set())
        return agree

    def add(self, r: Rule) -> None:
        i = len(self.rules)
        self.rules.append(r)
        for col, value in r.conds:
            self.by_value.setdefault((col, value), set()).add(i)
            self.readers.setdefault(col, set()).add(i)
        for col in r.writes:
            self.writers.setdefault(col, set()).add(i)


def compile_rules(rules: Sequence[Rule]) -> list[list[Rule]]:
    """Split an ordered rule list into layers; order inside a layer is kept.

    A rule whose only conflicts in its layer are with rules that shadow it can never fire and is left out.
    """
    layers: list[_Layer] = []
    for r in rules:
        if not r.outs:
            continue
        found = layers[-1].conflicts(r) if layers else []
        if found and all(shadows(earlier, r) for earlier in found):
            continue
        if not layers or found:
            layers.append(_Layer())
        layers[-1].add(r)
    return [layer.rules for layer in layers]


def _name(col: str) -> str:
    return "`" + col.replace("`", "``") + "`"


def _text(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _condition(r: Rule) -> str:
    tokens = ", ".join(_text(t) for t in MISSING_TOKENS)
    tests = [
        f"({_name(c)} IS NULL OR {_name(c)} IN ({tokens}))" if v is MISSING else f"{_name(c)} = {_text(v)}"
        for c, v in r.conds
    ]
    return " AND ".join(tests) if tests else "TRUE"


def _inline_layer(df: DataFrame, layer: Sequence[Rule], where: Column | None) -> DataFrame:
    """One flat CASE per output column, the last rule first. It is handed over as one SQL text:
    building hundreds of branches call by call costs more than running them."""
    types = dict(df.dtypes)
    branches: dict[str, list[str]] = {}
    for r in reversed(layer):
        cond = _condition(r)
        for col, value in r.outs:
            branches.setdefault(col, []).append(f"WHEN {cond} THEN {_text(value)}")
    out = {}
    for col, cases in branches.items():
        dtype = types.get(col, "string")
        hit = F.expr("CASE " + " ".join(cases) + " END")
        old = F.col(col) if col in types else F.lit(None).cast(dtype)
        new = F.coalesce(hit if dtype == "string" else hit.cast(dtype), old)
        out[col] = new if where is None else F.when(where, new).otherwise(old)
    return df.withColumns(out)


def _joined_layer(df: DataFrame, layer: Sequence[Rule], where: Column | None) -> DataFrame:
    """One join per condition shape; the highest-ranked hit per output column wins."""
    spark = df.sparkSession
    shapes: dict[tuple, dict[tuple, dict[str, tuple[int, str]]]] = {}
    for rank, r in enumerate(layer):
        eq = tuple(sorted(c for c, v in r.conds if v is not MISSING))
        empty = tuple(sorted(c for c, v in r.conds if v is MISSING))
        last = shapes.setdefault((eq, empty), {}).setdefault(tuple(r.reads[c] for c in eq), {})
        for col, value in r.outs:
            last[col] = (rank, value)
    targets = list(dict.fromkeys(c for r in layer for c in r.writes))
    hits: dict[str, list[Column]] = {c: [] for c in targets}
    hit_type = T.StructType([T.StructField("rank", T.IntegerType()), T.StructField("value", T.StringType())])
    added: list[str] = []
    for n, ((eq, empty), table) in enumerate(shapes.items()):
        cols = [c for c in targets if any(c in o for o in table.values())]
        guard = reduce(lambda a, b: a & b, [is_missing(c) for c in empty], F.lit(True))
        if not eq:
            for c in cols:
                rank, value = next(iter(table.values()))[c]
                hits[c].append(F.when(guard, F.struct(F.lit(rank).alias("rank"), F.lit(value).alias("value"))))
            continue
        names = {c: f"__r{n}_{i}" for i, c in enumerate(cols)}
        schema = T.StructType(
            [T.StructField(f"__e{i}", T.StringType()) for i in range(len(eq))]
            + [T.StructField(names[c], hit_type) for c in cols]
        )
        rows = [
            (*key, *[dict(zip(("rank", "value"), outs[c])) if c in outs else None for c in cols])
            for key, outs in table.items()
        ]
        side = small_table(spark, rows, schema)
        on = {c: f"__e{i}" for i, c in enumerate(eq)}
        df = left_lookup(df, side, on, list(names.values()), unique="trust")
        added += names.values()
        for c in cols:
            hits[c].append(F.when(guard, F.col(names[c])) if empty else F.col(names[c]))
    return take_hits(df, hits, where).drop(*added)


def take_hits(df: DataFrame, hits: Mapping[str, Sequence[Column]], where: Column | None) -> DataFrame:
    """Each column takes the value of its hit of the highest rank: structs (rank, value), NULL where nothing was hit."""
    types = dict(df.dtypes)
    out = {}
    for c, found in hits.items():
        dtype = types.get(c, "string")
        old = F.col(c) if c in types else F.lit(None).cast(dtype)
        best = found[0] if len(found) == 1 else F.greatest(*found)
        new = F.when(best.isNotNull(), best["value"].cast(dtype)).otherwise(old)
        out[c] = new if where is None else F.when(where, new).otherwise(old)
    return df.withColumns(out)


def apply_rules(
    df: DataFrame, layers: Sequence[Sequence[Rule]], where: Column | None = None, inline: int = INLINE_RULES
) -> DataFrame:
    """Apply compiled rules. Rules that read an absent column are skipped; absent outputs are added."""
    for k, layer in enumerate(layers):
        if k and k % LAYERS_A_PLAN == 0:
            df = written(df)
        have = set(df.columns)
        usable = [r for r in layer if all(c in have for c in r.reads)]
        if len(usable) < len(layer):
            log.warning("%d rules are skipped: the facts lack %s", len(layer) - len(usable), sorted({c for r in layer for c in r.reads} - have))
        if not usable:
            continue
        step = _inline_layer if len(usable) <= inline else _joined_layer
        df = step(df, usable, where)
    return df


def written(df: DataFrame) -> DataFrame:
    """``df`` written to a work folder and read again: its plan ends there."""
    folder = work_dir(df.sparkSession, "layers")
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


# ---------------------------------------------------------------- sheets to rules


def generic_rules(
    records: Iterable[Mapping[str, str]],
    output: str | None = None,
    second_is_null: bool = False,
) -> list[Rule]:
    """Rules whose column names are data: ``VAR1_IN = VALUE1_IN [and VAR2_IN ...] -> VAR_OUT``.

    One-condition rules come first, then the two-condition ones. The second value is
    honoured; ``second_is_null`` reads the second test as "is missing" instead.
    ``output`` keeps the rules that write one column.
    """
    single, double = [], []
    for r in records:
        if output is not None and r["VAR_OUT"] != output:
            continue
        outs = {r["VAR_OUT"]: r["VALUE_OUT"]}
        second = r.get("VALUE2_IN") or ""
        if second == "":
            single.append(rule({r["VAR1_IN"]: r["VALUE1_IN"]}, outs))
        else:
            test = MISSING if second_is_null else second
            double.append(rule({r["VAR1_IN"]: r["VALUE1_IN"], r["VAR2_IN"]: test}, outs))
    return single + double


def year_rules(records: Iterable[Mapping[str, str]], year: str = "RENTREE") -> list[Rule]:
    """Generic rules bound to one year: ``year`` and ``VAR_IN = VALUE_IN -> VAR_OUT``."""
    return [rule({year: r[year], r["VAR_IN"]: r["VALUE_IN"]}, {r["VAR_OUT"]: r["VALUE_OUT"]}) for r in records]


def formation_rules(records: Iterable[Mapping[str, str]], empty: str = "[empty]") -> list[Rule]:
    """Rules with any ``<COL>_IN`` conditions and any ``<COL>_OUT`` outputs; blanks are unused."""
    rules = []
    for r in records:
        conds = {k[: -len("_IN")].strip(): v.replace(empty, "") for k, v in r.items() if v and k.endswith("_IN")}
        outs = {k[: -len("_OUT")].strip(): v for k, v in r.items() if v and k.endswith("_OUT")}
        if conds and outs:
            rules.append(rule(conds, outs))
    return rules


# Wildcard words used in the sheets of commune rules.
ANY_WORD = "rien"
MISSING_WORD = "crochet"


def wildcard_rules(
    records: Iterable[Mapping[str, str]],
    target: str,
    keys: Sequence[str],
    any_word: str | None = ANY_WORD,
    missing_word: str | None = MISSING_WORD,
) -> list[Rule]:
    """Rules on ``keys`` and the current value of ``target`` (column ``IN``), with wildcard words;
    ``None`` turns a wildcard off."""
    rules = []
    for r in records:
        conds = {k: r[k] for k in keys if r.get(k, any_word) != any_word}
        current = r.get("IN", any_word)
        if current == missing_word:
            conds[target] = MISSING
        elif current != any_word:
            conds[target] = current
        rules.append(rule(conds, {target: r["OUT"]}))
    return rules


def commune_registration_rules(records: Iterable[Mapping[str, str]], target: str = "COMINS") -> list[Rule]:
    """A degree type makes the rule unconditional on the current value; else unit, year and value
    count unless they are the wildcard, and a rule without a unit looks at the value only. The
    word for a missing value counts only in rules bound to a year."""
    rules = []
    for r in records:
        if r["TYP_DIPL"] != ANY_WORD:
            rules.append(rule({k: r[k] for k in ("TYP_DIPL", "COMPOS", "RENTREE")}, {target: r["OUT"]}))
        elif r["COMPOS"] != ANY_WORD:
            missing = MISSING_WORD if r["RENTREE"] != ANY_WORD else None
            rules += wildcard_rules([r], target, ("COMPOS", "RENTREE"), missing_word=missing)
        else:
            rules.append(rule({target: r["IN"]}, {target: r["OUT"]}))
    return rules


def commune_establishment_rules(records: Iterable[Mapping[str, str]], target: str = "COMETAB") -> list[Rule]:
    """By establishment and year (always, or only when the value is missing), else by entity and year."""
    rules = []
    for r in records:
        if r["ETABLI"] != ANY_WORD:
            conds: dict[str, object] = {"ETABLI": r["ETABLI"], "RENTREE": r["RENTREE"]}
            if r["IN"] != ANY_WORD:
                conds[target] = MISSING
        else:
            conds = {"ID_PAYSAGE": r["ID_PAYSAGE"], "RENTREE": r["RENTREE"]}
        rules.append(rule(conds, {target: r["OUT"]}))
    return rules


# ---------------------------------------------------------------- self-referencing sheets


def fold_rules(df: DataFrame, rules: Sequence[Rule], target: str) -> DataFrame:
    """Sequential rules that test and write ``target``.

    Per set of other key columns there is one lookup table from key to its ordered rules.
    The arrays found for a row are merged by rank and folded over the current value, which
    is the sequential semantics itself. Rules before an unconditional rule of the same key
    can have no effect and are left out of the table.
    """
    if not rules:
        return df
    if any(set(r.writes) != {target} for r in rules):
        raise ValueError(f"every rule must write {target} only")
    step = T.StructType([
        T.StructField("rank", T.IntegerType()), T.StructField("kind", T.StringType()),
        T.StructField("seen", T.StringType()), T.StructField("out", T.StringType()),
    ])
    shapes: dict[tuple[str, ...], dict[tuple, list[dict]]] = {}
    for rank, r in enumerate(rules):
        reads = r.reads
        current = reads.pop(target, None)
        kind = "any" if current is None else "missing" if current is MISSING else "value"
        shape = tuple(sorted(reads))
        if MISSING in reads.values():
            raise ValueError(f"only {target} may be tested for a missing value")
        if not set(shape) <= set(df.columns):
            continue
        steps = shapes.setdefault(shape, {}).setdefault(tuple(reads[c] for c in shape), [])
        if kind == "any":
            steps.clear()
        seen = current if kind == "value" else None
        steps.append({"rank": rank, "kind": kind, "seen": seen, "out": r.writes[target]})
    empty = F.array().cast(T.ArrayType(step))
    arrays, temps = [], []
    for n, (shape, table) in enumerate(shapes.items()):
        if not shape:
            arrays.append(F.array(*[
                F.struct(*[F.lit(s[f.name]).cast(f.dataType).alias(f.name) for f in step.fields])
                for s in table[()]
            ]))
            continue
        schema = T.StructType([T.StructField(f"__e{i}", T.StringType()) for i in range(len(shape))]
                              + [T.StructField(f"__f{n}", T.ArrayType(step))])
        side = small_table(df.sparkSession, [(*k, v) for k, v in table.items()], schema)
        df = left_lookup(df, side, {c: f"__e{i}" for i, c in enumerate(shape)}, [f"__f{n}"], unique="trust")
        temps.append(f"__f{n}")
        arrays.append(F.coalesce(F.col(f"__f{n}"), empty))
    if not arrays:
        return df
    ordered = arrays[0] if len(arrays) == 1 else F.array_sort(F.concat(*arrays))

    def apply_step(value: Column, s: Column) -> Column:
        fits = (s["kind"] == "any") | ((s["kind"] == "missing") & is_missing(value)) | (
            (s["kind"] == "value") & eq_true(value, s["seen"]))
        return F.when(fits, s["out"]).otherwise(value)

    old = F.col(target) if target in df.columns else F.lit(None).cast("string")
    return df.withColumn(target, F.aggregate(ordered, old, apply_step)).drop(*temps)


# ---------------------------------------------------------------- key-to-value sheets


def expand_years(sheet: DataFrame, first: int, last: int, year: str = "RENTREE") -> DataFrame:
    """One row per year of the inclusive range; no start means every year of the facts, ``first`` to ``last``."""
    years = F.explode(year_range("RENTREE_START", "RENTREE_END", first, last)).alias(year)
    return sheet.select("*", years).drop("RENTREE_START", "RENTREE_END")


def year_bounds(df: DataFrame, year: str = "RENTREE") -> tuple[int, int]:
    """First and last year of the facts; over stored facts only the year is read. Of no facts: an empty range."""
    first, last = df.agg(F.min(F.col(year).cast("int")), F.max(F.col(year).cast("int"))).first()
    return (first, last) if first is not None else (0, 0)


#: Years that bound an open span.
FIRST_OF_ALL, LAST_OF_ALL = -(1 << 31), (1 << 31) - 1


def span_map(sheet: DataFrame, key: str, out: str = "OUT", source: str | None = None) -> DataFrame:
    """One row a code with its spans of years, in order: what the sheet says, without a row for each year or source.

    No start means every year. ``source``: a column of the sheet that is blank for rules of all sources.
    Two values that a code has for one year (and source) fail. Blank codes are no rules.
    """
    start, end = F.col("RENTREE_START"), F.col("RENTREE_END")
    open_ = is_missing(start)
    span = F.struct(
        F.when(open_, F.lit(FIRST_OF_ALL)).otherwise(start.try_cast("int")).alias("first"),
        F.when(open_, F.lit(LAST_OF_ALL)).otherwise(end.try_cast("int")).alias("last"),
        (F.lit("") if source is None else F.coalesce(F.col(source), F.lit(""))).alias("source"), F.col(out).alias("out"))
    rows = sheet.filter(~is_blank(key)).select(F.col(key).alias("code"), span.alias("span")).filter("span.first <= span.last")
    spans = rows.groupBy("code").agg(F.array_sort(F.collect_set("span")).alias("spans"))

    def clash(a: Column, b: Column) -> Column:
        both = (a["first"] <= b["last"]) & (b["first"] <= a["last"]) & ((a["source"] == b["source"]) | (a["source"] == "") | (b["source"] == ""))
        return both & ~a["out"].eqNullSafe(b["out"])

    sound = ~F.exists("spans", lambda a: F.exists("spans", lambda b: clash(a, b)))
    return stored(enforced(spans, ["code"], sound, F.struct("spans")), "spans")


def replace_in_spans(
    df: DataFrame, spans: DataFrame, col: str, target: str, year: str = "RENTREE", source: str | None = None, min_len: int = 4, **how
) -> DataFrame:
    """Replace ``target`` by the value that the code in ``col`` has in the year of the row, when that is long enough. One lookup."""
    found = left_lookup(df, spans, {col: "code"}, {"spans": "__spans"}, unique="trust", **how)
    y = F.col(year).try_cast("int")

    def fits(s: Column) -> Column:
        at = (s["first"] <= y) & (y <= s["last"])
        return at if source is None else at & ((s["source"] == "") | (s["source"] == F.col(source)))

    new = F.try_element_at(F.filter("__spans", fits), F.lit(1))["out"]
    found = found.withColumn("__new", new).drop("__spans")
    return found.withColumn(target, F.when(len_at_least("__new", min_len), F.col("__new")).otherwise(F.col(target))).drop("__new")


def replace_by_key(
    df: DataFrame,
    rules: DataFrame,
    keys: Sequence[str] | Mapping[str, str],
    target: str,
    out: str = "OUT",
    min_len: int = 4,
    **how,
) -> DataFrame:
    """Replace ``target`` by the rule value of the key when that value is long enough."""
    found = left_lookup(df, rules, keys, {out: "__new"}, **how)
    new = F.when(len_at_least("__new", min_len), F.col("__new")).otherwise(F.col(target))
    return found.withColumn(target, new).drop("__new")


def replace_by_sources(df: DataFrame, sheet: DataFrame, **how) -> DataFrame:
    """Three passes over one sheet with blank sources and years as wildcards: by establishment,
    by component, by parent unit. Rules without an establishment are keyed by component."""
    by_etab = span_map(sheet, "IN", source="SOURCE")
    by_comp = span_map(sheet.filter(is_blank("IN")), "COMPOS", source="SOURCE")
    for col, spans in (("ETABLI", by_etab), ("COMPOS", by_comp), ("RATTACH", by_comp)):
        if col in df.columns:
            df = replace_in_spans(df, spans, col, "ETABLI", source="SOURCE", **how)
    return df.drop("RATTACH")


def replace_by_name(
    df: DataFrame, rules: DataFrame, name: str, target: str, keep_unmatched: bool = True, **how
) -> DataFrame:
    """Set ``target`` to the ID of a name. A blank ID keeps the old value; so does an unknown
    name, unless ``keep_unmatched`` is off, which sets NULL."""
    found = left_lookup(df, rules, {name: "IN"}, {"OUT": "__id"}, **how)
    keep = is_blank("__id") if keep_unmatched else eq_true("__id", "")
    return found.withColumn(target, F.when(keep, F.col(target)).otherwise(F.col("__id"))).drop("__id")


def override_tiers(df: DataFrame, tiers: Sequence[tuple], target: str, out: str, **how) -> DataFrame:
    """Overrides from general to specific: each tier is ``(rules, on, condition or None)``; a hit of
    non-zero length replaces ``target``, later tiers win. All conditions read the incoming row."""
    temps = []
    for i, (rules, on, when) in enumerate(tiers):
        df = left_lookup(df, rules, on, {out: f"__o{i}"}, **how)
        temps.append((f"__o{i}", when))
    case = None
    for temp, when in reversed(temps):
        hit = len_at_least(temp, 1) if when is None else len_at_least(temp, 1) & holds(when)
        case = F.when(hit, F.col(temp)) if case is None else case.when(hit, F.col(temp))
    old = F.col(target) if target in df.columns else F.lit(None).cast("string")
    return df.withColumn(target, case.otherwise(old)).drop(*[t for t, _ in temps])


# ---------------------------------------------------------------- literal assignments


def assign_where(df: DataFrame, cond: Column, values: Mapping[str, object]) -> DataFrame:
    """Set several columns where ``cond`` is true, all reading the incoming row."""
    types = dict(df.dtypes)
    mask = holds(cond)
    out = {}
    for col, value in values.items():
        dtype = types.get(col)
        new = value if isinstance(value, Column) else F.lit(value)
        old = F.lit(None) if dtype is None else F.col(col)
        out[col] = F.when(mask, new if dtype is None else new.cast(dtype)).otherwise(old)
    return df.withColumns(out)


def assign_steps(df: DataFrame, steps: Sequence[tuple[Column, Mapping[str, object]]]) -> DataFrame:
    """Ordered assignments: every step sees the earlier ones."""
    for cond, values in steps:
        df = assign_where(df, cond, values)
    return df


def fill_component(df: DataFrame, col: str = "COMPOS", source: str = "ETABLI", min_len: int = 3) -> DataFrame:
    """Take ``source`` where ``col`` is missing or too short."""
    short = F.col(col).isNull() | (F.length(col) < min_len)
    return assign_where(df, F.col(source).isNotNull() & short, {col: F.col(source)})
