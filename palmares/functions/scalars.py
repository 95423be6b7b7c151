"""Scalar functions on codes, years and labels. All are built-in expressions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, functions as F

from .nulls import as_col, eq_true, is_missing


def zero_pad(c: Column | str, width: int = 2) -> Column:
    """Left-pad a code of exactly one ASCII digit."""
    c = as_col(c)
    return F.when(c.rlike("^[0-9]$"), F.lpad(c, width, "0")).otherwise(c)


def strip_zero(c: Column | str, outside: str = "HORS") -> Column:
    """Remove one leading zero; the ``outside`` marker becomes an empty text."""
    cut = F.regexp_replace(as_col(c), "^0", "")
    return F.when(cut == outside, F.lit("")).otherwise(cut)


def recode(c: Column | str, mapping: dict[str, str], default: Column | None = None) -> Column:
    """Exact recoding as one flat CASE; values outside the map keep ``default`` (or themselves)."""
    c = as_col(c)
    sources: dict[str, list[str]] = {}
    for old, new in mapping.items():
        sources.setdefault(new, []).append(old)
    branches = list(sources.items())
    if not branches:
        return c if default is None else default
    first_new, first_old = branches[0]
    case = F.when(c.isin(*first_old), F.lit(first_new))
    for new, old in branches[1:]:
        case = case.when(c.isin(*old), F.lit(new))
    return case.otherwise(c if default is None else default)


def default_missing(c: Column | str, value: str) -> Column:
    c = as_col(c)
    return F.when(is_missing(c), F.lit(value)).otherwise(c)


def suffix_code(c: Column | str, codes: tuple[str, ...], tail: str = "5", full: str = "-85") -> Column:
    """Complete a truncated two-part code: append ``tail`` after a dash, else ``full``."""
    c = as_col(c)
    done = F.when(c.contains("-"), F.concat(c, F.lit(tail))).otherwise(F.concat(c, F.lit(full)))
    return F.when(c.isin(*codes), done).otherwise(c)


def prefix(c: Column | str, n: int, start: int = 1) -> Column:
    return F.substring(as_col(c), start, n)


def len_at_least(c: Column | str, n: int) -> Column:
    """Length test that is false for NULL."""
    return F.coalesce(F.length(as_col(c)) >= n, F.lit(False))


def _next_year(y: Column) -> Column:
    return (y.cast("int") + 1).cast("string")


def academic_year(y: Column | str) -> Column:
    """``2019`` to ``2019-20``."""
    y = as_col(y)
    return F.concat(y.cast("string"), F.lit("-"), F.substring(_next_year(y), 3, 2))


def session(y: Column | str) -> Column:
    """``2019`` to ``2020``: the year in which the degree is awarded."""
    return _next_year(as_col(y))


def join_codes(*cols: Column | str) -> Column:
    """Concatenation; NULL as soon as one part is NULL."""
    return F.concat(*[as_col(c) for c in cols])


def breadcrumb(*levels: Column | str, sep: str = ">") -> Column:
    """Path from the widest to the narrowest place; a level equal to its parent is left out.

    Each level contributes one piece, so the expression grows with the number of
    levels only. A NULL level makes the whole path NULL.
    """
    cols = [as_col(c) for c in levels]
    pieces = [cols[0]]
    for parent, child in zip(cols, cols[1:]):
        pieces.append(F.when(eq_true(parent, child), F.lit("")).otherwise(F.concat(F.lit(sep), child)))
    return F.concat(*pieces)


def yes_no(c: Column | str, yes: str = "O") -> Column:
    return F.when(as_col(c) == yes, F.lit("Oui")).otherwise(F.lit("Non"))


def diff_int(a: Column | str, b: Column | str) -> Column:
    return as_col(a).cast("bigint") - as_col(b).cast("bigint")


def total(*cols: Column | str) -> Column:
    return reduce(lambda a, b: a + b, [as_col(c) for c in cols])


def year_range(start: Column | str, end: Column | str, first: int, last: int) -> Column:
    """Inclusive years as texts; an empty start means every year from ``first`` to ``last``, those of the facts."""
    start, end = as_col(start), as_col(end)
    every = F.sequence(F.lit(first), F.lit(last))
    lo, hi = start.cast("int"), end.cast("int")
    span = F.when(lo <= hi, F.sequence(lo, hi)).otherwise(F.array().cast("array<int>"))
    return F.when(is_missing(start), every).otherwise(span).cast("array<string>")


def flatten_lists(c: Column | str) -> Column:
    return F.flatten(as_col(c))


def json_map(c: Column | str) -> Column:
    """A JSON object of scalars as a map of texts."""
    return F.from_json(as_col(c), "map<string,string>")


def json_rows(c: Column | str) -> Column:
    """A JSON array of flat records as an array of maps of texts."""
    return F.from_json(as_col(c), "array<map<string,string>>")
