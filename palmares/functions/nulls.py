"""One model of missing values, used by every operator.

A text cell is missing when it is NULL or holds one of MISSING_TOKENS. All helpers
return plain Catalyst expressions, so they stay inside generated code.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Texts that mean "no value" in the raw files.
MISSING_TOKENS = ("", "None", "nan", "<NA>")

# What a text strip removes at both ends.
BLANKS = " \t\n\r\x0b\x0c\u00a0"


def as_col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def is_missing(c: Column | str) -> Column:
    """True or false, never NULL: is the text cell missing?"""
    c = as_col(c)
    return c.isNull() | c.isin(*MISSING_TOKENS)


def is_blank(c: Column | str) -> Column:
    """NULL or empty text only."""
    c = as_col(c)
    return c.isNull() | (c == "")


def pd_ne(c: Column | str, value) -> Column:
    """Not-equal where a NULL counts as different.

    Against a literal it is spelled as ``IS NULL OR <>``, which reaches the Parquet
    reader as a pushed filter; against a column, two NULLs are different too.
    """
    c = as_col(c)
    if isinstance(value, Column):
        return ~eq_true(c, value)
    return c.isNull() | (c != F.lit(value))


def eq_true(a: Column | str, b) -> Column:
    """Equality that is false, not NULL, when either side is NULL."""
    b = b if isinstance(b, Column) else F.lit(b)
    return F.coalesce(as_col(a) == b, F.lit(False))


def holds(cond: Column) -> Column:
    """A condition read as a row mask: NULL counts as false."""
    return F.coalesce(cond, F.lit(False))


def strip(c: Column | str) -> Column:
    return F.btrim(as_col(c), F.lit(BLANKS))


def cut_at(c: Column | str, mark: str = ".0") -> Column:
    """Text before the first ``mark``, stripped at both ends."""
    return strip(F.substring_index(as_col(c), mark, 1))


def norm_text(
    c: Column | str,
    cut: str | None = ".0",
    tokens: tuple[str, ...] = ("nan", "None", "<NA>"),
    missing: str | None = None,
) -> Column:
    """Cut at ``cut``, turn whole-cell ``tokens`` into ``missing``, NBSP into a space, strip."""
    text = strip(c) if cut is None else cut_at(c, cut)
    return untoken(text, tokens, missing)


def untoken(text: Column | str, tokens: tuple[str, ...] = ("nan", "None", "<NA>"), missing: str | None = None) -> Column:
    """Second half of ``norm_text``, for a text that is stripped already (NBSP included)."""
    text = as_col(text)
    plain = F.replace(text, F.lit("\u00a0"), F.lit(" "))
    return F.when(text.isin(*tokens), F.lit(missing).cast("string")).otherwise(plain) if tokens else plain
