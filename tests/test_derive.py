import itertools

import pytest
from pyspark.sql import functions as F

from conftest import values
from palmares.operators import derive as D


def brute_late_early(year, group, bac, anbac, annais):
    """Step by step, as the rules are written."""
    if group in (None, "") and bac in ("0031", "0032"):
        group = "7"
    age = None if anbac is None or annais is None else anbac - annais
    late = early = None
    known = age is not None
    if year < 2012:
        if group in ("1", "2", "3", "4", "5") and known:
            late, early = ("O" if age > 18 else "N"), ("O" if age < 18 else "N")
        if group == "6" and known:
            late, early = ("O" if age > 19 else "N"), ("O" if age <= 18 else "N")
        if anbac is None or group in ("7", "9"):
            late = early = "X"
    else:
        counted = group in ("1", "2", "3", "4", "5", "6", "A")
        if counted and known:
            late, early = ("O" if age > 18 else "N"), ("O" if age < 18 else "N")
        if anbac is None or not counted:
            late = early = "X"
    if group == "9" and anbac is None:
        group = "7"
    return age, group, late, early


def test_late_early_grid(frame):
    rows = []
    grid = itertools.product([2010, 2011, 2012, 2015], ["1", "5", "6", "7", "9", "A", "", None], ["0031", "0500"],
                             [2000, None], [1983, 1982, 1981, 1980, None])
    for i, (y, g, bac, anbac, annais) in enumerate(grid):
        rows.append((i, str(y), g, bac, anbac, annais))
    df = frame(rows, "i int, RENTREE string, BAC_RGRP string, BAC string, ANBAC bigint, ANNAIS bigint")
    got = {r.i: (r.AGE_BAC, r.BAC_RGRP, r.RETARD, r.AVANCE) for r in D.late_early(df).collect()}
    for i, y, g, bac, anbac, annais in rows:
        assert got[i] == brute_late_early(int(y), g, bac, anbac, annais), (y, g, bac, anbac, annais)


def test_degree_group_priority(frame):
    cols = "DIPLOM string, TYP_DIPL string, PAR_TYPE string, DNDU string, LMDDONT string, LMDDONTBIS string"
    df = frame([
        ("1", "XA", "0001291", "DU", "L", "B"), ("1", "XA", None, "DN", "L", "B"), ("6001000", "ZZ", "", "DN", "L", "B"),
        ("6001000", "XA", "", "DN", "L", "B"), ("9610007", "61", "", "DU", "", None), ("1", "ZZ", "", "DU", None, "B"), ("1", "ZZ", "", "DN", None, ""),
    ], cols)
    assert [(r.LMDDONT, r.LMDDONTBIS) for r in D.degree_group(df).collect()] == [
        ("L", "LIC_L_LAS"), ("L", "LIC_L_AUT"), ("AUTRES", "AUTRES"), ("AUTRES", "LIC_L_AUT"), ("AUTRES", "REBOND"), ("AUTRES", "DU"), ("AUTRES", "AUTRES")]


def test_mobility_negations_count_null_as_different(frame):
    df = frame([("100", "00", "0031"), (None, "00", None), ("350", None, None), ("350", "01", "0031"), ("350", "01", "0500")],
               "NATION string, ACABAC string, BAC string").withColumns(
        {c: F.lit(None).cast("string") for c in ("FR_ETR", "BAC_RGRP", "DNDU", "TYP_DIPL", "CURSUS_LMD")})
    assert [r.MOBINTERN for r in D.mobility(df).collect()] == ["X", "M", "X", "M", "X"]


@pytest.mark.parametrize("group, place, want", [
    ("7", None, "9 - non-bachelier"), ("9", "075", "5 - NR"), ("1", "000", "5 - NR"), (None, "", "5 - NR"), ("1", "075", None)])
def test_proximity(frame, group, place, want):
    df = frame([(group, place, None, None, None)], "BAC_RGRP string, DEPBAC string, PROXBAC string, PROXREGBAC string, OUTREMER string")
    assert values(D.proximity_fix(df), "PROXBAC") == [(want,)]


def test_headcounts(frame):
    df = frame([("O",), ("1",), ("N",), ("None",), (None,), ("X",)], "r string")
    assert [r.v for r in df.select(D.headcount("r").alias("v")).collect()] == [1, 1, 0, 0, 0, 0]
