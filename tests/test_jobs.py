"""The jobs on hand-made facts, with results worked out by hand, and their invariants."""

import json
import random

import pytest
from pyspark.sql import Column, DataFrame, functions as F, types as T

from conftest import values
from palmares.functions.nulls import is_missing, pd_ne
from palmares.operators import derive, rules
from palmares.operators.lookups import small_table
from palmares.operators.schema import beside
from palmares.plans import chain, correct, ingest, publish, verify
from palmares.plans.correct import _all, _is, _source
from palmares.queries import published as P
from palmares.sources.catalogue import catalogue, fact_path, landing_name, missing_partitions, sources_of
from palmares.sources.contracts import FILE_COLUMNS, RAW_COLUMNS, RAW_INTS, columns_mask, contract, file_has, has_intermediate
from palmares.sources.facts import normalise_landing, read_fact, write_fact
from palmares.sources.opendata import read_open_csv, write_open_csv
from palmares.sources.sheets import StoredSheets, read_sheet_folder, read_sheets, write_sheets

SF = "/root/testdata/sf0.001"


def raw(spark, rows):
    cols = ["SOURCE", "RENTREE", *RAW_COLUMNS]
    schema = contract(cols, RAW_INTS).add(FILE_COLUMNS, T.LongType())
    return small_table(spark, [(*(r.get(c) for c in cols), columns_mask(c for c in RAW_COLUMNS if c not in r.get("ABSENT", ()))) for r in rows], schema)


# Outcomes --------------------------------------------------------------------
# The five steps one by one, as the rules state them: what ``correct.outcomes`` must equal.


def outcome_defaults(df: DataFrame) -> DataFrame:
    """Files without outcome columns hold awarded final degrees only."""
    return rules.assign_where(df, ~file_has("RESDIP"), {"RESDIP": "O", "RESINT": "N"})


def read_time_recodes(df: DataFrame) -> DataFrame:
    """Private-sector intermediate types, one discipline, blank intermediate outcome.

    The steps cannot feed each other (a row that gets a type has an outcome already), so
    all of them read the incoming row.
    """
    private = _all(_source("priv"), _is("RESINT", "O"), _is("RESDIP", "N"), _is("NIVEAUR", "02"), is_missing("TYP_DIPINT"))
    discipline = _all(_source("result"), _is("DIPINT", "5000770"), _is("SECTINT", "07"))
    return df.withColumns({
        "TYP_DIPINT": F.when(private & _is("TYP_DIPR", "XA"), F.lit("CP")).when(private & _is("TYP_DIPR", "XB"), F.lit("EP"))
        .otherwise(F.col("TYP_DIPINT")),
        "DISCIPLINT": F.when(discipline, F.lit("11")).otherwise(F.col("DISCIPLINT")),
        "RESINT": F.when(has_intermediate() & is_missing("RESINT") & is_missing("TYP_DIPINT"), F.lit("N"))
        .otherwise(F.col("RESINT")),
    })


def code_outcomes(df: DataFrame) -> DataFrame:
    """How each source states the final and the intermediate outcome."""
    inter = is_missing("DIPINT")
    schools, outside = _source("inge"), _source("mana", "enq", "culture")
    final = (F.when(schools & pd_ne("RESDIP", "N"), F.lit("O"))
             .when(_source("ens"), F.when(inter, F.lit("O")).otherwise(F.lit("N")))
             .when(outside, F.lit("O")).otherwise(F.col("RESDIP")))
    middle = (F.when(_source("ens"), F.when(inter, F.lit("N")).otherwise(F.lit("O")))
              .when(outside, F.lit("")).otherwise(F.col("RESINT")))
    flag = F.when(_source("inge", "ens", "mana", "enq", "culture"), F.lit("0")).otherwise(F.col("FLAG_MEEF"))
    return df.withColumns({"RESDIP": final, "RESINT": middle, "FLAG_MEEF": flag})


def _old_licence() -> Column:
    return _all(_is("RESINT", "O"), _is("TYP_DIPR", "XA"), _is("TYP_DIPINT", "01", "10", "CC", "XA"), _is("NIVEAUR", "02"))


def intermediate_types(df: DataFrame) -> DataFrame:
    """Intermediate type recodes that precede the text clean-up.

    No recode writes a type that another one tests, so one CASE over the incoming row holds
    them all.
    """
    final = has_intermediate() & _is("RESDIP", "O")
    kind = derive.last_wins(F.col("TYP_DIPINT"), [
        (final & _is("TYP_DIPINT", "10"), "CP"),
        (final & _is("TYP_DIPINT", "20"), "EP"),
        (final & is_missing("TYP_DIPINT") & _is("TYP_DIPL", "PE"), "CZ"),
        (has_intermediate() & _old_licence(), "CP"),
    ])
    return df.withColumn("TYP_DIPINT", kind)


def outcome_consistency(df: DataFrame) -> DataFrame:
    """Agreement of outcomes and intermediate type, after the text clean-up.

    The outcome changes only where the type is missing, the type only where it is not, and
    the last step asks for a type: all three read the incoming row.
    """
    both = has_intermediate()
    middle_only = both & _is("RESDIP", "N") & _is("RESINT", "O") & pd_ne("DIPINT", "")
    awarded_twice = _all(both, _is("RESDIP", "O"), _is("RESINT", "O"), ~is_missing("TYP_DIPINT"), ~is_missing("DIPINT"))
    return df.withColumns({
        "TYP_DIPINT": derive.last_wins(F.col("TYP_DIPINT"), [
            (both & _old_licence(), "CP"),
            (middle_only & _is("TYP_DIPINT", "10"), "CP"),
            (middle_only & _is("TYP_DIPINT", "20"), "EP"),
            (both & _is("TYP_DIPINT", "CC") & _is("TYP_DIPR", "XA") & _is("RESINT", "O"), "CP"),
        ]),
        "RESINT": F.when(both & pd_ne("RESINT", "N") & is_missing("TYP_DIPINT"), F.lit("N")).otherwise(F.col("RESINT")),
        "RESDIP": F.when(awarded_twice, F.lit("N")).otherwise(F.col("RESDIP")),
    })


def double_counted_engineers() -> Column:
    """Engineering schools, 2020: two degrees of two schools counted elsewhere."""
    return _all(correct.double_counted_codes(), is_missing("DIPINT"), is_missing("TYP_DIPINT"), ~is_missing("LMDDONT_INT"))


def test_one_projection_equals_the_chain_of_steps(spark):
    """``outcomes`` against the five steps applied in turn, on random combinations of codes."""
    rng = random.Random(3)
    pools = {
        "SOURCE": ["result", "ens", "inge", "priv", "mana", "culture"], "RENTREE": ["2015", "2017", "2019", "2021"],
        "RESDIP": [None, "", "O", "N", "X"], "RESINT": [None, "", "O", "N", "X", "O"], "TYP_DIPL": ["PE", "XA", ""],
        "TYP_DIPR": ["XA", "XB", "PE", "1"], "TYP_DIPINT": [None, "", "nan", "10", "20", "1", "01", "CC", "XA", "EP"],
        "NIVEAUR": ["02", "01", None], "DIPINT": [None, "", "5000770", "8"], "SECTINT": ["07", None], "DISCIPLINT": ["12", None],
        "FLAG_MEEF": ["1", None], "ABSENT": [(), (), ("RESDIP",)],
    }
    rows = [{"IDETU": str(i), **{c: rng.choice(v) for c, v in pools.items()}} for i in range(6000)]
    df = correct.clean_text(raw(spark, rows))
    chain = code_outcomes(read_time_recodes(outcome_defaults(df)))
    chain = outcome_consistency(intermediate_types(chain))
    cols = ["IDETU", "RESDIP", "RESINT", "TYP_DIPINT", "DISCIPLINT", "FLAG_MEEF"]
    step = {r.IDETU: tuple(r) for r in chain.select(*cols).collect()}
    once = {r.IDETU: tuple(r) for r in correct.outcomes(df).select(*cols).collect()}
    different = [(rows[int(i)], step[i], once[i]) for i in step if step[i] != once[i]]
    assert not different, different[:2]


def test_suppression_in_short_form_equals_the_full_one(spark):
    """Once final degrees are blanked and groups filled, the short test finds the same rows."""
    df = spark.createDataFrame(
        [(s, d, i, k, e, t, g) for s in ("inge", "priv") for d in ("O", "N") for i in ("N", "O", "X") for k in ("2500203", "1")
         for e in ("0597131F", "x") for t in ("", "CP") for g in ("AUTRES", "A")],
        "SOURCE string, RESDIP string, RESINT string, DIPLOM string, ETABLI_ORI_UAI string, TYP_DIPINT string, LMDDONT_INT string")
    df = df.withColumns({"RENTREE": F.lit("2020"), "DIPINT": F.col("TYP_DIPINT")})
    blank = (F.col("RESDIP") == "O") & F.col("RESINT").isin("N", "X")
    df = df.withColumns({c: F.when(blank, "").otherwise(F.col(c)) for c in ("TYP_DIPINT", "DIPINT")})
    assert df.filter(correct.double_counted_codes() != double_counted_engineers()).count() == 0


# Correction ------------------------------------------------------------------

BASE = {"DIPLOMR": "2217000", "COMPOSR": "0755555A", "ETABLI": "0750001A", "SECTDISR": "5", "DISCIPLR": "1", "NIVEAU": "7", "NIVEAUR": "3",
        "CURSUS_LMDR": "L", "BAC": "ES", "BAC_RGRP": "1", "ANBAC": 2015, "ANNAIS": 1997, "NATION": "100", "FR_ETR": "1", "SEXE": "1",
        "DEPBAC": "075", "ACABAC": "01", "NUMED": "0123", "TYP_DIPR": "XA", "RESDIP": "O", "RESINT": "N"}
RAW = [
    {**BASE, "IDETU": "A", "SOURCE": "result", "RENTREE": "2019", "SECTDISR": "2A"},
    {**BASE, "IDETU": "A2", "SOURCE": "result", "RENTREE": "2019", "SECTDISR": "2A"},
    {**BASE, "IDETU": "B", "SOURCE": "priv", "RENTREE": "2020", "RESDIP": "N", "RESINT": "O", "TYP_DIPR": "XB", "NIVEAUR": "02", "TYP_DIPINT": "", "ABSENT": ("DEPBAC", "CONV")},
    {**BASE, "IDETU": "C", "SOURCE": "culture", "RENTREE": "2019", "RESDIP": None, "RESINT": None, "NIVEAUR": None, "BAC": None, "BAC_RGRP": None,
     "ANBAC": None, "NATION": "", "DEPBAC": None, "ACABAC": None, "ABSENT": ("RESDIP", "NIVEAUR", "DEPBAC", "ACABAC", "DEPRESPA", "CONV")},
    {**BASE, "IDETU": "D", "SOURCE": "result", "RENTREE": "2019", "FLAG_DIP": "1"},
    {**BASE, "IDETU": "E", "SOURCE": "result", "RENTREE": "2019", "RESDIP": "N"},
    {**BASE, "IDETU": "F", "SOURCE": "result", "RENTREE": "2019", "DIPLOMR": "None", "TYP_DIPR": "99", "DIPINT": "nan"},
    {**BASE, "IDETU": "G", "SOURCE": "inge", "RENTREE": "2020", "DIPLOMR": "2500203", "ETABLI": "0597131F"},
    {**BASE, "IDETU": "H", "SOURCE": "inge", "RENTREE": "2020", "DIPLOMR": "6000361", "TYP_DIPR": "99"},
    {**BASE, "IDETU": "I", "SOURCE": "result", "RENTREE": "2019", "DIPLOMR": "DEL"},
    {**BASE, "IDETU": "J", "SOURCE": "result", "RENTREE": "2019", "ETATINS": "41"},
]

SHEET_COLUMNS = {
    "deleter": "RENTREE SOURCE DIPLOM ETABLI ETABLI_ORI_UAI ETABLI_DIFFUSION", "ETABLI": "IN OUT RENTREE_START RENTREE_END",
    "A_UAI": "RENTREE SOURCE ETABLI TYPE ID_PAYSAGE", "D_EPE": "RENTREE ID_PAYSAGE ID_PAYSAGE_EPE", "ETABLI_DIFFUSION_ID": "IN OUT",
    "COMINS": "TYP_DIPL COMPOS RENTREE IN OUT", "COMETAB": "ETABLI ID_PAYSAGE RENTREE IN OUT", "COMUI": "IN COMPOS RENTREE OUT",
    "DEP_ACA_RESPA_CORRECTIF": "RENTREE VAR_IN VALUE_IN VAR_OUT VALUE_OUT", "FORMATIONS_CORRECTIF": "TYP_DIPL_IN DIPLOM_IN SECTDIS_OUT",
    **{s: "VAR1_IN VALUE1_IN VAR2_IN VALUE2_IN VAR_OUT VALUE_OUT" for s in
       ("RESTE_DEPRESPA_CORRECTIF", "DEP_CORRECTIF", "ACA_CORRECTIF", "GROUPE_CORRECTIF")},
    "CORRLMD": "TYP_DIPL CURSUS_LMD_OUT", "CURSUS_LMD_CORRECTIF": "TYP_DIPL DIPLOM NIVEAU CURSUS_LMD_OUT",
    "LES_COMMUNES": "COM_CODE COM_NOM DEP_ID DEP_NOM ACA_ID ACA_NOM REG_ID REG_NOM UUCR_ID UUCR_NOM",
    "H_PROXIMITE": "DEPARTEMENT_UI DEPARTEMENT_PARENTS PROXIMIT_ PROX_R_GIONS OUTREMER",
    "G_PAYS": "PAYS CONTINENT UE_28 UE_27 UE_EURO OCDE_MEMBRES OCDE_OBS BOLOGNE BRICS", "L_ED": "NUMED ID_PAYSAGE_ED",
    "M_IUT": "RENTREE UR UI ID_PAYSAGE_IUT ID_PAYSAGE_IUT_CAMPUS ID_PAYSAGE_IUT_POLE", "N_ING": "RENTREE UR UI ID_PAYSAGE_ING ID_PAYSAGE_ING_CAMPUS",
    "J_LMDDONT": "TYP_DIPL LMDDONT LMDDONTBIS", "I_DNDU": "TYP_DIPL DNDU", "O_DUTBUT": "DIPLOM CORRESPONDANCEIUT SPECIUT OPTIUT PARCOURSBUT",
    "DISCIPLINES_SISE": "SECTDIS GDDISC", "DEPTOREG": "IN OUT", "DEPTOREGNEW": "IN OUT",
    "C_ETABLISSEMENTS": "ID_PAYSAGE ID_PAYSAGE_ACTUEL UO_LIB TYPE TYPOLOGIE_D_UNIVERSITES_ET_ASSIMILES ANCIENS_CODES_UAI IDENTIFIANT_WIKIDATA "
                        "IDENTIFIANT_ROR OPERATEUR_LOLF_150 COM_CODE",
    "E_FORM_ENS": "ID_PAYSAGE UO_LIB", "F_RENTREES": "RENTREE ANNEE_UNIVERSITAIRE", "SEXE": "SEXE SEXE_LIB", "BAC_RGRP": "BAC_RGRP BAC BAC_LIB BAC_RGP",
    "AVANCE_RETARD": "AVANCE_RETARD BAC_AGE BAC_AGE_LIB", "ATTRAC_INTERN": "ATTRAC_INTERN ATTRAC_INTERN_LIB", "DNDU": "DNDU DN_DE DN_DE_LIB",
    "CURSUS_LMD": "CURSUS_LMD CURSUS_LMD_LIB", "LMDDONTBIS": "LMDDONTBIS DIPLOME DIPLOME_RGP DIPLOME_LIB",
    "SECTDIS": "SECTDIS " + " ".join(publish.SECTOR_ATTRIBUTES), "SPECIUT": "SPECIUT SPEC_IUT SPEC_IUT_LIB SPEC_IUT_RGP_LIB",
}
SHEET_ROWS = {
    "deleter": [("2019", "result", "DEL", "", "", "")],
    "A_UAI": [("2019", "result", "0750001A", "inscri", "P1")],
    "D_EPE": [("2019", "P1", "EPE9")],
    "COMINS": [("rien", "rien", "rien", "75056", "75101")],
    "FORMATIONS_CORRECTIF": [("XA", "2217000", "31")],
    "CORRLMD": [("XA", "L"), ("EP", "X")],
    "LES_COMMUNES": [("75101", "Paris 1er", "D075", "Paris", "A01", "Paris", "R11", "Ile-de-France", "UU1", "Paris")],
    "H_PROXIMITE": [("075", "075", "1 - dep", "1 - reg", "metropole")],
    "G_PAYS": [("100", "Europe", *"1101111"), ("999", "", *"0000000")],
    "L_ED": [("123", "ED1")],
    "C_ETABLISSEMENTS": [("EPE9", "EPE9", "Université E", "Université", "Tout", "0750001A", "Q1", "R1", "O", "75101"),
                         ("P1", "EPE9", "Université P", "Université", "Tout", "0750002B", "Q2", "R2", "N", "75101")],
    "F_RENTREES": [("2019", "2019-20"), ("2020", "2020-21")], "SEXE": [("M", "Homme"), ("F", "Femme")],
    "BAC_RGRP": [("A", "BA", "Général", "Général")], "AVANCE_RETARD": [("NN", "a", "À l'heure")],
}


@pytest.fixture(scope="module")
def sheets(spark):
    return {n: small_table(spark, SHEET_ROWS.get(n, []), ", ".join(f"{c} string" for c in cols.split())) for n, cols in SHEET_COLUMNS.items()}


@pytest.fixture(scope="module")
def corrected(spark, sheets):
    parents = small_table(spark, [("2019", "0755555A", "0759999Z")], "RENTREE string, COMPOS string, RATTACH string")
    seats = small_table(spark, [("2019", "0755555A", "75056")], "RENTREE string, UAI string, COMCODE string")
    return correct.correct_table(spark, raw(spark, RAW), sheets, parents, seats).cache()


def test_rows_that_leave(corrected):
    assert values(corrected, "IDETU") == [("A",), ("A2",), ("B",), ("C",), ("H",)]


@pytest.mark.parametrize("row, want", [
    ("A", {"SECTDIS": "31", "DISCIPLI": "04", "NIVEAU": "03", "BAC_RGRP": "A", "AGE_BAC": "18", "RETARD": "N", "AVANCE": "N", "NUMED": "123",
           "ETABLI_ORI_UAI": "0750001A", "ID_PAYSAGE": "EPE9", "ID_PAYSAGE_EPE_ETAB_COMPOS": "P1", "RATTACH": "0759999Z", "UI": "0755555A",
           "COMINS": "75101", "COMUI": "75101", "COMETAB": "", "DEPINS": "075", "UUCRINS": "UU1", "PROXBAC": "1 - dep", "PROXREGBAC": "1 - reg",
           "OUTREMER": "metropole", "CURSUS_LMD": "L", "LMDDONT": "AUTRES", "LMDDONTBIS": "LIC_L_AUT", "DNDU": "DN", "DNDU_INT": "DN",
           "TYP_DIPINT": "", "LMDDONTBIS_INT": "", "EFFECTIF_R": 1, "EFFECTIF_INT": 0, "EFFECTIF_TOT": 1, "MOBINTERN": "X", "NATION_VRAI": "F",
           "UE_27": 1, "UE_EURO": 0, "ID_PAYSAGE_ED": "", "SESSION": "2020", "ANNEE_UNIVERSITAIRE": "2019-20", "SPECIUT": "AUTRES", "REGIME": "99"}),
    ("B", {"RESDIP": "N", "RESINT": "O", "TYP_DIPINT": "EP", "CURSUS_LMD_INT": "M", "EFFECTIF_R": 0, "EFFECTIF_INT": 1, "FLAG_MEEF": "1",
           "EFF_SS_ESPE": 0, "ID_PAYSAGE": "", "RATTACH": "0755555A", "COMINS": "", "COMUI": "", "DEPBAC": "", "PROXBAC": "5 - NR"}),
    ("C", {"RESDIP": "O", "RESINT": "", "NIVEAU": "07", "BAC": "9999", "BAC_RGRP": "7", "NATION": "999", "RETARD": "X", "AVANCE": "X",
           "PROXBAC": "9 - non-bachelier", "OUTREMER": "non-bachelier", "DNDU_INT": "", "TYP_DIPINT": "", "FLAG_MEEF": "0", "AGE_BAC": ""}),
    ("H", {"CURSUS_LMDR": "M", "SECTDIS": "16", "DISCIPLI": "15", "TYP_DIPL": "FI"}),
])
def test_corrected_rows(corrected, row, want):
    got = corrected.filter(F.col("IDETU") == row).first().asDict()
    assert {c: got[c] for c in want} == want


def test_no_text_is_null_at_the_end(corrected):
    texts = [c for c, t in corrected.dtypes if t == "string" and c not in ("EFF_SS_ESPE",)]
    nulls = corrected.select(*[F.count_if(F.col(c).isNull()).alias(c) for c in texts]).first().asDict()
    assert not {c for c, n in nulls.items() if n}


def test_correction_never_shuffles_the_facts(spark, sheets):
    """The plan over stored facts has exchanges only under broadcast sides."""
    root = P.work_dir(spark, "facts")
    write_fact(correct.normalise(raw(spark, RAW)), root)
    none = small_table(spark, [], "RENTREE string, COMPOS string, RATTACH string")
    seats = small_table(spark, [], "RENTREE string, UAI string, COMCODE string")
    plan = correct.correct(read_fact(spark, root), sheets, none, seats)._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan and "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_lookups_carry_only_the_columns_they_use(spark, sheets):
    """Columns that no lookup reads pass all lookups of a step in one value; deletions, which copy no row, come before."""
    root = P.work_dir(spark, "facts")
    write_fact(correct.normalise(raw(spark, RAW)), root)
    none = small_table(spark, [], "RENTREE string, COMPOS string, RATTACH string")
    seats = small_table(spark, [], "RENTREE string, UAI string, COMCODE string")
    plan = correct.correct(read_fact(spark, root), sheets, none, seats)._jdf.queryExecution().optimizedPlan()
    widths, todo = [], [plan]
    while todo:
        node = todo.pop()
        if node.nodeName() == "Join":
            widths.append(node.output().size())
        todo += [node.children().apply(i) for i in range(node.children().size())]
    assert sum(w > 60 for w in widths) <= len(correct.DELETE_SHAPES) and sorted(widths)[len(widths) // 2] < 40
    assert "__rest" not in correct.correct(read_fact(spark, root), sheets, none, seats).columns


def test_beside_keeps_rows_columns_and_order(frame):
    df = frame([("1", "2", "3", "4"), (None, None, None, None)], "a string, b string, c string, d string")
    out = beside(df, ["b", "absent"], lambda d: d.withColumns({"new": F.concat("b", F.lit("!")), "b": F.lit("x")}))
    assert out.columns == ["a", "b", "c", "d", "new"]
    assert values(out) == sorted([("1", "x", "3", "4", "2!"), (None, "x", None, None, None)], key=repr)
    with pytest.raises(ValueError, match="duplicate"):
        beside(df, ["b"], lambda d: d.withColumn("c", F.lit("x")))


# Publication -----------------------------------------------------------------


def test_published_row(corrected, sheets):
    rows = publish.publish(corrected, sheets).collect()
    assert len(rows) == 1 and len(rows[0]) == 83
    got = rows[0].asDict()
    assert got["Nombre de diplômes délivrés"] == 2 and got["Nombre total de diplômes délivrés"] == 2
    assert got["Nombre de diplômes délivrés UE27"] == 2 and got["Etablissement"] == "Université E"
    assert got["Décomposition des universités"] == "Université P" and got["Sexe de l'étudiant"] == "Homme"
    assert got["Localisation de l'unité d'inscription"] == "Ile-de-France>Paris>Paris 1er"
    assert got["Localisation du siège de l'établissement"] is None and got["Age au baccalauréat"] == "À l'heure"


def test_labels_are_not_grouped(spark):
    """Rows of labels are ten times as wide as rows of codes: no sum holds or shuffles them."""
    todo, widths = [publish.publish(P.corrected(spark, SF), P.reference_tables(spark, SF), names=False)._jdf.queryExecution().optimizedPlan()], {}
    while todo:
        node = todo.pop()
        widths.setdefault(node.nodeName(), []).append(node.output().size())
        todo += [node.children().apply(i) for i in range(node.children().size())]
    assert max(widths["Aggregate"]) < 40 and widths["RebalancePartitions"] and max(widths["RebalancePartitions"]) < 40


def test_codes_of_one_label_are_one_row(spark, frame, sheets):
    """Codes that share every label of their list merge; unlisted codes, codes without labels and NULL are one."""
    lists = {**sheets, "SPECIUT": frame([("a", "x", "y", "z"), ("b", "x", "y", "z"), ("c", "x", "y", "w"), ("d", None, None, None)], "SPECIUT string, SPEC_IUT string, SPEC_IUT_LIB string, SPEC_IUT_RGP_LIB string")}
    keys = [k for k in publish.ROLLUP_KEYS if k not in publish.UNPUBLISHED]
    schema = ", ".join([f"{k} string" for k in keys] + [f"{m} bigint" for m in publish.MEASURES])
    rows = [tuple(code if k == "SPECIUT" else "1" for k in keys) + (n,) * len(publish.MEASURES) for code, n in [("a", 1), ("b", 2), ("b", 4), ("c", 8), ("d", 16), ("e", 32), (None, 64)]]
    got = publish.labelled_sums(frame(rows, schema), lists)
    assert values(got, "SPEC_IUT_RGP_LIB", "EFFECTIF_R") == [("w", 8), ("z", 7), (None, 112)]


def test_published_names():
    assert len(publish.PUBLISHED_KEYS) == len(set(publish.PUBLISHED_KEYS)) == 76
    assert len(publish.PUBLISHED_NAMES) == 82 == len({v.lower() for v in publish.PUBLISHED_NAMES.values()})
    assert set(publish.PUBLISHED_NAMES) | {"ATTRAC_INTERN"} == {*publish.PUBLISHED_KEYS, *publish.MEASURES}
    assert len(publish.CUBE_KEYS) + len(publish.CUBE_FLAGS) == 41 and len(publish.ROLLUP_KEYS) == 36


def test_two_cubes_equal_one_and_keep_the_headcounts(spark):
    df = P.corrected(spark, SF)
    two = publish.resum(publish.second_cube(publish.first_cube(df)), ["RENTREE", "SEXE", "AVANCE_RETARD"], publish.MEASURES)
    one = publish.resum(publish.code_sums(df), ["RENTREE", "SEXE", "AVANCE_RETARD"], publish.MEASURES)
    assert values(one) == values(two)
    total = df.agg(F.sum("EFFECTIF_TOT")).first()[0]
    assert one.agg(F.sum("EFFECTIF_TOTAL")).first()[0] == total


def test_labels_do_not_change_the_number_of_rows(spark):
    sums = publish.code_sums(P.corrected(spark, SF))
    tables = P.reference_tables(spark, SF)
    assert publish.label(publish.star(sums, tables), tables).count() == sums.count()


def test_one_call_from_landed_files_to_csv(spark, sheets, tmp_path):
    """The steps chained over landed files give the published row of the steps called one by one; a repeat lands nothing."""
    landing, root = str(tmp_path / "in"), str(tmp_path / "out")
    for source in sources_of(2019):
        rows = raw(spark, [r for r in RAW if (r["SOURCE"], r["RENTREE"]) == (source, "2019")])
        rows.select(*[F.col(c).alias(c.lower()) for c in RAW_COLUMNS]).write.parquet(f"{landing}/{landing_name(source, 2019)}")
    parents = small_table(spark, [("2019", "0755555A", "0759999Z")], "RENTREE string, COMPOS string, RATTACH string")
    seats = small_table(spark, [("2019", "0755555A", "75056")], "RENTREE string, UAI string, COMCODE string")
    steps = publish.publish(correct.correct_table(spark, raw(spark, [r for r in RAW if r["RENTREE"] == "2019"]), sheets, parents, seats), sheets)
    want = sorted(tuple(None if c in (None, "") else str(c) for c in r) for r in steps.collect())
    for _ in range(2):
        csv = chain.run(spark, landing, root, sheets, parents, seats, years=[2019])
        got = read_open_csv(spark, csv)
        assert got.columns == steps.columns and sorted(tuple(r) for r in got.collect()) == want and len(want) == 1
    assert ingest.wanted_partitions(spark, ingest.landed(spark, f"{root}/raw"), [2019]) == [(s, 2019) for s in sources_of(2019) if s not in {r["SOURCE"] for r in RAW if r["RENTREE"] == "2019"}]


# Sources and verification ------------------------------------------------------


def test_catalogue_and_names(spark):
    assert sources_of(2016) == ["result", "ens", "inge", "priv"] and len(sources_of(2019)) == 7
    with pytest.raises(ValueError):
        sources_of(2014)
    assert catalogue(spark).count() == 38
    assert [landing_name(s, 2019) for s in ("result", "enq", "ens")] == ["result19_ssa.parquet", "dipenq26bis19_ssa.parquet", "dipens19_ssa.parquet"]
    assert landing_name("enq", 2019, corrected=True) == "corrected_dipenq26bis2019_ssa.parquet"
    assert fact_path("/x/", "ens", 2019) == "/x/SOURCE=ens/RENTREE=2019"
    assert missing_partitions(catalogue(spark), catalogue(spark, [2015, 2016])).count() == 30


def test_landing_writes_only_what_is_missing(spark, tmp_path):
    landing, root = str(tmp_path / "in"), str(tmp_path / "out")
    for source in sources_of(2015):
        spark.createDataFrame([(2015.0, " x.0 ", "nan")], "anbac double, Bac string, sexe string").write.parquet(f"{landing}/{landing_name(source, 2015)}")
    assert ingest.land_missing(spark, landing, root, years=[2015], columns=("ANBAC", "BAC", "SEXE", "NBACH")) == 4
    got = read_fact(spark, root, ["ens"], [2015])
    assert values(got, "ANBAC", "BAC", "SEXE", "NBACH", "RENTREE") == [(2015, "x", "", None, "2015")]
    assert ingest.land_missing(spark, landing, root, years=[2015]) == 0
    with pytest.raises(Exception, match="PATH_NOT_FOUND|does not exist"):
        ingest.land_missing(spark, landing, root, years=[2016])


def test_partition_filter_prunes(spark, tmp_path):
    root = str(tmp_path / "f")
    write_fact(spark.createDataFrame([("ens", "2015", 1), ("priv", "2016", 2)], "SOURCE string, RENTREE string, k int"), root)
    df = read_fact(spark, root, ["priv"], [2016], contract(["k"], ["k"]))
    assert "PartitionFilters: [isnotnull(RENTREE" in df._jdf.queryExecution().executedPlan().toString() or df.count() == 1
    write_fact(spark.createDataFrame([("ens", "2015", 9)], "SOURCE string, RENTREE string, k int"), root)
    assert values(read_fact(spark, root), "k", "RENTREE") == [(2, "2016"), (9, "2015")]


def test_sheets_json(spark, tmp_path):
    doc = tmp_path / "correctifs.json"
    doc.write_text('{"SEXE": [{"sexe": "1.0", "Sexe_lib": " Homme "}, {"sexe": "1", "Sexe_lib": "Homme"}, {"sexe": "2"}], "DNDU": [{"dndu": "DU"}]}')
    got = read_sheets(spark, str(doc))
    assert values(got["SEXE"], "SEXE", "SEXE_LIB") == [("1", "Homme"), ("2", "")] and got["DNDU"].count() == 1
    write_sheets(got, str(tmp_path / "out"))
    back = read_sheet_folder(spark, str(tmp_path / "out"), ["SEXE", "DNDU"])
    assert values(back["SEXE"], "SEXE", "SEXE_LIB") == [("1", "Homme"), ("2", "")]


def test_open_csv_round_trip(spark, tmp_path):
    df = spark.createDataFrame([("2019", 'a;"b"', None), ("2020", " x ", "é")], "rentree string, `Libellé` string, n string")
    write_open_csv(df, str(tmp_path / "od"), year="rentree")
    assert values(read_open_csv(spark, str(tmp_path / "od"))) == [("2019", 'a;"b"', None), ("2020", " x ", "é")]
    assert values(read_open_csv(spark, str(tmp_path / "od" / "year_folder=2020"))) == [("2020", " x ", "é")]


def test_landing_text(frame):
    df = normalise_landing(frame([(" 12.0", 3.0, "a b", "nan")], "b string, a double, c string, d string"))
    assert df.columns == ["A", "B", "C", "D"] and values(df) == [(3, "12", "a b", "")]


def test_verification(corrected, sheets):
    again = verify.reread(corrected.select("SOURCE", "RESDIP", "RESINT", "TYP_DIPL", "TYP_DIPINT", "NIVEAU", "CURSUS_LMDR", "CURSUS_LMD_INT", "ID_PAYSAGE"))
    combos = verify.combinations(again)
    assert combos.columns == sorted(combos.columns) and combos.count() == 4
    assert verify.entities(sheets).columns == sorted(verify.ENTITY_COLUMNS)


def test_sheets_keep_the_order_of_the_document(spark, tmp_path):
    """Rules apply in the order of the sheet: of equal rows the first place counts, in every way of reading."""
    records = [{"VAR1_IN": "t", "VALUE1_IN": str(i % 40), "VAR2_IN": "", "VALUE2_IN": "", "VAR_OUT": "t", "VALUE_OUT": str((i * 7 + 1) % 40)} for i in range(120)]
    (tmp_path / "whole.json").write_text(json.dumps({"DEP_CORRECTIF": records}))
    (tmp_path / "lines.json").write_text("\n".join(json.dumps({"DEP_CORRECTIF": [r]}) for r in records))
    first = list({tuple(r.values()): r for r in reversed(records)}.values())[::-1]
    want = list({tuple(r.values()): r for r in records}.values())
    assert len(first) == len(want) == 40
    for name, whole in (("whole", True), ("lines", False)):
        sheets = read_sheets(spark, str(tmp_path / f"{name}.json"), whole=whole)
        assert rules.all_records(sheets, ["DEP_CORRECTIF"])["DEP_CORRECTIF"] == want
        write_sheets(sheets, str(tmp_path / f"sheets-{name}"))
        again = read_sheet_folder(spark, str(tmp_path / f"sheets-{name}"), ["DEP_CORRECTIF"])
        assert rules.all_records(again, ["DEP_CORRECTIF"])["DEP_CORRECTIF"] == want


def test_stored_sheets_are_written_once(spark):
    made = spark.range(20).groupBy((F.col("id") % 5).cast("string").alias("K")).agg(F.max(F.col("id").cast("string")).alias("V"))
    local = small_table(spark, [("a",)], "K string")
    sheets = StoredSheets({"A": made, "B": local}).ahead()
    assert sheets["A"] is sheets["A"] and sheets["A"] is not made and sheets["B"] is local
    assert values(sheets["A"]) == values(made) and set(sheets) == {"A", "B"} and StoredSheets(sheets)["A"] is sheets["A"]
