"""Correction job: raw facts of all sources and years to corrected, enriched facts.

Two lazy plans over one table partitioned by (SOURCE, RENTREE): ``normalise`` and
``correct``, with a written table between them. No step shuffles the facts: rules are
projections or lookups, and the sheets are small enough to broadcast (checked). Steps that
depend on the source are conditions on SOURCE, not loops.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from ..functions.nulls import cut_at, holds, is_blank, is_missing, pd_ne, untoken
from ..functions.scalars import default_missing, diff_int, recode, strip_zero, suffix_code, zero_pad
from ..operators import derive, rule_tables, rules
from ..operators.filters import delete_by_rules, exclude, if_any, keep_positive, remove_where
from ..operators.lookups import coalesced_lookup, country_lookup, left_lookup, role_lookup, tiered_lookup
from ..operators.schema import add_defaults, add_nulls, beside, finalise_types, flag_text, rename_present, swap_columns, with_provenance
from ..session import work_dir
from ..sources.contracts import COUNTRY_FLAGS, FILE_COLUMNS, RAW_COLUMNS, RAW_INTS, file_has, has_intermediate, with_file_columns
from ..sources.facts import PARTITIONS, read_fact, write_fact
from ..sources.sheets import StoredSheets

# Codes named by the cleaning steps.
SHORT_BAC_CODES = ("A2-8", "A6", "A6-8", "A7", "A7-8")
VAGUE_NATIONS = {"600": "999", "900": "999", "993": "999", "996": "999", "998": "999", "$": "999"}
SECTOR_RECODES = {"2A": "21", "2B": "21", "2C": "21", "2E": "21", "2D": "27"}
MERGED_SECTORS = {"44": "39", "45": "39", "46": "39", "47": "39", "48": "39"}
UNITS_AS_ESTABLISHMENTS = (
    "0753364Z", "0352317D", "0595876S", "0380134P", "0130221V", "0310133B", "0330192E", "0690173N",
)
OVERSEAS_ESTABLISHMENTS = ("9730224F", "9730279R", "9741101D")
OVERSEAS_UNITS = ("9730224F", "9730279R", "9741101D", "9730269E", "9741183T")
PADDED_CODES = ("NIVEAU", "SECTDIS", "DISCIPLI", "TYP_DIPL", "TYP_DIPINT")
IUT_COLUMNS = ("CORRESPONDANCEIUT", "SPECIUT", "OPTIUT", "PARCOURSBUT")
INTERMEDIATE_COLUMNS = (
    "TYP_DIPINT", "DIPINT", "CURSUS_LMD_INT", "SECTINT", "DISCIPLINT", "GROUPINT", "LMDDONTBIS_INT",
)
ENROLMENT_COLUMNS = ("SECTDIS", "COMPOS", "DISCIPLI", "DIPLOM", "CYCLE", "GROUPE", "NIVEAU", "TYP_DIPL", "VOIE")
RESULT_COLUMNS = {
    "SECTDISR": "SECTDIS", "COMPOSR": "COMPOS", "DISCIPLR": "DISCIPLI", "DIPLOMR": "DIPLOM", "CYCLER": "CYCLE",
    "GROUPER": "GROUPE", "NIVEAUR": "NIVEAU", "TYP_DIPR": "TYP_DIPL", "VOIER": "VOIE",
}
# Sheets whose rows become conditions of the plan: one job collects the small ones, larger ones stay tables.
RULE_SHEETS = (
    "COMINS", "COMETAB", "COMUI", "DEP_ACA_RESPA_CORRECTIF", "RESTE_DEPRESPA_CORRECTIF", "DEP_CORRECTIF", "ACA_CORRECTIF",
    "FORMATIONS_CORRECTIF", "GROUPE_CORRECTIF",
)
# Columns that the steps with lookups read or write, beside those that their rule sheets name; the others pass them in one value.
ENTITY_COLUMNS = (
    "RENTREE", "SOURCE", "DIPLOM", "ETABLI", "ETABLI_ORI_UAI", "ETABLI_DIFFUSION", "COMPOS", "UI", "UR", "RATTACH", "FLAG_MEEF", "EFF_SS_ESPE", "TYP_DIPL",
    "ID_PAYSAGE", "ID_PAYSAGE_EPE", "ID_PAYSAGE_EPE_ETAB_COMPOS", "ID_PAYSAGE_FORMENS",
)
COMMUNE_COLUMNS = ("RENTREE", "COMPOS", "ETABLI", "TYP_DIPL", "ID_PAYSAGE", "UI", "UAI", "COMCODE", "COMINS", "COMETAB", "COMUI")
ORIGIN_COLUMNS = (
    "SOURCE", "RENTREE", "SITUPRE", "BAC", "BAC_RGRP", "NATION", "PCSPAR2", "DEPBAC", "ACABAC", "DEPRESPA", "ACARESPA",
)
ORIGIN_SHEETS = ("DEP_ACA_RESPA_CORRECTIF", "RESTE_DEPRESPA_CORRECTIF", "DEP_CORRECTIF", "ACA_CORRECTIF")
DEGREE_COLUMNS = (*PADDED_CODES, "SOURCE", "DIPLOM", "CURSUS_LMD", "CURSUS_LMD_INT", "RESINT", "REGIME")
DEGREE_SHEETS = ("FORMATIONS_CORRECTIF", "GROUPE_CORRECTIF")
ATTRIBUTE_COLUMNS = (
    "SOURCE", "RENTREE", "UR", "UI", "NUMED", "DIPLOM", "TYP_DIPL", "TYP_DIPINT", "NATION", "CONTINENT", *COUNTRY_FLAGS, "COMUI", "COMETAB", "DEPRESPA", "DEPBAC",
    "DEPINS", "UUCRINS", "UUCRETAB", "PROXREG", "PROXIMITE", "PROXBAC", "PROXREGBAC", "OUTREMER", "ID_PAYSAGE_ED", "ID_PAYSAGE_IUT", "ID_PAYSAGE_IUT_CAMPUS",
    "ID_PAYSAGE_IUT_POLE", "ID_PAYSAGE_ING", "ID_PAYSAGE_ING_CAMPUS", "LMDDONT", "LMDDONTBIS", "LMDDONT_INT", "LMDDONTBIS_INT", "DNDU", "DNDU_INT", *IUT_COLUMNS,
)
INDICATOR_COLUMNS = (
    "SOURCE", "RENTREE", "DIPLOM", "TYP_DIPL", "TYP_DIPINT", "PAR_TYPE", "SECTDIS", "GDDISC", "LMDDONT", "LMDDONTBIS", "LMDDONT_INT", "LMDDONTBIS_INT", "DNDU",
    "DNDU_INT", "BAC", "BAC_RGRP", "ANBAC", "ANNAIS", "AGE_BAC", "RETARD", "AVANCE", "DEPBAC", "ACABAC", "DEPRESPA", "PROXBAC", "PROXREGBAC", "OUTREMER",
    "REGRESPA", "REGRESPA16", "NATION", "NATION_BAC", "NATION_VRAI", "MOBINTERN", "FR_ETR", "CURSUS_LMD", "CURSUS_LMD_INT",
)
# Names under which the two unit maps are stored with the sheets.
PARENTS, SEATS = "__parents", "__seats"
Records = Mapping[str, rule_tables.Sheet]
DELETE_SHAPES = (
    ("ETABLI_DIFFUSION", ("RENTREE", "ETABLI_DIFFUSION", "SOURCE")),
    ("ETABLI_ORI_UAI", ("RENTREE", "DIPLOM", "SOURCE", "ETABLI_ORI_UAI")),
    ("ETABLI", ("RENTREE", "ETABLI", "SOURCE")),
    (None, ("RENTREE", "DIPLOM", "SOURCE")),
)


def _source(*names: str) -> Column:
    return F.col("SOURCE").isin(*names)


def _is(col: str, *values: str) -> Column:
    return F.col(col).isin(*values)


def _all(*conds: Column) -> Column:
    return reduce(lambda a, b: a & b, conds)


# ---------------------------------------------------------------- normalise


def drop_flagged(df: DataFrame) -> DataFrame:
    for col, value in (("FLAG_DIP", "1"), ("FLAG_RES", "1"), ("ETATINS", "41")):
        df = exclude(df, col, value)
    return df


def recode_sectors(df: DataFrame, sector: str = "SECTDISR", discipline: str = "DISCIPLR") -> DataFrame:
    old = F.col(sector).isin(*SECTOR_RECODES)
    return df.withColumns({
        discipline: F.when(old, F.lit("04")).otherwise(F.col(discipline)),
        sector: recode(sector, SECTOR_RECODES),
    })


def code_defaults(df: DataFrame, parents_to_bac: bool = False,
                  mobility_country: str = "PAYS_MOBPCO", mobility_type: str = "TYPE_MOBPCO") -> DataFrame:
    """Defaults and exact recodes of single codes.

    ``parents_to_bac`` reproduces a known slip of earlier publications, in which a missing
    parents' occupation set the baccalaureate to 99.
    """
    nation = recode(default_missing("NATION", "$"), {"20": "999", "22": "999", "86": "999"})
    bac = suffix_code(default_missing("BAC", "9999"), SHORT_BAC_CODES)
    out = {
        "NUMED": F.when(is_missing("NUMED"), F.lit("")).when(_is("NUMED", "050"), F.lit("50")).otherwise(F.col("NUMED")),
        "DIPDER": F.when(has_intermediate(), default_missing("DIPDER", "$")).otherwise(F.col("DIPDER")),
        "VOIER": default_missing("VOIER", "9"),
        "NATION": nation,
        "BAC": F.when(is_missing("PCSPAR"), F.lit("99")).otherwise(bac) if parents_to_bac else bac,
        "BAC_RGRP": default_missing("BAC_RGRP", "9"),
        "FR_ETR": default_missing("FR_ETR", "9"),
        "SEXE": default_missing("SEXE", "9"),
        mobility_country: recode(mobility_country, {"": "000"}),
        mobility_type: recode(mobility_type, {"": "X", "0": "X"}),
    }
    if not parents_to_bac:
        out["PCSPAR"] = default_missing("PCSPAR", "99")
    return df.withColumns({c: e for c, e in out.items() if c in df.columns})


def clean_text(df: DataFrame) -> DataFrame:
    """Cut, strip and un-token every text column; pad one-digit degree types, blank for NULL.

    Three projections: each later one reads its column several times, and a stripped text
    that is a column of its own is worked out once per row.
    """
    texts = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType) and f.name not in PARTITIONS]
    df = df.withColumns({c: cut_at(c) for c in texts})
    df = df.withColumns({c: untoken(c) for c in texts})
    padded = {c: zero_pad(F.coalesce(c, F.lit(""))) for c in ("TYP_DIPL", "TYP_DIPR", "TYP_DIPINT")}
    padded["TYP_DIPINT"] = F.when(has_intermediate(), padded["TYP_DIPINT"])
    return df.withColumns(padded)


def keep_awarded(df: DataFrame) -> DataFrame:
    """Universities and private schools: rows with a final or an intermediate degree."""
    return df.filter(~_source("result", "priv") | _is("RESDIP", "O") | _is("RESINT", "O"))


def outcomes(df: DataFrame) -> DataFrame:
    """Final outcome, intermediate outcome and intermediate type in one projection.

    Five steps in turn (defaults of files without outcomes, recodes at reading, coding by source,
    recodes of types, agreement of outcomes and type), worked out on the incoming row. Filters
    on outcomes move below this projection by substitution; a chain of five projections that
    each read their own output would make such a filter explode.
    """
    both, outside, absent = has_intermediate(), _source("mana", "enq", "culture"), ~file_has("RESDIP")
    inter, no_kind = is_missing("DIPINT"), is_missing("TYP_DIPINT")
    final = (F.when(_source("ens"), F.when(inter, F.lit("O")).otherwise(F.lit("N")))
             .when(outside | absent, F.lit("O"))
             .when(_source("inge"), F.when(_is("RESDIP", "N"), F.lit("N")).otherwise(F.lit("O")))
             .otherwise(F.col("RESDIP")))
    middle = (F.when(_source("ens"), F.when(inter, F.lit("N")).otherwise(F.lit("O")))
              .when(outside, F.lit(""))
              .when(absent | (both & is_missing("RESINT") & no_kind), F.lit("N"))
              .otherwise(F.col("RESINT")))
    # A missing type is filled for private schools, and for a final degree of one type.
    private = _all(_source("priv"), ~absent, _is("RESINT", "O"), _is("RESDIP", "N"), _is("NIVEAUR", "02"), no_kind)
    first_years = _all(both, no_kind, _is("TYP_DIPL", "PE"), final == "O")
    still_missing = no_kind & ~holds(first_years) & ~holds(private & _is("TYP_DIPR", "XA", "XB"))
    middle_only = _all(both, final == "N", middle == "O", pd_ne("DIPINT", ""))
    licence = _all(both, middle == "O", _is("TYP_DIPR", "XA"))
    kind = derive.last_wins(F.col("TYP_DIPINT"), [
        (private & _is("TYP_DIPR", "XA"), "CP"),
        (private & _is("TYP_DIPR", "XB"), "EP"),
        ((both & (final == "O") | middle_only) & _is("TYP_DIPINT", "10"), "CP"),
        ((both & (final == "O") | middle_only) & _is("TYP_DIPINT", "20"), "EP"),
        (first_years, "CZ"),
        (licence & _is("TYP_DIPINT", "01", "10", "CC", "XA") & _is("NIVEAUR", "02"), "CP"),
        (licence & _is("TYP_DIPINT", "CC"), "CP"),
    ])
    changed = both & holds(still_missing)
    return df.withColumns({
        "TYP_DIPINT": kind,
        "RESINT": F.when(changed, F.lit("N")).otherwise(middle),
        "RESDIP": F.when(_all(both, final == "O", middle == "O", ~still_missing, ~inter), F.lit("N")).otherwise(final),
        "DISCIPLINT": F.when(_all(_source("result"), _is("DIPINT", "5000770"), _is("SECTINT", "07")), F.lit("11"))
        .otherwise(F.col("DISCIPLINT")),
        "FLAG_MEEF": F.when(_source("result", "priv"), F.col("FLAG_MEEF")).otherwise(F.lit("0")),
    })


def normalise(df: DataFrame, parents_to_bac: bool = False) -> DataFrame:
    """Raw facts to one clean coding of outcomes and codes.

    The exclusions test stored columns and come first, so they reach the Parquet reader.
    """
    df = with_file_columns(df)
    df = rename_present(df, {"IDENTITFIANT_NATIONAL_ETUDIANT": "IDETU", "IDETU_CORR": "IDETU1"})
    df = add_nulls(df, {c: "bigint" if c in RAW_INTS else "string" for c in RAW_COLUMNS})
    df = clean_text(flag_text(drop_flagged(df), "FLAG_MEEF"))
    df = code_defaults(recode_sectors(outcomes(df)), parents_to_bac)
    return with_provenance(keep_awarded(df))


# ---------------------------------------------------------------- correct


def drop_empty_results(df: DataFrame) -> DataFrame:
    """Rows with no degree of either kind go; missing degree codes become NULL.

    The filter tests the stored columns, before they are rewritten, so it can move to the
    scan as it stands.
    """
    df = remove_where(df, _all(is_missing("DIPLOMR"), _is("TYP_DIPR", "99"), is_missing("DIPINT"), is_missing("TYP_DIPINT")))
    cols = ("DIPLOMR", "DIPINT", "TYP_DIPINT")
    return df.withColumns({c: F.when(~is_missing(c), F.col(c)) for c in cols})


def result_side(df: DataFrame) -> DataFrame:
    """The result columns take the place of the enrolment ones."""
    level = F.when(file_has("NIVEAUR"), F.col("NIVEAUR")).otherwise(F.col("NIVEAU"))
    return swap_columns(df.withColumn("NIVEAUR", level), RESULT_COLUMNS, ENROLMENT_COLUMNS)


def headcounts(df: DataFrame) -> DataFrame:
    return df.withColumns({
        "AGE_BAC": diff_int("ANBAC", "ANNAIS"),
        "EFFECTIF_R": derive.headcount("RESDIP"),
        "EFFECTIF_INT": derive.headcount("RESINT"),
    })


def swap_double_award(df: DataFrame) -> DataFrame:
    """One establishment coded the intermediate technology degree as final: swap back.

    Not part of the default order.
    """
    cond = _all(_is("TYP_DIPINT", "UT"), _is("RESDIP", "X"), _is("RESINT", "O"),
                _is("ETABLI_ORI_UAI", "0912423P"), _is("TYP_DIPL", "UT"))
    return rules.assign_where(df, cond, {"RESDIP": "O", "RESINT": "X", "EFFECTIF_R": 1, "EFFECTIF_INT": 0})


def units_as_establishments(df: DataFrame) -> DataFrame:
    """Units that count as establishments of their own."""
    own = F.col("COMPOS")
    return rules.assign_where(df, _is("COMPOS", *UNITS_AS_ESTABLISHMENTS), {"ETABLI": own, "ETABLI_ORI_UAI": own})


def private_flags(df: DataFrame) -> DataFrame:
    """Private schools without a teacher-training entity."""
    cond = _source("priv") & is_blank("ID_PAYSAGE_FORMENS")
    return rules.assign_where(df, cond, {"FLAG_MEEF": "1", "EFF_SS_ESPE": F.lit(0).cast("bigint")})


def parent_unit(df: DataFrame) -> DataFrame:
    """Parent unit of two units that moved."""
    return df.withColumn("UR", F.when(_is("COMPOS", "0011312W"), F.lit("0694121E"))
                         .when(_is("COMPOS", "0133479L"), F.lit("0131844J")))


def establishments(df: DataFrame, sheets: Mapping[str, DataFrame], parents: DataFrame) -> DataFrame:
    """Component, establishment, unit, parent unit and entity of every row."""
    df = rules.fill_component(df)
    df = df.withColumns({"NUMED": strip_zero("NUMED"), "ETABLI": recode("ETABLI", {"0352771X": "0352692L"})})
    df = df.withColumn("ETABLI_ORI_UAI", F.col("ETABLI"))
    df = add_defaults(df, {c: "" for c in ("ID_PAYSAGE_FORMENS", "COMUI", "PAR_TYPE", "ETABLIESPE")})
    df = df.withColumns({c: F.when(~file_has(c), F.lit("")).otherwise(F.col(c))
                         for c in ("DEPBAC", "ACABAC", "DEPRESPA", "CONV")})
    df = delete_by_rules(df, sheets["deleter"], DELETE_SHAPES)
    return beside(df, ENTITY_COLUMNS, lambda d: entities(d, sheets, parents))


def entities(df: DataFrame, sheets: Mapping[str, DataFrame], parents: DataFrame) -> DataFrame:
    """Unit, parent unit, establishment and entity of the rows that stay."""
    df = private_flags(units_as_establishments(df.withColumn("UI", F.col("COMPOS"))))
    df = df.withColumn("UI", F.when(_is("COMPOS", "0684045X"), F.lit("0694045X")).otherwise(F.col("UI")))
    df = coalesced_lookup(df, parents, ["RENTREE", "COMPOS"], "RATTACH", "RATTACH", "COMPOS")
    df = parent_unit(df)
    df = rules.replace_in_spans(df, rules.span_map(sheets["ETABLI"], "IN"), "ETABLI", "ETABLI")
    df = tiered_lookup(df, sheets["A_UAI"], ["RENTREE", "SOURCE", "ETABLI"], "ID_PAYSAGE", "TYPE", ["result", "inscri"])
    successor = sheets["D_EPE"].withColumn("ID_PAYSAGE_EPE_ETAB_COMPOS", F.col("ID_PAYSAGE"))
    df = left_lookup(df, successor, ["RENTREE", "ID_PAYSAGE"], ["ID_PAYSAGE_EPE_ETAB_COMPOS", "ID_PAYSAGE_EPE"])
    df = df.withColumn("ID_PAYSAGE", F.when(is_blank("ID_PAYSAGE_EPE"), F.col("ID_PAYSAGE")).otherwise(F.col("ID_PAYSAGE_EPE")))
    return publication_names(df, sheets["ETABLI_DIFFUSION_ID"])


def publication_names(df: DataFrame, ids: DataFrame, keep_unmatched: bool = True) -> DataFrame:
    """Publication name fixes, then the teacher-training ID by name."""
    name, old = "ETABLI_DIFFUSION", _is("RENTREE", "2014")
    df = rules.assign_steps(df, [
        (old & _is(name, "UNIVERSITE NELLE CALEDONIE") & _is("FLAG_MEEF", "1"), {name: "ESPE ACADEMIE DE NOUVELLE CALE"}),
        (old & _is(name, "ESPE ACADEMIE DE NOUVELLE CALE") & _is("FLAG_MEEF", "0"), {name: "UNIVERSITE NELLE CALEDONIE"}),
        (_is(name, "ESPE ACADEMIE DE REUNION") & _is("TYP_DIPL", "VF"), {name: "UNIVERSITE LA REUNION"}),
    ])
    return rules.replace_by_name(df, ids, name, "ID_PAYSAGE_FORMENS", keep_unmatched)


def commune_of_establishment(df: DataFrame) -> DataFrame:
    """The commune found for an establishment, unless it merely repeats the head of its code; overseas it always counts."""
    own = _is("ETABLI", *OVERSEAS_ESTABLISHMENTS) | pd_ne("COMCODE", F.substring("ETABLI", 1, 5))
    return df.withColumn("COMETAB", F.when(own, F.col("COMCODE")))


def commune_of_unit(df: DataFrame) -> DataFrame:
    """The commune of registration becomes that of the unit, unless it merely repeats the head of the unit's code."""
    local = _all(F.col("COMINS") == F.substring("COMPOS", 1, 5), ~F.coalesce(_is("UI", *OVERSEAS_UNITS), F.lit(False)))
    unit = F.when(local, F.lit("")).when(pd_ne("COMINS", ""), F.col("COMINS")).otherwise(F.col("COMUI"))
    return df.withColumn("COMUI", unit)


def communes(df: DataFrame, records: Records, unit_communes: DataFrame) -> DataFrame:
    """Communes of registration, of the establishment and of the unit."""
    df = left_lookup(df, unit_communes, {"RENTREE": "RENTREE", "COMPOS": "UAI"}, {"COMCODE": "COMINS"})
    df = rule_tables.fold_sheet(df, "registration", records["COMINS"], "COMINS")
    seat = unit_communes.withColumn("__UAI", F.col("UAI"))
    df = left_lookup(df, seat, {"RENTREE": "RENTREE", "ETABLI": "UAI"}, {"COMCODE": "COMCODE", "__UAI": "UAI"})
    df = commune_of_establishment(df)
    df = rule_tables.fold_sheet(df, "establishment", records["COMETAB"], "COMETAB")
    df = commune_of_unit(df)
    return rule_tables.fold_sheet(df, "wildcard", records["COMUI"], "COMUI", keys=("COMPOS", "RENTREE"), any_word=None)


def origin_codes(df: DataFrame) -> DataFrame:
    """Previous situation, baccalaureate group, nationality and second parent's occupation."""
    year = F.col("RENTREE").cast("int")
    return df.withColumns({
        "SITUPRE": F.when(is_blank("SITUPRE"), F.lit("9")).otherwise(F.col("SITUPRE")),
        "BAC_RGRP": F.when(_is("BAC", "0037", "0031"), F.lit("7")).when(_is("BAC", "ES"), F.lit("2")).otherwise(F.col("BAC_RGRP")),
        "NATION": recode("NATION", VAGUE_NATIONS),
        "PCSPAR2": F.when((year > 2003) & (year < 2009), F.lit("99")).otherwise(F.col("PCSPAR2")),
    })


def origins(df: DataFrame, records: Records) -> DataFrame:
    """Departments and academies of origin, after the codes of origin."""
    df = origin_codes(df)
    departments, academies = records["DEP_CORRECTIF"], records["ACA_CORRECTIF"]
    df = rule_tables.apply_sheets(df, [("year", records["DEP_ACA_RESPA_CORRECTIF"]), ("generic", records["RESTE_DEPRESPA_CORRECTIF"])])
    for dep, aca in (("DEPBAC", "ACABAC"), ("DEPRESPA", "ACARESPA")):
        df = rule_tables.apply_sheets(df, [("generic", departments, {"output": dep})])
        fixes = [("generic", academies, {"output": aca})]
        if gate_matters(academies, aca, dep):
            df = if_any(df, pd_ne(dep, "000"), lambda d, gate: rule_tables.apply_sheets(d, fixes, gate), ["SOURCE", "RENTREE"])
        else:
            df = rule_tables.apply_sheets(df, fixes)
    return df


def gate_matters(academies: rule_tables.Sheet, aca: str, dep: str) -> bool:
    """Can a rule fire in a file whose ``dep`` is 000 everywhere?

    The academies' rules apply only to files with some department other than 000. When
    every rule asks for another department the gate changes nothing, and the extra pass
    over the facts that it costs is spared. Of a sheet that stays a table this is not asked.
    """
    if isinstance(academies, DataFrame):
        return True
    return any(r.reads.get(dep, "000") == "000" for r in rules.generic_rules(academies, aca))


def degrees(df: DataFrame, sheets: Mapping[str, DataFrame], records: Records) -> DataFrame:
    """Degree codes: multi-column rules, padded codes, cycle by type and by degree, groups."""
    def pad(d: DataFrame) -> DataFrame:
        return d.withColumns({c: zero_pad(c) for c in PADDED_CODES})

    df = pad(rule_tables.apply_sheets(pad(df), [("formation", records["FORMATIONS_CORRECTIF"])]))
    df = add_nulls(df.withColumn("SECTDIS", recode("SECTDIS", MERGED_SECTORS)),
                   {"CURSUS_LMD": "string", "CURSUS_LMD_INT": "string"})
    by_type = sheets["CORRLMD"].select("TYP_DIPL", "CURSUS_LMD_OUT")
    finer = sheets["CURSUS_LMD_CORRECTIF"].select("TYP_DIPL", "DIPLOM", "NIVEAU", "CURSUS_LMD_OUT")
    by_level = finer.filter(F.col("NIVEAU") != "")
    by_degree = finer.filter(F.col("NIVEAU") == "").drop("NIVEAU")
    for kind, cycle, guard in (("TYP_DIPL", "CURSUS_LMD", is_missing("CURSUS_LMD") | _is("CURSUS_LMD", "X")),
                               ("TYP_DIPINT", "CURSUS_LMD_INT", None)):
        df = rules.override_tiers(df, [
            (by_type, {kind: "TYP_DIPL"}, guard),
            (by_level, {kind: "TYP_DIPL", "DIPLOM": "DIPLOM", "NIVEAU": "NIVEAU"}, None),
            (by_degree, {kind: "TYP_DIPL", "DIPLOM": "DIPLOM"}, None),
        ], cycle, "CURSUS_LMD_OUT")
    df = private_cycles(df)
    df = rule_tables.apply_sheets(df, [("generic", records["GROUPE_CORRECTIF"])])
    return df.withColumn("REGIME", F.when(is_blank("REGIME"), F.lit("99")).otherwise(F.col("REGIME")))


def private_cycles(df: DataFrame) -> DataFrame:
    """Private schools: undefined intermediate cycle from the types. The first cycle set closes the row."""
    open_cycle = _all(_source("priv"), _is("CURSUS_LMD_INT", "X"), _is("RESINT", "O"))
    blank = open_cycle & _is("TYP_DIPINT", "")
    cycle = (F.when(open_cycle & _is("TYP_DIPINT", "CP"), F.lit("L"))
             .when(open_cycle & _is("TYP_DIPINT", "EP"), F.lit("M"))
             .when(blank & _is("TYP_DIPL", "XB"), F.lit("M"))
             .when(blank & _is("TYP_DIPL", "TB", "TE"), F.lit("D")))
    return df.withColumn("CURSUS_LMD_INT", cycle.otherwise(F.col("CURSUS_LMD_INT")))


def enrich(df: DataFrame, sheets: Mapping[str, DataFrame]) -> DataFrame:
    """Attributes from the reference tables."""
    places = sheets["LES_COMMUNES"].select(
        F.col("COM_CODE"), F.substring("DEP_ID", 2, 3).alias("DEPINS"), F.col("UUCR_ID"))
    df = role_lookup(df, places, [
        ({"COMUI": "COM_CODE"}, {"DEPINS": "DEPINS", "UUCR_ID": "UUCRINS"}),
        ({"COMETAB": "COM_CODE"}, {"UUCR_ID": "UUCRETAB"}),
    ])
    df = role_lookup(df, sheets["H_PROXIMITE"], [
        ({"DEPINS": "DEPARTEMENT_UI", "DEPRESPA": "DEPARTEMENT_PARENTS"},
         {"PROX_R_GIONS": "PROXREG", "PROXIMIT_": "PROXIMITE"}),
        ({"DEPINS": "DEPARTEMENT_UI", "DEPBAC": "DEPARTEMENT_PARENTS"},
         {"PROXIMIT_": "PROXBAC", "PROX_R_GIONS": "PROXREGBAC", "OUTREMER": "OUTREMER"}),
    ])
    df = country_lookup(df, sheets["G_PAYS"], flags=COUNTRY_FLAGS)
    df = left_lookup(df, sheets["L_ED"], "NUMED", ["ID_PAYSAGE_ED"])
    df = left_lookup(df, sheets["M_IUT"], ["RENTREE", "UR", "UI"],
                     ["ID_PAYSAGE_IUT", "ID_PAYSAGE_IUT_CAMPUS", "ID_PAYSAGE_IUT_POLE"])
    df = left_lookup(df, sheets["N_ING"], ["RENTREE", "UR", "UI"], ["ID_PAYSAGE_ING", "ID_PAYSAGE_ING_CAMPUS"])
    df = role_lookup(df, sheets["J_LMDDONT"], [
        ("TYP_DIPL", ["LMDDONT", "LMDDONTBIS"]),
        ({"TYP_DIPINT": "TYP_DIPL"}, {"LMDDONT": "LMDDONT_INT", "LMDDONTBIS": "LMDDONTBIS_INT"}),
    ])
    df = role_lookup(df, sheets["I_DNDU"], [("TYP_DIPL", ["DNDU"]), ({"TYP_DIPINT": "TYP_DIPL"}, {"DNDU": "DNDU_INT"})])
    df = derive.certificate_flag(df, has_intermediate())
    df = left_lookup(df, sheets["O_DUTBUT"], "DIPLOM", IUT_COLUMNS)
    return derive.default_group(df, IUT_COLUMNS)


def indicators(df: DataFrame, sheets: Mapping[str, DataFrame]) -> DataFrame:
    df = derive.degree_group(df, has_intermediate())
    df = left_lookup(df, sheets["DISCIPLINES_SISE"], "SECTDIS", ["GDDISC"])
    df = derive.proximity_fix(derive.late_early(df))
    df = left_lookup(df, sheets["DEPTOREG"], {"DEPRESPA": "IN"}, {"OUT": "REGRESPA"})
    df = left_lookup(df, sheets["DEPTOREGNEW"], {"DEPRESPA": "IN"}, {"OUT": "REGRESPA16"})
    return derive.mobility(df, has_intermediate())


def blank_intermediate(df: DataFrame) -> DataFrame:
    """A final degree without an intermediate one has no intermediate columns."""
    return rules.assign_where(df, _is("RESDIP", "O") & _is("RESINT", "N", "X"),
                              {"EFFECTIF_INT": 0, **{c: "" for c in INTERMEDIATE_COLUMNS}})


def engineers(df: DataFrame) -> DataFrame:
    """Codes of one engineering degree that arrives without a type."""
    cond = _all(_source("inge"), _is("RESDIP", "O"), _is("DIPLOM", "6000361"), _is("TYP_DIPL", "99"))
    return rules.assign_where(df, cond, {"CURSUS_LMDR": "M", "SECTDIS": "16", "DISCIPLI": "15", "TYP_DIPL": "FI"})


def doctoral_schools(df: DataFrame) -> DataFrame:
    """Doctoral schools go with the third cycle only; one type is of the second."""
    return df.withColumns({
        "ID_PAYSAGE_ED": F.when(pd_ne("CURSUS_LMDR", "D"), F.lit("")).otherwise(F.col("ID_PAYSAGE_ED")),
        "CURSUS_LMDR": F.when(_is("TYP_DIPL", "JD") & _is("CURSUS_LMDR", "L"), F.lit("M")).otherwise(F.col("CURSUS_LMDR")),
    })


def last_fixes(df: DataFrame) -> DataFrame:
    """Final types, then source-specific fixes; rows without any degree go."""
    df = finalise_types(df, text=("COMETAB", "DEPRESPA", "ACARESPA", "COMINS", "ANNAIS", "ANBAC", "AGE_BAC"),
                        zero_ints=("NBACH", "NET"), ints=COUNTRY_FLAGS)
    df = engineers(blank_intermediate(df))
    df = remove_where(df, double_counted_codes())
    df = rules.assign_where(df, _all(_source("result"), _is("RESDIP", "O"), _is("RESINT", "X"), _is("DIPINT", "8")),
                            {"TYP_DIPINT": "", "DISCIPLINT": "", "SECTINT": ""})
    return keep_positive(derive.total_headcount(doctoral_schools(df)), "EFFECTIF_TOT")


def double_counted_codes() -> Column:
    """Engineering schools, 2020: two degrees of two schools counted elsewhere. Blank intermediate columns and a filled
    group, which mark them too, hold for every such row once ``blank_intermediate`` has run."""
    return _all(
        _source("inge"), _is("RENTREE", "2020"), _is("RESDIP", "O"), _is("RESINT", "N"),
        _is("DIPLOM", "2500203", "2500164"), _is("ETABLI_ORI_UAI", "0597131F", "0632033T"))


def named_in(df: DataFrame, records: Records, names: tuple[str, ...]) -> list[str]:
    """Columns that the rules of these sheets may read or write: those that their cells or headings name, all for a sheet that stays a table."""
    if any(isinstance(records[n], DataFrame) for n in names):
        return df.columns
    words = {w for n in names for r in records[n] for k, v in r.items() for w in (v, k.removesuffix("_IN").strip(), k.removesuffix("_OUT").strip())}
    return [c for c in df.columns if c in words]


def correct(df: DataFrame, sheets: Mapping[str, DataFrame], parents: DataFrame, unit_communes: DataFrame) -> DataFrame:
    """Normalised facts to corrected facts.

    ``parents``: (RENTREE, COMPOS, RATTACH). ``unit_communes``: (RENTREE, UAI, COMCODE).
    """
    sheets = StoredSheets({**sheets, PARENTS: parents, SEATS: unit_communes}).ahead()
    parents, unit_communes = sheets[PARENTS], sheets[SEATS]
    df = headcounts(result_side(drop_empty_results(df)))
    df = establishments(df, sheets, parents)
    records = rules.all_records(sheets, RULE_SHEETS)
    df = beside(df, COMMUNE_COLUMNS, lambda d: communes(d, records, unit_communes))
    df = beside(df, [*ORIGIN_COLUMNS, *named_in(df, records, ORIGIN_SHEETS)], lambda d: origins(d, records))
    df = beside(df, [*DEGREE_COLUMNS, *named_in(df, records, DEGREE_SHEETS)], lambda d: degrees(d, sheets, records))
    df = beside(df, ATTRIBUTE_COLUMNS, lambda d: enrich(d, sheets))
    df = beside(df, INDICATOR_COLUMNS, lambda d: indicators(d, sheets))
    return last_fixes(df).drop(FILE_COLUMNS)


def correct_table(
    spark: SparkSession, raw: DataFrame, sheets: Mapping[str, DataFrame], parents: DataFrame, unit_communes: DataFrame,
    folder: str | None = None, parents_to_bac: bool = False,
) -> DataFrame:
    """The whole job. The normalised facts are written once to ``folder`` (a fresh work folder
    by default): filters of the second half then test stored columns, the gates read a narrow
    second scan instead of repeating the first half, and a lost executor costs no more than
    the half it was in."""
    folder = folder or work_dir(spark, "normalised")
    write_fact(normalise(raw, parents_to_bac), folder)
    return correct(read_fact(spark, folder), sheets, parents, unit_communes)
