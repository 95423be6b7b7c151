"""Publication job: corrected facts to the labelled open-data table.

Two shuffles, both of codes: one into parts of even size, one by group. Codes that are published by
their labels alone are replaced by one code for each set of labels; the facts are then summed over
codes (map-side combined, so a heavy group leaves each task as one row), and the star and label
lookups run on the result. Rows of labels, many times as wide, are neither grouped nor shuffled.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame, Window, functions as F

from ..functions.scalars import breadcrumb, join_codes, recode, yes_no
from ..operators.aggregate import in_even_parts, resum, sum_cube
from ..operators.filters import exclude, keep_positive, semi_by_attribute
from ..operators.lookups import left_lookup, star_join
from ..operators.rules import ROW
from ..operators.schema import alias_columns, pick, relabel
from ..sources.sheets import StoredSheets

# Keys, measures and names of the published table.
CUBE_KEYS = (
    "RENTREE", "SESSION", "ID_PAYSAGE", "ID_PAYSAGE_EPE_ETAB_COMPOS", "ID_PAYSAGE_FORMENS", "ID_PAYSAGE_ED",
    "ID_PAYSAGE_ING", "ID_PAYSAGE_ING_CAMPUS", "ID_PAYSAGE_IUT", "ID_PAYSAGE_IUT_CAMPUS", "ID_PAYSAGE_IUT_POLE",
    "ETABLI_ORI_UAI", "COMUI", "COMETAB", "SEXE", "BAC_RGRP", "RETARD", "AVANCE", "PROXBAC", "PROXREGBAC",
    "NATION_VRAI", "MOBINTERN", "DNDU", "DNDU_INT", "CURSUS_LMD", "CURSUS_LMDR", "CURSUS_LMD_INT", "LMDDONTBIS",
    "LMDDONTBIS_INT", "RESDIP", "RESINT", "SECTDIS", "SECTINT", "SPECIUT", "OPTIUT", "PARCOURSBUT", "NIVEAU",
)
CUBE_FLAGS = ("UE_27", "OCDE_MEMBRES", "BOLOGNE", "BRICS")
CUBE_MEASURES = ("EFFECTIF_INT", "EFFECTIF_R", "EFFECTIF_TOT")
ROLLUP_KEYS = (
    "RENTREE", "SESSION", "ID_PAYSAGE", "ID_PAYSAGE_EPE_ETAB_COMPOS", "ID_PAYSAGE_FORMENS", "ID_PAYSAGE_ED",
    "ID_PAYSAGE_ING", "ID_PAYSAGE_ING_CAMPUS", "ID_PAYSAGE_IUT", "ID_PAYSAGE_IUT_CAMPUS", "ID_PAYSAGE_IUT_POLE",
    "ETABLI_ORI_UAI", "COM_INS", "COM_ETAB", "SEXE", "BAC_RGRP", "AVANCE_RETARD", "PROXBAC", "PROXREGBAC",
    "ATTRAC_INTERN", "MOBILITE_INTERN", "DNDU", "DNDU_INT", "CURSUS_LMD", "CURSUS_LMDR", "CURSUS_LMD_INT",
    "LMDDONTBIS", "LMDDONTBIS_INT", "NIVEAU", "SECTDIS", "SECTINT", "SPECIUT", "OPTIUT", "PARCOURSBUT",
    "OBTENU_DIPLOME", "OBTENU_DIPINT",
)
# Codes of the roll-up whose labels are not published; leaving them out does not change the table.
UNPUBLISHED = (
    "ID_PAYSAGE_ED", "ID_PAYSAGE_ING", "ID_PAYSAGE_ING_CAMPUS", "ID_PAYSAGE_IUT", "ID_PAYSAGE_IUT_CAMPUS",
    "ID_PAYSAGE_IUT_POLE", "PROXBAC", "PROXREGBAC", "MOBILITE_INTERN", "DNDU_INT", "CURSUS_LMDR", "NIVEAU", "OPTIUT",
    "PARCOURSBUT",
)
ALIASES = {
    "ATTRAC_INTERN_UE_27": "UE_27",
    "ATTRAC_INTERN_OCDE_MEMBRES": "OCDE_MEMBRES",
    "ATTRAC_INTERN_BOLOGNE": "BOLOGNE",
    "ATTRAC_INTERN_BRICS": "BRICS",
    "ATTRAC_INTERN": "NATION_VRAI",
    "MOBILITE_INTERN": "MOBINTERN",
    "COM_INS": "COMUI",
    "COM_ETAB": "COMETAB",
    "EFFECTIF_TOTAL": "EFFECTIF_TOT",
}
MEASURES = (
    "EFFECTIF_R", "EFFECTIF_INT", "EFFECTIF_TOTAL", "ATTRAC_INTERN_UE_27", "ATTRAC_INTERN_OCDE_MEMBRES",
    "ATTRAC_INTERN_BOLOGNE", "ATTRAC_INTERN_BRICS",
)
STAR_KEYS = {
    "ID_PAYSAGE_EPE_ETAB_COMPOS": "ETABLISSEMENT_COMPOS_ID_PAYSAGE",
    "ID_PAYSAGE": "ETABLISSEMENT_ID_PAYSAGE",
    "ID_PAYSAGE_FORMENS": "FORM_ENS_ID_PAYSAGE",
    "COM_ETAB": "ETABLISSEMENT_CODE_COMMUNE",
    "COM_INS": "IMPLANTATION_CODE_COMMUNE",
    "ETABLI_ORI_UAI": "ETABLISSEMENT_ID_UAI_SOURCE",
}
ESTABLISHMENT_ATTRIBUTES = {
    "UO_LIB": "ETABLISSEMENT_LIB",
    "TYPE": "ETABLISSEMENT_TYPE",
    "TYPOLOGIE_D_UNIVERSITES_ET_ASSIMILES": "ETABLISSEMENT_TYPOLOGIE",
    "ANCIENS_CODES_UAI": "ETABLISSEMENT_ID_UAI",
    "IDENTIFIANT_WIKIDATA": "ETABLISSEMENT_ID_WIKIDATA",
    "IDENTIFIANT_ROR": "ETABLISSEMENT_ID_ROR",
    "ID_PAYSAGE_ACTUEL": "ETABLISSEMENT_ID_PAYSAGE_ACTUEL",
}
PLACE_LEVELS = {
    "COM_NOM": "COMMUNE", "UUCR_ID": "ID_UUCR", "UUCR_NOM": "UUCR", "DEP_ID": "ID_DEPARTEMENT", "DEP_NOM": "DEPARTEMENT",
    "ACA_ID": "ID_ACADEMIE", "ACA_NOM": "ACADEMIE", "REG_ID": "ID_REGION", "REG_NOM": "REGION",
}
PATH_LEVELS = ("REGION", "ACADEMIE", "DEPARTEMENT", "UUCR", "COMMUNE")
SECTOR_ATTRIBUTES = (
    "GD_DISCIPLINE", "GD_DISCIPLINE_LIB", "DISCIPLINE", "DISCIPLINE_LIB", "SECT_DISCIPLINAIRE",
    "SECT_DISCIPLINAIRE_LIB", "DISCIPLINES_SELECTION",
)
# The label lists, as (sheet, key in the table, key in the sheet, {attribute: column}).
LABELS = (
    ("SEXE", "SEXE", "SEXE", {"SEXE_LIB": "SEXE_LIB"}),
    ("BAC_RGRP", "BAC_RGRP", "BAC_RGRP", {"BAC": "BAC", "BAC_LIB": "BAC_LIB", "BAC_RGP": "BAC_RGP"}),
    ("AVANCE_RETARD", "AVANCE_RETARD", "AVANCE_RETARD", {"BAC_AGE_LIB": "BAC_AGE_LIB"}),
    ("ATTRAC_INTERN", "ATTRAC_INTERN", "ATTRAC_INTERN", {"ATTRAC_INTERN_LIB": "ATTRAC_INTERN_LIB"}),
    ("DNDU", "DNDU", "DNDU", {"DN_DE": "DN_DE", "DN_DE_LIB": "DN_DE_LIB"}),
    ("CURSUS_LMD", "CURSUS_LMD", "CURSUS_LMD", {"CURSUS_LMD_LIB": "CURSUS_LMD_LIB"}),
    ("CURSUS_LMD", "CURSUS_LMD_INT", "CURSUS_LMD", {"CURSUS_LMD_LIB": "CURSUS_LMD_LIB_INT"}),
    ("LMDDONTBIS", "LMDDONTBIS", "LMDDONTBIS",
     {"DIPLOME": "DIPLOME", "DIPLOME_RGP": "DIPLOME_RGP", "DIPLOME_LIB": "DIPLOME_LIB"}),
    ("LMDDONTBIS", "LMDDONTBIS_INT", "LMDDONTBIS", {"DIPLOME": "DIPLOME_INT", "DIPLOME_LIB": "DIPLOME_LIB_INT"}),
    ("SECTDIS", "SECTDIS", "SECTDIS", {c: c for c in SECTOR_ATTRIBUTES}),
    ("SECTDIS", "SECTINT", "SECTDIS", {c: f"{c}_INT" for c in SECTOR_ATTRIBUTES if c != "DISCIPLINES_SELECTION"}),
    ("SPECIUT", "SPECIUT", "SPECIUT",
     {"SPEC_IUT": "SPEC_IUT", "SPEC_IUT_LIB": "SPEC_IUT_LIB", "SPEC_IUT_RGP_LIB": "SPEC_IUT_RGP_LIB"}),
)
# Label lists of codes that are not published: offered by ``label`` on request.
OTHER_LABELS = ("PROXBAC", "PROXREGBAC", "MOBILITE_INTERN", "NIVEAU")
# Further roles of published lists, offered in the same way.
OTHER_ROLES = {"DNDU_INT": ("DNDU", {"DN_DE": "DN_DE_INT", "DN_DE_LIB": "DN_DE_LIB_INT"})}
PUBLISHED_KEYS = (
    "ANNEE_UNIVERSITAIRE", "ATTRAC_INTERN", "ATTRAC_INTERN_LIB", "BAC", "BAC_AGE_LIB", "BAC_LIB", "BAC_RGP",
    "CURSUS_LMD", "CURSUS_LMD_LIB", "CURSUS_LMD_INT", "CURSUS_LMD_LIB_INT", "DIPLOME", "DIPLOME_INT", "DIPLOME_LIB",
    "DIPLOME_LIB_INT", "DIPLOME_RGP", "DISCIPLINE", "DISCIPLINES_SELECTION", "DISCIPLINE_LIB", "DISCIPLINE_INT",
    "DISCIPLINE_LIB_INT", "DN_DE", "DN_DE_LIB", "ETABLISSEMENT_ACADEMIE", "ETABLISSEMENT_ACTUEL_LIB",
    "ETABLISSEMENT_CODE_COMMUNE", "ETABLISSEMENT_COMMUNE", "ETABLISSEMENT_COMPOS_ID_PAYSAGE",
    "ETABLISSEMENT_COMPOS_LIB", "ETABLISSEMENT_DEPARTEMENT", "ETABLISSEMENT_ID_ACADEMIE",
    "ETABLISSEMENT_ID_DEPARTEMENT", "ETABLISSEMENT_ID_PAYSAGE", "ETABLISSEMENT_ID_PAYSAGE_ACTUEL",
    "ETABLISSEMENT_ID_REGION", "ETABLISSEMENT_ID_ROR", "ETABLISSEMENT_ID_UAI", "ETABLISSEMENT_ID_UAI_SOURCE",
    "ETABLISSEMENT_ID_UUCR", "ETABLISSEMENT_ID_WIKIDATA", "ETABLISSEMENT_LIB", "ETABLISSEMENT_LOCALISATION",
    "ETABLISSEMENT_REGION", "ETABLISSEMENT_TYPE", "ETABLISSEMENT_TYPOLOGIE", "ETABLISSEMENT_UUCR",
    "FORM_ENS_ID_PAYSAGE", "FORM_ENS_LIB", "GD_DISCIPLINE_INT", "GD_DISCIPLINE", "GD_DISCIPLINE_LIB",
    "GD_DISCIPLINE_LIB_INT", "IMPLANTATION_ACADEMIE", "IMPLANTATION_CODE_COMMUNE", "IMPLANTATION_COMMUNE",
    "IMPLANTATION_DEPARTEMENT", "IMPLANTATION_ID_ACADEMIE", "IMPLANTATION_ID_DEPARTEMENT",
    "IMPLANTATION_ID_REGION", "IMPLANTATION_ID_UUCR", "IMPLANTATION_LOCALISATION", "IMPLANTATION_REGION",
    "IMPLANTATION_UUCR", "OBTENU_DIPINT", "OBTENU_DIPLOME", "RENTREE", "SECT_DISCIPLINAIRE",
    "SECT_DISCIPLINAIRE_LIB", "SECT_DISCIPLINAIRE_INT", "SECT_DISCIPLINAIRE_LIB_INT", "SESSION", "SEXE", "SEXE_LIB",
    "SPEC_IUT", "SPEC_IUT_LIB", "SPEC_IUT_RGP_LIB",
)
PUBLISHED_NAMES = {
    "ANNEE_UNIVERSITAIRE": "Année universitaire",
    "ATTRAC_INTERN_BOLOGNE": "Nombre de diplômes délivrés BOLOGNE",
    "ATTRAC_INTERN_BRICS": "Nombre de diplômes délivrés BRICS",
    "ATTRAC_INTERN_LIB": "Attractivité internationale",
    "ATTRAC_INTERN_OCDE_MEMBRES": "Nombre de diplômes délivrés OCDE_MEMBRES",
    "ATTRAC_INTERN_UE_27": "Nombre de diplômes délivrés UE27",
    "BAC": "bac",
    "BAC_AGE_LIB": "Age au baccalauréat",
    "BAC_LIB": "Série du baccalauréat obtenu",
    "BAC_RGP": "Type du baccalauréat obtenu",
    "CURSUS_LMD": "CURSUS_LMD_R",
    "CURSUS_LMD_INT": "Cycle universitaire intermédiaire",
    "CURSUS_LMD_LIB": "Cycle universitaire (cursus LMD)",
    "CURSUS_LMD_LIB_INT": "cursus_lmd_int",
    "DIPLOME": "DIPLOME_r",
    "DIPLOME_INT": "DIPlome_int",
    "DIPLOME_LIB": "Diplôme délivré",
    "DIPLOME_LIB_INT": "Diplôme intermédiaire délivré",
    "DIPLOME_RGP": "Regroupement de diplômes",
    "DISCIPLINE": "DISCIPLINE_r",
    "DISCIPLINES_SELECTION": "Sélection de la discipline",
    "DISCIPLINE_INT": "DISCIPLine_int",
    "DISCIPLINE_LIB": "Discipline du diplôme",
    "DISCIPLINE_LIB_INT": "Discipline du diplôme intermédiaire",
    "DN_DE": "dn_de_r",
    "DN_DE_LIB": "Type de diplôme",
    "EFFECTIF_INT": "Nombre de diplômes intermédiaires délivrés",
    "EFFECTIF_R": "Nombre de diplômes délivrés",
    "EFFECTIF_TOTAL": "Nombre total de diplômes délivrés",
    "ETABLISSEMENT_ACADEMIE": "Académie de l'établissement",
    "ETABLISSEMENT_ACTUEL_LIB": "etablissement_actuel_lib",
    "ETABLISSEMENT_CODE_COMMUNE": "etablissement_code_commune",
    "ETABLISSEMENT_COMMUNE": "Commune du siège de l'établissement",
    "ETABLISSEMENT_COMPOS_ID_PAYSAGE": "etablissement_compos_id_paysage",
    "ETABLISSEMENT_COMPOS_LIB": "Décomposition des universités",
    "ETABLISSEMENT_DEPARTEMENT": "Département de l'établissement",
    "ETABLISSEMENT_ID_ACADEMIE": "etablissement_id_academie",
    "ETABLISSEMENT_ID_DEPARTEMENT": "etablissement_id_departement",
    "ETABLISSEMENT_ID_PAYSAGE": "etablissement_id_paysage",
    "ETABLISSEMENT_ID_PAYSAGE_ACTUEL": "etablissement_id_paysage_actuel",
    "ETABLISSEMENT_ID_REGION": "etablissement_id_region",
    "ETABLISSEMENT_ID_ROR": "etablissement_id_ror",
    "ETABLISSEMENT_ID_UAI": "etablissement_id_uai",
    "ETABLISSEMENT_ID_UAI_SOURCE": "etablissement_id_uai_source",
    "ETABLISSEMENT_ID_UUCR": "etablissement_id_UUCR",
    "ETABLISSEMENT_ID_WIKIDATA": "etablissement_id_wikidata",
    "ETABLISSEMENT_LIB": "Etablissement",
    "ETABLISSEMENT_LOCALISATION": "Localisation du siège de l'établissement",
    "ETABLISSEMENT_REGION": "Région de l'établissement",
    "ETABLISSEMENT_TYPE": "Type d'établissement",
    "ETABLISSEMENT_TYPOLOGIE": "Typologie d'établissement",
    "ETABLISSEMENT_UUCR": "Unité urbaine ou commune rurale de l'établissement",
    "FORM_ENS_ID_PAYSAGE": "form_ens_id_paysage",
    "FORM_ENS_LIB": "ESPE - INSPE",
    "GD_DISCIPLINE": "GD_DISCIPLINE_r",
    "GD_DISCIPLINE_INT": "GD_DISCIPLine_int",
    "GD_DISCIPLINE_LIB": "Grande discipline du diplôme",
    "GD_DISCIPLINE_LIB_INT": "Grande discipline du diplôme intermédiaire",
    "IMPLANTATION_ACADEMIE": "Academie de l'unité d'inscription",
    "IMPLANTATION_CODE_COMMUNE": "implantation_code_commune",
    "IMPLANTATION_COMMUNE": "Commune de l'unité d'inscription",
    "IMPLANTATION_DEPARTEMENT": "Département de l'unité d'inscription",
    "IMPLANTATION_ID_ACADEMIE": "implantation_id_academie",
    "IMPLANTATION_ID_DEPARTEMENT": "implantation_id_departement",
    "IMPLANTATION_ID_REGION": "implantation_id_region",
    "IMPLANTATION_ID_UUCR": "implantation_id_uucr",
    "IMPLANTATION_LOCALISATION": "Localisation de l'unité d'inscription",
    "IMPLANTATION_REGION": "Région de l'unité d'inscription",
    "IMPLANTATION_UUCR": "Unité urbaine ou commune rurale de l'unité d'inscription",
    "OBTENU_DIPINT": "obtenu_dipint",
    "OBTENU_DIPLOME": "obtenu_diplome",
    "RENTREE": "rentree",
    "SECT_DISCIPLINAIRE": "SECT_DISCIPLINAIRE_r",
    "SECT_DISCIPLINAIRE_INT": "SECT_DISCIPL_int",
    "SECT_DISCIPLINAIRE_LIB": "Secteur disciplinaire du diplôme",
    "SECT_DISCIPLINAIRE_LIB_INT": "Secteur disciplinaire du diplôme intermédiaire",
    "SESSION": "Session",
    "SEXE": "sexe",
    "SEXE_LIB": "Sexe de l'étudiant",
    "SPEC_IUT": "SPEC_DUTr",
    "SPEC_IUT_LIB": "Spécialité du DUT délivré",
    "SPEC_IUT_RGP_LIB": "Regroupement de spécialité DUTs du DUT",
}
# Fixed value: the one entity left out of the publication.
EXCLUDED_ENTITY = "XR16q"


def in_scope(df: DataFrame, sheets: Mapping[str, DataFrame]) -> DataFrame:
    """Rows with a degree, of the state operators, without the excluded entity."""
    df = exclude(keep_positive(df, "EFFECTIF_TOT"), "ID_PAYSAGE", EXCLUDED_ENTITY)
    return semi_by_attribute(df, sheets["C_ETABLISSEMENTS"], "ID_PAYSAGE", "OPERATEUR_LOLF_150", "O")


def first_cube(df: DataFrame) -> DataFrame:
    """Sums over all codes; a country flag is a key and a sum at once."""
    keys = [k for k in CUBE_KEYS if k in df.columns]
    return sum_cube(df, keys, CUBE_MEASURES, CUBE_FLAGS)


def publication_codes(df: DataFrame) -> DataFrame:
    """Codes as published: sex letters, yes / no outcomes, early-late pair, publication names."""
    df = df.withColumns({
        "SEXE": recode("SEXE", {"1": "M", "2": "F"}),
        "OBTENU_DIPLOME": yes_no("RESDIP"),
        "OBTENU_DIPINT": yes_no("RESINT"),
        "AVANCE_RETARD": join_codes("AVANCE", "RETARD"),
    })
    return alias_columns(df, ALIASES)


def second_cube(cube: DataFrame) -> DataFrame:
    """Sums of the first cube over the published codes."""
    keys = [k for k in ROLLUP_KEYS if k in cube.columns or k not in CUBE_KEYS]
    return resum(publication_codes(cube), keys, MEASURES)


def code_sums(df: DataFrame) -> DataFrame:
    """Both cubes in one step, over the codes that are published: sums can be summed again."""
    keys = [k for k in ROLLUP_KEYS if k not in UNPUBLISHED]
    return resum(publication_codes(df), keys, MEASURES)


def star(df: DataFrame, sheets: Mapping[str, DataFrame]) -> DataFrame:
    """Establishment, current establishment, component, teacher training, year and both places."""
    df = df.withColumnsRenamed(STAR_KEYS)
    entities, places = sheets["C_ETABLISSEMENTS"], sheets["LES_COMMUNES"]
    df = star_join(df, [
        (entities, {"ETABLISSEMENT_ID_PAYSAGE": "ID_PAYSAGE"}, ESTABLISHMENT_ATTRIBUTES),
        (entities, {"ETABLISSEMENT_ID_PAYSAGE_ACTUEL": "ID_PAYSAGE"}, {"UO_LIB": "ETABLISSEMENT_ACTUEL_LIB"}),
        (entities, {"ETABLISSEMENT_COMPOS_ID_PAYSAGE": "ID_PAYSAGE"}, {"UO_LIB": "ETABLISSEMENT_COMPOS_LIB"}),
        (sheets["E_FORM_ENS"], {"FORM_ENS_ID_PAYSAGE": "ID_PAYSAGE"}, {"UO_LIB": "FORM_ENS_LIB"}),
        (sheets["F_RENTREES"], "RENTREE", ["ANNEE_UNIVERSITAIRE"]),
        *[(places, {f"{role}_CODE_COMMUNE": "COM_CODE"}, {c: f"{role}_{n}" for c, n in PLACE_LEVELS.items()})
          for role in ("ETABLISSEMENT", "IMPLANTATION")],
    ])
    return df.withColumns({
        f"{role}_LOCALISATION": breadcrumb(*[f"{role}_{level}" for level in PATH_LEVELS])
        for role in ("ETABLISSEMENT", "IMPLANTATION")
    })


def label(df: DataFrame, sheets: Mapping[str, DataFrame], others: tuple[str, ...] = ()) -> DataFrame:
    """Labels of the published codes; ``others`` adds every attribute of further lists, or a further role of a list."""
    for sheet, key, sheet_key, cols in LABELS:
        df = left_lookup(df, sheets[sheet], {key: sheet_key}, cols)
    for name in others:
        if name in OTHER_ROLES:
            sheet, cols = OTHER_ROLES[name]
            df = left_lookup(df, sheets[sheet], {name: sheet}, cols)
            continue
        extra = [c for c in sheets[name].columns if c not in (name, ROW)]
        df = left_lookup(df, sheets[name], name, extra)
    return df.withColumn("SEXE_LIB", F.coalesce("SEXE_LIB", F.lit("Inconnu")))


def one_code_per_label(df: DataFrame, sheets: Mapping[str, DataFrame]) -> DataFrame:
    """Codes that are published by their labels alone: the smallest code with the same labels, NULL where there are none."""
    for sheet, key, sheet_key, cols in LABELS:
        if key in PUBLISHED_KEYS:
            continue
        codes = sheets[sheet].filter(F.col(sheet_key).isNotNull())
        labelled = reduce(lambda a, b: a | b, [F.col(c).isNotNull() for c in cols])
        same = F.when(labelled, F.min(sheet_key).over(Window.partitionBy(*cols)))
        df = left_lookup(df, codes.select(sheet_key, same.alias("__same")), {key: sheet_key}, ["__same"])
        df = df.withColumn(key, F.col("__same")).drop("__same")
    return df


def labelled_sums(df: DataFrame, sheets: Mapping[str, DataFrame]) -> DataFrame:
    """The published table from rows with publication codes and measures: one row a code is one row a label."""
    keys = [k for k in ROLLUP_KEYS if k not in UNPUBLISHED]
    codes = one_code_per_label(in_even_parts(df.select(*keys, *MEASURES), keys), sheets)
    sums = resum(codes, keys, MEASURES)
    return pick(label(star(sums, sheets), sheets), [*PUBLISHED_KEYS, *MEASURES])


def publish(df: DataFrame, sheets: Mapping[str, DataFrame], names: bool = True) -> DataFrame:
    """Corrected facts to the published table (French names unless ``names`` is off)."""
    sheets = StoredSheets(sheets).ahead()
    table = labelled_sums(publication_codes(in_scope(df, sheets)), sheets)
    return relabel(table, PUBLISHED_NAMES) if names else table
