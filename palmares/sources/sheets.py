"""Correction sheets and code lists: text tables with no NULL.

Sheets that are read keep the place of their rows (``ROW``, a text that sorts in the order of the document): rules
apply in that order.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Mapping
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from ..functions.nulls import cut_at
from ..operators.lookups import size_is_known, stored
from ..operators.rules import ROW
from ..operators.schema import upper_names
from ..session import work_dir

# Names of the sheets.
SHEETS = (
    "ETABLI", "A_UAI", "C_ETABLISSEMENTS", "D_EPE", "E_FORM_ENS", "DEP_ACA_RESPA_CORRECTIF", "F_RENTREES", "G_PAYS",
    "H_PROXIMITE", "I_DNDU", "J_LMDDONT", "DISCIPLINES_SISE", "ETABLI_SOURCE", "L_ED", "M_IUT", "N_ING", "O_DUTBUT",
    "LES_COMMUNES", "DEPTOREG", "CORRLMD", "DEPTOREGNEW", "ETABLI_DIFFUSION_ID", "FORMATIONS_CORRECTIF",
    "CURSUS_LMD_CORRECTIF", "RESTE_DEPRESPA_CORRECTIF", "DEP_CORRECTIF", "ACA_CORRECTIF", "GROUPE_CORRECTIF",
    "COMINS", "COMUI", "COMETAB", "deleter", "K_FORM_ENS_ETAB", "SEXE", "BAC_RGRP", "AVANCE_RETARD", "PROXBAC",
    "PROXREGBAC", "ATTRAC_INTERN", "MOBILITE_INTERN", "DNDU", "CURSUS_LMD", "LMDDONTBIS", "NIVEAU", "SECTDIS",
    "SPECIUT",
)


def normalise_cells(df: DataFrame) -> DataFrame:
    """Workbook cells as text: cut at ``.0``, stripped, empty instead of NULL."""
    return df.select(*[F.coalesce(cut_at(F.col(c).cast("string")), F.lit("")).alias(c) for c in df.columns])


def as_sheet(df: DataFrame) -> DataFrame:
    """Upper-case names, clean cells, no exact duplicate: of equal rows the first stays, if places are known."""
    df = upper_names(df)
    if ROW not in df.columns:
        return normalise_cells(df).distinct()
    cells = [c for c in df.columns if c != ROW]
    return df.select(ROW, *[F.coalesce(cut_at(F.col(c).cast("string")), F.lit("")).alias(c) for c in cells]).groupBy(*cells).agg(F.min(ROW).alias(ROW))


class StoredSheets(Mapping):
    """Sheets that are written once, at their first use: a lookup then knows their size and works nothing out again.

    Sheets whose size is known as they are (local rows, files) are passed through.
    """

    def __init__(self, sheets: Mapping[str, DataFrame]):
        self._sheets, self._stored = dict(sheets), {}
        if isinstance(sheets, StoredSheets):
            self._stored = sheets._stored

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._stored:
            sheet = self._sheets[name]
            self._stored[name] = sheet if size_is_known(sheet) else stored(sheet, name.lower())
        return self._stored[name]

    def __iter__(self) -> Iterator[str]:
        return iter(self._sheets)

    def __len__(self) -> int:
        return len(self._sheets)

    def ahead(self, names: Iterable[str] | None = None, at_once: int = 8) -> "StoredSheets":
        """Write the named sheets (all of them) now, several at a time: most are small."""
        with ThreadPoolExecutor(at_once) as pool:
            list(pool.map(self.__getitem__, [n for n in (self if names is None else names) if n in self._sheets]))
        return self


def read_sheets(spark: SparkSession, path: str, whole: bool = True) -> dict[str, DataFrame]:
    """JSON documents ``{sheet: [record, ...]}`` as one table per sheet.

    ``whole``: each file is one document (a workbook export). Otherwise each line is one,
    so files can be split and the records of a sheet may come from many documents.
    The text is parsed once, into a columnar table of which each sheet reads its own column. A sheet without records is
    not listed. One document is one record, parsed in one task: ``documents.read_document`` reads large ones in parts.
    """
    folder = work_dir(spark, "sheets")
    parsed = spark.read.option("multiLine", whole).option("primitivesAsString", True).json(path)
    place = F.format_string("%s %020d %020d", "_metadata.file_path", "_metadata.file_block_start", F.monotonically_increasing_id())
    parsed.withColumn(ROW, place).write.parquet(folder)
    doc = spark.read.parquet(folder)

    def sheet(name: str) -> DataFrame:
        rows = doc.select(ROW, F.posexplode(F.col(f"`{name}`")).alias("place", "r"))
        return as_sheet(rows.select(F.format_string("%s %010d", ROW, "place").alias(ROW), "r.*"))

    kinds = {f.name: f.dataType for f in doc.schema.fields}
    return {name: sheet(name) for name, kind in kinds.items() if isinstance(kind, T.ArrayType) and isinstance(kind.elementType, T.StructType)}


def read_sheet_folder(spark: SparkSession, root: str, names: Iterable[str]) -> dict[str, DataFrame]:
    """The layout of ``write_sheets``: one folder of JSON lines per sheet."""
    root = root.rstrip("/")
    return {n: as_sheet(spark.read.option("primitivesAsString", True).json(f"{root}/{n}")) for n in names}


def write_sheets(sheets: Mapping[str, DataFrame], root: str) -> None:
    root = root.rstrip("/")
    for name, df in sheets.items():
        df.write.mode("overwrite").json(f"{root}/{name}")
