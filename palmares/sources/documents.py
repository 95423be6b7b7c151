"""One large JSON document ``{sheet: [record, ...]}``, read by many tasks.

Spark's text reader cuts files at byte ranges and, here, rows at closing braces. Whether a brace stands inside a text is
told by the number of quotes before it, summed first over blocks and then inside them; pieces up to a real brace make
a record. Nothing of the document but its sheet names and field names reaches the driver.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from ..operators.lookups import stored
from ..operators.rules import ROW
from .sheets import as_sheet

_TEXT = r'"(?:[^"\\]|\\.)*+"'
#: What stands before a record, and the record: a flat object at the end of a piece.
RECORD = rf"(?s)^(.*?)(\{{(?:[^{{}}\"]|{_TEXT})*+\}})$"
#: The sheets that begin before a record; the last one holds it.
SHEET = rf'(?s)"((?:[^"\\]|\\.)*+)"\s*:\s*\['
_BLOCK = ["file", "block"]


def _upto(value: str, blocks: DataFrame) -> DataFrame:
    """For each block of a file the sum of ``value`` over the blocks before it. One row a block: small."""
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    sums = blocks.groupBy(*_BLOCK).agg(F.sum(value).alias("n"))
    return sums.select(*_BLOCK, F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))


def _running(value: str) -> Column:
    """Sum of ``value`` up to and with a row, from the beginning of its block."""
    return F.sum(value).over(Window.partitionBy(*_BLOCK).orderBy("at").rowsBetween(Window.unboundedPreceding, 0))


def records(spark: SparkSession, path: str) -> DataFrame:
    """Rows (file, number, sheet, record): every record of the documents under ``path`` in order, as JSON texts.

    Records are flat objects; one that holds an object fails. A sheet without records gives no row. Blocks are Spark's
    input splits (``spark.sql.files.maxPartitionBytes``).
    """
    lines = spark.read.option("lineSep", "}").text(path)
    quotes = F.length(F.regexp_replace("value", r'(?s)\\.|[^"\\]+', ""))
    pieces = lines.select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("at"), "value", quotes.alias("quotes"))
    pieces = stored(pieces, "pieces")
    placed = pieces.join(F.broadcast(_upto("quotes", pieces)), _BLOCK)
    # an even number of quotes so far: the brace that ended the piece closes something
    ended = placed.select(*_BLOCK, "at", "value", ((F.col("before") + _running("quotes")) % 2 == 0).cast("int").alias("ends"))
    ended = stored(ended, "ends")
    numbered = ended.join(F.broadcast(_upto("ends", ended)), _BLOCK)
    number = F.col("before") + _running("ends") - F.col("ends")
    parts = numbered.select("file", number.alias("number"), F.struct("block", "at", "value").alias("part"))
    texts = parts.groupBy("file", "number").agg(F.array_sort(F.collect_list("part")).alias("parts"))
    whole = texts.select("file", "number", F.concat(F.array_join(F.transform("parts", lambda p: p["value"]), "}"), F.lit("}")).alias("text"))
    record, before = F.regexp_extract("text", RECORD, 2), F.regexp_extract("text", RECORD, 1)
    opened = F.regexp_extract_all(before, F.lit(SHEET), F.lit(1))
    # no brace is open before a record but that of the document, which stands before the first one
    bare = F.regexp_replace(before, _TEXT, "")
    deeper = F.when(F.col("number") > 0, F.contains(bare, F.lit("{"))).otherwise(~F.regexp_like(bare, F.lit(r"^\s*(\{[^{]*)?$")))
    odd = F.when(record == "", F.contains("text", F.lit("{"))).otherwise(deeper)
    cut = stored(whole.select("file", "number", record.alias("record"), F.try_element_at(opened, F.lit(-1)).alias("sheet"), odd.alias("odd")), "records")
    if not cut.filter("odd").isEmpty():
        raise ValueError(f"a record of {path} is no flat object")
    # one row a sheet and file: where it begins
    begins = cut.filter("sheet IS NOT NULL").groupBy("file").agg(F.array_sort(F.collect_list(F.struct("number", "sheet"))).alias("begins"))
    found = cut.filter("record <> ''").drop("sheet").join(F.broadcast(begins), "file")
    inside = F.try_element_at(F.filter("begins", lambda b: b["number"] <= F.col("number")), F.lit(-1))["sheet"]
    return found.select("file", "number", inside.alias("sheet"), "record").filter("sheet IS NOT NULL")


def read_document(spark: SparkSession, path: str) -> dict[str, DataFrame]:
    """One table per sheet, as ``read_sheets`` gives them, from documents of any size."""
    fields = F.from_json("record", "map<string,string>")
    place = F.format_string("%s %020d", "file", "number")
    rows = stored(records(spark, path).select("sheet", place.alias(ROW), fields.alias("fields")), "document")
    names: dict[str, list[str]] = {}
    for r in rows.select("sheet", F.explode(F.map_keys("fields")).alias("field")).distinct().collect():
        names.setdefault(r.sheet, []).append(r.field)
    return {
        name: as_sheet(rows.filter(F.col("sheet") == name).select(ROW, *[F.col("fields")[f].alias(f) for f in sorted(found)]))
        for name, found in sorted(names.items())}
