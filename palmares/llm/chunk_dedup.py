"""Substring dedup: content-defined chunks by a gear rolling hash, deduplicated by digest.

A cut falls where the gear hash of the last 16 bytes is the least of its neighbourhood. That depends on nearby bytes
alone, so chunks of a passage are the same wherever it stands and whatever was inserted before it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import let, total, written

#: Bytes to either side of a cut in which no other cut can fall: chunks have over REACH bytes, mostly about twice that.
REACH = 16
#: A chunk ends after so many bytes at the latest (runs of one byte have no least hash).
LONGEST = 4096
#: Repeated stretches of fewer words are left alone.
MIN_WORDS = 20
_GEAR = np.array([xxhash.xxh32_intdigest(bytes([b]), 7) for b in range(256)], dtype=np.uint32)
_PIECE = 1 << 22


def gear(data: np.ndarray) -> np.ndarray:
    """The gear hash after each byte, modulo 2**16: h = 2h + G[byte]. Its low 16 bits hold the last 16 bytes only,
    so it is the sum of 16 shifted values, made in four doubling steps."""
    h = _GEAR[data]
    for k in (1, 2, 4, 8):
        h[k:] += h[:-k] << np.uint32(k)
    return h & np.uint32(0xFFFF)


def cuts(data: np.ndarray, reach: int = REACH, longest: int = LONGEST) -> np.ndarray:
    """Ends of the chunks of ``data`` (the last is its length)."""
    n = len(data)
    found = [np.zeros(0, dtype=np.int64)]
    for a in range(0, n, _PIECE):
        lo, hi = max(0, a - 2 * reach - 32), min(n, a + _PIECE + reach + 1)
        h = gear(data[lo:hi]).astype(np.int64)
        # ties go to the earlier byte: strictly least before, least or equal after
        before = np.full(len(h), 1 << 17)
        after = np.full(len(h), 1 << 17)
        for k in range(1, reach + 1):
            np.minimum(before[k:], h[:-k], out=before[k:])
            np.minimum(after[:-k], h[k:], out=after[:-k])
        at = np.flatnonzero((h < before) & (h <= after)) + lo + 1
        at = at[(at > a) & (at <= a + _PIECE) & (at > reach) & (at <= n - reach)]
        found.append(at[(data[at] & 0xC0) != 0x80])  # never inside a character
    ends = np.append(np.concatenate(found), n)
    gaps = np.diff(ends, prepend=0)
    if gaps.max(initial=0) > longest:
        more = np.concatenate([np.arange(e - g + longest, e, longest) for e, g in zip(ends[gaps > longest], gaps[gaps > longest])])
        ends = np.sort(np.concatenate([ends, more[(data[more] & 0xC0) != 0x80]]))
    return ends


def chunks(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Rows (doc_id, row_hash, d1, d2, again, at, bytes, words): the chunks of every whole text, in UTF-8 bytes; 128-bit digests as two longs.

    ``row_hash`` is Spark's xxhash64 of the text and tells rows of one id apart. ``again`` marks a chunk that stands further up in its text as well.
    """
    kind = docs.schema[doc_id].dataType.simpleString()
    names = ["doc_id", "row_hash", "d1", "d2", "again", "at", "bytes", "words"]

    def batches(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digest = xxhash.xxh3_128_digest
        for b in it:
            for row, t in enumerate(b.column(1)):
                t = t.as_py()
                if not t:
                    continue
                data = np.frombuffer(t, dtype=np.uint8)
                ends = cuts(data)
                starts = np.concatenate([[0], ends[:-1]])
                digests = [digest(t[a:e]) for a, e in zip(starts.tolist(), ends.tolist())]
                both = np.frombuffer(b"".join(digests), dtype="<i8").reshape(-1, 2)
                met: set[bytes] = set()
                again = [d in met or bool(met.add(d)) for d in digests]
                blank = (data == 32) | ((data >= 9) & (data <= 13))
                begins = ~blank
                begins[1:] &= blank[:-1]
                count = np.concatenate([[0], np.cumsum(begins)])
                n = len(ends)
                yield pa.RecordBatch.from_arrays([
                    pa.array([b.column(0)[row].as_py()] * n, b.column(0).type), pa.array([b.column(2)[row].as_py()] * n, pa.int64()), pa.array(both[:, 0]), pa.array(both[:, 1]), pa.array(again, pa.bool_()),
                    pa.array(starts.astype(np.int64)), pa.array((ends - starts).astype(np.int32)), pa.array((count[ends] - count[starts]).astype(np.int32))], names=names)

    def merged(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, rows = [], 0
        for b in batches(it):
            held.append(b)
            rows += b.num_rows
            if rows >= 20_000:
                yield from pa.Table.from_batches(held).combine_chunks().to_batches()
                held, rows = [], 0
        if held:
            yield from pa.Table.from_batches(held).combine_chunks().to_batches()

    narrow = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("binary").alias("text"), F.xxhash64(text).alias("row_hash"))
    return narrow.mapInArrow(merged, f"doc_id {kind}, row_hash long, d1 long, d2 long, again boolean, at long, bytes int, words int")


def _runs(parts: Column, min_words: int) -> Column:
    """Neighbouring chunks joined to stretches; those of at least ``min_words`` words. ``parts`` are sorted by place; each is read once or twice."""
    def begins(i: Column) -> Column:
        before, here = F.get(parts, i - 1), F.get(parts, i)
        return (i == 0) | (before["at"] + before["bytes"] != here["at"])

    starts = F.when(F.size(parts) > 0, F.filter(F.sequence(F.lit(0), F.size(parts) - 1), begins)).otherwise(F.array().cast("array<int>"))

    def stretch(starts: Column) -> Column:
        def one(i: Column, k: Column) -> Column:
            run = F.slice(parts, i + 1, F.coalesce(F.get(starts, k + 1), F.size(parts)) - i)
            return let(run, lambda r: F.struct(
                F.get(r, F.lit(0))["at"].alias("at"), total(F.transform(r, lambda p: p["bytes"].cast("long"))).alias("bytes"),
                total(F.transform(r, lambda p: p["words"].cast("long"))).alias("words"), F.forall(r, lambda p: p["first"]).alias("first")))

        return F.transform(starts, one)

    return F.filter(let(starts, stretch), lambda r: r["words"] >= min_words)


def repeated_passages(docs: DataFrame, min_words: int = MIN_WORDS, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Rows (doc_id, row_hash, spans, repeated_words, removed_words): documents with stretches that stand elsewhere too.

    A stretch is a row of neighbouring chunks of which each occurs twice or more in the table, with at least ``min_words``
    words. ``spans`` has (at, bytes, words, first); ``first`` marks a stretch all of whose chunks have their first
    occurrence (least doc_id, null last, then least row_hash, then place) there: it stays, the others are the copies. Null or empty
    texts have none; documents without stretches give no row. Rows that repeat an id and a text give one row, of stretches that
    repeat each other; with the same id, other texts are other documents.
    """
    cut = written(chunks(docs, doc_id, text), "chunks")
    texts = cut.groupBy("doc_id").agg(F.min("row_hash").alias("a"), F.max("row_hash").alias("b"))
    if texts.where("a <> b").isEmpty():
        # one text an id: the id alone tells documents apart, and its minimum is kept in place while chunks are counted
        own, least = F.col("doc_id"), F.min("doc_id")
    else:
        own = F.struct(F.col("doc_id").isNull().alias("nameless"), "doc_id", "row_hash")
        least = F.min(own)
    counted = cut.groupBy("d1", "d2").agg(F.count("*").alias("n"), least.alias("least")).where("n > 1")
    # all chunks are shuffled here: two longs hold what is known of each besides its digest
    place = F.shiftleft("at", 1).bitwiseOR(F.col("again").cast("long")).alias("place")
    size = F.shiftleft(F.col("bytes").cast("long"), 32).bitwiseOR(F.col("words").cast("long")).alias("size")
    found = cut.select("doc_id", "row_hash", "d1", "d2", place, size).join(counted, ["d1", "d2"])
    first = own.eqNullSafe(F.col("least")) & (F.col("place") % 2 == 0)
    part = F.struct(
        F.shiftright("place", 1).alias("at"), F.shiftright("size", 32).cast("int").alias("bytes"), F.col("size").bitwiseAND((1 << 32) - 1).cast("int").alias("words"),
        first.alias("first"))
    parts = found.groupBy("doc_id", "row_hash").agg(F.array_sort(F.collect_set(part)).alias("parts"))
    spans = parts.select("doc_id", "row_hash", _runs(F.col("parts"), min_words).alias("spans")).where(F.size("spans") > 0)
    words = lambda kept: F.aggregate(F.filter("spans", kept), F.lit(0).cast("long"), lambda a, s: a + s["words"])
    return spans.select("doc_id", "row_hash", "spans", words(lambda s: F.lit(True)).alias("repeated_words"), words(lambda s: ~s["first"]).alias("removed_words"))


def without_copies(docs: DataFrame, passages: DataFrame) -> DataFrame:
    """``docs`` with the copies (spans that are not first) cut out of ``text``; other columns and rows as they are."""
    spans = passages.select(F.col("doc_id").alias("__id"), F.col("row_hash").alias("__hash"), F.filter("spans", lambda s: ~s["first"]).alias("__spans")).where(F.size("__spans") > 0)
    data = F.col("text").cast("binary")
    ends = F.concat(F.array(F.lit(0).cast("long")), F.transform("__spans", lambda s: s["at"] + s["bytes"]))
    starts = F.concat(F.transform("__spans", lambda s: s["at"]), F.array(F.octet_length("text").cast("long")))
    pieces = F.transform(F.arrays_zip(ends.alias("a"), starts.alias("b")), lambda p: F.substring(data, (p["a"] + 1).cast("int"), (p["b"] - p["a"]).cast("int")))
    cut = F.decode(F.aggregate(pieces, F.lit(b""), lambda a, p: F.concat(a, p)), "utf-8")
    joined = docs.join(spans, docs["doc_id"].eqNullSafe(spans["__id"]) & (F.xxhash64(docs["text"]) == spans["__hash"]), "left")
    return joined.select(*[F.when(F.col("__spans").isNull(), docs["text"]).otherwise(cut).alias("text") if c == "text" else docs[c] for c in docs.columns])
