"""Benchmark decontamination: windows of the size of a benchmark item, compared by SimHash and then exactly.

A window without any shingle of an item has similarity 0, so only windows over a met shingle are made. Their
fingerprints meet those of items in a multi-index of Hamming blocks, which misses none within the radius; pairs within
it are compared by the weighted Jaccard similarity of their shingles. DataFrame functions only.
"""

from __future__ import annotations

from functools import reduce
from itertools import combinations
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import free_name, let, small, written

SHINGLE = 5
LEAST = 0.8
#: Equal-sized windows of similarity 0.8 share 8/9 of their shingles: a bit differs with probability 0.15, more than 23 of 64 in about one
#: case of 100 000. It is the largest radius for which a block may differ in 2 bits at the most (23 // 8), so the index is that of 16.
RADIUS = 23
BLOCKS = 8
#: Bits of the table that tells most shingles of texts from those of items: 64 a shingle, within these bounds.
FEWEST_BITS, MOST_BITS = 1 << 16, 1 << 22


def word_hashes(text: Column) -> Column:
    """Hashes of the words of a text: runs of letters and digits in lower case."""
    found = F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+", -1)
    return F.transform(F.filter(found, lambda w: w != ""), lambda w: F.xxhash64(w))


def shingle_hashes(hashes: Column) -> Column:
    """Hashes of the five-word shingles, in order; none for fewer words."""
    return let(hashes, lambda h: F.when(F.size(h) < SHINGLE, F.array().cast("array<bigint>")).otherwise(
        F.transform(F.sequence(F.lit(0), F.size(h) - SHINGLE), lambda i: F.xxhash64(*[F.get(h, i + k) for k in range(SHINGLE)]))))


def simhash_sums() -> list[Column]:
    """Sums over rows of the bits of ``hash``: each holds the counts of two bits, in the halves of a long."""
    return [F.sum(F.shiftrightunsigned("hash", k).bitwiseAND(F.lit(0x0000000100000001))).alias(f"c{k}") for k in range(32)]


def simhash_of_sums(n: Column) -> Column:
    """The fingerprint of ``simhash_sums`` over ``n`` shingles: a bit is set if more than half of them have it."""
    out = F.lit(0).cast("long")
    for k in range(32):
        low = F.col(f"c{k}").bitwiseAND(F.lit(0xFFFFFFFF))
        high = F.shiftrightunsigned(F.col(f"c{k}"), 32)
        for bit, count in ((k, low), (k + 32, high)):
            mask = 1 << bit
            out = out.bitwiseOR(F.when(count * 2 > n, F.lit(mask - (1 << 64) if bit == 63 else mask).cast("long")).otherwise(F.lit(0).cast("long")))
    return out


def benchmark_items(benchmark: DataFrame, item_id: str = "item_id", text: str = "text") -> DataFrame:
    """Rows (item_id, n, hs): items of five words or more with their number of words and their shingles. Shorter ones and null texts say nothing."""
    rows = benchmark.select(F.col(item_id).alias("item_id"), shingle_hashes(word_hashes(F.col(text))).alias("hs")).distinct()
    return rows.select("item_id", (F.size("hs") + SHINGLE - 1).alias("n"), "hs").where("n >= 5")


def _bit_table(shingles: DataFrame, bits: int) -> list[int]:
    """Longs of a bit table of fixed size with four bits set for each hash."""
    both = shingles.select(F.explode(F.array(*_places(F.col("hash"), bits))).alias("at"))
    longs = both.groupBy(F.shiftright("at", 6).alias("w")).agg(F.bit_or(F.expr("shiftleft(1L, cast(at & 63 as int))")).alias("v")).collect()
    table = [0] * (bits // 64)
    for r in longs:
        table[r["w"]] = r["v"]
    return table


def _places(h: Column, bits: int) -> list[Column]:
    return [F.shiftrightunsigned(h, s).bitwiseAND(F.lit(bits - 1)).cast("int") for s in (0, 14, 28, 42)]


def _maybe(table: Column, h: Column, bits: int) -> Column:
    """Are all bits of a hash set? False only for hashes that no item has."""
    one = lambda at: F.call_function("getbit", F.get(table, F.shiftright(at, 6)), at.bitwiseAND(F.lit(63))) == 1
    return reduce(and_, map(one, _places(h, bits)))


def _variants(items: DataFrame, radius: int, blocks: int) -> DataFrame:
    """Rows (item_id, n, fp, block, value): every value of a block within radius // blocks bits of the item's own."""
    width = 64 // blocks
    flips = [0] + [sum(1 << b for b in c) for k in range(1, radius // blocks + 1) for c in combinations(range(width), k)]
    each = items.select("*", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"))
    value = F.expr(f"shiftrightunsigned(fp, block * {width}) & {(1 << width) - 1}L")
    return each.select("*", F.explode(F.transform(F.array(*[F.lit(x).cast("long") for x in flips]), lambda x: value.bitwiseXOR(x))).alias("value"))


def contaminated(docs: DataFrame, benchmark: DataFrame, least: float = LEAST, radius: int = RADIUS, blocks: int = BLOCKS, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Rows (doc_id, row_hash, item_id, similarity, distance, at_word, n_words): each row of ``docs`` with each item it holds.

    The best window of the item's number of words (all of a shorter text) counts: most similar, then first. Similarity is
    sum(min) / sum(max) over the counts of five-word shingles. ``row_hash`` (of the text) tells rows of one id apart;
    repeated rows give repeated results. Null and short texts hold nothing; items that agree are all named.
    """
    spark = docs.sparkSession
    items = written(benchmark_items(benchmark), "items")
    parts = items.select("item_id", "n", F.explode("hs").alias("hash"))
    sizes = small(written(parts.select("n", "hash").distinct(), "item-shingles"))
    n_shingles = sizes.count()
    bits = FEWEST_BITS
    while bits < min(MOST_BITS, 64 * n_shingles):
        bits *= 2
    table = F.from_json(F.lit("[" + ",".join(map(str, _bit_table(sizes, bits))) + "]"), "array<bigint>")

    # one pass over the texts; the row number keeps the filter behind the projection, so shingles are made once
    met = let(shingle_hashes(word_hashes(docs[text])), lambda h: F.struct(
        h.alias("hs"), F.when(F.size(h) > 0, F.filter(F.sequence(F.lit(0), F.size(h) - 1), lambda i: _maybe(table, F.get(h, i), bits))).alias("met")))
    rows = docs.select(docs[doc_id].alias("doc_id"), F.xxhash64(docs[text]).alias("row_hash"), met.alias("m"), F.monotonically_increasing_id().alias("row"))
    held = written(rows.where(F.size("m.met") > 0).select("row", "doc_id", "row_hash", "m.hs", "m.met"), "met")

    hits = held.select("row", F.explode("met").alias("at"), F.size("hs").alias("len"), "hs").select("row", "at", "len", F.get("hs", F.col("at")).alias("hash"))
    sized = hits.join(sizes, "hash").select("row", "n", F.explode(F.sequence(
        F.least(F.greatest(F.col("at") - (F.col("n") - SHINGLE), F.lit(0)), F.greatest(F.col("len") - (F.col("n") - SHINGLE + 1), F.lit(0))),
        F.least(F.col("at"), F.greatest(F.col("len") - (F.col("n") - SHINGLE + 1), F.lit(0))))).alias("start")).distinct()
    starts = sized.groupBy("row", "n").agg(F.collect_list("start").alias("starts"))
    windows = held.join(starts, "row").select("row", "n", "hs", F.explode("starts").alias("start"))
    windows = windows.select("row", "n", "start", F.slice("hs", F.col("start") + 1, F.col("n") - SHINGLE + 1).alias("win"))
    printed = windows.select("row", "n", "start", F.explode("win").alias("hash")).groupBy("row", "n", "start").agg(F.count("*").alias("k"), *simhash_sums())
    printed = printed.select("row", "n", "start", simhash_of_sums(F.col("k")).alias("fp"))

    item_prints = parts.groupBy("item_id", "n").agg(F.count("*").alias("k"), *simhash_sums()).select("item_id", "n", simhash_of_sums(F.col("k")).alias("fp"))
    index = small(written(_variants(item_prints, radius, blocks), "index"))
    width = 64 // blocks
    blocked = printed.select("*", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block")).withColumn("value", F.expr(f"shiftrightunsigned(fp, block * {width}) & {(1 << width) - 1}L"))
    both = blocked.alias("w").join(index.alias("i"), ["n", "block", "value"]).withColumn("x", F.col("w.fp").bitwiseXOR(F.col("i.fp")))
    near = both.where(F.bit_count("x") <= radius)
    # a pair that meets in several blocks counts in the first of them
    differ = lambda j: F.bit_count(F.shiftrightunsigned("x", j * width).bitwiseAND(F.lit((1 << width) - 1)))
    first = F.coalesce(*[F.when(differ(j) <= radius // blocks, F.lit(j)) for j in range(blocks)])
    pairs = near.where(F.col("block") == first).select("row", "n", "start", "item_id", F.bit_count("x").alias("distance"))

    close = written(pairs, "close")
    found = close.groupBy("row", "n").agg(F.collect_list(F.struct("start", "item_id", "distance")).alias("ps"))
    again = held.join(found, "row").select("row", "n", "hs", F.explode("ps").alias("p")).select(
        "row", "n", "p.*", F.slice("hs", F.col("p.start") + 1, F.col("n") - SHINGLE + 1).alias("win"))
    counts = again.select("row", "n", "start", "item_id", "distance", F.size("win").alias("size"), F.explode("win").alias("hash"))
    counts = counts.groupBy("row", "n", "start", "item_id", "distance", "size", "hash").agg(F.count("*").alias("a"))
    of_item = small(written(parts.groupBy("item_id", "hash").agg(F.count("*").alias("b")), "item-counts"))
    shared = counts.join(of_item, ["item_id", "hash"]).groupBy("row", "n", "start", "item_id", "distance", "size").agg(F.sum(F.least("a", "b")).alias("both"))
    alike = F.col("both") / (F.col("size") + F.col("n") - SHINGLE + 1 - F.col("both"))
    best = shared.withColumn("similarity", alike).where(F.col("similarity") >= least).groupBy("row", "item_id", "n").agg(
        F.max(F.struct("similarity", (-F.col("start")).alias("start"), (-F.col("distance")).alias("distance"))).alias("b"))
    named = held.select("row", "doc_id", "row_hash")
    return best.join(named, "row").select(
        "doc_id", "row_hash", "item_id", F.col("b.similarity").alias("similarity"), (-F.col("b.distance")).cast("int").alias("distance"),
        (-F.col("b.start")).cast("int").alias("at_word"), F.col("n").alias("n_words"))


def decontaminated(docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text", **how) -> DataFrame:
    """The rows of ``docs`` that hold no item, with all columns; rows of one id are told apart by their texts."""
    found = contaminated(docs, benchmark, doc_id=doc_id, text=text, **how)
    key, mark = free_name(docs, "leak_id"), free_name(docs, "leak_hash")
    leaks = small(written(found.select(F.col("doc_id").alias(key), F.col("row_hash").alias(mark)).distinct(), "leaks"))
    return docs.join(leaks, docs[doc_id].eqNullSafe(leaks[key]) & (F.xxhash64(docs[text]) == leaks[mark]), "left_anti")
