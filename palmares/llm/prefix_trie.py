"""The trie of conversation prefixes, folded in shards over minimal perfect hash tables.

The digest of a prefix is made from sums of the digests of its turns, each bound to its place: sums run in parallel, so a
conversation of any length is dealt to many tasks. Grouped aggregation makes the distinct nodes, and checks that one digest stands for one
prefix. Nodes that many conversations share form the crown, of bounded size; every subtree below it lies in one shard, long chains
in several bands of depth. A shard puts its digests into the slots of a minimal perfect hash, scatters counts into flat arrays by slot and adds
them up along an array of parent slots, deepest nodes first. What the tops of a shard hold goes to the band above and to the crown, folded the same way.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce
from operator import and_

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import join_hot, written

#: Most nodes of the crown, and the most members that a node below it always may have.
CROWN = 100_000
FEW = 64
#: About how many nodes a shard gets, the least number of shards (for parallel work on small tables), and the depths of a band.
SHARD = 50_000
LEAST_SHARDS = 64
BAND = 100_000
#: Turns of a conversation that one group sums up.
CHUNK = 4096
#: Ends of a node are joined to one text per range of ids that agree but for so many bits.
RANGE_BITS = 12
_SUMS = ["s0", "s1", "s2", "s3"]


def digests(depth: Column, sums: list[Column]) -> list[Column]:
    """The digest of a prefix of ``depth`` turns as two longs."""
    return [F.xxhash64(depth, *sums[:2]).alias("low"), F.xxhash64(depth, *sums[2:]).alias("high")]


def ranked(rows: DataFrame) -> DataFrame:
    """Rows (conv_id, rank, n, a, b, n_bytes): the turns in order with their number, that of the conversation, a digest of role and text, and bytes.

    A global sort deals a long conversation to many tasks; ranks are counted inside each part of it and moved on by the parts before.
    """
    narrow = rows.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    ordered = narrow.orderBy("conv_id", F.asc_nulls_first("turn"), "role", "text")
    mark = F.sha2(F.concat(F.octet_length("role").cast("string"), F.lit(" "), F.col("role"), F.col("text")), 256)
    half = lambda k: F.conv(F.substring(mark, k, 15), 16, 10).cast("long")
    placed = written(ordered.select(
        F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("at"), "conv_id", half(1).alias("a"), half(16).alias("b"), F.octet_length("text").cast("long").alias("n_bytes")), "turns")
    parts = placed.groupBy("conv_id", "part").agg(F.count("*").alias("m"))
    whole = Window.partitionBy("conv_id")
    before = F.coalesce(F.sum("m").over(whole.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    offsets = parts.select("conv_id", "part", before.alias("before"), F.sum("m").over(whole).alias("n"))
    here = Window.partitionBy("conv_id", "part").orderBy("at")
    return placed.join(offsets, ["conv_id", "part"]).select("conv_id", (F.col("before") + F.row_number().over(here)).alias("rank"), "n", "a", "b", "n_bytes")


def rebuilt(rows: DataFrame, block: int, heads: int) -> tuple[DataFrame, DataFrame]:
    """(turns, conversations) after the rebuild: (conv_id, depth, a, b, n_bytes) and (conv_id, length), one a conversation."""
    turns = written(ranked(rows), "ranked")
    base = F.col("conv_id") - F.pmod("conv_id", F.lit(block))
    sizes = turns.where("rank = 1").select("conv_id", "n", base.alias("base"), F.pmod(F.crc32(F.col("conv_id").cast("string").cast("binary")), F.lit(heads)).alias("h"))
    of_base = sizes.where("conv_id = base").select("base", F.col("n").alias("n_base"))
    lent = F.when(F.col("conv_id") == F.col("base"), F.col("n")).otherwise(F.least("h", F.coalesce("n_base", F.lit(0))))
    length = F.when(F.col("conv_id") == F.col("base"), F.col("n")).otherwise(lent + F.greatest(F.col("n") - F.col("h"), F.lit(0)))
    convs = written(sizes.join(of_base, "base", "left").select("conv_id", "base", "n", "h", lent.alias("lent"), length.alias("length")), "conversations")
    own = join_hot(turns.drop("n"), convs, "conv_id", "n")
    first = F.col("conv_id") == F.col("base")
    kept = own.where(first | (F.col("rank") > F.col("h"))).select(
        "conv_id", F.when(first, F.col("rank")).otherwise(F.col("lent") + F.col("rank") - F.col("h")).alias("depth"), "a", "b", "n_bytes")
    head = turns.where((F.col("rank") < heads) & (base == F.col("conv_id"))).select(F.col("conv_id").alias("base"), F.col("rank").alias("depth"), "a", "b", "n_bytes")
    borrowed = convs.where((F.col("conv_id") != F.col("base")) & (F.col("lent") > 0)).join(head, "base").where("depth <= lent")
    return kept.unionByName(borrowed.select("conv_id", "depth", "a", "b", "n_bytes")), convs.select("conv_id", "length")


def prefixes(rows: DataFrame, block: int, heads: int) -> DataFrame:
    """A row for every prefix of every rebuilt conversation: conv_id, depth, digest, parent's digest, the last turn's digest and bytes, whether it ends there.

    Sums run inside chunks of a conversation and are moved on by the chunks before. Texts are shuffled once, for the order.
    """
    turns, convs = rebuilt(rows, block, heads)
    own = [F.xxhash64("depth", "a", "b", F.lit(seed)).bitwiseAND(F.lit(0xFFFFFFFF)) for seed in range(4)]
    chunk = F.floor((F.col("depth") - 1) / CHUNK).alias("chunk")
    bound = written(turns.select("conv_id", "depth", "a", "b", "n_bytes", chunk, *[v.alias(f"o{k}") for k, v in enumerate(own)]), "bound")
    upto = Window.partitionBy("conv_id").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    sums = bound.groupBy("conv_id", "chunk").agg(*[F.sum(f"o{k}").alias(f"c{k}") for k in range(4)])
    offsets = sums.select("conv_id", "chunk", *[F.coalesce(F.sum(f"c{k}").over(upto), F.lit(0)).alias(f"c{k}") for k in range(4)])
    here = Window.partitionBy("conv_id", "chunk").orderBy("depth").rowsBetween(Window.unboundedPreceding, 0)
    running = bound.join(offsets, ["conv_id", "chunk"]).select(
        "conv_id", "depth", "a", "b", "n_bytes", *[f"o{k}" for k in range(4)], *[(F.sum(f"o{k}").over(here) + F.col(f"c{k}")).alias(s) for k, s in enumerate(_SUMS)])
    low, high = digests(F.col("depth"), [F.col(s) for s in _SUMS])
    up = digests(F.col("depth") - 1, [F.col(s) - F.col(f"o{k}") for k, s in enumerate(_SUMS)])
    steps = running.select("conv_id", "depth", low, high, up[0].alias("parent_low"), up[1].alias("parent_high"), "a", "b", "n_bytes")
    zero = F.lit(0).cast("long")
    root = digests(zero, [zero] * 4)
    roots = convs.select("conv_id", zero.alias("depth"), *root, root[0].alias("parent_low"), root[1].alias("parent_high"), zero.alias("a"), zero.alias("b"), zero.alias("n_bytes"))
    ends = convs.select("conv_id", F.col("length").alias("depth"), F.lit(True).alias("ends"))
    return steps.unionByName(roots).join(ends, ["conv_id", "depth"], "left").withColumn("ends", F.coalesce("ends", F.lit(False)))


class SlotTable:
    """A minimal perfect hash of distinct digests: n keys to slots 0 … n-1, with the digests kept by slot, so that every lookup is verified.

    Level by level, keys that meet no other in a bit array of twice their number get the rank of their bit; the rest go to the next level.
    """

    def __init__(self, low: np.ndarray, high: np.ndarray):
        self.levels: list[tuple[int, np.ndarray, np.ndarray]] = []
        left, first = np.arange(len(low)), 0
        seed = 0
        while len(left):
            size = 2 * len(left) + 1
            at = self._place(low[left], high[left], seed, size)
            bits = np.bincount(at, minlength=size) == 1
            alone = bits[at]
            self.levels.append((seed, bits, first + np.cumsum(bits) - 1))
            first, left, seed = first + int(alone.sum()), left[~alone], seed + 1
            if seed > 200:
                raise ValueError("digests are not distinct")
        self.low, self.high = np.zeros_like(low), np.zeros_like(high)
        slots = self._slots(low, high)
        if len(np.unique(slots)) != len(slots):
            raise ValueError("two digests have one slot")
        self.low[slots], self.high[slots] = low, high

    @staticmethod
    def _place(low: np.ndarray, high: np.ndarray, seed: int, size: int) -> np.ndarray:
        mixed = low.view(np.uint64) ^ (high.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(seed * 0xD1B54A32D192ED03 % (1 << 64)))
        mixed = (mixed ^ (mixed >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
        return ((mixed ^ (mixed >> np.uint64(29))) % np.uint64(size)).astype(np.int64)

    def _slots(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        slots, left = np.full(len(low), -1, dtype=np.int64), np.arange(len(low))
        for seed, bits, ranks in self.levels:
            at = self._place(low[left], high[left], seed, len(bits))
            hit = bits[at]
            slots[left[hit]] = ranks[at[hit]]
            left = left[~hit]
        return slots

    def slots(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """The slot of each digest, -1 for one that the table does not hold."""
        slots = self._slots(low, high)
        held = (slots >= 0) & (self.low[slots] == low) & (self.high[slots] == high)
        return np.where(held, slots, -1)


#: What a node's fold starts with: parts of subtrees that lie in other shards.
BELOW = ("n_children", "n_leaves", "saved_tokens")
NODE = "depth long, low long, high long, parent_low long, parent_high long, conv_id long, n_convs long, n_bytes long"


def fold(pdf: pd.DataFrame) -> pd.DataFrame:
    """The nodes of one shard with children, leaves and savings of their subtrees; parent_conv_id and ``top`` (parent not in the shard)."""
    low, high = pdf["low"].to_numpy(), pdf["high"].to_numpy()
    table = SlotTable(low, high)
    at = table.slots(low, high)
    if (at < 0).any():
        raise ValueError("a digest is not in its own slot")
    n = len(at)

    def scattered(name: str) -> np.ndarray:
        flat = np.zeros(n, dtype=np.int64)
        flat[at] = pdf[name].to_numpy()
        return flat

    depth, conv, members = scattered("depth"), scattered("conv_id"), scattered("n_convs")
    parent = np.empty(n, dtype=np.int64)
    parent[at] = table.slots(pdf["parent_low"].to_numpy(), pdf["parent_high"].to_numpy())
    parent[depth == 0] = -1
    children, leaves, saved = (scattered(name) for name in BELOW)
    children += np.bincount(parent[parent >= 0], minlength=n)
    leaves += children == 0
    saved += (members - 1) * scattered("n_bytes")
    order = np.argsort(-depth, kind="stable")
    edges = np.flatnonzero(np.diff(depth[order])) + 1
    for part in np.split(order, edges):
        part = part[parent[part] >= 0]
        np.add.at(leaves, parent[part], leaves[part])
        np.add.at(saved, parent[part], saved[part])
    has = parent[at] >= 0
    out = pdf[[c.split()[0] for c in NODE.split(", ")]].copy()
    out["parent_conv_id"] = pd.array(conv[parent[at]], dtype="Int64")
    out.loc[~has, "parent_conv_id"] = pd.NA
    for name, flat in zip(BELOW, (children, leaves, saved)):
        out[name] = flat[at]
    out["top"] = ~has
    return out


FOLDED = f"{NODE}, parent_conv_id long, n_children long, n_leaves long, saved_tokens long, top boolean"


def ends_digests(ends: DataFrame) -> DataFrame:
    """Rows (low, high, ends_sha256): SHA-256 of the ascending, comma-joined ids that end at a node.

    Ids are sorted and joined in ranges first; the texts of a node then stream through its hash, so no node is held whole.
    """
    ranges = ends.groupBy("low", "high", F.shiftright("conv_id", RANGE_BITS).alias("range")).agg(F.sort_array(F.collect_set("conv_id")).alias("ids"))
    texts = ranges.select("low", "high", "range", F.array_join(F.col("ids").cast("array<string>"), ",").alias("ids"))
    dealt = texts.repartition("low", "high").sortWithinPartitions("low", "high", "range")

    def batches(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, state, done = None, None, []
        pack = lambda rows: pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows)], names=["low", "high", "ends_sha256"])
        for b in it:
            for low, high, ids in zip(*(b.column(k).to_pylist() for k in range(3))):
                if (low, high) != key:
                    if key is not None:
                        done.append((*key, state.hexdigest()))
                    key, state = (low, high), hashlib.sha256(ids.encode())
                else:
                    state.update(b"," + ids.encode())
            if done:
                yield pack(done)
                done = []
        if key is not None:
            yield pack([(*key, state.hexdigest())])

    return dealt.select("low", "high", "ids").mapInArrow(batches, "low long, high long, ends_sha256 string")


def same(*columns: str) -> Column:
    """Whether all rows of a group have the same values."""
    return reduce(and_, (F.min(c) == F.max(c) for c in columns))


def folded(nodes: DataFrame, below: DataFrame | None, name: str) -> DataFrame:
    """``nodes`` (with ``shard``) folded shard by shard on top of what ``below`` holds for them; written."""
    names = [c.split()[0] for c in NODE.split(", ")]
    if below is None:
        start = nodes.select("shard", *names, *[F.lit(0).cast("long").alias(c) for c in BELOW])
    else:
        start = nodes.join(below, ["low", "high"], "left").select("shard", *names, *[F.coalesce(c, F.lit(0)).alias(c) for c in BELOW])
    return written(start.groupBy("shard").applyInPandas(fold, FOLDED), name)


def held_by_tops(part: DataFrame) -> DataFrame:
    """What the parents of a shard's tops get from it."""
    return part.where("top").groupBy(F.col("parent_low").alias("low"), F.col("parent_high").alias("high")).agg(
        F.count("*").alias("n_children"), F.sum("n_leaves").alias("n_leaves"), F.sum("saved_tokens").alias("saved_tokens"))


def prefix_trie(conversations: DataFrame, block: int = 5, heads: int = 9, crown: int = CROWN, shard: int = SHARD, band: int = BAND) -> DataFrame:
    """Rows, one a node: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256, digest.

    Conversations (conv_id, turn, role, text) are ordered by turn, null first, equal turns by role and text; null roles and texts are empty.
    The first h turns of conversation c are those of the first of its block, h = crc32(c) % heads; c - c % block rounds down also
    below 0. Rows with a null conv_id belong to no conversation; repeated rows are repeated turns. An empty table gives no node, not even a root.
    """
    steps = written(prefixes(conversations, block, heads), "prefixes")
    checked = steps.groupBy("low", "high").agg(
        F.count("*").alias("n_convs"), F.min("conv_id").alias("conv_id"), F.min("depth").alias("depth"), F.min("parent_low").alias("parent_low"),
        F.min("parent_high").alias("parent_high"), F.min("n_bytes").alias("n_bytes"), same("depth", "parent_low", "parent_high", "a", "b", "n_bytes").alias("sound"))
    nodes = written(checked, "nodes")
    n, rows, sound, deepest = nodes.agg(F.count("*"), F.coalesce(F.sum("n_convs"), F.lit(0)), F.coalesce(F.min("sound"), F.lit(True)), F.coalesce(F.max("depth"), F.lit(0))).first()
    if not sound:
        raise ValueError("two prefixes have one digest")
    # nodes with more members than this have more than rows / crown prefixes each, so there are fewer than ``crown``
    high = F.col("n_convs") > max(rows // crown, FEW)
    key = ["low", "high"]
    level = F.floor(F.col("depth") / band)
    # the first node below the crown on a conversation's path, in each band, names the shard of all nodes that it is the least member of
    tops = steps.join(F.broadcast(nodes.where(high).select(*key)), key, "left_anti").groupBy("conv_id", level.alias("level")).agg(F.min_by(F.struct(*key), "depth").alias("at"))
    parts = max(LEAST_SHARDS, -(-n // shard))
    light = nodes.where(~high).withColumn("level", level).join(tops, ["conv_id", "level"]).withColumn("shard", F.pmod(F.xxhash64("at"), F.lit(parts)))
    done, given = [], []
    for k in range(deepest // band, -1, -1):
        done.append(folded(light.where(F.col("level") == k), given[-1] if given else None, "folded"))
        given.append(held_by_tops(done[-1]))
    below = reduce(DataFrame.unionByName, given).groupBy(*key).agg(*[F.sum(c).alias(c) for c in BELOW])
    upper = folded(nodes.where(high).withColumn("shard", F.lit(0)), below, "crown")
    lower = reduce(DataFrame.unionByName, done)
    # the parents of tops lie in the crown or in the band above
    if len(done) > 1:
        over = nodes.where(~high & ((F.col("depth") + 1) % band == 0)).select(F.col("low").alias("parent_low"), F.col("high").alias("parent_high"), F.col("conv_id").alias("over_conv_id"))
        lower = lower.join(over, ["parent_low", "parent_high"], "left").withColumn("parent_conv_id", F.coalesce("parent_conv_id", "over_conv_id")).drop("over_conv_id")
    parents = F.broadcast(nodes.where(high).select(F.col("low").alias("parent_low"), F.col("high").alias("parent_high"), F.col("conv_id").alias("crown_conv_id")))
    lower = lower.join(parents, ["parent_low", "parent_high"], "left")
    lower = lower.withColumn("parent_conv_id", F.when(F.col("depth") > 0, F.coalesce("parent_conv_id", "crown_conv_id"))).drop("crown_conv_id")
    ends = ends_digests(steps.where("ends").select("conv_id", *key))
    return lower.unionByName(upper).join(ends, key, "left").select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256"),
        F.lower(F.concat(F.lpad(F.hex("high"), 16, "0"), F.lpad(F.hex("low"), 16, "0"))).alias("digest"))
