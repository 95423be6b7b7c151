"""SimHash near-duplicates: fingerprints, exact Hamming links through vantage-point shards, components."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import free_name, join_labels, written
from .components import components

SEED = 42
#: Fingerprints that the tree of shards is built from, how many of all fingerprints a shard should hold, and the least number of shards. Each
#: level of the tree halves a shard but sends about 1.7 times the copies over its borders (64-bit distances crowd around 32), so comparisons
#: fall by a sixth only while rows grow: few large shards are best.
SAMPLE = 4096
SHARD = 1 << 15
LEAST_SHARDS = 8
#: Points in a leaf of the tree inside a shard.
LEAF = 1 << 10
_BLOCK = 1 << 14


def fingerprint(tokens: list[bytes], shingle: int) -> int:
    """SimHash of the shingles of ``tokens`` with repeats: a bit is set if more than half of the hashes have it.

    Fewer words than a shingle: the whole sequence is one; no word: 0.
    """
    n = len(tokens)
    if not n:
        return 0
    digest = xxhash.xxh64_intdigest
    if n <= shingle:
        return digest(b" ".join(tokens), SEED)
    parts = zip(*(tokens[k:] for k in range(shingle)))
    ones = np.zeros(64, dtype=np.int64)
    hashes = np.fromiter((digest(x, SEED) for x in map(b" ".join, parts)), dtype="<u8", count=n - shingle + 1)
    for a in range(0, len(hashes), _BLOCK):
        bits = np.unpackbits(hashes[a : a + _BLOCK].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    packed = np.packbits(ones * 2 > len(hashes), bitorder="little")
    return int(packed.view("<u8")[0])


def fingerprints(docs: DataFrame, shingle: int, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Rows (doc_id, row_hash, fp): the fingerprint of every whole text as a signed long. Null texts count as empty.

    ``row_hash`` is Spark's xxhash64 of the text and tells rows of one id apart.
    """
    id_type = docs.schema[doc_id].dataType

    def batches(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in it:
            # on bytes lower() changes A-Z alone, and split() splits at [\x20\x09-\x0D]+ alone
            fps = [fingerprint(t.lower().split() if t else [], shingle) for t in b.column(1).to_pylist()]
            signed = np.array(fps, dtype=np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(2), pa.array(signed)], names=["doc_id", "row_hash", "fp"])

    narrow = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("binary").alias("text"), F.xxhash64(text).alias("row_hash"))
    return narrow.mapInArrow(batches, f"doc_id {id_type.simpleString()}, row_hash long, fp long")


class _Node:
    """A vantage point with its radius: inside (distance <= radius) and outside, or a shard number."""

    __slots__ = ("point", "radius", "inside", "outside", "shard")

    def __init__(self, point=None, radius=0, inside=None, outside=None, shard=-1):
        self.point, self.radius, self.inside, self.outside, self.shard = point, radius, inside, outside, shard


def build_tree(sample: np.ndarray, shards: int) -> tuple[_Node, int]:
    """A vantage-point tree over a bounded sample with about ``shards`` leaves of even weight; (root, number of leaves)."""
    made = 0

    def grow(points: np.ndarray, leaves: int) -> _Node:
        nonlocal made
        if leaves >= 2 and len(points) >= 4:
            # of a few points the one whose distances spread most prunes best
            tried = points[:: max(1, len(points) // 12)][:12]
            spread = [np.bitwise_count(points ^ p).std() for p in tried]
            point = tried[int(np.argmax(spread))]
            far = np.bitwise_count(points ^ point)
            radius = int(np.median(far))
            if (far <= radius).all():
                radius = int(far.max()) - 1
            near = far <= radius
            if near.any() and not near.all():
                inner = min(leaves - 1, max(1, round(leaves * near.mean())))
                return _Node(point, radius, grow(points[near], inner), grow(points[~near], leaves - inner))
        made += 1
        return _Node(shard=made - 1)

    return grow(sample, shards), made


def route(tree: _Node, fps: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(position, shard, at home) of every shard that a fingerprint lies in or whose border is within ``radius``.

    A pair within ``radius`` meets in the home of either end: if d(x, v) > r + radius, the triangle bound
    puts everything within ``radius`` of x outside the ball (v, r), and likewise for the inside.
    """
    out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    stack = [(tree, np.arange(len(fps)), np.ones(len(fps), dtype=bool))]
    while stack:
        node, rows, home = stack.pop()
        if not len(rows):
            continue
        if node.shard >= 0:
            out.append((rows, np.full(len(rows), node.shard), home))
            continue
        far = np.bitwise_count(fps[rows] ^ node.point).astype(np.int16)
        inside = far <= node.radius
        a, b = far <= node.radius + radius, far > node.radius - radius
        stack.append((node.inside, rows[a], home[a] & inside[a]))
        stack.append((node.outside, rows[b], home[b] & ~inside[b]))
    return tuple(np.concatenate(x) for x in zip(*out))


def links(own: np.ndarray, guests: np.ndarray, radius: int, leaf: int = LEAF) -> tuple[np.ndarray, np.ndarray]:
    """Edges that connect all pairs within ``radius`` of own-own and own-guest fingerprints, as a forest.

    A vantage-point tree over the own points: whoever is more than ``radius`` outside a ball meets nothing in it, and
    the other way round, so a branch sees only the points whose distance to its vantage point allows a pair. A leaf is compared with
    all that reach it, and every hit only joins two trees of the forest: memory stays linear, also where thousands are close.
    """
    points = np.concatenate([own, guests])
    labels = np.arange(len(points))
    stack = [(np.arange(len(own)), np.arange(len(points)))]
    while stack:
        held, met = stack.pop()
        if not len(held) or not len(met):
            continue
        if len(held) > leaf:
            tried = points[held[:: max(1, len(held) // 8)][:8]]
            spread = [np.bitwise_count(points[held[:: max(1, len(held) // 256)]] ^ p).std() for p in tried]
            vantage = tried[int(np.argmax(spread))]
            far = np.bitwise_count(points[held] ^ vantage).astype(np.int16)
            ball = min(int(np.median(far)), int(far.max()) - 1)
            reach = np.bitwise_count(points[met] ^ vantage).astype(np.int16)
            inside = far <= ball
            if inside.any() and not inside.all():
                stack.append((held[inside], met[reach <= ball + radius]))
                stack.append((held[~inside], met[reach > ball - radius]))
                continue
        step = max(1, (1 << 22) // len(held))
        for k in range(0, len(met), step):
            part = met[k : k + step]
            x, y = np.nonzero(np.bitwise_count(points[part][:, None] ^ points[held][None, :]) <= radius)
            join_labels(labels, part[x], held[y])
    tied = np.flatnonzero(labels != np.arange(len(points)))
    return points[tied], points[labels[tied]]


def hamming_links(fps: DataFrame, radius: int, shard: int = SHARD, sample: int = SAMPLE) -> DataFrame:
    """Edges (u, v) whose components are those of all pairs of the distinct longs ``fps.fp`` within ``radius`` bits.

    The driver sees a sample of at most ``sample`` fingerprints, from which the shards are laid out; every
    fingerprint is routed on the executors, goes home to one shard and visits those of higher number within reach.
    ``fps`` must be a written table: it is read three times.
    """
    spark = fps.sparkSession
    n = fps.count()
    leaves = max(LEAST_SHARDS, min(-(-n // shard), sample // 4))
    by = F.xxhash64("fp", F.lit(7))
    drawn = [r[0] for r in fps.orderBy(by, "fp").limit(sample).collect()]
    tree, made = build_tree(np.array(drawn, dtype=np.int64).view(np.uint64), leaves)
    sent = spark.sparkContext.broadcast(tree)

    def deal(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in it:
            own = b.column(0).to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)
            if not len(own):
                continue
            rows, shards, home = route(sent.value, own, radius)
            at = np.zeros(len(own), dtype=np.int64)
            at[rows[home]] = shards[home]
            keep = shards >= at[rows]
            yield pa.RecordBatch.from_arrays(
                [pa.array(shards[keep].astype(np.int32)), pa.array(own[rows[keep]].view(np.int64)), pa.array(home[keep])], names=["shard", "fp", "home"])

    def search(pdf: pd.DataFrame) -> pd.DataFrame:
        fp = pdf["fp"].to_numpy(dtype=np.int64).view(np.uint64)
        home = pdf["home"].to_numpy(dtype=bool)
        u, v = links(np.sort(fp[home]), fp[~home], radius)
        return pd.DataFrame({"u": u.view(np.int64), "v": v.view(np.int64)})

    dealt = fps.select("fp").mapInArrow(deal, "shard int, fp long, home boolean")
    return dealt.groupBy("shard").applyInPandas(search, "u long, v long")


def near_duplicates(docs: DataFrame, shingle: int = 4, radius: int = 4, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Rows (doc_id, row_hash, fp, component_id): one per row of ``docs``; component_id is the least doc_id reachable over links.

    Two texts are linked if their fingerprints differ in at most ``radius`` bits; equal fingerprints always are,
    those of texts without words (0) too. Null texts count as empty. Repeated ids give repeated rows; each text of
    an id links for itself. Rows with a null id take part but never name a component, unless it has no other id (then null).
    """
    by_doc, of_class = _classes(docs, shingle, radius, doc_id, text)
    return by_doc.join(of_class, "fp").select("doc_id", "row_hash", "fp", "component_id")


def _classes(docs: DataFrame, shingle: int, radius: int, doc_id: str, text: str) -> tuple[DataFrame, DataFrame]:
    """The written fingerprints of all rows, and (fp, root, component_id) of each distinct one."""
    by_doc = written(fingerprints(docs, shingle, doc_id, text), "fingerprints")
    classes = written(by_doc.groupBy("fp").agg(F.min("doc_id").alias("least")), "classes")
    edges = hamming_links(classes, radius)
    root = components(edges, "u", "v").withColumnRenamed("node", "fp")
    rooted = classes.join(root, "fp", "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    rooted = written(rooted, "rooted")
    named = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    return by_doc, rooted.join(named, "root").select("fp", "root", "component_id")


def as_hex(fp) -> "F.Column":
    """16 lower-case hexadecimal digits of a signed long."""
    return F.lpad(F.lower(F.hex(fp)), 16, "0")


def one_of_each(docs: DataFrame, shingle: int = 4, radius: int = 4, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One document of each group of linked fingerprints, with all columns: the row of the least id, of one id that of the least text hash.

    Rows are told by id and text. Null ids come last; rows that agree in both are one document, of which the row with the least
    hash over all columns stays. An empty table gives an empty one.
    """
    by_doc, of_class = _classes(docs, shingle, radius, doc_id, text)
    rows = by_doc.join(of_class, "fp").groupBy("root", "doc_id", "row_hash").agg(F.count("*").alias("n"))
    first = rows.groupBy("root").agg(F.min(F.struct(F.col("doc_id").isNull().alias("nameless"), "doc_id", "row_hash", "n")).alias("keeper"))
    key, mark, many = free_name(docs, "kept_id"), free_name(docs, "kept_hash"), free_name(docs, "kept_rows")
    # most rows are kept, so their ids outgrow any broadcast: join by merge at every size, as large tables do
    keep = written(first.select(F.col("keeper.doc_id").alias(key), F.col("keeper.row_hash").alias(mark), F.col("keeper.n").alias(many)), "kept")

    def rows_of(kept: DataFrame) -> DataFrame:
        same = (F.xxhash64(docs[text]) == kept[mark]) & docs[doc_id].eqNullSafe(kept[key])
        return docs.join(kept.hint("merge"), same, "left_semi")

    single, repeated = keep.where(F.col(many) == 1), keep.where(F.col(many) > 1)
    if repeated.isEmpty():
        return rows_of(single)
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    least = rows_of(repeated).groupBy(F.col(doc_id).alias(key), F.xxhash64(text).alias(mark)).agg(F.min_by(whole, F.xxhash64(*docs.columns)).alias(many))
    return rows_of(single).unionByName(written(least.select(f"`{many}`.*"), "least"))
