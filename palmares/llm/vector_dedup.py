"""Near-duplicate embeddings: int8 tile products with a proven error bound, doubles only for pairs that may reach the threshold.

For a unit vector u with scale s, whole entries q and error e = u - s q: u.v = s t q.r + (s q).f + e.v, so the product of
two quantised vectors is off by at most (1 + |e|) |f| + |e|. Pairs that stay below the threshold with this bound are done;
the others are computed again from the entries of the table.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import join_hot, join_labels, written
from .components import components
from .vectors import entry_type, packed

THRESHOLD = 0.95
#: Most distinct vectors in a tile, and the least number of tiles a side (for parallel work on small tables).
TILE = 1 << 13
LEAST_TILES = 8
#: Rows and columns of a product that are held at once; above this share of possible pairs all of a block is computed again.
BLOCK = 1 << 10
DENSE = 1 / 32
#: Rounding of the bound itself and of products in doubles.
SLACK = 1e-9
#: Products of int8 entries over so many dimensions are whole numbers that float32 holds exactly (127 * 127 * 1024 < 2^24).
EXACT_DIMENSIONS = 1024


class Tile:
    """Distinct vectors of one length in the order of their scales: entries scaled by a power of two, norms, quantised unit vectors, error norms."""

    def __init__(self, vectors: np.ndarray):
        entries = np.ldexp(vectors.astype(np.float64), -np.frexp(np.abs(vectors).max(axis=1))[1][:, None])  # no product overflows
        norms = np.sqrt((entries**2).sum(axis=1))
        units = entries / norms[:, None]
        scales = np.abs(units).max(axis=1) / 127
        whole = np.rint(units / scales[:, None])
        errors = np.sqrt(((units - whole * scales[:, None]) ** 2).sum(axis=1)) * (1 + SLACK) + SLACK
        self.at = np.argsort(scales, kind="stable")
        self.entries, self.norms, self.scales, self.errors = entries[self.at], norms[self.at], scales[self.at], errors[self.at]
        self.quantised = whole.astype(np.int8)[self.at]


def quantised_products(a: Tile, rows: slice, b: Tile, columns: slice) -> np.ndarray:
    """Products of quantised vectors, exact: multiplied as float32 over at most 1024 dimensions at a time."""
    parts = [
        a.quantised[rows, k : k + EXACT_DIMENSIONS].astype(np.float32) @ b.quantised[columns, k : k + EXACT_DIMENSIONS].astype(np.float32).T
        for k in range(0, a.quantised.shape[1], EXACT_DIMENSIONS)]
    return parts[0] if len(parts) == 1 else np.sum(parts, axis=0, dtype=np.float64)


def error_bound(ea, eb):
    """How far the product of two quantised unit vectors with these error norms is from their cosine at the most."""
    return (1 + ea) * eb + ea + SLACK


def possible(a: Tile, rows: slice, b: Tile, columns: slice, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Positions in the block of the pairs that may have a cosine of ``threshold`` or more.

    One comparison with the block's widest bound and largest scales comes first; what passes is held against its own bound.
    """
    products = quantised_products(a, rows, b, columns)
    sa, sb, ea, eb = a.scales[rows], b.scales[columns], a.errors[rows], b.errors[columns]
    widest = (threshold - error_bound(ea.max(), eb.max())) / (sa.max() * sb.max())
    p, q = np.nonzero(products >= (widest * (1 - 1e-6) if widest > 0 else -np.inf))
    may = products[p, q] * (sa[p] * sb[q]) >= threshold - error_bound(ea[p], eb[q])
    return p[may], q[may]


def linked_pairs(a: Tile, b: Tile, same: bool, threshold: float):
    """Arrays (positions in a, positions in b) of linked pairs, block by block; within one tile each pair once."""
    for i in range(0, len(a.norms), BLOCK):
        rows = slice(i, i + BLOCK)
        for j in range(i if same else 0, len(b.norms), BLOCK):
            columns = slice(j, j + BLOCK)
            p, q = possible(a, rows, b, columns, threshold)
            if same and i == j:
                p, q = p[p < q], q[p < q]
            if not len(p):
                continue
            x, y = p + i, q + j
            if len(p) > DENSE * BLOCK * BLOCK:
                products = (a.entries[rows] @ b.entries[columns].T)[p, q]
            else:
                step = BLOCK * 8
                products = np.concatenate([np.einsum("ij,ij->i", a.entries[x[k : k + step]], b.entries[y[k : k + step]]) for k in range(0, len(x), step)])
            hit = products / (a.norms[x] * b.norms[y]) >= threshold
            if hit.any():
                yield a.at[x[hit]], b.at[y[hit]]


def tile_links(cls: np.ndarray, sizes: np.ndarray, home: np.ndarray, vectors: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(class, vectors linked in this tile, least class of its tree) of the classes with a link.

    ``home`` tells the rows of the first tile; with none of the second the tile meets itself. Memory is that of the tiles and one block.
    """
    order = np.lexsort((cls, ~home))
    cls, sizes, vectors, n_home = cls[order], sizes[order], vectors[order], int(home.sum())
    same = n_home == len(cls)
    a = Tile(vectors[:n_home])
    b, shift = (a, 0) if same else (Tile(vectors[n_home:]), n_home)
    weights, labels = np.zeros(len(cls), dtype=np.int64), np.arange(len(cls))
    for x, y in linked_pairs(a, b, same, threshold):
        y = y + shift
        np.add.at(weights, x, sizes[y])
        np.add.at(weights, y, sizes[x])
        join_labels(labels, x, y)
    hit = weights > 0
    return cls[hit], weights[hit], cls[labels[hit]]


def near_duplicate_vectors(df: DataFrame, threshold: float = THRESHOLD, vec_id: str = "vec_id", vector: str = "embedding", tile: int = TILE) -> DataFrame:
    """Rows (vec_id, n_links, component_id), one for each row: vectors of cosine ``threshold`` (above 0) or more are linked.

    Every pair of distinct vectors meets in one tile; equal vectors are compared once and counted. Null, empty and zero vectors and those
    with null or non-finite entries link with nothing; vectors of unlike lengths never link. ``component_id`` is the least id reachable, the own
    one without links. Rows that repeat an id link each for itself; rows with a null id take part, and name no component unless it has no other id.
    """
    if not threshold > 0:
        raise ValueError("the threshold must be above 0")
    kind = entry_type(df, vector)
    rows = packed(df, vec_id, vector)
    takes_part = F.col("vec").isNotNull() & ~F.col("zero")
    distinct = rows.where(takes_part).groupBy("vec").agg(F.min("vec_id").alias("least"), F.count("*").alias("size"))
    classes = written(distinct.select(F.monotonically_increasing_id().alias("cls"), F.octet_length("vec").alias("bytes"), "vec", "least", "size"), "classes")
    n = classes.count()
    tiles = max(LEAST_TILES, -(-n // tile))
    own, other = F.pmod(F.xxhash64("cls"), F.lit(tiles)), F.col("other")
    dealt = classes.select("cls", "bytes", "vec", "size", own.alias("own"), F.explode(F.sequence(F.lit(0), F.lit(tiles - 1))).alias("other"))
    dealt = dealt.select("cls", "bytes", "vec", "size", F.least("own", other).alias("a"), F.greatest("own", other).alias("b"), (F.col("own") <= other).alias("home"))

    def search(pdf: pd.DataFrame) -> pd.DataFrame:
        vectors = np.frombuffer(b"".join(pdf["vec"]), dtype=kind).reshape(len(pdf), -1)
        home = pdf["home"].to_numpy(dtype=bool)
        if pdf["a"].iloc[0] == pdf["b"].iloc[0]:
            home = np.ones(len(pdf), dtype=bool)
        elif home.all() or not home.any():
            return pd.DataFrame({"node": [], "weight": [], "root": []}, dtype="int64")
        node, weight, root = tile_links(pdf["cls"].to_numpy(), pdf["size"].to_numpy(), home, vectors, threshold)
        return pd.DataFrame({"node": node, "weight": weight, "root": root})

    links = written(dealt.groupBy("bytes", "a", "b").applyInPandas(search, "node long, weight long, root long"), "links")
    weights = links.groupBy(F.col("node").alias("cls")).agg(F.sum("weight").alias("weight"))
    roots = components(links, "node", "root").withColumnRenamed("node", "cls")
    rooted = classes.select("cls", F.sha2("vec", 256).alias("key"), "least", "size").join(roots, "cls", "left").join(weights, "cls", "left")
    rooted = written(rooted.select("key", "least", "size", F.coalesce("root", "cls").alias("root"), (F.coalesce("weight", F.lit(0)) + F.col("size") - 1).alias("n_links")), "rooted")
    named = written(rooted.groupBy("root").agg(F.min("least").alias("component_id"), F.count("*").alias("members")), "named")
    of_class = written(join_hot(rooted.select("key", "root", "size", "n_links"), named, "root", "members").select("key", "size", "n_links", "component_id"), "of-class")
    keyed = rows.select("vec_id", F.when(takes_part, F.sha2("vec", 256)).alias("key"))
    found = join_hot(keyed.where("key IS NOT NULL"), of_class, "key", "size").select("vec_id", "n_links", "component_id")
    alone = keyed.where("key IS NULL").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return found.unionByName(alone)
