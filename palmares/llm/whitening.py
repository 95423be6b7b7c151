"""Whitening of embeddings by shifted CholeskyQR.

The centred rows A are never factored themselves. Each pass adds up the Gram matrix of A over the factors found so far
(triangular solves, row block by row block, on the executors); its Cholesky factor joins them on the driver, where only
matrices of the vectors' dimension live. A shift keeps the first factors defined; passes go on until the Gram matrix is the
identity, so R = R_k ... R_1 is the R of A = QR to double precision, whatever the condition of A. An SVD of R gives the components.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written
from .vectors import binary_rows, entry_type, matrix, packed

#: Entries become whole multiples of 1 / GRID.
GRID = 256
#: Whole entries stay below this: their sums over a batch are exact.
LIMIT = 1 << 40
#: Doubles in a block of rows that a task holds at once.
BLOCK = 1 << 20
MAX_PASSES = 12
#: Passes end when no eigenvalue of the Gram matrix is further from 1.
CLOSE = 1e-8
#: Directions whose deviation is below this share of the largest one count as constant.
RANK_SHARE = 1e-9


@dataclass(frozen=True)
class Whitening:
    """``n`` distinct vectors with exact sums; components (one a row) with eigenvalues, falling; the error measured over the fit list."""

    dimension: int
    n: int
    sums: tuple[int, ...]
    components: np.ndarray
    eigenvalues: np.ndarray
    explained: np.ndarray
    identity_error: float
    passes: int


def _whole(flat: np.ndarray) -> np.ndarray:
    return np.floor(GRID * flat.astype(np.float64))


def whole_rows(df: DataFrame, dimension: int, vec_id: str, vector: str) -> DataFrame:
    """Rows (vec_id, x): x = floor(256 c) as two bytes an entry, or eight where one needs them; rows that do not take part are left out."""
    kind, id_type = entry_type(df, vector), df.schema[vec_id].dataType

    def batches(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in it:
            x = _whole(matrix(b.column(1), kind))
            most = np.abs(x).max(axis=1) if x.size else np.zeros(len(x))
            for fits, width in ((most < 1 << 15, "<i2"), ((most >= 1 << 15) & (most < LIMIT), "<i8")):
                if fits.any():
                    rows = x[fits].astype(width)
                    lengths = np.full(len(rows), rows.shape[1] * rows.itemsize)
                    yield pa.RecordBatch.from_arrays([b.column(0).filter(pa.array(fits)), binary_rows(rows, lengths, np.ones(len(rows), dtype=bool))], names=["vec_id", "x"])

    whole = packed(df, vec_id, vector).where(F.octet_length("vec") == dimension * kind.itemsize)
    return whole.mapInArrow(batches, f"vec_id {id_type.simpleString()}, x binary")


def _blocks(column: pa.Array, dimension: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(positions, whole entries) of blocks of rows."""
    lengths = pc.binary_length(column).to_numpy(zero_copy_only=False)
    step = max(1, BLOCK // dimension)
    for width in ("<i2", "<i8"):
        at = np.flatnonzero(lengths == dimension * np.dtype(width).itemsize)
        for k in range(0, len(at), step):
            yield at[k : k + step], matrix(column.take(pa.array(at[k : k + step])), np.dtype(width)).astype(np.int64)


def _centred(x: np.ndarray, n: int, sums: tuple[int, ...]) -> np.ndarray:
    """x - sums / n with one rounding: the whole part of the mean goes first."""
    return (x - np.array([s // n for s in sums])) - np.array([s % n / n for s in sums])


def _solved(rows: np.ndarray, upper: np.ndarray) -> np.ndarray:
    """rows times the inverse of an upper triangular matrix, by substitution."""
    out = np.empty_like(rows)
    for j in range(rows.shape[1]):
        out[:, j] = (rows[:, j] - out[:, :j] @ upper[:j, j]) / upper[j, j]
    return out


def _sums(fit: DataFrame, dimension: int) -> tuple[int, ...]:
    def batches(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in it:
            found = [x.sum(axis=0) for _, x in _blocks(b.column(0), dimension)]
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(np.arange(dimension, dtype=np.int32)), pa.array(np.sum(found, axis=0))], names=["j", "s"])

    parts = fit.mapInArrow(batches, "j int, s long")
    by_place = {r["j"]: int(r["s"]) for r in parts.groupBy("j").agg(F.sum(F.col("s").cast("decimal(38,0)")).alias("s")).collect()}
    return tuple(by_place[j] for j in range(dimension))


def _gram(fit: DataFrame, n: int, sums: tuple[int, ...], turned) -> tuple[np.ndarray, np.ndarray]:
    """Gram matrix and column sums of ``turned(A)``, A the centred fit list: one matrix a task, added up entry by entry on the executors."""
    dimension = len(sums)

    def batches(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for b in it:
            for _, x in _blocks(b.column(0), dimension):
                y = turned(_centred(x, n, sums))
                part = np.vstack([y.T @ y, y.sum(axis=0)])
                total = part if total is None else total + part
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total), dtype=np.int32)), pa.array(total.tolist(), pa.list_(pa.float64()))], names=["i", "row"])

    parts = fit.mapInArrow(batches, "i int, row array<double>").select("i", F.posexplode("row").alias("j", "v"))
    cells = parts.groupBy("i", "j").agg(F.sum("v").alias("v")).toArrow().to_pandas()
    k = int(cells["j"].max()) + 1
    out = np.zeros((k + 1, k))
    out[cells["i"], cells["j"]] = cells["v"]
    return (out[:k] + out[:k].T) / 2, out[k]


def _factors(fit: DataFrame, n: int, sums: tuple[int, ...]) -> tuple[np.ndarray, int]:
    """(R, passes): R'R is the Gram matrix of the centred fit list."""
    d, unit = len(sums), np.finfo(float).eps / 2
    found: list[np.ndarray] = []
    for k in range(MAX_PASSES):
        gram, _ = _gram(fit, n, sums, lambda rows, fs=tuple(found): _through(rows, fs))
        values, vectors = np.linalg.eigh(gram)
        top = values[-1]
        if top <= 0:
            return np.zeros((d, d)), k + 1
        range_ = values > 1e-10
        least = min(11 * (n * d + d * (d + 1)) * unit, 1e-3) * top
        if k and np.abs(values[range_] - 1).max(initial=0) <= max(CLOSE, 0.0 if range_.all() else 2 * least):
            # so near the identity the last factor is known to all digits; only rounding is left in other directions, which are constant
            last = (vectors * np.sqrt(np.where(range_, values, 0))) @ vectors.T
            break
        shift = 0.0 if k and range_.all() else least
        while True:
            try:
                found.append(np.linalg.cholesky(gram + shift * np.eye(d)).T)
                break
            except np.linalg.LinAlgError:
                shift = max(4 * shift, least)
    else:
        raise RuntimeError(f"the rows did not become orthogonal in {MAX_PASSES} passes")
    whole = last
    for f in reversed(found):
        whole = whole @ f
    return whole, k + 1


def _through(rows: np.ndarray, factors: tuple[np.ndarray, ...]) -> np.ndarray:
    for f in factors:
        rows = _solved(rows, f)
    return rows


def fit_whitening(df: DataFrame, k: int = 4, vec_id: str = "vec_id", vector: str = "embedding") -> Whitening | None:
    """Fit over the distinct whole vectors; None if no row takes part.

    Left out: null vectors, those with null or non-finite entries or entries of 2^32 and more, and vectors of another
    length than the commonest (of equally common ones the longest). Directions without deviation have no component,
    so fewer than ``k`` may come back, none for a single distinct vector. Each component's largest entry is positive.
    """
    kind = entry_type(df, vector)
    lengths = packed(df, vec_id, vector).where("vec IS NOT NULL").groupBy(F.octet_length("vec").alias("bytes")).count()
    common = lengths.where("bytes > 0").orderBy(F.desc("count"), F.desc("bytes")).first()
    if common is None:
        return None
    d = common["bytes"] // kind.itemsize
    fit = written(whole_rows(df, d, vec_id, vector).groupBy("x").agg(F.lit(1).alias("one")).select("x"), "fit-list")
    n = fit.count()
    if not n:
        return None
    sums = _sums(fit, d)
    r, passes = _factors(fit, n, sums)
    _, s, vt = np.linalg.svd(r)
    kept = min(k, int((s > RANK_SHARE * s[0]).sum())) if s[0] > 0 else 0
    parts = vt[:kept]
    parts = parts * np.sign(parts[np.arange(kept), np.abs(parts).argmax(axis=1)])[:, None] if kept else parts
    values = s[:kept] ** 2 / n
    share = s[:kept] ** 2 / (s**2).sum() if kept else values
    error = 0.0
    if kept:
        onto = parts.T / np.sqrt(values)
        gram, total = _gram(fit, n, sums, lambda rows: rows @ onto)
        error = float(np.abs(gram / n - np.outer(total, total) / n**2 - np.eye(kept)).max())
    return Whitening(d, n, sums, parts, values, share, error, passes)


def deviations(x: np.ndarray, n: int, sums: tuple[int, ...]) -> list[int]:
    """Sum over the dimensions of (n x - sums)^2 for every row, exact."""
    large = max(1, int(np.abs(x).max(initial=0)))
    exact = lambda bound: np.int64 if bound * x.shape[1] < 1 << 62 else object
    squares = (x.astype(exact(large * large)) ** 2).sum(axis=1)
    own = exact(large * max(1, *map(abs, sums)))
    crossed = x.astype(own) @ np.array(sums, dtype=own)
    all_sums = sum(s * s for s in sums)
    return [n * n * int(a) - 2 * n * int(b) + all_sums for a, b in zip(squares, crossed)]


def whitened(df: DataFrame, fit: Whitening | None, vec_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """Rows (vec_id, whitened array<double>, deviation decimal): one for every row that takes part, repeated rows too.

    ``whitened`` has an entry for each component of the fit; ``deviation`` is null where it has over 38 digits. No shuffle.
    """
    id_type = df.schema[vec_id].dataType
    schema = f"vec_id {id_type.simpleString()}, whitened array<double>, deviation decimal(38,0)"
    if fit is None:
        return df.sparkSession.createDataFrame([], schema)
    onto = fit.components.T / np.sqrt(fit.eigenvalues)
    d, n, sums, most = fit.dimension, fit.n, fit.sums, 10**38

    def batches(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in it:
            for at, x in _blocks(b.column(1), d):
                turned = _centred(x, n, sums) @ onto
                lists = pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1, dtype=np.int32) * onto.shape[1]), pa.array(turned.ravel()))
                apart = pa.array([Decimal(v) if v < most else None for v in deviations(x, n, sums)], pa.decimal128(38, 0))
                yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(at)), lists, apart], names=["vec_id", "whitened", "deviation"])

    return whole_rows(df, d, vec_id, vector).mapInArrow(batches, schema)
