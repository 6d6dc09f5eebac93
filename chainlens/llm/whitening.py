"""Embedding whitening from a bit-sliced scatter.

Components are quantised to x = floor(scale * c).  Every distinct x vector is
fitted once.  A task holds its vectors as bit planes: dimension i, shifted by
its least value in the block, has plane a with bit a of every row, packed 64
rows to a word.  The sum over rows of y_i * y_j is then the sum over planes of
2^(a+b) * popcount(plane_ia AND plane_jb), exactly; shifts are undone in whole
numbers.  The blocks' sums are added up by Spark as decimals, and the driver
gets one number for each pair of dimensions, centres them as whole numbers
(n * sum x_i x_j - S_i S_j) and only then turns to doubles for eigh.

What the driver holds grows with the square of the dimensions, at most
MOST_DIMENSIONS of them, never with the rows.

Defined results: rows whose vector is null, or holds a null, a non-finite entry
or one whose x does not lie within +-2^31, take no part.  If vectors have
several lengths, those of the commonest length do (ties: the longest).  Repeated
rows each get their own result, as do rows of null or equal vec_id.  Components
of no variance (eigenvalue at most dimensions * 2^-52 of the largest) do not
exist, so n = 1, or vectors of no entries, give no rows, as does an empty
table.  deviation is null where it does not fit a long (the exact whole numbers
are in ``deviations``).  Equal eigenvalues: any basis of their space, the same
for all rows.  Other columns are ignored by ``whiten`` but for those named.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chainlens.llm.common import by_value, stored

by_value(__name__)

SCALE = 256
MOST_DIMENSIONS = 4096
#: Rows whose planes are compared at a time: 64 words a plane.
BLOCK_ROWS = 4096
#: |x| below it: sums over a block of products stay within 64 bits.
X_BOUND = 1 << 31


def quantised(rows: DataFrame, vector: str = "embedding", scale: int = SCALE) -> DataFrame:
    """``rows`` that take part, with x: array<long> in place of ``vector``."""
    c = lambda v: v.cast("double")
    fits = lambda v: v.isNotNull() & ~F.isnan(c(v)) & (F.abs(c(v)) * scale < float(X_BOUND))
    good = rows.where(F.col(vector).isNotNull()).where(F.forall(vector, fits))
    return good.withColumn("x", F.transform(vector, lambda v: F.floor(c(v) * scale).cast("long"))).drop(vector)


def commonest_length(x: DataFrame) -> int | None:
    """The length of most vectors (ties: the longest); None without rows."""
    row = x.groupBy(F.size("x").alias("d")).agg(F.count("*").alias("n")).agg(F.max_by("d", F.struct("n", "d")).alias("d")).first()
    return row.d


def bit_planes(y: np.ndarray, bits: int) -> np.ndarray:
    """Planes of a block of non-negative whole numbers (rows, dimensions):
    (dimensions, bits, words), 64 rows to a word; missing rows are zero."""
    rows, dims = y.shape
    words = -(-rows // 64)
    flat = np.zeros((dims, words * 64), dtype=np.uint64)
    flat[:, :rows] = y.T
    planes = np.empty((dims, bits, words), dtype=np.uint64)
    for b in range(bits):
        one = ((flat >> np.uint64(b)) & np.uint64(1)).astype(np.uint8)
        planes[:, b] = np.packbits(one, axis=1, bitorder="little").view("<u8")
    return planes


def cross_products(y: np.ndarray) -> list[np.ndarray]:
    """Row i: the sums over rows of y_i * y_j for j >= i, as Python whole numbers
    in object arrays; ``y`` is non-negative."""
    dims = y.shape[1]
    bits = max(1, int(y.max()).bit_length())
    planes = bit_planes(y, bits)
    weight = np.array([1 << b for b in range(bits)], dtype=object)
    out = []
    for i in range(dims):
        total = np.zeros(dims - i, dtype=object)
        for a in range(bits):
            if planes[i, a].any():
                both = np.bitwise_count(planes[i:, :, :] & planes[i, a]).sum(axis=2, dtype=np.int64)
                total += (both.astype(object) * weight).sum(axis=1) * (1 << a)
        out.append(total)
    return out


def scatter_rows(batches: Iterator[pa.RecordBatch], dims: int) -> Iterator[pa.RecordBatch]:
    """One task's (i, j, total): for j = -1 the sum of x_i, for j >= i the sum of
    x_i * x_j, and (-1, -1) the number of rows, as decimals."""
    cross = [np.zeros(dims - i, dtype=object) for i in range(dims)]
    sums, n = np.zeros(dims, dtype=object), 0
    for b in batches:
        every = b.column(0).flatten().to_numpy(zero_copy_only=False).reshape(-1, dims)
        for lo in range(0, len(every), BLOCK_ROWS):
            x = every[lo:lo + BLOCK_ROWS]
            shift = x.min(axis=0)
            y = (x - shift).astype(np.uint64)
            s = shift.astype(object)
            of_y = y.sum(axis=0, dtype=np.uint64).astype(object)
            for i, total in enumerate(cross_products(y)):
                cross[i] += total + s[i] * of_y[i:] + s[i:] * of_y[i] + len(x) * s[i] * s[i:]
            sums += of_y + len(x) * s
            n += len(x)
    if not n:
        return
    kinds = pa.schema([("i", pa.int32()), ("j", pa.int32()), ("total", pa.string())])
    heads = [(-1, -1, n), *((i, -1, v) for i, v in enumerate(sums))]
    for rows in (heads, *([(i, i + k, v) for k, v in enumerate(cross[i])] for i in range(dims))):
        i, j, v = zip(*rows)
        yield pa.RecordBatch.from_arrays([pa.array(i, pa.int32()), pa.array(j, pa.int32()), pa.array([str(int(t)) for t in v])], schema=kinds)


@dataclass
class Fit:
    """n distinct vectors, their sums S by dimension, the eigenvalues e of the
    covariance of x that are kept, falling, the unit eigenvectors as rows of
    ``vectors``, and the covariance's trace."""

    n: int
    sums: list[int]
    values: np.ndarray
    vectors: np.ndarray
    trace: float


def fit(x: DataFrame, dims: int, components: int) -> Fit:
    """Fit the distinct vectors ``x`` (column x, each of ``dims`` entries)."""
    if dims > MOST_DIMENSIONS:
        raise ValueError(f"{dims} dimensions; the driver holds at most {MOST_DIMENSIONS} squared")
    parts = x.select("x").mapInArrow(lambda b: scatter_rows(b, dims), "i int, j int, total string")
    added = parts.groupBy("i", "j").agg(F.sum(F.col("total").cast("decimal(38,0)")).alias("total"))
    n, sums, cross = 0, [0] * dims, np.zeros((dims, dims), dtype=object)
    for r in added.toLocalIterator():  # one row for each pair of dimensions
        v = int(r.total)
        if r.i < 0:
            n = v
        elif r.j < 0:
            sums[r.i] = v
        else:
            cross[r.i, r.j] = cross[r.j, r.i] = v
    s = np.array(sums, dtype=object)
    centred = n * cross - np.outer(s, s)  # whole numbers: n^2 times the covariance
    trace = int(np.trace(centred)) / n**2
    values, vectors = np.linalg.eigh((centred / n**2).astype(np.float64))
    order = np.argsort(-values, kind="stable")
    keep = [k for k in order if values[k] > dims * 2.0**-52 * values[order[0]]][:components] if trace > 0 else []
    return Fit(n, sums, values[keep], vectors[:, keep].T, trace)


def _centred(every: np.ndarray, fitted: Fit) -> np.ndarray:
    """n * x - S, exactly; Python whole numbers where they may not fit 64 bits."""
    most = max([abs(v) for v in fitted.sums] + [0]) + fitted.n * max(int(np.abs(every).max(initial=0)), 1)
    if most * most * max(1, len(fitted.sums)) < 1 << 63:
        return every * fitted.n - np.array(fitted.sums, dtype=np.int64)
    return every.astype(object) * fitted.n - np.array(fitted.sums, dtype=object)


def projected(x: DataFrame, fitted: Fit, dims: int, keep: list[str]) -> DataFrame:
    """``keep``, deviations (text of the exact whole number), whitened (array of
    one double for each component) of each row of ``x``."""
    basis = (fitted.vectors / np.sqrt(fitted.values)[:, None]).T
    fields = ", ".join(f"`{c}` {x.schema[c].dataType.simpleString()}" for c in keep)

    def run(batches):
        for b in batches:
            every = b.column(b.schema.get_field_index("x")).flatten().to_numpy(zero_copy_only=False).reshape(-1, dims)
            if not len(every):
                continue
            off = _centred(every, fitted)
            deviation = (off * off).sum(axis=1)
            white = (off.astype(np.float64) / fitted.n) @ basis
            k = white.shape[1]
            lists = pa.ListArray.from_arrays(np.arange(0, len(white) * k + 1, k, dtype=np.int32), pa.array(white.ravel()))
            yield pa.RecordBatch.from_arrays([*(b.column(b.schema.get_field_index(c)) for c in keep),
                                              pa.array([str(int(v)) for v in deviation]), lists], names=[*keep, "deviations", "whitened"])

    return x.select(*keep, "x").mapInArrow(run, f"{fields + ', ' if keep else ''}deviations string, whitened array<double>")


def identity_error(white: DataFrame, components: int) -> float:
    """Largest absolute entry of the covariance (divisor n, Spark's centred
    ``covar_pop``) of the fit list's whitened vectors minus the identity."""
    pairs = [(i, j) for i in range(components) for j in range(i, components)]
    w = lambda i: F.col("whitened").getItem(i)
    row = white.agg(*[F.covar_pop(w(i), w(j)).alias(f"c{i}_{j}") for i, j in pairs]).first()
    return max(abs(row[f"c{i}_{j}"] - (i == j)) for i, j in pairs)


def whiten(rows: DataFrame, components: int = 4, id_col: str = "vec_id", vector: str = "embedding", scale: int = SCALE) -> DataFrame:
    """One row for each row of ``rows`` that takes part and each component:
    ``id_col``, component (from 1), n, deviation, deviations, whitened, explained,
    identity_error."""
    spark = rows.sparkSession
    x = quantised(rows.select(id_col, vector), vector, scale)
    kind = rows.schema[id_col].dataType.simpleString()
    empty = spark.createDataFrame([], f"`{id_col}` {kind}, component int, n long, deviation long, deviations string, "
                                      "whitened double, explained double, identity_error double")
    dims = commonest_length(x)
    if not dims:
        return empty
    x = x.where(F.size("x") == dims)
    distinct = stored(x.select("x").distinct(), "whiten-fit")
    fitted = fit(distinct, dims, components)
    k = len(fitted.values)
    if not k:
        return empty
    error = identity_error(projected(distinct, fitted, dims, []), k)
    explained = F.array(*[F.lit(float(e / fitted.trace)) for e in fitted.values])
    out = projected(x, fitted, dims, [id_col]).select(id_col, "deviations", F.posexplode("whitened").alias("at", "whitened"))
    return out.select(id_col, (F.col("at") + 1).cast("int").alias("component"), F.lit(fitted.n).cast("long").alias("n"),
                      F.expr("try_cast(deviations AS long)").alias("deviation"), "deviations", "whitened",
                      F.get(explained, F.col("at")).alias("explained"), F.lit(float(error)).alias("identity_error"))
