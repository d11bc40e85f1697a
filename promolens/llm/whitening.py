"""Whitening of embedding vectors with FEAST, an eigensolver by contour integration.

Entries become integers, ``floor(64 * c) + 1000000``, and the fit list holds each distinct
integer vector once.  Sums are added up exactly; the covariance is added up from centred
vectors, task by task, so only matrices as large as one vector squared are ever gathered.

The eigenvalues wanted are the largest.  The inertia of the shifted covariance (signs of
the pivots of a symmetric factorisation) counts the eigenvalues below any number, and by
bisection cuts the spectrum into intervals of few eigenvalues each.  Every interval is a
task of its own: quadrature over a circle around it, a complex solve of the shifted
covariance at each node, projects a block of vectors onto the eigenvectors inside;
Rayleigh-Ritz extracts them, and this is repeated until the residuals are at rounding level.
The count of each interval must be the difference of the inertia counts at its ends, else
the interval is tried again with a larger block, and at last refused: none is missed.

Eigenvalues closer together than rounding can tell stay in one interval, and eigenvectors of
equal eigenvalues are any orthonormal ones of their space, the same for all rows.

Defined results: rows whose vector is null, empty, or holds null, non-finite or entries of
2^55 or more are dropped; null ids stay; repeated rows count once in the fit list and come
out each; vectors of the length that most distinct vectors have are whitened, of equally many
the longer, and others are dropped; components without variance (at rounding level) are not
returned, so a fit list of one vector gives no rows, like an empty table; ``deviation`` is null
where it is no long.  Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from promolens.llm.common import stored

#: Eigenvalues of one interval, nodes of the half circle, rounds, and tries with larger blocks.
EACH, NODES, ROUNDS, TRIES = 8, 8, 12, 4
#: Largest magnitude of an entry, so that it stays a long.
LARGEST = float(2**55)
SEED = 11


def integers(vector: Column) -> Column:
    """``floor(64 * c) + 1000000`` for each entry; null if the vector cannot be used."""
    usable = vector.isNotNull() & (F.size(vector) > 0) & F.forall(
        vector, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < LARGEST))
    return F.when(F.coalesce(usable, F.lit(False)), F.transform(
        vector, lambda c: F.floor(c.cast("double") * 64).cast("long") + 1_000_000))


# ---- the spectrum, on one matrix ------------------------------------------------------------

def below(matrix: np.ndarray, shift: float) -> int:
    """How many eigenvalues are smaller than ``shift``: the negative pivots of a symmetric
    factorisation of ``matrix - shift`` with pivots of one or two rows."""
    a = matrix - shift * np.eye(len(matrix))
    negative, at, size = 0, 0, len(a)
    alpha = (1 + np.sqrt(17)) / 8
    while at < size:
        rest = a[at:, at:]
        column = np.abs(rest[1:, 0])
        two = False
        if len(column) and column.max() > 0 and abs(rest[0, 0]) < alpha * column.max():
            # the largest entry beside the diagonal, or else the largest one of its row
            r = 1 + int(column.argmax())
            row = np.abs(rest[r])
            row[r] = 0
            if abs(rest[0, 0]) * row.max() < alpha * column.max() ** 2:
                if abs(rest[r, r]) >= alpha * row.max():
                    _swap(rest, 0, r)
                else:
                    _swap(rest, 1, r)
                    two = True
        if two:
            pivot = rest[:2, :2]
            det = pivot[0, 0] * pivot[1, 1] - pivot[0, 1] ** 2
            negative += 1 if det < 0 else 2 * (pivot[0, 0] + pivot[1, 1] < 0)
            rest[2:, 2:] -= rest[2:, :2] @ np.linalg.solve(pivot, rest[:2, 2:])
        else:
            negative += rest[0, 0] < 0
            if rest[0, 0] != 0:
                rest[1:, 1:] -= np.outer(rest[1:, 0], rest[0, 1:] / rest[0, 0])
        at += 1 + two
    return int(negative)


def _swap(a: np.ndarray, i: int, j: int) -> None:
    a[[i, j]] = a[[j, i]]
    a[:, [i, j]] = a[:, [j, i]]


def intervals(matrix: np.ndarray, wanted: int, each: int = EACH) -> list[tuple[float, float, int]]:
    """``(low, high, count)`` from the top down, which hold the ``wanted`` largest eigenvalues at least.
    Ends lie in the middle of gaps; eigenvalues that no gap parts stay together."""
    size = len(matrix)
    reach = np.abs(matrix).sum(1).max()
    resolution = 1e-13 * reach
    known: dict[int, tuple[float, float]] = {0: (2 * reach, 2 * reach), size + 1: (-2 * reach, -2 * reach)}

    def value(k):
        """Bounds of the k-th largest eigenvalue."""
        if k not in known:
            low, high = -1.1 * reach, 1.1 * reach
            while high - low > resolution:
                middle = (low + high) / 2
                if size - below(matrix, middle) >= k:
                    low = middle
                else:
                    high = middle
            known[k] = low, high
        return known[k]

    out, above, high = [], 0, value(1)[1] + 0.05 * reach
    while above < wanted:
        target = min(above + each, wanted)
        # downwards from the target, then upwards, for a gap that rounding cannot close
        for count in [*range(target, above, -1), *range(target + 1, size + 1)]:
            if value(count)[0] - value(count + 1)[1] > 1e4 * resolution:
                break
        low = (value(count)[0] + max(value(count + 1)[1], value(count)[0] - 0.05 * reach)) / 2
        out.append((low, high, count - above))
        above, high = count, low
    return out


def inside(matrix: np.ndarray, low: float, high: float, count: int, seed: int = SEED) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues of ``[low, high)``, falling, and unit eigenvectors as columns, by FEAST."""
    size, scale = len(matrix), np.abs(matrix).sum(1).max()
    centre, radius = (low + high) / 2, (high - low) / 2
    nodes, weights = np.polynomial.legendre.leggauss(NODES)
    angles = np.pi / 2 * (nodes + 1)
    shifts = centre + radius * np.exp(1j * angles)
    factors = weights / 2 * radius * np.exp(1j * angles)
    rng = np.random.default_rng(seed)
    eye = np.eye(size)
    best = None
    for attempt in range(TRIES):
        block = min(size, int(1.5 * count * 2**attempt) + 8)
        q = np.linalg.qr(rng.standard_normal((size, block)))[0]
        for _ in range(ROUNDS):
            y = np.zeros_like(q)
            for z, w in zip(shifts, factors):
                y += np.real(w * np.linalg.solve(z * eye - matrix, q))
            basis, sizes, _ = np.linalg.svd(y, full_matrices=False)
            basis = basis[:, sizes > 1e-14 * max(sizes[0], np.finfo(float).tiny)]
            # Rayleigh-Ritz in the projected space
            values, small = np.linalg.eigh(basis.T @ matrix @ basis)
            vectors = basis @ small
            q = vectors
            here = np.flatnonzero((values >= low) & (values < high))
            if len(here) == count:
                found = values[here[::-1]], vectors[:, here[::-1]]
                residual = np.abs(matrix @ found[1] - found[1] * found[0]).max()
                if best is None or residual < best[0]:
                    best = residual, found
                elif residual <= 1e-12 * scale:
                    return best[1]
            if q.shape[1] < block:
                q = np.linalg.qr(np.hstack([q, rng.standard_normal((size, block - q.shape[1]))]))[0]
        if best is not None and best[0] <= 1e-11 * scale:
            return best[1]
    raise ArithmeticError(f"of {count} eigenvalues in [{low}, {high}) not all were found")


# ---- the table -----------------------------------------------------------------------------------

def _matrix(column: pa.Array, size: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, size).astype(np.int64, copy=False)


def _sums(fit: DataFrame, size: int) -> tuple[int, list[int]]:
    """Rows and exact sum of each dimension."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count, high, low = 0, np.zeros(size, np.int64), np.zeros(size, np.int64)
        for batch in batches:
            x = _matrix(batch.column(0), size)
            count += len(x)
            high += (x >> 32).sum(0)
            low += (x & 0xFFFFFFFF).sum(0)
        total = [str(int(h) * 2**32 + int(v)) for h, v in zip(high, low)]
        yield pa.RecordBatch.from_arrays([pa.array(range(size), pa.int32()), pa.array([count] * size), pa.array(total)], names=["j", "n", "s"])

    rows = fit.select("x").mapInArrow(run, "j int, n long, s string").groupBy("j").agg(
        F.sum("n").alias("n"), F.sum(F.col("s").cast("decimal(38,0)")).alias("s")).collect()
    rows.sort(key=lambda r: r["j"])
    return (rows[0]["n"], [int(r["s"]) for r in rows]) if rows else (0, [0] * size)


def _deviations(x: np.ndarray, n: int, s: list[int]) -> np.ndarray:
    """``n * x - S``, exact: as longs where they fit, else as Python's integers."""
    if n * (int(np.abs(x).max(initial=0)) + 1) + max(map(abs, s)) < 2**62:
        return n * x - np.array(s, np.int64)
    return n * x.astype(object) - np.array(s, object)


def _second_moments(fit: DataFrame, size: int, width: int, rows) -> tuple[np.ndarray, np.ndarray]:
    """Sums and products of ``rows(x)``, an array of ``width`` columns for each batch of vectors.
    Tasks send one matrix each, row by row; Spark adds up equal places."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, products, some = np.zeros(width), np.zeros((width, width)), False
        for batch in batches:
            if batch.num_rows:
                some = True
                y = rows(_matrix(batch.column(0), size))
                total += y.sum(0)
                products += y.T @ y
        if some:
            values = np.vstack([total, products])
            yield pa.RecordBatch.from_arrays([pa.array(range(-1, width), pa.int32()), pa.array(list(values))], names=["i", "v"])

    placed = fit.select("x").mapInArrow(run, "i int, v array<double>").select("i", F.posexplode("v").alias("j", "v"))
    got = placed.where("j >= i").groupBy("i", "j").agg(F.sum("v").alias("v")).toPandas()
    total, products = np.zeros(width), np.zeros((width, width))
    first = got["i"] < 0
    total[got["j"][first]] = got["v"][first]
    i, j, v = (got[c][~first].to_numpy() for c in ("i", "j", "v"))
    products[i, j] = products[j, i] = v
    return total, products


def _centred(x: np.ndarray, n: int, s: list[int]) -> np.ndarray:
    return (_deviations(x, n, s) / n).astype(np.float64)


def components(spark, covariance: np.ndarray, wanted: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``wanted`` largest eigenvalues with variance, falling, and their eigenvectors as columns.
    Each interval of the spectrum is a task."""
    size = len(covariance)
    scale = np.abs(covariance).sum(1).max()
    if not scale > 0:
        return np.zeros(0), np.zeros((size, 0))
    # eigenvalues at rounding level are none
    least = size * np.finfo(float).eps * scale
    real = size - below(covariance, least)
    cuts = intervals(covariance, min(wanted, real))
    shared = spark.sparkContext.broadcast(covariance)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for low, high, count in zip(batch["low"], batch["high"], batch["count"]):
                values, vectors = inside(shared.value, low, high, int(count))
                yield pd.DataFrame({"value": values, "vector": list(np.ascontiguousarray(vectors.T))})

    frame = spark.createDataFrame([(float(a), float(b), int(c)) for a, b, c in cuts], "low double, high double, count long")
    found = frame.repartition(len(cuts), "low").mapInPandas(run, "value double, vector array<double>").collect()
    found.sort(key=lambda r: -r["value"])
    if len(found) != sum(c for _, _, c in cuts):
        raise ArithmeticError("the intervals hold another number of eigenvalues than counted")
    values = np.array([r["value"] for r in found])
    keep = np.flatnonzero(values >= least)[:wanted]
    return values[keep], np.array([r["vector"] for r in found]).reshape(-1, size).T[:, keep]


SCHEMA = "component int, n long, deviation long, whitened double, explained double, identity_error double"


def whiten(df: DataFrame, *, key="vec_id", vector="embedding", wanted: int = 16) -> DataFrame:
    """``(key, component, n, deviation, whitened, explained, identity_error)`` for each usable row and component."""
    spark = df.sparkSession
    rows = df.select(F.col(key).alias(key), integers(F.col(vector)).alias("x")).where("x is not null")
    lists = stored(rows.select("x").distinct(), "fit")
    lengths = lists.groupBy(F.size("x").alias("size")).count().orderBy(F.desc("count"), F.desc("size")).first()
    kind = df.schema[key].dataType.simpleString()
    empty = spark.createDataFrame([], f"`{key}` {kind}, {SCHEMA}")
    if lengths is None:
        return empty
    size = lengths["size"]
    fit, rows = lists.where(F.size("x") == size), rows.where(F.size("x") == size)
    n, s = _sums(fit, size)
    shift, products = _second_moments(fit, size, size, lambda x: _centred(x, n, s))
    covariance = products / n - np.outer(shift / n, shift / n)
    values, vectors = components(spark, covariance, wanted)
    if not len(values):
        return empty
    explained = values / np.trace(covariance)
    projection = vectors / np.sqrt(values)
    mean, square = _second_moments(fit, size, len(values), lambda x: _centred(x, n, s) @ projection)
    error = float(np.abs(square / n - np.outer(mean / n, mean / n) - np.eye(len(values))).max())
    shared = spark.sparkContext.broadcast((n, s, projection))
    count = len(values)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, s, projection = shared.value
        for batch in batches:
            if not batch.num_rows:
                continue
            off = _deviations(_matrix(batch.column(1), size), n, s)
            if float(np.abs(off).max()) ** 2 * size < 2**62:
                deviation = (off * off).sum(1).tolist()
            else:
                deviation = [int(d) if d < 2**63 else None for d in (off.astype(object) ** 2).sum(1)]
            white = (off / n).astype(np.float64) @ projection
            offsets = pa.array(np.arange(0, (batch.num_rows + 1) * count, count, dtype=np.int32))
            lists = pa.ListArray.from_arrays(offsets, pa.array(white.ravel()))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(deviation, pa.int64()), lists], names=[key, "deviation", "_white"])

    out = rows.mapInArrow(run, f"`{key}` {kind}, deviation long, _white array<double>")
    out = out.select(key, "deviation", F.posexplode("_white").alias("_c", "whitened"))
    share = F.element_at(F.array(*[F.lit(float(e)) for e in explained]), F.col("_c") + 1)
    return out.select(key, (F.col("_c") + 1).alias("component"), F.lit(n).cast("long").alias("n"), "deviation", "whitened",
                      share.alias("explained"), F.lit(error).alias("identity_error"))
