"""Whitening of embeddings: covariance summed over the tasks, leading eigenvectors, broadcast projection.

Entries become whole numbers x = floor(256 c). The statistics are those of the fit list, each distinct x
once. Rows that surely have no equal (a two-pass filter over hashes, of bounded size) go into it where
they are; only the others are shuffled for the exact test. Sums are whole numbers and exact. Then every
task adds up its rows' centred products, and the tasks' matrices are added by rows of the matrix.

The driver sees one matrix of dimension times dimension, whatever the rows. It is brought to tridiagonal
form by Householder reflections; the leading eigenvalues come from bisection on Sturm counts, the
eigenvectors from inverse iteration, orthogonalised against those of nearby eigenvalues, and go back
through the reflections. Means and components are broadcast and every row is projected where it is.

Defined cases: a row whose vector is null, or has an entry that is null, not finite or so large that x
takes more than 45 bits, is left out; so is a vector of another length than most rows have (the longer,
if two are as frequent). Repeated rows are projected one by one. A component whose variance is nothing
but rounding (at most ``NO_VARIANCE`` of the largest) isn't given, so equal vectors alone give no rows; an
empty table gives an empty result. A deviation beyond 64 bits is null. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import filter_bits, staged, with_filter_hit
from .exact_dedup import HASHES, repeated_cells

UNIT = 256
#: Entries whose x is smaller than this; their products with counts and their sums stay exact.
LARGEST = 2**45
#: Part of the largest eigenvalue below which another is rounding.
NO_VARIANCE = 1e-12
#: Rows of a block when products are added up.
BLOCK = 4096


# --- eigenvectors of one matrix -----------------------------------------------------------------


def tridiagonal(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """Diagonal, second diagonal and reflections of a symmetric matrix (Householder)."""
    a = matrix.astype(np.float64).copy()
    n = len(a)
    reflections = []
    for k in range(n - 2):
        v = a[k + 1 :, k].copy()
        size = np.linalg.norm(v)
        if size > 0:
            v[0] += size if v[0] >= 0 else -size
            v /= np.linalg.norm(v)
            below = a[k + 1 :, k + 1 :]
            p = below @ v
            w = p - (v @ p) * v
            below -= 2 * (np.outer(v, w) + np.outer(w, v))
            a[k + 1, k] = a[k, k + 1] = -size if a[k + 1, k] >= 0 else size
        reflections.append(v)
    return np.diag(a).copy(), np.diag(a, -1).copy(), reflections


def reflected(vectors: np.ndarray, reflections: list[np.ndarray]) -> np.ndarray:
    """Columns in the tridiagonal matrix's coordinates brought back to the first ones."""
    out = vectors.copy()
    for k in range(len(reflections) - 1, -1, -1):
        v = reflections[k]
        out[k + 1 :] -= 2 * np.outer(v, v @ out[k + 1 :])
    return out


def smaller(diagonal: np.ndarray, second: np.ndarray, at: float) -> int:
    """Sturm count: how many eigenvalues are smaller than ``at``."""
    count, pivot = 0, 1.0
    tiny = np.finfo(np.float64).tiny * max(1.0, float(np.max(second**2, initial=0.0)))
    for i, d in enumerate(diagonal):
        pivot = d - at - (second[i - 1] ** 2 / pivot if i else 0.0)
        if abs(pivot) < tiny:
            pivot = -tiny
        count += pivot < 0
    return count


def leading_values(diagonal: np.ndarray, second: np.ndarray, count: int) -> np.ndarray:
    """The ``count`` largest eigenvalues, falling, each bisected until no double lies between its bounds."""
    n = len(diagonal)
    reach = np.abs(np.concatenate(([0.0], second))) + np.abs(np.concatenate((second, [0.0])))
    least, most = float((diagonal - reach).min()), float((diagonal + reach).max())
    most += abs(most) * 1e-15 + np.finfo(np.float64).tiny
    out = []
    for k in range(count):
        low, high = least, out[-1] if out else most
        # of n eigenvalues, n - 1 - k are smaller than the one that is asked for
        if out and smaller(diagonal, second, high) <= n - 1 - k:
            out.append(high)
            continue
        while low < (middle := (low + high) / 2) < high:
            if smaller(diagonal, second, middle) <= n - 1 - k:
                low = middle
            else:
                high = middle
        out.append(low)
    return np.array(out)


def _solved(diagonal: np.ndarray, second: np.ndarray, shift: float, right: np.ndarray, tiny: float) -> np.ndarray:
    """x of (T - shift) x = right, by elimination with row exchanges."""
    n = len(diagonal)
    d, up, up2, x = diagonal - shift, np.append(second, 0.0), np.zeros(n), right.copy()
    for i in range(n - 1):
        if abs(second[i]) > abs(d[i]):
            factor = d[i] / second[i]
            d[i], up[i], d[i + 1], up2[i], up[i + 1] = second[i], d[i + 1], up[i] - factor * d[i + 1], up[i + 1], -factor * up[i + 1]
            x[i], x[i + 1] = x[i + 1], x[i] - factor * x[i + 1]
        else:
            factor = second[i] / d[i] if d[i] else 0.0
            d[i + 1] -= factor * up[i]
            x[i + 1] -= factor * x[i]
    for i in range(n - 1, -1, -1):
        total = x[i] - (up[i] * x[i + 1] if i + 1 < n else 0.0) - (up2[i] * x[i + 2] if i + 2 < n else 0.0)
        x[i] = total / (d[i] if abs(d[i]) > tiny else tiny)
    return x


def tridiagonal_vectors(diagonal: np.ndarray, second: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Unit eigenvectors as columns; those of a cluster of near values are kept orthogonal."""
    n = len(diagonal)
    scale = float(np.abs(diagonal).max(initial=0.0) + 2 * np.abs(second).max(initial=0.0)) or 1.0
    tiny, near = np.finfo(np.float64).eps * scale, 1e-3 * scale
    out = np.zeros((n, len(values)))
    draws = np.random.default_rng(12)
    for k, value in enumerate(values):
        first = k
        while first and values[first - 1] - values[first] <= near:
            first -= 1
        others, x = out[:, first:k], draws.standard_normal(n)
        # equal shifts would give the same vector again
        shift = value - tiny * (k - first)
        for _ in range(8):
            x = _solved(diagonal, second, shift, x / np.linalg.norm(x), tiny)
            for _ in range(2):
                x -= others @ (others.T @ x)
        out[:, k] = x / np.linalg.norm(x)
    return out


def leading(matrix: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray]:
    """The largest eigenvalues, falling, and their unit eigenvectors as columns."""
    diagonal, second, reflections = tridiagonal(matrix)
    values = leading_values(diagonal, second, min(count, len(matrix)))
    return values, reflected(tridiagonal_vectors(diagonal, second, values), reflections)


# --- sums over the tasks ------------------------------------------------------------------------


def _rows_of(column) -> np.ndarray:
    """A batch's vectors of one length as a matrix of whole numbers."""
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1) if len(column) else np.empty((0, 0), np.int64)


def _blocks(batches: Iterator, name: str) -> Iterator[np.ndarray]:
    for batch in batches:
        for low in range(0, batch.num_rows, BLOCK):
            yield _rows_of(batch.column(name).slice(low, BLOCK))


def exact_sums(rows: DataFrame, name: str) -> tuple[int, list[int]]:
    """The number of vectors and their sums by dimension, exact."""

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        count, total = 0, 0
        for block in _blocks(batches, name):
            # a block's sums have less than 58 bits; whole numbers of any length add up over the blocks
            count, total = count + len(block), total + block.sum(axis=0).astype(object)
        if count:
            every = [count, *total]
            yield pa.RecordBatch.from_arrays([pa.array(range(-1, len(total)), pa.int32()), pa.array([str(x) for x in every])], ["at", "s"])

    # one number for each task and dimension is shuffled
    parts = rows.mapInArrow(run, "at int, s string").groupBy("at").agg(F.sum(F.col("s").cast("decimal(38,0)")).alias("s"))
    found = [int(r.s) for r in parts.orderBy("at").collect()]
    return (found[0], found[1:]) if found else (0, [])


def products(rows: DataFrame, name: str, change) -> np.ndarray:
    """The sum of y y' over all rows, where ``change`` makes a block of vectors x a block of y."""

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        total = None
        for block in _blocks(batches, name):
            y = change(block)
            total = y.T @ y if total is None else total + y.T @ y
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array(range(len(total)), pa.int32()), pa.array(list(total))], ["at", "row"])

    def add(batches: Iterator) -> Iterator:
        import pyarrow as pa

        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for at, row in zip(batch.column("at").to_pylist(), _rows_of(batch.column("row")), strict=True):
                sums[at] = sums[at] + row if at in sums else row.copy()
        if sums:
            yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int32()), pa.array(list(sums.values()))], ["at", "row"])

    kind = "at int, row array<double>"
    # each task's matrix is dealt out by its rows; the driver gets the sum, of bounded size
    parts = rows.mapInArrow(run, kind).repartition("at").mapInArrow(add, kind)
    return np.array([r.row for r in sorted(parts.collect(), key=lambda r: r.at)])


# --- the operator -------------------------------------------------------------------------------


def usable(rows: DataFrame, vector_column: str) -> DataFrame:
    """(row, x): the rows whose vectors are whole, as structs, with their x."""
    vector = F.col(f"`{vector_column}`").cast("array<double>")
    named = rows.select(F.struct(*[F.col(f"`{c}`") for c in rows.columns]).alias("row"), vector.alias("v"))
    # not a number counts as larger than any number
    whole = F.forall("v", lambda c: c.isNotNull() & (F.abs(c) < LARGEST / UNIT))
    found = named.filter(F.col("v").isNotNull() & (F.size("v") > 0) & whole)
    lengths = found.groupBy(F.size("v").alias("size")).count()
    most = lengths.orderBy(F.desc("count"), F.desc("size")).first()
    found = found.filter(F.size("v") == (most["size"] if most else 0))
    return found.select("row", F.transform("v", lambda c: F.floor(c * F.lit(float(UNIT)))).alias("x"))


def fit_list(rows: DataFrame) -> DataFrame:
    """Each distinct ``x`` of ``rows`` once."""
    hashed = rows.select("x", F.xxhash64("x").alias("key"))
    keys = staged(hashed.select("key"), "vector-hashes")
    bits = filter_bits(keys.count())
    marked = staged(repeated_cells(keys, "key", bits), "repeated-vectors")
    probed = with_filter_hit(hashed, marked, F.col("key"), bits, HASHES, "suspect")
    # of a vector that many rows have, each task sends one
    return probed.filter("not suspect").select("x").unionByName(probed.filter("suspect").select("x").distinct())


@dataclass(frozen=True)
class Whitening:
    """What was fitted; ``projected`` applies it."""

    n: int
    sums: list[int]
    values: np.ndarray
    vectors: np.ndarray
    explained: np.ndarray
    identity_error: float

    def projected(self, rows: DataFrame) -> DataFrame:
        """One row for each row of ``rows`` (row, x) and component: row, component, n, deviation, whitened, explained, identity_error."""
        n, sums, explained = self.n, np.array(self.sums), self.explained
        change = _whitened(self)
        count = len(self.values)

        def run(batches: Iterator) -> Iterator:
            import pyarrow as pa

            for batch in batches:
                for low in range(0, batch.num_rows, BLOCK):
                    part = batch.slice(low, BLOCK)
                    x = _rows_of(part.column("x"))
                    y = change(x)
                    deviations = deviation(x, n, sums)
                    at = np.repeat(np.arange(len(x)), count)
                    columns = [part.column("row").take(pa.array(at)), pa.array(np.tile(np.arange(1, count + 1, dtype=np.int32), len(x)))]
                    columns += [pa.array([deviations[i] for i in at], pa.int64()), pa.array(y.ravel()), pa.array(np.tile(explained, len(x)))]
                    yield pa.RecordBatch.from_arrays(columns, ["row", "component", "deviation", "whitened", "explained"])

        kind = f"row {rows.schema['row'].dataType.simpleString()}, component int, deviation long, whitened double, explained double"
        if not count:
            return rows.sparkSession.createDataFrame([], f"{kind}, n long, identity_error double")
        return rows.mapInArrow(run, kind).withColumns({"n": F.lit(n).cast("long"), "identity_error": F.lit(self.identity_error)})


def deviation(x: np.ndarray, n: int, sums: np.ndarray) -> list[int | None]:
    """The sum over dimensions of (n x - S)^2, exact; null beyond 64 bits."""
    bound = float(n) * float(np.abs(x).max(initial=0)) + float(np.abs(sums.astype(np.float64)).max(initial=0.0))
    if len(x) and bound * bound * x.shape[1] >= 2.0**62:
        exact = [sum((n * int(c) - int(s)) ** 2 for c, s in zip(row, sums, strict=True)) for row in x]
        return [e if e < 2**63 else None for e in exact]
    return ((n * x - sums.astype(np.int64)) ** 2).sum(axis=1).tolist() if len(x) else []


def _whitened(fitted: Whitening):
    """Function from a block of x to its whitened components; only small arrays travel with it."""
    mean, axes = np.array([s / fitted.n for s in fitted.sums]), fitted.vectors / np.sqrt(fitted.values)
    return lambda x: (x - mean) @ axes


def fitted(rows: DataFrame, components: int = 4) -> Whitening:
    """Fit on ``rows`` (column ``x``), each distinct vector once."""
    listed = staged(fit_list(rows), "fit-list")
    n, sums = exact_sums(listed, "x")
    if not n:
        return Whitening(0, [], np.empty(0), np.empty((0, 0)), np.empty(0), 0.0)
    mean = np.array([s / n for s in sums])
    covariance = products(listed, "x", lambda x: x - mean) / n
    values, vectors = leading(covariance, components)
    real = values > NO_VARIANCE * max(float(values.max(initial=0.0)), float(np.finfo(np.float64).tiny))
    values, vectors = values[real], vectors[:, real]
    first = Whitening(n, sums, values, vectors, values / np.trace(covariance), 0.0)
    if not len(values):
        return first
    # the fit list's mean is zero but for rounding
    error = np.abs(products(listed, "x", _whitened(first)) / n - np.eye(len(values))).max()
    return Whitening(n, sums, values, vectors, first.explained, float(error))


def whiten(rows: DataFrame, id_column: str = "vec_id", vector_column: str = "embedding", components: int = 4) -> DataFrame:
    """One row for each usable row of ``rows`` and component: id, component, n, deviation, whitened, explained, identity_error."""
    x = usable(rows.select(F.col(f"`{id_column}`"), F.col(f"`{vector_column}`")), vector_column).select(F.col(f"row.`{id_column}`").alias("row"), "x")
    out = fitted(x, components).projected(x)
    return out.select(F.col("row").alias(id_column), "component", "n", "deviation", "whitened", "explained", "identity_error")
