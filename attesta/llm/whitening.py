"""Embedding whitening by spectrum slicing: inertia counts isolate the leading eigenvalues of the covariance, Rayleigh quotients find them, counts certify their numbers."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from attesta.llm import arrays as A
from attesta.llm.sums import summed

#: An entry c becomes the integer floor(SCALE * c) + SHIFT. Entries beyond +-LIMIT count as LIMIT: doubles hold integers exactly up to there.
SCALE, SHIFT, LIMIT = 1024.0, 100_000, 2.0 ** 53
COMPONENTS = 8
#: Eigenvalues are told apart down to this share of the largest one; those nearer are one cluster, in which vectors are kept orthogonal. Below NOTHING times the dimension a direction has no variance.
CLOSE, NOTHING = 1e-11, 1e-15
#: Sums of integers travel as two halves of so many bits, so that 64 bits hold the sum of a task.
HALF = 27


# --- Spectrum slicing, on a matrix as large as the dimension ---

_ALPHA = (1 + 17 ** 0.5) / 8


def eigenvalues_above(matrix: np.ndarray, shift: float) -> int:
    """How many eigenvalues of a symmetric matrix exceed `shift`: by Sylvester's law the positive pivots of an LDL^T factorisation of matrix - shift * I.

    Pivots are single entries or pairs (Bunch and Parlett): a pair is taken where an entry off the diagonal is larger than the diagonal allows, and has one sign each.
    """
    a = matrix - shift * np.eye(len(matrix))
    above = 0
    while n := len(a):
        diagonal = np.abs(np.diagonal(a))
        p = int(diagonal.argmax())
        off = np.abs(a)
        np.fill_diagonal(off, 0.0)
        i, j = divmod(int(off.argmax()), n)
        if diagonal[p] >= _ALPHA * off[i, j]:
            if a[p, p] == 0.0:  # nothing is left
                break
            above += int(a[p, p] > 0)
            keep = np.arange(n) != p
            a = a[np.ix_(keep, keep)] - np.outer(a[keep, p], a[p, keep] / a[p, p])
        else:
            above += 1
            keep = (np.arange(n) != i) & (np.arange(n) != j)
            pair = a[np.ix_([i, j], [i, j])]
            a = a[np.ix_(keep, keep)] - a[np.ix_(keep, [i, j])] @ np.linalg.solve(pair, a[np.ix_([i, j], keep)])
    return above


def _rayleigh(matrix: np.ndarray, shift: float, found: np.ndarray, inside, seed: int, rounds: int = 60) -> tuple[float, np.ndarray] | None:
    """The eigenpair to which Rayleigh quotient iteration converges from inverse iterations at `shift`, orthogonal to the `found` vectors; None if its quotient leaves the interval."""
    d = len(matrix)
    x = np.random.default_rng(seed).standard_normal(d)
    value, best = shift, None
    for k in range(rounds):
        for _ in range(2):
            x = x - found @ (found.T @ x)
        x /= np.linalg.norm(x)
        quotient = float(x @ matrix @ x)
        residual = float(np.linalg.norm(matrix @ x - quotient * x - found @ (found.T @ (matrix @ x))))
        if best is None or residual < best[0]:
            best = residual, quotient, x
        elif k > 6 and residual <= 64 * d * np.finfo(float).eps:
            break
        if k >= 2 and inside(quotient):
            value = quotient
        try:
            y = np.linalg.solve(matrix - value * np.eye(d), x)
        except np.linalg.LinAlgError:
            y = np.linalg.solve(matrix - (value + 4 * np.finfo(float).eps) * np.eye(d), x)
        if not np.isfinite(y).all():
            break
        x = y / np.linalg.norm(y)
    residual, quotient, x = best
    return (quotient, x) if inside(quotient) and residual <= 1e-10 else None


def leading_eigenpairs(matrix: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(values, vectors): the k largest eigenvalues, falling, and unit eigenvectors as columns.

    The matrix is scaled to a trace of 1. An interval for each number is halved until inertia counts say that it holds that eigenvalue alone, or is too narrow to tell eigenvalues
    apart; a Rayleigh quotient iteration then starts in it, with cubic convergence, and is started again in a narrower one if it went astray. At the end the counts on both sides of each value
    must give its number.
    """
    d, scale = len(matrix), float(np.trace(matrix))
    k = min(k, d)
    if scale <= 0:
        return np.zeros(k), np.eye(d)[:, :k]
    m = (matrix + matrix.T) / (2 * scale)
    counts: dict[float, int] = {}

    def above(shift: float) -> int:
        if shift not in counts:
            counts[shift] = eigenvalues_above(m, shift)
        return counts[shift]
    top, bottom = 1.0 + 1e-9, -1e-9
    counts[top], counts[bottom] = 0, d
    values, vectors = np.zeros(k), np.zeros((d, k))
    for number in range(1, k + 1):
        low = max(s for s, n in counts.items() if n >= number)
        high = min(s for s, n in counts.items() if n < number)
        while True:
            alone = above(low) == number and above(high) == number - 1
            narrow = high - low <= CLOSE
            if alone or narrow:
                slack = 1e-13 + (CLOSE if narrow else 0.0)
                pair = _rayleigh(m, (low + high) / 2, vectors[:, :number - 1], lambda q, a=low - slack, b=high + slack: a <= q <= b, number)
                if pair:
                    break
                if high - low <= 1e-15:
                    raise ArithmeticError(f"eigenvalue {number} was not found")
            middle = (low + high) / 2
            if above(middle) >= number:
                low = middle
            else:
                high = middle
        values[number - 1], vectors[:, number - 1] = pair
        if not (above(pair[0] - 2 * CLOSE) >= number and above(pair[0] + 2 * CLOSE) < number):
            raise ArithmeticError(f"the counts do not give number {number}")
    return np.maximum(values, 0.0) * scale, vectors


# --- Sums over all vectors ---

def integers(column: pa.Array) -> tuple[np.ndarray, dict[int, tuple[np.ndarray, np.ndarray]]]:
    """Of an array<double> column: (rows, {dimension: (rows, integer vectors)}) of the vectors that hold neither nulls nor non-finite entries."""
    sizes = pc.fill_null(pc.list_value_length(column), -1).to_numpy(zero_copy_only=False)
    flat = column.flatten()
    entries = np.asarray(flat.to_numpy(zero_copy_only=False), np.float64)  # a null entry is a NaN here
    ends = np.cumsum(np.maximum(sizes, 0))
    bad = np.concatenate([[0], np.cumsum(~np.isfinite(entries))])
    fine = (sizes > 0) & (bad[ends] == bad[ends - np.maximum(sizes, 0)])
    out = {}
    for d in np.unique(sizes[fine]):
        rows = np.flatnonzero(fine & (sizes == d))
        x = np.clip(np.floor(SCALE * entries[(ends[rows] - d)[:, None] + np.arange(d)]), -LIMIT, LIMIT)
        out[int(d)] = rows, x.astype(np.int64) + SHIFT
    return np.flatnonzero(fine), out


def _halves(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each dimension of the vectors of a task and each of their places: how many there are, and the sum of their entries in two halves."""
    total: dict[int, list] = {}
    for batch in batches:
        for d, (rows, x) in integers(batch.column(1))[1].items():
            n, high, low = total.get(d, (0, 0, 0))
            total[d] = [n + len(rows), high + (x >> HALF).sum(axis=0), low + (x & ((1 << HALF) - 1)).sum(axis=0)]
    for d, (n, high, low) in total.items():
        yield pa.RecordBatch.from_arrays([pa.array(np.full(d, d), pa.int32()), pa.array(np.arange(d), pa.int32()), pa.array(np.full(d, n), pa.int64()), pa.array(high, pa.int64()), pa.array(low, pa.int64())],
                                         names=["d", "place", "n", "high", "low"])


@dataclass(frozen=True)
class Fit:
    """n vectors of dimension d with the sums `sums` (exact); `map`: dimension by components, eigenvectors over the roots of their eigenvalues; `explained`: shares of the trace."""

    d: int
    n: int
    sums: tuple[int, ...]
    map: np.ndarray
    explained: tuple[float, ...]
    error: float | None

    def centred(self, x: np.ndarray) -> np.ndarray:
        """x - S / n: whole quotients are taken off as integers first, so that nothing is lost to the size of the entries."""
        whole, rest = np.array([s // self.n for s in self.sums], np.int64), np.array([s % self.n for s in self.sums], np.float64)
        return (x - whole).astype(np.float64) - rest / self.n

    def deviations(self, x: np.ndarray) -> list[int | None]:
        """The exact sum over dimensions of (n * x - S)^2 for each row; None where 64 bits don't hold it."""
        most = self.n * float(np.abs(self.centred(x)).max(initial=0)) + 1
        if max(most * most * self.d, self.n * float(np.abs(x).max(initial=0)), max(map(abs, self.sums))) < 2.0 ** 62:
            t = x * self.n - np.array(self.sums, np.int64)
            return np.einsum("ij,ij->i", t, t).tolist()
        exact = [sum((self.n * v - s) ** 2 for v, s in zip(row, self.sums, strict=True)) for row in x.tolist()]
        return [v if v < 1 << 63 else None for v in exact]

    def whitened(self, x: np.ndarray) -> np.ndarray:
        return self.centred(x) @ self.map


def _vectors(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    return vectors.select(A.quoted(id_col).cast("long").alias("vec_id"), A.quoted(vector_col).cast("array<double>").alias("v"))


def _squares(fit: Fit, of):
    """Sums over the vectors of a task of the products of the entries of `of`(x), a row of the matrix in each row, the sums of the entries last."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            _, x = integers(batch.column(1))[1].get(fit.d, (None, None))
            if x is not None:
                y = of(fit, x)
                part = np.vstack([y.T @ y, y.sum(axis=0)])
                total = part if total is None else total + part
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total)), pa.int32()), pa.array(np.full(len(total), TaskContext.get().partitionId()), pa.int32()), pa.array([r.tobytes() for r in total], pa.binary())],
                                             names=["place", "task", "sums"])
    return run


def _moments(rows: DataFrame, fit: Fit, of) -> tuple[np.ndarray, np.ndarray]:
    """(mean of the products, mean) of `of`(x) over all vectors. A task sends a square matrix as large as the dimension; those of a place meet in one task."""
    total = summed(rows.mapInArrow(_squares(fit, of), "place int, task int, sums binary")) / fit.n
    return total[:-1], total[-1]


def fit_whitening(vectors: DataFrame, components: int = COMPONENTS, id_col: str = "vec_id", vector_col: str = "embedding") -> Fit | None:
    """Mean, leading components and their shares of the variance, over all vectors; None without any. Only sums as large as the dimension, and its square, reach the driver.

    Three passes: sums; products of centred vectors; the covariance of the whitened vectors, whose largest departure from the identity is `error`. The dimension is that of most
    vectors (the larger one of equals). Components are numbered by falling eigenvalue; one without variance has a map of 0, an explained share of 0 and no part in `error`.
    """
    rows = _vectors(vectors, id_col, vector_col).select("vec_id", "v")
    sums = rows.mapInArrow(_halves, "d int, place int, n long, high long, low long").groupBy("d", "place").agg(
        F.sum("n").alias("n"), F.sum(F.col("high").cast("decimal(38,0)")).alias("high"), F.sum(F.col("low").cast("decimal(38,0)")).alias("low"))
    first = sums.filter("place = 0").orderBy(F.desc("n"), F.desc("d")).select("d", "n").first()
    if first is None:
        return None
    d, n = first
    places = sums.filter(F.col("d") == d).orderBy("place").collect()
    exact = tuple((int(r["high"]) << HALF) + int(r["low"]) for r in places)
    fit = Fit(d, n, exact, np.zeros((d, 0)), (), None)
    products, mean = _moments(rows, fit, Fit.centred)
    covariance = products - np.outer(mean, mean)
    values, basis = leading_eigenpairs(covariance, components)
    some = values > NOTHING * d * max(float(np.trace(covariance)), 0.0)
    shares = np.where(some, values / np.trace(covariance) if some.any() else 0.0, 0.0)
    fit = Fit(d, n, exact, basis * np.where(some, 1 / np.sqrt(np.where(some, values, 1.0)), 0.0), tuple(shares.tolist()), None)
    products, mean = _moments(rows, fit, Fit.whitened)
    left = (products - np.outer(mean, mean) - np.eye(len(values)))[np.ix_(some, some)]
    return Fit(fit.d, n, exact, fit.map, fit.explained, float(np.abs(left).max()) if left.size else None)


_ROW = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"


def whiten(vectors: DataFrame, fit: Fit | None, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """A row for each vector and component: vec_id, component (from 1), n, deviation, whitened, explained, identity_error.

    Vectors that are null or empty, hold null or non-finite entries or have another dimension than the fit take no part; a null id stays null, rows that repeat give repeated rows.
    Fewer dimensions than components give as many components. A component without variance has a null `whitened`; `deviation` is null where 64 bits don't hold it.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k = len(fit.explained)
        for batch in batches:
            rows, x = integers(batch.column(1))[1].get(fit.d, (None, None))
            if x is None:
                continue
            y = fit.whitened(x).reshape(-1)
            none = np.tile(np.array(fit.explained) == 0.0, len(rows))
            yield pa.RecordBatch.from_arrays([
                batch.column(0).take(pa.array(np.repeat(rows, k))), pa.array(np.tile(np.arange(1, k + 1), len(rows)), pa.int32()), pa.array(np.full(len(rows) * k, fit.n), pa.int64()),
                pa.array([v for v in fit.deviations(x) for _ in range(k)], pa.int64()), pa.array(y, pa.float64(), mask=none), pa.array(np.tile(fit.explained, len(rows)), pa.float64()),
                pa.array(np.full(len(rows) * k, np.nan if fit.error is None else fit.error), pa.float64(), mask=np.full(len(rows) * k, fit.error is None))], names=[c.split()[0] for c in _ROW.split(", ")])
    rows = _vectors(vectors, id_col, vector_col)
    return rows.mapInArrow(run, _ROW) if fit else vectors.sparkSession.createDataFrame([], _ROW)
