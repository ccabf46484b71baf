"""Whitening of embeddings by shifted CholeskyQR over distributed Gram matrices.

Vectors are first put on an integer grid, so that their sums are exact and every row is centred without loss. Only one
small matrix ever leaves a pass: tasks add up the Gram matrix of their rows, one row of the matrix per dimension goes
through the shuffle, and the driver holds dimension x dimension numbers whatever the number of vectors. A pass takes
the triangular factors found so far and solves each centred row against them, one after the other, so that the rows it
multiplies are ever closer to orthonormal: a first Cholesky factor of the Gram matrix plus a shift (which exists
however ill-conditioned the rows are), more shifted ones while the rows are still far from orthonormal, then two plain
ones. The product of all factors is the R of a QR decomposition of the centred rows to double precision; its singular
values and right vectors give the covariance's eigenvalues and components without squaring the condition number.

Where directions hold no variance (fewer vectors than dimensions, constant or repeated ones), the rows are rotated out
of them before the plain passes, unless rounding has filled them; either way such directions have no component.

Defined cases: a vector that is null, empty, or holds null, non-finite entries or entries of 2^50 and more takes no
part; so do vectors of another length than most have (the longer length where two are as frequent). Null and repeated
ids are rows of their own. One vector, or equal ones only, have no component and so no rows. `deviation` is null where
it exceeds 63 bits. An empty table gives an empty result; extra columns are never read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import settle

SCALE, OFFSET = 1024, 100_000
LARGEST = float(1 << 50)
COMPONENTS = 8
BLOCK = 1 << 20  # numbers that a task multiplies at once
UNIT = np.finfo(np.float64).eps / 2
ROUNDS = 3  # shifted passes at most
NOISE = 8  # units of rounding a dimension, below which a direction of equally long dimensions counts as empty
FULL = 1e-6  # smallest eigenvalue of a Gram matrix, against its largest, from which plain passes follow


def grid(vectors: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", scale: int = SCALE,
         offset: int = OFFSET) -> DataFrame:
    """(vec_id, x): floor(scale * entry) + offset of the vectors that take part. Settle it before use."""
    def sound(c):
        return c.isNotNull() & ~F.isnan(c) & (F.abs(c) < LARGEST)

    slim = vectors.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(vector).cast("array<double>").alias("v"))
    slim = slim.where(F.col("v").isNotNull() & (F.size("v") > 0) & F.forall("v", sound))
    return slim.select("vec_id", F.transform("v", lambda c: F.floor(c * scale) + offset).alias("x"))


def one_length(points: DataFrame) -> tuple[DataFrame, int]:
    """The points of the most frequent length, and that length; 0 without points."""
    best = points.groupBy(F.size("x").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    if best is None:
        return points, 0
    return points.where(F.size("x") == best["d"]), best["d"]


def _blocks(batches: Iterator[pa.RecordBatch], d: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    """Slices of the batches with their vectors as a matrix of integers."""
    rows = max(1, BLOCK // d)
    for batch in batches:
        for low in range(0, batch.num_rows, rows):
            part = batch.slice(low, rows)
            yield part, part.column("x").flatten().to_numpy(zero_copy_only=False).reshape(-1, d)


@dataclass(frozen=True)
class Centre:
    """Number of vectors and exact sums of each dimension."""

    n: int
    sums: tuple[int, ...]

    def exact(self, x: np.ndarray) -> np.ndarray:
        """n * x - S; as Python integers where 64 bits could overflow."""
        n, most = self.n, max(abs(int(x.min())), abs(int(x.max()))) if x.size else 0
        if n * most < 1 << 62:
            return n * x - np.array(self.sums, np.int64)
        return n * x.astype(object) - np.array(self.sums, object)

    def centred(self, x: np.ndarray) -> np.ndarray:
        """x - S / n, rounded once."""
        exact = self.exact(x)
        if exact.dtype == object:
            return np.array([[float(Fraction(int(v), self.n)) for v in row] for row in exact]).reshape(x.shape)
        return exact / self.n

    def deviation(self, x: np.ndarray) -> list[int | None]:
        """Squared distance from the mean, times n squared, exact."""
        exact = self.exact(x)
        most = max(abs(int(exact.min())), abs(int(exact.max()))) if exact.size else 0
        if exact.dtype != object and most * most * x.shape[1] < 1 << 63:
            return np.einsum("ij,ij->i", exact, exact).tolist()
        totals = [sum(int(v) ** 2 for v in row) for row in exact]
        return [t if t < 1 << 63 else None for t in totals]


def centre(points: DataFrame, d: int) -> Centre:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = [0] * d, 0
        for _, x in _blocks(batches, d):
            small = max(abs(int(x.min())), abs(int(x.max()))) * len(x) < 1 << 62
            total = [a + int(b) for a, b in zip(total, (x if small else x.astype(object)).sum(axis=0))]
            n += len(x)
        # The number of rows goes with dimension -1.
        yield pa.RecordBatch.from_pydict({"i": pa.array(range(-1, d), pa.int32()), "total": [str(v) for v in (n, *total)]})

    found = points.mapInArrow(run, "i int, total string").groupBy("i").agg(F.sum(F.col("total").cast("decimal(38,0)")).alias("t"))
    held = {r["i"]: int(r["t"]) for r in found.collect()}  # a row per dimension
    return Centre(held.get(-1, 0), tuple(held.get(i, 0) for i in range(d)))


def solve(rows: np.ndarray, r: np.ndarray) -> np.ndarray:
    """rows times the inverse of an upper triangular matrix, by forward substitution."""
    out = np.empty(rows.shape, np.float64, order="F")
    for j in range(len(r)):
        out[:, j] = (rows[:, j] - out[:, :j] @ r[:j, j]) / r[j, j]
    return out


@dataclass
class Factors:
    """What turns centred rows into nearly orthonormal ones: triangular solves, and one rotation where rank lacks."""

    steps: list[tuple[str, np.ndarray]] = field(default_factory=list)

    def rows(self, centred: np.ndarray) -> np.ndarray:
        for kind, m in self.steps:
            centred = solve(centred, m) if kind == "solve" else centred @ m
        return centred

    def triangle(self, d: int) -> np.ndarray:
        """All factors composed: centred rows are the orthonormal ones times this."""
        out = np.eye(d)
        for kind, m in self.steps:
            out = (m if kind == "solve" else m.T) @ out
        return out


def gram(points: DataFrame, d: int, to_rows: Callable[[np.ndarray], np.ndarray], width: int) -> np.ndarray:
    """Sum over all points of the products of what `to_rows` makes of them."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((width, width))
        for _, x in _blocks(batches, d):
            rows = to_rows(x)
            total += rows.T @ rows
        yield pa.RecordBatch.from_pydict({"i": pa.array(range(width), pa.int32()),
                                          "row": pa.array(list(total), pa.list_(pa.float64()))})

    def add(table: pa.Table) -> pa.Table:
        parts = table["row"].combine_chunks().flatten().to_numpy().reshape(-1, width)
        return pa.table({"i": table["i"].slice(0, 1), "row": pa.array([parts.sum(axis=0)], pa.list_(pa.float64()))})

    schema = "i int, row array<double>"
    out = np.zeros((width, width))
    # A group holds one row of the matrix per task.
    for r in points.mapInArrow(run, schema).groupBy("i").applyInArrow(add, schema).collect():
        out[r["i"]] = r["row"]
    return (out + out.T) / 2


@dataclass(frozen=True)
class Whitening:
    """Components as columns, the eigenvalues of the covariance behind them, and its trace."""

    centre: Centre
    vectors: np.ndarray
    eigenvalues: np.ndarray
    trace: float

    def rows(self, x: np.ndarray) -> np.ndarray:
        return self.centre.centred(x) @ self.vectors / np.sqrt(self.eigenvalues)


def upper(matrix: np.ndarray) -> np.ndarray:
    return np.linalg.cholesky(matrix).T


def rank(triangle: np.ndarray, norms: np.ndarray) -> int:
    """Number of directions with variance. The shifted passes also raise what rounding left where there is none; per
    dimension that is some units in the last place of its norm, so it is told apart once all norms are one."""
    scaled = triangle[:, norms > 0] / norms[norms > 0]
    singular = np.linalg.svd(scaled, compute_uv=False)
    return int((singular > NOISE * scaled.shape[1] * UNIT * singular[0]).sum())


def fit(points: DataFrame, d: int, components: int = COMPONENTS) -> Whitening | None:
    """None where no direction has variance."""
    middle = centre(points, d)
    factors = Factors()

    def passed() -> np.ndarray:
        width = len(factors.triangle(d))
        return gram(points, d, lambda x, c=middle, f=factors: f.rows(c.centred(x)), width)

    g = first = passed()
    if not np.trace(first) > 0:
        return None
    for _ in range(ROUNDS):
        # The shift lies above the rounding of the matrix, so its Cholesky factor exists.
        shift = 11 * (middle.n * d + d * (d + 1)) * UNIT * np.linalg.eigvalsh(g)[-1]
        factors.steps.append(("solve", upper(g + shift * np.eye(d))))
        g = passed()
        values, turned = np.linalg.eigh(g)
        if values[0] > FULL * values[-1]:
            break
    else:
        kept = turned[:, values > FULL * values[-1]]
        factors.steps.append(("turn", kept))
        g = kept.T @ g @ kept
    factors.steps.append(("solve", upper(g)))
    factors.steps.append(("solve", upper(passed())))
    triangle = factors.triangle(d)
    _, singular, right = np.linalg.svd(triangle, full_matrices=False)
    k = min(components, rank(triangle, np.sqrt(np.diag(first))))
    chosen = right[:k].T
    # Either sign is right; the largest entry's is made positive so that reruns agree.
    chosen = chosen * np.sign(chosen[np.abs(chosen).argmax(axis=0), np.arange(k)])
    return Whitening(middle, chosen, singular[:k] ** 2 / middle.n, float(np.trace(first)) / middle.n)


def identity_error(points: DataFrame, d: int, model: Whitening) -> float:
    """Largest entry of the whitened vectors' covariance minus the identity. Their mean is zero but for rounding."""
    k = model.vectors.shape[1]
    return float(np.abs(gram(points, d, model.rows, k) / model.centre.n - np.eye(k)).max())


WHITE = ("vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double")


def query(vectors: DataFrame) -> DataFrame:
    """One row per vector and component."""
    points, d = one_length(settle(grid(vectors)))
    model = fit(points, d) if d else None
    if model is None:
        return points.sparkSession.createDataFrame([], WHITE)
    error = identity_error(points, d, model)
    k, n = model.vectors.shape[1], model.centre.n
    share = model.eigenvalues / model.trace

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, x in _blocks(batches, d):
            m = len(x)
            at = pa.array(np.repeat(np.arange(m), k))
            yield pa.RecordBatch.from_arrays([
                part.column("vec_id").take(at), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)),
                pa.array(np.full(m * k, n, np.int64)), pa.array(model.centre.deviation(x), pa.int64()).take(at),
                pa.array(model.rows(x).ravel()), pa.array(np.tile(share, m)), pa.array(np.full(m * k, error))],
                ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return points.mapInArrow(run, WHITE)
