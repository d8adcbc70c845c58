"""Embedding whitening by QDWH spectral divide and conquer.

Polar factors of the shifted covariance give projectors on the eigenvectors above and below the shift, which
split the space until single components are left. What the driver holds are matrices of the vectors' width.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from docharbor.llm.common import pick, received, shipped, stored

#: Fixed values of the scale: an entry c counts as floor(64 * c) + 1000000.
SCALE, SHIFT = 64, 1_000_000
COMPONENTS = 16
#: Tasks that add up what all tasks found, before the driver adds up theirs.
ADDERS = 8


def polar(a: np.ndarray) -> np.ndarray:
    """The orthogonal polar factor of a symmetric matrix, by QDWH iterations: the sign of its eigenvalues."""
    size = len(a)
    x = a / np.linalg.norm(a)
    low = np.finfo(float).eps / 16
    for _ in range(30):
        square = low * low
        d = np.cbrt(4 * (1 - square) / square**2) if square < 1 else 0.0
        p = np.sqrt(1 + d) + 0.5 * np.sqrt(max(8 - 4 * d + 8 * (2 - square) / (square * np.sqrt(1 + d)), 0.0))
        q = (p - 1) ** 2 / 4
        r = p + q - 1
        before = x
        if r > 100:
            stacked, _ = np.linalg.qr(np.vstack([np.sqrt(r) * x, np.eye(size)]))
            x = q / r * x + (p - q / r) / np.sqrt(r) * stacked[:size] @ stacked[size:].T
        else:
            factor = np.linalg.cholesky(np.eye(size) + r * x.T @ x)
            y = np.linalg.solve(factor, x.T)
            x = q / r * x + (p - q / r) * np.linalg.solve(factor.T, y).T
        x = (x + x.T) / 2
        low = min(low * (p + q * square) / (1 + r * square), 1.0)
        if abs(1 - low) < 1e-15 and np.linalg.norm(x - before) < 1e-8 * np.sqrt(size):
            break
    return x


def _cut(a: np.ndarray, shift: float) -> tuple[np.ndarray, np.ndarray] | None:
    """Bases of the invariant subspaces above and below ``shift``; nothing if it doesn't part them."""
    size = len(a)
    moved = a - shift * np.eye(size)
    if not np.linalg.norm(moved):
        return None
    above = (polar(moved) + np.eye(size)) / 2
    rank = round(float(np.trace(above)))
    if not 0 < rank < size:
        return None
    start = np.random.default_rng(size).standard_normal((size, size))
    basis, _ = np.linalg.qr(above @ start[:, :rank])
    basis, _ = np.linalg.qr(np.hstack([above @ basis, start[:, rank:] - above @ start[:, rank:]]))
    high, low = basis[:, :rank], basis[:, rank:]
    if np.linalg.norm(high.T @ a @ low) > 1e-12 * np.linalg.norm(a):
        return None
    return high, low


def eigen(v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues of a symmetric matrix, falling, and their unit eigenvectors as columns."""
    whole = np.linalg.norm(v)
    found: list[tuple[float, np.ndarray]] = []
    parts = [(v, np.eye(len(v)))]
    while parts:
        a, basis = parts.pop()
        a = (a + a.T) / 2
        line = np.diag(a)
        if len(a) == 1 or np.linalg.norm(a - np.diag(line)) <= 1e-15 * whole:
            found += [(x, basis[:, i]) for i, x in enumerate(line)]
            continue
        ordered = np.sort(line)
        # The middle of the diagonal halves the work; if an eigenvalue lies there, another place parts them.
        middles = [np.median(line), line.mean(), *((ordered[1:] + ordered[:-1]) / 2)]
        low, high = line.mean() - np.linalg.norm(a), line.mean() + np.linalg.norm(a)
        shifts = middles + list(np.linspace(low, high, 64))
        cut = next((c for s in shifts if (c := _cut(a, float(s))) is not None), None)
        if cut is None:
            # Eigenvalues that no shift can part are equal to working precision: any basis will do.
            found += [(x, basis[:, i]) for i, x in enumerate(line)]
            continue
        parts += [(half.T @ a @ half, basis @ half) for half in cut]
    found.sort(key=lambda f: -f[0])
    return _polished(v, np.stack([c for _, c in found], 1))


def _polished(v: np.ndarray, basis: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """One step of refinement: what rounding has mixed into a component of others goes."""
    d = basis.T @ v @ basis
    values = np.diag(d)
    gap = values[None, :] - values[:, None]
    far = np.abs(gap) > 1e3 * np.abs(d)
    mix = np.where(far, d / np.where(far, gap, 1.0), 0.0)
    np.fill_diagonal(mix, 0.0)
    basis, r = np.linalg.qr(basis + basis @ mix)
    basis = basis * np.sign(np.diag(r))
    values = np.einsum("ij,ij->j", basis, v @ basis)
    order = np.argsort(-values, kind="stable")
    return values[order], basis[:, order]


@dataclass(frozen=True)
class Whitening:
    """Counts and sums of the fit list, and what turns a centred vector into whitened components."""

    n: int
    sums: list[int]
    values: np.ndarray
    components: np.ndarray
    trace: float
    identity_error: float | None = None

    def centred(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """``n * x - S``, exact, and the same over ``n``."""
        exact = exactly(x, self.n, self.sums)
        return exact, exact.astype(float) / self.n

    def whitened(self, centre: np.ndarray) -> np.ndarray:
        """Not a number where a component has no variance."""
        ok = self.varied()
        root = np.sqrt(np.where(ok, self.values, 1.0))
        return np.where(ok, centre @ self.components / root, np.nan)

    def varied(self) -> np.ndarray:
        return self.values > 1e-13 * self.trace


def exactly(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """``n * x - S`` in whole numbers of any size."""
    largest = max(int(x.max(initial=0)), -int(x.min(initial=0)))
    if n * largest + max(map(abs, sums), default=0) < 1 << 62:
        return x * np.int64(n) - np.array(sums, np.int64)
    return x.astype(object) * n - np.array(sums, object)


def deviations(exact: np.ndarray) -> list[int | None]:
    """Sums of squares by row, exact; nothing where one doesn't fit into a long."""
    if exact.dtype == np.int64 and exact.size:
        largest = max(int(exact.max()), -int(exact.min()))
        if largest * largest * exact.shape[1] < 1 << 63:
            return (exact * exact).sum(1).tolist()
    sums = ((row * row).sum() if len(row) else 0 for row in exact.astype(object))
    return [int(s) if s < 1 << 63 else None for s in sums]


def _matrix(column: pa.Array) -> np.ndarray:
    flat = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return flat.flatten().to_numpy(zero_copy_only=False).reshape(len(flat), -1)


def scaled(vectors: DataFrame, key: str, vector: str) -> DataFrame:
    """``key, x``: rows whose vector is neither null nor holds null or non-finite entries, in whole numbers.

    Only vectors of the commonest length take part, the longer one of two equally common; entries beyond the
    range of a long stay at its end.
    """
    own = pick(vectors, key, vector).toDF("key", "v").withColumn("v", F.col("v").cast("array<double>"))
    huge = float("inf")
    finite = F.forall("v", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < huge))
    own = own.where(F.coalesce(finite, F.lit(False)) & (F.size("v") > 0))
    lengths = own.groupBy(F.size("v").alias("size")).count()
    common = lengths.orderBy(F.desc("count"), F.desc("size")).limit(1).select("size")
    own = own.join(F.broadcast(common), F.size("v") == F.col("size"), "left_semi")
    edge = 2.0**62

    def whole(c):
        return F.floor(F.greatest(F.least(c * SCALE, F.lit(edge)), F.lit(-edge))) + SHIFT

    return own.select("key", F.transform("v", whole).cast("array<long>").alias("x"))


def _added(
    df: DataFrame, make: Callable[[np.ndarray], np.ndarray], join: Callable[[np.ndarray, np.ndarray], np.ndarray]
) -> np.ndarray | None:
    """``make`` of all vectors of a task, joined in tasks, then in ``ADDERS`` of them, then on the driver."""

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            if batch.num_rows:
                found = make(_matrix(batch.column("x")))
                total = found if total is None else join(total, found)
        yield from packed(total)

    def second(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            for found in batch.column("part").to_pylist():
                found = np.frombuffer(found)
                total = found if total is None else join(total, found)
        yield from packed(total)

    def packed(total):
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array([np.asarray(total, float).tobytes()], pa.binary())], ["part"])

    rows = df.select("x").mapInArrow(first, "part binary").repartition(ADDERS).mapInArrow(second, "part binary").collect()
    total = None
    for (part,) in rows:
        found = np.frombuffer(bytes(part))
        total = found if total is None else join(total, found)
    return total


def _covariance(df: DataFrame, centre: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
    """The products of centred vectors, added up."""

    def make(x: np.ndarray) -> np.ndarray:
        y = centre(x)
        return (y.T @ y).ravel()

    out = _added(df, make, lambda a, b: a + b)
    return out.reshape(int(np.sqrt(len(out))), -1)


def _spread(df: DataFrame, whiten: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
    """The covariance of whitened vectors, centred by the means of the parts that are joined."""

    def make(x: np.ndarray) -> np.ndarray:
        y = whiten(x)
        mean = y.mean(0)
        return np.concatenate([[len(y)], mean, ((y - mean).T @ (y - mean)).ravel()])

    def join(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        width = int((np.sqrt(4 * len(a) - 3) - 1) / 2)
        n = a[0] + b[0]
        step = b[1 : width + 1] - a[1 : width + 1]
        mean = a[1 : width + 1] + step * (b[0] / n)
        return np.concatenate([[n], mean, a[width + 1 :] + b[width + 1 :] + np.outer(step, step).ravel() * (a[0] * b[0] / n)])

    out = _added(df, make, join)
    width = int((np.sqrt(4 * len(out) - 3) - 1) / 2)
    return out[width + 1 :].reshape(width, width) / out[0]


def fit(x: DataFrame, components: int = COMPONENTS) -> Whitening | None:
    """The whitening of the distinct vectors in column ``x``; nothing without vectors.

    Equal vectors are made one by a partial aggregate before anything moves, then three passes over them
    count and sum, add up the covariance about the mean, and measure what whitening leaves of it.
    """
    distinct = stored(x.select("x").distinct(), "distinct-vectors")
    places = F.posexplode("x").alias("at", "v")
    sums = distinct.select(places).groupBy("at").agg(F.count("*"), F.sum(F.col("v").cast("decimal(38,0)")))
    sums = sums.orderBy("at").collect()
    if not sums:
        return None
    n, totals = sums[0][1], [int(s[2]) for s in sums]
    blank = Whitening(n, totals, np.zeros(0), np.zeros((len(totals), 0)), 0.0)
    v = _covariance(distinct, lambda m: blank.centred(m)[1]) / n
    values, basis = eigen(v)
    size = min(components, len(totals))
    trace = float(np.trace(v))
    # Equal signs in every run: the largest entry of a component is positive.
    signs = np.sign(basis[np.abs(basis).argmax(0), np.arange(len(totals))])
    fitted = Whitening(n, totals, values[:size], (basis * signs)[:, :size], trace)
    ok = fitted.varied()
    if not ok.any():
        return fitted
    left = _spread(distinct, lambda m: fitted.whitened(fitted.centred(m)[1])[:, ok])
    error = float(np.abs(left - np.eye(int(ok.sum()))).max())
    return Whitening(n, totals, fitted.values, fitted.components, trace, error)


def whiten(x: DataFrame, fitted: Whitening) -> DataFrame:
    """``key, deviation, whitened`` of every row of ``key, x``; a component without variance is null."""
    sent = shipped(x.sparkSession, fitted)
    schema = StructType([x.schema["key"], *StructType.fromDDL("deviation long, whitened array<double>")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = received(sent)
        for batch in batches:
            if not batch.num_rows:
                continue
            exact, centre = own.centred(_matrix(batch.column("x")))
            out = [[None if np.isnan(v) else v for v in row] for row in own.whitened(centre).tolist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("key"), pa.array(deviations(exact), pa.int64()), pa.array(out, pa.list_(pa.float64()))],
                ["key", "deviation", "whitened"],
            )

    return x.select("key", "x").mapInArrow(run, schema)


def whitening_report(vectors: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """``vec_id, component, n, deviation, whitened, explained, identity_error``: a row for each component.

    Repeated rows and equal vectors each have their rows, but count once in the fit. See :func:`scaled` for
    rows that take no part; without any left, an empty table too, there are no rows. A component without
    variance has null ``whitened``; if none has any, ``explained`` and ``identity_error`` are null as well. A
    ``deviation`` beyond a long is null.
    """
    spark: SparkSession = vectors.sparkSession
    x = scaled(vectors, "vec_id", "embedding")
    fitted = fit(x, components)
    shape = "component int, n long, deviation long, whitened double, explained double, identity_error double"
    if fitted is None:
        empty = StructType([x.schema["key"], *StructType.fromDDL(shape)])
        return spark.createDataFrame([], empty).withColumnRenamed("key", "vec_id")
    shares = [float(v / fitted.trace) if fitted.trace > 0 else None for v in fitted.values]
    explained = F.array(*(F.lit(s).cast("double") for s in shares))
    out = whiten(x, fitted).select("key", "deviation", F.posexplode("whitened").alias("at", "whitened"))
    return out.select(
        F.col("key").alias("vec_id"),
        (F.col("at") + 1).alias("component"),
        F.lit(fitted.n).cast("long").alias("n"),
        "deviation",
        "whitened",
        F.get(explained, F.col("at")).alias("explained"),
        F.lit(fitted.identity_error).cast("double").alias("identity_error"),
    )
