"""Whitening of embeddings on the leading components of their covariance, by Jacobi-Davidson with distributed products.

An entry c, as double, becomes the long x = floor(scale * c).  The fit list is
each distinct x vector once; n vectors with per-dimension sums S.  Their
covariance has divisor n and is never formed: ``Covariance.times`` multiplies
it by a few columns in one Spark job, in which every task centres its vectors,
multiplies them twice and gives one partial sum; Spark adds the partial sums.

``leading`` keeps a search space of a few orthonormal columns (the only thing
the driver holds; its size is the vectors' length).  Each outer step takes the
space's Ritz pairs, locks the leading ones whose residual is at rounding level,
and solves the projected correction equation
(I - QQ')(V - theta I)(I - QQ') t = -r, Q being the locked and wanted vectors,
by MINRES for each other wanted pair; the pairs' products share a job.

Rows whose vector is null or empty or holds null or non-finite entries take no
part; neither do vectors of another length than the most frequent one (the
longer of equals).  Every other row gives one row per component, repeated rows
and rows without id too.  Components without variance cannot be whitened and
are left out, so one distinct vector, or an empty table, gives no rows.
floor(scale * c) beyond 64 bits is the nearest long; a deviation beyond 64
bits is null.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from realty_spark.llm.common import land, read_table
from realty_spark.llm.vectors import matrix

SCALE = 256
COMPONENTS = 4
INNER_STEPS = 4  # of MINRES in an outer step
INNER_FALL = 1e-3  # of the correction equation's residual, at which MINRES ends earlier
OUTER_STEPS = 60
EPS = np.finfo(np.float64).eps


def minres_block(times: Callable[[np.ndarray], np.ndarray], right: np.ndarray, steps: int, fall: float) -> np.ndarray:
    """MINRES for several right sides with operators that share a product: column j of ``times(v)`` is operator j times column j.

    The usual recurrences: Lanczos vectors, the QR factors of the tridiagonal
    matrix by Givens rotations, and the directions of the solution.
    """
    x = np.zeros_like(right)
    beta = np.linalg.norm(right, axis=0)
    start = beta.copy()
    safe = lambda a: np.where(a > 0, a, 1.0)
    v_old, v = np.zeros_like(right), right / safe(beta)
    d_old, d = np.zeros_like(right), np.zeros_like(right)
    c_old, c, s_old, s = (np.ones(right.shape[1]), np.ones(right.shape[1]), np.zeros(right.shape[1]), np.zeros(right.shape[1]))
    eta, live, beta_next = beta.copy(), beta > 0, np.zeros_like(beta)
    for _ in range(steps):
        if not live.any():
            break
        p = times(v) - beta_next * v_old
        alpha = np.sum(v * p, axis=0)
        p = p - alpha * v
        new = np.linalg.norm(p, axis=0)
        r3 = s_old * beta_next  # the new column of the triangular factor
        r2 = c_old * c * beta_next + s * alpha
        bare = c * alpha - c_old * s * beta_next
        r1 = np.hypot(bare, new)
        go = live & (r1 > 0)
        c_old, s_old = c, s
        c, s = np.where(go, bare / safe(r1), 1.0), np.where(go, new / safe(r1), 0.0)
        d_new = (v - r2 * d - r3 * d_old) / safe(r1)
        x = x + np.where(go, c * eta, 0.0) * d_new
        eta = np.where(go, -s * eta, eta)
        d_old, d = d, d_new
        v_old, v = v, p / safe(new)
        beta_next = new
        live = go & (np.abs(eta) > fall * start) & (new > EPS * safe(r1))
    return x


def orthonormal(columns: np.ndarray, *against: np.ndarray) -> np.ndarray:
    """The columns' span outside the other (orthonormal) columns; what has no part outside goes."""
    base = np.hstack(against) if against else np.zeros((len(columns), 0))
    kept: list[np.ndarray] = []
    for column in columns.T:
        size = np.linalg.norm(column)
        if not size > 0:
            continue
        v = column / size
        for _ in range(2):  # twice is enough
            v = v - base @ (base.T @ v)
            for k in kept:
                v = v - k * (k @ v)
        left = np.linalg.norm(v)
        if left > 1e-8:
            v = v / left
            v = v - base @ (base.T @ v)
            kept.append(v / np.linalg.norm(v))
    return np.array(kept).T if kept else np.zeros((len(columns), 0))


def leading(times: Callable[[np.ndarray], np.ndarray], dims: int, wanted: int, seed: int = 0,
            inner_steps: int = INNER_STEPS, outer_steps: int = OUTER_STEPS) -> tuple[np.ndarray, np.ndarray]:
    """(values, vectors) of the ``wanted`` largest eigenpairs of the symmetric operator ``times``, by falling value.

    Every product has ``wanted`` columns at most: the start, the new columns of
    the space, those of an inner step, and the pairs that are about to be
    locked, whose residual is taken from a product of their own.
    """
    wanted = min(wanted, dims)
    least, most = min(dims, 2 * wanted + 2), min(dims, 6 * wanted + 2)
    space = orthonormal(np.random.default_rng(seed).standard_normal((dims, wanted)))
    product = times(space)
    locked, values = np.zeros((dims, 0)), np.zeros(0)
    lowest, still = np.inf, 0
    for _ in range(outer_steps):
        small = space.T @ product
        theta, s = np.linalg.eigh((small + small.T) / 2)
        order = np.argsort(-theta)
        theta, s = theta[order], s[:, order]
        ritz, image = space @ s, product @ s
        open_pairs = wanted - locked.shape[1]
        scale = max(theta[0], values[0] if len(values) else 0.0, np.finfo(np.float64).tiny)

        def residuals(n: int) -> tuple[np.ndarray, np.ndarray]:
            r = image[:, :n] - ritz[:, :n] * theta[:n]
            r = r - locked @ (locked.T @ r)
            return r, np.linalg.norm(r, axis=0)

        def leading_close(size: np.ndarray) -> int:
            close = size <= 16 * EPS * scale * np.sqrt(dims)
            close[0] |= still >= 3
            return int(np.argmin(close)) if not close.all() else len(close)
        residual, size = residuals(open_pairs)
        # a residual at the products' own rounding falls no further
        still = still + 1 if size[0] > 0.5 * lowest and size[0] <= 1e-10 * scale else 0
        lowest = min(lowest, size[0])
        done = leading_close(size)
        if done:
            image[:, :done] = times(ritz[:, :done])
            residual, size = residuals(open_pairs)
            done = leading_close(size)
        if done:
            locked, values = np.hstack([locked, ritz[:, :done]]), np.append(values, theta[:done])
            ritz, image, theta, residual = ritz[:, done:], image[:, done:], theta[done:], residual[:, done:]
            lowest, still = np.inf, 0
            if locked.shape[1] == wanted:
                order = np.argsort(-values, kind="stable")
                return values[order], locked[:, order]
        open_pairs = wanted - locked.shape[1]
        if ritz.shape[1] + open_pairs > most:  # restart from the best Ritz vectors
            ritz, image = ritz[:, :least], image[:, :least]
        if residual.shape[1]:
            q = np.hstack([locked, ritz[:, :open_pairs]])
            shift = theta[:residual.shape[1]]

            def projected(v: np.ndarray) -> np.ndarray:
                v = v - q @ (q.T @ v)
                out = times(v) - v * shift
                return out - q @ (q.T @ out)
            more = minres_block(projected, -(residual - q @ (q.T @ residual)), inner_steps, INNER_FALL)
        else:  # every pair of the space is locked
            more = np.random.default_rng(locked.shape[1]).standard_normal((dims, open_pairs))
        new = orthonormal(more, locked, ritz)
        if not new.shape[1]:
            new = orthonormal(np.random.default_rng(locked.shape[1]).standard_normal((dims, open_pairs)), locked, ritz)
        space, product = np.hstack([ritz, new]), np.hstack([image, times(new)]) if new.shape[1] else image
    raise ArithmeticError(f"the components' residuals did not reach rounding level within {outer_steps} steps")


class Covariance:
    """The covariance of landed (x array<long>) rows of one length, known by its products only."""

    def __init__(self, fit: DataFrame, dims: int):
        self.fit, self.dims, self.products = fit, dims, 0
        sums = (fit.select(F.posexplode("x").alias("at", "v")).groupBy("at")
                .agg(F.sum(F.col("v").cast("decimal(20,0)")).alias("s"), F.count(F.lit(1)).alias("n")).orderBy("at").collect())
        self.n = int(sums[0]["n"]) if sums else 0
        self.sums = [int(r["s"]) for r in sums]
        self.mean = np.array([s / self.n for s in self.sums])

    def summed(self, part: Callable[[np.ndarray], np.ndarray], size: int) -> np.ndarray:
        """The sum of ``part`` (a flat array of ``size``) over the centred rows, one partial sum from each task."""
        mean, dims = self.mean, self.dims

        def run(batches):
            total = np.zeros(size)
            for batch in batches:
                if batch.num_rows:
                    total += part(matrix(pa.chunked_array([batch.column(0)]), dims) - mean)
            yield pa.RecordBatch.from_arrays([pa.array([total.tolist()], pa.list_(pa.float64()))], names=["part"])
        parts = self.fit.select("x").mapInArrow(run, "part array<double>")
        rows = parts.select(F.posexplode("part").alias("at", "v")).groupBy("at").agg(F.sum("v").alias("v")).collect()
        out = np.zeros(size)
        for r in rows:
            out[r["at"]] = r["v"]
        return out

    def times(self, columns: np.ndarray) -> np.ndarray:
        """The covariance times a few columns, in one job."""
        self.products += 1
        flat = self.summed(lambda c: (c.T @ (c @ columns)).ravel(), columns.size)
        return flat.reshape(columns.shape) / self.n

    def trace(self) -> float:
        return float(self.summed(lambda c: np.array([np.sum(c * c)]), 1)[0]) / self.n

    def identity_error(self, whiten: np.ndarray) -> float:
        """The largest entry of the whitened rows' covariance minus the identity."""
        k = whiten.shape[1]

        def part(c: np.ndarray) -> np.ndarray:
            y = c @ whiten
            return np.append((y.T @ y).ravel(), y.sum(axis=0))
        flat = self.summed(part, k * k + k) / self.n
        cov = flat[:k * k].reshape(k, k) - np.outer(flat[k * k:], flat[k * k:])
        return float(np.abs(cov - np.eye(k)).max())


def integers(vectors: DataFrame, id_col: str, vec_col: str, scale: int) -> DataFrame:
    """(vec_id, x) of the rows with a whole vector."""
    rows = vectors.select(vectors[id_col].cast("long").alias("vec_id"), vectors[vec_col].cast("array<double>").alias("vec"))
    whole = F.forall("vec", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) != float("inf")))
    return rows.where("vec is not null and size(vec) > 0").where(whole).select(
        "vec_id", F.transform("vec", lambda c: F.floor(c * float(scale))).alias("x"))


def deviations(x: np.ndarray, n: int, sums: list[int]) -> list[int | None]:
    """The exact sum over dimensions of (n * x - S)^2 of each row; null beyond 64 bits."""
    s = np.array(sums, dtype=object)
    far = n * max(int(x.max(initial=0)), -int(x.min(initial=0))) + max(map(abs, sums))
    if far * far * len(sums) < 1 << 63:
        return ((n * x - s.astype(np.int64)) ** 2).sum(axis=1).tolist()
    exact = [int(v) for v in ((n * x.astype(object) - s) ** 2).sum(axis=1)]
    return [v if v < 1 << 63 else None for v in exact]


def whiten(vectors: DataFrame, components: int = COMPONENTS, scale: int = SCALE, id_col: str = "vec_id",
           vec_col: str = "embedding") -> DataFrame:
    """(vec_id, component, n, deviation, whitened, explained, identity_error) of every whole vector and component."""
    schema = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
    rows = land(integers(vectors, id_col, vec_col, scale), "integers")
    sizes = rows.groupBy(F.size("x").alias("dims")).agg(F.count(F.lit(1)).alias("rows")).orderBy(F.desc("rows"), F.desc("dims")).first()
    if sizes is None:
        return vectors.sparkSession.createDataFrame([], schema)
    dims = int(sizes["dims"])
    rows = rows.where(F.size("x") == dims)
    cov = Covariance(land(rows.select("x").distinct(), "fit"), dims)
    values, basis = leading(cov.times, dims, components)
    trace = cov.trace()
    real = values > 64 * EPS * dims * max(trace, 0.0)
    if not real.any():
        return vectors.sparkSession.createDataFrame([], schema)
    values, basis = values[real], basis[:, real]
    project = basis / np.sqrt(values)
    error, explained = cov.identity_error(project), (values / trace).tolist()
    n, sums, mean, k = cov.n, cov.sums, cov.mean, len(values)

    def run(batches):
        for batch in batches:
            x = np.asarray(batch.column(1).flatten(), dtype=np.int64).reshape(-1, dims)
            y = (x.astype(np.float64) - mean) @ project
            m = batch.num_rows
            each = np.repeat(np.arange(m), k)
            yield pa.RecordBatch.from_arrays([
                batch.column(0).take(pa.array(each)), pa.array(np.tile(np.arange(1, k + 1), m), pa.int32()), pa.array(np.full(m * k, n), pa.int64()),
                pa.array(deviations(x, n, sums), pa.int64()).take(pa.array(each)), pa.array(y.ravel(), pa.float64()),
                pa.array(np.tile(explained, m), pa.float64()), pa.array(np.full(m * k, error), pa.float64())],
                names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])
    return rows.mapInArrow(run, schema)


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All embeddings on the four leading components of their integer vectors' covariance, whitened."""
    return whiten(read_table(spark, sf_dir, "embeddings"))
