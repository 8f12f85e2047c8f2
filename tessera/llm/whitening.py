"""Operator 11: whitening of embeddings by Jacobi-Davidson eigenvectors of their covariance.

The covariance V of the fit list (each distinct vector once) is never formed: only
products V Q with a few vectors Q are taken, each one pass of Spark tasks over the
written fit list, which centre their rows, multiply, and sum d x b numbers.

* *Subspace.*  A basis and its image are kept on the driver (``space`` vectors of d
  numbers).  Rayleigh-Ritz in it gives the leading pairs and their residuals.
* *Locking.*  A pair whose residual norm is at the rounding level of V is locked,
  in order, and everything after is kept orthogonal to it.
* *Correction.*  For all leading pairs not locked, the projected equations
  (I - QQ')(V - theta I)(I - QQ') t = -r are solved by MINRES, all at once: one
  product a step serves every pair.  The solutions expand the basis.
* *Restart* from the best Ritz vectors when the basis is full.

The pairs are taken when all residuals, from a fresh product, are at that level; a pair
whose eigenvalue is at the rounding level of the largest (a flat direction) has no
whitened value and is left out, so fewer components than ``components`` may come back.

Vectors are integers (``floor(64 c) + 1000000``), stored in the least width that holds
all entries of the vector, so equal vectors are equal bytes, and duplicates fold
map-side before the one shuffle.  Sums are exact; x - S / n is formed from whole
numbers before it is rounded.

Rows whose vector is null or holds a null or non-finite entry are dropped.  Dimension:
the most frequent length among the rest (ties: the longest); vectors of another
length, empty ones included, have no place in it and are dropped.  ``deviation`` is
null where it does not fit a long; entries of 2^52 / 64 or more raise an error.  A null
id is kept; repeated rows are returned each, the fit list holds them once; no rows,
or one distinct vector, give an empty result; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written

COMPONENTS = 16
SCALE, SHIFT = 64, 1_000_000
#: Rows that a task multiplies at once.
CHUNK = 4_096
#: Residual, in units of rounding of the largest eigenvalue times sqrt(d), at which a pair counts as converged.
ROUNDINGS = 16.0
SCHEMA = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
_WIDTHS = ("<i1", "<i2", "<i4", "<i8")


# ------------------------------------------------------------------ vectors as bytes
def pack_rows(y: np.ndarray) -> list[bytes]:
    """Each row in the least width that holds all its entries."""
    top = np.maximum(y.max(axis=1), -(y.min(axis=1) + 1))
    out: list = [None] * len(y)
    low = -1
    for k, kind in enumerate(_WIDTHS):
        high = np.iinfo(kind).max
        at = np.flatnonzero((top > low) & (top <= high))
        low = high
        if len(at):
            data = np.ascontiguousarray(y[at].astype(kind)).view(np.uint8).reshape(len(at), -1)
            data = np.concatenate([np.full((len(at), 1), k, np.uint8), data], axis=1).tobytes()
            size = len(data) // len(at)
            for i, j in enumerate(at.tolist()):
                out[j] = data[i * size:(i + 1) * size]
    return out


def unpack_rows(column: pa.Array, d: int) -> np.ndarray:
    """int64 rows of packed vectors, in order."""
    column = column.cast(pa.large_binary())
    _, off, data = column.buffers()
    off = np.frombuffer(off, np.int64)[column.offset:column.offset + len(column) + 1]
    data = np.frombuffer(data, np.uint8)
    out = np.empty((len(column), d), np.int64)
    kinds = data[off[:-1]]
    for k in np.unique(kinds).tolist():
        at = np.flatnonzero(kinds == k)
        size = d * np.dtype(_WIDTHS[k]).itemsize
        if len(at) == len(column):
            out[:] = data[off[0]:off[-1]].reshape(len(at), size + 1)[:, 1:].copy().view(_WIDTHS[k])
        else:
            out[at] = data[(off[at] + 1)[:, None] + np.arange(size)].view(_WIDTHS[k])
    return out


def vectors(embeddings: DataFrame) -> tuple[DataFrame, int]:
    """(vec_id, y) of the rows that remain, y packed (x less the shift), written once; and the dimension."""
    v = F.transform("embedding", lambda c: c.cast("double"))
    bad = F.exists(v, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    rows = embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding").where(F.col("embedding").isNotNull() & ~bad & (F.size("embedding") > 0))
    sizes = rows.groupBy(F.size("embedding").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).limit(1).collect()
    d = sizes[0]["d"] if sizes else 0
    rows = rows.where(F.size("embedding") == d).select("vec_id", F.transform("embedding", lambda c: c.cast("double")).alias("v"))

    def pack(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            c = np.floor(batch.column("v").flatten().to_numpy(zero_copy_only=False) * SCALE).reshape(batch.num_rows, d)
            if np.abs(c).max() >= 2.0 ** 52:
                raise ValueError("an entry of a vector is too large for a whole number")
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), pa.array(pack_rows(c.astype(np.int64)), pa.binary())], names=["vec_id", "y"])

    return written(rows.mapInArrow(pack, "vec_id long, y binary"), "vectors"), d


# ------------------------------------------------------------------ passes over the fit list
def summed(fit: DataFrame, d: int, work: Callable[[np.ndarray], np.ndarray], size: int, exact: bool = False) -> np.ndarray:
    """Sum over the fit list of ``work`` (int64 rows -> ``size`` numbers); tasks send one row each, added in the JVM."""
    kind, numbers = ("array<long>", pa.int64()) if exact else ("array<double>", pa.float64())

    def run(batches):
        total = None
        for batch in batches:
            for at in range(0, batch.num_rows, CHUNK):
                part = work(unpack_rows(batch.column("y").slice(at, CHUNK), d))
                total = part if total is None else total + part
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array([total], pa.list_(numbers))], names=["part"])

    parts = fit.mapInArrow(run, f"part {kind}").select(F.posexplode("part").alias("at", "value"))
    out = np.zeros(size, np.int64 if exact else np.float64)
    for r in parts.groupBy("at").agg(F.sum("value").alias("value")).collect():  # ``size`` rows
        out[r["at"]] = r["value"]
    return out


class Centre:
    """x - S / n of whole rows, formed from whole numbers."""

    def __init__(self, n: int, sums: np.ndarray):
        self.n = n
        self.q, self.r = np.divmod(sums, n)

    def __call__(self, y: np.ndarray) -> np.ndarray:
        return (y - self.q).astype(np.float64) - self.r / self.n

    def deviation(self, y: np.ndarray) -> list[int | None]:
        """Sum of (n x - S)^2, exact; None where a long does not hold it."""
        near = ((self(y) * self.n) ** 2).sum(axis=1)
        if len(y) == 0 or near.max() < 2.0 ** 62:
            e = (y - self.q) * self.n - self.r
            return (e * e).sum(axis=1).tolist()
        e = (y - self.q).astype(object) * self.n - self.r.astype(object)
        return [x if x < 1 << 63 else None for x in (e * e).sum(axis=1)]


def product(fit: DataFrame, d: int, centre: Centre) -> Callable[[np.ndarray], np.ndarray]:
    """Q -> V Q: one pass, centred before multiplying."""

    def times(q: np.ndarray) -> np.ndarray:
        def work(y):
            x = centre(y)
            return (x.T @ (x @ q)).ravel()
        return summed(fit, d, work, q.size).reshape(q.shape) / centre.n
    return times


# ------------------------------------------------------------------ Jacobi-Davidson
def _orthonormal(block: np.ndarray, *others: np.ndarray) -> np.ndarray:
    """An orthonormal basis of the block's part orthogonal to the others; columns that vanish go."""
    keep = []
    for v in block.T:
        norm = np.linalg.norm(v)
        for _ in range(3):
            for o in others:
                v = v - o @ (o.T @ v)
            for o in keep:
                v = v - o * (o @ v)
        if norm and np.linalg.norm(v) > 1e-10 * norm:
            keep.append(v / np.linalg.norm(v))
    return np.array(keep).T.reshape(block.shape[0], len(keep))


def minres(times: Callable[[np.ndarray], np.ndarray], theta: np.ndarray, away: np.ndarray, rhs: np.ndarray, steps: int, cut: float) -> np.ndarray:
    """MINRES for (I - QQ')(A - theta I)(I - QQ') t = rhs, one column per theta, Q = ``away``; one product a step."""
    def project(v):
        return v - away @ (away.T @ v)

    d, b = rhs.shape
    rhs = project(rhs)
    beta = np.linalg.norm(rhs, axis=0)
    target = cut * beta
    v_old, v = np.zeros((d, b)), rhs / np.where(beta > 0, beta, 1)
    t, w, w_old = np.zeros((d, b)), np.zeros((d, b)), np.zeros((d, b))
    eta, c, c_old, s, s_old = beta.copy(), np.ones(b), np.ones(b), np.zeros(b), np.zeros(b)
    beta_now, live = np.zeros(b), beta > 0
    for _ in range(steps):
        if not live.any():
            break
        u = project(times(v)) - theta * v
        alpha = (v * u).sum(axis=0)
        u = project(u - alpha * v - beta_now * v_old)
        beta_next = np.linalg.norm(u, axis=0)
        rho_0 = c * alpha - c_old * s * beta_now
        rho_1 = np.hypot(rho_0, beta_next)
        rho_2 = s * alpha + c_old * c * beta_now
        rho_3 = s_old * beta_now
        live &= rho_1 > 0
        safe = np.where(live, rho_1, 1)
        c_old, c, s_old, s = c, rho_0 / safe, s, beta_next / safe
        w_old, w = w, (v - rho_3 * w_old - rho_2 * w) / safe
        t = t + np.where(live, c * eta, 0) * w
        eta = -s * eta
        live &= (np.abs(eta) > target) & (beta_next > 1e-14 * np.abs(theta))
        v_old, v, beta_now = v, u / np.where(beta_next > 0, beta_next, 1), beta_next
    return project(t)


def jacobi_davidson(times: Callable[[np.ndarray], np.ndarray], d: int, k: int, guard: int = 4, steps: int = 6, cut: float = 0.05,
                    rounds: int = 200) -> tuple[np.ndarray, np.ndarray]:
    """The ``k`` largest eigenpairs of a symmetric positive operator on R^d, by falling eigenvalue."""
    k = min(k, d)
    width, space = min(d, k + guard), min(d, 4 * k + guard)
    rng = np.random.default_rng(11)
    locked, values = np.zeros((d, 0)), np.zeros(0)
    basis = _orthonormal(rng.standard_normal((d, width)))
    image = times(basis)
    best, stalled = np.inf, 0
    for _ in range(rounds):
        want = k - locked.shape[1]
        theta, y = np.linalg.eigh((basis.T @ image + image.T @ basis) / 2)
        theta, y = theta[::-1], y[:, ::-1]
        ritz, ritz_image = basis @ y, image @ y
        top = max(values[0] if len(values) else 0.0, theta[0] if len(theta) else 0.0)
        level = ROUNDINGS * np.finfo(float).eps * top * np.sqrt(d)
        residual = ritz_image[:, :want] - ritz[:, :want] * theta[:want]
        residual -= locked @ (locked.T @ residual)
        norms = np.linalg.norm(residual, axis=0)
        done = int(np.argmax(norms > level)) if (norms > level).any() else want
        if norms.size and norms.max() < 0.5 * best:
            best, stalled = norms.max(), 0
        else:
            stalled += 1
        if stalled > 8 and norms.max() <= 64 * level:
            done = want  # the rounding of the products themselves
        if done:
            locked, values = np.concatenate([locked, ritz[:, :done]], axis=1), np.concatenate([values, theta[:done]])
            basis, image, best, stalled = ritz[:, done:], ritz_image[:, done:], np.inf, 0
            residual, theta, ritz, ritz_image = residual[:, done:], theta[done:], ritz[:, done:], ritz_image[:, done:]
            want -= done
        if not want:
            # one more Rayleigh-Ritz in the locked space, from a fresh product: orthonormal and ordered
            q = np.linalg.qr(locked)[0]
            theta, y = np.linalg.eigh(q.T @ times(q))
            return theta[::-1], q @ y[:, ::-1]
        new = minres(times, theta[:want], np.concatenate([locked, ritz[:, :want]], axis=1), -residual[:, :want], steps, cut)
        if space < d and basis.shape[1] + want > space - locked.shape[1]:
            basis, image = ritz[:, :want + guard].copy(), ritz_image[:, :want + guard].copy()
        new = _orthonormal(new, locked, basis)
        if not new.shape[1]:  # the space is exhausted by what is known, or the corrections vanish: a fresh direction
            new = _orthonormal(rng.standard_normal((d, min(want, d - locked.shape[1] - basis.shape[1]))), locked, basis)
        if new.shape[1]:
            basis, image = np.concatenate([basis, new], axis=1), np.concatenate([image, times(new)], axis=1)
        else:
            image = times(basis)
    raise ArithmeticError("Jacobi-Davidson did not converge")


# ------------------------------------------------------------------ whitening
def whiten(embeddings: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """One row per remaining vector and component."""
    spark = embeddings.sparkSession
    rows, d = vectors(embeddings)
    if not d:
        return spark.createDataFrame([], SCHEMA)
    fit = written(rows.groupBy("y").agg(F.lit(1)).select("y"), "fit")
    head = summed(fit, d, lambda y: np.append(y.sum(axis=0), len(y)), d + 1, exact=True)
    n, sums = int(head[-1]), head[:-1]
    centre = Centre(n, sums)
    values, q = jacobi_davidson(product(fit, d, centre), d, components)
    keep = values > d * np.finfo(float).eps * max(values[0], 0.0) * 64 if n > 1 else np.zeros(len(values), bool)
    values, q = values[keep], q[:, keep]
    k = len(values)
    if not k:
        return spark.createDataFrame([], SCHEMA)
    project = q / np.sqrt(values)

    def check(y):
        x = centre(y)
        w = x @ project
        return np.append((w.T @ w).ravel(), (x * x).sum())

    found = summed(fit, d, check, k * k + 1) / n
    error = float(np.abs(found[:-1].reshape(k, k) - np.eye(k)).max())
    share = (values / found[-1]).tolist()

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, CHUNK):
                part = batch.slice(at, CHUNK)
                y, m = unpack_rows(part.column("y"), d), part.num_rows
                far = pa.array(centre.deviation(y), pa.int64())
                each = pa.array(np.repeat(np.arange(m), k))
                yield pa.RecordBatch.from_arrays(
                    [part.column("vec_id").take(each), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)), pa.array(np.full(m * k, n, np.int64)),
                     far.take(each), pa.array((centre(y) @ project).ravel()), pa.array(np.tile(share, m)), pa.array(np.full(m * k, error))],
                    names=[c.split()[0] for c in SCHEMA.split(", ")])

    return rows.mapInArrow(run, SCHEMA)
