"""Whitening by the leading eigenvectors of the covariance, found by block Jacobi-Davidson without forming it.

The covariance V of the vectors is met through products alone: one Spark job takes a block of directions W to
mean((x - mean) ((x - mean) . W)), every vector centred before it is multiplied. The driver holds the subspace (a few
dozen directions of the vectors' length) and does the small algebra: Rayleigh-Ritz in the subspace, a correction for
every wanted pair that hasn't settled, each from the equation projected against what is locked and against its own Ritz
vector, by inner MINRES. All corrections of a round run side by side, so an inner step is one job for all of them. A
pair is locked when its residual is down to the rounding of the products; the search ends when all are.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, LongType, StructField, StructType

from tallyvane.llm.common import stored

COMPONENTS = 8
SCALE, SHIFT = 1024, 100_000
#: Residuals, as a share of the largest eigenvalue, at which a pair is locked: some units in the last place of a product.
RESIDUAL = 64 * np.finfo(float).eps
INNER, ROUNDS = 6, 60
#: Pairs beyond the wanted ones that are carried along: a wider block costs a product nothing that counts, and settles in fewer of them.
SPARE = 8
#: The subspace holds at most so many blocks of directions, then only its best ones.
BLOCKS = 6
#: Whole numbers up to here are themselves as doubles.
_EXACT = 1 << 53


def whole(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """Rows (vec_id, x) of vectors: x has floor(1024 * c) + 100000 for every entry c.

    Left out are rows whose vector is null or empty or holds a null or non-finite entry, or one whose x is over 2^53 (its
    place on the grid is unknown), and those whose length isn't the commonest (of equally common ones the greatest). Null
    ids and repeated rows stay. Other columns aren't read.
    """
    c = F.col(vector_col)
    fits = F.size(c) > 0
    sound = F.forall(c, lambda e: e.isNotNull() & ~F.isnan(e.cast("double")) & (F.abs(e.cast("double")) <= _EXACT // SCALE // 2))
    rows = vectors.where(c.isNotNull() & fits & F.coalesce(sound, F.lit(False)))
    sizes = rows.groupBy(F.size(c).alias("d")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), F.desc("d")).first()
    x = F.transform(c, lambda e: F.floor(SCALE * e.cast("double")).cast("long") + SHIFT)
    return rows.where(F.size(c) == (sizes["d"] if sizes else 0)).select(F.col(id_col).alias("vec_id"), x.alias("x"))


def matrix(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    flat = (column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column).flatten()
    return flat.to_numpy(zero_copy_only=False).reshape(len(column), -1) if len(column) else np.empty((0, 0))


@dataclass(frozen=True)
class Moments:
    """Of n vectors of d whole entries: by entry the sum, the least and the greatest."""

    n: int
    sums: list[int]
    lows: list[int]
    highs: list[int]

    @property
    def d(self) -> int:
        return len(self.sums)

    def _apart(self) -> tuple[np.ndarray, np.ndarray]:
        """The means as whole part and n times the rest."""
        return np.array([s // self.n for s in self.sums], dtype=np.int64), np.array([s % self.n for s in self.sums], dtype=np.int64)

    def centred(self, x: np.ndarray) -> np.ndarray:
        """x - S / n: the whole part of the mean is taken off before anything is rounded."""
        base, rest = self._apart()
        return (x - base).astype(float) - rest / self.n

    def deviations(self, x: np.ndarray) -> list[int | None]:
        """Of each row, the sum of (n x - S)^2, exact; None where a long can't hold it."""
        base, rest = self._apart()
        most = sum(max(self.n * h - s, s - self.n * low) ** 2 for s, low, h in zip(self.sums, self.lows, self.highs, strict=True))
        if most < 1 << 63:
            return ((self.n * (x - base) - rest) ** 2).sum(axis=1).tolist()
        exact = ((self.n * (x - base).astype(object) - rest.astype(object)) ** 2).sum(axis=1)
        return [int(v) if v < 1 << 63 else None for v in exact]


def moments(rows: DataFrame) -> Moments | None:
    """Of rows with x, which all have one length; None without rows. Sums are exact."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, sums, lows, highs = 0, None, None, None
        for b in batches:
            if not b.num_rows:
                continue
            x = matrix(b.column(0))
            own = x.sum(axis=0).tolist() if np.abs(x).max() < 1 << 48 else x.astype(object).sum(axis=0).tolist()
            sums = own if sums is None else [p + q for p, q in zip(sums, own, strict=True)]
            lows = x.min(axis=0) if lows is None else np.minimum(lows, x.min(axis=0))
            highs = x.max(axis=0) if highs is None else np.maximum(highs, x.max(axis=0))
            n += b.num_rows
        if n:
            yield pa.RecordBatch.from_arrays([pa.array(range(len(sums)), pa.int32()), pa.array([n] * len(sums), pa.int64()), pa.array([Decimal(s) for s in sums], pa.decimal128(38, 0)), pa.array(lows), pa.array(highs)], ["i", "n", "s", "low", "high"])

    parts = rows.select("x").mapInArrow(run, "i int, n bigint, s decimal(38,0), low bigint, high bigint")
    found = parts.groupBy("i").agg(F.sum("n").alias("n"), F.sum("s").alias("s"), F.min("low").alias("low"), F.max("high").alias("high")).orderBy("i").collect()
    return Moments(found[0]["n"], *([int(r[k]) for r in found] for k in ("s", "low", "high"))) if found else None


def summed(rows: DataFrame, fit: Moments, of: Callable[[np.ndarray], np.ndarray], size: int) -> np.ndarray:
    """The sum of an array of so many numbers that `of` makes of a batch of centred vectors; the tasks' sums are added up by Spark."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size)
        for b in batches:
            if b.num_rows:
                total += of(fit.centred(matrix(b.column(0)))).ravel()
        yield pa.RecordBatch.from_arrays([pa.array([total], pa.list_(pa.float64()))], ["v"])

    parts = rows.select("x").mapInArrow(run, "v array<double>").select(F.posexplode("v").alias("i", "v"))
    out = np.zeros(size)
    for r in parts.groupBy("i").agg(F.sum("v").alias("v")).collect():
        out[r["i"]] = r["v"]
    return out


def _orthogonal(t: np.ndarray, *to: np.ndarray) -> np.ndarray:
    """An orthonormal basis of what t adds to the bases given; what is already in them is left out."""
    size = np.linalg.norm(t, axis=0)
    t = t[:, size > 0] / size[size > 0]
    for _ in range(2):
        for q in to:
            t = t - q @ (q.T @ t)
    kept: list[np.ndarray] = []
    for column in t.T:
        begun = np.linalg.norm(column)
        for _ in range(2):
            for q in kept:
                column = column - q * (q @ column)
        left = np.linalg.norm(column)
        if left > 1e-8 * max(begun, 1e-4):
            kept.append(column / left)
    out = np.array(kept).T if kept else np.empty((len(t), 0))
    for q in to:
        out = out - q @ (q.T @ out)
    return np.linalg.qr(out)[0] if out.shape[1] else out


def minres(apply: Callable[[np.ndarray], np.ndarray], b: np.ndarray, steps: int, share: float) -> np.ndarray:
    """Approximate solutions of symmetric systems, one a column of b, side by side; apply is called once a step for all.

    A column whose residual is down to the share of b, or whose Krylov space is used up, rests.
    """
    norm = lambda a: np.linalg.norm(a, axis=0)
    x, w, w2 = np.zeros_like(b), np.zeros_like(b), np.zeros_like(b)
    r1, r2, y = b, b, b
    beta = first = norm(b)
    oldb, dbar, epsln, phibar, cs, sn = np.ones_like(beta), np.zeros_like(beta), np.zeros_like(beta), beta.copy(), -np.ones_like(beta), np.zeros_like(beta)
    live = first > 0
    for step in range(steps):
        live = live & (phibar > share * first) & (beta > 1e-13 * first)
        if not live.any():
            break
        v = np.where(live, y / np.where(live, beta, 1), 0)
        y = np.where(live, apply(v), 0)
        r1, r2 = np.where(live, r1, 0), np.where(live, r2, 0)
        if step:
            y = y - r1 * (beta / oldb)
        alfa = (v * y).sum(axis=0)
        y = y - r2 * (alfa / np.where(live, beta, 1))
        r1, r2, oldb, beta = r2, y, np.where(live, beta, 1), norm(y)
        oldeps, delta, gbar = epsln, cs * dbar + sn * alfa, sn * dbar - cs * alfa
        epsln, dbar = sn * beta, -cs * beta
        gamma = np.where(live, np.maximum(np.hypot(gbar, beta), np.finfo(float).tiny), 1)
        cs, sn = gbar / gamma, beta / gamma
        phi, phibar = cs * phibar, np.where(live, sn * phibar, phibar)
        w, w2 = np.where(live, (v - oldeps * w2 - delta * w) / gamma, w), w
        x = np.where(live, x + phi * w, x)
    return x


@dataclass(frozen=True)
class Pairs:
    """Eigenvalues, falling, their unit vectors as columns, the residuals at which each was locked, and the products that it took."""

    values: np.ndarray
    vectors: np.ndarray
    residuals: np.ndarray
    products: int


def eigenpairs(product: Callable[[np.ndarray], np.ndarray], d: int, k: int, seed: int = 1) -> Pairs:
    """The k greatest eigenpairs of a symmetric, nonnegative operator on d numbers, known by its product with blocks of directions."""
    used = 0

    def times(w: np.ndarray) -> np.ndarray:
        nonlocal used
        used += 1
        return product(w)

    k, width = min(k, d), min(d, k + SPARE)
    locked, values, residuals = np.empty((d, 0)), [], []
    basis = _orthogonal(np.random.default_rng(seed).standard_normal((d, width)))
    image, scale, last = times(basis), 0.0, None
    for turn in range(ROUNDS):
        theta, s = np.linalg.eigh((basis.T @ image + image.T @ basis) / 2)
        theta, s = theta[::-1], s[:, ::-1]
        ritz, image = basis @ s, image @ s
        image = image - locked @ (locked.T @ image)
        scale = max(scale, float(np.abs(theta).max(initial=0)))
        rest = image - ritz * theta
        error = np.linalg.norm(rest, axis=0)
        want = k - len(values)
        # A product is rounded in its last places; where turns gain nothing any more there, that is all there is.
        still = last is not None and turn > 2 and error[0] > last / 2 and error[0] <= 64 * RESIDUAL * scale
        done = next((i for i in range(want) if error[i] > RESIDUAL * scale and not (still and i == 0)), want)
        last = error[done] if done < want else None
        if done:
            values += theta[:done].tolist()
            residuals += error[:done].tolist()
            locked = np.linalg.qr(np.hstack([locked, ritz[:, :done]]))[0] * 1.0
            ritz, image, theta, rest = ritz[:, done:], image[:, done:], theta[done:], rest[:, done:]
            error, want = error[done:], want - done
        if not want:
            break
        if ritz.shape[1] > (BLOCKS - 1) * width:
            ritz, image = ritz[:, : 2 * width], image[:, : 2 * width]
        ask = [i for i in range(min(want + SPARE, len(theta))) if error[i] > RESIDUAL * scale]
        u, shift = ritz[:, ask], theta[ask]

        def project(a: np.ndarray, u: np.ndarray = u, q: np.ndarray = locked) -> np.ndarray:
            a = a - q @ (q.T @ a)
            return a - u * (u * a).sum(axis=0)

        def corrected(a: np.ndarray, shift: np.ndarray = shift, project=project) -> np.ndarray:
            return project(times(project(a)) - a * shift)

        step = minres(corrected, project(-rest[:, ask]), INNER, 0.5 ** min(turn + 1, 7))
        more = _orthogonal(step, locked, ritz) if ritz.shape[1] + locked.shape[1] < d else np.empty((d, 0))
        if more.shape[1]:
            fresh = times(more)
            basis, image = np.hstack([ritz, more]), np.hstack([image, fresh - locked @ (locked.T @ fresh)])
        else:
            basis, image = ritz, times(ritz)
    else:
        raise RuntimeError(f"{k - len(values)} eigenpairs haven't settled in {ROUNDS} rounds")
    order = np.argsort(values)[::-1]
    return Pairs(np.array(values)[order], locked[:, order], np.array(residuals)[order], used)


@dataclass(frozen=True)
class Whitening:
    """What whitens: the moments of the fit list, eigenpairs, trace of V, and how far the whitened covariance is from the identity."""

    moments: Moments | None
    pairs: Pairs
    trace: float
    identity_error: float

    @property
    def weights(self) -> np.ndarray:
        return self.pairs.vectors / np.sqrt(self.pairs.values)


def fit(rows: DataFrame, k: int = COMPONENTS) -> Whitening:
    """Fitted on all rows of whole(), which should be stored: every product reads them once.

    Only components with some variance can be whitened, so fewer than k come of vectors that span fewer directions, and
    none of no rows, one row or equal rows.
    """
    own = moments(rows)
    if own is None:
        return Whitening(None, Pairs(np.empty(0), np.empty((0, 0)), np.empty(0), 0), 0.0, 0.0)
    n, d = own.n, own.d
    trace = float(summed(rows, own, lambda c: (c * c).sum(), 1)[0]) / n
    found = eigenpairs(lambda w: summed(rows, own, lambda c: c.T @ (c @ w), w.size).reshape(w.shape) / n, d, k) if trace else Pairs(np.empty(0), np.empty((d, 0)), np.empty(0), 0)
    some = found.values > 1024 * d * np.finfo(float).eps * found.values.max(initial=0)
    found = Pairs(found.values[some], found.vectors[:, some], found.residuals[some], found.products)
    out = Whitening(own, found, trace, 0.0)
    m = len(found.values)
    if not m:
        return out
    weights = out.weights
    mean = summed(rows, own, lambda c: (c @ weights).sum(axis=0), m) / n
    spread = summed(rows, own, lambda c: (c @ weights - mean).T @ (c @ weights - mean), m * m).reshape(m, m) / n
    return Whitening(own, found, trace, float(np.abs(spread - np.eye(m)).max()))


def whiten(rows: DataFrame, model: Whitening) -> DataFrame:
    """Rows of whole() with `whitened` (a number for each component, in their order) and `deviation` in place of x; none if the model has no component."""
    own, weights = model.moments, model.weights if len(model.pairs.values) else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows and weights is not None:
                x = matrix(b.column("x"))
                flat = own.centred(x) @ weights
                ends = np.arange(len(x) + 1, dtype=np.int32) * flat.shape[1]
                yield pa.RecordBatch.from_arrays([b.column("vec_id"), pa.array(own.deviations(x), pa.int64()), pa.ListArray.from_arrays(pa.array(ends), pa.array(flat.ravel()))], ["vec_id", "deviation", "whitened"])

    schema = StructType([rows.schema["vec_id"], StructField("deviation", LongType()), StructField("whitened", ArrayType(DoubleType()))])
    return rows.select("vec_id", "x").mapInArrow(run, schema)


def digest(vectors: DataFrame, k: int = COMPONENTS, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """One row for each vector and component: vec_id, component (from 1), n, deviation, whitened, explained, identity_error.

    What whole() leaves out has no rows; null ids and repeated rows have theirs. An empty table, or one without variance, gives no rows.
    """
    rows = stored(whole(vectors, id_col, vector_col))
    model = fit(rows, k)
    n = model.moments.n if model.moments else 0
    share = F.get(F.array(*(F.lit(float(v / model.trace)) for v in model.pairs.values)).cast("array<double>"), F.col("component") - 1)
    each = whiten(rows, model).select("vec_id", "deviation", F.posexplode("whitened").alias("at", "whitened")).withColumn("component", (F.col("at") + 1).cast("int"))
    return each.select("vec_id", "component", F.lit(n).cast("long").alias("n"), "deviation", "whitened", share.alias("explained"), F.lit(model.identity_error).alias("identity_error"))
