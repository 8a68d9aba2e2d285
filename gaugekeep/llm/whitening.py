"""Whitening of embeddings by a bidiagonal qd solver.

Components are turned into integers x = floor(256 * c). The fit list holds each
distinct x vector once: n vectors with sums S per dimension. Tasks reduce their
centred rows (x - S/n) to a triangular R by QR of blocks, and the triangles of
several tasks to one, in rounds; so no covariance is formed and nothing but d x d
triangles (d: the dimension) travels. On the last R, Householder reflections give
a bidiagonal B, dqds its singular values, each to high relative accuracy, and
twisted factorisations of B'B - shift the directions. Close singular values are
told apart under a shift beside them (their relative gaps grow there); what stays
together is made orthogonal.

Cases: rows whose vector is null or holds null or non-finite entries, or which is
of another length than most (of two lengths as frequent, the smaller counts),
take no part; repeated rows, also of one id, give their rows each and count once
in the fit; no row or vectors without entries: no rows. Where a component has no
variance (few rows, constant dimensions), `whitened` is null, `explained` 0 (null
if no component has any), and identity_error is over the other components (null
if there is none). A deviation beyond a long is null. Entries beyond 2^55 are held
at that limit. Other columns are not read.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugekeep.llm.common import stored

SCALE = 256
LIMIT = 1 << 55
# Rows of one block of the QR (times the dimension: doubles held by a task), triangles merged by a task.
BLOCK_ROWS, FAN_IN = 4096, 16
EPS = float(np.finfo(np.float64).eps)
# Squared singular values closer than this share are told apart under a new shift.
CLOSE, ROUNDS = 1e-3, 8


# ------------------------------------------------- singular values and vectors


def bidiagonal(r: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(a, b, p): r = U B p' with B upper bidiagonal, a on and b above its diagonal."""
    m = np.array(r, np.float64)
    d = m.shape[1]
    p = np.eye(d)

    def reflector(v: np.ndarray) -> np.ndarray | None:
        size = np.linalg.norm(v)
        if size == 0 or not v[1:].any():
            return None
        w = v.copy()
        w[0] += math.copysign(size, v[0])
        return w / np.linalg.norm(w)

    for k in range(d):
        w = reflector(m[k:, k])
        if w is not None:
            m[k:, k:] -= 2 * np.outer(w, w @ m[k:, k:])
        if k < d - 2:
            w = reflector(m[k, k + 1:])
            if w is not None:
                m[k:, k + 1:] -= 2 * np.outer(m[k:, k + 1:] @ w, w)
                p[:, k + 1:] -= 2 * np.outer(p[:, k + 1:] @ w, w)
    return np.diag(m).copy(), np.diag(m, 1).copy(), p


def _dqds_step(q: list, e: list, shift: float) -> tuple[list, list, float] | None:
    """One dqds transform: (q, e, sum of 1/d), None if a d falls below zero."""
    n = len(q)
    d = q[0] - shift
    if d < 0:
        return None
    nq, ne, inverse = [0.0] * n, [0.0] * (n - 1), 0.0
    for i in range(n - 1):
        inverse += 1 / d if d > 0 else math.inf
        nq[i] = d + e[i]
        t = q[i + 1] / nq[i] if nq[i] > 0 else 0.0
        if nq[i] > 0:
            ne[i], d = e[i] * t, d * t - shift
        else:
            d = q[i + 1] - shift
        if d < 0:
            return None
    nq[-1] = d
    inverse += 1 / d if d > 0 else math.inf
    return nq, ne, inverse


def squared_singular_values(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Squares of the singular values of the bidiagonal (a, b), falling.

    A transform without shift gives 1 / (sum of 1/d), a bound below the smallest
    value, so that the transform shifted by it cannot fail but by rounding."""
    out: list[float] = []
    blocks = [((np.asarray(a, float) ** 2).tolist(), (np.asarray(b, float) ** 2).tolist(), 0.0)]
    while blocks:
        q, e, base = blocks.pop()
        for _ in range(200 * len(q) + 200):
            if len(q) == 1:
                out.append(base + max(q[0], 0.0))
                break
            if len(q) == 0:
                break
            # what lies below rounding of the values gone through splits the block
            slack = (EPS * base / 8) ** 2
            cut = next((i for i in range(len(e) - 1, -1, -1) if e[i] <= EPS * EPS * (base + min(q[i], q[i + 1]))
                        or e[i] * (e[i] + max(q[i], q[i + 1])) <= slack), None)
            if cut is not None:
                if cut == len(e) - 1:
                    out.append(base + max(q[-1], 0.0))
                    q, e = q[:-1], e[:-1]
                else:
                    blocks.append((q[:cut + 1], e[:cut], base))
                    q, e = q[cut + 1:], e[cut + 1:]
                continue
            if 1.5 * q[0] < q[-1]:  # rows and columns turned round and transposed: the same values
                q, e = q[::-1], e[::-1]
            q, e, inverse = _dqds_step(q, e, 0.0)
            shift = (1 - 8 * EPS) / inverse if 0 < inverse < math.inf else 0.0
            step = _dqds_step(q, e, shift) if shift > EPS * base else None
            if step is not None:
                q, e, base = step[0], step[1], base + shift
        else:  # pragma: no cover - the bound makes every step converge
            raise ArithmeticError("dqds did not converge")
    return np.sort(np.array(out))[::-1]


def _twisted(dd: np.ndarray, ll: np.ndarray, lam: float) -> tuple[np.ndarray, float]:
    """(z, gamma): z solves (L D L' - lam) z = gamma e_r, r where |gamma| is least."""
    n = len(dd)
    tiny = EPS * EPS * (abs(lam) + float(np.abs(dd).max()) + 1e-290)
    lower, upper = np.zeros(n), np.zeros(n)
    s, p = np.zeros(n), np.zeros(n)
    s[0] = -lam
    for i in range(n - 1):
        x = s[i] + dd[i]
        x = x if abs(x) > tiny else tiny
        lower[i] = dd[i] * ll[i] / x
        s[i + 1] = lower[i] * ll[i] * s[i] - lam
    p[-1] = dd[-1] - lam
    for i in range(n - 2, -1, -1):
        x = dd[i] * ll[i] * ll[i] + p[i + 1]
        x = x if abs(x) > tiny else tiny
        t = dd[i] / x
        upper[i] = ll[i] * t
        p[i] = p[i + 1] * t - lam
    gamma = s + p + lam
    r = int(np.argmin(np.abs(gamma)))
    z = np.zeros(n)
    z[r] = 1.0
    for i in range(r - 1, -1, -1):
        z[i] = -lower[i] * z[i + 1]
    for i in range(r, n - 1):
        z[i + 1] = -upper[i] * z[i]
    return z, float(gamma[r])


def _below(dd: np.ndarray, ll: np.ndarray, lam: float) -> int:
    """How many eigenvalues of L D L' lie below `lam`."""
    count, s = 0, -lam
    tiny = EPS * EPS * (abs(lam) + float(np.abs(dd).max()) + 1e-290)
    for i in range(len(dd)):
        x = s + dd[i]
        x = x if abs(x) > tiny else -tiny
        count += x < 0
        if i < len(dd) - 1:
            s = dd[i] * ll[i] / x * ll[i] * s - lam
    return count


def _bisected(dd: np.ndarray, ll: np.ndarray, k: int, lo: float, hi: float) -> float:
    """The k-th smallest eigenvalue of L D L' (k from 0), between lo and hi."""
    width = max(hi - lo, EPS * max(abs(lo), abs(hi)), 1e-300)
    while _below(dd, ll, lo) > k:
        lo, width = lo - width, 2 * width
    while _below(dd, ll, hi) <= k:
        hi, width = hi + width, 2 * width
    for _ in range(200):
        mid = 0.5 * (lo + hi)
        if hi - lo <= 4 * EPS * max(abs(lo), abs(hi)) or mid in (lo, hi):
            break
        lo, hi = (lo, mid) if _below(dd, ll, mid) > k else (mid, hi)
    return 0.5 * (lo + hi)


def _vector(dd: np.ndarray, ll: np.ndarray, lam: float) -> np.ndarray:
    for _ in range(4):
        z, gamma = _twisted(dd, ll, lam)
        size = float(z @ z)
        step = gamma / size
        if not math.isfinite(step) or abs(step) <= 2 * EPS * abs(lam):
            break
        lam += step
    return z / np.linalg.norm(z)


def _shifted(dd: np.ndarray, ll: np.ndarray, by: float) -> tuple[np.ndarray, np.ndarray]:
    """L D L' - by as another such product."""
    n = len(dd)
    out_d, out_l, s = np.zeros(n), np.zeros(max(n - 1, 0)), -by
    tiny = EPS * EPS * (abs(by) + float(np.abs(dd).max()))
    for i in range(n):
        x = s + dd[i]
        out_d[i] = x if abs(x) > tiny else tiny
        if i < n - 1:
            out_l[i] = dd[i] * ll[i] / out_d[i]
            s = out_l[i] * ll[i] * s - by
    return out_d, out_l


def _vectors(dd: np.ndarray, ll: np.ndarray, lams: list[float], first: int, depth: int = 0) -> list[np.ndarray]:
    """Unit eigenvectors of L D L' for `lams` (rising; their places from `first`)."""
    out: list[np.ndarray] = []
    i = 0
    while i < len(lams):
        j = i + 1
        while j < len(lams) and lams[j] - lams[j - 1] <= CLOSE * max(abs(lams[j]), abs(lams[j - 1])):
            j += 1
        group = lams[i:j]
        spread = group[-1] - group[0]
        if j - i == 1:
            out.append(_vector(dd, ll, group[0]))
        elif depth < ROUNDS and spread > 64 * EPS * max(abs(group[0]), abs(group[-1])):
            by = group[-1] + max(spread * 1e-2, 16 * EPS * abs(group[-1]))
            new_d, new_l = _shifted(dd, ll, by)
            fresh = [_bisected(new_d, new_l, first + i + k, g - by - spread * 1e-3, g - by + spread * 1e-3)
                     for k, g in enumerate(group)]
            out += _orthogonal(_vectors(new_d, new_l, sorted(fresh), first + i, depth + 1))
        else:
            out += _orthogonal([_vector(dd, ll, g) for g in group], dd, ll, group)
        i = j
    return out


def _orthogonal(vectors: list[np.ndarray], dd=None, ll=None, lams=None) -> list[np.ndarray]:
    """The vectors of a group made orthogonal; where one nearly lies in the span
    of those before it, a start of its own replaces it, improved by the group's inverse."""
    done: list[np.ndarray] = []
    for k, v in enumerate(vectors):
        w = v.copy()
        for _ in range(2):
            for u in done:
                w -= (u @ w) * u
        if np.linalg.norm(w) < 0.1 and lams is not None:
            w = np.random.default_rng(k).standard_normal(len(v))
            for _ in range(6):
                for u in done:
                    w -= (u @ w) * u
                w = _solve(dd, ll, lams[k], w / np.linalg.norm(w))
            for _ in range(2):
                for u in done:
                    w -= (u @ w) * u
        done.append(w / np.linalg.norm(w))
    return done


def _solve(dd: np.ndarray, ll: np.ndarray, lam: float, rhs: np.ndarray) -> np.ndarray:
    """(L D L' - lam)^-1 rhs by the shifted factors."""
    new_d, new_l = _shifted(dd, ll, lam)
    x = rhs.copy()
    for i in range(len(x) - 1):
        x[i + 1] -= new_l[i] * x[i]
    x /= new_d
    for i in range(len(x) - 2, -1, -1):
        x[i] -= new_l[i] * x[i + 1]
    return x / np.linalg.norm(x)


def directions(r: np.ndarray, top: int) -> tuple[np.ndarray, np.ndarray]:
    """(squared singular values, right singular vectors in columns) of the
    triangular r: the `top` largest, falling."""
    a, b, p = bidiagonal(r)
    size = max(float(np.abs(a).max(initial=0)), float(np.abs(b).max(initial=0)))
    d = len(a)
    if size == 0:
        return np.zeros(min(top, d)), np.eye(d)[:, :top]
    # parts of B that hang together by less than rounding are solved one by one
    a = np.where(np.abs(a) <= EPS * size * EPS, EPS * EPS * size, a)
    ends = [i + 1 for i in range(d - 1) if abs(b[i]) <= EPS * size * EPS] + [d]
    found, lo = [], 0
    for hi in ends:
        aa, bb = a[lo:hi], b[lo:hi - 1]
        values = squared_singular_values(aa, bb)[::-1]  # rising
        keep = min(top + 8, len(values))
        first = len(values) - keep
        while first > 0 and values[first] - values[first - 1] <= CLOSE * values[first]:
            first -= 1
        vectors = _vectors(aa * aa, bb / aa[:-1], values[first:].tolist(), first)
        for value, z in zip(values[first:], vectors, strict=True):
            full = np.zeros(d)
            full[lo:hi] = z
            found.append((value, full))
        lo = hi
    found.sort(key=lambda f: -f[0])
    values = np.array([f[0] for f in found[:top]])
    vectors = p @ np.column_stack([f[1] for f in found[:top]])
    return values, vectors / np.linalg.norm(vectors, axis=0)


# ------------------------------------------------------------------ Spark side


def _matrix(column) -> np.ndarray:
    flat = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    n = len(flat)
    return flat.flatten().to_numpy(zero_copy_only=False).reshape(n, -1) if n else np.empty((0, 0), np.int64)


def integer_vectors(rows: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(vec_id, x array<long>) of the rows that take part."""
    v = rows.select(rows[id_col].alias("vec_id"), rows[vector_col].cast("array<double>").alias("v"))
    inf = F.lit(float("inf"))
    v = v.filter(F.col("v").isNotNull() & F.forall("v", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < inf)))
    limit = F.lit(float(LIMIT))
    return v.select("vec_id", F.transform("v", lambda c: F.floor(F.greatest(F.least(c * SCALE, limit), -limit)).cast("long")).alias("x"))


def _sums(fit: DataFrame, d: int) -> tuple[int, list[int]]:
    """(n, sums per dimension), exact: halves of 28 bits are summed apart."""
    def run(batches):
        for b in batches:
            x = _matrix(b.column("x"))
            if len(x):
                high, low = x >> 28, x & ((1 << 28) - 1)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.arange(d, dtype=np.int32)), pa.array(np.full(d, len(x), np.int64)),
                     pa.array(high.sum(0)), pa.array(low.sum(0))], ["i", "n", "high", "low"])

    parts = fit.mapInArrow(run, "i int, n long, high long, low long").groupBy("i").agg(
        F.sum("n").alias("n"), F.sum(F.col("high").cast("decimal(20,0)")).alias("high"),
        F.sum(F.col("low").cast("decimal(20,0)")).alias("low")).orderBy("i").collect()
    return (parts[0].n, [(int(p.high) << 28) + int(p.low) for p in parts]) if parts else (0, [0] * d)


def _triangle(fit: DataFrame, mean: np.ndarray) -> np.ndarray:
    """R of the centred rows: QR of blocks within tasks, then of the triangles of
    FAN_IN tasks at a time, until one is left."""
    d = len(mean)
    out = "part long, r array<double>"

    def one(part: int, r: np.ndarray):
        return pa.RecordBatch.from_arrays([pa.array([part], pa.int64()), pa.array([r.ravel()], pa.list_(pa.float64()))], ["part", "r"])

    def blocks(batches):
        from pyspark import TaskContext
        r = np.empty((0, d))
        for b in batches:
            x = _matrix(b.column("x"))
            for i in range(0, len(x), BLOCK_ROWS):
                r = np.linalg.qr(np.vstack([r, x[i:i + BLOCK_ROWS] - mean]), mode="r")
        if len(r):
            yield one(TaskContext.get().partitionId(), r)

    def merged(key, table):
        order = np.argsort(table.column("part").to_numpy())
        rows = _matrix(table.column("r").take(pa.array(order))).reshape(-1, d) if d else np.empty((0, 0))
        return pa.Table.from_batches([one(key[0].as_py(), np.linalg.qr(rows, mode="r"))])

    def padded(batches):  # triangles of fewer than d rows: with zero rows, so that all are d x d
        for b in blocks(batches):
            r = np.array(b.column("r")[0].as_py()).reshape(-1, d)
            yield one(b.column("part")[0].as_py(), np.vstack([r, np.zeros((d - len(r), d))]))

    parts = stored(fit.mapInArrow(padded, out), "whitening-r")
    while parts.count() > 1:
        numbered = parts.withColumn("part", (F.col("part") / F.lit(FAN_IN)).cast("long"))
        parts = stored(numbered.groupBy("part").applyInArrow(merged, out), "whitening-r")
    return np.array(parts.first().r).reshape(d, d)


def _identity_error(fit: DataFrame, mean: np.ndarray, to: np.ndarray, n: int) -> float | None:
    """Largest entry of the whitened fit list's covariance minus the identity."""
    k = to.shape[1]
    if not k:
        return None
    names = [f"s{i}" for i in range(k)] + [f"p{i}_{j}" for i in range(k) for j in range(i, k)]

    def run(batches):
        for b in batches:
            x = _matrix(b.column("x"))
            if len(x):
                w = (x - mean) @ to
                got = [w[:, i].sum() for i in range(k)] + [w[:, i] @ w[:, j] for i in range(k) for j in range(i, k)]
                yield pa.RecordBatch.from_arrays([pa.array([float(g)]) for g in got], names)

    sums = fit.mapInArrow(run, ", ".join(f"{c} double" for c in names)).agg(*[F.sum(c).alias(c) for c in names]).first()
    means = [sums[f"s{i}"] / n for i in range(k)]  # zero but for rounding, as x is centred
    return max(abs(sums[f"p{i}_{j}"] / n - means[i] * means[j] - (i == j)) for i in range(k) for j in range(i, k))


def _deviation(x: np.ndarray, n: int, sums: list[int]) -> list[int | None]:
    """Sum of (n * x - S)^2 of each row, exact."""
    top = n * int(np.abs(x).max(initial=0)) + max((abs(s) for s in sums), default=0)
    if top * top * max(len(sums), 1) < 1 << 63:
        y = x * np.int64(n) - np.array(sums, np.int64)
        return (y * y).sum(1).tolist()
    y = x.astype(object) * n - np.array(sums, object)
    return [v if v < 1 << 63 else None for v in (y * y).sum(1).tolist()]


def whiten(rows: DataFrame, components: int = 4, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """vec_id, component, n, deviation, whitened, explained, identity_error."""
    spark = rows.sparkSession
    out = ("vec_id bigint, component int, n bigint, deviation bigint, whitened double, explained double, identity_error double")
    ints = integer_vectors(rows, id_col, vector_col)
    size = ints.groupBy(F.size("x").alias("d")).count().orderBy(F.desc("count"), "d").limit(1).collect()
    if not size or size[0].d == 0:
        return spark.createDataFrame([], out)
    d = size[0].d
    ints = ints.filter(F.size("x") == d).select(F.col("vec_id").cast("long").alias("vec_id"), "x")
    fit = stored(ints.select("x").distinct(), "whitening-fit")
    n, sums = _sums(fit, d)
    mean = np.array([s / n for s in sums])
    values, vectors = directions(r := _triangle(fit, mean), components)
    total = float((r * r).sum())
    # what rounding alone can make is no variance to scale by
    noise = (8 * d * EPS) ** 2 * (values[0] + n * float((mean * mean).max()))
    sound = [i for i in range(len(values)) if values[i] > noise]
    to = vectors[:, sound] * np.sqrt(n / values[sound]) if sound else np.empty((d, 0))
    error = _identity_error(fit, mean, to, n)
    k = len(values)
    at = {c: j for j, c in enumerate(sound)}
    explained = [None if not sound else float(values[c] / total) if c in at else 0.0 for c in range(k)]

    def run(batches):
        for b in batches:
            x = _matrix(b.column("x"))
            m = len(x)
            if not m:
                continue
            w = (x - mean) @ to
            deviation = _deviation(x, n, sums)
            white = [w[:, at[c]] if c in at else None for c in range(k)]
            yield pa.RecordBatch.from_arrays(
                [pa.concat_arrays([b.column("vec_id")] * k), pa.array(np.repeat(np.arange(1, k + 1, dtype=np.int32), m)),
                 pa.array(np.full(m * k, n)), pa.array(deviation * k, pa.int64()),
                 pa.concat_arrays([pa.nulls(m, pa.float64()) if c is None else pa.array(c) for c in white]),
                 pa.array(np.repeat(np.array(explained, dtype=object), m).tolist(), pa.float64()),
                 pa.array([error] * (m * k), pa.float64())],
                ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return ints.mapInArrow(run, out)
