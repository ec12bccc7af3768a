"""Embedding whitening: covariance on the cluster, eigenvectors by Householder and Sturm.

1. Every component c becomes the whole number ``x = floor(SCALE * c) + SHIFT``; the number of
   vectors n and the sums S per dimension are exact.
2. The covariance ``V`` (divisor n) is summed over tasks from vectors that are centred before
   they are multiplied: a task gives one triangle of dim * (dim + 1) / 2 numbers.
3. On the driver, which holds V alone (dim x dim, ``MOST_DIM`` at most, whatever the number of
   rows): Householder reflections make V tridiagonal; counting sign changes of Sturm sequences
   bisects the leading eigenvalues; inverse iteration finds their vectors, made orthogonal to
   those of the same cluster of eigenvalues; the reflections carry them back.
4. The components (``k`` times dim numbers) go with the tasks that project every row. The
   covariance of what they wrote, less the identity, is measured over all rows.

The covariance's and projection's parts meet by partial aggregates on keys whose number is set
by the dimension alone. Cases: rows whose vector is null or holds null or non-finite entries are
dropped, also from n; so are those with an entry beyond ``LARGEST`` (x would be no long). A zero
vector takes part. Of vectors of several lengths the most frequent length takes part (ties: the
longest); empty vectors never do. Ids may repeat or be null: each row is one vector. Components
are numbered up to the smaller of ``k`` and the dimension; those without variance (within
rounding) whiten to 0 and are left out of the identity error; their share explained is what it is
(0 where nothing varies). A deviation beyond a long is null. An empty table gives an empty result;
other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._util import staged
from ._vectors import matrix

SCALE, SHIFT, COMPONENTS, MOST_DIM = 1024, 100_000, 8, 4096
LARGEST = 2.0 ** 50
AT_ONCE = 4096
EPS = np.finfo(float).eps


def scaled(v: np.ndarray) -> np.ndarray:
    return np.floor(SCALE * v).astype(np.int64) + SHIFT


def fitting_rows(table: DataFrame, key: str, vector: str) -> DataFrame:
    """``(id, v)`` of the rows that take part, and of the one length that does."""
    v = F.col(vector).cast("array<double>")
    fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < LARGEST))
    rows = table.select(F.col(key).alias("id"), v.alias("v")).where(F.coalesce(fine & (F.size(v) > 0), F.lit(False)))
    # one row: the length of most vectors
    common = (rows.groupBy(F.size("v").alias("d")).agg(F.count(F.lit(1)).alias("n"))
              .agg(F.max(F.struct("n", "d")).alias("m")).select(F.col("m.d").alias("d")))
    return rows.join(F.broadcast(common), F.size("v") == F.col("d")).drop("d")


def exact_sums(rows: DataFrame) -> tuple[int, list[int]]:
    """``(n, S)``."""
    def add(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        n, total = 0, None
        for b in batches:
            if len(b):
                x = scaled(matrix(b["v"]))
                part = x.sum(axis=0) if np.abs(x).max() < 2 ** 40 else x.astype(object).sum(axis=0)  # a batch has under 2 ** 20 rows
                total = part.astype(object) + (0 if total is None else total)
                n += len(b)
        if n:
            yield pd.DataFrame({"j": range(-1, len(total)), "s": [str(n), *map(str, total)]})

    parts = rows.select("v").mapInPandas(add, "j int, s string")
    # dim + 1 rows
    got = sorted(parts.groupBy("j").agg(F.sum(F.col("s").cast("decimal(38,0)")).alias("s")).collect())
    return (int(got[0].s), [int(r.s) for r in got[1:]]) if got else (0, [])


class Centre:
    """The exact mean S / n as whole part and rest."""

    def __init__(self, n: int, sums: list[int]):
        self.n = n
        self.whole = np.array([s // n for s in sums], np.int64)
        self.rest = np.array([s % n for s in sums], np.int64)

    def centred(self, x: np.ndarray) -> np.ndarray:
        """x - S / n."""
        return (x - self.whole).astype(np.float64) - self.rest / self.n

    def deviation(self, x: np.ndarray) -> list[int | None]:
        """The exact sum over the dimensions of (n * x - S) ** 2."""
        whole = x - self.whole
        most = float(np.abs(whole).max(initial=0) + 1) * self.n
        if most < 2 ** 31 and most * most * x.shape[1] < 2 ** 62:
            return ((whole * self.n - self.rest) ** 2).sum(axis=1).tolist()
        exact = ((whole.astype(object) * self.n - self.rest.astype(object)) ** 2).sum(axis=1)
        return [int(e) if e < 2 ** 63 else None for e in exact]


def triangle_sums(rows: DataFrame, column: str, dim: int, read) -> np.ndarray:
    """The sum over all rows of the outer products of ``read(column)``'s rows: one triangle a task, added by place."""
    i, j = np.tril_indices(dim)

    def multiply(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total, any_ = np.zeros((dim, dim)), False
        for b in batches:
            for lo in range(0, len(b), AT_ONCE):
                c = read(b[column].iloc[lo:lo + AT_ONCE])
                total += c.T @ c
                any_ = True
        if any_:
            yield pd.DataFrame({"i": i, "j": j, "s": total[i, j]})

    out = np.zeros((dim, dim))
    # dim * (dim + 1) / 2 rows, set by the vectors' length alone
    for r in rows.select(column).mapInPandas(multiply, "i int, j int, s double").groupBy("i", "j").agg(F.sum("s").alias("s")).collect():
        out[r.i, r.j] = out[r.j, r.i] = r.s
    return out


def tridiagonal(a: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """Diagonal, next diagonal and the Householder vectors that lead there."""
    a, d = a.copy(), len(a)
    mirrors = []
    for k in range(d - 2):
        v = a[k + 1:, k].copy()
        to = -np.copysign(np.linalg.norm(v), v[0])  # what the mirror makes of the column
        v[0] -= to
        size = np.linalg.norm(v)
        if size > 0:
            v /= size
            rest = a[k + 1:, k + 1:]
            p = 2 * (rest @ v)
            p -= (p @ v) * v
            rest -= np.outer(v, p) + np.outer(p, v)
            a[k + 1:, k] = a[k, k + 1:] = 0
            a[k + 1, k] = a[k, k + 1] = to
        mirrors.append(v)
    return np.diag(a).copy(), np.diag(a, -1).copy(), mirrors


def below(diag: np.ndarray, next_: np.ndarray, at: np.ndarray) -> np.ndarray:
    """How many eigenvalues lie below each of ``at``: the sign changes of the Sturm sequence."""
    tiny = EPS * max(np.abs(diag).max(initial=0), np.abs(next_).max(initial=0), 1e-300)
    q = diag[0] - at
    count = (q < 0).astype(int)
    for i in range(1, len(diag)):
        q = np.where(np.abs(q) < tiny, -tiny, q)
        q = diag[i] - at - next_[i - 1] ** 2 / q
        count += q < 0
    return count


def leading_values(diag: np.ndarray, next_: np.ndarray, k: int) -> np.ndarray:
    """The ``k`` largest eigenvalues, falling, by bisection."""
    d = len(diag)
    reach = np.append(np.abs(next_), 0) + np.append(0, np.abs(next_))
    lo, hi = np.full(k, (diag - reach).min()), np.full(k, (diag + reach).max())
    wanted = d - 1 - np.arange(k)  # from the smallest, counted from 0
    for _ in range(200):
        mid = 0.5 * (lo + hi)
        if ((mid <= lo) | (mid >= hi)).all():
            break
        less = below(diag, next_, mid) <= wanted
        lo, hi = np.where(less, mid, lo), np.where(less, hi, mid)
    return 0.5 * (lo + hi)


def solved(diag: np.ndarray, next_: np.ndarray, at: float, b: np.ndarray) -> np.ndarray:
    """``(T - at I) x = b`` by elimination with row exchanges; a pivot of zero becomes a tiny one."""
    n = len(diag)
    scale = max(np.abs(diag).max(), np.abs(next_).max(initial=0), 1e-300)
    tiny = EPS * scale
    u0, u1, u2, x = diag - at, np.append(next_, 0.0), np.zeros(n), b.copy()
    for i in range(n - 1):
        low = next_[i]
        if abs(low) > abs(u0[i]):  # exchange rows i and i + 1
            m = u0[i] / low
            u0[i], u1[i], u0[i + 1], u2[i] = low, u0[i + 1], u1[i] - m * u0[i + 1], u1[i + 1]
            u1[i + 1] = -m * u2[i]
            x[i], x[i + 1] = x[i + 1], x[i] - m * x[i + 1]
        else:
            u0[i] = u0[i] if abs(u0[i]) > tiny else tiny
            m = low / u0[i]
            u0[i + 1] -= m * u1[i]
            x[i + 1] -= m * x[i]
    u0[-1] = u0[-1] if abs(u0[-1]) > tiny else tiny
    for i in range(n - 1, -1, -1):
        x[i] -= (u1[i] * x[i + 1] if i + 1 < n else 0) + (u2[i] * x[i + 2] if i + 2 < n else 0)
        x[i] /= u0[i]
        if abs(x[i]) > 1e150:  # only the direction counts
            x /= abs(x[i])
    return x


def leading_vectors(diag: np.ndarray, next_: np.ndarray, values: np.ndarray, seed: int = 11) -> np.ndarray:
    """Unit eigenvectors of the falling ``values`` by inverse iteration; those of a cluster (gaps
    under a thousandth of the norm) are made orthogonal in every step."""
    rng = np.random.default_rng(seed)
    norm = max(np.abs(diag).max(), np.abs(next_).max(initial=0), 1e-300)
    out = np.zeros((len(diag), len(values)))
    begin, before = 0, np.inf
    for k, e in enumerate(values):
        if k and values[k - 1] - e > 1e-3 * norm:
            begin = k
        at = min(e, before - 10 * EPS * norm) if k > begin else e  # equal values are told apart
        before = at
        x = rng.normal(size=len(diag))
        for _ in range(5):
            x = solved(diag, next_, at, x / np.linalg.norm(x))
            for _ in range(2):
                x -= out[:, begin:k] @ (out[:, begin:k].T @ x)
        out[:, k] = x / np.linalg.norm(x)
    return out


def components(v: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``k`` largest eigenvalues of a symmetric matrix and their unit vectors (columns)."""
    size = np.abs(v).max(initial=0)
    if size == 0:
        return np.zeros(k), np.eye(len(v))[:, :k]
    diag, next_, mirrors = tridiagonal(v / size)
    values = leading_values(diag, next_, k)
    x = leading_vectors(diag, next_, values)
    for j in range(len(mirrors) - 1, -1, -1):
        m = mirrors[j]
        x[j + 1:] -= 2 * np.outer(m, m @ x[j + 1:])
    return values * size, x


def whiten(table: DataFrame, key: str = "vec_id", vector: str = "embedding", k: int = COMPONENTS) -> DataFrame:
    """``(key, component, n, deviation, whitened, explained, identity_error)``, one row per vector and component."""
    kind = table.schema[key].dataType.simpleString()
    rows = staged(fitting_rows(table, key, vector), "vectors")
    n, sums = exact_sums(rows)
    dim = len(sums)
    if dim > MOST_DIM:
        raise ValueError(f"vectors of {dim} components: {MOST_DIM} at most, as the driver holds their covariance")
    k = min(k, dim)
    if not n:
        return table.sparkSession.createDataFrame([], f"{key} {kind}, component int, n long, deviation long, "
                                                      "whitened double, explained double, identity_error double")
    centre = Centre(n, sums)
    v = triangle_sums(rows, "v", dim, lambda c: centre.centred(scaled(matrix(c)))) / n
    values, vectors = components(v, k)
    trace = float(np.trace(v))
    varies = values > 1e-12 * max(trace, 1e-300)
    to = vectors / np.where(varies, np.sqrt(np.where(varies, values, 1.0)), np.inf)

    def project(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            if len(b):
                x = scaled(matrix(b["v"]))
                yield pd.DataFrame({"id": b["id"], "deviation": pd.array(centre.deviation(x), "Int64"),
                                    "w": list(centre.centred(x) @ to)})

    done = staged(rows.mapInPandas(project, f"id {kind}, deviation long, w array<double>"), "whitened")
    # the whitened mean is zero but for rounding, which the square of the sums takes out
    seen = triangle_sums(done, "w", k + 1, lambda c: np.column_stack([matrix(c), np.ones(len(c))]))
    mean = seen[k, :k] / n
    gap = np.abs(seen[:k, :k] / n - np.outer(mean, mean) - np.eye(k))[np.ix_(varies, varies)]
    shares = F.array(*[F.lit(float(e / trace) if trace > 0 else 0.0) for e in values])
    return (done.select("id", "deviation", F.posexplode("w").alias("at", "whitened"))
            .select(F.col("id").alias(key), (F.col("at") + 1).alias("component"), F.lit(n).cast("long").alias("n"), "deviation",
                    "whitened", F.element_at(shares, F.col("at") + 1).alias("explained"),
                    F.lit(float(gap.max(initial=0.0))).alias("identity_error")))
