"""Approximate nearest neighbours by multiprobe p-stable hashing.

Largest inner product is made a distance: stored vectors are divided by the largest norm
and get one more component that makes them unit vectors, queries are unit vectors with a
zero there; the nearest in Euclidean distance is then the largest inner product.

Each of ``TABLES`` tables hashes a vector to a cell of ``m`` integers
``floor((a . x) / WIDTH + b)`` with Gaussian ``a`` (2-stable); ``m`` grows with the
logarithm of the row count so that a cell holds about ``PER_CELL`` vectors. A query visits
the perturbed cells of a table in descending order of their estimated chance to hold a
neighbour at a given cosine, in two looks:

1. The first look takes the cells most likely at the cosine ``NEAR``, until their chances sum to
   ``TARGET`` over the tables together or their expected content is ``AT_LEAST`` times k. Where a
   query has real neighbours it finds them here.
2. The second look knows the k-th score found, which the true k-th can only exceed. It goes on until
   the chances at that cosine sum to ``TARGET``: over both tables, each by its share, or in the one
   table that needs fewer rows for it alone. A query whose neighbours are hardly nearer than the
   rest so costs at most one pass over all rows; one with near neighbours visits nothing more.

What the second look finds can only raise the k-th score, so there is no third.

Every row is indexed. The cells that a query visits in a table are those whose chance is at least
that of the last one visited, so a look is one row for a query and table that holds this least
chance, not a row for each cell. Stored vectors lie in blocks of up to about ``PER_BLOCK``, sorted by
cell, of one region (the cells that share their leading directions; a hot cell is many blocks);
queries in blocks of one region too. A block of queries meets the blocks of the regions that one of
its queries visits, by a join of blocks that shuffles no vectors again. There each cell is multiplied
with the queries that visit it, in single precision; whatever comes within its error of a query's
k-th score so far is scored exactly, in double precision on the original vectors. A task keeps each
query's best k of what it has seen, so what leaves a task is bounded by k rows per query. Ties go to the
smaller id, so of equal vectors in a block only the k + 1 smallest ids are multiplied: no query ranks more.

Vectors that are null, zero, of odd length or hold null or non-finite components take no
part, as queries or candidates; neither do rows with a null id. Rows that repeat an id
are one candidate with its best score, and never a candidate of their own id. An empty
table gives an empty result.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ._shingles import mixed
from ._util import discarded, released, setting, staged
from ._vectors import valid_vectors

TABLES, WIDTH, TARGET, AT_LEAST, NEAR = 2, 1.2, 0.92, 25, 0.8
PER_CELL, PER_BLOCK, PER_QUERIES = 512, 8192, 8192
HALF = 2  # a direction has 2 * HALF intervals, the outer ones open
ENUMERATE = 1 << 20  # up to so many cells are listed, more come off a heap
BLOCK_BYTES = 1 << 23  # fewer vectors in a block where they are long
AT_ONCE = 1 << 21  # numbers of an intermediate matrix
SLACK = 1e-9  # by which the logarithm of a chance may differ where it is computed again
U = np.uint64


def phi(x: np.ndarray) -> np.ndarray:
    """The normal distribution function, to three digits: it only ranks cells."""
    return 0.5 * (1 + np.tanh(0.7978845608 * (x + 0.044715 * x ** 3)))


def functions_of(dim: int, m: int, seed: int = 5) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each table ``m`` Gaussian directions and offsets."""
    rng = np.random.default_rng(seed)
    return [(rng.normal(size=(dim, m)), rng.uniform(-0.5, 0.5, size=m)) for _ in range(TABLES)]


def place(x: np.ndarray, f: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """The cell of each row: ``m`` integers in ``[-HALF, HALF)``."""
    a, b = f
    return np.nan_to_num(np.clip(np.floor(x @ a / WIDTH + b), -HALF, HALF - 1)).astype(np.int64)


def cell_key(cell: np.ndarray, table: int) -> np.ndarray:
    key = np.full(cell.shape[:-1], U((table + 1) * 0x9E3779B97F4A7C15 % 2 ** 64))
    for k in range(cell.shape[-1]):
        key = mixed(key ^ (cell[..., k].view(U) + U(k << 40)))
    return key.view(np.int64)


def intervals(q: np.ndarray, f: tuple[np.ndarray, np.ndarray], cosine) -> tuple[np.ndarray, np.ndarray]:
    """For each direction and interval the chance of a neighbour at ``cosine`` and of any vector; ``q`` is
    one query, or a matrix of them with a cosine each."""
    a, b = f
    y = (q @ a)[..., None]
    cosine = np.asarray(cosine, float)[..., None, None]
    cut = (np.arange(-HALF + 1, HALF)[None, :] - b[:, None]) * WIDTH
    spread = np.maximum(1e-3, np.sqrt(np.maximum(0.0, 1 - cosine * cosine)))

    def chances(at: np.ndarray) -> np.ndarray:
        ends = np.ones((*at.shape[:-1], 1))
        return np.maximum(np.diff(np.concatenate([0 * ends, phi(at), ends], axis=-1), axis=-1), 1e-12)

    return chances((cut - cosine * y) / spread), chances(cut)


def digits(codes: np.ndarray, m: int) -> np.ndarray:
    """The intervals (from 0) of cells given by number, the first direction's in the highest place."""
    return codes[..., None] // (2 * HALF) ** np.arange(m - 1, -1, -1) % (2 * HALF)


def numbers(cells: np.ndarray) -> np.ndarray:
    """The numbers of cells given by integers in ``[-HALF, HALF)``."""
    return (cells + HALF) @ (2 * HALF) ** np.arange(cells.shape[-1] - 1, -1, -1)


def chance_of(near: np.ndarray, codes: np.ndarray) -> np.ndarray:
    """The chance of each query's own cells: the product over the directions."""
    at = digits(codes, near.shape[1])
    out = np.ones(codes.shape)
    for j in range(near.shape[1]):
        out *= np.take_along_axis(near[:, j], at[..., j], 1)
    return out


def best_cells(near: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Each query's ``most`` likeliest cells in order, and their chances. A prefix of a cell among them
    is among the best prefixes, so only those are continued."""
    p, codes = np.ones((len(near), 1)), np.zeros((len(near), 1), np.int64)
    for j in range(near.shape[1]):
        p = (p[:, :, None] * near[:, j, None, :]).reshape(len(near), -1)
        codes = (codes[:, :, None] * (2 * HALF) + np.arange(2 * HALF)).reshape(len(near), -1)
        if p.shape[1] > most:
            top = np.argpartition(-p, most - 1, axis=1)[:, :most]
            p, codes = np.take_along_axis(p, top, 1), np.take_along_axis(codes, top, 1)
    order = np.lexsort((codes, -p), axis=1)
    return np.take_along_axis(codes, order, 1), np.take_along_axis(p, order, 1)


def listed(near: np.ndarray, any_: np.ndarray, target: float, content: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Each query's cells, best chance first, until their chances sum to ``target`` or the share of all
    vectors expected in them to ``content``: their numbers, how many of them count, that share."""
    m = near.shape[1]
    cells, most = (2 * HALF) ** m, 64
    out, counts, held = [None] * len(near), np.zeros(len(near), int), np.zeros(len(near))
    left = np.arange(len(near))
    while len(left):
        if cells > ENUMERATE and most * 8 >= ENUMERATE:
            for i in left:
                got, held[i] = from_heap(near[i], any_, target, content)
                out[i], counts[i] = numbers(got), len(got)
            break
        most = cells if most * 8 >= cells else most
        again = []
        for at in np.array_split(left, -(-len(left) * most * 2 * HALF // AT_ONCE)):
            codes, p = best_cells(near[at], most)
            share = np.cumsum(chance_of(np.broadcast_to(any_, (len(at), *any_.shape)), codes), axis=1)
            n = ((np.cumsum(p, axis=1) < target) & (share < content)).sum(axis=1) + 1
            done = (n <= most) | (most == cells)
            n = np.minimum(n, codes.shape[1])
            for i in np.flatnonzero(done):
                out[at[i]], counts[at[i]], held[at[i]] = codes[i, :n[i]], n[i], share[i, n[i] - 1]
            again.append(at[~done])
        left, most = np.concatenate(again), most * 32
    width = max(counts, default=0)
    return (np.array([np.append(c, np.zeros(width - len(c), np.int64)) for c in out], np.int64).reshape(len(near), width),
            counts, held)


def least_chances(near: np.ndarray, any_: np.ndarray, targets: tuple[float, ...]) -> tuple[np.ndarray, np.ndarray]:
    """For each query and target the chance of the last cell visited until the chances sum to the target,
    and the share of all vectors expected in those visited."""
    m = near.shape[1]
    cells, most = (2 * HALF) ** m, 64
    last, held = np.zeros((len(near), len(targets))), np.ones((len(near), len(targets)))
    left = np.arange(len(near))
    everywhere = chance_of(any_[None], np.arange(cells)[None])[0] if cells <= ENUMERATE else None
    while len(left):
        if cells > ENUMERATE and most * 8 >= ENUMERATE:
            for i in left:
                for t, target in enumerate(targets):
                    got, held[i, t] = from_heap(near[i], any_, target, 1.0)
                    last[i, t] = chance_of(near[i][None], numbers(got[-1:])[None])[0, 0]
            break
        most = cells if most * 8 >= cells else most
        again = []
        for at in np.array_split(left, -(-len(left) * most * 2 * HALF // AT_ONCE)):
            if most == cells:
                p = np.ones((len(at), 1))
                for j in range(m):
                    p = (p[:, :, None] * near[at, j, None, :]).reshape(len(at), -1)
                ordered = np.sort(p, axis=1)[:, ::-1]
            else:
                codes, ordered = best_cells(near[at], most)
            total = np.cumsum(ordered, axis=1)
            n = np.stack([(total < target).sum(axis=1) for target in targets], axis=1)
            done = (n < most).all(axis=1) | (most == cells)
            n = np.minimum(n, most - 1)
            least = np.take_along_axis(ordered, n, 1)
            if most == cells:
                share = np.stack([(p >= least[:, t, None]) @ everywhere for t in range(len(targets))], axis=1)
            else:
                share = np.take_along_axis(np.cumsum(chance_of(np.broadcast_to(any_, (len(at), *any_.shape)), codes), axis=1), n, 1)
            last[at[done]], held[at[done]] = least[done], share[done]
            again.append(at[~done])
        left, most = np.concatenate(again), most * 32
    return last, held


def visits(q: np.ndarray, f: tuple[np.ndarray, np.ndarray], cosine: float, target: float, content: float = 1.0) -> tuple[np.ndarray, float]:
    """Cells for one query, best chance first, until their chances sum to ``target`` or the share of
    all vectors expected in them to ``content``; and that share.

    Along each direction a neighbour at ``cosine`` lies at ``N(cosine * q, 1 - cosine**2)``
    and any vector at ``N(0, 1)``, which gives a chance for each interval; a cell's chance
    is the product.
    """
    near, any_ = intervals(q, f, cosine)
    if (2 * HALF) ** len(near) > ENUMERATE:
        return from_heap(near, any_, target, content)
    codes, _, held = listed(near[None], any_, target, content)
    return digits(codes[0], len(near)) - HALF, float(held[0])


def from_heap(near: np.ndarray, any_: np.ndarray, target: float, content: float) -> tuple[np.ndarray, float]:
    """The same order without listing all cells: a cell's successors move one direction to its next best interval."""
    order = np.argsort(-near, axis=1, kind="stable")
    near, any_ = np.take_along_axis(near, order, 1), np.take_along_axis(any_, order, 1)
    first = (0,) * len(near)
    heap, pushed = [(-float(near[:, 0].prod()), first)], {first}
    each = np.arange(len(near))
    out, chance, held = [], 0.0, 0.0
    while heap and chance < target and held < content:
        c, at = heapq.heappop(heap)
        chance -= c
        held += float(any_[each, at].prod())
        out.append(order[each, at] - HALF)
        for j, i in enumerate(at):
            after = (*at[:j], i + 1, *at[j + 1:])
            if i + 1 < near.shape[1] and after not in pushed:
                pushed.add(after)
                heapq.heappush(heap, (c / near[j, i] * near[j, i + 1], after))
    return np.array(out), held


SHARED = 1 - (1 - TARGET) ** (1 / TABLES)  # of each table, that together they reach the target


def first_looks(q: np.ndarray, maps: list, rows: int, k: int) -> list[tuple[np.ndarray, np.ndarray] | None]:
    """Of each table the numbers of the cells of the first look and how many of them count; None: all cells."""
    if rows <= AT_LEAST * k:
        return [None] * TABLES
    share = min(1.0, AT_LEAST * k / rows / TABLES)
    return [listed(*intervals(q, f, np.full(len(q), NEAR)), SHARED, share)[:2] for f in maps]


def plans(q: np.ndarray, maps: list, rows: int, k: int, cosine: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """For each query and table the least chance of a cell visited (infinite: no cell), and the least chance at
    ``NEAR`` of those seen before: of the first look, or of the second once the k-th is known to be at ``cosine``."""
    least, seen = np.full((len(q), TABLES), np.inf), np.full((len(q), TABLES), np.inf)
    first = first_looks(q, maps, rows, k)
    if first[0] is None:  # all cells at once, nothing is left for a second look
        return (np.zeros_like(least) if cosine is None else least), seen
    missed = np.ones(len(q))
    for t, (codes, n) in enumerate(first):
        near, _ = intervals(q, maps[t], np.full(len(q), NEAR))
        seen[:, t] = np.take_along_axis(chance_of(near, codes), n[:, None] - 1, 1)[:, 0]
        if cosine is not None:
            at = chance_of(intervals(q, maps[t], cosine)[0], codes)
            missed *= 1 - np.minimum(1.0, (at * (np.arange(codes.shape[1]) < n[:, None])).sum(axis=1))
    if cosine is None:
        return seen, least
    more = np.flatnonzero(1 - missed < TARGET)
    if len(more):
        each = [least_chances(*intervals(q[more], f, cosine[more]), (SHARED, TARGET)) for f in maps]
        alone = np.stack([held[:, 1] for _, held in each], axis=1)
        best = alone.argmin(axis=1)
        one = alone.min(axis=1) < sum(held[:, 0] for _, held in each)
        for t, (last, _) in enumerate(each):
            least[more, t] = np.where(one, np.where(best == t, last[:, 1], np.inf), last[:, 0])
    return least, seen


def cells_of(q: np.ndarray, f: tuple[np.ndarray, np.ndarray], cosine: float, least: float, seen: float) -> np.ndarray:
    """The cells that a plan has one query visit."""
    here, _ = intervals(q[None], f, np.array([cosine]))
    before, _ = intervals(q[None], f, np.array([NEAR]))
    every = np.arange((2 * HALF) ** here.shape[1])
    at = digits(every, here.shape[1])
    return at[visited(at, logs(here), logs(before), np.array([least]), np.array([seen]))[:, 0]] - HALF


def first_look(q: np.ndarray, maps: list, rows: int, k: int) -> list[np.ndarray]:
    """Of each table the cells of one query's first look."""
    least, seen = plans(q[None], maps, rows, k)
    return [cells_of(q, f, NEAR, least[0, t], seen[0, t]) for t, f in enumerate(maps)]


def second_look(q: np.ndarray, maps: list, cosine: float, rows: int, k: int) -> list[np.ndarray]:
    """Of each table the cells that one query's second look adds, once the k-th is known to be at ``cosine``."""
    least, seen = plans(q[None], maps, rows, k, np.array([cosine]))
    return [cells_of(q, f, cosine, least[0, t], seen[0, t]) for t, f in enumerate(maps)]


def logs(near: np.ndarray) -> np.ndarray:
    """A row of logarithms for each query, direction after direction."""
    return np.log(near).reshape(len(near), -1)


def visited(at: np.ndarray, here: np.ndarray, before: np.ndarray, least: np.ndarray, seen: np.ndarray) -> np.ndarray:
    """Which cells (intervals from 0) which queries visit: those of at least the least chance, but for those seen."""
    pick = np.zeros((len(at), here.shape[1]))
    np.put_along_axis(pick, at + np.arange(at.shape[1]) * 2 * HALF, 1.0, 1)
    with np.errstate(divide="ignore"):
        out = pick @ here.T >= np.log(least) - SLACK
        if np.isfinite(seen).any():
            out &= pick @ before.T < np.log(seen) - SLACK
    return out


def regions_met(here: np.ndarray, least: np.ndarray, leading: int) -> np.ndarray:
    """Numbers of the regions (cells that share the ``leading`` directions) of which some query visits a cell."""
    each = here.reshape(len(here), -1, 2 * HALF)
    rest = each[:, leading:].max(axis=2).sum(axis=1)
    at = digits(np.arange((2 * HALF) ** leading), leading)
    pick = np.zeros((len(at), max(1, leading) * 2 * HALF))
    np.put_along_axis(pick, at + np.arange(leading) * 2 * HALF, 1.0, 1)
    met = np.zeros(len(at), bool)
    with np.errstate(divide="ignore"):
        bar = np.log(least) - SLACK - rest
    for i in np.array_split(np.arange(len(here)), -(-len(here) * len(at) // AT_ONCE)):
        met |= (pick @ here[i, :pick.shape[1]].T >= bar[i]).any(axis=1)
    return np.flatnonzero(met)


def best_of(k: int, query: np.ndarray, ids: np.ndarray, score: np.ndarray, repeated: bool = False) -> np.ndarray:
    """Positions of the ``k`` best distinct ids of each query, by score, then smaller id. ``repeated``: an id
    may have several scores."""
    if not len(query):
        return np.zeros(0, int)
    if repeated:
        each = np.lexsort((-score, ids, query))
        q, i = query[each], ids[each]
        each = each[np.append(True, (q[1:] != q[:-1]) | (i[1:] != i[:-1]))]
        return each[best_of(k, query[each], ids[each], score[each])]
    order = np.lexsort((ids, -score, query))
    q, i = query[order], ids[order]
    again = np.append(False, (q[1:] == q[:-1]) & (i[1:] == i[:-1]))  # equal ids score alike
    order, q = order[~again], q[~again]
    start = np.flatnonzero(np.append(True, q[1:] != q[:-1])) if len(q) else np.zeros(0, int)
    rank = np.arange(len(q)) - np.repeat(start, np.diff(np.append(start, len(q))))
    return order[rank < k]


def lifted(q: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Queries as unit vectors with the further component, and their norms."""
    norms = np.linalg.norm(q, axis=1)
    with np.errstate(all="ignore"):
        return np.column_stack([q / norms[:, None], np.zeros(len(q))]), norms


class Asked:
    """A block of queries that visit one table, and the best found for each so far."""

    def __init__(self, ids: np.ndarray, q: np.ndarray, plan: np.ndarray, f: tuple[np.ndarray, np.ndarray], longest: float, k: int, repeated: bool):
        self.k, self.repeated, self.ids, self.q = k, repeated, ids, q
        unit, norms = lifted(q)
        cosine, floor, self.least, self.seen = plan.T
        self.here, self.before = logs(intervals(unit, f, cosine)[0]), logs(intervals(unit, f, np.full(len(q), NEAR))[0])
        self.unit, self.scale = unit[:, :-1].astype(np.float32), norms * longest
        self.query, self.own = np.unique(ids, return_inverse=True)
        self.floor = np.full(len(self.query), -np.inf)
        np.maximum.at(self.floor, self.own, floor)
        # unit vectors rounded to single precision, multiplied and summed in any order
        self.error = (q.shape[1] + 8) * 2.0 ** -23
        self.held = [(np.zeros(0, np.int64), np.zeros(0, ids.dtype), np.zeros(0))]
        self.added, self.bar = 0, self.scaled_floor()

    def scaled_floor(self) -> np.ndarray:
        """What a product in single precision must reach; what isn't a number is passed on."""
        with np.errstate(all="ignore"):
            return (self.floor[self.own] / self.scale - self.error).astype(np.float32) - np.float32(1e-7)

    def meet(self, ids: np.ndarray, x: np.ndarray, unit: np.ndarray, codes: np.ndarray) -> None:
        """Vectors sorted by cell: each cell with the queries that visit it."""
        start = np.flatnonzero(np.append(True, codes[1:] != codes[:-1]))
        hits = visited(digits(codes[start], self.here.shape[1] // (2 * HALF)), self.here, self.before, self.least, self.seen)
        for n, (lo, hi) in enumerate(zip(start, np.append(start[1:], len(codes)), strict=True)):
            who = np.flatnonzero(hits[n])
            for i in range(0, len(who), step := max(1, AT_ONCE // 8 // (hi - lo))):
                self.cell(who[i:i + step], ids[lo:hi], x[lo:hi], unit[lo:hi])

    def cell(self, who: np.ndarray, ids: np.ndarray, x: np.ndarray, unit: np.ndarray) -> None:
        got = self.unit[who] @ unit.T
        bar = self.bar[who]
        if len(ids) > self.k + 1 and not self.repeated and np.isneginf(bar).any():  # the cell's own k-th, beside the query itself
            kth = np.partition(got, len(ids) - self.k - 1, axis=1)[:, len(ids) - self.k - 1]
            bar = np.fmax(bar, kth - np.float32(2 * self.error + 1e-6))
        r, c = np.divmod(np.flatnonzero(~(got < bar[:, None])), len(ids))
        r = who[r]
        other = self.ids[r] != ids[c]
        r, c = r[other], c[other]
        for i in range(0, len(r), AT_ONCE // 8):
            a, b = r[i:i + AT_ONCE // 8], c[i:i + AT_ONCE // 8]
            score = np.einsum("ij,ij->i", self.q[a], x[b].astype(np.float64))
            own = self.own[a]
            fits = ~(score < self.floor[own])
            self.held.append((own[fits], ids[b[fits]], score[fits]))
            self.added += int(fits.sum())
            if self.added > 100_000:
                self.prune()

    def prune(self) -> None:
        own, ids, score = (np.concatenate(x) for x in zip(*self.held, strict=True))
        top = best_of(self.k, own, ids, score, self.repeated)
        own, ids, score = own[top], ids[top], score[top]
        self.held, self.added = [(own, ids, score)], 0
        if len(own):
            end = np.flatnonzero(np.append(own[1:] != own[:-1], True))
            full = np.diff(np.append(-1, end)) == self.k
            self.floor[own[end[full]]] = np.fmax(self.floor[own[end[full]]], score[end[full]])
        self.bar = self.scaled_floor()

    def best(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        self.prune()
        own, ids, score = self.held[0]
        return self.query[own], ids, score


def packed(x: np.ndarray) -> pa.Array:
    """The rows of a matrix as binary values."""
    width = x.shape[1] * x.itemsize
    return pa.Array.from_buffers(pa.binary(), len(x), [None, pa.py_buffer(np.arange(0, (len(x) + 1) * width, max(width, 1), np.int32)[:len(x) + 1]), pa.py_buffer(np.ascontiguousarray(x).tobytes())])


def unpacked(column, kind) -> np.ndarray:
    """Binary values of one length as a matrix."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return np.frombuffer(b"".join(column.to_pylist()), kind).reshape(len(column), -1)


def plain(column) -> np.ndarray:
    return column.to_numpy(zero_copy_only=False) if isinstance(column, pa.Array) else column.to_numpy()


def nearest(table: DataFrame, is_query, key: str = "vec_id", vector: str = "embedding", k: int = 20) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: each query's ``k`` nearest found by inner product."""
    spark = table.sparkSession
    kind = table.schema[key].dataType.simpleString()
    single = table.schema[vector].dataType.simpleString() == "array<float>"
    number = np.float32 if single else np.float64
    rows = staged(valid_vectors(table, key, vector).withColumn("v", F.col("v").cast("array<float>" if single else "array<double>")), "vectors")
    norm = F.sqrt(F.aggregate("v", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double")))
    about = rows.agg(F.count(F.lit(1)).alias("n"), F.max(norm).alias("norm"), F.max(F.size("v")).alias("dim")).first()
    n, longest, dim = about["n"] or 0, about["norm"] or 1.0, about["dim"] or 1
    repeated = not rows.groupBy("id").count().where("count > 1").limit(1).isEmpty()
    m = max(1, round(float(np.log2(max(n, 2) / PER_CELL)) / 1.8))
    maps = functions_of(dim + 1, m)
    tasks, cores = int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism
    fit = max(1, BLOCK_BYTES // (dim * number().itemsize))
    per_block = int(min(np.clip(n // tasks, 512, PER_BLOCK), fit))

    def leading(rows: int, per: int) -> int:
        """So many directions that a region holds about ``per`` rows or more."""
        return int(np.clip(np.log2(max(rows, 1) / per) / 2, 0, m))

    queries = staged(rows.where(is_query(F.col("id"))), "queries")
    asking = queries.count()
    if not asking:
        return spark.createDataFrame([], f"query_id {kind}, rank int, vec_id {kind}, score double")
    per_query = int(min(np.clip(-(-asking // cores), 64, PER_QUERIES), fit))
    shallow = leading(asking, per_query)
    wide = (2 * HALF) ** shallow
    deep = leading(n, per_block)
    per_region = (2 * HALF) ** (m - deep)
    all_regions = (2 * HALF) ** deep

    def vectors(column) -> np.ndarray:
        return column.flatten().to_numpy().reshape(len(column), dim)

    def indexed(t: int, whole: bool = True) -> DataFrame:
        """The rows by their cells of a table; else the regions alone."""
        def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                if not len(b):
                    continue
                raw = vectors(b.column("v"))
                x = raw / longest
                x = np.column_stack([x, np.sqrt(np.maximum(0.0, 1 - (x * x).sum(axis=1)))])
                cell = numbers(place(x, maps[t]))
                out = {"region": t * all_regions + cell // per_region}
                yield pa.RecordBatch.from_pydict(out | {"cell": cell, "id": b.column("id"), "v": packed(raw)} if whole else out)

        return rows.mapInArrow(index, "region long" + f", cell long, id {kind}, v binary" * whole)

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A row for each query and table that it visits: in the first look; in the second where a batch has the
        k-th score found (null: fewer than k)."""
        for b in batches:
            if not len(b):
                continue
            raw = vectors(b.column("v"))
            q, norms = lifted(raw.astype(np.float64))
            floor, cosine = np.full(len(q), -np.inf), None
            if "kth" in b.schema.names:
                kth = plain(b.column("kth").cast(pa.float64()).fill_null(float("nan")))
                with np.errstate(all="ignore"):
                    cosine = np.nan_to_num(np.clip(kth / norms / longest, -0.98, 0.98))
                floor = np.where(np.isnan(kth), -np.inf, kth)
            least, seen = plans(q, maps, n, k, cosine)
            for t, f in enumerate(maps):
                at = np.flatnonzero(least[:, t] < np.inf)
                if len(at):
                    plan = np.column_stack([np.full(len(at), NEAR) if cosine is None else cosine[at], floor[at], least[at, t], seen[at, t]])
                    yield pa.RecordBatch.from_pydict({
                        "region": t * wide + numbers(place(q[at], f)) // (2 * HALF) ** (m - shallow), "id": b.column("id").take(pa.array(at)),
                        "v": packed(raw[at]), "plan": packed(plan)})

    def blocks(df: DataFrame, regions: DataFrame, per: int, most: int, pack, to: str) -> DataFrame:
        """Rows of a region packed into blocks of about ``per``: dealt by hash into as many as its size asks for."""
        size = staged(regions.groupBy("region").agg(F.ceil(F.count(F.lit(1)) / per).alias("parts")), "sizes")
        # a bounded block: about ``per`` rows
        return (df.join(size, "region").withColumn("part", F.pmod(F.xxhash64("id", "v"), F.col("parts"))).drop("parts")
                .repartition(most, "region", "part").groupBy("region", "part").applyInArrow(pack, to))

    def pack_stored(group: pa.Table) -> pa.Table:
        codes, ids, x = plain(group.column("cell")), plain(group.column("id")), unpacked(group.column("v"), number)
        order = np.lexsort((ids, x.astype(np.float64).sum(axis=1), codes))
        if not repeated:  # equal vectors score alike, so of a run of them no query ranks more than the k + 1 smallest ids
            new = np.append(True, (codes[order][1:] != codes[order][:-1]) | (x[order][1:] != x[order][:-1]).any(axis=1))
            start = np.flatnonzero(new)
            order = order[np.arange(len(order)) - np.repeat(start, np.diff(np.append(start, len(order)))) <= k]
        return pa.table({"region": group.column("region").slice(0, 1), "xi": pa.array([ids[order]]), "xv": [x[order].tobytes()], "cells": [codes[order].tobytes()]})

    def pack_queries(group: pa.Table) -> pa.Table:
        q, plan = unpacked(group.column("v"), number), unpacked(group.column("plan"), np.float64)
        region, part = group.column("region")[0].as_py(), group.column("part")[0].as_py()
        t = region // wide
        here = logs(intervals(lifted(q.astype(np.float64))[0], maps[t], plan[:, 0])[0])
        met = regions_met(here, plan[:, 2], deep) + t * all_regions
        return pa.table({"block": [region << 32 | part], "t": pa.array([t], pa.int32()), "meets": pa.array([met], pa.list_(pa.int64())),
                         "qi": pa.array([plain(group.column("id"))]), "qv": [q.tobytes()], "plan": [plan.tobytes()]})

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        met: dict[int, Asked] = {}
        for b in batches:
            for i in range(len(b)):
                at = {name: b.column(name)[i] for name in b.schema.names}
                block = at["block"].as_py()
                if block not in met:
                    met[block] = Asked(plain(at["qi"].values), np.frombuffer(at["qv"].as_buffer(), number).reshape(-1, dim).astype(np.float64),
                                       np.frombuffer(at["plan"].as_buffer(), np.float64).reshape(-1, 4), maps[at["t"].as_py()], longest, k, repeated)
                x = np.frombuffer(at["xv"].as_buffer(), number).reshape(-1, dim)
                met[block].meet(plain(at["xi"].values), x, (x / longest).astype(np.float32), np.frombuffer(at["cells"].as_buffer(), np.int64))
            b = at = x = None  # before the next batch comes
        for asked in met.values():
            query, ids, found = asked.best()
            yield pa.RecordBatch.from_pydict({"query_id": query, "vec_id": ids, "score": found})

    def searched(asked: DataFrame) -> DataFrame:
        asks = staged(blocks(asked, asked, per_query, min(tasks, max(cores, -(-asking * TABLES * 2 // per_query))), pack_queries,
                             f"block long, meets array<long>, qi array<{kind}>, qv binary, plan binary, t int"), "asks", ("t",), plain=True)
        found, at_least = [], int(np.clip(n * asking >> 29, cores, 8 * cores))
        for t, many in sorted(asks.groupBy("t").count().collect()):
            # a task is a block of queries and a part of the table's stored blocks, which it reads where they lie
            parts = int(np.clip(-(-at_least // many), -(-stored_blocks[t] // 512), stored_blocks[t]))
            pairs = (stored[t].coalesce(parts)
                     .join(asks.where(F.col("t") == t).repartition(many).hint("shuffle_replicate_nl"), F.array_contains("meets", F.col("region"))))
            found.append(pairs.select("t", "block", "qi", "qv", "plan", "xi", "xv", "cells")
                         .mapInArrow(score, f"query_id {kind}, vec_id {kind}, score double"))
        return reduce(DataFrame.unionByName, found)

    def best(found: DataFrame) -> DataFrame:
        each = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
        w = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
        return (each.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)
                .select("query_id", "rank", "vec_id", "score"))

    # tasks that have blocks, each for a file of 32 MB at most
    files = max(min(tasks, max(cores, -(-n * 2 // per_block))), -(-n * dim * number().itemsize // 2 ** 25))
    stored = []  # of each table, read by both looks
    for t in range(TABLES):
        stored.append(staged(blocks(indexed(t), indexed(t, False), per_block, files, pack_stored,
                                    f"region long, xi array<{kind}>, xv binary, cells binary"), "blocks", plain=True))
        released(spark)
    discarded(rows)
    stored_blocks = [of_t.count() for of_t in stored]
    # planning a query's cells is work of its own: a number of tasks that AQE does not merge by bytes
    spread = min(tasks, max(cores, -(-asking // 256)))
    queries = queries.repartition(spread, "id")
    of_ask = f"region long, id {kind}, v binary, plan binary"
    with setting(spark, "spark.sql.execution.arrow.maxBytesPerBatch", "8m"):  # a few blocks; rows are as long as blocks
        first = staged(best(searched(staged(queries.mapInArrow(ask, of_ask), "asked"))), "first")
        kth = staged(first.where(F.col("rank") == k).select(F.col("query_id").alias("id"), F.col("score").alias("kth")), "kth")
        known = queries.join(kth, "id", "left").repartition(spread, "id")
        more = staged(known.mapInArrow(ask, of_ask), "asked")
        if more.isEmpty():
            return first
        return staged(best(first.select("query_id", "vec_id", "score").unionByName(searched(more))), "nearest")
