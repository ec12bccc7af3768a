"""Embedding near-duplicates by lattice hashing.

Unit vectors are projected by ``TABLES`` random orthonormal maps to ``8 * BLOCKS``
dimensions, scaled by ``SCALE`` and decoded, eight coordinates at a time, to the nearest
point of the E8 lattice. A vector's home cell in a table is its lattice points; it also
visits the ``PROBES`` cells nearest to it that change one or more of its points to one
of the 240 neighbouring lattice points. Vectors meet when one visits the other's home;
meetings are verified by cosine in double precision.

Identical vectors are one class (partially aggregated) and stand for all their copies.
A task gives, for every vector it has linked, the smallest id that it is connected to there: one
row a vector, and the same row from all tasks that see its group, and
cells over ``BLOCK`` members are dealt out as pairs of blocks, so neither all pairs of a
group nor a whole hot cell are ever in one task. All links lie inside components: the
link counts then come from blocks of each component against each other, counted per
vector without a row per pair; a component's blocks grow with it, so that a vector is sent to
``WIDE`` tasks at most (to more only beyond half a million different vectors in a component).

A pair at cosine 0.95 meets in one table with probability about 0.69, so it is missed
with less than 1e-3, one at 0.97 with less than 1e-5 (a link is also found by any path).
``BLOCKS`` sets how selective a cell is: two hold about one of a million random vectors.

Vectors that are null, zero, of odd length or hold null or non-finite components link with
nothing: each is its own component. A row with a null id has a null component and is
kept. Rows that repeat an id are one node with the links of all its vectors (its count
then counts a vector once per own vector). An empty table gives an empty result.
"""

from __future__ import annotations

import heapq
import itertools
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._shingles import mixed
from ._util import components, staged
from ._vectors import matrix, valid_vectors

TABLES, BLOCKS, SCALE, PROBES = 6, 2, 5.0, 24
NEAREST = 12  # neighbours of each lattice point that probing combines
BLOCK, WIDE, MOST_IN_BLOCK, SLAB = 256, 64, 8192, 512
U = np.uint64


def neighbours() -> np.ndarray:
    """The 240 shortest vectors of E8: two entries of +-1, or eight of +-1/2 with an even number of minuses."""
    out = []
    for i, j in itertools.combinations(range(8), 2):
        for a, b in itertools.product((1.0, -1.0), repeat=2):
            v = [0.0] * 8
            v[i], v[j] = a, b
            out.append(v)
    out += [list(s) for s in itertools.product((0.5, -0.5), repeat=8) if sum(x < 0 for x in s) % 2 == 0]
    return np.array(out)


STEPS = np.concatenate([np.zeros((1, 8)), neighbours()])


def nearest_even(y: np.ndarray) -> np.ndarray:
    """The nearest integer points with an even sum: round, and where the sum is odd move the
    coordinate that was rounded furthest to its other side."""
    r = np.rint(y)
    d = y - r
    odd = np.flatnonzero(r.sum(axis=1) % 2 != 0)
    k = np.abs(d[odd]).argmax(axis=1)
    r[odd, k] += np.where(d[odd, k] >= 0, 1.0, -1.0)
    return r


def decode(y: np.ndarray) -> np.ndarray:
    """The nearest E8 point of each row: the better of the even points and their half-shifted copy."""
    a, b = nearest_even(y), nearest_even(y - 0.5) + 0.5
    closer = ((y - a) ** 2).sum(axis=1) <= ((y - b) ** 2).sum(axis=1)
    return np.where(closer[:, None], a, b)


def projections(dim: int, seed: int = 8) -> list[np.ndarray]:
    """For each table a random orthonormal map to ``8 * BLOCKS`` dimensions (fewer than that: zero-padded)."""
    rng = np.random.default_rng(seed)
    out = []
    for _ in range(TABLES):
        q, _ = np.linalg.qr(rng.normal(size=(dim, min(dim, 8 * BLOCKS))))
        out.append(np.pad(q, ((0, 0), (0, 8 * BLOCKS - q.shape[1]))) * SCALE * np.sqrt(dim / 64))
    return out


def cell_key(points: np.ndarray, table: int) -> np.ndarray:
    """A 64-bit key of lattice points ``(..., 8 * BLOCKS)``."""
    key = np.full(points.shape[:-1], U((table + 1) * 0x9E3779B97F4A7C15 % 2 ** 64))
    for k in range(points.shape[-1]):
        key = mixed(key ^ ((points[..., k] * 2).astype(np.int64).view(U) + U(k << 40)))
    return key.view(np.int64)


def combinations(width: int, choices: int, most: int) -> list[tuple[int, ...]]:
    """Index tuples that can be among the ``most`` smallest sums of ``width`` ascending lists:
    those with at most ``most`` tuples below or at them."""
    out = []
    for t in itertools.product(range(choices), repeat=width):
        if np.prod([i + 1 for i in t]) <= most + 1:
            out.append(t)
    return out


def cells(unit: np.ndarray, maps: list[np.ndarray]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each table, the home key of every row and its ``PROBES`` visited keys, nearest first."""
    n = len(unit)
    combos = np.array(combinations(BLOCKS, NEAREST, PROBES))
    for table, m in enumerate(maps):
        y = (unit @ m).reshape(n * BLOCKS, 8)
        home = decode(y)
        off = y - home
        # |off - step|^2 without the constant |off|^2
        far = (STEPS ** 2).sum(axis=1) - 2 * off @ STEPS.T
        best = np.argpartition(far, NEAREST, axis=1)[:, :NEAREST]
        cost = np.take_along_axis(far, best, 1)
        order = np.argsort(cost, axis=1, kind="stable")
        best, cost = np.take_along_axis(best, order, 1), np.take_along_axis(cost, order, 1)
        points = (home[:, None] + STEPS[best]).reshape(n, BLOCKS, NEAREST, 8)
        cost = cost.reshape(n, BLOCKS, NEAREST)
        total = sum(cost[:, b][:, combos[:, b]] for b in range(BLOCKS))
        pick = np.argsort(total, axis=1, kind="stable")[:, 1:PROBES + 1]  # the first is the home itself
        chosen = combos[pick]
        rows = np.arange(n)[:, None]
        visited = np.concatenate([points[rows, b, chosen[:, :, b]] for b in range(BLOCKS)], axis=2)
        yield cell_key(home.reshape(n, 8 * BLOCKS), table), cell_key(visited, table)


def meet(rows: DataFrame, kind: str) -> DataFrame:
    """``(cell, id, home)``: every class's home cells and the cells it visits."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        maps = None
        for b in batches:
            for at in range(0, len(b), 1000):
                part = b.iloc[at:at + 1000]
                v = matrix(part["v"])
                maps = maps or projections(v.shape[1])
                for home, visited in cells(v / np.linalg.norm(v, axis=1, keepdims=True), maps):
                    yield pd.DataFrame({
                        "cell": np.concatenate([home, visited.reshape(-1)]),
                        "id": np.concatenate([part["id"], np.repeat(part["id"].to_numpy(), PROBES)]),
                        "home": np.arange(len(part) * (PROBES + 1)) < len(part)})

    return rows.select("id", "v").mapInPandas(run, f"cell long, id {kind}, home boolean")


def links_in(least: float):
    """mapInPandas over rows sorted by (cell, lo, hi): of every vector that a task has linked, the smallest
    id it is connected to there. Tasks that see the same group name the same id, so that their links are equal."""

    def top(up: dict, x):
        while up.setdefault(x, x) != x:
            up[x] = up[up[x]]
            x = up[x]
        return x

    def verify(g: pd.DataFrame, up: dict) -> None:
        start = np.flatnonzero(np.append(True, (g["cell"].to_numpy()[1:] != g["cell"].to_numpy()[:-1])
                                         | (g["lo"].to_numpy()[1:] != g["lo"].to_numpy()[:-1])
                                         | (g["hi"].to_numpy()[1:] != g["hi"].to_numpy()[:-1])))
        size = np.diff(np.append(start, len(g)))
        group = np.repeat(np.arange(len(start)), size)
        home, block = g["home"].to_numpy(), g["block"].to_numpy()
        cross = (g["lo"] != g["hi"]).to_numpy()
        first = np.flatnonzero(home)  # every home against every member of its group
        a = np.repeat(first, size[group[first]])
        b = start[group[a]] + np.arange(len(a)) - np.repeat(np.cumsum(size[group[first]]) - size[group[first]], size[group[first]])
        ids = g["id"].to_numpy()
        keep = (ids[a] != ids[b]) & (~home[b] | (a < b)) & (~cross[a] | (block[a] != block[b]))
        a, b = a[keep], b[keep]
        v = matrix(g["v"])
        v /= np.linalg.norm(v, axis=1, keepdims=True)
        for at in range(0, len(a), 100_000):
            x, y = a[at:at + 100_000], b[at:at + 100_000]
            near = np.einsum("ij,ij->i", v[x], v[y]) >= least
            for i, j in zip(ids[x[near]].tolist(), ids[y[near]].tolist(), strict=True):
                p, q = top(up, i), top(up, j)
                if p != q:
                    up[max(p, q)] = min(p, q)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        tail, up = None, {}
        for b in batches:
            b = pd.concat([tail, b]) if tail is not None else b
            if not len(b):
                continue
            end = b[["cell", "lo", "hi"]].iloc[-1]
            last = ((b["cell"] == end["cell"]) & (b["lo"] == end["lo"]) & (b["hi"] == end["hi"])).to_numpy()
            tail = b[last]
            if not last.all():
                verify(b[~last], up)
        if tail is not None and len(tail):
            verify(tail, up)
        links = [(x, r) for x in list(up) if (r := top(up, x)) != x]
        for at in range(0, len(links), 100_000):
            yield pd.DataFrame(links[at:at + 100_000], columns=["a", "b"])

    return run


def degrees(members: DataFrame, kind: str, least: float) -> DataFrame:
    """``(id, n)``: for every class of ``(component, id, v, copies, size)`` the vectors of other classes it links to."""
    # a vector goes to as many tasks as its component has blocks: WIDE of them, more only beyond MOST_IN_BLOCK
    per = F.least(F.greatest(F.ceil(F.col("size") / WIDE), F.lit(BLOCK)), F.lit(MOST_IN_BLOCK))
    blocks = F.ceil(F.col("size") / per).cast("int")
    dealt = (members.withColumn("block", F.pmod(F.xxhash64("id"), blocks).cast("int"))
             .withColumn("with", F.explode(F.sequence(F.lit(0), blocks - 1)))
             .select("component", F.least("block", "with").alias("lo"), F.greatest("block", "with").alias("hi"),
                     "block", "id", "v", "copies"))

    def count(g: pd.DataFrame) -> pd.DataFrame:
        v = matrix(g["v"])
        v /= np.linalg.norm(v, axis=1, keepdims=True)
        ids, block, copies = g["id"].to_numpy(), g["block"].to_numpy(), g["copies"].to_numpy()
        cross = g["lo"].iloc[0] != g["hi"].iloc[0]
        n = np.zeros(len(g), np.int64)
        for at in range(0, len(g), SLAB):
            part = slice(at, at + SLAB)
            cosine = v[part] @ v.T
            near = cosine >= least - 1e-12
            for i, j in np.argwhere(near & (cosine < least + 1e-12)):  # as the links were verified
                near[i, j] = np.einsum("i,i->", v[at + i], v[j]) >= least
            near &= ids[part, None] != ids[None, :]
            if cross:
                near &= block[part, None] != block[None, :]
            n[part] = near @ copies
        return pd.DataFrame({"id": ids, "n": n})

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        tail = None
        for b in batches:
            b = pd.concat([tail, b]) if tail is not None else b
            if not len(b):
                continue
            parts = [g for _, g in b.groupby(["component", "lo", "hi"], sort=False)]
            tail = parts.pop()
            if parts:
                yield pd.concat([count(g) for g in parts])
        if tail is not None and len(tail):
            yield count(tail)

    return (dealt.repartition("component", "lo", "hi").sortWithinPartitions("component", "lo", "hi")
            .mapInPandas(run, f"id {kind}, n long").groupBy("id").agg(F.sum("n").alias("n")))


def near_vectors(table: DataFrame, key: str = "vec_id", vector: str = "embedding", least: float = 0.95) -> DataFrame:
    """``(key, n_links, component_id, kept)`` for every row of ``table``."""
    kind = table.schema[key].dataType.simpleString()
    rows = valid_vectors(table, key, vector)
    classes = staged(rows.groupBy("v").agg(F.min("id").alias("id"), F.count(F.lit(1)).alias("copies")), "classes")
    seen = staged(meet(classes, kind), "cells")
    # written before it is joined, so that AQE may split a hot cell
    busy = staged(seen.groupBy("cell").agg(F.count(F.lit(1)).alias("size"), F.max("home").alias("any"))
                  .where(F.col("any") & (F.col("size") > 1)).select("cell", "size"), "busy")
    blocks = F.ceil(F.col("size") / BLOCK).cast("int")
    dealt = (seen.join(busy, "cell").withColumn("block", F.pmod(F.xxhash64("id"), blocks).cast("int"))
             .withColumn("with", F.explode(F.sequence(F.lit(0), blocks - 1)))
             .select("cell", F.least("block", "with").alias("lo"), F.greatest("block", "with").alias("hi"),
                     "block", "id", "home"))
    found = (dealt.join(classes.select("id", "v"), "id").repartition("cell", "lo", "hi")
             .sortWithinPartitions("cell", "lo", "hi").mapInPandas(links_in(least), f"a {kind}, b {kind}"))
    comp = components(staged(found.distinct(), "links"))
    named = classes.join(comp.withColumnRenamed("node", "id"), "id")
    sizes = named.groupBy("component").agg(F.count(F.lit(1)).alias("size"))
    linked = degrees(named.join(sizes, "component"), kind, least)
    of = (classes.select("v", F.col("id").alias("rep"), "copies")
          .join(comp.withColumnRenamed("node", "rep"), "rep", "left")
          .join(linked.withColumnRenamed("id", "rep"), "rep", "left"))
    per_row = (rows.join(of, "v").select("id", (F.col("copies") - 1 + F.coalesce("n", F.lit(0))).alias("n"),
                                         F.coalesce("component", "rep").alias("component")))
    each = per_row.groupBy("id").agg(F.sum("n").alias("n"), F.min("component").alias("component"))
    return (table.select(F.col(key).alias("id")).join(each, "id", "left")
            .select(F.col("id").alias(key), F.coalesce("n", F.lit(0)).alias("n_links"),
                    F.coalesce("component", "id").alias("component_id"))
            .withColumn("kept", F.coalesce(F.col("component_id") == F.col(key), F.lit(True))))
