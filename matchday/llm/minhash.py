"""MinHash near-duplicates with b-bit signatures, exact links and their components.

1. One scan hashes each document's distinct word shingles. ``PERMS`` minima give
   ``BANDS`` band keys (``ROWS`` full minima each); of every minimum only the low
   ``BITS`` bits are kept, packed in 64-bit words. Equal sets meet by a digest and are
   represented by their smallest id from here on.
2. Documents that share a band key are candidates. Each is compared with the bucket's
   smallest id. The packed signatures give the similarity by counting equal b-bit
   cells, corrected for cells that agree by chance (``1 / 2**BITS``); pairs whose
   estimate is ``MARGIN`` below the threshold go, the rest is confirmed on the full sets.
3. Pairs inside a component need no look. Buckets that still hold several components
   have their cross pairs estimated and confirmed in the tasks, each pair in its first
   common band, giving only links that join components. Buckets over ``BLOCK``
   documents are cut into blocks and dealt out as pairs of blocks, so no task holds a
   whole hot bucket and no pair of it is left out.

A pair at the threshold misses all bands with probability
``(1 - 0.8**ROWS)**BANDS`` = 3e-6 and the estimate's margin with less than 1e-6.
Full sets are only built for documents that share a band key.

Cases: a null or empty text, or one without words, has an empty set and no links; with
fewer words than a shingle the whole sequence is one shingle. Rows that repeat an id
are judged by their own texts and are one node of the graph. A row with a null id
links with nothing: its component is null and it is kept. Other columns are not read.
An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ._shingles import mixed, shingle_sets
from ._util import components, staged

PERMS, ROWS, BITS = 96, 4, 4
BANDS = PERMS // ROWS
PACK = PERMS * BITS // 64
MARGIN = 0.22
BLOCK = 1024
U = np.uint64
_RNG = np.random.default_rng(96)
MUL = _RNG.integers(1, 2 ** 32, PERMS, dtype=np.uint32) | np.uint32(1)
ADD = _RNG.integers(0, 2 ** 32, PERMS, dtype=np.uint32)


def minima(hashes: np.ndarray, rows: int = 4096) -> np.ndarray:
    """The minimum of each permutation over a set of 64-bit hashes."""
    x = (hashes >> U(32)).astype(np.uint32)
    low = np.full(PERMS, np.uint32(0xFFFFFFFF))
    for at in range(0, len(x), rows):
        np.minimum(low, (x[at:at + rows, None] * MUL + ADD).min(axis=0), out=low)
    return low


def band_keys(low: np.ndarray) -> np.ndarray:
    """One 64-bit key per band from minima ``(n, PERMS)``; different bands never share keys by design."""
    m = low.astype(U).reshape(len(low), BANDS, ROWS)
    key = np.broadcast_to(np.arange(1, BANDS + 1, dtype=U) * U(0x9E3779B97F4A7C15), m.shape[:2]).copy()
    for k in range(ROWS):
        key = mixed(key ^ (m[:, :, k] + U(k << 32)))
    return key.view(np.int64)


def packed(low: np.ndarray) -> np.ndarray:
    """The low ``BITS`` bits of each minimum, 16 to a 64-bit word."""
    cell = (low.astype(U) & U(2 ** BITS - 1)).reshape(len(low), PACK, 64 // BITS)
    return (cell << (np.arange(64 // BITS, dtype=U) * U(BITS))).sum(axis=2, dtype=U).view(np.int64)


def scan(docs: DataFrame, key: str, text: str, width: int, sets: bool = False) -> DataFrame:
    """``(id, n, digest, bands, sig[, hashes])`` of every row; ``sets`` adds the full set."""
    kind = docs.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids, texts = b.column(0), b.column(1).to_pylist()
            at, n, digests, low, full, held = 0, [], [], [], [], 0

            def flush(hi: int) -> pa.RecordBatch:
                m = np.array(low, np.uint32).reshape(hi - at, PERMS)
                cols = [ids.slice(at, hi - at), pa.array(n, pa.int64()), pa.array(digests, pa.binary()),
                        lists(band_keys(m)), lists(packed(m))]
                if sets:
                    ends = np.cumsum([0] + [len(f) for f in full]).astype(np.int32)
                    flat = np.concatenate(full) if full else np.zeros(0, U)
                    cols.append(pa.ListArray.from_arrays(pa.array(ends), pa.array(flat.view(np.int64))))
                names = ["id", "n", "digest", "bands", "sig"] + ["hashes"] * sets
                return pa.RecordBatch.from_arrays(cols, names=names)

            for i, h in enumerate(shingle_sets(texts, width)):
                n.append(len(h))
                digests.append(hashlib.blake2b(h.tobytes(), digest_size=16).digest())
                low.append(minima(h))
                if sets:
                    full.append(h)
                held += len(h) if sets else 1
                if held >= 1_000_000:
                    yield flush(i + 1)
                    at, n, digests, low, full, held = i + 1, [], [], [], [], 0
            if n:
                yield flush(at + len(n))

    schema = f"id {kind}, n long, digest binary, bands array<long>, sig array<long>" + ", hashes array<long>" * sets
    return docs.select(F.col(key).alias("id"), F.col(text).alias("text")).mapInArrow(run, schema)


def lists(rows: np.ndarray) -> pa.ListArray:
    ends = np.arange(len(rows) + 1, dtype=np.int32) * np.int32(rows.shape[1])
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(rows.reshape(-1)))


def estimate(a: str, b: str) -> Column:
    """Similarity from two packed signatures: the share of equal cells, less what agrees by chance."""
    low = "CAST(1229782938247303441 AS BIGINT)"  # the lowest bit of each 4-bit cell
    unequal = " + ".join(
        f"bit_count((x | shiftrightunsigned(x, 1) | shiftrightunsigned(x, 2) | shiftrightunsigned(x, 3)) & {low})"
        .replace("x", f"({a}[{i}] ^ {b}[{i}])") for i in range(PACK))
    chance = 1 / 2 ** BITS
    return (F.lit(1.0) - F.expr(f"({unequal})") / float(PERMS) - chance) / (1 - chance)


def similar(inter: Column, a: Column, b: Column, percent: int) -> Column:
    return inter * 100 >= (a + b - inter) * percent


def cross_links(percent: int):
    """mapInPandas function over rows sorted by group: links that join different components."""
    floor = percent / 100 - MARGIN

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[pd.DataFrame] = []
        last = None
        for b in batches:
            if not len(b):
                continue
            group = list(zip(b["bucket"], b["lo"], b["hi"], strict=True))
            cuts = [0] + [i for i in range(1, len(b)) if group[i] != group[i - 1]] + [len(b)]
            for x, y in zip(cuts, cuts[1:], strict=False):
                if last is not None and group[x] != last and held:
                    yield joined(pd.concat(held), floor, percent)
                    held = []
                held.append(b.iloc[x:y])
                last = group[x]
        if held:
            yield joined(pd.concat(held), floor, percent)

    return run


def joined(g: pd.DataFrame, floor: float, percent: int) -> pd.DataFrame:
    """Links between the components of one group (a bucket, or two blocks of one)."""
    label, own = np.unique(g["component"].to_numpy(), return_inverse=True)
    band = int(g["band"].iloc[0])
    keys = np.stack(g["bands"].to_list())
    sig = np.stack(g["sig"].to_list()).view(U)
    sets = [h.view(U) for h in g["hashes"].to_numpy()]
    n = np.array([len(s) for s in sets])
    block = g["block"].to_numpy()
    two = g["lo"].iloc[0] != g["hi"].iloc[0]
    up = np.arange(len(label))

    def top(x: int) -> int:
        while up[x] != x:
            up[x] = up[up[x]]
            x = up[x]
        return x

    most = np.bincount(own).argmax()
    few = np.flatnonzero(own != most)
    rank = np.full(len(g), len(g))
    rank[few] = np.arange(len(few))
    cell = U(0x1111111111111111)
    links = []
    for r, x in enumerate(few):
        roots = np.array([top(i) for i in range(len(label))])[own]
        see = (rank > r) & (roots != roots[x]) & (n * 100 >= n[x] * percent) & (n[x] * 100 >= n * percent)
        if two:
            see &= block != block[x]
        y = np.flatnonzero(see)
        y = y[(keys[y] == keys[x]).argmax(axis=1) == band]  # each pair once: in its first common band
        if not len(y):
            continue
        d = sig[y] ^ sig[x]
        d = (d | d >> U(1) | d >> U(2) | d >> U(3)) & cell
        chance = 1 / 2 ** BITS
        like = (1 - np.bitwise_count(d).sum(axis=1) / PERMS - chance) / (1 - chance)
        y = y[like >= floor]
        for i in y[np.argsort(-like[like >= floor], kind="stable")]:
            if top(own[i]) == top(own[x]):
                continue
            both = len(np.intersect1d(sets[x], sets[i], assume_unique=True))
            if both * 100 >= (n[x] + n[i] - both) * percent:
                links.append((label[own[x]], label[own[i]]))
                up[top(own[x])] = top(own[i])
    return pd.DataFrame(links, columns=["a", "b"], dtype=g["component"].dtype)


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", width: int = 5,
                    percent: int = 80) -> DataFrame:
    """``(key, n_shingles, component_id, kept)`` for every row; documents link when
    ``100 * |A & B| >= percent * |A | B|`` over their ``width``-word shingles."""
    kind = docs.schema[key].dataType.simpleString()
    seen = staged(scan(docs, key, text, width), "scan")
    # aggregates are written before they are joined, so that AQE may split a hot digest or bucket
    classes = staged(seen.where((F.col("n") > 0) & F.col("id").isNotNull())
                     .groupBy("digest").agg(F.min("id").alias("rep")), "digests")
    rep = F.when(F.col("id").isNotNull(), F.col("rep")).alias("rep")  # a row without an id joins nothing
    known = staged(seen.join(classes, "digest", "left").select("id", "n", rep, F.when(
        F.col("id") == F.col("rep"), F.col("bands")).alias("bands")), "classes")
    bands = (known.where(F.col("bands").isNotNull()).select("id", F.posexplode("bands").alias("band", "bucket")))
    shared = staged(bands.groupBy("bucket").agg(F.count(F.lit(1)).alias("size"), F.min("id").alias("pivot"),
                                                F.max("id").alias("top"))
                    .where(F.col("pivot") != F.col("top")).drop("top"), "shared")
    rows = staged(bands.join(shared, "bucket"), "buckets")

    wanted = rows.select(F.col("id").alias(key)).distinct()
    sets = staged(scan(docs.select(key, text).join(wanted, key, "left_semi"), key, text, width, sets=True), "sets")
    pairs = rows.where(F.col("id") != F.col("pivot")).select("id", "pivot").distinct()
    left = sets.select("id", F.col("n").alias("n1"), F.col("sig").alias("s1"), F.col("hashes").alias("h1"))
    right = sets.select(F.col("id").alias("pivot"), F.col("n").alias("n2"), F.col("sig").alias("s2"),
                        F.col("hashes").alias("h2"))
    both = F.size(F.array_intersect("h1", "h2"))
    near = (pairs.join(left, "id").join(right, "pivot")
            .where((F.col("n1") * 100 >= F.col("n2") * percent) & (F.col("n2") * 100 >= F.col("n1") * percent))
            .where(estimate("s1", "s2") >= percent / 100 - MARGIN)
            .where(similar(both, F.col("n1"), F.col("n2"), percent)))
    first = components(staged(near.select(F.col("id").alias("a"), F.col("pivot").alias("b")), "stars"))

    named = (rows.join(first.withColumnRenamed("node", "id"), "id", "left")
             .withColumn("component", F.coalesce("component", "id")))
    split = (named.groupBy("bucket").agg(F.min("component").alias("c0"), F.max("component").alias("c1"))
             .where(F.col("c0") != F.col("c1")).select("bucket"))
    blocks = F.ceil(F.col("size") / BLOCK).cast("int")
    dealt = (named.join(split, "bucket")
             .withColumn("block", F.pmod(F.xxhash64("id"), blocks).cast("int"))
             .withColumn("with", F.explode(F.sequence(F.lit(0), blocks - 1)))
             .select("bucket", "band", "id", "component", "block", F.least("block", "with").alias("lo"),
                     F.greatest("block", "with").alias("hi")))
    full = dealt.join(sets.select("id", "bands", "sig", "hashes"), "id")
    more = (full.repartition("bucket", "lo", "hi").sortWithinPartitions("bucket", "lo", "hi")
            .mapInPandas(cross_links(percent), f"a {kind}, b {kind}"))
    second = components(staged(more, "cross"))
    comp = (first.join(second.select(F.col("node").alias("component"), F.col("component").alias("over")),
                       "component", "left").select("node", F.coalesce("over", "component").alias("component")))
    # components of one document that only the second look joined
    alone = second.join(first.select("node"), "node", "left_anti")
    final = comp.unionByName(alone).withColumnRenamed("node", "rep")
    return (known.select("id", "n", "rep").join(final, "rep", "left")
            .select(F.col("id").alias(key), F.col("n").alias("n_shingles"),
                    F.coalesce("component", "rep", "id").alias("component_id"))
            .withColumn("kept", F.coalesce(F.col("component_id") == F.col(key), F.lit(True))))
