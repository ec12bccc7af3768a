"""Exact repeats of ``LEAST`` bytes or more, from the LCP intervals of enhanced suffix arrays.

A suffix array over all texts is cut into pieces that need no other piece. Every window
of ``LEAST`` bytes picks an anchor, the ``GRAM``-byte gram in it with the smallest hash;
equal windows pick the same anchor at the same offset. An anchor owns a run of
consecutive windows, whose bytes are its context. So:

1. One scan lists the anchors: gram hash, context hash, place. Grams that occur once are
   done with.
2. Equal contexts (gram and context, two independent 64-bit hashes with lengths) are one
   class. A class with two or more places repeats in full.
3. Classes that share a gram but not their context form a bucket: its suffixes (the owned
   windows, with all that follows in their context) are sorted, neighbours' common
   prefixes give the LCP array, and a stack scan lists its intervals of depth ``LEAST``
   or more. An interval whose suffixes are all preceded by the same byte is not
   left-maximal and is passed over: its repeat is part of the one a byte to the left. The
   others are the maximal repeats inside the contexts, with all their occurrences, and
   cover them in full. A context's first window counts as preceded by a byte of its own,
   so nothing that crosses from one anchor to the next is lost.
4. Buckets of over ``LARGE`` classes are not sorted in one task: their windows are grouped
   by two 64-bit hashes, exactly and spread over all tasks.
5. The covered stretches come back to the texts, are merged and cut out.

Hot grams and contexts are partially aggregated, as are the places of equal texts; only
joins on them remain, each followed by a write or a shuffle, so that AQE can split them. A document's stretches are bounded by its own length. Matches are judged on the
input, overlaps count, and a stretch never crosses texts. A null text counts as empty;
equal texts share their result; rows with null or repeated ids are handled like any;
other columns are not read. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._shingles import mixed
from ._util import discarded, released, staged

LEAST, GRAM = 200, 64
LARGE = 2048
CHARS = 2_000_000
U = np.uint64
BYTE = np.random.default_rng(200).integers(0, 2 ** 64, (2, 256), dtype=U)
BASE = (0x9E3779B97F4A7C15, 0xD1342543DE82EF95)
PLACE = 22  # low bits of a hash that hold a place in a batch, to break ties


class Hashes:
    """Two independent 64-bit polynomial hashes of any stretch of ``data`` from running sums."""

    def __init__(self, data: np.ndarray):
        n = len(data)
        self.sums, self.back = [], []
        for t in (0, 1):
            power, back = np.full(n + 1, U(BASE[t])), np.full(n + 1, U(pow(BASE[t], -1, 2 ** 64)))
            power[0] = back[0] = 1
            np.multiply.accumulate(power, out=power)
            np.multiply.accumulate(back, out=back)
            s = np.zeros(n + 1, U)
            np.cumsum(BYTE[t][data] * power[:-1], out=s[1:])
            self.sums.append(s)
            self.back.append(back)

    def of(self, t: int, start: np.ndarray, size: np.ndarray) -> np.ndarray:
        s = self.sums[t]
        return mixed((s[start + size] - s[start]) * self.back[t][start] + size.astype(U) * U(0x2545F4914F6CDD1D))


def anchors(data: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, ...]:
    """Of joined texts (``doc``: text of each byte) the anchors: first owned window, windows
    owned, gram hash, hash of the context and the anchor's offset in it."""
    none = np.zeros(0, np.int64)
    if len(data) < LEAST:
        return none, none, none, none
    hashes = Hashes(data)
    at = np.arange(len(data) - GRAM + 1)
    gram = hashes.of(0, at, np.full(len(at), GRAM))
    place = max(PLACE, len(data).bit_length())
    ranked = (gram >> U(place) << U(place)) | at.astype(U)
    # minima of runs of ``width`` grams: the tail of one block with the head of the next
    width = LEAST - GRAM + 1
    padded = np.concatenate([ranked, np.full(-len(ranked) % width, U(2 ** 64 - 1))]).reshape(-1, width)
    head = np.minimum.accumulate(padded, axis=1).reshape(-1)
    tail = np.minimum.accumulate(padded[:, ::-1], axis=1)[:, ::-1].reshape(-1)
    n = len(data) - LEAST + 1
    pick = (np.minimum(tail[:n], head[width - 1:width - 1 + n]) & U(2 ** place - 1)).astype(np.int64)
    window = np.flatnonzero(doc[:n] == doc[LEAST - 1:])
    if not len(window):
        return none, none, none, none
    pick = pick[window]
    new = np.append(True, (pick[1:] != pick[:-1]) | (window[1:] != window[:-1] + 1))
    first = window[new]
    owned = np.diff(np.append(np.flatnonzero(new), len(window)))
    offset = pick[new] - first
    context = hashes.of(1, first, owned + LEAST - 1)
    context = mixed(context + offset.astype(U) * U(0x9E3779B97F4A7C15) + owned.astype(U))
    return first, owned, gram[pick[new]].view(np.int64), context.view(np.int64)


def keyed(docs: DataFrame, text: str) -> DataFrame:
    """``docs`` with the 16 bytes of the text's MD5 in ``k``."""
    return docs.withColumn("k", F.unhex(F.md5(F.coalesce(F.col(text), F.lit("")).cast("binary"))))


def scan(docs: DataFrame, text: str) -> DataFrame:
    """``(k, lo, owned, gram, context)`` for every anchor of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keys, texts = b.column(0).to_pylist(), [(t or "").encode() for t in b.column(1).to_pylist()]
            i = 0
            while i < len(texts):
                j, size = i, 0
                while j < len(texts) and (j == i or size + len(texts[j]) <= CHARS):
                    size += len(texts[j]) + 1
                    j += 1
                sizes = np.array([len(t) for t in texts[i:j]])
                data = np.frombuffer(b"".join(texts[i:j]), np.uint8)
                doc = np.repeat(np.arange(j - i), sizes)
                first, owned, gram, context = anchors(data, doc)
                of = doc[first] if len(first) else first
                yield pa.RecordBatch.from_arrays(
                    [pa.array([keys[i + d] for d in of.tolist()], pa.binary()),
                     pa.array(first - (np.cumsum(sizes) - sizes)[of]), pa.array(owned.astype(np.int64)),
                     pa.array(gram), pa.array(context)], names=["k", "lo", "owned", "gram", "context"])
                i = j

    return (keyed(docs.select(F.coalesce(F.col(text), F.lit("")).alias("text")), "text").select("k", "text")
            .mapInArrow(run, "k binary, lo long, owned long, gram long, context long"))


def lcp_intervals(lcp: np.ndarray, least: int) -> list[tuple[int, int, int]]:
    """``(depth, first, last)`` of the LCP intervals of depth ``least`` or more of a sorted run,
    by one scan with a stack; ``lcp[i]`` is common to suffixes ``i - 1`` and ``i``."""
    out, stack = [], []
    for i in range(1, len(lcp) + 1):
        d = int(lcp[i]) if i < len(lcp) else 0
        start = i - 1
        while stack and stack[-1][0] > d:
            depth, start = stack.pop()
            out.append((depth, start, i - 1))
        if d >= least and (not stack or stack[-1][0] < d):
            stack.append((d, start))
    return out


def maximal_repeats(contexts: list[bytes], owned: np.ndarray, least: int = LEAST) -> list[tuple[int, list[tuple[int, int]]]]:
    """``(length, [(context, offset), ...])`` of the left-maximal LCP intervals of a bucket."""
    size = np.array([len(c) for c in contexts])
    base = np.cumsum(size) - size
    data = np.frombuffer(b"".join(contexts) + bytes(least), np.uint8)
    which = np.repeat(np.arange(len(contexts)), owned)
    offset = np.arange(len(which)) - np.repeat(np.cumsum(owned) - owned, owned)
    place = base[which] + offset
    rows = np.ascontiguousarray(np.lib.stride_tricks.sliding_window_view(data, least)[place])
    suffix = np.argsort(rows.view(f"S{least}").ravel(), kind="stable")
    same = np.append(False, (rows[suffix[1:]] == rows[suffix[:-1]]).all(axis=1))
    run = np.cumsum(~same) - 1
    # what follows the first ``least`` bytes, for the suffixes that share them
    preceding = np.where(offset > 0, data[place - 1].astype(np.int64), 256 + which)[suffix]
    starts = np.flatnonzero(~same)
    diverse = np.minimum.reduceat(preceding, starts) != np.maximum.reduceat(preceding, starts)
    several = np.diff(np.append(starts, len(suffix))) > 1
    out = []
    raw = data.tobytes()
    for r in np.flatnonzero(diverse & several):
        lo, hi = starts[r], starts[r + 1] if r + 1 < len(starts) else len(suffix)
        ends = (base + size)[which]
        own = sorted(((raw[place[s] + least:ends[s]], s) for s in suffix[lo:hi].tolist()))
        lcp = np.zeros(len(own), np.int64)
        for i in range(1, len(own)):
            a, b = own[i - 1][0], own[i][0]
            n = min(len(a), len(b))
            d = n if a[:n] == b[:n] else next(j for j in range(n) if a[j] != b[j])
            lcp[i] = least + d
        for depth, first, last in lcp_intervals(lcp, least):
            inside = [s for _, s in own[first:last + 1]]
            before = {int(data[place[s] - 1]) if offset[s] else -1 - int(which[s]) for s in inside}
            if len(before) > 1:
                out.append((depth, [(int(which[s]), int(offset[s])) for s in inside]))
    return out


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for lo, hi in sorted(spans):
        if out and lo <= out[-1][1]:
            out[-1][1] = max(out[-1][1], hi)
        else:
            out.append([lo, hi])
    return [(a, b) for a, b in out]


def groups_of(batches: Iterator[pd.DataFrame], column: str) -> Iterator[pd.DataFrame]:
    """Whole groups of rows that arrive sorted by ``column``."""
    tail = None
    for b in batches:
        b = pd.concat([tail, b]) if tail is not None else b
        if not len(b):
            continue
        parts = [g for _, g in b.groupby(column, sort=False)]
        tail = parts.pop()
        yield from parts
    if tail is not None and len(tail):
        yield tail


def bucket_cover(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """``(gram, context, lo, hi)``: stretches of each context that repeat elsewhere in its bucket."""
    rows: list[tuple] = []
    for g in groups_of(batches, "gram"):
        g = g.drop_duplicates("context")
        spans: dict[int, list[tuple[int, int]]] = {}
        for depth, places in maximal_repeats(g["bytes"].to_list(), g["owned"].to_numpy()):
            for c, at in places:
                spans.setdefault(c, []).append((at, at + depth))
        gram, context = g["gram"].to_list(), g["context"].to_list()
        rows += [(gram[c], context[c], lo, hi) for c, s in spans.items() for lo, hi in merged(s)]
        if len(rows) > 10_000:
            yield pd.DataFrame(rows, columns=["gram", "context", "lo", "hi"])
            rows = []
    yield pd.DataFrame(rows, columns=["gram", "context", "lo", "hi"])


def windows_of(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """``(gram, context, at, w1, w2)``: the two hashes of every owned window."""
    for b in batches:
        for lo in range(0, len(b), 4000):
            part = b.iloc[lo:lo + 4000]
            owned = part["owned"].to_numpy()
            size = part["bytes"].str.len().to_numpy()
            h = Hashes(np.frombuffer(b"".join(part["bytes"]), np.uint8))
            at = np.arange(owned.sum()) - np.repeat(np.cumsum(owned) - owned, owned)
            start = np.repeat(np.cumsum(size) - size, owned) + at
            length = np.full(len(at), LEAST)
            yield pd.DataFrame({"gram": np.repeat(part["gram"].to_numpy(), owned),
                                "context": np.repeat(part["context"].to_numpy(), owned), "at": at,
                                "w1": h.of(0, start, length).view(np.int64), "w2": h.of(1, start, length).view(np.int64)})


def repeated_spans(docs: DataFrame, text: str = "text") -> DataFrame:
    """``(k, spans)``: of each text with repeats, its stretches (not merged) by the key of the text."""
    every = staged(scan(docs, text), "anchors")
    # written before and after the join, so that AQE may split a hot gram
    twice = staged(every.groupBy("gram").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1).select("gram"), "twice")
    shared = staged(every.join(twice, "gram", "left_semi"), "shared")
    discarded(every)
    classes = staged(shared.groupBy("gram", "context").agg(F.count(F.lit(1)).alias("n"),
                                                           F.min(F.struct("k", "lo", "owned")).alias("r"))
                     .select("gram", "context", "n", "r.k", "r.lo", "r.owned"), "classes")
    buckets = (classes.groupBy("gram").agg(F.count(F.lit(1)).alias("classes")).where(F.col("classes") > 1))
    # one row per text that holds such a class, with its own places
    wanted = (classes.join(buckets, "gram").groupBy("k")
              .agg(F.collect_list(F.struct("gram", "context", "classes", "lo", "owned")).alias("r")))

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = []
            for t, r in zip(b["text"], b["r"], strict=True):
                data = t.encode()
                rows += [(x["gram"], x["context"], x["classes"], x["owned"],
                          data[x["lo"]:x["lo"] + x["owned"] + LEAST - 1]) for x in r]
                if len(rows) > 20_000:
                    yield pd.DataFrame(rows, columns=["gram", "context", "classes", "owned", "bytes"])
                    rows = []
            yield pd.DataFrame(rows, columns=["gram", "context", "classes", "owned", "bytes"])

    texts = keyed(docs.select(F.coalesce(F.col(text), F.lit("")).alias("text")), "text")
    contexts = staged(texts.join(wanted, "k").select("text", "r").mapInPandas(
        cut, "gram long, context long, classes long, owned long, bytes binary"), "contexts")
    released(docs.sparkSession)
    cover = "gram long, context long, lo long, hi long"
    small = (contexts.where(F.col("classes") <= LARGE).repartition("gram").sortWithinPartitions("gram", "context")
             .mapInPandas(bucket_cover, cover))
    windows = staged(contexts.where(F.col("classes") > LARGE).dropDuplicates(["gram", "context"]).mapInPandas(
        windows_of, "gram long, context long, at long, w1 long, w2 long"), "windows")
    again = windows.groupBy("w1", "w2").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1).select("w1", "w2")
    large = windows.join(again, ["w1", "w2"], "left_semi").select(
        "gram", "context", F.col("at").alias("lo"), (F.col("at") + LEAST).alias("hi"))
    full = classes.where(F.col("n") > 1).select("gram", "context", F.lit(0).cast("long").alias("lo"),
                                                (F.col("owned") + LEAST - 1).alias("hi"))
    stretches = staged(small.unionByName(large).unionByName(full).groupBy("gram", "context")
                       .agg(F.collect_list(F.struct("lo", "hi")).alias("s")), "stretches")
    # places of equal texts are one row from here on
    places = shared.select("k", "lo", "gram", "context").distinct()
    placed = places.join(stretches, ["gram", "context"]).select(
        "k", F.transform("s", lambda s: F.struct((F.col("lo") + s["lo"]).alias("lo"), (F.col("lo") + s["hi"]).alias("hi")))
        .alias("s"))
    return placed.groupBy("k").agg(F.flatten(F.collect_list("s")).alias("spans"))


def remove_repeats(docs: DataFrame, key: str = "doc_id", text: str = "text", with_text: bool = False) -> DataFrame:
    """``(key, n_bytes, n_removed, n_spans, kept_sha256[, kept])`` for every row."""
    kind = docs.schema[key].dataType.simpleString()
    spans = staged(repeated_spans(docs, text), "spans")
    released(docs.sparkSession)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = []
            for k, t, s in zip(b["id"], b["text"], b["spans"], strict=True):
                data = t.encode()
                out = merged([(x["lo"], x["hi"]) for x in s]) if s is not None else []
                ends = [0] + [x for lo, hi in out for x in (lo, hi)] + [len(data)]
                kept = b"".join([data[a:z] for a, z in zip(ends[::2], ends[1::2], strict=True)])
                rows.append((k, len(data), len(data) - len(kept), len(out), hashlib.sha256(kept).hexdigest())
                            + ((kept,) if with_text else ()))
            names = ["id", "n_bytes", "n_removed", "n_spans", "kept_sha256"] + ["kept"] * with_text
            yield pd.DataFrame(rows, columns=names)

    rows = keyed(docs.select(F.col(key).alias("id"), F.coalesce(F.col(text), F.lit("")).alias("text")), "text")
    schema = f"id {kind}, n_bytes long, n_removed long, n_spans long, kept_sha256 string" + ", kept binary" * with_text
    return (rows.join(spans, "k", "left").select("id", "text", "spans").mapInPandas(run, schema)
            .withColumnRenamed("id", key))
