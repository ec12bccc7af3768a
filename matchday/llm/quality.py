"""Quality classifier: attention-based multiple-instance learning over passages.

A document is a bag of passages (``PASSAGE`` bytes each, the whole text). A passage is
encoded as the square roots of its byte-class bigram frequencies and, for repetition,
of the share of its 8-byte grams that occurred earlier in the document. A learned layer
embeds each passage, ``h = tanh(E x + e)``; gated attention
``a = softmax(w (tanh(V h) * sigmoid(U h)))`` weighs the passages of the bag; the
weighted representation ``z = sum(a h)`` gives the score ``sigmoid(c z + d)``. All
weights are learned together from document labels alone.

Training reads a bounded sample of labelled rows, every passage of each: of the labelled
documents that are not held out, those with the smallest hash, one bag per id (the smallest
encoded), up to ``SAMPLE`` documents and ``TRAIN_PASSAGES`` passages per label. The passages
bound the documents, never a document: where texts are long, fewer are taken, the first of
them whatever its length. How long they are is counted before any text is encoded, so the
driver holds at most twice ``TRAIN_PASSAGES`` rows of ``WIDTH`` half floats and two documents; the
trained weights (about 70 kB) go back with the tasks. Scoring is one narrow ``mapInArrow``;
memory is that of ``CHARS`` bytes of text or one document.

Labels, language, source and id never enter a score. Cases: a null or empty text is a
bag of one empty passage and scored as such; labels that are null or not 0/1, or whose
id is null, are not used; several labels of a document count as the smallest; without
both labels in the sample every score is the share of label 1 (0.5 without any).
Repeated rows are each scored; a null id counts as not held out; an empty table gives
an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

PASSAGE = 512
SAMPLE = 500
TRAIN_PASSAGES = 16_000
CHARS, ROWS = 500_000, 512
KINDS = 17
WIDTH = KINDS * KINDS + 2
GRAM = 8
EMBED, GATE = 32, 16


def byte_kinds() -> np.ndarray:
    """A class for each byte value: letters by case, digits, blanks, single marks, the rest."""
    kind = np.full(256, 14, np.uint8)
    kind[128:] = 15
    for chars, k in ((range(97, 123), 0), (range(65, 91), 1), (range(48, 58), 2), (b" \t", 3), (b"\n\r", 4)):
        kind[list(chars)] = k
    for k, mark in enumerate(b".,|*#$%&!", 5):
        kind[mark] = k
    kind[list(b"<>{}[]=\\/_@^~")] = 16
    return kind


KIND = byte_kinds()
POWERS = np.cumprod(np.full(GRAM, 0x9E3779B97F4A7C15, np.uint64))


def encode(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Encoded passages ``(n, WIDTH)`` as float32 and the number of passages of each text."""
    data = [(t or "").encode("utf-8", "surrogatepass") for t in texts]
    sizes = np.array([len(b) for b in data], np.int64)
    bags = np.maximum(1, -(-sizes // PASSAGE))
    flat = np.frombuffer(b"".join(data), np.uint8)
    starts = np.cumsum(sizes) - sizes
    doc = np.repeat(np.arange(len(data)), sizes)
    passage = (np.cumsum(bags) - bags)[doc] + (np.arange(len(flat)) - starts[doc]) // PASSAGE
    n = int(bags.sum())
    kind = KIND[flat].astype(np.int64)
    out = np.zeros((n, WIDTH), np.float32)
    if len(flat) > 1:
        same = doc[1:] == doc[:-1]
        cell = passage[:-1][same] * KINDS * KINDS + kind[:-1][same] * KINDS + kind[1:][same]
        out[:, :KINDS * KINDS] = np.bincount(cell, minlength=n * KINDS * KINDS).reshape(n, -1)
    held = np.bincount(passage, minlength=n) if len(flat) else np.zeros(n)
    out[:, :-2] /= np.maximum(held, 1)[:, None]
    out[:, -2] = repeated(flat, doc, passage, n) / np.maximum(held, 1)
    out[:, -1] = held / PASSAGE
    np.sqrt(out, out=out)
    return out, bags


def repeated(flat: np.ndarray, doc: np.ndarray, passage: np.ndarray, n: int) -> np.ndarray:
    """For each passage, how many of its 8-byte grams at word starts occurred earlier in its document."""
    m = len(flat) - GRAM + 1
    if m <= 1:
        return np.zeros(n)
    at = np.flatnonzero((flat[:-1] <= 32) & (flat[1:] > 32)) + 1
    at = at[at < m]
    at = at[doc[at] == doc[at + GRAM - 1]]
    h = np.zeros(len(at), np.uint64)
    for k in range(GRAM):
        h += (flat[at + k].astype(np.uint64) + np.uint64(1)) * POWERS[k]
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) + doc[at].astype(np.uint64)
    order = np.argsort(h, kind="stable")
    again = np.zeros(len(at), bool)
    again[order[1:]] = h[order[1:]] == h[order[:-1]]
    return np.bincount(passage[at[again]], minlength=n) * float(GRAM)


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * x))


def bag_sum(x: np.ndarray, starts: np.ndarray) -> np.ndarray:
    return np.add.reduceat(x, starts, axis=0)


def forward(p: dict[str, np.ndarray], x: np.ndarray, bags: np.ndarray) -> tuple[np.ndarray, dict]:
    """Scores of bags and what the backward pass needs."""
    starts = np.cumsum(bags) - bags
    h = np.tanh(((x - p["mean"]) / p["scale"]) @ p["E"] + p["e"])
    v, u = np.tanh(h @ p["V"]), sigmoid(h @ p["U"])
    g = (v * u) @ p["w"]
    g = np.exp(g - np.repeat(np.maximum.reduceat(g, starts), bags))
    a = g / np.repeat(bag_sum(g, starts), bags)
    z = bag_sum(a[:, None] * h, starts)
    return sigmoid(z @ p["c"] + p["d"]), {"h": h, "v": v, "u": u, "a": a, "z": z, "starts": starts}


def train(x: np.ndarray, bags: np.ndarray, y: np.ndarray, rounds: int = 150, rate: float = 0.01,
          decay: float = 1e-4, seed: int = 4) -> dict[str, np.ndarray]:
    """Weights by full-batch Adam on the balanced log loss."""
    rng = np.random.default_rng(seed)
    share = float(y.mean()) if len(y) else 0.5
    p = {"mean": x.mean(axis=0) if len(x) else np.zeros(WIDTH), "scale": x.std(axis=0) + 0.02 if len(x) else np.ones(WIDTH),
         "E": rng.normal(0, 0.05, (WIDTH, EMBED)), "e": np.zeros(EMBED), "V": rng.normal(0, 0.2, (EMBED, GATE)),
         "U": rng.normal(0, 0.2, (EMBED, GATE)), "w": rng.normal(0, 0.2, GATE), "c": np.zeros(EMBED), "d": np.zeros(1)}
    if share in (0.0, 1.0) or not len(y):
        p["d"][:] = np.log((share + 1e-9) / (1 - share + 1e-9))
        return p
    p["c"] = rng.normal(0, 0.2, EMBED)
    p = {k: v.astype(np.float32) for k, v in p.items()}
    weight = np.where(y == 1, 0.5 / share, 0.5 / (1 - share)).astype(np.float32) / len(y)
    xn = (x - p["mean"]) / p["scale"]
    learned = ["E", "e", "V", "U", "w", "c", "d"]
    m1, m2 = ({k: np.zeros_like(p[k]) for k in learned} for _ in range(2))
    for t in range(1, rounds + 1):
        s, f = forward(p, x, bags)
        dz = ((s - y) * weight)[:, None]
        grad = {"c": f["z"].T @ dz[:, 0], "d": dz.sum(axis=0)}
        back = np.repeat(dz * p["c"], bags, axis=0)
        da = (back * f["h"]).sum(axis=1)
        dg = f["a"] * (da - np.repeat(bag_sum(f["a"] * da, f["starts"]), bags))
        gate = dg[:, None] * p["w"]
        dv, du = gate * f["u"] * (1 - f["v"] ** 2), gate * f["v"] * f["u"] * (1 - f["u"])
        grad["w"] = (f["v"] * f["u"]).T @ dg
        grad["V"], grad["U"] = f["h"].T @ dv, f["h"].T @ du
        dh = (back * f["a"][:, None] + dv @ p["V"].T + du @ p["U"].T) * (1 - f["h"] ** 2)
        grad["E"], grad["e"] = xn.T @ dh, dh.sum(axis=0)
        for k in learned:
            g = grad[k].astype(np.float32) + decay * p[k]
            m1[k] = 0.9 * m1[k] + 0.1 * g
            m2[k] = 0.999 * m2[k] + 0.001 * g * g
            p[k] = p[k] - rate * (m1[k] / (1 - 0.9 ** t)) / (np.sqrt(m2[k] / (1 - 0.999 ** t)) + 1e-8)
    return p


def text_batches(texts: list[str | None]) -> Iterator[tuple[int, int]]:
    """Ranges of texts of about ``CHARS`` characters together, or one text."""
    lo = size = 0
    for i, t in enumerate(texts):
        if i > lo and size + len(t or "") > CHARS:
            yield lo, i
            lo, size = i, 0
        size += len(t or "")
    if texts:
        yield lo, len(texts)


def fit(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "quality",
        sample: int = SAMPLE, passages: int = TRAIN_PASSAGES) -> dict[str, np.ndarray]:
    """Weights learned from labelled documents whose crc32(id) mod 3 is not 1."""
    rows = (labels.where(F.col(key).isNotNull() & F.col(label).isin(0, 1) & ~held_out(F.col(key)))
            .groupBy(key).agg(F.min(label).alias("y")))
    drawn = [rows.where(F.col("y") == y).orderBy(F.xxhash64(key), key).limit(sample) for y in (0, 1)]
    drawn = drawn[0].unionByName(drawn[1])  # 2 * sample rows, a documented bound
    texts = docs.select(key, F.coalesce(F.col(text), F.lit("")).alias("text"))
    held = F.greatest(F.lit(1), F.ceil(F.octet_length("text") / PASSAGE))
    sizes = (texts.join(F.broadcast(drawn), key).groupBy(key, "y").agg(F.max(held).alias("n"))
             .orderBy(F.xxhash64(key), key).collect())  # one row per drawn document
    chosen, left = [], {0: passages, 1: passages}
    for r in sizes:
        if left[r.y] == passages or r.n <= left[r.y]:
            chosen.append((r[key], r.y))
            left[r.y] -= r.n
    some = texts.join(F.broadcast(docs.sparkSession.createDataFrame(chosen, rows.schema)), key)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for t, y, k in zip(b["text"], b["y"], b["k"], strict=True):
                x, _ = encode([t])
                yield pd.DataFrame({"k": [k], "y": [y], "n": [len(x)], "x": [x.astype(np.float16).tobytes()]})

    got = (some.select(F.col(key).cast("string").alias("k"), "text", F.col("y").cast("int").alias("y"))
           .mapInPandas(run, "k string, y int, n int, x binary")
           # one bag per id, whatever rows repeat it
           .groupBy("k", "y").agg(F.min(F.struct("n", "x")).alias("r")).select("k", "y", "r.n", "r.x").collect())
    got.sort(key=lambda r: (r.k, r.n, bytes(r.x)))  # the order of arrival must not matter
    if not got:
        return train(np.zeros((0, WIDTH), np.float32), np.zeros(0, int), np.zeros(0))
    x = np.concatenate([np.frombuffer(r.x, np.float16).reshape(r.n, WIDTH) for r in got]).astype(np.float32)
    return train(x, np.array([r.n for r in got]), np.array([r.y for r in got], np.float32))


def held_out(key) -> F.Column:
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def score(docs: DataFrame, weights: dict[str, np.ndarray], text: str = "text", out: str = "score") -> DataFrame:
    """``docs`` with a column ``out`` added (or replaced): the score of every row's whole text."""
    docs = docs.drop(out)
    small = {k: v.astype(np.float32) for k, v in weights.items()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            s = np.zeros(b.num_rows)
            for first in range(0, b.num_rows, ROWS):  # a batch's texts become Python's a few at a time
                texts = b.column(at).slice(first, ROWS).to_pylist()
                for lo, hi in text_batches(texts):
                    s[first + lo:first + hi] = forward(small, *encode(texts[lo:hi]))[0]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(np.clip(s, 0.0, 1.0))], names=[*b.schema.names, out])

    at = docs.columns.index(text)
    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, T.StructField(out, T.DoubleType())]))


def classify(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``(key, held_out, score, predicted)`` of every row."""
    scored = score(docs.select(F.col(key).alias(key), F.col(text).alias("text")), fit(docs, labels, key, text))
    return scored.select(key, held_out(F.col(key)).alias("held_out"), "score",
                         (F.col("score") >= 0.5).cast("int").alias("predicted"))
