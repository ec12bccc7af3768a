"""Whitening, sharding and spelling variants against brute force."""
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from matchday.llm import sharding, spelling, whitening

DOCS = "doc_id long, text string, size int, word string"


# ------------------------------------------------------------------ op11
def table(spark, rows):
    return spark.createDataFrame([(i, v, "x") for i, v in rows], "vec_id long, embedding array<double>, n string").repartition(3)


def whitened(spark, rows, **kw):
    return whitening.whiten(table(spark, rows), **kw).collect()


def test_components_equal_a_library():
    rng = np.random.default_rng(3)
    for d, spread in ((1, None), (2, None), (3, None), (30, None), (64, None), (40, [5.0] * 12 + [1.0] * 28), (20, [1.0] * 20),
                      (12, [3.0, 3.0, 3.0] + [0.0] * 9)):
        a = rng.normal(size=(d, d))
        q, _ = np.linalg.qr(a)
        v = a @ a.T if spread is None else q @ np.diag(spread) @ q.T
        v = (v + v.T) / 2
        k = min(8, d)
        values, x = whitening.components(v, k)
        want = np.sort(np.linalg.eigvalsh(v))[::-1][:k]
        assert np.allclose(values, want, atol=1e-10 * max(1, want[0]))
        assert np.allclose(x.T @ x, np.eye(k), atol=1e-10)
        assert np.abs(v @ x - x * values).max() < 1e-9 * max(1, want[0])


def test_whitening_equals_brute_force(spark):
    rng = np.random.default_rng(1)
    v = rng.normal(size=(300, 12)) @ rng.normal(size=(12, 12)) * 0.2
    rows = [(i, x.tolist()) for i, x in enumerate(v)] + [(7, v[7].tolist()), (None, v[3].tolist()), (500, [0.0] * 12)]
    bad = [(900, None), (901, [float("nan")] + [0.1] * 11), (902, [None] * 12), (903, [float("inf")] * 12), (904, [1.0] * 5),
           (905, []), (906, [1e300] * 12)]
    got = whitened(spark, rows + bad)
    x = np.floor(1024 * np.array([r[1] for r in rows])).astype(int) + 100000
    n, s = len(x), x.sum(axis=0)
    centred = x - s / n
    cov = centred.T @ centred / n
    values, vectors = np.linalg.eigh(cov)
    values, vectors = values[::-1][:8], vectors[:, ::-1][:, :8]
    assert len(got) == n * 8 and {r.n for r in got} == {n}
    want = centred @ vectors / np.sqrt(values)
    deviation = ((n * x - s) ** 2).sum(axis=1)
    mine = defaultdict(dict)
    for r in got:
        mine[r.vec_id, r.deviation][r.component] = r
    for (i, _), w, d in zip(rows, want, deviation.tolist(), strict=True):
        for c, r in mine[i, d].items():
            assert abs(abs(r.whitened) - abs(w[c - 1])) < 1e-8
            assert abs(r.explained - values[c - 1] / np.trace(cov)) < 1e-9
    assert max(r.identity_error for r in got) < 1e-8


def test_whitening_edges(spark):
    assert whitened(spark, []) == [] and whitened(spark, [(1, None)]) == []
    one = whitened(spark, [(1, [0.5, 1.0])])
    assert [(r.component, r.deviation, r.whitened, r.explained, r.identity_error) for r in sorted(one)] == [
        (1, 0, 0.0, 0.0, 0.0), (2, 0, 0.0, 0.0, 0.0)]
    flat = whitened(spark, [(i, [float(i), 1.0, 2.0]) for i in range(10)])
    assert {r.whitened for r in flat if r.component > 1} == {0.0} and max(r.identity_error for r in flat) < 1e-9
    huge = whitened(spark, [(1, [2.0 ** 49, 0.0]), (2, [-(2.0 ** 49), 0.0]), (3, [0.0, 1.0])])
    assert {r.deviation for r in huge if r.vec_id < 3} == {None}
    with pytest.raises(ValueError):
        whitening.whiten(table(spark, [(1, [0.0] * (whitening.MOST_DIM + 1))]))


# ------------------------------------------------------------------ op12
def shards_of(rows, n=8):
    by = defaultdict(list)
    for r in rows:
        by[r.shard].append(r)
    for held in by.values():
        assert sorted(r.slot for r in held) == list(range(len(held)))
    return by


@pytest.mark.parametrize("per_range", [200_000, 20])
def test_shards_are_near_equal(spark, per_range):
    rng = np.random.default_rng(2)
    docs = [(i, "w" * int(rng.pareto(1.5) * 40), 1, "x") for i in range(3000)]
    docs += [(4000 + i, "the same text in a third of all rows", 1, "x") for i in range(1500)]
    docs += [(9, "equal row", 1, "x")] * 1500 + [(None, None, 1, "x"), (None, "", 1, "x"), (8000, "ü" * 2000, 1, "x")]
    got = sharding.shard_rows(spark.createDataFrame(docs, DOCS).repartition(4), per_range=per_range).collect()
    want = Counter((i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t, *_ in docs)
    assert Counter((r.doc_id, r["size"], r.text_crc32) for r in got) == want
    by = shards_of(got)
    total, most = sum(r["size"] for r in got), max(r["size"] for r in got)
    assert sorted(by) == list(range(8))
    for held in by.values():
        assert abs(sum(r["size"] for r in held) - total / 8) <= most
    assert {(r.law, r.grown_shard) for r in got} == {("bytes", None)}


def test_overfull_ranges_are_subdivided(spark):
    docs = spark.createDataFrame([(1, "equal", 1, "x")] * 2000 + [(i, "copies", 1, "x") for i in range(2000)]
                                 + [(i, f"own {i}", 1, "x") for i in range(2000)], DOCS).repartition(4)
    f = sharding.F
    rows = docs.select((f.octet_length("text") + 1).cast("long").alias("size"), f.xxhash64("text").alias("__k")).withColumn(
        "__m", f.monotonically_increasing_id())
    total = rows.agg(f.sum("size")).first()[0]
    _, counts = sharding.balanced(rows, 6000, total, 8)
    assert sum(c[0] for c in counts.values()) == 6000
    assert max(c[0] for c in counts.values()) <= 1.3 * sharding.OVERFULL * 6000 / 128  # two keys hold two thirds


def test_shard_edges(spark, tmp_path):
    assert sharding.shard_rows(spark.createDataFrame([], DOCS)).count() == 0
    few = sharding.shard_rows(spark.createDataFrame([(1, "a", 5, "x"), (2, None, 6, "y")], DOCS)).collect()
    assert sorted((r["size"], r.slot) for r in few) == [(1, 0), (2, 0)]
    docs = spark.createDataFrame([(i, "text " * (i % 9), 1, "x") for i in range(100)], DOCS)
    sharding.write_shards(docs, str(tmp_path / "out"))
    back = spark.read.parquet(str(tmp_path / "out"))
    assert sorted((r.doc_id, r.text) for r in back.collect()) == sorted((r.doc_id, r.text) for r in docs.collect())
    shards_of(back.collect())


# ------------------------------------------------------------------ op13
def brute(docs):
    seen = Counter()
    for i, t in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 31 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            seen[run] += 1
    n = {w: c for w, c in seen.items() if len(w) >= 7 and c >= 2}
    without = defaultdict(set)
    for w in n:
        for j in range(len(w)):
            without[w[:j], w[j + 1:]].add(w)  # one replaced, at a place
    out = {}
    for w in n:
        near = set().union(*(without[w[:j], w[j + 1:]] for j in range(len(w))))
        near |= {w[:j] + w[j + 1:] for j in range(len(w))} & n.keys()
        near |= {v for j in range(len(w) + 1) for v in without[w[:j], w[j:]] if len(v) == len(w) + 1}
        near.discard(w)
        best = min(near, key=lambda v: (-n[v], v), default=None)
        form = best if best and n[best] >= 10 * n[w] else None
        out[w] = [form, n[w], len(near), n[form] if form else None]
    roots = {}
    for w in out:
        r = w
        while out[r][0]:
            r = out[r][0]
        roots[w] = r
    return {w: (f, roots[w], c, k, fn) for w, (f, c, k, fn) in out.items()}


def corpus(seed, size=400):
    rng = np.random.default_rng(seed)
    stems = ["".join(rng.choice(list("abeéÿ"), rng.integers(6, 11))) for _ in range(150)]
    stems += ["prefixprefix" + "".join(rng.choice(list("ab"), 4)) for _ in range(30)] + ["x" * 600, "x" * 601, "x" * 300 + "y" + "x" * 299]
    weight = 1 / np.arange(1, len(stems) + 1) ** 1.1
    docs = []
    for i in range(size):
        words = list(rng.choice(stems, 60, p=weight / weight.sum()))
        for k in range(0, 60, 7):
            w, at = words[k], int(rng.integers(0, len(words[k])))
            words[k] = [w[:at] + "q" + w[at:], w[:at] + w[at + 1:], w[:at] + "b" + w[at + 1:], w.upper()][int(rng.integers(0, 4))]
        docs.append((i, " ".join(words) + "3short Ünicode×÷word"))
    return docs + [(None, "Nothing nothing nothing"), (5, None), (6, ""), (7, docs[0][1]), (7, docs[0][1])]


@pytest.mark.parametrize("per_block", [spelling.PER_BLOCK, 40])
def test_spelling_equals_brute_force(spark, monkeypatch, per_block):
    monkeypatch.setattr(spelling.near_words, "__defaults__", (per_block,))
    docs = corpus(per_block)
    got = spelling.spelling_variants(spark.createDataFrame([(*d, 1, "clash") for d in docs], DOCS).repartition(3)).collect()
    want = brute(docs)
    assert {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in got} == want and len(got) == len(want)
    assert sum(f is not None for f, *_ in want.values()) > 20


def test_no_words(spark):
    assert spelling.spelling_variants(spark.createDataFrame([], DOCS)).count() == 0
    assert spelling.spelling_variants(spark.createDataFrame([(1, "short", 1, "x")], DOCS)).count() == 0


def test_list_scan_equals_all_pairs():
    rng = np.random.default_rng(5)
    words = sorted({"".join(rng.choice(list("ab"), rng.integers(7, 10))) for _ in range(300)})

    def one(a, b):
        if len(a) == len(b):
            return sum(x != y for x, y in zip(a, b, strict=True)) == 1
        a, b = sorted((a, b), key=len)
        return len(b) == len(a) + 1 and any(b[:j] + b[j + 1:] == a for j in range(len(b)))

    q, w = spelling.near_in_list(words, words)
    want = {(i, j) for i, a in enumerate(words) for j, b in enumerate(words) if one(a, b) and a[:len(a) // 2] == b[:len(a) // 2]}
    assert len(q) == len(want) and set(zip(q.tolist(), w.tolist(), strict=True)) == want
    for i, j in want:
        for cut in range(len(words[i]) // 2, len(words[j]) + 1):
            assert spelling.edges_alive(words[j][:cut], words[i], len(words[i]) // 2)
