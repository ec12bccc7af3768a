"""BPE, near-duplicates and repeats against a library or brute force."""
import collections
import hashlib
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from matchday.llm import bpe, minhash, repeats

DOCS = "doc_id long, text string, extra string"


def frame(spark, rows, parts=3):
    return spark.createDataFrame([(*r, "x") for r in rows], DOCS).repartition(parts)


# ------------------------------------------------------------------ BPE
@pytest.fixture(scope="module")
def both():
    from tokenizers import Tokenizer
    path = bpe.default_vocabulary()
    return Tokenizer.from_file(path), bpe.Bpe(bpe.read_spec(path))


TRICKY = ["", " ", "Hello  World's can't", "<|endoftext|>", "a<|startoftext|> b<|endoftext|><|endoftext|>", "ΑΣ ΑΣΑ",
          "\x1c\x1d a\x85b\xa0c d​e", "İI ß ẞ ſ K", "é ́x 'S it's", "a" * 3000, "ab12 ３４ ½ Ⅷ", "안녕하세요 각",
          "日本語。テスト!?", "😀👍🏽 !!??", "'ll'll ' s", "x﻿y", "ab" * 400 + " end", "ᤉ1 s߽̒"]


@pytest.mark.parametrize("text", TRICKY)
def test_bpe_equals_library(both, text):
    lib, own = both
    ids = lib.encode(text, add_special_tokens=False).ids
    assert own.encode(text) == ids
    written, decoded = next(iter(own.written([text])))
    assert written == " ".join(map(str, ids))
    assert decoded == lib.decode(ids, skip_special_tokens=False) == own.decode(ids)


@settings(max_examples=300, deadline=None)
@given(st.text(st.characters(exclude_categories=("Cs",)), max_size=60))
def test_bpe_equals_library_on_any_text(both, text):
    lib, own = both
    assert own.encode(text) == lib.encode(text, add_special_tokens=False).ids


def test_long_words_merge_alike(both):
    _, own = both
    rng = random.Random(2)
    for n in (1, 2, 7, 60, 200, 256):
        w = "".join(rng.choice("thearinongs") for _ in range(n)).encode()
        assert own.merge_all([w]) == [own.merge_long(w)]


def test_bpe_documents(spark, both):
    lib, _ = both
    rows = [(1, "Same text"), (1, "Same text"), (2, None), (None, "x y"), (3, ""), (4, "word " * 30000)]
    got = collections.Counter((r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256, tuple(r.ids))
                              for r in bpe.encode_documents(frame(spark, rows), with_ids=True).collect())
    want = collections.Counter()
    for k, t in rows:
        ids = lib.encode(t or "", add_special_tokens=False).ids
        sha = [hashlib.sha256(s.encode()).hexdigest() for s in (" ".join(map(str, ids)), lib.decode(ids, skip_special_tokens=False))]
        want[k, len(ids), *sha, tuple(ids)] += 1
    assert got == want
    assert bpe.encode_documents(frame(spark, [])).count() == 0


# ------------------------------------------------------------------ near-duplicates
def shingles(text, width):
    w = (text or "").encode().lower().split()
    return {tuple(w[i:i + width]) for i in range(len(w) - width + 1)} if len(w) >= width else {tuple(w)} if w else set()


def linked(rows, width, percent=80):
    sets = [shingles(t, width) for _, t in rows]
    comp = {k: k for k, _ in rows}

    def top(x):
        while comp[x] != x:
            x = comp[x]
        return x
    for i, (a, _) in enumerate(rows):
        for j, (b, _) in enumerate(rows[:i]):
            n = len(sets[i] & sets[j])
            if a is not None and b is not None and n and 100 * n >= percent * len(sets[i] | sets[j]):
                x, y = sorted((top(a), top(b)))
                comp[y] = x
    return collections.Counter((k, len(s), top(k), k is None or top(k) == k) for (k, _), s in zip(rows, sets, strict=True))


def near_rows(seed=1):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(300)]
    rows, k = [], 0
    for g in range(8):
        base = [rng.choice(words) for _ in range(60)]
        for _ in range(rng.choice([1, 2, 25])):
            t = list(base)
            for _ in range(rng.randrange(4)):
                t[rng.randrange(len(t))] = rng.choice(words)
            rows.append((k, rng.choice([" ", "\n", " \t "]).join(t)))
            k += 3
    return rows + [(1000, "one two"), (1001, "ONE  two"), (1002, "one"), (1003, None), (1004, ""), (1005, " \n"),
                   (1006, "é È"), (1007, "é è"), (5, rows[0][1]), (5, rows[0][1]), (None, rows[0][1]), (None, "z")]


@pytest.mark.parametrize("block", [minhash.BLOCK, 4])
def test_near_duplicates_equal_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(minhash, "BLOCK", block)
    rows = near_rows()
    got = minhash.near_duplicates(frame(spark, rows), width=4).collect()
    assert collections.Counter((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in got) == linked(rows, 4)


def test_near_duplicates_of_nothing(spark):
    assert minhash.near_duplicates(frame(spark, [])).count() == 0


def test_estimate_is_unbiased():
    import numpy as np
    rng = np.random.default_rng(0)
    like = []
    for _ in range(40):
        x = rng.integers(0, 2 ** 63, 1100, dtype=np.uint64)
        a, b = minhash.packed(np.stack([minhash.minima(x[:1000]), minhash.minima(x[100:])])).view(np.uint64)
        d = a ^ b
        d = (d | d >> np.uint64(1) | d >> np.uint64(2) | d >> np.uint64(3)) & np.uint64(0x1111111111111111)
        like.append((1 - np.bitwise_count(d).sum() / minhash.PERMS - 1 / 16) / (15 / 16))
    assert abs(np.mean(like) - 900 / 1100) < 0.03


# ------------------------------------------------------------------ repeats
def removed(texts, least=repeats.LEAST):
    data = [(t or "").encode() for t in texts]
    seen = collections.Counter(b[i:i + least] for b in data for i in range(len(b) - least + 1))
    out = []
    for b in data:
        gone = bytearray(len(b))
        for i in range(len(b) - least + 1):
            if seen[b[i:i + least]] > 1:
                gone[i:i + least] = b"\1" * least
        runs = sum(1 for i in range(len(b)) if gone[i] and not (i and gone[i - 1]))
        out.append((len(b), sum(gone), runs, hashlib.sha256(bytes(c for c, g in zip(b, gone, strict=True) if not g)).hexdigest()))
    return out


def repeat_rows():
    rng = random.Random(3)
    noise = lambda n: "".join(rng.choice("abcdefgh ") for _ in range(n))
    shared = [noise(rng.choice([150, 199, 200, 201, 230, 400, 700])) for _ in range(8)]
    rows = []
    for i in range(90):
        parts = [rng.choice([noise(rng.randrange(300)), rng.choice(shared), rng.choice(shared)[rng.randrange(50):],
                             rng.choice(shared)[:-1 - rng.randrange(60)]]) for _ in range(rng.randrange(5))]
        rows.append((i, "".join(parts)))
    return rows + [(200, "a" * 199), (201, "a" * 200), (202, "a" * 201), (203, "ab" * 300), (204, None), (205, ""),
                   (None, shared[0] * 2), (206, shared[5] + "é" * 150), (206, shared[5] + "é" * 150), (207, "\0" * 450),
                   (208, "x" * 210 + "\0" * 3), (209, "x" * 210 + "\0" * 5)]


@pytest.mark.parametrize("large", [repeats.LARGE, 1])
def test_repeats_equal_brute_force(spark, monkeypatch, large):
    monkeypatch.setattr(repeats, "LARGE", large)
    rows = repeat_rows()
    got = repeats.remove_repeats(frame(spark, rows)).collect()
    want = collections.Counter((k, *x) for (k, _), x in zip(rows, removed([t for _, t in rows]), strict=True))
    assert collections.Counter(tuple(r) for r in got) == want


def test_repeats_of_nothing(spark):
    assert repeats.remove_repeats(frame(spark, [])).count() == 0


def test_maximal_repeats_have_all_occurrences():
    import numpy as np
    rng = random.Random(5)
    core = "".join(rng.choice("xyz") for _ in range(230)).encode()
    contexts = [b"1" + core + b"A", b"2" + core + b"B", b"3" + core[:210] + b"C" * 30]
    owned = np.array([len(c) - 199 for c in contexts])
    got = {(n, frozenset(p)) for n, p in repeats.maximal_repeats(contexts, owned)}
    assert got == {(230, frozenset({(0, 1), (1, 1)})), (210, frozenset({(0, 1), (1, 1), (2, 1)}))}


def test_bpe_worker_holds_few_words_and_small_batches():
    """An executor's memory counts its workers: what one holds between and within batches is bounded."""
    import pandas as pd

    b = bpe.Bpe(bpe.read_spec(bpe.default_vocabulary()))
    texts = [" ".join(f"w{chr(97 + n)}{i}" for i in range(40_000)) for n in range(3)]
    first = [list(b.written([t]))[0][0] for t in texts]
    assert len(b.ids_of) <= 60_000 and len(b.names_of) <= 60_000
    assert [list(b.written([t]))[0][0] for t in texts] == first  # words that were dropped are encoded again
    rows = pd.DataFrame({"doc_id": range(8), "text": ["x" * 500_000] * 8})
    parts = list(bpe.small_batches(iter([rows])))
    assert max(p["text"].str.len().sum() for p in parts) <= 1_000_000 and [i for p in parts for i in p["doc_id"]] == list(range(8))
