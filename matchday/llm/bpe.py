"""BPE encoding and decoding with a public vocabulary, merges found in a rank array.

Words are merged in a contiguous array: part boundaries next to the rank of each
adjacent pair. The smallest rank (leftmost on ties) is found by scanning, its
inner boundary is deleted and only the two neighbouring ranks are looked up
again. Words longer than ``SCAN_PARTS`` bytes, for which the scan would be
quadratic, run the same merges from a heap of (rank, position): same result.

The vocabulary file (format: ``tokenizers`` JSON with a ``BPE`` model) is read
on the driver from the path given and broadcast (one file, under 2 MB); a
Python worker parses it once and keeps an encoded form of the words it has met; when
``CACHE_WORDS`` are held, those that the batch at hand does not use are dropped (a bound
on memory, not on results).
Text is normalised as the file says: NFC, white space runs to one space, lower
case by character; special tokens in a text are taken as themselves.

Documents are independent: one narrow ``mapInPandas``, no shuffle; a very long
text is one row of one task and costs time in proportion to its length. A null
or empty text gives no ids. Rows with null or repeated ids are each encoded.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import re
import sys
import unicodedata
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SCAN_PARTS = 256
CACHE_WORDS = 60_000
CACHED_LENGTH = 64
NO_RANK = np.iinfo(np.int32).max
ARRAY_CELLS = 1 << 20

# The white space of Unicode, which the file's `\s+` stands for.
SPACE = "\t\n\x0b\x0c\r \x85\xa0  -     　"
SPACES = re.compile(f"[{SPACE}]+")
LATIN = re.compile("[!-\u024f]+")
# str.split() also cuts at these, which are no white space of Unicode
ODD = re.compile("[\x1c-\x1f]")


def byte_letters() -> list[str]:
    """The printable stand-in of each byte: printable bytes stand for themselves, the
    others are numbered from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(rest)) for b in range(256)]


def split_pattern(pattern: str) -> str:
    """The file's splitting pattern with ``\\p{L}``, ``\\p{N}`` and ``\\s`` written out as ranges."""
    kinds: dict[str, list[list[int]]] = {"L": [], "N": []}
    for c in range(sys.maxunicode + 1):
        found = kinds.get(unicodedata.category(chr(c))[0])
        if found is not None:
            if found and found[-1][1] == c - 1:
                found[-1][1] = c
            else:
                found.append([c, c])
    for k, ranges in kinds.items():
        pattern = pattern.replace(f"[\\p{{{k}}}]", f"\\p{{{k}}}")
        inside = "".join(f"\\U{a:08x}-\\U{b:08x}" for a, b in ranges)
        pattern = pattern.replace(f"\\p{{{k}}}]", inside + "]").replace(f"\\s\\p{{{k}}}", f"\\s{inside}")
        pattern = pattern.replace(f"\\p{{{k}}}", f"[{inside}]")
    return pattern.replace("\\s", SPACE)


class Bpe:
    """Encoder and decoder of one vocabulary file's text."""

    def __init__(self, spec: str):
        data = json.loads(spec)
        model = data["model"]
        self.vocab: dict[str, int] = model["vocab"]
        self.names = {i: t for t, i in self.vocab.items()}
        self.end = model.get("end_of_word_suffix") or ""
        # a pair's rank, and what the rank makes of it
        self.ranks = {(self.vocab[a], self.vocab[b]): rank for rank, (a, b) in enumerate(model["merges"])}
        self.made = np.array([self.vocab[a + b] for a, b in model["merges"]], np.int32)
        self.span = max(self.vocab.values()) + 1
        packed = np.array([a * self.span + b for a, b in self.ranks], np.int64)
        order = np.argsort(packed)
        self.pairs, self.pair_rank = packed[order], np.array(list(self.ranks.values()), np.int32)[order]
        letters = byte_letters()
        self.first = np.array([self.vocab[c] for c in letters], np.int32)
        self.last = np.array([self.vocab[c + self.end] for c in letters], np.int32)
        self.specials = {t["content"]: t["id"] for t in data["added_tokens"]}
        self.names |= {i: t for t, i in self.specials.items()}
        self.numbers = {i: str(i) for i in self.names}
        self.special = re.compile("|".join(map(re.escape, sorted(self.specials, key=len, reverse=True))) or "(?!)")
        pattern = next(p["pattern"]["Regex"] for p in data["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")
        self.pattern = re.compile(split_pattern(pattern))
        self.bytes = {c: b for b, c in enumerate(letters)}
        self.spec, self.tables = spec, None
        self.ids_of: dict[str, str] = {}
        self.names_of: dict[str, str] = {}

    def pair_ranks(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Ranks of pairs of ids; ``NO_RANK`` for a pair that no merge names or that holds a -1."""
        pair = a.astype(np.int64) * self.span + b
        at = np.minimum(np.searchsorted(self.pairs, pair), len(self.pairs) - 1)
        return np.where((self.pairs[at] == pair) & (a >= 0) & (b >= 0), self.pair_rank[at], NO_RANK)

    def merge_equal(self, words: list[bytes], width: int) -> list[list[int]]:
        """Ids of words of 1 to ``width`` bytes, one row of the arrays for each word.

        ``ids`` holds the parts and ``ranks`` the rank of each adjacent pair, both packed to the
        left. Each turn scans every row for its smallest rank, deletes that boundary and looks up
        the two ranks beside it; rows without a rank left are done.
        """
        n = len(words)
        sizes = np.fromiter(map(len, words), np.int64, n)
        flat = np.frombuffer(b"".join(words), np.uint8)
        row = np.repeat(np.arange(n), sizes)
        ids = np.full((n, width + 1), -1, np.int32)
        ids[row, np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = self.first[flat]
        ids[np.arange(n), sizes - 1] = self.last[flat[np.cumsum(sizes) - 1]]
        ranks = self.pair_ranks(ids[:, :-1], ids[:, 1:])
        left, out = np.arange(n), [None] * n
        while True:
            i = ranks.argmin(axis=1)
            low = ranks[np.arange(len(left)), i]
            done = low == NO_RANK
            if done.any():
                for k, r in zip(left[done].tolist(), ids[done].tolist(), strict=True):
                    out[k] = r[:r.index(-1)]
                keep = ~done
                left, ids, ranks, i, low = left[keep], ids[keep], ranks[keep], i[keep], low[keep]
                if not len(left):
                    return out
            each, column = np.arange(len(left)), np.arange(ranks.shape[1] - 1)
            ids[each, i] = self.made[low]
            ids = np.take_along_axis(ids, np.arange(ids.shape[1] - 1) + (np.arange(ids.shape[1] - 1) > i[:, None]), 1)
            ranks = np.take_along_axis(ranks, column + (column >= i[:, None]), 1)
            has = i > 0
            ranks[each[has], i[has] - 1] = self.pair_ranks(ids[each[has], i[has] - 1], ids[each[has], i[has]])
            has = i < ranks.shape[1]
            ranks[each[has], i[has]] = self.pair_ranks(ids[each[has], i[has]], ids[each[has], i[has] + 1])

    def merge_all(self, words: list[bytes]) -> list[list[int]]:
        """Ids of each word: words of like length share the arrays."""
        out: list[list[int]] = [[]] * len(words)
        by: dict[int, list[int]] = {}
        for k, w in enumerate(words):
            by.setdefault(max(8, 1 << (len(w) - 1).bit_length()) if w else 0, []).append(k)
        for width, rows in by.items():
            if width > SCAN_PARTS:
                found = [self.merge_long(words[k]) for k in rows]
            else:
                step = max(1, ARRAY_CELLS // max(width, 1))
                found = [x for at in range(0, len(rows), step) if width
                         for x in self.merge_equal([words[k] for k in rows[at:at + step]], width)]
            for k, x in zip(rows, found, strict=width > 0):
                out[k] = x
        return out

    def merge_long(self, word: bytes) -> list[int]:
        """The same merges from a heap, for words too long to scan again and again."""
        ids = [*self.first[list(word[:-1])].tolist(), int(self.last[word[-1]])]
        n = len(ids)
        after, before, gone = list(range(1, n + 1)), list(range(-1, n - 1)), [False] * n
        of = self.ranks.get
        heap = [(r, i, ids[i], ids[i + 1]) for i in range(n - 1) if (r := of((ids[i], ids[i + 1]))) is not None]
        heapq.heapify(heap)
        while heap:
            rank, i, a, b = heapq.heappop(heap)
            j = after[i]
            if gone[i] or ids[i] != a or j >= n or ids[j] != b:
                continue
            ids[i], gone[j], after[i] = int(self.made[rank]), True, after[j]
            if after[j] < n:
                before[after[j]] = i
            for x, y in ((before[i], i), (i, after[i])):
                if x >= 0 and y < n and (r := of((ids[x], ids[y]))) is not None:
                    heapq.heappush(heap, (r, x, ids[x], ids[y]))
        return [x for x, dead in zip(ids, gone, strict=True) if not dead]

    def chunk_words(self, chunk: str) -> list[bytes]:
        """Words of a run of text without white space, not yet normalised."""
        if not LATIN.fullmatch(chunk):
            return self.other_words(chunk)
        if chunk.isascii():
            return self.words(chunk.lower())
        return self.words("".join([c.lower() for c in unicodedata.normalize("NFC", chunk)]))  # by character

    def chunk_ids(self, chunks: list[str]) -> list[list[int]]:
        """Ids of runs of text without white space."""
        split = [self.chunk_words(c) for c in chunks]
        at = {w: None for words in split for w in words}
        at = dict(zip(at, self.merge_all(list(at)), strict=True))
        return [at[words[0]] if len(words) == 1 else [i for w in words for i in at[w]] for words in split]

    def words(self, low: str) -> list[bytes]:
        return [w.encode() for w in ([low] if low.isalpha() else self.pattern.findall(low))]

    def other_words(self, chunk: str) -> list[bytes]:
        """Words of a chunk beyond Latin letters: normalised and split with the Unicode tables
        of the ``tokenizers`` library, whose versions differ from Python's."""
        from tokenizers import Tokenizer
        if self.tables is None:
            self.tables = Tokenizer.from_str(self.spec)
        words = self.tables.pre_tokenizer.pre_tokenize_str(self.tables.normalizer.normalize_str(chunk))
        return [bytes(self.bytes[c] for c in w) for w, _ in words]

    def chunks(self, text: str) -> Iterator[tuple[list[str], int | None]]:
        """Runs without white space up to each special token, and its id (None at the end)."""
        at = 0
        for m in self.special.finditer(text):
            yield self.pieces(text[at:m.start()]), self.specials[m[0]]
            at = m.end()
        yield self.pieces(text[at:]), None

    @staticmethod
    def pieces(text: str) -> list[str]:
        if ODD.search(text):
            return [p for p in SPACES.split(text) if p]
        return text.split()

    def encode(self, text: str | None) -> list[int]:
        out = []
        for pieces, special in self.chunks(text or ""):
            for ids in self.chunk_ids(pieces):
                out += ids
            if special is not None:
                out.append(special)
        return out

    def decode(self, ids: Iterable[int]) -> str:
        """As the file's missing decoder says: the tokens joined by spaces."""
        return " ".join([self.names[i] for i in ids])

    def written(self, texts: Iterable[str | None]) -> Iterator[tuple[str, str]]:
        """Of each text, the ids as decimals and the decoded text, each joined by one space.

        Runs of text met before are looked up; the new ones of a batch are merged together.
        """
        split = [list(self.chunks(t or "")) for t in texts]
        ids_of, names_of, number, name = self.ids_of, self.names_of, self.numbers, self.names
        met = set().union(*(pieces for parts in split for pieces, _ in parts))
        new = [p for p in met if p not in ids_of]
        if len(ids_of) + len(new) > CACHE_WORDS:  # keep what this batch asks for: the frequent ones
            ids_of = self.ids_of = {p: ids_of[p] for p in met if p in ids_of}
            names_of = self.names_of = {p: names_of[p] for p in ids_of}
        for p, own in zip(new, self.chunk_ids(new), strict=True):
            ids_of[p] = " ".join([number[i] for i in own])
            names_of[p] = " ".join([name[i] for i in own])
        for parts in split:
            ids, names = [], []
            for pieces, special in parts:
                ids += [x for p in pieces if (x := ids_of[p])]
                names += [x for p in pieces if (x := names_of[p])]
                if special is not None:
                    ids.append(number[special])
                    names.append(name[special])
            yield " ".join(ids), " ".join(names)
        for p in new:
            if len(p) > CACHED_LENGTH:
                del ids_of[p], names_of[p]


_LOADED: dict[str, Bpe] = {}


def loaded(spec: str) -> Bpe:
    """The worker's encoder for a vocabulary, parsed once."""
    key = hashlib.sha256(spec.encode()).hexdigest()
    if key not in _LOADED:
        _LOADED.clear()
        _LOADED[key] = Bpe(spec)
    return _LOADED[key]


def default_vocabulary() -> str:
    import public_tokenizers
    return public_tokenizers.path("word_bpe_49k.json")


def read_spec(path: str) -> str:
    with open(path, encoding="utf-8") as f:
        return f.read()


def small_batches(batches: Iterator[pd.DataFrame], chars: int = 1_000_000) -> Iterator[pd.DataFrame]:
    """The same rows in order, cut so that a batch holds about ``chars`` characters or one row."""
    for b in batches:
        part = b["text"].str.len().cumsum() // chars
        for _, rows in b.groupby(part, sort=False):
            yield rows


def encode_documents(docs: DataFrame, path: str | None = None, key: str = "doc_id", text: str = "text",
                     with_ids: bool = False) -> DataFrame:
    """``(doc_id, n_tokens, ids_sha256, decoded_sha256[, ids])`` for every row."""
    spark = docs.sparkSession
    spec = spark.sparkContext.broadcast(read_spec(path or default_vocabulary()))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        bpe = loaded(spec.value)
        for b in small_batches(batches):
            rows = {"doc_id": b["doc_id"], "n_tokens": [], "ids_sha256": [], "decoded_sha256": []}
            ids = []
            for a, d in bpe.written(b["text"]):
                rows["n_tokens"].append(a.count(" ") + 1 if a else 0)
                rows["ids_sha256"].append(hashlib.sha256(a.encode()).hexdigest())
                rows["decoded_sha256"].append(hashlib.sha256(d.encode("utf-8", "surrogatepass")).hexdigest())
                if with_ids:
                    ids.append([int(i) for i in a.split()])
            yield pd.DataFrame(rows | ({"ids": ids} if with_ids else {}))

    kind = docs.schema[key].dataType.simpleString()
    schema = f"doc_id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids array<int>" * with_ids
    return (docs.select(F.col(key).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
            .mapInPandas(run, schema))
