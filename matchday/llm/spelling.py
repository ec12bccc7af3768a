"""Spelling variant grouping by dynamic programming over the sorted vocabulary.

Words are the maximal runs ``[A-Za-z\\u00C0-\\u00FF]+`` of the texts, A-Z lower-cased. So that
rare misspellings are among them, one run in ``EVERY`` loses a letter: where ``EVERY`` divides
the crc32 of ``<doc_id>:<run>``, the code point at crc32 % length goes. The vocabulary is the
words of ``LEAST`` or more code points that occur ``OCCURS`` times or more. Two words are near
if one inserted, deleted or replaced code point makes one the other. A word's form is its near
word of largest count, if that count is ``TIMES`` times its own; its root is where the forms lead.

Of two near words the shared prefix or the shared suffix holds half of the query's code points.
So the vocabulary is scanned twice, sorted as it is and sorted by the reversed words, and a
query only looks at the words that share its first half (pairs that share it both ways count in
the first scan). The sorted list is cut by range into blocks; a query goes to the blocks which
its half touches and whose common prefix is within one edit. In a block, neighbours' longest
common prefixes (LCP) cut the list into ranges that share a prefix: the edit matrix's row for
that prefix, three cells about the diagonal, is computed once for the range and reused by every
word in it, and a range whose row exceeds one edit is skipped whole. All queries of a block
advance together, so a step is a few array operations over (query, range) pairs.

Sizes: a block holds ``PER_BLOCK`` words (more only beyond ``MOST_BLOCKS`` blocks, whose first
and last 64 letters are all that goes to the driver); a block that many queries visit is dealt
out with its list over several tasks. Words are counted inside the tasks that read the texts
before they are shuffled, so a frequent word is a few rows. A task's counts are given on
whenever ``HELD`` different words are held.

Cases: a null or empty text has no words; texts and words of any length are read whole; a null
id reads as the empty text in the crc32; repeated rows count again; an empty table, or one
without such words, gives an empty result; other columns are not read.
"""

from __future__ import annotations

import re
import zlib
from bisect import bisect_left, bisect_right
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._util import discarded, staged

LEAST, OCCURS, TIMES, EVERY = 7, 2, 10, 31
PER_BLOCK, MOST_BLOCKS, SHOWN = 40_000, 4096, 64
HELD, AT_ONCE = 500_000, 20_000
RUN = re.compile(f"[A-Za-zÀ-ÿ]{{{LEAST},}}")
LAST = chr(0x10FFFF)


def words_of(doc_id: object, text: str) -> Iterator[str]:
    """The words of a text that are long enough (a run that is too short cannot grow)."""
    begun = zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode())
    for run in RUN.findall(text.encode("utf-8", "surrogatepass").lower().decode("utf-8", "surrogatepass")):
        h = zlib.crc32(run.encode(), begun)
        if h % EVERY == 0:
            at = h % len(run)
            run = run[:at] + run[at + 1:]
            if len(run) < LEAST:
                continue
        yield run


def vocabulary(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``(word, n)`` of the words that occur ``OCCURS`` times or more."""
    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: Counter = Counter()
        for b in batches:
            for k, t in zip(b["k"], b["t"], strict=True):
                held.update(words_of(k, t))
                if len(held) > HELD:
                    yield pd.DataFrame(held.items(), columns=["word", "n"])
                    held.clear()
        if held:
            yield pd.DataFrame(held.items(), columns=["word", "n"])

    return (docs.where(F.col(text).isNotNull()).select(F.col(key).cast("string").alias("k"), F.col(text).alias("t"))
            .mapInPandas(count, "word string, n long")
            .groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= OCCURS))


def half(word: str) -> int:
    """So many code points of a word are shared, first or last, with every word near it."""
    return len(word) // 2


def edges_alive(prefix: str, word: str, at: int) -> bool:
    """Whether some word that starts with ``prefix`` may be within one edit of ``word``; they share ``at`` letters."""
    row = (1, 0, 1)
    for d in range(at, len(prefix)):
        c, n = prefix[d], len(word)
        low = min(row[1] + 1, row[0] + (d - 1 < 0 or d > n or c != word[d - 1]))
        mid = min(row[2] + 1, row[1] + (d >= n or c != word[d]), low + 1) if d < n else 2
        high = min(row[2] + (d + 1 >= n or c != word[d + 1]), mid + 1) if d + 1 < n else 2
        row = (low if d <= n else 2, mid, high)
        if min(row) > 1:
            return False
    return True


def shared(a: str, b: str) -> int:
    n = min(len(a), len(b))
    return next((i for i in range(n) if a[i] != b[i]), n)


class Letters:
    """The code points of many words in one array."""

    def __init__(self, words: list[str]):
        self.size = np.fromiter(map(len, words), np.int64, len(words))
        self.start = np.cumsum(self.size) - self.size
        flat = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32)
        self.flat = np.append(flat, np.uint32(0))

    def at(self, word: np.ndarray, place: np.ndarray) -> np.ndarray:
        """Code points; 0 where a word has none at that place."""
        inside = (place >= 0) & (place < self.size[word])
        return np.where(inside, self.flat[np.where(inside, self.start[word] + place, len(self.flat) - 1)], 0)


def neighbour_lcp(letters: Letters, n: int) -> np.ndarray:
    """The common prefix of each sorted word with the one before it (0 for the first)."""
    out = np.zeros(n, np.int64)
    live = np.arange(1, n)
    while len(live):
        a = letters.at(live, out[live])
        live = live[(a == letters.at(live - 1, out[live])) & (a != 0)]
        out[live] += 1
    return out


def near_in_list(listed: list[str], asked: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """``(query, position)`` of each pair of a query and a word of the sorted list that differ by
    exactly one edit and share the query's first half."""
    words, queries = Letters(listed), Letters(asked)
    n = len(listed)
    lcp = neighbour_lcp(words, n)
    # where ranges of a depth are cut: ordered by depth, then position
    cuts = np.sort(lcp * (n + 1) + np.arange(n))
    found_q, found_w = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for begin in range(0, len(asked), AT_ONCE):
        some = asked[begin:begin + AT_ONCE]
        q = np.arange(begin, begin + len(some))
        d = queries.size[q] // 2
        lo = np.fromiter((bisect_left(listed, w[:half(w)]) for w in some), np.int64, len(some))
        hi = np.fromiter((bisect_right(listed, w[:half(w)] + LAST) for w in some), np.int64, len(some))
        row = np.tile(np.array([1, 0, 1], np.int8), (len(some), 1))
        while True:
            some = lo < hi
            q, d, lo, hi, row = q[some], d[some], lo[some], hi[some], row[some]
            if not len(q):
                break
            # the word that ends here is the first of its range: its distance stands in the query's last column
            ends = words.size[lo] == d
            last = queries.size[q] - d
            hit = ends & (np.abs(last) <= 1)
            hit[hit] = row[hit, last[hit] + 1] == 1
            found_q.append(q[hit])
            found_w.append(lo[hit])
            lo = lo + ends
            some = lo < hi
            q, d, lo, hi, row = q[some], d[some], lo[some], hi[some], row[some]
            # cut each range by its words' next letter
            first = np.searchsorted(cuts, d * (n + 1) + lo, "right")
            parts = np.searchsorted(cuts, d * (n + 1) + hi, "left") - first + 1
            each = np.repeat(np.arange(len(q)), parts)
            turn = np.arange(len(each)) - np.repeat(np.cumsum(parts) - parts, parts)
            left = np.where(turn == 0, lo[each], cuts[np.minimum(first[each] + turn - 1, n - 1)] % (n + 1))
            right = np.where(turn == parts[each] - 1, hi[each], cuts[np.minimum(first[each] + turn, n - 1)] % (n + 1))
            q, d, row = q[each], d[each], row[each]
            c = words.at(left, d)
            size = queries.size[q]
            low = np.minimum(row[:, 1] + 1, row[:, 0] + (c != queries.at(q, d - 1)))
            mid = np.minimum(np.minimum(row[:, 2] + 1, row[:, 1] + (c != queries.at(q, d))), low + 1)
            high = np.minimum(row[:, 2] + (c != queries.at(q, d + 1)), mid + 1)
            row = np.stack([np.where(d <= size, low, 2), np.where(d + 1 <= size, mid, 2),
                            np.where(d + 2 <= size, high, 2)], axis=1).clip(0, 2).astype(np.int8)
            some = row.min(axis=1) <= 1
            q, d, lo, hi, row = q[some], d[some] + 1, left[some], right[some], row[some]
    return np.concatenate(found_q), np.concatenate(found_w)


def near_words(words: DataFrame, backwards: bool, per_block: int = PER_BLOCK) -> DataFrame:
    """``(word, n_near, best_n, best)``: partial results of one scan, for the words with a near word."""
    spark = words.sparkSession
    total = words.count()
    number = int(min(MOST_BLOCKS, max(1, -(-total // per_block))))
    room = max(per_block, -(-total // number))
    turned = words.select((F.reverse("word") if backwards else F.col("word")).alias("key"), "n")
    blocks = staged(turned.repartitionByRange(number, "key").withColumn("block", F.spark_partition_id()), "sorted")
    # at most MOST_BLOCKS rows of two cut words
    ends = sorted(blocks.groupBy("block").agg(F.min(F.substring("key", 1, SHOWN)).alias("lo"),
                                              F.max(F.substring("key", 1, SHOWN)).alias("hi")).collect(), key=lambda r: r.lo)
    ids, lows, highs = [r.block for r in ends], [r.lo for r in ends], [r.hi for r in ends]
    common = [a[:shared(a, b)] for a, b in zip(lows, highs, strict=True)]

    def route(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = []
            for key, n, own in zip(b["key"], b["n"], b["block"], strict=True):
                start = key[:half(key)][:SHOWN]
                for i in range(bisect_left(highs, start), bisect_right(lows, start + LAST)):
                    if ids[i] == own or edges_alive(common[i], key, min(len(start), shared(common[i], key))):
                        out.append((ids[i], key, n, ids[i] == own))
            yield pd.DataFrame(out, columns=["block", "key", "n", "own"])

    routed = staged(blocks.mapInPandas(route, "block int, key string, n long, own boolean"), "routed")
    discarded(blocks)
    # at most MOST_BLOCKS rows
    tasks = F.broadcast(routed.groupBy("block").agg(F.ceil(F.count(F.lit(1)) / (4 * room)).cast("int").alias("tasks")))
    dealt = F.pmod(F.xxhash64("key"), F.col("tasks")).cast("int")
    copies = F.when(F.col("own"), F.sequence(F.lit(0), F.col("tasks") - 1)).otherwise(F.array(dealt))
    placed = (routed.join(tasks, "block").withColumn("home", dealt).withColumn("task", F.explode(copies))
              .select("block", "task", "key", "n", "own", (F.col("home") == F.col("task")).alias("asks")))

    def scan(g: pd.DataFrame) -> pd.DataFrame:
        mine = g[g["own"]].sort_values("key")
        listed, counts = mine["key"].tolist(), mine["n"].to_numpy()
        asked = g.loc[g["asks"], "key"].tolist()
        q, w = near_in_list(listed, asked)
        if backwards:  # what the words share in front too has been counted in the other scan
            new = np.fromiter((asked[i][::-1][:half(asked[i])] != listed[j][::-1][:half(asked[i])]
                               for i, j in zip(q.tolist(), w.tolist(), strict=True)), bool, len(q))
            q, w = q[new], w[new]
        turn = -1 if backwards else 1
        pairs = pd.DataFrame({"word": [asked[i][::turn] for i in q.tolist()], "best": [listed[j][::turn] for j in w.tolist()],
                              "best_n": counts[w]})
        pairs = pairs.sort_values(["word", "best_n", "best"], ascending=[True, False, True])
        best = pairs.drop_duplicates("word")
        size = pairs.groupby("word", sort=False).size()
        return best.assign(n_near=size.reindex(best["word"]).to_numpy().astype("int64"))[["word", "n_near", "best_n", "best"]]

    return placed.groupBy("block", "task").applyInPandas(scan, "word string, n_near long, best_n long, best string")


def roots(forms: DataFrame) -> DataFrame:
    """``(word, root)`` of the words that have a form: each step doubles how far a word has
    followed. Counts grow tenfold from word to form, so a few steps reach every end."""
    at = staged(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        then = at.select(F.col("word").alias("root"), F.col("root").alias("over"))
        far = staged(at.join(then, "root", "left").select("word", F.coalesce("over", "root").alias("root"),
                                                          F.col("over").isNotNull().alias("moved")), "roots")
        if far.where("moved").isEmpty():
            return far.select("word", "root")
        at = far.select("word", "root")


def spelling_variants(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``(word, form, root, n, n_near, form_n)``, one row per word of the vocabulary."""
    words = staged(vocabulary(docs, key, text), "words")
    both = near_words(words, False).unionByName(near_words(words, True))
    # largest count first, then the smallest word: of equal counts the least negative pair
    near = both.groupBy("word").agg(F.sum("n_near").alias("n_near"),
                                    F.min(F.struct((-F.col("best_n")).alias("less"), "best")).alias("top"))
    seen = staged(words.join(near, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(-F.col("top.less") >= TIMES * F.col("n"), F.col("top.best")).alias("form"),
        F.when(-F.col("top.less") >= TIMES * F.col("n"), -F.col("top.less")).alias("form_n")), "near")
    led = roots(seen.where(F.col("form").isNotNull()))
    return (seen.join(led, "word", "left")
            .select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"))
