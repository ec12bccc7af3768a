"""Sharding by sampled splitters: shards of near equal bytes, range-partitioned.

1. Every row gets a key: a hash of its text (upper 40 bits) with a hash of the whole row (lower
   24 bits). In key order equal texts stand together, and a group of copies that holds a third
   of all rows can still be cut inside.
2. A size-weighted sample is drawn by hash: a row of size s is drawn s * SAMPLED * ranges /
   total times on average (a large row several times). Its quantiles are the splitters of the
   ranges, of which there are ``RANGES`` a shard, and one per ``PER_RANGE`` rows if those are more.
3. Rows and bytes of every range are counted. A range of over ``OVERFULL`` times its share of rows
   or bytes is subdivided: by splitters of a denser sample of its own, or, when all its rows have
   one key, by slices of a hash of the rows' places. That repeats until none is overfull (a
   single row may be).
4. A range knows the bytes and rows before it; its rows are numbered in its own task. The row
   whose middle byte lies in the i-th equal part of all bytes is in shard i, so a shard's size is
   its share to within its two outermost rows; a shard's rows count from slot 0.

Only splitters and counts of ranges go to the driver: at most ``MOST_RANGES`` of them plus the
subdivisions, and ``SAMPLED`` sampled keys each. No range depends on one frequent text or id, and
the counts are combined before they are shuffled.

Cases: the size is the text's bytes in UTF-8 plus 1, so a null or empty text counts 1; a very
long text is one row of its shard; rows that are equal in every column are interchangeable; null
ids are ids like any; fewer rows than shards leave shards empty; an empty table gives an empty
result. Columns named in ``carry`` go along, those named as in ``OUT`` not; names that start with two
underscores are reserved.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ._util import staged

OUT = ("size", "text_crc32", "law", "shard", "slot", "grown_shard")
SHARDS, RANGES, SAMPLED, PER_RANGE, MOST_RANGES, OVERFULL, ROUNDS = 8, 16, 32, 200_000, 8192, 3, 8
LOW = (1 << 24) - 1
PARTS = 1 << 16  # slices of the place hash


class Ranges:
    """Splitters of the keys in rising order; a range of one key may be cut further into slices of
    the place hash. Range ``i`` begins at ``(keys[i], slices[i])``."""

    def __init__(self, starts: set[tuple[int, int]]):
        self.starts = sorted(starts | {(-2 ** 63, 0)})
        self.keys = np.array([k for k, _ in self.starts], np.int64)
        self.slices = np.array([s for _, s in self.starts], np.int64)

    def of(self, key: np.ndarray, part: np.ndarray) -> np.ndarray:
        at = np.searchsorted(self.keys, key, "right") - 1  # the last range that begins at or before the key
        first = np.searchsorted(self.keys, key, "left")
        for k in np.unique(key[first < at]):  # several ranges begin at this key: the slice tells
            some = np.flatnonzero(key == k)
            lo, hi = first[some[0]], at[some[0]] + 1
            at[some] = lo + np.searchsorted(self.slices[lo:hi], part[some], "right") - 1
        return at


def drawn(rate: Column, salt: int) -> Column:
    """How often a row is drawn: its size times ``rate``, rounded up or down by hash."""
    u = F.pmod(F.xxhash64("__k", "__m", F.lit(salt)), F.lit(1 << 30)) / float(1 << 30)
    return F.floor(F.col("size") * rate + u).cast("int").alias("w")


def quantiles(keys: Sequence[int], weights: Sequence[int], parts: int) -> set[tuple[int, int]]:
    """Starts of ``parts`` ranges of equal weight; a key that fills a range has one of its own."""
    order = np.argsort(keys, kind="stable")
    k = np.repeat(np.array(keys, np.int64)[order], np.array(weights, np.int64)[order])
    if not len(k):
        return set()
    cuts = k[(np.arange(1, parts) * len(k)) // parts]
    hot = {int(x) for x in cuts[1:][cuts[1:] == cuts[:-1]]}
    return {(int(x), 0) for x in cuts} | {(x + 1, 0) for x in hot if x < 2 ** 63 - 1}


def in_ranges(rows: DataFrame, ranges: Ranges) -> DataFrame:
    @F.pandas_udf("int")
    def of(key: pd.Series, part: pd.Series) -> pd.Series:
        return pd.Series(ranges.of(key.to_numpy(np.int64), part.to_numpy(np.int64)).astype(np.int32))

    return rows.withColumn("__range", of("__k", F.pmod(F.xxhash64("__m"), F.lit(PARTS))))


def counted(rows: DataFrame, ranges: Ranges) -> dict[int, tuple[int, int, int, int]]:
    """Of each range: rows, bytes, smallest and largest key (as many rows as there are ranges)."""
    got = (in_ranges(rows.select("__k", "__m", "size"), ranges).groupBy("__range")
           .agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("b"), F.min("__k").alias("lo"), F.max("__k").alias("hi")).collect())
    return {r["__range"]: (r.n, r.b, r.lo, r.hi) for r in got}


def balanced(rows: DataFrame, n: int, total: int, shards: int, per_range: int = PER_RANGE) -> tuple[Ranges, dict]:
    """Ranges of which none is overfull, and their counts."""
    number = min(MOST_RANGES, max(shards * RANGES, -(-n // per_range)))
    sample = rows.select("__k", drawn(F.lit(number * SAMPLED / max(total, 1)), 0)).where("w > 0").collect()
    ranges = Ranges(quantiles([r["__k"] for r in sample], [r.w for r in sample], number))
    counts = counted(rows, ranges)
    for turn in range(1, ROUNDS + 1):
        fill = {i: max(c[0] * number / n, c[1] * number / total) for i, c in counts.items() if c[0] > 1}
        over = {i: int(2 * f) for i, f in fill.items() if f > OVERFULL}
        if not over:
            break
        starts = set(ranges.starts)
        mixed = [i for i in over if counts[i][2] < counts[i][3]]
        if mixed:
            rates = F.create_map(*[F.lit(x) for i in mixed for x in (i, over[i] * SAMPLED / counts[i][1])])
            more = (in_ranges(rows.select("__k", "__m", "size"), ranges).where(F.col("__range").isin(mixed))
                    .select("__range", "__k", drawn(F.element_at(rates, F.col("__range")), turn)).where("w > 0").collect())
            for i in mixed:
                of = [r for r in more if r["__range"] == i]
                starts |= quantiles([r["__k"] for r in of], [r.w for r in of], over[i])
        for i in set(over) - set(mixed):  # one key: a range of its own, cut into slices
            k, parts = counts[i][2], min(over[i], PARTS)
            starts |= {(k, PARTS * s // parts) for s in range(parts)} | ({(k + 1, 0)} if k < 2 ** 63 - 1 else set())
        if starts == set(ranges.starts):
            break
        ranges = Ranges(starts)
        counts = counted(rows, ranges)
    return ranges, counts


def shard_rows(docs: DataFrame, shards: int = SHARDS, key: str = "doc_id", text: str = "text", carry: Sequence[str] = (),
               per_range: int = PER_RANGE) -> DataFrame:
    """``(key, *carry, *OUT)``, one row per row of ``docs``."""
    spark = docs.sparkSession
    cols = [c for c in carry if c not in (key, *OUT)]
    body = F.coalesce(F.col(text), F.lit("")).cast("binary")
    row_hash = F.xxhash64(*[F.col(c) for c, kind in docs.dtypes if "map<" not in kind and "variant" not in kind])
    k = F.xxhash64(body).bitwiseAND(F.lit(~LOW)).bitwiseOR(row_hash.bitwiseAND(F.lit(LOW)))
    rows = staged(docs.select(key, *cols, (F.octet_length(body) + 1).cast("long").alias("size"), F.crc32(body).alias("text_crc32"),
                              k.alias("__k"), row_hash.alias("__h")).withColumn("__m", F.monotonically_increasing_id()), "rows")
    about = rows.agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("b")).first()
    n, total = about.n, about.b or 1
    ranges, counts = balanced(rows, n, total, shards, per_range) if n else (Ranges(set()), {})
    before, at = [], (0, 0)
    for i in sorted(counts):
        before.append((i, *at))
        at = (at[0] + counts[i][0], at[1] + counts[i][1])
    # as many rows as there are ranges
    offsets = F.broadcast(spark.createDataFrame(before, "__range int, __rows long, __bytes long"))
    w = Window.partitionBy("__range").orderBy("__k", "__h", "__m")
    upto = F.sum("size").over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow)) + F.col("__bytes")
    middle = F.floor((2 * F.col("__upto") - F.col("size")) * F.lit(shards) / F.lit(2 * total))
    placed = staged(in_ranges(rows, ranges).join(offsets, "__range")
                    .withColumn("__upto", upto).withColumn("__i", F.row_number().over(w) - 1 + F.col("__rows"))
                    .withColumn("shard", F.least(middle, F.lit(shards - 1)).cast("int"))
                    .select(key, *cols, "size", "text_crc32", "shard", "__i"), "placed")
    # at most one row a shard
    first = [F.lit(x) for r in placed.groupBy("shard").agg(F.min("__i").alias("i")).collect() for x in (r.shard, r.i)]
    slot = F.col("__i") - F.element_at(F.create_map(*first), F.col("shard")) if first else F.col("__i")
    return placed.select(key, *cols, "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
                         slot.cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"))


def write_shards(docs: DataFrame, path: str, shards: int = SHARDS, key: str = "doc_id", text: str = "text") -> None:
    """The whole records as Parquet, one folder ``shard=i`` a shard, in slot order within and across its files."""
    rest = [c for c in docs.columns if c not in (key, *OUT)]
    out = shard_rows(docs, shards, key, text, carry=rest).select(key, *rest, "shard", "slot")
    out.repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)
