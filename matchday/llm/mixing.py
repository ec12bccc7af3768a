"""Mixing sources to target weights by Pfair scheduling, with DataFrame functions only.

Every source's documents, in a fixed pseudo-random order, are cut into blocks.
With integer weights that sum to H, block j (from 0) of a source of weight n may
start at slot ``floor(j * H / n)`` and must be out before slot
``ceil((j + 1) * H / n)``. Each slot takes, of the sources whose next block is
released, the one with the earliest deadline (ties: the first listed). Earliest
deadline first meets all those windows on one sequence, so after any number of
slots a source that still has blocks is less than one block away from its
share. The windows repeat every H slots, so the schedule of one period (H rows,
whatever the data size) is computed once by a fold and every block finds its
slot by arithmetic: no sequential pass over the data.

Every document is scheduled: when a source runs out, its slots stay empty and
the others keep their own proportions. Sources that have no weight of their own
(null included) share the entry ``*``; without such an entry they raise.

A document's index in its source needs no window over the source: the source is
cut by hash into as many buckets of about ``rows_per_bucket`` rows as its size
asks for, buckets get running offsets and rows are numbered inside their bucket.
A source that holds a third of all rows is spread over a third of the buckets. The hash is of
id and text, so rows of one id, or without id, are spread too. Only rows that repeat id and text
share a hash; they are interchangeable, and where more than ``rows_per_bucket`` of them do, they
follow the source's other rows, cut into parts by their place in the table (written first, so that
the cut stands).
An empty table gives an empty result; text, null or of any length, is only
carried. Columns of other names are carried untouched, but for those named as in ``OUT``,
which the operator's own replace; names that start with two underscores are reserved.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce
from math import gcd

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ._util import staged

REST = "*"
OUT = ("mix_source", "mix_block", "mix_slot", "mix_release", "mix_deadline", "mix_position")
MAX_PERIOD = 10_000
# Target shares of the production mix, in percent; the rest pool takes what no entry names.
TARGET_WEIGHTS = {"src0": 10, "src1": 8, "src2": 6, **{f"src{i}": 5 for i in range(3, 10)},
                  **{f"src{i}": 4 for i in range(10, 19)}, "src19": 3, REST: 2}


def reduced(weights: Mapping[str, int]) -> dict[str, int]:
    """Weights without their common divisor; they must be positive integers."""
    if not weights or any(not isinstance(n, int) or n <= 0 for n in weights.values()):
        raise ValueError("weights must be positive integers")
    d = reduce(gcd, weights.values())
    out = {s: n // d for s, n in weights.items()}
    if sum(out.values()) > MAX_PERIOD:
        raise ValueError(f"the weights' period {sum(out.values())} is over {MAX_PERIOD} slots")
    return out


def period_schedule(spark: SparkSession, weights: Mapping[str, int]) -> DataFrame:
    """One period: ``(mix_source, turn, n, slot0, release0, deadline0)``, one row per slot."""
    w = reduced(weights)
    h = sum(w.values())
    shares = F.array(*[F.struct(F.lit(s).alias("source"), F.lit(n).alias("n"), F.lit(i).alias("i"))
                       for i, (s, n) in enumerate(w.items())])
    made = "array<struct<i:int,source:string,n:int,turn:int,slot:int,release:int,deadline:int>>"
    init = F.struct(F.array_repeat(F.lit(0), len(w)).alias("done"), F.array().cast(made).alias("out"))

    def step(acc, t):
        def offer(s):
            j = F.element_at(acc["done"], s["i"] + 1)
            release = F.floor(j * h / s["n"]).cast("int")
            deadline = F.ceil((j + 1) * h / s["n"]).cast("int")
            ready = (j < s["n"]) & (release <= t)
            return F.when(ready, F.struct(deadline.alias("deadline"), s["i"].alias("i"), s["source"].alias("source"),
                                          s["n"].alias("n"), j.alias("turn"), release.alias("release")))
        pick = F.array_min(F.filter(F.transform(shares, offer), lambda o: o.isNotNull()))
        row = F.struct(pick["i"].alias("i"), pick["source"].alias("source"), pick["n"].alias("n"),
                       pick["turn"].alias("turn"), t.alias("slot"), pick["release"].alias("release"),
                       pick["deadline"].alias("deadline"))
        done = F.transform(acc["done"], lambda d, k: F.when(k == pick["i"], d + 1).otherwise(d))
        return F.struct(done.alias("done"), F.concat(acc["out"], F.array(row).cast(made)).alias("out"))

    fold = F.aggregate(F.sequence(F.lit(0), F.lit(h - 1)), init, step, lambda acc: acc["out"])
    return (spark.range(1).select(F.explode(fold).alias("r"))
            .select(F.col("r.source").alias("mix_source"), "r.turn", "r.n", F.col("r.slot").alias("slot0"),
                    F.col("r.release").alias("release0"), F.col("r.deadline").alias("deadline0")))


def mix(docs: DataFrame, weights: Mapping[str, int] | None = None, key: str = "doc_id", source: str = "source",
        block_rows: int = 16, rows_per_bucket: int = 500) -> DataFrame:
    """Every row of ``docs`` with its block, slot, window and position (columns ``OUT``).

    ``mix_position`` orders the mixed stream; it is unique and grows with the slot.
    """
    w = reduced(TARGET_WEIGHTS if weights is None else weights)
    h = sum(w.values())
    spark = docs.sparkSession
    docs = docs.drop(*OUT)
    given = [s for s in w if s != REST]
    rest = F.lit(REST) if REST in w else F.raise_error(F.concat(F.lit("no weight for source "),
                                                                F.coalesce(F.col(source), F.lit("null")))).cast("string")
    named = F.when(F.coalesce(F.col(source).isin(given), F.lit(False)), F.col(source)).otherwise(rest)
    words = F.md5(F.coalesce(F.col("text").cast("string"), F.lit(""))) if "text" in docs.columns else F.lit("")
    digest = F.md5(F.concat(F.coalesce(F.col(key).cast("string"), F.lit("")), F.lit(":"), words))
    rows = docs.withColumn("mix_source", named).withColumn("__h", digest)
    # at most as many rows as there are weights
    sizes = rows.groupBy("mix_source").agg(F.ceil(F.count(F.lit(1)) / rows_per_bucket).alias("__buckets"))
    head = F.conv(F.substring("__h", 1, 8), 16, 10).cast("long")
    hot = staged(rows.groupBy("mix_source", "__h").agg(F.count(F.lit(1)).alias("__same"))
                 .where(F.col("__same") > rows_per_bucket), "hot")
    cut = (rows.join(hot, ["mix_source", "__h"], "left_anti").join(F.broadcast(sizes), "mix_source")
           .withColumn("__b", F.floor(head * F.col("__buckets") / 2 ** 32).cast("long"))
           .withColumn("__part", F.struct(F.lit("").alias("h"), F.lit(0).cast("long").alias("i"))).drop("__buckets"))
    if not hot.isEmpty():
        parts = F.ceil(F.col("__same") / rows_per_bucket)
        same = staged(rows.join(hot, ["mix_source", "__h"]).withColumn("__b", F.lit(1 << 40).cast("long"))
                      .withColumn("__part", F.struct(F.col("__h").alias("h"), F.pmod(
                          F.xxhash64(F.monotonically_increasing_id()), parts).cast("long").alias("i"))).drop("__same"), "same")
        cut = cut.unionByName(same)
    held = cut.groupBy("mix_source", "__b", "__part").agg(F.count(F.lit(1)).alias("__n"))
    before = Window.partitionBy("mix_source").orderBy("__b", "__part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = held.select("mix_source", "__b", "__part", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__off"))
    inside = Window.partitionBy("mix_source", "__b", "__part").orderBy("__h", F.col(key))
    numbered = (cut.withColumn("__r", F.row_number().over(inside) - 1)
                .join(offsets, ["mix_source", "__b", "__part"])
                .withColumn("__i", F.col("__off") + F.col("__r"))
                .withColumn("mix_block", F.floor(F.col("__i") / block_rows).cast("long")))
    # at most MAX_PERIOD rows
    plan = F.broadcast(period_schedule(spark, w).select("mix_source", *[
        F.col(c).alias(f"__{c}") for c in ("turn", "slot0", "release0", "deadline0")]))
    share = F.create_map(*[x for s, n in w.items() for x in (F.lit(s), F.lit(n))])
    numbered = (numbered.withColumn("__w", F.element_at(share, F.col("mix_source")).cast("long"))
                .withColumn("__turn", (F.col("mix_block") % F.col("__w")).cast("int"))
                .withColumn("__cycle", F.floor(F.col("mix_block") / F.col("__w")).cast("long")))
    out = numbered.join(plan, ["mix_source", "__turn"])
    base = F.col("__cycle") * h
    return (out.withColumn("mix_slot", base + F.col("__slot0"))
            .withColumn("mix_release", base + F.col("__release0"))
            .withColumn("mix_deadline", base + F.col("__deadline0"))
            .withColumn("mix_position", F.col("mix_slot") * block_rows + F.col("__i") % block_rows)
            .select(*docs.columns, *OUT))


def ordered(mixed: DataFrame) -> DataFrame:
    """The mixed stream in its order: range-partitioned and sorted by position."""
    return mixed.repartitionByRange("mix_position").sortWithinPartitions("mix_position")


def mixed_documents(docs: DataFrame) -> DataFrame:
    """``doc_id`` and the schedule of every document under ``TARGET_WEIGHTS``."""
    return mix(docs.select("doc_id", "source", F.md5(F.coalesce("text", F.lit(""))).alias("text"))).select("doc_id", *OUT)


def oracle_sql() -> str:
    """The same schedule, its period by a recursive query."""
    w = reduced(TARGET_WEIGHTS)
    h = sum(w.values())
    values = ", ".join(f"('{s}', {n}, {i})" for i, (s, n) in enumerate(w.items()))
    given = ", ".join(f"'{s}'" for s in w if s != REST)
    return f"""
WITH RECURSIVE w(source, n, i) AS (VALUES {values}),
offers AS (SELECT source, n, i, j, (j * {h}) // n AS release, ((j + 1) * {h} + n - 1) // n AS deadline
  FROM w, LATERAL (SELECT unnest(range(n)) AS j)),
run(t, done, source, n, j, release, deadline) AS (
  SELECT -1::BIGINT, (SELECT list(0::BIGINT ORDER BY i) FROM w), NULL::VARCHAR, 0, 0::BIGINT, 0::BIGINT, 0::BIGINT
  UNION ALL
  SELECT r.t + 1, list_transform(r.done, lambda d, k: CASE WHEN k = p.i + 1 THEN d + 1 ELSE d END),
    p.source, p.n, p.j, p.release, p.deadline
  FROM run r, LATERAL (SELECT o.* FROM offers o WHERE o.j = r.done[o.i + 1] AND o.release <= r.t + 1
    ORDER BY o.deadline, o.i LIMIT 1) p
  WHERE r.t + 1 < {h}),
docs AS (SELECT doc_id, CASE WHEN source IN ({given}) THEN source ELSE '*' END AS s,
  md5(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || md5(md5(coalesce(text, '')))) AS h FROM documents),
same AS (SELECT *, count(*) OVER (PARTITION BY s, h) > 500 AS hot FROM docs),
idx AS (SELECT *, row_number() OVER (PARTITION BY s ORDER BY hot, h, doc_id) - 1 AS x FROM same),
blk AS (SELECT idx.*, x // 16 AS b, w.n AS n FROM idx JOIN w ON w.source = idx.s)
SELECT doc_id, s AS mix_source, CAST(b AS BIGINT) AS mix_block,
  CAST((b // blk.n) * {h} + r.t AS BIGINT) AS mix_slot,
  CAST((b // blk.n) * {h} + r.release AS BIGINT) AS mix_release,
  CAST((b // blk.n) * {h} + r.deadline AS BIGINT) AS mix_deadline,
  CAST(((b // blk.n) * {h} + r.t) * 16 + x % 16 AS BIGINT) AS mix_position
FROM blk JOIN run r ON r.source = blk.s AND r.j = b % blk.n
"""
