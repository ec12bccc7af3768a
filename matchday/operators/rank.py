"""Ranking and "pick one row per key" operators.

Scale notes
-----------
* ``pct_rank_avg`` never puts a whole group into one task. A plain
  ``rank() over (partition by group)`` does exactly that, and groups here
  are few and huge (four positions). Instead the values are first reduced to
  distinct ``(group, value, count)`` with a map-side partial aggregate (a hot
  value is one row after that), cut at approximate quantiles into as many
  buckets per group as its number of values asks for, repartitioned by
  (group, bucket), and the prefix counts are computed per bucket plus a
  per-group offset from the (tiny) bucket totals. The result is exact.
* ``latest_by`` / ``first_by`` use ``max``/``min`` over a struct: combined on
  the map side, so a key holding a third of all rows is reduced before the
  shuffle instead of being sorted in one window task. Spark plans it as a
  sort aggregate, so every task sorts its own input.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


CUTS = 1024  # approximate quantiles that cut a group
SALTS = 64  # partitions in which a group's values meet the edges of its buckets


def _cols(x) -> list[str]:
    return [x] if isinstance(x, str) else list(x)


# --------------------------------------------------------------------------- E1
def pct_rank_avg(df: DataFrame, value: str, group: str | Sequence[str], out: str = "pct_rank",
                 default: float = 50.0, valid: Column | None = None, buckets: int | None = None,
                 per_bucket: int = 50_000) -> DataFrame:
    """Percentile rank of ``value`` within ``group`` (x100), average ties.

    Semantics of a pandas ``rank(pct=True)`` per group: NULL/NaN values are
    excluded from both the rank and the denominator and get ``default``; rows
    where ``valid`` is false (e.g. an unknown group) also get ``default``.
    ``rank_avg = (#values < v) + (#values == v + 1) / 2``, divided by the
    number of non-null values in the group.

    A group of ``n`` distinct values is ranked in ``buckets`` tasks, or if that is
    not given in ``ceil(n / per_bucket)`` (``CUTS`` at most).
    """
    g = _cols(group)
    v = F.col(value).cast("double")
    ok = v.isNotNull() & ~F.isnan(v)
    if valid is not None:
        ok = ok & F.coalesce(valid, F.lit(False))
    for c in g:
        ok = ok & F.col(c).isNotNull()
    keyed = df.withColumn("__v", F.when(ok, v))

    # distinct (group, value) with multiplicity: map-side combined
    dist = (keyed.where(F.col("__v").isNotNull())
            .groupBy(*g, "__v").agg(F.count(F.lit(1)).alias("__c")))
    parts = F.ceil(F.count(F.lit(1)) / per_bucket) if buckets is None else F.lit(buckets)
    bounds = dist.groupBy(*g).agg(
        F.percentile_approx("__v", [i / CUTS for i in range(1, CUTS)], 10000).alias("__q"),
        F.least(F.lit(CUTS), parts).cast("int").alias("__m"))
    # of the quantiles, a group of several buckets keeps the edges of those; one of a single bucket needs none
    edges = bounds.where(F.col("__m") > 1).select(
        *g, F.ceil(F.sqrt("__m")).cast("int").alias("__step"),
        F.transform(F.sequence(F.lit(1), F.col("__m") - 1),
                    lambda i: F.element_at("__q", F.floor(i * F.lit(CUTS) / F.col("__m")).cast("int"))).alias("__b"))
    # edges meet their group's values in SALTS partitions instead of one
    salted = dist.withColumn("__s", F.pmod(F.xxhash64("__v"), F.lit(SALTS)).cast("int"))
    spread = edges.withColumn("__s", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    # which bucket: every __step-th edge first, then those after the last of them below the value
    coarse = F.size(F.filter(F.sequence(F.lit(1), F.size("__b"), F.col("__step")),
                             lambda i: F.element_at("__b", i) < F.col("__v")))
    first = F.greatest(F.lit(0), F.col("__at") - 1) * F.col("__step")
    fine = F.size(F.filter(F.slice("__b", first + 1, F.col("__step")), lambda x: x < F.col("__v")))
    assigned = (salted.join(spread, [*g, "__s"], "left")
                .withColumn("__at", F.when(F.col("__b").isNotNull(), coarse))
                .withColumn("__k", F.when(F.col("__b").isNotNull(), first + fine).otherwise(F.lit(0)).cast("int"))
                .select(*g, "__k", "__v", "__c").repartition(*g, "__k"))
    # prefix count inside a bucket, on the bucket's own partitions
    w_in = Window.partitionBy(*g, "__k").orderBy("__v")
    win = assigned.select(*g, "__k", "__v", "__c",
                          F.coalesce(F.sum("__c").over(w_in.rowsBetween(Window.unboundedPreceding, -1)),
                                     F.lit(0)).alias("__pre"))
    # rows in the group's lower buckets and in the group: at most CUTS rows per group
    sizes = assigned.groupBy(*g, "__k").agg(F.sum("__c").alias("__bc"))
    w_prev = Window.partitionBy(*g).orderBy("__k").rowsBetween(Window.unboundedPreceding, -1)
    offs = sizes.select(*g, "__k", F.coalesce(F.sum("__bc").over(w_prev), F.lit(0)).alias("__off"),
                        F.sum("__bc").over(Window.partitionBy(*g)).alias("__n"))
    ranks = (win.join(offs, [*g, "__k"])
             .select(*g, "__v", ((F.col("__off") + F.col("__pre") + (F.col("__c") + 1) / 2.0)
                                 / F.col("__n") * 100.0).alias("__r"), F.lit(0).alias("__j")))
    # unranked rows match nothing and are dealt over all partitions, not to that of the null key
    spare = F.when(F.col("__v").isNull(), 1 + F.pmod(F.xxhash64(*df.columns), F.lit(1 << 20)).cast("int")).otherwise(F.lit(0))
    return (keyed.withColumn("__j", spare).join(ranks, [*g, "__v", "__j"], "left")
            .withColumn(out, F.coalesce(F.col("__r"), F.lit(float(default))))
            .select(*df.columns, out))


# --------------------------------------------------------------------------- E3/E4
def _pick(df: DataFrame, key, order: Sequence, largest: bool) -> DataFrame:
    k = _cols(key)
    order_cols = [F.col(o) if isinstance(o, str) else o for o in order]
    rest = [c for c in df.columns if c not in k]
    packed = F.struct(*[oc.alias(f"__o{i}") for i, oc in enumerate(order_cols)],
                      F.struct(*[F.col(c) for c in rest]).alias("__row"))
    agg = F.max(packed) if largest else F.min(packed)
    return (df.groupBy(*k).agg(agg.alias("__p"))
            .select(*k, *[F.col("__p.__row")[c].alias(c) for c in rest]))


def latest_by(df: DataFrame, key, order: Sequence) -> DataFrame:
    """One row per key: the one with the greatest ``order`` tuple.

    Put an explicit tie-break last in ``order`` for a deterministic answer.
    """
    return _pick(df, key, order, largest=True)


def first_by(df: DataFrame, key, order: Sequence) -> DataFrame:
    """One row per key: the one with the smallest ``order`` tuple."""
    return _pick(df, key, order, largest=False)


# --------------------------------------------------------------------------- E6
def latest_partition(df: DataFrame, col: str) -> DataFrame:
    """Rows of the newest value of ``col`` (e.g. the latest gameweek).

    The maximum is a one-row global aggregate, so broadcasting it is
    bounded by construction.
    """
    mx = df.agg(F.max(col).alias("__max"))
    return df.join(F.broadcast(mx), F.col(col) == F.col("__max"), "left_semi")


# --------------------------------------------------------------------------- F2
def top_k(df: DataFrame, order: Sequence[Column], k: int) -> DataFrame:
    """Top-k rows by ``order`` (planned as TakeOrderedAndProject)."""
    return df.orderBy(*order).limit(k)


def top_n_per_group(df: DataFrame, key, order: Sequence[Column], n: int, rn: str = "rn") -> DataFrame:
    """First ``n`` rows per key in ``order`` with their 1-based position.

    ``row_number() <= n`` is planned with a partial WindowGroupLimit before
    the shuffle, so each map task forwards at most ``n`` rows per key.
    """
    w = Window.partitionBy(*_cols(key)).orderBy(*order)
    return df.withColumn(rn, F.row_number().over(w)).where(F.col(rn) <= n)
