"""Keyed merge, missing periods and two-way key comparison."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .rank import latest_by


def _cols(x) -> list[str]:
    return [x] if isinstance(x, str) else list(x)


# --------------------------------------------------------------------------- G1
def merge_latest(sources: Sequence[DataFrame], key, order: Sequence[Column | str] = ()) -> DataFrame:
    """Union sources (lowest priority first) and keep one row per key.

    Later sources win; within one source the greatest ``order`` wins, so a
    source that repeats keys must give an order. Columns missing from a
    source are NULL. The pick is a ``max`` over a struct: map-side combined.
    """
    tagged = None
    for i, s in enumerate(sources):
        t = s.withColumn("__prio", F.lit(i))
        tagged = t if tagged is None else tagged.unionByName(t, allowMissingColumns=True)
    return latest_by(tagged, key, ["__prio", *order]).drop("__prio")


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    """``unionByName`` of many frames (missing columns become NULL)."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out


# --------------------------------------------------------------------------- G3
def period_axis(upto, start: int = 1, name: str = "period", spark=None, like: DataFrame | None = None) -> DataFrame:
    """A one-column DataFrame ``start..upto`` (``upto`` may be a Column of a
    one-row frame ``like``)."""
    if isinstance(upto, Column):
        return like.select(F.explode(F.sequence(F.lit(start), upto)).alias(name))
    return spark.range(start, int(upto) + 1).select(F.col("id").cast("int").alias(name))


def missing_periods(existing: DataFrame, col: str, expected: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Expected periods (optionally per ``by`` key) absent from ``existing``."""
    keys = [*by, col]
    return expected.join(existing.select(*keys).distinct(), keys, "left_anti")


# --------------------------------------------------------------------------- G4
def diff_keys(left: DataFrame, right: DataFrame, key) -> DataFrame:
    """Keys present on one side only: ``side`` is 'missing' (left only,
    i.e. expected but absent on the right) or 'extra' (right only)."""
    k = _cols(key)
    lk = left.select(*k).distinct().withColumn("__l", F.lit(True))
    rk = right.select(*k).distinct().withColumn("__r", F.lit(True))
    j = lk.join(rk, k, "full_outer")
    return (j.where(F.col("__l").isNull() | F.col("__r").isNull())
            .select(*k, F.when(F.col("__r").isNull(), F.lit("missing")).otherwise(F.lit("extra")).alias("side")))
