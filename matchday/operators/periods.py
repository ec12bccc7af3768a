"""Gameweek bookkeeping (K1-K4) and the lag-one allowance rule.

The "current gameweek" is a one-row DataFrame, never a collected Python
value, so a whole refresh stays one lazy plan; join it with
``F.broadcast`` (one row by construction).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


# --------------------------------------------------------------------------- K1
def current_period(events: DataFrame, id_col: str = "event_id", current_flag: str = "is_current",
                   finished_col: str = "finished") -> DataFrame:
    """One row: ``current`` (first current event id, else 1) and
    ``finished`` (that event's flag; unknown -> true)."""
    cur = F.min(F.when(F.coalesce(F.col(current_flag), F.lit(False)), F.struct(F.col(id_col).alias("id"),
                                                                                F.col(finished_col).alias("f"))))
    return (events.agg(cur.alias("__c"))
            .select(F.coalesce(F.col("__c.id").cast("int"), F.lit(1)).alias("current"),
                    F.coalesce(F.col("__c.f"), F.lit(True)).alias("finished")))


# --------------------------------------------------------------------------- K2
def target_period(current: DataFrame) -> DataFrame:
    """Adds ``target``: next period if the current one is finished."""
    return current.withColumn("target", F.when(F.col("finished"), F.col("current") + 1).otherwise(F.col("current")))


# --------------------------------------------------------------------------- K3/K4
def pending(targets: DataFrame, existing: DataFrame, key: Sequence[str], force: bool = False) -> DataFrame:
    """Targets still to compute: all of them when forced, else those absent."""
    if force:
        return targets
    return targets.join(existing.select(*key).distinct(), list(key), "left_anti")


# --------------------------------------------------------------------------- E7
RESET_CHIPS = ("wildcard", "freehit", "free hit")  # fixed values: chips that reset banking


def free_allowance(summary: DataFrame, chips: DataFrame, key: str = "manager_id", period: str = "event",
                   transfers: str = "event_transfers", chip_col: str = "chip_used",
                   resets: Sequence[str] = RESET_CHIPS) -> DataFrame:
    """Free transfers available at every (key, period) of ``summary``.

    1 at period <= 1, when there is no previous-period row, when the previous
    period used a resetting chip, or when previous transfers were made; else
    2. Implemented as an equi-join on ``period = prev + 1`` (all periods at
    once, no driver loop); ``chips`` must be one row per (key, period).
    """
    prev = summary.select(F.col(key), (F.col(period) + 1).alias(period),
                          F.col(transfers).alias("__prev_transfers"), F.lit(True).alias("__has_prev"))
    ch = chips.select(F.col(key), (F.col(period) + 1).alias(period), F.lower(F.col(chip_col)).alias("__prev_chip"))
    j = (summary.select(key, period)
         .join(prev, [key, period], "left")
         .join(ch, [key, period], "left"))
    one = ((F.col(period) <= 1) | F.col("__has_prev").isNull()
           | F.coalesce(F.col("__prev_chip").isin(*resets), F.lit(False))
           | F.coalesce(F.col("__prev_transfers") != 0, F.lit(True)))
    return j.select(key, period, F.when(one, F.lit(1)).otherwise(F.lit(2)).alias("free_transfers"))


# --------------------------------------------------------------------------- K4
def choose_targets(existing: DataFrame, period_col: str, upto: int, mode: str = "missing",
                   single: int | None = None, span: tuple[int, int] | None = None) -> DataFrame:
    """Periods to (re)compute, as a one-column DataFrame ``period``.

    ``mode``: 'single' (just ``single``), 'range' (``span`` inclusive),
    'missing' (1..upto absent from ``existing``), 'force' (all of 1..upto).
    'single' and 'range' skip periods already present unless forced via
    'force'. The period axis is generated with ``range``; the comparison with
    the stored periods is an anti join (no driver-side set arithmetic).
    """
    spark = existing.sparkSession
    if mode == "single":
        lo = hi = int(single)
    elif mode == "range":
        lo, hi = int(span[0]), int(span[1])
    elif mode in ("missing", "force"):
        lo, hi = 1, int(upto)
    else:
        raise ValueError(f"unknown mode {mode!r}")
    axis = spark.range(lo, hi + 1).select(F.col("id").cast("int").alias("period"))
    if mode == "force":
        return axis
    have = existing.select(F.col(period_col).cast("int").alias("period")).distinct()
    return axis.join(have, "period", "left_anti")


# --------------------------------------------------------------------------- K6
def chip_history(picks: DataFrame, stored: DataFrame | None = None, key: str = "manager_id",
                 period: str = "event", chip_col: str = "chip_used", order: str = "position") -> DataFrame:
    """One chip row per (key, period) from pick rows (the chip is repeated on
    every pick: the first pick's value is taken), merged over the stored
    history with the new rows winning."""
    from .merge import merge_latest
    from .rank import first_by
    fresh = first_by(picks.select(key, period, chip_col, order), [key, period], [order]).drop(order)
    return fresh if stored is None else merge_latest([stored.select(key, period, chip_col), fresh], [key, period])
