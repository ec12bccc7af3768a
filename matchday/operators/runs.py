"""Period window sums (D1) and ordered forward runs.

For one period (``period_sums``, ``forward_runs``) or for every period of an
axis in one plan (``trailing_sums``: value-range window frames over the totals
per key and period; ``in_reach`` + ``forward_runs``: a bounded interval join,
written as an expansion of each row to the periods that reach it).

Both work on team-perspective rows (see :mod:`reshape`), aggregate per team
with map-side partial aggregation, and produce one row per team. Player-level
tables then join the per-team result instead of recomputing it per player.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .rank import top_n_per_group


def _cols(x) -> list[str]:
    return [x] if isinstance(x, str) else list(x)


def with_periods(df: DataFrame, periods: DataFrame, period_col: str) -> DataFrame:
    """Every row of ``df`` for every period of ``periods`` (column ``period_col``, one row per period).

    The periods are one array of a one-row aggregate, exploded per row: as many
    values as a season has gameweeks.
    """
    axis = (periods.agg(F.sort_array(F.collect_set(F.col(period_col).cast("int"))).alias("__p"))
            .withColumn("__one", F.lit(1)))
    return (df.drop(period_col).withColumn("__one", F.lit(1)).join(F.broadcast(axis), "__one")
            .withColumn(period_col, F.explode("__p")).drop("__one", "__p"))


def trailing_sums(persp: DataFrame, key: str, period_col: str, axis: DataFrame, span: int,
                  measures: Mapping[str, Column], first: int = 1) -> DataFrame:
    """Per (key, period) of ``axis``: sums of ``measures`` over rows with
    max(first, period - span) <= row's period < period, all periods in one plan.

    Rows are first totalled per (key, period), map-side combined, so the window
    of a key holds two rows per period at most, whatever the number of rows; its
    frame is a range of period values, so gaps and double periods need no care.
    NULL measures are skipped (the sum of nothing is NULL).
    """
    totals = (persp.where(F.col(period_col) >= first).groupBy(key, F.col(period_col).cast("int").alias(period_col))
              .agg(*[F.sum(c).alias(n) for n, c in measures.items()]))
    asked = axis.select(key, F.col(period_col).cast("int").alias(period_col)).withColumn("__asks", F.lit(True))
    w = Window.partitionBy(key).orderBy(period_col).rangeBetween(-span, -1)
    both = totals.withColumn("__asks", F.lit(False)).unionByName(asked, allowMissingColumns=True)
    return (both.select(key, period_col, "__asks", *[F.sum(n).over(w).alias(n) for n in measures])
            .where("__asks").drop("__asks"))


def in_reach(persp: DataFrame, period_col: str, horizon: int, axis: DataFrame, out: str) -> DataFrame:
    """Each row once for every period ``p`` of ``axis`` with p <= row's period <= p + horizon (column ``out``).

    The interval join is bounded: a row reaches ``horizon + 1`` periods, which
    are generated per row and kept where the axis has them (a semi join).
    """
    c = F.col(period_col).cast("int")
    reach = persp.withColumn(out, F.explode(F.sequence(c - horizon, c)))
    return reach.join(axis.select(F.col(out).cast("int").alias(out)).distinct(), out, "left_semi")


def period_sums(persp: DataFrame, key: str, period_col: str, lo, hi_exclusive,
                measures: Mapping[str, Column], where: Column | None = None) -> DataFrame:
    """Sum ``measures`` per ``key`` over rows with lo <= period < hi_exclusive.

    NULL measure values are skipped (sum of nothing is NULL; callers coalesce
    after joining back to the full key set).
    """
    pred = (F.col(period_col) >= F.lit(lo) if not isinstance(lo, Column) else F.col(period_col) >= lo)
    pred = pred & (F.col(period_col) < (hi_exclusive if isinstance(hi_exclusive, Column) else F.lit(hi_exclusive)))
    if where is not None:
        pred = pred & where
    return persp.where(pred).groupBy(key).agg(*[F.sum(c).alias(n) for n, c in measures.items()])


def forward_runs(persp: DataFrame, key, order: Sequence[Column], value: str,
                 sizes: tuple[int, int] = (3, 5), easy: float = 2.0, head: int = 2,
                 prefix: str = "run") -> DataFrame:
    """Summaries of the first items of an ordered run per key.

    For the first ``sizes[0]`` and ``sizes[1]`` items: mean of ``value`` and
    number of items with value <= ``easy``. ``swing`` = mean(items head+1..
    sizes[1]) - mean(items 1..head) when at least ``sizes[1]`` items exist,
    else 0. Only the first ``max(sizes)`` rows per key ever leave a map task.
    """
    s, l = sizes
    ranked = top_n_per_group(persp, key, order, l, rn="__rn")
    rn, v = F.col("__rn"), F.col(value)
    return ranked.groupBy(*_cols(key)).agg(
        F.avg(F.when(rn <= s, v)).alias(f"{prefix}_{s}_mean"),
        F.avg(v).alias(f"{prefix}_{l}_mean"),
        F.count(F.when((rn <= s) & (v <= easy), 1)).alias(f"{prefix}_{s}_easy"),
        F.count(F.when(v <= easy, 1)).alias(f"{prefix}_{l}_easy"),
        F.when(F.count(F.lit(1)) >= l,
               F.avg(F.when(rn > head, v)) - F.avg(F.when(rn <= head, v))).otherwise(F.lit(0.0))
        .alias(f"{prefix}_swing"),
    )
