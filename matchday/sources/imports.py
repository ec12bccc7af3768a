"""Historical imports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.cols import season_short
from .flatten import snapshot


def normalise_results(fixtures: DataFrame, teams: DataFrame, season: str) -> DataFrame:
    """Finished results with team names (``Team_<id>`` when unknown),
    kickoff in UTC and the season label as given. Rows without both scores
    are dropped."""
    t = teams.select(F.col("team_id").alias("__tid"), F.col("name").alias("__name"))
    f = fixtures.where(F.col("team_h_score").isNotNull() & F.col("team_a_score").isNotNull())
    h = t.withColumnsRenamed({"__tid": "__hid", "__name": "__hn"})
    a = t.withColumnsRenamed({"__tid": "__aid", "__name": "__an"})
    j = (f.join(h, F.col("home_team_id") == F.col("__hid"), "left")
         .join(a, F.col("away_team_id") == F.col("__aid"), "left"))
    return j.select(
        F.col("kickoff_utc").cast("timestamp_ntz").alias("date_utc"),
        F.coalesce(F.col("__hn"), F.concat(F.lit("Team_"), F.col("home_team_id").cast("string"))).alias("home_team"),
        F.coalesce(F.col("__an"), F.concat(F.lit("Team_"), F.col("away_team_id").cast("string"))).alias("away_team"),
        F.col("team_h_score").cast("int").alias("home_goals"), F.col("team_a_score").cast("int").alias("away_goals"),
        F.lit(season).alias("season"),
    )


def season_key(season) -> Column:
    """'2024-2025' -> '2024-25' (the provider's folder name)."""
    return season_short(F.lit(season) if isinstance(season, str) else season)


def import_snapshots(rows: DataFrame, first_gw: int, last_gw: int, as_of, allowed: tuple[int, int] = (1, 6)) -> DataFrame:
    """External player rows -> backfilled snapshots replicated over
    gameweeks first..last (only ranges inside ``allowed`` are accepted).
    Text 'nan' becomes '' (news) or '0.0' (ep/form). The range is generated
    per row with ``explode(sequence)``, not a cross join."""
    lo, hi = allowed
    if not (lo <= first_gw <= last_gw <= hi):
        raise ValueError(f"gameweek range {first_gw}..{last_gw} outside {lo}..{hi}")
    clean = rows
    for c, d in (("news", ""), ("ep_this", "0.0"), ("ep_next", "0.0"), ("form", "0.0")):
        if c in clean.columns:
            v = F.col(c).cast("string")
            clean = clean.withColumn(c, F.when(v.isNull() | (F.lower(F.trim(v)) == "nan"), F.lit(d)).otherwise(v))
    gw = F.explode(F.sequence(F.lit(first_gw), F.lit(last_gw)))
    return snapshot(clean.withColumn("__gw", gw), F.col("__gw"), True, as_of)
