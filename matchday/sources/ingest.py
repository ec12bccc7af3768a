"""Bookmaker odds from provider rows to the stored table, as one plan.

provider rows (CSV files of any layout, or flattened JSON documents) -> declared types ->
team names through the alias maps -> the one fixture of that day and pairing -> newest row per
fixture. Every row that falls out says where: ``refused`` is one of ``date``, ``home team``,
``away team``, ``no fixture`` or ``several fixtures``.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..quality.tables import BETTING_ODDS, GOAL_PRICES, HANDICAP_PRICES, MATCH_STATS, RESULT_PRICES
from .landing import observed
from .odds import csv_column_name

# Names that differ between the odds documents, the odds files and the team table.
DOCUMENT_NAMES = {
    "Manchester United": "Man United", "Man United": "Man United", "Tottenham Hotspur": "Tottenham",
    "Tottenham": "Tottenham", "Manchester City": "Man City", "Man City": "Man City",
    "Brighton & Hove Albion": "Brighton", "Brighton and Hove Albion": "Brighton", "Wolverhampton Wanderers": "Wolves",
    "Leicester City": "Leicester", "Newcastle United": "Newcastle", "West Ham United": "West Ham",
    "Crystal Palace": "Crystal Palace", "Nottingham Forest": "Nott'm Forest", "Leeds United": "Leeds",
}
FILE_NAMES = {"Man United": "Man Utd", "Tottenham": "Spurs"}
PRICES = (*RESULT_PRICES, *GOAL_PRICES, "AHh", *HANDICAP_PRICES)
REFUSED = "refused"


def renamed(name: Column, *maps: Mapping[str, str]) -> Column:
    """A name after each alias map in turn (literal maps of a few entries, no join)."""
    for m in maps:
        pairs = F.create_map(*[F.lit(x) for kv in m.items() for x in kv]) if m else None
        name = F.coalesce(F.try_element_at(pairs, name), name) if m else name
    return name


def read_odds_files(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """Odds CSV files whose layouts differ, as text columns under their cleaned names, by name."""
    from .landing import _csv, layouts
    parts = [_csv(spark, files, names) for names, files in layouts(spark, path)]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p, allowMissingColumns=True)
    return out


def match_odds(rows: DataFrame, fixtures: DataFrame, teams: DataFrame, as_of, order: Sequence[str] = (),
               maps: Sequence[Mapping[str, str]] = (DOCUMENT_NAMES, FILE_NAMES), date_format: str = "dd/MM/yyyy") -> DataFrame:
    """Every provider row in the columns of the stored table, with ``refused`` (NULL: matched) and
    the columns ``order``. The team table and the fixtures are joined by equality on name, and on
    day and pairing; a pairing met by several fixtures of a day is counted before the join, so
    candidates are never multiplied. Names that the team table repeats resolve to their smallest id."""
    rows = rows.toDF(*[csv_column_name(c) for c in rows.columns])
    have = set(rows.columns)
    dim = teams.groupBy(F.col("name").alias("__name")).agg(F.min("team_id").alias("__team"))
    day = F.try_to_timestamp(F.trim(F.col("Date").cast("string")), F.lit(date_format)).cast("date")
    base = rows.select("*", day.alias("__day"), renamed(F.col("HomeTeam"), *maps).alias("__hn"),
                       renamed(F.col("AwayTeam"), *maps).alias("__an"))
    base = (base.join(dim.withColumnsRenamed({"__name": "__hn", "__team": "__h"}), "__hn", "left")
            .join(dim.withColumnsRenamed({"__name": "__an", "__team": "__a"}), "__an", "left"))
    days = (fixtures.groupBy(F.col("kickoff_utc").cast("date").alias("__day"), F.col("home_team_id").alias("__h"),
                             F.col("away_team_id").alias("__a"))
            .agg(F.count(F.lit(1)).alias("__n"), F.min("fixture_id").alias("__fixture")))
    found = base.join(days, ["__day", "__h", "__a"], "left")
    refused = (F.when(F.col("__day").isNull(), "date").when(F.col("__h").isNull(), "home team")
               .when(F.col("__a").isNull(), "away team").when(F.col("__n").isNull(), "no fixture")
               .when(F.col("__n") > 1, "several fixtures"))

    def field(c: str) -> Column:
        kind = BETTING_ODDS.columns[c].kind
        source = {"referee": "Referee"}.get(c, c)
        source = source if source in have else c
        return (F.col(f"`{source}`").try_cast(kind) if source in have else F.lit(None).cast(kind)).alias(c)

    stamp = F.to_timestamp_ntz(F.lit(str(as_of)))
    return found.select(F.col("__fixture").cast("bigint").alias("fixture_id"), F.col("__day").cast("timestamp_ntz").alias("match_date"),
                        F.col("__h").cast("bigint").alias("home_team_id"), F.col("__a").cast("bigint").alias("away_team_id"),
                        *[field(c) for c in ("referee", *MATCH_STATS, *PRICES)], stamp.alias("as_of_utc"),
                        *order, refused.alias(REFUSED))


def newest_per_fixture(matched: DataFrame, order: Sequence[str] = ()) -> DataFrame:
    """Matched rows, one per fixture: the greatest by ``order``, then by all columns (map-side combined)."""
    good = matched.where(F.col(REFUSED).isNull()).drop(REFUSED)
    rest = [c for c in good.columns if c not in ("fixture_id", *order)]
    # the columns that break ties are the row itself: each value is carried once
    newest = F.max(F.struct(*order, F.struct(*rest).alias("__row")))
    return (good.groupBy("fixture_id").agg(newest.alias("__p"))
            .select("fixture_id", *[F.col("__p")[c].alias(c) for c in order], *[F.col("__p.__row")[c].alias(c) for c in rest])
            .select(*good.columns))


def ingest_odds(rows: DataFrame, fixtures: DataFrame, teams: DataFrame, as_of, path: str, order: Sequence[str] = (),
                refused_path: str | None = None, **options) -> dict[str, int]:
    """Match, keep the newest per fixture and upsert the stored odds; returns the numbers of rows read,
    matched and refused by reason, observed on the job that writes them."""
    from .sinks import upsert
    reasons = ("date", "home team", "away team", "no fixture", "several fixtures")
    matched = match_odds(rows, fixtures, teams, as_of, order, **options)
    by = {"matched": F.col(REFUSED).isNull()} | {r: F.col(REFUSED) == r for r in reasons}
    watched, seen = observed(matched, "odds", by)
    if refused_path:
        watched.where(F.col(REFUSED).isNotNull()).write.mode("overwrite").option(
            "partitionOverwriteMode", "static").parquet(refused_path)
        upsert(newest_per_fixture(matched, order).drop(*order), path, "fixture_id")
    else:
        upsert(newest_per_fixture(watched, order).drop(*order), path, "fixture_id")
    return dict(seen.get)
