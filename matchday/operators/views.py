"""Read views over the stored tables.

Thin, lazy functions: each returns a DataFrame whose filters and column
selection Catalyst pushes into the scan (partition pruning on ``gameweek``
when the table is partitioned by it).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.cols import decode

# Status codes and position ids of the source data model.
STATUS_MEANINGS = {"a": "Available", "i": "Injured", "s": "Suspended", "u": "Unavailable", "d": "Doubtful",
                   "n": "Not in squad"}
POSITION_NAMES = {1: "GKP", 2: "DEF", 3: "MID", 4: "FWD"}


# --------------------------------------------------------------------------- A13 / M3
def scan(spark: SparkSession, path: str, fmt: str = "parquet", columns: Sequence[str] | None = None,
         equals: Mapping[str, object] | None = None, between: Mapping[str, tuple] | None = None,
         exclude_backfilled: bool = False) -> DataFrame:
    """Read a stored table with optional equality / range filters (pushed to
    the scan, partition-pruned) and a column subset."""
    df = spark.read.format(fmt).load(path)
    for c, v in (equals or {}).items():
        df = df.where(F.col(c) == F.lit(v))
    for c, (lo, hi) in (between or {}).items():
        if lo is not None:
            df = df.where(F.col(c) >= F.lit(lo))
        if hi is not None:
            df = df.where(F.col(c) <= F.lit(hi))
    if exclude_backfilled and "is_backfilled" in df.columns:
        df = df.where(~F.coalesce(F.col("is_backfilled"), F.lit(False)))
    return df.select(*columns) if columns else df


class TableStore:
    """Named accessors over a root folder of tables (one folder per table).

    Every accessor returns a lazy DataFrame; a table that was never stored reads as an empty one
    with its declared columns. Ranges are inclusive and optional on either side.
    """

    def __init__(self, spark: SparkSession, root: str, fmt: str = "parquet"):
        self.spark, self.root, self.fmt = spark, root, fmt

    def table(self, name: str, **kw) -> DataFrame:
        from ..quality.tables import TABLES
        try:
            return scan(self.spark, f"{self.root}/{name}", self.fmt, **kw)
        except AnalysisException as e:
            known = TABLES.get(name.removeprefix("derived_") if name.startswith("derived_") else name)
            if known is None or "PATH_NOT_FOUND" not in str(e):
                raise
            return typed_empty(self.spark, ", ".join(f"{c} {col.kind}" for c, col in known.columns.items()))

    def stored(self) -> list[str]:
        """The names of the tables in the root folder, from one listing."""
        p = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(self.root)
        fs = p.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        return sorted(s.getPath().getName() for s in fs.listStatus(p) if s.isDirectory()) if fs.exists(p) else []

    # raw tables
    def players(self) -> DataFrame:
        return self.table("raw_players_bootstrap")

    def teams(self) -> DataFrame:
        return self.table("raw_teams_bootstrap")

    def events(self) -> DataFrame:
        return self.table("raw_events_bootstrap")

    def game_settings(self) -> DataFrame:
        return self.table("raw_game_settings")

    def element_stats(self) -> DataFrame:
        return self.table("raw_element_stats")

    def element_types(self) -> DataFrame:
        return self.table("raw_element_types")

    def chips(self) -> DataFrame:
        return self.table("raw_chips")

    def phases(self) -> DataFrame:
        return self.table("raw_phases")

    def fixtures(self, gameweek: int | None = None) -> DataFrame:
        return self.table("raw_fixtures", equals=_given(event=gameweek))

    def betting_odds(self, gameweek: int | None = None) -> DataFrame:
        """Stored odds; of one gameweek those of its fixtures (a semi join)."""
        odds = self._upserted("raw_betting_odds")
        return odds if gameweek is None else odds.join(self.fixtures(gameweek).select("fixture_id"), "fixture_id", "left_semi")

    def _upserted(self, name: str) -> DataFrame:
        df = self.table(name)
        return df.drop(*[c for c in df.columns if c.startswith("_bucket_of_")])

    def fixtures_with_odds(self) -> DataFrame:
        """Every fixture with its odds columns, NULL without odds; clashing odds columns end in ``_odds``."""
        from .joins import left_join_suffix
        return left_join_suffix(self.fixtures(), self.betting_odds(), "fixture_id", "_odds")

    # performance and snapshots
    def performance(self, start_gw: int | None = None, end_gw: int | None = None,
                    player_id: int | None = None) -> DataFrame:
        return self.table("raw_player_gameweek_performance", between={"gameweek": (start_gw, end_gw)},
                          equals=_given(player_id=player_id))

    def gameweek_performance(self, gameweek: int) -> DataFrame:
        return self.performance(gameweek, gameweek)

    def snapshots(self, start_gw: int | None = None, end_gw: int | None = None,
                  include_backfilled: bool = True, player_id: int | None = None) -> DataFrame:
        return self.table("raw_player_gameweek_snapshot", between={"gameweek": (start_gw, end_gw)},
                          equals=_given(player_id=player_id), exclude_backfilled=not include_backfilled)

    def availability(self, gameweek: int, include_backfilled: bool = True) -> DataFrame:
        return self.snapshots(gameweek, gameweek, include_backfilled)

    # a manager's tables
    def manager(self) -> DataFrame:
        return self.table("raw_my_manager")

    def picks(self, start_gw: int | None = None, end_gw: int | None = None) -> DataFrame:
        return self.table("raw_my_picks", between={"event": (start_gw, end_gw)})

    def current_picks(self) -> DataFrame:
        """Picks of the newest gameweek that has any."""
        from .rank import latest_partition
        return latest_partition(self.picks(), "event")

    def chip_usage(self, start_gw: int | None = None, end_gw: int | None = None) -> DataFrame:
        """``(gameweek, chip_used)``, one row a gameweek: a chip is the same on all of its picks."""
        return (self.picks(start_gw, end_gw).groupBy(F.col("event").alias("gameweek")).agg(F.min("chip_used").alias("chip_used")))

    def gameweek_summary(self, start_gw: int | None = None, end_gw: int | None = None) -> DataFrame:
        return self.table("raw_my_gameweek_summary", between={"event": (start_gw, end_gw)})

    def free_transfers(self, gameweek: int | None = None) -> DataFrame:
        """Free transfers of every manager and gameweek, or of one gameweek."""
        from .periods import free_allowance
        chips = self.picks().groupBy("manager_id", "event").agg(F.min("chip_used").alias("chip_used"))
        out = free_allowance(self.gameweek_summary(), chips)
        return out if gameweek is None else out.where(F.col("event") == gameweek)

    # derived tables
    def derived(self, name: str, gameweek: int | None = None) -> DataFrame:
        return self.table(f"derived_{name}", equals=_given(gameweek=gameweek))

    def player_metrics(self, gameweek: int | None = None) -> DataFrame:
        return self.derived("player_metrics", gameweek)

    def team_form(self, gameweek: int | None = None) -> DataFrame:
        return self.derived("team_form", gameweek)

    def fixture_difficulty(self, gameweek: int | None = None) -> DataFrame:
        return self.derived("fixture_difficulty", gameweek)

    def value_analysis(self, gameweek: int | None = None) -> DataFrame:
        return self.derived("value_analysis", gameweek)

    def ownership_trends(self, gameweek: int | None = None) -> DataFrame:
        return self.derived("ownership_trends", gameweek)

    def betting_features(self, gameweek: int | None = None) -> DataFrame:
        return self.derived("betting_features", gameweek)

    def fixture_runs(self, gameweek: int | None = None) -> DataFrame:
        return self.derived("fixture_runs", gameweek)

    # views
    def players_enhanced(self) -> DataFrame:
        return enhanced_players(self.players())

    def player_status(self, name: str) -> DataFrame:
        return player_status(self.players(), name)

    def current_players(self) -> DataFrame:
        return legacy_players(self.players())

    def current_teams(self) -> DataFrame:
        return legacy_teams(self.teams())

    def normalised_fixtures(self) -> DataFrame:
        return normalised_fixtures(self.fixtures())

    def live(self, gameweek: int | None = None) -> DataFrame:
        return legacy_live(self.performance(gameweek, gameweek))

    def expected_rates(self) -> DataFrame:
        """Expected goals and assists per 90 minutes of those who played."""
        from .filters import per_unit_rates
        return per_unit_rates(self.players(), ["expected_goals", "expected_assists"])

    # bookkeeping
    def summary(self) -> DataFrame:
        """``(table, rows)`` of every stored table."""
        from ..quality.checks import table_counts
        return table_counts({t: self.table(t) for t in self.stored()})

    def freshness(self, now) -> DataFrame:
        """Per stored table with a timestamp, and over all: oldest, newest, age, status."""
        from ..quality.checks import freshness_overall
        stamps = {}
        for t in self.stored():
            df = self.table(t)
            col = next((c for c in ("as_of_utc", "calculation_date", "last_updated", "analysis_date") if c in df.columns), None)
            if col:
                stamps[t] = (df, col)
        return freshness_overall(stamps, now)


def _given(**values) -> dict | None:
    return {k: v for k, v in values.items() if v is not None} or None


# --------------------------------------------------------------------------- B2 / B8
# The columns of the enhanced player view, in order; those of the second list stay as they are.
ENHANCED = [
    "player_id", "web_name", "first_name", "second_name", "team_id", "position_id", "now_cost", "total_points", "form",
    "selected_by_percent", "minutes", "starts", "status", "chance_of_playing_next_round", "chance_of_playing_this_round",
    "corners_and_indirect_freekicks_order", "direct_freekicks_order", "penalties_order", "expected_goals_per_90",
    "expected_assists_per_90", "transfers_in_event", "transfers_out_event", "form_rank", "ict_index_rank",
    "points_per_game_rank", "news", "cost_change_event", "cost_change_start", "value_form", "influence_rank",
    "creativity_rank", "threat_rank", "defensive_contribution", "tackles", "recoveries", "goals_scored", "assists",
    "clean_sheets", "bonus", "bps", "influence", "creativity", "threat", "ict_index", "expected_goals", "expected_assists",
    "points_per_game"]
NOT_NUMERIC = ["player_id", "web_name", "first_name", "second_name", "team_id", "position_id", "status", "news"]


def enhanced_players(players: DataFrame) -> DataFrame:
    """The enhanced columns that exist, numbers parsed leniently (what does not parse is NULL)."""
    from .filters import project_available
    return project_available(players, [(c, None if c in NOT_NUMERIC else "num") for c in ENHANCED])


def player_status(players: DataFrame, name: str) -> DataFrame:
    """One row, the first player (smallest id) whose name contains ``name``: as a pattern in either case,
    or, where none does, without accents. No row when nobody does."""
    from .filters import name_lookup
    hit = name_lookup(players, "web_name", name)
    first = F.min(F.struct("player_id", *[c for c in hit.columns if c != "player_id"])).alias("p")
    one = hit.agg(first).where(F.col("p").isNotNull()).select("p.*")
    return one.select(
        "player_id", F.col("web_name").alias("name"), F.concat_ws(" ", "first_name", "second_name").alias("full_name"),
        F.col("status").alias("status_code"), status_meaning("status").alias("status_meaning"),
        F.col("chance_of_playing_next_round").try_cast("double").alias("chance_next_round"),
        F.col("chance_of_playing_this_round").try_cast("double").alias("chance_this_round"), "news", "team_id", "position_id",
        (F.col("now_cost") / 10.0).alias("current_price"), "total_points")


# --------------------------------------------------------------------------- B3 / B9
def legacy_players(players: DataFrame) -> DataFrame:
    """Legacy player view: price in units, position name, status meaning,
    the id repeated as ``mapped_player_id``."""
    return players.select(
        F.col("player_id").alias("id"), F.col("player_id").alias("mapped_player_id"), "web_name",
        F.col("team_id").alias("team"), F.col("position_id").alias("element_type"),
        decode("position_id", POSITION_NAMES).alias("position"),
        (F.col("now_cost") / 10.0).alias("price"),
        status_meaning("status").alias("status_meaning") if "status" in players.columns
        else F.lit(None).cast("string").alias("status_meaning"),
    )


def status_meaning(c) -> Column:
    """Status code -> text, unknown codes as 'Unknown: <code>'."""
    col = F.col(c) if isinstance(c, str) else c
    return F.coalesce(decode(col, STATUS_MEANINGS), F.concat(F.lit("Unknown: "), col))


# --------------------------------------------------------------------------- B4
def typed_empty(spark: SparkSession, schema: T.StructType | str) -> DataFrame:
    """An empty result that still carries the declared columns."""
    return spark.createDataFrame([], schema)


def legacy_teams(teams: DataFrame) -> DataFrame:
    """Legacy team view: id, names and when they were taken."""
    return teams.select(*[c for c in ("team_id", "name", "short_name", "as_of_utc") if c in teams.columns])


def normalised_fixtures(fixtures: DataFrame) -> DataFrame:
    """Legacy fixture view: id, gameweek, kickoff, teams and when they were taken."""
    return fixtures.select(*[c for c in ("fixture_id", "event", "kickoff_utc", "home_team_id", "away_team_id", "as_of_utc")
                             if c in fixtures.columns])


def legacy_live(performance: DataFrame) -> DataFrame:
    """Legacy live view: ``gameweek`` is called ``event``."""
    return performance.withColumnRenamed("gameweek", "event")


# --------------------------------------------------------------------------- D8
def group_size_stats(df: DataFrame, key: Sequence[str], period: str) -> DataFrame:
    """Per period: min / max / avg number of rows per key group."""
    sizes = df.groupBy(period, *key).agg(F.count(F.lit(1)).alias("n"))
    return sizes.groupBy(period).agg(F.min("n").alias("min_size"), F.max("n").alias("max_size"),
                                     F.avg("n").alias("avg_size"), F.count(F.lit(1)).alias("groups"))


# --------------------------------------------------------------------------- F3
def preview(df: DataFrame, order: Sequence[Column | str], n: int = 5) -> DataFrame:
    """First ``n`` rows in a stated order (dry-run samples)."""
    return df.orderBy(*order).limit(n)
