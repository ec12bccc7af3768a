"""The derived feature tables (I1-I8), composed from the generic operators.

Inputs use the logical column names of the raw tables:

* players: player_id, web_name, team_id, position_id, now_cost (tenths),
  total_points, form (text), minutes, selected_by_percent (text),
  transfers_in_event, transfers_out_event, penalties_order,
  corners_and_indirect_freekicks_order, direct_freekicks_order,
  chance_of_playing_next_round
* teams: team_id, name, short_name, strength_{overall,attack,defence}_{home,away}
* fixtures: fixture_id, event, kickoff_utc, home_team_id, away_team_id,
  finished, team_h_score, team_a_score
* odds: fixture_id and the bookmaker columns (B365H ... AvgAHA), referee
* history: player_id, gameweek (rows of past per-gameweek performance)

``gameweek`` is an int; ``as_of`` a datetime (the calculation time is a
parameter, never ``current_timestamp()``, so reruns are reproducible).

Every table is computed at its natural grain first (team, fixture) and only
then joined to players, so no formula is evaluated once per player.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.cols import (classify, clean_sheet, clip_null, consensus, decode, devig2, devig3, first_pair,
                              is_first, num, poisson_lambda_ge3, split_goals, stable_bucket, tier, weighted_flags)
from ..operators.joins import fan_out, lookup_or_default, new_entities, unique_or_raise
from ..operators.rank import pct_rank_avg
from ..operators.reshape import fixture_sides, perspectives
from ..operators.runs import forward_runs, in_reach, period_sums, trailing_sums, with_periods

# Fixed values of the feature definitions.
CALCULATION_VERSION = "v1.0.0"
POSITIONS = {1: "GKP", 2: "DEF", 3: "MID", 4: "FWD"}
STRENGTH_SCALE = 300.0
FACTORS_INCLUDED = '["opponent_strength", "venue", "form"]'
BETTING_DEFAULTS = {
    "team_win_probability": 0.33,
    "opponent_win_probability": 0.33,
    "draw_probability": 0.33,
    "implied_clean_sheet_probability": 0.35,
    "implied_total_goals": 2.5,
    "team_expected_goals": 1.25,
    "market_consensus_strength": 0.5,
    "odds_movement_team": 0.0,
    "odds_movement_magnitude": 0.0,
    "favorite_status": 0.5,
    "asian_handicap_line": 0.0,
    "handicap_team_odds": 2.0,
    "expected_goal_difference": 0.0,
    "over_under_signal": 0.0,
    "referee_encoded": -1,
}


def ts_lit(as_of) -> Column:
    """A calculation-time literal as TIMESTAMP_NTZ (the data's timestamp type)."""
    if isinstance(as_of, Column):
        return as_of
    if isinstance(as_of, _dt.datetime):
        as_of = as_of.strftime("%Y-%m-%d %H:%M:%S")
    return F.to_timestamp_ntz(F.lit(str(as_of)))


def _price() -> Column:
    return F.col("now_cost") / 10.0


def _net() -> Column:
    return F.col("transfers_in_event") - F.col("transfers_out_event")


def _pos_valid() -> Column:
    return F.col("position_id").isin(*POSITIONS)


# --------------------------------------------------------------------------- I1
def _gw(gameweek) -> Column:
    """A gameweek given as an int (one period) or a column name (many)."""
    return (F.col(gameweek) if isinstance(gameweek, str) else F.lit(gameweek)).cast("int")


def _rank_group(gameweek) -> list[str]:
    return [gameweek, "position_id"] if isinstance(gameweek, str) else ["position_id"]


def player_metrics(players: DataFrame, gameweek, as_of) -> DataFrame:
    """I1. ``gameweek`` is an int, or the name of a column when ``players``
    holds many gameweeks (K5: ranks are then taken per gameweek and position,
    all gameweeks in one job)."""
    price = _price()
    tp = F.col("total_points")
    form = num("form")
    own = num("selected_by_percent")
    base = players.select(
        "*",
        price.alias("current_price"),
        F.when(price > 0, clip_null(tp, 0.0) / price).otherwise(F.lit(0.0)).alias("points_per_million"),
    )
    ranked = pct_rank_avg(base, "points_per_million", _rank_group(gameweek), out="value_score", valid=_pos_valid())
    epg = clip_null(F.coalesce(form, F.lit(3.0)), 0.0)
    form3 = F.coalesce(form, F.lit(3.0))
    return ranked.select(
        "player_id", "web_name", "team_id", "position_id",
        decode("position_id", POSITIONS).alias("position_name"),
        "current_price", "points_per_million",
        F.when((price > 0) & F.col("form").isNotNull(), clip_null(form, 0.0) / price)
        .otherwise(F.lit(0.0)).alias("form_per_million"),
        "value_score",
        F.least(F.coalesce(F.col("minutes"), F.lit(0)) / 1000.0, F.lit(1.0)).alias("value_confidence"),
        classify([(form3 >= 5.0, "improving"), (form3 >= 2.5, "stable")], "declining").alias("form_trend"),
        F.lit(0.0).alias("form_momentum"),
        F.greatest(F.coalesce(form, F.lit(0.0)), F.lit(0.0)).alias("recent_form_5gw"),
        F.lit(0.7).alias("season_consistency"),
        epg.alias("expected_points_per_game"),
        (tp - F.coalesce(epg * F.col("minutes") / 90.0, F.lit(0.0))).alias("points_above_expected"),
        F.lit(0.3).alias("overperformance_risk"),
        classify([(_net() > 1000, "rising"), (_net() < -1000, "falling")], "stable").alias("ownership_trend"),
        _net().alias("transfer_momentum"),
        F.least(F.coalesce(own, F.lit(5.0)) / 50.0, F.lit(1.0)).alias("ownership_risk"),
        weighted_flags([(F.col("penalties_order") == 1, 3),
                        (F.col("corners_and_indirect_freekicks_order") == 1, 2),
                        (F.col("direct_freekicks_order") == 1, 1)], 3).alias("set_piece_priority"),
        is_first("penalties_order").alias("penalty_taker"),
        is_first("corners_and_indirect_freekicks_order").alias("corner_taker"),
        is_first("direct_freekicks_order").alias("freekick_taker"),
        ((F.lit(100.0) - F.coalesce(num("chance_of_playing_next_round"), F.lit(100.0))) / 100.0).alias("injury_risk"),
        F.lit(0.2).alias("rotation_risk"),
        _gw(gameweek).alias("gameweek"),
        ts_lit(as_of).alias("calculation_date"),
        F.lit(CALCULATION_VERSION).alias("calculation_version"),
        F.lit(0.85).alias("data_quality_score"),
    )


# --------------------------------------------------------------------------- I2
def _scaled(c: str) -> Column:
    return clip_null(F.col(c) / STRENGTH_SCALE, 0.0, 5.0)


def goal_window(fixtures: DataFrame, gameweek: int, span: int = 5) -> DataFrame:
    """Per team: goals scored/conceded home and away over finished fixtures
    with max(1, gw - span) <= event < gw (D1)."""
    return period_sums(_finished_sides(fixtures), "team_id", "event", max(1, gameweek - span), gameweek, _goals())


def _finished_sides(fixtures: DataFrame) -> DataFrame:
    return fixture_sides(fixtures.where(F.coalesce(F.col("finished"), F.lit(False))),
                         home_score="team_h_score", away_score="team_a_score", keep=["event"])


def _goals() -> dict[str, Column]:
    h, gf, ga = F.col("is_home"), F.col("goals_for"), F.col("goals_against")
    return {
        "team_goals_scored_home_5gw": F.when(h, gf),
        "team_goals_conceded_home_5gw": F.when(h, ga),
        "team_goals_scored_away_5gw": F.when(~h, gf),
        "team_goals_conceded_away_5gw": F.when(~h, ga),
    }


def team_form(teams: DataFrame, fixtures: DataFrame, gameweek, as_of, periods: DataFrame | None = None,
              span: int = 5) -> DataFrame:
    """I2. ``gameweek`` is an int, or a column name with ``periods`` (a frame with that
    column): every team then gets a row for each of the periods, from one plan (K5)."""
    gcols = ["team_goals_scored_home_5gw", "team_goals_conceded_home_5gw",
             "team_goals_scored_away_5gw", "team_goals_conceded_away_5gw"]
    if isinstance(gameweek, str):
        sides = _finished_sides(fixtures).withColumnRenamed("event", gameweek)
        axis = with_periods(teams.select("team_id").distinct(), periods, gameweek)
        goals = trailing_sums(sides, "team_id", gameweek, axis, span, _goals())
        t = teams.drop(gameweek).join(goals, "team_id")
    else:
        t = teams.join(goal_window(fixtures, gameweek, span), "team_id", "left")
    home_pts, away_pts = F.lit(1.6), F.lit(1.4)
    adv = home_pts - away_pts
    return t.select(
        "team_id", F.col("name").alias("team_name"), F.col("short_name").alias("team_short_name"),
        _scaled("strength_overall_away").alias("overall_attack_strength"),
        _scaled("strength_defence_home").alias("overall_defense_strength"),
        F.lit(1.5).alias("overall_form_points"),
        _scaled("strength_attack_home").alias("home_attack_strength"),
        _scaled("strength_defence_home").alias("home_defense_strength"),
        home_pts.alias("home_form_points"),
        *[F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(c) for c in gcols[:2]],
        _scaled("strength_attack_away").alias("away_attack_strength"),
        _scaled("strength_defence_away").alias("away_defense_strength"),
        away_pts.alias("away_form_points"),
        *[F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(c) for c in gcols[2:]],
        adv.alias("home_advantage"),
        (F.lit(1.0) - F.abs(adv) / 3.0).alias("venue_consistency"),
        F.lit("stable").alias("form_trend"), F.lit(0.0).alias("momentum"),
        F.lit(0.75).alias("attack_confidence"), F.lit(0.75).alias("defense_confidence"),
        _gw(gameweek).alias("gameweek"), F.lit(6).alias("games_analyzed"),
        ts_lit(as_of).alias("last_updated"),
    )


# --------------------------------------------------------------------------- I3
def _valid_fixtures(fixtures: DataFrame) -> DataFrame:
    """Fixtures with both teams and a gameweek (others are skipped)."""
    return fixtures.where(F.col("home_team_id").isNotNull() & F.col("away_team_id").isNotNull()
                          & F.col("event").isNotNull())


def fixture_difficulty(fixtures: DataFrame, teams: DataFrame, as_of) -> DataFrame:
    sides = fixture_sides(_valid_fixtures(fixtures), keep=["fixture_id", "event", "kickoff_utc"])
    opp = teams.select("team_id", "strength_overall_home", "strength_overall_away")
    j = lookup_or_default(sides, opp, "opponent_id", "team_id",
                          {"strength_overall_home": 1000, "strength_overall_away": 1000}, prefix="opp_")
    b = F.when(F.col("is_home"), clip_null(F.col("opp_strength_overall_away") / STRENGTH_SCALE, 0.0, 5.0)) \
        .otherwise(clip_null(F.col("opp_strength_overall_home") / STRENGTH_SCALE, 0.0, 5.0))
    j = j.withColumn("__b", b)
    b = F.col("__b")
    return j.select(
        "fixture_id", "team_id", "opponent_id", F.col("event").cast("int").alias("gameweek"), "is_home",
        F.col("kickoff_utc").alias("kickoff_time"),
        b.alias("opponent_strength_difficulty"),
        (b * F.when(F.col("is_home"), F.lit(0.9)).otherwise(F.lit(1.1))).alias("venue_difficulty"),
        F.lit(2.5).alias("congestion_difficulty"),
        b.alias("form_difficulty"), b.alias("overall_difficulty"),
        tier(b).alias("difficulty_tier"),
        F.lit(0.75).alias("difficulty_confidence"),
        F.greatest(F.lit(3.0) - b * 0.3, F.lit(0.5)).alias("expected_goals_for"),
        F.greatest(b * 0.3, F.lit(0.2)).alias("expected_goals_against"),
        F.greatest(F.lit(3.0) - b * 0.4, F.lit(0.3)).alias("expected_points"),
        F.greatest(F.lit(0.8) - b * 0.15, F.lit(0.1)).alias("clean_sheet_probability"),
        ts_lit(as_of).alias("calculation_date"),
        F.lit(FACTORS_INCLUDED).alias("factors_included"),
    )


# --------------------------------------------------------------------------- I4 / I5 shared
def flag_new(players: DataFrame, history: DataFrame, gameweek) -> DataFrame:
    """players + ``is_new`` (no performance history before ``gameweek``).

    With ``gameweek`` a column name (many gameweeks, K5) the same rule is
    applied per row: new at gw iff gw > 1, some history exists before gw, and
    the player's first history gameweek is not before gw. One join with the
    per-player first gameweek, no per-gameweek loop.
    """
    if not isinstance(gameweek, str):
        new = new_entities(players, history, "player_id", "gameweek", gameweek).withColumn("is_new", F.lit(True))
        return (players.join(new, "player_id", "left")
                .withColumn("is_new", F.coalesce(F.col("is_new"), F.lit(False))))
    first = history.groupBy("player_id").agg(F.min("gameweek").alias("__first"))
    gate = history.agg(F.min("gameweek").alias("__gmin")).withColumn("__one", F.lit(1))
    gw = F.col(gameweek)
    return (players.join(first, "player_id", "left")
            .withColumn("__one", F.lit(1)).join(F.broadcast(gate), "__one", "left")  # one-row aggregate
            .withColumn("is_new", (gw > 1) & F.coalesce(F.col("__gmin") < gw, F.lit(False))
                        & (F.col("__first").isNull() | (F.col("__first") >= gw)))
            .drop("__first", "__gmin", "__one"))


# --------------------------------------------------------------------------- I4
def value_analysis(players: DataFrame, history: DataFrame, gameweek, as_of, flagged: DataFrame | None = None) -> DataFrame:
    p = flagged if flagged is not None else flag_new(players, history, gameweek)
    price = _price()
    tp = clip_null(F.col("total_points"), 0.0)
    is_new = F.col("is_new")
    ppp = F.when(is_new, F.lit(0.5)).when(price > 0, tp / price).otherwise(F.lit(0.0))
    base = p.select("*", price.alias("current_price"), tp.alias("__tp"), ppp.alias("points_per_pound"))
    ranked = pct_rank_avg(base, "points_per_pound", _rank_group(gameweek), out="__vvp", valid=_pos_valid())
    ppp = F.col("points_per_pound")
    buy = clip_null(ppp / 2.0, None, 10.0)
    net = _net()
    own = num("selected_by_percent")
    return ranked.select(
        "player_id", "web_name", "position_id", "current_price",
        F.col("__tp").cast("int").alias("total_points"),
        "points_per_pound",
        F.when(is_new, F.lit(0.5)).otherwise(ppp * 1.05).alias("expected_points_per_pound"),
        F.when(is_new, F.lit(1.0)).otherwise(F.col("__vvp")).alias("value_vs_position"),
        F.when(is_new, F.lit(1.0)).otherwise(F.lit(50.0)).alias("value_vs_price_tier"),
        F.when(is_new, F.lit(0.0)).otherwise(net / 100000.0 * 1).alias("predicted_price_change_1gw"),
        F.when(is_new, F.lit(0.0)).otherwise(net / 100000.0 * 5).alias("predicted_price_change_5gw"),
        F.when(is_new, F.lit(0.0)).otherwise(F.lit(0.1)).alias("price_volatility"),
        buy.alias("buy_rating"), (F.lit(10.0) - buy).alias("sell_rating"), F.lit(5.0).alias("hold_rating"),
        F.least(F.coalesce(own, F.lit(5.0)) / 50.0, F.lit(1.0)).alias("ownership_risk"),
        F.when(is_new, F.lit(0.0)).otherwise(clip_null(clip_null(-net / 100000.0, 0.0), 0.0, 1.0)).alias("price_risk"),
        F.lit(0.3).alias("performance_risk"),
        classify([(buy >= 8.0, "strong_buy"), (buy >= 6.0, "buy"), (buy >= 4.0, "hold"), (buy >= 2.0, "sell")],
                 "strong_sell").alias("recommendation"),
        F.lit(0.75).alias("confidence"),
        _gw(gameweek).alias("gameweek"),
        ts_lit(as_of).alias("analysis_date"),
        F.lit(CALCULATION_VERSION).alias("model_version"),
    )


# --------------------------------------------------------------------------- I5
def ownership_trends(players: DataFrame, history: DataFrame, gameweek, as_of, flagged: DataFrame | None = None) -> DataFrame:
    p = flagged if flagged is not None else flag_new(players, history, gameweek)
    is_new = F.col("is_new")
    tin = F.coalesce(F.col("transfers_in_event"), F.lit(0)).cast("long")
    tout = F.coalesce(F.col("transfers_out_event"), F.lit(0)).cast("long")
    net = tin - tout
    own = num("selected_by_percent")
    own5 = F.coalesce(own, F.lit(5.0))
    own0 = F.coalesce(own, F.lit(0.0))
    price = _price()
    return p.select(
        "player_id", "web_name", own.alias("selected_by_percent"),
        tin.alias("transfers_in_gw"), tout.alias("transfers_out_gw"), net.alias("net_transfers_gw"),
        F.when(is_new, F.lit(0.0)).otherwise(tin * 0.8).alias("avg_transfers_in_5gw"),
        F.when(is_new, F.lit(0.0)).otherwise(tout * 0.8).alias("avg_transfers_out_5gw"),
        F.when(is_new, F.lit(0.0)).otherwise(net * 0.8).alias("avg_net_transfers_5gw"),
        F.when(is_new, F.lit("neutral")).otherwise(classify(
            [(net > 5000, "accelerating_in"), (net > 1000, "steady_in"), (net > -1000, "neutral"),
             (net > -5000, "steady_out")], "accelerating_out")).alias("transfer_momentum"),
        F.least(F.abs(net) / 1000.0, F.lit(10.0)).alias("momentum_strength"),
        F.when(is_new, F.lit(0.0)).otherwise(net / 1000.0).alias("ownership_velocity"),
        F.when(is_new, F.lit("punt")).otherwise(classify(
            [(own5 >= 30.0, "template"), (own5 >= 15.0, "popular"), (own5 >= 5.0, "mid_owned"),
             (own5 >= 1.0, "differential")], "punt")).alias("ownership_tier"),
        classify([(own5 >= 40.0, "very_high"), (own5 >= 20.0, "high"), (own5 >= 10.0, "medium")], "low")
        .alias("ownership_risk_level"),
        F.when(is_new, F.lit(0.0)).otherwise(F.least(own5 / 5.0, F.lit(10.0))).alias("bandwagon_score"),
        F.when(price > 0, own0 / price).otherwise(F.lit(0.0)).alias("ownership_vs_price"),
        (own0 > 40.0).alias("template_player"),
        ((own0 > 30.0) & (net < 0)).alias("high_ownership_falling"),
        _gw(gameweek).alias("gameweek"),
        ts_lit(as_of).alias("last_updated"),
    )


# --------------------------------------------------------------------------- I6
def run_difficulty(fixtures: DataFrame, teams: DataFrame, gameweek, horizon: int = 5,
                   periods: DataFrame | None = None) -> DataFrame:
    """Per team: difficulty summaries of the next fixtures in gw..gw+horizon. With
    ``gameweek`` a column name: per team and period of ``periods``, in one plan."""
    many = isinstance(gameweek, str)
    up = _valid_fixtures(fixtures)
    if not many:
        up = up.where(F.col("event").between(gameweek, gameweek + horizon))
    sides = fixture_sides(up, keep=["fixture_id", "event"])
    opp = teams.select("team_id", "strength_overall_home", "strength_overall_away")
    j = lookup_or_default(sides, opp, "opponent_id", "team_id",
                          {"strength_overall_home": 1200, "strength_overall_away": 1200}, prefix="opp_")
    s = F.when(F.col("is_home"), F.col("opp_strength_overall_away")).otherwise(F.col("opp_strength_overall_home"))
    # once per fixture and side, before it is spread over the periods that reach it
    j = j.select("team_id", "event", "fixture_id", clip_null((s - 1000) / 80.0, 0.0, 5.0).alias("difficulty"))
    key = ["team_id"]
    if many:
        j, key = in_reach(j, "event", horizon, periods, gameweek), ["team_id", gameweek]
    return forward_runs(j, key, [F.col("event"), F.col("fixture_id")], "difficulty")


def fixture_runs(players: DataFrame, fixtures: DataFrame, teams: DataFrame, gameweek, as_of,
                 periods: DataFrame | None = None) -> DataFrame:
    """I6. ``gameweek`` is an int, or the name of a column of ``players`` (K5: a player's team
    may differ by gameweek; ``periods`` defaults to the gameweeks found there)."""
    if isinstance(gameweek, str):
        runs = run_difficulty(fixtures, teams, gameweek, periods=periods if periods is not None else players)
        j = players.select("player_id", "team_id", F.col(gameweek).cast("int").alias(gameweek)).join(
            runs, ["team_id", gameweek], "left")
    else:
        j = players.select("player_id", "team_id").join(run_difficulty(fixtures, teams, gameweek), "team_id", "left")
    r3 = F.coalesce(F.col("run_3_mean"), F.lit(2.5))
    r5 = F.coalesce(F.col("run_5_mean"), F.lit(2.5))
    g3 = F.coalesce(F.col("run_3_easy"), F.lit(0)).cast("int")
    g5 = F.coalesce(F.col("run_5_easy"), F.lit(0)).cast("int")
    sw = F.coalesce(F.col("run_swing"), F.lit(0.0))
    return j.select(
        "player_id", _gw(gameweek).alias("gameweek"),
        r3.alias("fixture_run_3gw_difficulty"), r5.alias("fixture_run_5gw_difficulty"),
        g3.alias("green_fixtures_next_3"), g5.alias("green_fixtures_next_5"),
        sw.alias("fixture_swing_upcoming"),
        ((r3 <= 2.0) & (g3 >= 2)).alias("optimal_transfer_in_window"),
        ((r3 >= 3.5) | (sw > 1.0)).alias("optimal_transfer_out_window"),
        ts_lit(as_of).alias("calculation_date"),
    )


# --------------------------------------------------------------------------- I7
def odds_fixture_features(odds: DataFrame) -> DataFrame:
    """Fixture-grain market features (both sides), before any fan-out."""
    c = F.col
    h_sel = F.coalesce(c("AvgCH"), c("B365CH"), c("AvgH"))
    a_sel = F.coalesce(c("AvgCA"), c("B365CA"), c("AvgA"))
    d_sel = F.coalesce(c("AvgCD"), c("B365CD"), c("AvgD"), c("B365D"))
    ph, pd_, pa = devig3(h_sel, d_sel, a_sel)
    over, under = first_pair(("Avg_over_2_5", "Avg_under_2_5"), ("B365_over_2_5", "B365_under_2_5"))
    both_avg_ah = c("AvgAHH").isNotNull() & c("AvgAHA").isNotNull()
    step1 = odds.select(
        "*",
        h_sel.alias("__h"), a_sel.alias("__a"),
        ph.alias("__ph"), pd_.alias("__pd"), pa.alias("__pa"),
        poisson_lambda_ge3(devig2(over, under)).alias("__tot"),
        F.when(both_avg_ah, c("AvgAHH")).otherwise(c("B365AHH")).alias("__ahh"),
        F.when(both_avg_ah, c("AvgAHA")).otherwise(c("B365AHA")).alias("__aha"),
    )
    hxg, axg = split_goals(c("__tot"), c("__ph"), c("__pd"), c("__pa"))
    ah = F.coalesce(c("AHh"), F.lit(0.0))
    mv_h = c("AvgCH") - c("AvgH")
    mv_a = c("AvgCA") - c("AvgA")
    return step1.select(
        "*",
        hxg.alias("__hxg"), axg.alias("__axg"),
        consensus("B365H", "PSH", "MaxH", "AvgH").alias("__cons_h"),
        consensus("B365A", "PSA", "MaxA", "AvgA").alias("__cons_a"),
        mv_h.alias("__mv_h"), mv_a.alias("__mv_a"),
        F.when(c("__h") < c("__a"), F.lit(1.0)).otherwise(F.lit(0.0)).alias("__fav_h"),
        F.when(c("__a") < c("__h"), F.lit(1.0)).otherwise(F.lit(0.0)).alias("__fav_a"),
        ah.alias("__ah"),
        stable_bucket("referee").alias("__ref"),
    )


def betting_features(odds: DataFrame, fixtures: DataFrame, players: DataFrame, as_of,
                     period_col: str | None = None) -> DataFrame:
    """I7. With ``period_col`` (a column of ``players``, K5) a fixture goes to the players that
    its team has in the fixture's gameweek; without it, to the team's players."""
    c = F.col
    fx = fixtures.select("fixture_id", c("event").alias("__gw"), c("home_team_id").alias("__home"),
                         c("away_team_id").alias("__away"))
    o = odds.drop("home_team_id", "away_team_id", "gameweek", "kickoff_time")
    # one odds row and one fixture row per id: checked inside the plan, on the join's own partitioning
    feats = odds_fixture_features(unique_or_raise(o, "fixture_id", "odds")
                                  .join(unique_or_raise(fx, "fixture_id", "fixtures"), "fixture_id", "inner"))
    tot = c("__tot")

    def side(team, p_team, p_opp, xg, cons, mv, fav, sign, ho):
        return {
            "team_id": team, "is_home": F.lit(sign > 0),
            "team_win_probability": p_team, "opponent_win_probability": p_opp,
            "draw_probability": c("__pd"),
            "implied_clean_sheet_probability": clean_sheet(tot, xg),
            "implied_total_goals": tot, "team_expected_goals": xg,
            "market_consensus_strength": cons,
            "odds_movement_team": mv, "odds_movement_magnitude": F.abs(mv),
            "favorite_status": fav,
            "asian_handicap_line": c("__ah") * float(sign),
            "handicap_team_odds": ho,
            "expected_goal_difference": c("__ah") * float(sign) * 1.0,
            "over_under_signal": tot - 2.5,
            "referee_encoded": c("__ref"),
        }

    sides = perspectives(
        feats,
        side(c("__home"), c("__ph"), c("__pa"), c("__hxg"), c("__cons_h"), c("__mv_h"), c("__fav_h"), 1, c("__ahh")),
        side(c("__away"), c("__pa"), c("__ph"), c("__axg"), c("__cons_a"), c("__mv_a"), c("__fav_a"), -1, c("__aha")),
        keep=["fixture_id", "__gw"],
    ).where(c("team_id").isNotNull())
    # defaults are filled at (fixture, side) grain, before the fan-out, so
    # the join only copies finished rows to every member of the team
    filled = [F.coalesce(c(k), F.lit(v)).alias(k) for k, v in BETTING_DEFAULTS.items()]
    sides = sides.select("team_id", F.coalesce(c("__gw"), F.lit(1)).cast("int").alias("gameweek"), "fixture_id",
                         "is_home", *filled, ts_lit(as_of).alias("as_of_utc"))
    members = players.where(c("team_id").isNotNull())
    if period_col:
        members = members.select("player_id", "team_id", c(period_col).cast("int").alias("gameweek"))
        out = fan_out(sides, members, ["team_id", "gameweek"])
    else:
        out = fan_out(sides, members.select("player_id", "team_id"))
    return out.select("gameweek", "fixture_id", "player_id", "is_home", *BETTING_DEFAULTS, "as_of_utc")


# --------------------------------------------------------------------------- I8
def neutral_backfill(players: DataFrame, new: DataFrame, gameweek: int, kind: str, as_of) -> DataFrame:
    """Rows for gameweeks 1..gameweek-1 of every new player, neutral values.

    ``new`` holds ``player_id``; the gameweek axis is generated per row with
    ``explode(sequence)``, not by a cross join.
    """
    if gameweek <= 1:
        return players.limit(0).select("player_id")
    p = players.join(new.select("player_id").distinct(), "player_id", "inner")
    p = p.withColumn("gameweek", F.explode(F.sequence(F.lit(1), F.lit(gameweek - 1))))
    price = _price()
    if kind == "value":
        return p.select(
            "player_id", "web_name", "position_id", price.alias("current_price"),
            F.lit(0).alias("total_points"), F.lit(0.5).alias("points_per_pound"),
            F.lit(0.5).alias("expected_points_per_pound"), F.lit(1.0).alias("value_vs_position"),
            F.lit(1.0).alias("value_vs_price_tier"), F.lit(0.0).alias("predicted_price_change_1gw"),
            F.lit(0.0).alias("predicted_price_change_5gw"), F.lit(0.0).alias("price_volatility"),
            F.lit(5.0).alias("buy_rating"), F.lit(5.0).alias("sell_rating"), F.lit(5.0).alias("hold_rating"),
            F.lit(0.0).alias("ownership_risk"), F.lit(0.0).alias("price_risk"),
            F.lit(0.3).alias("performance_risk"), F.lit("hold").alias("recommendation"),
            F.lit(0.5).alias("confidence"), "gameweek", ts_lit(as_of).alias("analysis_date"),
            F.lit(CALCULATION_VERSION).alias("model_version"),
        )
    if kind == "ownership":
        return p.select(
            "player_id", "web_name", F.lit(1.0).alias("selected_by_percent"),
            F.lit(0).cast("long").alias("transfers_in_gw"), F.lit(0).cast("long").alias("transfers_out_gw"),
            F.lit(0).cast("long").alias("net_transfers_gw"),
            F.lit(0.0).alias("avg_transfers_in_5gw"), F.lit(0.0).alias("avg_transfers_out_5gw"),
            F.lit(0.0).alias("avg_net_transfers_5gw"), F.lit("neutral").alias("transfer_momentum"),
            F.lit(0.0).alias("momentum_strength"), F.lit(0.0).alias("ownership_velocity"),
            F.lit("punt").alias("ownership_tier"), F.lit("low").alias("ownership_risk_level"),
            F.lit(0.0).alias("bandwagon_score"),
            F.when(price > 0, F.lit(1.0) / price).otherwise(F.lit(0.0)).alias("ownership_vs_price"),
            F.lit(False).alias("template_player"), F.lit(False).alias("high_ownership_falling"),
            "gameweek", ts_lit(as_of).alias("last_updated"),
        )
    raise ValueError(f"unknown backfill kind {kind!r}")


# --------------------------------------------------------------------------- K5
def derive_periods(table: str, players_by_period: DataFrame | None = None, as_of=None, history: DataFrame | None = None,
                   period_col: str = "gameweek", *, teams: DataFrame | None = None, fixtures: DataFrame | None = None,
                   odds: DataFrame | None = None, periods: DataFrame | None = None) -> DataFrame:
    """Recompute one of the seven derived tables for every gameweek in one job.

    Gameweek is a column throughout: ranks are per gameweek and position, new
    players per gameweek, goal windows are value-range frames, forward runs a
    bounded interval join; difficulty and betting features hold all gameweeks
    by nature (a fixture carries its own). ``periods`` (a frame with
    ``period_col``) limits the gameweeks; by default those of the input. The
    result is ready for a partition-wise write
    (``sinks.replace_partitions(df, path, 'gameweek')``).
    """
    def need(**given):
        lacking = [k for k, v in given.items() if v is None]
        if lacking:
            raise ValueError(f"{table} needs {', '.join(lacking)}")

    def limited(df: DataFrame, col: str) -> DataFrame:
        if periods is None:
            return df
        return df.join(periods.select(F.col(period_col).cast("int").alias(col)).distinct(), col, "left_semi")

    if table in ("player_metrics", "value_analysis", "ownership_trends"):
        need(players_by_period=players_by_period)
        players = limited(players_by_period, period_col)
        if table == "player_metrics":
            return player_metrics(players, period_col, as_of)
        need(history=history)
        return (value_analysis if table == "value_analysis" else ownership_trends)(players, history, period_col, as_of)
    if table == "team_form":
        need(teams=teams, fixtures=fixtures)
        axis = periods if periods is not None else _gameweeks_of(fixtures, period_col)
        return team_form(teams, fixtures, period_col, as_of, axis)
    if table == "fixture_runs":
        need(players_by_period=players_by_period, fixtures=fixtures, teams=teams)
        return fixture_runs(limited(players_by_period, period_col), fixtures, teams, period_col, as_of)
    if table == "fixture_difficulty":
        need(fixtures=fixtures, teams=teams)
        return limited(fixture_difficulty(fixtures, teams, as_of), "gameweek")
    if table == "betting_features":
        need(odds=odds, fixtures=fixtures, players_by_period=players_by_period)
        return limited(betting_features(odds, fixtures, players_by_period, as_of, period_col), "gameweek")
    raise ValueError(f"unknown derived table {table!r}")


def _gameweeks_of(fixtures: DataFrame, period_col: str) -> DataFrame:
    return (fixtures.where(F.col("event") >= 1).select(F.col("event").cast("int").alias(period_col)).distinct())
