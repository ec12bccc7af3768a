"""Feature tables on small hand-written rows (branch thresholds on both sides)."""
import datetime as dt

import pytest
from pyspark.sql import functions as F

from matchday.plans import features as feat

AS_OF = dt.datetime(2025, 1, 1)
P_SCHEMA = ("player_id int, web_name string, team_id int, position_id int, now_cost int, total_points int, form string, "
            "minutes int, selected_by_percent string, transfers_in_event int, transfers_out_event int, "
            "penalties_order int, corners_and_indirect_freekicks_order int, direct_freekicks_order int, "
            "chance_of_playing_next_round double")


@pytest.fixture()
def players(spark):
    rows = [
        (1, "neg", 1, 1, 50, -5, "5.0", 900, "40.0", 7000, 100, 1, 1, 1, None),
        (2, "nullform", 1, 1, 50, 100, None, 0, None, 100, 2000, None, None, None, 75.0),
        (3, "badform", 2, 2, 0, 50, "abc", 1500, "4.9", 1000, 0, 2, 1, None, 0.0),
        (4, "pos9", 2, 9, 100, 80, "2.4", 90, "15", 0, 6000, None, None, 1, 100.0),
        (5, "tie", 1, 1, 50, 100, "3.5", 1800, "30.1", 2000, 0, None, None, None, 50.0),
    ]
    return spark.createDataFrame(rows, P_SCHEMA)


def test_player_metrics_rules(spark, players):
    got = {r.player_id: r for r in feat.player_metrics(players, 10, AS_OF).collect()}
    assert got[1].points_per_million == 0.0 and got[1].form_trend == "improving"
    assert got[1].set_piece_priority == 3 and got[1].penalty_taker and got[1].ownership_trend == "rising"
    assert got[2].form_trend == "stable" and got[2].expected_points_per_game == 3.0 and got[2].recent_form_5gw == 0.0
    assert got[2].ownership_risk == pytest.approx(0.1) and got[2].ownership_trend == "falling"
    assert got[3].points_per_million == 0.0 and got[3].form_per_million == 0.0  # price 0
    assert got[3].value_confidence == 1.0 and got[3].injury_risk == 1.0
    assert got[4].value_score == 50.0 and got[4].form_trend == "declining" and got[4].position_name is None
    # position 1: ppm 0, 20, 20 -> ranks 1, 2.5, 2.5 of 3
    assert got[1].value_score == pytest.approx(100 / 3) and got[2].value_score == pytest.approx(250 / 3)
    assert got[5].value_score == got[2].value_score
    assert got[2].injury_risk == pytest.approx(0.25) and got[1].injury_risk == 0.0
    assert got[5].points_above_expected == pytest.approx(100 - 3.5 * 1800 / 90)


def test_value_and_ownership_new_players(spark, players):
    hist = spark.createDataFrame([(1, 3), (3, 2), (4, 4), (5, 9)], "player_id int, gameweek int")
    va = {r.player_id: r for r in feat.value_analysis(players, hist, 5, AS_OF).collect()}
    # players 2 and 5 have no history before gw 5 -> new
    assert va[2].points_per_pound == 0.5 and va[2].value_vs_position == 1.0 and va[2].recommendation == "strong_sell"
    assert va[2].predicted_price_change_1gw == 0.0 and va[2].price_risk == 0.0
    assert va[1].total_points == 0 and va[1].points_per_pound == 0.0
    assert va[4].points_per_pound == pytest.approx(8.0) and va[4].buy_rating == 4.0 and va[4].recommendation == "hold"
    assert va[4].price_risk == pytest.approx(0.06) and va[4].value_vs_position == 50.0
    ot = {r.player_id: r for r in feat.ownership_trends(players, hist, 5, AS_OF).collect()}
    assert ot[2].ownership_tier == "punt" and ot[2].transfer_momentum == "neutral" and ot[2].bandwagon_score == 0.0
    assert ot[2].momentum_strength == pytest.approx(1.9)  # same formula for new players
    assert ot[1].transfer_momentum == "accelerating_in" and ot[1].ownership_tier == "template"
    assert ot[1].ownership_risk_level == "very_high" and not ot[1].template_player
    assert ot[4].transfer_momentum == "accelerating_out" and ot[4].ownership_tier == "popular"
    assert ot[3].ownership_tier == "differential" and ot[3].ownership_vs_price == 0.0
    assert ot[5].high_ownership_falling is False and ot[5].template_player is False


def test_neutral_backfill(spark, players):
    new = spark.createDataFrame([(2,)], "player_id int")
    rows = feat.neutral_backfill(players, new, 4, "ownership", AS_OF).collect()
    assert sorted(r.gameweek for r in rows) == [1, 2, 3]
    assert all(r.ownership_vs_price == pytest.approx(0.2) and r.ownership_tier == "punt" for r in rows)
    v = feat.neutral_backfill(players, new, 4, "value", AS_OF).collect()
    assert len(v) == 3 and v[0].recommendation == "hold" and v[0].buy_rating == 5.0
    assert feat.neutral_backfill(players, new, 1, "value", AS_OF).count() == 0


T_SCHEMA = ("team_id int, name string, short_name string, strength_overall_home int, strength_overall_away int, "
            "strength_attack_home int, strength_attack_away int, strength_defence_home int, strength_defence_away int")
F_SCHEMA = ("fixture_id int, event int, kickoff_utc timestamp, home_team_id int, away_team_id int, finished boolean, "
            "team_h_score int, team_a_score int")


@pytest.fixture()
def teams(spark):
    return spark.createDataFrame([
        (1, "A", "AAA", 1000, 1160, 1200, 1100, 1300, 1250),
        (2, "B", "BBB", 1400, 1600, 1200, 1100, 1300, 1250),
        (3, "C", "CCC", 1160, 1000, 1200, 1100, 1300, 1250)], T_SCHEMA)


@pytest.fixture()
def fixtures(spark):
    ts = dt.datetime(2025, 1, 1)
    return spark.createDataFrame([
        (1, 8, ts, 1, 2, True, 2, 1), (2, 9, ts, 2, 1, True, None, None), (3, 9, ts, 3, 1, False, None, None),
        (4, 10, ts, 1, 3, False, None, None), (5, 10, ts, 4, 1, False, None, None),
        (6, 11, ts, 2, 1, False, None, None), (7, 12, ts, 1, 3, False, None, None),
        (8, 13, ts, 3, 1, False, None, None), (9, None, ts, 1, 2, False, None, None)], F_SCHEMA)


def test_team_form_goal_window(spark, teams, fixtures):
    got = {r.team_id: r for r in feat.team_form(teams, fixtures, 10, AS_OF).collect()}
    assert got[1].team_goals_scored_home_5gw == 2.0 and got[1].team_goals_conceded_home_5gw == 1.0
    assert got[1].team_goals_scored_away_5gw == 0.0  # finished but null scores
    assert got[3].team_goals_scored_home_5gw == 0.0  # no finished games
    assert got[2].overall_attack_strength == 5.0  # 1600/300 clipped
    assert got[1].home_advantage == pytest.approx(0.2) and got[1].venue_consistency == pytest.approx(1 - 0.2 / 3)


def test_fixture_difficulty(spark, teams, fixtures):
    got = {(r.fixture_id, r.team_id): r for r in feat.fixture_difficulty(fixtures, teams, AS_OF).collect()}
    assert (9, 1) not in got  # null gameweek skipped
    home = got[(1, 1)]  # opponent 2 away rating 1600 -> clip 5.0
    assert home.opponent_strength_difficulty == 5.0 and home.venue_difficulty == pytest.approx(4.5)
    away = got[(1, 2)]  # opponent 1 home rating 1000 -> 3.333
    assert away.opponent_strength_difficulty == pytest.approx(1000 / 300) and away.difficulty_tier == 3
    assert away.venue_difficulty == pytest.approx(1000 / 300 * 1.1)
    missing = got[(5, 1)]  # team 4 missing -> 1000
    assert missing.opponent_strength_difficulty == pytest.approx(1000 / 300)
    assert home.expected_goals_for == 1.5 and home.clean_sheet_probability == pytest.approx(0.1)


def test_fixture_runs(spark, teams, fixtures, players):
    got = {r.player_id: r for r in feat.fixture_runs(players, fixtures, teams, 10, AS_OF).collect()}
    # team 1 from gw 10: fx4 (home v 3: away 1000 ->0), fx5 (away at 4: missing 1200 -> 2.5),
    # fx6 (away at 2: home 1400 -> 5), fx7 (home v 3 -> 0), fx8 (away at 3: home 1160 -> 2)
    p1 = got[1]
    assert p1.fixture_run_3gw_difficulty == pytest.approx((0 + 2.5 + 5) / 3)
    assert p1.fixture_run_5gw_difficulty == pytest.approx(9.5 / 5)
    assert p1.green_fixtures_next_3 == 1 and p1.green_fixtures_next_5 == 3
    assert p1.fixture_swing_upcoming == pytest.approx(7 / 3 - 1.25)
    assert p1.optimal_transfer_out_window is True and p1.optimal_transfer_in_window is False
    # team 2 (player 4): one upcoming fixture at home to team 1 (away rating 1160 -> 2.0)
    assert got[4].fixture_run_3gw_difficulty == 2.0 and got[4].green_fixtures_next_3 == 1
    assert got[4].fixture_swing_upcoming == 0.0 and got[4].optimal_transfer_in_window is False
    lone = spark.createDataFrame([(99, 42)], "player_id int, team_id int")
    n = feat.fixture_runs(lone, fixtures, teams, 10, AS_OF).first()
    assert (n.fixture_run_3gw_difficulty, n.fixture_run_5gw_difficulty, n.green_fixtures_next_5) == (2.5, 2.5, 0)


ODDS_COLS = ["fixture_id", "referee", "B365H", "B365D", "B365A", "PSH", "PSD", "PSA", "MaxH", "MaxD", "MaxA",
             "AvgH", "AvgD", "AvgA", "B365CH", "B365CD", "B365CA", "AvgCH", "AvgCD", "AvgCA", "Avg_over_2_5",
             "Avg_under_2_5", "B365_over_2_5", "B365_under_2_5", "AHh", "AvgAHH", "AvgAHA", "B365AHH", "B365AHA"]


def test_betting_features_fallbacks_and_defaults(spark, fixtures, players):
    schema = "fixture_id int, referee string, " + ", ".join(f"{c} double" for c in ODDS_COLS[2:])
    full = [1, "Ref A", 2.0, 3.4, 4.0, 2.1, 3.3, 3.9, 2.2, 3.6, 4.2, 2.05, 3.45, 4.05, 1.9, 3.5, 4.3, 1.95, 3.4,
            4.2, 1.9, 1.95, 1.8, 2.0, -0.5, 1.9, 2.0, 1.85, 2.05]
    none = [3, ""] + [None] * (len(ODDS_COLS) - 2)
    odds = spark.createDataFrame([tuple(full), tuple(none)], schema)
    got = {(r.fixture_id, r.player_id): r for r in feat.betting_features(odds, fixtures, players, AS_OF).collect()}
    h = got[(1, 1)]  # home side of fixture 1 (team 1)
    ph, pd_, pa = 1 / 1.95, 1 / 3.4, 1 / 4.2
    tot = ph + pd_ + pa
    assert h.team_win_probability == pytest.approx(ph / tot) and h.draw_probability == pytest.approx(pd_ / tot)
    assert h.is_home and h.favorite_status == 1.0 and h.asian_handicap_line == -0.5
    assert h.odds_movement_team == pytest.approx(1.95 - 2.05) and h.handicap_team_odds == 1.9
    assert h.referee_encoded >= 0 and h.implied_total_goals > 0
    a = got[(1, 3)]  # away team 2 has player 3
    assert not a.is_home and a.asian_handicap_line == 0.5 and a.favorite_status == 0.0
    assert a.team_win_probability == pytest.approx(pa / tot)
    d = got[(3, 1)]  # no odds at all -> defaults
    assert (d.team_win_probability, d.implied_total_goals, d.team_expected_goals) == (0.33, 2.5, 1.25)
    assert (d.market_consensus_strength, d.handicap_team_odds, d.referee_encoded) == (0.5, 2.0, -1)
    assert d.favorite_status == 0.0  # both odds missing: not the favourite


def test_derive_periods_ranks_per_gameweek(spark, players):
    two = players.withColumn("gameweek", F.lit(1)).unionByName(players.withColumn("gameweek", F.lit(2)))
    out = feat.derive_periods("player_metrics", two, AS_OF).collect()
    by = {(r.player_id, r.gameweek): r.value_score for r in out}
    assert len(out) == 10 and by[(2, 1)] == by[(2, 2)] == pytest.approx(250 / 3)
    with pytest.raises(ValueError):
        feat.derive_periods("value_analysis", two, AS_OF)
