"""Declared tables: every column with its type, nullability and limits (fixed values).

Eleven raw tables as the provider delivers them and the seven derived tables. A column is
declared by one call that names its type (``whole``, ``real``, ``text``, ``flag``, ``stamp``)
and what its values must keep to; series of columns that follow a rule are built from it.
"""

from __future__ import annotations

from .schemas import Col, Table


def whole(*names: str, lo=None, hi=None, nullable=False) -> dict[str, Col]:
    return {n: Col("bigint", nullable, lo, hi) for n in names}


def real(*names: str, lo=None, hi=None, nullable=False) -> dict[str, Col]:
    return {n: Col("double", nullable, lo, hi) for n in names}


def text(*names: str, least=None, most=None, values=(), nullable=False) -> dict[str, Col]:
    return {n: Col("string", nullable, values=tuple(values), least=least, most=most) for n in names}


def flag(*names: str) -> dict[str, Col]:
    return {n: Col("boolean") for n in names}


def stamp(*names: str, nullable=False) -> dict[str, Col]:
    return {n: Col("timestamp_ntz", nullable) for n in names}


STATUS = ("a", "i", "s", "u", "d", "n")
RANKED = ("influence", "creativity", "threat", "ict_index", "now_cost", "form", "points_per_game", "selected")
AS_OF = stamp("as_of_utc")

PLAYERS = Table(
    whole("player_id", "code", "team_code", lo=1)
    | text("web_name", "first_name", "second_name", least=1)
    | whole("team_id", lo=1, hi=20) | whole("position_id", lo=1, hi=4)
    | whole("squad_number", nullable=True)
    | flag("can_transact", "can_select") | text("status", values=STATUS)
    | real("chance_of_playing_next_round", "chance_of_playing_this_round", lo=0.0, hi=100.0, nullable=True)
    | text("news") | stamp("news_added", nullable=True)
    | whole("now_cost", lo=35, hi=200, nullable=True)
    | whole("cost_change_event", "cost_change_event_fall", "cost_change_start", "cost_change_start_fall", nullable=True)
    | text("value_form", "value_season", least=1)
    | whole("total_points", "event_points", nullable=True)
    | text("points_per_game", "form", "selected_by_percent", least=1)
    | whole("transfers_in", "transfers_out", "transfers_in_event", "transfers_out_event",
            "minutes", "starts", "goals_scored", "assists", "clean_sheets", "goals_conceded", "own_goals",
            "penalties_saved", "penalties_missed", "yellow_cards", "red_cards", "saves", "bonus", lo=0, nullable=True)
    | whole("bps", nullable=True)
    | text("influence", "creativity", "threat", "ict_index", least=1)
    | whole("clearances_blocks_interceptions", "recoveries", "tackles", "defensive_contribution", lo=0, nullable=True)
    | text("expected_goals", "expected_assists", "expected_goal_involvements", "expected_goals_conceded", least=1)
    | whole(*[f"{c}_{kind}" for c in RANKED for kind in ("rank", "rank_type")], nullable=True)
    | whole("corners_and_indirect_freekicks_order", "direct_freekicks_order", "penalties_order", nullable=True)
    | text("corners_and_indirect_freekicks_text", "direct_freekicks_text", "penalties_text")
    | real(*[f"{c}_per_90" for c in ("expected_goals", "saves", "expected_assists", "expected_goal_involvements",
                                     "expected_goals_conceded", "goals_conceded", "starts", "clean_sheets",
                                     "defensive_contribution")], lo=0.0)
    | text("photo", least=1) | flag("special", "removed", "in_dreamteam") | whole("dreamteam_count", lo=0)
    | whole("region", lo=0, nullable=True) | text("team_join_date", "birth_date", nullable=True)
    | flag("has_temporary_code") | text("opta_code", "ep_this", "ep_next", least=1) | AS_OF,
    ["player_id"])

TEAMS = Table(
    whole("team_id", lo=1, hi=20) | text("name", least=1) | text("short_name", least=3, most=3) | whole("code", lo=1)
    | whole("position", lo=1, hi=20) | whole("played", lo=0, hi=38) | whole("win", "draw", "loss", "points", lo=0)
    | text("form", nullable=True) | whole("strength", lo=1, hi=5)
    | whole("strength_overall_home", "strength_overall_away", "strength_attack_home", "strength_attack_away",
            "strength_defence_home", "strength_defence_away", lo=1)
    | whole("team_division", lo=1, nullable=True) | flag("unavailable") | whole("pulse_id", lo=1) | AS_OF,
    ["team_id", "name", "short_name", "code"])

EVENTS = Table(
    whole("event_id", lo=1, hi=38) | text("name", least=1)
    | stamp("deadline_time", "release_time", nullable=True)
    | whole("deadline_time_epoch", lo=0, nullable=True) | whole("deadline_time_game_offset", nullable=True)
    | flag("finished", "data_checked", "is_previous", "is_current", "is_next", "released", "can_enter", "can_manage",
           "cup_leagues_created", "h2h_ko_matches_created")
    | whole("average_entry_score", "highest_score", "highest_scoring_entry", "ranked_count", "most_selected",
            "most_transferred_in", "top_element", "most_captained", "most_vice_captained", "transfers_made",
            lo=0, nullable=True)
    | text("top_element_info", "chip_plays", "overrides") | AS_OF,
    ["event_id"])

GAME_SETTINGS = Table(
    whole("league_join_private_max", "league_join_public_max", "league_max_size_public_classic",
          "league_max_size_public_h2h", "league_max_size_private_h2h", "league_max_ko_rounds_private_h2h", lo=1)
    | text("league_prefix_public", least=1)
    | whole("league_points_h2h_win", "league_points_h2h_lose", "league_points_h2h_draw", lo=0)
    | flag("league_ko_first_instead_of_random")
    | whole("cup_start_event_id", "cup_stop_event_id", lo=1, hi=38, nullable=True)
    | text("cup_qualifying_method", "cup_type", nullable=True)
    | whole("squad_squadplay", "squad_squadsize", "squad_team_limit", "squad_total_spend", lo=1)
    | whole("squad_special_min", nullable=True) | whole("squad_special_max", lo=0, nullable=True)
    | whole("transfers_cap", "max_extra_free_transfers", lo=0) | real("transfers_sell_on_fee", lo=0.0, hi=1.0)
    | flag("element_sell_at_purchase_price") | whole("ui_currency_multiplier", lo=1)
    | flag("ui_use_special_shirts") | text("ui_special_shirt_exclusions")
    | flag("sys_vice_captain_enabled") | whole("stats_form_days", lo=1) | text("timezone", least=1)
    | text("featured_entries", "percentile_ranks", "underdog_differential", "league_h2h_tiebreak_stats") | AS_OF)

ELEMENT_STATS = Table(text("name", "label", least=1) | AS_OF, ["name"])

ELEMENT_TYPES = Table(
    whole("position_id", lo=1, hi=4) | text("plural_name", "singular_name", least=1)
    | text("plural_name_short", "singular_name_short", least=3, most=3) | whole("squad_select", lo=1)
    | whole("squad_min_select", lo=0, nullable=True) | whole("squad_max_select", lo=1, nullable=True)
    | flag("ui_shirt_specific") | AS_OF,
    ["position_id", "plural_name", "plural_name_short"])

CHIPS = Table(
    whole("chip_id", "number", lo=1) | text("name", least=1) | text("chip_type", values=("transfer", "team"))
    | whole("start_event", "stop_event", lo=1, hi=38) | text("overrides") | AS_OF, ["chip_id"])

PHASES = Table(
    whole("phase_id", lo=1) | text("name", least=1) | whole("start_event", "stop_event", lo=1, hi=38) | AS_OF, ["phase_id"])

FIXTURES = Table(
    whole("fixture_id", lo=1) | whole("event", lo=1, hi=38, nullable=True) | stamp("kickoff_utc", nullable=True)
    | whole("home_team_id", "away_team_id", lo=1, hi=20) | whole("code", lo=1)
    | flag("finished", "finished_provisional", "started")
    | whole("team_h_score", "team_a_score", lo=0, nullable=True)
    | whole("team_h_difficulty", "team_a_difficulty", lo=1, hi=5) | text("stats") | whole("pulse_id", lo=1) | AS_OF,
    ["fixture_id"])

SNAPSHOTS = Table(
    whole("player_id", lo=1, hi=800) | whole("gameweek", lo=1, hi=38) | text("status", values=STATUS)
    | real("chance_of_playing_next_round", "chance_of_playing_this_round", lo=0.0, hi=100.0, nullable=True)
    | text("news") | stamp("news_added", nullable=True) | whole("now_cost", lo=35, hi=200, nullable=True)
    | text("ep_this", "ep_next", "form", nullable=True)
    | whole("penalties_order", "corners_and_indirect_freekicks_order", "direct_freekicks_order", lo=0, hi=10, nullable=True)
    | flag("is_backfilled") | stamp("snapshot_date") | AS_OF,
    ["player_id,gameweek"])

# match result, shots, corners, fouls and cards of home and away, then prices by bookmaker
MATCH_STATS = ("HS", "AS", "HST", "AST", "HC", "AC", "HF", "AF", "HY", "AY", "HR", "AR")
RESULT_PRICES = tuple(f"{book}{side}" for book in ("B365", "PS", "Max", "Avg", "B365C", "PSC", "MaxC", "AvgC") for side in "HDA")
GOAL_PRICES = tuple(f"{book}_{way}_2_5" for book in ("B365", "BFE", "Max", "Avg") for way in ("over", "under"))
HANDICAP_PRICES = tuple(f"{book}AH{side}" for book in ("B365", "P", "Avg") for side in "HA")

BETTING_ODDS = Table(
    whole("fixture_id", lo=1) | stamp("match_date") | whole("home_team_id", "away_team_id", lo=1, hi=20)
    | text("referee", nullable=True) | whole(*MATCH_STATS, lo=0, nullable=True)
    | real(*RESULT_PRICES, *GOAL_PRICES, lo=1.0, nullable=True) | real("AHh", nullable=True)
    | real(*HANDICAP_PRICES, lo=1.0, nullable=True) | AS_OF,
    ["fixture_id"])

PLAYER_METRICS = Table(
    whole("player_id", lo=1) | text("web_name", least=1) | whole("team_id", lo=1, hi=20) | whole("position_id", lo=1, hi=4)
    | text("position_name", values=("GKP", "DEF", "MID", "FWD")) | real("current_price", lo=3.5, hi=20.0)
    | real("points_per_million", "form_per_million", "recent_form_5gw", "expected_points_per_game", lo=0.0)
    | real("value_score", lo=0.0, hi=100.0)
    | real("value_confidence", "season_consistency", "overperformance_risk", "ownership_risk", "injury_risk",
           "rotation_risk", "data_quality_score", lo=0.0, hi=1.0)
    | text("form_trend", values=("improving", "declining", "stable", "volatile")) | real("form_momentum", lo=-10.0, hi=10.0)
    | real("points_above_expected", "transfer_momentum")
    | text("ownership_trend", values=("rising", "falling", "stable"))
    | whole("set_piece_priority", lo=0, hi=3, nullable=True) | flag("penalty_taker", "corner_taker", "freekick_taker")
    | stamp("calculation_date") | text("calculation_version", least=1),
    ["player_id"])

TEAM_FORM = Table(
    whole("team_id", lo=1, hi=20) | text("team_name", "team_short_name", least=1)
    | real("overall_attack_strength", "overall_defense_strength", "home_attack_strength", "home_defense_strength",
           "away_attack_strength", "away_defense_strength", lo=0.0, hi=5.0)
    | real("overall_form_points", "home_form_points", "away_form_points", lo=0.0, hi=3.0)
    | real("team_goals_scored_home_5gw", "team_goals_conceded_home_5gw", "team_goals_scored_away_5gw",
           "team_goals_conceded_away_5gw", lo=0.0)
    | real("home_advantage") | real("venue_consistency", "attack_confidence", "defense_confidence", lo=0.0, hi=1.0)
    | text("form_trend", values=("improving", "declining", "stable")) | real("momentum", lo=-3.0, hi=3.0)
    | whole("games_analyzed", lo=1) | stamp("last_updated"),
    ["team_id"])

FIXTURE_DIFFICULTY = Table(
    whole("fixture_id", lo=1) | whole("team_id", "opponent_id", lo=1, hi=20) | whole("gameweek", lo=1, hi=38)
    | flag("is_home") | stamp("kickoff_time")
    | real("opponent_strength_difficulty", "venue_difficulty", "congestion_difficulty", "form_difficulty",
           "overall_difficulty", "expected_goals_for", "expected_goals_against", lo=0.0, hi=5.0)
    | whole("difficulty_tier", lo=1, hi=5) | real("difficulty_confidence", "clean_sheet_probability", lo=0.0, hi=1.0)
    | real("expected_points", lo=0.0, hi=3.0) | stamp("calculation_date") | text("factors_included"),
    ["fixture_id,team_id"])

VALUE_ANALYSIS = Table(
    whole("player_id", lo=1) | text("web_name", least=1) | whole("position_id", lo=1, hi=4)
    | real("current_price", lo=3.5, hi=20.0) | whole("total_points", lo=0)
    | real("points_per_pound", "expected_points_per_pound", "price_volatility", lo=0.0)
    | real("value_vs_position", "value_vs_price_tier", "predicted_price_change_1gw", "predicted_price_change_5gw")
    | real("buy_rating", "sell_rating", "hold_rating", lo=0.0, hi=10.0)
    | real("ownership_risk", "price_risk", "performance_risk", "confidence", lo=0.0, hi=1.0)
    | text("recommendation", values=("strong_buy", "buy", "hold", "sell", "strong_sell"))
    | stamp("analysis_date") | text("model_version"),
    ["player_id"])

OWNERSHIP_TRENDS = Table(
    whole("player_id", lo=1) | text("web_name", least=1) | real("selected_by_percent", lo=0.0, hi=100.0)
    | whole("transfers_in_gw", "transfers_out_gw", lo=0) | whole("net_transfers_gw")
    | real("avg_transfers_in_5gw", "avg_transfers_out_5gw", "ownership_vs_price", lo=0.0)
    | real("avg_net_transfers_5gw", "ownership_velocity")
    | text("transfer_momentum", values=("accelerating_in", "steady_in", "neutral", "steady_out", "accelerating_out"))
    | real("momentum_strength", "bandwagon_score", lo=0.0, hi=10.0)
    | text("ownership_tier", values=("template", "popular", "mid_owned", "differential", "punt"))
    | text("ownership_risk_level", values=("low", "medium", "high", "very_high"))
    | flag("template_player", "high_ownership_falling") | whole("gameweek", lo=1, hi=38) | stamp("last_updated"),
    ["player_id"])

BETTING_FEATURES = Table(
    whole("gameweek", lo=1, hi=38) | whole("fixture_id", "player_id", lo=1) | flag("is_home")
    | real("team_win_probability", "opponent_win_probability", "draw_probability", "implied_clean_sheet_probability",
           "market_consensus_strength", "favorite_status", lo=0.0, hi=1.0)
    | real("implied_total_goals", "team_expected_goals", lo=0.0, hi=10.0)
    | real("odds_movement_team", "asian_handicap_line", "expected_goal_difference", "over_under_signal")
    | real("odds_movement_magnitude", lo=0.0) | real("handicap_team_odds", lo=1.0) | whole("referee_encoded") | AS_OF,
    ["gameweek,fixture_id,player_id"])

FIXTURE_RUNS = Table(
    whole("player_id", lo=1) | whole("gameweek", lo=1, hi=38)
    | real("fixture_run_3gw_difficulty", "fixture_run_5gw_difficulty", lo=0.0, hi=5.0)
    | whole("green_fixtures_next_3", lo=0, hi=3) | whole("green_fixtures_next_5", lo=0, hi=5)
    | real("fixture_swing_upcoming") | flag("optimal_transfer_in_window", "optimal_transfer_out_window")
    | stamp("calculation_date"),
    ["player_id,gameweek"])

RAW = {
    "raw_players_bootstrap": PLAYERS, "raw_teams_bootstrap": TEAMS, "raw_events_bootstrap": EVENTS,
    "raw_game_settings": GAME_SETTINGS, "raw_element_stats": ELEMENT_STATS, "raw_element_types": ELEMENT_TYPES,
    "raw_chips": CHIPS, "raw_phases": PHASES, "raw_fixtures": FIXTURES, "raw_player_gameweek_snapshot": SNAPSHOTS,
    "raw_betting_odds": BETTING_ODDS,
}
DERIVED = {
    "player_metrics": PLAYER_METRICS, "team_form": TEAM_FORM, "fixture_difficulty": FIXTURE_DIFFICULTY,
    "value_analysis": VALUE_ANALYSIS, "ownership_trends": OWNERSHIP_TRENDS, "betting_features": BETTING_FEATURES,
    "fixture_runs": FIXTURE_RUNS,
}
TABLES = RAW | DERIVED
