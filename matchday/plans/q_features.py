"""Catalog entries for the feature tables and their formulas (I1-I8, E1,
E2, E5, D1, D5, H1-H9, B7, C8)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.cols import (classify, clean_sheet, consensus, devig2, devig3, first_pair, poisson_lambda_ge3,
                              stable_bucket, tier)
from ..operators.joins import new_entities
from ..operators.rank import pct_rank_avg
from ..operators.reshape import fixture_sides
from . import bindings as b
from . import features as feat
from .bindings import AS_OF, AS_OF_SQL, GAMEWEEK, with_bindings
from .catalog import B, CLIP, D, NUM, R, conform, query

GW = GAMEWEEK
LO5 = max(1, GW - 5)

# ----------------------------------------------------------------------------- E1
query("pct_rank_in_group", sql=f"""
SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, l_returnflag, l_linestatus,
  {R("CASE WHEN l_linestatus = 'F' AND l_extendedprice IS NOT NULL THEN "
     "(CAST(rank() OVER (PARTITION BY l_returnflag, l_linestatus = 'F' ORDER BY l_extendedprice) AS DOUBLE) "
     "+ CAST(count(*) OVER (PARTITION BY l_returnflag, l_linestatus = 'F', l_extendedprice) - 1 AS DOUBLE) / 2.0) "
     "/ CAST(count(*) OVER (PARTITION BY l_returnflag, l_linestatus = 'F') AS DOUBLE) * 100.0 ELSE 50.0 END")} AS pct
FROM lineitem""")(lambda spark, d: conform(
    pct_rank_avg(b.read(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_returnflag", "l_linestatus",
                                                        "l_extendedprice"),
                 "l_extendedprice", "l_returnflag", out="pct", valid=F.col("l_linestatus") == "F")
    .select("l_orderkey", "l_linenumber", "l_returnflag", "l_linestatus", "pct")))

# ----------------------------------------------------------------------------- E5
_SIDES_SQL = """SELECT fixture_id, event, home_team_id AS team_id, away_team_id AS opponent_id, TRUE AS is_home,
  team_h_score AS goals_for, team_a_score AS goals_against FROM b_fixtures
UNION ALL
SELECT fixture_id, event, away_team_id, home_team_id, FALSE, team_a_score, team_h_score FROM b_fixtures"""

query("perspective_unpivot", sql=with_bindings(
    f"SELECT fixture_id, {B('event')} AS event, team_id, opponent_id, is_home, {D('goals_for')} AS goals_for, "
    f"{D('goals_against')} AS goals_against FROM ({_SIDES_SQL})", "b_fixtures"))(
    lambda spark, d: conform(_doubles(fixture_sides(b.fixtures(spark, d), home_score="team_h_score",
                                                    away_score="team_a_score", keep=["fixture_id", "event"]),
                                      "goals_for", "goals_against")))


def _doubles(df, *cols):
    return df.withColumns({c: F.col(c).cast("double") for c in cols})




# ----------------------------------------------------------------------------- D1
query("rolling_goals", sql=with_bindings(f"""
SELECT team_id,
  {D("sum(CASE WHEN is_home THEN goals_for END)")} AS team_goals_scored_home_5gw,
  {D("sum(CASE WHEN is_home THEN goals_against END)")} AS team_goals_conceded_home_5gw,
  {D("sum(CASE WHEN NOT is_home THEN goals_for END)")} AS team_goals_scored_away_5gw,
  {D("sum(CASE WHEN NOT is_home THEN goals_against END)")} AS team_goals_conceded_away_5gw
FROM ({_SIDES_SQL.replace('FROM b_fixtures', 'FROM b_fixtures WHERE coalesce(finished, FALSE)')})
WHERE event >= {LO5} AND event < {GW}
GROUP BY team_id""", "b_fixtures"))(lambda spark, d: conform(_doubles(
    feat.goal_window(b.fixtures(spark, d), GW), "team_goals_scored_home_5gw", "team_goals_conceded_home_5gw",
    "team_goals_scored_away_5gw", "team_goals_conceded_away_5gw")))

# ----------------------------------------------------------------------------- I3


def _diff_sql() -> str:
    b_ = "b_"
    return with_bindings(f"""
, j AS (
  SELECT s.*, CASE WHEN s.is_home THEN {CLIP("coalesce(t.strength_overall_away, 1000) / 300.0", "0.0", "5.0")}
                   ELSE {CLIP("coalesce(t.strength_overall_home, 1000) / 300.0", "0.0", "5.0")} END AS {b_}
  FROM (SELECT fixture_id, event, kickoff_utc, home_team_id AS team_id, away_team_id AS opponent_id, TRUE AS is_home
        FROM b_fixtures WHERE home_team_id IS NOT NULL AND away_team_id IS NOT NULL AND event IS NOT NULL
        UNION ALL
        SELECT fixture_id, event, kickoff_utc, away_team_id, home_team_id, FALSE
        FROM b_fixtures WHERE home_team_id IS NOT NULL AND away_team_id IS NOT NULL AND event IS NOT NULL) s
  LEFT JOIN b_teams t ON s.opponent_id = t.team_id)
SELECT fixture_id, team_id, opponent_id, {B("event")} AS gameweek, is_home, kickoff_utc AS kickoff_time,
  {R(b_)} AS opponent_strength_difficulty,
  {R(f"{b_} * CASE WHEN is_home THEN 0.9 ELSE 1.1 END")} AS venue_difficulty,
  {R("2.5")} AS congestion_difficulty, {R(b_)} AS form_difficulty, {R(b_)} AS overall_difficulty,
  {B(f"least(greatest(CASE WHEN {b_} >= 0 THEN floor({b_}) ELSE ceil({b_}) END, 1), 5)")} AS difficulty_tier,
  {R("0.75")} AS difficulty_confidence,
  {R(f"greatest(3.0 - {b_} * 0.3, 0.5)")} AS expected_goals_for,
  {R(f"greatest({b_} * 0.3, 0.2)")} AS expected_goals_against,
  {R(f"greatest(3.0 - {b_} * 0.4, 0.3)")} AS expected_points,
  {R(f"greatest(0.8 - {b_} * 0.15, 0.1)")} AS clean_sheet_probability,
  {AS_OF_SQL} AS calculation_date, '["opponent_strength", "venue", "form"]' AS factors_included
FROM j""", "b_fixtures", "b_teams").replace("\n, j AS", ", j AS", 1)


query("difficulty", sql=_diff_sql())(
    lambda spark, d: conform(feat.fixture_difficulty(b.fixtures(spark, d), b.teams(spark, d), AS_OF)))

# ----------------------------------------------------------------------------- I2


def _s(col: str) -> str:
    return R(CLIP(f"{col} / 300.0", "0.0", "5.0"))


query("team_form", sql=with_bindings(f"""
, g AS (
  SELECT team_id,
    sum(CASE WHEN is_home THEN goals_for END) AS sh, sum(CASE WHEN is_home THEN goals_against END) AS ch,
    sum(CASE WHEN NOT is_home THEN goals_for END) AS sa, sum(CASE WHEN NOT is_home THEN goals_against END) AS ca
  FROM ({_SIDES_SQL.replace('FROM b_fixtures', 'FROM b_fixtures WHERE coalesce(finished, FALSE)')})
  WHERE event >= {LO5} AND event < {GW} GROUP BY team_id)
SELECT t.team_id, t.name AS team_name, t.short_name AS team_short_name,
  {_s("strength_overall_away")} AS overall_attack_strength,
  {_s("strength_defence_home")} AS overall_defense_strength,
  {R("1.5")} AS overall_form_points,
  {_s("strength_attack_home")} AS home_attack_strength,
  {_s("strength_defence_home")} AS home_defense_strength,
  {R("1.6")} AS home_form_points,
  {R("coalesce(g.sh, 0)")} AS team_goals_scored_home_5gw, {R("coalesce(g.ch, 0)")} AS team_goals_conceded_home_5gw,
  {_s("strength_attack_away")} AS away_attack_strength,
  {_s("strength_defence_away")} AS away_defense_strength,
  {R("1.4")} AS away_form_points,
  {R("coalesce(g.sa, 0)")} AS team_goals_scored_away_5gw, {R("coalesce(g.ca, 0)")} AS team_goals_conceded_away_5gw,
  {R("CAST(1.6 AS DOUBLE) - CAST(1.4 AS DOUBLE)")} AS home_advantage,
  {R("1.0 - abs(CAST(1.6 AS DOUBLE) - CAST(1.4 AS DOUBLE)) / 3.0")} AS venue_consistency,
  'stable' AS form_trend, {R("0.0")} AS momentum, {R("0.75")} AS attack_confidence, {R("0.75")} AS defense_confidence,
  {B(str(GW))} AS gameweek, {B("6")} AS games_analyzed, {AS_OF_SQL} AS last_updated
FROM b_teams t LEFT JOIN g ON t.team_id = g.team_id""", "b_fixtures", "b_teams").replace("\n, g AS", ", g AS", 1))(
    lambda spark, d: conform(feat.team_form(b.teams(spark, d), b.fixtures(spark, d), GW, AS_OF)))

# ----------------------------------------------------------------------------- E2 / I6
_RUNS_SQL = f"""
, s AS (
  SELECT fixture_id, event, home_team_id AS team_id, away_team_id AS opponent_id, TRUE AS is_home FROM b_fixtures
  WHERE home_team_id IS NOT NULL AND away_team_id IS NOT NULL AND event BETWEEN {GW} AND {GW + 5}
  UNION ALL
  SELECT fixture_id, event, away_team_id, home_team_id, FALSE FROM b_fixtures
  WHERE home_team_id IS NOT NULL AND away_team_id IS NOT NULL AND event BETWEEN {GW} AND {GW + 5}),
d AS (
  SELECT s.team_id, s.event, s.fixture_id,
    {CLIP("(CASE WHEN s.is_home THEN coalesce(t.strength_overall_away, 1200) ELSE coalesce(t.strength_overall_home, 1200) END - 1000) / 80.0", "0.0", "5.0")} AS diff,
    row_number() OVER (PARTITION BY s.team_id ORDER BY s.event, s.fixture_id) AS rn
  FROM s LEFT JOIN b_teams t ON s.opponent_id = t.team_id),
runs AS (
  SELECT team_id,
    avg(CASE WHEN rn <= 3 THEN diff END) AS r3, avg(CASE WHEN rn <= 5 THEN diff END) AS r5,
    count(CASE WHEN rn <= 3 AND diff <= 2.0 THEN 1 END) AS g3, count(CASE WHEN rn <= 5 AND diff <= 2.0 THEN 1 END) AS g5,
    CASE WHEN count(*) >= 5 THEN avg(CASE WHEN rn BETWEEN 3 AND 5 THEN diff END) - avg(CASE WHEN rn <= 2 THEN diff END)
         ELSE 0.0 END AS sw
  FROM d GROUP BY team_id)"""

query("fixture_runs", sql=with_bindings(_RUNS_SQL.replace("\n, s AS", ", s AS", 1) + f"""
SELECT p.player_id, {B(str(GW))} AS gameweek,
  {R("coalesce(r3, 2.5)")} AS fixture_run_3gw_difficulty, {R("coalesce(r5, 2.5)")} AS fixture_run_5gw_difficulty,
  {B("coalesce(g3, 0)")} AS green_fixtures_next_3, {B("coalesce(g5, 0)")} AS green_fixtures_next_5,
  {R("coalesce(sw, 0.0)")} AS fixture_swing_upcoming,
  (coalesce(r3, 2.5) <= 2.0 AND coalesce(g3, 0) >= 2) AS optimal_transfer_in_window,
  (coalesce(r3, 2.5) >= 3.5 OR coalesce(sw, 0.0) > 1.0) AS optimal_transfer_out_window,
  {AS_OF_SQL} AS calculation_date
FROM b_players p LEFT JOIN runs r ON p.team_id = r.team_id""", "b_fixtures", "b_teams", "b_players"))(
    lambda spark, d: conform(feat.fixture_runs(b.players(spark, d), b.fixtures(spark, d), b.teams(spark, d),
                                               GW, AS_OF)))

# ----------------------------------------------------------------------------- H1 / H2 / H3 / H4 / H5 / H6 / D5 / H8


def _devig2_sql(a: str, b_: str) -> str:
    return f"(CASE WHEN {a} > 0 AND {b_} > 0 THEN (1.0 / {a}) / ((1.0 / {a}) + (1.0 / {b_})) END)"


query("devig_two_way", sql=with_bindings(f"""
SELECT fixture_id, {R(_devig2_sql("Avg_over_2_5", "Avg_under_2_5"))} AS p_over,
  {R(_devig2_sql("B365H", "B365A"))} AS p_home_two_way
FROM b_odds""", "b_odds"))(lambda spark, d: conform(b.odds(spark, d).select(
    "fixture_id", devig2("Avg_over_2_5", "Avg_under_2_5").alias("p_over"),
    devig2("B365H", "B365A").alias("p_home_two_way"))))

_SEL_SQL = """coalesce(AvgCH, B365CH, AvgH) AS h_sel, coalesce(AvgCA, B365CA, AvgA) AS a_sel,
  coalesce(AvgCD, B365CD, AvgD, B365D) AS d_sel"""


def _devig3_sql(x: str) -> str:
    ok = "(h_sel > 0 AND d_sel > 0 AND a_sel > 0)"
    tot = "(1.0 / h_sel + 1.0 / d_sel + 1.0 / a_sel)"
    return f"(CASE WHEN {ok} THEN (1.0 / {x}) / {tot} END)"


query("normalise_three_way", sql=with_bindings(f"""
SELECT fixture_id, {R(_devig3_sql("h_sel"))} AS p_home, {R(_devig3_sql("d_sel"))} AS p_draw,
  {R(_devig3_sql("a_sel"))} AS p_away
FROM (SELECT fixture_id, {_SEL_SQL} FROM b_odds)""", "b_odds"))(
    lambda spark, d: conform(b.odds(spark, d).select(
        "fixture_id",
        *[c.alias(n) for c, n in zip(devig3(F.coalesce("AvgCH", "B365CH", "AvgH"),
                                            F.coalesce("AvgCD", "B365CD", "AvgD", "B365D"),
                                            F.coalesce("AvgCA", "B365CA", "AvgA")),
                                     ["p_home", "p_draw", "p_away"])])))

_OU_SQL = """CASE WHEN Avg_over_2_5 IS NOT NULL AND Avg_under_2_5 IS NOT NULL THEN Avg_over_2_5
       WHEN B365_over_2_5 IS NOT NULL AND B365_under_2_5 IS NOT NULL THEN B365_over_2_5 END AS ou_o,
  CASE WHEN Avg_over_2_5 IS NOT NULL AND Avg_under_2_5 IS NOT NULL THEN Avg_under_2_5
       WHEN B365_over_2_5 IS NOT NULL AND B365_under_2_5 IS NOT NULL THEN B365_under_2_5 END AS ou_u"""


def _bisect_sql(src: str) -> str:
    """Recursive-CTE bisection, one row per (fixture_id, step)."""
    m = "((lo + hi) / 2.0)"
    p_mid = f"(1.0 - exp(-{m}) * (1.0 + {m} + ({m} * {m}) / 2.0))"
    return f"""bis(fixture_id, i, lo, hi, t) AS (
  SELECT fixture_id, 0, CAST(0.0 AS DOUBLE), CAST(8.0 AS DOUBLE), least(greatest(p, 1e-6), 1.0 - 1e-6)
  FROM {src} WHERE p IS NOT NULL
  UNION ALL
  SELECT fixture_id, i + 1, CASE WHEN {p_mid} < t THEN {m} ELSE lo END,
         CASE WHEN {p_mid} < t THEN hi ELSE {m} END, t
  FROM bis WHERE i < 40),
lam AS (SELECT fixture_id, (lo + hi) / 2.0 AS tot FROM bis WHERE i = 40)"""


_POIS = f"""
, ou AS (SELECT fixture_id, {_OU_SQL} FROM b_odds),
pr AS (SELECT fixture_id, {_devig2_sql("ou_o", "ou_u")} AS p FROM ou),
{_bisect_sql("pr")}"""

query("poisson_lambda", sql="WITH RECURSIVE " + with_bindings(_POIS.replace("\n, ou AS", ", ou AS", 1) + f"""
SELECT pr.fixture_id, {R("p")} AS p_over, {R("lam.tot")} AS implied_total_goals
FROM pr LEFT JOIN lam ON pr.fixture_id = lam.fixture_id""", "b_odds")[len("WITH "):])(
    lambda spark, d: conform(_pois_spark(spark, d)))


def _pois_spark(spark, d):
    o = b.odds(spark, d)
    over, under = first_pair(("Avg_over_2_5", "Avg_under_2_5"), ("B365_over_2_5", "B365_under_2_5"))
    p = devig2(over, under)
    return o.select("fixture_id", p.alias("p_over")).select(
        "fixture_id", "p_over", poisson_lambda_ge3(F.col("p_over")).alias("implied_total_goals"))


query("goal_split", sql="WITH RECURSIVE " + with_bindings(_POIS.replace("\n, ou AS", ", ou AS", 1) + f"""
, pp AS (SELECT fixture_id, {_devig3_sql("h_sel")} AS ph, {_devig3_sql("d_sel")} AS pd, {_devig3_sql("a_sel")} AS pa
         FROM (SELECT fixture_id, {_SEL_SQL} FROM b_odds)),
x AS (SELECT pp.fixture_id, lam.tot, ph, pd, pa,
        CASE WHEN lam.tot IS NOT NULL AND ph IS NOT NULL AND pd IS NOT NULL AND pa IS NOT NULL
                  AND (ph + 0.5 * pd) + (pa + 0.5 * pd) > 0
             THEN lam.tot * ((ph + 0.5 * pd) / ((ph + 0.5 * pd) + (pa + 0.5 * pd))) END AS hxg,
        CASE WHEN lam.tot IS NOT NULL AND ph IS NOT NULL AND pd IS NOT NULL AND pa IS NOT NULL
                  AND (ph + 0.5 * pd) + (pa + 0.5 * pd) > 0
             THEN lam.tot * ((pa + 0.5 * pd) / ((ph + 0.5 * pd) + (pa + 0.5 * pd))) END AS axg
      FROM pp LEFT JOIN lam ON pp.fixture_id = lam.fixture_id)
SELECT fixture_id, {R("hxg")} AS home_xg, {R("axg")} AS away_xg,
  {R(CLIP("1.0 - tot * (CASE WHEN hxg IS NOT NULL AND tot IS NOT NULL AND tot > 0 THEN hxg / tot END) * 0.3", "0.0", "1.0"))} AS home_clean_sheet,
  {R(CLIP("1.0 - tot * (CASE WHEN axg IS NOT NULL AND tot IS NOT NULL AND tot > 0 THEN axg / tot END) * 0.3", "0.0", "1.0"))} AS away_clean_sheet
FROM x""", "b_odds")[len("WITH "):])(lambda spark, d: conform(_goal_split_spark(spark, d)))


def _goal_split_spark(spark, d):
    o = b.odds(spark, d)
    f = feat.odds_fixture_features(o)
    return f.select("fixture_id", F.col("__hxg").alias("home_xg"), F.col("__axg").alias("away_xg"),
                    clean_sheet("__tot", "__hxg").alias("home_clean_sheet"),
                    clean_sheet("__tot", "__axg").alias("away_clean_sheet"))


def _consensus_sql(*cols: str) -> str:
    n = " + ".join(f"(CASE WHEN {c} IS NOT NULL THEN 1.0 ELSE 0.0 END)" for c in cols)
    s = " + ".join(f"coalesce({c}, 0.0)" for c in cols)
    mean = f"(({s}) / ({n}))"
    ss = " + ".join(f"(CASE WHEN {c} IS NOT NULL THEN ({c} - {mean}) * ({c} - {mean}) ELSE 0.0 END)" for c in cols)
    return (f"(CASE WHEN ({n}) > 0 AND {mean} <> 0 THEN "
            f"{CLIP(f'1.0 - sqrt(({ss}) / ({n})) / {mean}', '0.0', '1.0')} END)")


query("row_consensus", sql=with_bindings(f"""
SELECT fixture_id, {R(_consensus_sql("B365H", "PSH", "MaxH", "AvgH"))} AS consensus_home,
  {R(_consensus_sql("B365A", "PSA", "MaxA", "AvgA"))} AS consensus_away,
  {R(_consensus_sql("AvgCH", "B365CH"))} AS consensus_close_home
FROM b_odds""", "b_odds"))(lambda spark, d: conform(b.odds(spark, d).select(
    "fixture_id", consensus("B365H", "PSH", "MaxH", "AvgH").alias("consensus_home"),
    consensus("B365A", "PSA", "MaxA", "AvgA").alias("consensus_away"),
    consensus("AvgCH", "B365CH").alias("consensus_close_home"))))

query("odds_fallback", sql=with_bindings(f"""
SELECT fixture_id, {R("coalesce(AvgCH, B365CH, AvgH)")} AS home_odds, {R("coalesce(AvgCA, B365CA, AvgA)")} AS away_odds,
  {R("coalesce(AvgCD, B365CD, AvgD, B365D)")} AS draw_odds,
  {R("CASE WHEN Avg_over_2_5 IS NOT NULL AND Avg_under_2_5 IS NOT NULL THEN Avg_over_2_5 WHEN B365_over_2_5 IS NOT NULL AND B365_under_2_5 IS NOT NULL THEN B365_over_2_5 END")} AS over_odds,
  {R("CASE WHEN Avg_over_2_5 IS NOT NULL AND Avg_under_2_5 IS NOT NULL THEN Avg_under_2_5 WHEN B365_over_2_5 IS NOT NULL AND B365_under_2_5 IS NOT NULL THEN B365_under_2_5 END")} AS under_odds
FROM b_odds""", "b_odds"))(lambda spark, d: conform(_fallback_spark(spark, d)))


def _fallback_spark(spark, d):
    o = b.odds(spark, d)
    over, under = first_pair(("Avg_over_2_5", "Avg_under_2_5"), ("B365_over_2_5", "B365_under_2_5"))
    return o.select("fixture_id", F.coalesce("AvgCH", "B365CH", "AvgH").alias("home_odds"),
                    F.coalesce("AvgCA", "B365CA", "AvgA").alias("away_odds"),
                    F.coalesce("AvgCD", "B365CD", "AvgD", "B365D").alias("draw_odds"),
                    over.alias("over_odds"), under.alias("under_odds"))


_BUCKET_SQL = ("CASE WHEN referee IS NULL OR trim(referee) = '' THEN -1 "
               "ELSE CAST(('0x' || substr(md5(referee), 1, 8)) AS BIGINT) % 10000 END")

query("string_bucket", sql=with_bindings(f"""
SELECT fixture_id, referee, {B(_BUCKET_SQL)} AS referee_encoded FROM b_odds""", "b_odds"))(
    lambda spark, d: conform(b.odds(spark, d).select("fixture_id", "referee",
                                                     stable_bucket("referee").alias("referee_encoded"))))

query("classify_tiers", sql=with_bindings(f"""
SELECT fixture_id,
  CASE WHEN ah >= 1.5 THEN 'heavy_favourite' WHEN ah >= 0.5 THEN 'favourite' WHEN ah > -0.5 THEN 'level'
       WHEN ah > -1.5 THEN 'underdog' ELSE 'heavy_underdog' END AS handicap_class,
  {B("least(greatest(CASE WHEN B365D >= 0 THEN floor(B365D) ELSE ceil(B365D) END, 1), 5)")} AS draw_tier
FROM (SELECT fixture_id, B365D, AHh AS ah FROM b_odds)""", "b_odds"))(lambda spark, d: conform(
    b.odds(spark, d).select(
        "fixture_id",
        classify([(F.col("AHh") >= 1.5, "heavy_favourite"), (F.col("AHh") >= 0.5, "favourite"),
                  (F.col("AHh") > -0.5, "level"), (F.col("AHh") > -1.5, "underdog")], "heavy_underdog")
        .alias("handicap_class"),
        tier("B365D").alias("draw_tier"))))

# ----------------------------------------------------------------------------- I7


def _betting_sql() -> str:
    side_cols = """fixture_id, gw, {team} AS team_id, {is_home} AS is_home, {p_team} AS team_win_probability,
    {p_opp} AS opponent_win_probability, pd AS draw_probability,
    {cs} AS implied_clean_sheet_probability, tot AS implied_total_goals, {xg} AS team_expected_goals,
    {cons} AS market_consensus_strength, {mv} AS odds_movement_team, abs({mv}) AS odds_movement_magnitude,
    {fav} AS favorite_status, {sign} * ah AS asian_handicap_line, {ho} AS handicap_team_odds,
    {sign} * ah * 1.0 AS expected_goal_difference, tot - 2.5 AS over_under_signal, ref AS referee_encoded"""

    def cs(xg):
        return CLIP(f"1.0 - tot * (CASE WHEN {xg} IS NOT NULL AND tot IS NOT NULL AND tot > 0 THEN {xg} / tot END) * 0.3",
                    "0.0", "1.0")

    home = side_cols.format(team="home_team_id", is_home="TRUE", p_team="ph", p_opp="pa", cs=cs("hxg"), xg="hxg",
                            cons="cons_h", mv="(AvgCH - AvgH)", fav="CASE WHEN h_sel < a_sel THEN 1.0 ELSE 0.0 END",
                            sign="1.0", ho="hc_home")
    away = side_cols.format(team="away_team_id", is_home="FALSE", p_team="pa", p_opp="ph", cs=cs("axg"), xg="axg",
                            cons="cons_a", mv="(AvgCA - AvgA)", fav="CASE WHEN a_sel < h_sel THEN 1.0 ELSE 0.0 END",
                            sign="-1.0", ho="hc_away")
    # the contract's neutral values, written out: the SQL must not follow the code under test
    dflt = {"team_win_probability": 0.33, "opponent_win_probability": 0.33, "draw_probability": 0.33,
            "implied_clean_sheet_probability": 0.35, "implied_total_goals": 2.5, "team_expected_goals": 1.25,
            "market_consensus_strength": 0.5, "odds_movement_team": 0.0, "odds_movement_magnitude": 0.0,
            "favorite_status": 0.5, "asian_handicap_line": 0.0, "handicap_team_odds": 2.0,
            "expected_goal_difference": 0.0, "over_under_signal": 0.0, "referee_encoded": -1}
    outs = ",\n  ".join(
        (B(f"coalesce({k}, {v})") if k == "referee_encoded" else R(f"coalesce({k}, {v})")) + f" AS {k}"
        for k, v in dflt.items())
    body = _POIS.replace("\n, ou AS", ", ou AS", 1) + f"""
, base AS (
  SELECT o.*, f.event AS gw, f.home_team_id AS fh, f.away_team_id AS fa, {_SEL_SQL}
  FROM b_odds o JOIN b_fixtures f ON o.fixture_id = f.fixture_id),
pp AS (
  SELECT base.*, {_devig3_sql("h_sel")} AS ph, {_devig3_sql("d_sel")} AS pd, {_devig3_sql("a_sel")} AS pa,
    lam.tot AS tot,
    CASE WHEN AHh IS NULL THEN 0.0 ELSE AHh END AS ah,
    CASE WHEN AvgAHH IS NOT NULL AND AvgAHA IS NOT NULL THEN AvgAHH ELSE B365AHH END AS hc_home,
    CASE WHEN AvgAHH IS NOT NULL AND AvgAHA IS NOT NULL THEN AvgAHA ELSE B365AHA END AS hc_away,
    {_consensus_sql("B365H", "PSH", "MaxH", "AvgH")} AS cons_h,
    {_consensus_sql("B365A", "PSA", "MaxA", "AvgA")} AS cons_a,
    {_BUCKET_SQL} AS ref
  FROM base LEFT JOIN lam ON base.fixture_id = lam.fixture_id),
x AS (
  SELECT pp.* EXCLUDE (home_team_id, away_team_id), fh AS home_team_id, fa AS away_team_id,
    CASE WHEN tot IS NOT NULL AND ph IS NOT NULL AND pd IS NOT NULL AND pa IS NOT NULL
              AND (ph + 0.5 * pd) + (pa + 0.5 * pd) > 0
         THEN tot * ((ph + 0.5 * pd) / ((ph + 0.5 * pd) + (pa + 0.5 * pd))) END AS hxg,
    CASE WHEN tot IS NOT NULL AND ph IS NOT NULL AND pd IS NOT NULL AND pa IS NOT NULL
              AND (ph + 0.5 * pd) + (pa + 0.5 * pd) > 0
         THEN tot * ((pa + 0.5 * pd) / ((ph + 0.5 * pd) + (pa + 0.5 * pd))) END AS axg
  FROM pp),
sides AS (SELECT {home} FROM x UNION ALL SELECT {away} FROM x)
SELECT {B("coalesce(gw, 1)")} AS gameweek, s.fixture_id, p.player_id, s.is_home,
  {outs},
  {AS_OF_SQL} AS as_of_utc
FROM sides s JOIN b_players p ON s.team_id = p.team_id
WHERE s.team_id IS NOT NULL"""
    return "WITH RECURSIVE " + with_bindings(body, "b_odds", "b_fixtures", "b_players")[len("WITH "):]


query("betting_features", sql=_betting_sql())(lambda spark, d: conform(
    feat.betting_features(b.odds(spark, d), b.fixtures(spark, d), b.players(spark, d), AS_OF)))

# ----------------------------------------------------------------------------- I1


def _pm_sql() -> str:
    price = "(now_cost / 10.0)"
    form = NUM("form")
    own = NUM("selected_by_percent")
    net = "(transfers_in_event - transfers_out_event)"
    form3 = f"coalesce({form}, 3.0)"
    epg = CLIP(f"coalesce({form}, 3.0)", "0.0")
    valid = "(position_id IN (1, 2, 3, 4) AND ppm IS NOT NULL)"
    return with_bindings(f"""
, base AS (
  SELECT p.*, {price} AS current_price,
    CASE WHEN {price} > 0 THEN {CLIP("total_points", "0.0")} / {price} ELSE 0.0 END AS ppm
  FROM b_players p),
rk AS (
  SELECT base.*, CASE WHEN {valid} THEN
      (CAST(rank() OVER (PARTITION BY position_id, {valid} ORDER BY ppm) AS DOUBLE)
       + CAST(count(*) OVER (PARTITION BY position_id, {valid}, ppm) - 1 AS DOUBLE) / 2.0)
      / CAST(count(*) OVER (PARTITION BY position_id, {valid}) AS DOUBLE) * 100.0
    ELSE 50.0 END AS value_score
  FROM base)
SELECT player_id, web_name, team_id, {B("position_id")} AS position_id,
  CASE position_id WHEN 1 THEN 'GKP' WHEN 2 THEN 'DEF' WHEN 3 THEN 'MID' WHEN 4 THEN 'FWD' END AS position_name,
  {R("current_price")} AS current_price, {R("ppm")} AS points_per_million,
  {R(f"CASE WHEN {price} > 0 AND form IS NOT NULL THEN {CLIP(form, '0.0')} / {price} ELSE 0.0 END")} AS form_per_million,
  {R("value_score")} AS value_score,
  {R("least(coalesce(minutes, 0) / 1000.0, 1.0)")} AS value_confidence,
  CASE WHEN {form3} >= 5.0 THEN 'improving' WHEN {form3} >= 2.5 THEN 'stable' ELSE 'declining' END AS form_trend,
  {R("0.0")} AS form_momentum,
  {R(f"greatest(coalesce({form}, 0.0), 0.0)")} AS recent_form_5gw,
  {R("0.7")} AS season_consistency,
  {R(epg)} AS expected_points_per_game,
  {R(f"total_points - coalesce({epg} * minutes / 90.0, 0.0)")} AS points_above_expected,
  {R("0.3")} AS overperformance_risk,
  CASE WHEN {net} > 1000 THEN 'rising' WHEN {net} < -1000 THEN 'falling' ELSE 'stable' END AS ownership_trend,
  {B(net)} AS transfer_momentum,
  {R(f"least(coalesce({own}, 5.0) / 50.0, 1.0)")} AS ownership_risk,
  {B("least((CASE WHEN coalesce(penalties_order = 1, FALSE) THEN 3 ELSE 0 END) + (CASE WHEN coalesce(corners_and_indirect_freekicks_order = 1, FALSE) THEN 2 ELSE 0 END) + (CASE WHEN coalesce(direct_freekicks_order = 1, FALSE) THEN 1 ELSE 0 END), 3)")} AS set_piece_priority,
  coalesce(penalties_order = 1, FALSE) AS penalty_taker,
  coalesce(corners_and_indirect_freekicks_order = 1, FALSE) AS corner_taker,
  coalesce(direct_freekicks_order = 1, FALSE) AS freekick_taker,
  {R("(100.0 - coalesce(chance_of_playing_next_round, 100.0)) / 100.0")} AS injury_risk,
  {R("0.2")} AS rotation_risk, {B(str(GW))} AS gameweek, {AS_OF_SQL} AS calculation_date,
  'v1.0.0' AS calculation_version, {R("0.85")} AS data_quality_score
FROM rk""", "b_players").replace("\n, base AS", ", base AS", 1)


query("player_metrics", sql=_pm_sql())(lambda spark, d: conform(
    feat.player_metrics(b.players(spark, d), GW, AS_OF)))

# ----------------------------------------------------------------------------- C8 / I4 / I5 / I8
_NEW_SQL = f"""
, hist AS (SELECT player_id FROM b_history WHERE gameweek < {GW}),
new_ids AS (
  SELECT DISTINCT player_id FROM b_players
  WHERE {GW} > 1 AND EXISTS (SELECT 1 FROM hist) AND player_id NOT IN (SELECT player_id FROM hist)),
fp AS (SELECT p.*, (n.player_id IS NOT NULL) AS is_new FROM b_players p LEFT JOIN new_ids n ON p.player_id = n.player_id)"""

query("new_entities", sql=with_bindings(_NEW_SQL.replace("\n, hist AS", ", hist AS", 1) + """
SELECT player_id FROM new_ids""", "b_players", "b_history"))(lambda spark, d: conform(
    new_entities(b.players(spark, d), b.history(spark, d), "player_id", "gameweek", GW)))


def _va_sql() -> str:
    price = "(now_cost / 10.0)"
    net = "(transfers_in_event - transfers_out_event)"
    own = NUM("selected_by_percent")
    valid = "(position_id IN (1, 2, 3, 4) AND ppp IS NOT NULL)"
    buy = CLIP("ppp / 2.0", None, "10.0")
    return with_bindings(_NEW_SQL.replace("\n, hist AS", ", hist AS", 1) + f"""
, base AS (
  SELECT fp.*, {price} AS current_price, {CLIP("total_points", "0.0")} AS tp,
    CASE WHEN is_new THEN 0.5 WHEN {price} > 0 THEN {CLIP("total_points", "0.0")} / {price} ELSE 0.0 END AS ppp
  FROM fp),
rk AS (
  SELECT base.*, CASE WHEN {valid} THEN
      (CAST(rank() OVER (PARTITION BY position_id, {valid} ORDER BY ppp) AS DOUBLE)
       + CAST(count(*) OVER (PARTITION BY position_id, {valid}, ppp) - 1 AS DOUBLE) / 2.0)
      / CAST(count(*) OVER (PARTITION BY position_id, {valid}) AS DOUBLE) * 100.0
    ELSE 50.0 END AS vvp
  FROM base)
SELECT player_id, web_name, {B("position_id")} AS position_id, {R("current_price")} AS current_price,
  {B("tp")} AS total_points, {R("ppp")} AS points_per_pound,
  {R("CASE WHEN is_new THEN 0.5 ELSE ppp * 1.05 END")} AS expected_points_per_pound,
  {R("CASE WHEN is_new THEN 1.0 ELSE vvp END")} AS value_vs_position,
  {R("CASE WHEN is_new THEN 1.0 ELSE 50.0 END")} AS value_vs_price_tier,
  {R(f"CASE WHEN is_new THEN 0.0 ELSE {net} / 100000.0 * 1 END")} AS predicted_price_change_1gw,
  {R(f"CASE WHEN is_new THEN 0.0 ELSE {net} / 100000.0 * 5 END")} AS predicted_price_change_5gw,
  {R("CASE WHEN is_new THEN 0.0 ELSE 0.1 END")} AS price_volatility,
  {R(buy)} AS buy_rating, {R(f"10.0 - {buy}")} AS sell_rating, {R("5.0")} AS hold_rating,
  {R(f"least(coalesce({own}, 5.0) / 50.0, 1.0)")} AS ownership_risk,
  {R(f"CASE WHEN is_new THEN 0.0 ELSE {CLIP(CLIP(f'-{net} / 100000.0', '0.0'), '0.0', '1.0')} END")} AS price_risk,
  {R("0.3")} AS performance_risk,
  CASE WHEN {buy} >= 8.0 THEN 'strong_buy' WHEN {buy} >= 6.0 THEN 'buy' WHEN {buy} >= 4.0 THEN 'hold'
       WHEN {buy} >= 2.0 THEN 'sell' ELSE 'strong_sell' END AS recommendation,
  {R("0.75")} AS confidence, {B(str(GW))} AS gameweek, {AS_OF_SQL} AS analysis_date, 'v1.0.0' AS model_version
FROM rk""", "b_players", "b_history")


query("value_analysis", sql=_va_sql())(lambda spark, d: conform(
    feat.value_analysis(b.players(spark, d), b.history(spark, d), GW, AS_OF)))


def _ot_sql() -> str:
    own = NUM("selected_by_percent")
    tin = "CAST(coalesce(transfers_in_event, 0) AS BIGINT)"
    tout = "CAST(coalesce(transfers_out_event, 0) AS BIGINT)"
    net = f"({tin} - {tout})"
    own5 = f"coalesce({own}, 5.0)"
    own0 = f"coalesce({own}, 0.0)"
    price = "(now_cost / 10.0)"
    return with_bindings(_NEW_SQL.replace("\n, hist AS", ", hist AS", 1) + f"""
SELECT player_id, web_name, {R(own)} AS selected_by_percent,
  {tin} AS transfers_in_gw, {tout} AS transfers_out_gw, {net} AS net_transfers_gw,
  {R(f"CASE WHEN is_new THEN 0.0 ELSE {tin} * 0.8 END")} AS avg_transfers_in_5gw,
  {R(f"CASE WHEN is_new THEN 0.0 ELSE {tout} * 0.8 END")} AS avg_transfers_out_5gw,
  {R(f"CASE WHEN is_new THEN 0.0 ELSE {net} * 0.8 END")} AS avg_net_transfers_5gw,
  CASE WHEN is_new THEN 'neutral' WHEN {net} > 5000 THEN 'accelerating_in' WHEN {net} > 1000 THEN 'steady_in'
       WHEN {net} > -1000 THEN 'neutral' WHEN {net} > -5000 THEN 'steady_out' ELSE 'accelerating_out' END
    AS transfer_momentum,
  {R(f"least(abs({net}) / 1000.0, 10.0)")} AS momentum_strength,
  {R(f"CASE WHEN is_new THEN 0.0 ELSE {net} / 1000.0 END")} AS ownership_velocity,
  CASE WHEN is_new THEN 'punt' WHEN {own5} >= 30.0 THEN 'template' WHEN {own5} >= 15.0 THEN 'popular'
       WHEN {own5} >= 5.0 THEN 'mid_owned' WHEN {own5} >= 1.0 THEN 'differential' ELSE 'punt' END AS ownership_tier,
  CASE WHEN {own5} >= 40.0 THEN 'very_high' WHEN {own5} >= 20.0 THEN 'high' WHEN {own5} >= 10.0 THEN 'medium'
       ELSE 'low' END AS ownership_risk_level,
  {R(f"CASE WHEN is_new THEN 0.0 ELSE least({own5} / 5.0, 10.0) END")} AS bandwagon_score,
  {R(f"CASE WHEN {price} > 0 THEN {own0} / {price} ELSE 0.0 END")} AS ownership_vs_price,
  ({own0} > 40.0) AS template_player, ({own0} > 30.0 AND {net} < 0) AS high_ownership_falling,
  {B(str(GW))} AS gameweek, {AS_OF_SQL} AS last_updated
FROM fp""", "b_players", "b_history")


query("ownership_trends", sql=_ot_sql())(lambda spark, d: conform(
    feat.ownership_trends(b.players(spark, d), b.history(spark, d), GW, AS_OF)))


query("neutral_backfill", sql=with_bindings(_NEW_SQL.replace("\n, hist AS", ", hist AS", 1) + f"""
SELECT fp.player_id, web_name, {R("1.0")} AS selected_by_percent, {B("0")} AS transfers_in_gw,
  {B("0")} AS transfers_out_gw, {B("0")} AS net_transfers_gw, {R("0.0")} AS avg_transfers_in_5gw,
  {R("0.0")} AS avg_transfers_out_5gw, {R("0.0")} AS avg_net_transfers_5gw, 'neutral' AS transfer_momentum,
  {R("0.0")} AS momentum_strength, {R("0.0")} AS ownership_velocity, 'punt' AS ownership_tier,
  'low' AS ownership_risk_level, {R("0.0")} AS bandwagon_score,
  {R("CASE WHEN now_cost / 10.0 > 0 THEN 1.0 / (now_cost / 10.0) ELSE 0.0 END")} AS ownership_vs_price,
  FALSE AS template_player, FALSE AS high_ownership_falling, {B("g.gw")} AS gameweek, {AS_OF_SQL} AS last_updated
FROM fp JOIN (SELECT range AS gw FROM range(1, {GW})) g ON TRUE
WHERE fp.is_new""", "b_players", "b_history"))(lambda spark, d: conform(_backfill_spark(spark, d)))


def _backfill_spark(spark, d):
    players = b.players(spark, d)
    new = new_entities(players, b.history(spark, d), "player_id", "gameweek", GW)
    return feat.neutral_backfill(players, new, GW, "ownership", AS_OF)



# ----------------------------------------------------------------------------- K5 (many gameweeks, one job)
def _k5_rank_sql(metric: str, out: str) -> str:
    valid = f"(position_id IN (1, 2, 3, 4) AND {metric} IS NOT NULL)"
    return f"""CASE WHEN {valid} THEN
      (CAST(rank() OVER (PARTITION BY gameweek, position_id, {valid} ORDER BY {metric}) AS DOUBLE)
       + CAST(count(*) OVER (PARTITION BY gameweek, position_id, {valid}, {metric}) - 1 AS DOUBLE) / 2.0)
      / CAST(count(*) OVER (PARTITION BY gameweek, position_id, {valid}) AS DOUBLE) * 100.0
    ELSE 50.0 END AS {out}"""


query("multi_period_metrics", sql=with_bindings(f"""
, base AS (
  SELECT p.*, now_cost / 10.0 AS current_price,
    CASE WHEN now_cost / 10.0 > 0 THEN {CLIP("total_points", "0.0")} / (now_cost / 10.0) ELSE 0.0 END AS ppm
  FROM b_players_gw p),
rk AS (SELECT base.*, {_k5_rank_sql("ppm", "value_score")} FROM base)
SELECT player_id, {B("gameweek")} AS gameweek, {B("position_id")} AS position_id, {R("ppm")} AS points_per_million,
  {R("value_score")} AS value_score,
  CASE WHEN (transfers_in_event - transfers_out_event) > 1000 THEN 'rising'
       WHEN (transfers_in_event - transfers_out_event) < -1000 THEN 'falling' ELSE 'stable' END AS ownership_trend
FROM rk""", "b_players_gw"))(lambda spark, d: conform(
    feat.player_metrics(b.players_by_period(spark, d), "gameweek", AS_OF)
    .select("player_id", "gameweek", "position_id", "points_per_million", "value_score", "ownership_trend")))


def _k5_value_sql() -> str:
    buy = CLIP("ppp / 2.0", None, "10.0")
    return with_bindings(f"""
, first AS (SELECT player_id, min(gameweek) AS f FROM b_history GROUP BY player_id),
fp AS (
  SELECT p.*, (p.gameweek > 1 AND coalesce((SELECT min(gameweek) FROM b_history) < p.gameweek, FALSE)
               AND (first.f IS NULL OR first.f >= p.gameweek)) AS is_new
  FROM b_players_gw p LEFT JOIN first ON p.player_id = first.player_id),
base AS (
  SELECT fp.*, CASE WHEN is_new THEN 0.5 WHEN now_cost / 10.0 > 0
    THEN {CLIP("total_points", "0.0")} / (now_cost / 10.0) ELSE 0.0 END AS ppp FROM fp),
rk AS (SELECT base.*, {_k5_rank_sql("ppp", "vvp")} FROM base)
SELECT player_id, {B("gameweek")} AS gameweek, {R("ppp")} AS points_per_pound,
  {R("CASE WHEN is_new THEN 1.0 ELSE vvp END")} AS value_vs_position,
  {R("CASE WHEN is_new THEN 0.0 ELSE (transfers_in_event - transfers_out_event) / 100000.0 * 1 END")}
    AS predicted_price_change_1gw,
  CASE WHEN {buy} >= 8.0 THEN 'strong_buy' WHEN {buy} >= 6.0 THEN 'buy' WHEN {buy} >= 4.0 THEN 'hold'
       WHEN {buy} >= 2.0 THEN 'sell' ELSE 'strong_sell' END AS recommendation
FROM rk""", "b_players_gw", "b_history")


def _k5_value_spark(spark, d):
    players = b.players_by_period(spark, d)
    hist = b.history(spark, d)
    va = feat.value_analysis(players, hist, "gameweek", AS_OF)
    return conform(va.select("player_id", "gameweek", "points_per_pound", "value_vs_position",
                             "predicted_price_change_1gw", "recommendation"))


query("multi_period_value", sql=_k5_value_sql())(_k5_value_spark)


_AXIS_SQL = "axis AS (SELECT DISTINCT event AS gameweek FROM b_fixtures WHERE event >= 1)"

query("multi_period_form", sql=with_bindings(f"""
, sides AS ({_SIDES_SQL.replace('FROM b_fixtures', 'FROM b_fixtures WHERE coalesce(finished, FALSE)')}),
{_AXIS_SQL},
g AS (
  SELECT s.team_id, a.gameweek,
    sum(CASE WHEN is_home THEN goals_for END) AS sh, sum(CASE WHEN is_home THEN goals_against END) AS ch,
    sum(CASE WHEN NOT is_home THEN goals_for END) AS sa, sum(CASE WHEN NOT is_home THEN goals_against END) AS ca
  FROM axis a JOIN sides s ON s.event >= greatest(1, a.gameweek - 5) AND s.event < a.gameweek
  GROUP BY s.team_id, a.gameweek)
SELECT t.team_id, {B("a.gameweek")} AS gameweek, t.name AS team_name,
  {_s("strength_attack_home")} AS home_attack_strength, {_s("strength_defence_home")} AS overall_defense_strength,
  {R("coalesce(g.sh, 0)")} AS team_goals_scored_home_5gw, {R("coalesce(g.ch, 0)")} AS team_goals_conceded_home_5gw,
  {R("coalesce(g.sa, 0)")} AS team_goals_scored_away_5gw, {R("coalesce(g.ca, 0)")} AS team_goals_conceded_away_5gw,
  {AS_OF_SQL} AS last_updated
FROM b_teams t JOIN axis a ON TRUE LEFT JOIN g ON t.team_id = g.team_id AND g.gameweek = a.gameweek""",
    "b_fixtures", "b_teams").replace("\n, sides AS", ", sides AS", 1))(lambda spark, d: conform(
        feat.derive_periods("team_form", as_of=AS_OF, teams=b.teams(spark, d), fixtures=b.fixtures(spark, d))
        .select("team_id", "gameweek", "team_name", "home_attack_strength", "overall_defense_strength",
                "team_goals_scored_home_5gw", "team_goals_conceded_home_5gw", "team_goals_scored_away_5gw",
                "team_goals_conceded_away_5gw", "last_updated")))

_RUN_DIFF = CLIP("(CASE WHEN s.is_home THEN coalesce(t.strength_overall_away, 1200) "
                 "ELSE coalesce(t.strength_overall_home, 1200) END - 1000) / 80.0", "0.0", "5.0")

query("multi_period_runs", sql=with_bindings(f"""
, s AS (
  SELECT fixture_id, event, home_team_id AS team_id, away_team_id AS opponent_id, TRUE AS is_home FROM b_fixtures
  WHERE home_team_id IS NOT NULL AND away_team_id IS NOT NULL AND event IS NOT NULL
  UNION ALL
  SELECT fixture_id, event, away_team_id, home_team_id, FALSE FROM b_fixtures
  WHERE home_team_id IS NOT NULL AND away_team_id IS NOT NULL AND event IS NOT NULL),
axis AS (SELECT DISTINCT gameweek FROM b_players_gw),
d AS (
  SELECT s.team_id, a.gameweek, {_RUN_DIFF} AS diff,
    row_number() OVER (PARTITION BY s.team_id, a.gameweek ORDER BY s.event, s.fixture_id) AS rn
  FROM s JOIN axis a ON s.event BETWEEN a.gameweek AND a.gameweek + 5 LEFT JOIN b_teams t ON s.opponent_id = t.team_id),
runs AS (
  SELECT team_id, gameweek,
    avg(CASE WHEN rn <= 3 THEN diff END) AS r3, avg(CASE WHEN rn <= 5 THEN diff END) AS r5,
    count(CASE WHEN rn <= 3 AND diff <= 2.0 THEN 1 END) AS g3, count(CASE WHEN rn <= 5 AND diff <= 2.0 THEN 1 END) AS g5,
    CASE WHEN count(*) >= 5 THEN avg(CASE WHEN rn BETWEEN 3 AND 5 THEN diff END) - avg(CASE WHEN rn <= 2 THEN diff END)
         ELSE 0.0 END AS sw
  FROM d GROUP BY team_id, gameweek)
SELECT p.player_id, {B("p.gameweek")} AS gameweek,
  {R("coalesce(r3, 2.5)")} AS fixture_run_3gw_difficulty, {R("coalesce(r5, 2.5)")} AS fixture_run_5gw_difficulty,
  {B("coalesce(g3, 0)")} AS green_fixtures_next_3, {B("coalesce(g5, 0)")} AS green_fixtures_next_5,
  {R("coalesce(sw, 0.0)")} AS fixture_swing_upcoming,
  (coalesce(r3, 2.5) <= 2.0 AND coalesce(g3, 0) >= 2) AS optimal_transfer_in_window,
  (coalesce(r3, 2.5) >= 3.5 OR coalesce(sw, 0.0) > 1.0) AS optimal_transfer_out_window,
  {AS_OF_SQL} AS calculation_date
FROM b_players_gw p LEFT JOIN runs r ON p.team_id = r.team_id AND p.gameweek = r.gameweek""",
    "b_fixtures", "b_teams", "b_players_gw").replace("\n, s AS", ", s AS", 1))(lambda spark, d: conform(
        feat.derive_periods("fixture_runs", b.players_by_period(spark, d), AS_OF, teams=b.teams(spark, d),
                            fixtures=b.fixtures(spark, d))))

query("multi_period_betting", sql=_betting_sql().replace(
    "FROM sides s JOIN b_players p ON s.team_id = p.team_id",
    "FROM sides s JOIN b_players_gw p ON s.team_id = p.team_id AND coalesce(s.gw, 1) = p.gameweek").replace(
    "b_players AS (\n" + b.SQL["b_players"] + "\n)", "b_players_gw AS (\n" + b.SQL["b_players_gw"] + "\n)"))(
    lambda spark, d: conform(feat.derive_periods(
        "betting_features", b.players_by_period(spark, d), AS_OF, odds=b.odds(spark, d), fixtures=b.fixtures(spark, d))))
