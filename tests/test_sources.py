"""Ingest flattening on literal provider documents."""
import json

import pytest
from pyspark.sql import functions as F

from matchday.sources import flatten, odds


def docs(spark, objs, schema, key=True):
    df = spark.createDataFrame([(i, json.dumps(o)) for i, o in enumerate(objs)], "k long, json string")
    return flatten.parse_docs(df, "json", schema, keep=["k"] if key else [])


def test_market_odds_literal_case(spark):
    m = {"home_team": "Arsenal", "away_team": "Burnley", "commence_time": "2025-08-16T14:00:00Z",
         "bookmakers": [
             {"key": "skybet", "markets": [{"key": "h2h", "outcomes": [
                 {"name": "Arsenal", "price": 1.20}, {"name": "Draw", "price": 6.0}, {"name": "Burnley", "price": 13.0}]}]},
             {"key": "williamhill", "markets": [{"key": "h2h", "outcomes": [
                 {"name": "Arsenal", "price": 1.22}, {"name": "Draw", "price": 5.8}, {"name": "Burnley", "price": 12.0}]}]}]}
    bad = dict(m, commence_time="not a time")
    r = odds.flatten_market_odds(docs(spark, [m, bad], odds.MATCH_SCHEMA), "k").collect()
    assert len(r) == 1
    r = r[0]
    assert r.MaxH == 1.22 and r.AvgH == pytest.approx(1.21) and r.B365H == 1.20 and r.B365A == 13.0
    assert r.PSH is None and r.B365CH == r.B365H and r.Date == "16/08/2025"


def test_market_odds_exact_book_and_totals(spark):
    m = {"home_team": "H", "away_team": "A", "commence_time": "2025-08-16T14:00:00Z",
         "bookmakers": [
             {"key": "skybet", "markets": [{"key": "h2h", "outcomes": [
                 {"name": "H", "price": 2.0}, {"name": "Draw", "price": 3.0}, {"name": "A", "price": 4.0}]}]},
             {"key": "bet365", "markets": [
                 {"key": "h2h", "outcomes": [{"name": "H", "price": 2.1}, {"name": "Draw", "price": 3.1},
                                             {"name": "A", "price": 4.1}]},
                 {"key": "totals", "outcomes": [{"name": "Over", "price": 1.8, "point": 2.5},
                                                {"name": "Under", "price": 2.0, "point": 2.5},
                                                {"name": "Over", "price": 2.6, "point": 3.5}]}]}]}
    r = odds.flatten_market_odds(docs(spark, [m], odds.MATCH_SCHEMA), "k").first()
    assert (r.B365H, r.B365D, r.B365A) == (2.1, 3.1, 4.1)
    assert (r.B365_over_2_5, r.B365_under_2_5) == (1.8, 2.0)
    assert r.MaxA == 4.1 and r.AvgD == pytest.approx(3.05)


def test_csv_names_and_read(spark, scratch):
    assert odds.csv_column_name("B365>2.5") == "B365_over_2_5"
    assert odds.csv_column_name("Avg<2.5") == "Avg_under_2_5"
    p = f"{scratch}/odds.csv"
    with open(p, "w") as f:
        f.write("Date,HomeTeam,AwayTeam,B365>2.5,Avg<2.5\n16/08/2024,Man United,Fulham,1.8,2.0\n32/13/2024,X,Y,,\n")
    df = odds.read_odds_csv(spark, p).collect()
    assert df[0].B365_over_2_5 == "1.8" and df[0].match_date.day == 16 and df[1].match_date is None


def test_flatten_section_fills_and_json(spark):
    schema = "elements array<struct<id:long,team:long,element_type:int,now_cost:int,news:string," \
             "chance_of_playing_next_round:double,extra:struct<k:int>>>"
    d = docs(spark, [{"elements": [{"id": 1, "team": 2, "element_type": 3, "now_cost": None, "news": None,
                                    "chance_of_playing_next_round": None, "extra": {"k": 5}},
                                   {"id": 2, "team": 2, "element_type": 1}]}], schema, key=False)
    r = flatten.flatten_section(d, "doc.elements", aliases={"player_id": "id"}, json_cols={"extra": "{}"},
                                keep_null=["chance_of_playing_next_round"]).orderBy("id").collect()
    assert r[0].player_id == 1 and r[0].now_cost == 0 and r[0].news == "" and r[0].extra == '{"k":5}'
    assert r[0].chance_of_playing_next_round is None and r[1].extra == "{}"


def test_flatten_performance_first_usable_explain(spark):
    schema = ("elements array<struct<id:long,stats:struct<total_points:int,minutes:int>,"
              "explain:array<struct<fixture:string>>>>")
    live = {"elements": [
        {"id": 1, "stats": {"total_points": 5, "minutes": 90}, "explain": [{"fixture": 999}, {"fixture": 10}]},
        {"id": 2, "stats": {"total_points": 1, "minutes": 10}, "explain": [{"fixture": {"opponent_team": 7, "is_home": True}}]},
        {"id": 3, "stats": {"total_points": 2, "minutes": 20}, "explain": [{"fixture": [{"opponent_team": 8, "is_home": False}]}]},
        {"id": 4, "stats": {"total_points": 2, "minutes": 20}, "explain": [{"fixture": 10}]}]}
    d = docs(spark, [live], schema)
    players = spark.createDataFrame([(1, 3, 55), (2, 4, 60), (3, 5, 70)], "player_id long, team_id long, now_cost int")
    fixtures = spark.createDataFrame([(10, 3, 9)], "fixture_id long, home_team_id long, away_team_id long")
    got = {r.player_id: r for r in flatten.flatten_performance(d, players, fixtures, 12, doc_key="k").collect()}
    assert (got[1].opponent_team, got[1].was_home, got[1].value) == (9, True, 55)
    assert (got[2].opponent_team, got[2].was_home) == (7, True)
    assert (got[3].opponent_team, got[3].was_home) == (8, False)
    assert got[4].opponent_team is None and got[4].team_id is None  # unknown player: no team, no lookup


def test_snapshot_defaults(spark):
    p = spark.createDataFrame([(1, None, None, 55)], "player_id int, news string, form string, now_cost int")
    r = flatten.snapshot(p, 3, False, "2025-01-01 00:00:00").first()
    assert (r.gameweek, r.news, r.form, r.ep_next, r.status, r.is_backfilled) == (3, "", "0.0", "0.0", "a", False)


def test_flatten_performance_spreads_elements_without_a_known_fixture(spark):
    """Ids that no fixture has and elements that ask for none are not sent to one task."""
    schema = "elements array<struct<id:long,stats:struct<total_points:int,minutes:int>,explain:array<struct<fixture:string>>>>"
    docs = spark.range(4000).select(F.col("id").alias("k"), F.when(F.col("id") % 2 == 0, F.lit(
        '{"elements":[{"id":1,"stats":{"total_points":3,"minutes":9},"explain":[{"fixture":{"opponent_team":7,"is_home":true}},{"fixture":5}]}]}')).otherwise(
        F.lit('{"elements":[{"id":1,"stats":{"total_points":3,"minutes":9},"explain":[{"fixture":-1},{"fixture":6},{"fixture":5}]}]}')).alias("json"))
    players = spark.createDataFrame([(1, 2, 50)], "player_id long, team_id long, now_cost int")
    fixtures = spark.createDataFrame([(5, 2, 8), (6, 3, 4)], "fixture_id long, home_team_id long, away_team_id long")
    plan = flatten.flatten_performance(flatten.parse_docs(docs, "json", schema, keep=["k"]), players, fixtures, 12, doc_key="k")
    got = {(r.k % 2, r.opponent_team, r.was_home) for r in plan.collect()}
    # the first usable entry: the object, or fixture 6, which the player's team does not play in
    assert got == {(0, 7, True), (1, None, None)} and plan.count() == 4000
    text = plan._jdf.queryExecution().optimizedPlan().toString()
    assert text.count("from_json(") == 1 and "__bucket" in text


def test_market_documents_render_lines_before_they_are_collected(spark, scratch):
    """The collect takes a rendered column, and the text is that of ``to_json``: no price for NULL, quotes around no number."""
    from matchday.plans import q_core
    spark.createDataFrame([(7, 1, 1, 2, 10.0, 1.0, 0.0, 0.02, "N"), (7, 2, 1, 1, 1e9, 1.0, None, float("nan"), "R"),
                           (8, 1, 1, 1, float("inf"), 1.0, 0.05, None, None)],
                          "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, "
                          "l_discount double, l_tax double, l_returnflag string").write.parquet(f"{scratch}/lineitem.parquet")
    spark.sql("SELECT 7L AS o_orderkey, '1-URGENT' AS o_orderpriority, timestamp_ntz'1998-01-02 00:00:00' AS o_orderdate UNION ALL "
              "SELECT 8L, '5-LOW', timestamp_ntz'1998-01-02 00:00:00'").write.parquet(f"{scratch}/orders.parquet")
    plan = q_core._market_docs(spark, scratch)
    got = {r.l_orderkey: r.json for r in plan.collect()}
    over = '"markets":[{"key":"h2h","outcomes":['
    assert got[7] == (
        '{"home_team":"Home 7","away_team":"Away 7","commence_time":"1998-01-02T00:00:00Z","bookmakers":['
        '{"key":"skybet",' + over + '{"name":"Home 7"},{"name":"Draw"},{"name":"Away 7","price":-4.999999645E7}]},'
        '{"key":"totals","outcomes":[{"name":"Over","price":"NaN","point":3.5},{"name":"Under","price":"NaN","point":3.5}]}]},'
        '{"key":"williamhill",' + over + '{"name":"Home 7","price":1.5},{"name":"Draw","price":3.0},{"name":"Away 7","price":3.05}]},'
        '{"key":"totals","outcomes":[{"name":"Over","price":1.7,"point":2.5},{"name":"Under","price":2.3,"point":2.5}]}]}]}')
    assert '"commence_time":"TBD"' in got[8] and '{"name":"Home 8"},' in got[8] and '"price":"-Infinity"' in got[8]
    text = plan._jdf.queryExecution().optimizedPlan().toString()
    assert "collect_list(line#" in text and "StructsToJson" not in text
