"""Landed files, odds ingest, key-bucket upserts, refresh, stored partitions, JSON paths, freshness."""
import json
import os

import pytest
from pyspark.sql import functions as F

from matchday.operators import runs, stored, views
from matchday.plans import bindings as b
from matchday.plans import features as feat
from matchday.plans import refresh
from matchday.quality import checks as q
from matchday.quality import tables as t
from matchday.quality.schemas import REJECTS, Col, Table, judged
from matchday.sources import ingest, landing, sinks
from matchday.streaming import capture

SF = "/root/testdata/sf0.001"
AS_OF = "2025-01-03 00:00:00"


def text(path, lines):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        f.write("\n".join(lines) + "\n")


# ------------------------------------------------------------------ landing
def test_permissive_json_keeps_rejects(spark, scratch):
    rows = [{"chip_id": 1, "name": "wildcard", "number": 1, "chip_type": "transfer", "start_event": 1, "stop_event": 19,
             "overrides": {"rules": {"a": 1}}, "as_of_utc": AS_OF},
            {"chip_id": "x", "name": "", "number": 0, "chip_type": "other", "start_event": 1, "stop_event": 39, "as_of_utc": None}]
    text(f"{scratch}/chips/a.json", [json.dumps(r) for r in rows] + ["{not json"])
    df = landing.read_landed(spark, f"{scratch}/chips", t.CHIPS)
    got = {r.chip_id if r.number == 1 else r.name: [(x["column"], x["check"], x["value"]) for x in r[REJECTS]] for r in df.collect()}
    assert got[1] == [] and df.where("chip_id = 1").first().overrides == '{"rules": {"a": 1}}'
    assert set(got[""]) == {("chip_id", "coerce:bigint", "x"), ("name", "length[1,None]", ""), ("number", "range[1,None]", "0"),
                            ("chip_type", "isin", "other"), ("stop_event", "range[1,38]", "39"), ("overrides", "not_null", None),
                            ("as_of_utc", "not_null", None)}
    assert got[None] == [("*", "corrupt", "{not json")]
    counts = landing.write_landed(df, f"{scratch}/out", checks=["coerce:bigint"])
    assert counts == {"rows": 3, "good": 1, "rejected": 2, "coerce:bigint": 1}
    assert landing.read_written(spark, f"{scratch}/out").columns == t.CHIPS.names()
    assert landing.read_written(spark, f"{scratch}/out", good=False).count() == landing.rejected(df).count() == 2
    assert landing.accepted(df).count() == 1


def test_write_counts_in_one_scan(spark, scratch):
    df = judged(spark.createDataFrame([("1",), ("x",), (None,)], "a string"), Table({"a": Col("bigint")}))
    watched, _ = landing.observed(df, "n", {"bad": F.size(REJECTS) > 0})
    plan = watched._jdf.queryExecution().explainString(spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    assert plan.count("Scan ExistingRDD") == 2 or plan.count("LocalTableScan") <= 2  # named once in the tree, once in its details
    assert landing.write_landed(df, f"{scratch}/o") == {"rows": 3, "good": 1, "rejected": 2}


def test_seasons_of_three_layouts(spark, scratch):
    root = f"{scratch}/data"
    text(f"{root}/2021-22/gws/merged_gw.csv", ["name,element,round,total_points,value", "Ann,1,3,12,55", "Bob,2,3", "Cyd,3,x,4,60"])
    text(f"{root}/2022-23/gws/merged_gw.csv", ["﻿element,name,xP,GW,total_points,expected_goals,was_home",
                                                 '4,"Doe, Jane",1.5,7,2,0.31,True', "5,Eve,1,8,3,none,False"])
    text(f"{root}/2023-24/gws/merged_gw.csv", ["GW,name,element,total_points,name", "9,Fay,6,-1,again"])
    df = landing.read_merged_gameweeks(spark, root)
    got = {r.element: r for r in df.collect() if r.element}
    assert len(landing.layouts(spark, root)) == 3
    assert (got[1].season, got[1].GW, got[1].value, got[1].expected_goals, got[1][REJECTS]) == ("2021-22", 3, 55, None, [])
    assert (got[4].season, got[4].name, got[4].GW, got[4].expected_goals, got[4].was_home) == ("2022-23", "Doe, Jane", 7, 0.31, True)
    assert (got[6].season, got[6].name, got[6].total_points) == ("2023-24", "Fay", -1)
    bad = {r.source_file.split("/")[-3]: [(x["column"], x["check"]) for x in r[REJECTS]] for r in landing.rejected(df).collect()
           if r.element in (3, 5)}
    assert bad == {"2021-22": [("GW", "coerce:bigint")], "2022-23": [("expected_goals", "coerce:double")]}
    counts = landing.write_landed(df, f"{scratch}/o", "season")
    assert (counts["rows"], counts["rejected"]) == (6, 3)  # the short record is kept as corrupt
    assert landing.read_seasons(spark, f"{root}/2021-22", t.CHIPS).where("season = '2021-22'").count() == 3


def test_no_files_give_an_empty_table(spark, scratch):
    os.makedirs(f"{scratch}/none")
    assert landing.read_merged_gameweeks(spark, f"{scratch}/none").count() == 0


# ------------------------------------------------------------------ odds
def odds_inputs(spark):
    teams = spark.createDataFrame([(1, "Man Utd"), (2, "Spurs"), (3, "Leeds"), (4, "Wolves")], "team_id int, name string")
    fixtures = spark.createDataFrame([(10, "2025-01-01 15:00:00", 1, 2), (11, "2025-01-02 15:00:00", 3, 4),
                                      (12, "2025-01-03 12:00:00", 2, 1), (13, "2025-01-03 20:00:00", 2, 1), (14, None, 3, 1)],
                                     "fixture_id int, kickoff_utc string, home_team_id int, away_team_id int")
    return teams, fixtures.withColumn("kickoff_utc", F.col("kickoff_utc").cast("timestamp_ntz"))


def test_odds_of_files_reach_the_stored_table(spark, scratch):
    teams, fixtures = odds_inputs(spark)
    text(f"{scratch}/odds/a.csv", ["Div,Date,HomeTeam,AwayTeam,Referee,B365H,B365>2.5,AHh", "E0,01/01/2025,Man United,Tottenham,M Dean,2.1,1.9,-0.5",
                                   "E0,02/01/2025,Leeds,Wolves,,n/a,1.7,0", "E0,03/01/2025,Tottenham,Man United,X,2,2,1",
                                   "E0,bad,Leeds,Wolves,X,2,2,1", "E0,02/01/2025,Nobody,Wolves,X,2,2,1", "E0,02/01/2025,Leeds,Nobody,X,2,2,1",
                                   "E0,09/01/2025,Leeds,Wolves,X,2,2,1"])
    text(f"{scratch}/odds/b.csv", ["Date,HomeTeam,AwayTeam,Avg<2.5", "02/01/2025,Leeds United,Wolverhampton Wanderers,3.25"])
    rows = ingest.read_odds_files(spark, f"{scratch}/odds").withColumn("seen", F.when(F.col("Div").isNull(), 2).otherwise(1))
    path = f"{scratch}/stored"
    counts = ingest.ingest_odds(rows, fixtures, teams, AS_OF, path, order=["seen"])
    assert counts == {"rows": 8, "matched": 3, "date": 1, "home team": 1, "away team": 1, "no fixture": 1, "several fixtures": 1}
    refused = ingest.match_odds(rows, fixtures, teams, AS_OF, ["seen"]).where("refused is not null")
    assert refused.count() == counts["rows"] - counts["matched"]
    got = {r.fixture_id: r for r in sinks.read_upserted(spark, path).collect()}
    assert sorted(got) == [10, 11] and set(got[10].asDict()) == set(t.BETTING_ODDS.names())
    assert (got[10].referee, got[10].B365H, got[10].B365_over_2_5, got[10].AHh, got[10].match_date.day) == ("M Dean", 2.1, 1.9, -0.5, 1)
    assert (got[11].Avg_under_2_5, got[11].B365H) == (3.25, None)  # the newer row of the two


def test_documents_and_files_have_one_layout():
    from matchday.sources.odds import NEVER_IN_DOCUMENTS
    given = {c for c in ingest.PRICES if c not in NEVER_IN_DOCUMENTS}
    assert {f"{k}{s}" for k in ("B365", "PS", "Max", "Avg", "B365C", "PSC", "MaxC", "AvgC") for s in "HDA"} <= given
    assert set(NEVER_IN_DOCUMENTS) <= {*ingest.PRICES, *ingest.MATCH_STATS}


# ------------------------------------------------------------------ writers
ROWS = "k int, g string, v string"


def test_keyed_rewrite_keeps_the_null_partition(spark, scratch):
    path = f"{scratch}/t"
    rows = [(1, "1", "a"), (2, None, "b"), (3, None, "c"), (5, "x:y", "d"), (6, "01", "e")]
    sinks.replace_keys(spark.createDataFrame(rows, ROWS), path, "k", partition_col="g")
    sinks.replace_keys(spark.createDataFrame([(4, None, "n")], ROWS), path, "k", partition_col="g")
    # a key that leaves a partition whose name is escaped on disk, and one that looks like a number
    sinks.replace_keys(spark.createDataFrame([(5, "z", "D"), (6, "1", "E")], ROWS), path, "k", partition_col="g")
    got = sorted((r.k, str(r.g) if r.g is not None else None, r.v) for r in spark.read.schema(ROWS).parquet(path).collect())
    assert got == [(1, "1", "a"), (2, None, "b"), (3, None, "c"), (4, None, "n"), (5, "z", "D"), (6, "1", "E")]
    assert sorted(n for n in os.listdir(path) if n.startswith("g=")) == ["g=1", "g=__HIVE_DEFAULT_PARTITION__", "g=z"]


def files(path):
    return {os.path.join(d, f) for d, _, names in os.walk(path) for f in names if f.endswith(".parquet")}


def test_upsert_leaves_untouched_files(spark, scratch):
    path = f"{scratch}/t"
    first = spark.createDataFrame([(i, i % 3, f"v{i}") for i in range(200)] + [(None, 1, "none")], "m int, e int, v string")
    sinks.upsert(first, path, ["m", "e"], buckets=16)
    before = files(path)
    sinks.upsert(spark.createDataFrame([(7, 1, "new"), (500, 0, "more")], "m long, e long, v string"), path, ["m", "e"], buckets=99)
    after = files(path)
    assert len(before & after) >= len(before) - 2 and len(after - before) <= 2
    got = {(r.m, r.e): r.v for r in sinks.read_upserted(spark, path).collect()}
    assert len(got) == 202 and got[7, 1] == "new" and got[500, 0] == "more" and got[None, 1] == "none" and got[8, 2] == "v8"
    sinks.upsert(first.limit(0), path, ["m", "e"])
    assert files(path) == after
    sinks.replace_all(first, f"{scratch}/plain")
    with pytest.raises(ValueError, match="key buckets"):
        sinks.upsert(first, f"{scratch}/plain", "m")


def test_late_odds_never_win(spark, scratch):
    path = f"{scratch}/odds"
    write = capture.odds_batch_writer(path, ["fixture_id"], ["as_of_utc"], buckets=8)
    rows = "fixture_id int, B365H double, as_of_utc string"
    write(spark.createDataFrame([(i, 2.0, "2025-02-02") for i in range(40)], rows), 0)
    before = files(path)
    write(spark.createDataFrame([(1, 9.0, "2025-01-01"), (2, 3.0, "2025-03-01"), (3, 5.0, "2025-02-02")], rows), 1)
    write(spark.createDataFrame([(1, 9.0, "2025-01-01"), (2, 3.0, "2025-03-01"), (3, 5.0, "2025-02-02")], rows), 1)  # replayed
    got = {r.fixture_id: r.B365H for r in sinks.read_upserted(spark, path).collect()}
    assert len(got) == 40 and (got[1], got[2], got[3], got[4]) == (2.0, 3.0, 5.0, 2.0)
    assert len(before & files(path)) >= len(before) - 3  # at most the buckets of three keys


def test_save_many_concurrently_fails_alone(spark, scratch):
    good = spark.range(5)
    bad = spark.range(5).select(F.raise_error(F.lit("broken")).cast("string").alias("x"))

    def unplannable():
        return good.select("absent")
    out = sinks.save_many({"a": good, "b": bad, "c": unplannable, "d": lambda: good, "e": good.limit(0)}, scratch, workers=3)
    assert out["a"] == out["d"] == "saved" and out["e"] == "skipped: empty"
    assert out["b"].startswith("failed") and out["c"].startswith("failed") and spark.read.parquet(f"{scratch}/d").count() == 5


def test_refresh_writes_seven_tables(spark, scratch):
    inputs = {"players": b.players(spark, SF), "teams": b.teams(spark, SF), "fixtures": b.fixtures(spark, SF),
              "history": b.history(spark, SF), "odds": b.odds(spark, SF)}
    assert set(refresh.refresh_derived(inputs, scratch, b.GAMEWEEK, b.AS_OF).values()) == {"saved"}
    assert refresh.refresh_derived({**inputs, "teams": inputs["teams"].drop("strength_overall_home")}, scratch, b.GAMEWEEK + 1, b.AS_OF)[
        "value_analysis"] == "saved"
    both = refresh.stored(spark, scratch, "value_analysis").select("gameweek").distinct().count()
    assert both == 2 and refresh.stored(spark, scratch, "team_form", b.GAMEWEEK).count() == inputs["teams"].count()
    season = {**inputs, "players": b.players_by_period(spark, SF)}
    periods = spark.createDataFrame([(40,), (41,)], "gameweek int")
    out = refresh.refresh_season(season, f"{scratch}/season", b.AS_OF, periods=periods)
    assert set(out.values()) == {"saved"}
    for table in t.DERIVED:
        assert {r.gameweek for r in refresh.stored(spark, f"{scratch}/season", table).select("gameweek").distinct().collect()} == {40, 41}, table


# ------------------------------------------------------------------ whole season
def test_season_equals_gameweek_by_gameweek(spark):
    teams, fixtures, players = b.teams(spark, SF), b.fixtures(spark, SF), b.players_by_period(spark, SF)
    periods = spark.createDataFrame([(1,), (2,), (30,), (42,)], "gameweek int")
    form = feat.derive_periods("team_form", as_of=b.AS_OF, teams=teams, fixtures=fixtures, periods=periods)
    run = feat.derive_periods("fixture_runs", players, b.AS_OF, teams=teams, fixtures=fixtures, periods=periods)
    for gw in (1, 2, 30, 42):
        one = feat.team_form(teams, fixtures, gw, b.AS_OF)
        assert form.where(F.col("gameweek") == gw).select(*one.columns).exceptAll(one).count() == 0
        mine = feat.fixture_runs(players.where(F.col("gameweek") == gw), fixtures, teams, gw, b.AS_OF)
        got = run.where(F.col("gameweek") == gw).select(*mine.columns)
        assert got.count() == mine.count() and got.exceptAll(mine).count() == 0
    with pytest.raises(ValueError, match="needs"):
        feat.derive_periods("team_form")
    with pytest.raises(ValueError, match="unknown"):
        feat.derive_periods("nothing")


def test_trailing_sums_and_reach(spark):
    rows = spark.createDataFrame([("a", 1, 2), ("a", 1, 3), ("a", 3, None), ("a", 4, 7), ("b", 9, 1), ("a", -2, 50)], "k string, p int, v int")
    axis = spark.createDataFrame([("a", i) for i in (1, 2, 5, 8, 9)] + [("c", 2)], "k string, p int")
    got = {(r.k, r.p): r.s for r in runs.trailing_sums(rows, "k", "p", axis, 3, {"s": F.col("v")}).collect()}
    assert got == {("a", 1): None, ("a", 2): 5, ("a", 5): 7, ("a", 8): None, ("a", 9): None, ("c", 2): None}
    reach = runs.in_reach(rows, "p", 2, spark.createDataFrame([(1,), (2,), (8,)], "gw int"), "gw")
    assert sorted((r.k, r.p, r.gw) for r in reach.collect()) == [("a", 1, 1), ("a", 1, 1), ("a", 3, 1), ("a", 3, 2), ("a", 4, 2), ("b", 9, 8)]


# ------------------------------------------------------------------ stored partitions
def test_newest_partition_and_runtime_pruning(spark, scratch):
    path = f"{scratch}/t"
    sinks.replace_partitions(spark.createDataFrame([(i, i % 12) for i in range(60)] + [(99, None)], "id int, gw int"), path, "gw")
    assert sorted(stored.partition_values(spark, path, "gw"), key=str) == sorted([*map(str, range(12)), None], key=str)
    assert {r.gw for r in stored.newest_partition(spark, path, "gw").collect()} == {11}
    scan = stored.newest_partition(spark, path, "gw")._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(gw" in scan
    periods = f"{scratch}/p"
    spark.createDataFrame([(i, i > 9) for i in range(12)], "event int, open boolean").write.parquet(periods)
    picked = stored.rows_of_periods(spark.read.parquet(path), spark.read.parquet(periods).where("open and event > 8"), "gw", "event")
    assert {r.gw for r in picked.collect()} == {10, 11}
    assert "dynamicpruning" in picked._jdf.queryExecution().toString()
    spark.createDataFrame([], "id int, gw int").write.parquet(f"{scratch}/e")
    assert stored.newest_partition(spark, f"{scratch}/e", "gw").count() == 0


def test_json_paths_of_several_shapes(spark):
    docs = ['{"a": {"b": 3}}', '{"a": 4}', '[{"b": "5"}]', "no json", None, '{"a": "x"}']
    df = spark.createDataFrame([(i, d) for i, d in enumerate(docs)], "i int, d string")
    out = stored.json_paths(df, "d", {"n": [("$.a.b", "int"), ("$.a", "int"), ("$[0].b", "int")], "s": ("$.a", "string")})
    got = {r.i: (r.n, r.s) for r in out.collect()}
    assert got == {0: (3, '{"b":3}'), 1: (4, "4"), 2: (5, None), 3: (None, None), 4: (None, None), 5: (None, "x")}
    kinds = {r.i: r.k for r in df.select("i", stored.json_kind("d").alias("k")).collect()}
    assert kinds[0] == "OBJECT" and kinds[2] == "ARRAY" and kinds[3] is None


# ------------------------------------------------------------------ accessors, rules, freshness
def test_store_accessors(spark, scratch):
    store = views.TableStore(spark, scratch)
    assert store.players().columns == t.PLAYERS.names() and store.betting_odds().count() == 0 and store.stored() == []
    save = {
        "raw_fixtures": spark.createDataFrame([(1, 5, 10, 11), (2, 6, 12, 13)], "fixture_id int, event int, home_team_id int, away_team_id int"),
        "raw_players_bootstrap": spark.createDataFrame(
            [(1, "Ekitiké", "Hugo", "Ekitiké", 3, 4, "a", None, "55.5", "", 85, 40, "0.5", "7"),
             (2, "Salah", "Mohamed", "Salah", 4, 3, "z", "50", None, "hurt", 145, 90, "0.7", "x")],
            "player_id int, web_name string, first_name string, second_name string, team_id int, position_id int, status string, "
            "chance_of_playing_next_round string, chance_of_playing_this_round string, news string, now_cost int, total_points int, "
            "expected_goals string, form string"),
        "raw_my_picks": spark.createDataFrame([(1, 4, 7, "bboost"), (1, 5, 8, None), (1, 5, 9, None)],
                                              "manager_id int, event int, player_id int, chip_used string"),
        "raw_my_gameweek_summary": spark.createDataFrame([(1, 4, 0), (1, 5, 1)], "manager_id int, event int, event_transfers int"),
        "derived_player_metrics": spark.createDataFrame([(1, 4, AS_OF), (1, 5, AS_OF)], "player_id int, gameweek int, calculation_date string"),
        "raw_teams_bootstrap": spark.createDataFrame([(3, "Liverpool", "LIV", AS_OF, 4)], "team_id int, name string, short_name string, as_of_utc string, strength int"),
        "raw_player_gameweek_snapshot": spark.createDataFrame([(1, 4, False), (1, 5, True)], "player_id int, gameweek int, is_backfilled boolean"),
        "raw_player_gameweek_performance": spark.createDataFrame([(1, 4, 90), (2, 5, 0)], "player_id int, gameweek int, minutes int"),
    }
    assert set(sinks.save_many(save, scratch, workers=4).values()) == {"saved"}
    sinks.upsert(spark.createDataFrame([(1, 2.0, 77)], "fixture_id int, B365H double, home_team_id int"), f"{scratch}/raw_betting_odds", "fixture_id", 4)
    assert store.betting_odds().columns == ["fixture_id", "B365H", "home_team_id"] and store.betting_odds(6).count() == 0
    both = {r.fixture_id: (r.B365H, r.home_team_id, r.home_team_id_odds) for r in store.fixtures_with_odds().collect()}
    assert both == {1: (2.0, 10, 77), 2: (None, 12, None)}
    assert store.current_picks().count() == 2 and {(r.gameweek, r.chip_used) for r in store.chip_usage().collect()} == {(4, "bboost"), (5, None)}
    assert [r.free_transfers for r in store.free_transfers(5).collect()] == [2]
    assert store.player_metrics(5).count() == 1 and store.fixture_runs().columns == t.FIXTURE_RUNS.names()
    assert store.availability(5, include_backfilled=False).count() == 0 and store.snapshots(player_id=1).count() == 2
    assert store.live(4).columns[1] == "event" and store.gameweek_performance(5).first().player_id == 2
    assert store.current_teams().columns == ["team_id", "name", "short_name", "as_of_utc"]
    assert store.normalised_fixtures().columns == ["fixture_id", "event", "home_team_id", "away_team_id"]
    assert [r.form for r in store.players_enhanced().orderBy("player_id").collect()] == [7.0, None]
    one = store.player_status("ekitike").collect()
    assert [(r.player_id, r.full_name, r.status_meaning, r.chance_this_round, r.current_price) for r in one] == [
        (1, "Hugo Ekitiké", "Available", 55.5, 8.5)]
    assert store.player_status("SALAH").first().status_meaning == "Unknown: z" and store.player_status("nobody").count() == 0
    assert {r["table"]: r["rows"] for r in store.summary().collect()}["raw_fixtures"] == 2
    fresh = {r["table"]: r.newest for r in store.freshness("2025-01-03 05:00:00").collect()}
    assert set(fresh) == {"derived_player_metrics", "raw_teams_bootstrap", "ALL"}
    for name in ("events", "game_settings", "element_stats", "element_types", "chips", "phases"):
        assert getattr(store, name)().count() == 0
    assert len(views.ENHANCED) == 47 and set(views.ENHANCED) <= set(t.PLAYERS.names())


def test_picks_and_performance_rules(spark):
    squad = [(1, 1, p, p == 1, p == 2) for p in range(1, 16)]
    broken = [(2, 1, p, p < 3, False) for p in range(1, 15)] + [(2, 1, 14, False, False)]
    rep = {r.check: (r.violations, r.total) for r in q.check_picks(spark.createDataFrame(
        squad + broken + [(3, 1, 5, True, True)], "manager_id int, event int, player_id int, is_captain boolean, is_vice_captain boolean")).collect()}
    assert rep == {"picks": (1, 3), "one_captain": (1, 3), "one_vice_captain": (1, 3), "no_player_twice": (1, 3)}
    perf = spark.createDataFrame([(-11, 90, 0, 0, 1), (5, 121, -1, 0, 1), (3, 90, 0, 0, 2)], "total_points int, minutes int, goals_scored int, assists int, gameweek int")
    rep = {r.column: r.violations for r in q.validate(perf, "p", q.performance_rules()).collect()}
    assert rep == {"total_points": 1, "minutes": 1, "goals_scored": 1, "assists": 0}
    ev = spark.createDataFrame([(1, True), (2, True), (3, True), (4, False), (5, None)], "event_id int, finished boolean")
    r = q.check_finished_have_stats(ev, perf).first()
    assert (r.violations, r.total, r.status) == (1, 3, "fail")


def test_overall_freshness(spark):
    a = spark.createDataFrame([("2025-01-01 00:00:00",), (None,)], "ts string")
    z = spark.createDataFrame([("2025-01-03 00:00:00",)], "at string")
    got = {r["table"]: (str(r.oldest)[:10], str(r.newest)[:10], r.stamped, r.age_hours, r.status) for r in
           q.freshness_overall({"a": (a, "ts"), "z": (z, "at"), "n": (a.limit(0), "ts")}, "2025-01-03 05:00:00").collect()}
    assert got == {"a": ("2025-01-01", "2025-01-01", 1, 53.0, "very_stale"), "z": ("2025-01-03", "2025-01-03", 1, 5.0, "fresh"),
                   "ALL": ("2025-01-01", "2025-01-03", 2, 5.0, "fresh")}


def test_odds_editions_come_from_one_pass_and_a_row_is_carried_once(spark):
    """Both editions of the provider rows are one read of the lines, and the pick of the newest packs each column once."""
    from matchday.plans import bindings as b
    from matchday.plans import q_stored
    from matchday.sources import ingest
    d = "/root/testdata/sf0.001"
    rows = q_stored._provider_rows(spark, d)
    assert rows._jdf.queryExecution().optimizedPlan().collectLeaves().mkString("\n").count("l_orderkey#") == 1
    old, new = rows.where("seen = 1"), rows.where("seen = 2")
    odds = b.odds(spark, d)
    assert new.count() == odds.count() and old.count() == odds.where("home_team_id % 5 = 0").count() > 0
    assert [r.B365H for r in old.select("B365H").distinct().collect()] == ["9.0"]
    # an old edition is its new one in everything but that price
    rest = [c for c in rows.columns if c not in ("seen", "B365H")]
    assert old.select(rest).exceptAll(new.select(rest)).count() == 0

    matched = spark.createDataFrame([(1, 1, 9.0, None, None), (1, 2, 1.5, "b", None), (1, 2, 1.5, "c", None), (2, 1, None, None, None),
                                     (3, 1, 2.0, "x", "date")], "fixture_id long, seen int, B365H double, referee string, refused string")
    picked = ingest.newest_per_fixture(matched, ["seen"])
    assert picked.columns == ["fixture_id", "seen", "B365H", "referee"]
    assert sorted(tuple(r) for r in picked.collect()) == [(1, 2, 1.5, "c"), (2, 1, None, None)]
    assert [tuple(r) for r in ingest.newest_per_fixture(matched.where("fixture_id = 1").drop("seen")).collect()] == [(1, 9.0, None)]
    aggregate = [l for l in picked._jdf.queryExecution().analyzed().toString().split("\n") if "Aggregate" in l]
    assert len(aggregate) == 1 and aggregate[0].count("referee#") == 1
