"""Views, accessors and the remaining ingest helpers."""
import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from matchday.operators import views
from matchday.sources import flatten, imports

BOOT = ("elements array<struct<id:long,team:long,element_type:int,now_cost:int,news:string,"
        "chance_of_playing_next_round:double,news_added:string>>, "
        "teams array<struct<id:long,name:string,strength:int>>, "
        "events array<struct<id:int,is_current:boolean,deadline_time:string,chip_plays:array<struct<chip_name:string,"
        "num_played:int>>,top_element_info:struct<id:int,points:int>,overrides:struct<rules:map<string,string>>>>, "
        "chips array<struct<id:int,name:string,overrides:struct<x:int>>>, "
        "game_settings struct<league_join_private_max:int,sys_vice_captain_enabled:boolean,squad_squadplay:int,"
        "league_prefix_public:array<string>>")


def _docs(spark, obj, schema):
    return flatten.parse_docs(spark.createDataFrame([(json.dumps(obj),)], "j string"), "j", schema)


def test_bootstrap_sections_and_settings(spark):
    doc = {"elements": [{"id": 1, "team": 3, "element_type": 2, "now_cost": None, "news": None,
                         "chance_of_playing_next_round": None, "news_added": "2025-01-02T10:00:00Z"}],
           "teams": [{"id": 3, "name": "C", "strength": 4}],
           "events": [{"id": 1, "is_current": True, "deadline_time": "bad", "chip_plays": [],
                       "top_element_info": None, "overrides": {"rules": {}}}],
           "chips": [{"id": 7, "name": "wildcard", "overrides": None}],
           "game_settings": {"league_join_private_max": 25, "sys_vice_captain_enabled": True, "squad_squadplay": 11,
                             "league_prefix_public": None}}
    d = _docs(spark, doc, BOOT)
    out = flatten.flatten_bootstrap(d, "2025-01-03 00:00:00")
    assert "raw_element_stats" not in out and "raw_phases" not in out  # missing sections skipped
    p = out["raw_players_bootstrap"].first()
    assert (p.player_id, p.team_id, p.position_id, p.now_cost, p.news) == (1, 3, 2, 0, "")
    assert p.chance_of_playing_next_round is None and p.news_added.day == 2
    e = out["raw_events_bootstrap"].first()
    assert e.event_id == 1 and e.chip_plays == "[]" and e.top_element_info == "{}" and e.deadline_time is None
    assert out["raw_chips"].first().chip_id == 7 and out["raw_chips"].first().overrides == "{}"
    gs = flatten.game_settings(d, "2025-01-03 00:00:00", json_cols=["league_prefix_public"]).first()
    assert gs.id == 1 and gs.league_prefix_public == "[]" and gs.squad_squadplay == 11


def test_picks_summary_manager(spark):
    schema = ("active_chip string, picks array<struct<element:int,position:int,is_captain:boolean,multiplier:int>>, "
              "entry_history struct<event:int,entry:int,points:int,event_transfers:int>")
    d = _docs(spark, {"active_chip": "bboost", "picks": [{"element": 5, "position": 1, "is_captain": True,
                                                          "multiplier": 2}, {"element": 6, "position": 2,
                                                                             "is_captain": False, "multiplier": 1}],
                      "entry_history": {"event": 3, "entry": 99, "points": 50, "event_transfers": 1}}, schema)
    picks = flatten.flatten_picks(d, 3).orderBy("position").collect()
    assert [(r.player_id, r.chip_used, r.event) for r in picks] == [(5, "bboost", 3), (6, "bboost", 3)]
    s = flatten.flatten_summary(d).first()
    assert (s.manager_id, s.event, s.event_transfers) == (99, 3, 1)
    m = flatten.flatten_manager(_docs(spark, {"id": 99, "name": "me"}, "id int, name string")).first()
    assert (m.manager_id, m.name) == (99, "me")


def test_import_snapshots_and_results(spark):
    rows = spark.createDataFrame([(1, "nan", "NaN", "a")], "player_id int, news string, form string, status string")
    out = imports.import_snapshots(rows, 1, 3, "2025-01-01 00:00:00").collect()
    assert sorted(r.gameweek for r in out) == [1, 2, 3]
    assert all(r.news == "" and r.form == "0.0" and r.is_backfilled for r in out)
    with pytest.raises(ValueError):
        imports.import_snapshots(rows, 1, 7, "2025-01-01 00:00:00")
    fx = spark.createDataFrame([(dt.datetime(2024, 8, 1), 1, 2, 1, 0), (dt.datetime(2024, 8, 2), 1, 9, None, None)],
                               "kickoff_utc timestamp, home_team_id int, away_team_id int, team_h_score int, "
                               "team_a_score int")
    teams = spark.createDataFrame([(1, "A")], "team_id int, name string")
    r = imports.normalise_results(fx, teams, "2024-2025").collect()
    assert len(r) == 1 and (r[0].home_team, r[0].away_team, r[0].season) == ("A", "Team_2", "2024-2025")
    assert spark.range(1).select(imports.season_key("2024-2025").alias("k")).first().k == "2024-25"


def test_views_and_accessors(spark, scratch):
    perf = spark.createDataFrame([(1, 1, 5, False), (1, 2, 3, True), (2, 2, 7, False)],
                                 "player_id int, gameweek int, total_points int, is_backfilled boolean")
    perf.write.partitionBy("gameweek").parquet(f"{scratch}/raw_player_gameweek_performance")
    perf.write.partitionBy("gameweek").parquet(f"{scratch}/raw_player_gameweek_snapshot")
    store = views.TableStore(spark, scratch)
    assert store.performance(start_gw=2).count() == 2
    assert store.performance(player_id=1, end_gw=1).count() == 1
    assert store.snapshots(include_backfilled=False).count() == 2
    lp = views.legacy_players(spark.createDataFrame([(3, "x", 1, 2, 55, "q")], "player_id int, web_name string, "
                                                    "team_id int, position_id int, now_cost int, status string")).first()
    assert (lp.mapped_player_id, lp.position, lp.price, lp.status_meaning) == (3, "DEF", 5.5, "Unknown: q")
    e = views.typed_empty(spark, "event int, team_h int")
    assert e.count() == 0 and e.columns == ["event", "team_h"]
    assert views.legacy_live(perf).columns[1] == "event"
    st = views.group_size_stats(perf, ["player_id"], "gameweek").orderBy("gameweek").collect()
    assert [(r.gameweek, r.max_size, r.groups) for r in st] == [(1, 1, 1), (2, 1, 2)]
    assert [r.total_points for r in views.preview(perf, [F.col("total_points").desc()], 2).collect()] == [7, 5]
