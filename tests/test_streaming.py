"""Streaming capture jobs driven to completion with availableNow."""
import json
import os

import pytest

from matchday.streaming import capture

SNAP = "player_id int, gameweek int, status string"
ODDS = "fixture_id int, B365H double, as_of_utc string"


def land(folder, name, rows):
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, name), "w") as f:
        for r in rows:
            f.write(json.dumps(r) + "\n")


def test_snapshot_stream_appends_and_rejects_duplicates(spark, scratch):
    landing, table = f"{scratch}/landing", f"{scratch}/snapshots"
    land(landing, "a.json", [{"player_id": 1, "gameweek": 1, "status": "a"}, {"player_id": 2, "gameweek": 1, "status": "i"}])
    q = capture.capture_snapshots(spark, landing, SNAP, table, checkpoint=f"{scratch}/ck1")
    q.awaitTermination()
    land(landing, "b.json", [{"player_id": 3, "gameweek": 2, "status": "a"}])
    q = capture.capture_snapshots(spark, landing, SNAP, table, checkpoint=f"{scratch}/ck1")
    q.awaitTermination()
    got = sorted((r.player_id, r.gameweek) for r in spark.read.parquet(table).collect())
    assert got == [(1, 1), (2, 1), (3, 2)]
    land(landing, "c.json", [{"player_id": 1, "gameweek": 1, "status": "d"}])
    q = capture.capture_snapshots(spark, landing, SNAP, table, checkpoint=f"{scratch}/ck1")
    with pytest.raises(Exception):
        q.awaitTermination()


def test_second_checkpoint_loses_nothing(spark, scratch):
    landing, other, table = f"{scratch}/l1", f"{scratch}/l2", f"{scratch}/t"
    land(landing, "a.json", [{"player_id": 1, "gameweek": 1, "status": "a"}])
    capture.capture_snapshots(spark, landing, SNAP, table, checkpoint=f"{scratch}/c1").awaitTermination()
    land(other, "b.json", [{"player_id": 9, "gameweek": 1, "status": "a"}])
    capture.capture_snapshots(spark, other, SNAP, table, checkpoint=f"{scratch}/c2").awaitTermination()
    assert sorted(r.player_id for r in spark.read.parquet(table).collect()) == [1, 9]


def test_replayed_batch_writes_what_is_missing(spark, scratch):
    table = f"{scratch}/t"
    batch = spark.createDataFrame([(1, 1, "a"), (2, 1, "i")], SNAP)
    write = capture.snapshot_batch_writer(table, ["player_id", "gameweek"], stream="s1")
    write(batch.where("player_id = 1"), 0)  # a first run that was cut short
    write(batch, 0)
    write(batch, 0)
    assert sorted(r.player_id for r in spark.read.parquet(table).collect()) == [1, 2]
    with pytest.raises(capture.DuplicateKeyError):
        capture.snapshot_batch_writer(table, ["player_id", "gameweek"], stream="s2")(batch, 0)


def test_odds_stream_newest_wins(spark, scratch):
    landing, table = f"{scratch}/odds_in", f"{scratch}/odds"
    land(landing, "a.json", [{"fixture_id": 1, "B365H": 2.0, "as_of_utc": "2025-01-01T10:00:00"},
                             {"fixture_id": 1, "B365H": 2.2, "as_of_utc": "2025-01-01T12:00:00"},
                             {"fixture_id": 2, "B365H": 3.0, "as_of_utc": "2025-01-01T10:00:00"}])
    capture.capture_odds(spark, landing, ODDS, table, checkpoint=f"{scratch}/ck2").awaitTermination()
    land(landing, "b.json", [{"fixture_id": 2, "B365H": 3.5, "as_of_utc": "2025-01-02T10:00:00"}])
    capture.capture_odds(spark, landing, ODDS, table, checkpoint=f"{scratch}/ck2").awaitTermination()
    got = {r.fixture_id: r.B365H for r in spark.read.parquet(table).collect()}
    assert got == {1: 2.2, 2: 3.5}
