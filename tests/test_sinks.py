"""Write semantics on scratch folders."""
import pytest
from pyspark.sql import functions as F

from matchday.operators.joins import DuplicateKeyError
from matchday.sources import sinks


def rows(spark, path):
    return sorted(tuple(r) for r in spark.read.parquet(path).select("k", "gameweek", "v").collect())


def test_replace_partitions_keeps_others(spark, scratch):
    p = f"{scratch}/t"
    spark.createDataFrame([(1, 1, "a"), (2, 2, "b")], "k int, gameweek int, v string").write.partitionBy("gameweek").parquet(p)
    sinks.replace_partitions(spark.createDataFrame([(3, 2, "c")], "k int, gameweek int, v string"), p, "gameweek")
    assert rows(spark, p) == [(1, 1, "a"), (3, 2, "c")]


def test_append_unique_conflict_and_force(spark, scratch):
    p = f"{scratch}/snap"
    first = spark.createDataFrame([(1, 1, "a"), (2, 1, "b")], "k int, gameweek int, v string")
    sinks.append_unique(first, p, ["k", "gameweek"], partition_col="gameweek")
    dup = spark.createDataFrame([(1, 1, "z")], "k int, gameweek int, v string")
    with pytest.raises(DuplicateKeyError):
        sinks.append_unique(dup, p, ["k", "gameweek"], partition_col="gameweek")
    batch_dup = spark.createDataFrame([(5, 2, "x"), (5, 2, "y")], "k int, gameweek int, v string")
    with pytest.raises(DuplicateKeyError):
        sinks.append_unique(batch_dup, p, ["k", "gameweek"], partition_col="gameweek")
    sinks.append_unique(spark.createDataFrame([(3, 2, "c")], "k int, gameweek int, v string"), p, ["k", "gameweek"],
                        partition_col="gameweek")
    sinks.append_unique(dup, p, ["k", "gameweek"], force=True, partition_col="gameweek")
    assert rows(spark, p) == [(1, 1, "z"), (3, 2, "c")]


def test_insert_ignore_and_replace_keys(spark, scratch):
    p = f"{scratch}/va"
    base = spark.createDataFrame([(1, 1, "keep"), (2, 1, "keep")], "k int, gameweek int, v string")
    base.write.parquet(p)
    new = spark.createDataFrame([(2, 1, "new"), (3, 1, "first"), (3, 1, "second")], "k int, gameweek int, v string")
    sinks.insert_ignore(new, p, ["k", "gameweek"], order=[F.col("v")])
    assert rows(spark, p) == [(1, 1, "keep"), (2, 1, "keep"), (3, 1, "first")]
    sinks.replace_keys(spark.createDataFrame([(2, 1, "upd")], "k int, gameweek int, v string"), p, ["k", "gameweek"])
    assert rows(spark, p) == [(1, 1, "keep"), (2, 1, "upd"), (3, 1, "first")]


def test_frames(spark):
    old = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    new = spark.createDataFrame([(2, "c")], "k int, v string")
    assert sorted(tuple(r) for r in sinks.replace_keys_frame(old, new, "k").collect()) == [(1, "a"), (2, "c")]
    conf = {(r.k, r.reason) for r in sinks.append_conflicts(old, new.unionByName(new), "k").collect()}
    assert conf == {(2, "exists"), (2, "duplicate")}


def test_save_many_isolates_failures(spark, scratch):
    good = spark.createDataFrame([(1,)], "k int")
    empty = good.limit(0)
    st = sinks.save_many({"a": good, "b": empty, "c": good}, scratch, known=["a", "b"])
    assert st == {"a": "saved", "b": "skipped: empty", "c": "skipped: unknown table"}


def test_normalise_timestamps(spark):
    df = spark.createDataFrame([("2024-01-02 03:04:05",), ("garbage",)], "ts string")
    out = [r.ts for r in sinks.normalise_timestamps(df, ["ts"]).collect()]
    assert out[1] is None and out[0].hour == 3


def test_force_rejects_keys_repeated_in_the_batch(spark, scratch):
    dup = spark.createDataFrame([(1, 1, "a"), (1, 1, "b")], "k int, gameweek int, v string")
    with pytest.raises(sinks.DuplicateKeyError):
        sinks.append_unique(dup, f"{scratch}/f", ["k", "gameweek"], force=True, partition_col="gameweek")


def test_replace_keys_keeps_partitions_and_rewrites_only_touched(spark, scratch):
    import os
    p = f"{scratch}/part"
    rows = [(1, 1, "a"), (2, 2, "b"), (3, 3, "c"), (4, 3, "d")]
    sinks.replace_all(spark.createDataFrame(rows, "k int, gameweek int, v string"), p, partition_col="gameweek")
    before = {d: os.listdir(f"{p}/{d}") for d in os.listdir(p) if "=" in d}
    # key 2 moves to gameweek 3: its old partition empties; key 9 opens gameweek 4
    sinks.replace_keys(spark.createDataFrame([(2, 3, "B"), (9, 4, "n")], "k int, gameweek int, v string"), p, "k",
                       partition_col="gameweek")
    got = sorted((r.k, r.gameweek, r.v) for r in spark.read.parquet(p).collect())
    assert got == [(1, 1, "a"), (2, 3, "B"), (3, 3, "c"), (4, 3, "d"), (9, 4, "n")]
    assert os.listdir(f"{p}/gameweek=1") == before["gameweek=1"] and not os.path.exists(f"{p}/gameweek=2")


def test_replace_all_may_read_its_own_table(spark, scratch):
    p = f"{scratch}/own"
    sinks.replace_all(spark.range(5), p)
    sinks.replace_all(spark.read.parquet(p).where("id > 2"), p)
    assert sorted(r.id for r in spark.read.parquet(p).collect()) == [3, 4]
    bad = spark.read.parquet(p).select(F.raise_error(F.lit("no")).cast("long").alias("id"))
    with pytest.raises(Exception, match="no"):
        sinks.replace_all(bad, p)
    assert sorted(r.id for r in spark.read.parquet(p).collect()) == [3, 4]


def test_save_many_runs_a_plan_once_and_leaves_stored_tables_for_empty_ones(spark, scratch):
    seen = spark.sparkContext.accumulator(0)

    def touch(rows):
        for r in rows:
            seen.add(len(r))
            yield r

    df = spark.range(10).select("id", (F.col("id") % 2).alias("p")).repartition(2)
    counted = df.mapInPandas(touch, df.schema)
    by = {"a": "p", "none": "p"}
    tables = {"a": counted.groupBy("id", "p").count(), "b": df, "none": df.where("id < 0"), "nothing": df.where("id < 0")}
    want = {"a": "saved", "b": "saved", "none": "skipped: empty", "nothing": "skipped: empty"}
    assert sinks.save_many(tables, scratch, partition_cols=by, workers=2) == want
    assert seen.value == 10
    import os
    assert sorted(os.listdir(scratch)) == ["a", "b"]
    assert sinks.save_many({"a": df.where("id < 0"), "b": df.where("id < 0")}, scratch, partition_cols=by) == dict.fromkeys("ab", "skipped: empty")
    assert spark.read.parquet(f"{scratch}/a").count() == 10 and spark.read.parquet(f"{scratch}/b").count() == 10
