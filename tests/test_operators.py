"""Generic operators against pandas twins and hand-computed answers."""
import re

import pandas as pd
import pytest
from pyspark.sql import functions as F

from matchday.operators import joins, merge, periods, rank, reshape, runs
from matchday.operators.filters import fold_accents, name_lookup


def test_pct_rank_matches_pandas_average_ties(spark):
    rows = [(i, g, v) for i, (g, v) in enumerate(
        [(1, 3.0), (1, 1.0), (1, 3.0), (1, None), (1, 2.0), (2, 5.0), (2, 5.0), (9, 1.0), (None, 4.0), (1, float("nan"))])]
    df = spark.createDataFrame(rows, "id long, g int, v double")
    out = rank.pct_rank_avg(df, "v", "g", out="p", valid=F.col("g").isin(1, 2), buckets=2)
    got = {r.id: r.p for r in out.collect()}
    pdf = pd.DataFrame(rows, columns=["id", "g", "v"])
    for g in (1, 2):
        sub = pdf[pdf.g == g]
        want = sub.v.rank(pct=True) * 100
        for i, w in zip(sub.id, want):
            assert got[i] == pytest.approx(50.0 if pd.isna(w) else w)
    assert got[7] == 50.0 and got[8] == 50.0


def test_pct_rank_many_buckets_exact(spark):
    import random
    rnd = random.Random(7)
    rows = [(i, rnd.randint(1, 3), float(rnd.randint(0, 40))) for i in range(3000)]
    df = spark.createDataFrame(rows, "id long, g int, v double")
    got = {r.id: r.p for r in rank.pct_rank_avg(df, "v", "g", out="p", buckets=16).collect()}
    pdf = pd.DataFrame(rows, columns=["id", "g", "v"])
    pdf["want"] = pdf.groupby("g").v.rank(pct=True) * 100
    for i, w in zip(pdf.id, pdf.want):
        assert got[i] == pytest.approx(w, abs=1e-9)


def test_latest_and_first_by(spark):
    df = spark.createDataFrame([(1, 10, "a"), (1, 30, "b"), (1, 20, "c"), (2, 5, "d")], "k int, t int, x string")
    assert {r.k: r.x for r in rank.latest_by(df, "k", ["t"]).collect()} == {1: "b", 2: "d"}
    assert {r.k: r.x for r in rank.first_by(df, "k", ["t"]).collect()} == {1: "a", 2: "d"}
    assert [r.t for r in rank.latest_partition(df, "t").collect()] == [30]


def test_perspectives_two_rows_per_fixture(spark):
    fx = spark.createDataFrame([(1, 10, 20, 2, 1)], "fixture_id int, h int, a int, hs int, as_ int")
    out = reshape.fixture_sides(fx, "h", "a", "hs", "as_", keep=["fixture_id"]).orderBy("is_home").collect()
    assert [(r.team_id, r.opponent_id, r.is_home, r.goals_for, r.goals_against) for r in out] == [
        (20, 10, False, 1, 2), (10, 20, True, 2, 1)]


def test_forward_runs_sizes_and_swing(spark):
    # team 1 has six fixtures, team 2 two, team 3 five
    rows = [(1, e, e, d) for e, d in zip(range(1, 7), [1.0, 2.0, 3.0, 4.0, 5.0, 0.0])]
    rows += [(2, 1, 100, 2.0), (2, 2, 101, 4.0)]
    rows += [(3, e, 200 + e, d) for e, d in zip(range(1, 6), [2.0, 2.0, 2.0, 2.0, 2.0])]
    df = spark.createDataFrame(rows, "team_id int, event int, fixture_id int, difficulty double")
    got = {r.team_id: r for r in runs.forward_runs(df, "team_id", [F.col("event"), F.col("fixture_id")],
                                                   "difficulty").collect()}
    assert got[1].run_3_mean == pytest.approx(2.0) and got[1].run_5_mean == pytest.approx(3.0)
    assert got[1].run_3_easy == 2 and got[1].run_5_easy == 2
    assert got[1].run_swing == pytest.approx(4.0 - 1.5)
    assert got[2].run_swing == 0.0 and got[2].run_3_mean == pytest.approx(3.0)
    assert got[3].run_5_easy == 5 and got[3].run_swing == pytest.approx(0.0)


def test_new_entities_rules(spark):
    cur = spark.createDataFrame([(1,), (2,), (3,)], "player_id int")
    hist = spark.createDataFrame([(1, 1), (2, 5)], "player_id int, gameweek int")
    assert sorted(r.player_id for r in joins.new_entities(cur, hist, "player_id", "gameweek", 3).collect()) == [2, 3]
    empty = hist.limit(0)
    assert joins.new_entities(cur, empty, "player_id", "gameweek", 3).count() == 0
    assert joins.new_entities(cur, hist, "player_id", "gameweek", 1).count() == 0


def test_join_one_to_one_raises_on_duplicates(spark):
    a = spark.createDataFrame([(1, "x"), (1, "y")], "k int, v string")
    b = spark.createDataFrame([(1, "z")], "k int, w string")
    with pytest.raises(joins.DuplicateKeyError):
        joins.join_one_to_one(a, b, "k")
    c = spark.createDataFrame([(1, "x", 5)], "k int, v string, w int")
    out = joins.join_one_to_one(c, b, "k").first()
    assert out.w == "z"  # right side wins


def test_match_exactly_one(spark):
    left = spark.createDataFrame([(1, "d1", 10), (2, "d1", 11), (3, "d2", 10)], "id int, d string, t int")
    right = spark.createDataFrame([(100, "d1", 10), (101, "d1", 11), (102, "d1", 11)], "fid int, d2 string, t2 int")
    m, u = joins.match_exactly_one(left, right, {"d": "d2", "t": "t2"}, "id", ["fid"])
    assert {r.id: r.fid for r in m.collect()} == {1: 100}
    assert sorted(r.id for r in u.collect()) == [2, 3]


def test_resolve_names_with_alias_maps(spark):
    dim = spark.createDataFrame([(1, "Man Utd"), (2, "Spurs")], "team_id int, name string")
    rows = spark.createDataFrame([("Man United",), ("Spurs",), ("Nowhere",)], "n string")
    a1 = joins.alias_table(spark, {"Man United": "Man Utd", "Tottenham": "Spurs"})
    ok, rej = joins.resolve_names(rows, "n", "team_id", dim, "name", "team_id", a1)
    assert sorted((r.n, r.team_id) for r in ok.collect()) == [("Man United", 1), ("Spurs", 2)]
    assert [r.n for r in rej.collect()] == ["Nowhere"]


def test_name_variants_first_writer_wins(spark):
    people = spark.createDataFrame([(1, "Ann", "Lee", "Lee"), (2, "Lee", "Ann", "Ann")],
                                   "id int, first string, second string, web string")
    v = [F.concat_ws(" ", "first", "second"), F.concat_ws(" ", "second", "first"), F.col("web"), F.col("first"),
         F.col("second")]
    m = {r.name: r.id for r in joins.name_variants(people, "id", "id", v).collect()}
    assert m["Ann Lee"] == 1 and m["Lee Ann"] == 1 and m["Lee"] == 1 and m["Ann"] == 1


def test_merge_latest_and_diff(spark):
    old = spark.createDataFrame([(1, "old"), (2, "old")], "k int, v string")
    new = spark.createDataFrame([(2, "new"), (3, "new")], "k int, v string")
    assert {r.k: r.v for r in merge.merge_latest([old, new], "k").collect()} == {1: "old", 2: "new", 3: "new"}
    d = {(r.k, r.side) for r in merge.diff_keys(old, new, "k").collect()}
    assert d == {(1, "missing"), (3, "extra")}


def test_missing_periods(spark):
    have = spark.createDataFrame([(1, 1), (1, 3)], "p int, period int")
    exp = merge.period_axis(4, spark=spark).withColumn("p", F.lit(1))
    got = sorted(r.period for r in merge.missing_periods(have, "period", exp, by=["p"]).collect())
    assert got == [2, 4]


def test_current_period_and_free_transfers(spark):
    ev = spark.createDataFrame([(1, False, True), (2, True, False), (3, False, False)],
                               "event_id int, is_current boolean, finished boolean")
    r = periods.target_period(periods.current_period(ev)).first()
    assert (r.current, r.finished, r.target) == (2, False, 2)
    none = ev.where("false")
    r = periods.current_period(none).first()
    assert (r.current, r.finished) == (1, True)
    summary = spark.createDataFrame([(7, 1, 0), (7, 2, 0), (7, 3, 2), (7, 4, 1), (7, 6, 0)],
                                    "manager_id int, event int, event_transfers int")
    chips = spark.createDataFrame([(7, 4, "Wildcard")], "manager_id int, event int, chip_used string")
    got = {r.event: r.free_transfers for r in periods.free_allowance(summary, chips).collect()}
    assert got == {1: 1, 2: 2, 3: 2, 4: 1, 6: 1}


def test_accent_lookup_falls_back(spark):
    df = spark.createDataFrame([(1, "Ekitiké"), (2, "Salah"), (3, "Ødegaard")], "id int, web_name string")
    assert [r.id for r in name_lookup(df, "web_name", "salah").collect()] == [2]
    assert [r.id for r in name_lookup(df, "web_name", "Ekitike").collect()] == [1]
    assert spark.range(1).select(fold_accents(F.lit("ÉÈç")).alias("v")).first().v == "eec"


def test_choose_targets_modes(spark):
    have = spark.createDataFrame([(1,), (2,), (4,)], "gw int")
    assert sorted(r.period for r in periods.choose_targets(have, "gw", 5).collect()) == [3, 5]
    assert sorted(r.period for r in periods.choose_targets(have, "gw", 5, mode="force").collect()) == [1, 2, 3, 4, 5]
    assert [r.period for r in periods.choose_targets(have, "gw", 5, mode="single", single=2).collect()] == []
    assert sorted(r.period for r in periods.choose_targets(have, "gw", 9, mode="range", span=(3, 6)).collect()) == [3, 5, 6]


def test_chip_history_merges_new_over_stored(spark):
    picks = spark.createDataFrame([(1, 3, "bboost", 2), (1, 3, "bboost", 1), (1, 4, None, 1)],
                                  "manager_id int, event int, chip_used string, position int")
    stored = spark.createDataFrame([(1, 2, "wildcard"), (1, 3, "old")], "manager_id int, event int, chip_used string")
    got = {r.event: r.chip_used for r in periods.chip_history(picks, stored).collect()}
    assert got == {2: "wildcard", 3: "bboost", 4: None}


def test_small_filters(spark):
    from matchday.operators import filters
    df = spark.createDataFrame([(1, "2.5", 3, None), (2, "x", 3, True), (3, "1", 4, False)],
                               "id int, form string, event int, finished boolean")
    p = filters.project_available(df, [("id", None), ("form", "num"), ("missing", "int")]).collect()
    assert [tuple(r) for r in p] == [(1, 2.5), (2, None), (3, 1.0)]
    assert [r.id for r in filters.upcoming(df, "event", 3).collect()] == [1]
    ids = spark.createDataFrame([(3,), (3,)], "id int")
    assert [r.id for r in filters.in_id_set(df, ids, "id").collect()] == [3]
    assert [r.id for r in joins.join_filter(df, ids.withColumn("ok", F.lit(True)), "id", F.col("ok")).collect()] == [3]


def test_pending_skips_present_unless_forced(spark):
    targets = spark.createDataFrame([(1, 3), (2, 3)], "player_id int, gameweek int")
    have = spark.createDataFrame([(1, 3)], "player_id int, gameweek int")
    assert [r.player_id for r in periods.pending(targets, have, ["player_id", "gameweek"]).collect()] == [2]
    assert periods.pending(targets, have, ["player_id", "gameweek"], force=True).count() == 2


def test_duplicate_keys_fail_as_the_plan_runs(spark):
    from matchday.operators.joins import join_one_to_one
    a = spark.createDataFrame([(1, "a"), (1, "b")], "k int, x string")
    b = spark.createDataFrame([(1, "c")], "k int, y string")
    j = join_one_to_one(a, b, "k", check="lazy")  # nothing runs yet
    with pytest.raises(Exception, match="not unique"):
        j.collect()
    assert join_one_to_one(b, a.limit(1), "k", check="lazy").count() == 1


def test_rank_windows_sit_on_group_and_bucket(spark):
    from matchday.operators.rank import pct_rank_avg
    rows = [(("a" if i % 10 else "b") if i % 7 else None, float(i * 37 % 1000)) for i in range(3000)]
    df = spark.createDataFrame(rows, "g string, v double")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = pct_rank_avg(df, "v", "g", per_bucket=50)
        plan = out._jdf.queryExecution().executedPlan().toString()
        windows = re.findall(r"Window .*?Exchange (hashpartitioning\([^)]*\))", plan, re.S)
        assert any("__k" in w for w in windows), plan  # the windows over rows sit on (group, bucket)
        got = out.toPandas()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    want = df.toPandas()
    want["pct_rank"] = (want.groupby("g")["v"].rank(pct=True) * 100).where(want["g"].notna(), 50.0)
    key = lambda d: sorted(map(repr, d[["g", "v", "pct_rank"]].round(9).itertuples(index=False, name=None)))
    assert key(got) == key(want)


def test_accents_of_every_letter_fold(spark):
    from matchday.operators.filters import name_lookup
    df = spark.createDataFrame([("Nguyễn",), ("Škoda",), ("e\u0301cole",), ("Ǻland",)], "n string")
    for term, hit in (("Nguyen", "Nguyễn"), ("skoda", "Škoda"), ("ecole", "e\u0301cole"), ("aland", "Ǻland")):
        assert [r.n for r in name_lookup(df, "n", term).collect()] == [hit]


def test_missing_extra_reads_every_row_of_its_tables(spark, tmp_path):
    from matchday.plans.catalog import all_queries
    tables = {"customer": ("c_custkey long", [(1,), (2,), (3,)]), "labels": ("doc_id long", [(1,), (9,)]),
              "part": ("p_partkey long, p_size int", [(1, 5), (2, 40), (7, 1), (8, 50)]), "orders": ("o_custkey long", [(1,), (1,), (2,), (3,)])}
    for name, (schema, rows) in tables.items():
        spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/{name}.parquet")
    got = {(r.source, r.id, r.side) for r in all_queries()["missing_extra"][0](spark, str(tmp_path)).collect()}
    # parts of any size count: 1 is not missing, 7 is extra
    assert got == {("labels", 2, "missing"), ("labels", 3, "missing"), ("labels", 9, "extra"),
                   ("part", 3, "missing"), ("part", 7, "extra"), ("part", 8, "extra")}
