"""Data-quality report operators."""
from pyspark.sql import functions as F

from matchday.quality import checks as q


def test_validate_collects_all_failures(spark):
    df = spark.createDataFrame([(1, "a", 5.0), (2, "x", -1.0), (None, "a", 200.0)], "id int, s string, v double")
    rep = {r.check + ":" + r.column: (r.violations, r.status) for r in q.validate(df, "t", [
        q.not_null("id"), q.isin("s", ["a", "b"]), q.between("v", 0.0, 100.0)]).collect()}
    assert rep == {"not_null:id": (1, "fail"), "isin:s": (1, "fail"), "range[0.0,100.0]:v": (2, "fail")}
    assert q.rejects(df, [q.not_null("id")]).count() == 1


def test_unique_fk_group_exactly(spark):
    df = spark.createDataFrame([(1, 1), (1, 1), (2, 1)], "k int, p int")
    assert q.check_unique(df, "t", ["k"]).first().violations == 1
    parent = spark.createDataFrame([(1,)], "p int")
    child = spark.createDataFrame([(1,), (2,), (None,)], "p int")
    assert q.check_fk(child, "c", "p", parent, "p").first().violations == 1
    assert q.check_group(df, "t", "two_rows", ["k"], F.count(F.lit(1)) == 2).first().violations == 1
    assert q.check_exactly(df, "t", "one_two", F.col("k") == 2).first().status == "pass"


def test_freshness_and_completeness(spark):
    df = spark.createDataFrame([("2024-01-30 12:00:00",)], "ts string").select(F.to_timestamp_ntz("ts").alias("ts"))
    rep = q.check_fresh({"a": (df, "ts"), "events": (df, "ts")}, "2024-01-31 12:00:00", {"events": (48.0, 336.0)})
    assert {r.table: r.status for r in rep.collect()} == {"a": "pass", "events": "pass"}
    rep = q.check_fresh({"a": (df, "ts")}, "2024-02-03 12:00:00", {})
    assert rep.first().status == "warn"
    f = q.freshness({"a": (df, "ts")}, "2024-01-30 17:00:00").first()
    assert f.age_hours == 5.0 and f.status == "fresh"
    c = {r.column: r.grade for r in q.completeness(spark.createDataFrame([(1, None), (2, None), (3, 1)], "a int, b int"), "t").collect()}
    assert c == {"a": "GOOD", "b": "POOR"}


def test_monotonic_and_summary(spark):
    df = spark.createDataFrame([(1, "2024-01-01"), (2, "2023-12-01"), (3, "2024-02-01")], "p int, d string") \
        .select("p", F.to_timestamp_ntz("d").alias("d"))
    rep = q.check_monotonic(df, "t", "p", "d", now="2024-01-15 00:00:00").collect()
    assert {r.check: r.violations for r in rep} == {"monotonic": 1, "not_future": 1}
    s = q.summarise([q.check_monotonic(df, "t", "p", "d")]).first()
    assert (s.checks, s.failed, s.success_rate) == (1, 1, 0.0)


def test_period_completeness(spark):
    t = spark.createDataFrame([(1,), (3,), (9,)], "gw int")
    got = {(r.period, r.issue) for r in q.period_completeness({"t": (t, "gw")}, 4).collect()}
    assert got == {(2, "missing"), (4, "missing"), (9, "future")}


def test_sanity_required_and_unexpected(spark):
    t = {"teams": spark.range(20), "weird": spark.range(1)}
    rep = {(r.table, r.check): r.status for r in q.sanity(t, expected_rows={"teams": 20}, required=["teams", "fixtures"],
                                                          known=["teams", "fixtures"]).collect()}
    assert rep[("teams", "row_count=20")] == "pass" and rep[("fixtures", "required_table")] == "fail"
    assert rep[("weird", "unexpected_table")] == "warn" and rep[("teams", "non_empty")] == "pass"


def test_periods_beside_the_expected_are_reported(spark):
    t = spark.createDataFrame([(0,), (1,), (2,), (5,), (9,)], "gw int")
    want = {(3, "missing"), (4, "missing"), (0, "extra"), (5, "extra"), (9, "future")}
    assert {(r.period, r.issue) for r in q.period_completeness({"t": (t, "gw")}, 4).collect()} == want
    upto = spark.createDataFrame([(4,)], "upto int")
    assert {(r.period, r.issue) for r in q.period_completeness({"t": (t, "gw")}, upto).collect()} == want
    assert [(r.violations, r.status) for r in q.check_periods({"t": (t, "gw")}, 4).collect()] == [(5, "fail")]


def test_sanity_of_absent_and_wider_tables(spark):
    t = {"a": spark.createDataFrame([(1, 2)], "x int, y int")}
    rep = {(r.table, r.check): (r.violations, r.status) for r in
           q.sanity(t, expected_rows={"b": 5}, expected_cols={"a": 1}).collect()}
    assert rep["b", "row_count=5"] == (5, "fail") and rep["a", "column_count=1"] == (0, "pass")


def test_reports_of_every_kind_summarise(spark):
    d = spark.createDataFrame([(1, 2.0), (1, 3.0), (2, 1.0)], "k int, v double")
    t = spark.createDataFrame([(1, 5.0), (2, 9.0)], "k int, total double")
    reps = [q.check_reconciled(d, "d", "k", F.col("v"), t, "total", 0.1), q.check_complete(d, "d"),
            q.check_periods({"d": (d, "k")}, 2)]
    assert [(r.violations, r.total, r.status) for r in reps[0].collect()] == [(1, 2, "fail")]
    one = q.summarise(reps).collect()[0]
    assert (one.checks, one.passed, one.failed) == (4, 3, 1)


def test_table_schema_reports_every_kind_of_failure(spark):
    from matchday.quality import schemas as s
    rows = [("1", "A", "abc", "2.5"), ("1", "", "ab", "x"), (None, "B", "abcd", "0.5")]
    df = spark.createDataFrame(rows, "player_id string, web_name string, short_name string, handicap_team_odds string")
    t = s.Table({"player_id": s.Col("bigint", lo=1), "web_name": s.Col(least=1), "short_name": s.Col(least=3, most=3),
                 "handicap_team_odds": s.Col("double", True, lo=1.0), "status": s.Col(values=("a", "i"))}, ["player_id"])
    got = {(r.check, r.column): (r.violations, r.status) for r in s.check_table(df, "t", t).collect()}
    assert got["not_null", "player_id"][0] == 1 and got["unique", "player_id"][0] == 1
    assert got["length[1,None]", "web_name"][0] == 1 and got["length[3,3]", "short_name"][0] == 2
    assert got["coerce:double", "handicap_team_odds"][0] == 1 and got["range[1.0,None]", "handicap_team_odds"][0] == 1
    assert got["column_present", "status"] == (1, "fail")
    assert [r.handicap_team_odds for r in s.coerce(df, t).collect()] == [2.5, None, 0.5]


def test_all_tables_are_declared():
    from matchday.quality import tables as t
    assert len(t.RAW) == 11 and len(t.DERIVED) == 7
    # fixed values: how many columns the provider's tables have
    sizes = {"raw_players_bootstrap": 102, "raw_teams_bootstrap": 22, "raw_events_bootstrap": 30, "raw_fixtures": 16,
             "raw_betting_odds": 57, "raw_player_gameweek_snapshot": 17}
    for name, table in t.TABLES.items():
        assert all(set(k.split(",")) <= set(table.names()) for k in table.keys), name
    assert {n: len(t.TABLES[n].columns) for n in sizes} == sizes


def test_table_schemas_judge_the_share_as_text_and_as_number(spark):
    from matchday.plans.catalog import all_queries
    got = [(r.check, r.violations) for r in all_queries()["dq_table_schemas"][0](spark, "/root/testdata/sf0.001").collect()
           if (r.table, r.column) == ("players", "selected_by_percent")]
    assert sorted(got) == [("coerce:double", 0), ("length[1,None]", 0), ("not_null", 0), ("range[0.0,100.0]", 0)]


def test_full_report_derives_shared_tables_once(spark, scratch):
    """Fixtures and players, which several reports read, are derived once; the reports see the same rows."""
    from matchday.plans import bindings as b
    from matchday.plans import q_quality
    d = "/root/testdata/sf0.001"
    t = b.stored(spark, d, scratch, "players", "fixtures")
    for n in ("players", "fixtures"):
        assert getattr(t, n)(spark, d).dtypes == getattr(b, n)(spark, d).dtypes
        assert getattr(t, n)(spark, d).exceptAll(getattr(b, n)(spark, d)).count() == 0
        assert getattr(t, n)(spark, d).count() == getattr(b, n)(spark, d).count()
    assert t.teams is b.teams
    leaves = q_quality._full_report_spark(spark, d)._jdf.queryExecution().optimizedPlan().collectLeaves().mkString("\n")
    assert leaves.count("l_orderkey#") <= 13, leaves.count("l_orderkey#")  # relations of lineitem; 24 when every report derived its own
