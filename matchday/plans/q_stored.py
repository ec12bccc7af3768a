"""Catalog entries for landed files and stored tables: rows that write to the shared scratch
folder and read back (A2-A7, A10, A12, A13, A15, C4, C5, D7, E6, H13, J1, J4, J7, L1, M2)."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.stored import json_kind, json_paths, newest_partition, rows_of_periods
from ..quality import checks as q
from ..quality import tables as declared
from ..quality.schemas import REJECTS
from ..session import ensure_checkpoint_dir
from ..sources import flatten, ingest, landing, sinks
from . import bindings as b
from . import features as feat
from . import refresh
from .bindings import AS_OF, AS_OF_SQL, GAMEWEEK, with_bindings
from .catalog import B, D, R, conform, query
from .q_features import _betting_sql


def scratch(spark: SparkSession, name: str) -> str:
    return f"{ensure_checkpoint_dir(spark)}/rows-{uuid.uuid4().hex}/{name}"


# ----------------------------------------------------------------------------- J4
def _j4_spark(spark, d):
    ev = b.read(spark, d, "events").select(F.col("user_id").alias("manager_id"), F.dayofmonth("ts").alias("event"), "value")
    first = ev.groupBy("manager_id", "event").agg(F.sum("value").alias("points")).withColumn("src", F.lit("first"))
    again = (ev.where(F.col("event") > 20).groupBy("manager_id", F.when(F.col("event") % 2 == 0, F.col("event")).otherwise(
        F.col("event") + 40).cast("int").alias("event")).agg(F.max("value").alias("points")).withColumn("src", F.lit("again")))
    path = scratch(spark, "summaries")
    sinks.upsert(first, path, ["manager_id", "event"], buckets=16)
    sinks.upsert(again, path, ["manager_id", "event"])
    return conform(sinks.read_upserted(spark, path))


query("upsert_two_keys", sql=f"""
WITH ev AS (SELECT user_id AS manager_id, day(ts) AS event, value FROM events),
a AS (SELECT manager_id, event, sum(value) AS points, 'first' AS src FROM ev GROUP BY ALL),
z AS (SELECT manager_id, CASE WHEN event % 2 = 0 THEN event ELSE event + 40 END AS event, max(value) AS points, 'again' AS src
      FROM ev WHERE event > 20 GROUP BY manager_id, CASE WHEN event % 2 = 0 THEN event ELSE event + 40 END)
SELECT manager_id, {B('event')} AS event, {R('points')} AS points, src FROM (
  SELECT * FROM a WHERE (manager_id, event) NOT IN (SELECT (manager_id, event) FROM z) UNION ALL SELECT * FROM z)""")(_j4_spark)


# ----------------------------------------------------------------------------- E6 / A13 on a partitioned copy
def _partitioned(spark, d) -> str:
    path = scratch(spark, "fixtures")
    sinks.replace_partitions(b.fixtures(spark, d).select("fixture_id", "event", "home_team_id", "away_team_id", "finished"),
                             path, "event")
    return path


query("stored_newest_partition", sql=with_bindings(f"""
SELECT fixture_id, {B('event')} AS event, home_team_id, away_team_id FROM b_fixtures
WHERE event = (SELECT max(event) FROM b_fixtures)""", "b_fixtures"))(lambda spark, d: conform(
    newest_partition(spark, _partitioned(spark, d), "event").select("fixture_id", "event", "home_team_id", "away_team_id")))


def _pruned_spark(spark, d):
    table = spark.read.parquet(_partitioned(spark, d))
    late = b.gameweeks(spark, d).where(~F.col("finished") & (F.col("event_id") <= GAMEWEEK + 1))
    return conform(rows_of_periods(table, late, "event", "event_id").select("fixture_id", "event", "finished"))


query("stored_period_scan", sql=with_bindings(f"""
SELECT fixture_id, {B('event')} AS event, finished FROM b_fixtures
WHERE event IN (SELECT event_id FROM b_gameweeks WHERE NOT finished AND event_id <= {GAMEWEEK + 1})""",
    "b_fixtures", "b_gameweeks"))(_pruned_spark)


# ----------------------------------------------------------------------------- H13
def _variant_spark(spark, d):
    li = b.read(spark, d, "lineitem")
    key, sup = F.col("l_orderkey").cast("string"), F.col("l_suppkey").cast("string")
    obj = F.concat(F.lit('{"fixture": {"id": '), key, F.lit(', "opponent": "T'), sup, F.lit('", "odds": ['),
                   F.floor("l_quantity").cast("string"), F.lit(".5, null]}}"))
    text = (F.when(F.col("l_linenumber") % 4 == 0, F.concat(F.lit('{"fixture": '), key, F.lit("}")))
            .when(F.col("l_linenumber") % 4 == 1, obj)
            .when(F.col("l_linenumber") % 4 == 2, F.concat(F.lit('[{"id": '), key, F.lit(', "opponent": "T'), sup, F.lit('"}]')))
            .otherwise(F.concat(F.lit("not json "), key)))
    docs = li.select("l_orderkey", F.col("l_linenumber").cast("long").alias("l_linenumber"), text.alias("stats"))
    out = json_paths(docs, "stats", {
        "fixture_id": [("$.fixture.id", "bigint"), ("$.fixture", "bigint"), ("$[0].id", "bigint")],
        "opponent": [("$.fixture.opponent", "string"), ("$[0].opponent", "string")],
        "first_odds": ("$.fixture.odds[0]", "double")})
    return conform(out.select("l_orderkey", "l_linenumber", F.col("fixture_id").cast("double").alias("fixture_id"), "opponent",
                              "first_odds", json_kind("stats").alias("kind")))


query("json_variant_paths", sql=f"""
SELECT l_orderkey, {B('l_linenumber')} AS l_linenumber, {D("CASE WHEN l_linenumber % 4 <> 3 THEN l_orderkey END")} AS fixture_id,
  CASE WHEN l_linenumber % 4 IN (1, 2) THEN 'T' || l_suppkey END AS opponent,
  {R("CASE WHEN l_linenumber % 4 = 1 THEN floor(l_quantity) + 0.5 END")} AS first_odds,
  CASE WHEN l_linenumber % 4 IN (0, 1) THEN 'OBJECT' WHEN l_linenumber % 4 = 2 THEN 'ARRAY' END AS kind
FROM lineitem""")(_variant_spark)


# ----------------------------------------------------------------------------- D7 / M2 / L10
query("freshness_overall", sql=f"""
WITH s AS (SELECT 'events' AS t, ts FROM events UNION ALL SELECT 'orders', o_orderdate FROM orders
  UNION ALL SELECT 'lineitem', l_shipdate FROM lineitem),
g AS (SELECT t, min(ts) AS oldest, max(ts) AS newest, count(ts) AS n FROM s GROUP BY t
  UNION ALL SELECT 'ALL', min(ts), max(ts), count(ts) FROM s),
a AS (SELECT *, round((epoch_us(TIMESTAMP '2026-01-01 00:00:00') - epoch_us(newest)) / 3.6e9, 2) AS age FROM g)
SELECT t AS "table", CAST(oldest AS TIMESTAMP) AS oldest, CAST(newest AS TIMESTAMP) AS newest, {B('n')} AS stamped,
  {R('age')} AS age_hours, CASE WHEN age <= 1 THEN 'very_fresh' WHEN age <= 6 THEN 'fresh' WHEN age <= 24 THEN 'stale'
  ELSE 'very_stale' END AS status
FROM a""")(lambda spark, d: conform(q.freshness_overall({
    "events": (b.read(spark, d, "events"), "ts"), "orders": (b.read(spark, d, "orders"), "o_orderdate"),
    "lineitem": (b.read(spark, d, "lineitem"), "l_shipdate")}, "2026-01-01 00:00:00")))


# ----------------------------------------------------------------------------- A12 / A15: files of three layouts
def _seasons_spark(spark, d):
    root = scratch(spark, "seasons")
    o = b.read(spark, d, "orders").withColumn("y", F.year("o_orderdate"))
    gw = F.month("o_orderdate").cast("string")
    points = F.when(F.col("o_orderkey") % 50 == 0, F.lit("n/a")).otherwise(F.floor(F.col("o_totalprice") / 1000).cast("string"))
    base = {"name": F.concat(F.lit("Player "), F.col("o_custkey").cast("string")), "element": (F.col("o_custkey") + 1).cast("string"),
            "fixture": F.col("o_orderkey").cast("string"), "total_points": points}
    # three seasons: the first says round, the second orders its columns otherwise and has more, the third lacks the fixture
    shapes = [("1995-96", 1995, {**base, "round": gw}),
              ("1996-97", 1996, {"GW": gw, "xP": F.lit("1.5"), **base, "expected_goals": (F.col("o_custkey") % 4 / 4.0).cast("string")}),
              ("1997-98", 1997, {**{k: v for k, v in base.items() if k != "fixture"}, "GW": gw, "position": F.lit("MID")})]
    for season, year, columns in shapes:
        (o.where(F.col("y") == year).select(*[c.alias(n) for n, c in columns.items()])
         .write.option("header", True).csv(f"{root}/{season}/gws"))
    rows = landing.read_merged_gameweeks(spark, root)
    why = F.array_join(F.transform(REJECTS, lambda r: F.concat_ws(":", r["column"], r["check"], r["value"])), ",")
    return conform(rows.select("season", "name", "element", F.col("fixture").cast("double").alias("fixture"), "GW",
                               F.col("total_points").cast("double").alias("total_points"), "expected_goals", "position",
                               why.alias("rejects")))


query("season_files", sql=f"""
SELECT CAST(year(o_orderdate) AS VARCHAR) || '-' || substr(CAST(year(o_orderdate) + 1 AS VARCHAR), 3, 2) AS season,
  'Player ' || o_custkey AS name, o_custkey + 1 AS element,
  {D("CASE WHEN year(o_orderdate) < 1997 THEN o_orderkey END")} AS fixture, {B('month(o_orderdate)')} AS "GW",
  {D("CASE WHEN o_orderkey % 50 <> 0 THEN floor(o_totalprice / 1000) END")} AS total_points,
  {R("CASE WHEN year(o_orderdate) = 1996 THEN o_custkey % 4 / 4.0 END")} AS expected_goals,
  CASE WHEN year(o_orderdate) = 1997 THEN 'MID' END AS position,
  CASE WHEN o_orderkey % 50 = 0 THEN 'total_points:coerce:bigint:n/a' ELSE '' END AS rejects
FROM orders WHERE year(o_orderdate) BETWEEN 1995 AND 1997""")(_seasons_spark)


# ----------------------------------------------------------------------------- L1: landed files, one violation per kind of rule
def _landed_spark(spark, d):
    p = b.players(spark, d)
    k = F.col("player_id")
    rows = p.select(
        F.when(k % 41 == 0, F.lit("none")).otherwise(k.cast("string")).alias("player_id"),
        F.when(k % 43 != 0, (k % 50 + 1).cast("string")).alias("gameweek"),
        F.when(k % 37 == 0, F.lit("x")).otherwise(F.col("status")).alias("status"),
        F.col("chance_of_playing_next_round"), F.lit("").alias("news"), (F.col("now_cost") * 2).alias("now_cost"),
        F.lit(False).alias("is_backfilled"), F.lit("1998-06-15 00:00:00").alias("snapshot_date"),
        F.lit("1998-06-15 00:00:00").alias("as_of_utc"))
    path, out = scratch(spark, "snapshots"), scratch(spark, "landed")
    rows.write.json(path)
    counts = landing.write_landed(landing.read_landed(spark, path, declared.SNAPSHOTS), out)
    bad = landing.read_written(spark, out, good=False).select(F.explode(REJECTS).alias("r"))
    kinds = bad.groupBy(F.col("r.column").alias("column"), F.col("r.check").alias("check")).agg(F.count(F.lit(1)).alias("rows"))
    told = spark.createDataFrame([("*", c, counts[c]) for c in ("rows", "good", "rejected")], "column string, check string, rows long")
    return conform(kinds.unionByName(told))


query("landed_rejects", sql=with_bindings(f"""
, t AS (SELECT player_id AS k, (player_id % 41 = 0) AS a, (player_id % 43 = 0) AS n, (player_id % 50 + 1 > 38 AND player_id % 43 <> 0) AS r,
  (player_id % 37 = 0) AS v, (player_id > 800 AND player_id % 41 <> 0) AS m, (now_cost * 2 > 200) AS c FROM b_players)
SELECT 'player_id' AS "column", 'coerce:bigint' AS "check", {B('count(*)')} AS "rows" FROM t WHERE a HAVING count(*) > 0
UNION ALL SELECT 'player_id', 'range[1,800]', {B('count(*)')} FROM t WHERE m HAVING count(*) > 0
UNION ALL SELECT 'gameweek', 'not_null', {B('count(*)')} FROM t WHERE n HAVING count(*) > 0
UNION ALL SELECT 'gameweek', 'range[1,38]', {B('count(*)')} FROM t WHERE r HAVING count(*) > 0
UNION ALL SELECT 'status', 'isin', {B('count(*)')} FROM t WHERE v HAVING count(*) > 0
UNION ALL SELECT 'now_cost', 'range[35,200]', {B('count(*)')} FROM t WHERE c HAVING count(*) > 0
UNION ALL SELECT '*', 'rows', {B('count(*)')} FROM t
UNION ALL SELECT '*', 'good', {B('count(*)')} FROM t WHERE NOT (a OR n OR r OR v OR m OR c)
UNION ALL SELECT '*', 'rejected', {B('count(*)')} FROM t WHERE a OR n OR r OR v OR m OR c""", "b_players").replace(
    "\n, t AS", ", t AS", 1))(_landed_spark)


# ----------------------------------------------------------------------------- A12 / C4 / C5 / G1 to I7: odds files to features
# Spellings of the first fifteen teams in the files.
_CLUBS = {f"Club {i}": f"Supplier#{i:09d}" for i in range(15)}


def _provider_rows(spark, d) -> DataFrame:
    def club(k):
        return (F.when(F.col(k) < 15, F.concat(F.lit("Club "), F.col(k).cast("string")))
                .when(F.col(k) % 10 == 9, F.concat(F.lit("Unknown "), F.col(k).cast("string")))
                .otherwise(F.format_string("Supplier#%09d", F.col(k))))
    o = b.odds(spark, d)
    price = [c for c in o.columns if c not in ("fixture_id", "match_date", "home_team_id", "away_team_id", "referee")]
    date = F.when(F.col("fixture_id") % 29 == 0, F.lit("TBD")).otherwise(F.date_format("match_date", "dd/MM/yyyy"))
    # an earlier edition of a fifth of the rows, with other prices: both editions come from one pass over the rows
    editions = F.explode(F.when(F.col("home_team_id") % 5 == 0, F.array(F.lit(2), F.lit(1))).otherwise(F.array(F.lit(2))))
    rows = o.select(date.alias("Date"), club("home_team_id").alias("HomeTeam"), club("away_team_id").alias("AwayTeam"),
                    F.col("referee").alias("Referee"), *[F.col(c).cast("string").alias(c) for c in price], editions.alias("seen"))
    return rows.withColumn("B365H", F.when(F.col("seen") == 1, F.lit("9.0")).otherwise(F.col("B365H")))


def _odds_to_features(spark, d):
    fixtures = b.fixtures(spark, d)
    matched = ingest.match_odds(_provider_rows(spark, d), fixtures, b.teams(spark, d), AS_OF, order=["seen"], maps=[_CLUBS])
    stored = ingest.newest_per_fixture(matched, ["seen"]).drop("seen")
    return conform(feat.betting_features(stored, fixtures, b.players(spark, d), AS_OF))


_INGESTED_SQL = """SELECT o.* FROM b_odds_all o JOIN (
  SELECT CAST(kickoff_utc AS DATE) AS day, home_team_id AS h, away_team_id AS a FROM b_fixtures GROUP BY ALL HAVING count(*) = 1) f
  ON CAST(o.match_date AS DATE) = f.day AND o.home_team_id = f.h AND o.away_team_id = f.a
WHERE o.fixture_id % 29 <> 0 AND NOT (o.home_team_id >= 15 AND o.home_team_id % 10 = 9)
  AND NOT (o.away_team_id >= 15 AND o.away_team_id % 10 = 9)"""


def _ingested_sql() -> str:
    sql = _betting_sql()
    own = "b_odds AS (\n" + b.SQL["b_odds"] + "\n)"
    late = "b_fixtures AS (\n" + b.SQL["b_fixtures"] + "\n)"
    return sql.replace(late + ",\n", "").replace(own, f"b_odds_all AS (\n{b.SQL['b_odds']}\n),\n{late},\nb_odds AS (\n{_INGESTED_SQL}\n)")


query("odds_files_to_features", sql=_ingested_sql())(_odds_to_features)


def _refused_spark(spark, d):
    path = scratch(spark, "odds")
    counts = ingest.ingest_odds(_provider_rows(spark, d), b.fixtures(spark, d), b.teams(spark, d), AS_OF, path, order=["seen"], maps=[_CLUBS])
    told = [(k, v) for k, v in counts.items()] + [("stored", sinks.read_upserted(spark, path).count())]
    return conform(spark.createDataFrame(told, "what string, n long"))


query("odds_ingest_counts", sql=with_bindings("""
, f AS (SELECT CAST(kickoff_utc AS DATE) AS day, home_team_id AS h, away_team_id AS a, count(*) AS n, min(fixture_id) AS fixture
        FROM b_fixtures GROUP BY ALL),
r AS (SELECT o.fixture_id, CAST(match_date AS DATE) AS day, home_team_id AS h, away_team_id AS a, o.fixture_id % 29 = 0 AS tbd,
  home_team_id >= 15 AND home_team_id % 10 = 9 AS uh, away_team_id >= 15 AND away_team_id % 10 = 9 AS ua,
  CASE WHEN home_team_id % 5 = 0 THEN 2 ELSE 1 END AS editions FROM b_odds o),
j AS (SELECT r.editions, f.fixture, CASE WHEN tbd THEN 'date' WHEN uh THEN 'home team' WHEN ua THEN 'away team'
        WHEN f.n > 1 THEN 'several fixtures' ELSE 'matched' END AS what
      FROM r LEFT JOIN f ON r.day = f.day AND r.h = f.h AND r.a = f.a),
names AS (SELECT unnest(['matched', 'date', 'home team', 'away team', 'no fixture', 'several fixtures']) AS what)
SELECT n.what, CAST(coalesce(sum(j.editions), 0) AS BIGINT) AS n FROM names n LEFT JOIN j USING (what) GROUP BY n.what
UNION ALL SELECT 'rows', CAST(sum(editions) AS BIGINT) FROM j
UNION ALL SELECT 'stored', count(DISTINCT fixture) FROM j WHERE what = 'matched'""", "b_odds", "b_fixtures").replace(
    "\n, f AS", ", f AS", 1))(_refused_spark)


# ----------------------------------------------------------------------------- A2-A7 / A6 / J1
def _sections_docs(spark, d) -> DataFrame:
    """One bootstrap document per supplier: its team, and a gameweek, a position, a chip, a phase and a statistic after its key."""
    k = F.col("s_suppkey")
    return b.read(spark, d, "supplier").select(
        F.array(F.struct(k.alias("id"), F.col("s_name").alias("name"), F.concat(F.lit("T"), (k % 90 + 10).cast("string")).alias("short_name"),
                         F.when(k % 3 == 0, F.lit(None).cast("int")).otherwise((k % 5 + 1).cast("int")).alias("strength"))).alias("teams"),
        F.array(F.struct(k.alias("id"), F.concat(F.lit("Gameweek "), k.cast("string")).alias("name"),
                         F.when(k % 2 == 0, F.array(F.struct(F.lit("bboost").alias("chip_name"), k.alias("num_played")))).alias("chip_plays"),
                         F.lit("1998-08-14T17:30:00Z").alias("deadline_time"))).alias("events"),
        F.array(F.struct(k.alias("id"), F.concat(F.lit("Position "), k.cast("string")).alias("plural_name"))).alias("element_types"),
        F.array(F.struct(k.alias("id"), F.lit("wildcard").alias("name"), F.when(k % 2 == 1, F.struct(k.alias("rules"))).alias("overrides"))).alias("chips"),
        F.array(F.struct(k.alias("id"), F.lit("Overall").alias("name"))).alias("phases"),
        F.array(F.struct(F.concat(F.lit("stat_"), k.cast("string")).alias("name"), F.lit("Stat").alias("label"))).alias("element_stats"),
        F.struct(k.alias("squad_squadsize"), F.lit("UTC").alias("timezone")).alias("game_settings"))


def _sections_spark(spark, d):
    root = scratch(spark, "raw")
    sections = {n: s for n, s in flatten.BOOTSTRAP_SECTIONS.items()}  # the documents hold no players: that section fails alone
    status = refresh.refresh_raw(_sections_docs(spark, d), root, AS_OF, sections)
    parts = []
    for name, id_col, text in (("raw_teams_bootstrap", "team_id", F.concat_ws("|", "name", "short_name", F.col("strength").cast("string"))),
                               ("raw_events_bootstrap", "event_id", F.concat_ws("|", "name", "chip_plays", F.date_format("deadline_time", "yyyy-MM-dd HH:mm"))),
                               ("raw_element_types", "position_id", F.col("plural_name")),
                               ("raw_chips", "chip_id", F.concat_ws("|", "name", "overrides")), ("raw_phases", "phase_id", F.col("name")),
                               ("raw_element_stats", None, F.concat_ws("|", "name", "label"))):
        df = spark.read.parquet(f"{root}/{name}")
        parts.append(df.select(F.lit(name).alias("section"), (F.col(id_col) if id_col else F.lit(0)).cast("long").alias("id"), text.alias("content")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    told = spark.createDataFrame([(n, 0, s.split(":")[0]) for n, s in status.items()], "section string, id long, content string")
    return conform(out.unionByName(told))


query("bootstrap_sections", sql="""
WITH s AS (SELECT s_suppkey AS k, s_name FROM supplier)
SELECT 'raw_teams_bootstrap' AS section, k AS id, s_name || '|T' || (k % 90 + 10) || '|' || (CASE WHEN k % 3 = 0 THEN 0 ELSE k % 5 + 1 END) AS content FROM s
UNION ALL SELECT 'raw_events_bootstrap', k, 'Gameweek ' || k || '|' || CASE WHEN k % 2 = 0 THEN '[{"chip_name":"bboost","num_played":' || k || '}]' ELSE '[]' END
  || '|1998-08-14 17:30' FROM s
UNION ALL SELECT 'raw_element_types', k, 'Position ' || k FROM s
UNION ALL SELECT 'raw_chips', k, 'wildcard|' || CASE WHEN k % 2 = 1 THEN '{"rules":' || k || '}' ELSE '{}' END FROM s
UNION ALL SELECT 'raw_phases', k, 'Overall' FROM s
UNION ALL SELECT 'raw_element_stats', CAST(0 AS BIGINT), 'stat_' || k || '|Stat' FROM s
UNION ALL SELECT unnest(['raw_teams_bootstrap', 'raw_events_bootstrap', 'raw_element_types', 'raw_chips', 'raw_phases', 'raw_element_stats']),
  CAST(0 AS BIGINT), 'saved'
UNION ALL SELECT 'raw_players_bootstrap', CAST(0 AS BIGINT), 'failed'""")(_sections_spark)


# ----------------------------------------------------------------------------- J7: the derived tables of a gameweek
def _refresh_spark(spark, d):
    root = scratch(spark, "derived")
    inputs = {"players": b.players(spark, d), "teams": b.teams(spark, d), "fixtures": b.fixtures(spark, d),
              "history": b.history(spark, d), "odds": b.odds(spark, d)}
    status = refresh.refresh_derived(inputs, root, GAMEWEEK, AS_OF)
    parts = [refresh.stored(spark, root, t).agg(F.count(F.lit(1)).alias("rows")).select(
        F.lit(t).alias("table"), F.lit(s).alias("status"), "rows") for t, s in status.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return conform(out)


query("refresh_derived", sql=with_bindings(f"""
SELECT 'player_metrics' AS "table", 'saved' AS status, {B('count(*)')} AS "rows" FROM b_players
UNION ALL SELECT 'value_analysis', 'saved', {B('count(*)')} FROM b_players
UNION ALL SELECT 'ownership_trends', 'saved', {B('count(*)')} FROM b_players
UNION ALL SELECT 'fixture_runs', 'saved', {B('count(*)')} FROM b_players
UNION ALL SELECT 'team_form', 'saved', {B('count(*)')} FROM b_teams
UNION ALL SELECT 'fixture_difficulty', 'saved', {B('2 * count(*)')} FROM b_fixtures
UNION ALL SELECT 'betting_features', 'saved', {B('count(*)')} FROM (
  SELECT home_team_id AS t FROM b_fixtures UNION ALL SELECT away_team_id FROM b_fixtures) f JOIN b_players p ON f.t = p.team_id""",
    "b_players", "b_teams", "b_fixtures"))(_refresh_spark)


# ----------------------------------------------------------------------------- A7 / A10
def _picks_spark(spark, d):
    li = b.read(spark, d, "lineitem")
    pick = F.struct(F.col("l_partkey").alias("element"), F.col("l_linenumber").alias("position"),
                    (F.col("l_linenumber") == 1).alias("is_captain"), F.floor("l_quantity").cast("int").alias("multiplier"))
    docs = (li.groupBy("l_orderkey").agg(F.sort_array(F.collect_list(pick)).alias("picks"), F.sum("l_quantity").alias("s"))
            .select(F.struct(F.when(F.col("l_orderkey") % 5 == 0, F.lit("wildcard")).alias("active_chip"), "picks",
                             F.struct(F.col("l_orderkey").alias("entry"), F.col("s").cast("long").alias("points"),
                                      F.lit(GAMEWEEK).alias("event")).alias("entry_history")).alias("doc")))
    picks = flatten.flatten_picks(docs, GAMEWEEK).groupBy("event", "player_id", "chip_used").agg(
        F.count(F.lit(1)).alias("n"), F.sum("multiplier").alias("total")).select(
        F.lit("picks").alias("table"), F.col("player_id").alias("id"), "event", F.coalesce("chip_used", F.lit("")).alias("chip"), "n", "total")
    summary = flatten.flatten_summary(docs).select(F.lit("summary").alias("table"), F.col("manager_id").alias("id"), "event",
                                                   F.lit("").alias("chip"), F.lit(1).cast("long").alias("n"), F.col("points").alias("total"))
    return conform(picks.unionByName(summary))


query("manager_documents", sql=f"""
SELECT 'picks' AS "table", l_partkey AS id, {B(str(GAMEWEEK))} AS event, CASE WHEN l_orderkey % 5 = 0 THEN 'wildcard' ELSE '' END AS chip,
  {B('count(*)')} AS n, {B('sum(floor(l_quantity))')} AS total
FROM lineitem GROUP BY l_partkey, CASE WHEN l_orderkey % 5 = 0 THEN 'wildcard' ELSE '' END
UNION ALL SELECT 'summary', l_orderkey, {B(str(GAMEWEEK))}, '', CAST(1 AS BIGINT), {B('floor(sum(l_quantity))')} FROM lineitem GROUP BY l_orderkey""")(_picks_spark)


def _fixtures_doc_spark(spark, d):
    k = F.col("fixture_id")
    docs = b.fixtures(spark, d).select(F.array(F.struct(
        k.alias("id"), F.col("event"), F.when(k % 7 == 0, F.lit("unknown")).otherwise(F.date_format("kickoff_utc", "yyyy-MM-dd'T'HH:mm:ss'Z'")).alias("kickoff_time"),
        F.col("home_team_id").alias("team_h"), F.col("away_team_id").alias("team_a"),
        F.when(F.col("finished"), F.array(F.struct(F.lit("goals").alias("identifier"), F.col("team_h_score").alias("h")))).alias("stats"))).alias("fixtures"))
    return conform(flatten.flatten_fixtures(docs, "fixtures", AS_OF))


query("fixtures_document", sql=with_bindings(f"""
SELECT fixture_id, {B('event')} AS event, CASE WHEN fixture_id % 7 <> 0 THEN CAST(kickoff_utc AS TIMESTAMP) END AS kickoff_utc, home_team_id, away_team_id,
  CASE WHEN finished THEN '[{{"identifier":"goals","h":' || team_h_score || '}}]' ELSE '[]' END AS stats, {AS_OF_SQL} AS as_of_utc
FROM b_fixtures""", "b_fixtures"))(_fixtures_doc_spark)


# ----------------------------------------------------------------------------- L14: needs the report rows of the other modules
from .q_ops import _fk_spark  # noqa: E402,F401  (registers dq_referential)
from .q_quality import _full_report_spark, _full_report_sql  # noqa: E402

query("dq_full_report", sql=_full_report_sql())(_full_report_spark)


# ----------------------------------------------------------------------------- J1 / F1
def _replaced_spark(spark, d):
    path = scratch(spark, "orders")
    o = b.read(spark, d, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    sinks.replace_all(o, path)
    # the table is read by its own replacement
    sinks.replace_all(spark.read.parquet(path).where(F.col("o_orderstatus") != "F").withColumn("o_totalprice", F.col("o_totalprice") * 2), path)
    return conform(spark.read.parquet(path))


query("replace_whole_table", sql=f"""
SELECT o_orderkey, o_orderstatus, {R('o_totalprice * 2')} AS o_totalprice FROM orders WHERE o_orderstatus <> 'F'""")(_replaced_spark)


def _history_spark(spark, d):
    from ..operators.filters import in_range
    rows = in_range(b.players_by_period(spark, d).select("player_id", "gameweek", "minutes"), "gameweek", 10, None, ["gameweek", "player_id"])
    # each row with its place in the sorted history: what a reader of the sorted rows sees
    return conform(rows.select("*", (F.col("gameweek") * 1000000 + F.col("player_id")).alias("place")))


query("sorted_history", sql=with_bindings(f"""
SELECT player_id, {B('gameweek')} AS gameweek, {B('minutes')} AS minutes, CAST(gameweek AS BIGINT) * 1000000 + player_id AS place
FROM b_players_gw WHERE gameweek >= 10 ORDER BY gameweek, player_id""", "b_players_gw"))(_history_spark)
