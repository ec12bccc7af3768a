"""Bindings of the driver's TPC-H-like tables to the domain inputs.

Each pseudo-table is derived from whole base tables, so its size grows with
the data; the same derivation is given as a SQL CTE (``SQL[name]``) for the
DuckDB oracle. Mapping:

* players  <- part LEFT JOIN lineitem aggregated by part; a player's team is
  the supplier of the part's earliest order line (data-derived, so players
  per team stay constant as the data grows).
* teams    <- supplier (team strengths by an integer rule on the key).
* fixtures <- orders JOIN lineitem aggregated by order: home = supplier of
  the first line, away = supplier of the last line (orders where they are the
  same are not fixtures); gameweek = month index since 1995-01; finished =
  status F.
* odds     <- the same per-order aggregate: bookmaker prices >= 1 derived
  from quantity / discount / tax; order priority knocks out closing,
  over/under and handicap columns so every fallback chain is exercised.
* history  <- (user, day) pairs of events: parts that are no user are new players.
* gameweeks<- months of orders with flags relative to ``AS_OF``.
"""

from __future__ import annotations

import datetime as _dt
from functools import partial
from types import SimpleNamespace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed parameters of the bindings.
AS_OF = _dt.datetime(1998, 6, 15)
AS_OF_SQL = "TIMESTAMP '1998-06-15 00:00:00'"
BASE_YEAR = 1995
GAMEWEEK = (AS_OF.year - BASE_YEAR) * 12 + AS_OF.month  # 42


def read(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def month_index(c) -> F.Column:
    return ((F.year(c) - BASE_YEAR) * 12 + F.month(c)).cast("int")


# --------------------------------------------------------------------------- players
def _line_stats(li: DataFrame, *keys) -> DataFrame:
    return li.groupBy("l_partkey", *keys).agg(
        F.sum("l_quantity").alias("qty"), F.count(F.lit(1)).alias("n_lines"),
        F.sum(F.when(F.col("l_returnflag") == "A", 1).otherwise(0)).alias("n_a"),
        F.sum(F.when(F.col("l_returnflag") == "R", 1).otherwise(0)).alias("n_r"),
        # the supplier of the part's earliest order line (uniform over suppliers)
        F.min(F.struct("l_orderkey", "l_linenumber", "l_suppkey"))["l_suppkey"].alias("team"))


def _player_cols() -> list:
    c = F.col
    return [
        c("p_partkey").alias("player_id"),
        c("p_name").alias("web_name"),
        F.split(c("p_name"), " ").getItem(0).alias("first_name"),
        F.split(c("p_name"), " ").getItem(1).alias("second_name"),
        c("team").alias("team_id"),
        (c("p_size") % 5 + 1).cast("int").alias("position_id"),
        (F.floor("p_retailprice") % 166 + 35).cast("int").alias("now_cost"),
        (F.floor(F.coalesce(c("qty"), F.lit(0.0))) % 300 - 20).cast("int").alias("total_points"),
        F.when(c("p_size") % 13 == 0, F.lit(None).cast("string"))
        .when(c("p_size") % 17 == 0, F.lit("n/a"))
        .otherwise(F.concat((c("p_partkey") % 10).cast("string"), F.lit("."), (c("p_size") % 10).cast("string")))
        .alias("form"),
        (c("n_lines") * 30).cast("int").alias("minutes"),
        F.concat(c("p_size").cast("string"), F.lit("."), (c("p_partkey") % 10).cast("string")).alias("selected_by_percent"),
        (c("n_a") * 700).cast("int").alias("transfers_in_event"),
        (c("n_r") * 700).cast("int").alias("transfers_out_event"),
        F.when(c("p_size") % 7 == 0, 1).when(c("p_size") % 7 == 1, 2).cast("int").alias("penalties_order"),
        F.when(c("p_size") % 3 == 0, 1).otherwise(2).cast("int").alias("corners_and_indirect_freekicks_order"),
        F.when(c("p_partkey") % 4 == 0, 1).cast("int").alias("direct_freekicks_order"),
        F.when(c("p_size") % 4 == 0, F.lit(None).cast("double"))
        .otherwise((c("p_size") % 4) * 25.0).alias("chance_of_playing_next_round"),
        F.element_at(F.array(*[F.lit(s) for s in "aisudn"]), (c("p_size") % 6 + 1).cast("int")).alias("status"),
    ]


def players(spark: SparkSession, d: str) -> DataFrame:
    part = read(spark, d, "part")
    agg = _line_stats(read(spark, d, "lineitem"))
    return part.join(agg, part.p_partkey == agg.l_partkey, "left").select(*_player_cols())


def players_by_period(spark: SparkSession, d: str) -> DataFrame:
    """One player row per (part, ship month) with that month's line stats:
    the input of a many-gameweek recomputation (K5)."""
    part = read(spark, d, "part")
    li = read(spark, d, "lineitem").withColumn("gameweek", month_index(F.col("l_shipdate")))
    agg = _line_stats(li, "gameweek")
    return part.join(agg, part.p_partkey == agg.l_partkey, "inner").select(*_player_cols(), "gameweek")


# --------------------------------------------------------------------------- teams
def teams(spark: SparkSession, d: str) -> DataFrame:
    s = read(spark, d, "supplier")
    k = F.col("s_suppkey")

    def strength(shift: int):
        return (F.lit(1000) + F.lit(16) * ((k + shift) % 25)).cast("int")

    return s.select(
        k.alias("team_id"), F.col("s_name").alias("name"),
        F.concat(F.lit("T"), (k % 1000).cast("string")).alias("short_name"),
        strength(0).alias("strength_overall_home"), strength(13).alias("strength_overall_away"),
        strength(5).alias("strength_attack_home"), strength(7).alias("strength_attack_away"),
        strength(3).alias("strength_defence_home"), strength(11).alias("strength_defence_away"),
    )


# --------------------------------------------------------------------------- per-order aggregate
def order_lines(spark: SparkSession, d: str) -> DataFrame:
    li = read(spark, d, "lineitem")
    return li.groupBy("l_orderkey").agg(
        # suppliers of the order's first and last line
        F.min(F.struct("l_linenumber", "l_suppkey"))["l_suppkey"].alias("home"),
        F.max(F.struct("l_linenumber", "l_suppkey"))["l_suppkey"].alias("away"),
        F.min("l_quantity").alias("qmin"), F.max("l_quantity").alias("qmax"),
        F.min("l_discount").alias("dmin"), F.max("l_discount").alias("dmax"),
        F.max("l_tax").alias("tmax"), F.count(F.lit(1)).alias("n"), F.sum("l_quantity").alias("qsum"))


def _orders_with_lines(spark, d):
    o = read(spark, d, "orders")
    return o.join(order_lines(spark, d), o.o_orderkey == F.col("l_orderkey"), "inner") \
        .where(F.col("home") != F.col("away"))


def fixtures(spark: SparkSession, d: str) -> DataFrame:
    c = F.col
    fin = c("o_orderstatus") == "F"
    return _orders_with_lines(spark, d).select(
        c("o_orderkey").alias("fixture_id"),
        month_index(c("o_orderdate")).alias("event"),
        c("o_orderdate").alias("kickoff_utc"),
        c("home").alias("home_team_id"), c("away").alias("away_team_id"),
        fin.alias("finished"),
        F.when(fin, F.floor("qmin") % 4).cast("int").alias("team_h_score"),
        F.when(fin, F.floor("qmax") % 3).cast("int").alias("team_a_score"),
    )


def odds(spark: SparkSession, d: str) -> DataFrame:
    c = F.col
    pr, st = c("o_orderpriority"), c("o_orderstatus")
    qmax, qmin, dmax, dmin, tmax = c("qmax"), c("qmin"), c("dmax"), c("dmin"), c("tmax")
    no_avg_close = pr.isin("5-LOW", "4-NOT SPECIFIED")
    no_b365_close = pr == "5-LOW"

    def unless(cond, val):
        return F.when(~cond, val)

    return _orders_with_lines(spark, d).select(
        c("o_orderkey").alias("fixture_id"), c("o_orderdate").alias("match_date"),
        c("home").alias("home_team_id"), c("away").alias("away_team_id"),
        F.when(c("o_custkey") % 37 == 0, F.lit("")).otherwise(
            F.concat(F.lit("Ref "), (c("o_custkey") % 37).cast("string"))).alias("referee"),
        (1.0 + qmax / 20.0).alias("B365H"), (2.5 + dmax * 10.0).alias("B365D"), (1.0 + qmin / 10.0).alias("B365A"),
        (1.0 + (qmax + 1.0) / 20.0).alias("PSH"), (2.6 + dmin * 10.0).alias("PSD"),
        (1.0 + (qmin + 1.0) / 10.0).alias("PSA"),
        (1.0 + (qmax + 2.0) / 20.0).alias("MaxH"), (2.7 + dmax * 10.0).alias("MaxD"),
        (1.0 + (qmin + 2.0) / 10.0).alias("MaxA"),
        (1.0 + (qmax + 0.5) / 20.0).alias("AvgH"),
        unless((pr == "5-LOW") & (st == "P"), 2.55 + dmax * 10.0).alias("AvgD"),
        (1.0 + (qmin + 0.5) / 10.0).alias("AvgA"),
        unless(no_avg_close, 1.0 + (qmax + tmax * 10.0) / 20.0).alias("AvgCH"),
        unless(no_avg_close, 2.5 + tmax * 10.0).alias("AvgCD"),
        unless(no_avg_close, 1.0 + (qmin + tmax * 10.0) / 10.0).alias("AvgCA"),
        unless(no_b365_close, 1.0 + (qmax + 1.5) / 20.0).alias("B365CH"),
        unless(no_b365_close, 2.45 + dmax * 10.0).alias("B365CD"),
        unless(no_b365_close, 1.0 + (qmin + 1.5) / 10.0).alias("B365CA"),
        unless(pr == "3-MEDIUM", 1.0 + c("qsum") / (c("n") * 25.0)).alias("Avg_over_2_5"),
        unless(pr == "3-MEDIUM", 1.0 + 25.0 / (qmax + 1.0)).alias("Avg_under_2_5"),
        unless((pr == "3-MEDIUM") & (st == "P"), 1.2 + tmax * 10.0).alias("B365_over_2_5"),
        (1.3 + dmax * 10.0).alias("B365_under_2_5"),
        unless((st == "O") & (pr == "1-URGENT"), (qmax - qmin) / 10.0 - 2.5).alias("AHh"),
        unless(pr == "2-HIGH", 1.8 + dmin * 5.0).alias("AvgAHH"), (2.1 - dmin * 5.0).alias("AvgAHA"),
        (1.85 + tmax).alias("B365AHH"), unless((pr == "2-HIGH") & (st == "F"), 2.0 - tmax).alias("B365AHA"),
    )


# --------------------------------------------------------------------------- history / gameweeks
def history(spark: SparkSession, d: str) -> DataFrame:
    ev = read(spark, d, "events")
    return ev.select(F.col("user_id").alias("player_id"), F.dayofmonth("ts").alias("gameweek")).distinct()


def gameweeks(spark: SparkSession, d: str) -> DataFrame:
    o = read(spark, d, "orders")
    ev = month_index(F.col("o_orderdate"))
    g = o.groupBy(ev.alias("event_id")).agg(F.min("o_orderdate").alias("deadline_time"),
                                            F.max("o_orderdate").alias("__last"))
    as_of = F.to_timestamp_ntz(F.lit(AS_OF.strftime("%Y-%m-%d %H:%M:%S")))
    return g.select("event_id", "deadline_time", (F.col("__last") < as_of).alias("finished"),
                    (F.col("event_id") == GAMEWEEK).alias("is_current"),
                    (F.col("event_id") == GAMEWEEK + 1).alias("is_next"))


# --------------------------------------------------------------------------- derived once
def stored(spark: SparkSession, d: str, root: str, *names: str) -> SimpleNamespace:
    """Bindings for a plan that reads them many times: the named ones are derived once and written whole
    below ``root`` (a folder that driver and executors share), the others are those of this module."""
    own = {n: globals()[n] for n in ("players", "players_by_period", "teams", "fixtures", "odds", "history", "gameweeks")}
    for n in names:
        own[n](spark, d).write.parquet(f"{root}/{n}")
        own[n] = partial(_read_stored, f"{root}/{n}")
    return SimpleNamespace(**own)


def _read_stored(path: str, spark: SparkSession, d: str) -> DataFrame:
    return spark.read.parquet(path)


# --------------------------------------------------------------------------- SQL twins
_ORDER_LINES = """SELECT l_orderkey, min({'n': l_linenumber, 's': l_suppkey}).s AS home,
  max({'n': l_linenumber, 's': l_suppkey}).s AS away,
  min(l_quantity) AS qmin, max(l_quantity) AS qmax, min(l_discount) AS dmin, max(l_discount) AS dmax,
  max(l_tax) AS tmax, count(*) AS n, sum(l_quantity) AS qsum FROM lineitem GROUP BY l_orderkey"""

_OWL = f"""(SELECT * FROM orders o JOIN ({_ORDER_LINES}) ol ON o.o_orderkey = ol.l_orderkey WHERE home <> away)"""

_MONTH = "CAST((year({c}) - 1995) * 12 + month({c}) AS INTEGER)"

SQL = {
    "b_players": """SELECT p.p_partkey AS player_id, p.p_name AS web_name,
  split_part(p.p_name, ' ', 1) AS first_name, split_part(p.p_name, ' ', 2) AS second_name,
  a.team AS team_id,
  CAST(p.p_size % 5 + 1 AS INTEGER) AS position_id,
  CAST(CAST(floor(p.p_retailprice) AS BIGINT) % 166 + 35 AS INTEGER) AS now_cost,
  CAST(CAST(floor(coalesce(a.qty, 0.0)) AS BIGINT) % 300 - 20 AS INTEGER) AS total_points,
  CASE WHEN p.p_size % 13 = 0 THEN NULL WHEN p.p_size % 17 = 0 THEN 'n/a'
       ELSE CAST(p.p_partkey % 10 AS VARCHAR) || '.' || CAST(p.p_size % 10 AS VARCHAR) END AS form,
  CAST(a.n_lines * 30 AS INTEGER) AS minutes,
  CAST(p.p_size AS VARCHAR) || '.' || CAST(p.p_partkey % 10 AS VARCHAR) AS selected_by_percent,
  CAST(a.n_a * 700 AS INTEGER) AS transfers_in_event,
  CAST(a.n_r * 700 AS INTEGER) AS transfers_out_event,
  CAST(CASE WHEN p.p_size % 7 = 0 THEN 1 WHEN p.p_size % 7 = 1 THEN 2 END AS INTEGER) AS penalties_order,
  CAST(CASE WHEN p.p_size % 3 = 0 THEN 1 ELSE 2 END AS INTEGER) AS corners_and_indirect_freekicks_order,
  CAST(CASE WHEN p.p_partkey % 4 = 0 THEN 1 END AS INTEGER) AS direct_freekicks_order,
  CASE WHEN p.p_size % 4 = 0 THEN NULL ELSE CAST((p.p_size % 4) * 25 AS DOUBLE) END AS chance_of_playing_next_round,
  (['a','i','s','u','d','n'])[CAST(p.p_size % 6 + 1 AS INTEGER)] AS status
FROM part p LEFT JOIN (SELECT l_partkey, sum(l_quantity) AS qty, count(*) AS n_lines,
  sum(CASE WHEN l_returnflag = 'A' THEN 1 ELSE 0 END) AS n_a,
  sum(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END) AS n_r,
  min({'o': l_orderkey, 'n': l_linenumber, 's': l_suppkey}).s AS team FROM lineitem GROUP BY l_partkey) a
  ON p.p_partkey = a.l_partkey""",
    "b_teams": """SELECT s_suppkey AS team_id, s_name AS name, 'T' || CAST(s_suppkey % 1000 AS VARCHAR) AS short_name,
  CAST(1000 + 16 * ((s_suppkey + 0) % 25) AS INTEGER) AS strength_overall_home,
  CAST(1000 + 16 * ((s_suppkey + 13) % 25) AS INTEGER) AS strength_overall_away,
  CAST(1000 + 16 * ((s_suppkey + 5) % 25) AS INTEGER) AS strength_attack_home,
  CAST(1000 + 16 * ((s_suppkey + 7) % 25) AS INTEGER) AS strength_attack_away,
  CAST(1000 + 16 * ((s_suppkey + 3) % 25) AS INTEGER) AS strength_defence_home,
  CAST(1000 + 16 * ((s_suppkey + 11) % 25) AS INTEGER) AS strength_defence_away
FROM supplier""",
    "b_fixtures": f"""SELECT o_orderkey AS fixture_id, {_MONTH.format(c='o_orderdate')} AS event,
  o_orderdate AS kickoff_utc, home AS home_team_id, away AS away_team_id,
  (o_orderstatus = 'F') AS finished,
  CASE WHEN o_orderstatus = 'F' THEN CAST(CAST(floor(qmin) AS BIGINT) % 4 AS INTEGER) END AS team_h_score,
  CASE WHEN o_orderstatus = 'F' THEN CAST(CAST(floor(qmax) AS BIGINT) % 3 AS INTEGER) END AS team_a_score
FROM {_OWL}""",
    "b_odds": f"""SELECT o_orderkey AS fixture_id, o_orderdate AS match_date, home AS home_team_id, away AS away_team_id,
  CASE WHEN o_custkey % 37 = 0 THEN '' ELSE 'Ref ' || CAST(o_custkey % 37 AS VARCHAR) END AS referee,
  1.0 + qmax / 20.0 AS B365H, 2.5 + dmax * 10.0 AS B365D, 1.0 + qmin / 10.0 AS B365A,
  1.0 + (qmax + 1.0) / 20.0 AS PSH, 2.6 + dmin * 10.0 AS PSD, 1.0 + (qmin + 1.0) / 10.0 AS PSA,
  1.0 + (qmax + 2.0) / 20.0 AS MaxH, 2.7 + dmax * 10.0 AS MaxD, 1.0 + (qmin + 2.0) / 10.0 AS MaxA,
  1.0 + (qmax + 0.5) / 20.0 AS AvgH,
  CASE WHEN NOT (o_orderpriority = '5-LOW' AND o_orderstatus = 'P') THEN 2.55 + dmax * 10.0 END AS AvgD,
  1.0 + (qmin + 0.5) / 10.0 AS AvgA,
  CASE WHEN o_orderpriority NOT IN ('5-LOW', '4-NOT SPECIFIED') THEN 1.0 + (qmax + tmax * 10.0) / 20.0 END AS AvgCH,
  CASE WHEN o_orderpriority NOT IN ('5-LOW', '4-NOT SPECIFIED') THEN 2.5 + tmax * 10.0 END AS AvgCD,
  CASE WHEN o_orderpriority NOT IN ('5-LOW', '4-NOT SPECIFIED') THEN 1.0 + (qmin + tmax * 10.0) / 10.0 END AS AvgCA,
  CASE WHEN o_orderpriority <> '5-LOW' THEN 1.0 + (qmax + 1.5) / 20.0 END AS B365CH,
  CASE WHEN o_orderpriority <> '5-LOW' THEN 2.45 + dmax * 10.0 END AS B365CD,
  CASE WHEN o_orderpriority <> '5-LOW' THEN 1.0 + (qmin + 1.5) / 10.0 END AS B365CA,
  CASE WHEN o_orderpriority <> '3-MEDIUM' THEN 1.0 + qsum / (n * 25.0) END AS Avg_over_2_5,
  CASE WHEN o_orderpriority <> '3-MEDIUM' THEN 1.0 + 25.0 / (qmax + 1.0) END AS Avg_under_2_5,
  CASE WHEN NOT (o_orderpriority = '3-MEDIUM' AND o_orderstatus = 'P') THEN 1.2 + tmax * 10.0 END AS B365_over_2_5,
  1.3 + dmax * 10.0 AS B365_under_2_5,
  CASE WHEN NOT (o_orderstatus = 'O' AND o_orderpriority = '1-URGENT') THEN (qmax - qmin) / 10.0 - 2.5 END AS AHh,
  CASE WHEN o_orderpriority <> '2-HIGH' THEN 1.8 + dmin * 5.0 END AS AvgAHH, 2.1 - dmin * 5.0 AS AvgAHA,
  1.85 + tmax AS B365AHH,
  CASE WHEN NOT (o_orderpriority = '2-HIGH' AND o_orderstatus = 'F') THEN 2.0 - tmax END AS B365AHA
FROM {_OWL}""",
    "b_history": f"""SELECT DISTINCT user_id AS player_id, CAST(day(ts) AS INTEGER) AS gameweek FROM events""",
    "b_gameweeks": f"""SELECT event_id, deadline_time, (last_ts < {AS_OF_SQL}) AS finished,
  (event_id = {GAMEWEEK}) AS is_current, (event_id = {GAMEWEEK + 1}) AS is_next
FROM (SELECT {_MONTH.format(c='o_orderdate')} AS event_id, min(o_orderdate) AS deadline_time,
  max(o_orderdate) AS last_ts FROM orders GROUP BY 1)""",
}


SQL["b_players_gw"] = (SQL["b_players"]
                       .replace("status\nFROM part p LEFT JOIN (SELECT l_partkey,", "status, a.gameweek\n"
                                "FROM part p JOIN (SELECT l_partkey, " + _MONTH.format(c="l_shipdate") + " AS gameweek,")
                       .replace("FROM lineitem GROUP BY l_partkey) a", "FROM lineitem GROUP BY l_partkey, gameweek) a"))
assert "a.gameweek" in SQL["b_players_gw"] and "GROUP BY l_partkey, gameweek" in SQL["b_players_gw"]


def with_bindings(body: str, *names: str) -> str:
    """Prefix ``body`` with the CTEs it needs (in dependency-free order)."""
    if not names:
        return body
    ctes = ",\n".join(f"{n} AS (\n{SQL[n]}\n)" for n in names)
    return f"WITH {ctes}\n{body}"
