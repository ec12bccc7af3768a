"""Catalog entries for ingest (A1-A11, A14, H13): landed JSON documents are
built by Spark from the base tables, then flattened by the library. Element
and live documents are one per lineitem record (no grouping); a market
document is one match = one order, bounded by the lines of that order."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sources.flatten import flatten_performance, flatten_section, parse_docs, snapshot
from ..sources.imports import normalise_results
from ..sources.odds import MATCH_SCHEMA, flatten_market_odds
from . import bindings as b
from .bindings import AS_OF, AS_OF_SQL, GAMEWEEK, with_bindings
from .catalog import B, D, R, conform, query

# Bookmaker standing in for each line number of an order.
BOOK_BY_LINE = ["skybet", "williamhill", "bet365", "pinnacle", "betfair_ex_uk", "unibet", "bet365"]
_LINE_ORDER = ["l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def _sorted_lines(li: DataFrame, fields: list) -> DataFrame:
    """Per order: its lines as an array sorted by a total order (bounded by
    the lines of one order). Fields are read back with ``lines.<field>``
    (no higher-order function). The line is projected before it is collected:
    inside ``collect_list`` its expressions would be interpreted."""
    s = F.struct(*[F.col(c) for c in _LINE_ORDER]).alias("s")
    line = li.select("l_orderkey", F.struct(s, *fields).alias("line"))
    return line.groupBy("l_orderkey").agg(F.sort_array(F.collect_list("line")).alias("lines"))


# ----------------------------------------------------------------------------- A1-A5 / H13
ELEMENT_SCHEMA = T.StructType([T.StructField("elements", T.ArrayType(T.StructType([
    T.StructField("id", T.LongType()), T.StructField("team", T.LongType()),
    T.StructField("element_type", T.IntegerType()), T.StructField("now_cost", T.IntegerType()),
    T.StructField("news", T.StringType()), T.StructField("chance_of_playing_next_round", T.DoubleType()),
    T.StructField("extra", T.StructType([T.StructField("k", T.IntegerType())]))])))])


def _element_docs(spark, d) -> DataFrame:
    li = b.read(spark, d, "lineitem")
    el = F.struct(
        F.col("l_partkey").alias("id"), F.col("l_suppkey").alias("team"), F.col("l_linenumber").alias("element_type"),
        F.when(F.col("l_returnflag") != "R", (F.floor("l_quantity") * 10).cast("int")).alias("now_cost"),
        F.when(F.col("l_linestatus") != "O", F.lit("ok")).alias("news"),
        F.when(F.col("l_returnflag") != "A", F.col("l_discount") * 1000.0).alias("chance_of_playing_next_round"),
        F.when(F.col("l_linestatus") == "F", F.struct(F.col("l_linenumber").alias("k"))).alias("extra"))
    # one landed document per element record (JSON lines): no grouping needed
    return li.select("l_orderkey", F.to_json(F.struct(F.array(el).alias("elements"))).alias("json"))


def _json_flatten_spark(spark, d):
    docs = parse_docs(_element_docs(spark, d), "json", ELEMENT_SCHEMA)
    rows = flatten_section(docs, "doc.elements", aliases={"player_id": "id", "team_id": "team",
                                                          "position_id": "element_type"},
                           json_cols={"extra": "{}"}, keep_null=["chance_of_playing_next_round"])
    return conform(rows.select("player_id", "team_id", "position_id", "now_cost", "news",
                               "chance_of_playing_next_round", "extra"))


query("json_flatten", sql=f"""
SELECT l_partkey AS player_id, l_suppkey AS team_id, {B('l_linenumber')} AS position_id,
  {B("coalesce(CASE WHEN l_returnflag <> 'R' THEN floor(l_quantity) * 10 END, 0)")} AS now_cost,
  coalesce(CASE WHEN l_linestatus <> 'O' THEN 'ok' END, '') AS news,
  {R("CASE WHEN l_returnflag <> 'A' THEN l_discount * 1000.0 END")} AS chance_of_playing_next_round,
  CASE WHEN l_linestatus = 'F' THEN '{{"k":' || CAST(l_linenumber AS VARCHAR) || '}}' ELSE '{{}}' END AS extra
FROM lineitem""")(_json_flatten_spark)

# ----------------------------------------------------------------------------- A11 / D6


def _json_number(x: F.Column) -> F.Column:
    """A double as JSON text, as ``to_json`` writes it (what is no number is quoted)."""
    text = x.cast("string")
    return F.when(F.abs(x) < float("inf"), text).otherwise(F.concat(F.lit('"'), text, F.lit('"')))


def _json_outcome(name: F.Column, price: F.Column, point: F.Column | None = None) -> F.Column:
    """One outcome of a market as JSON text; a price that is NULL is left out. Names need no escapes."""
    fields = [F.lit('{"name":"'), name, F.lit('"'),
              F.coalesce(F.concat(F.lit(',"price":'), _json_number(price)), F.lit(""))]
    return F.concat(*fields, *([] if point is None else [F.lit(',"point":'), _json_number(point)]), F.lit("}"))


def _market_docs(spark, d) -> DataFrame:
    """One provider JSON document per order; each line is one bookmaker.
    Lines are rendered to JSON text before the per-order collect, so the
    shuffle carries compact strings rather than nested structs."""
    li = b.read(spark, d, "lineitem")
    book = F.element_at(F.array(*[F.lit(x) for x in BOOK_BY_LINE]), F.pmod(F.col("l_linenumber") - 1, len(BOOK_BY_LINE)) + 1)
    home = F.concat(F.lit("Home "), F.col("l_orderkey").cast("string"))
    away = F.concat(F.lit("Away "), F.col("l_orderkey").cast("string"))
    q, dc, tx = F.col("l_quantity"), F.col("l_discount"), F.col("l_tax")
    home_price = F.when(F.col("l_returnflag") != "R", 1.0 + q / 20.0)  # some books quote no home price
    h2h = F.concat_ws(",", _json_outcome(home, home_price), _json_outcome(F.lit("Draw"), 3.0 + dc * 10.0),
                      _json_outcome(away, 1.0 + (51.0 - q) / 20.0))
    pt = F.when(tx < 0.04, F.lit(2.5)).otherwise(F.lit(3.5))
    tot = F.concat_ws(",", _json_outcome(F.lit("Over"), 1.5 + tx * 10.0, pt), _json_outcome(F.lit("Under"), 2.5 - tx * 10.0, pt))
    bk = F.concat(F.lit("{"), F.coalesce(F.concat(F.lit('"key":"'), book, F.lit('",')), F.lit("")),
                  F.lit('"markets":[{"key":"h2h","outcomes":['), h2h, F.lit(']},{"key":"totals","outcomes":['), tot, F.lit("]}]}"))
    per = _sorted_lines(li, [bk.alias("bk")])
    o = b.read(spark, d, "orders")
    j = per.join(o, per.l_orderkey == o.o_orderkey, "inner")
    commence = F.when(F.col("o_orderpriority") == "5-LOW", F.lit("TBD")).otherwise(
        F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss'Z'"))
    doc = F.concat(F.lit('{"home_team":"'), home, F.lit('","away_team":"'), away, F.lit('"'),
                   F.coalesce(F.concat(F.lit(',"commence_time":"'), commence, F.lit('"')), F.lit("")),
                   F.lit(',"bookmakers":['), F.array_join(F.col("lines.bk"), ","), F.lit("]}"))
    return j.select("l_orderkey", doc.alias("json"))


_MARKET_COLS = ["l_orderkey", "Date", "HomeTeam", "AwayTeam", "B365H", "B365D", "B365A", "PSH", "PSD", "PSA",
                "MaxH", "MaxD", "MaxA", "AvgH", "AvgD", "AvgA", "B365_over_2_5", "B365_under_2_5"]


def _market_spark(spark, d):
    docs = parse_docs(_market_docs(spark, d), "json", MATCH_SCHEMA, keep=["l_orderkey"])
    return conform(flatten_market_odds(docs, "l_orderkey").select(*_MARKET_COLS))


def _market_sql() -> str:
    books = ", ".join(f"'{x}'" for x in BOOK_BY_LINE)
    pref = "('bet365', 'pinnacle', 'skybet', 'williamhill', 'betfair_ex_uk')"

    def pick(fn, col, cond):
        return f"{fn}({col}, bpos) FILTER (WHERE {cond})"

    cols, ps = [], []
    for s in "hda":
        cols += [f"max({s}) AS max_{s}", f"avg({s}) AS avg_{s}"]
        ps.append(f"{s} AS ps_{s}")
    return f"""
WITH li AS (
  SELECT l_orderkey, row_number() OVER (PARTITION BY l_orderkey ORDER BY {', '.join(_LINE_ORDER)}) - 1 AS bpos,
    ([{books}])[(l_linenumber - 1) % {len(BOOK_BY_LINE)} + 1] AS book,
    CASE WHEN l_returnflag <> 'R' THEN 1.0 + l_quantity / 20.0 END AS h, 3.0 + l_discount * 10.0 AS d,
    1.0 + (51.0 - l_quantity) / 20.0 AS a, 1.5 + l_tax * 10.0 AS ov, 2.5 - l_tax * 10.0 AS un,
    CASE WHEN l_tax < 0.04 THEN 2.5 ELSE 3.5 END AS pt
  FROM lineitem),
-- the exact book's last quote, unless its home price is missing and a preferred book quotes one
-- after it; without the exact book the first preferred one with a home price, else the last
ex AS (SELECT l_orderkey, max(bpos) AS epos FROM li WHERE book = 'bet365' GROUP BY l_orderkey),
cand AS (
  SELECT li.*, ex.epos, (li.h IS NOT NULL) AS quoted FROM li LEFT JOIN ex USING (l_orderkey)
  WHERE li.book IN {pref} AND (ex.epos IS NULL OR li.bpos >= ex.epos)),
b365 AS (
  SELECT l_orderkey, h AS b_h, d AS b_d, a AS b_a FROM (
    SELECT *, row_number() OVER (PARTITION BY l_orderkey
      ORDER BY quoted DESC, CASE WHEN quoted THEN bpos ELSE -bpos END) AS rn FROM cand) WHERE rn = 1),
pin AS (
  SELECT l_orderkey, {', '.join(ps)} FROM (
    SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY bpos DESC) AS rn FROM li WHERE book = 'pinnacle')
  WHERE rn = 1),
agg AS (
  SELECT l_orderkey, {', '.join(cols)},
    {pick('arg_max', 'ov', "book = 'bet365' AND abs(pt - 2.5) < 0.1")} AS ov,
    {pick('arg_max', 'un', "book = 'bet365' AND abs(pt - 2.5) < 0.1")} AS un
  FROM li GROUP BY l_orderkey)
SELECT o_orderkey AS l_orderkey, strftime(o_orderdate, '%d/%m/%Y') AS "Date",
  'Home ' || CAST(o_orderkey AS VARCHAR) AS HomeTeam, 'Away ' || CAST(o_orderkey AS VARCHAR) AS AwayTeam,
  {R('b_h')} AS B365H, {R('b_d')} AS B365D, {R('b_a')} AS B365A,
  {R('ps_h')} AS PSH, {R('ps_d')} AS PSD, {R('ps_a')} AS PSA,
  {R('max_h')} AS MaxH, {R('max_d')} AS MaxD, {R('max_a')} AS MaxA,
  {R('avg_h')} AS AvgH, {R('avg_d')} AS AvgD, {R('avg_a')} AS AvgA,
  {R('ov')} AS B365_over_2_5, {R('un')} AS B365_under_2_5
FROM orders JOIN agg ON o_orderkey = agg.l_orderkey LEFT JOIN b365 ON o_orderkey = b365.l_orderkey
LEFT JOIN pin ON o_orderkey = pin.l_orderkey WHERE o_orderpriority <> '5-LOW'"""


query("nested_market_agg", sql=_market_sql())(_market_spark)

# ----------------------------------------------------------------------------- A8
LIVE_SCHEMA = T.StructType([T.StructField("elements", T.ArrayType(T.StructType([
    T.StructField("id", T.LongType()),
    T.StructField("stats", T.StructType([T.StructField("total_points", T.IntegerType()),
                                         T.StructField("minutes", T.IntegerType())])),
    T.StructField("explain", T.ArrayType(T.StructType([T.StructField("fixture", T.StringType())])))])))])
UNKNOWN_FIXTURE = -1  # an id no fixture has: that explain entry is skipped


def _live_docs(spark, d) -> DataFrame:
    li = b.read(spark, d, "lineitem")
    shape = F.col("l_linenumber") % 3
    main = (F.when(shape == 0, F.col("l_orderkey").cast("string"))
            .when(shape == 1, F.concat(F.lit('{"opponent_team":'), F.col("l_suppkey").cast("string"),
                                       F.lit(',"is_home":true}')))
            .otherwise(F.concat(F.lit('[{"opponent_team":'), F.col("l_suppkey").cast("string"),
                                F.lit(',"is_home":false}]'))))
    explain = F.concat(F.lit("["), F.when(F.col("l_linenumber") % 2 == 0,
                                          F.lit(f'{{"fixture":{UNKNOWN_FIXTURE}}},')).otherwise(F.lit("")),
                       F.lit('{"fixture":'), main, F.lit("}]"))
    el = F.concat(F.lit('{"id":'), F.col("l_partkey").cast("string"), F.lit(',"stats":{"total_points":'),
                  F.floor("l_quantity").cast("string"), F.lit(',"minutes":'),
                  (F.col("l_linenumber") * 10).cast("string"), F.lit('},"explain":'), explain, F.lit("}"))
    # one landed document per element record; the document id keeps equal
    # lines of one order apart
    return li.select("l_orderkey", F.monotonically_increasing_id().alias("doc_id"),
                     F.concat(F.lit('{"elements":['), el, F.lit("]}")).alias("json"))


def _live_spark(spark, d):
    docs = parse_docs(_live_docs(spark, d), "json", LIVE_SCHEMA, keep=["l_orderkey", "doc_id"])
    out = flatten_performance(docs, b.players(spark, d), b.fixtures(spark, d), GAMEWEEK,
                              doc_key=["l_orderkey", "doc_id"])
    return conform(out.select("l_orderkey", "player_id", "gameweek", "total_points", "minutes", "team_id",
                              F.col("opponent_team").cast("double").alias("opponent_team"),
                              F.col("was_home").cast("string").alias("was_home"), "value"))


query("first_nested_match", sql=with_bindings(f"""
, li AS (
  SELECT l.l_orderkey, l.l_partkey, l.l_suppkey, l.l_linenumber, l.l_quantity, p.team_id, p.now_cost,
    f.fixture_id, f.home_team_id, f.away_team_id
  FROM lineitem l LEFT JOIN b_players p ON l.l_partkey = p.player_id
  LEFT JOIN b_fixtures f ON l.l_linenumber % 3 = 0 AND f.fixture_id = l.l_orderkey)
SELECT l_orderkey, l_partkey AS player_id, {B(str(GAMEWEEK))} AS gameweek,
  {B('floor(l_quantity)')} AS total_points, {B('l_linenumber * 10')} AS minutes, {B('team_id')} AS team_id,
  {D('''CASE WHEN team_id IS NULL THEN NULL
        WHEN l_linenumber % 3 = 0 THEN CASE WHEN fixture_id IS NULL THEN NULL WHEN team_id = home_team_id
             THEN away_team_id WHEN team_id = away_team_id THEN home_team_id END
        ELSE l_suppkey END''')} AS opponent_team,
  CAST(CASE WHEN team_id IS NULL THEN NULL
        WHEN l_linenumber % 3 = 0 THEN CASE WHEN fixture_id IS NULL THEN NULL WHEN team_id = home_team_id
             THEN TRUE WHEN team_id = away_team_id THEN FALSE END
        WHEN l_linenumber % 3 = 1 THEN TRUE ELSE FALSE END AS VARCHAR) AS was_home,
  {B('now_cost')} AS value
FROM li""", "b_players", "b_fixtures"))(_live_spark)

# ----------------------------------------------------------------------------- A9


def _snapshot_spark(spark, d):
    return conform(snapshot(b.players(spark, d), GAMEWEEK, False, AS_OF)
                   .select("player_id", "gameweek", "status", "chance_of_playing_next_round", "news", "now_cost",
                           "ep_next", "form", "penalties_order", "is_backfilled", "snapshot_date")
                   .withColumn("penalties_order", F.col("penalties_order").cast("double")))


query("snapshot_capture", sql=with_bindings(f"""
SELECT player_id, {B(str(GAMEWEEK))} AS gameweek, coalesce(status, 'a') AS status,
  {R('chance_of_playing_next_round')} AS chance_of_playing_next_round, '' AS news, {B('now_cost')} AS now_cost,
  '0.0' AS ep_next, coalesce(form, '0.0') AS form, {D('penalties_order')} AS penalties_order,
  FALSE AS is_backfilled, {AS_OF_SQL} AS snapshot_date
FROM b_players""", "b_players"))(_snapshot_spark)

# ----------------------------------------------------------------------------- A14


def _results_spark(spark, d):
    return conform(normalise_results(b.fixtures(spark, d), b.teams(spark, d), "1998-1999"))


query("results_normalise", sql=with_bindings("""
SELECT f.kickoff_utc AS date_utc, coalesce(h.name, 'Team_' || CAST(f.home_team_id AS VARCHAR)) AS home_team,
  coalesce(a.name, 'Team_' || CAST(f.away_team_id AS VARCHAR)) AS away_team,
  CAST(f.team_h_score AS BIGINT) AS home_goals, CAST(f.team_a_score AS BIGINT) AS away_goals, '1998-1999' AS season
FROM b_fixtures f LEFT JOIN b_teams h ON f.home_team_id = h.team_id LEFT JOIN b_teams a ON f.away_team_id = a.team_id
WHERE f.team_h_score IS NOT NULL AND f.team_a_score IS NOT NULL""", "b_fixtures", "b_teams"))(_results_spark)
