"""Catalog entries for the data-quality checks and catalog views (L1-L14,
M1, M2, D2-D4, D7-D9)."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..quality import checks as q
from ..session import ensure_checkpoint_dir
from . import bindings as b
from . import features as feat
from .bindings import AS_OF, GAMEWEEK, with_bindings
from .catalog import B, R, conform, query

NOW = "2024-01-31 12:00:00"  # fixed "now" of the freshness checks (never the wall clock)
NOW_SQL = f"TIMESTAMP '{NOW}'"
ALL_TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
              "benchmark labels conversations").split()


def _rep_sql(table: str, check: str, column: str, bad: str, src: str, severity: str = "fail") -> str:
    v = f"coalesce(sum(CASE WHEN coalesce({bad}, FALSE) THEN 1 ELSE 0 END), 0)"
    return (f"SELECT '{table}' AS \"table\", '{check}' AS \"check\", '{column}' AS \"column\", "
            f"CAST({v} AS BIGINT) AS violations, CAST(count(*) AS BIGINT) AS total, "
            f"CASE WHEN {v} = 0 THEN 'pass' ELSE '{severity}' END AS status FROM {src}")


# ----------------------------------------------------------------------------- L1-L3
def _schema_spark(spark, d, t=b):
    li = b.read(spark, d, "lineitem")
    o = b.read(spark, d, "orders")
    p = t.players(spark, d)
    r1 = q.validate(li, "lineitem", [q.between("l_quantity", 1, 50), q.between("l_discount", 0.0, 0.1),
                                     q.isin("l_returnflag", ["A", "N", "R"]), q.isin("l_linestatus", ["O", "F"]),
                                     q.between("l_tax", 0.0, None), q.not_null("l_shipdate")])
    r2 = q.validate(o, "orders", [q.isin("o_orderpriority", ["1-URGENT", "2-HIGH", "3-MEDIUM"]),
                                  q.between("o_totalprice", 0.0, None), q.length_between("o_orderstatus", 1, 1)])
    r3 = q.validate(p, "players", [q.coercible("form", "double"), q.not_null("team_id"), q.between("now_cost", 35, 200),
                                   q.isin("position_id", [1, 2, 3, 4]),
                                   q.between("chance_of_playing_next_round", 0.0, 100.0)])
    return conform(r1.unionByName(r2).unionByName(r3))


query("dq_schema", sql=with_bindings(" UNION ALL ".join([
    _rep_sql("lineitem", "range[1,50]", "l_quantity", "(l_quantity < 1 OR l_quantity > 50)", "lineitem"),
    _rep_sql("lineitem", "range[0.0,0.1]", "l_discount", "(l_discount < 0.0 OR l_discount > 0.1)", "lineitem"),
    _rep_sql("lineitem", "isin", "l_returnflag", "l_returnflag NOT IN ('A', 'N', 'R')", "lineitem"),
    _rep_sql("lineitem", "isin", "l_linestatus", "l_linestatus NOT IN ('O', 'F')", "lineitem"),
    _rep_sql("lineitem", "range[0.0,None]", "l_tax", "l_tax < 0.0", "lineitem"),
    _rep_sql("lineitem", "not_null", "l_shipdate", "l_shipdate IS NULL", "lineitem"),
    _rep_sql("orders", "isin", "o_orderpriority", "o_orderpriority NOT IN ('1-URGENT', '2-HIGH', '3-MEDIUM')", "orders"),
    _rep_sql("orders", "range[0.0,None]", "o_totalprice", "o_totalprice < 0.0", "orders"),
    _rep_sql("orders", "length[1,1]", "o_orderstatus", "(length(o_orderstatus) < 1 OR length(o_orderstatus) > 1)",
             "orders"),
    _rep_sql("players", "coerce:double", "form", "(form IS NOT NULL AND TRY_CAST(form AS DOUBLE) IS NULL)",
             "b_players"),
    _rep_sql("players", "not_null", "team_id", "team_id IS NULL", "b_players"),
    _rep_sql("players", "range[35,200]", "now_cost", "(now_cost < 35 OR now_cost > 200)", "b_players"),
    _rep_sql("players", "isin", "position_id", "position_id NOT IN (1, 2, 3, 4)", "b_players"),
    _rep_sql("players", "range[0.0,100.0]", "chance_of_playing_next_round",
             "(chance_of_playing_next_round < 0.0 OR chance_of_playing_next_round > 100.0)", "b_players"),
]), "b_players"))(_schema_spark)

# ----------------------------------------------------------------------------- L4 / D3


def _uniq_sql(table: str, key: list[str]) -> str:
    k = ", ".join(key)
    return (f"SELECT '{table}' AS \"table\", 'unique' AS \"check\", '{','.join(key)}' AS \"column\", "
            f"CAST(coalesce(sum(n - 1), 0) AS BIGINT) AS violations, CAST(coalesce(sum(n), 0) AS BIGINT) AS total, "
            f"CASE WHEN coalesce(sum(n - 1), 0) = 0 THEN 'pass' ELSE 'fail' END AS status "
            f"FROM (SELECT {k}, count(*) AS n FROM {table} GROUP BY {k})")


query("dq_unique", sql=" UNION ALL ".join([_uniq_sql("lineitem", ["l_orderkey", "l_linenumber"]),
                                          _uniq_sql("orders", ["o_orderkey"]),
                                          _uniq_sql("conversations", ["conv_id", "turn"])]))(
    lambda spark, d: conform(
        q.check_unique(b.read(spark, d, "lineitem"), "lineitem", ["l_orderkey", "l_linenumber"])
        .unionByName(q.check_unique(b.read(spark, d, "orders"), "orders", ["o_orderkey"]))
        .unionByName(q.check_unique(b.read(spark, d, "conversations"), "conversations", ["conv_id", "turn"]))))

# ----------------------------------------------------------------------------- L6


def _business_spark(spark, d, t=b):
    fx = t.fixtures(spark, d)
    fin = F.coalesce(F.col("finished"), F.lit(False))
    r1 = q.validate(fx, "fixtures", [
        q.predicate("finished_has_scores", ~fin | (F.col("team_h_score").isNotNull() & F.col("team_a_score").isNotNull())),
        q.predicate("scores_non_negative", (F.col("team_h_score") >= 0) & (F.col("team_a_score") >= 0)),
        q.predicate("distinct_teams", F.col("home_team_id") != F.col("away_team_id")),
    ])
    r2 = q.check_exactly(t.gameweeks(spark, d), "gameweeks", "one_current", F.col("is_current"), 1)
    r3 = q.check_group(b.read(spark, d, "lineitem"), "lineitem", "lines_per_order<=7", ["l_orderkey"],
                       F.count(F.lit(1)) <= 7)
    return conform(r1.unionByName(r2).unionByName(r3))


query("dq_business", sql=with_bindings(" UNION ALL ".join([
    _rep_sql("fixtures", "finished_has_scores", "*",
             "NOT coalesce(NOT coalesce(finished, FALSE) OR (team_h_score IS NOT NULL AND team_a_score IS NOT NULL), TRUE)",
             "b_fixtures"),
    _rep_sql("fixtures", "scores_non_negative", "*", "NOT coalesce(team_h_score >= 0 AND team_a_score >= 0, TRUE)",
             "b_fixtures"),
    _rep_sql("fixtures", "distinct_teams", "*", "NOT coalesce(home_team_id <> away_team_id, TRUE)", "b_fixtures"),
    """SELECT 'gameweeks' AS "table", 'one_current' AS "check", '*' AS "column",
  CAST(abs(coalesce(sum(CASE WHEN coalesce(is_current, FALSE) THEN 1 ELSE 0 END), 0) - 1) AS BIGINT) AS violations,
  CAST(count(*) AS BIGINT) AS total,
  CASE WHEN abs(coalesce(sum(CASE WHEN coalesce(is_current, FALSE) THEN 1 ELSE 0 END), 0) - 1) = 0 THEN 'pass'
       ELSE 'fail' END AS status FROM b_gameweeks""",
    """SELECT 'lineitem' AS "table", 'lines_per_order<=7' AS "check", 'l_orderkey' AS "column",
  CAST(sum(CASE WHEN n <= 7 THEN 0 ELSE 1 END) AS BIGINT) AS violations, CAST(count(*) AS BIGINT) AS total,
  CASE WHEN sum(CASE WHEN n <= 7 THEN 0 ELSE 1 END) = 0 THEN 'pass' ELSE 'fail' END AS status
FROM (SELECT l_orderkey, count(*) AS n FROM lineitem GROUP BY l_orderkey)"""]), "b_fixtures", "b_gameweeks"))(
    _business_spark)

# ----------------------------------------------------------------------------- L7 / D4
_LINE_VALUE = "l_extendedprice * (1 - l_discount) * (1 + l_tax)"

query("dq_reconcile", sql=f"""
SELECT o.o_orderkey, {R('o.o_totalprice')} AS stored_total, {R('s.detail_sum')} AS detail_sum,
  {R('o.o_totalprice - coalesce(s.detail_sum, 0.0)')} AS difference
FROM orders o LEFT JOIN (SELECT l_orderkey, sum({_LINE_VALUE}) AS detail_sum FROM lineitem GROUP BY l_orderkey) s
  ON o.o_orderkey = s.l_orderkey
WHERE abs(o.o_totalprice - coalesce(s.detail_sum, 0.0)) > 1.0""")(
    lambda spark, d: conform(_reconcile_spark(spark, d)))


def _reconcile_spark(spark, d):
    li = b.read(spark, d, "lineitem").withColumnRenamed("l_orderkey", "o_orderkey")
    r = q.reconcile(li, "o_orderkey", F.col("l_extendedprice") * (1 - F.col("l_discount")) * (1 + F.col("l_tax")),
                    b.read(spark, d, "orders"), "o_totalprice", 1.0)
    return r.select("o_orderkey", "stored_total", "detail_sum", "difference")


# ----------------------------------------------------------------------------- L8
def _formula_spark(spark, d, t=b):
    # stored charge of a line against quantity times the part's list price
    lines = b.read(spark, d, "lineitem").join(b.read(spark, d, "part"), F.col("l_partkey") == F.col("p_partkey"))
    exp = F.col("l_quantity") * F.col("p_retailprice")
    price = q.check_formula(lines, "lineitem", "line_charge", exp, F.col("l_extendedprice"), 0.01)
    f = feat.fixture_difficulty(t.fixtures(spark, d), t.teams(spark, d), AS_OF)
    exp = F.col("opponent_strength_difficulty") * F.when(F.col("is_home"), 0.9).otherwise(1.1)
    # the rule clips at 5, so a higher venue difficulty breaks this stricter form
    low = q.validate(f, "fixture_difficulty", [q.Rule("venue_at_most_4", "venue_difficulty", F.col("venue_difficulty") > 4.0)])
    return conform(price.unionByName(q.check_formula(f, "fixture_difficulty", "venue_difficulty", exp,
                                                     F.col("venue_difficulty"), 0.01)).unionByName(low))


query("dq_formula", sql=with_bindings("""
, sides AS (
  SELECT away_team_id AS opponent_id, 0.9 AS f FROM b_fixtures
  WHERE home_team_id IS NOT NULL AND away_team_id IS NOT NULL AND event IS NOT NULL
  UNION ALL SELECT home_team_id, 1.1 FROM b_fixtures
  WHERE home_team_id IS NOT NULL AND away_team_id IS NOT NULL AND event IS NOT NULL),
diff AS (
  SELECT f, least(greatest(coalesce(CASE WHEN f < 1 THEN strength_overall_away ELSE strength_overall_home END, 1000)
                           / 300.0, 0.0), 5.0) AS base
  FROM sides LEFT JOIN b_teams t ON sides.opponent_id = t.team_id),
r AS (
  SELECT 1 AS o, 'lineitem' AS "table", 'line_charge' AS "check", 'line_charge' AS "column",
    sum(CASE WHEN abs(l_quantity * p_retailprice - l_extendedprice) > 0.01 THEN 1 ELSE 0 END) AS v, count(*) AS n
  FROM lineitem JOIN part ON l_partkey = p_partkey
  UNION ALL SELECT 2, 'fixture_difficulty', 'venue_difficulty', 'venue_difficulty',
    sum(CASE WHEN abs(base * CAST(f AS DOUBLE) - base * f) > 0.01 THEN 1 ELSE 0 END), count(*) FROM diff
  UNION ALL SELECT 3, 'fixture_difficulty', 'venue_at_most_4', 'venue_difficulty',
    sum(CASE WHEN base * f > 4.0 THEN 1 ELSE 0 END), count(*) FROM diff)
SELECT "table", "check", "column", CAST(coalesce(v, 0) AS BIGINT) AS violations, CAST(n AS BIGINT) AS total,
  CASE WHEN coalesce(v, 0) = 0 THEN 'pass' ELSE 'fail' END AS status FROM r""", "b_fixtures", "b_teams"))(_formula_spark)

# ----------------------------------------------------------------------------- L9
_MON = "CAST((year(o_orderdate) - 1995) * 12 + month(o_orderdate) AS INTEGER)"

query("dq_temporal", sql=f"""
WITH per AS (SELECT {_MON} AS period, max(o_orderdate) AS mx FROM orders GROUP BY 1),
back AS (SELECT mx, lag(mx) OVER (ORDER BY period) AS prev FROM per)
SELECT 'orders' AS "table", 'monotonic' AS "check", 'o_orderdate' AS "column",
  CAST(sum(CASE WHEN mx < prev THEN 1 ELSE 0 END) AS BIGINT) AS violations, CAST(count(*) AS BIGINT) AS total,
  CASE WHEN sum(CASE WHEN mx < prev THEN 1 ELSE 0 END) = 0 THEN 'pass' ELSE 'fail' END AS status FROM back
UNION ALL
{_rep_sql("orders", "not_future", "o_orderdate", "o_orderdate > TIMESTAMP '2001-06-30 00:00:00'", "orders")}""")(
    lambda spark, d: conform(q.check_monotonic(
        b.read(spark, d, "orders").withColumn("period", b.month_index(F.col("o_orderdate"))), "orders", "period",
        "o_orderdate", now="2001-06-30 00:00:00")))

# ----------------------------------------------------------------------------- L10 / D7


def _fresh_tables(spark, d):
    return {"orders": (b.read(spark, d, "orders"), "o_orderdate"),
            "lineitem": (b.read(spark, d, "lineitem"), "l_shipdate"),
            "events": (b.read(spark, d, "events"), "ts")}


def _age_sql(col: str) -> str:
    return f"((epoch_us({NOW_SQL}) - epoch_us(max({col}))) / 3.6e9)"


def _fresh_sql(table: str, col: str, warn: float, fail: float) -> str:
    age = _age_sql(col)
    st = (f"CASE WHEN max({col}) IS NULL THEN 'fail' WHEN {age} > {fail} THEN 'fail' WHEN {age} > {warn} THEN 'warn' "
          f"ELSE 'pass' END")
    return (f"SELECT '{table}' AS \"table\", 'freshness' AS \"check\", '*' AS \"column\", "
            f"CAST(CASE WHEN {st} = 'pass' THEN 0 ELSE 1 END AS BIGINT) AS violations, CAST(1 AS BIGINT) AS total, "
            f"{st} AS status FROM {table}")


query("dq_freshness", sql=" UNION ALL ".join([_fresh_sql("orders", "o_orderdate", 24, 168),
                                             _fresh_sql("lineitem", "l_shipdate", 24, 168),
                                             _fresh_sql("events", "ts", 48, 336)]))(
    lambda spark, d: conform(q.check_fresh(_fresh_tables(spark, d), NOW, {"events": (48.0, 336.0)})))

query("freshness_summary", sql=" UNION ALL ".join(
    f"""SELECT '{t}' AS "table", max({c}) AS latest, {R(f"round({_age_sql(c)}, 2)")} AS age_hours,
  CASE WHEN round({_age_sql(c)}, 2) <= 1 THEN 'very_fresh' WHEN round({_age_sql(c)}, 2) <= 6 THEN 'fresh'
       WHEN round({_age_sql(c)}, 2) <= 24 THEN 'stale' WHEN max({c}) IS NOT NULL THEN 'very_stale'
       ELSE 'unknown' END AS status FROM {t}"""
    for t, c in [("orders", "o_orderdate"), ("lineitem", "l_shipdate"), ("events", "ts")]))(
    lambda spark, d: conform(q.freshness(_fresh_tables(spark, d), NOW)))

# ----------------------------------------------------------------------------- L11 / D9
_PLAYER_COLS = ["player_id", "web_name", "first_name", "second_name", "team_id", "position_id", "now_cost",
                "total_points", "form", "minutes", "selected_by_percent", "transfers_in_event", "transfers_out_event",
                "penalties_order", "corners_and_indirect_freekicks_order", "direct_freekicks_order",
                "chance_of_playing_next_round", "status"]


def _compl_sql() -> str:
    parts = []
    for c in _PLAYER_COLS:
        nul = f"coalesce(sum(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END), 0)"
        pct = f"(CASE WHEN count(*) > 0 THEN (1 - {nul} / count(*)) * 100.0 ELSE 100.0 END)"
        parts.append(f"""SELECT 'players' AS "table", '{c}' AS "column", CAST({nul} AS BIGINT) AS null_cells,
  CAST(count(*) AS BIGINT) AS total, {R(pct)} AS completeness_pct,
  CASE WHEN {pct} >= 90.0 THEN 'GOOD' WHEN {pct} >= 70.0 THEN 'FAIR' ELSE 'POOR' END AS grade FROM b_players""")
    return with_bindings(" UNION ALL ".join(parts), "b_players")


query("dq_completeness", sql=_compl_sql())(lambda spark, d: conform(q.completeness(b.players(spark, d), "players")))

# ----------------------------------------------------------------------------- L12
query("dq_partition_completeness", sql=with_bindings(f"""
, present AS (SELECT DISTINCT 'fixtures' AS "table", CAST(event AS INTEGER) AS period FROM b_fixtures
              UNION SELECT DISTINCT 'history', CAST(gameweek AS INTEGER) FROM b_history),
exp AS (SELECT t."table", CAST(g.range AS INTEGER) AS period
        FROM (SELECT 'fixtures' AS "table" UNION ALL SELECT 'history') t, range(1, {GAMEWEEK - 1} + 1) g)
SELECT "table", CAST(period AS BIGINT) AS period, 'missing' AS issue FROM exp
WHERE ("table", period) NOT IN (SELECT ("table", period) FROM present)
UNION ALL
SELECT "table", CAST(period AS BIGINT), CASE WHEN period > {GAMEWEEK - 1} + 1 THEN 'future' ELSE 'extra' END
FROM present WHERE period < 1 OR period > {GAMEWEEK - 1}""",
                                                        "b_fixtures", "b_history"))(
    lambda spark, d: conform(q.period_completeness({"fixtures": (b.fixtures(spark, d), "event"),
                                                    "history": (b.history(spark, d), "gameweek")}, GAMEWEEK - 1)))

# ----------------------------------------------------------------------------- L13
_EXPECTED_COLS = {"orders": 6, "lineitem": 11, "part": 6, "customer": 5}


def _sanity_spark(spark, d):
    t = {n: b.read(spark, d, n) for n in ("nation", "supplier", "orders", "lineitem", "part", "customer")}
    return conform(q.sanity(t, expected_rows={"nation": 25, "region": 5}, expected_cols=_EXPECTED_COLS,
                            required=["nation", "supplier", "orders", "lineitem", "fixtures"]))


def _sanity_sql() -> str:
    parts = []
    for n in ("nation", "supplier", "orders", "lineitem", "part", "customer"):
        parts.append(f"""SELECT '{n}' AS "table", 'non_empty' AS "check", '*' AS "column",
  CAST(CASE WHEN count(*) = 0 THEN 1 ELSE 0 END AS BIGINT) AS violations, CAST(count(*) AS BIGINT) AS total,
  CASE WHEN count(*) = 0 THEN 'fail' ELSE 'pass' END AS status FROM {n}""")
    parts.append("""SELECT 'nation' AS "table", 'row_count=25' AS "check", '*' AS "column",
  CAST(abs(count(*) - 25) AS BIGINT) AS violations, CAST(count(*) AS BIGINT) AS total,
  CASE WHEN count(*) = 25 THEN 'pass' ELSE 'fail' END AS status FROM nation""")
    for n, want in _EXPECTED_COLS.items():
        parts.append(f"""SELECT '{n}' AS "table", 'column_count={want}' AS "check", '*' AS "column",
  CAST(greatest({want} - count(*), 0) AS BIGINT) AS violations, CAST(count(*) AS BIGINT) AS total,
  CASE WHEN count(*) >= {want} THEN 'pass' ELSE 'warn' END AS status
FROM (DESCRIBE SELECT * FROM {n})""")
    parts.append("""SELECT 'region' AS "table", 'row_count=5' AS "check", '*' AS "column",
  CAST(5 AS BIGINT) AS violations, CAST(0 AS BIGINT) AS total, 'fail' AS status""")
    parts.append("""SELECT 'fixtures' AS "table", 'required_table' AS "check", '*' AS "column",
  CAST(1 AS BIGINT) AS violations, CAST(0 AS BIGINT) AS total, 'fail' AS status""")
    return " UNION ALL ".join(parts)


query("dq_sanity", sql=_sanity_sql())(_sanity_spark)

# ----------------------------------------------------------------------------- L14
query("dq_report", sql=f"""
WITH u AS (SELECT status FROM ({" UNION ALL ".join([
    _uniq_sql("lineitem", ["l_orderkey", "l_linenumber"]), _uniq_sql("orders", ["o_orderkey"]),
    _uniq_sql("conversations", ["conv_id", "turn"]),
    _rep_sql("lineitem", "range[1,50]", "l_quantity", "(l_quantity < 1 OR l_quantity > 50)", "lineitem"),
    _rep_sql("orders", "isin", "o_orderpriority", "o_orderpriority NOT IN ('1-URGENT', '2-HIGH', '3-MEDIUM')",
             "orders")])}))
SELECT CAST(count(*) AS BIGINT) AS checks, CAST(sum(CASE WHEN status = 'pass' THEN 1 ELSE 0 END) AS BIGINT) AS passed,
  CAST(sum(CASE WHEN status = 'warn' THEN 1 ELSE 0 END) AS BIGINT) AS warned,
  CAST(sum(CASE WHEN status = 'fail' THEN 1 ELSE 0 END) AS BIGINT) AS failed,
  {R("round(sum(CASE WHEN status = 'pass' THEN 1 ELSE 0 END) / count(*) * 100.0, 2)")} AS success_rate FROM u""")(
    lambda spark, d: conform(q.summarise([
        q.check_unique(b.read(spark, d, "lineitem"), "lineitem", ["l_orderkey", "l_linenumber"]),
        q.check_unique(b.read(spark, d, "orders"), "orders", ["o_orderkey"]),
        q.check_unique(b.read(spark, d, "conversations"), "conversations", ["conv_id", "turn"]),
        q.validate(b.read(spark, d, "lineitem"), "lineitem", [q.between("l_quantity", 1, 50)]),
        q.validate(b.read(spark, d, "orders"), "orders", [q.isin("o_orderpriority", ["1-URGENT", "2-HIGH", "3-MEDIUM"])]),
    ])))

# ----------------------------------------------------------------------------- M1 / D2
query("table_counts", sql=" UNION ALL ".join(
    f"SELECT '{t}' AS \"table\", CAST(count(*) AS BIGINT) AS \"rows\" FROM {t}" for t in ALL_TABLES))(
    lambda spark, d: conform(q.table_counts({t: b.read(spark, d, t) for t in ALL_TABLES})))

# ----------------------------------------------------------------------------- L1 (table schemas)
from ..quality import schemas as sch  # noqa: E402
from ..quality import tables as declared  # noqa: E402

_PLAYERS = declared.PLAYERS.only(
    "player_id", "web_name", "first_name", "second_name", "team_id", "position_id", "status", "now_cost", "minutes",
    "transfers_in_event", "transfers_out_event", "selected_by_percent", "chance_of_playing_next_round")
_FIXTURES = declared.FIXTURES.only("fixture_id", "event", "home_team_id", "away_team_id", "team_h_score", "team_a_score")
_SHARE = sch.Table({"selected_by_percent": sch.Col("double", True, 0.0, 100.0)})


def _schemas_spark(spark, d, t=b):
    # two raw tables, one with a text column for a number, and one without a column of its schema
    players = t.players(spark, d).select(*[c for c in _PLAYERS.names() if c != "first_name"])
    players = players.withColumn("minutes", F.when(F.col("position_id") == 1, F.lit("ninety")).otherwise(
        F.col("minutes").cast("string")))
    fx = t.fixtures(spark, d)
    # the declared text of this column holds a number, which is judged beside the text
    share = sch.rules_of(_SHARE, players.columns)
    return conform(sch.check_table(players, "players", _PLAYERS, share).unionByName(sch.check_table(fx, "fixtures", _FIXTURES)))


def _schemas_sql() -> str:
    # the contract's limits, written out: the SQL must not follow the declarations under test
    def rng(c, lo, hi):
        parts = ([f"{c} < {lo}"] if lo is not None else []) + ([f"{c} > {hi}"] if hi is not None else [])
        return f"({' OR '.join(parts)})"

    def text(lo, hi):
        return f"range[{lo},{hi}]"

    p, f = "players", "fixtures"
    rules = []
    for c, kind, lo, hi, null in [("player_id", "bigint", 1, None, False), ("team_id", "bigint", 1, 20, False),
                                  ("position_id", "bigint", 1, 4, False), ("now_cost", "bigint", 35, 200, True),
                                  ("transfers_in_event", "bigint", 0, None, True),
                                  ("transfers_out_event", "bigint", 0, None, True)]:
        rules += [(p, f"coerce:{kind}", c, "FALSE", "b_players"), (p, text(lo, hi), c, rng(c, lo, hi), "b_players")]
        rules += [] if null else [(p, "not_null", c, f"{c} IS NULL", "b_players")]
    for c in ("selected_by_percent", "chance_of_playing_next_round"):
        v = f"TRY_CAST({c} AS DOUBLE)"
        rules += [(p, "coerce:double", c, f"({c} IS NOT NULL AND {v} IS NULL)", "b_players"),
                  (p, text(0.0, 100.0), c, rng(v, 0, 100), "b_players")]
    rules += [(p, "coerce:bigint", "minutes", "position_id = 1", "b_players"),
              (p, "range[0,None]", "minutes", "(minutes < 0 AND position_id <> 1)", "b_players"),
              (p, "not_null", "status", "status IS NULL", "b_players"),
              (p, "isin", "status", "status NOT IN ('a', 'i', 's', 'u', 'd', 'n')", "b_players")]
    for c in ("web_name", "second_name", "selected_by_percent"):
        rules += [(p, "not_null", c, f"{c} IS NULL", "b_players"), (p, "length[1,None]", c, f"length({c}) < 1", "b_players")]
    for c, lo, hi, null in [("fixture_id", 1, None, False), ("event", 1, 38, True), ("home_team_id", 1, 20, False),
                            ("away_team_id", 1, 20, False), ("team_h_score", 0, None, True), ("team_a_score", 0, None, True)]:
        rules += [(f, "coerce:bigint", c, "FALSE", "b_fixtures"), (f, text(lo, hi), c, rng(c, lo, hi), "b_fixtures")]
        rules += [] if null else [(f, "not_null", c, f"{c} IS NULL", "b_fixtures")]
    parts = [_rep_sql(t, chk, c, bad, src) for t, chk, c, bad, src in rules]
    for t, c, src in ((p, "player_id", "b_players"), (f, "fixture_id", "b_fixtures")):
        parts.append(f"""SELECT '{t}', 'unique', '{c}', CAST(count(*) - count(DISTINCT {c}) AS BIGINT),
  CAST(count(*) AS BIGINT), CASE WHEN count(*) = count(DISTINCT {c}) THEN 'pass' ELSE 'fail' END FROM {src}""")
    parts.append("SELECT 'players', 'column_present', 'first_name', CAST(1 AS BIGINT), CAST(1 AS BIGINT), 'fail'")
    return with_bindings(" UNION ALL ".join(parts), "b_players", "b_fixtures")


query("dq_table_schemas", sql=_schemas_sql())(_schemas_spark)


# ----------------------------------------------------------------------------- L6 (squads, finished gameweeks, performance)
def _squads(spark, d):
    # an order is a squad, its lines the picks; the line of the largest number is captain, that of number 2 the vice-captain
    li = b.read(spark, d, "lineitem")
    return li.select(F.col("l_orderkey").alias("manager_id"), F.lit(1).alias("event"), F.col("l_partkey").alias("player_id"),
                     (F.col("l_linenumber") == 7).alias("is_captain"), (F.col("l_linenumber") == 2).alias("is_vice_captain"))


def _game_rules_spark(spark, d, t=b):
    perf = t.players_by_period(spark, d).select("player_id", "gameweek", "total_points", "minutes",
                                                F.col("penalties_order").alias("goals_scored"), F.lit(0).alias("assists"))
    reports = [q.check_picks(_squads(spark, d), size=7), q.validate(perf, "performance", q.performance_rules()),
               q.check_finished_have_stats(t.gameweeks(spark, d), perf, "gameweeks")]
    return conform(reports[0].unionByName(reports[1]).unionByName(reports[2]))


def _game_rules_sql() -> str:
    def rep(table, check, column, bad, src):
        return (f"SELECT '{table}' AS \"table\", '{check}' AS \"check\", '{column}' AS \"column\", "
                f"{B(f'coalesce(sum(CASE WHEN {bad} THEN 1 ELSE 0 END), 0)')} AS violations, {B('count(*)')} AS total, "
                f"CASE WHEN coalesce(sum(CASE WHEN {bad} THEN 1 ELSE 0 END), 0) = 0 THEN 'pass' ELSE 'fail' END AS status FROM {src}")
    squads = ("(SELECT l_orderkey, count(*) AS n, count(*) FILTER (WHERE l_linenumber = 7) AS c, count(*) FILTER (WHERE l_linenumber = 2) AS v, "
              "count(DISTINCT l_partkey) AS p, count(l_partkey) AS k FROM lineitem GROUP BY l_orderkey)")
    m = "raw_my_picks"
    parts = [rep(m, "picks", "manager_id,event", "n <> 7", squads), rep(m, "one_captain", "manager_id,event", "c <> 1", squads),
             rep(m, "one_vice_captain", "manager_id,event", "v <> 1", squads), rep(m, "no_player_twice", "manager_id,event", "p <> k", squads),
             rep("performance", "range[-10,None]", "total_points", "total_points < -10", "b_players_gw"),
             rep("performance", "range[0,120]", "minutes", "(minutes < 0 OR minutes > 120)", "b_players_gw"),
             rep("performance", "range[0,None]", "goals_scored", "penalties_order < 0", "b_players_gw"),
             rep("performance", "range[0,None]", "assists", "FALSE", "b_players_gw"),
             rep("gameweeks", "finished_has_stats", "event_id", "event_id NOT IN (SELECT gameweek FROM b_players_gw)",
                 "(SELECT * FROM b_gameweeks WHERE finished)")]
    return with_bindings(" UNION ALL ".join(parts), "b_players_gw", "b_gameweeks")


query("dq_game_rules", sql=_game_rules_sql())(_game_rules_spark)

# ----------------------------------------------------------------------------- L14 over every kind of check
_REPORTS = ("dq_schema", "dq_unique", "dq_referential", "dq_business", "dq_formula", "dq_temporal", "dq_freshness", "dq_sanity",
            "dq_table_schemas", "dq_game_rules")


def _full_report_spark(spark, d):
    from .q_ops import _fk_spark
    from .catalog import all_queries
    # the derived tables that several reports read: each order's and each part's lines are aggregated once
    t = b.stored(spark, d, f"{ensure_checkpoint_dir(spark)}/report-{uuid.uuid4().hex}", "players", "fixtures")
    on_derived = {"dq_schema": _schema_spark, "dq_referential": _fk_spark, "dq_business": _business_spark, "dq_formula": _formula_spark,
                  "dq_table_schemas": _schemas_spark, "dq_game_rules": _game_rules_spark}
    value = F.col("l_extendedprice") * (1 - F.col("l_discount")) * (1 + F.col("l_tax"))
    li = b.read(spark, d, "lineitem").withColumnRenamed("l_orderkey", "o_orderkey")
    reports = [on_derived[n](spark, d, t) if n in on_derived else all_queries()[n][0](spark, d) for n in _REPORTS] + [
        q.check_reconciled(li, "orders", "o_orderkey", value, b.read(spark, d, "orders"), "o_totalprice", 1.0),
        q.check_complete(t.players(spark, d), "players"),
        q.check_periods({"fixtures": (t.fixtures(spark, d), "event"), "history": (t.history(spark, d), "gameweek")}, GAMEWEEK - 1)]
    return conform(q.summarise(reports))


def _full_report_sql() -> str:
    from .catalog import REGISTRY
    subs = [f"SELECT status FROM ({REGISTRY[n][1]})" for n in _REPORTS]
    subs.append(f"SELECT CASE WHEN count(*) = 0 THEN 'pass' ELSE 'fail' END AS status FROM ({REGISTRY['dq_reconcile'][1]})")
    subs.append(f"SELECT CASE grade WHEN 'GOOD' THEN 'pass' WHEN 'FAIR' THEN 'warn' ELSE 'fail' END FROM ({REGISTRY['dq_completeness'][1]})")
    subs.append("SELECT CASE WHEN count(p.period) = 0 THEN 'pass' ELSE 'fail' END FROM (SELECT 'fixtures' AS t UNION ALL SELECT 'history') n "
                f"LEFT JOIN ({REGISTRY['dq_partition_completeness'][1]}) p ON n.t = p.\"table\" GROUP BY n.t")
    return f"""SELECT {B('count(*)')} AS checks, {B("count(*) FILTER (WHERE status = 'pass')")} AS passed,
  {B("count(*) FILTER (WHERE status = 'warn')")} AS warned, {B("count(*) FILTER (WHERE status = 'fail')")} AS failed,
  {R("round(count(*) FILTER (WHERE status = 'pass') / count(*) * 100.0, 2)")} AS success_rate FROM ({' UNION ALL '.join(subs)})"""
