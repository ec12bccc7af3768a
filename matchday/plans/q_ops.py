"""Catalog entries for joins, merges, write semantics, filters, ranking
helpers and gameweek bookkeeping (B5-B8, C2, C4-C6, C10, C11, E3, E4, E6,
E7, F2, G1, G3, G4, J2, J3, J5, J6, K1, K2)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators.filters import in_range, name_lookup, per_unit_rates
from ..operators.joins import alias_table, duplicate_keys, fill_nulls, left_join_suffix, match_exactly_one, orphans, resolve_names, \
    resolve_variants
from ..operators.merge import diff_keys, merge_latest, missing_periods
from ..operators.periods import current_period, free_allowance, target_period
from ..operators.rank import first_by, latest_by, latest_partition, top_k
from ..sources.sinks import append_conflicts, insert_ignore_frame, replace_keys_frame, replace_partitions_frame
from . import bindings as b
from .bindings import month_index, with_bindings
from .catalog import B, NUM, R, conform, query

# keys that a one-to-one join refuses
query("refused_keys", sql="""
SELECT l_orderkey, count(*) AS n FROM lineitem GROUP BY l_orderkey HAVING count(*) > 1""")(lambda spark, d: conform(
    duplicate_keys(b.read(spark, d, "lineitem"), "l_orderkey")))

# ----------------------------------------------------------------------------- J6
query("insert_or_ignore", sql=f"""
SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, {R('l_extendedprice')} AS l_extendedprice FROM (
  SELECT l_orderkey, l_linenumber, l_extendedprice,
    row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_extendedprice) AS rn
  FROM lineitem WHERE l_linestatus <> 'F'
    AND l_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE l_linestatus = 'F'))
WHERE rn = 1""")(lambda spark, d: conform(insert_ignore_frame(
    b.read(spark, d, "lineitem").where(F.col("l_linestatus") == "F").select("l_orderkey"),
    b.read(spark, d, "lineitem").where(F.col("l_linestatus") != "F")
    .select("l_orderkey", "l_linenumber", "l_extendedprice"),
    "l_orderkey", order=["l_linenumber", "l_extendedprice"])))

# ----------------------------------------------------------------------------- J2
_MON = "CAST((year({c}) - 1995) * 12 + month({c}) AS INTEGER)"


def _j2_spark(spark, d):
    li = b.read(spark, d, "lineitem")
    old = li.select("l_orderkey", "l_linenumber", month_index(F.col("l_shipdate")).alias("gameweek"),
                    "l_quantity")
    o = b.read(spark, d, "orders")
    new = o.select(F.col("o_orderkey").alias("l_orderkey"), F.lit(0).alias("l_linenumber"),
                   month_index(F.col("o_orderdate")).alias("gameweek"), F.lit(0.0).alias("l_quantity"))
    return conform(replace_partitions_frame(old, new, "gameweek"))


query("replace_partition", sql=f"""
WITH old AS (SELECT l_orderkey, l_linenumber, {_MON.format(c='l_shipdate')} AS gameweek, l_quantity FROM lineitem),
new AS (SELECT o_orderkey AS l_orderkey, 0 AS l_linenumber, {_MON.format(c='o_orderdate')} AS gameweek,
               0.0 AS l_quantity FROM orders)
SELECT {B('l_orderkey')} AS l_orderkey, {B('l_linenumber')} AS l_linenumber, {B('gameweek')} AS gameweek,
  {R('l_quantity')} AS l_quantity
FROM (SELECT * FROM old WHERE gameweek NOT IN (SELECT gameweek FROM new) UNION ALL SELECT * FROM new)""")(_j2_spark)

# ----------------------------------------------------------------------------- J3


def _j3_spark(spark, d):
    o = b.read(spark, d, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    li = b.read(spark, d, "lineitem")
    new = li.groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.sum("l_extendedprice").alias("o_totalprice")) \
        .withColumn("o_orderstatus", F.lit("R"))
    return conform(replace_keys_frame(o, new, "o_orderkey"))


query("replace_by_keys", sql=f"""
WITH new AS (SELECT l_orderkey AS o_orderkey, 'R' AS o_orderstatus, sum(l_extendedprice) AS o_totalprice
             FROM lineitem GROUP BY l_orderkey)
SELECT o_orderkey, o_orderstatus, {R('o_totalprice')} AS o_totalprice FROM (
  SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders WHERE o_orderkey NOT IN (SELECT o_orderkey FROM new)
  UNION ALL SELECT o_orderkey, o_orderstatus, o_totalprice FROM new)""")(_j3_spark)

# ----------------------------------------------------------------------------- J5


def _j5_spark(spark, d):
    ev = b.read(spark, d, "events").select("user_id", F.dayofmonth("ts").alias("day"))
    existing = ev.where(F.col("day") <= 15)
    incoming = ev.where(F.col("day") >= 10)
    return conform(append_conflicts(existing, incoming, ["user_id", "day"]))


query("append_only_conflicts", sql="""
WITH ev AS (SELECT user_id, CAST(day(ts) AS BIGINT) AS day FROM events),
ex AS (SELECT * FROM ev WHERE day <= 15), inc AS (SELECT * FROM ev WHERE day >= 10)
SELECT DISTINCT user_id, day, 'exists' AS reason FROM inc WHERE (user_id, day) IN (SELECT (user_id, day) FROM ex)
UNION ALL
SELECT user_id, day, 'duplicate' FROM inc GROUP BY user_id, day HAVING count(*) > 1""")(_j5_spark)

# ----------------------------------------------------------------------------- G1


def _g1_spark(spark, d):
    o = b.read(spark, d, "orders").select(F.col("o_orderkey").alias("key"), F.col("o_totalprice").alias("value"),
                                          F.lit("orders").alias("src"), F.lit(0).alias("line"))
    li = b.read(spark, d, "lineitem").select(
        F.col("l_orderkey").alias("key"), F.col("l_extendedprice").alias("value"), F.lit("lineitem").alias("src"),
        F.col("l_linenumber").alias("line"))
    return conform(merge_latest([o, li], "key", order=["line", "value"]).drop("line"))


query("keyed_merge", sql=f"""
WITH u AS (
  SELECT o_orderkey AS key, o_totalprice AS value, 'orders' AS src, 0 AS line, 0 AS prio FROM orders
  UNION ALL
  SELECT l_orderkey, l_extendedprice, 'lineitem', l_linenumber, 1 FROM lineitem)
SELECT key, {R('value')} AS value, src FROM (
  SELECT *, row_number() OVER (PARTITION BY key ORDER BY prio DESC, line DESC, value DESC) AS rn FROM u)
WHERE rn = 1""")(_g1_spark)

# ----------------------------------------------------------------------------- G3


def _g3_spark(spark, d):
    o = b.read(spark, d, "orders").select("o_custkey", month_index(F.col("o_orderdate")).alias("gameweek"))
    span = o.groupBy("o_custkey").agg(F.min("gameweek").alias("lo"), F.max("gameweek").alias("hi"))
    expected = span.select("o_custkey", F.explode(F.sequence("lo", "hi")).alias("gameweek"))
    return conform(missing_periods(o, "gameweek", expected, by=["o_custkey"]))


query("missing_partitions", sql=f"""
WITH o AS (SELECT o_custkey, {_MON.format(c='o_orderdate')} AS gameweek FROM orders),
exp AS (SELECT o_custkey, unnest(range(lo, hi + 1)) AS gameweek
        FROM (SELECT o_custkey, min(gameweek) AS lo, max(gameweek) AS hi FROM o GROUP BY o_custkey))
SELECT o_custkey, {B('gameweek')} AS gameweek FROM exp
WHERE (o_custkey, gameweek) NOT IN (SELECT (o_custkey, gameweek) FROM o)""")(_g3_spark)

# ----------------------------------------------------------------------------- G4
# expected: every customer's id in each of three tables; present: the ids that those tables hold, all their rows
_KEYED = {"labels": "doc_id", "part": "p_partkey", "orders": "o_custkey"}


def _g4_spark(spark, d):
    want = b.read(spark, d, "customer").select(F.explode(F.array(*[F.lit(t) for t in _KEYED])).alias("source"),
                                               F.col("c_custkey").alias("id"))
    have = union_all([b.read(spark, d, t).select(F.lit(t).alias("source"), F.col(c).alias("id")) for t, c in _KEYED.items()])
    return conform(diff_keys(want, have, ["source", "id"]))


query("missing_extra", sql="""
WITH want AS (SELECT unnest(['labels', 'part', 'orders']) AS source, c_custkey AS id FROM customer), have AS (
  SELECT 'labels' AS source, doc_id AS id FROM labels UNION ALL SELECT 'part', p_partkey FROM part
  UNION ALL SELECT 'orders', o_custkey FROM orders)
SELECT source, id, 'missing' AS side FROM (SELECT * FROM want EXCEPT SELECT * FROM have)
UNION ALL
SELECT source, id, 'extra' FROM (SELECT * FROM have EXCEPT SELECT * FROM want)""")(_g4_spark)

# ----------------------------------------------------------------------------- C4


def _c4_spark(spark, d):
    o = b.read(spark, d, "orders")
    ext = o.where(F.col("o_orderstatus") != "F").select(
        F.col("o_orderkey").alias("ext_id"), F.to_date("o_orderdate").alias("match_date"),
        F.col("o_custkey").alias("team"))
    fx = o.where(F.col("o_orderstatus") == "F").select(
        F.col("o_orderkey").alias("fixture_id"), F.to_date("o_orderdate").alias("fx_date"),
        F.col("o_custkey").alias("fx_team"))
    matched, unmatched = match_exactly_one(ext, fx, {"match_date": "fx_date", "team": "fx_team"}, "ext_id",
                                           ["fixture_id"])
    return conform(matched.select("ext_id", "fixture_id", F.lit("matched").alias("status"))
                   .unionByName(unmatched.select("ext_id", F.lit(-1).cast("long").alias("fixture_id"),
                                                 F.lit("unmatched").alias("status"))))


query("exact_match_join", sql="""
WITH ext AS (SELECT o_orderkey AS ext_id, CAST(o_orderdate AS DATE) AS d, o_custkey AS team FROM orders
             WHERE o_orderstatus <> 'F'),
fx AS (SELECT o_orderkey AS fixture_id, CAST(o_orderdate AS DATE) AS d, o_custkey AS team FROM orders
       WHERE o_orderstatus = 'F'),
c AS (SELECT ext.ext_id, count(fx.fixture_id) AS n, min(fx.fixture_id) AS fixture_id
      FROM ext LEFT JOIN fx ON ext.d = fx.d AND ext.team = fx.team GROUP BY ext.ext_id)
SELECT ext_id, CASE WHEN n = 1 THEN fixture_id ELSE -1 END AS fixture_id,
  CASE WHEN n = 1 THEN 'matched' ELSE 'unmatched' END AS status FROM c""")(_c4_spark)

# ----------------------------------------------------------------------------- C5
# Provider spellings -> canonical names (two literal maps).
PROVIDER_ALIASES = {f"Nation {i}": f"NATION_{i}" for i in range(15)}
SHORT_ALIASES = {"N3": "NATION_3", "N7": "NATION_7"}


def _c5_spark(spark, d):
    c = b.read(spark, d, "customer")
    seg, k = F.col("c_mktsegment"), F.col("c_nationkey").cast("string")
    raw = (F.when(seg == "BUILDING", F.concat(F.lit("Nation "), k))
           .when(seg == "MACHINERY", F.concat(F.lit("N"), k))
           .when(seg == "FURNITURE", F.concat(F.lit("Unknown "), k))
           .otherwise(F.concat(F.lit("NATION_"), k)))
    rows = c.select("c_custkey", raw.alias("raw_name"))
    nation = b.read(spark, d, "nation")
    ok, rej = resolve_names(rows, "raw_name", "nation_id", nation, "n_name", "n_nationkey",
                            alias_table(spark, PROVIDER_ALIASES), alias_table(spark, SHORT_ALIASES))
    return conform(ok.withColumn("status", F.lit("resolved"))
                   .unionByName(rej.withColumn("nation_id", F.lit(-1)).withColumn("status", F.lit("rejected"))))


def _c5_sql():
    a1 = " UNION ALL ".join(f"SELECT '{k}' AS alias, '{v}' AS canonical" for k, v in PROVIDER_ALIASES.items())
    a2 = " UNION ALL ".join(f"SELECT '{k}' AS alias, '{v}' AS canonical" for k, v in SHORT_ALIASES.items())
    return f"""
WITH a1 AS ({a1}), a2 AS ({a2}),
rows AS (SELECT c_custkey, CASE WHEN c_mktsegment = 'BUILDING' THEN 'Nation ' || CAST(c_nationkey AS VARCHAR)
  WHEN c_mktsegment = 'MACHINERY' THEN 'N' || CAST(c_nationkey AS VARCHAR)
  WHEN c_mktsegment = 'FURNITURE' THEN 'Unknown ' || CAST(c_nationkey AS VARCHAR)
  ELSE 'NATION_' || CAST(c_nationkey AS VARCHAR) END AS raw_name FROM customer),
r AS (SELECT rows.*, coalesce(a2.canonical, coalesce(a1.canonical, raw_name)) AS nm
      FROM rows LEFT JOIN a1 ON rows.raw_name = a1.alias
      LEFT JOIN a2 ON coalesce(a1.canonical, rows.raw_name) = a2.alias)
SELECT c_custkey, raw_name, {B('coalesce(n.n_nationkey, -1)')} AS nation_id,
  CASE WHEN n.n_nationkey IS NULL THEN 'rejected' ELSE 'resolved' END AS status
FROM r LEFT JOIN nation n ON r.nm = n.n_name"""


query("alias_resolution", sql=_c5_sql())(_c5_spark)

# ----------------------------------------------------------------------------- C6


def _c6_spark(spark, d):
    p = b.read(spark, d, "part")
    first = F.split("p_name", " ").getItem(0)
    second = F.split("p_name", " ").getItem(1)
    people = p.select("p_partkey", first.alias("first"), second.alias("second"), F.col("p_brand").alias("web"))
    variants = [F.concat_ws(" ", "first", "second"), F.concat_ws(" ", "second", "first"), F.col("web"),
                F.col("first"), F.col("second")]
    rows = people.select(F.col("p_partkey").alias("row_id"), F.concat_ws(" ", "second", "first").alias("lookup"))
    out = resolve_variants(rows, F.col("lookup"), people, "p_partkey", "p_partkey", variants, out="mapped_id")
    return conform(out)


query("name_variants", sql="""
WITH people AS (SELECT p_partkey, split_part(p_name, ' ', 1) AS first, split_part(p_name, ' ', 2) AS second,
                       p_brand AS web FROM part),
v AS (SELECT p_partkey, 0 AS pos, trim(first || ' ' || second) AS name FROM people
      UNION ALL SELECT p_partkey, 1, trim(second || ' ' || first) FROM people
      UNION ALL SELECT p_partkey, 2, trim(web) FROM people
      UNION ALL SELECT p_partkey, 3, trim(first) FROM people
      UNION ALL SELECT p_partkey, 4, trim(second) FROM people),
m AS (SELECT name, p_partkey AS mapped_id FROM (
        SELECT *, row_number() OVER (PARTITION BY name ORDER BY p_partkey, pos) AS rn FROM v
        WHERE name IS NOT NULL AND name <> '') WHERE rn = 1)
SELECT p.p_partkey AS row_id, p.second || ' ' || p.first AS lookup, m.mapped_id
FROM people p LEFT JOIN m ON p.second || ' ' || p.first = m.name""")(_c6_spark)

# ----------------------------------------------------------------------------- C2


def _c2_spark(spark, d):
    # every order, also those that are no fixture and so have no odds
    fx = b.read(spark, d, "orders").select(F.col("o_orderkey").alias("fixture_id"), F.col("o_custkey").alias("home_team_id"),
                                           month_index(F.col("o_orderdate")).alias("event"))
    od = b.odds(spark, d).select("fixture_id", "home_team_id", "B365H", "referee")
    j = left_join_suffix(fx, od, "fixture_id", "_odds")
    return conform(j.select("fixture_id", "home_team_id", "event", F.col("home_team_id_odds").isNotNull()
                            .alias("has_odds"), "B365H", "referee"))


query("left_join_suffix", sql=with_bindings(f"""
SELECT f.fixture_id, f.home_team_id, {B('f.event')} AS event, (o.home_team_id IS NOT NULL) AS has_odds,
  {R('o.B365H')} AS B365H, o.referee
FROM (SELECT o_orderkey AS fixture_id, o_custkey AS home_team_id, {_MON.format(c='o_orderdate')} AS event FROM orders) f
LEFT JOIN (SELECT fixture_id, home_team_id, B365H, referee FROM b_odds) o ON f.fixture_id = o.fixture_id""", "b_odds"))(_c2_spark)

# ----------------------------------------------------------------------------- C10


def _c10_spark(spark, d):
    od = b.odds(spark, d).select("fixture_id", "AvgCH")
    lk = b.read(spark, d, "orders").select(F.col("o_orderkey").alias("fixture_id"),
                                           (F.col("o_totalprice") / 70000.0 + 1.0).alias("AvgCH"))
    return conform(fill_nulls(od, lk, "fixture_id", "AvgCH"))


query("fill_nulls_from_lookup", sql=with_bindings(f"""
SELECT o.fixture_id, {R('coalesce(o.AvgCH, r.o_totalprice / 70000.0 + 1.0)')} AS AvgCH
FROM (SELECT fixture_id, AvgCH FROM b_odds) o LEFT JOIN orders r ON o.fixture_id = r.o_orderkey""", "b_odds"))(
    _c10_spark)

# ----------------------------------------------------------------------------- C11
# customers that never caused an event (as users), documents without a label
query("orphans", sql="""
SELECT 'customer' AS child, c_custkey AS id FROM customer c
WHERE NOT EXISTS (SELECT 1 FROM events e WHERE e.user_id = c.c_custkey)
UNION ALL SELECT 'document', doc_id FROM documents d WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)""")(
    lambda spark, d: conform(
        orphans(b.read(spark, d, "customer").select("c_custkey"), b.read(spark, d, "events"), "c_custkey", "user_id")
        .select(F.lit("customer").alias("child"), F.col("c_custkey").alias("id")).unionByName(
            orphans(b.read(spark, d, "documents").select("doc_id"),
                    b.read(spark, d, "labels").withColumnRenamed("doc_id", "l_doc"), "doc_id", "l_doc")
            .select(F.lit("document").alias("child"), F.col("doc_id").alias("id")))))

# ----------------------------------------------------------------------------- E3 / E4 / E6
query("latest_per_key", sql=f"""
SELECT user_id, event_id, ts, event_type, {R('value')} AS value FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events)
WHERE rn = 1""")(lambda spark, d: conform(latest_by(
    b.read(spark, d, "events").select("user_id", "event_id", "ts", "event_type", "value"), "user_id",
    ["ts", "event_id"])))

query("first_per_key", sql="""
SELECT conv_id, turn, role FROM (
  SELECT conv_id, turn, role, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS rn FROM conversations)
WHERE rn = 1""")(lambda spark, d: conform(first_by(
    b.read(spark, d, "conversations").select("conv_id", "turn", "role"), "conv_id", ["turn"])))

query("latest_partition", sql=with_bindings(f"""
SELECT fixture_id, {B('event')} AS event, home_team_id, away_team_id FROM b_fixtures
WHERE event = (SELECT max(event) FROM b_fixtures)""", "b_fixtures"))(lambda spark, d: conform(
    latest_partition(b.fixtures(spark, d).select("fixture_id", "event", "home_team_id", "away_team_id"), "event")))

# ----------------------------------------------------------------------------- E7
# Event types standing in for chips in the binding.
CHIP_OF_EVENT = {"signup": "wildcard", "error": "Free Hit"}


def _e7_spark(spark, d):
    ev = b.read(spark, d, "events").select("user_id", F.dayofmonth("ts").alias("event"), "event_type", "event_id")
    summary = ev.groupBy("user_id", "event").agg(
        F.count(F.when(F.col("event_type") == "purchase", 1)).alias("event_transfers"))
    chip = (F.when(F.col("event_type") == "signup", F.lit(CHIP_OF_EVENT["signup"]))
            .when(F.col("event_type") == "error", F.lit(CHIP_OF_EVENT["error"])))
    chips = first_by(ev.select("user_id", "event", "event_id", chip.alias("chip_used")), ["user_id", "event"],
                     ["event_id"]).select("user_id", "event", "chip_used")
    return conform(free_allowance(summary, chips, key="user_id"))


query("free_allowance", sql="""
WITH ev AS (SELECT user_id, day(ts) AS event, event_type, event_id FROM events),
s AS (SELECT user_id, event, count(CASE WHEN event_type = 'purchase' THEN 1 END) AS tr FROM ev GROUP BY ALL),
ch AS (SELECT user_id, event, CASE WHEN event_type = 'signup' THEN 'wildcard' WHEN event_type = 'error'
         THEN 'Free Hit' END AS chip FROM (
         SELECT *, row_number() OVER (PARTITION BY user_id, event ORDER BY event_id) AS rn FROM ev) WHERE rn = 1)
SELECT s.user_id, CAST(s.event AS BIGINT) AS event,
  CAST(CASE WHEN s.event <= 1 OR p.user_id IS NULL OR coalesce(lower(c.chip) IN ('wildcard', 'freehit', 'free hit'), FALSE)
       OR coalesce(p.tr <> 0, TRUE) THEN 1 ELSE 2 END AS BIGINT) AS free_transfers
FROM s LEFT JOIN s p ON p.user_id = s.user_id AND p.event + 1 = s.event
LEFT JOIN ch c ON c.user_id = s.user_id AND c.event + 1 = s.event""")(_e7_spark)

# ----------------------------------------------------------------------------- B5 / B6 / B8 / F2
query("per_unit_rates", sql=with_bindings(f"""
SELECT player_id, {R('coalesce(CASE WHEN minutes > 0 THEN total_points * 90.0 / minutes ELSE 0.0 END, 0.0)')}
    AS total_points_per90,
  {R(f"coalesce(CASE WHEN minutes > 0 THEN {NUM('form')} * 90.0 / minutes ELSE 0.0 END, 0.0)")} AS form_per90
FROM b_players WHERE minutes > 0""", "b_players"))(lambda spark, d: conform(
    per_unit_rates(b.players(spark, d), ["total_points", "form"])
    .select("player_id", "total_points_per90", "form_per90")))

query("range_filter", sql=with_bindings(f"""
SELECT fixture_id, {B('event')} AS event, home_team_id, away_team_id FROM b_fixtures WHERE event BETWEEN 30 AND 40""",
                                        "b_fixtures"))(lambda spark, d: conform(
    in_range(b.fixtures(spark, d), "event", 30, 40).select("fixture_id", "event", "home_team_id", "away_team_id")))

ACCENT_TERM = "Eoireeau"  # only the accent-folded text contains it (fallback branch)

query("accent_lookup", sql=f"""
WITH hits AS (SELECT count(*) AS n FROM documents WHERE regexp_matches(text, '(?i){ACCENT_TERM}'))
SELECT doc_id, lang FROM documents
WHERE CASE WHEN (SELECT n FROM hits) > 0 THEN regexp_matches(text, '(?i){ACCENT_TERM}')
           ELSE regexp_matches(strip_accents(lower(text)), '{ACCENT_TERM.lower()}') END""")(
    lambda spark, d: conform(name_lookup(b.read(spark, d, "documents"), "text", ACCENT_TERM).select("doc_id", "lang")))

query("topk", sql=f"""
SELECT o_orderkey, {R('o_totalprice')} AS o_totalprice FROM orders WHERE o_orderstatus = 'F'
ORDER BY o_totalprice DESC, o_orderkey LIMIT 10""")(lambda spark, d: conform(
    top_k(b.read(spark, d, "orders").where(F.col("o_orderstatus") == "F").select("o_orderkey", "o_totalprice"),
          [F.col("o_totalprice").desc(), F.col("o_orderkey")], 10)))

# ----------------------------------------------------------------------------- K1 / K2
query("current_period", sql=with_bindings("""
SELECT CAST(coalesce(min(CASE WHEN is_current THEN event_id END), 1) AS BIGINT) AS current,
  coalesce(min(CASE WHEN is_current THEN finished END), TRUE) AS finished,
  CAST(CASE WHEN coalesce(min(CASE WHEN is_current THEN finished END), TRUE)
       THEN coalesce(min(CASE WHEN is_current THEN event_id END), 1) + 1
       ELSE coalesce(min(CASE WHEN is_current THEN event_id END), 1) END AS BIGINT) AS target
FROM b_gameweeks""", "b_gameweeks"))(lambda spark, d: conform(target_period(current_period(b.gameweeks(spark, d)))))

# ----------------------------------------------------------------------------- A13 / B3 / B9 / D8 / L5
from ..operators.views import group_size_stats, legacy_players, scan  # noqa: E402
from ..quality import checks as _q  # noqa: E402

query("scan_filter", sql=f"""
SELECT l_orderkey, l_partkey, {R('l_quantity')} AS l_quantity FROM lineitem
WHERE l_returnflag = 'R' AND l_quantity >= 10 AND l_quantity <= 20""")(lambda spark, d: conform(scan(
    spark, f"{d}/lineitem.parquet", columns=["l_orderkey", "l_partkey", "l_quantity"],
    equals={"l_returnflag": "R"}, between={"l_quantity": (10, 20)})))

query("legacy_players_view", sql=with_bindings(f"""
SELECT player_id AS id, player_id AS mapped_player_id, web_name, team_id AS team, {B('position_id')} AS element_type,
  CASE position_id WHEN 1 THEN 'GKP' WHEN 2 THEN 'DEF' WHEN 3 THEN 'MID' WHEN 4 THEN 'FWD' END AS position,
  {R('now_cost / 10.0')} AS price,
  coalesce(CASE status WHEN 'a' THEN 'Available' WHEN 'i' THEN 'Injured' WHEN 's' THEN 'Suspended'
    WHEN 'u' THEN 'Unavailable' WHEN 'd' THEN 'Doubtful' WHEN 'n' THEN 'Not in squad' END, 'Unknown: ' || status)
    AS status_meaning
FROM b_players""", "b_players"))(lambda spark, d: conform(legacy_players(b.players(spark, d))))

query("group_sizes", sql=f"""
SELECT CAST(day AS BIGINT) AS day, CAST(min(n) AS BIGINT) AS min_size, CAST(max(n) AS BIGINT) AS max_size,
  {R('avg(n)')} AS avg_size, CAST(count(*) AS BIGINT) AS groups
FROM (SELECT day(ts) AS day, user_id, count(*) AS n FROM events GROUP BY ALL) GROUP BY day""")(
    lambda spark, d: conform(group_size_stats(
        b.read(spark, d, "events").withColumn("day", F.dayofmonth("ts")), ["user_id"], "day")))


def _fk_sql(table: str, col: str, src: str, parent: str, pcol: str) -> str:
    bad = f"(c.{col} IS NOT NULL AND p.{pcol} IS NULL)"
    return (f"SELECT '{table}' AS \"table\", 'foreign_key' AS \"check\", '{col}' AS \"column\", "
            f"CAST(coalesce(sum(CASE WHEN {bad} THEN 1 ELSE 0 END), 0) AS BIGINT) AS violations, "
            f"CAST(count(*) AS BIGINT) AS total, "
            f"CASE WHEN coalesce(sum(CASE WHEN {bad} THEN 1 ELSE 0 END), 0) = 0 THEN 'pass' ELSE 'fail' END AS status "
            f"FROM {src} c LEFT JOIN (SELECT DISTINCT {pcol} FROM {parent}) p ON c.{col} = p.{pcol}")


_FKS = [("lineitem", "l_orderkey", "lineitem", "orders", "o_orderkey"),
        ("lineitem", "l_partkey", "lineitem", "part", "p_partkey"),
        ("lineitem", "l_suppkey", "lineitem", "supplier", "s_suppkey"),
        ("orders", "o_custkey", "orders", "customer", "c_custkey"),
        ("labels", "doc_id", "labels", "documents", "doc_id"),
        ("documents", "doc_id", "documents", "labels", "doc_id"),
        ("customer", "c_custkey", "customer", "events", "user_id"),
        ("players", "team_id", "b_players", "b_teams", "team_id")]


def _fk_spark(spark, d, t=b):
    tabs = {"b_players": t.players(spark, d), "b_teams": t.teams(spark, d)}

    def table(n):
        return tabs[n] if n in tabs else b.read(spark, d, n)

    reps = [_q.check_fk(table(src), name, col, table(parent), pcol) for name, col, src, parent, pcol in _FKS]
    out = reps[0]
    for r in reps[1:]:
        out = out.unionByName(r)
    return conform(out)


query("dq_referential", sql=with_bindings(" UNION ALL ".join(_fk_sql(*f) for f in _FKS), "b_players", "b_teams"))(
    _fk_spark)

# ----------------------------------------------------------------------------- K4 / K6 / D2
from ..operators.periods import chip_history, choose_targets  # noqa: E402

query("backfill_targets", sql=f"""
WITH have AS (SELECT DISTINCT day(ts) AS period FROM events)
SELECT CAST(range AS BIGINT) AS period FROM range(1, {b.GAMEWEEK - 1} + 1)
WHERE range NOT IN (SELECT period FROM have)""")(lambda spark, d: conform(choose_targets(
    b.history(spark, d), "gameweek", b.GAMEWEEK - 1, mode="missing")))


def _chips_spark(spark, d):
    ev = b.read(spark, d, "events").select(
        F.col("user_id").alias("manager_id"), F.dayofmonth("ts").alias("event"), F.col("event_id").alias("position"),
        F.when(F.col("event_type") == "signup", F.lit("wildcard")).when(F.col("event_type") == "error",
                                                                        F.lit("freehit")).alias("chip_used"))
    stored = chip_history(ev.where(F.col("event") <= 10))
    return conform(chip_history(ev.where(F.col("event") >= 5), stored=stored))


query("chip_history", sql="""
WITH ev AS (SELECT user_id AS manager_id, day(ts) AS event, event_id AS position,
              CASE WHEN event_type = 'signup' THEN 'wildcard' WHEN event_type = 'error' THEN 'freehit' END AS chip_used
            FROM events),
firsts AS (SELECT manager_id, event, chip_used, src FROM (
  SELECT *, row_number() OVER (PARTITION BY src, manager_id, event ORDER BY position) AS rn FROM (
    SELECT *, 0 AS src FROM ev WHERE event <= 10 UNION ALL SELECT *, 1 AS src FROM ev WHERE event >= 5))
  WHERE rn = 1)
SELECT manager_id, CAST(event AS BIGINT) AS event, chip_used FROM (
  SELECT *, row_number() OVER (PARTITION BY manager_id, event ORDER BY src DESC) AS rn FROM firsts) WHERE rn = 1""")(
    _chips_spark)

query("key_stats", sql="""
SELECT 'lineitem' AS "table", CAST(count(*) AS BIGINT) AS "rows",
  CAST(count(DISTINCT (l_orderkey, l_linenumber)) AS BIGINT) AS distinct_keys FROM lineitem
UNION ALL SELECT 'orders', CAST(count(*) AS BIGINT), CAST(count(DISTINCT o_orderkey) AS BIGINT) FROM orders
UNION ALL SELECT 'events', CAST(count(*) AS BIGINT), CAST(count(DISTINCT (user_id, event_type)) AS BIGINT)
FROM events""")(lambda spark, d: conform(_q.key_stats({
    "lineitem": (b.read(spark, d, "lineitem"), ["l_orderkey", "l_linenumber"]),
    "orders": (b.read(spark, d, "orders"), ["o_orderkey"]),
    "events": (b.read(spark, d, "events"), ["user_id", "event_type"])})))

# ----------------------------------------------------------------------------- B11 / C3 / H10-H12 / A15
from ..functions.cols import age_text, season_code, season_short  # noqa: E402
from ..operators.filters import upcoming  # noqa: E402
from ..operators.joins import join_filter  # noqa: E402
from ..sources.imports import import_snapshots  # noqa: E402

query("upcoming_fixtures", sql=with_bindings(f"""
SELECT fixture_id, home_team_id, away_team_id FROM b_fixtures
WHERE event = {b.GAMEWEEK} AND NOT coalesce(finished, FALSE)""", "b_fixtures"))(lambda spark, d: conform(
    upcoming(b.fixtures(spark, d), "event", b.GAMEWEEK).select("fixture_id", "home_team_id", "away_team_id")))

query("odds_of_gameweek", sql=with_bindings(f"""
SELECT fixture_id, {R('B365H')} AS B365H FROM b_odds
WHERE fixture_id IN (SELECT fixture_id FROM b_fixtures WHERE event = {b.GAMEWEEK})""", "b_odds", "b_fixtures"))(
    lambda spark, d: conform(join_filter(b.odds(spark, d).select("fixture_id", "B365H"), b.fixtures(spark, d),
                                         "fixture_id", F.col("event") == b.GAMEWEEK)))


def _age_sql(sec: str) -> str:
    def unit(n: str, word: str) -> str:
        return (f"CAST({n} AS VARCHAR) || ' {word}' || CASE WHEN {n} <> 1 THEN 's' ELSE '' END || ' ago'")
    return (f"CASE WHEN {sec} IS NULL THEN 'Unknown' WHEN {sec} < 60 THEN 'Less than a minute ago' "
            f"WHEN {sec} < 3600 THEN {unit(f'CAST(floor({sec} / 60) AS BIGINT)', 'minute')} "
            f"WHEN {sec} < 86400 THEN {unit(f'CAST(floor({sec} / 3600) AS BIGINT)', 'hour')} "
            f"ELSE {unit(f'CAST(floor({sec} / 86400) AS BIGINT)', 'day')} END")


def _labels_spark(spark, d):
    o = b.read(spark, d, "orders")
    y = F.year("o_orderdate")
    season = F.concat(y.cast("string"), F.lit("-"), (y + 1).cast("string"))
    secs = (F.unix_seconds(F.to_timestamp_ntz(F.lit("1998-06-15 00:00:00")).cast("timestamp"))
            - F.unix_seconds(F.col("o_orderdate").cast("timestamp")))
    return conform(o.select("o_orderkey", season_short(season).alias("season"), season_code(season).alias("code"),
                            F.when(secs >= 0, age_text(secs)).otherwise(F.lit("in the future")).alias("age")))


query("season_labels", sql=f"""
SELECT o_orderkey, CAST(year(o_orderdate) AS VARCHAR) || '-' || substr(CAST(year(o_orderdate) + 1 AS VARCHAR), 3, 2)
    AS season,
  substr(CAST(year(o_orderdate) AS VARCHAR), 3, 2) || substr(CAST(year(o_orderdate) + 1 AS VARCHAR), 3, 2) AS code,
  CASE WHEN secs >= 0 THEN {_age_sql('secs')} ELSE 'in the future' END AS age
FROM (SELECT *, epoch(TIMESTAMP '1998-06-15 00:00:00') - epoch(o_orderdate) AS secs FROM orders)""")(_labels_spark)


def _import_spark(spark, d):
    p = b.players(spark, d).select(
        "player_id", "status", "now_cost",
        F.when(F.col("form").isNull() | (F.col("form") == "n/a"), F.lit("nan")).otherwise(F.col("form")).alias("form"),
        F.when(F.col("position_id") == 5, F.lit("nan")).otherwise(F.lit("fit")).alias("news"))
    out = import_snapshots(p, 1, 6, AS_OF_TS)
    return conform(out.select("player_id", "gameweek", "status", "news", "form", "now_cost", "is_backfilled"))


AS_OF_TS = "1998-06-15 00:00:00"

query("snapshot_import", sql=with_bindings("""
SELECT player_id, CAST(g.range AS BIGINT) AS gameweek, coalesce(status, 'a') AS status,
  CASE WHEN position_id = 5 THEN '' ELSE 'fit' END AS news,
  CASE WHEN form IS NULL OR form = 'n/a' THEN '0.0' ELSE form END AS form,
  CAST(now_cost AS BIGINT) AS now_cost, TRUE AS is_backfilled
FROM b_players, range(1, 7) g""", "b_players"))(_import_spark)

# ----------------------------------------------------------------------------- B2 / B10 / B12 / F3 / G2 / K3 / J8
from ..operators.filters import by_id, in_id_set, project_available  # noqa: E402
from ..operators.merge import union_all  # noqa: E402
from ..operators.periods import pending  # noqa: E402
from ..operators.views import preview  # noqa: E402
from ..sources.sinks import normalise_timestamps  # noqa: E402

query("project_available", sql=with_bindings(f"""
SELECT player_id, {R(NUM('form'))} AS form, TRY_CAST(now_cost AS BIGINT) AS now_cost, web_name FROM b_players""",
                                             "b_players"))(lambda spark, d: conform(project_available(
    b.players(spark, d), [("player_id", None), ("form", "num"), ("now_cost", "bigint"), ("absent", "num"),
                          ("web_name", None)])))

query("in_id_set", sql="""
SELECT o_orderkey, o_custkey FROM orders WHERE o_custkey IN (SELECT user_id FROM events)""")(
    lambda spark, d: conform(in_id_set(
        b.read(spark, d, "orders").select("o_orderkey", "o_custkey"),
        b.read(spark, d, "events").select(F.col("user_id").alias("o_custkey")), "o_custkey")))

query("by_id", sql=f"""
SELECT l_orderkey, l_partkey, {R('l_quantity')} AS l_quantity FROM lineitem WHERE l_suppkey = 3""")(
    lambda spark, d: conform(by_id(b.read(spark, d, "lineitem"), "l_suppkey", 3)
                             .select("l_orderkey", "l_partkey", "l_quantity")))

query("preview", sql=f"""
SELECT p_partkey, {R('p_retailprice')} AS p_retailprice FROM part ORDER BY p_retailprice DESC, p_partkey LIMIT 5""")(
    lambda spark, d: conform(preview(b.read(spark, d, "part").select("p_partkey", "p_retailprice"),
                                     [F.col("p_retailprice").desc(), F.col("p_partkey")])))

query("union_frames", sql=f"""
SELECT c_custkey AS id, c_mktsegment AS segment, CAST(NULL AS DOUBLE) AS size FROM customer
UNION ALL SELECT p_partkey, NULL, CAST(p_size AS DOUBLE) FROM part
UNION ALL SELECT s_suppkey, NULL, NULL FROM supplier""")(lambda spark, d: conform(union_all([
    b.read(spark, d, "customer").select(F.col("c_custkey").alias("id"), F.col("c_mktsegment").alias("segment")),
    b.read(spark, d, "part").select(F.col("p_partkey").alias("id"), F.col("p_size").cast("double").alias("size")),
    b.read(spark, d, "supplier").select(F.col("s_suppkey").alias("id"))])))

query("pending_targets", sql="""
SELECT DISTINCT c_custkey AS user_id, CAST(d.range AS BIGINT) AS day FROM customer, range(1, 4) d
WHERE (c_custkey, d.range) NOT IN (SELECT (user_id, day(ts)) FROM events)""")(lambda spark, d: conform(pending(
    b.read(spark, d, "customer").select(F.col("c_custkey").alias("user_id"),
                                        F.explode(F.array(F.lit(1), F.lit(2), F.lit(3))).alias("day")),
    b.read(spark, d, "events").select("user_id", F.dayofmonth("ts").alias("day")), ["user_id", "day"])))

query("normalise_timestamps", sql="""
SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN o_orderdate END AS at FROM orders""")(
    lambda spark, d: conform(normalise_timestamps(
        b.read(spark, d, "orders").select("o_orderkey", F.when(
            F.col("o_orderstatus") == "F", F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss")).otherwise(
                F.lit("to be fixed")).alias("at")), ["at"])))
