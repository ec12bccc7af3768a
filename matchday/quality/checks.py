"""Declarative data-quality checks and catalog views.

Every check returns a *report* DataFrame with the fixed schema
``(table, check, column, violations, total, status)``; reports union
together and summarise (L14). Row-level checks of one table compile into a
single aggregate pass (``validate``): one scan however many rules.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

REPORT_COLS = ["table", "check", "column", "violations", "total", "status"]


@dataclass(frozen=True)
class Rule:
    """A row-level rule: ``bad`` is true on violating rows (NULL = fine)."""

    check: str
    column: str
    bad: Column
    severity: str = "fail"


# ------------------------------------------------------------------ rule builders (L2/L3)
def not_null(c: str) -> Rule:
    return Rule("not_null", c, F.col(c).isNull())


def between(c: str, lo=None, hi=None) -> Rule:
    x = F.col(c)
    bad = F.lit(False)
    if lo is not None:
        bad = bad | (x < F.lit(lo))
    if hi is not None:
        bad = bad | (x > F.lit(hi))
    return Rule(f"range[{lo},{hi}]", c, bad)


def isin(c: str, values: Sequence) -> Rule:
    return Rule("isin", c, ~F.col(c).isin(*values))


def length_between(c: str, lo: int | None = None, hi: int | None = None) -> Rule:
    n = F.length(F.col(c))
    bad = F.lit(False)
    if lo is not None:
        bad = bad | (n < lo)
    if hi is not None:
        bad = bad | (n > hi)
    return Rule(f"length[{lo},{hi}]", c, bad)


def coercible(c: str, to: str) -> Rule:
    """The value parses as ``to`` (ANSI-safe ``try_cast``)."""
    return Rule(f"coerce:{to}", c, F.col(c).isNotNull() & F.col(c).try_cast(to).isNull())


def predicate(name: str, ok: Column, column: str = "*", severity: str = "fail") -> Rule:
    """A business rule given as the condition every row must satisfy."""
    return Rule(name, column, ~F.coalesce(ok, F.lit(True)), severity)


def _status(viol: Column, severity: Column | str = "fail") -> Column:
    sev = F.lit(severity) if isinstance(severity, str) else severity
    return F.when(viol == 0, F.lit("pass")).otherwise(sev)


def _report(df: DataFrame) -> DataFrame:
    return df.select(F.col("table").cast("string"), F.col("check").cast("string"), F.col("column").cast("string"),
                     F.col("violations").cast("long"), F.col("total").cast("long"), F.col("status").cast("string"))


# --------------------------------------------------------------------------- L1
def validate(df: DataFrame, table: str, rules: Sequence[Rule]) -> DataFrame:
    """All row rules of one table in one aggregate pass (lazy: every rule is
    evaluated, none short-circuits)."""
    aggs = [F.count(F.lit(1)).alias("__total")]
    aggs += [F.sum(F.when(F.coalesce(r.bad, F.lit(False)), 1).otherwise(0)).alias(f"__r{i}")
             for i, r in enumerate(rules)]
    one = df.agg(*aggs)
    structs = [F.struct(F.lit(table).alias("table"), F.lit(r.check).alias("check"), F.lit(r.column).alias("column"),
                        F.coalesce(F.col(f"__r{i}"), F.lit(0)).cast("long").alias("violations"),
                        F.col("__total").alias("total"), F.lit(r.severity).alias("severity"))
               for i, r in enumerate(rules)]
    out = one.select(F.inline(F.array(*structs)))
    return _report(out.withColumn("status", _status(F.col("violations"), F.col("severity"))))


def rejects(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Rows violating at least one rule, with the list of failed checks."""
    failed = F.filter(F.array(*[F.when(F.coalesce(r.bad, F.lit(False)), F.lit(f"{r.check}:{r.column}"))
                                for r in rules]), lambda x: x.isNotNull())
    return df.withColumn("failed_checks", failed).where(F.size("failed_checks") > 0)


# --------------------------------------------------------------------------- L4
def check_unique(df: DataFrame, table: str, key: Sequence[str]) -> DataFrame:
    """Surplus rows over a key (count - distinct keys), one report row."""
    per = df.groupBy(*key).agg(F.count(F.lit(1)).alias("n"))
    one = per.agg(F.sum(F.col("n") - 1).alias("violations"), F.sum("n").alias("total"))
    return _report(one.select(F.lit(table).alias("table"), F.lit("unique").alias("check"),
                              F.lit(",".join(key)).alias("column"),
                              F.coalesce(F.col("violations"), F.lit(0)).alias("violations"),
                              F.coalesce(F.col("total"), F.lit(0)).alias("total"),
                              _status(F.coalesce(F.col("violations"), F.lit(0))).alias("status")))


# --------------------------------------------------------------------------- L5
def check_fk(child: DataFrame, table: str, child_key: str, parent: DataFrame, parent_key: str) -> DataFrame:
    """Child rows whose non-null key has no parent (anti join)."""
    p = parent.select(F.col(parent_key).alias("__pk")).distinct()
    flagged = child.select(F.col(child_key).alias("__ck")).join(p, F.col("__ck") == F.col("__pk"), "left")
    one = flagged.agg(F.sum(F.when(F.col("__ck").isNotNull() & F.col("__pk").isNull(), 1).otherwise(0))
                      .alias("violations"), F.count(F.lit(1)).alias("total"))
    return _report(one.select(F.lit(table).alias("table"), F.lit("foreign_key").alias("check"),
                              F.lit(child_key).alias("column"), F.coalesce("violations", F.lit(0)).alias("violations"),
                              "total", _status(F.coalesce("violations", F.lit(0))).alias("status")))


# --------------------------------------------------------------------------- L6 (group rules)
def check_group(df: DataFrame, table: str, name: str, key: Sequence[str], ok: Column) -> DataFrame:
    """Groups violating an aggregate predicate (e.g. count(*) == 15)."""
    g = df.groupBy(*key).agg(F.coalesce(ok, F.lit(False)).alias("__ok"))
    one = g.agg(F.sum(F.when(~F.col("__ok"), 1).otherwise(0)).alias("violations"), F.count(F.lit(1)).alias("total"))
    return _report(one.select(F.lit(table).alias("table"), F.lit(name).alias("check"),
                              F.lit(",".join(key) or "*").alias("column"),
                              F.coalesce("violations", F.lit(0)).alias("violations"), "total",
                              _status(F.coalesce("violations", F.lit(0))).alias("status")))


def check_exactly(df: DataFrame, table: str, name: str, cond: Column, n: int = 1) -> DataFrame:
    """Exactly ``n`` rows satisfy ``cond`` (e.g. one current gameweek)."""
    one = df.agg(F.sum(F.when(F.coalesce(cond, F.lit(False)), 1).otherwise(0)).alias("__n"),
                 F.count(F.lit(1)).alias("total"))
    viol = F.abs(F.coalesce(F.col("__n"), F.lit(0)) - n)
    return _report(one.select(F.lit(table).alias("table"), F.lit(name).alias("check"), F.lit("*").alias("column"),
                              viol.alias("violations"), "total", _status(viol).alias("status")))


# --------------------------------------------------------------------------- L7
def reconcile(detail: DataFrame, key: str, measure: Column, totals: DataFrame, total_col: str, tol: float) -> DataFrame:
    """Per key: sum of ``measure`` in ``detail`` vs the stored total; rows
    whose absolute difference exceeds ``tol`` (missing detail counts as 0)."""
    s = detail.groupBy(key).agg(F.sum(measure).alias("detail_sum"))
    j = totals.select(key, F.col(total_col).alias("stored_total")).join(s, key, "left")
    diff = F.col("stored_total") - F.coalesce(F.col("detail_sum"), F.lit(0.0))
    return j.withColumn("difference", diff).where(F.abs(diff) > tol)


def check_reconciled(detail: DataFrame, table: str, key: str, measure: Column, totals: DataFrame, total_col: str,
                     tol: float) -> DataFrame:
    """L7 as a report row: keys whose detail does not add up to the stored total."""
    off = reconcile(detail, key, measure, totals, total_col, tol).agg(F.count(F.lit(1)).alias("violations"))
    one = (off.withColumn("__one", F.lit(1))
           .join(F.broadcast(totals.agg(F.count(F.lit(1)).alias("total")).withColumn("__one", F.lit(1))), "__one"))
    return _report(one.select(F.lit(table).alias("table"), F.lit("reconciles").alias("check"),
                              F.lit(total_col).alias("column"), "violations", "total",
                              _status(F.col("violations")).alias("status")))


def check_complete(df: DataFrame, table: str, good: float = 90.0, fair: float = 70.0) -> DataFrame:
    """L11 as report rows: null cells per column; GOOD passes, FAIR warns, POOR fails."""
    c = completeness(df, table, good, fair)
    status = F.when(F.col("grade") == "GOOD", "pass").when(F.col("grade") == "FAIR", "warn").otherwise("fail")
    return _report(c.select("table", F.lit("completeness").alias("check"), "column",
                            F.col("null_cells").alias("violations"), "total", status.alias("status")))


def check_periods(tables: Mapping[str, tuple[DataFrame, str]], expected_upto: DataFrame | int) -> DataFrame:
    """L12 as report rows: periods missing or beside the expected ones, per table."""
    spark = next(iter(tables.values()))[0].sparkSession
    bad = period_completeness(tables, expected_upto).groupBy("table").agg(F.count(F.lit(1)).alias("n"))
    names = spark.createDataFrame([(n, c) for n, (_, c) in tables.items()], "table string, column string")
    n = F.coalesce(F.col("n"), F.lit(0))
    return _report(names.join(bad, "table", "left").select(
        "table", F.lit("periods").alias("check"), "column", n.alias("violations"), n.alias("total"),
        _status(n).alias("status")))


# --------------------------------------------------------------------------- L8
def check_formula(df: DataFrame, table: str, name: str, expected: Column, actual: Column, tol: float) -> DataFrame:
    return validate(df, table, [Rule(name, name, F.abs(expected - actual) > tol)])


# --------------------------------------------------------------------------- L9
def check_monotonic(df: DataFrame, table: str, period: str, ts: str, now=None) -> DataFrame:
    """Latest ``ts`` per period never decreases with the period (all
    consecutive pairs), and (if ``now`` given) no ``ts`` is in the future."""
    # one row per period; each meets the one before by an equi-join on its rank's place in the sorted list of periods
    per = df.groupBy(period).agg(F.max(ts).alias("__mx"))
    listed = per.agg(F.sort_array(F.collect_list(F.struct(F.col(period).alias("p"), F.col("__mx").alias("m")))).alias("__l"))
    pairs = listed.select(F.explode(F.when(F.size("__l") > 0, F.transform(F.sequence(F.lit(1), F.size("__l")), lambda i: F.struct(
        F.element_at("__l", i)["m"].alias("m"), F.when(i > 1, F.try_element_at("__l", i - 1)["m"]).alias("before"))))).alias("e"))
    one = pairs.agg(F.sum(F.when(F.col("e.m") < F.col("e.before"), 1).otherwise(0)).alias("violations"),
                    F.count(F.lit(1)).alias("total"))
    rep = one.select(F.lit(table).alias("table"), F.lit("monotonic").alias("check"), F.lit(ts).alias("column"),
                     F.coalesce("violations", F.lit(0)).alias("violations"), "total",
                     _status(F.coalesce("violations", F.lit(0))).alias("status"))
    if now is not None:
        fut = validate(df, table, [Rule("not_future", ts, F.col(ts) > _ts(now))])
        return _report(rep).unionByName(fut)
    return _report(rep)


def _ts(now) -> Column:
    if isinstance(now, Column):
        return now
    if isinstance(now, _dt.datetime):
        now = now.strftime("%Y-%m-%d %H:%M:%S")
    return F.to_timestamp_ntz(F.lit(str(now)))


# --------------------------------------------------------------------------- L10 / D7 / M2
def latest_ts(tables: Mapping[str, tuple[DataFrame, str]]) -> DataFrame:
    """(table, latest) — the max timestamp of each table, one union."""
    parts = [df.agg(F.max(F.col(c).cast("timestamp_ntz")).alias("latest")).select(F.lit(name).alias("table"), "latest")
             for name, (df, c) in tables.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def _age_hours(latest: Column, now) -> Column:
    return (F.unix_micros(_ts(now).cast("timestamp")) - F.unix_micros(latest.cast("timestamp"))) / 3.6e9


def check_fresh(tables: Mapping[str, tuple[DataFrame, str]], now, thresholds: Mapping[str, tuple[float, float]],
                default: tuple[float, float] = (24.0, 168.0)) -> DataFrame:
    """Freshness per table: pass / warn (older than warn h) / fail."""
    lt = latest_ts(tables)
    th = F.create_map(*[x for k, (w, f) in thresholds.items() for x in (F.lit(k), F.array(F.lit(w), F.lit(f)))]) \
        if thresholds else None
    warn = F.coalesce(F.element_at(th, F.col("table"))[0], F.lit(default[0])) if th is not None else F.lit(default[0])
    fail = F.coalesce(F.element_at(th, F.col("table"))[1], F.lit(default[1])) if th is not None else F.lit(default[1])
    age = _age_hours(F.col("latest"), now)
    status = (F.when(F.col("latest").isNull(), F.lit("fail")).when(age > fail, F.lit("fail"))
              .when(age > warn, F.lit("warn")).otherwise(F.lit("pass")))
    return _report(lt.select("table", F.lit("freshness").alias("check"), F.lit("*").alias("column"),
                             F.when(status == "pass", 0).otherwise(1).alias("violations"), F.lit(1).alias("total"),
                             status.alias("status")))


def freshness(tables: Mapping[str, tuple[DataFrame, str]], now) -> DataFrame:
    """M2: per table latest timestamp, age in hours and status
    (<=1 very_fresh, <=6 fresh, <=24 stale, else very_stale)."""
    from ..functions.cols import age_bucket
    lt = latest_ts(tables)
    age = F.round(_age_hours(F.col("latest"), now), 2)
    return lt.select("table", "latest", age.alias("age_hours"), age_bucket(age).alias("status"))


def freshness_overall(tables: Mapping[str, tuple[DataFrame, str]], now) -> DataFrame:
    """A row per table and one for all (``table`` = 'ALL'): oldest and newest timestamp, rows with
    one, age of the newest in hours, status. One rollup over the union of the timestamp columns."""
    from ..functions.cols import age_bucket
    parts = [df.select(F.lit(name).alias("table"), F.col(c).cast("timestamp_ntz").alias("__ts"))
             for name, (df, c) in tables.items()]
    rows = parts[0]
    for p in parts[1:]:
        rows = rows.unionByName(p)
    rolled = rows.rollup("table").agg(F.grouping("table").alias("__all"), F.min("__ts").alias("oldest"),
                                      F.max("__ts").alias("newest"), F.count("__ts").alias("stamped"))
    age = F.round(_age_hours(F.col("newest"), now), 2)
    name = F.when(F.col("__all") == 1, "ALL").otherwise(F.col("table"))
    return rolled.select(name.alias("table"), "oldest", "newest", "stamped", age.alias("age_hours"), age_bucket(age).alias("status"))


# --------------------------------------------------------------------------- L6 (picks and performance)
def check_picks(picks: DataFrame, table: str = "raw_my_picks", key: Sequence[str] = ("manager_id", "event"),
                size: int = 15) -> DataFrame:
    """Every squad has ``size`` picks, one captain and one vice-captain, and no player twice: one aggregate."""
    one_each = [("picks", F.count(F.lit(1)) == size), ("one_captain", F.count_if(F.col("is_captain")) == 1),
                ("one_vice_captain", F.count_if(F.col("is_vice_captain")) == 1),
                ("no_player_twice", F.count_distinct("player_id") == F.count("player_id"))]
    squads = picks.groupBy(*key).agg(*[F.coalesce(ok, F.lit(False)).alias(n) for n, ok in one_each])
    return validate(squads, table, [predicate(n, F.col(n), ",".join(key)) for n, _ in one_each])


def performance_rules() -> list[Rule]:
    """Points not below -10, minutes of a match, no negative counts of goals and assists."""
    return [between("total_points", -10, None), between("minutes", 0, 120), between("goals_scored", 0, None),
            between("assists", 0, None)]


def check_finished_have_stats(events: DataFrame, performance: DataFrame, table: str = "raw_events_bootstrap",
                              event_col: str = "event_id", period_col: str = "gameweek") -> DataFrame:
    """A finished gameweek has performance rows (a semi join on the distinct gameweeks)."""
    played = performance.select(F.col(period_col).alias("__gw")).distinct()
    done = events.where(F.coalesce(F.col("finished"), F.lit(False)))
    flagged = done.join(played, F.col(event_col) == F.col("__gw"), "left").select(F.col("__gw").isNull().alias("__lacks"))
    return validate(flagged, table, [Rule("finished_has_stats", event_col, F.col("__lacks"))])


# --------------------------------------------------------------------------- L11 / D9
def completeness(df: DataFrame, table: str, good: float = 90.0, fair: float = 70.0) -> DataFrame:
    """Per column: null cells, completeness %, GOOD / FAIR / POOR (one pass)."""
    cols = df.columns
    one = df.agg(F.count(F.lit(1)).alias("__n"),
                 *[F.sum(F.when(F.col(f"`{c}`").isNull(), 1).otherwise(0)).alias(f"__c{i}") for i, c in enumerate(cols)])
    rows = one.select(F.inline(F.array(*[
        F.struct(F.lit(table).alias("table"), F.lit(c).alias("column"),
                 F.coalesce(F.col(f"__c{i}"), F.lit(0)).cast("long").alias("null_cells"),
                 F.col("__n").cast("long").alias("total")) for i, c in enumerate(cols)])))
    pct = F.when(F.col("total") > 0, (1 - F.col("null_cells") / F.col("total")) * 100.0).otherwise(F.lit(100.0))
    return rows.select("table", "column", "null_cells", "total", pct.alias("completeness_pct"),
                       F.when(pct >= good, "GOOD").when(pct >= fair, "FAIR").otherwise("POOR").alias("grade"))


# --------------------------------------------------------------------------- L12
def period_completeness(tables: Mapping[str, tuple[DataFrame, str]], expected_upto: DataFrame | int) -> DataFrame:
    """Per table: expected periods 1..upto that are missing, and every period present outside
    them ('future' beyond upto+1, else 'extra'), as (table, period, issue).

    ``expected_upto`` is a number or a one-row frame with a column ``upto`` (e.g. the current period).
    """
    parts = []
    for name, (df, col) in tables.items():
        parts.append(df.select(F.lit(name).alias("table"), F.col(col).cast("int").alias("period")).distinct())
    present = parts[0]
    for p in parts[1:]:
        present = present.unionByName(p)
    spark = present.sparkSession
    if isinstance(expected_upto, DataFrame):
        upto = expected_upto.select(F.col("upto").cast("int").alias("upto"))
    else:
        upto = spark.createDataFrame([(int(expected_upto),)], "upto int")
    one = upto.withColumn("__one", F.lit(1))
    names = spark.createDataFrame([(n,) for n in tables], "table string").withColumn("__one", F.lit(1))
    exp = (names.join(F.broadcast(one), "__one").where(F.col("upto") >= 1)  # one-row frame
           .select("table", F.explode(F.sequence(F.lit(1), F.col("upto"))).alias("period")))
    missing = exp.join(present, ["table", "period"], "left_anti").withColumn("issue", F.lit("missing"))
    beside = (present.withColumn("__one", F.lit(1)).join(F.broadcast(one), "__one")  # one-row frame
              .where((F.col("period") < 1) | (F.col("period") > F.col("upto")))
              .select("table", "period", F.when(F.col("period") > F.col("upto") + 1, "future").otherwise("extra").alias("issue")))
    return missing.unionByName(beside)


# --------------------------------------------------------------------------- L13
def sanity(tables: Mapping[str, DataFrame], expected_rows: Mapping[str, int] | None = None,
           expected_cols: Mapping[str, int] | None = None, required: Sequence[str] = (),
           known: Sequence[str] | None = None) -> DataFrame:
    """Table-level checks: non-empty, exact expected row counts (a table that is
    absent fails them), columns missing from the expected count (schema metadata), required tables present and (with ``known``)
    unexpected table names flagged as warnings."""
    spark = next(iter(tables.values())).sparkSession
    reps = []
    for name, df in tables.items():
        n = df.agg(F.count(F.lit(1)).alias("total"))
        reps.append(n.select(F.lit(name).alias("table"), F.lit("non_empty").alias("check"), F.lit("*").alias("column"),
                             F.when(F.col("total") == 0, 1).otherwise(0).alias("violations"), "total",
                             F.when(F.col("total") == 0, "fail").otherwise("pass").alias("status")))
        if expected_rows and name in expected_rows:
            want = expected_rows[name]
            reps.append(n.select(F.lit(name).alias("table"), F.lit(f"row_count={want}").alias("check"),
                                 F.lit("*").alias("column"), F.abs(F.col("total") - want).alias("violations"), "total",
                                 F.when(F.col("total") == want, "pass").otherwise("fail").alias("status")))
    meta = []
    for name, want in (expected_cols or {}).items():
        if name in tables:
            have = len(tables[name].columns)
            meta.append((name, f"column_count={want}", "*", max(want - have, 0), have, "pass" if have >= want else "warn"))
    for name, want in (expected_rows or {}).items():
        if name not in tables:
            meta.append((name, f"row_count={want}", "*", want, 0, "fail"))
    for name in required:
        if name not in tables:
            meta.append((name, "required_table", "*", 1, 0, "fail"))
    for name in tables:
        if known is not None and name not in known:
            meta.append((name, "unexpected_table", "*", 1, 0, "warn"))
    out = reps[0]
    for r in reps[1:]:
        out = out.unionByName(r)
    out = _report(out)
    if meta:
        out = out.unionByName(_report(spark.createDataFrame(meta, ",".join(f"{c} string" if c not in ("violations", "total") else f"{c} long" for c in REPORT_COLS))))
    return out


# --------------------------------------------------------------------------- L14
def summarise(reports: Sequence[DataFrame]) -> DataFrame:
    """One row: checks, passed, warned, failed, success rate (%)."""
    u = reports[0]
    for r in reports[1:]:
        u = u.unionByName(r)
    return u.agg(F.count(F.lit(1)).alias("checks"),
                 F.sum(F.when(F.col("status") == "pass", 1).otherwise(0)).alias("passed"),
                 F.sum(F.when(F.col("status") == "warn", 1).otherwise(0)).alias("warned"),
                 F.sum(F.when(F.col("status") == "fail", 1).otherwise(0)).alias("failed")) \
        .withColumn("success_rate", F.round(F.col("passed") / F.col("checks") * 100.0, 2))


# --------------------------------------------------------------------------- M1
def table_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    parts = [df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(n).alias("table"), "rows") for n, df in tables.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


# --------------------------------------------------------------------------- D2
def key_stats(tables: Mapping[str, tuple[DataFrame, Sequence[str]]]) -> DataFrame:
    """Per table: rows and distinct keys (count distinct of the key tuple)."""
    parts = [df.agg(F.count(F.lit(1)).alias("rows"), F.count_distinct(*[F.col(k) for k in key]).alias("distinct_keys"))
             .select(F.lit(name).alias("table"), "rows", "distinct_keys") for name, (df, key) in tables.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
