"""Flattening of landed provider JSON into raw tables (A1-A10).

Input is a DataFrame with one parsed document per row (``spark.read.json``
of landed files, or ``from_json`` over a text column); sections are arrays
of structs and become rows with ``inline`` (one pass, no per-row Python).
Nested fields that the raw tables keep as JSON text go through ``to_json``.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T




def _ts(as_of) -> Column:
    from ..plans.features import ts_lit
    return ts_lit(as_of)


def parse_docs(df: DataFrame, col: str, schema: T.StructType | str, keep: Sequence[str] = ()) -> DataFrame:
    """Parse a JSON text column into a struct column ``doc`` (``keep``
    columns carried along); unparsable documents become NULL and are dropped.

    The parsed column comes out of a one-row explode: filters on its fields stay above it, where
    a projected one would be parsed again by every filter that the optimizer moves below."""
    once = F.explode_outer(F.array(F.from_json(F.col(col), schema)))
    return df.select(*keep, once.alias("doc")).where(F.col("doc").isNotNull())


def _fill(df: DataFrame, keep_null: Sequence[str], skip: Sequence[str]) -> DataFrame:
    """Numeric NULL -> 0 (except ``keep_null``), string NULL -> ''."""
    out = {}
    for f in df.schema.fields:
        if f.name in skip or f.name in keep_null:
            continue
        if isinstance(f.dataType, T.NumericType):
            out[f.name] = F.coalesce(F.col(f"`{f.name}`"), F.lit(0).cast(f.dataType))
        elif isinstance(f.dataType, T.StringType):
            out[f.name] = F.coalesce(F.col(f"`{f.name}`"), F.lit(""))
    return df.withColumns(out) if out else df


def flatten_section(docs: DataFrame, path: str, aliases: Mapping[str, str] | None = None,
                    json_cols: Mapping[str, str] | None = None, fill: bool = True,
                    keep_null: Sequence[str] = (), ts_cols: Sequence[str] = (), as_of=None,
                    renames: Mapping[str, str] | None = None) -> DataFrame:
    """Rows of the array-of-structs at ``path`` of each document.

    * ``aliases``  new column -> existing column (both kept, like id/player_id)
    * ``renames``  existing column -> new name (old name dropped)
    * ``json_cols`` column -> empty default (``'{}'`` or ``'[]'``): nested values
      stored as JSON text; NULL/missing becomes the default of its true shape
    * ``fill``     numeric NULL -> 0 except ``keep_null``; string NULL -> ''
    * ``ts_cols``  parsed leniently to timestamps (unparsable -> NULL)
    """
    rows = docs.select(F.inline(F.col(path)))
    if json_cols:
        rows = rows.withColumns({c: F.coalesce(F.to_json(F.col(c)), F.lit(d)) if not isinstance(
            rows.schema[c].dataType, T.StringType) else F.coalesce(F.col(c), F.lit(d))
            for c, d in json_cols.items() if c in rows.columns})
    if renames:
        rows = rows.withColumnsRenamed({k: v for k, v in renames.items() if k in rows.columns})
    if aliases:
        rows = rows.withColumns({new: F.col(old) for new, old in aliases.items() if old in rows.columns})
    if fill:
        rows = _fill(rows, keep_null, skip=list((json_cols or {}).keys()) + list(ts_cols))
    if ts_cols:
        rows = rows.withColumns({c: F.try_to_timestamp(F.col(c).cast("string")).cast("timestamp_ntz")
                                 for c in ts_cols if c in rows.columns})
    if as_of is not None:
        rows = rows.withColumn("as_of_utc", _ts(as_of))
    return rows


# Per-section layout of the bootstrap document.
BOOTSTRAP_SECTIONS = {
    "raw_players_bootstrap": dict(path="elements", aliases={"player_id": "id", "team_id": "team",
                                                           "position_id": "element_type"},
                                  keep_null=["chance_of_playing_next_round", "chance_of_playing_this_round",
                                             "squad_number"], ts_cols=["news_added"]),
    "raw_teams_bootstrap": dict(path="teams", aliases={"team_id": "id"}),
    "raw_events_bootstrap": dict(path="events", aliases={"event_id": "id"},
                                 json_cols={"chip_plays": "[]", "top_element_info": "{}", "overrides": "{}"},
                                 ts_cols=["deadline_time"]),
    "raw_element_stats": dict(path="element_stats"),
    "raw_element_types": dict(path="element_types", renames={"id": "position_id"}),
    "raw_chips": dict(path="chips", renames={"id": "chip_id"}, json_cols={"overrides": "{}"}),
    "raw_phases": dict(path="phases", renames={"id": "phase_id"}),
}


def flatten_bootstrap(docs: DataFrame, as_of, sections: Mapping[str, dict] | None = None) -> dict[str, DataFrame]:
    """All sections of one bootstrap read; a section that cannot be planned
    (missing / malformed) is skipped and the others proceed."""
    out = {}
    nested = "doc" in docs.columns  # parsed from text (parse_docs) vs read with spark.read.json
    for name, spec in (sections or BOOTSTRAP_SECTIONS).items():
        spec = dict(spec, path=f"doc.{spec['path']}") if nested else spec
        try:
            df = flatten_section(docs, as_of=as_of, **spec)
            df.schema  # force analysis now so a broken section is skipped here
            out[name] = df
        except Exception:  # noqa: BLE001 - per-section isolation is the contract
            continue
    return out


def game_settings(docs: DataFrame, as_of, json_cols: Sequence[str] = ()) -> DataFrame:
    """A4: the single settings object as one row; list-valued fields as JSON."""
    s = docs.select("doc.game_settings.*") if "doc" in docs.columns else docs.select("game_settings.*")
    s = s.withColumns({c: F.coalesce(F.to_json(F.col(c)), F.lit("[]")) for c in json_cols if c in s.columns})
    return s.withColumn("id", F.lit(1)).withColumn("as_of_utc", _ts(as_of))


def flatten_fixtures(docs: DataFrame, path: str | None = None, as_of=None) -> DataFrame:
    """Fixtures list -> rows, provider names -> logical names, stats -> JSON."""
    rows = docs.select(F.inline(F.col(path))) if path else docs
    rows = rows.withColumnsRenamed({k: v for k, v in {"id": "fixture_id", "team_h": "home_team_id",
                                                      "team_a": "away_team_id", "kickoff_time": "kickoff_utc"}.items()
                                    if k in rows.columns})
    if "stats" in rows.columns and not isinstance(rows.schema["stats"].dataType, T.StringType):
        rows = rows.withColumn("stats", F.coalesce(F.to_json("stats"), F.lit("[]")))
    if "kickoff_utc" in rows.columns:
        rows = rows.withColumn("kickoff_utc", F.try_to_timestamp(F.col("kickoff_utc").cast("string"))
                               .cast("timestamp_ntz"))
    return rows.withColumn("as_of_utc", _ts(as_of)) if as_of is not None else rows


# --------------------------------------------------------------------------- A8
BUCKETS = 4096


def flatten_performance(live: DataFrame, players: DataFrame, fixtures: DataFrame, gameweek, as_of=None,
                        stats: Sequence[str] = ("total_points", "minutes"),
                        doc_key: str | Sequence[str] | None = None) -> DataFrame:
    """Per player of a live document: projected stats, team/price looked up
    from ``players``, opponent/venue from the first usable ``explain`` entry.

    ``explain[].fixture`` is read as text and may be an int (a fixture id,
    usable only when it is in ``fixtures``; the player's team decides the
    side), an object, or a list whose first item is an object. The first
    usable entry in array order wins.

    Entries that carry their own opponent are settled in place; only the ids before the first
    of them are looked up. An element that asks for none keeps one row, spread over the tasks.
    The bucket is a second join key: both sides are shuffled for this join, so that AQE can
    split the partition of an id that very many elements name.
    """
    keys = ([doc_key] if isinstance(doc_key, str) else list(doc_key or [])) + ["__epos"]
    el = live.select(*keys[:-1], F.posexplode(F.col("doc.elements")).alias("__epos", "__el")) \
        .select(*keys, "__el.*")
    base = el.select(*keys, F.col("id").alias("player_id"),
                     *[F.col("stats")[s].alias(s) for s in stats], F.col("explain"))
    pl = players.select("player_id", "team_id", F.col("now_cost").alias("value"))
    base = base.join(pl, "player_id", "left")
    carried = [*keys, "player_id", *stats, "team_id", "value"]
    by = [*keys, "player_id"]

    def own(txt: Column) -> Column:
        listed = F.coalesce(F.ltrim(txt).startswith("["), F.lit(False)) & \
            F.get_json_object(txt, "$[0]").startswith("{")
        return F.coalesce(F.ltrim(txt).startswith("{"), F.lit(False)) | F.coalesce(listed, F.lit(False))

    # entries are only looked at when the player's team is known
    texts = F.when(F.col("team_id").isNotNull(), F.transform("explain", lambda e, i: F.struct(i.alias("pos"), e["fixture"].alias("txt"))))
    base = base.select(*carried, texts.alias("__x"))
    base = base.withColumn("__own", F.try_element_at(F.filter("__x", lambda x: own(x["txt"])), F.lit(1)))
    before = F.filter("__x", lambda x: x["txt"].rlike(r"^-?\d+$") & (
        F.col("__own").isNull() | (x["pos"] < F.col("__own")["pos"])))
    ex = base.select(*carried, F.col("__own.txt").alias("__txt"), F.explode_outer(before).alias("__e"))
    ex = ex.select(*carried, "__txt", F.col("__e.pos").alias("__pos"), F.col("__e.txt").cast("long").alias("__ask"))
    ex = ex.withColumn("__bucket", F.pmod(F.coalesce("__ask", F.xxhash64(*by)), F.lit(BUCKETS)))
    fxl = fixtures.select(F.col("fixture_id").cast("long").alias("__fid"), F.col("home_team_id").alias("__h"),
                          F.col("away_team_id").alias("__a"))
    fxl = fxl.withColumn("__b", F.pmod("__fid", F.lit(BUCKETS)))
    ex = ex.join(fxl, (F.col("__ask") == F.col("__fid")) & (F.col("__bucket") == F.col("__b")), "left")
    opp = F.when(F.col("team_id") == F.col("__h"), F.col("__a")).when(F.col("team_id") == F.col("__a"), F.col("__h"))
    home = F.when(F.col("team_id") == F.col("__h"), F.lit(True)).when(F.col("team_id") == F.col("__a"), F.lit(False))
    # one aggregation per element, keyed by document, position and player alone (its other columns are
    # the same on all its rows): the first id that is a fixture is the min of a struct led by its position
    first = ex.groupBy(*by).agg(
        *[F.first(c).alias(c) for c in [*carried, "__txt"] if c not in by],
        F.min(F.when(F.col("__fid").isNotNull(), F.struct("__pos", opp.alias("opponent_team"), home.alias("was_home"))))
        .alias("__hit"))
    txt, plain = F.col("__txt"), F.ltrim("__txt").startswith("{")

    def of_own(name: str) -> Column:
        return F.when(plain, F.get_json_object(txt, f"$.{name}")).otherwise(F.get_json_object(txt, f"$[0].{name}"))

    found = F.struct(F.col("__hit.opponent_team").cast("long").alias("opponent_team"), F.col("__hit.was_home").alias("was_home"))
    first = first.withColumn("__m", F.when(F.col("__hit").isNotNull(), found).otherwise(
        F.struct(of_own("opponent_team").cast("long").alias("opponent_team"), of_own("is_home").cast("boolean").alias("was_home"))))
    gw = gameweek if isinstance(gameweek, Column) else F.lit(gameweek)
    out = first.select(*keys[:-1], "player_id", gw.alias("gameweek"), *stats, "team_id",
                       F.col("__m.opponent_team").alias("opponent_team"), F.col("__m.was_home").alias("was_home"),
                       "value")
    return out.withColumn("as_of_utc", _ts(as_of)) if as_of is not None else out


# --------------------------------------------------------------------------- A9 / A15
SNAPSHOT_FIELDS = ["player_id", "status", "chance_of_playing_next_round", "chance_of_playing_this_round", "news",
                   "news_added", "now_cost", "ep_this", "ep_next", "form", "penalties_order",
                   "corners_and_indirect_freekicks_order", "direct_freekicks_order"]


def snapshot(players: DataFrame, gameweek, backfilled: bool, as_of) -> DataFrame:
    """Availability snapshot of every player for ``gameweek`` (an int, or a
    Column such as an exploded gameweek range for a backfill). Missing text
    gets the neutral defaults: news '', ep/form '0.0', status 'a'."""
    have = set(players.columns)
    types = {"chance_of_playing_next_round": "double", "chance_of_playing_this_round": "double",
             "news_added": "timestamp_ntz", "now_cost": "int", "penalties_order": "int",
             "corners_and_indirect_freekicks_order": "int", "direct_freekicks_order": "int"}
    defaults = {"status": "a", "news": "", "ep_this": "0.0", "ep_next": "0.0", "form": "0.0"}

    def field(c: str) -> Column:
        v = F.col(c) if c in have else F.lit(None)
        if c in defaults:
            v = F.coalesce(v.cast("string"), F.lit(defaults[c]))
        return v.cast(types.get(c, "string")).alias(c)

    gw = gameweek if isinstance(gameweek, Column) else F.lit(gameweek)
    return players.select(
        F.col("player_id"), gw.cast("int").alias("gameweek"), *[field(c) for c in SNAPSHOT_FIELDS[1:]],
        F.lit(bool(backfilled)).alias("is_backfilled"),
        _ts(as_of).alias("snapshot_date"), _ts(as_of).alias("as_of_utc"),
    )


# --------------------------------------------------------------------------- A10
def flatten_picks(docs: DataFrame, gameweek) -> DataFrame:
    """Picks of a manager document; ``active_chip`` repeated on every pick."""
    gw = gameweek if isinstance(gameweek, Column) else F.lit(gameweek)
    return docs.select(gw.alias("event"), F.col("doc.active_chip").alias("chip_used"), F.inline("doc.picks")) \
        .withColumnRenamed("element", "player_id")


def flatten_summary(docs: DataFrame) -> DataFrame:
    """The ``entry_history`` object of a picks document as one row."""
    return docs.select("doc.entry_history.*").withColumnRenamed("entry", "manager_id")


def flatten_manager(docs: DataFrame) -> DataFrame:
    """The manager object as one row (``id`` -> ``manager_id``)."""
    return docs.select("doc.*").withColumnRenamed("id", "manager_id")


__all__ = ["parse_docs", "flatten_section", "flatten_bootstrap", "game_settings", "flatten_fixtures",
           "flatten_performance", "snapshot", "flatten_picks", "flatten_summary", "flatten_manager"]
