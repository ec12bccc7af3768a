"""Bookmaker odds ingest.

``flatten_market_odds`` turns provider documents (match -> bookmakers ->
markets -> outcomes) into one row per match in the wide CSV layout. Each
document is one match, so it is reduced where it sits with array functions
(filter / transform / aggregate): a narrow, shuffle-free projection.
"""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The exact bookmaker, the sharp bookmaker and the preference
# list used when the exact one is missing (provider order decides among them).
EXACT_BOOK = "bet365"
SHARP_BOOK = "pinnacle"
PREFERRED_BOOKS = ("bet365", "pinnacle", "skybet", "williamhill", "betfair_ex_uk")

# Columns of the file layout that the documents do not have.
NEVER_IN_DOCUMENTS = ("HS", "AS", "HST", "AST", "HC", "AC", "HF", "AF", "HY", "AY", "HR", "AR", "BFE_over_2_5", "BFE_under_2_5",
                      "Max_over_2_5", "Max_under_2_5", "Avg_over_2_5", "Avg_under_2_5", "AHh", "B365AHH", "B365AHA", "PAHH",
                      "PAHA", "AvgAHH", "AvgAHA")

OUTCOME = T.StructType([T.StructField("name", T.StringType()), T.StructField("price", T.DoubleType()),
                        T.StructField("point", T.DoubleType())])
MARKET = T.StructType([T.StructField("key", T.StringType()), T.StructField("outcomes", T.ArrayType(OUTCOME))])
BOOK = T.StructType([T.StructField("key", T.StringType()), T.StructField("markets", T.ArrayType(MARKET))])
MATCH_SCHEMA = T.StructType([T.StructField("home_team", T.StringType()), T.StructField("away_team", T.StringType()),
                             T.StructField("commence_time", T.StringType()),
                             T.StructField("bookmakers", T.ArrayType(BOOK))])


def flatten_market_odds(docs: DataFrame, key: str, name_map: Mapping[str, str] | None = None,
                        exact: str = EXACT_BOOK, sharp: str = SHARP_BOOK, preferred: Sequence[str] = PREFERRED_BOOKS,
                        line: float = 2.5, tol: float = 0.1) -> DataFrame:
    """One row per match document (``doc`` struct, ``key`` column kept).

    * h2h price per bookmaker market: outcome named like the home team ->
      home, like the away team -> away, any other name -> draw (last wins)
    * Max*/Avg* over all bookmakers' h2h prices
    * B365*: in provider order, the exact bookmaker (its last h2h market) takes
      over from any other, and a preferred bookmaker does while no home price
      is known; PS*: the sharp bookmaker
    * B365 over/under at ``line``: the exact bookmaker's totals outcomes whose
      point is within ``tol`` of the line ("over" wins over "under")
    * matches whose time does not parse are skipped; closing columns are the
      opening ones until real closing prices arrive

    A document is one match, so it is reduced in place with array functions:
    no explode, no shuffle, work linear in the number of documents.
    """
    d = F.col("doc")
    home, away = d["home_team"], d["away_team"]

    def is_home(o):
        return F.coalesce(o["name"] == home, F.lit(False))

    def is_away(o):
        return F.coalesce(o["name"] == away, F.lit(False))

    # one pass over a market's outcomes, the last of a side wins
    entry = T.StructType([T.StructField(k, T.DoubleType()) for k in "hda"])
    nothing = F.lit(None).cast(entry)

    def quoted(acc, o):
        h, a = is_home(o), is_away(o)
        return F.struct(F.when(h, o["price"]).otherwise(acc["h"]).alias("h"),
                        F.when(h | a, acc["d"]).otherwise(o["price"]).alias("d"),
                        F.when(a, o["price"]).otherwise(acc["a"]).alias("a"))

    def h2h_entries(b):
        return F.transform(F.filter(b["markets"], lambda m: F.coalesce(m["key"] == "h2h", F.lit(False))),
                           lambda m: F.struct(b["key"].alias("book"), F.aggregate(m["outcomes"], nothing, quoted).alias("p")))

    entries = F.flatten(F.transform(d["bookmakers"], h2h_entries))
    totals = F.flatten(F.transform(
        F.filter(d["bookmakers"], lambda b: F.coalesce(b["key"] == exact, F.lit(False))),
        lambda b: F.flatten(F.transform(
            F.filter(b["markets"], lambda m: F.coalesce(m["key"] == "totals", F.lit(False))),
            lambda m: F.filter(m["outcomes"],
                               lambda o: F.abs(F.coalesce(o["point"], F.lit(0.0)) - line) < tol)))))
    step = docs.select(key, home.alias("home_team"), away.alias("away_team"),
                       F.try_to_timestamp(d["commence_time"]).alias("ts"),
                       entries.alias("e"), totals.alias("t")).where(F.col("ts").isNotNull())

    e = F.col("e")

    def side(c):
        return F.filter(F.transform(e, lambda x: x["p"][c]), lambda v: v.isNotNull())

    def avg(arr):
        return F.when(F.size(arr) > 0, F.aggregate(arr, F.lit(0.0), lambda acc, v: acc + v) / F.size(arr))

    # one pass in provider order: the exact book always takes over; while the home price is
    # missing, so does any preferred book
    def takes_over(acc, x):
        now = F.coalesce(x["book"] == exact, F.lit(False)) | (
            acc["h"].isNull() & F.coalesce(x["book"].isin(*preferred), F.lit(False)))
        return F.when(now, x["p"]).otherwise(acc)

    b365 = F.aggregate(e, nothing, takes_over)
    ps = F.try_element_at(F.filter(e, lambda x: F.coalesce(x["book"] == sharp, F.lit(False))), F.lit(-1))
    lname = lambda o: F.lower(F.coalesce(o["name"], F.lit("")))
    over = F.try_element_at(F.filter("t", lambda o: lname(o).contains("over")), F.lit(-1))["price"]
    under = F.try_element_at(F.filter("t", lambda o: ~lname(o).contains("over") & lname(o).contains("under")),
                             F.lit(-1))["price"]
    nm = name_map or {}
    mp = F.create_map(*[F.lit(x) for kv in nm.items() for x in kv]) if nm else None

    def norm(c):
        return F.coalesce(F.element_at(mp, F.col(c)), F.col(c)) if mp is not None else F.col(c)

    # each side's prices once; the projection that uses them twice is kept apart by the optimizer
    step = step.withColumns({f"__{c}": side(c) for c in "hda"})
    out = step.select(
        key, F.date_format("ts", "dd/MM/yyyy").alias("Date"), F.to_date("ts").alias("match_date"),
        norm("home_team").alias("HomeTeam"), norm("away_team").alias("AwayTeam"),
        b365["h"].alias("B365H"), b365["d"].alias("B365D"), b365["a"].alias("B365A"),
        ps["p"]["h"].alias("PSH"), ps["p"]["d"].alias("PSD"), ps["p"]["a"].alias("PSA"),
        F.array_max("__h").alias("MaxH"), F.array_max("__d").alias("MaxD"), F.array_max("__a").alias("MaxA"),
        avg(F.col("__h")).alias("AvgH"), avg(F.col("__d")).alias("AvgD"), avg(F.col("__a")).alias("AvgA"),
        over.alias("B365_over_2_5"), under.alias("B365_under_2_5"))
    # a price of 0 is no price when it stands in for the closing one
    closing = {f"{bk}C{s}": F.when(F.col(f"{bk}{s}") != 0, F.col(f"{bk}{s}")) for bk in ("B365", "PS", "Max", "Avg") for s in "HDA"}
    # what the documents never carry is there, empty, so that rows of files and documents have one layout
    absent = {c: F.lit(None).cast("double") for c in NEVER_IN_DOCUMENTS}
    return out.withColumns(closing).withColumns({"Referee": F.lit(None).cast("string")} | absent)


# --------------------------------------------------------------------------- A12
def csv_column_name(c: str) -> str:
    """Provider CSV header -> column name: ``B365>2.5`` -> ``B365_over_2_5``,
    ``Avg<2.5`` -> ``Avg_under_2_5``; other '.'/'>'/'<' become '_'."""
    c = re.sub(r">(\d+)\.(\d+)$", r"_over_\1_\2", c)
    c = re.sub(r"<(\d+)\.(\d+)$", r"_under_\1_\2", c)
    return re.sub(r"[^0-9A-Za-z_]", "_", c)


def read_odds_csv(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """Read a provider odds CSV (header row); problem characters in column
    names are renamed, the date ``dd/MM/yyyy`` is parsed leniently."""
    r = spark.read.option("header", True)
    df = r.schema(schema).csv(path) if schema is not None else r.option("inferSchema", False).csv(path)
    df = df.toDF(*[csv_column_name(c) for c in df.columns])
    if "Date" in df.columns:
        df = df.withColumn("match_date", F.try_to_timestamp(F.col("Date"), F.lit("dd/MM/yyyy")).cast("timestamp_ntz"))
    return df
