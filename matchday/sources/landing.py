"""Landed files to typed tables, keeping what does not fit.

* ``read_landed`` reads JSON or CSV files by a declared table: every column as text first, so
  no value is lost to a parse, then typed and judged in the same pass (``schemas.judged``).
* ``read_seasons`` reads many CSV files whose headers differ: each file's header decides which
  of its fields is which column; the season comes from the file's path.
* ``write_landed`` writes good rows and rejects in one job and returns their numbers, observed
  on the write itself: no second pass counts them.

Nothing here needs the files' contents on the driver: it sees one header per *layout* (files
with equal headers are one layout) and the file paths, which any Spark read lists.
"""

from __future__ import annotations

import csv
import re
from collections.abc import Callable, Mapping, Sequence
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..quality.schemas import CORRUPT, REJECTS, Col, Table, judged
from .odds import csv_column_name

STATUS, GOOD, BAD = "landing_status", "good", "rejected"
MOST_LAYOUTS = 500


def _as_text(names: Sequence[str]) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType()) for n in [*names, CORRUPT]])


def read_landed(spark: SparkSession, path: str | Sequence[str], table: Table, fmt: str = "json",
                multi_line: bool = False) -> DataFrame:
    """The declared columns, typed, and ``_rejects``. JSON by field name (nested values as their
    JSON text), one record a line unless ``multi_line``; CSV by the header of its first file
    (files of several layouts: ``read_seasons``)."""
    if fmt == "json":
        raw = (spark.read.schema(_as_text(table.names())).option("mode", "PERMISSIVE").option("multiLine", multi_line)
               .option("columnNameOfCorruptRecord", CORRUPT).json(path))
        return judged(raw, table)
    if fmt == "csv":
        names = spark.read.option("header", True).option("inferSchema", False).csv(path).columns
        return judged(_csv(spark, path, [csv_column_name(n) for n in names]), table)
    raise ValueError(f"format {fmt!r}: json or csv")


def _csv(spark: SparkSession, path, names: Sequence[str]) -> DataFrame:
    return (spark.read.schema(_as_text(names)).option("header", True).option("enforceSchema", True)
            .option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT).csv(path))


def layouts(spark: SparkSession, path: str | Sequence[str]) -> list[tuple[list[str], list[str]]]:
    """``(field names, files)`` of each distinct header of the CSV files under ``path``.

    The first line of a file is the first of its first block, which one task reads, so the
    partial aggregate meets it first.
    """
    lines = (spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", "*.csv").text(path)
             .select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("at")))
    heads = lines.where("at = 0").groupBy("file").agg(F.first("value").alias("header"))
    found = heads.groupBy("header").agg(F.sort_array(F.collect_list("file")).alias("files")).orderBy("header").limit(
        MOST_LAYOUTS + 1).collect()
    if len(found) > MOST_LAYOUTS:
        raise ValueError(f"over {MOST_LAYOUTS} different headers under {path}: are these tables of one kind?")
    out = []
    for r in found:
        names, seen = [], set()
        for i, n in enumerate(next(csv.reader([(r.header or "").lstrip("﻿")]), [])):
            n = csv_column_name(n.strip()) or f"_unnamed_{i}"
            n = n if n.lower() not in seen else f"{n}_{i}"  # a header that repeats a name: the first one counts
            seen.add(n.lower())
            names.append(n)
        out.append((names, [unquote(f) for f in r.files]))
    return out


def read_seasons(spark: SparkSession, path: str | Sequence[str], table: Table, season: str = r"(\d{4}-\d{2})",
                 renames: Mapping[str, str] | None = None, derived: Mapping[str, Callable[[set[str]], Column]] | None = None) -> DataFrame:
    """One typed table from CSV files of several seasons whose headers differ.

    Columns are taken by name per layout: ``renames`` maps a file's field name to a declared
    column (several names may lead to one; the first that a layout has counts), undeclared
    fields are left out, declared ones that a layout lacks are NULL and not held against its
    rows. ``derived`` gives columns computed from a layout's fields. Added: ``season`` (the
    first group of the pattern in the file's path; NULL without a match), ``source_file`` and
    ``_rejects`` (records with a wrong number of fields, values that do not parse or break a rule).
    """
    parts = []
    for names, files in layouts(spark, path):
        raw = _csv(spark, files, names).withColumn("source_file", F.col("_metadata.file_path"))
        for old, new in (renames or {}).items():
            if old in raw.columns and new not in raw.columns:
                raw = raw.withColumnRenamed(old, new)
        raw = raw.withColumns({c: make(set(names)) for c, make in (derived or {}).items()})
        # an absent column is no fault of a row: only those present are judged
        have = Table({c: col for c, col in table.columns.items() if c in raw.columns}, ())
        part = judged(raw, have, ["source_file"])
        parts.append(part.withColumns({c: F.lit(None).cast(col.kind) for c, col in table.columns.items() if c not in have.columns}))
    if not parts:
        empty = spark.createDataFrame([], _as_text([*table.names(), "source_file"])).drop(CORRUPT)
        parts = [judged(empty, table, ["source_file"])]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    where = F.regexp_extract("source_file", season, 1)
    return out.select(*table.names(), F.when(where != "", where).alias("season"), "source_file", REJECTS)


def accepted(df: DataFrame) -> DataFrame:
    return df.where(F.size(REJECTS) == 0).drop(REJECTS)


def rejected(df: DataFrame) -> DataFrame:
    return df.where(F.size(REJECTS) > 0)


def observed(df: DataFrame, name: str, by: Mapping[str, Column]) -> tuple[DataFrame, Observation]:
    """``df`` with counts that fill as it is written: ``rows`` and, per name, the rows where the
    condition holds. Read them from the observation after the action; no job of their own."""
    seen = Observation(name)
    counts = [F.count(F.when(c, F.lit(1))).alias(n) for n, c in by.items()]
    return df.observe(seen, F.count(F.lit(1)).alias("rows"), *counts), seen


def write_landed(df: DataFrame, path: str, partition_col: str | None = None, checks: Sequence[str] = ()) -> dict[str, int]:
    """Write judged rows, good and rejected apart (folders ``landing_status=good`` and ``=rejected``),
    in one job; returns ``rows``, ``good``, ``rejected`` and, for each of ``checks`` (such as
    ``coerce:double``), the rows that failed it."""
    bad = F.size(REJECTS) > 0

    def failed(check: str) -> Column:
        return F.exists(REJECTS, lambda r: r["check"] == check)

    by = {GOOD: ~bad, BAD: bad} | {c: failed(c) for c in checks}
    watched, seen = observed(df.withColumn(STATUS, F.when(bad, BAD).otherwise(GOOD)), "landing", by)
    watched.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy(
        *[STATUS, *([partition_col] if partition_col else [])]).parquet(path)
    return dict(seen.get)


def read_written(spark: SparkSession, path: str, good: bool = True) -> DataFrame:
    """One side of what ``write_landed`` wrote: the other side's folder is not opened."""
    df = spark.read.parquet(path).where(F.col(STATUS) == (GOOD if good else BAD)).drop(STATUS)
    return df.drop(REJECTS) if good else df


# --------------------------------------------------------------------------- historical tables
# The columns that a season's merged gameweek file and player file have in common use.
GAMEWEEK_ROWS = Table({
    "name": Col(least=1), "position": Col(nullable=True), "team": Col(nullable=True), "element": Col("bigint", lo=1),
    "fixture": Col("bigint", True, lo=1), "opponent_team": Col("bigint", True, 1, 20), "GW": Col("bigint", lo=1, hi=47),
    "kickoff_time": Col("timestamp_ntz", True), "was_home": Col("boolean", True), "minutes": Col("bigint", True, 0, 120),
    "total_points": Col("bigint"), "goals_scored": Col("bigint", True, 0), "assists": Col("bigint", True, 0),
    "clean_sheets": Col("bigint", True, 0), "goals_conceded": Col("bigint", True, 0), "saves": Col("bigint", True, 0),
    "bonus": Col("bigint", True, 0), "bps": Col("bigint", True), "value": Col("bigint", True, 0),
    "selected": Col("bigint", True, 0), "transfers_in": Col("bigint", True, 0), "transfers_out": Col("bigint", True, 0),
    "expected_goals": Col("double", True, 0.0), "expected_assists": Col("double", True, 0.0),
    "starts": Col("bigint", True, 0)})


def read_merged_gameweeks(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """Player rows per gameweek of many seasons: older files say ``round`` for ``GW`` and lack the expected columns."""
    return read_seasons(spark, path, GAMEWEEK_ROWS, renames={"round": "GW", "event": "GW", "player_name": "name", "id": "element"})
