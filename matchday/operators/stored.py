"""Stored tables by partition (A13, E6) and their JSON-text columns.

* ``partition_values`` / ``newest_partition`` read the newest partition from the file listing
  alone: no data is opened to find it, and the scan that follows lists one folder.
* ``rows_of_periods`` joins a partitioned table with a filtered period table, so that Spark
  prunes partitions at run time (dynamic partition pruning).
* ``json_paths`` reads typed paths out of JSON text through the variant type: the text is parsed
  once per row whatever the number of paths, and a path that leads nowhere, or to a value
  of another kind, is NULL.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

NULL_PARTITION = "__HIVE_DEFAULT_PARTITION__"  # how Spark names the folder of NULL


# --------------------------------------------------------------------------- E6 on stored partitions
def partition_values(spark: SparkSession, path: str, col: str) -> list[str | None]:
    """The values of the first partition column, from one listing of the table's folder."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    names = [s.getPath().getName() for s in p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).listStatus(p)
             if s.isDirectory()]
    values = [unquote(n[len(col) + 1:]) for n in names if n.startswith(f"{col}=")]
    return [None if v == NULL_PARTITION else v for v in values]


def newest_partition(spark: SparkSession, path: str, col: str) -> DataFrame:
    """Rows of the greatest value of a numeric (or ISO-dated) partition column; none of an empty table."""
    df = spark.read.parquet(path)
    values = [v for v in partition_values(spark, path, col) if v is not None]
    if not values:
        return df.limit(0)
    number = all(v.lstrip("-").isdigit() for v in values)
    return df.where(F.col(col) == F.lit(max(values, key=int) if number else max(values)).cast(df.schema[col].dataType))


# --------------------------------------------------------------------------- A13 on stored partitions
def rows_of_periods(table: DataFrame, periods: DataFrame, col: str, period_col: str | None = None) -> DataFrame:
    """Rows of a table partitioned by ``col`` whose period is among ``periods`` (a filtered period
    table). An inner join with the distinct periods: Spark runs that side first and opens only
    the partitions it names."""
    named = periods.select(F.col(period_col or col).alias("__period")).distinct()
    return table.join(named, F.col(col) == F.col("__period")).drop("__period")


# --------------------------------------------------------------------------- H13
def json_paths(df: DataFrame, col: str, paths: Mapping[str, tuple[str, str] | Sequence[tuple[str, str]]]) -> DataFrame:
    """``df`` with a column per entry of ``paths``: ``name -> (path, type)``, or several of them, of
    which the first that yields a value counts (documents of several shapes). Text that is no JSON gives NULLs."""
    def value(at: tuple[str, str]) -> Column:
        return F.try_variant_get("__v", *at)

    def first(spec) -> Column:
        return value(spec) if isinstance(spec[0], str) else F.coalesce(*[value(s) for s in spec])

    return df.withColumn("__v", F.try_parse_json(col)).withColumns({n: first(s) for n, s in paths.items()}).drop("__v")


def json_kind(col) -> Column:
    """The kind of a JSON text: ``OBJECT``, ``ARRAY``, ``BIGINT``, ``STRING`` ...; NULL of what is no JSON."""
    kind = F.schema_of_variant(F.try_parse_json(col))
    return F.regexp_extract(kind, r"^[A-Z]+", 0)
