"""Write semantics of the stored tables.

Each semantic is split in two: a pure *frame* function that computes the new
table content (testable, and what the query catalog checks), and a writer
that persists it with plain ``DataFrameWriter`` calls.

Full replaces and keyed rewrites are staged: the new table is written beside
the old one and swapped in by two renames, so a job that fails leaves the
table as it was (between the renames a reader may find none; a table format
with atomic overwrite removes that gap). A keyed rewrite of a partitioned
table only rewrites touched partitions; as it overwrites what it reads, it
first cuts the lineage with ``DataFrame.checkpoint()`` into
``spark.checkpoint.dir`` (the cluster's shared folder). ``upsert`` keeps a table
in key buckets and rewrites only those that new keys fall into. The append-only
conflict check is not race-free against a concurrent writer.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.joins import DuplicateKeyError, duplicate_keys
from ..operators.rank import first_by, latest_by
from ..session import ensure_checkpoint_dir


def _cols(x) -> list[str]:
    return [x] if isinstance(x, str) else list(x)


# --------------------------------------------------------------------------- frames
def replace_keys_frame(old: DataFrame, new: DataFrame, key) -> DataFrame:
    """Rows of ``old`` whose key is not in ``new``, plus all of ``new``."""
    k = _cols(key)
    return old.join(new.select(*k).distinct(), k, "left_anti").unionByName(new, allowMissingColumns=True)


def replace_partitions_frame(old: DataFrame, new: DataFrame, col: str) -> DataFrame:
    """Partitions (values of ``col``) present in ``new`` are replaced."""
    return replace_keys_frame(old, new, [col])


def insert_ignore_frame(existing: DataFrame, new: DataFrame, key, order: Sequence[Column | str] = ()) -> DataFrame:
    """The rows of ``new`` that an INSERT OR IGNORE would add.

    Keys already stored are ignored; within ``new`` the first row per key
    (by ``order``, else by full row) is the one kept.
    """
    k = _cols(key)
    fresh = new.join(existing.select(*k).distinct(), k, "left_anti")
    if order:
        return first_by(fresh, k, list(order))
    rest = [c for c in new.columns if c not in k]
    return first_by(fresh, k, [F.struct(*rest)]) if rest else fresh.distinct()


def append_conflicts(existing: DataFrame, incoming: DataFrame, key) -> DataFrame:
    """Keys of ``incoming`` that break an append-only unique key, with
    ``reason`` 'exists' (already stored) or 'duplicate' (repeated in the batch)."""
    k = _cols(key)
    stored = incoming.select(*k).join(existing.select(*k).distinct(), k, "left_semi").distinct() \
        .withColumn("reason", F.lit("exists"))
    dup = duplicate_keys(incoming, k).select(*k).withColumn("reason", F.lit("duplicate"))
    return stored.unionByName(dup)


def merge_newest(old: DataFrame, new: DataFrame, key, order: Sequence[str]) -> DataFrame:
    """Per key the greatest row by ``order`` of both, the new one of equals; rows without a key all stay."""
    both = old.withColumn("__prio", F.lit(0)).unionByName(new.withColumn("__prio", F.lit(1)), allowMissingColumns=True)
    k = _cols(key)
    lacks = F.coalesce(*[F.when(F.col(c).isNull(), F.lit(True)) for c in k], F.lit(False))
    picked = latest_by(both.where(~lacks), k, [*order, "__prio"])
    return picked.unionByName(both.where(lacks)).drop("__prio")


# --------------------------------------------------------------------------- writers
def _frozen(df: DataFrame) -> DataFrame:
    """Materialise into the checkpoint folder (lineage cut, executor-loss safe)."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return jvm, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def _write_staged(df: DataFrame, path: str, fmt: str, partition_col: str | None = None,
                  wanted: Callable[[], bool] = lambda: True) -> None:
    """Write beside the table, then swap: a failing job leaves the table as it was, and so does
    one whose written rows are not ``wanted`` (asked after the write)."""
    spark = df.sparkSession
    jvm, fs, target = _fs(spark, path)
    tag = uuid.uuid4().hex[:12]
    staging, old = (jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}.{kind}-{tag}") for kind in ("staging", "old"))
    w = df.write.format(fmt)
    (w.partitionBy(partition_col) if partition_col else w).save(str(staging.toString()))
    if not wanted():
        fs.delete(staging, True)
        return
    if fs.exists(target):
        if not fs.rename(target, old):
            raise OSError(f"cannot move {path} aside")
    else:
        fs.mkdirs(target.getParent())
    if not fs.rename(staging, target):
        if fs.exists(old):
            fs.rename(old, target)
        raise OSError(f"cannot move the new table to {path}")
    fs.delete(old, True)
    spark.catalog.refreshByPath(path)


def replace_all(df: DataFrame, path: str, fmt: str = "parquet", partition_col: str | None = None) -> None:
    """Full replace (staged, then swapped; the table may be read by ``df``)."""
    _write_staged(df, path, fmt, partition_col)


def replace_partitions(df: DataFrame, path: str, col: str, fmt: str = "parquet") -> None:
    """Replace only the partitions present in ``df`` (dynamic overwrite)."""
    (df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(col).format(fmt).save(path))


def _exists(spark: SparkSession, path: str, fmt: str, **options) -> DataFrame | None:
    try:
        return spark.read.options(**options).format(fmt).load(path)
    except Exception as e:  # noqa: BLE001 - a missing table reads as "no rows yet"
        if "PATH_NOT_FOUND" in str(e) or "does not exist" in str(e) or "UNABLE_TO_INFER_SCHEMA" in str(e):
            return None
        raise


def _as_stored(spark: SparkSession, path: str, fmt: str, old: DataFrame, df: DataFrame, col: str) -> DataFrame:
    """``old`` with the partition column in the type that ``df`` has: folder names tell no type
    (``01`` would read as the number 1)."""
    want = df.schema[col].dataType
    if old.schema[col].dataType == want:
        return old
    fields = [T.StructField(f.name, want if f.name == col else f.dataType) for f in old.schema.fields]
    return spark.read.schema(T.StructType(fields)).format(fmt).load(path)


def _typed_like(df: DataFrame, old: DataFrame) -> DataFrame:
    """``df`` with the columns that ``old`` has in its types: all files of a table must agree."""
    kinds = {f.name: f.dataType for f in old.schema.fields}
    return df.select(*[F.col(f"`{c}`").cast(kinds[c]).alias(c) if c in kinds else F.col(f"`{c}`") for c in df.columns])


def replace_keys(df: DataFrame, path: str, key, fmt: str = "parquet", partition_col: str | None = None) -> None:
    """Keyed replace (upsert) of the stored table, staged and swapped.

    With ``partition_col`` the table keeps that partitioning and only touched
    partitions are rewritten: those of the new rows and those that hold a
    replaced key, the partition of NULL included. A touched partition that ends
    up empty is removed. (``upsert`` rewrites less where keys say nothing of partitions.)
    A row without a key is replaced by none.
    """
    spark = df.sparkSession
    old = _exists(spark, path, fmt)
    if old is None:
        _write_staged(df, path, fmt, partition_col)
        return
    if partition_col is None:
        _write_staged(replace_keys_frame(old, df, key), path, fmt)
        return
    old = _as_stored(spark, path, fmt, old, df, partition_col)
    df = _typed_like(df, old)
    k, part = _cols(key), F.col(partition_col)
    hit = old.join(df.select(*k).distinct(), k, "left_semi").select(partition_col).distinct()
    touched = _frozen(hit.unionByName(df.select(partition_col)).distinct().withColumnRenamed(partition_col, "__p"))
    out = _frozen(replace_keys_frame(old.join(touched, part.eqNullSafe(F.col("__p")), "left_semi"), df, key))
    # the folders of partitions that end up empty: one row each, as Spark names their files
    left = out.select(partition_col).distinct()
    gone = touched.join(left, part.eqNullSafe(F.col("__p")), "left_anti")
    files = (old.select(partition_col, F.col("_metadata.file_path").alias("__f"))
             .join(gone, part.eqNullSafe(F.col("__p")), "left_semi"))
    folders = [r[0] for r in files.select(F.regexp_replace("__f", "/[^/]*$", "")).distinct().collect()]
    replace_partitions(out, path, partition_col, fmt)
    jvm, fs, _ = _fs(spark, path)
    for f in folders:
        fs.delete(jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(f)), True)
    spark.catalog.refreshByPath(path)


BUCKETS = "_bucket_of_"


def upsert(df: DataFrame, path: str, key, buckets: int = 64, fmt: str = "parquet", newest: Sequence[str] = ()) -> None:
    """J3/J4 on a table stored by key buckets: the folders ``_bucket_of_<n>=<i>`` hold the rows
    whose key hashes to ``i``, so a key never leaves its bucket and only buckets with new keys
    are read and rewritten; the files of all others stay as they are.

    The new rows are computed once (into the checkpoint folder). ``buckets`` counts only when the
    table is made; later calls follow its folders. A row without a key is replaced by none.
    With ``newest`` (columns) a stored row stays where it is greater by them than the new one of
    its key; of equal ones the new row counts. Read it with ``read_upserted``.
    """
    spark = df.sparkSession
    old = _exists(spark, path, fmt)
    held = [c for c in old.columns if c.startswith(BUCKETS)] if old is not None else []
    if old is not None and not held:
        raise ValueError(f"{path} is not stored by key buckets: rewrite it once with upsert to another path")
    col = held[0] if held else f"{BUCKETS}{buckets}"
    number = int(col[len(BUCKETS):])
    hashed = F.pmod(F.xxhash64(*[F.col(c).cast("string") for c in _cols(key)]), F.lit(number)).cast("int")
    new = _frozen((df if old is None else _typed_like(df, old)).withColumn(col, hashed))
    if old is not None:
        touched = [r[0] for r in new.select(col).distinct().collect()]  # at most the number of buckets
        if not touched:
            return
        held_rows = old.where(F.col(col).isin(touched))
        new = (merge_newest(held_rows, new, key, newest) if newest else replace_keys_frame(held_rows, new, key))
    # a dynamic overwrite swaps folders when the job commits, so the old rows can be read until then
    replace_partitions(new.repartition(col), path, col, fmt)
    spark.catalog.refreshByPath(path)


def read_upserted(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """The rows of a table written by ``upsert``, without its bucket column."""
    df = spark.read.format(fmt).load(path)
    return df.drop(*[c for c in df.columns if c.startswith(BUCKETS)])


def append_unique(df: DataFrame, path: str, key, force: bool = False, partition_col: str | None = None,
                  fmt: str = "parquet") -> None:
    """Append-only write; a key already stored (or repeated in the batch)
    raises :class:`DuplicateKeyError`. ``force`` replaces the incoming
    partitions (``partition_col``); a key repeated in the batch still raises."""
    spark = df.sparkSession
    old = _exists(spark, path, fmt)
    if force:
        if partition_col is None:
            raise ValueError("force needs partition_col")
        bad = duplicate_keys(df, key).limit(1).collect()
        if bad:
            raise DuplicateKeyError(f"append-only table {path}: key {list(_cols(key))} repeats, e.g. {bad[0].asDict()}")
        replace_partitions(df, path, partition_col, fmt)
        return
    if old is not None:
        bad = append_conflicts(old, df, key).limit(1).collect()
    else:
        bad = duplicate_keys(df, key).limit(1).collect()
    if bad:
        raise DuplicateKeyError(f"append-only table {path}: key {list(_cols(key))} conflict, e.g. {bad[0].asDict()}")
    w = df.write.mode("append").format(fmt)
    if partition_col:
        w = w.partitionBy(partition_col)
    w.save(path)


def insert_ignore(df: DataFrame, path: str, key, order: Sequence[Column | str] = (), partition_col: str | None = None,
                  fmt: str = "parquet") -> None:
    """Append only rows whose key is not stored yet."""
    spark = df.sparkSession
    old = _exists(spark, path, fmt)
    rows = insert_ignore_frame(old, df, key, order) if old is not None else insert_ignore_frame(
        df.limit(0), df, key, order)
    w = rows.write.mode("append").format(fmt)
    if partition_col:
        w = w.partitionBy(partition_col)
    w.save(path)


def save_many(tables: Mapping[str, DataFrame | Callable[[], DataFrame]], root: str, known: Sequence[str] | None = None,
              partition_cols: Mapping[str, str] | None = None, workers: int = 1) -> dict[str, str]:
    """Save several tables; empty or unknown ones are skipped and one
    failure does not stop the others. Returns ``{table: status}``.

    A table may be given as a function, so that its planning too fails alone. ``workers`` tables
    are written at a time: their jobs share the cluster instead of waiting for each other's tails.
    """
    def save(name: str) -> str:
        if known is not None and name not in known:
            return "skipped: unknown table"
        try:
            df = tables[name]
            df = df() if callable(df) else df
            # counted by the write itself: a look beforehand would run all shuffles of the plan twice
            seen = Observation()
            df = df.observe(seen, F.count(F.lit(1)).alias("rows"))
            path, pc = f"{root}/{name}", (partition_cols or {}).get(name)
            if pc:
                _, fs, target = _fs(df.sparkSession, path)
                held = fs.exists(target)
                replace_partitions(df, path, pc)  # without rows no partition is replaced
                if not seen.get["rows"] and not held:
                    fs.delete(target, True)
            else:
                _write_staged(df, path, "parquet", wanted=lambda: seen.get["rows"] > 0)
            return "saved" if seen.get["rows"] else "skipped: empty"
        except Exception as e:  # noqa: BLE001 - reported per table
            return f"failed: {type(e).__name__}: {e}"[:300]

    if workers <= 1:
        return {name: save(name) for name in tables}
    with ThreadPoolExecutor(workers) as pool:
        return dict(zip(tables, pool.map(save, tables), strict=True))


def normalise_timestamps(df: DataFrame, cols: Sequence[str], fmt: str | None = None) -> DataFrame:
    """Timestamp columns as zone-less UTC; unparsable text -> NULL."""
    out = {}
    types = dict(df.dtypes)
    for c in cols:
        if c not in types:
            continue
        if types[c] == "string":
            v = F.try_to_timestamp(F.col(c), F.lit(fmt)) if fmt else F.try_to_timestamp(F.col(c))
        else:
            v = F.col(c)
        out[c] = v.cast("timestamp_ntz")
    return df.withColumns(out) if out else df


__all__ = ["replace_keys_frame", "replace_partitions_frame", "insert_ignore_frame", "append_conflicts",
           "replace_all", "replace_partitions", "replace_keys", "upsert", "read_upserted", "append_unique", "insert_ignore", "save_many",
           "normalise_timestamps", "DuplicateKeyError"]
