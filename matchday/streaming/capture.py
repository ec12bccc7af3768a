"""Structured Streaming jobs over landed provider files.

The source system is a batch pipeline; its two continuously fed tables map
onto streaming micro-batches:

* player availability snapshots: append-only, unique per (player, gameweek);
  a duplicate key is an error (J5 semantics per micro-batch)
* bookmaker odds: keyed merge with the stored rows, the newest wins whatever
  the order of arrival (G1 + J3 per micro-batch, on key buckets)

Both use ``foreachBatch`` with the checkpoint in the shared folder named by
``spark.checkpoint.dir``, so a restarted query resumes from its last
committed batch. Replays are idempotent: snapshot rows carry the stream's id
(which Spark keeps in the checkpoint) and the batch that wrote them, and a
replayed batch only writes rows that are not there yet; the odds merge keeps
the newest row per key (re-applying it gives the same table).
"""

from __future__ import annotations

import threading
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.joins import DuplicateKeyError, duplicate_keys
from ..operators.merge import merge_latest
from ..session import ensure_checkpoint_dir
from ..sources.sinks import _exists, upsert


def _ckpt(spark: SparkSession, name: str, location: str | None) -> str:
    return location or f"{ensure_checkpoint_dir(spark)}/streams/{name}"


def snapshot_batch_writer(table_path: str, key: Sequence[str], partition_col: str = "gameweek",
                          stream: Callable[[], str] | str = ""):
    """foreachBatch function: append-only write with a duplicate-key check.

    ``stream`` is the id of the stream, or a function that tells it. A batch is
    known by stream and batch number together: a second stream, or one that
    starts anew with another checkpoint, numbers its batches from 0 again.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        sid = stream() if callable(stream) else stream
        tagged = (batch.withColumn("_stream_id", F.lit(sid)).withColumn("_batch_id", F.lit(batch_id).cast("long")))
        dup = duplicate_keys(tagged, key).limit(1).collect()
        if dup:
            raise DuplicateKeyError(f"duplicate snapshot key in batch {batch_id}: {dup[0].asDict()}")
        old = _exists(spark, table_path, "parquet", mergeSchema=True)
        if old is not None:
            if "_stream_id" not in old.columns:  # a table of before streams were told apart
                old = old.withColumn("_stream_id", F.lit(None).cast("string"))
            own = F.coalesce((F.col("_stream_id") == sid) & (F.col("_batch_id") == batch_id), F.lit(False))
            clash = tagged.select(*key).join(old.where(~own).select(*key), list(key), "left_semi").limit(1).collect()
            if clash:
                raise DuplicateKeyError(f"snapshot already stored for {clash[0].asDict()}")
            # a replay writes what its first run left unwritten: nothing, if that was complete
            tagged = tagged.join(old.where(own).select(*key), list(key), "left_anti").select(*tagged.columns)
        tagged.write.mode("append").partitionBy(partition_col).parquet(table_path)
    return write


class _StreamId:
    """The id that Spark keeps in a checkpoint, told once its query has started."""

    def __init__(self):
        self._known, self._id = threading.Event(), ""

    def tell(self, query) -> None:
        self._id = str(query.id)
        self._known.set()

    def __call__(self) -> str:
        self._known.wait()
        return self._id


def capture_snapshots(spark: SparkSession, landing_dir: str, schema: T.StructType | str, table_path: str,
                      key: Sequence[str] = ("player_id", "gameweek"), checkpoint: str | None = None,
                      available_now: bool = True):
    """Start the snapshot capture stream over JSON files in ``landing_dir``."""
    src = spark.readStream.schema(schema).json(landing_dir)
    stream = _StreamId()
    w = (src.writeStream.foreachBatch(snapshot_batch_writer(table_path, list(key), stream=stream))
         .option("checkpointLocation", _ckpt(spark, "snapshots", checkpoint)))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    query = w.start()
    stream.tell(query)
    return query


def odds_batch_writer(table_path: str, key: Sequence[str], order: Sequence[str], buckets: int = 64):
    """foreachBatch function: per key the newest row of batch and table stays.

    The stored row takes part in the comparison, so a file that arrives late, however late, never
    replaces newer odds (no watermark is needed, and none drops a row). Only the key buckets that the
    batch falls into are read and rewritten.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        upsert(merge_latest([batch], list(key), order=list(order)), table_path, list(key), buckets, newest=list(order))
    return write


def capture_odds(spark: SparkSession, landing_dir: str, schema: T.StructType | str, table_path: str,
                 key: Sequence[str] = ("fixture_id",), order: Sequence[str] = ("as_of_utc",),
                 checkpoint: str | None = None, available_now: bool = True):
    """Start the odds merge stream over JSON files in ``landing_dir``."""
    src = spark.readStream.schema(schema).json(landing_dir)
    w = (src.writeStream.foreachBatch(odds_batch_writer(table_path, list(key), list(order)))
         .option("checkpointLocation", _ckpt(spark, "odds", checkpoint)))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start()
