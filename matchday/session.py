"""Spark session defaults shared by jobs, tests and the bench.

Everything here is plain session configuration: UTC session time zone (all
timestamps in the data model are UTC, stored without zone), ANSI mode on
(so every cast that may fail is written as ``try_cast``), AQE with skew-join
handling on, and dynamic partition overwrite so that replacing one gameweek
never touches the others.
"""

from __future__ import annotations

import re
import tempfile

from pyspark.sql import SparkSession

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # post-shuffle partitions are sized by AQE from this target, so the same
    # code needs no per-scale shuffle-partition tuning (on a cluster set
    # spark.sql.shuffle.partitions high, e.g. 4-8x the cores, and let AQE coalesce)
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
}


def build_session(master: str | None = None, app: str = "matchday",
                  shuffle_partitions: int | None = None, extra: dict | None = None) -> SparkSession:
    """Create (or reuse) a session with the library defaults.

    ``master`` is only set when given: on a cluster the launcher decides it.
    """
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    conf = dict(DEFAULTS)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def apply_defaults(spark: SparkSession) -> SparkSession:
    """Apply the runtime-settable defaults to an existing session."""
    for k, v in DEFAULTS.items():
        if k == "spark.ui.enabled":
            continue
        try:
            spark.conf.set(k, v)
        except Exception:  # static conf on an existing session: keep the cluster's value
            pass
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder: ``spark.checkpoint.dir``, used as it is.

    Where the setting is absent, a session whose driver and executors are one
    process (a ``local`` master, as in tests) uses a scratch folder; any other
    master raises, because a folder of one machine could not be shared.
    """
    d = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    sc = spark.sparkContext
    if not d:
        d = sc.getCheckpointDir()
    if not d:
        if not re.fullmatch(r"local(\[[^\]]*\])?", sc.master):
            raise RuntimeError("spark.checkpoint.dir is not set: name a folder that the driver and all executors share")
        d = tempfile.mkdtemp(prefix="matchday-ckpt-")
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(d)
    return d
