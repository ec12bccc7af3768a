"""Helpers shared by the corpus operators: scratch tables and connected components.

Scratch tables go to the shared folder named by ``spark.checkpoint.dir`` so that
a lost executor never loses an intermediate result; nothing is kept on local
disks. A scratch table lives as long as the result that reads it and may be
removed afterwards (``<spark.checkpoint.dir>/llm-*``).
"""

from __future__ import annotations

import gc
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir


def staged(df: DataFrame, name: str, by: tuple[str, ...] = (), plain: bool = False) -> DataFrame:
    """Write ``df`` as Parquet to the shared scratch folder and read it back. ``by``: columns that get folders;
    ``plain``: not compressed."""
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark)}/llm-{uuid.uuid4().hex}/{name}"
    df.write.partitionBy(*by).parquet(path, compression="none" if plain else None)
    out = spark.read.schema(df.schema).parquet(path)
    out.scratch_path = path
    return out


def discarded(table: DataFrame) -> None:
    """Delete a staged table that nothing reads any more (its readers are written themselves)."""
    spark = table.sparkSession
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(table.scratch_path)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
    released(spark)


@contextmanager
def setting(spark: SparkSession, key: str, value: str) -> Iterator[None]:
    """A session setting that holds while tables are written."""
    before = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def released(spark: SparkSession) -> None:
    """Let Spark's cleaner drop the shuffle files of plans that a staged table has replaced."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def components(edges: DataFrame, a: str = "a", b: str = "b", max_rounds: int = 60) -> DataFrame:
    """Smallest reachable id of every node of an undirected edge list.

    Returns ``(node, component)`` for the nodes that occur in an edge. Each
    round takes the smallest label among the neighbours and then follows the
    label's own label (pointer jumping), so the number of rounds is logarithmic
    in the longest path. Labels and edges are cut from their lineage by a
    written table every round. Minima are combined on the map side, so a
    component that holds a third of all nodes is no single task's work.
    Null ids and self loops are ignored; an empty edge list gives no rows.
    """
    kind = edges.schema[a].dataType
    both = (edges.select(F.explode(F.array(F.struct(F.col(a).alias("node"), F.col(b).alias("other")),
                                           F.struct(F.col(b).alias("node"), F.col(a).alias("other")))).alias("e"))
            .select("e.node", "e.other")
            .where(F.col("node").isNotNull() & F.col("other").isNotNull() & (F.col("node") != F.col("other"))))
    links = staged(both.distinct(), "links")
    labels = staged(links.groupBy("node").agg(F.min("other").alias("m"))
                    .select("node", F.least("node", "m").cast(kind).alias("component")), "labels")
    for _ in range(max_rounds):
        # the smallest label next to each node
        near = (links.join(labels.select(F.col("node").alias("other"), "component"), "other")
                .groupBy("node").agg(F.min("component").alias("near")))
        low = (labels.join(near, "node")
               .select("node", F.col("component").alias("was"), F.least("component", "near").alias("low")))
        # one pointer jump: the label's label (a label is itself a node)
        jump = low.join(labels.select(F.col("node").alias("low"), F.col("component").alias("over")), "low", "left")
        step = staged(jump.select("node", "was", F.least("low", F.coalesce("over", "low")).alias("component")), "labels")
        moved = step.where(F.col("component") != F.col("was")).limit(1).count()
        labels = step.select("node", "component")
        if not moved:
            return labels
    raise RuntimeError(f"components did not settle in {max_rounds} rounds")
