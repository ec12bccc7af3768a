"""Valid embedding vectors and their identical copies."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def valid_vectors(table: DataFrame, key: str, vector: str) -> DataFrame:
    """``(id, v)`` of the rows whose vector takes part: no null id, not null, not zero, every
    component finite, and of the most frequent length (ties: the longest)."""
    v = F.col(vector).cast("array<double>")
    fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    rows = (table.select(F.col(key).alias("id"), v.alias("v"))
            .where(F.col("id").isNotNull() & F.col("v").isNotNull())
            .where(F.coalesce(fine, F.lit(False)) & F.exists("v", lambda x: x != 0.0)))
    # one row: the length of most vectors
    common = (rows.groupBy(F.size("v").alias("d")).agg(F.count(F.lit(1)).alias("n"))
              .agg(F.max(F.struct("n", "d")).alias("m")).select(F.col("m.d").alias("d")))
    return rows.join(F.broadcast(common), F.size("v") == F.col("d")).drop("d")


def matrix(column: pd.Series) -> np.ndarray:
    """A column of equally long arrays as one float64 matrix."""
    return np.stack(column.to_list()).astype(np.float64)
