"""Query catalog: one entry per operator, Spark plan + DuckDB oracle SQL.

Each entry is ``name -> (fn(spark, sf_dir) -> DataFrame, sql | None)``. The
Spark side is written with the library operators; the SQL side is an
independent formulation of the same semantics over the same parquet tables
(bindings as CTEs). Output discipline for value-hash comparison: every
double is rounded to 6 decimals, every integer is BIGINT, on both sides.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

REGISTRY: dict[str, tuple[Callable[[SparkSession, str], DataFrame], str | None]] = {}


def query(name: str, sql: str | None = None):
    """Register ``fn(spark, sf_dir) -> DataFrame`` with its oracle SQL. The
    registered callable first applies the library session defaults (UTC
    session time zone, ANSI, AQE), whatever session the caller passes."""
    def deco(fn):
        if name in REGISTRY:
            raise KeyError(f"duplicate query {name}")

        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            from ..session import apply_defaults
            apply_defaults(spark)
            return fn(spark, sf_dir)

        run.__name__ = run.__qualname__ = name
        run.__doc__ = fn.__doc__
        REGISTRY[name] = (run, sql)
        return fn
    return deco


def round6(c) -> F.Column:
    """x rounded to 6 decimals as sign(y) * floor(|y| + 0.5) / 1e6, y = x * 1e6.

    Plain arithmetic (stays in codegen; ``round()`` on doubles goes through
    BigDecimal and was measured at ~10x the cost of a whole fan-out query),
    and the oracle SQL uses the identical formula, so both sides perform the
    same IEEE operations. ``+ 0.0`` turns a negative zero into zero.
    """
    y = c.cast("double") * 1e6
    return F.signum(y) * F.floor(F.abs(y) + 0.5) / 1e6 + 0.0


def conform(df: DataFrame) -> DataFrame:
    """Round doubles to 6 decimals and widen integers to BIGINT."""
    out = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            c = round6(c)
        elif isinstance(f.dataType, (T.ByteType, T.ShortType, T.IntegerType)):
            c = c.cast("long")
        out.append(c.alias(f.name))
    return df.select(*out)


# SQL helpers (plain text builders for the oracle side)
def R(x: str) -> str:
    """SQL twin of :func:`round6` (same operations, same order)."""
    y = f"(CAST({x} AS DOUBLE) * 1000000.0)"
    return f"(CAST(sign({y}) AS DOUBLE) * floor(abs({y}) + 0.5) / 1000000.0 + 0.0)"


def B(x: str) -> str:
    return f"CAST({x} AS BIGINT)"


def D(x: str) -> str:
    """A nullable count/score carried as DOUBLE on both sides."""
    return f"CAST({x} AS DOUBLE)"


def CLIP(x: str, lo: str | None = None, hi: str | None = None) -> str:
    e = x
    if lo is not None:
        e = f"greatest({e}, {lo})"
    if hi is not None:
        e = f"least({e}, {hi})"
    return f"(CASE WHEN ({x}) IS NULL THEN NULL ELSE {e} END)"


def NUM(x: str) -> str:
    """Lenient numeric parse in SQL: NaN / inf -> NULL."""
    v = f"TRY_CAST({x} AS DOUBLE)"
    return f"(CASE WHEN isnan({v}) OR isinf({v}) THEN NULL ELSE {v} END)"


def all_queries() -> dict:
    # import the query modules for their registration side effects
    from . import q_core, q_features, q_ops, q_quality, q_stored  # noqa: F401
    return REGISTRY
