"""Projections, filters and lookups.

All of these are plain ``select`` / ``filter`` / semi-join expressions, so
Catalyst pushes the predicates into the parquet scan and prunes columns.
"""

from __future__ import annotations

import sys
import unicodedata
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.cols import num, ratio_or


# --------------------------------------------------------------------------- B2
def project_available(df: DataFrame, spec: Sequence[tuple[str, str | None]]) -> DataFrame:
    """Keep the spec's columns that exist, in spec order; ``cast`` 'num'
    means lenient numeric parse, any other string is a ``try_cast`` type."""
    present = set(df.columns)
    out = []
    for name, cast in spec:
        if name not in present:
            continue
        c = F.col(name)
        if cast == "num":
            c = num(c)
        elif cast:
            c = c.try_cast(cast)
        out.append(c.alias(name))
    return df.select(*out)


# --------------------------------------------------------------------------- B5
def per_unit_rates(df: DataFrame, measures: Sequence[str], minutes: str = "minutes", per: float = 90.0,
                   suffix: str = "_per90") -> DataFrame:
    """Rows with minutes > 0 and ``measure * per / minutes`` (NULL -> 0)."""
    m = F.col(minutes)
    cols = [F.coalesce(ratio_or(num(F.col(x)) * per, m, 0.0), F.lit(0.0)).alias(x + suffix) for x in measures]
    return df.where(m > 0).select("*", *cols)


# --------------------------------------------------------------------------- B6
def in_range(df: DataFrame, col: str, lo=None, hi=None, order: Sequence[Column | str] = ()) -> DataFrame:
    """Optional inclusive bounds on ``col``; sorted by ``order`` if given."""
    c = F.col(col)
    if lo is not None:
        df = df.where(c >= F.lit(lo))
    if hi is not None:
        df = df.where(c <= F.lit(hi))
    return df.orderBy(*order) if order else df


# --------------------------------------------------------------------------- B8
def _fold_table() -> tuple[str, str]:
    """Accented -> plain letter for every letter that decomposes under NFD to one
    letter and combining marks (generated by rule over all code points)."""
    src, dst = [], []
    for cp in range(0x00C0, sys.maxunicode + 1):
        ch = chr(cp)
        if not unicodedata.decomposition(ch) or unicodedata.category(ch) == "Mn":
            continue
        base = "".join(c for c in unicodedata.normalize("NFD", ch) if unicodedata.category(c) != "Mn")
        if base != ch and len(base) == 1:
            src.append(ch)
            dst.append(base)
    return "".join(src), "".join(dst)


FOLD_FROM, FOLD_TO = _fold_table()


def fold_accents(c) -> Column:
    """lower(), then strip accents: of precomposed letters by table, and combining marks."""
    c = F.col(c) if isinstance(c, str) else c
    return F.regexp_replace(F.translate(F.lower(c), FOLD_FROM, FOLD_TO), r"\p{Mn}", "")


def _fold_py(s: str) -> str:
    return "".join(c for c in unicodedata.normalize("NFD", s.lower()) if unicodedata.category(c) != "Mn")


def name_lookup(df: DataFrame, col: str, term: str) -> DataFrame:
    """Rows whose ``col`` contains ``term`` as a case-insensitive regex; if
    none, rows whose accent-folded ``col`` contains the folded term.

    Both branches are evaluated in one plan; the fallback only contributes
    when the first finds nothing (a one-row existence aggregate).
    """
    first = F.col(col).rlike("(?i)" + term)
    folded = fold_accents(col).rlike(_fold_py(term))
    hits = df.agg(F.max(F.coalesce(first, F.lit(False)).cast("int")).alias("__any")).withColumn("__one", F.lit(1))
    tagged = df.withColumn("__one", F.lit(1)).join(F.broadcast(hits), "__one", "left")  # one-row aggregate
    return tagged.where(F.when(F.col("__any") == 1, first).otherwise(folded)).drop("__any", "__one")


# --------------------------------------------------------------------------- B10
def in_id_set(df: DataFrame, ids: DataFrame, key: str) -> DataFrame:
    """Rows whose ``key`` appears in ``ids`` (semi join, no duplication)."""
    return df.join(ids.select(key), key, "left_semi")


# --------------------------------------------------------------------------- B11
def upcoming(fixtures: DataFrame, period_col: str, period, finished: str = "finished") -> DataFrame:
    """Fixtures of ``period`` that are not finished (NULL = not finished)."""
    p = period if isinstance(period, Column) else F.lit(period)
    return fixtures.where((F.col(period_col) == p) & ~F.coalesce(F.col(finished), F.lit(False)))


# --------------------------------------------------------------------------- B12
def by_id(df: DataFrame, key: str, value) -> DataFrame:
    return df.where(F.col(key) == F.lit(value))
