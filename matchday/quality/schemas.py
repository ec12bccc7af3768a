"""Table schemas: types to coerce to, nullability, limits, value lists, lengths, keys (L1).

``check_table`` evaluates all rules of a table and reports every failure: one aggregate
pass for the row rules plus one per key. ``judged`` types a table and says of each row, in
the same pass, what was wrong with it (``_rejects``), so that good rows and rejects come
from one scan. Values are judged in the type they are coerced to; one that does not parse
is a failure of the report, not of the job. The declared tables are in ``tables``.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import checks as q

CORRUPT, REJECTS = "_corrupt_record", "_rejects"


@dataclass(frozen=True)
class Col:
    """A column's type and what its values keep to: bounds, allowed texts, shortest and longest text."""
    kind: str = "string"
    nullable: bool = False
    lo: float | None = None
    hi: float | None = None
    values: Sequence[str] = ()
    least: int | None = None
    most: int | None = None

    def rules(self, c: str) -> list[tuple[str, Column]]:
        """``(check, bad)`` for the column named ``c``; ``bad`` is true or null on what keeps to the rule."""
        raw, v = F.col(f"`{c}`"), self.typed(c)
        out = [] if self.kind == "string" else [(f"coerce:{self.kind}", raw.isNotNull() & v.isNull())]
        if not self.nullable:
            out.append(("not_null", raw.isNull()))
        if self.lo is not None or self.hi is not None:
            bad = F.lit(False)
            bad = bad if self.lo is None else bad | (v < F.lit(self.lo))
            bad = bad if self.hi is None else bad | (v > F.lit(self.hi))
            out.append((f"range[{self.lo},{self.hi}]", bad))
        if self.values:
            out.append(("isin", ~v.isin(*self.values)))
        if self.least is not None or self.most is not None:
            bad = F.lit(False)
            bad = bad if self.least is None else bad | (F.length(v) < self.least)
            bad = bad if self.most is None else bad | (F.length(v) > self.most)
            out.append((f"length[{self.least},{self.most}]", bad))
        return out

    def typed(self, c: str) -> Column:
        return F.col(f"`{c}`").try_cast(self.kind)


@dataclass(frozen=True)
class Table:
    """A table's columns in order and its unique keys (several columns of one key: joined by commas)."""
    columns: Mapping[str, Col]
    keys: Sequence[str] = field(default_factory=tuple)

    def names(self) -> list[str]:
        return list(self.columns)

    def only(self, *names: str) -> Table:
        """The table reduced to some of its columns, and to the keys that they hold."""
        return Table({n: self.columns[n] for n in names}, [k for k in self.keys if set(k.split(",")) <= set(names)])


def coerce(df: DataFrame, table: Table) -> DataFrame:
    """The schema's columns that ``df`` has, in its types; the other columns after them."""
    typed = [col.typed(c).alias(c) for c, col in table.columns.items() if c in df.columns]
    return df.select(*typed, *[F.col(f"`{c}`") for c in df.columns if c not in table.columns])


def rules_of(table: Table, present: Sequence[str]) -> list[q.Rule]:
    """Row rules on the raw table."""
    return [q.Rule(check, c, bad) for c, col in table.columns.items() if c in present for check, bad in col.rules(c)]


def check_table(df: DataFrame, name: str, table: Table | None = None, more: Sequence[q.Rule] = ()) -> DataFrame:
    """The report of every rule of a table, and of the row rules ``more``; absent columns are failures of their own."""
    if table is None:
        from .tables import TABLES
        table = TABLES[name]
    absent = [(name, "column_present", c, 1, 1, "fail") for c in table.names() if c not in df.columns]
    out = q.validate(df, name, [*rules_of(table, df.columns), *more])
    for key in table.keys:
        cols = key.split(",")
        if set(cols) <= set(df.columns):
            out = out.unionByName(q.check_unique(df, name, cols))
    if absent:
        out = out.unionByName(df.sparkSession.createDataFrame(absent, out.schema))
    return out


def judged(df: DataFrame, table: Table, keep: Sequence[str] = ()) -> DataFrame:
    """Every declared column in its type (NULL where ``df`` has none), the columns ``keep``, and
    ``_rejects``: the failed rules of the row as ``(column, check, value)``, empty for a good row.

    A record that the reader could not split (``_corrupt_record``) has that one entry.
    """
    reason = "struct<column:string,check:string,value:string>"
    failed = [F.when(F.coalesce(bad, F.lit(False)), F.struct(F.lit(c).alias("column"), F.lit(check).alias("check"),
                                                               F.col(f"`{c}`").cast("string").alias("value")))
              for c, col in table.columns.items() if c in df.columns for check, bad in col.rules(c)]
    found = F.filter(F.array(*failed), lambda r: r.isNotNull()) if failed else F.array().cast(f"array<{reason}>")
    if CORRUPT in df.columns:
        broken = F.array(F.struct(F.lit("*").alias("column"), F.lit("corrupt").alias("check"), F.col(CORRUPT).alias("value")))
        found = F.when(F.col(CORRUPT).isNotNull(), broken).otherwise(found)
    typed = [(col.typed(c) if c in df.columns else F.lit(None).cast(col.kind)).alias(c) for c, col in table.columns.items()]
    return df.select(*typed, *[F.col(f"`{c}`") for c in keep], found.cast(f"array<{reason}>").alias(REJECTS))
