"""Join operators.

Broadcast policy: a ``broadcast()`` hint is only placed on inputs whose size
is bounded by construction (literal alias maps, one-row aggregates). Every
other join is left to Catalyst/AQE, which broadcast a side only when its
measured size is under ``spark.sql.autoBroadcastJoinThreshold`` and otherwise
keep a shuffle join (with AQE skew splitting for hot keys).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def _cols(x) -> list[str]:
    return [x] if isinstance(x, str) else list(x)


class DuplicateKeyError(ValueError):
    """A side of a one-to-one join (or an append-only write) repeats a key."""


def duplicate_keys(df: DataFrame, key) -> DataFrame:
    """Keys that occur more than once, with their multiplicity (``n``)."""
    k = _cols(key)
    return df.groupBy(*k).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)


def assert_unique(df: DataFrame, key, what: str = "input") -> None:
    """Raise :class:`DuplicateKeyError` if ``key`` repeats (one distributed job)."""
    bad = duplicate_keys(df, key).limit(1).collect()
    if bad:
        raise DuplicateKeyError(f"{what}: key {list(_cols(key))} is not unique, e.g. {bad[0].asDict()}")


def unique_or_raise(df: DataFrame, key, what: str = "input") -> DataFrame:
    """``df`` itself, failing when it runs if ``key`` repeats.

    The count is a window on the key, so a join on the same key adds no
    shuffle and no job runs while the plan is built.
    """
    k = _cols(key)
    n = F.count(F.lit(1)).over(Window.partitionBy(*k))
    said = F.concat(F.lit(f"{what}: key {k} is not unique, e.g. "), F.to_json(F.struct(*k)))
    one = F.when(F.col("__n") > 1, F.raise_error(said).cast("boolean")).otherwise(F.lit(True))
    return df.withColumn("__n", n).where(one).drop("__n")


# --------------------------------------------------------------------------- C1
def join_one_to_one(left: DataFrame, right: DataFrame, on, check: bool | str = True) -> DataFrame:
    """Inner equi-join that requires both sides to be key-unique.

    ``check`` true: by a job per side before the join is built; ``"lazy"``: inside
    the plan, as it runs. On overlapping non-key columns the right side wins.
    """
    k = _cols(on)
    if check == "lazy":
        left, right = unique_or_raise(left, k, "left side"), unique_or_raise(right, k, "right side")
    elif check:
        assert_unique(left, k, "left side")
        assert_unique(right, k, "right side")
    overlap = [c for c in left.columns if c in right.columns and c not in k]
    return left.drop(*overlap).join(right, k, "inner")


# --------------------------------------------------------------------------- C2
def left_join_suffix(left: DataFrame, right: DataFrame, on, suffix: str = "_right") -> DataFrame:
    """Left join; right columns that clash with left ones get ``suffix``."""
    k = _cols(on)
    ren = {c: c + suffix for c in right.columns if c in left.columns and c not in k}
    return left.join(right.withColumnsRenamed(ren) if ren else right, k, "left")


# --------------------------------------------------------------------------- C3
def join_filter(left: DataFrame, right: DataFrame, on, predicate: Column) -> DataFrame:
    """Keep left rows whose partner on ``on`` satisfies ``predicate`` (semi join)."""
    return left.join(right.where(predicate), _cols(on), "left_semi")


# --------------------------------------------------------------------------- C4
def match_exactly_one(left: DataFrame, right: DataFrame, keys: Mapping[str, str], left_id: str,
                      right_cols: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Attach ``right_cols`` to each left row that has exactly one candidate.

    ``keys`` maps left column -> right column. Returns ``(matched, unmatched)``
    where unmatched are the left rows with zero or several candidates.
    Candidates are first summarised per key on the right (count + the
    columns of the single candidate), so each left row meets one summary row:
    no candidate pairs are ever formed, whatever the multiplicity of a key.
    """
    rk = list(keys.values())
    summary = (right.groupBy(*[F.col(c).alias(f"__k{i}") for i, c in enumerate(rk)])
               .agg(F.count(F.lit(1)).alias("__n"), *[F.min(F.col(c)).alias(c) for c in right_cols]))
    cond = None
    for i, lc in enumerate(keys):
        c = F.col(lc) == F.col(f"__k{i}")
        cond = c if cond is None else cond & c
    clash = [c for c in right_cols if c in left.columns and c != left_id]
    j = left.drop(*clash).join(summary, cond, "left")
    one = F.coalesce(F.col("__n") == 1, F.lit(False))
    drop = [f"__k{i}" for i in range(len(rk))] + ["__n"]
    matched = j.where(one).drop(*drop)
    unmatched = j.where(~one).drop(*drop, *right_cols).select(*[c for c in left.columns])
    return matched, unmatched


# --------------------------------------------------------------------------- C5
def alias_table(spark: SparkSession, mapping: Mapping[str, str], src: str = "alias", dst: str = "canonical") -> DataFrame:
    """A literal name -> name map as a (tiny, broadcastable) DataFrame."""
    return spark.createDataFrame(list(mapping.items()), f"{src} string, {dst} string")


def resolve_names(df: DataFrame, col: str, out: str, dim: DataFrame, dim_name: str, dim_id: str,
                  *alias_maps: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Map a free-text name to a dimension id through alias maps.

    Each alias map (columns ``alias``, ``canonical``) is applied in turn
    (first hit wins), then the name is looked up in ``dim``. Returns
    ``(resolved, rejected)``; rejected rows keep their original columns.
    """
    name = F.col(col)
    cur = df.withColumn("__name", name)
    for i, am in enumerate(alias_maps):
        a = F.broadcast(am.select(F.col("alias").alias(f"__a{i}"), F.col("canonical").alias(f"__c{i}")))
        cur = (cur.join(a, F.col("__name") == F.col(f"__a{i}"), "left")
               .withColumn("__name", F.coalesce(F.col(f"__c{i}"), F.col("__name")))
               .drop(f"__a{i}", f"__c{i}"))
    d = dim.select(F.col(dim_name).alias("__dn"), F.col(dim_id).alias(out))
    joined = cur.join(d, F.col("__name") == F.col("__dn"), "left").drop("__dn", "__name")
    return joined.where(F.col(out).isNotNull()), joined.where(F.col(out).isNull()).drop(out)


# --------------------------------------------------------------------------- C6
def name_variants(people: DataFrame, id_col: str, order: str, variants: Sequence[Column]) -> DataFrame:
    """``(name, id)`` from several name variants per person; first writer wins.

    Variants are tried in ``order`` of the people, then in list order; blank
    variants are skipped. The winner per name is picked with a ``min`` over
    a struct (partial aggregate, safe for very common names).
    """
    arr = F.array(*[F.struct(F.lit(i).alias("pos"), F.trim(v).alias("name")) for i, v in enumerate(variants)])
    ex = (people.select(F.col(order).alias("__ord"), F.col(id_col).alias("__id"), F.inline(arr))
          .where(F.col("name").isNotNull() & (F.col("name") != "")))
    best = ex.groupBy("name").agg(F.min(F.struct("__ord", "pos", "__id")).alias("__w"))
    return best.select("name", F.col("__w.__id").alias(id_col))


def resolve_variants(rows: DataFrame, name: Column, people: DataFrame, id_col: str, order: str,
                     variants: Sequence[Column], out: str = "mapped_id") -> DataFrame:
    """Left-join ``rows`` to the variant map on ``name``; unmatched -> NULL."""
    m = name_variants(people, id_col, order, variants).withColumnRenamed(id_col, out)
    return rows.withColumn("__key", name).join(m, F.col("__key") == F.col("name"), "left").drop("__key", "name")


# --------------------------------------------------------------------------- C8
def new_entities(current: DataFrame, history: DataFrame, key: str, period_col: str, period) -> DataFrame:
    """Keys of ``current`` with no ``history`` row before ``period``.

    Empty history before ``period`` means "no history yet" and yields no new
    entities; so does period <= 1.
    """
    p = period if isinstance(period, Column) else F.lit(period)
    before = history.where(F.col(period_col) < p)
    cur = current.select(key).distinct().where(p > 1)
    fresh = cur.join(before.select(key), key, "left_anti")
    gate = before.select(F.lit(1).alias("__one")).limit(1)
    return (fresh.withColumn("__one", F.lit(1))
            .join(F.broadcast(gate), "__one", "left_semi").drop("__one"))


# --------------------------------------------------------------------------- C9
def lookup_or_default(df: DataFrame, dim: DataFrame, left_on: str, right_on: str,
                      cols_defaults: Mapping[str, object], prefix: str = "") -> DataFrame:
    """Left lookup of ``cols_defaults`` keys in ``dim``; missing -> default."""
    sel = [F.col(right_on).alias("__k")] + [F.col(c).alias(f"__d_{c}") for c in cols_defaults]
    j = df.join(dim.select(*sel), F.col(left_on) == F.col("__k"), "left")
    for c, dflt in cols_defaults.items():
        j = j.withColumn(prefix + c, F.coalesce(F.col(f"__d_{c}"), F.lit(dflt)))
    return j.drop("__k", *[f"__d_{c}" for c in cols_defaults])


# --------------------------------------------------------------------------- C10
def fill_nulls(df: DataFrame, lookup: DataFrame, on, col: str, lookup_col: str | None = None) -> DataFrame:
    """Fill NULLs of ``col`` from ``lookup`` (non-null values are kept)."""
    k = _cols(on)
    lc = lookup_col or col
    lk = lookup.select(*k, F.col(lc).alias("__fill"))
    return (df.join(lk, k, "left")
            .withColumn(col, F.coalesce(F.col(col), F.col("__fill"))).drop("__fill"))


# --------------------------------------------------------------------------- C11
def orphans(child: DataFrame, parent: DataFrame, child_key: str, parent_key: str) -> DataFrame:
    """Child rows whose non-null key has no parent row."""
    p = parent.select(F.col(parent_key).alias("__pk"))
    return (child.where(F.col(child_key).isNotNull())
            .join(p, F.col(child_key) == F.col("__pk"), "left_anti"))


# --------------------------------------------------------------------------- C7
def fan_out(features: DataFrame, members: DataFrame, on="team_id") -> DataFrame:
    """Attach per-team features to every member of that team (inner join)."""
    return features.join(members, _cols(on), "inner")
