"""A refresh end to end: landed documents -> raw tables -> the seven derived tables.

The bootstrap documents are read once and staged as Parquet, from which every section reads its
own field alone. Tables are written a few at a time; one that fails, in planning or in running,
is reported and leaves the others and its own stored state as they were. Derived tables read
the raw tables that are stored, so a raw table that failed today is yesterday's there.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..quality.tables import DERIVED
from ..session import ensure_checkpoint_dir
from ..sources.flatten import BOOTSTRAP_SECTIONS, flatten_section, game_settings
from ..sources.sinks import save_many
from . import features as feat

WORKERS = 4
# Derived tables that hold one row set per gameweek are replaced gameweek by gameweek.
BY_GAMEWEEK = {t: "gameweek" for t in DERIVED}


def refresh_raw(docs: DataFrame, root: str, as_of, sections: Mapping[str, dict] | None = None,
                workers: int = WORKERS) -> dict[str, str]:
    """Write every section of the bootstrap documents, and the settings, from one read; ``{table: status}``."""
    spark = docs.sparkSession
    staged = f"{ensure_checkpoint_dir(spark)}/refresh-{uuid.uuid4().hex}"
    docs.write.parquet(staged)
    once = spark.read.schema(docs.schema).parquet(staged)
    nested = "doc" in once.columns
    tables = {}
    for name, spec in (sections or BOOTSTRAP_SECTIONS).items():
        spec = dict(spec, path=f"doc.{spec['path']}") if nested else dict(spec)
        tables[name] = lambda spec=spec: flatten_section(once, as_of=as_of, **spec)
    if sections is None:
        tables["raw_game_settings"] = lambda: game_settings(once, as_of)
    out = save_many(tables, root, workers=workers)
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(staged)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
    return out


def derived_tables(inputs: Mapping[str, DataFrame], gameweek: int, as_of) -> dict:
    """The seven derived tables of a gameweek as functions that plan them; ``inputs`` holds
    ``players``, ``teams``, ``fixtures``, ``history`` and ``odds``."""
    i = inputs
    return {
        "player_metrics": lambda: feat.player_metrics(i["players"], gameweek, as_of),
        "team_form": lambda: feat.team_form(i["teams"], i["fixtures"], gameweek, as_of),
        "fixture_difficulty": lambda: feat.fixture_difficulty(i["fixtures"], i["teams"], as_of),
        "value_analysis": lambda: feat.value_analysis(i["players"], i["history"], gameweek, as_of),
        "ownership_trends": lambda: feat.ownership_trends(i["players"], i["history"], gameweek, as_of),
        "fixture_runs": lambda: feat.fixture_runs(i["players"], i["fixtures"], i["teams"], gameweek, as_of),
        "betting_features": lambda: feat.betting_features(i["odds"], i["fixtures"], i["players"], as_of),
    }


def refresh_derived(inputs: Mapping[str, DataFrame], root: str, gameweek: int, as_of, workers: int = WORKERS) -> dict[str, str]:
    """Compute and store the derived tables of a gameweek; other gameweeks stay. ``{table: status}``."""
    return save_many(derived_tables(inputs, gameweek, as_of), root, partition_cols=BY_GAMEWEEK, workers=workers)


def refresh_season(inputs: Mapping[str, DataFrame], root: str, as_of, workers: int = WORKERS,
                   periods: DataFrame | None = None) -> dict[str, str]:
    """All derived tables of every gameweek (K5), one plan per table. ``inputs["players"]`` has a ``gameweek`` column."""
    i = inputs
    tables = {t: (lambda t=t: feat.derive_periods(
        t, i["players"], as_of, i["history"], teams=i["teams"], fixtures=i["fixtures"], odds=i["odds"], periods=periods))
        for t in DERIVED}
    return save_many(tables, root, partition_cols=BY_GAMEWEEK, workers=workers)


def stored(spark: SparkSession, root: str, table: str, gameweek: int | None = None) -> DataFrame:
    """A stored table; of one gameweek only that folder is read."""
    df = spark.read.parquet(f"{root}/{table}")
    return df if gameweek is None else df.where(F.col("gameweek") == gameweek)
