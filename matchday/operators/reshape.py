"""Home/away perspective unpivot (E5).

One fixture row becomes two team-perspective rows in a single pass
(``inline`` of a two-element array of structs): no self-union, no second
scan of the input.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _expr(x) -> Column:
    if isinstance(x, Column):
        return x
    if isinstance(x, str):
        return F.col(x)
    return F.lit(x)


def perspectives(df: DataFrame, home: Mapping[str, object], away: Mapping[str, object],
                 keep: Sequence[str] = ()) -> DataFrame:
    """Emit one row per side.

    ``home`` / ``away`` map each output column to a column name, a Column or
    a literal, and must have the same keys in the same order. ``keep`` are
    input columns repeated on both rows.
    """
    if list(home) != list(away):
        raise ValueError("home and away must define the same output columns in the same order")
    h = F.struct(*[_expr(v).alias(k) for k, v in home.items()])
    a = F.struct(*[_expr(v).alias(k) for k, v in away.items()])
    return df.select(*keep, F.inline(F.array(h, a)))


def fixture_sides(fixtures: DataFrame, home_col: str = "home_team_id", away_col: str = "away_team_id",
                  home_score: str | None = None, away_score: str | None = None,
                  keep: Sequence[str] = ()) -> DataFrame:
    """Team-perspective rows of a fixture table: team_id, opponent_id, is_home
    (+ goals_for / goals_against when score columns are given)."""
    hm = {"team_id": home_col, "opponent_id": away_col, "is_home": F.lit(True)}
    aw = {"team_id": away_col, "opponent_id": home_col, "is_home": F.lit(False)}
    if home_score and away_score:
        hm.update(goals_for=home_score, goals_against=away_score)
        aw.update(goals_for=away_score, goals_against=home_score)
    return perspectives(fixtures, hm, aw, keep=keep)
