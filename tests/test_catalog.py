"""Every registered query against its DuckDB oracle (sf0.001: fast)."""
import math
import os

import duckdb
import pytest

import __spark_entry__ as entry
from matchday.plans.catalog import all_queries

SF = os.environ.get("MATCHDAY_TEST_SF", "/root/testdata/sf0.001")
TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()
# the catalog's own queries; an optional subpackage may register more
QUERIES = {k: entry.queries()[k] for k in all_queries()}
SQL = {k: v for k, v in entry.oracle_sql().items() if k in QUERIES}

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test data not present")


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


def _norm(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return None
    if isinstance(v, float):
        return round(v, 6)
    if hasattr(v, "isoformat"):
        return v.isoformat()
    return v


def _rows(pdf):
    cols = sorted(pdf.columns)
    return sorted((tuple(_norm(x) for x in r) for r in pdf[cols].astype(object).itertuples(index=False, name=None)),
                  key=repr)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(SQL)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    got = QUERIES[name](spark, SF).toPandas()
    want = con.execute(SQL[name]).fetchdf()
    assert sorted(got.columns) == sorted(want.columns)
    assert len(got) == len(want)
    assert _rows(got) == _rows(want)


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() >= 0 and "player_id" in df.columns


SPARK_TO_DUCK = {"bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN",
                 "timestamp_ntz": "TIMESTAMP"}


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_types_match_oracle(spark, con, name):
    rel = con.sql(SQL[name])
    duck = dict(zip(rel.columns, [str(t) for t in rel.types]))
    for col, t in QUERIES[name](spark, SF).dtypes:
        assert duck[col] == SPARK_TO_DUCK.get(t, t), (col, t, duck[col])
