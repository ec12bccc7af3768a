"""Property-based checks of the distributed operators against pandas."""
import pandas as pd
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from matchday.operators import rank

rows_strategy = st.lists(st.tuples(st.integers(0, 3), st.one_of(st.none(), st.integers(-5, 5).map(float))),
                         min_size=1, max_size=60)


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=rows_strategy, buckets=st.sampled_from([2, 3, 8]))
def test_pct_rank_equals_pandas(spark, rows, buckets):
    data = [(i, g, v) for i, (g, v) in enumerate(rows)]
    df = spark.createDataFrame(data, "id long, g int, v double")
    got = {r.id: r.p for r in rank.pct_rank_avg(df, "v", "g", out="p", buckets=buckets).collect()}
    pdf = pd.DataFrame(data, columns=["id", "g", "v"])
    pdf["want"] = (pdf.groupby("g").v.rank(pct=True) * 100).fillna(50.0)
    for i, w in zip(pdf.id, pdf.want):
        assert got[i] == pytest.approx(w, abs=1e-9)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=st.lists(st.tuples(st.integers(0, 4), st.integers(0, 20), st.integers(0, 3)), min_size=1, max_size=40))
def test_latest_by_equals_sort_last(spark, rows):
    data = [(k, t, x, i) for i, (k, t, x) in enumerate(rows)]
    df = spark.createDataFrame(data, "k int, t int, x int, i int")
    got = {r.k: (r.t, r.i) for r in rank.latest_by(df, "k", ["t", "i"]).collect()}
    pdf = pd.DataFrame(data, columns=["k", "t", "x", "i"]).sort_values(["k", "t", "i"]).groupby("k").tail(1)
    assert got == {k: (t, i) for k, t, i in zip(pdf.k, pdf.t, pdf.i)}
