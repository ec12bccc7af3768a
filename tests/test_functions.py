"""Scalar formulas: known answers of the reference tests + numpy twins."""
import hashlib
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from matchday.functions import cols as C


def one(spark, expr):
    return spark.range(1).select(expr.alias("v")).first()["v"]


def test_devig_two_way_known_answers(spark):
    assert one(spark, C.devig2(F.lit(2.0), F.lit(2.0))) == pytest.approx(0.5, abs=1e-12)
    want = (1 / 1.8) / (1 / 1.8 + 1 / 2.0)
    assert one(spark, C.devig2(F.lit(1.8), F.lit(2.0))) == pytest.approx(want, abs=1e-12)
    assert one(spark, C.devig2(F.lit(0.0), F.lit(2.0))) is None
    assert one(spark, C.devig2(F.lit(None).cast("double"), F.lit(2.0))) is None


def test_three_way_sums_to_one(spark):
    h, d, a = C.devig3(F.lit(2.0), F.lit(3.5), F.lit(3.2))
    r = spark.range(1).select(h.alias("h"), d.alias("d"), a.alias("a")).first()
    assert r.h + r.d + r.a == pytest.approx(1.0, abs=1e-12)
    h, d, a = C.devig3(F.lit(2.0), F.lit(None).cast("double"), F.lit(3.2))
    r = spark.range(1).select(h.alias("h"), d.alias("d"), a.alias("a")).first()
    assert (r.h, r.d, r.a) == (None, None, None)


@pytest.mark.parametrize("p", [0.2, 0.5, 0.8])
def test_poisson_inversion_reproduces_p(spark, p):
    lam = one(spark, C.poisson_lambda_ge3(F.lit(p)))
    back = 1 - math.exp(-lam) * (1 + lam + lam * lam / 2)
    assert back == pytest.approx(p, abs=1e-6)
    lam_jvm = one(spark, C.poisson_lambda_ge3_jvm(F.lit(p)))
    assert lam == pytest.approx(lam_jvm, abs=1e-11)


def test_poisson_nulls_and_clipping(spark):
    df = spark.createDataFrame([(None,), (0.0,), (1.0,)], "p double")
    out = [r.v for r in df.select(C.poisson_lambda_ge3("p").alias("v")).collect()]
    assert out[0] is None
    assert 0.0 < out[1] < 1e-1 and 7.9 < out[2] <= 8.0


def test_consensus_matches_numpy(spark):
    rows = [(1.5, 1.6, None, 1.7), (2.0, None, None, None), (None, None, None, None), (1.9, 2.1, 2.0, 2.2)]
    df = spark.createDataFrame(rows, "a double, b double, c double, d double")
    got = [r.v for r in df.select(C.consensus("a", "b", "c", "d").alias("v")).collect()]
    for row, g in zip(rows, got):
        vals = np.array([v for v in row if v is not None])
        if vals.size == 0:
            assert g is None
        else:
            assert g == pytest.approx(float(np.clip(1 - vals.std() / vals.mean(), 0, 1)), abs=1e-12)


def test_stable_bucket_is_md5_prefix(spark):
    want = int(hashlib.md5(b"Ref 3").hexdigest()[:8], 16) % 10000
    assert one(spark, C.stable_bucket(F.lit("Ref 3"))) == want
    assert one(spark, C.stable_bucket(F.lit("  "))) == -1
    assert one(spark, C.stable_bucket(F.lit(None).cast("string"))) == -1


def test_clip_and_tier_propagate_null(spark):
    assert one(spark, C.clip_null(F.lit(None).cast("double"), 0.0, 1.0)) is None
    assert one(spark, C.clip_null(F.lit(7.0), 0.0, 5.0)) == 5.0
    assert one(spark, C.tier(F.lit(0.3))) == 1
    assert one(spark, C.tier(F.lit(4.99))) == 4
    assert one(spark, C.tier(F.lit(9.0))) == 5


def test_num_is_lenient(spark):
    df = spark.createDataFrame([("3.5",), ("abc",), ("nan",), (None,), (" 2 ",)], "s string")
    assert [r.v for r in df.select(C.num("s").alias("v")).collect()] == [3.5, None, None, None, 2.0]


def test_split_goals_and_clean_sheet(spark):
    hxg, axg = C.split_goals(F.lit(3.0), F.lit(0.5), F.lit(0.2), F.lit(0.3))
    r = spark.range(1).select(hxg.alias("h"), axg.alias("a"), C.clean_sheet(F.lit(3.0), hxg).alias("cs")).first()
    assert r.h == pytest.approx(3.0 * 0.6) and r.a == pytest.approx(3.0 * 0.4)
    assert r.cs == pytest.approx(max(0.0, 1 - 3.0 * 0.6 * 0.3))


def test_first_pair_needs_both(spark):
    x, y = C.first_pair((F.lit(1.0), F.lit(None).cast("double")), (F.lit(2.0), F.lit(3.0)))
    r = spark.range(1).select(x.alias("x"), y.alias("y")).first()
    assert (r.x, r.y) == (2.0, 3.0)


def test_age_text_and_season(spark):
    assert one(spark, C.age_text(F.lit(30))) == "Less than a minute ago"
    assert one(spark, C.age_text(F.lit(60))) == "1 minute ago"
    assert one(spark, C.age_text(F.lit(7300))) == "2 hours ago"
    assert one(spark, C.age_text(F.lit(86400 * 3))) == "3 days ago"
    assert one(spark, C.season_short(F.lit("2024-2025"))) == "2024-25"
    assert one(spark, C.season_code(F.lit("2025-26"))) == "2526"


def test_weighted_flags_capped(spark):
    v = C.weighted_flags([(F.lit(True), 3), (F.lit(True), 2), (F.lit(None).cast("boolean"), 1)], 3)
    assert one(spark, v) == 3


def test_age_description(spark):
    assert one(spark, C.age_description(F.lit(0.5))) == "Very fresh (updated 30 minutes ago)"
    assert one(spark, C.age_description(F.lit(5.25))) == "Fresh (updated 5.3 hours ago)"
    assert one(spark, C.age_description(F.lit(30.0))) == "Stale (updated 30.0 hours ago)"
    assert one(spark, C.age_description(F.lit(72.0))) == "Very stale (updated 3.0 days ago)"
    assert one(spark, C.age_bucket(F.lit(3.0))) == "fresh"
