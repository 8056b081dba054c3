import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from driftloom.operators import drift as dr
from driftloom.operators import stored_profiles as sp


def table(spark, n=4000, seed=1, shift=0.0):
    rng = np.random.default_rng(seed)
    a = rng.standard_normal(n) * 3 + shift
    b = rng.lognormal(0, 2, n) * rng.choice([-1, 1], n)
    c = rng.integers(-3, 4, n).astype(float)
    rows = [(i, float(a[i]), None if i % 9 == 0 else float(b[i]), float("nan") if i % 7 == 0 else float(c[i])) for i in range(n)]
    return spark.createDataFrame(rows, "id long, a double, b double, c double").repartition(4, "id")


def cells(profile):
    return {(r.feature, r.cell): (r.n, r.low, r.high, round(r.s1, 9), round(r.s2, 9)) for r in profile.collect()}


def test_merge_of_parts_is_the_whole(spark, tmp_path):
    df = table(spark)
    whole = sp.stored_profile(df, ["a", "b", "c"])
    for day in range(3):
        sp.save_profile(sp.stored_profile(df.where(F.col("id") % 3 == day), ["a", "b", "c"]), str(tmp_path), f"2024-01-0{day + 1}")
    sp.save_profile(sp.stored_profile(df.where("id % 3 = 1"), ["a", "b", "c"]), str(tmp_path), "2024-01-02")  # again
    assert cells(sp.load_profile(spark, str(tmp_path))) == cells(whole)
    some = sp.load_profile(spark, str(tmp_path), "2024-01-02", "2024-01-03")
    assert cells(some) == cells(sp.stored_profile(df.where("id % 3 > 0"), ["a", "b", "c"]))


def test_moments_and_quantiles(spark):
    df = table(spark, shift=1e6)
    profile = sp.stored_profile(df, ["a", "b", "c"])
    want = {r.feature: r for r in dr.reference_profile(df, ["a", "b", "c"]).collect()}
    for r in sp.profile_moments(profile).collect():
        assert (r.n, r.min, r.max) == (want[r.feature].n, want[r.feature].min, want[r.feature].max)
        assert math.isclose(r["mean"], want[r.feature]["mean"], rel_tol=1e-9, abs_tol=1e-9)
        assert math.isclose(r["std"], want[r.feature]["std"], rel_tol=1e-7)
    values = {c: sorted(r[0] for r in df.select(c).where(f"{c} is not null and not isnan({c})").collect()) for c in "abc"}
    asked = [0.0, 0.01, 0.25, 0.5, 0.9, 1.0]
    got = sp.profile_quantiles(profile, asked).collect()
    assert len(got) == 18
    for r in got:
        exact = values[r.feature][max(math.ceil(r.p * len(values[r.feature])), 1) - 1]
        assert abs(r.value - exact) <= 0.00101 * abs(exact)


@pytest.mark.parametrize("accuracy", [0.001, 0.05])
def test_bounds_hold_the_score_of_the_rows(spark, accuracy):
    for seed, shift in ((2, 0.0), (3, 2.0)):
        left, right = table(spark), table(spark, 900, seed, shift)
        exact = {r.feature: r for r in dr.drift(left, right, ["a", "b", "c"]).collect()}
        kept = sp.drift_of_profiles(*[sp.stored_profile(t, ["a", "b", "c"], accuracy=accuracy) for t in (left, right)])
        for r in kept.collect():
            e = exact[r.feature]
            assert r.score_low - 1e-9 <= e.drift_score <= r.score_high + 1e-9
            assert r.score_low - 1e-9 <= r.drift_score <= r.score_high + 1e-9
            if r.feature == "c":
                assert math.isclose(r.score_high, e.drift_score, abs_tol=1e-12) and math.isclose(r.score_low, e.drift_score, abs_tol=1e-12)


def test_awkward_columns(spark):
    schema = "const double, only_left double, none double, odd double"
    left = spark.createDataFrame([(5.0, 1.0, None, float("inf")), (5.0, 2.0, None, 0.0), (5.0, 3.0, float("nan"), -1e-300)], schema)
    right = spark.createDataFrame([(5.0, None, None, 1e300), (5.0, None, None, -0.0)], schema)
    got = {r.feature: r for r in sp.drift_of_profiles(sp.stored_profile(left), sp.stored_profile(right)).collect()}
    assert sorted(got) == ["const", "odd", "only_left"]
    assert (got["const"].drift_score, got["const"].score_high) == (0.0, 0.0)
    assert (got["only_left"].drift_score, got["only_left"].drift_detected, got["only_left"].production_n) == (None, False, 0)
    assert (got["odd"].reference_n, got["odd"].production_n) == (2, 2)
    empty = sp.stored_profile(left.limit(0))
    assert empty.count() == 0 and sp.drift_of_profiles(empty, empty).count() == 0
    with pytest.raises(ValueError, match="accuracy"):
        sp.drift_of_profiles(sp.stored_profile(left), sp.stored_profile(right, accuracy=0.01))
    with pytest.raises(ValueError, match="part"):
        sp.save_profile(empty, "/nowhere", "a/b")


def test_profile_shuffles_cells_not_rows(spark):
    plan = sp.stored_profile(table(spark), ["a", "b"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning(feature") == 1 and "partial_count" in plan
