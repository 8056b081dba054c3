import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from driftloom.functions.binning import unit_bin, unit_edges
from driftloom.functions.pvalue import exact_law, ks_pvalue, limit_law
from driftloom.operators import drift as dr
from driftloom.operators import features as ft


def two(spark, a, b, name="x"):
    def build(v):
        return spark.createDataFrame([(float(i),) if i is not None else (None,) for i in v], f"{name} double")

    return build(a), build(b)


def psi_by_hand(a, b, bins=10):
    lo, hi = min(a.min(), b.min()), max(a.max(), b.max())
    if lo == hi:
        return 0.0
    edges = np.linspace(0, 1, bins + 1)
    e, p = (np.histogram((v - lo) / (hi - lo), bins=edges)[0] / len(v) for v in (a, b))
    e, p = np.where(e == 0, 1e-4, e), np.where(p == 0, 1e-4, p)
    return float(np.sum((p - e) * np.log(p / e)))


def js_by_hand(p, q):
    p, q = p / p.sum(), q / q.sum()
    m = (p + q) / 2
    terms = [x * np.log(x / y) if x > 0 else 0.0 for v in (p, q) for x, y in zip(v, m)]
    return math.sqrt(sum(terms) / 2)


def gap_by_hand(a, b):
    at = np.unique(np.concatenate([a, b]))
    fa = np.searchsorted(np.sort(a), at, side="right") / len(a)
    fb = np.searchsorted(np.sort(b), at, side="right") / len(b)
    return float(np.abs(fa - fb).max())


def test_bins_follow_the_literal_edges(spark):
    assert unit_edges(10) == np.linspace(0, 1, 11).tolist()
    x = [0.0, 0.1, 0.2, 0.3, 0.30000000000000004, 0.6, 0.7, 0.9999, 1.0]
    df = spark.createDataFrame([(v,) for v in x], "x double")
    assert [r[0] for r in df.select(unit_bin(F.col("x"), 10)).collect()] == [0, 1, 2, 2, 3, 5, 6, 9, 9]


def test_bins_match_numpy(spark):
    rng = np.random.default_rng(0)
    for bins in (3, 7, 10, 49):
        edges = np.linspace(0, 1, bins + 1)
        x = np.concatenate([rng.random(200), edges, np.nextafter(edges[1:], 0), np.nextafter(edges[:-1], 1)])
        df = spark.createDataFrame([(float(v),) for v in x], "x double")
        got = [r[0] for r in df.select(unit_bin(F.col("x"), bins)).collect()]
        want = np.minimum(np.searchsorted(edges, x, side="right") - 1, bins - 1)
        assert got == want.tolist()


@pytest.mark.parametrize("kind", ["shifted", "ties", "outlier"])
def test_psi_and_js(spark, kind):
    rng = np.random.default_rng(4)
    a, b = rng.normal(size=400), rng.normal(0.4, 1.2, size=300)
    if kind == "ties":
        a, b = np.round(a), np.round(b)
    if kind == "outlier":
        a[0] = 1000
    ref, prod = two(spark, a, b)
    (r,) = dr.drift(ref, prod, method="psi").collect()
    assert r["drift_score"] == pytest.approx(psi_by_hand(a, b))
    assert r["drift_detected"] == (r["drift_score"] > 0.25)
    assert r["reference_mean"] == pytest.approx(a.mean()) and r["production_std"] == pytest.approx(b.std())
    lo, hi = min(a.min(), b.min()), max(a.max(), b.max())
    edges = np.linspace(0, 1, 11)
    hist = [np.histogram((v - lo) / (hi - lo), bins=edges)[0].astype(float) for v in (a, b)]
    (r,) = dr.drift(ref, prod, method="js").collect()
    assert r["drift_score"] == pytest.approx(js_by_hand(*hist))


def test_equal_and_constant(spark):
    for values in ([1, 2, 3, 4, 5], [7, 7, 7]):
        ref, prod = two(spark, values, values)
        for method in dr.METHODS:
            assert dr.drift(ref, prod, method=method).first()["drift_score"] == pytest.approx(0.0, abs=1e-12)
        assert dr.ks_statistic(ref, prod).first()["d"] == 0.0


def test_many_features_agree_with_few(spark):
    """More than a handful of features take the row-wise form; same scores."""
    rng = np.random.default_rng(9)
    names = [f"f{i}" for i in range(12)]
    a, b = rng.normal(size=(200, 12)), rng.normal(0.3, 1, size=(150, 12))
    b[:, 3] = a[0, 3]
    a[:, 3] = a[0, 3]
    schema = ", ".join(f"{n} double" for n in names)
    ref, prod = (spark.createDataFrame([tuple(map(float, r)) for r in m], schema) for m in (a, b))
    for method in dr.METHODS:
        wide = {r["feature"]: r for r in dr.drift(ref, prod, method=method).collect()}
        assert list(wide) and set(wide) == set(names)
        for n in names[:4]:
            few = dr.drift(ref, prod, [n], method=method).first().asDict()
            want = {k: v if isinstance(v, (str, bool)) else pytest.approx(v) for k, v in few.items()}
            assert wide[n].asDict() == want
    assert wide["f3"]["drift_score"] == 0.0


def test_missing_values_are_skipped(spark):
    ref, prod = two(spark, [1, 2, 3, 4, float("nan"), None], [2, 3, 4, 5, 6])
    got = dr.drift(ref, prod).first()
    assert got["drift_score"] == pytest.approx(psi_by_hand(np.array([1.0, 2, 3, 4]), np.array([2.0, 3, 4, 5, 6])))
    assert got["reference_mean"] == 2.5


@pytest.mark.parametrize("kind", ["shift", "same", "ties", "hot"])
@pytest.mark.parametrize("bucket_rows", [40, 100_000])
def test_ks_search_equals_direct(spark, monkeypatch, kind, bucket_rows):
    monkeypatch.setattr(dr, "KS_MAX_BUCKETS", 9)
    rng = np.random.default_rng(11)
    a, b = rng.normal(size=700), rng.normal(size=900)
    if kind == "shift":
        b = b + 0.5
    if kind == "ties":
        a, b = np.round(a * 2), np.round(b * 2 + 0.3)
    if kind == "hot":
        a[: len(a) // 3] = 0.25
    ref, prod = two(spark, a, b)
    want = gap_by_hand(a, b)
    assert dr.ks_statistic(ref, prod).first()["d"] == pytest.approx(want, abs=1e-12)
    search = dr.ks_statistic(ref, prod, direct_rows=0, bucket_rows=bucket_rows)
    assert search.first()["d"] == pytest.approx(want, abs=1e-12)


def test_p_values():
    # exact law against counting all arrangements of small samples
    from itertools import combinations

    for n, m in ((3, 3), (4, 2), (5, 3)):
        spots = range(n + m)
        gaps = []
        for left in combinations(spots, n):
            i = j = 0
            top = 0.0
            for s in spots:
                if s in left:
                    i += 1
                else:
                    j += 1
                top = max(top, abs(i / n - j / m))
            gaps.append(top)
        for d in sorted(set(gaps)):
            share = sum(g >= d - 1e-12 for g in gaps) / len(gaps)
            assert exact_law(d, n, m) == pytest.approx(share)
    assert exact_law(0.0, 10, 10) == 1.0 and exact_law(1.0, 400, 300) < 1e-12
    assert limit_law(0.0, 10, 10) == 1.0
    n = m = 5000
    d = 0.02
    assert exact_law(d, n, m) == pytest.approx(limit_law(d, n, m), abs=5e-3)
    lam = 1.18 / math.sqrt(n * m / (n + m))
    assert limit_law(lam - 1e-9, n, m) == pytest.approx(limit_law(lam + 1e-9, n, m), abs=1e-6)
    assert ks_pvalue(None, 3, 3) is None


def test_js_positional(spark):
    a, b = np.array([1.0, 2, 3, 0]), np.array([2.0, 2, 1, 1])

    def build(v):
        return spark.createDataFrame([(i, float(x)) for i, x in enumerate(v)], "id int, w double")

    got = dr.js_positional(build(a), build(b).repartition(3), ["id"]).first()
    assert got["score"] == pytest.approx(js_by_hand(a, b))
    assert dr.js_positional(build([1, -2, 5, 1]), build(b), ["id"]).first()["score"] == float("inf")


def test_contracts(spark):
    ref, prod = two(spark, [1, 2], [1, 2])
    with pytest.raises(ValueError, match="not supported"):
        dr.drift(ref, prod, method="other")
    with pytest.raises(ValueError, match="reference data"):
        dr.drift(None, prod)
    with pytest.raises(ValueError, match="not found"):
        dr.drift(ref, prod.withColumnRenamed("x", "y"), ["x"])


@pytest.mark.parametrize(
    "method,score,level",
    [
        ("psi", 0.0999, "none"), ("psi", 0.1, "low"), ("psi", 0.25, "moderate"), ("psi", 0.5, "high"),
        ("js", 0.0999, "none"), ("js", 0.1, "low"), ("js", 0.3, "moderate"), ("js", 0.5, "high"),
        ("ks", 0.94, "none"), ("ks", 0.96, "low"), ("ks", 0.995, "moderate"), ("ks", 0.9995, "high"),
        ("other", 0.3, "unknown"),
    ],
)
def test_severity(spark, method, score, level):
    assert spark.range(1).select(dr.severity(method, F.lit(score))).first()[0] == level


def test_published_summary(spark):
    """The seven non-zero scores among fifty published features."""
    scores = {13: 0.3938025575621644, 17: 0.3105111916319226, 26: 0.8806685684929288, 30: 0.3495874851287056,
              39: 0.22132517423282913, 45: 0.23665621987363605, 48: 1.6223130288477599}
    rows = [(str(i), scores.get(i, 0.0), scores.get(i, 0.0) > 0.25) for i in range(50)]
    detail = spark.createDataFrame(rows, "feature string, drift_score double, drift_detected boolean")
    s = dr.with_severity(dr.drift_summary(detail), "psi", "max_drift_score").first()
    assert s["max_drift_score"] == pytest.approx(1.6223, abs=1e-4)
    assert (s["features_with_drift"], s["total_features"], s["drift_percentage"]) == (5, 50, 10.0)
    assert s["drift_detected"] and s["severity"] == "high"
    assert s["mean_drift_score"] == pytest.approx(4.0149 / 50, abs=1e-6)
    top = dr.top_drift(detail).collect()
    assert len(top) == 10 and top[0]["feature"] == "48" and top[7]["drift_score"] == 0.0


def test_drift_of_transformed_columns(spark):
    rng = np.random.default_rng(6)
    names = ["a", "b", "c"]
    schema = ", ".join(f"{n} double" for n in names)
    x, y = rng.normal(size=(120, 3)), rng.normal(0.5, 1, size=(100, 3))
    ref, prod = (spark.createDataFrame([tuple(map(float, r)) for r in m], schema) for m in (x, y))
    model = ft.preprocessing(names, k=2).fit(ref)
    detail = dr.drift(ref, prod, model=model).orderBy("feature").collect()
    assert [r["feature"] for r in detail] == ["PC1", "PC2"]
    projected = [np.array([list(r) for r in ft.transform_columns(model, d).collect()]) for d in (ref, prod)]
    for i, r in enumerate(detail):
        assert r["drift_score"] == pytest.approx(psi_by_hand(projected[0][:, i], projected[1][:, i]))


def test_the_law_of_the_p_value_is_an_argument(spark):
    a = spark.createDataFrame([(float(v),) for v in range(40)], "v double")
    b = spark.createDataFrame([(v * 0.8 + 3.3,) for v in range(50)], "v double")
    rows = {law: dr.ks_statistic(a, b, ["v"], law=law).first() for law in ("auto", "exact", "limit")}
    d = rows["auto"].d
    assert rows["auto"].p_value == rows["exact"].p_value == exact_law(d, 40, 50) != rows["limit"].p_value == limit_law(d, 40, 50)
    score = dr.drift(a, b, ["v"], method="ks", law="limit").first().drift_score
    assert score == pytest.approx(1 - limit_law(d, 40, 50))
    with pytest.raises(ValueError, match="law"):
        dr.ks_statistic(a, b, ["v"], law="other")
