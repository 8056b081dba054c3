import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from driftloom.functions.quantiles import quantiles
from driftloom.operators import clean, profile

NAN = float("nan")


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_clean_keeps_all_without_outliers(frame):
    df = frame("col1 long, col2 long", a=range(1, 11), b=range(10, 101, 10))
    out, log = clean.remove_outliers_iqr(df, exclude=["id"])
    assert out.count() == 10
    assert [r["column"] for r in log.orderBy("ordinal").collect()] == ["col1", "col2"]


def test_clean_removes_outlier(frame):
    df = frame("col1 long", a=[*range(1, 11), 1000])
    out, _ = clean.remove_outliers_iqr(df, exclude=["id"])
    assert out.where("col1 = 1000").count() == 0
    assert out.count() == 10


def test_clean_subset_keeps_other_columns(frame):
    df = frame(
        "col1 long, col2 long, col3 string",
        a=[*range(1, 11), 1000],
        b=range(10, 111, 10),
        c=list("abcdefghijk"),
    )
    out, log = clean.remove_outliers_iqr(df, ["col1"])
    assert out.columns == ["id", "col1", "col2", "col3"]
    assert [r["column"] for r in log.collect()] == ["col1"]


def test_clean_empty(spark):
    df = spark.createDataFrame([], "id long, col1 double")
    out, log = clean.remove_outliers_iqr(df, exclude=["id"])
    assert out.count() == 0
    assert rows(log) == [("col1", 0, 0, 0, 0, None, None)]


def test_clean_log(frame):
    df = frame("col1 long", a=[1, 2, 3, 4, 5, 1000])
    (r,) = clean.remove_outliers_iqr(df, ["col1"])[1].collect()
    assert (r["before"], r["after"], r["removed"]) == (6, 5, 1)


def test_clean_is_sequential_and_drops_missing(frame):
    rng = np.random.default_rng(7)
    a, b = rng.normal(size=400), rng.exponential(size=400)
    a[:5] = 50
    b[5:9] = math.nan
    df = frame("a double, b double", a=a.tolist(), b=b.tolist())
    out, log = clean.remove_outliers_iqr(df, ["a", "b"])

    keep = np.ones(400, bool)
    expected = []
    for x in (a, b):
        q1, q3 = np.nanquantile(x[keep], [0.25, 0.75])
        inside = (x >= q1 - 1.5 * (q3 - q1)) & (x <= q3 + 1.5 * (q3 - q1))
        before = int(keep.sum())
        keep &= inside
        expected.append((before, int(keep.sum())))
    assert [(r["before"], r["after"]) for r in log.orderBy("ordinal").collect()] == expected
    assert sorted(r["id"] for r in out.collect()) == np.flatnonzero(keep).tolist()


def test_clean_bounds_reach_the_scan(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(1000).select(F.col("id").cast("double").alias("v"), F.lit("x").alias("other")).write.parquet(path)
    out, _ = clean.remove_outliers_iqr(spark.read.parquet(path), ["v"])
    plan = out.select("v")._jdf.queryExecution().toString()
    assert "GreaterThanOrEqual(v" in plan and "LessThanOrEqual(v" in plan
    assert "ReadSchema: struct<v:double>" in plan


@pytest.mark.parametrize("kind", ["normal", "ties", "heavy", "geometric", "constant", "two"])
@pytest.mark.parametrize("n", [2, 3001])
def test_quantile_search_equals_numpy(spark, kind, n):
    rng = np.random.default_rng(n)
    x = {
        "normal": rng.normal(size=n),
        "ties": rng.integers(0, 4, n).astype(float),
        "heavy": np.where(rng.random(n) < 0.7, 3.25, rng.normal(size=n) * 100),
        "geometric": np.exp(rng.normal(size=n) * 40),
        "constant": np.full(n, 2.5),
        "two": np.where(np.arange(n) % 3 == 0, -1.0, 1.0),
    }[kind]
    df = spark.createDataFrame([(float(v),) for v in x] + [(None,), (NAN,)], "v double")
    probs = [0.0, 0.25, 0.5, 0.75, 0.9, 1.0]
    want = np.quantile(x, probs)
    for exact_rows in (10**6, 0 if n < 50 else 40):
        got = quantiles(df, ["v"], probs, exact_rows=exact_rows)["v"]
        assert np.allclose(got, want, rtol=1e-12, atol=0), (kind, n, exact_rows)


def test_quantile_of_nothing(spark):
    df = spark.createDataFrame([(None,), (NAN,)], "v double")
    for exact_rows in (100, 0):
        assert quantiles(df, ["v"], [0.5], exact_rows=exact_rows)["v"] == [None]


def test_stats_numeric(frame):
    df = frame("col1 long, col2 long, col3 string", a=range(1, 6), b=range(10, 51, 10), c=list("abcde"))
    for exact_rows in (1000, 1):
        out = {(r[0], r[1]): r[2] for r in profile.stats_numeric(df, exclude=["id"], exact_rows=exact_rows).collect()}
        assert {c for c, _ in out} == {"col1", "col2"}
        assert out["col1", "Media"] == 3
        assert out["col1", "Mediana/Cuartil 50%"] == 3
        assert out["col1", "Min"] == 1 and out["col1", "Max"] == 5
        assert out["col1", "Cuartil 25%"] == 2 and out["col1", "Cuartil 75%"] == 4
        assert out["col1", "Desviacion estandar"] == pytest.approx(np.std([1, 2, 3, 4, 5], ddof=1))


def test_stats_categorical(frame):
    df = frame("col1 string, col2 string, col3 long", a=list("abcab"), b=list("xyxyx"), c=range(1, 6))
    assert rows(profile.stats_categorical(df)) == [
        ("col1", "Cardinalidad", "3"),
        ("col1", "Moda", "a"),
        ("col2", "Cardinalidad", "2"),
        ("col2", "Moda", "x"),
    ]


def test_missing(frame):
    none = frame("col1 long, col2 long", a=range(1, 6), b=range(5))
    assert rows(profile.missing_percentage(none, ["col1", "col2"])) == [("col1", 0.0), ("col2", 0.0)]
    for gap in (NAN, None):
        some = frame("col1 double, col2 long", a=[1.0, 2.0, gap, 4.0, 5.0], b=range(5))
        assert rows(profile.missing_percentage(some, ["col1", "col2"])) == [("col1", 20.0), ("col2", 0.0)]
        assert profile.missing_total(some).first()[0] == pytest.approx(20.0)


def test_impute(frame):
    df = frame("a double, b double", a=[1.0, NAN, 3.0, None], b=[1.0, 1.0, None, 4.0])
    out = clean.impute_mean(df, exclude=["id"]).orderBy("id").collect()
    assert [r["a"] for r in out] == [1, 2, 3, 2]
    assert [r["b"] for r in out] == [1, 1, 2, 4]


def test_errors_without_fitting_columns(spark, frame):
    with pytest.raises(ValueError, match="No categorical columns"):
        profile.category_counts(frame("col1 long, col2 long", a=range(5), b=range(5)))
    text = spark.createDataFrame([("a", "b")], "col1 string, col2 string")
    for fn in (profile.correlation, profile.histogram, profile.stats_numeric):
        with pytest.raises(ValueError, match="No numeric columns"):
            fn(text)


def test_correlation_is_pairwise(frame):
    rng = np.random.default_rng(1)
    a, b, c = rng.normal(size=(3, 200))
    a[:20], b[10:50] = math.nan, math.nan
    df = frame("a double, b double, c double", a=a.tolist(), b=b.tolist(), c=c.tolist())
    got = {(r[0], r[1]): r[2] for r in profile.correlation(df, exclude=["id"]).collect()}
    ok = ~np.isnan(a) & ~np.isnan(b)
    assert got["a", "b"] == pytest.approx(np.corrcoef(a[ok], b[ok])[0, 1])
    assert got["a", "b"] == got["b", "a"]
    assert len(got) == 9


def test_histogram_matches_numpy(frame):
    rng = np.random.default_rng(3)
    a = np.round(rng.normal(size=500), 1)
    b = np.full(500, 7.0)
    df = frame("a double, b double", a=[*a[:-1].tolist(), NAN], b=b.tolist())
    got = profile.histogram(df, ["a", "b"], bins=50).orderBy("column", "bin").collect()
    for name, x in (("a", a[:-1]), ("b", b)):
        counts, edges = np.histogram(x, bins=np.histogram_bin_edges(x, 50))
        mine = [r for r in got if r["column"] == name]
        assert [r["n"] for r in mine] == counts.tolist()
        assert np.allclose([r["bin_left"] for r in mine], edges[:-1])


def test_kde_matches_direct_sum(frame):
    x = np.random.default_rng(5).normal(size=300)
    got = profile.kde_curve(frame("v double", v=x.tolist()), "v", 37).orderBy("point").collect()
    width = np.std(x, ddof=1) * 300 ** (-0.2)
    grid = np.linspace(x.min(), x.max(), 37)
    want = np.exp(-0.5 * ((grid[:, None] - x) / width) ** 2).sum(1) / (300 * width * math.sqrt(2 * math.pi))
    assert [r["point"] for r in got] == list(range(37))
    assert np.allclose([r["density"] for r in got], want)


def test_boxplot(frame):
    df = frame("v double", v=[1.0, 2.0, 3.0, 4.0, 5.0, 100.0])
    r = profile.boxplot_stats(df, ["v"]).first()
    assert (r["whisker_low"], r["whisker_high"], r["n_outliers"]) == (1.0, 5.0, 1)
    assert rows(profile.boxplot_outliers(df, ["v"])) == [("v", 100.0)]


def test_hot_category_counts(spark):
    random.seed(1)
    df = spark.createDataFrame([("hot" if i % 3 else f"c{i}",) for i in range(3000)], "c string")
    top = {r["category"]: r["n"] for r in profile.category_counts(df).collect()}
    assert top["hot"] == 2000 and len(top) == 1001


def test_correlation_of_many_columns(spark, monkeypatch):
    x = np.random.default_rng(8).normal(size=(300, 5))
    schema = ", ".join(f"c{i} double" for i in range(5))
    df = spark.createDataFrame([tuple(map(float, r)) for r in x], schema)
    few = {tuple(r)[:2]: r[2] for r in profile.correlation(df).collect()}
    monkeypatch.setattr(profile, "WIDE_CORRELATION", 3)
    many = {tuple(r)[:2]: r[2] for r in profile.correlation(df).collect()}
    assert many == pytest.approx(few) and len(many) == 25


def test_approximate_quantiles(frame):
    df = frame("v double", v=[float(i) for i in range(101)])
    got = {r["prob"]: r["value"] for r in profile.quantile_table(df, ["v"], exact=False).collect()}
    assert got == {0.25: 25.0, 0.5: 50.0, 0.75: 75.0}


def test_wide_correlation_is_no_long_method(spark):
    wide = spark.range(40).select(*[F.expr(f"CASE WHEN id % {i + 2} > 0 THEN id * {i + 1} + id * id END").alias(f"c{i}") for i in range(70)])
    plan = profile.correlation(wide)._jdf.queryExecution().sparkPlan().toString()
    # the passes over the rows: arrays into batches, no aggregate of 210 functions and no separate columns
    batches = [line for line in plan.splitlines() if "MapInArrow" in line]
    assert len(batches) == 1 and "values" in batches[0]


def test_wide_correlation_of_odd_columns(spark):
    odd = {0: "CASE WHEN id % 3 = 0 THEN double('NaN') ELSE id END", 1: "CAST(NULL AS DOUBLE)", 2: "7", 3: "CASE WHEN id > 5 THEN id * 1e9 END"}
    df = spark.range(30).select(*[F.expr(odd.get(i, f"id * id + {i}")).alias(f"c{i}") for i in range(64)])
    found = {(r["column_a"], r["column_b"]): r["corr"] for r in profile.correlation(df).collect()}
    assert len(found) == 64 * 64
    plain = {(r["column_a"], r["column_b"]): r["corr"] for r in profile.correlation(df, ["c0", "c1", "c2", "c3", "c4"]).collect()}
    for pair, r in plain.items():
        assert (found[pair] is None) == (r is None) and (r is None or abs(found[pair] - r) < 1e-9)
    nothing = profile.correlation(df.where("id < 0")).collect()
    assert len(nothing) == 64 * 64 and all(r["corr"] is None for r in nothing)


def test_wide_correlation_tasks_need_no_package():
    import pickle
    import subprocess
    import sys

    from pyspark import cloudpickle

    sent = pickle.dumps([cloudpickle.dumps(f) for f in (profile._fact_rows(2), profile._moment_rows([0.0, 0.0]))])
    load = "import pickle, sys; [pickle.loads(b) for b in pickle.load(sys.stdin.buffer)]; assert 'driftloom' not in sys.modules"
    subprocess.run([sys.executable, "-c", load], input=sent, check=True, cwd="/")
