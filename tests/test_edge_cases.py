"""Ordinary inputs that once gave wrong answers or ended a job."""

import os

import pytest
from pyspark.errors import PySparkException
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from driftloom import correlation, drift, drift_summary, fingerprint, js_positional, kde_curve, validate_features
from driftloom.operators.boosting import BoostedOneVsRest, first_rounds
from driftloom.operators.evaluate import length_check, pair
from driftloom.operators.runs import latest_metrics, log_metrics, metric_history, reference_metrics, write_metric_history
from driftloom.operators.train import SEARCH_SPACE, random_forest
from driftloom.session import scratch_path


def matrix(df, columns):
    return {(r.column_a, r.column_b): r["corr"] for r in correlation(df, columns).collect()}


def test_correlation_is_the_same_at_any_number_of_columns(spark):
    base = spark.range(50).select(
        F.col("id").cast("double").alias("a"), (F.col("id") % 7).cast("double").alias("b"), F.lit(2.0).alias("flat")
    )
    many = base.withColumns({f"c{i}": F.sin(F.col("a") * (i + 1)) for i in range(60)})
    narrow, wide = matrix(base, ["a", "b", "flat"]), matrix(many, many.columns)
    for pair_, value in narrow.items():
        if "flat" in pair_:
            assert value is None and wide[pair_] is None
        else:
            assert wide[pair_] == pytest.approx(value)
    assert narrow["a", "a"] == pytest.approx(1.0)


def test_dead_columns_do_not_end_a_drift_report(spark):
    ref = spark.range(100).select(F.col("id").cast("double").alias("x"), F.col("id").cast("double").alias("y"), F.lit(1.0).alias("flat"))
    live = ref.withColumn("y", F.lit(None).cast("double"))
    for method in ("psi", "js", "ks"):
        got = {r.feature: r for r in drift(ref, live, method=method).collect()}
        assert got["x"].drift_score == pytest.approx(0.0)
        assert got["y"].drift_score is None and got["y"].drift_detected is False
        assert {r.drift_score for r in drift(ref, live.limit(0), method=method).collect()} == {None}
    nothing = drift_summary(drift(ref, live).limit(0)).first()
    assert nothing.total_features == 0 and nothing.drift_percentage is None


def test_positional_distance_wants_the_same_keys(spark):
    def side(rows):
        return spark.createDataFrame(rows, "k long, w double")

    ok = js_positional(side([(1, 1.0), (2, 3.0)]), side([(2, 3.0), (1, 1.0)]), ["k"]).first()
    assert ok.score == pytest.approx(0.0)
    for left, right in (
        ([(1, 1.0), (2, 3.0)], [(1, 1.0), (3, 3.0)]),
        ([(1, 1.0), (2, 3.0)], [(1, 1.0)]),
        ([(1, 1.0), (1, 3.0)], [(1, 1.0), (1, 3.0)]),
        ([(1, 1.0), (1, 3.0), (2, 1.0)], [(1, 1.0), (2, 3.0), (2, 1.0)]),
    ):
        with pytest.raises(PySparkException, match="same keys"):
            js_positional(side(left), side(right), ["k"]).collect()
    assert js_positional(side([(1, 0.0), (2, 0.0)]), side([(1, 1.0), (2, 1.0)]), ["k"]).first().score is None


def test_length_check_counts_repeated_keys(spark):
    def side(keys):
        return spark.createDataFrame([(k,) for k in keys], "k long")

    row = length_check(side([1, 2, 2]), side([1, 2, 3]), ["k"]).first()
    assert (row.n_truth, row.n_pred, row.only_truth, row.only_pred, row.same_rows) == (3, 3, 1, 1, False)
    row = length_check(side([1, 1]), side([1]), ["k"]).first()
    assert (row.n_truth, row.n_pred, row.only_truth, row.same_rows) == (2, 1, 1, False)
    with pytest.raises(ValueError, match="different lengths"):
        pair(side([1, 1]), side([1]), ["k"])
    with pytest.raises(ValueError, match="repeated"):
        pair(side([1, 1]), side([1, 1]), ["k"])
    row = length_check(side([]), side([]), ["k"]).first()
    assert (row.n_truth, row.n_pred, row.same_rows) == (0, 0, True)


def test_a_bad_vector_fails_whatever_is_asked(spark):
    df = spark.createDataFrame([(1, [1.0, 2.0, 3.0]), (2, [1.0, 2.0])], "id long, f array<double>")
    checked = validate_features(df, "f", 3)
    for action in (lambda: checked.count(), lambda: checked.select("id").collect(), lambda: checked.agg(F.max("id")).collect()):
        with pytest.raises(PySparkException, match="expected 3 values, got 2"):
            action()
    assert validate_features(df.where("id = 1"), "f", 3).count() == 1


def test_different_tables_have_different_fingerprints(spark):
    def checksum(*row):
        return fingerprint(spark.createDataFrame([row], "a string, b string")).first().checksum

    assert checksum("a|b", "c") != checksum("a", "b|c")
    assert checksum(None, "x") != checksum("\\N", "x") != checksum("-", "x")
    assert checksum("1:a", "") != checksum("", "1:a")


def test_a_seed_that_is_no_number(spark):
    runs = spark.createDataFrame(
        [("r", {"random_state": "None"}, {"test_accuracy": 0.5})], "run_id string, params map<string,string>, metrics map<string,double>"
    )
    assert reference_metrics(runs).first().seed == 42


def test_forest_depth_is_never_cut_silently():
    assert random_forest().getMaxDepth() == 30
    with pytest.raises(ValueError, match="deepest"):
        random_forest(max_depth=99)
    assert SEARCH_SPACE["maxDepth"] == ("int", 3, 20)


def test_the_first_rounds_equal_a_shorter_fit(spark):
    rows = spark.range(400).select(
        (F.col("id") % 2).cast("double").alias("label"), (F.col("id") % 17).cast("double").alias("a"), (F.col("id") % 5).cast("double").alias("b")
    )
    ready = VectorAssembler(inputCols=["a", "b"], outputCol="features").transform(rows).withColumn("__is_class", F.col("label"))
    boost = BoostedOneVsRest(maxIter=6, stepSize=0.2, maxDepth=3, minInstancesPerNode=1)
    cut, short = first_rounds(boost._binary(6).fit(ready), 3), boost._binary(3).fit(ready)
    assert cut.getNumTrees == 3 and cut.numFeatures == 2
    assert list(cut.treeWeights) == list(short.treeWeights)
    assert [t.toDebugString.split("\n", 1)[1] for t in cut.trees] == [t.toDebugString.split("\n", 1)[1] for t in short.trees]
    left, right = (m.transform(ready).select("rawPrediction").collect() for m in (cut, short))
    assert left == right


def test_density_of_far_values(spark):
    """One value lies hundreds of bandwidths away; blocks between hold 0."""
    df = spark.createDataFrame([(float(i % 10),) for i in range(2000)] + [(1e6,)], "x double")
    curve = kde_curve(df, "x").orderBy("point").collect()
    assert [r.point for r in curve] == list(range(200))
    import numpy as np

    v = np.array([i % 10 for i in range(2000)] + [1e6], float)
    width = v.std(ddof=1) * len(v) ** -0.2
    want = np.exp(-0.5 * ((np.array([r.x for r in curve])[:, None] - v) / width) ** 2).sum(1) / (len(v) * width * np.sqrt(2 * np.pi))
    assert np.allclose([r.density for r in curve], want, rtol=1e-9, atol=0)


def test_metric_history(spark):
    path = scratch_path(spark, "history")
    for step, loss in ((0, 3.0), (1, 1.0), (2, 2.0)):
        write_metric_history(spark, path, log_metrics("r1", {"loss": loss, "bad": float("nan")}, step))
    write_metric_history(spark, path, log_metrics("r2", {"loss": 9.0}))
    assert metric_history(spark, path).count() == 4
    assert [(r.step, r.value) for r in metric_history(spark, path, "r1").orderBy("step").collect()] == [(0, 3.0), (1, 1.0), (2, 2.0)]
    got = {r.run_id: (r.value, r.step) for r in latest_metrics(metric_history(spark, path)).collect()}
    assert got == {"r1": (2.0, 2), "r2": (9.0, None)}


def test_scratch_of_this_application_can_be_removed(tmp_path, spark, monkeypatch):
    from driftloom import session

    monkeypatch.setattr(session, "shared_dir", lambda spark: str(tmp_path))
    (tmp_path / "driftloom" / "app-of-another").mkdir(parents=True)
    mine = session.scratch_path(spark, "rows")
    spark.range(3).write.parquet(mine)
    assert spark.read.parquet(mine).count() == 3
    session.remove_scratch(spark)
    session.remove_scratch(spark)  # nothing left is no error
    assert [p.name for p in (tmp_path / "driftloom").iterdir()] == ["app-of-another"]


def test_only_a_local_session_may_go_without_a_shared_folder():
    from types import SimpleNamespace

    from driftloom.session import shared_dir

    def unset(master):
        return SimpleNamespace(
            conf=SimpleNamespace(get=lambda key, default: default), sparkContext=SimpleNamespace(master=master, applicationId="app-1")
        )

    assert os.path.isdir(shared_dir(unset("local[2]"))) and shared_dir(unset("local[2]")) == shared_dir(unset("local[2]"))
    with pytest.raises(ValueError, match="shared|share"):
        shared_dir(unset("spark://host:7077"))
