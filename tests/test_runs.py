import pytest
from pyspark.sql import functions as F

from driftloom.operators import runs as rn
from driftloom.sources import commits


def stored(spark, tmp_path, *runs):
    path = str(tmp_path / "runs")
    for r in runs:
        rn.append_run(spark, path, **r)
    return rn.read_runs(spark, path)


def test_dirty_values_are_dropped(spark, tmp_path):
    df = stored(
        spark,
        tmp_path,
        dict(
            metrics={"accuracy": 0.95, "bad": float("nan"), "worse": float("inf"), "text": "x", "none": None},
            params={"none_param": None, "n_estimators": 100},
        ),
    )
    row = df.first()
    assert row["metrics"] == {"accuracy": 0.95}
    assert row["params"] == {"n_estimators": "100"}
    assert row["run_name"].startswith("run_") and row["tags"]["created_at"]


def test_metrics_need_a_run():
    with pytest.raises(RuntimeError, match="No active run"):
        rn.log_metrics(None, {"a": 1})
    assert rn.log_metrics("r", {"a": 1, "b": float("nan"), "c": "x"}, step=3) == [("r", "a", 1.0, 3)]


def test_best(spark, tmp_path):
    df = stored(
        spark,
        tmp_path,
        dict(run_id="run1", metrics={"test_accuracy": 0.95, "loss": 0.5}),
        dict(run_id="run2", metrics={"test_accuracy": 0.98, "loss": 0.3}),
        dict(run_id="run3", metrics={}),
    )
    assert tuple(rn.best_run(df).first()) == ("run2", 0.98, "test_accuracy")
    assert tuple(rn.best_run(df, "loss", ascending=True).first()) == ("run2", 0.3, "loss")
    assert rn.best_run(df.where("false")).first() is None


def test_compare_and_search(spark, tmp_path):
    df = stored(
        spark,
        tmp_path,
        dict(run_id="run1", metrics={"accuracy": 0.95, "f1": 0.87}, params={"n": 100}, experiment="e"),
        dict(run_id="run2", metrics={"accuracy": 0.98, "f1": 0.89}, params={"n": 200}, experiment="e"),
        dict(run_id="run3", metrics={"accuracy": 0.1}, params={"n": 200}, experiment="other"),
    )
    wide = rn.compare_runs(df, ["run1", "run2"])
    assert wide.columns == ["run_id", "metrics.accuracy", "metrics.f1", "params.n"] and wide.count() == 2
    found = rn.search_runs(df, "metrics.accuracy > 0.5", ["metrics.accuracy DESC"], experiment="e")
    assert [r["run_id"] for r in found.collect()] == ["run2", "run1"]
    assert rn.search_runs(df, n=2).count() == 2
    assert [r["run_id"] for r in rn.top_runs(df, "accuracy", 2).collect()] == ["run2", "run1"]
    best = rn.best_per_group(df, "n", "accuracy").orderBy("n").collect()
    assert [tuple(r) for r in best] == [("100", "run1", 0.95), ("200", "run2", 0.98)]


def test_reference_defaults(spark, tmp_path):
    df = stored(
        spark, tmp_path, dict(run_id="a", metrics={"test_accuracy": 0.5}, params={"random_state": 7})
    )
    row = rn.reference_metrics(df, "a").first()
    assert (row["accuracy"], row["f1_macro"], row["seed"], row["model_type"]) == (0.5, 0.0, 7, "unknown")


def test_fingerprint(spark):
    df = spark.range(1000).select("id", F.when(F.col("id") % 3 > 0, F.col("id") / 7).alias("v"))
    a = rn.fingerprint(df).first()
    assert a == rn.fingerprint(df.orderBy(F.desc("id")).repartition(5)).first()
    assert a["n_rows"] == 1000 and a["n_columns"] == 2
    assert a["checksum"] != rn.fingerprint(df.withColumn("v", F.col("v") + 1e-9)).first()["checksum"]


def one(spark, run_id, value=1.0):
    row = (run_id, "n", "e", None, {}, {"test_accuracy": value}, {})
    return spark.createDataFrame([row], rn.T.StructType([*rn.RUN_SCHEMA.fields]))


def test_a_repeated_append_leaves_one_run(spark, tmp_path):
    path = str(tmp_path / "runs")
    assert rn.append_runs(one(spark, "a", 0.5), path) == 1
    assert rn.append_runs(one(spark, "a", 0.9), path) == 0
    both = one(spark, "a", 0.9).unionByName(one(spark, "b")).unionByName(one(spark, "b"))
    assert rn.append_runs(both, path) == 1
    got = {r.run_id: r.metrics["test_accuracy"] for r in rn.read_runs(spark, path).collect()}
    assert got == {"a": 0.5, "b": 1.0} and rn.read_runs(spark, path).count() == 2
    assert rn.append_runs(one(spark, "c").limit(0), path) == 0


def test_many_appends_are_read_from_few_files(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(commits, "FAN", 3)
    path = str(tmp_path / "runs")
    for i in range(20):
        rn.append_runs(one(spark, f"r{i}", float(i)), path)
    runs = rn.read_runs(spark, path)
    # at most two folders of one file on each of three levels
    assert len(runs.inputFiles()) <= 6
    assert sorted(r.metrics["test_accuracy"] for r in runs.collect()) == [float(i) for i in range(20)]
    log = commits.Commits(spark, path)
    assert log.remove_merged() > 0 and rn.read_runs(spark, path).count() == 20
    assert len(log.numbers()) <= commits.KEPT_COMMITS


def test_a_writer_that_comes_second_tries_again(spark, tmp_path, monkeypatch):
    path, plain = str(tmp_path / "runs"), commits.Commits.publish
    rn.append_runs(one(spark, "a"), path)
    between = []

    def publish(self, number, folders):
        if not between:
            between.append(1)
            rn.append_runs(one(spark, "b").unionByName(one(spark, "c", 7.0)), path)  # another writer is faster
        return plain(self, number, folders)

    monkeypatch.setattr(commits.Commits, "publish", publish)
    assert rn.append_runs(one(spark, "c", 0.1).unionByName(one(spark, "d")), path) == 1
    got = {r.run_id: r.metrics["test_accuracy"] for r in rn.read_runs(spark, path).collect()}
    assert got == {"a": 1.0, "b": 1.0, "c": 7.0, "d": 1.0}
    assert not plain(commits.Commits(spark, path), 1, [])


def test_a_batch_without_a_commit_is_not_seen(spark, tmp_path):
    path = str(tmp_path / "runs")
    rn.append_runs(one(spark, "a"), path)
    commits.Commits(spark, path).write(one(spark, "lost"))
    assert [r.run_id for r in rn.read_runs(spark, path).collect()] == ["a"]


def test_plain_folders_are_still_read(spark, tmp_path):
    one(spark, "old").write.parquet(str(tmp_path / "old"))
    assert rn.read_runs(spark, str(tmp_path / "old")).first().run_id == "old"
