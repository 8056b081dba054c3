import pytest
from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from driftloom.operators import boosting, evaluate as ev, score as sc, train as tr
from driftloom.operators.features import preprocessing
from driftloom.operators.split import stratified_split
from driftloom.plans import jobs
from driftloom.operators import runs as rn
from driftloom.streaming.scoring import read_stream, score_batch_checked, score_stream, score_stream_checked


@pytest.fixture(scope="module")
def table(spark):
    """Three classes set by one column, two columns of noise."""
    df = spark.range(600).select(
        "id",
        ((F.col("id") * 37) % 100).cast("double").alias("a"),
        ((F.col("id") * 11) % 17).cast("double").alias("b"),
        ((F.col("id") * 7) % 23).cast("double").alias("c"),
    )
    band = F.when(F.col("a") < 30, "angry").when(F.col("a") < 70, "happy").otherwise("sad")
    return df.withColumn("Class", band).cache()


COLUMNS = ["a", "b", "c"]


@pytest.fixture(scope="module")
def split(table):
    return stratified_split(table, "Class", ["id"])


@pytest.fixture(scope="module")
def forest(split):
    estimator = tr.full_pipeline(COLUMNS, "Class", n_trees=5, max_depth=5)
    return tr.fit_spread(estimator, split[0], [*COLUMNS, "Class"])


def f1(scored):
    return ev.metrics(ev.pair_counts(scored, "true_label", "prediction_label")).first()["f1_macro"]


def test_forest(forest, split):
    scored = sc.score(forest, split[1], ["id"], "Class", proba=True, model_name="random_forest")
    assert scored.columns == [
        "id", "prediction", "prediction_label", "true_label", "correct", "probabilities", "model_name",
    ]
    assert scored.count() == split[1].count() and f1(scored) > 0.9
    row = scored.first()
    assert sorted(row["probabilities"]) == ["angry", "happy", "sad"]
    assert sum(row["probabilities"].values()) == pytest.approx(1)
    assert sc.accuracy(scored).first()["accuracy"] > 0.9


def test_scoring_without_labels_or_names(forest, split):
    assert sc.score(forest, split[1].drop("Class"), ["id"], "Class").columns == ["id", "prediction", "prediction_label"]
    plain = PipelineModel(forest.stages[1:])
    out = sc.score(plain, split[1], proba=True)
    assert out.columns == ["prediction", "probabilities"]
    assert sorted(out.first()["probabilities"]) == ["class_0", "class_1", "class_2"]


def test_unknown_models(forest):
    with pytest.raises(ValueError, match="Unknown model_type"):
        tr.full_pipeline(COLUMNS, "Class", "other")
    with pytest.raises(ValueError, match="not found"):
        sc.pick_model({"random_forest": forest}, "other")
    with pytest.raises(ValueError, match="Unknown model_type"):
        jobs.train_model(None, "p", "m", "Class", ["id"], "other")


def test_boosting_with_early_stop_saves_and_loads(split, tmp_path):
    model = tr.fit_with_validation(
        split[0], "Class", ["id"], COLUMNS, n_rounds=4, learning_rate=0.5, max_depth=3, patience=1
    )
    scored = sc.score(model, split[1], ["id"], "Class", proba=True)
    assert f1(scored) > 0.9
    total = F.aggregate(F.map_values("probabilities"), F.lit(0.0), lambda a, b: a + b)
    assert scored.where(F.abs(total - 1) > 1e-9).count() == 0
    path = str(tmp_path / "m")
    model.write().overwrite().save(path)
    again = sc.score(PipelineModel.load(path), split[1], ["id"], "Class", proba=True)
    assert sorted(map(str, scored.collect())) == sorted(map(str, again.collect()))


def test_best_round():
    assert boosting.best_round([5, 4, 3, 2], 2) == 4
    assert boosting.best_round([5, 4, 4.5, 4.6, 1], 2) == 2
    assert boosting.best_round([5, 4, 4.5, 4.6, 1], 5) == 5


def test_draw_stays_in_space():
    for t in range(50):
        s = tr.draw(tr.SEARCH_SPACE, t, 42)
        assert 0.01 <= s["stepSize"] <= 0.3 and 3 <= s["maxDepth"] <= 20
        assert s == tr.draw(tr.SEARCH_SPACE, t, 42)
        assert 0.6 <= float(s["featureSubsetStrategy"]) <= 1.0


def test_tune(split):
    ready = preprocessing(COLUMNS, use_pca=False).fit(split[0]).transform(split[0])
    model, best, trials = tr.tune(
        ready, "Class", ["id"], tr.gbt_one_vs_rest(n_rounds=1),
        {"maxDepth": ("int", 1, 3)}, n_trials=2, folds=2, final_rounds=2,
    )
    assert best in [s for _, s, _ in trials]
    assert max(v for *_, v in trials) == dict((str(s), v) for _, s, v in trials)[str(best)]
    assert all(m.getNumTrees == 2 for m in model.models)


def test_grid_skips_failures(split):
    configs = [{"model_type": "random_forest", "n_trees": 2, "max_depth": 3}, {"model_type": "other"}]
    runs = tr.run_grid(*split, "Class", ["id"], configs, COLUMNS)
    assert [r["tags"]["status"] for r in runs.orderBy("run_id").collect()] == ["completed", "failed"]
    assert rn.count_runs(runs).where("model_type = 'other'").first()["completed"] == 0
    assert rn.best_run(runs).first()["run_id"] == "run001"


def test_performance_runs(forest, split):
    runs = jobs.performance_runs(forest, split[1], "Class", ["id"], "a", "b", n_runs=2).orderBy("run").collect()
    assert [r["run"] for r in runs] == [1, 2]
    assert all(1.1 <= r["shift_factor"] <= 1.3 and 0.05 <= r["missing_ratio"] <= 0.2 for r in runs)
    still = jobs.performance_runs(forest, split[1], "Class", ["id"], "a", "b", settings=[(1.0, 0.0), (3.0, 0.1)])
    same, moved = still.orderBy("run").collect()
    assert same["performance_drop"] == pytest.approx(0.0) and not same["alert"]
    assert moved["alert"] and moved["drift_f1"] < moved["base_f1"]


@pytest.mark.parametrize("kind", ["gbt", "gbt_tuned"])
def test_train_job_kinds(spark, table, tmp_path, kind):
    source, path = str(tmp_path / "t"), str(tmp_path / "m")
    table.write.parquet(source)
    small = tr.gbt_one_vs_rest(n_rounds=1, max_depth=3)
    params = {"gbt": dict(n_rounds=2, max_depth=3, learning_rate=0.5),
              "gbt_tuned": dict(estimator=small, space={"maxDepth": ("int", 2, 3)}, n_trials=1, folds=2, final_rounds=2)}
    jobs.train_model(spark, source, path, "Class", ["id"], kind, COLUMNS, **params[kind])
    jobs.predict_table(spark, source, path, str(tmp_path / "p"), ["id"], "Class")
    scored = spark.read.parquet(str(tmp_path / "p"))
    assert scored.count() == 600 and f1(scored) > 0.9


def test_validation_of_vectors(spark):
    df = spark.createDataFrame([(1, [1.0] * 50), (2, [1.0] * 49), (3, []), (4, None)], "id int, v array<double>")
    good, bad = sc.validate_features(df, "v", mode="quarantine")
    assert [r["id"] for r in good.collect()] == [1]
    assert {r["id"]: r["problem"] for r in bad.collect()} == {
        2: "expected 50 values, got 49", 3: "empty", 4: "empty",
    }
    assert sc.validate_features(df.where("id = 1"), "v").count() == 1
    with pytest.raises(Exception, match="expected 50 values, got 49"):
        sc.validate_features(df.where("id = 2"), "v").collect()


def test_argmax_and_threshold(spark):
    rows = [([0.9, 0.1, 0.0],), ([0.1, 0.8, 0.1],), ([0.0, 0.2, 0.8],), ([0.4, 0.4, 0.2],)]
    df = spark.createDataFrame(rows, "p array<double>")
    assert [r[0] for r in df.select(sc.argmax_class(F.col("p"))).collect()] == [0, 1, 2, 0]
    flags = spark.createDataFrame([(0.5,), (0.51,)], "s double").select(sc.threshold_class(F.col("s")))
    assert [r[0] for r in flags.collect()] == [0, 1]


def test_stream_scores_every_row_and_resumes(spark, forest, table, tmp_path):
    source, out, mark = (str(tmp_path / n) for n in ("in", "out", "mark"))
    half = table.where("id < 300")
    half.write.parquet(source)

    def run():
        q = score_stream(forest, read_stream(spark, source, table.schema), out, mark, ["id"], "Class")
        q.awaitTermination()
        return spark.read.parquet(out)

    assert run().count() == 300
    table.where("id >= 300").write.mode("append").parquet(source)
    rows = run()
    assert rows.count() == 600 and rows.select("id").distinct().count() == 600
    batch = sc.score(forest, table, ["id"])
    assert rows.select("id", "prediction", "prediction_label").exceptAll(batch).count() == 0


def test_jobs_end_to_end(spark, table, tmp_path):
    raw, clean, runs = (str(tmp_path / n) for n in ("raw", "clean", "runs"))
    table.write.parquet(raw)
    info = jobs.clean_dataset(spark, raw, clean, exclude=["id"]).first()
    assert info["rows_in"] == 600 and info["rows_out"] == spark.read.parquet(clean).count()
    paths = jobs.build_features(spark, clean, str(tmp_path / "f"), "Class", ["id"], COLUMNS, k=2)
    train, test = (spark.read.parquet(paths[p]) for p in ("train", "test"))
    assert train.columns == ["id", "PC1", "PC2", "target"]
    assert train.count() + test.count() == info["rows_out"]
    model = jobs.train_model(spark, clean, str(tmp_path / "m"), "Class", ["id"], columns=COLUMNS, n_trees=3, max_depth=4)
    jobs.predict_table(spark, clean, str(tmp_path / "m"), str(tmp_path / "p"), ["id"], "Class")
    tables = jobs.evaluate_predictions(spark.read.parquet(str(tmp_path / "p")), reference_f1=0.84)
    assert tables["metrics"].first()["accuracy"] > 0.2
    assert set(tables) == {"matrix", "report", "metrics", "flat", "f1_per_class", "degradation"}
    a, b = stratified_split(spark.read.parquet(clean), "Class", ["id"])
    run_id = jobs.track_training(
        spark, runs, model, a, b, "Class", ["id"], {"n_trees": 3, "gone": None}, "m", "random_forest", str(tmp_path / "art")
    )
    run = rn.read_runs(spark, runs).where(F.col("run_id") == run_id).first()
    assert run["params"]["n_features"] == "3" and "gone" not in run["params"]
    assert 0 <= run["metrics"]["test_f1_macro"] <= 1 and "train_accuracy" in run["metrics"]
    assert run["tags"]["status"] == "completed"
    with pytest.raises(Exception, match="Class"):
        jobs.track_training(spark, runs, model, a, b.drop("Class"), "Class", ["id"], {}, "m", "random_forest")
    assert rn.read_runs(spark, runs).where("tags['status'] = 'failed'").count() == 1
    drift_id = jobs.drift_job(spark, a, b, str(tmp_path / "d"), runs, COLUMNS)
    tags = rn.read_runs(spark, runs).where(F.col("run_id") == drift_id).first()["tags"]
    assert tags["drift_status"] in ("detected", "no_drift") and "drift_severity" in tags
    assert spark.read.text(str(tmp_path / "d" / "summary")).first()[0].startswith('{"method":"psi"')


def test_stream_quarantines_bad_vectors_and_repeats_add_nothing(spark, forest, table, tmp_path):
    source, out, bad = (str(tmp_path / d) for d in ("in", "out", "bad"))
    vector = F.array(*[F.col(c).cast("double") for c in COLUMNS])
    rows = table.select("id", F.when(F.col("id") % 10 == 0, F.array().cast("array<double>")).when(F.col("id") % 10 == 1, F.slice(vector, 1, 1)).when(F.col("id") % 10 == 2, F.lit(None)).otherwise(vector).alias("v"))
    rows.repartition(3).write.parquet(source)

    def run(mark):
        q = score_stream_checked(forest, read_stream(spark, source, rows.schema, files_per_batch=1), out, bad, str(tmp_path / mark), "v", COLUMNS, ["id"])
        q.awaitTermination()

    def check():
        good, held = spark.read.parquet(out), spark.read.parquet(bad)
        assert good.count() == good.select("id").distinct().count() == rows.where("id % 10 > 2").count()
        assert held.count() == held.select("id").distinct().count() == rows.where("id % 10 <= 2").count()
        assert {r.problem for r in held.select("problem").distinct().collect()} == {"empty", f"expected {len(COLUMNS)} values, got 1"}
        assert good.select("batch_id").distinct().count() == 3

    run("mark")
    check()
    run("mark")  # nothing new arrived
    check()
    run("other mark")  # every batch comes again
    check()
    score_batch_checked(forest, rows.where("id = 5"), 9, out, bad, "v", COLUMNS, ["id"])
    plain = sc.score(forest, table.where("id = 5"), ["id"], model_name="random_forest").first()
    assert spark.read.parquet(out).where("batch_id = 9").drop("batch_id").first() == plain


def test_grid_fits_each_preparation_once(split, monkeypatch):
    fits, plain = [], tr.preprocessing
    monkeypatch.setattr(tr, "preprocessing", lambda columns, use_pca, k: (fits.append((use_pca, k)), plain(columns, use_pca, k))[1])
    small = {"n_trees": 2, "max_depth": 2}
    configs = [{"model_type": "random_forest", "use_pca": True, "k": 2, **small}, {"model_type": "random_forest", **small}]
    configs += [{"model_type": "gbt", "n_rounds": 1, "use_pca": True, "k": 2}, {"model_type": "softmax", "n_rounds": 1, "valid_size": 0.3}]
    configs += [{"model_type": "other"}, {"model_type": "random_forest", "use_pca": True, "k": 99, **small}]
    models = {}
    runs = tr.run_grid(*split, "Class", ["id"], configs, COLUMNS, on_model=lambda n, c, m: models.update({n: m}))
    got = {r.run_id: r for r in runs.collect()}
    assert [got[f"run{i:03d}"].tags["status"] for i in range(1, 7)] == ["completed"] * 4 + ["failed"] * 2
    assert fits == [(True, 2), (False, 50), (True, 99)]
    assert [got[f"run{i:03d}"].tags["preparation"] for i in range(1, 5)] == ["1", "2", "1", "2"]
    assert got["run001"].params["n_test"] == str(split[1].count())
    # the models handed out are whole pipelines
    for n, m in models.items():
        found = m.transform(split[1])
        assert ev.metrics(ev.pair_counts(found, tr.LABEL_CODE, "prediction")).first().accuracy == got[f"run{n:03d}"].metrics["test_accuracy"]
