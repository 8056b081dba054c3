"""Trees on cells against plain counts, and the models that they make."""

import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from driftloom.operators import boosting, cells as ce, evaluate as ev, softmax as sm, train as tr
from driftloom.plans import catalog_models as cm


@pytest.fixture(scope="module")
def rows(spark):
    """Three classes told by the first of two columns, 200 values of the second, a fold and a validation mark."""
    df = spark.range(6000).select("id", (F.col("id") % 7).cast("double").alias("a"), ((F.col("id") * 37) % 200 / 3).alias("b"))
    df = df.withColumn("label", F.when(F.col("a") <= 1, 0.0).when(F.col("a") <= 3, 1.0).otherwise(2.0))
    return df.withColumns({"features": array_to_vector(F.array("a", "b")), "fold": F.col("id") % 5, "v": F.col("id") % 4 == 0}).cache()


def accuracy(model, rows):
    return model.transform(rows).agg(F.avg((F.col("prediction") == F.col("label")).cast("double"))).first()[0]


def test_cells_count_every_row(rows):
    cells = ce.gather(rows, "features", "label", F.col("fold"), 5)
    assert cells.counts.sum() == 6000 and [len(e) for e in cells.edges] == [6, 31]
    got = {(f, c): cells.counts[:, f, c].sum() for f in range(5) for c in range(3)}
    assert got == {(r.fold, int(r.label)): r["count"] for r in rows.groupBy("fold", "label").count().collect()}
    # every vector falls into its bins, and the point of a cell into the same
    for f in range(2):
        assert (np.searchsorted(cells.edges[f], cells.points()[:, f]) == cells.bins[:, f]).all()
    assert ce.gather(rows.withColumn("label", F.lit(None).cast("double")), "features", "label") is None
    assert ce.gather(rows.withColumn("label", F.lit(0.5)), "features", "label") is None


def test_edges():
    assert ce.edges_of_counts([1.0, 2.0, 4.0], [5, 1, 1], 32) == [1.5, 3.0]
    assert ce.edges_of_counts([7.0], [5], 32) == [] == ce.edges_of_counts([], [], 32)
    assert ce.edges_of_counts([float(i) for i in range(8)], [1] * 8, 4) == [1.5, 3.5, 5.5]


def test_too_many_cells_are_not_gathered(rows, monkeypatch):
    monkeypatch.setattr(ce, "MOST_CELLS", 100)
    assert ce.gather(rows, "features", "label") is None


def test_the_first_split_is_the_best_one():
    rng = np.random.default_rng(1)
    bins, y, n = rng.integers(0, 6, (300, 2)).astype(np.int16), rng.normal(size=300), rng.integers(1, 5, 300).astype(float)
    tree = ce.grow(bins, [6, 6], n, n, [n * y], n * y * y, 1, 20, 2, rng)
    spread = lambda m: (n[m] * y[m] ** 2).sum() - (n[m] * y[m]).sum() ** 2 / n[m].sum()
    every = np.ones(300, dtype=bool)
    cuts = {(f, b): spread(every) - spread(bins[:, f] <= b) - spread(bins[:, f] > b) for f in range(2) for b in range(5)}
    best = max(cuts, key=cuts.get)
    assert (tree.feature[0], tree.cut[0]) == best and tree.gain[0] * n.sum() == pytest.approx(cuts[best])
    left = bins[:, best[0]] <= best[1]
    assert (tree.at == np.where(left, 1, 2)).all()
    assert tree.values()[1] == pytest.approx((n * y)[left].sum() / n[left].sum())


def test_a_forest_of_many_bags_keeps_none_per_row(rows, monkeypatch, tmp_path):
    monkeypatch.setattr(tr, "MANY_BAGS", 1)
    monkeypatch.setattr(tr.RandomForestClassifier, "_fit", lambda *_: pytest.fail("a bag count per row and tree was kept"))
    model = tr.random_forest(n_trees=30, label="label").fit(rows)
    assert model.getNumTrees == 30 and model.numClasses == 3 and accuracy(model, rows) == 1.0
    assert all(t.numNodes == 5 for t in model.trees)  # pruned: three classes, two borders
    bags = {round(t.toDebugString.count("If")) for t in model.trees}
    assert bags == {2}
    PipelineModel([model]).write().save(str(tmp_path / "m"))
    again = PipelineModel.load(str(tmp_path / "m"))
    columns = ("id", "probability", "prediction")
    assert again.transform(rows).select(*columns).exceptAll(model.transform(rows).select(*columns)).count() == 0


def test_a_forest_of_too_many_cells_grows_in_groups(rows, monkeypatch):
    monkeypatch.setattr(tr, "MANY_BAGS", 1)
    monkeypatch.setattr(ce, "MOST_CELLS", 10)
    monkeypatch.setattr(tr, "TREES_AT_ONCE", 4)
    model = tr.random_forest(n_trees=10, label="label").fit(rows)
    assert model.getNumTrees == 10 and accuracy(model, rows) == 1.0


@pytest.mark.parametrize("work", [1, 1 << 60])
def test_boosting_on_cells_is_that_of_rows(rows, monkeypatch, work):
    """Without bags both ways grow the same trees, on bins that part all values."""
    few = rows.withColumn("features", array_to_vector(F.array("a", F.col("id") % 20)))
    boost = boosting.BoostedOneVsRest(maxIter=4, stepSize=0.3, maxDepth=3, subsamplingRate=1.0, featureSubsetStrategy="all", validationCol="v")
    plain = boost.fit(few).transform(few).select("id", "probability")
    monkeypatch.setattr(boosting, "MUCH_WORK", 1)
    monkeypatch.setattr(ce, "_TASK_WORK", work)  # in tasks and on the driver
    model = boost.fit(few)
    both = plain.join(model.transform(few).select("id", F.col("probability").alias("p")), "id").collect()
    assert len(both) == 6000 and all(np.allclose(r.probability, r.p, atol=1e-9) for r in both)


def test_no_round_is_grown_after_patience_ran_out():
    rng = np.random.default_rng(0)
    bins, counts = np.arange(50, dtype=np.int16)[:, None], rng.integers(1, 9, (50, 2)).astype(float)
    grown = []
    plain = ce.grow
    try:
        ce.grow = lambda *a: (grown.append(1), plain(*a))[1]
        fit = ce.boost(bins, [50], counts, counts[::-1].copy(), 1, 500, 0.3, 5, 1, 1, 1.0, 3, 7)
    finally:
        ce.grow = plain
    assert len(fit.trees) <= len(grown) <= len(fit.trees) + 3 < 100


def test_softmax_on_cells(rows, monkeypatch):
    few = rows.withColumn("features", array_to_vector(F.array("a", F.col("id") % 20)))
    boost = sm.SoftmaxBoost(maxIter=4, stepSize=0.5, maxDepth=3, numLeaves=4, featureFraction=1.0, baggingFraction=1.0, validationCol="v")
    plain = boost.fit(few)
    monkeypatch.setattr(sm, "MANY_ROWS", 1)
    monkeypatch.setattr(sm, "_Run", None)
    model = boost.fit(few)
    assert (model.rounds, model.grown) == (plain.rounds, plain.grown) and np.allclose(model.losses, plain.losses)
    both = plain.transform(few).join(model.transform(few).select("id", F.col("probability").alias("p")), "id").collect()
    assert all(np.allclose(r.probability, r.p, atol=1e-9) for r in both)


def test_search_and_grid_on_cells(rows, monkeypatch):
    named = rows.withColumn("Class", F.element_at(F.array(F.lit("x"), F.lit("y"), F.lit("z")), F.col("label").cast("int") + 1))
    for owner, name in ((boosting, "MUCH_WORK"), (tr, "MANY_BAGS")):
        monkeypatch.setattr(owner, name, 1)
    monkeypatch.setattr(tr, "fit_spread", lambda e, *a, plain=tr.fit_spread: plain(e, *a) if isinstance(e, tr.Pipeline) else pytest.fail("not on cells"))
    model, best, trials = tr.tune(named.drop("label"), "Class", ["id"], tr.gbt_one_vs_rest(n_rounds=3), n_trials=2, folds=2, final_rounds=4)
    assert [v for _, _, v in trials] == [1.0, 1.0] and all(m.getNumTrees == 4 for m in model.models)
    configs = [{"model_type": "random_forest", "n_trees": 3}, {"model_type": "gbt", "n_rounds": 3, "learning_rate": 0.3}]
    kept = {}
    train, test = named.where("id % 5 > 0"), named.where("id % 5 = 0")
    runs = tr.run_grid(train, test, "Class", ["id"], configs, ["a", "b"], on_model=lambda n, c, m: kept.update({n: m})).collect()
    for number, run in enumerate(runs, 1):
        assert run.params["n_train"] == "4800" and run.params["n_test"] == "1200"
        for part, own in (("train", train), ("test", test)):
            pairs = ev.pair_counts(kept[number].transform(own), tr.LABEL_CODE, "prediction")
            assert ev.metrics(pairs).first().accuracy == pytest.approx(run.metrics[f"{part}_accuracy"])


def test_queries_ask_for_the_whole_work(monkeypatch):
    """gbt_ovr and tune leave rounds, trials, folds and the space to the operators."""
    asked = {}
    monkeypatch.setattr(cm, "parts", lambda *_: ("train", "test"))
    monkeypatch.setattr(cm, "_scores", lambda model, test: None)
    monkeypatch.setattr(cm.tr, "fit_with_validation", lambda *a, **k: asked.update(gbt=(a[4:], k)))
    cm.gbt_ovr(None, "")
    assert asked["gbt"] == ((), {})

    class Ready:
        fit = transform = lambda self, _: self

    monkeypatch.setattr(cm, "preprocessing", lambda *a, **k: Ready())
    monkeypatch.setattr(cm.tr, "tune", lambda *a, **k: (asked.update(tune=(a[3], a[4:], k)), (None, None, []))[1])
    cm.tune(type("S", (), {"createDataFrame": lambda *_: None})(), "")
    estimator, *rest = asked["tune"]
    assert estimator.getMaxIter() == 500 and rest == [(), {}]
