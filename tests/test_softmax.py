"""Joint softmax boosting against plain NumPy arithmetic."""

import math

import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from driftloom.operators import softmax as sm
from driftloom.operators import train as tr


@pytest.fixture(scope="module")
def rows(spark):
    rng = np.random.default_rng(0)
    x = rng.normal(size=(900, 3))
    y = (x[:, 0] + 0.5 * rng.normal(size=900) > 0).astype(int) + (x[:, 1] > 0.8)
    valid = rng.random(900) < 0.25
    data = [(i, r.tolist(), int(a), bool(v)) for i, (r, a, v) in enumerate(zip(x, y, valid))]
    df = spark.createDataFrame(data, "id long, x array<double>, label int, v boolean")
    return df.withColumn("features", array_to_vector("x")).cache()


WHOLE = dict(featureFraction=1.0, baggingFraction=1.0, minInstancesPerNode=5)


def test_leaf_values_equal_plain_sums(rows):
    """First and second round: every leaf moves its rows by the shrunk Newton step of its sums."""
    l1, l2, step = 2.0, 3.0, 0.4
    data = rows.where("not v").orderBy("id").collect()
    y = np.array([r.label for r in data])
    model = sm.SoftmaxBoost(maxIter=2, stepSize=step, maxDepth=3, l1=l1, l2=l2, chunk=1, **WHOLE).fit(rows.where("not v"))
    k = model.numClasses
    assert k == 3
    margins = np.tile([math.log((np.sum(y == c) + 0.5) / (len(y) + 0.5 * k)) for c in range(k)], (len(y), 1))
    assert np.allclose(margins[0], model.priors)
    for t in range(2):
        e = np.exp(margins - margins.max(axis=1, keepdims=True))
        p = e / e.sum(axis=1, keepdims=True)
        moved = margins.copy()
        for c in range(k):
            tree = model.models[c].trees[t]
            leaf = np.array([tree.predictLeaf(r.features) for r in data])
            value = np.array([tree.predict(r.features) for r in data])
            g, h = p[:, c] - (y == c), k / (k - 1) * p[:, c] * (1 - p[:, c])
            for one in set(leaf.tolist()):
                own = leaf == one
                gs, hs = g[own].sum(), h[own].sum()
                want = -math.copysign(max(abs(gs) - l1, 0), gs) / (hs + l2) * step
                assert np.allclose(value[own], want, atol=1e-9)
            moved[:, c] += value
        margins = moved
    shares = model.transform(rows.where("not v")).orderBy("id").select("probability").collect()
    e = np.exp(margins - margins.max(axis=1, keepdims=True))
    assert np.allclose([r[0].toArray() for r in shares], e / e.sum(axis=1, keepdims=True))


def test_leaf_value():
    assert sm.leaf_value(5.0, 2.0, 1.0, 2.0) == -1.0
    assert sm.leaf_value(-5.0, 2.0, 1.0, 2.0) == 1.0
    assert sm.leaf_value(0.5, 2.0, 1.0, 0.0) == 0.0
    assert sm.leaf_value(1.0, 0.0, 0.0, 0.0) == 0.0


def test_boosting_stops_soon_after_its_best_round(rows):
    patience, chunk = 2, 3
    boost = sm.SoftmaxBoost(maxIter=500, stepSize=0.8, maxDepth=3, validationCol="v", patience=patience, chunk=chunk, **WHOLE)
    model = boost.fit(rows)
    assert model.rounds < model.grown <= model.rounds + patience < 100
    assert model.rounds == int(np.argmin(model.losses)) + 1 and len(model.losses) == model.grown
    # the kept trees are those that a fit of so many rounds grows
    short = sm.SoftmaxBoost(maxIter=model.rounds, stepSize=0.8, maxDepth=3, **WHOLE).fit(rows.where("not v"))
    pick = lambda m: [r[0].toArray() for r in m.transform(rows).orderBy("id").select("probability").collect()]
    assert np.allclose(pick(model), pick(short))
    loss = np.mean([-math.log(p[r.label]) for p, r in zip(pick(model), rows.orderBy("id").collect()) if r.v])
    assert math.isclose(loss, min(model.losses), rel_tol=1e-9)


def test_resuming_equals_one_longer_fit(rows, tmp_path):
    options = dict(stepSize=0.3, maxDepth=2, featureFraction=0.6, baggingFraction=1.0, l2=1.0)
    first = sm.SoftmaxBoost(maxIter=2, **options).fit(rows)
    first.write().save(str(tmp_path / "m"))
    first = sm.SoftmaxBoostModel.load(str(tmp_path / "m"))
    both = sm.SoftmaxBoost(maxIter=2, **options).resume(rows, first)
    whole = sm.SoftmaxBoost(maxIter=4, **options).fit(rows)
    pick = lambda m: [r[0].toArray() for r in m.transform(rows).orderBy("id").select("probability").collect()]
    assert both.rounds == whole.rounds == 4
    assert np.allclose(pick(both), pick(whole))


def test_leaves_are_limited_by_gain(rows):
    model = sm.SoftmaxBoost(maxIter=1, maxDepth=4, numLeaves=3, **WHOLE).fit(rows)
    full = sm.SoftmaxBoost(maxIter=1, maxDepth=4, numLeaves=64, **WHOLE).fit(rows)
    for small, large in zip(model.models, full.models):
        leaves = {small.trees[0].predictLeaf(r.features) for r in rows.collect()}
        assert len(leaves) == 3 < len({large.trees[0].predictLeaf(r.features) for r in rows.collect()})
        assert small.trees[0]._call_java("rootNode").split().featureIndex() == large.trees[0]._call_java("rootNode").split().featureIndex()


def test_bags_last_as_long_as_asked(rows):
    """Rounds of one bag see the same rows; the next bag sees others."""
    boost = sm.SoftmaxBoost(maxIter=1, baggingFraction=0.5, baggingFrequency=2, featureFraction=0.4)
    run = sm._Run(boost, rows, None)
    numbered = run.state.select("row")

    def bag(number):
        drawn = F.pmod(F.xxhash64(F.lit(42), F.lit(number // 2), "row"), F.lit(sm._DRAWS)) < sm._DRAWS // 2
        return {r[0] for r in numbered.where(drawn).collect()}

    assert bag(0) == bag(1) != bag(2) and 0.4 < len(bag(0)) / 900 < 0.6
    assert run.features_of(3, 1) == run.features_of(3, 1) and len(run.features_of(3, 1)) == 2


def test_strong_penalties_keep_the_priors(rows):
    model = sm.SoftmaxBoost(maxIter=2, maxDepth=2, l1=1e6, **WHOLE).fit(rows)
    one = model.transform(rows).first()["probability"].toArray()
    e = np.exp(model.priors)
    assert np.allclose(one, e / e.sum())


def test_edge_rows(spark, rows):
    empty = rows.limit(0)
    with pytest.raises(ValueError, match="no training rows"):
        sm.SoftmaxBoost(maxIter=1).fit(empty)
    with pytest.raises(ValueError, match="codes"):
        sm.SoftmaxBoost(maxIter=1).fit(rows.withColumn("label", F.lit(-1)))
    single = sm.SoftmaxBoost(maxIter=1, **WHOLE).fit(rows.withColumn("label", F.lit(0)))
    assert single.transform(rows).where("prediction = 0").count() == 900
    holes = rows.withColumn("label", F.when(F.col("id") % 2 == 0, F.col("label")))
    assert sm.SoftmaxBoost(maxIter=1, **WHOLE).fit(holes).numClasses == 3
    assert sm.best_so_far([3, 2, 2.5, 1.9]) == 4 and sm.best_so_far([1, float("nan")]) == 1


def test_written_out_shares_equal_the_general_ones(spark):
    margins = [[0.1, -2.0, 3.5], [700.0, -700.0, 0.0], [float("nan"), 1.0, 2.0], [1e308, -1e308, 5.0], [2.0, 2.0, 2.0]]
    df = spark.createDataFrame([(m,) for m in margins], "m array<double>")
    for one, two in df.select(sm.probabilities(F.col("m")), sm.probabilities(F.col("m"), 3)).collect():
        assert np.array_equal(one, two, equal_nan=True)
    assert "lambda" not in df.select(sm.probabilities(F.col("m"), 3))._jdf.queryExecution().executedPlan().toString()


def test_every_tree_passes_over_one_kept_bag(rows, monkeypatch):
    """A tree reads its rows several times: gradients are not worked out anew in each pass."""
    grow, plans = sm.DecisionTreeRegressor.fit, []

    def noted(self, df, params=None):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return grow(self, df, params)

    monkeypatch.setattr(sm.DecisionTreeRegressor, "fit", noted)
    sm.SoftmaxBoost(maxIter=2, maxDepth=2, **WHOLE).fit(rows)
    assert len(plans) == 6
    for plan in plans:
        shown = plan.split("InMemoryTableScan")
        assert len(shown) > 1 and "EXP" not in shown[0].upper() and "UDF" not in shown[0]


def test_search_space_has_all_parameters():
    assert set(tr.SOFTMAX_SPACE) == {
        "stepSize", "numLeaves", "maxDepth", "minInstancesPerNode", "featureFraction", "baggingFraction", "baggingFrequency", "l1", "l2",
    }
    for t in range(30):
        s = tr.draw(tr.SOFTMAX_SPACE, t, 42)
        assert 0 <= s["l1"] <= 5 and 0 <= s["l2"] <= 5 and 1 <= s["baggingFrequency"] <= 10 and 20 <= s["numLeaves"] <= 200
        sm.SoftmaxBoost(**s)


def test_tuning_searches_the_joint_loss(spark, rows):
    named = rows.where("id < 300").withColumn("Class", F.col("label").cast("string")).select("id", "features", "Class")
    model, best, trials = tr.tune(named, "Class", ["id"], tr.softmax_boost(n_rounds=2), n_trials=1, folds=2, final_rounds=1)
    assert isinstance(model, sm.SoftmaxBoostModel) and model.rounds == 1
    assert set(best) == set(tr.SOFTMAX_SPACE) and 0 < trials[0][2] <= 1
