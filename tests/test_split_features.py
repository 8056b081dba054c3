import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from driftloom.functions import ranks
from driftloom.operators import features as ft
from driftloom.operators import perturb, split
from driftloom.sources import tables


def skewed(spark, n=3000):
    """One class holds two thirds of the rows, many hold a few."""
    label = F.when(F.col("id") % 3 > 0, "hot").otherwise(F.concat(F.lit("c"), (F.col("id") % 7).cast("string")))
    return spark.range(n).select("id", label.alias("y"), (F.col("id") * 1.0).alias("v"))


def ids(df):
    return sorted(r["id"] for r in df.select("id").collect())


def test_split_is_exact_disjoint_complete(spark):
    df = skewed(spark)
    train, test = split.stratified_split(df, "y", ["id"])
    assert sorted(ids(train) + ids(test)) == list(range(3000))
    sizes = {r["y"]: r["count"] for r in df.groupBy("y").count().collect()}
    for r in test.groupBy("y").count().collect():
        assert r["count"] == int(sizes[r["y"]] * 0.2 + 0.5)


def test_split_ignores_partitioning_and_seed_matters(spark):
    df = skewed(spark, 500)
    a = ids(split.stratified_split(df, "y", ["id"])[1])
    b = ids(split.stratified_split(df.repartition(7), "y", ["id"])[1])
    c = ids(split.stratified_split(df, "y", ["id"], seed=1)[1])
    assert a == b and a != c


@pytest.mark.parametrize("hot_rows", [0, 100, 1500])
@pytest.mark.parametrize("sort_rows", [5, 10**6])
def test_cut_search_equals_window(spark, monkeypatch, hot_rows, sort_rows):
    monkeypatch.setattr(ranks, "_SORT_ROWS", sort_rows)
    df = skewed(spark).withColumn("y", F.when(F.col("id") > 5, F.col("y")))  # null class too
    key = ["id"]

    def as_map(frame, c):
        return {r["id"]: r[c] for r in frame.collect()}

    assert as_map(split.mark_test(df, "y", key, hot_rows=hot_rows), "is_test") == as_map(
        split.mark_test(df, "y", key), "is_test"
    )
    assert as_map(split.stratified_folds(df, "y", key, 4, hot_rows=hot_rows), "fold") == as_map(
        split.stratified_folds(df, "y", key, 4), "fold"
    )


def test_cut_split_needs_no_shuffle_of_rows(spark):
    df = skewed(spark)
    plan = split.mark_test(df.where("y = 'hot'"), "y", ["id"], hot_rows=10)._jdf.queryExecution().toString()
    assert "Window" not in plan.split("== Physical Plan ==")[1].split("Union")[1].split("BroadcastHashJoin")[0]


def test_nested_validation(spark):
    out = split.train_valid_test(skewed(spark), "y", ["id"])
    assert out.where("is_test and is_validation").count() == 0
    hot = out.where("y = 'hot'").agg(F.count_if("is_test"), F.count_if("is_validation")).first()
    assert tuple(hot) == (400, 320)


def test_folds_differ_by_one(spark):
    out = split.stratified_folds(skewed(spark, 503), "y", ["id"], 5)
    for r in out.groupBy("y").pivot("fold", [0, 1, 2, 3, 4]).count().na.fill(0).collect():
        counts = list(r)[1:]
        assert max(counts) - min(counts) <= 1


def test_sample(spark):
    df = skewed(spark, 1000)
    few = split.sample_n(df, ["id"], 100)
    assert few.count() == 100 and ids(few) == ids(split.sample_n(df.repartition(5), ["id"], 100))
    assert split.sample_n(df, ["id"], 5000).count() == 1000
    assert ids(few) == ids(ranks.top_by_hash(df, ["id"], 42, 100, direct_rows=1))


def test_random_split(spark):
    train, test = split.random_split(spark.range(5000), ["id"], 0.2)
    assert train.count() + test.count() == 5000
    assert abs(test.count() - 1000) < 120


@pytest.mark.parametrize("labels", [list("abcab"), ["angry", "happy", "relax", "sad", "angry"]])
def test_labels_round_trip(frame, labels):
    df = frame("y string", y=labels)
    coded = ft.encode_labels(df, "y").orderBy("id")
    classes = sorted(set(labels))
    assert [r["code"] for r in coded.collect()] == [classes.index(v) for v in labels]
    back = ft.decode_labels(coded.select("id", "code"), "code", classes).orderBy("id")
    assert [r["label"] for r in back.collect()] == labels
    assert [tuple(r) for r in ft.code_table(df, "y").collect()] == [(v, i) for i, v in enumerate(classes)]


def test_unseen_label_is_an_error(frame):
    model = ft.label_indexer("y", "code").fit(frame("y string", y=["a", "b"]))
    with pytest.raises(Exception, match="[Uu]nseen"):
        model.transform(frame("y string", y=["c"])).collect()


def three_columns(frame, values):
    return frame("col1 long, col2 long, col3 long", a=values, b=[v * 10 for v in values], c=[v * 100 for v in values])


def test_scaler_is_population_and_constant_is_zero(frame):
    train = frame("a double, b double", a=[1.0, 2.0, 3.0, 4.0, 5.0], b=[7.0] * 5)
    new = frame("a double, b double", a=[6.0], b=[9.0])
    out = ft.standard_scale(train, train, ["a", "b"]).orderBy("id").collect()
    x = np.arange(1, 6)
    assert np.allclose([r["a"] for r in out], (x - 3) / np.std(x))
    assert [r["b"] for r in out] == [0.0] * 5
    (r,) = ft.standard_scale(train, new, ["a", "b"]).collect()
    assert r["a"] == pytest.approx(3 / np.std(x)) and r["b"] == 2.0


def test_pca_shapes_and_names(frame):
    train, test, new = (three_columns(frame, v) for v in ([1, 2, 3, 4, 5], [6, 7], [8, 9]))
    model = ft.preprocessing(["col1", "col2", "col3"], k=2).fit(train)
    assert ft.feature_names(model) == ["PC1", "PC2"]
    for df in (train, test, new):
        out = ft.transform_columns(model, df)
        assert out.columns == ["PC1", "PC2"] and out.count() == df.count()


def test_no_pca(frame):
    model = ft.preprocessing(["col1", "col2"], use_pca=False).fit(three_columns(frame, [1, 2, 3, 4, 5]))
    assert ft.feature_names(model) == []
    assert ft.transform_columns(model, three_columns(frame, [6, 7])).columns == ["col1", "col2"]


def test_unfitted(frame):
    with pytest.raises(ValueError, match="must be fitted"):
        ft.PopulationScalerModel().transform(three_columns(frame, [1, 2, 3]))


def test_too_many_components(frame):
    with pytest.raises(Exception, match="no less than|k="):
        ft.preprocessing(["col1", "col2"], k=5).fit(three_columns(frame, [1, 2, 3]))


def test_pca_matches_numpy(spark, frame):
    x = np.random.default_rng(2).normal(size=(100, 5)) @ np.random.default_rng(3).normal(size=(5, 5))
    names = [f"f{i}" for i in range(5)]
    df = frame(", ".join(f"{n} double" for n in names), **{n: x[:, i].tolist() for i, n in enumerate(names)})
    model = ft.preprocessing(names, k=3).fit(df)
    z = (x - x.mean(0)) / x.std(0)
    values, vectors = np.linalg.eigh(np.cov(z.T))
    order = np.argsort(-values)[:3]
    vectors = vectors[:, order]
    vectors *= np.sign(vectors[np.abs(vectors).argmax(0), range(3)])
    got = np.array([list(r) for r in ft.transform_columns(model, df.orderBy("id")).collect()])
    assert np.allclose(got, z @ vectors)
    ratio = ft.explained_variance(model, spark).orderBy("component").collect()
    assert np.allclose([r["ratio"] for r in ratio], values[order] / values.sum())
    assert 0 < ratio[-1]["cumulative"] <= 1


def test_preprocessing_save_and_load(frame, tmp_path):
    df = three_columns(frame, [1, 2, 3, 5, 9])
    model = ft.preprocessing(["col1", "col2", "col3"], k=2).fit(df)
    path = str(tmp_path / "model")
    model.write().overwrite().save(path)
    again = PipelineModel.load(path)
    a, b = (ft.transform_columns(m, df).collect() for m in (model, again))
    assert a == b


# --- perturbation -----------------------------------------------------------


def test_shift_and_drop(spark):
    df = skewed(spark, 1000)
    assert perturb.shift(df, "v", 1.2).agg(F.avg("v")).first()[0] == pytest.approx(499.5 * 1.2)
    for hot in (10**6, 10):
        out = perturb.drop_values(df, "v", 0.1, ["id"], hot_rows=hot)
        assert out.where("v is null").count() == 100 and out.columns == df.columns


def test_noise_is_keyed_and_normal(spark):
    df = skewed(spark, 4000)
    a = perturb.add_noise(df, ["v"], ["id"])
    b = perturb.add_noise(df.repartition(9), ["v"], ["id"])
    assert a.exceptAll(b).count() == 0
    moved = a.join(df.select("id", F.col("v").alias("old")), "id").select(F.col("v") - F.col("old"))
    mean, std = moved.agg(F.avg(moved[0]), F.stddev(moved[0])).first()
    assert mean == pytest.approx(0.5, abs=0.02) and std == pytest.approx(0.2, abs=0.01)


def test_default_column_choice(spark):
    df = spark.range(50).select("id", *[(F.col("id") + i).cast("double").alias(f"c{i}") for i in range(10)])

    def changed(out):
        return [c for c in df.columns[1:] if out.select("id", c).exceptAll(df.select("id", c)).count()]

    assert len(changed(perturb.add_noise(df, None, ["id"]))) == 2
    assert len(changed(perturb.add_shifted_noise(df, None, ["id"]))) == 1
    assert len(changed(perturb.scale_noise(df, None, ["id"], 0.5))) == 3
    assert len(changed(perturb.relative_noise(df, None, ["id"]))) == 10


def test_perturbed_sample_contract(spark):
    df = skewed(spark, 300)
    out = perturb.perturbed_sample(df, "y", ["id"], 50, drift_factor=0.3)
    assert out.count() == 50 and out.columns == df.columns
    assert perturb.perturbed_sample(df, "y", ["id"], 500).count() == 300
    with pytest.raises(ValueError, match="not found"):
        perturb.perturbed_sample(df, "Class", ["id"])


# --- sources ----------------------------------------------------------------


def test_label_column(spark):
    assert tables.label_column(spark.createDataFrame([(1, "a")], "x int, Class string")) == "Class"
    assert tables.label_column(spark.createDataFrame([("a",)], "y string")) == "y"
    with pytest.raises(ValueError):
        tables.label_column(spark.createDataFrame([(1, 2)], "x int, y int"))


def test_metrics_file_forms(spark, tmp_path):
    nested, flat = tmp_path / "n.json", tmp_path / "f.json"
    nested.write_text('{"metrics": {"a": 0.5, "b": 1}, "seed": 42}')
    flat.write_text('{\n "a": 0.5\n}')
    assert sorted(map(tuple, tables.read_metrics(spark, str(nested)).collect())) == [("a", 0.5), ("b", 1.0)]
    assert [tuple(r) for r in tables.read_metrics(spark, str(flat)).collect()] == [("a", 0.5)]


def test_required_column(spark, tmp_path):
    path = str(tmp_path / "t.csv")
    tables.write_table(spark.range(3), path)
    assert tables.read_table(spark, path).count() == 3
    with pytest.raises(ValueError, match="Class"):
        tables.read_table(spark, path, required=["Class"])


def test_table_of_large_strata_is_scanned_for_them_alone(spark):
    df = skewed(spark).where("y = 'hot'")
    marked = split.mark_test(df, "y", ["id"], hot_rows=10)
    assert marked._jdf.queryExecution().optimizedPlan().toString().count("Range (") == 1
    assert ids(marked.where("is_test")) == ids(split.mark_test(df, "y", ["id"]).where("is_test"))
    assert marked.schema["is_test"].dataType.simpleString() == "boolean"
