"""Components of wide tables against dense linear algebra."""

import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.functions import array_to_vector

from driftloom.operators import features as ft
from driftloom.operators import krylov


def vectors(spark, x):
    return spark.createDataFrame([(r.tolist(),) for r in x], "x array<double>").select(array_to_vector("x").alias("v"))


def angle(a, b):
    """Sine of the largest angle between two column spaces."""
    return np.linalg.norm(a - b @ (b.T @ a), 2)


@pytest.mark.parametrize("k", [1, 5, 30])
def test_subspace_of_embeddings_like_rows(spark, k):
    """A flat spectrum, for which plain power iterations would need hundreds of passes."""
    x = np.random.default_rng(k).normal(size=(500, 64))
    x -= x.mean(axis=0)
    loadings, shares = krylov.principal_components(vectors(spark, x), "v", k)
    _, s, vt = np.linalg.svd(x, full_matrices=False)
    assert angle(loadings, vt[:k].T) < 1e-6
    assert np.allclose(shares, s[:k] ** 2 / (s**2).sum(), atol=1e-12)
    assert np.allclose(loadings.T @ loadings, np.eye(k), atol=1e-10)


def test_embeddings_table(spark):
    table = ft.array_columns(spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet"), "embedding", 64)
    names = [f"f{i}" for i in range(64)]
    both = [ft.pca_stage(ft.preprocessing(names, True, 30, solver=s).fit(table)) for s in ("gram", "krylov")]
    assert angle(both[1].pc.toArray(), both[0].pc.toArray()) < 1e-6
    assert np.allclose(both[0].explainedVariance.toArray(), both[1].explainedVariance.toArray(), atol=1e-9)


def test_many_columns_take_few_passes(spark, monkeypatch):
    rng = np.random.default_rng(0)
    x = rng.normal(size=(300, 6)) * [30, 20, 10, 8, 6, 4] @ rng.normal(size=(6, 700)) + 0.01 * rng.normal(size=(300, 700))
    x -= x.mean(axis=0)
    widths, plain = [], krylov.covariance_action
    monkeypatch.setattr(krylov, "covariance_action", lambda rows, basis: (widths.append(basis.shape[1]), plain(rows, basis))[1])
    loadings, _ = krylov.principal_components(vectors(spark, x), "v", 4)
    assert angle(loadings, np.linalg.svd(x, full_matrices=False)[2][:4].T) < 1e-6
    assert len(widths) <= 4 and max(widths) <= 14


def test_rank_below_k_and_edges(spark):
    x = np.outer(np.arange(-5, 6), [1.0, 2.0, 2.0, 0.0])
    loadings, shares = krylov.principal_components(vectors(spark, x), "v", 3)
    assert np.allclose(np.abs(loadings[:, 0]), [1 / 3, 2 / 3, 2 / 3, 0]) and np.allclose(shares, [1, 0, 0], atol=1e-12)
    assert np.allclose(loadings.T @ loadings, np.eye(3), atol=1e-9)
    zero = krylov.principal_components(vectors(spark, np.zeros((4, 3))), "v", 2)
    assert np.allclose(zero[1], 0) and zero[0].shape == (3, 2)
    with pytest.raises(ValueError, match="no rows"):
        krylov.principal_components(vectors(spark, x).limit(0), "v", 1)
    with pytest.raises(ValueError, match="between 1 and 4"):
        krylov.principal_components(vectors(spark, x), "v", 5)


def test_wide_input_takes_the_solver_and_is_saved(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(ft, "GRAM_COLUMNS", 3)
    x = np.random.default_rng(1).normal(size=(60, 5)) * [5, 4, 3, 2, 1]
    df = spark.createDataFrame([tuple(map(float, r)) for r in x], ", ".join(f"c{i} double" for i in range(5)))
    columns = [f"c{i}" for i in range(5)]
    model = ft.preprocessing(columns, True, 2).fit(df)
    monkeypatch.setattr(ft, "GRAM_COLUMNS", 4000)
    exact = ft.preprocessing(columns, True, 2).fit(df)
    model.write().save(str(tmp_path / "m"))
    again = PipelineModel.load(str(tmp_path / "m"))
    show = lambda m: [r[0].toArray() for r in m.transform(df).select("features").collect()]
    assert np.allclose(show(model), show(exact)) and np.allclose(show(again), show(model))
    with pytest.raises(ValueError, match="solver"):
        ft.preprocessing(columns, True, 2, solver="other").fit(df)
