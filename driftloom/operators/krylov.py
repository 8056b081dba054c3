"""Leading principal components of wide tables, without their columns x columns matrix."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import SparkContext
from pyspark.ml.common import _py2java
from pyspark.ml.feature import PCAModel
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import DenseMatrix, DenseVector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

OVERSAMPLE = 10
TOLERANCE = 1e-10  # of the largest variance: the residual of a component at which it counts as found
MAX_PASSES = 30
_ROWS = 64  # rows of the result that one shuffled row holds


def _action(basis: np.ndarray):
    """Per task the sum of a (a' basis) over its rows a, in blocks of rows of the result."""

    def act(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(basis.shape)
        for batch in batches:
            rows = batch.column(0).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, len(basis))
            total += rows.T @ (rows @ basis)
        for at in range(0, len(basis), _ROWS):
            part = total[at : at + _ROWS]
            place = np.arange(part.size, dtype=np.int32)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(part.size, at, np.int32)), pa.array(place), pa.array(part.ravel())], ["at", "place", "value"])

    return act


def covariance_action(rows: DataFrame, basis: np.ndarray) -> np.ndarray:
    """A'A basis for the rows A (one array column): one pass, sums combined per task before the shuffle."""
    parts = rows.mapInArrow(_action(basis), "at int, place int, value double")
    summed = parts.groupBy("at", "place").agg(F.sum("value").alias("value")).toPandas()
    out = np.zeros(basis.size)
    out[summed["at"].to_numpy(np.int64) * basis.shape[1] + summed["place"].to_numpy(np.int64)] = summed["value"].to_numpy()
    return out.reshape(basis.shape)


def _orthonormal(block: np.ndarray, against: np.ndarray | None) -> np.ndarray:
    """A basis of what the block adds to the columns of ``against``; directions lost in rounding are left out."""
    size = np.linalg.norm(block, axis=0).max(initial=0.0)
    for _ in range(2):  # once more, for what the first subtraction leaves
        if against is not None:
            block = block - against @ (against.T @ block)
        left, values, _ = np.linalg.svd(block, full_matrices=False)
        block = left[:, values > 1e-12 * max(size, values.max(initial=0.0))]
        size = 1.0
    return block


def principal_components(df: DataFrame, vector: str, k: int, seed: int = 42, oversample: int = OVERSAMPLE, tolerance: float = TOLERANCE) -> tuple[np.ndarray, np.ndarray]:
    """(columns x k loadings, share of the total variance of each) of a centred vector column.

    A random start block grows into a block Krylov space of the covariance: each pass over the
    rows applies it to the newest block, and the leading pairs of the projected problem are
    kept once their residuals, known without a further pass, fall below ``tolerance``. The driver holds
    columns x (k + oversample) numbers per pass, never columns x columns, unless the space fills up.
    """
    rows = df.select(vector_to_array(vector).alias("a"))
    size, total = rows.agg(F.max(F.size("a")), F.sum(F.aggregate("a", F.lit(0.0), lambda s, x: s + x * x))).first()
    if size is None:
        raise ValueError("no rows")
    if not 0 < k <= size:
        raise ValueError(f"k must lie between 1 and {size}")
    width = min(size, k + oversample)
    newest = _orthonormal(np.random.default_rng(seed).normal(size=(size, width)), None)
    basis, image = np.zeros((size, 0)), np.zeros((size, 0))
    for _ in range(MAX_PASSES):
        image = np.hstack([image, covariance_action(rows, newest)])
        basis = np.hstack([basis, newest])
        projected = basis.T @ image
        values, vectors = np.linalg.eigh((projected + projected.T) / 2)
        values, vectors = values[::-1][:k], vectors[:, ::-1][:, :k]
        loadings = basis @ vectors
        residual = np.linalg.norm(image @ vectors - loadings * values, axis=0)
        newest = _orthonormal(image[:, -newest.shape[1] :], basis)
        if residual.max() <= tolerance * max(values[0], 1e-300) or not newest.shape[1]:
            break
    # fewer directions than asked for: the others carry no variance
    short = k - loadings.shape[1]
    if short > 0:
        filled = _orthonormal(np.eye(size), loadings)[:, :short]
        loadings, values = np.hstack([loadings, filled]), np.concatenate([values, np.zeros(short)])
    shares = np.maximum(values, 0.0) / total if total else np.zeros(k)
    return loadings, shares


def pca_model(loadings: np.ndarray, shares: np.ndarray, uid: str, input_col: str, output_col: str) -> PCAModel:
    """The built-in projection stage with these components, to be saved and loaded like any other."""
    context = SparkContext._active_spark_context
    matrix = DenseMatrix(*loadings.shape, loadings.ravel(order="F").tolist())
    java = context._jvm.org.apache.spark.ml.feature.PCAModel(uid, _py2java(context, matrix), _py2java(context, DenseVector(shares)))
    model = PCAModel(java)
    model._resetUid(uid)
    return model._set(k=loadings.shape[1]).setInputCol(input_col).setOutputCol(output_col)
