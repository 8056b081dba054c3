"""Label codes, population scaling, sign-fixed PCA."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark import keyword_only
from pyspark.ml import Estimator, Model, Pipeline, PipelineModel
from pyspark.ml.feature import PCA, ElementwiseProduct, IndexToString, StringIndexer
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasInputCol, HasInputCols, HasOutputCol
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import as_number, chunks, col, local_frame, numeric_columns, require_columns
from .krylov import pca_model, principal_components

SCALED = "scaled"
FEATURES = "features"


# --- labels -----------------------------------------------------------------


def label_indexer(label: str, out: str = "label_code") -> StringIndexer:
    """Codes 0..k-1 in ascending label order, fitted once; an unseen label is an error."""
    return StringIndexer(
        inputCol=label, outputCol=out, stringOrderType="alphabetAsc", handleInvalid="error"
    )


def label_decoder(code: str, labels: Sequence[str], out: str = "label_decoded") -> IndexToString:
    return IndexToString(inputCol=code, outputCol=out, labels=list(labels))


def code_table(df: DataFrame, label: str) -> DataFrame:
    """(label, code), one row per class."""
    seen = sorted(
        r[0] for r in df.select(col(label)).where(col(label).isNotNull()).distinct().collect()
    )
    kind = df.schema[label].dataType.simpleString()
    return local_frame(df.sparkSession, [(v, i) for i, v in enumerate(seen)], f"`{label}` {kind}, code int")


def encode_labels(df: DataFrame, label: str, out: str = "code") -> DataFrame:
    model = label_indexer(label, out).fit(df)
    return model.transform(df).withColumn(out, col(out).cast("int"))


def decode_labels(df: DataFrame, code: str, labels: Sequence[str], out: str = "label") -> DataFrame:
    cast = df.withColumn("__code", col(code).cast("double"))
    return label_decoder("__code", labels, out).transform(cast).drop("__code")


# --- population scaling -----------------------------------------------------


class _ScalerParams(HasInputCols, HasOutputCol):
    means = Param(Params._dummy(), "means", "mean per column", TypeConverters.toListFloat)
    scales = Param(Params._dummy(), "scales", "divisor per column", TypeConverters.toListFloat)


class PopulationScaler(Estimator, _ScalerParams, DefaultParamsReadable, DefaultParamsWritable):
    """Centre and divide by the population std; a constant column becomes 0.

    Reads plain numeric columns and writes one vector column. The built-in
    scaler divides by the sample std instead.
    """

    @keyword_only
    def __init__(self, inputCols=None, outputCol=SCALED):
        super().__init__()
        self._setDefault(outputCol=SCALED)
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def _fit(self, df: DataFrame) -> PopulationScalerModel:
        columns = self.getInputCols()
        require_columns(df, columns)
        means, scales = [], []
        for group in chunks(columns):
            aggs = []
            for i, c in enumerate(group):
                x = as_number(df, c)
                aggs += [F.avg(x).alias(f"m{i}"), F.stddev_pop(x).alias(f"s{i}")]
            row = df.agg(*aggs).first()
            for i in range(len(group)):
                means.append(row[f"m{i}"] or 0.0)
                scales.append(row[f"s{i}"] or 1.0)
        model = PopulationScalerModel()
        model._set(inputCols=columns, outputCol=self.getOutputCol(), means=means, scales=scales)
        return model


class PopulationScalerModel(Model, _ScalerParams, DefaultParamsReadable, DefaultParamsWritable):
    """Fitted scaler: literal means and divisors, applied in one projection."""

    def __init__(self):
        super().__init__()

    def _transform(self, df: DataFrame) -> DataFrame:
        if not self.isSet(self.means):
            raise ValueError("Means and divisors are missing: the scaler must be fitted first")
        columns = self.getInputCols()
        require_columns(df, columns)
        cells = [
            (col(c).cast("double") - F.lit(m)) / F.lit(s)
            for c, m, s in zip(columns, self.getOrDefault(self.means), self.getOrDefault(self.scales))
        ]
        return df.withColumn(self.getOutputCol(), array_to_vector(F.array(*cells)))


def standard_scale(
    fit_on: DataFrame, apply_to: DataFrame, columns: Sequence[str]
) -> DataFrame:
    """``apply_to`` with the given columns scaled by the figures of ``fit_on``."""
    model = PopulationScaler(inputCols=list(columns), outputCol="__scaled").fit(fit_on)
    out = model.transform(apply_to).withColumn("__scaled", vector_to_array("__scaled"))
    at = {c: i for i, c in enumerate(columns)}
    return out.select(
        *[F.col("__scaled")[at[c]].alias(c) if c in at else col(c) for c in apply_to.columns]
    )


# --- PCA --------------------------------------------------------------------


GRAM_COLUMNS = 4000


class SignedPCA(Estimator, HasInputCol, HasOutputCol, DefaultParamsReadable, DefaultParamsWritable):
    """PCA whose components have their largest loading positive.

    Expects centred input, as :class:`PopulationScaler` yields. The fitted
    stage is a pair of built-in stages (projection, sign).

    Solver "gram" brings the columns x columns matrix to the driver, "krylov" only
    columns x k figures per pass over the rows; "auto" takes the latter beyond ``GRAM_COLUMNS``.
    """

    k = Param(Params._dummy(), "k", "number of components", TypeConverters.toInt)
    solver = Param(Params._dummy(), "solver", "gram, krylov or auto", TypeConverters.toString)

    @keyword_only
    def __init__(self, k=50, inputCol=SCALED, outputCol=FEATURES, solver="auto"):
        super().__init__()
        self._setDefault(k=50, inputCol=SCALED, outputCol=FEATURES, solver="auto")
        self._set(**self._input_kwargs)

    def getK(self) -> int:
        return self.getOrDefault(self.k)

    def _fit(self, df: DataFrame) -> PipelineModel:
        raw = f"__{self.getOutputCol()}_raw"
        solver = self.getOrDefault(self.solver)
        if solver not in ("gram", "krylov", "auto"):
            raise ValueError("solver must be 'gram', 'krylov' or 'auto'")
        first = df.select(self.getInputCol()).first() if solver == "auto" else None
        if solver == "krylov" or (first is not None and len(first[0]) > GRAM_COLUMNS):
            found = principal_components(df, self.getInputCol(), self.getK())
            pca = pca_model(*found, f"{self.uid}_pca", self.getInputCol(), raw)
        else:
            pca = PCA(k=self.getK(), inputCol=self.getInputCol(), outputCol=raw).fit(df)
        signs = component_signs(pca.pc.toArray())
        flip = ElementwiseProduct(
            scalingVec=Vectors.dense(signs), inputCol=raw, outputCol=self.getOutputCol()
        )
        return PipelineModel([pca, flip])


def component_signs(loadings: np.ndarray) -> list[float]:
    """+1 or -1 per component; among equally large loadings the first decides."""
    out = []
    for column in loadings.T:
        size = np.abs(column)
        first = int(np.argmax(size >= size.max() - 1e-9))
        out.append(-1.0 if column[first] < 0 else 1.0)
    return out


def preprocessing(
    columns: Sequence[str], use_pca: bool = True, k: int = 50, solver: str = "auto"
) -> Pipeline:
    """Scaler and, unless switched off, PCA, as one estimator; output ``features``."""
    if not use_pca:
        return Pipeline(stages=[PopulationScaler(inputCols=list(columns), outputCol=FEATURES)])
    return Pipeline(
        stages=[
            PopulationScaler(inputCols=list(columns), outputCol=SCALED),
            SignedPCA(k=k, inputCol=SCALED, outputCol=FEATURES, solver=solver),
        ]
    )


def pca_stage(model: PipelineModel):
    """The fitted projection inside a preprocessing model, or None."""
    for stage in getattr(model, "stages", []):
        if hasattr(stage, "explainedVariance"):
            return stage
        if isinstance(stage, PipelineModel):
            inner = pca_stage(stage)
            if inner is not None:
                return inner
    return None


def feature_names(model: PipelineModel) -> list[str]:
    """PC1..PCk, or nothing without PCA."""
    pca = pca_stage(model)
    return [f"PC{i + 1}" for i in range(pca.getK())] if pca is not None else []


def explained_variance(model: PipelineModel, spark) -> DataFrame:
    """(component, name, ratio, cumulative): k rows held by the fitted model."""
    pca = pca_stage(model)
    if pca is None:
        raise ValueError("the model has no PCA stage")
    ratios = [float(v) for v in pca.explainedVariance.toArray()]
    total = np.cumsum(ratios)
    rows = [(i + 1, f"PC{i + 1}", r, float(t)) for i, (r, t) in enumerate(zip(ratios, total))]
    return local_frame(spark, rows, "component int, name string, ratio double, cumulative double")


def vector_columns(df: DataFrame, vector: str, names: Sequence[str]) -> DataFrame:
    """Spread a vector column over named double columns."""
    kept = [col(c) for c in df.columns if c != vector]
    spread = df.withColumn("__v", vector_to_array(col(vector)))
    return spread.select(*kept, *[F.col("__v")[i].alias(n) for i, n in enumerate(names)])


def array_columns(df: DataFrame, array: str, size: int, prefix: str = "f") -> DataFrame:
    """Spread an array column of known size over double columns f0, f1, ..."""
    kept = [col(c) for c in df.columns if c != array]
    return df.select(*kept, *[col(array)[i].cast("double").alias(f"{prefix}{i}") for i in range(size)])


def transformed_names(model) -> list[str]:
    """Names of the entries of the output vector: PC1.. or the scaled inputs."""
    return feature_names(model) or list(_input_columns(model))


def transform_columns(model, df: DataFrame) -> DataFrame:
    """Output of a fitted preprocessor as plain columns."""
    out = model.transform(df).select(FEATURES)
    return vector_columns(out, FEATURES, transformed_names(model))


def _input_columns(model) -> Sequence[str]:
    for stage in model.stages:
        if isinstance(stage, PopulationScalerModel):
            return stage.getInputCols()
    raise ValueError("No scaler among the stages: preprocessing must be fitted first")


def build_matrices(
    train: DataFrame,
    test: DataFrame,
    label: str,
    key: Sequence[str],
    columns: Sequence[str] | None = None,
    use_pca: bool = True,
    k: int = 50,
):
    """Fit codes and preprocessing on train, apply to both.

    Gives (train, test, indexer model, preprocessing model); the frames hold
    key, feature columns and an int ``target``.
    """
    columns = list(columns or numeric_columns(train, [label, *key]))
    indexer = label_indexer(label, "__code").fit(train)
    model = preprocessing(columns, use_pca, k).fit(train)
    names = feature_names(model) or columns

    def apply(df: DataFrame) -> DataFrame:
        out = model.transform(indexer.transform(df))
        spread = out.withColumn("__v", vector_to_array(FEATURES))
        return spread.select(
            *[col(c) for c in key],
            *[F.col("__v")[i].alias(n) for i, n in enumerate(names)],
            F.col("__code").cast("int").alias("target"),
        )

    return apply(train), apply(test), indexer, model
