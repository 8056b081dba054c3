"""Multiclass boosting: one binary boosted forest per class."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark import SparkContext, keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import (
    HasFeaturesCol,
    HasLabelCol,
    HasMaxIter,
    HasPredictionCol,
    HasProbabilityCol,
    HasSeed,
    HasStepSize,
)
from pyspark.ml.util import (
    DefaultParamsReadable,
    DefaultParamsReader,
    DefaultParamsWritable,
    DefaultParamsWriter,
    MLReadable,
    MLReader,
    MLWritable,
    MLWriter,
)
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.storagelevel import StorageLevel

from ..functions.columns import col
from ..session import ensure_checkpoint_dir
from . import cells as ce

#: rows times rounds from which trees are grown on cells
MUCH_WORK = 1_000_000


class _BoostParams(
    HasFeaturesCol, HasLabelCol, HasPredictionCol, HasProbabilityCol, HasMaxIter, HasStepSize, HasSeed
):
    maxDepth = Param(Params._dummy(), "maxDepth", "depth of a tree", TypeConverters.toInt)
    minInstancesPerNode = Param(
        Params._dummy(), "minInstancesPerNode", "rows a leaf needs", TypeConverters.toInt
    )
    featureSubsetStrategy = Param(
        Params._dummy(), "featureSubsetStrategy", "features per split", TypeConverters.toString
    )
    subsamplingRate = Param(
        Params._dummy(), "subsamplingRate", "share of rows per tree", TypeConverters.toFloat
    )
    validationCol = Param(
        Params._dummy(), "validationCol", "boolean column of the validation rows", TypeConverters.toString
    )
    patience = Param(
        Params._dummy(),
        "patience",
        "rounds without improvement before boosting stops",
        TypeConverters.toInt,
    )


class BoostedOneVsRest(Estimator, _BoostParams, DefaultParamsReadable, DefaultParamsWritable):
    """Boosted trees per class, class probabilities normalised to sum 1.

    Labels are codes 0..k-1. With a validation column, each class stops at
    its best round and keeps the trees up to it, which are those that a fit of so many rounds would grow.

    From ``MUCH_WORK`` rows times rounds on, trees grow on the cells of the rows (``cells``), and no more than
    ``patience`` rounds are grown beyond the best one. With less work, or with more
    cells than are gathered, ``GBTClassifier`` grows all rounds, and their validation losses are read afterwards.
    """

    @keyword_only
    def __init__(
        self,
        featuresCol="features",
        labelCol="label",
        predictionCol="prediction",
        probabilityCol="probability",
        maxIter=500,
        stepSize=0.05,
        maxDepth=5,
        minInstancesPerNode=20,
        featureSubsetStrategy="0.9",
        subsamplingRate=0.8,
        validationCol=None,
        patience=5,
        seed=42,
    ):
        super().__init__()
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})
        self._setDefault(
            maxIter=500,
            stepSize=0.05,
            maxDepth=5,
            minInstancesPerNode=20,
            featureSubsetStrategy="0.9",
            subsamplingRate=0.8,
            patience=5,
            seed=42,
        )

    def _binary(self, rounds: int) -> GBTClassifier:
        get = self.getOrDefault
        return GBTClassifier(
            featuresCol=self.getFeaturesCol(),
            labelCol="__is_class",
            maxIter=rounds,
            stepSize=get(self.stepSize),
            maxDepth=get(self.maxDepth),
            minInstancesPerNode=get(self.minInstancesPerNode),
            featureSubsetStrategy=get(self.featureSubsetStrategy),
            subsamplingRate=get(self.subsamplingRate),
            seed=get(self.seed),
        )

    def _fit(self, df: DataFrame) -> BoostedOneVsRestModel:
        ensure_checkpoint_dir(df.sparkSession)
        found = self.cells(df) if self.wants_cells(df.count()) else None
        if found is not None:
            return self.fit_cells(df.sparkSession, found)
        label = col(self.getLabelCol())
        early = self.isSet(self.validationCol)
        kept = [col(self.getFeaturesCol()), label.alias("__label")]
        if early:
            kept.append(col(self.getOrDefault(self.validationCol)).alias("__valid"))
        # every class and round reads the same two columns
        rows = df.select(*kept).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            top = rows.agg(F.max("__label")).first()[0]
            if top is None:
                raise ValueError("no training rows")
            models = [self._fit_class(rows, float(c), early) for c in range(int(top) + 1)]
        finally:
            rows.unpersist()
        model = BoostedOneVsRestModel(models)
        self._copyValues(model)
        return model

    def wants_cells(self, rows: int) -> bool:
        return rows * self.getOrDefault(self.maxIter) >= MUCH_WORK

    def cells(self, df: DataFrame) -> ce.Cells | None:
        """Cells of the rows; mark 1 is that of the validation rows, if there are any."""
        mark = col(self.getOrDefault(self.validationCol)).cast("int") if self.isSet(self.validationCol) else None
        return ce.gather(df, self.getFeaturesCol(), self.getLabelCol(), mark, 1 if mark is None else 2)

    def setting(self, size: int) -> dict:
        """What ``cells.boost`` is told, for vectors of ``size`` features."""
        get = self.getOrDefault
        some = ce.per_node(get(self.featureSubsetStrategy), size)
        return dict(
            rounds=get(self.maxIter), step=get(self.stepSize), depth=get(self.maxDepth), min_rows=get(self.minInstancesPerNode), some=some,
            share=get(self.subsamplingRate), patience=get(self.patience), seed=get(self.seed),
        )

    def fit_cells(self, spark: SparkSession, cells: ce.Cells) -> BoostedOneVsRestModel:
        """The model of the rows of mark 0, stopped early on those of mark 1 if there is a validation column."""
        if not cells.counts[:, 0].any():
            raise ValueError("no training rows")
        fits = ce.boost_classes(spark, cells, self.isSet(self.validationCol), self.setting(len(cells.edges)))
        names = (self.getFeaturesCol(), self.uid)
        model = BoostedOneVsRestModel(lambda: [_loaded(spark, cells.edges, fit, c, *names) for c, fit in enumerate(fits)])
        self._copyValues(model)
        return model

    def _fit_class(self, rows: DataFrame, code: float, early: bool) -> GBTClassificationModel:
        marked = rows.withColumn("__is_class", (F.col("__label") == code).cast("double"))
        rounds = self.getOrDefault(self.maxIter)
        if not early:
            return self._binary(rounds).fit(marked)
        train, valid = marked.where(~F.col("__valid")), marked.where("__valid")
        model = self._binary(rounds).fit(train)
        best = best_round(model.evaluateEachIteration(valid), self.getOrDefault(self.patience))
        return model if best == rounds else first_rounds(model, best)


def _loaded(spark: SparkSession, edges, fit: ce.Boosted, code: int, features: str, uid: str) -> GBTClassificationModel:
    path = ce.stored(spark, ce._BOOSTED, f"{uid}_{code}", fit.trees, [t.values() for t in fit.trees], fit.weights, edges)
    return GBTClassificationModel.load(path).setFeaturesCol(features)


def first_rounds(model: GBTClassificationModel, n: int) -> GBTClassificationModel:
    """The boosted model of the first ``n`` rounds; nothing is grown again."""
    java = model._java_obj
    jvm, gateway = SparkContext._active_spark_context._jvm, SparkContext._active_spark_context._gateway
    trees = gateway.new_array(jvm.org.apache.spark.ml.regression.DecisionTreeRegressionModel, n)
    weights = gateway.new_array(jvm.double, n)
    for i, tree in enumerate(java.trees()[:n]):
        trees[i] = tree
        weights[i] = java.treeWeights()[i]
    cut = GBTClassificationModel(
        jvm.org.apache.spark.ml.classification.GBTClassificationModel(java.uid(), trees, weights, java.numFeatures(), java.numClasses())
    )
    model._copyValues(cut)
    return cut


def best_round(losses: Sequence[float], patience: int) -> int:
    """Round (from 1) of the least loss before ``patience`` rounds without gain."""
    best = 0
    for i, loss in enumerate(losses):
        if loss < losses[best]:
            best = i
        elif patience > 0 and i - best >= patience:
            break
    return best + 1


class BoostedOneVsRestModel(Model, _BoostParams, MLWritable, MLReadable):
    """Fitted forests in class order; adds probability vector and prediction."""

    def __init__(self, models: Sequence[GBTClassificationModel] | Callable[[], list[GBTClassificationModel]] = ()):
        super().__init__()
        self._models = models

    @property
    def models(self) -> list[GBTClassificationModel]:
        """Made when first asked for, where trees were grown on cells."""
        self._models = self._models() if callable(self._models) else list(self._models)
        return self._models

    @property
    def numClasses(self) -> int:
        return len(self.models)

    def _transform(self, df: DataFrame) -> DataFrame:
        out, votes = df, []
        for i, m in enumerate(self.models):
            m = m.copy()
            m.setFeaturesCol(self.getFeaturesCol())
            m.setPredictionCol("")
            m.setRawPredictionCol(f"__raw{i}")
            m.setProbabilityCol(f"__p{i}")
            out = m.transform(out)
            votes.append(vector_to_array(F.col(f"__p{i}"))[1])
        out = out.withColumn("__votes", F.array(*votes))
        total = F.aggregate("__votes", F.lit(0.0), lambda a, b: a + b)
        shares = F.transform("__votes", lambda v: v / F.col("__total"))
        out = out.withColumn("__total", total).withColumn("__shares", shares)
        # the first of equal maxima wins
        code = (F.array_position("__shares", F.array_max("__shares")) - 1).cast("double")
        return (
            out.withColumn(self.getProbabilityCol(), array_to_vector("__shares"))
            .withColumn(self.getPredictionCol(), code)
            .drop("__votes", "__total", "__shares", *[f"__{n}{i}" for i in range(len(self.models)) for n in ("raw", "p")])
        )

    def write(self) -> MLWriter:
        return _BoostWriter(self)

    @classmethod
    def read(cls) -> MLReader:
        return _BoostReader(cls)


class _BoostWriter(MLWriter):
    def __init__(self, instance: BoostedOneVsRestModel):
        super().__init__()
        self.instance = instance

    def saveImpl(self, path: str) -> None:
        extra = {"classes": len(self.instance.models)}
        DefaultParamsWriter.saveMetadata(self.instance, path, self.sparkSession, extraMetadata=extra)
        for i, m in enumerate(self.instance.models):
            m.write().overwrite().save(f"{path}/class-{i}")


class _BoostReader(MLReader):
    def __init__(self, cls):
        super().__init__()
        self.cls = cls

    def load(self, path: str) -> BoostedOneVsRestModel:
        metadata = DefaultParamsReader.loadMetadata(path, self.sparkSession)
        models = [GBTClassificationModel.load(f"{path}/class-{i}") for i in range(metadata["classes"])]
        model = self.cls(models)
        model._resetUid(metadata["uid"])
        DefaultParamsReader.getAndSetParams(model, metadata)
        return model
