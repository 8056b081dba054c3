"""Multiclass boosting of one joint softmax loss, in chunks that can be resumed."""

from __future__ import annotations

import hashlib
import math
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

import numpy as np
from pyspark import SparkContext, keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.feature import VectorSlicer
from pyspark.ml.functions import array_to_vector
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasFeaturesCol, HasLabelCol, HasMaxIter, HasPredictionCol, HasProbabilityCol, HasSeed, HasStepSize
from pyspark.ml.regression import DecisionTreeRegressor, GBTRegressionModel
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
from ..session import ensure_checkpoint_dir, scratch_path
from . import cells as ce

MANY_ROWS = 100_000  # from here on trees grow on the cells of the rows
_FLAT = 1e-16  # a curvature below this moves no leaf
_DRAWS = 1 << 30
_PLAIN_CLASSES = 16  # the arithmetic of the shares is written out up to here; it grows with the square of the classes


def leaf_value(gradient: float, hessian: float, l1: float, l2: float) -> float:
    """Newton step of a leaf: the gradient sum, pulled towards zero by ``l1``, over the curvature sum and ``l2``."""
    pulled = math.copysign(max(abs(gradient) - l1, 0.0), gradient)
    under = hessian + l2
    return -pulled / under if under > _FLAT else 0.0


def probabilities(margins, classes: int | None = None):
    """Softmax of an array column, free of overflow; with a known, small number of classes as plain arithmetic, to the same bits."""
    if classes is not None and 2 <= classes <= _PLAIN_CLASSES:
        most = F.greatest(*[margins[c] for c in range(classes)])
        raised = [F.exp(margins[c] - most) for c in range(classes)]
        total = reduce(lambda a, b: a + b, raised)
        return F.array(*[e / total for e in raised])
    shifted = F.transform(margins, lambda x: F.exp(x - F.array_max(margins)))
    return F.transform(shifted, lambda x: x / F.aggregate(shifted, F.lit(0.0), lambda a, b: a + b))


def best_so_far(losses: Sequence[float], least_gain: float = 0.0) -> int:
    """Round (from 1) that later ones do not improve on by more than ``least_gain``."""
    best = 0
    for i, loss in enumerate(losses):
        if loss < losses[best] - least_gain:
            best = i
    return best + 1


@dataclass
class _Shape:
    """A grown tree cut back: nodes by heap number, the open ones, and the ends."""

    nodes: dict[int, object]
    opened: set[int]
    ends: list[int]


def _is_inner(node) -> bool:
    return node.getClass().getSimpleName() == "InternalNode"


def _cut_back(root, most: int) -> _Shape:
    """Open the node of the highest gain until there are ``most`` ends, as growth by leaf does; no other node is visited."""
    nodes = {1: root}
    gain = lambda i: nodes[i].gain() if _is_inner(nodes[i]) else -1.0
    opened, rim = set(), {1: gain(1)}
    while len(rim) < most:
        i = max(rim, key=lambda n: (rim[n], -n))
        if rim[i] < 0:
            break
        del rim[i]
        opened.add(i)
        nodes[2 * i], nodes[2 * i + 1] = nodes[i].leftChild(), nodes[i].rightChild()
        rim |= {n: gain(n) for n in (2 * i, 2 * i + 1)}
    return _Shape(nodes, opened, sorted(rim))


def _rebuild(jvm, shape: _Shape, values: Sequence[float], features: Sequence[int]):
    """The tree with the given values in its ends; ``features`` gives each split its place among all features."""
    tree, by_end = jvm.org.apache.spark.ml.tree, dict(zip(shape.ends, values))

    def build(i: int):
        node = shape.nodes[i]
        if i not in shape.opened:
            return tree.LeafNode(float(by_end[i]), node.impurity(), node.impurityStats())
        split = tree.ContinuousSplit(features[node.split().featureIndex()], node.split().threshold())
        return tree.InternalNode(node.prediction(), node.impurity(), node.gain(), build(2 * i), build(2 * i + 1), split, node.impurityStats())

    return build(1)


class _SoftmaxParams(HasFeaturesCol, HasLabelCol, HasPredictionCol, HasProbabilityCol, HasMaxIter, HasStepSize, HasSeed):
    maxDepth = Param(Params._dummy(), "maxDepth", "depth of a tree", TypeConverters.toInt)
    maxBins = Param(Params._dummy(), "maxBins", "bins of a feature", TypeConverters.toInt)
    numLeaves = Param(Params._dummy(), "numLeaves", "leaves of a tree", TypeConverters.toInt)
    minInstancesPerNode = Param(Params._dummy(), "minInstancesPerNode", "rows a leaf needs", TypeConverters.toInt)
    featureFraction = Param(Params._dummy(), "featureFraction", "share of features per tree", TypeConverters.toFloat)
    baggingFraction = Param(Params._dummy(), "baggingFraction", "share of rows in the bag", TypeConverters.toFloat)
    baggingFrequency = Param(Params._dummy(), "baggingFrequency", "rounds that share a bag; 0: every row in each", TypeConverters.toInt)
    l1 = Param(Params._dummy(), "l1", "what is taken off the gradient sum of a leaf", TypeConverters.toFloat)
    l2 = Param(Params._dummy(), "l2", "what is added to the curvature sum of a leaf", TypeConverters.toFloat)
    validationCol = Param(Params._dummy(), "validationCol", "boolean column of the validation rows", TypeConverters.toString)
    patience = Param(Params._dummy(), "patience", "rounds without improvement before boosting stops", TypeConverters.toInt)
    chunk = Param(Params._dummy(), "chunk", "rounds between two written states", TypeConverters.toInt)


_DEFAULTS = dict(
    maxIter=500, stepSize=0.05, maxDepth=5, maxBins=64, numLeaves=31, minInstancesPerNode=20, featureFraction=0.9,
    baggingFraction=0.8, baggingFrequency=5, l1=0.0, l2=0.0, patience=5, chunk=5, seed=42,
)


class SoftmaxBoost(Estimator, _SoftmaxParams, DefaultParamsReadable, DefaultParamsWritable):
    """One tree per class and round on the gradients of the joint softmax loss.

    Labels are codes 0..k-1. The margins of all rows are a column. A round fits each class's tree to
    gradient over curvature, weighted by curvature; one aggregate then sums both per
    class and leaf, and a leaf's value is its sums' Newton step with ``l1`` and ``l2``. Trees
    grow to ``maxDepth`` and are cut back to the ``numLeaves`` that growth by leaf would open. Bags of
    rows change every ``baggingFrequency`` rounds.

    With a validation column boosting ends when the validation loss has not fallen for ``patience`` rounds, and
    keeps the rounds up to the least loss: no more than ``patience`` rounds are grown in vain. Margins are written to
    the shared folder every ``chunk`` rounds, so a lost executor costs that many rounds at most;
    ``resume`` grows further rounds upon a fitted model.

    Rows without a label or with a null validation mark are left out.

    ``MANY_ROWS`` rows or more are first counted in the cells of their bins (``cells``), and the trees grow on those; a bag then
    draws a count per cell. Only where there are too many cells, and in ``resume``, every round passes over the rows.
    """

    @keyword_only
    def __init__(
        self, featuresCol="features", labelCol="label", predictionCol="prediction", probabilityCol="probability", maxIter=500, stepSize=0.05,
        maxDepth=5, maxBins=64, numLeaves=31, minInstancesPerNode=20, featureFraction=0.9, baggingFraction=0.8, baggingFrequency=5,
        l1=0.0, l2=0.0, validationCol=None, patience=5, chunk=5, seed=42,
    ):
        super().__init__()
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})
        self._setDefault(**_DEFAULTS)

    def _fit(self, df: DataFrame) -> SoftmaxBoostModel:
        return self.resume(df, None)

    def resume(self, df: DataFrame, model: SoftmaxBoostModel | None) -> SoftmaxBoostModel:
        """Grows up to ``maxIter`` further rounds on ``df`` upon ``model``, as one longer fit would."""
        if model is None and df.count() >= MANY_ROWS:
            cells = self.cells(df)
            if cells is not None and cells.counts[:, 0].any() and not _beyond(cells):
                return self.fit_cells(df.sparkSession, cells)
        return _Run(self, df, model).model()

    def wants_cells(self, rows: int) -> bool:
        return rows >= MANY_ROWS

    def cells(self, df: DataFrame) -> ce.Cells | None:
        """Cells of the rows; mark 1 is that of the validation rows, if there are any."""
        mark = col(self.getOrDefault(self.validationCol)).cast("int") if self.isSet(self.validationCol) else None
        label = col(self.getLabelCol()).cast("int")
        rows = df.select(col(self.getFeaturesCol()).alias("features"), label.alias("label"), (F.lit(0) if mark is None else mark).alias("mark"))
        rows = rows.where("label is not null and mark is not null")
        return ce.gather(rows, "features", "label", F.col("mark"), 1 if mark is None else 2, self.getOrDefault(self.maxBins))

    def fit_cells(self, spark: SparkSession, cells: ce.Cells) -> SoftmaxBoostModel:
        """The model of the rows of mark 0, stopped early on those of mark 1 if there is a validation column."""
        get = lambda name: self.getOrDefault(self.getParam(name))
        early, size = self.isSet(self.validationCol), len(cells.edges)
        train = cells.counts[:, 0]
        valid = cells.counts[:, 1] if cells.counts.shape[1] > 1 else 0 * train
        seen = train.sum(axis=0)
        k = int(np.flatnonzero(seen).max()) + 1
        priors = [math.log((seen[c] + 0.5) / (seen.sum() + 0.5 * k)) for c in range(k)]
        margins, factor = np.tile(priors, (len(train), 1)), k / (k - 1) if k > 1 else 1.0
        trees: list[list[tuple]] = [[] for _ in range(k)]
        losses: list[float] = []
        bag, drawn = train, get("baggingFrequency") > 0 and get("baggingFraction") < 1
        for number in range(get("maxIter")):
            if drawn and number % get("baggingFrequency") == 0:
                rng = np.random.default_rng([get("seed") & (2**63 - 1), number // get("baggingFrequency")])
                bag = rng.binomial(train.astype(np.int64), get("baggingFraction")).astype(np.float64)
            rows, shares, moved = bag.sum(axis=1), _shares(margins), margins.copy()
            for c in range(k):
                share, own = shares[:, c], bag[:, c]
                curvature = np.maximum(factor * share * (1 - share), _FLAT)
                chosen = features_of(get("seed"), get("featureFraction"), size, number, c)
                squares = (own * (1 - share) ** 2 + (rows - own) * share**2) / curvature
                tree = ce.grow(
                    cells.bins[:, chosen], [cells.widths[f] for f in chosen], rows, rows * curvature, [own - rows * share], squares, get("maxDepth"),
                    get("minInstancesPerNode"), len(chosen), None,
                )
                tree = ce.cut_back(tree, get("numLeaves"))
                tree.feature = np.where(tree.feature >= 0, np.array(chosen)[tree.feature], -1)
                values = np.array([get("stepSize") * leaf_value(-g, h, get("l1"), get("l2")) for g, h in zip(tree.sums[0], tree.weight)])
                moved[:, c] += values[tree.at]
                tree.at = None
                trees[c].append((tree, values))
            margins = moved
            if early:
                lost = -np.log(np.maximum(_shares(margins), 1e-300)) * valid[:, :k]
                losses.append(lost.sum() / valid.sum() if valid.any() else float("nan"))
                if get("patience") > 0 and len(losses) - best_so_far(losses) >= get("patience"):
                    break
        grown = len(trees[0])
        rounds = max(best_so_far(losses), 1) if early and losses else grown
        models = []
        for c, own in enumerate(trees):
            own = own[:rounds]
            path = ce.stored(spark, ce._SUMMED, f"{self.uid}_{c}", [t for t, _ in own], [v for _, v in own], [1.0] * len(own), cells.edges)
            models.append(GBTRegressionModel.load(path))
        model = SoftmaxBoostModel(models, priors)
        model.grown, model.losses = grown, list(losses)
        self._copyValues(model)
        return model


def _beyond(cells: ce.Cells) -> bool:
    """Whether a class is among the validation rows only, and beyond those of the training rows."""
    seen = cells.counts.sum(axis=0)
    return bool(np.flatnonzero(seen.sum(axis=0)).max() > np.flatnonzero(seen[0]).max())


def _shares(margins: np.ndarray) -> np.ndarray:
    raised = np.exp(margins - margins.max(axis=1, keepdims=True))
    return raised / raised.sum(axis=1, keepdims=True)


def features_of(seed: int, fraction: float, size: int, round_: int, c: int) -> list[int]:
    """The features that a tree may split on; the same for the same seed, round and class."""
    many = max(1, math.ceil(fraction * size - 1e-9))
    draw = lambda i: hashlib.md5(f"{seed}|{round_}|{c}|{i}".encode()).digest()
    return sorted(sorted(range(size), key=draw)[:many])


class _Run:
    def __init__(self, estimator: SoftmaxBoost, df: DataFrame, model: SoftmaxBoostModel | None):
        self.spark: SparkSession = df.sparkSession
        ensure_checkpoint_dir(self.spark)
        self.estimator, self.start = estimator, model
        get = self.get = lambda name: estimator.getOrDefault(estimator.getParam(name))
        self.early = estimator.isSet(estimator.validationCol)
        features, label = col(get("featuresCol")), col(get("labelCol")).cast("int")
        valid = col(get("validationCol")) if self.early else F.lit(False)
        # splits are on values, whatever the columns of the vector were said to be
        rows = df.select(features.alias("features", metadata={}), label.alias("label"), valid.alias("valid"))
        rows = rows.where("label is not null and valid is not null").withColumn("row", F.monotonically_increasing_id())
        # numbered and written once: bags then stay the same rows whenever they are drawn
        rows = self.written(rows)
        counts = {r["label"]: r["n"] for r in rows.where("not valid").groupBy("label").agg(F.count("*").alias("n")).collect()}
        if not counts:
            raise ValueError("no training rows")
        self.classes = model.numClasses if model else max(counts) + 1
        if min(counts) < 0 or max(counts) >= self.classes:
            raise ValueError("labels must be codes from 0 on")
        total = sum(counts.values())
        self.priors = model.priors if model else [math.log((counts.get(c, 0) + 0.5) / (total + 0.5 * self.classes)) for c in range(self.classes)]
        self.size = len(rows.first()["features"])
        flat = F.array(*[F.lit(p) for p in self.priors])
        self.state = model.with_margins(rows, "features", "margins") if model else rows.withColumn("margins", flat)
        self.before = model.rounds if model else 0
        self.trees: list[list] = [list(m._java_obj.trees()) for m in model.models] if model else [[] for _ in range(self.classes)]
        self.losses: list[float] = []

    def written(self, df: DataFrame) -> DataFrame:
        path = scratch_path(self.spark, "boosting")
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def features_of(self, round_: int, c: int) -> list[int]:
        """The features that the tree may split on; the same for the same seed, round and class."""
        return features_of(self.get("seed"), self.get("featureFraction"), self.size, round_, c)

    def round(self, state: DataFrame, number: int) -> DataFrame:
        """The state after one more tree per class."""
        get, k = self.get, self.classes
        used = ~F.col("valid")
        if get("baggingFrequency") > 0 and get("baggingFraction") < 1:
            drawn = F.pmod(F.xxhash64(F.lit(get("seed")), F.lit(number // get("baggingFrequency")), "row"), F.lit(_DRAWS))
            used &= drawn < int(get("baggingFraction") * _DRAWS)
        factor = k / (k - 1) if k > 1 else 1.0
        shares = state.where(used).select("features", "label", probabilities(F.col("margins"), k).alias("p"))
        slopes = []
        for c in range(k):
            share = F.col("p")[c]
            slopes.append((share - (F.col("label") == c).cast("double")).alias(f"g{c}"))
            slopes.append(F.greatest(F.lit(factor) * share * (1 - share), F.lit(_FLAT)).alias(f"h{c}"))
        # the bag of the round: each tree passes over it several times, for its own two columns
        bag = shares.select("features", *slopes).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            return self.after_trees(state, bag, number)
        finally:
            bag.unpersist()

    def after_trees(self, state: DataFrame, bag: DataFrame, number: int) -> DataFrame:
        """``state`` with the steps of trees grown on ``bag``, which holds gradient and curvature per class."""
        get, k = self.get, self.classes
        parts, grown, placed = [], [], bag
        for c in range(k):
            gradient, curvature = F.col(f"g{c}"), F.col(f"h{c}")
            chosen = self.features_of(number, c)
            grower = DecisionTreeRegressor(
                featuresCol="some", labelCol="target", weightCol="weight", maxDepth=get("maxDepth"), maxBins=get("maxBins"),
                minInstancesPerNode=get("minInstancesPerNode"), seed=get("seed"),
            )
            rows = bag.withColumns({"target": -gradient / curvature, "weight": curvature})
            if len(chosen) < self.size:
                rows = VectorSlicer(inputCol="features", outputCol="some", indices=chosen).transform(rows)
            else:
                rows = rows.withColumn("some", F.col("features"))
            fitted = grower.fit(rows.select("some", "target", "weight"))
            shape = _cut_back(fitted._java_obj.rootNode(), get("numLeaves"))
            # a tree that tells the number of the end a row falls into
            placed = self.adding([self.tree(fitted.uid, shape, range(len(shape.ends)), chosen)], f"end{c}").transform(placed)
            parts.append(F.struct(F.lit(c).alias("c"), F.col(f"end{c}").cast("int").alias("end"), gradient.alias("g"), curvature.alias("h")))
            grown.append((fitted.uid, shape, chosen))
        # one row per class and end, combined before the shuffle
        found = placed.select(F.explode(F.array(*parts)).alias("s")).groupBy("s.c", "s.end")
        sums = {(r["c"], r["end"]): (r["g"], r["h"]) for r in found.agg(F.sum("s.g").alias("g"), F.sum("s.h").alias("h")).collect()}
        out, steps = state, []
        for c, (uid, shape, chosen) in enumerate(grown):
            values = [get("stepSize") * leaf_value(*sums.get((c, i), (0.0, 0.0)), get("l1"), get("l2")) for i in range(len(shape.ends))]
            self.trees[c].append(self.tree(uid, shape, values, chosen))
            out = self.adding(self.trees[c][-1:], f"step{c}").transform(out)
            steps.append(F.col("margins")[c] + F.col(f"step{c}"))
        return out.select("features", "label", "valid", "row", F.array(*steps).alias("margins"))

    def tree(self, uid: str, shape: _Shape, values: Sequence[float], chosen: Sequence[int]):
        jvm = SparkContext._active_spark_context._jvm
        return jvm.org.apache.spark.ml.regression.DecisionTreeRegressionModel(uid, _rebuild(jvm, shape, values, chosen), self.size)

    def adding(self, trees: list, out: str) -> GBTRegressionModel:
        return self.ensemble(trees).setFeaturesCol("features").setPredictionCol(out)

    def ensemble(self, trees: list) -> GBTRegressionModel:
        """The sum of trees."""
        context = SparkContext._active_spark_context
        jvm, gateway = context._jvm, context._gateway
        kept = gateway.new_array(jvm.org.apache.spark.ml.regression.DecisionTreeRegressionModel, len(trees))
        weights = gateway.new_array(jvm.double, len(trees))
        for i, tree in enumerate(trees):
            kept[i], weights[i] = tree, 1.0
        uid = f"SoftmaxBoost_{hashlib.md5('|'.join(t.uid() for t in trees).encode()).hexdigest()[:12]}"
        return GBTRegressionModel(jvm.org.apache.spark.ml.regression.GBTRegressionModel(uid, kept, weights, self.size))

    def model(self) -> SoftmaxBoostModel:
        get, patience = self.get, self.get("patience")
        state, kept = self.state, None
        lost = F.when(F.col("valid"), -F.log(F.greatest(probabilities(F.col("margins"), self.classes)[F.col("label")], F.lit(1e-300))))
        for number in range(self.before, self.before + get("maxIter")):
            state = self.round(state, number)
            if (number + 1) % get("chunk") == 0:
                state, held = self.written(state), None
            else:
                state = held = state.persist(StorageLevel.MEMORY_AND_DISK)
            # reads every row, so the new margins are kept before the old ones go
            loss = state.agg(F.avg(lost), F.count("row")).first()[0]
            if kept is not None:
                kept.unpersist()
            kept = held
            if self.early:
                self.losses.append(loss if loss is not None else float("nan"))
                if patience > 0 and len(self.losses) - best_so_far(self.losses) >= patience:
                    break
        if kept is not None:
            kept.unpersist()
        grown = len(self.trees[0])
        rounds = self.before + best_so_far(self.losses) if self.early and self.losses else grown
        model = SoftmaxBoostModel([self.ensemble(t[: max(rounds, 1)]) for t in self.trees], self.priors)
        model.grown, model.losses = grown, list(self.losses)
        self.estimator._copyValues(model)
        return model


class SoftmaxBoostModel(Model, _SoftmaxParams, MLWritable, MLReadable):
    """One sum of trees per class. ``grown``: rounds grown in all; ``losses``: validation loss of the last fit's rounds."""

    def __init__(self, models: Sequence[GBTRegressionModel] = (), priors: Sequence[float] = ()):
        super().__init__()
        self.models, self.priors = list(models), list(priors)
        self.grown, self.losses = self.rounds, []
        self._setDefault(**_DEFAULTS)

    @property
    def numClasses(self) -> int:
        return len(self.models)

    @property
    def rounds(self) -> int:
        return self.models[0].getNumTrees if self.models else 0

    def with_margins(self, df: DataFrame, features: str, out: str) -> DataFrame:
        for c, m in enumerate(self.models):
            m = m.copy()
            m.setFeaturesCol(features)
            m.setPredictionCol(f"__margin{c}")
            df = m.transform(df)
        total = F.array(*[F.col(f"__margin{c}") + F.lit(p) for c, p in enumerate(self.priors)])
        return df.withColumn(out, total).drop(*[f"__margin{c}" for c in range(len(self.models))])

    def _transform(self, df: DataFrame) -> DataFrame:
        out = self.with_margins(df, self.getFeaturesCol(), "__margins").withColumn("__shares", probabilities(F.col("__margins"), self.numClasses))
        # the first of equal maxima wins
        code = (F.array_position("__shares", F.array_max("__shares")) - 1).cast("double")
        out = out.withColumn(self.getProbabilityCol(), array_to_vector("__shares")).withColumn(self.getPredictionCol(), code)
        return out.drop("__margins", "__shares")

    def write(self) -> MLWriter:
        return _SoftmaxWriter(self)

    @classmethod
    def read(cls) -> MLReader:
        return _SoftmaxReader(cls)


class _SoftmaxWriter(MLWriter):
    def __init__(self, instance: SoftmaxBoostModel):
        super().__init__()
        self.instance = instance

    def saveImpl(self, path: str) -> None:
        extra = {"priors": self.instance.priors, "grown": self.instance.grown, "losses": self.instance.losses}
        DefaultParamsWriter.saveMetadata(self.instance, path, self.sparkSession, extraMetadata=extra)
        for c, m in enumerate(self.instance.models):
            m.write().overwrite().save(f"{path}/class-{c}")


class _SoftmaxReader(MLReader):
    def __init__(self, cls):
        super().__init__()
        self.cls = cls

    def load(self, path: str) -> SoftmaxBoostModel:
        metadata = DefaultParamsReader.loadMetadata(path, self.sparkSession)
        models = [GBTRegressionModel.load(f"{path}/class-{c}") for c in range(len(metadata["priors"]))]
        model = self.cls(models, metadata["priors"])
        model.grown, model.losses = metadata["grown"], metadata["losses"]
        model._resetUid(metadata["uid"])
        DefaultParamsReader.getAndSetParams(model, metadata)
        return model
