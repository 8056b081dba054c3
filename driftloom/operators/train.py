"""Training, tuning and experiment grids on ``pyspark.ml``."""

from __future__ import annotations

import hashlib
import math
import traceback
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field
from multiprocessing.pool import ThreadPool

import numpy as np
import pyarrow as pa
from pyspark import SparkContext, inheritable_thread_target
from pyspark.ml import Estimator, Pipeline, PipelineModel
from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.evaluation import Evaluator
from pyspark.ml.functions import array_to_vector
from pyspark.ml.param.shared import HasLabelCol, HasPredictionCol
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.storagelevel import StorageLevel

from ..functions.columns import col, numeric_columns
from ..session import ensure_checkpoint_dir, scratch_path
from . import cells as ce
from .boosting import BoostedOneVsRest
from .evaluate import metrics, pair_counts
from .features import FEATURES, explained_variance, label_indexer, pca_stage, preprocessing
from .softmax import SoftmaxBoost
from .split import SEED, mark_test, stratified_folds

LABEL_CODE = "label_code"
MAX_DEPTH = 30  # the deepest tree Spark grows

MODEL_TYPES = ("random_forest", "gbt", "softmax")
MANY_BAGS = 50_000_000  # rows times trees; Spark keeps a number for each
TREES_AT_ONCE = 20


class Forest(RandomForestClassifier):
    """Forest whose bags are not kept per row where there are ``MANY_BAGS`` of them.

    Such a forest is grown on the cells of the rows (``cells``); where they are too many, in
    groups of ``TREES_AT_ONCE`` trees, each with a seed of its own, over the same rows.
    """

    def _fit(self, df: DataFrame) -> RandomForestClassificationModel:
        if not self.wants_cells(df.count()):
            return super()._fit(df)
        found = self.cells(df)
        return self.fit_groups(df) if found is None else self.fit_cells(df.sparkSession, found)

    def wants_cells(self, rows: int) -> bool:
        return rows * self.getNumTrees() >= MANY_BAGS

    def cells(self, df: DataFrame, mark: Column | None = None, marks: int = 1) -> ce.Cells | None:
        """Cells of the rows, unless the forest asks for what growing on cells does not know."""
        if self.getImpurity() != "gini" or self.isSet(self.weightCol) or self.getMinWeightFractionPerNode() > 0 or self.getMinInfoGain() > 0:
            return None
        return ce.gather(df, self.getFeaturesCol(), self.getLabelCol(), mark, marks, self.getMaxBins())

    def fit_cells(self, spark, cells: ce.Cells) -> RandomForestClassificationModel:
        some = ce.per_node(self.getFeatureSubsetStrategy(), len(cells.edges), self.getNumTrees())
        trees = ce.forest(
            cells, self.getNumTrees(), self.getMaxDepth(), self.getMinInstancesPerNode(), some, self.getSeed(), self.getSubsamplingRate(), self.getBootstrap()
        )
        guesses = [t.sums.argmax(axis=0) for t in trees]
        path = ce.stored(spark, ce._FOREST, self.uid, trees, guesses, [1.0] * len(trees), cells.edges, max(cells.counts.shape[2], 2))
        return self._copyValues(RandomForestClassificationModel.load(path))

    def fit_groups(self, df: DataFrame) -> RandomForestClassificationModel:
        starts = range(0, self.getNumTrees(), TREES_AT_ONCE)
        sizes = [min(TREES_AT_ONCE, self.getNumTrees() - i) for i in starts]
        strategy = str(ce.per_node(self.getFeatureSubsetStrategy(), len(df.first()[self.getFeaturesCol()]), self.getNumTrees()))
        groups = []
        for i, n in zip(starts, sizes):
            one = {self.numTrees: n, self.seed: self.getSeed() + i, self.featureSubsetStrategy: strategy}
            groups.append(self.copy(one)._fit_plain(df))
        jvm, gateway = SparkContext._active_spark_context._jvm, SparkContext._active_spark_context._gateway
        trees = [t for g in groups for t in g._java_obj.trees()]
        kept = gateway.new_array(jvm.org.apache.spark.ml.classification.DecisionTreeClassificationModel, len(trees))
        for i, tree in enumerate(trees):
            kept[i] = tree
        whole = jvm.org.apache.spark.ml.classification.RandomForestClassificationModel(
            self.uid, kept, groups[0].numFeatures, max(g.numClasses for g in groups)
        )
        model = self._copyValues(RandomForestClassificationModel(whole))
        model._transfer_params_to_java()
        return model

    def _fit_plain(self, df: DataFrame) -> RandomForestClassificationModel:
        return super()._fit(df)


def random_forest(
    n_trees: int = 200, max_depth: int = MAX_DEPTH, seed: int = SEED, label: str = LABEL_CODE, **params
) -> Forest:
    """Gini forest on bootstrap samples with sqrt(features) per split.

    Trees grow as deep as Spark grows them unless ``max_depth`` says less.
    """
    if max_depth > MAX_DEPTH:
        raise ValueError(f"max_depth {max_depth} is over {MAX_DEPTH}, the deepest tree that Spark grows")
    return Forest(
        featuresCol="features",
        labelCol=label,
        numTrees=n_trees,
        maxDepth=max_depth,
        featureSubsetStrategy="sqrt",
        impurity="gini",
        seed=seed,
        **params,
    )


def gbt_one_vs_rest(
    n_rounds: int = 500,
    learning_rate: float = 0.05,
    max_depth: int = 5,
    patience: int = 5,
    validation_col: str | None = None,
    seed: int = SEED,
    label: str = LABEL_CODE,
    **params,
) -> BoostedOneVsRest:
    return BoostedOneVsRest(
        featuresCol="features",
        labelCol=label,
        maxIter=n_rounds,
        stepSize=learning_rate,
        maxDepth=max_depth,
        patience=patience,
        validationCol=validation_col,
        seed=seed,
        **params,
    )


def softmax_boost(
    n_rounds: int = 500,
    learning_rate: float = 0.05,
    max_depth: int = 5,
    patience: int = 5,
    validation_col: str | None = None,
    seed: int = SEED,
    label: str = LABEL_CODE,
    **params,
) -> SoftmaxBoost:
    """Boosting of the joint multiclass loss; further parameters as in ``SoftmaxBoost``."""
    return SoftmaxBoost(
        featuresCol="features",
        labelCol=label,
        maxIter=n_rounds,
        stepSize=learning_rate,
        maxDepth=max_depth,
        patience=patience,
        validationCol=validation_col,
        seed=seed,
        **params,
    )


def model_stage(model_type: str, **params) -> Estimator:
    if model_type == "random_forest":
        return random_forest(**params)
    if model_type == "gbt":
        return gbt_one_vs_rest(**params)
    if model_type == "softmax":
        return softmax_boost(**params)
    raise ValueError(f"Unknown model_type: {model_type}")


def spread(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Training rows, cut to the columns needed and spread evenly over the cores.

    A fit passes over its rows once per tree level; rows left where a split or
    a small file put them would keep most cores idle in every pass.
    """
    # partitions of about equal size, as many as the bytes at hand call for and the cores can use
    return df.select(*[col(c) for c in dict.fromkeys(columns)]).hint("rebalance")


def fit_spread(estimator: Estimator, train: DataFrame, columns: Sequence[str]):
    """Fit a chain of stages on spread rows, kept while each stage passes over them."""
    rows = spread(train, columns).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        return estimator.fit(rows)
    finally:
        rows.unpersist()


def full_pipeline(
    columns: Sequence[str],
    label: str,
    model_type: str = "random_forest",
    use_pca: bool = False,
    k: int = 50,
    **params,
) -> Pipeline:
    """Label codes, scaler, PCA and classifier as one estimator."""
    stage = model_stage(model_type, **params)
    prep = preprocessing(columns, use_pca, k)
    return Pipeline(stages=[label_indexer(label, LABEL_CODE), *prep.getStages(), stage])


def fit_with_validation(
    train: DataFrame,
    label: str,
    key: Sequence[str],
    columns: Sequence[str],
    valid_size: float = 0.2,
    use_pca: bool = False,
    k: int = 50,
    seed: int = SEED,
    model_type: str = "gbt",
    **params,
) -> PipelineModel:
    """Boosting ("gbt" or "softmax") stopped early on a stratified part of the training rows."""
    marked = mark_test(train, label, key, valid_size, f"{seed}|validation", out="__validation")
    estimator = full_pipeline(
        columns, label, model_type, use_pca, k, validation_col="__validation", seed=seed, **params
    )
    return fit_spread(estimator, marked, [*columns, label, "__validation"])


class MacroF1(Evaluator, HasLabelCol, HasPredictionCol):
    """Unweighted mean f1 over the classes, from one pass of pair counts."""

    def __init__(self, labelCol: str = LABEL_CODE, predictionCol: str = "prediction"):
        super().__init__()
        self._set(labelCol=labelCol, predictionCol=predictionCol)

    def _evaluate(self, df: DataFrame) -> float:
        row = metrics(pair_counts(df, self.getLabelCol(), self.getPredictionCol())).first()
        return float(row["f1_macro"] or 0.0)

    def isLargerBetter(self) -> bool:
        return True


# Fixed values. Search space of one-versus-rest boosting: (kind, low, high). Leaf counts are
# reached through the depth; L1/L2 leaf penalties have no counterpart there.
SEARCH_SPACE: dict[str, tuple[str, float, float]] = {
    "stepSize": ("log", 0.01, 0.3),
    "maxDepth": ("int", 3, 20),
    "minInstancesPerNode": ("int", 5, 50),
    "featureSubsetStrategy": ("share", 0.6, 1.0),
    "subsamplingRate": ("float", 0.6, 1.0),
}


# Fixed values. Search space of boosting on the joint loss.
SOFTMAX_SPACE: dict[str, tuple[str, float, float]] = {
    "stepSize": ("log", 0.01, 0.3),
    "numLeaves": ("int", 20, 200),
    "maxDepth": ("int", 3, 20),
    "minInstancesPerNode": ("int", 5, 50),
    "featureFraction": ("float", 0.6, 1.0),
    "baggingFraction": ("float", 0.6, 1.0),
    "baggingFrequency": ("int", 1, 10),
    "l1": ("float", 0.0, 5.0),
    "l2": ("float", 0.0, 5.0),
}


def draw(space: Mapping[str, tuple[str, float, float]], trial: int, seed: int) -> dict:
    """One random setting; the same for the same trial number and seed."""
    out = {}
    for name, (kind, low, high) in space.items():
        digest = hashlib.md5(f"{seed}|{trial}|{name}".encode()).hexdigest()
        u = int(digest[:8], 16) / 2**32
        if kind == "log":
            out[name] = math.exp(math.log(low) + u * (math.log(high) - math.log(low)))
        elif kind == "int":
            out[name] = int(low) + int(u * (int(high) - int(low) + 1))
        elif kind == "share":
            out[name] = f"{low + u * (high - low):.4f}"
        else:
            out[name] = low + u * (high - low)
    return out


def tune(
    df: DataFrame,
    label: str,
    key: Sequence[str],
    estimator: BoostedOneVsRest | SoftmaxBoost | None = None,
    space: Mapping[str, tuple[str, float, float]] | None = None,
    n_trials: int = 50,
    folds: int = 5,
    final_rounds: int = 800,
    parallelism: int = 2,
    seed: int = SEED,
):
    """Seeded random search by mean macro f1 over stratified folds; by default of the joint loss over all its parameters.

    In each fold boosting stops early on the fold's own rows (``patience`` of the
    estimator). ``df`` holds ``features`` and the label column. Returns (model refitted on
    all rows with the best setting, best setting, trial rows as
    (trial, setting, mean macro f1)).
    """
    estimator = estimator or softmax_boost()
    space = space or (SOFTMAX_SPACE if isinstance(estimator, SoftmaxBoost) else SEARCH_SPACE)
    settings = [draw(space, t, seed) for t in range(n_trials)]
    coded = label_indexer(label, LABEL_CODE).fit(df).transform(df)
    folded = stratified_folds(coded, label, key, folds, seed, out="__fold")
    folded = folded.withColumn("__fold", col("__fold").cast("int"))
    maps = [{estimator.getParam(k): v for k, v in s.items()} for s in settings]
    cells = _cells_of_search(coded, folded, estimator, n_trials, folds)
    if cells is not None:
        scores = _scores_on_cells(df.sparkSession, cells, [estimator.copy(m) for m in maps], folds)
        best = max(range(n_trials), key=lambda t: (scores[t], -t))
        whole = ce.Cells(cells.edges, cells.bins, cells.counts.sum(axis=1, keepdims=True))
        model = estimator.copy({**maps[best], estimator.maxIter: final_rounds}).fit_cells(df.sparkSession, whole)
        return model, settings[best], [(t, settings[t], scores[t]) for t in range(n_trials)]
    narrow = spread(folded, ["features", LABEL_CODE, "__fold"]).persist(StorageLevel.MEMORY_AND_DISK)
    evaluator = MacroF1(estimator.getLabelCol())

    def fold_score(trial: int, fold: int) -> float:
        """Boosting stops on the rows of the fold, which are then scored."""
        marked = narrow.withColumn("__valid", F.col("__fold") == fold)
        stopped = estimator.copy({**maps[trial], estimator.validationCol: "__valid"})
        return evaluator.evaluate(stopped.fit(marked).transform(marked.where("__valid")))

    pool = ThreadPool(parallelism)
    try:
        jobs = [(t, f) for t in range(n_trials) for f in range(folds)]
        found = dict(zip(jobs, pool.starmap(inheritable_thread_target(df.sparkSession)(fold_score), jobs)))
        scores = [sum(found[t, f] for f in range(folds)) / folds for t in range(n_trials)]
        best = max(range(n_trials), key=lambda t: (scores[t], -t))
        final = dict(maps[best])
        final[estimator.maxIter] = final_rounds
        model = estimator.copy(final).fit(narrow)
    finally:
        pool.close()
        narrow.unpersist()
    trials = [(t, settings[t], float(scores[t])) for t in range(n_trials)]
    return model, settings[best], trials


def _cells_of_search(rows: DataFrame, folded: DataFrame, estimator, n_trials: int, folds: int) -> ce.Cells | None:
    """Cells with the fold as mark, where the search is much work; the folds are read in one pass only, so nothing is kept."""
    if not isinstance(estimator, BoostedOneVsRest) or not estimator.wants_cells(rows.count() * n_trials * folds):
        return None
    return ce.gather(folded, estimator.getFeaturesCol(), estimator.getLabelCol(), col("__fold"), folds)


def _scores_on_cells(spark, cells: ce.Cells, estimators: Sequence[BoostedOneVsRest], folds: int) -> list[float]:
    """Mean macro f1 over the folds, per estimator."""
    pairs = ce.search(spark, cells, [e.setting(len(cells.edges)) for e in estimators], folds)
    found = {(r["trial"], r["fold"]): r["f1_macro"] for r in metrics(pairs, ["trial", "fold"]).collect()}
    return [sum(float(found.get((t, f)) or 0.0) for f in range(folds)) / folds for t in range(len(estimators))]


# Fixed values. Experiment grid: five forest and six boosting configurations.
DEFAULT_GRID: list[dict] = [
    {"model_type": "random_forest", "n_trees": 100, "use_pca": True, "k": 50},
    {"model_type": "random_forest", "n_trees": 200, "use_pca": True, "k": 50},
    {"model_type": "random_forest", "n_trees": 300, "use_pca": True, "k": 50},
    {"model_type": "random_forest", "n_trees": 200, "use_pca": False},
    {"model_type": "random_forest", "n_trees": 100, "use_pca": True, "k": 30},
    {"model_type": "gbt", "learning_rate": 0.05, "max_depth": 5, "n_rounds": 500, "use_pca": True, "k": 50},
    {"model_type": "gbt", "learning_rate": 0.1, "max_depth": 5, "n_rounds": 500, "use_pca": True, "k": 50},
    {"model_type": "gbt", "learning_rate": 0.05, "max_depth": 6, "n_rounds": 500, "use_pca": True, "k": 50},
    {"model_type": "gbt", "learning_rate": 0.05, "max_depth": 5, "n_rounds": 300, "use_pca": False},
    {"model_type": "gbt", "learning_rate": 0.03, "max_depth": 5, "n_rounds": 500, "use_pca": True, "k": 50},
    {"model_type": "gbt", "learning_rate": 0.05, "max_depth": 4, "n_rounds": 500, "use_pca": True, "k": 50},
]


VALID_SIZE = 0.2
BOOSTED = ("gbt", "softmax")


@dataclass
class _Prepared:
    number: int
    model: PipelineModel
    train: DataFrame
    test: DataFrame
    cells: dict[int, tuple[ce.Cells, ce.Cells] | None] = field(default_factory=dict)  # of training and test rows, by number of bins


class _Preparations:
    """The distinct beginnings of a grid's pipelines, each fitted and applied when first asked for."""

    def __init__(self, train, test, label, key, columns, configs, seed):
        self.label, self.columns, self.test = label, columns, test
        sizes = sorted({c.get("valid_size", VALID_SIZE) for c in configs if c.get("model_type") in BOOSTED})
        #: column that marks the validation rows, per share
        self.marks = {size: f"__validation{i}" for i, size in enumerate(sizes)}
        for size, mark in self.marks.items():
            train = mark_test(train, label, key, size, f"{seed}|validation", out=mark)
        self.train = train
        self.made: dict[tuple, _Prepared] = {}

    def get(self, use_pca: bool, k: int) -> _Prepared:
        name = (True, k) if use_pca else (False,)
        if name not in self.made:
            stages = [label_indexer(self.label, LABEL_CODE), *preprocessing(self.columns, use_pca, k).getStages()]
            model = fit_spread(Pipeline(stages=stages), self.train, [*self.columns, self.label])
            parts = [self._written(model.transform(rows), marks) for rows, marks in ((self.train, self.marks.values()), (self.test, []))]
            self.made[name] = _Prepared(len(self.made) + 1, model, *parts)
        return self.made[name]

    def cells(self, ready: _Prepared, stage) -> tuple[ce.Cells, ce.Cells] | None:
        """Cells of the training and the test rows for a stage that is to be grown on them, gathered once per preparation."""
        marked = list(self.marks.values())
        if not hasattr(stage, "wants_cells") or len(marked) > 1 or not stage.wants_cells(ready.train.count()):
            return None
        bins = stage.getMaxBins() if isinstance(stage, Forest) else 32
        if bins not in ready.cells:
            mark, marks = (col(marked[0]), 2) if marked else (None, 1)
            train = ce.gather(ready.train, FEATURES, LABEL_CODE, mark, marks, bins)
            test = train and ce.gather(ready.test, FEATURES, LABEL_CODE, edges=train.edges)
            ready.cells[bins] = (train, test) if test else None
        return ready.cells[bins]

    def _written(self, rows: DataFrame, marks) -> DataFrame:
        path = scratch_path(rows.sparkSession, "prepared")
        narrow = rows.select(FEATURES, LABEL_CODE, *marks)
        narrow.write.parquet(path)
        return rows.sparkSession.read.schema(narrow.schema).parquet(path)


def _pairs_on_cells(fitted, cells: ce.Cells) -> DataFrame:
    """Pair counts of all rows in the cells: a model grown on them gives the rows of a cell the same class, so it scores one vector for each."""
    spark, counts = SparkSession.getActiveSession(), cells.counts.sum(axis=1)
    at, code = np.nonzero(counts)
    points = cells.points()[at]
    table = pa.table({"x": pa.FixedSizeListArray.from_arrays(pa.array(points.ravel()), points.shape[1]).cast(pa.list_(pa.float64())), LABEL_CODE: code.astype(np.float64), "n": counts[at, code].astype(np.int64)})
    rows = spark.createDataFrame(table).withColumn(FEATURES, array_to_vector("x"))
    scored = fitted.transform(rows)
    return scored.groupBy(F.col(LABEL_CODE).alias("true_label"), F.col("prediction").alias("pred_label")).agg(F.sum("n").alias("n"))


def run_grid(
    train: DataFrame,
    test: DataFrame,
    label: str,
    key: Sequence[str],
    configs: Sequence[Mapping] = tuple(DEFAULT_GRID),
    columns: Sequence[str] | None = None,
    seed: int = SEED,
    on_model: Callable | None = None,
) -> DataFrame:
    """Train and test every configuration; a failing one is recorded and skipped.

    Returns run rows: run_id, run_name, params, metrics of train and test rows, tags
    (``runs.append_runs`` keeps them). Boosting stops
    early on part of the training rows, never on the test rows.

    Label codes, scaler and PCA are fitted once for all configurations that share
    them (tag ``preparation``); their output is written once, and the classifiers
    are trained and tested on that table.
    """
    ensure_checkpoint_dir(train.sparkSession)
    columns = list(columns or numeric_columns(train, [label, *key]))
    shared = _Preparations(train, test, label, key, columns, configs, seed)
    rows = []
    for number, config in enumerate(configs, 1):
        params = {**{k: str(v) for k, v in config.items()}, "random_state": str(seed)}
        tags = {"experiment_number": str(number), "total_experiments": str(len(configs))}
        scores: dict[str, float] = {}
        try:
            options = dict(config)
            kind, size = options.pop("model_type"), options.pop("valid_size", VALID_SIZE)
            use_pca, k = options.pop("use_pca", False), options.pop("k", 50)
            if kind in BOOSTED:
                options["validation_col"] = shared.marks[size]
            stage = model_stage(kind, seed=seed, **options)
            ready = shared.get(use_pca, k)
            tags["preparation"] = str(ready.number)
            cells = shared.cells(ready, stage)
            if cells is None:
                fitted = fit_spread(stage, ready.train, [FEATURES, LABEL_CODE, *shared.marks.values()])
            else:
                fitted = stage.fit_cells(train.sparkSession, cells[0])
            model = PipelineModel([*ready.model.stages, fitted])
            if pca_stage(model) is not None:
                total = explained_variance(model, train.sparkSession).agg(F.max("cumulative")).first()[0]
                params["pca_explained_variance"] = str(total)
            for i, (part, rows_of) in enumerate((("train", ready.train), ("test", ready.test))):
                pairs = pair_counts(fitted.transform(rows_of), LABEL_CODE, "prediction") if cells is None else _pairs_on_cells(fitted, cells[i])
                found = metrics(pairs).first().asDict()
                scores |= {f"{part}_{k}": float(v) for k, v in found.items() if k != "n" and v is not None}
                params[f"n_{part}"] = str(found["n"] or 0)
            tags["status"] = "completed"
            if on_model is not None:
                on_model(number, config, model)
        except Exception as error:  # a bad configuration must not end the grid
            tags["status"] = "failed"
            tags["error"] = "".join(traceback.format_exception_only(error)).strip()
        rows.append((f"run{number:03d}", f"{config.get('model_type')}_{number}", params, scores, tags))
    schema = (
        "run_id string, run_name string, params map<string,string>, "
        "metrics map<string,double>, tags map<string,string>"
    )
    return train.sparkSession.createDataFrame(rows, schema)
