"""Batch scoring; the same functions serve a streaming frame."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.ml import PipelineModel
from pyspark.ml.feature import StringIndexerModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import col, is_missing, require_columns


def model_labels(model) -> list[str] | None:
    """Class names held by the label stage of a fitted model, if any."""
    for stage in getattr(model, "stages", []):
        if isinstance(stage, StringIndexerModel):
            return list(stage.labels)
    return None


def without_labels(model: PipelineModel) -> PipelineModel:
    """The stages that score rows: all but the label indexer."""
    return PipelineModel([s for s in model.stages if not isinstance(s, StringIndexerModel)])


def pick_model(models: Mapping[str, PipelineModel], name: str) -> PipelineModel:
    if name not in models:
        raise ValueError(f"Model '{name}' not found")
    return models[name]


def argmax_class(scores: Column) -> Column:
    """Index of the largest entry; the first of equal ones."""
    return (F.array_position(scores, F.array_max(scores)) - 1).cast("int")


def threshold_class(score: Column) -> Column:
    """Class 1 for a score above one half, else 0."""
    return (score > F.lit(0.5)).cast("int")


def score(
    model: PipelineModel,
    df: DataFrame,
    keep: Sequence[str] = (),
    target: str | None = None,
    labels: Sequence[str] | None = None,
    proba: bool = False,
    model_name: str | None = None,
) -> DataFrame:
    """Prediction columns for every row of a batch or streaming frame.

    ``prediction`` and, with class names, ``prediction_label``; with a target
    column present ``true_label`` and ``correct``; with ``proba`` the map of
    class probabilities; ``model_name`` if given. All in one projection after
    the model stages.
    """
    labels = list(labels) if labels is not None else model_labels(model)
    scored = without_labels(model).transform(df)
    code = F.col("prediction").cast("int")
    out = [col(c) for c in keep] + [code.alias("prediction")]
    name = F.element_at(F.array(*[F.lit(v) for v in labels]), code + 1) if labels else None
    if name is not None:
        out.append(name.alias("prediction_label"))
    if target is not None and target in df.columns:
        truth = col(target)
        out.append(truth.alias("true_label"))
        guess = name if name is not None else code
        out.append((guess == truth).alias("correct"))
    if proba:
        p = vector_to_array(F.col("probability"))
        if labels:
            keys = F.array(*[F.lit(v) for v in labels])
        else:
            keys = F.transform(p, lambda _, i: F.concat(F.lit("class_"), i.cast("string")))
        out.append(F.map_from_arrays(keys, p).alias("probabilities"))
    if model_name is not None:
        out.append(F.lit(model_name).alias("model_name"))
    return scored.select(*out)


def accuracy(scored: DataFrame, correct: str = "correct") -> DataFrame:
    return scored.agg(
        F.count(F.lit(1)).alias("n"), F.avg(col(correct).cast("double")).alias("accuracy")
    )


def vector_problem(features: str, size: int) -> Column:
    """Why a feature array is unfit for scoring, or null."""
    c = col(features)
    return (
        F.when(c.isNull() | (F.size(c) == 0), "empty")
        .when(F.size(c) != size, F.concat(F.lit("expected "), F.lit(size), F.lit(" values, got "), F.size(c)))
    )


def validate_features(df: DataFrame, features: str, size: int = 50, mode: str = "raise"):
    """Check array length. ``raise`` fails the job at a bad row and returns the
    frame; ``quarantine`` returns (good, bad with column ``problem``)."""
    require_columns(df, [features])
    problem = vector_problem(features, size)
    if mode == "raise":
        # a filter, so that no later projection or count can do without the check
        return df.where(F.when(problem.isNotNull(), F.raise_error(problem).cast("boolean")).otherwise(F.lit(True)))
    if mode == "quarantine":
        marked = df.withColumn("problem", problem)
        return (
            marked.where(F.col("problem").isNull()).drop("problem"),
            marked.where(F.col("problem").isNotNull()),
        )
    raise ValueError("mode must be 'raise' or 'quarantine'")
