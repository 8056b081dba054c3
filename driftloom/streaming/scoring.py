"""Continuous scoring of arriving feature rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..functions.columns import col
from ..operators.score import score, validate_features


def read_stream(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    fmt: str = "parquet",
    files_per_batch: int = 1000,
) -> DataFrame:
    """New files below a folder as a stream, so many per micro-batch."""
    reader = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch)
    if fmt == "csv":
        reader = reader.option("header", True)
    return reader.format(fmt).load(path)


def score_stream(
    model: PipelineModel,
    stream: DataFrame,
    out: str,
    checkpoint: str,
    keep: Sequence[str] = (),
    target: str | None = None,
    proba: bool = True,
    model_name: str | None = "random_forest",
    available_now: bool = True,
    interval: str = "1 minute",
    fmt: str = "parquet",
) -> StreamingQuery:
    """Score a stream into files, exactly once, with a checkpoint to resume from.

    Scoring is stateless, so the stream needs no watermark and no shuffle.
    """
    scored = score(model, stream, keep, target, proba=proba, model_name=model_name)
    writer = (
        scored.writeStream.format(fmt)
        .outputMode("append")
        .option("path", out)
        .option("checkpointLocation", checkpoint)
    )
    trigger = {"availableNow": True} if available_now else {"processingTime": interval}
    return writer.trigger(**trigger).start()


def score_batch_checked(
    model: PipelineModel,
    batch: DataFrame,
    batch_id: int,
    out: str,
    quarantine: str,
    features: str,
    names: Sequence[str],
    keep: Sequence[str] = (),
    target: str | None = None,
    proba: bool = False,
    model_name: str | None = "random_forest",
) -> None:
    """Score the fit vectors of a micro-batch into ``out`` and write the others, with their ``problem``, to ``quarantine``.

    Each sink has a folder per batch, which a repeated batch replaces: after a
    restart no row is there twice. The batch is read once for both sinks.
    """
    batch.persist()
    try:
        good, bad = validate_features(batch, features, len(names), "quarantine")
        # kept columns travel in a struct, as some may be named like inputs of the model
        kept = [F.struct(*[col(c) for c in keep]).alias("__kept")] if keep else []
        truth = [col(target)] if target in good.columns and target not in names else []
        columns = good.select(*kept, *truth, *[col(features)[i].alias(n) for i, n in enumerate(names)])
        scored = score(model, columns, ["__kept"] if keep else [], target, proba=proba, model_name=model_name)
        scored = scored.select("__kept.*", *[c for c in scored.columns if c != "__kept"]) if keep else scored
        scored.write.mode("overwrite").parquet(f"{out}/batch_id={batch_id}")
        bad.write.mode("overwrite").parquet(f"{quarantine}/batch_id={batch_id}")
    finally:
        batch.unpersist()


def score_stream_checked(
    model: PipelineModel,
    stream: DataFrame,
    out: str,
    quarantine: str,
    checkpoint: str,
    features: str,
    names: Sequence[str],
    keep: Sequence[str] = (),
    target: str | None = None,
    proba: bool = False,
    model_name: str | None = "random_forest",
    available_now: bool = True,
    interval: str = "1 minute",
) -> StreamingQuery:
    """Score arriving feature arrays; those that are empty or of the wrong length go to a table of their own.

    ``names`` are the input columns of the model, in the order of the array. Read either
    result as a Parquet folder; ``batch_id`` tells the micro-batch of a row.
    """

    def both(batch: DataFrame, batch_id: int) -> None:
        score_batch_checked(model, batch, batch_id, out, quarantine, features, names, keep, target, proba, model_name)

    trigger = {"availableNow": True} if available_now else {"processingTime": interval}
    return stream.writeStream.foreachBatch(both).option("checkpointLocation", checkpoint).trigger(**trigger).start()
