"""Experiment runs kept as an ordinary table, and operators over it."""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import col, local_frame
from ..sources.commits import Commits

RUN_SCHEMA = T.StructType(
    [
        T.StructField("run_id", T.StringType(), False),
        T.StructField("run_name", T.StringType()),
        T.StructField("experiment", T.StringType()),
        T.StructField("created_at", T.TimestampType()),
        T.StructField("params", T.MapType(T.StringType(), T.StringType())),
        T.StructField("metrics", T.MapType(T.StringType(), T.DoubleType())),
        T.StructField("tags", T.MapType(T.StringType(), T.StringType())),
    ]
)


def clean_params(params):
    """Drop params without a value; all values as text."""
    as_text = F.transform_values(params, lambda _, v: v.cast("string"))
    return F.map_filter(as_text, lambda _, v: v.isNotNull())


def clean_metrics(metrics):
    """Values as double; NaN, infinities and non-numbers are dropped."""
    as_number = F.transform_values(metrics, lambda _, v: v.try_cast("double"))
    return F.map_filter(
        as_number,
        lambda _, v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(float("inf"))),
    )


def append_run(
    spark: SparkSession,
    path: str,
    name: str | None = None,
    experiment: str = "default",
    params: Mapping | None = None,
    metrics: Mapping | None = None,
    tags: Mapping | None = None,
    run_id: str | None = None,
) -> str:
    """Append one finished run and return its id."""
    now = datetime.now(timezone.utc)
    run_id = run_id or uuid.uuid4().hex

    def text(values: Mapping | None) -> dict:
        return {str(k): None if v is None else str(v) for k, v in (values or {}).items()}

    raw = T.StructType(
        [
            *RUN_SCHEMA.fields[:5],
            T.StructField("metrics", T.MapType(T.StringType(), T.StringType())),
            RUN_SCHEMA["tags"],
        ]
    )
    row = (
        run_id,
        name or f"run_{now:%Y%m%d_%H%M%S}",
        experiment,
        now,
        text(params),
        text(metrics),
        {**text(tags), "created_at": now.isoformat()},
    )
    df = spark.createDataFrame([row], raw)
    append_runs(df, path)
    return run_id


def append_runs(runs: DataFrame, path: str) -> int:
    """Append many run rows in one commit; params and metrics are cleaned on the way.

    A run id that is already there is not added again, so a repeated append changes nothing. Returns how
    many runs were added. Batches are merged as they become many.
    """
    ready = runs.select(
        "run_id",
        "run_name",
        "experiment",
        F.col("created_at").cast("timestamp").alias("created_at"),
        clean_params("params").alias("params"),
        clean_metrics("metrics").alias("metrics"),
        "tags",
    )
    nullable = T.StructType([T.StructField(f.name, f.dataType) for f in RUN_SCHEMA])
    return Commits(runs.sparkSession, path).append(ready.to(nullable), "run_id")


def log_metrics(run_id: str | None, metrics: Mapping, step: int | None = None) -> list[tuple]:
    """(run_id, metric, value, step) entries of an open run; needs a run."""
    if run_id is None:
        raise RuntimeError("No active run, start one first")
    out = []
    for k, v in metrics.items():
        try:
            number = float(v)
        except (TypeError, ValueError):
            continue
        if number == number and abs(number) != float("inf"):
            out.append((run_id, k, number, step))
    return out


def read_runs(spark: SparkSession, path: str) -> DataFrame:
    """All committed runs; a folder without commits is read as plain Parquet files."""
    commits = Commits(spark, path)
    number, folders = commits.live()
    if not number:
        return spark.read.schema(RUN_SCHEMA).parquet(path)
    return commits.read(RUN_SCHEMA, folders)


def _order(entry: str):
    words = entry.split()
    descending = len(words) > 1 and words[-1].upper() == "DESC"
    name = words[0]
    return F.expr(name).desc_nulls_last() if descending else F.expr(name).asc_nulls_last()


def search_runs(
    runs: DataFrame,
    where: str | None = None,
    order_by: Sequence[str] = (),
    n: int = 100,
    experiment: str | None = None,
) -> DataFrame:
    """Filter by a SQL condition such as ``metrics.accuracy > 0.8``."""
    if experiment is not None:
        runs = runs.where(F.col("experiment") == experiment)
    if where:
        runs = runs.where(where)
    orders = [_order(o) for o in order_by] or [F.col("created_at").desc_nulls_last()]
    return runs.orderBy(*orders, "run_id").limit(n)


def best_run(runs: DataFrame, metric: str = "test_accuracy", ascending: bool = False) -> DataFrame:
    """(run_id, metric_value, metric_name) of the best run; empty without runs."""
    value = F.col("metrics")[metric]
    rated = runs.select("run_id", value.alias("metric_value"), F.lit(metric).alias("metric_name"))
    order = F.col("metric_value").asc_nulls_last() if ascending else F.col("metric_value").desc_nulls_last()
    return rated.orderBy(order, "run_id").limit(1)


def compare_runs(runs: DataFrame, ids: Sequence[str]) -> DataFrame:
    """Wide table of the given runs: ``metrics.<m>`` and ``params.<p>`` columns."""
    chosen = runs.where(F.col("run_id").isin(list(ids)))

    def names(map_column: str) -> list[str]:
        # the keys of the chosen runs name the columns
        keys = chosen.select(F.explode(F.map_keys(map_column))).distinct().collect()
        return sorted(r[0] for r in keys)

    metric_names, param_names = names("metrics"), names("params")
    return chosen.select(
        "run_id",
        *[F.col("metrics")[m].alias(f"metrics.{m}") for m in metric_names],
        *[F.col("params")[p].alias(f"params.{p}") for p in param_names],
    )


def top_runs(runs: DataFrame, metric: str = "test_accuracy", n: int = 5) -> DataFrame:
    return runs.orderBy(F.col("metrics")[metric].desc_nulls_last(), "run_id").limit(n)


def best_per_group(runs: DataFrame, group: str = "model_type", metric: str = "test_accuracy") -> DataFrame:
    """The best run per value of a param; ties go to the smallest run id.

    A combinable aggregate, so one large group does not meet in one task.
    """
    value = F.col("metrics")[metric]
    rated = runs.where(value.isNotNull()).select(
        F.col("params")[group].alias(group), F.struct((-value).alias("rank"), "run_id", value.alias("value")).alias("best")
    )
    return rated.groupBy(col(group)).agg(F.min("best").alias("best")).select(
        col(group), F.col("best.run_id").alias("run_id"), F.col("best.value").alias("metric_value")
    )


def count_runs(runs: DataFrame, group: str = "model_type") -> DataFrame:
    """Completed and total runs per value of a param; failed ones are tagged."""
    failed = F.coalesce(F.col("tags")["status"] == "failed", F.lit(False))
    return runs.groupBy(F.col("params")[group].alias(group)).agg(
        F.count_if(~failed).alias("completed"), F.count(F.lit(1)).alias("total")
    )


REFERENCE_METRICS = ("accuracy", "f1_macro", "f1_weighted", "precision_macro", "recall_macro")


def reference_metrics(runs: DataFrame, run_id: str | None = None, seed: int = 42) -> DataFrame:
    """Test metrics of a run (0 where absent), its seed and model type."""
    if run_id is not None:
        runs = runs.where(F.col("run_id") == run_id)
    return runs.select(
        "run_id",
        *[
            F.coalesce(F.col("metrics")[f"test_{m}"], F.lit(0.0)).alias(m)
            for m in REFERENCE_METRICS
        ],
        F.coalesce(F.col("params")["random_state"].try_cast("int"), F.lit(seed)).alias("seed"),
        F.coalesce(F.col("params")["model_type"], F.lit("unknown")).alias("model_type"),
    )


def fingerprint(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """(n_rows, n_columns, checksum): equal for equal content in any row order.

    Each value is written with its length in front, a null as a dash, so no two
    different rows share a text. The checksum adds the leading 64 bits of each row's md5; rows are
    combined map-side and partitioning does not matter.
    """
    columns = list(columns or df.columns)
    parts = []
    for c in columns:
        text = col(c).cast("string")
        parts.append(F.coalesce(F.concat(F.length(text).cast("string"), F.lit(":"), text), F.lit("-")))
    number = F.conv(F.substring(F.md5(F.concat(*parts)), 1, 16), 16, 10)
    return df.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.lit(len(columns)).cast("long").alias("n_columns"),
        F.coalesce(F.sum(number.cast("decimal(38,0)")), F.lit(0)).cast("string").alias("checksum"),
    )


METRIC_SCHEMA = "run_id string, metric string, value double, step long"


def write_metric_history(spark: SparkSession, path: str, entries: Sequence[tuple]) -> None:
    """Append (run_id, metric, value, step) entries, as ``log_metrics`` makes them, to the history table."""
    local_frame(spark, [tuple(e) for e in entries], METRIC_SCHEMA).write.mode("append").parquet(path)


def metric_history(spark: SparkSession, path: str, run_id: str | None = None) -> DataFrame:
    """All logged values, of one run or of all: (run_id, metric, value, step)."""
    history = spark.read.schema(METRIC_SCHEMA).parquet(path)
    return history if run_id is None else history.where(F.col("run_id") == run_id)


def latest_metrics(history: DataFrame) -> DataFrame:
    """(run_id, metric, value, step) of the last step of each metric; entries without a step come before all others."""
    order = F.struct(F.coalesce("step", F.lit(-(1 << 62))).alias("at"), F.col("value"), F.col("step"))
    last = history.groupBy("run_id", "metric").agg(F.max(order).alias("last"))
    return last.select("run_id", "metric", "last.value", "last.step")
