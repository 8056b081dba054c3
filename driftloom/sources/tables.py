"""Table sources and sinks: Parquet, CSV and JSON."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.columns import col, local_frame, require_columns

FORMATS = ("parquet", "csv", "json")


def _format_of(path: str, fmt: str | None) -> str:
    if fmt is None:
        ending = path.rstrip("/").rsplit(".", 1)[-1].lower()
        fmt = ending if ending in FORMATS else "parquet"
    if fmt not in FORMATS:
        raise ValueError(f"unknown format '{fmt}', use one of {FORMATS}")
    return fmt


def read_table(
    spark: SparkSession,
    path: str,
    schema=None,
    fmt: str | None = None,
    required: Sequence[str] = (),
) -> DataFrame:
    """Scan a table. CSV has a header; without a schema its types are inferred.

    Give a schema for large CSV input: inference reads the files once more.
    """
    fmt = _format_of(path, fmt)
    reader = spark.read
    if schema is not None:
        reader = reader.schema(schema)
    if fmt == "csv":
        reader = reader.option("header", True)
        if schema is None:
            reader = reader.option("inferSchema", True)
        df = reader.csv(path)
    elif fmt == "json":
        df = reader.json(path)
    else:
        df = reader.parquet(path)
    require_columns(df, required)
    return df


def write_table(df: DataFrame, path: str, fmt: str | None = None, mode: str = "overwrite") -> None:
    """Write a table in parallel, one file per task; labels are plain columns."""
    fmt = _format_of(path, fmt)
    writer = df.write.mode(mode)
    if fmt == "csv":
        writer.option("header", True).csv(path)
    elif fmt == "json":
        writer.json(path)
    else:
        writer.parquet(path)


def report_json(df: DataFrame, **extra) -> DataFrame:
    """One JSON text per row (column ``report``) of a summary or detail frame."""
    fields = [F.lit(v).alias(k) for k, v in extra.items()] + [col(c) for c in df.columns]
    return df.select(F.to_json(F.struct(*fields)).alias("report"))


def write_report(df: DataFrame, path: str, **extra) -> None:
    report_json(df, **extra).write.mode("overwrite").text(path)


def read_metrics(spark: SparkSession, path: str) -> DataFrame:
    """Reference metrics from JSON: ``{"metrics": {...}}`` or flat, as (metric, value)."""
    text = spark.read.text(path, wholetext=True)
    as_map = "map<string,double>"
    nested = F.from_json(F.get_json_object("value", "$.metrics"), as_map)
    flat = F.from_json("value", as_map)
    return text.select(F.explode(F.coalesce(nested, flat)).alias("metric", "value"))


def write_metrics(metrics: DataFrame, path: str) -> None:
    """Store (metric, value) rows as one ``{"metrics": {...}}`` object."""
    # a metric table has one row per metric name, so one row holds it
    packed = metrics.agg(
        F.map_from_entries(F.collect_list(F.struct("metric", "value"))).alias("metrics")
    )
    packed.select(F.to_json(F.struct("metrics"))).coalesce(1).write.mode("overwrite").text(path)


def dataset_info(train: DataFrame, test: DataFrame, label: str, exclude: Sequence[str] = ()) -> DataFrame:
    """n_train_samples, n_test_samples, n_features, n_classes in one row."""
    features = [c for c in train.columns if c != label and c not in set(exclude)]
    n_test = test.agg(F.count(F.lit(1)).alias("n")).first()["n"]
    # distinct labels first: one row per class reaches the final count
    per_class = train.groupBy(col(label).alias("__c")).agg(F.count(F.lit(1)).alias("__n"))
    return per_class.agg(
        F.coalesce(F.sum("__n"), F.lit(0)).alias("n_train_samples"),
        F.lit(n_test).cast("long").alias("n_test_samples"),
        F.lit(len(features)).cast("long").alias("n_features"),
        F.count("__c").alias("n_classes"),
    )


def shape(df: DataFrame, exclude: Sequence[str] = ()) -> DataFrame:
    """Row and column count."""
    n = len([c for c in df.columns if c not in set(exclude)])
    return df.agg(F.count(F.lit(1)).alias("n_rows"), F.lit(n).cast("long").alias("n_columns"))


def head_n(df: DataFrame, n: int, key: Sequence[str]) -> DataFrame:
    """The first n rows in key order (a table has no other order)."""
    return df.orderBy(*[col(k) for k in key]).limit(n)


def label_column(df: DataFrame, preferred: str = "Class") -> str:
    """The label column: ``preferred`` if present, else the only column."""
    if preferred in df.columns:
        return preferred
    if len(df.columns) == 1:
        return df.columns[0]
    raise ValueError(f"cannot tell the label column among {df.columns}")


__all__ = [
    "dataset_info",
    "head_n",
    "label_column",
    "local_frame",
    "read_metrics",
    "read_table",
    "report_json",
    "shape",
    "write_metrics",
    "write_report",
    "write_table",
]
