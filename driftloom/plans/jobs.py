"""Batch jobs: read, run operators, write. Each is a plain function."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.columns import col, local_frame, numeric_columns, require_columns, union_all
from ..functions.hashing import scalar_uniform
from ..operators import clean, drift as dr, evaluate as ev, perturb, profile, runs, score as sc, train as tr
from ..operators.features import build_matrices
from ..operators.split import SEED, mark_test, stratified_split
from ..session import ensure_checkpoint_dir, scratch_path
from ..sources.tables import dataset_info, read_table, write_report, write_table


def clean_dataset(
    spark: SparkSession,
    source: str,
    target: str,
    iqr_factor: float = 1.5,
    columns: Sequence[str] | None = None,
    exclude: Sequence[str] = (),
    fmt: str | None = None,
) -> DataFrame:
    """Read, report missing values, drop outliers, write.

    Returns one row: rows and columns read, total missing percent, rows kept.
    """
    df = read_table(spark, source)
    missing = profile.missing_total(df).first()[0]
    log = clean.iqr_bounds(df, columns, iqr_factor, exclude)
    write_table(clean.apply_bounds(df, log), target, fmt)
    rows_in = log[0][2] if log else df.count()
    rows_out = log[-1][3] if log else rows_in
    return spark.range(1).select(
        F.lit(rows_in).cast("long").alias("rows_in"),
        F.lit(len(df.columns)).cast("long").alias("n_columns"),
        F.lit(missing).cast("double").alias("total_missing_pct"),
        F.lit(rows_out).cast("long").alias("rows_out"),
    )


def build_features(
    spark: SparkSession,
    source: str,
    target_dir: str,
    label: str,
    key: Sequence[str],
    columns: Sequence[str] | None = None,
    name: str = "features",
    test_size: float = 0.2,
    use_pca: bool = True,
    k: int = 50,
    seed: int = SEED,
    fmt: str = "parquet",
) -> dict[str, str]:
    """Split, encode, fit and write: ``<name>``, ``test_<name>`` and the fitted stages."""
    df = read_table(spark, source, required=[label, *key])
    # every fit and write below passes over the parts, so the ranking is done once
    marked_path = scratch_path(spark, "marked")
    mark_test(df, label, key, test_size, seed).write.parquet(marked_path)
    marked = spark.read.parquet(marked_path)
    train, test = marked.where("not is_test").drop("is_test"), marked.where("is_test").drop("is_test")
    train_out, test_out, indexer, model = build_matrices(train, test, label, key, columns, use_pca, k)
    paths = {
        "train": f"{target_dir}/{name}",
        "test": f"{target_dir}/test_{name}",
        "transformer": f"{target_dir}/transformer",
    }
    write_table(train_out, paths["train"], fmt)
    write_table(test_out, paths["test"], fmt)
    PipelineModel([indexer, model]).write().overwrite().save(paths["transformer"])
    return paths


def train_model(
    spark: SparkSession,
    source: str,
    model_path: str,
    label: str,
    key: Sequence[str],
    model_type: str = "random_forest",
    columns: Sequence[str] | None = None,
    **params,
) -> PipelineModel:
    """Fit and save a classifier: ``random_forest``, ``gbt`` or ``gbt_tuned``."""
    if model_type not in (*tr.MODEL_TYPES, "gbt_tuned"):
        raise ValueError(f"Unknown model_type: {model_type}")
    ensure_checkpoint_dir(spark)
    df = read_table(spark, source, required=[label, *key])
    columns = list(columns or numeric_columns(df, [label, *key]))
    if model_type == "gbt":
        model = tr.fit_with_validation(df, label, key, columns, **params)
    elif model_type == "gbt_tuned":
        prep = tr.preprocessing(columns, use_pca=False).fit(df)
        indexer = tr.label_indexer(label, tr.LABEL_CODE).fit(df)
        best, _, _ = tr.tune(prep.transform(df), label, key, **params)
        model = PipelineModel([indexer, *prep.stages, best])
    else:
        estimator = tr.full_pipeline(columns, label, model_type, **params)
        model = tr.fit_spread(estimator, df, [*columns, label])
    model.write().overwrite().save(model_path)
    return model


def predict_table(
    spark: SparkSession,
    source: str,
    model_path: str,
    out: str,
    keep: Sequence[str] = (),
    target: str | None = None,
    proba: bool = False,
    model_name: str | None = None,
    fmt: str | None = None,
) -> None:
    """Score a table with a saved model and write the predictions."""
    df = read_table(spark, source)
    model = PipelineModel.load(model_path)
    write_table(sc.score(model, df, keep, target, proba=proba, model_name=model_name), out, fmt)


def evaluate_predictions(
    scored: DataFrame, reference_f1: float | None = None, prefix: str = "test"
) -> dict[str, DataFrame]:
    """All evaluation tables of a scored frame; without truth only the count."""
    if "true_label" not in scored.columns:
        return {"summary": ev.prediction_summary(scored)}
    pred = "prediction_label" if "prediction_label" in scored.columns else "prediction"
    counts = ev.pair_counts(scored, "true_label", pred)
    out = {
        "matrix": ev.fill_matrix(counts),
        "report": ev.report(counts),
        "metrics": ev.metrics(counts),
        "flat": ev.metrics_flat(counts, prefix),
        "f1_per_class": ev.f1_per_class(counts),
    }
    if reference_f1 is not None:
        out["degradation"] = ev.degradation(out["metrics"], reference_f1)
    return out


def drift_job(
    spark: SparkSession,
    reference: DataFrame,
    production: DataFrame,
    out_dir: str,
    runs_path: str,
    columns: Sequence[str] | None = None,
    method: str = "psi",
    threshold: float = dr.DEFAULT_THRESHOLD,
    experiment: str = "drift_monitoring",
    model=None,
) -> str:
    """Write detail, top features and summary, append a run; returns the run id."""
    detail = dr.drift(reference, production, columns, method, threshold, model=model)
    write_table(detail, f"{out_dir}/drift_features")
    # one row per feature from here on
    detail = read_table(spark, f"{out_dir}/drift_features")
    summary = dr.with_severity(dr.drift_summary(detail), method, "max_drift_score")
    write_report(dr.top_drift(detail), f"{out_dir}/top_features")
    write_report(summary, f"{out_dir}/summary", method=method, threshold=threshold)
    row = summary.first()
    scalars = [
        "max_drift_score",
        "mean_drift_score",
        "min_drift_score",
        "features_with_drift",
        "total_features",
        "drift_percentage",
    ]
    return runs.append_run(
        spark,
        runs_path,
        experiment=experiment,
        params={
            "detection_method": method,
            "threshold": threshold,
            "reference_samples": reference.count(),
            "reference_features": row["total_features"],
            "production_samples": production.count(),
            "production_features": row["total_features"],
        },
        metrics={
            **{s: row[s] for s in scalars},
            "drift_detected": 1.0 if row["drift_detected"] else 0.0,
        },
        tags={
            "drift_severity": row["severity"],
            "drift_status": "detected" if row["drift_detected"] else "no_drift",
        },
    )


def performance_runs(
    model: PipelineModel,
    df: DataFrame,
    label: str,
    key: Sequence[str],
    shift_column: str,
    missing_column: str,
    settings: Sequence[tuple[float, float]] | None = None,
    n_runs: int = 10,
    threshold_pct: float = 5.0,
    seed: int = SEED,
) -> DataFrame:
    """Weighted f1 on perturbed copies of a labelled table against the table itself.

    Each run shifts one column, blanks part of another and fills the blanks
    with the column mean. ``settings`` lists (shift factor, missing ratio);
    by default ``n_runs`` are drawn from [1.1, 1.3] and [0.05, 0.2]. Returns a
    row per run with drop, alert and action.
    """
    if settings is None:
        settings = [
            (1.1 + 0.2 * scalar_uniform(seed, f"{i}|shift"), 0.05 + 0.15 * scalar_uniform(seed, f"{i}|missing"))
            for i in range(1, n_runs + 1)
        ]

    def counted(rows: DataFrame, run: int) -> DataFrame:
        scored = sc.score(model, rows, target=label)
        pred = "prediction_label" if "prediction_label" in scored.columns else "prediction"
        return ev.pair_counts(scored, "true_label", pred).withColumn("run", F.lit(run))

    parts = [counted(df, 0)]
    for i, (factor, ratio) in enumerate(settings, 1):
        moved = perturb.shift(df, shift_column, factor)
        gaps = perturb.drop_values(moved, missing_column, ratio, key, f"{seed}|{i}")
        parts.append(counted(clean.impute_mean(gaps, [missing_column]), i))
    # classes x classes rows per run from here on
    scores = ev.metrics(union_all(parts), ["run"]).select("run", "f1_weighted")
    drawn = local_frame(
        df.sparkSession,
        [(i, float(f), float(r)) for i, (f, r) in enumerate(settings, 1)],
        "run int, shift_factor double, missing_ratio double",
    )
    rated = ev.against_baseline(scores, F.col("run") == 0, threshold_pct=threshold_pct)
    return rated.join(F.broadcast(drawn), "run")


def perturbed_set(
    df: DataFrame,
    out_dir: str,
    label: str,
    key: Sequence[str],
    n: int = 50,
    noise: float = 0.1,
    drift_factor: float = 0.0,
    seed: int = SEED,
    fmt: str = "csv",
) -> None:
    """Write features, labels and both together of a perturbed sample."""
    require_columns(df, [label, *key])
    write_table(perturb.perturbed_sample(df, label, key, n, noise, drift_factor, seed), f"{out_dir}/full", "parquet")
    full = read_table(df.sparkSession, f"{out_dir}/full", fmt="parquet")
    write_table(full.drop(label), f"{out_dir}/features", fmt)
    write_table(full.select(*[col(k) for k in key], col(label)), f"{out_dir}/labels", fmt)
    write_table(full, f"{out_dir}/production_data", fmt)


def track_training(
    spark: SparkSession,
    runs_path: str,
    model: PipelineModel,
    train: DataFrame,
    test: DataFrame,
    label: str,
    key: Sequence[str],
    params: Mapping,
    name: str,
    model_type: str,
    out_dir: str | None = None,
    tags: Mapping | None = None,
) -> str:
    """Record one training: params, sizes, train and test metrics; with
    ``out_dir`` also matrices, reports and the model. Returns the run id.

    A failure is recorded as a failed run with what was known, then raised.
    """
    known, metrics = dict(params), {}
    status = "failed"
    try:
        require_columns(test, [label])
        known |= dataset_info(train, test, label, exclude=key).first().asDict()
        for part, df in (("train", train), ("test", test)):
            tables = evaluate_predictions(sc.score(model, df, target=label), prefix=part)
            metrics |= {r["metric"]: r["value"] for r in tables["flat"].collect()}
            if out_dir is not None:
                write_table(tables["matrix"], f"{out_dir}/confusion_matrix_{part}")
                write_table(tables["report"], f"{out_dir}/classification_report_{part}")
        if out_dir is not None:
            model.write().overwrite().save(f"{out_dir}/model")
        status = "completed"
    finally:
        run_id = runs.append_run(
            spark,
            runs_path,
            name=name,
            params=known,
            metrics=metrics,
            tags={**(tags or {}), "model_type": model_type, "model_name": name, "status": status},
        )
    return run_id


def pipeline_job(
    spark: SparkSession,
    source: str,
    out_dir: str,
    label: str,
    key: Sequence[str],
    columns: Sequence[str] | None = None,
    model_type: str = "random_forest",
    iqr_factor: float = 1.5,
    test_size: float = 0.2,
    seed: int = SEED,
    runs_path: str | None = None,
    **params,
) -> DataFrame:
    """Clean, split, encode, fit, evaluate and save, from a raw table to a model on disk.

    Below ``out_dir``: ``clean``, ``model``, ``predictions`` (of the test rows), ``report``.
    Returns (metric, value) rows of the test part. With ``runs_path`` the run is recorded there.
    """
    clean_dataset(spark, source, f"{out_dir}/clean", iqr_factor, columns, exclude=[label, *key])
    cleaned = read_table(spark, f"{out_dir}/clean", required=[label, *key])
    columns = list(columns or numeric_columns(cleaned, [label, *key]))
    mark_test(cleaned, label, key, test_size, seed).write.parquet(f"{out_dir}/marked")
    marked = spark.read.parquet(f"{out_dir}/marked")
    train, test = marked.where("not is_test").drop("is_test"), marked.where("is_test").drop("is_test")
    if model_type == "gbt":
        model = tr.fit_with_validation(train, label, key, columns, seed=seed, **params)
    else:
        model = tr.fit_spread(tr.full_pipeline(columns, label, model_type, seed=seed, **params), train, [*columns, label])
    model.write().overwrite().save(f"{out_dir}/model")
    write_table(sc.score(model, test, key, label), f"{out_dir}/predictions", "parquet")
    tables = evaluate_predictions(read_table(spark, f"{out_dir}/predictions"), prefix="test")
    write_table(tables["report"], f"{out_dir}/report", "json")
    if runs_path is not None:
        track_training(spark, runs_path, model, train, test, label, key, {**params, "random_state": seed}, "pipeline", model_type)
    return tables["flat"]


def reproducibility_job(
    spark: SparkSession,
    source: str,
    label: str,
    key: Sequence[str],
    columns: Sequence[str],
    reference: Mapping[str, float],
    tolerance: float = 1e-6,
    seed: int = SEED,
    model_type: str = "random_forest",
    test_size: float = 0.2,
    **params,
) -> DataFrame:
    """Train once more with the seed of a recorded run and compare the test metrics with its own.

    ``reference``: metric names of the recorded run (``test_accuracy`` ...) with their values. Returns
    (metric, reference, again, difference, reproduced).
    """
    df = read_table(spark, source, required=[label, *key])
    train, test = stratified_split(df, label, key, test_size, seed)
    if model_type == "gbt":
        model = tr.fit_with_validation(train, label, key, columns, seed=seed, **params)
    else:
        model = tr.fit_spread(tr.full_pipeline(columns, label, model_type, seed=seed, **params), train, [*columns, label])
    again = evaluate_predictions(sc.score(model, test, target=label), prefix="test")["flat"]
    known = local_frame(spark, [(k, float(v)) for k, v in reference.items()], "metric string, reference double")
    both = known.join(F.broadcast(again.withColumnRenamed("value", "again")), "metric", "left")  # one row per metric
    difference = F.abs(F.col("again") - F.col("reference"))
    return both.select(
        "metric", "reference", "again", difference.alias("difference"), F.coalesce(difference <= tolerance, F.lit(False)).alias("reproduced")
    )
