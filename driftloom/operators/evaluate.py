"""Evaluation of predictions. One scan yields the pair counts; all metrics
derive from those k x k rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import col, local_frame, require_columns

TOTALS = ("accuracy", "macro avg", "weighted avg")


def pair_counts(df: DataFrame, truth: str, pred: str, by: Sequence[str] = ()) -> DataFrame:
    """(true_label, pred_label, n) of the pairs that occur. A missing label is an error.

    With ``by`` columns, such as a run id, many evaluations share one scan.
    """
    require_columns(df, [truth, pred, *by])

    def known(name: str) -> Column:
        c = col(name)
        return F.when(c.isNull(), F.raise_error(F.lit(f"missing value in {name}"))).otherwise(c)

    return df.groupBy(
        *[col(b) for b in by], known(truth).alias("true_label"), known(pred).alias("pred_label")
    ).agg(F.count(F.lit(1)).alias("n"))


def confusion(df: DataFrame, truth: str, pred: str, labels: Sequence | None = None) -> DataFrame:
    """Confusion matrix in long form (true_label, pred_label, n), zeros present.

    The labels are those of truth and prediction together, or the given ones.
    """
    return fill_matrix(pair_counts(df, truth, pred), labels)


def fill_matrix(counts: DataFrame, labels: Sequence | None = None) -> DataFrame:
    if labels is not None:
        listed = counts.sparkSession.range(1).select(F.array(*[F.lit(v) for v in labels]).alias("labels"))
    else:
        # One entry per class: pairs are already reduced to distinct labels. The
        # condition, like the null-safe join below, changes no row; it leaves
        # both branches the same aggregate, so they share one scan and shuffle.
        listed = (
            counts.where(F.col("n") > 0)
            .select(F.explode(F.array("true_label", "pred_label")).alias("label"))
            .distinct()
            .agg(F.collect_list("label").alias("labels"))
        )
    # the classes x classes grid is the operator's own result
    grid = listed.select(F.explode("labels").alias("true_label"), "labels").select(
        "true_label", F.explode("labels").alias("pred_label")
    )
    found = counts.select(F.col("true_label").alias("__t"), F.col("pred_label").alias("__p"), "n")
    same = F.col("true_label").eqNullSafe(F.col("__t")) & F.col("pred_label").eqNullSafe(F.col("__p"))
    return grid.join(found, same, "left").select(
        "true_label", "pred_label", F.coalesce("n", F.lit(0)).cast("long").alias("n")
    )


def name_classes(matrix: DataFrame, names: Sequence[str] | None = None) -> DataFrame:
    """Replace class codes by names, or by ``Class_<code>`` without names."""

    def named(c: str) -> Column:
        if names is None:
            return F.concat(F.lit("Class_"), col(c).cast("string"))
        return F.element_at(F.array(*[F.lit(v) for v in names]), col(c).cast("int") + 1)

    return matrix.select(
        named("true_label").alias("true_label"), named("pred_label").alias("pred_label"), "n"
    )


def wide_matrix(matrix: DataFrame, labels: Sequence) -> DataFrame:
    """One row per true label, one column per predicted label."""
    return matrix.groupBy("true_label").pivot("pred_label", list(labels)).agg(F.sum("n"))


def normalize_matrix(matrix: DataFrame) -> DataFrame:
    """Add ``share`` of the row sum; null in a row without any case."""
    total = F.sum("n").over(Window.partitionBy("true_label"))
    return matrix.withColumn("share", F.when(total > 0, F.col("n") / total))


def class_metrics(counts: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """(label, tp, predicted, support, precision, recall, f1), 0 for 0/0."""
    hit = F.col("true_label") == F.col("pred_label")
    zero = F.lit(0).cast("long")
    parts = F.array(
        F.struct(
            F.col("true_label").alias("label"),
            F.col("n").alias("support"),
            zero.alias("predicted"),
            F.when(hit, F.col("n")).otherwise(zero).alias("tp"),
        ),
        F.struct(
            F.col("pred_label").alias("label"),
            zero.alias("support"),
            F.col("n").alias("predicted"),
            zero.alias("tp"),
        ),
    )
    sums = (
        counts.select(*[col(b) for b in by], F.inline(parts))
        .groupBy(*[col(b) for b in by], "label")
        .agg(F.sum("tp").alias("tp"), F.sum("predicted").alias("predicted"), F.sum("support").alias("support"))
    )

    def ratio(a: Column, b: Column) -> Column:
        return F.when(b > 0, a / b).otherwise(F.lit(0.0))

    return sums.select(
        *[col(b) for b in by],
        "label",
        "tp",
        "predicted",
        "support",
        ratio(F.col("tp"), F.col("predicted")).alias("precision"),
        ratio(F.col("tp"), F.col("support")).alias("recall"),
        ratio(2 * F.col("tp"), F.col("predicted") + F.col("support")).alias("f1"),
    )


_AVERAGED = ("precision", "recall", "f1")


def _averages() -> list[Column]:
    out = [F.sum("support").alias("n"), F.try_divide(F.sum("tp"), F.sum("support")).alias("accuracy")]
    for m in _AVERAGED:
        out.append(F.avg(m).alias(f"{m}_macro"))
        out.append(F.try_divide(F.sum(F.col(m) * F.col("support")), F.sum("support")).alias(f"{m}_weighted"))
    return out


def metrics(counts: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """One row (one per ``by`` group): n, accuracy, macro and weighted precision/recall/f1, micro f1.

    With one label per row, micro f1 equals accuracy.
    """
    grouped = class_metrics(counts, by).groupBy(*[col(b) for b in by])
    return grouped.agg(*_averages()).withColumn("f1_micro", F.col("accuracy"))


def report(counts: DataFrame) -> DataFrame:
    """Classification report: a row per class, then accuracy, macro avg and
    weighted avg. The accuracy row repeats the accuracy in every column."""
    # both branches share the exchange of the class sums, so predictions are scanned once
    classes = class_metrics(counts)
    total, acc = F.col("n").cast("double"), F.col("accuracy")
    rows = [(TOTALS[0], [acc, acc, acc, acc])]
    for name, kind in ((TOTALS[1], "macro"), (TOTALS[2], "weighted")):
        rows.append((name, [*[F.col(f"{m}_{kind}") for m in _AVERAGED], total]))
    names = (*_AVERAGED, "support")
    summary = F.array(
        *[F.struct(F.lit(name).alias("label"), *[v.alias(n) for n, v in zip(names, values)]) for name, values in rows]
    )
    per_class = classes.select(F.col("label").cast("string").alias("label"), *_AVERAGED, F.col("support").cast("double").alias("support"))
    return per_class.unionAll(classes.agg(*_averages()).select(F.inline(summary)))


def f1_per_class(counts: DataFrame) -> DataFrame:
    """One-vs-rest f1 per class: (label, f1)."""
    return class_metrics(counts).select(F.col("label").cast("string").alias("label"), "f1")


def metrics_flat(counts: DataFrame, prefix: str = "test") -> DataFrame:
    """All metrics as rows (metric, value), named ``<prefix>_<metric>[_<class>]``."""
    classes = class_metrics(counts)
    overall = [
        "accuracy",
        *[f"{m}_macro" for m in _AVERAGED],
        *[f"{m}_weighted" for m in _AVERAGED],
    ]
    head = F.array(
        *[F.struct(F.lit(f"{prefix}_{m}").alias("metric"), F.col(m).alias("value")) for m in overall]
    )
    by_class = F.array(
        *[
            F.struct(F.concat(F.lit(f"{prefix}_{m}_"), F.col("label").cast("string")).alias("metric"), F.col(m).alias("value"))
            for m in _AVERAGED
        ]
    )
    return classes.agg(*_averages()).select(F.inline(head)).unionAll(classes.select(F.inline(by_class)))


def prediction_summary(df: DataFrame) -> DataFrame:
    """Without labels only the number of predictions can be reported."""
    return df.agg(
        F.count(F.lit(1)).alias("n_samples"), F.lit(True).alias("predictions_generated")
    )


def length_check(truth: DataFrame, pred: DataFrame, key: Sequence[str]) -> DataFrame:
    """Row counts of both sides, and the rows by which either side exceeds the other.

    Rows are counted per key, so a repeated key is neither lost nor
    multiplied: a key three times in the truth and once in the prediction
    makes two rows of ``only_truth``. Null keys count as one key.
    """
    key = list(key)
    sides = truth.select(*[col(k) for k in key], F.lit(1).alias("__t"), F.lit(0).alias("__p")).unionAll(
        pred.select(*[col(k) for k in key], F.lit(0).alias("__t"), F.lit(1).alias("__p"))
    )
    per_key = sides.groupBy(*[col(k) for k in key]).agg(F.sum("__t").alias("t"), F.sum("__p").alias("p"))
    zero = F.lit(0).cast("long")

    def total(value: Column) -> Column:
        return F.coalesce(F.sum(value), zero)

    return per_key.agg(
        total(F.col("t")).alias("n_truth"),
        total(F.col("p")).alias("n_pred"),
        total(F.greatest(F.col("t") - F.col("p"), zero)).alias("only_truth"),
        total(F.greatest(F.col("p") - F.col("t"), zero)).alias("only_pred"),
        F.coalesce(F.max(F.greatest("t", "p")), zero).alias("__most"),
    ).select(
        "n_truth", "n_pred", "only_truth", "only_pred",
        ((F.col("only_truth") == 0) & (F.col("only_pred") == 0)).alias("same_rows"),
        (F.col("__most") <= 1).alias("unique_keys"),
    )


def pair(truth: DataFrame, pred: DataFrame, key: Sequence[str]) -> DataFrame:
    """Join truth and prediction on the key; unmatched rows and repeated keys are an error."""
    check = length_check(truth, pred, key).first()
    if not check["same_rows"]:
        raise ValueError(
            f"truth and prediction have different lengths or keys: "
            f"{check['n_truth']} vs {check['n_pred']}"
        )
    if not check["unique_keys"]:
        raise ValueError(f"the key {list(key)} is repeated, rows cannot be paired")
    return truth.join(pred, list(key))


def degradation(metrics_row: DataFrame, reference_f1: float) -> DataFrame:
    """Macro f1 against a reference value: difference, flag, percent change."""
    diff = F.col("f1_macro") - F.lit(float(reference_f1))
    pct = F.lit(0.0) if reference_f1 <= 0 else diff / F.lit(float(reference_f1)) * 100
    return metrics_row.select(
        "f1_macro",
        diff.alias("f1_difference"),
        (diff < 0).alias("f1_degradation"),
        pct.alias("f1_degradation_pct"),
    )


ACTION_ALERT = "review the shifted features, then retrain on recent data"
ACTION_OK = "continue monitoring"


def performance_alert(scores: DataFrame, base: str, current: str, threshold_pct: float = 5.0) -> DataFrame:
    """Alert where a score fell by more than ``threshold_pct`` percent of its base."""
    drop = col(base) - col(current)
    pct = F.when(col(base) != 0, drop / col(base) * 100)
    alert = F.coalesce((drop > 0) & (pct > F.lit(float(threshold_pct))), F.lit(False))
    return scores.select(
        "*",
        drop.alias("performance_drop"),
        pct.alias("relative_drop_pct"),
        alert.alias("alert"),
        F.when(alert, ACTION_ALERT).otherwise(ACTION_OK).alias("action"),
    )


def against_baseline(
    scores: DataFrame, is_base: Column, metric: str = "f1_weighted", threshold_pct: float = 5.0
) -> DataFrame:
    """Rate every run of a score table, one row per run, against its baseline run.

    The baseline is read off the same rows, so the scored data is passed once.
    """
    whole = Window.partitionBy()  # one row per run
    marked = scores.withColumn("__base", is_base)
    base = F.max(F.when(F.col("__base"), col(metric))).over(whole)
    rated = marked.withColumn("base_f1", base).where(~F.col("__base")).drop("__base")
    return performance_alert(rated.withColumnRenamed(metric, "drift_f1"), "base_f1", "drift_f1", threshold_pct)


def alert_summary(runs: DataFrame) -> DataFrame:
    """Number of alerts and mean, worst and best relative drop over many runs."""
    return runs.agg(
        F.count(F.lit(1)).alias("total_runs"),
        F.count_if("alert").alias("alerts"),
        F.avg("relative_drop_pct").alias("mean_drop_pct"),
        F.max("relative_drop_pct").alias("max_drop_pct"),
        F.min("relative_drop_pct").alias("min_drop_pct"),
    )


def compare_metrics(current: DataFrame, reference: DataFrame, tol: float = 1e-6) -> DataFrame:
    """Compare (metric, value) rows: difference and verdict per current metric.

    ``status`` is ``match``, ``mismatch`` or ``missing``.
    """
    ref = reference.select("metric", F.col("value").alias("reference"))
    diff = F.abs(F.col("value") - F.col("reference"))
    joined = current.join(ref, "metric", "left")
    return joined.select(
        "metric",
        F.col("value").alias("current"),
        "reference",
        diff.alias("difference"),
        F.when(F.col("reference").isNull(), "missing")
        .when(diff > F.lit(tol), "mismatch")
        .otherwise("match")
        .alias("status"),
    )


def comparison_verdict(compared: DataFrame) -> DataFrame:
    """``matches`` ignores metrics the reference lacks, ``all_match`` does not."""
    bad = F.count_if(F.col("status") == "mismatch")
    return compared.agg(
        (bad == 0).alias("matches"),
        (F.count_if(F.col("status") != "match") == 0).alias("all_match"),
    )


def compare_predictions(
    current: DataFrame, reference: DataFrame, key: Sequence[str], pred: str, n: int = 10
) -> DataFrame:
    """The first n predictions of two runs side by side, in key order."""
    key = list(key)

    def first(df: DataFrame, name: str) -> DataFrame:
        return df.orderBy(*[col(k) for k in key]).limit(n).select(*key, col(pred).alias(name))

    both = first(current, "current_pred").join(first(reference, "reference_pred"), key, "full_outer")
    return both.withColumn("same", F.col("current_pred").eqNullSafe(F.col("reference_pred")))


def matrix_from_rows(spark, rows: Sequence[tuple], label_type: str = "string") -> DataFrame:
    """A confusion matrix given as (true, pred, n) tuples."""
    return local_frame(spark, rows, f"true_label {label_type}, pred_label {label_type}, n long")
