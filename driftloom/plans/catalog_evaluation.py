"""Queries: evaluation of predictions."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import evaluate as ev
from ..operators import score as sc
from ..session import scratch_path
from ..sources.tables import read_table, write_table
from .registry import LINE_KEY, query, rounded, table

GUESS = "CASE WHEN l_quantity < 20 THEN 'A' WHEN l_quantity < 35 THEN 'N' ELSE 'R' END"
EARLY = "l_shipdate < TIMESTAMP '1998-06-01'"
KEYS = ", ".join(LINE_KEY)


def predicted(spark, sf_dir, *extra):
    li = table(spark, sf_dir, "lineitem")
    return li.select(*LINE_KEY, *extra, F.col("l_returnflag").alias("truth"), F.expr(GUESS).alias("guess"))


def counts(spark, sf_dir):
    return ev.pair_counts(predicted(spark, sf_dir), "truth", "guess")


def metric_ctes(by: str = "", relation: str = "lineitem", guess: str = GUESS, where: str = "TRUE") -> str:
    """CTEs c (pair counts), m (per class), o (overall), optionally per group."""
    b = f"{by}, " if by else ""
    join = f"c.{by} = l.{by}" if by else "TRUE"
    part = f"GROUP BY {by}" if by else ""
    return f"""
    c AS (SELECT {b}l_returnflag AS t, {guess} AS p, count(*) AS n FROM {relation} WHERE {where} GROUP BY ALL),
    l AS (SELECT {b}t AS label FROM c UNION SELECT {b}p FROM c),
    k AS (SELECT {'l.' + b if by else ''}l.label, coalesce(sum(n) FILTER (t = label AND p = label), 0) AS tp,
                 coalesce(sum(n) FILTER (p = label), 0) AS predicted,
                 coalesce(sum(n) FILTER (t = label), 0) AS support
          FROM l JOIN c ON {join} GROUP BY ALL),
    m AS (SELECT *, CASE WHEN predicted = 0 THEN 0 ELSE tp / predicted END AS precision,
                 CASE WHEN support = 0 THEN 0 ELSE tp / support END AS recall,
                 CASE WHEN predicted + support = 0 THEN 0 ELSE 2 * tp / (predicted + support) END AS f1 FROM k),
    o AS (SELECT {b}sum(support) AS n, sum(tp) / sum(support) AS accuracy,
                 avg(precision) AS precision_macro, avg(recall) AS recall_macro, avg(f1) AS f1_macro,
                 sum(precision * support) / sum(support) AS precision_weighted,
                 sum(recall * support) / sum(support) AS recall_weighted,
                 sum(f1 * support) / sum(support) AS f1_weighted FROM m {part})
    """


BASE = "WITH " + metric_ctes()


@query(
    "confusion_matrix",
    sql=BASE
    + """ SELECT a.label AS true_label, b.label AS pred_label, CAST(coalesce(c.n, 0) AS BIGINT) AS n
       FROM l a CROSS JOIN l b LEFT JOIN c ON c.t = a.label AND c.p = b.label""",
)
def confusion_matrix(spark, sf_dir):
    return ev.confusion(predicted(spark, sf_dir), "truth", "guess")


@query(
    "confusion_normalized",
    sql=BASE
    + """ SELECT a.label AS true_label, b.label AS pred_label, CAST(coalesce(c.n, 0) AS BIGINT) AS n,
             round(coalesce(c.n, 0) / sum(coalesce(c.n, 0)) OVER (PARTITION BY a.label), 6) AS share
       FROM l a CROSS JOIN l b LEFT JOIN c ON c.t = a.label AND c.p = b.label""",
)
def confusion_normalized(spark, sf_dir):
    return rounded(ev.normalize_matrix(ev.confusion(predicted(spark, sf_dir), "truth", "guess")))


@query(
    "labelled_sink",
    sql=BASE
    + """ SELECT t AS true_label, CAST(coalesce(sum(n) FILTER (p = 'A'), 0) AS BIGINT) AS "A",
             CAST(coalesce(sum(n) FILTER (p = 'N'), 0) AS BIGINT) AS "N",
             CAST(coalesce(sum(n) FILTER (p = 'R'), 0) AS BIGINT) AS "R" FROM c GROUP BY t""",
)
def labelled_sink(spark, sf_dir):
    labels = ["A", "N", "R"]
    matrix = ev.confusion(predicted(spark, sf_dir), "truth", "guess", labels)
    path = scratch_path(spark, "matrix")
    write_table(ev.wide_matrix(matrix, labels), path, "csv")
    return read_table(spark, path, "true_label string, A bigint, N bigint, R bigint", "csv")


@query("accuracy", sql=f"SELECT count(*) AS n, round(avg(CASE WHEN l_returnflag = {GUESS} THEN 1.0 ELSE 0.0 END), 6) AS accuracy FROM lineitem")
def accuracy(spark, sf_dir):
    rows = predicted(spark, sf_dir).withColumn("correct", F.col("truth") == F.col("guess"))
    return rounded(sc.accuracy(rows))


def _metric_query(name, *fields):
    sql = BASE + " SELECT " + ", ".join(f"round({f}, 6) AS {f}" for f in fields) + " FROM o"

    @query(name, sql=sql.replace("round(f1_micro, 6)", "round(accuracy, 6)"))
    def run(spark, sf_dir):
        return rounded(ev.metrics(counts(spark, sf_dir)).select(*fields))


_metric_query("macro_metrics", "precision_macro", "recall_macro", "f1_macro")
_metric_query("weighted_metrics", "precision_weighted", "recall_weighted", "f1_weighted")
_metric_query("micro_metrics", "accuracy", "f1_micro")


@query(
    "metrics_by_group",
    sql="WITH "
    + metric_ctes("l_linestatus")
    + """ SELECT l_linestatus, CAST(n AS BIGINT) AS n, round(accuracy, 6) AS accuracy,
             round(f1_macro, 6) AS f1_macro, round(f1_weighted, 6) AS f1_weighted FROM o""",
)
def metrics_by_group(spark, sf_dir):
    by = ["l_linestatus"]
    pairs = ev.pair_counts(predicted(spark, sf_dir, *by), "truth", "guess", by)
    return rounded(ev.metrics(pairs, by).select(*by, "n", "accuracy", "f1_macro", "f1_weighted"))


@query(
    "classification_report",
    sql=BASE
    + """
    SELECT label, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1,
           CAST(support AS DOUBLE) AS support FROM m
    UNION ALL SELECT 'accuracy', round(accuracy, 6), round(accuracy, 6), round(accuracy, 6), round(accuracy, 6) FROM o
    UNION ALL SELECT 'macro avg', round(precision_macro, 6), round(recall_macro, 6), round(f1_macro, 6), n FROM o
    UNION ALL SELECT 'weighted avg', round(precision_weighted, 6), round(recall_weighted, 6), round(f1_weighted, 6), n FROM o
    """,
)
def classification_report(spark, sf_dir):
    return rounded(ev.report(counts(spark, sf_dir)))


FLAT = """
    SELECT 'test_accuracy' AS metric, accuracy AS value FROM o
    {overall}
    UNION ALL SELECT 'test_precision_' || label, precision FROM m
    UNION ALL SELECT 'test_recall_' || label, recall FROM m
    UNION ALL SELECT 'test_f1_' || label, f1 FROM m
""".format(
    overall="\n".join(
        f"UNION ALL SELECT 'test_{m}_{a}', {m}_{a} FROM o"
        for a in ("macro", "weighted")
        for m in ("precision", "recall", "f1")
    )
)


@query("metrics_flat", sql=BASE + f" SELECT metric, round(value, 6) AS value FROM ({FLAT})")
def metrics_flat(spark, sf_dir):
    return rounded(ev.metrics_flat(counts(spark, sf_dir), "test"))


@query("f1_per_class", sql=BASE + " SELECT label, round(f1, 6) AS f1 FROM m")
def f1_per_class(spark, sf_dir):
    return rounded(ev.f1_per_class(counts(spark, sf_dir)))


@query(
    "prediction_summary",
    sql="SELECT count(*) AS n_samples, TRUE AS predictions_generated FROM lineitem",
)
def prediction_summary(spark, sf_dir):
    return ev.prediction_summary(table(spark, sf_dir, "lineitem"))


@query(
    "length_check",
    sql="""
    SELECT count(d.doc_id) AS n_truth, count(l.doc_id) AS n_pred,
           count(*) FILTER (l.doc_id IS NULL) AS only_truth, count(*) FILTER (d.doc_id IS NULL) AS only_pred,
           count(*) FILTER (l.doc_id IS NULL) = 0 AND count(*) FILTER (d.doc_id IS NULL) = 0 AS same_rows,
           TRUE AS unique_keys
    FROM documents d FULL OUTER JOIN labels l ON d.doc_id = l.doc_id
    """,
)
def length_check(spark, sf_dir):
    return ev.length_check(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), ["doc_id"]
    )


# orders and their lines share a key that the lines repeat
@query(
    "length_check_duplicates",
    sql="""
    WITH t AS (SELECT o_orderkey AS k, count(*) AS n FROM orders GROUP BY 1),
         p AS (SELECT l_orderkey AS k, count(*) AS n FROM lineitem GROUP BY 1),
         b AS (SELECT coalesce(t.n, 0) AS t, coalesce(p.n, 0) AS p FROM t FULL OUTER JOIN p ON t.k = p.k)
    SELECT CAST(sum(t) AS BIGINT) AS n_truth, CAST(sum(p) AS BIGINT) AS n_pred,
           CAST(sum(greatest(t - p, 0)) AS BIGINT) AS only_truth, CAST(sum(greatest(p - t, 0)) AS BIGINT) AS only_pred,
           sum(abs(t - p)) = 0 AS same_rows, max(greatest(t, p)) <= 1 AS unique_keys
    FROM b
    """,
)
def length_check_duplicates(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").withColumnRenamed("l_orderkey", "o_orderkey")
    return ev.length_check(table(spark, sf_dir, "orders"), lines, ["o_orderkey"])


@query(
    "f1_degradation",
    sql=BASE
    + """ SELECT round(f1_macro, 6) AS f1_macro, round(f1_macro - 0.84, 6) AS f1_difference,
             f1_macro < 0.84 AS f1_degradation, round((f1_macro - 0.84) / 0.84 * 100, 5) AS f1_degradation_pct FROM o""",
)
def f1_degradation(spark, sf_dir):
    return rounded(ev.degradation(ev.metrics(counts(spark, sf_dir)), 0.84), f1_degradation_pct=5)


# Monitoring runs: a prediction that gets worse with the line number.
FADING = "CASE WHEN l_quantity > 2 + 1.5 * l_linenumber THEN l_returnflag ELSE 'N' END"


def monitored_runs(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem").select(
        "l_linenumber", F.col("l_returnflag").alias("truth"), F.expr(FADING).alias("guess")
    )
    by = ["l_linenumber"]
    scores = ev.metrics(ev.pair_counts(li, "truth", "guess", by), by)
    runs = scores.select(F.col("l_linenumber").alias("run"), "f1_weighted")
    return ev.against_baseline(runs, F.col("run") == 1)


_RUNS = (
    "WITH "
    + metric_ctes("l_linenumber", guess=FADING)
    + """, b AS (SELECT f1_weighted AS base_f1 FROM o WHERE l_linenumber = 1),
    r AS (SELECT l_linenumber AS run, base_f1, f1_weighted AS drift_f1, base_f1 - f1_weighted AS performance_drop,
                 (base_f1 - f1_weighted) / base_f1 * 100 AS relative_drop_pct,
                 base_f1 > f1_weighted AND (base_f1 - f1_weighted) / base_f1 * 100 > 5.0 AS alert
          FROM o, b WHERE l_linenumber > 1)
    """
)


@query(
    "performance_alert",
    sql=_RUNS
    + f""" SELECT run, round(base_f1, 6) AS base_f1, round(drift_f1, 6) AS drift_f1,
             round(performance_drop, 6) AS performance_drop, round(relative_drop_pct, 5) AS relative_drop_pct,
             alert, CASE WHEN alert THEN '{ev.ACTION_ALERT}' ELSE '{ev.ACTION_OK}' END AS action FROM r""",
)
def performance_alert(spark, sf_dir):
    return rounded(monitored_runs(spark, sf_dir), relative_drop_pct=5)


@query(
    "alert_summary",
    sql=_RUNS
    + """ SELECT count(*) AS total_runs, count(*) FILTER (alert) AS alerts, round(avg(relative_drop_pct), 5) AS mean_drop_pct,
             round(max(relative_drop_pct), 5) AS max_drop_pct, round(min(relative_drop_pct), 5) AS min_drop_pct FROM r""",
)
def alert_summary(spark, sf_dir):
    return rounded(ev.alert_summary(monitored_runs(spark, sf_dir)), 5)


def _halves(spark, sf_dir):
    early = F.expr("l_shipdate < TIMESTAMP_NTZ '1998-06-01 00:00:00'")
    rows = predicted(spark, sf_dir, "l_shipdate")
    ref = ev.metrics_flat(ev.pair_counts(rows.where(early), "truth", "guess"))
    cur = ev.metrics_flat(ev.pair_counts(rows.where(~early), "truth", "guess"))
    return cur, ref.where(F.col("metric") != "test_f1_A")


def _half_sql() -> str:
    def half(where: str) -> str:
        return f"(WITH {metric_ctes(where=where)} {FLAT})"

    return f"""
    WITH cur AS {half('NOT (' + EARLY + ')')},
         ref AS (SELECT * FROM {half(EARLY)} WHERE metric <> 'test_f1_A'),
         j AS (SELECT cur.metric, cur.value AS current, ref.value AS reference,
                      abs(cur.value - ref.value) AS difference,
                      CASE WHEN ref.value IS NULL THEN 'missing'
                           WHEN abs(cur.value - ref.value) > 0.005 THEN 'mismatch' ELSE 'match' END AS status
               FROM cur LEFT JOIN ref ON cur.metric = ref.metric)
    """


@query(
    "compare_metrics",
    sql=_half_sql()
    + """ SELECT metric, round(current, 6) AS current, round(reference, 6) AS reference,
             round(difference, 6) AS difference, status FROM j""",
)
def compare_metrics(spark, sf_dir):
    return rounded(ev.compare_metrics(*_halves(spark, sf_dir), tol=0.005))


@query(
    "comparison_verdict",
    sql=_half_sql()
    + """ SELECT count(*) FILTER (status = 'mismatch') = 0 AS matches,
             count(*) FILTER (status <> 'match') = 0 AS all_match FROM j""",
)
def comparison_verdict(spark, sf_dir):
    return ev.comparison_verdict(ev.compare_metrics(*_halves(spark, sf_dir), tol=0.005))


@query(
    "compare_predictions",
    sql=f"""
    SELECT {KEYS}, {GUESS} AS current_pred, {FADING} AS reference_pred, {GUESS} = {FADING} AS same
    FROM lineitem ORDER BY {KEYS} LIMIT 10
    """,
)
def compare_predictions(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    a = li.select(*LINE_KEY, F.expr(GUESS).alias("guess"))
    b = li.select(*LINE_KEY, F.expr(FADING).alias("guess"))
    return ev.compare_predictions(a, b, LINE_KEY, "guess")


@query(
    "argmax_class",
    sql="""SELECT vec_id, CAST(list_position(embedding, list_max(embedding)) - 1 AS INTEGER) AS class
           FROM embeddings""",
)
def argmax_class(spark, sf_dir):
    return table(spark, sf_dir, "embeddings").select(
        "vec_id", sc.argmax_class(F.col("embedding")).alias("class")
    )


@query(
    "threshold_class",
    sql="SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, CAST(l_discount * 10 > 0.5 AS INTEGER) AS class FROM lineitem",
)
def threshold_class(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").select(
        *LINE_KEY, sc.threshold_class(F.col("l_discount") * 10).alias("class")
    )


@query(
    "validate_features",
    sql="""
    SELECT l_returnflag, count(*) FILTER (l_discount <> 0) AS n_good, count(*) FILTER (l_discount = 0) AS n_bad
    FROM lineitem GROUP BY l_returnflag
    """,
)
def validate_features(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    vectors = li.select(
        "l_returnflag",
        F.array_compact(F.array("l_quantity", "l_extendedprice", F.nullif("l_discount", F.lit(0.0)))).alias("v"),
    )
    good, bad = sc.validate_features(vectors, "v", 3, mode="quarantine")
    parts = good.select("l_returnflag", F.lit(1).alias("ok")).unionAll(
        bad.select("l_returnflag", F.lit(0).alias("ok"))
    )
    return parts.groupBy("l_returnflag").agg(
        F.count_if(F.col("ok") == 1).alias("n_good"), F.count_if(F.col("ok") == 0).alias("n_bad")
    )


@query(
    "validate_features_strict",
    sql="SELECT vec_id, label, len(embedding) AS n_values FROM embeddings",
)
def validate_features_strict(spark, sf_dir):
    good = sc.validate_features(table(spark, sf_dir, "embeddings"), "embedding", 64)
    return good.select("vec_id", "label", F.size("embedding").cast("long").alias("n_values"))
