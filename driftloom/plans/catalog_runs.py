"""Queries: the run table. Runs are derived from orders, one per priority and status."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import runs as rn
from ..session import scratch_path
from .registry import query, rounded, table


def raw_runs(spark, sf_dir):
    """Run rows with a missing param and unusable metrics, as a careless writer leaves them."""
    orders = table(spark, sf_dir, "orders")
    grouped = orders.groupBy("o_orderpriority", "o_orderstatus").agg(
        F.count(F.lit(1)).alias("n"),
        F.avg("o_totalprice").alias("price"),
        F.avg((F.col("o_totalprice") < 250000).cast("double")).alias("share"),
        F.max("o_orderdate").alias("last"),
    )
    pending = F.col("o_orderstatus") == "P"
    return grouped.select(
        F.md5(F.concat_ws("|", "o_orderpriority", "o_orderstatus")).alias("run_id"),
        F.concat_ws("-", "o_orderpriority", "o_orderstatus").alias("run_name"),
        F.lit("orders").alias("experiment"),
        F.col("last").alias("created_at"),
        F.create_map(
            F.lit("model_type"), F.col("o_orderpriority"),
            F.lit("n_estimators"), F.col("n").cast("string"),
            F.lit("random_state"), F.when(~pending, "7"),
        ).alias("params"),
        F.create_map(
            F.lit("test_accuracy"), F.col("share"),
            F.lit("test_f1_macro"), F.col("price") / 500000,
            F.lit("test_loss"), F.when(pending, F.lit(float("nan"))).otherwise(1 - F.col("share")),
            F.lit("test_ratio"), F.when(pending, F.lit(float("inf"))).otherwise(F.col("share") * 2),
        ).alias("metrics"),
        F.create_map(
            F.lit("status"), F.when(F.col("o_orderstatus") == "F", "failed").otherwise("completed")
        ).alias("tags"),
    )


def stored_runs(spark, sf_dir):
    path = scratch_path(spark, "runs")
    rn.append_runs(raw_runs(spark, sf_dir), path)
    return rn.read_runs(spark, path)


RUNS = """
    WITH runs AS (
      SELECT md5(concat_ws('|', o_orderpriority, o_orderstatus)) AS run_id,
             o_orderpriority AS model_type, o_orderstatus AS st, count(*) AS n,
             avg(o_totalprice) / 500000 AS f1,
             avg(CASE WHEN o_totalprice < 250000 THEN 1.0 ELSE 0.0 END) AS acc
      FROM orders GROUP BY o_orderpriority, o_orderstatus)
"""


@query(
    "runs_append",
    sql=RUNS
    + """ SELECT run_id, model_type || '-' || st AS run_name, CAST(CASE st WHEN 'P' THEN 2 ELSE 3 END AS BIGINT) AS n_params,
             CAST(CASE st WHEN 'P' THEN 2 ELSE 4 END AS BIGINT) AS n_metrics FROM runs""",
)
def runs_append(spark, sf_dir):
    path = scratch_path(spark, "runs")
    runs = raw_runs(spark, sf_dir)
    rn.append_runs(runs.where("params['model_type'] < '3'"), path)
    rn.append_runs(runs.where("params['model_type'] >= '3'"), path)
    return rn.read_runs(spark, path).select(
        "run_id",
        "run_name",
        F.size("params").cast("long").alias("n_params"),
        F.size("metrics").cast("long").alias("n_metrics"),
    )


@query(
    "runs_append_repeated",
    sql=RUNS + " SELECT model_type, count(*) AS n, count(DISTINCT run_id) AS n_ids, true AS few_files FROM runs GROUP BY model_type",
)
def runs_append_repeated(spark, sf_dir):
    """Every batch is appended twice, and once more with all others."""
    path = scratch_path(spark, "runs")
    runs = raw_runs(spark, sf_dir)
    for part in ("< '3'", ">= '3'"):
        for _ in range(2):
            rn.append_runs(runs.where(f"params['model_type'] {part}"), path)
    rn.append_runs(runs, path)
    found = rn.read_runs(spark, path)
    few = len(found.inputFiles()) <= 2
    return found.groupBy(F.col("params")["model_type"].alias("model_type")).agg(
        F.count("*").alias("n"), F.countDistinct("run_id").alias("n_ids"), F.lit(few).alias("few_files")
    )


@query(
    "runs_params",
    sql=RUNS
    + """ SELECT run_id, 'model_type' AS name, model_type AS value FROM runs
       UNION ALL SELECT run_id, 'n_estimators', CAST(n AS VARCHAR) FROM runs
       UNION ALL SELECT run_id, 'random_state', '7' FROM runs WHERE st <> 'P'""",
)
def runs_params(spark, sf_dir):
    cleaned = raw_runs(spark, sf_dir).select("run_id", rn.clean_params("params").alias("params"))
    return cleaned.select("run_id", F.explode("params").alias("name", "value"))


@query(
    "runs_metrics",
    sql=RUNS
    + """ SELECT run_id, 'test_accuracy' AS name, round(acc, 6) AS value FROM runs
       UNION ALL SELECT run_id, 'test_f1_macro', round(f1, 6) FROM runs
       UNION ALL SELECT run_id, 'test_loss', round(1 - acc, 6) FROM runs WHERE st <> 'P'
       UNION ALL SELECT run_id, 'test_ratio', round(acc * 2, 6) FROM runs WHERE st <> 'P'""",
)
def runs_metrics(spark, sf_dir):
    cleaned = raw_runs(spark, sf_dir).select("run_id", rn.clean_metrics("metrics").alias("metrics"))
    return rounded(cleaned.select("run_id", F.explode("metrics").alias("name", "value")))


@query(
    "runs_search",
    sql=RUNS
    + """ SELECT run_id, round(acc, 6) AS accuracy FROM runs WHERE acc > 0.49 AND model_type <> '5-LOW'
       ORDER BY acc DESC, run_id LIMIT 100""",
)
def runs_search(spark, sf_dir):
    found = rn.search_runs(
        stored_runs(spark, sf_dir),
        "metrics.test_accuracy > 0.49 AND params.model_type <> '5-LOW'",
        ["metrics.test_accuracy DESC"],
        experiment="orders",
    )
    return rounded(found.select("run_id", F.col("metrics.test_accuracy").alias("accuracy")))


@query(
    "runs_best",
    sql=RUNS
    + """ SELECT run_id, round(acc, 6) AS metric_value, 'test_accuracy' AS metric_name
       FROM runs ORDER BY acc DESC, run_id LIMIT 1""",
)
def runs_best(spark, sf_dir):
    return rounded(rn.best_run(stored_runs(spark, sf_dir)))


@query(
    "runs_best_ascending",
    sql=RUNS
    + """ SELECT run_id, round(1 - acc, 6) AS metric_value, 'test_loss' AS metric_name
       FROM runs WHERE st <> 'P' ORDER BY 1 - acc, run_id LIMIT 1""",
)
def runs_best_ascending(spark, sf_dir):
    return rounded(rn.best_run(stored_runs(spark, sf_dir), "test_loss", ascending=True))


@query(
    "runs_compare",
    sql=RUNS
    + """ SELECT run_id, round(acc, 6) AS "metrics.test_accuracy", round(f1, 6) AS "metrics.test_f1_macro",
             round(1 - acc, 6) AS "metrics.test_loss", round(acc * 2, 6) AS "metrics.test_ratio",
             model_type AS "params.model_type", CAST(n AS VARCHAR) AS "params.n_estimators", '7' AS "params.random_state"
       FROM runs WHERE run_id IN (md5('1-URGENT|O'), md5('5-LOW|F'))""",
)
def runs_compare(spark, sf_dir):
    ids = spark.range(1).select(F.md5(F.lit("1-URGENT|O")), F.md5(F.lit("5-LOW|F"))).first()
    wide = rn.compare_runs(stored_runs(spark, sf_dir), list(ids))
    return wide.select(
        *[
            (F.round(F.col(f"`{c}`"), 6) if c.startswith("metrics.") else F.col(f"`{c}`")).alias(c)
            for c in wide.columns
        ]
    )


@query(
    "runs_topk",
    sql=RUNS + " SELECT run_id, round(acc, 6) AS accuracy FROM runs ORDER BY acc DESC, run_id LIMIT 5",
)
def runs_topk(spark, sf_dir):
    top = rn.top_runs(stored_runs(spark, sf_dir))
    return rounded(top.select("run_id", F.col("metrics")["test_accuracy"].alias("accuracy")))


@query(
    "runs_best_per_group",
    sql=RUNS
    + """ SELECT model_type, run_id, round(acc, 6) AS metric_value FROM (
         SELECT *, row_number() OVER (PARTITION BY model_type ORDER BY acc DESC, run_id) AS rn FROM runs) WHERE rn = 1""",
)
def runs_best_per_group(spark, sf_dir):
    return rounded(rn.best_per_group(stored_runs(spark, sf_dir)))


@query(
    "runs_count",
    sql=RUNS
    + " SELECT model_type, count(*) FILTER (st <> 'F') AS completed, count(*) AS total FROM runs GROUP BY model_type",
)
def runs_count(spark, sf_dir):
    return rn.count_runs(stored_runs(spark, sf_dir))


@query(
    "runs_reference",
    sql=RUNS
    + """ SELECT run_id, round(acc, 6) AS accuracy, round(f1, 6) AS f1_macro, CAST(0 AS DOUBLE) AS f1_weighted,
             CAST(0 AS DOUBLE) AS precision_macro, CAST(0 AS DOUBLE) AS recall_macro,
             CAST(CASE st WHEN 'P' THEN 42 ELSE 7 END AS INTEGER) AS seed, model_type FROM runs""",
)
def runs_reference(spark, sf_dir):
    return rounded(rn.reference_metrics(stored_runs(spark, sf_dir)))


def _fingerprint_sql(relation: str, columns: list[str]) -> str:
    text = " || ".join(f"coalesce(length(CAST({c} AS VARCHAR)) || ':' || CAST({c} AS VARCHAR), '-')" for c in columns)
    return f"""
    SELECT count(*) AS n_rows, CAST({len(columns)} AS BIGINT) AS n_columns,
           CAST(sum(CAST(CAST('0x' || substr(md5({text}), 1, 16) AS UBIGINT) AS HUGEINT)) AS VARCHAR) AS checksum
    FROM {relation}
    """


_ORDERS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"]


@query("data_fingerprint", sql=_fingerprint_sql("orders", _ORDERS))
def data_fingerprint(spark, sf_dir):
    return rn.fingerprint(table(spark, sf_dir, "orders"))


_DOCUMENTS = ["doc_id", "text", "lang", "source", "n_chars"]


@query("data_fingerprint_documents", sql=_fingerprint_sql("documents", _DOCUMENTS))
def data_fingerprint_documents(spark, sf_dir):
    return rn.fingerprint(table(spark, sf_dir, "documents"), _DOCUMENTS)


# The same characters with the border between two columns moved: other content, another checksum.
_MOVED = ["substr(source, 1, 1)", "substr(source, 2)"], ["source", "''"]


@query(
    "fingerprint_separators",
    sql="WITH a AS ({}), b AS ({}) SELECT a.checksum AS one, b.checksum AS other, a.checksum <> b.checksum AS told_apart FROM a, b".format(
        *[_fingerprint_sql("documents", columns) for columns in _MOVED]
    ),
)
def fingerprint_separators(spark, sf_dir):
    documents = table(spark, sf_dir, "documents")
    made = [rn.fingerprint(documents.select(*[F.expr(e).alias(f"c{i}") for i, e in enumerate(columns)])) for columns in _MOVED]
    one, other = (f.select(F.col("checksum").alias(name)) for f, name in zip(made, ("one", "other")))
    return one.crossJoin(other).withColumn("told_apart", F.col("one") != F.col("other"))  # one row on either side


@query(
    "runs_metric_history",
    sql="""SELECT CAST(user_id AS VARCHAR) AS run_id, event_type AS metric, max(value) AS value,
                  CAST(max(event_id) AS BIGINT) AS step
           FROM (SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY event_id DESC) AS r FROM events)
           WHERE r = 1 AND value IS NOT NULL GROUP BY 1, 2""",
)
def runs_metric_history(spark, sf_dir):
    """Events as logged values: the user is the run, the event id the step."""
    path = scratch_path(spark, "history")
    events = table(spark, sf_dir, "events").select(
        F.col("user_id").cast("string").alias("run_id"), F.col("event_type").alias("metric"), "value", F.col("event_id").alias("step")
    )
    events.write.parquet(path)
    return rn.latest_metrics(rn.metric_history(spark, path)).where("value is not null")
