"""Queries: sources, sinks, profiling, cleaning."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import clean, profile
from ..session import scratch_path
from ..sources import tables
from .jobs import clean_dataset
from .registry import MEASURES, query, rounded, table

CUSTOMER_SCHEMA = (
    "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string"
)


@query("scan_table", sql="SELECT * FROM customer")
def scan_table(spark, sf_dir):
    return tables.read_table(spark, f"{sf_dir}/customer.parquet", required=["c_custkey"])


@query("csv_roundtrip", sql="SELECT * FROM customer")
def csv_roundtrip(spark, sf_dir):
    path = scratch_path(spark, "customer-csv")
    tables.write_table(table(spark, sf_dir, "customer"), path, "csv")
    return tables.read_table(spark, path, CUSTOMER_SCHEMA, "csv")


@query(
    "csv_inferred",
    sql="SELECT n_nationkey, n_name, n_regionkey FROM nation",
)
def csv_inferred(spark, sf_dir):
    path = scratch_path(spark, "nation-csv")
    tables.write_table(table(spark, sf_dir, "nation"), path, "csv")
    return tables.read_table(spark, path, fmt="csv")


@query(
    "report_json",
    sql="""
    SELECT to_json({'source': 'orders', 'column': 'o_orderstatus', 'category': o_orderstatus,
                    'n': count(*)})::VARCHAR AS report
    FROM orders GROUP BY o_orderstatus
    """,
)
def report_json(spark, sf_dir):
    counts = profile.category_counts(table(spark, sf_dir, "orders"), ["o_orderstatus"])
    return tables.report_json(counts, source="orders")


@query(
    "json_metrics",
    sql="""
    SELECT l_returnflag AS metric, round(avg(l_quantity), 6) AS value
    FROM lineitem GROUP BY l_returnflag
    """,
)
def json_metrics(spark, sf_dir):
    means = table(spark, sf_dir, "lineitem").groupBy(F.col("l_returnflag").alias("metric")).agg(
        F.avg("l_quantity").alias("value")
    )
    path = scratch_path(spark, "metrics-json")
    tables.write_metrics(means, path)
    return rounded(tables.read_metrics(spark, path))


@query(
    "dataset_info",
    sql="""
    SELECT count(*) FILTER (l_shipdate < TIMESTAMP '1998-06-01') AS n_train_samples,
           count(*) FILTER (l_shipdate >= TIMESTAMP '1998-06-01') AS n_test_samples,
           CAST(10 AS BIGINT) AS n_features,
           count(DISTINCT l_returnflag) FILTER (l_shipdate < TIMESTAMP '1998-06-01') AS n_classes
    FROM lineitem
    """,
)
def dataset_info(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    early = F.col("l_shipdate") < F.lit("1998-06-01").cast("timestamp_ntz")
    return tables.dataset_info(li.where(early), li.where(~early), "l_returnflag")


@query("table_shape", sql="SELECT count(*) AS n_rows, CAST(11 AS BIGINT) AS n_columns FROM lineitem")
def table_shape(spark, sf_dir):
    return tables.shape(table(spark, sf_dir, "lineitem"))


@query(
    "head_n",
    sql="""
    SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice
    FROM orders ORDER BY o_orderkey LIMIT 20
    """,
)
def head_n(spark, sf_dir):
    cols = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice"]
    return tables.head_n(table(spark, sf_dir, "orders").select(*cols), 20, ["o_orderkey"])


# --- cleaning ---------------------------------------------------------------


def iqr_chain_sql(relation: str, columns: list[str]) -> str:
    """CTEs s0..sk (rows kept after each column) and b1..bk (fences)."""
    parts = [f"s0 AS (SELECT * FROM {relation})"]
    for i, c in enumerate(columns, 1):
        parts.append(
            f"b{i} AS (SELECT q1 - 1.5e0 * (q3 - q1) AS lower, q3 + 1.5e0 * (q3 - q1) AS upper FROM "
            f"(SELECT quantile_cont({c}, 0.25) AS q1, quantile_cont({c}, 0.75) AS q3 FROM s{i - 1}))"
        )
        parts.append(
            f"s{i} AS (SELECT s.* FROM s{i - 1} s, b{i} b WHERE s.{c} >= b.lower AND s.{c} <= b.upper)"
        )
    return "WITH " + ",\n".join(parts)


def iqr_log_sql(relation: str, columns: list[str]) -> str:
    rows = [
        f"SELECT '{c}' AS \"column\", {i - 1} AS ordinal, (SELECT count(*) FROM s{i - 1}) AS before, "
        f"(SELECT count(*) FROM s{i}) AS after, "
        f"(SELECT count(*) FROM s{i - 1}) - (SELECT count(*) FROM s{i}) AS removed, "
        f"round(lower, 6) AS lower, round(upper, 6) AS upper FROM b{i}"
        for i, c in enumerate(columns, 1)
    ]
    return iqr_chain_sql(relation, columns) + "\n" + "\nUNION ALL\n".join(rows)


EVENT_COLUMNS = ["value", "user_id"]


@query(
    "iqr_clean",
    sql=iqr_chain_sql("events", EVENT_COLUMNS) + " SELECT event_id, user_id, event_type, value FROM s2",
)
def iqr_clean(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("event_id", "user_id", "event_type", "value")
    return clean.remove_outliers_iqr(events, EVENT_COLUMNS)[0]


@query("iqr_log", sql=iqr_log_sql("events", EVENT_COLUMNS))
def iqr_log(spark, sf_dir):
    return rounded(clean.remove_outliers_iqr(table(spark, sf_dir, "events"), EVENT_COLUMNS)[1])


@query("iqr_log_lineitem", sql=iqr_log_sql("lineitem", MEASURES))
def iqr_log_lineitem(spark, sf_dir):
    return rounded(clean.remove_outliers_iqr(table(spark, sf_dir, "lineitem"), MEASURES)[1])


@query(
    "iqr_clean_documents",
    sql=iqr_chain_sql("documents", ["n_chars"]) + " SELECT doc_id, lang, source, n_chars FROM s1",
)
def iqr_clean_documents(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", "source", "n_chars")
    return clean.remove_outliers_iqr(docs, exclude=["doc_id"])[0]


@query(
    "clean_job",
    sql=iqr_chain_sql("events", ["value"])
    + """ SELECT (SELECT count(*) FROM s0) AS rows_in, CAST(6 AS BIGINT) AS n_columns,
          CAST(0.0 AS DOUBLE) AS total_missing_pct, (SELECT count(*) FROM s1) AS rows_out""",
)
def clean_job(spark, sf_dir):
    out = scratch_path(spark, "cleaned")
    return clean_dataset(spark, f"{sf_dir}/events.parquet", out, columns=["value"])


@query(
    "clean_job_output",
    sql=iqr_chain_sql("events", ["value"]) + " SELECT event_id, event_type, value FROM s1",
)
def clean_job_output(spark, sf_dir):
    out = scratch_path(spark, "cleaned")
    clean_dataset(spark, f"{sf_dir}/events.parquet", out, columns=["value"])
    return tables.read_table(spark, out).select("event_id", "event_type", "value")


LABELLED = """
    (SELECT d.doc_id, d.n_chars, l.quality, l.toxic
     FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id)
"""


def labelled_documents(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "n_chars")
    return docs.join(table(spark, sf_dir, "labels"), "doc_id", "left")


@query(
    "missing_pct",
    sql="SELECT 'doc_id' AS \"column\", CAST(0 AS DOUBLE) AS missing_pct"
    + "".join(
        f" UNION ALL SELECT '{c}', round(avg(CASE WHEN {c} IS NULL THEN 1.0 ELSE 0.0 END) * 100, 6)"
        f" FROM {LABELLED}"
        for c in ("n_chars", "quality", "toxic")
    ),
)
def missing_pct(spark, sf_dir):
    return rounded(profile.missing_percentage(labelled_documents(spark, sf_dir)))


@query(
    "missing_total",
    sql=f"""SELECT round(100 * (avg(CASE WHEN n_chars IS NULL THEN 1.0 ELSE 0.0 END)
    + avg(CASE WHEN quality IS NULL THEN 1.0 ELSE 0.0 END)
    + avg(CASE WHEN toxic IS NULL THEN 1.0 ELSE 0.0 END)), 6) AS total_missing_pct FROM {LABELLED}""",
)
def missing_total(spark, sf_dir):
    return rounded(profile.missing_total(labelled_documents(spark, sf_dir)))


@query(
    "impute_mean",
    sql=f"""SELECT doc_id, CAST(n_chars AS DOUBLE) AS n_chars,
    round(coalesce(quality, avg(quality) OVER ()), 6) AS quality,
    round(coalesce(toxic, avg(toxic) OVER ()), 6) AS toxic FROM {LABELLED}""",
)
def impute_mean(spark, sf_dir):
    return rounded(clean.impute_mean(labelled_documents(spark, sf_dir), exclude=["doc_id"]))


# --- profiling --------------------------------------------------------------


@query(
    "quantiles",
    sql="\nUNION ALL\n".join(
        f"SELECT '{c}' AS \"column\", CAST({p} AS DOUBLE) AS prob, "
        f"round(quantile_cont({c}, {p}), 6) AS value FROM lineitem"
        for c in MEASURES
        for p in (0.25, 0.5, 0.75)
    ),
)
def quantiles(spark, sf_dir):
    return rounded(profile.quantile_table(table(spark, sf_dir, "lineitem"), MEASURES))


# the same figures through the multi-pass search that large tables take
@query("quantiles_search", sql="\nUNION ALL\n".join(
    f"SELECT '{c}' AS \"column\", CAST({p} AS DOUBLE) AS prob, "
    f"round(quantile_cont({c}, {p}), 6) AS value FROM orders"
    for c in ("o_totalprice", "o_custkey")
    for p in (0.25, 0.5, 0.75)
))
def quantiles_search(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_totalprice", "o_custkey")
    return rounded(profile.quantile_table(orders, exact_rows=1000))


_STATS = {
    "Media": "avg({c})",
    "Desviacion estandar": "stddev_samp({c})",
    "Min": "min({c})",
    "Cuartil 25%": "quantile_cont({c}, 0.25)",
    "Mediana/Cuartil 50%": "quantile_cont({c}, 0.5)",
    "Cuartil 75%": "quantile_cont({c}, 0.75)",
    "Max": "max({c})",
}


@query(
    "stats_numeric",
    sql="\nUNION ALL\n".join(
        f"SELECT '{c}' AS \"column\", '{label}' AS statistic, round({sql.format(c=c)}, 4) + 0.0 AS value FROM lineitem"
        for c in MEASURES
        for label, sql in _STATS.items()
    ),
)
def stats_numeric(spark, sf_dir):
    return rounded(profile.stats_numeric(table(spark, sf_dir, "lineitem"), MEASURES), 4)


@query(
    "stats_categorical",
    sql="\nUNION ALL\n".join(
        f"""SELECT '{c}' AS "column", 'Cardinalidad' AS statistic, CAST(count(DISTINCT {c}) AS VARCHAR) AS value FROM orders
        UNION ALL
        SELECT '{c}', 'Moda', (SELECT {c} FROM orders GROUP BY {c} ORDER BY count(*) DESC, {c} LIMIT 1)"""
        for c in ("o_orderstatus", "o_orderpriority")
    ),
)
def stats_categorical(spark, sf_dir):
    return profile.stats_categorical(table(spark, sf_dir, "orders"))


@query(
    "category_counts",
    sql="\nUNION ALL\n".join(
        f"SELECT '{c}' AS \"column\", {c} AS category, count(*) AS n FROM lineitem GROUP BY {c}"
        for c in ("l_returnflag", "l_linestatus")
    ),
)
def category_counts(spark, sf_dir):
    return profile.category_counts(table(spark, sf_dir, "lineitem"))


@query(
    "corr_matrix",
    sql="\nUNION ALL\n".join(
        f"SELECT '{a}' AS column_a, '{b}' AS column_b, round(corr({a}, {b}), 6) AS corr FROM lineitem"
        for a in MEASURES
        for b in MEASURES
    ),
)
def corr_matrix(spark, sf_dir):
    return rounded(profile.correlation(table(spark, sf_dir, "lineitem"), MEASURES))


# a column that never varies next to one that is null throughout: neither has a correlation
_CONSTANT = {"same": "1.0", "gone": "CAST(NULL AS DOUBLE)"}


def _with_dead_columns(spark, sf_dir, copies: int):
    li = table(spark, sf_dir, "lineitem").select("l_quantity", "l_extendedprice")
    extra = {f"x{i}": F.col("l_quantity") + i * F.col("l_extendedprice") for i in range(copies)}
    return li.withColumns({k: F.expr(v) for k, v in _CONSTANT.items()} | extra)


def _dead_sql(columns: dict[str, str]) -> str:
    pairs = [(a, b) for a in columns for b in columns]
    return "\nUNION ALL\n".join(
        f"SELECT '{a}' AS column_a, '{b}' AS column_b, "
        + ("CAST(NULL AS DOUBLE)" if {a, b} & set(_CONSTANT) else f"round(corr({columns[a]}, {columns[b]}), 6)")
        + " AS corr FROM lineitem" * (not {a, b} & set(_CONSTANT))
        for a, b in pairs
    )


@query("corr_matrix_constant", sql=_dead_sql({"l_quantity": "l_quantity", "l_extendedprice": "l_extendedprice", **_CONSTANT}))
def corr_matrix_constant(spark, sf_dir):
    return rounded(profile.correlation(_with_dead_columns(spark, sf_dir, 0)))


# the same through the vectors that many columns take; the column of nulls would lead away from them
@query("corr_matrix_constant_wide", sql=_dead_sql({"l_quantity": "l_quantity", "l_extendedprice": "l_extendedprice", "same": "1.0"}))
def corr_matrix_constant_wide(spark, sf_dir):
    wide = profile.correlation(_with_dead_columns(spark, sf_dir, 60).drop("gone"))
    return rounded(wide.where(~F.col("column_a").startswith("x") & ~F.col("column_b").startswith("x")))


def _holed(i: int) -> str:
    """The measures over and over, each copy with other rows missing."""
    return f"CASE WHEN (l_orderkey * 7 + l_linenumber * {i + 3}) % {i + 4} > 0 THEN {MEASURES[i % len(MEASURES)]} + {i} * l_quantity END"


_HOLED = {f"h{i:03d}": _holed(i) for i in range(80)}


@query(
    "corr_matrix_holed_wide",
    sql=f"WITH t AS (SELECT {', '.join(f'{e} AS {c}' for c, e in _HOLED.items())} FROM lineitem)\n"
    + "\nUNION ALL\n".join(f"SELECT '{a}' AS column_a, '{b}' AS column_b, round(corr({a}, {b}), 6) AS corr FROM t" for a in list(_HOLED)[:6] for b in list(_HOLED)[-6:]),
)
def corr_matrix_holed_wide(spark, sf_dir):
    wide = table(spark, sf_dir, "lineitem").select(*[F.expr(e).alias(c) for c, e in _HOLED.items()])
    first, last = list(_HOLED)[:6], list(_HOLED)[-6:]
    return rounded(profile.correlation(wide).where(F.col("column_a").isin(first) & F.col("column_b").isin(last)))


def _histogram_sql(relation: str, c: str, bins: int) -> str:
    return f"""
    SELECT '{c}' AS "column", g.b AS bin,
           round(CASE WHEN g.b = 0 THEN lo ELSE g.b * ((hi - lo) / {bins}) + lo END, 6) AS bin_left,
           round(CASE WHEN g.b = {bins - 1} THEN hi ELSE (g.b + 1) * ((hi - lo) / {bins}) + lo END, 6) AS bin_right,
           coalesce(h.n, 0) AS n
    FROM (SELECT CAST(unnest(range({bins})) AS INTEGER) AS b) g
    CROSS JOIN (SELECT min({c}) AS lo, max({c}) AS hi FROM {relation}) m
    LEFT JOIN (
      SELECT len(list_filter(range(1, {bins}), lambda i: {c} >= i * ((hi - lo) / {bins}) + lo)) AS b, count(*) AS n
      FROM {relation}, (SELECT min({c}) AS lo, max({c}) AS hi FROM {relation}) GROUP BY 1
    ) h ON h.b = g.b
    """


@query(
    "histogram",
    sql="\nUNION ALL\n".join(_histogram_sql("lineitem", c, 50) for c in ("l_quantity", "l_extendedprice")),
)
def histogram(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    return rounded(profile.histogram(li, ["l_quantity", "l_extendedprice"]))


def _kde_sql(c: str) -> str:
    return f"""
    WITH m AS (SELECT count(*) AS n, min({c}) AS lo, max({c}) AS hi,
                      stddev_samp({c}) * pow(count(*), -0.2) AS width FROM lineitem),
         g AS (SELECT CAST(unnest(range(200)) AS INTEGER) AS point),
         v AS (SELECT {c} AS value, count(*) AS w FROM lineitem GROUP BY 1)
    SELECT point, round(any_value(lo + point * ((hi - lo) / 199)), 6) AS x,
           round(sum(w * exp(-0.5 * pow((value - (lo + point * ((hi - lo) / 199))) / width, 2)))
                 / any_value(n * width * sqrt(2 * pi())), 8) AS density
    FROM g, v, m GROUP BY point
    """


@query("kde_curve", sql=_kde_sql("l_quantity"))
def kde_curve(spark, sf_dir):
    return rounded(profile.kde_curve(table(spark, sf_dir, "lineitem"), "l_quantity"), density=8)


@query("kde_curve_continuous", sql=_kde_sql("l_extendedprice"))
def kde_curve_continuous(spark, sf_dir):
    return rounded(profile.kde_curve(table(spark, sf_dir, "lineitem"), "l_extendedprice"), density=8)


_BOX = """
    SELECT '{c}' AS "column", round(any_value(q1), 6) AS q1, round(any_value(q2), 6) AS median,
           round(any_value(q3), 6) AS q3,
           round(min({c}) FILTER ({c} >= q1 - 1.5 * (q3 - q1)), 6) AS whisker_low,
           round(max({c}) FILTER ({c} <= q3 + 1.5 * (q3 - q1)), 6) AS whisker_high,
           count(*) FILTER ({c} < q1 - 1.5 * (q3 - q1) OR {c} > q3 + 1.5 * (q3 - q1)) AS n_outliers
    FROM events, (SELECT quantile_cont({c}, 0.25) AS q1, quantile_cont({c}, 0.5) AS q2,
                         quantile_cont({c}, 0.75) AS q3 FROM events)
"""


@query("boxplot_stats", sql=_BOX.format(c="value") + "UNION ALL" + _BOX.format(c="user_id"))
def boxplot_stats(spark, sf_dir):
    return rounded(profile.boxplot_stats(table(spark, sf_dir, "events"), EVENT_COLUMNS))


@query(
    "boxplot_outliers",
    sql="""
    SELECT 'value' AS "column", value
    FROM events, (SELECT quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.75) AS q3 FROM events)
    WHERE value < q1 - 1.5 * (q3 - q1) OR value > q3 + 1.5 * (q3 - q1)
    """,
)
def boxplot_outliers(spark, sf_dir):
    return profile.boxplot_outliers(table(spark, sf_dir, "events"), ["value"])
