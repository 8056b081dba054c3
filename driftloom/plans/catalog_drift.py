"""Queries: drift monitoring."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.hashing import scalar_normal
from ..operators import drift as dr
from ..operators import features as ft
from ..operators import perturb
from ..operators import runs as rn
from ..operators import stored_profiles as sp
from ..session import scratch_path
from .catalog_features import normal_sql
from .jobs import drift_job
from .registry import LINE_KEY, MEASURES, query, rounded, table

CUT = "TIMESTAMP '1998-06-01'"


def halves(spark, sf_dir, columns=MEASURES):
    li = table(spark, sf_dir, "lineitem")
    early = F.expr("l_shipdate < TIMESTAMP_NTZ '1998-06-01 00:00:00'")
    return li.where(early).select(*columns), li.where(~early).select(*columns)


def detail_ctes(columns=MEASURES) -> str:
    """CTEs u (tall), p (profile), h (shares per bin), s (PSI and JS), k (KS), per feature."""
    cols = ", ".join(columns)
    return f"""
    WITH u AS (
      SELECT feature, value, l_shipdate >= {CUT} AS prod
      FROM (SELECT l_shipdate, {cols} FROM lineitem) UNPIVOT (value FOR feature IN ({cols}))),
    p AS (
      SELECT feature, count(*) FILTER (NOT prod) AS n, count(*) FILTER (prod) AS m,
             avg(value) FILTER (NOT prod) AS reference_mean, avg(value) FILTER (prod) AS production_mean,
             stddev_pop(value) FILTER (NOT prod) AS reference_std, stddev_pop(value) FILTER (prod) AS production_std,
             min(value) AS lo, max(value) AS hi
      FROM u GROUP BY feature),
    b AS (
      SELECT u.feature, prod,
             len(list_filter(range(1, 10), lambda i: (value - lo) / (hi - lo) >= i * CAST(0.1 AS DOUBLE))) AS bin
      FROM u JOIN p ON u.feature = p.feature),
    h AS (
      SELECT p.feature, g.bin, count(*) FILTER (NOT prod) / any_value(n) AS e, count(*) FILTER (prod) / any_value(m) AS a
      FROM p CROSS JOIN (SELECT unnest(range(10)) AS bin) g LEFT JOIN b ON b.feature = p.feature AND b.bin = g.bin
      GROUP BY p.feature, g.bin),
    s AS (
      SELECT feature,
             sum(((CASE WHEN a = 0 THEN 1e-4 ELSE a END) - (CASE WHEN e = 0 THEN 1e-4 ELSE e END))
                 * ln((CASE WHEN a = 0 THEN 1e-4 ELSE a END) / (CASE WHEN e = 0 THEN 1e-4 ELSE e END))) AS psi,
             sqrt(sum((CASE WHEN e > 0 THEN e * ln(e / ((e + a) / 2)) ELSE 0 END)
                    + (CASE WHEN a > 0 THEN a * ln(a / ((e + a) / 2)) ELSE 0 END)) / 2) AS js
      FROM h GROUP BY feature),
    v AS (
      SELECT feature, value, count(*) FILTER (NOT prod) AS r, count(*) FILTER (prod) AS q FROM u GROUP BY ALL),
    w AS (
      SELECT v.feature, abs(sum(r) OVER x / n - sum(q) OVER x / m) AS gap
      FROM v JOIN p ON v.feature = p.feature
      WINDOW x AS (PARTITION BY v.feature ORDER BY value)),
    k0 AS (
      SELECT p.feature, n, m, d, d * sqrt(n * m / (n + m)) AS lam
      FROM (SELECT feature, max(gap) AS d FROM w GROUP BY feature) x JOIN p ON x.feature = p.feature),
    k AS (
      SELECT feature, n AS n_ref, m AS n_prod, d,
             CASE WHEN lam = 0 THEN 1.0
                  WHEN lam >= 1.18 THEN 2 * list_sum(list_transform(range(1, 101),
                       lambda j: (CASE WHEN j % 2 = 1 THEN 1 ELSE -1 END) * exp(-2.0 * j * j * lam * lam)))
                  ELSE 1 - sqrt(2 * pi()) / lam * list_sum(list_transform(range(1, 101),
                       lambda j: exp(-1.0 * (2 * j - 1) * (2 * j - 1) * pi() * pi() / (8 * lam * lam)))) END AS p_value
      FROM k0)
    """


_LADDER = {
    "psi": "CASE WHEN {s} < 0.1 THEN 'none' WHEN {s} < 0.25 THEN 'low' WHEN {s} < 0.5 THEN 'moderate' ELSE 'high' END",
    "js": "CASE WHEN {s} < 0.1 THEN 'none' WHEN {s} < 0.3 THEN 'low' WHEN {s} < 0.5 THEN 'moderate' ELSE 'high' END",
    "ks": "CASE WHEN 1 - ({s}) >= 0.05 THEN 'none' WHEN 1 - ({s}) >= 0.01 THEN 'low' "
    "WHEN 1 - ({s}) >= 0.001 THEN 'moderate' ELSE 'high' END",
}


@query(
    "reference_profile",
    sql="\nUNION ALL\n".join(
        f"""SELECT '{c}' AS feature, count({c}) AS n, round(avg({c}), 4) AS mean, round(stddev_pop({c}), 4) AS std,
            min({c}) + 0.0 AS min, max({c}) + 0.0 AS max FROM lineitem"""
        for c in MEASURES
    ),
)
def reference_profile(spark, sf_dir):
    return rounded(dr.reference_profile(table(spark, sf_dir, "lineitem"), MEASURES), 4)


@query("drift_psi", sql=detail_ctes() + " SELECT feature, round(psi, 8) AS drift_score FROM s")
def drift_psi(spark, sf_dir):
    return rounded(dr.drift(*halves(spark, sf_dir), method="psi").select("feature", "drift_score"), 8)


@query("drift_js", sql=detail_ctes() + " SELECT feature, round(js, 8) AS drift_score FROM s")
def drift_js(spark, sf_dir):
    return rounded(dr.drift(*halves(spark, sf_dir), method="js").select("feature", "drift_score"), 8)


_KS_SQL = detail_ctes() + (
    " SELECT feature, n_ref, n_prod, round(d, 8) AS d, round(p_value, 6) AS p_value FROM k"
)


@query("drift_ks", sql=_KS_SQL)
def drift_ks(spark, sf_dir):
    return rounded(dr.ks_statistic(*halves(spark, sf_dir)), d=8)


# the same statistic through the bucket search that large features take
@query("drift_ks_buckets", sql=_KS_SQL)
def drift_ks_buckets(spark, sf_dir):
    return rounded(dr.ks_statistic(*halves(spark, sf_dir), direct_rows=1000, bucket_rows=5000), d=8)


@query(
    "drift_js_positional",
    sql="""
    WITH t AS (SELECT *, l_extendedprice / sum(l_extendedprice) OVER () AS p,
                      l_extendedprice * (1 - l_discount) / sum(l_extendedprice * (1 - l_discount)) OVER () AS q
               FROM lineitem)
    SELECT 'price' AS feature,
           round(sqrt((sum(p * ln(p / ((p + q) / 2))) + sum(q * ln(q / ((p + q) / 2)))) / 2), 8) AS score FROM t
    """,
)
def drift_js_positional(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    key = [*LINE_KEY, "l_shipdate"]
    a = li.select(*key, F.col("l_extendedprice").alias("price"))
    b = li.select(*key, (F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("price"))
    return rounded(dr.js_positional(a, b, key, ["price"]), 8)


def _detail_sql(method: str) -> str:
    score = {"psi": "psi", "js": "js", "ks": "1 - p_value"}[method]
    return detail_ctes() + f""", t AS (
      SELECT p.feature, {score} AS score, reference_mean, production_mean, reference_std, production_std
      FROM p JOIN s ON p.feature = s.feature JOIN k ON p.feature = k.feature)
    """


def _register_detail(name: str, method: str, threshold: float):
    @query(
        name,
        sql=_detail_sql(method)
        + f""" SELECT feature, round(score, 6) AS drift_score, score > {threshold} AS drift_detected,
        round(reference_mean, 4) AS reference_mean, round(production_mean, 4) AS production_mean,
        round(reference_std, 4) AS reference_std, round(production_std, 4) AS production_std FROM t""",
    )
    def run(spark, sf_dir):
        detail = dr.drift(*halves(spark, sf_dir), method=method, threshold=threshold)
        return rounded(detail, 4, drift_score=6)


_register_detail("drift_detail", "psi", 0.25)
_register_detail("drift_detail_low_threshold", "psi", 0.0009)
_register_detail("drift_detail_ks", "ks", 0.95)
_register_detail("drift_detail_js", "js", 0.25)


@query(
    "drift_summary",
    sql=_detail_sql("psi")
    + """ SELECT round(max(score), 8) AS max_drift_score, round(avg(score), 8) AS mean_drift_score,
             round(min(score), 8) AS min_drift_score, count(*) FILTER (score > 0.0009) AS features_with_drift,
             count(*) AS total_features, count(*) FILTER (score > 0.0009) > 0 AS drift_detected,
             count(*) FILTER (score > 0.0009) / count(*) * 100 AS drift_percentage FROM t""",
)
def drift_summary(spark, sf_dir):
    return rounded(dr.drift_summary(dr.drift(*halves(spark, sf_dir), threshold=0.0009)), 8)


def _register_severity(name: str, method: str):
    ladder = _LADDER[method].format(s="score")

    @query(
        name,
        sql=_detail_sql(method)
        + f""" SELECT feature, round(score, 6) AS drift_score, {ladder} AS severity,
           CASE {ladder} WHEN 'high' THEN 'retrain now and validate before release'
                WHEN 'moderate' THEN 'evaluate the model and monitor more often'
                ELSE 'keep monitoring' END AS action FROM t""",
    )
    def run(spark, sf_dir):
        detail = dr.with_severity(dr.drift(*halves(spark, sf_dir), method=method), method)
        return rounded(detail.select("feature", "drift_score", "severity", "action"))


_register_severity("drift_severity", "psi")
_register_severity("drift_severity_ks", "ks")
_register_severity("drift_severity_js", "js")


# A score per order drives the ladders through all their levels.
@query(
    "severity_ladders",
    sql="\nUNION ALL\n".join(
        f"SELECT o_orderkey, '{m}' AS method, {_LADDER[m].format(s='o_totalprice / 500000')} AS severity FROM orders"
        for m in ("psi", "js", "ks")
    )
    + "\nUNION ALL SELECT o_orderkey, 'other', 'unknown' FROM orders",
)
def severity_ladders(spark, sf_dir):
    methods = F.explode(F.array(*[F.lit(m) for m in ("psi", "js", "ks", "other")]))
    scored = table(spark, sf_dir, "orders").select(
        "o_orderkey", (F.col("o_totalprice") / 500000).alias("score"), methods.alias("method")
    )
    return scored.select(
        "o_orderkey", "method", dr.severity(F.col("method"), F.col("score")).alias("severity")
    )


@query(
    "drift_topk",
    sql=_detail_sql("psi")
    + " SELECT feature, round(score, 8) AS drift_score FROM t ORDER BY score DESC, feature LIMIT 2",
)
def drift_topk(spark, sf_dir):
    detail = dr.drift(*halves(spark, sf_dir))
    return rounded(dr.top_drift(detail, 2).select("feature", "drift_score"), 8)


@query(
    "drift_job",
    sql=_detail_sql("psi")
    + """
    SELECT 'max_drift_score' AS name, round(max(score), 6) AS value FROM t
    UNION ALL SELECT 'mean_drift_score', round(avg(score), 6) FROM t
    UNION ALL SELECT 'min_drift_score', round(min(score), 6) FROM t
    UNION ALL SELECT 'features_with_drift', count(*) FILTER (score > 0.25) FROM t
    UNION ALL SELECT 'total_features', count(*) FROM t
    UNION ALL SELECT 'drift_percentage', count(*) FILTER (score > 0.25) / count(*) * 100 FROM t
    UNION ALL SELECT 'drift_detected', CASE WHEN max(score) > 0.25 THEN 1.0 ELSE 0.0 END FROM t
    UNION ALL SELECT 'reference_samples', any_value(n) FROM p
    UNION ALL SELECT 'production_samples', any_value(m) FROM p
    """,
)
def drift_job_run(spark, sf_dir):
    out = scratch_path(spark, "drift")
    run_id = drift_job(spark, *halves(spark, sf_dir), out, f"{out}/runs")
    run = rn.read_runs(spark, f"{out}/runs").where(F.col("run_id") == run_id)
    samples = F.map_from_arrays(
        F.array(F.lit("reference_samples"), F.lit("production_samples")),
        F.array(*[F.col("params")[p].cast("double") for p in ("reference_samples", "production_samples")]),
    )
    return rounded(run.select(F.explode(F.map_concat("metrics", samples)).alias("name", "value")))


# Scaling both sides by the same fitted figures leaves the shares as they are.
_SCALED = ["l_quantity", "l_extendedprice"]


@query(
    "drift_transformed",
    sql=detail_ctes(_SCALED)
    + """ SELECT p.feature, round(psi, 8) AS drift_score, round((production_mean - reference_mean) / reference_std, 6)
             AS production_mean, round(production_std / reference_std, 6) AS production_std
       FROM p JOIN s ON p.feature = s.feature""",
)
def drift_transformed(spark, sf_dir):
    reference, production = halves(spark, sf_dir, _SCALED)
    model = ft.preprocessing(_SCALED, use_pca=False).fit(reference)
    detail = dr.drift(reference, production, model=model)
    return rounded(detail.select("feature", "drift_score", "production_mean", "production_std"), drift_score=8)


def _moved() -> float:
    return 0.5 + 0.2 * scalar_normal(42, "l_tax")


@query(
    "drift_simulated",
    sql=f"""
    WITH u AS (SELECT l_tax AS value, FALSE AS prod FROM lineitem
               UNION ALL SELECT l_tax + CAST({_moved()!r} AS DOUBLE) + 0.3 * {normal_sql('l_tax')}, TRUE FROM lineitem),
    p AS (SELECT min(value) AS lo, max(value) AS hi, count(*) FILTER (prod) AS m FROM u),
    b AS (SELECT prod, len(list_filter(range(1, 10), lambda i: (value - lo) / (hi - lo) >= i * CAST(0.1 AS DOUBLE))) AS bin
          FROM u, p),
    h AS (SELECT g.bin, count(*) FILTER (NOT prod) / any_value(m) AS e, count(*) FILTER (prod) / any_value(m) AS a
          FROM p CROSS JOIN (SELECT unnest(range(10)) AS bin) g LEFT JOIN b ON b.bin = g.bin GROUP BY g.bin),
    f AS (SELECT CASE WHEN e = 0 THEN 1e-4 ELSE e END AS e, CASE WHEN a = 0 THEN 1e-4 ELSE a END AS a FROM h)
    SELECT 'l_tax' AS feature, round(sum((a - e) * ln(a / e)), 7) AS drift_score,
           sum((a - e) * ln(a / e)) > 0.25 AS drift_detected FROM f
    """,
)
def drift_simulated(spark, sf_dir):
    """Production is the reference with a shifted, noisy column."""
    li = table(spark, sf_dir, "lineitem").select(*LINE_KEY, "l_tax")
    moved = perturb.add_shifted_noise(li, ["l_tax"], LINE_KEY)
    detail = dr.drift(li, moved, ["l_tax"])
    return rounded(detail.select("feature", "drift_score", "drift_detected"), 7)


@query("drift_after_pca")
def drift_after_pca(spark, sf_dir):
    wide = ft.array_columns(table(spark, sf_dir, "embeddings"), "embedding", 64)
    reference, production = wide.where("label < 5"), wide.where("label >= 5")
    model = ft.preprocessing([f"f{i}" for i in range(64)], use_pca=True, k=50).fit(reference)
    return dr.with_severity(dr.drift(reference, production, model=model), "psi")


@query(
    "drift_events",
    sql="""
    WITH p AS (SELECT min(value) AS lo, max(value) AS hi, count(*) FILTER (ts < TIMESTAMP '2024-01-16') AS n,
                      count(*) FILTER (ts >= TIMESTAMP '2024-01-16') AS m FROM events),
    b AS (SELECT ts >= TIMESTAMP '2024-01-16' AS prod,
                 len(list_filter(range(1, 10), lambda i: (value - lo) / (hi - lo) >= i * CAST(0.1 AS DOUBLE))) AS bin
          FROM events, p),
    h AS (SELECT g.bin, count(*) FILTER (NOT prod) / any_value(n) AS e, count(*) FILTER (prod) / any_value(m) AS a
          FROM p CROSS JOIN (SELECT unnest(range(10)) AS bin) g LEFT JOIN b ON b.bin = g.bin GROUP BY g.bin),
    f AS (SELECT CASE WHEN e = 0 THEN 1e-4 ELSE e END AS e, CASE WHEN a = 0 THEN 1e-4 ELSE a END AS a FROM h)
    SELECT 'value' AS feature, round(sum((a - e) * ln(a / e)), 8) AS drift_score FROM f
    """,
)
def drift_events(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    early = F.expr("ts < TIMESTAMP_NTZ '2024-01-16 00:00:00'")
    detail = dr.drift(events.where(early), events.where(~early), ["value"])
    return rounded(detail.select("feature", "drift_score"), 8)


def _dead(spark, sf_dir):
    """Documents with and without a label: ``toxic`` is unknown on the second side, ``flat`` never varies."""
    joined = table(spark, sf_dir, "documents").join(table(spark, sf_dir, "labels"), "doc_id", "left")
    rows = joined.withColumn("flat", F.lit(1.0)).select("n_chars", "toxic", "flat", "quality")
    return rows.where("quality is not null"), rows.where("quality is null")


def _dead_detail_sql(score: str) -> str:
    return f"""
    WITH j AS (SELECT n_chars, quality IS NULL AS prod FROM documents LEFT JOIN labels USING (doc_id)),
    r AS (SELECT min(n_chars) AS lo, max(n_chars) AS hi, count(*) FILTER (NOT prod) AS n, count(*) FILTER (prod) AS m FROM j),
    b AS (SELECT prod, len(list_filter(range(1, 10), lambda i: (n_chars - lo) / (hi - lo) >= i * CAST(0.1 AS DOUBLE))) AS bin FROM j, r),
    h AS (SELECT g.bin, count(*) FILTER (NOT prod) / any_value(n) AS e, count(*) FILTER (prod) / any_value(m) AS a
          FROM r CROSS JOIN (SELECT unnest(range(10)) AS bin) g LEFT JOIN b ON b.bin = g.bin GROUP BY g.bin)
    SELECT 'n_chars' AS feature, round({score}, 8) AS drift_score FROM h
    UNION ALL SELECT 'toxic', CAST(NULL AS DOUBLE) UNION ALL SELECT 'flat', 0.0
    """


_PSI_SUM = (
    "sum(((CASE WHEN a = 0 THEN 1e-4 ELSE a END) - (CASE WHEN e = 0 THEN 1e-4 ELSE e END))"
    " * ln((CASE WHEN a = 0 THEN 1e-4 ELSE a END) / (CASE WHEN e = 0 THEN 1e-4 ELSE e END)))"
)
_JS_SUM = (
    "sqrt(sum((CASE WHEN e > 0 THEN e * ln(e / ((e + a) / 2)) ELSE 0 END)"
    " + (CASE WHEN a > 0 THEN a * ln(a / ((e + a) / 2)) ELSE 0 END)) / 2)"
)


@query("drift_psi_dead_column", sql=_dead_detail_sql(_PSI_SUM))
def drift_psi_dead_column(spark, sf_dir):
    detail = dr.drift(*_dead(spark, sf_dir), ["n_chars", "toxic", "flat"], method="psi")
    return rounded(detail.select("feature", "drift_score"), 8)


@query("drift_js_dead_column", sql=_dead_detail_sql(_JS_SUM))
def drift_js_dead_column(spark, sf_dir):
    detail = dr.drift(*_dead(spark, sf_dir), ["n_chars", "toxic", "flat"], method="js")
    return rounded(detail.select("feature", "drift_score"), 8)


@query(
    "drift_empty_production",
    sql=" UNION ALL ".join(
        f"SELECT '{c}' AS feature, CAST(NULL AS DOUBLE) AS drift_score, FALSE AS drift_detected, "
        f"round(avg({c}), 6) AS reference_mean, CAST(NULL AS DOUBLE) AS production_mean FROM lineitem"
        for c in MEASURES
    ),
)
def drift_empty_production(spark, sf_dir):
    """No row has been seen in production yet: means of the reference, no score, no flag."""
    li = table(spark, sf_dir, "lineitem").select(*MEASURES)
    detail = dr.drift(li, li.where("l_quantity < 0"), MEASURES, method="psi")
    return rounded(detail.select("feature", "drift_score", "drift_detected", "reference_mean", "production_mean"))


def _kept_profiles(spark, sf_dir, columns):
    """Profiles of the lines before and from the cut, the former kept by year and merged."""
    li = table(spark, sf_dir, "lineitem")
    path = scratch_path(spark, "profiles")
    early = li.where("l_shipdate < TIMESTAMP_NTZ '1998-06-01 00:00:00'").withColumn("year", F.year("l_shipdate"))
    for year in sorted(r[0] for r in early.select("year").distinct().collect()):  # a handful
        sp.save_profile(sp.stored_profile(early.where(F.col("year") == year), columns), path, str(year))
    return sp.load_profile(spark, path), sp.stored_profile(halves(spark, sf_dir, columns)[1], columns)


FEW_VALUES = ["l_quantity", "l_discount", "l_tax"]


@query(
    "drift_of_profiles",
    sql=detail_ctes(FEW_VALUES)
    + """ SELECT s.feature, round(psi, 8) AS drift_score, round(psi, 8) AS score_low, round(psi, 8) AS score_high, n AS reference_n, m AS production_n,
          round(reference_mean, 8) AS reference_mean, round(production_mean, 8) AS production_mean,
          round(reference_std, 8) AS reference_std, round(production_std, 8) AS production_std
          FROM s JOIN p ON s.feature = p.feature""",
)
def drift_of_profiles(spark, sf_dir):
    """Columns of few values: a profile loses nothing."""
    return rounded(sp.drift_of_profiles(*_kept_profiles(spark, sf_dir, FEW_VALUES)).drop("drift_detected"), 8)


@query(
    "drift_profile_bounds",
    sql=detail_ctes()
    + """ SELECT s.feature, round(psi, 8) AS exact, true AS held, true AS narrow, n AS reference_n, m AS production_n
          FROM s JOIN p ON s.feature = p.feature""",
)
def drift_profile_bounds(spark, sf_dir):
    """The bounds hold the PSI of the rows, and lie within 0.05 of it."""
    kept = sp.drift_of_profiles(*_kept_profiles(spark, sf_dir, MEASURES))
    exact = dr.drift(*halves(spark, sf_dir), method="psi").select("feature", F.col("drift_score").alias("exact"))
    held = (F.col("score_low") <= F.col("exact") + 1e-9) & (F.col("exact") <= F.col("score_high") + 1e-9)
    narrow = F.greatest(F.col("score_high") - F.col("exact"), F.col("exact") - F.col("score_low")) < 0.05
    return rounded(kept.join(exact, "feature").select("feature", "exact", held.alias("held"), narrow.alias("narrow"), "reference_n", "production_n"), 8)
