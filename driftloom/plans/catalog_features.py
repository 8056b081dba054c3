"""Queries: labels, splits, samples, scaling, PCA, perturbation."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from ..operators import features as ft
from ..operators import perturb, split
from ..session import scratch_path
from ..sources.tables import read_table
from .jobs import build_features, perturbed_set
from .registry import LINE_KEY, MEASURES, query, rounded, table

KEYS = ", ".join(LINE_KEY)


def line_hash(seed: str, key: str = "concat_ws('|', {})") -> str:
    cols = ", ".join(f"CAST({k} AS VARCHAR)" for k in LINE_KEY)
    return f"md5(concat_ws('|', '{seed}', {cols}))"


def lines(spark, sf_dir, *columns):
    return table(spark, sf_dir, "lineitem").select(*LINE_KEY, *columns)


# --- labels -----------------------------------------------------------------


@query(
    "encode_labels",
    sql="""
    SELECT o_orderkey, o_orderpriority,
           CAST(dense_rank() OVER (ORDER BY o_orderpriority) - 1 AS INTEGER) AS code FROM orders
    """,
)
def encode_labels(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority")
    return ft.encode_labels(orders, "o_orderpriority")


@query("decode_labels", sql="SELECT o_orderkey, o_orderpriority AS label FROM orders")
def decode_labels(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority")
    codes = ft.label_indexer("o_orderpriority", "code").fit(orders)
    coded = codes.transform(orders).select("o_orderkey", F.col("code").cast("int").alias("code"))
    return ft.decode_labels(coded, "code", codes.labels).select("o_orderkey", "label")


@query(
    "label_codes",
    sql="""SELECT l_returnflag, CAST(row_number() OVER (ORDER BY l_returnflag) - 1 AS INTEGER) AS code
           FROM (SELECT DISTINCT l_returnflag FROM lineitem)""",
)
def label_codes(spark, sf_dir):
    return ft.code_table(table(spark, sf_dir, "lineitem"), "l_returnflag")


# --- splits -----------------------------------------------------------------

_RANKED = f"""
    SELECT *, row_number() OVER (PARTITION BY l_returnflag ORDER BY {line_hash('42')}, {KEYS}) AS rn,
           count(*) OVER (PARTITION BY l_returnflag) AS n
    FROM lineitem
"""


_SPLIT_SQL = f"SELECT {KEYS}, l_returnflag, rn <= floor(n * 0.2 + 0.5) AS is_test FROM ({_RANKED})"


@query("stratified_split", sql=_SPLIT_SQL)
def stratified_split(spark, sf_dir):
    train, test = split.stratified_split(lines(spark, sf_dir, "l_returnflag"), "l_returnflag", LINE_KEY)
    return train.withColumn("is_test", F.lit(False)).unionAll(test.withColumn("is_test", F.lit(True)))


# the same split through the cut search that large strata take
@query("stratified_split_cuts", sql=_SPLIT_SQL)
def stratified_split_cuts(spark, sf_dir):
    return split.mark_test(lines(spark, sf_dir, "l_returnflag"), "l_returnflag", LINE_KEY, hot_rows=1000)


@query(
    "random_split",
    sql=f"""
    SELECT {KEYS}, CAST('0x' || substr({line_hash('42')}, 1, 8) AS BIGINT) < 0.2 * 4294967296 AS is_test
    FROM lineitem
    """,
)
def random_split(spark, sf_dir):
    train, test = split.random_split(lines(spark, sf_dir), LINE_KEY)
    return train.withColumn("is_test", F.lit(False)).unionAll(test.withColumn("is_test", F.lit(True)))


@query(
    "train_valid_test",
    sql=f"""
    WITH a AS (SELECT *, floor(n * 0.2 + 0.5) AS n_test FROM ({_RANKED}))
    SELECT {KEYS}, l_returnflag, rn <= n_test AS is_test,
           rn > n_test AND rn <= n_test + floor((n - n_test) * 0.2 + 0.5) AS is_validation FROM a
    """,
)
def train_valid_test(spark, sf_dir):
    return split.train_valid_test(lines(spark, sf_dir, "l_returnflag"), "l_returnflag", LINE_KEY)


@query(
    "stratified_kfold",
    sql=f"""
    SELECT {KEYS}, l_returnflag,
           CAST(ntile(5) OVER (PARTITION BY l_returnflag ORDER BY {line_hash('42')}, {KEYS}) - 1 AS BIGINT) AS fold
    FROM lineitem
    """,
)
def stratified_kfold(spark, sf_dir):
    folds = split.stratified_folds(lines(spark, sf_dir, "l_returnflag"), "l_returnflag", LINE_KEY)
    return folds.withColumn("fold", F.col("fold").cast("long"))


@query(
    "sample_n",
    sql="""
    SELECT vec_id, label FROM embeddings
    ORDER BY md5(concat_ws('|', '42', CAST(vec_id AS VARCHAR))), vec_id LIMIT 100
    """,
)
def sample_n(spark, sf_dir):
    return split.sample_n(table(spark, sf_dir, "embeddings").select("vec_id", "label"), ["vec_id"], 100)


# --- scaling and projection -------------------------------------------------


@query(
    "standard_scale",
    sql=f"SELECT {KEYS}, "
    + ", ".join(f"round(({c} - m_{c}) / s_{c}, 5) + 0.0 AS {c}" for c in MEASURES)
    + " FROM lineitem, (SELECT "
    + ", ".join(f"avg({c}) AS m_{c}, stddev_pop({c}) AS s_{c}" for c in MEASURES)
    + " FROM lineitem WHERE l_shipdate < TIMESTAMP '1998-06-01')",
)
def standard_scale(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    early = li.where(F.col("l_shipdate") < F.lit("1998-06-01").cast("timestamp_ntz"))
    return rounded(ft.standard_scale(early, li.select(*LINE_KEY, *MEASURES), MEASURES), 5)


# With two standardised columns the components are known in closed form:
# (z1 +- z2) / sqrt(2), with variance shares (1 +- |r|) / 2.
_TWO = ["l_quantity", "l_extendedprice"]
_PCA_SQL = """
    WITH m AS (SELECT avg(l_quantity) AS m1, stddev_pop(l_quantity) AS s1,
                      avg(l_extendedprice) AS m2, stddev_pop(l_extendedprice) AS s2,
                      corr(l_quantity, l_extendedprice) AS r FROM lineitem)
"""


def _two_column_pca(spark, sf_dir):
    li = lines(spark, sf_dir, *_TWO)
    return li, ft.preprocessing(_TWO, use_pca=True, k=2).fit(li)


@query(
    "pca_project",
    sql=_PCA_SQL
    + f""" SELECT {KEYS},
       round(((l_quantity - m1) / s1 + sign(r) * (l_extendedprice - m2) / s2) / sqrt(2), 5) + 0.0 AS "PC1",
       round(((l_quantity - m1) / s1 - sign(r) * (l_extendedprice - m2) / s2) / sqrt(2), 5) + 0.0 AS "PC2"
    FROM lineitem, m""",
)
def pca_project(spark, sf_dir):
    li, model = _two_column_pca(spark, sf_dir)
    out = model.transform(li).select(*LINE_KEY, ft.FEATURES)
    return rounded(ft.vector_columns(out, ft.FEATURES, ft.feature_names(model)), 5)


@query(
    "pca_variance",
    sql=_PCA_SQL
    + """ SELECT 1 AS component, 'PC1' AS name, round((1 + abs(r)) / 2, 8) AS ratio FROM m
       UNION ALL SELECT 2, 'PC2', round((1 - abs(r)) / 2, 8) FROM m""",
)
def pca_variance(spark, sf_dir):
    _, model = _two_column_pca(spark, sf_dir)
    return rounded(ft.explained_variance(model, spark).drop("cumulative"), 8)


@query(
    "pca_cumulative",
    sql=_PCA_SQL
    + """ SELECT 1 AS component, round((1 + abs(r)) / 2, 8) AS cumulative FROM m
       UNION ALL SELECT 2, 1.0 FROM m""",
)
def pca_cumulative(spark, sf_dir):
    _, model = _two_column_pca(spark, sf_dir)
    return rounded(ft.explained_variance(model, spark).select("component", "cumulative"), 8)


@query("pca_embeddings")
def pca_embeddings(spark, sf_dir):
    wide = ft.array_columns(table(spark, sf_dir, "embeddings"), "embedding", 64)
    names = [f"f{i}" for i in range(64)]
    model = ft.preprocessing(names, use_pca=True, k=30).fit(wide)
    out = model.transform(wide).select("vec_id", "label", ft.FEATURES)
    return ft.vector_columns(out, ft.FEATURES, ft.feature_names(model))


@query("pca_embeddings_variance")
def pca_embeddings_variance(spark, sf_dir):
    wide = ft.array_columns(table(spark, sf_dir, "embeddings"), "embedding", 64)
    model = ft.preprocessing([f"f{i}" for i in range(64)], use_pca=True, k=50).fit(wide)
    return ft.explained_variance(model, spark)


_SCALED_NORMS = """
    WITH cells AS (SELECT vec_id, unnest(embedding)::DOUBLE AS x, unnest(range(64)) AS i FROM embeddings),
         facts AS (SELECT i, avg(x) AS m, stddev_pop(x) AS s FROM cells GROUP BY i)
    SELECT vec_id, sum(pow((x - m) / s, 2)) AS size FROM cells JOIN facts USING (i) GROUP BY vec_id
"""


def _projected(spark, sf_dir, k: int):
    """Scaled embeddings and their first k components by the block Krylov solver, as arrays."""
    names = [f"f{i}" for i in range(64)]
    wide = ft.array_columns(table(spark, sf_dir, "embeddings"), "embedding", 64)
    model = ft.preprocessing(names, use_pca=True, k=k, solver="krylov").fit(wide)
    out = model.transform(wide).select("vec_id", vector_to_array(ft.SCALED).alias("x"), vector_to_array(ft.FEATURES).alias("pc"))
    return out, ft.pca_stage(model)


def _square(array: str):
    return F.aggregate(array, F.lit(0.0), lambda s, x: s + x * x)


@query("pca_krylov_norms", sql=f"SELECT vec_id, round(size, 5) AS size FROM ({_SCALED_NORMS})")
def pca_krylov_norms(spark, sf_dir):
    """All 64 components only turn the vectors: each keeps its length."""
    return _projected(spark, sf_dir, 64)[0].select("vec_id", F.round(_square("pc"), 5).alias("size"))


@query(
    "pca_krylov_variance",
    sql=f"""
    SELECT k::INTEGER AS k, count(*) AS n, round(sum(size), 3) AS total, round(sum(size), 3) AS split_total, k AS n_ratios, TRUE AS ratios_fit
    FROM ({_SCALED_NORMS}), (SELECT unnest([30, 50, 64])::INTEGER AS k) GROUP BY k
    """,
)
def pca_krylov_variance(spark, sf_dir):
    """What k components hold and what they leave add up to all; the ratios are the held shares, in falling order."""
    rows = []
    for k in (30, 50, 64):
        out, pca = _projected(spark, sf_dir, k)
        matrix, ratios = pca.pc.toArray(), pca.explainedVariance.toArray()
        back = F.array(*[F.aggregate(F.zip_with("pc", F.array(*[F.lit(float(v)) for v in _signed(matrix)[i]]), lambda a, b: a * b), F.lit(0.0), lambda a, b: a + b) for i in range(64)])
        left = F.zip_with("x", back, lambda a, b: a - b)
        facts = out.select(_square("x").alias("x"), _square("pc").alias("pc"), left.alias("r")).agg(
            F.count("*").alias("n"), F.sum("x").alias("total"), F.sum("pc").alias("held"), F.sum(_square("r")).alias("left")
        )
        fit = (F.abs(F.col("held") / F.col("total") - float(ratios.sum())) < 1e-9) & F.lit(bool((ratios[:-1] >= ratios[1:] - 1e-12).all()))
        rows.append(
            facts.select(
                F.lit(k).alias("k"), "n", F.round("total", 3).alias("total"), F.round(F.col("held") + F.col("left"), 3).alias("split_total"),
                F.lit(len(ratios)).alias("n_ratios"), fit.alias("ratios_fit"),
            )
        )
    return rows[0].union(rows[1]).union(rows[2])


def _signed(matrix):
    return matrix * ft.component_signs(matrix)


@query(
    "scaler_without_pca",
    sql="""
    SELECT c_custkey, round((c_acctbal - avg(c_acctbal) OVER ()) / stddev_pop(c_acctbal) OVER (), 5) + 0.0 AS z
    FROM customer
    """,
)
def scaler_without_pca(spark, sf_dir):
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_acctbal")
    model = ft.preprocessing(["c_acctbal"], use_pca=False).fit(customers)
    out = model.transform(customers).select("c_custkey", vector_to_array(ft.FEATURES)[0].alias("z"))
    return rounded(out, 5)


@query(
    "feature_job",
    sql=f"""
    WITH a AS (SELECT *, rn <= floor(n * 0.2 + 0.5) AS is_test FROM ({_RANKED})),
    m AS (SELECT avg(l_quantity) AS m1, stddev_pop(l_quantity) AS s1,
                 avg(l_extendedprice) AS m2, stddev_pop(l_extendedprice) AS s2 FROM a WHERE NOT is_test)
    SELECT {KEYS}, round((l_quantity - m1) / s1, 5) + 0.0 AS l_quantity,
           round((l_extendedprice - m2) / s2, 5) + 0.0 AS l_extendedprice,
           CASE l_returnflag WHEN 'A' THEN 0 WHEN 'N' THEN 1 ELSE 2 END AS target, is_test
    FROM a, m
    """,
)
def feature_job(spark, sf_dir):
    out = scratch_path(spark, "features")
    paths = build_features(
        spark, f"{sf_dir}/lineitem.parquet", out, "l_returnflag", LINE_KEY, _TWO, use_pca=False
    )
    parts = [
        read_table(spark, paths[p]).withColumn("is_test", F.lit(p == "test")) for p in ("train", "test")
    ]
    return rounded(parts[0].unionByName(parts[1]), 5)


# --- perturbation -----------------------------------------------------------


def normal_sql(salt: str) -> str:
    def h(part: str) -> str:
        return f"CAST(CAST('0x' || substr({line_hash(f'42|{salt}|{part}')}, 1, 8) AS BIGINT) AS DOUBLE)"

    return (
        f"(sqrt(-2.0 * ln(({h('r')} + 1.0) / 4294967297.0))"
        f" * cos(2.0 * pi() * ({h('a')} / 4294967296.0)))"
    )


@query(
    "perturb_shift",
    sql=f"""
    SELECT {KEYS}, round(l_extendedprice + avg(l_extendedprice) OVER () * (1.2e0 - 1), 4) AS l_extendedprice
    FROM lineitem
    """,
)
def perturb_shift(spark, sf_dir):
    return rounded(perturb.shift(lines(spark, sf_dir, "l_extendedprice"), "l_extendedprice", 1.2), 4)


@query(
    "perturb_noise",
    sql=f"SELECT {KEYS}, round(l_tax + 0.5 + 0.2 * {normal_sql('l_tax')}, 6) AS l_tax, l_discount FROM lineitem",
)
def perturb_noise(spark, sf_dir):
    li = lines(spark, sf_dir, "l_tax", "l_discount")
    return rounded(perturb.add_noise(li, ["l_tax"], LINE_KEY, mu=0.5, sigma=0.2))


def _column_shift() -> float:
    from ..functions.hashing import scalar_normal

    return 0.5 + 0.2 * scalar_normal(42, "l_quantity")


@query(
    "perturb_shifted_noise",
    sql=f"""SELECT {KEYS}, round(l_quantity + CAST({_column_shift()!r} AS DOUBLE)
                                 + 0.3 * {normal_sql('l_quantity')}, 5) AS l_quantity FROM lineitem""",
)
def perturb_shifted_noise(spark, sf_dir):
    li = lines(spark, sf_dir, "l_quantity")
    return rounded(perturb.add_shifted_noise(li, ["l_quantity"], LINE_KEY), 5)


@query(
    "perturb_scale",
    sql=f"""SELECT {KEYS}, round(l_extendedprice * (1.0 + 0.25 * {normal_sql('l_extendedprice')}), 4)
            AS l_extendedprice FROM lineitem""",
)
def perturb_scale(spark, sf_dir):
    li = lines(spark, sf_dir, "l_extendedprice")
    return rounded(perturb.scale_noise(li, ["l_extendedprice"], LINE_KEY, 0.25), 4)


@query(
    "perturb_relative_noise",
    sql=f"""SELECT {KEYS}, round(l_quantity + {normal_sql('l_quantity|level')}
                                 * (SELECT stddev_samp(l_quantity) FROM lineitem) * 0.1, 5) AS l_quantity
            FROM lineitem""",
)
def perturb_relative_noise(spark, sf_dir):
    li = lines(spark, sf_dir, "l_quantity")
    return rounded(perturb.relative_noise(li, ["l_quantity"], LINE_KEY, 0.1), 5)


@query(
    "perturb_missing",
    sql=f"""
    SELECT {KEYS}, CASE WHEN row_number() OVER (ORDER BY {line_hash('42|l_quantity')}, {KEYS})
                             > floor(count(*) OVER () * 0.1) THEN l_quantity END AS l_quantity
    FROM lineitem
    """,
)
def perturb_missing(spark, sf_dir):
    return perturb.drop_values(lines(spark, sf_dir, "l_quantity"), "l_quantity", 0.1, LINE_KEY)


@query(
    "perturbed_sample",
    sql=f"""
    WITH s AS (SELECT * FROM lineitem ORDER BY {line_hash('42')}, {KEYS} LIMIT 500)
    SELECT {KEYS}, l_returnflag,
           round(l_quantity + {normal_sql('l_quantity|level')} * (SELECT stddev_samp(l_quantity) FROM s) * 0.1, 5)
             AS l_quantity
    FROM s
    """,
)
def perturbed_sample(spark, sf_dir):
    li = lines(spark, sf_dir, "l_quantity", "l_returnflag")
    return rounded(perturb.perturbed_sample(li, "l_returnflag", LINE_KEY, n=500, noise=0.1), 5)


@query(
    "perturbed_set_job",
    sql=f"""SELECT {KEYS}, l_returnflag FROM lineitem ORDER BY {line_hash('42')}, {KEYS} LIMIT 500""",
)
def perturbed_set_job(spark, sf_dir):
    li = lines(spark, sf_dir, "l_quantity", "l_returnflag")
    out = scratch_path(spark, "perturbed")
    perturbed_set(li, out, "l_returnflag", LINE_KEY, n=500, drift_factor=0.2)
    schema = ", ".join(f"{k} {li.schema[k].dataType.simpleString()}" for k in LINE_KEY)
    return read_table(spark, f"{out}/labels", schema + ", l_returnflag string", "csv")
