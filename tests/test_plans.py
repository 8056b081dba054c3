"""What the physical plans must and must not hold."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from driftloom.operators import clean, evaluate as ev, drift as dr, profile, split


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("plans") / "t")
    rng = np.random.default_rng(0)
    rows = [(i, "abc"[i % 3], float(v), float(w)) for i, (v, w) in enumerate(rng.normal(size=(900, 2)))]
    spark.createDataFrame(rows, "id long, y string, v double, w double").write.parquet(path)
    return spark.read.parquet(path)


def final_plan(df):
    df.collect()
    text = df._jdf.queryExecution().toString()
    return text.split("== Final Plan ==")[-1].split("== Initial Plan ==")[0]


def test_confusion_scans_once(stored):
    df = stored.withColumn("p", F.when(F.col("v") > 0, "a").otherwise("b"))
    plan = final_plan(ev.confusion(df, "y", "p"))
    assert plan.count("FileScan") == 1 and "ReusedExchange" in plan


def test_report_scans_once(stored):
    df = stored.withColumn("p", F.when(F.col("v") > 0, "a").otherwise("b"))
    counts = ev.pair_counts(df, "y", "p")
    for out in (ev.report(counts), ev.metrics_flat(counts), ev.metrics(counts)):
        assert final_plan(out).count("FileScan") == 1


def test_cleaning_is_one_pushed_filter(stored):
    out, _ = clean.remove_outliers_iqr(stored, ["v", "w"])
    plan = final_plan(out.select("id"))
    assert "Exchange" not in plan and "GreaterThanOrEqual(v," in plan
    assert "ReadSchema: struct<id:bigint,v:double,w:double>" in plan


def test_drift_reads_needed_columns_and_aggregates_before_the_shuffle(stored):
    plan = final_plan(dr.drift(stored.where("v < 0.3"), stored.where("v >= 0.3"), ["w"]))
    assert "ReadSchema: struct<v:double,w:double>" in plan
    below = plan[plan.index("Exchange hashpartitioning(f"):]
    assert below.index("partial_count") < below.index("FileScan")
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_large_strata_are_split_without_a_shuffle(stored):
    plan = final_plan(split.mark_test(stored.where("y = 'a'"), "y", ["id"], hot_rows=10).where("y = 'a'"))
    # no row is left for the window of the small strata, so only the cut remains
    assert "Window" not in plan and "hashpartitioning" not in plan


def test_wide_statistics_shuffle_one_row_per_task(stored):
    plan = final_plan(profile.stats_numeric(stored, exclude=["id"]))
    assert plan.count("Exchange") == 1 and "SinglePartition" in plan


def test_ks_of_many_large_features_takes_no_more_jobs(spark):
    """The passes are shared, so two features and eight need the same number of jobs."""
    from pyspark.sql import functions as F

    base = spark.range(1000).select(*[(F.col("id") * (i + 7) % 1009).cast("double").alias(f"c{i}") for i in range(8)])

    def jobs(k):
        tracker, group = spark.sparkContext.statusTracker(), f"ks-{k}"
        spark.sparkContext.setJobGroup(group, group)
        columns = [f"c{i}" for i in range(k)]
        dr.ks_statistic(base.where("c0 < 400"), base.where("c0 >= 400"), columns, direct_rows=100, bucket_rows=300).collect()
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        return len(tracker.getJobIdsForGroup(group))

    assert jobs(8) <= jobs(2) + 3


@pytest.fixture(scope="module")
def wide(spark, tmp_path_factory):
    """120 columns with holes, one constant, one without values."""
    path = str(tmp_path_factory.mktemp("wide") / "t")
    rng = np.random.default_rng(5)
    x = rng.normal(size=(400, 118)) @ rng.normal(size=(118, 118)) * 3 + 1e4
    x[rng.random(x.shape) < 0.2] = np.nan
    x = np.column_stack([x, np.full(400, 0.1), np.full(400, np.nan)])
    rows = [tuple(None if np.isnan(v) and i % 2 else float(v) for v in r) for i, r in enumerate(x)]
    spark.createDataFrame(rows, ", ".join(f"c{i} double" for i in range(120))).write.parquet(path)
    return spark.read.parquet(path), x


def test_wide_correlation_with_holes_is_one_scan(wide):
    df, x = wide
    out = profile.correlation(df)
    plan = final_plan(out)
    assert plan.count("FileScan") == 1 and "partial_sum" in plan
    got = {(r.column_a, r.column_b): r["corr"] for r in out.collect()}
    assert len(got) == 120 * 120
    for i in range(120):
        for j in range(120):
            known = ~np.isnan(x[:, i]) & ~np.isnan(x[:, j])
            a, b = x[known, i], x[known, j]
            value = got[f"c{i}", f"c{j}"]
            if i >= 118 or j >= 118:
                assert value is None
            else:
                assert value == pytest.approx(np.corrcoef(a, b)[0, 1], abs=1e-9)


def test_density_of_a_continuous_column_shuffles_blocks_only(stored, monkeypatch):
    monkeypatch.setattr(profile, "KDE_DISTINCT", 100)
    out = profile.kde_curve(stored, "v", 50)
    plan = final_plan(out)
    assert "hashpartitioning(v" not in plan and "hashpartitioning(block" in plan
    got = {r.point: r.density for r in out.collect()}
    monkeypatch.setattr(profile, "KDE_DISTINCT", 10_000)
    counted = {r.point: r.density for r in profile.kde_curve(stored, "v", 50).collect()}
    assert got.keys() == counted.keys() and all(got[p] == pytest.approx(counted[p], rel=1e-12) for p in got)


def exchanges(df):
    """Columns of the rows that each hash exchange moves."""
    df.collect()
    found = []

    def walk(node):
        if node.nodeName() == "Exchange" or node.nodeName() == "ShuffleQueryStage":
            out = node.output()
            found.append({out.apply(i).name() for i in range(out.size())})
        if node.nodeName() == "AdaptiveSparkPlan":
            walk(node.executedPlan())
        if node.nodeName().endswith("QueryStage"):
            walk(node.plan())
        children = node.children()
        for i in range(children.size()):
            walk(children.apply(i))

    walk(df._jdf.queryExecution().executedPlan())
    return found


@pytest.mark.parametrize("hot_rows", [10, 100_000])
def test_splits_and_folds_move_keys_only(stored, hot_rows):
    for out in (split.mark_test(stored, "y", ["id"], hot_rows=hot_rows), split.stratified_folds(stored, "y", ["id"], 4, hot_rows=hot_rows)):
        assert all(not {"v", "w"} & names for names in exchanges(out))
    assert exchanges(stored.groupBy("v").count())  # the walk does see exchanges


def test_many_strata_are_ranked_as_a_whole(stored, monkeypatch):
    from driftloom.functions import ranks

    few = split.stratified_folds(stored, "y", ["id"], 3).select("id", "fold").orderBy("id").collect()
    monkeypatch.setattr(ranks, "MAX_HOT", 2)
    assert split.stratified_folds(stored, "y", ["id"], 3).select("id", "fold").orderBy("id").collect() == few
    assert split.stratified_folds(stored, "y", ["id"], 3, hot_rows=10).select("id", "fold").orderBy("id").collect() == few


def test_split_of_lines_is_ranked_and_written_once(spark, tmp_path):
    from driftloom.operators.split import stratified_split
    from driftloom.plans import catalog_models as cm
    from driftloom.session import remove_scratch

    numbers = {"l_orderkey": "id div 4", "l_linenumber": "cast(id % 4 + 1 as int)", "l_partkey": "id % 9", "l_suppkey": "id % 5"}
    measures = {"l_quantity": "double(id % 50)", "l_extendedprice": "double(id * 997 % 100000)", "l_discount": "0.05D", "l_tax": "IF(id % 3 = 0, NULL, 0.02D)"}
    lines = spark.range(400).select(*[F.expr(e).alias(c) for c, e in {**numbers, **measures}.items()])
    lines.write.parquet(f"{tmp_path}/lineitem.parquet")
    for made, rows, label in ((cm.parts, cm.banded, "band"), (cm.class_parts, cm.classed, "line_class")):
        plain = stratified_split(rows(spark, str(tmp_path)), label, cm.LINE_KEY)
        first, second = made(spark, str(tmp_path)), made(spark, str(tmp_path))
        for old, new, again in zip(plain, first, second):
            assert new.columns == old.columns and new.inputFiles() == again.inputFiles()
            assert sorted(map(str, new.collect())) == sorted(map(str, old.collect()))
        remove_scratch(spark)
        assert sorted(map(str, made(spark, str(tmp_path))[1].collect())) == sorted(map(str, plain[1].collect()))
