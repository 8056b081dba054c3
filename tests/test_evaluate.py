import pytest
from pyspark.sql import functions as F

from driftloom.operators import evaluate as ev


def pairs(frame, truth, pred):
    return frame("y_true int, y_pred int", a=truth, b=pred)


def trace(matrix):
    return matrix.where("true_label = pred_label").agg(F.sum("n")).first()[0]


def test_perfect(frame):
    df = pairs(frame, [0, 1, 2, 0, 1, 2], [0, 1, 2, 0, 1, 2])
    matrix = ev.confusion(df, "y_true", "y_pred")
    assert matrix.count() == 9 and trace(matrix) == 6
    row = ev.metrics(ev.pair_counts(df, "y_true", "y_pred")).first()
    assert row["accuracy"] == row["f1_macro"] == row["f1_micro"] == 1.0


def test_errors(frame):
    df = pairs(frame, [0, 0, 1, 1, 2, 2], [0, 1, 1, 2, 2, 0])
    assert trace(ev.confusion(df, "y_true", "y_pred")) == 3
    assert ev.metrics(ev.pair_counts(df, "y_true", "y_pred")).first()["accuracy"] == 0.5


def test_label_seen_only_in_predictions_counts(frame):
    row = ev.metrics(ev.pair_counts(pairs(frame, [0, 0, 1], [0, 2, 1]), "y_true", "y_pred")).first()
    assert row["recall_macro"] == pytest.approx((0.5 + 1 + 0) / 3)
    assert row["precision_macro"] == pytest.approx((1 + 1 + 0) / 3)
    assert row["recall_weighted"] == pytest.approx(2 / 3)


def test_flat_names(frame):
    df = frame("t string, p string", a=["angry", "happy"] * 2, b=["angry", "happy"] * 2)
    flat = {r["metric"]: r["value"] for r in ev.metrics_flat(ev.pair_counts(df, "t", "p")).collect()}
    for name in ("test_precision_angry", "test_recall_happy", "test_f1_angry", "test_f1_macro", "test_accuracy"):
        assert flat[name] == 1.0
    assert len(flat) == 7 + 6


def test_names_and_given_labels(frame):
    df = pairs(frame, [0, 1], [0, 1])
    matrix = ev.confusion(df, "y_true", "y_pred", labels=[0, 1, 2])
    assert matrix.count() == 9
    named = ev.name_classes(matrix, ["a", "b", "c"])
    assert {r["true_label"] for r in named.collect()} == {"a", "b", "c"}
    assert {r["true_label"] for r in ev.name_classes(matrix).collect()} == {"Class_0", "Class_1", "Class_2"}


def test_missing_label_is_an_error(frame):
    with pytest.raises(Exception, match="missing value in y_pred"):
        ev.confusion(pairs(frame, [0, 1], [0, None]), "y_true", "y_pred").collect()


def test_different_lengths(frame):
    a = frame("y_true int", a=[0, 1, 2])
    b = frame("y_pred int", a=[0, 1])
    with pytest.raises(ValueError, match="different lengths"):
        ev.pair(a, b, ["id"])
    assert ev.pair(a.where("id < 2"), b, ["id"]).count() == 2


def matrix_of(spark, labels, counts):
    rows = [(t, p, n) for t, line in zip(labels, counts) for p, n in zip(labels, line)]
    return ev.matrix_from_rows(spark, rows)


# Two published confusion matrices with their reports.
LABELS = ["angry", "happy", "relax", "sad"]
TEST_MATRIX = [[0, 10, 2, 4], [0, 10, 4, 3], [0, 8, 1, 7], [0, 9, 1, 7]]
TEST_REPORT = {
    "angry": (0.0, 0.0, 0.0, 16.0),
    "happy": (0.2702702702702703, 0.5882352941176471, 0.37037037037037035, 17.0),
    "relax": (0.125, 0.0625, 0.08333333333333333, 16.0),
    "sad": (0.3333333333333333, 0.4117647058823529, 0.3684210526315789, 17.0),
    "accuracy": (0.2727272727272727,) * 4,
    "macro avg": (0.18215090090090091, 0.265625, 0.20553118908382065, 66.0),
    "weighted avg": (0.18577668577668577, 0.2727272727272727, 0.21049678067221925, 66.0),
}
TRAIN_MATRIX = [[3, 32, 9, 17], [0, 48, 5, 16], [0, 36, 13, 15], [0, 24, 4, 39]]
TRAIN_REPORT = {
    "angry": (1.0, 0.04918032786885246, 0.09375, 61.0),
    "happy": (0.34285714285714286, 0.6956521739130435, 0.45933014354066987, 69.0),
    "relax": (0.41935483870967744, 0.203125, 0.2736842105263158, 64.0),
    "sad": (0.4482758620689655, 0.582089552238806, 0.5064935064935064, 67.0),
    "accuracy": (0.3946360153256705,) * 4,
    "macro avg": (0.5526219609089464, 0.38251176350517546, 0.333314465140123, 261.0),
    "weighted avg": (0.5422618210466777, 0.3946360153256705, 0.34047273683162976, 261.0),
}


@pytest.mark.parametrize("counts,want", [(TEST_MATRIX, TEST_REPORT), (TRAIN_MATRIX, TRAIN_REPORT)])
def test_published_report(spark, counts, want):
    got = {r[0]: tuple(r)[1:] for r in ev.report(matrix_of(spark, LABELS, counts)).collect()}
    assert got.keys() == want.keys()
    for label, values in want.items():
        assert got[label] == pytest.approx(values), label


def test_normalised(spark):
    labels = ["0", "1", "2"]
    counts = [[10, 2, 1], [1, 15, 3], [2, 1, 12]]
    shares = ev.normalize_matrix(matrix_of(spark, labels, counts)).collect()
    for r in shares:
        assert r["share"] == pytest.approx(r["n"] / sum(counts[int(r["true_label"])]))
    empty = ev.normalize_matrix(matrix_of(spark, ["a", "b"], [[0, 0], [1, 1]])).where("true_label = 'a'")
    assert {r["share"] for r in empty.collect()} == {None}


def test_degradation(spark):
    base = spark.createDataFrame([(0.80,)], "f1_macro double")
    down = ev.degradation(base, 0.84).first()
    assert down["f1_degradation"] and down["f1_difference"] == pytest.approx(-0.04)
    assert down["f1_degradation_pct"] == pytest.approx(-0.04 / 0.84 * 100)
    assert not ev.degradation(base, 0.8).first()["f1_degradation"]
    assert ev.degradation(base, 0.0).first()["f1_degradation_pct"] == 0.0


def test_alert_boundaries(spark):
    rows = [(0, 0.8, 0.8), (1, 1.0, 0.96), (2, 1.0, 0.95), (3, 1.0, 0.94), (4, 0.8, 0.9), (5, 0.0, 0.0)]
    df = spark.createDataFrame(rows, "run int, base double, cur double")
    alerts = ev.performance_alert(df, "base", "cur")
    # 1 - 0.95 is a little above 0.05 in binary, so the exact boundary is set apart
    assert [r["run"] for r in alerts.where("alert").collect()] in ([3], [2, 3])
    assert [r["run"] for r in ev.performance_alert(df, "base", "cur", 5.1).where("alert").collect()] == [3]
    summary = ev.alert_summary(alerts.where("run in (1, 3)")).first()
    assert (summary["total_runs"], summary["alerts"]) == (2, 1)
    assert summary["max_drop_pct"] == pytest.approx(6) and summary["min_drop_pct"] == pytest.approx(4)


def test_compare_metrics(spark):
    schema = "metric string, value double"
    cur = spark.createDataFrame([("a", 0.5), ("b", 0.7), ("c", 0.1)], schema)
    ref = spark.createDataFrame([("a", 0.5 + 1e-7), ("b", 0.8), ("x", 1.0)], schema)
    got = {r["metric"]: r["status"] for r in ev.compare_metrics(cur, ref).collect()}
    assert got == {"a": "match", "b": "mismatch", "c": "missing"}
    verdict = ev.comparison_verdict(ev.compare_metrics(cur.where("metric <> 'b'"), ref)).first()
    assert verdict["matches"] and not verdict["all_match"]
    verdict = ev.comparison_verdict(ev.compare_metrics(cur.where("metric = 'a'"), ref)).first()
    assert verdict["matches"] and verdict["all_match"]


def test_compare_predictions(frame):
    a = frame("pred int", p=list(range(20)))
    b = frame("pred int", p=[0, 1, 9, *range(3, 20)])
    got = ev.compare_predictions(a, b, ["id"], "pred").orderBy("id").collect()
    assert [r["same"] for r in got] == [True, True, False] + [True] * 7


def test_groups_share_one_pass(frame):
    df = frame("g string, t int, p int", g=["a", "a", "b", "b"], t=[0, 1, 0, 1], p=[0, 1, 1, 1])
    got = {r["g"]: r["accuracy"] for r in ev.metrics(ev.pair_counts(df, "t", "p", ["g"]), ["g"]).collect()}
    assert got == {"a": 1.0, "b": 0.5}
