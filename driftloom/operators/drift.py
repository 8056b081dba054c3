"""Drift between a reference and a production table, column by column.

One aggregate pass profiles both sides (count, mean, population std, min, max);
its scalars fix the bins of the second pass, whose counts per (feature, side,
bin) are combined map-side. PSI and binned JS never shuffle rows. KS shuffles
at most the distinct values of those value ranges in which the largest gap can
lie.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml.feature import Bucketizer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.binning import unit_bin
from ..functions.columns import (
    as_number,
    chunks,
    col,
    local_frame,
    require_columns,
    resolve_numeric,
    union_all,
)
from ..functions.pvalue import ks_pvalue
from .profile import per_column

METHODS = ("psi", "ks", "js")
DEFAULT_THRESHOLD = 0.25
DEFAULT_BINS = 10
EMPTY_BIN_SHARE = 0.0001  # stands in for a zero share in PSI

# Up to so many features get an aggregate of their own; more are unpivoted to
# (feature, value) rows, which keeps the generated code small and needs one pass.
WIDE_FEATURES = 8

KS_DIRECT_ROWS = 5_000_000  # rows per feature that one window task may rank
KS_BUCKET_ROWS = 1_000_000
KS_MAX_BUCKETS = 2_000  # of a feature
KS_ALL_BUCKETS = 100_000  # of all features together; these reach the driver

PROFILE_SCHEMA = (
    "feature string, reference_n long, production_n long, reference_mean double, "
    "production_mean double, reference_std double, production_std double, "
    "reference_min double, production_min double, reference_max double, production_max double"
)


@dataclass
class FeatureProfile:
    """Scalars of one feature on both sides; indexes 0 reference, 1 production."""

    n: tuple[int, int]
    mean: tuple[float | None, float | None]
    std: tuple[float | None, float | None]
    low: tuple[float | None, float | None]
    high: tuple[float | None, float | None]

    @property
    def span(self) -> tuple[float, float] | None:
        """Joint [min, max], or None when nothing varies."""
        lows = [v for v in self.low if v is not None]
        highs = [v for v in self.high if v is not None]
        if not lows or min(lows) == max(highs):
            return None
        return min(lows), max(highs)


def _check(reference, production, columns, method):
    if method not in METHODS:
        raise ValueError(f"method '{method}' is not supported, use one of {METHODS}")
    if reference is None:
        raise ValueError("reference data must be set first")
    columns = resolve_numeric(reference, columns)
    require_columns(production, columns)
    return columns


def reference_profile(
    df: DataFrame, columns: Sequence[str] | None = None, exclude: Sequence[str] = ()
) -> DataFrame:
    """Mean, population std, min and max per feature."""
    columns = resolve_numeric(df, columns, exclude)

    def measures(c: str) -> dict[str, Column]:
        x = as_number(df, c)
        return {
            "n": F.count(x),
            "mean": F.avg(x),
            "std": F.stddev_pop(x),
            "min": F.min(x),
            "max": F.max(x),
        }

    return per_column(df, columns, measures, name="feature")


VALUES = "__values"


def _both(reference: DataFrame, production: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows (__side, __values): one array entry per feature, NaN as null."""

    def side(df: DataFrame, flag: int) -> DataFrame:
        values = F.array(*[as_number(df, c) for c in columns])
        return df.select(F.lit(flag).alias("__side"), values.alias(VALUES))

    return side(reference, 0).unionAll(side(production, 1))


def _both_transformed(reference: DataFrame, production: DataFrame, model) -> DataFrame:
    """The same rows from the output vector of a fitted preprocessor."""
    from .features import FEATURES

    def side(df: DataFrame, flag: int) -> DataFrame:
        values = F.transform(vector_to_array(FEATURES), lambda v: F.when(~F.isnan(v), v))
        return model.transform(df).select(F.lit(flag).alias("__side"), values.alias(VALUES))

    return side(reference, 0).unionAll(side(production, 1))


def _tall(both: DataFrame) -> DataFrame:
    """Rows (__side, f, value) of the known values; f is the feature number."""
    tall = both.select("__side", F.posexplode(VALUES).alias("f", "value"))
    return tall.where(F.col("value").isNotNull())


_PROFILE = {
    "n": F.count,
    "mean": F.avg,
    "std": F.stddev_pop,
    "low": F.min,
    "high": F.max,
}


def profile_sides(both: DataFrame, columns: Sequence[str]) -> dict[str, FeatureProfile]:
    """Five scalars per feature and side come back to the driver."""
    found: dict[tuple[int, int], dict] = {}
    if len(columns) <= WIDE_FEATURES:
        aggs = [
            fn(F.col(VALUES)[i]).alias(f"{m}{i}")
            for i in range(len(columns))
            for m, fn in _PROFILE.items()
        ]
        for r in both.groupBy("__side").agg(*aggs).collect():
            for i in range(len(columns)):
                found[i, r["__side"]] = {m: r[f"{m}{i}"] for m in _PROFILE}
    else:
        aggs = [fn("value").alias(m) for m, fn in _PROFILE.items()]
        for r in _tall(both).groupBy("__side", "f").agg(*aggs).collect():
            found[r["f"], r["__side"]] = r.asDict()

    def both_sides(i: int, m: str, empty=None) -> tuple:
        return tuple(found.get((i, side), {}).get(m, empty) for side in (0, 1))

    return {
        c: FeatureProfile(both_sides(i, "n", 0), *[both_sides(i, m) for m in list(_PROFILE)[1:]])
        for i, c in enumerate(columns)
    }


def _profile_frame(spark, profiles: dict[str, FeatureProfile]) -> DataFrame:
    rows = [
        (c, *p.n, *p.mean, *p.std, *p.low, *p.high)
        for c, p in profiles.items()
    ]
    return local_frame(spark, rows, PROFILE_SCHEMA)


def _shares(both: DataFrame, profiles: dict[str, FeatureProfile], bins: int) -> DataFrame:
    """(feature, e, a): shares of reference and production per bin, full grid."""
    # a feature that is constant, or unknown on one side, has no bins
    spans = {i: (c, p) for i, (c, p) in enumerate(profiles.items()) if p.span is not None and min(p.n) > 0}
    grid = local_frame(
        both.sparkSession,
        [(c, i, b, *p.n) for i, (c, p) in spans.items() for b in range(bins)],
        "feature string, f int, bin int, n_ref long, n_prod long",
    )
    if not spans:
        return grid.select("feature", F.lit(0.0).alias("e"), F.lit(0.0).alias("a"))
    if len(spans) <= WIDE_FEATURES:
        cells = []
        for i, (_, p) in spans.items():
            lo, hi = p.span
            share = (F.col(VALUES)[i] - F.lit(lo)) / F.lit(hi - lo)
            cells.append(F.struct(F.lit(i).alias("f"), unit_bin(share, bins).alias("bin")))
        binned = both.select("__side", F.inline(F.array(*cells)))
    else:
        table = local_frame(
            both.sparkSession,
            [(i, p.span[0], p.span[1] - p.span[0]) for i, (_, p) in spans.items()],
            "f int, lo double, width double",
        )
        share = (F.col("value") - F.col("lo")) / F.col("width")
        # one row per feature is broadcast
        binned = (
            _tall(both)
            .join(F.broadcast(table), "f")
            .select("__side", "f", unit_bin(share, bins).alias("bin"))
        )
    counts = (
        binned.where(F.col("bin").isNotNull())
        .groupBy("f", "bin")
        .agg(F.count_if(F.col("__side") == 0).alias("r"), F.count_if(F.col("__side") == 1).alias("p"))
    )
    # features x bins rows on both sides of the join
    full = grid.join(F.broadcast(counts), ["f", "bin"], "left")
    return full.select(
        "feature",
        (F.coalesce("r", F.lit(0)) / F.col("n_ref")).alias("e"),
        (F.coalesce("p", F.lit(0)) / F.col("n_prod")).alias("a"),
    )


def _psi(shares: DataFrame) -> DataFrame:
    def filled(c: str) -> Column:
        return F.when(F.col(c) == 0, EMPTY_BIN_SHARE).otherwise(F.col(c))

    e, a = filled("e"), filled("a")
    return shares.groupBy("feature").agg(F.sum((a - e) * F.ln(a / e)).alias("score"))


def _relative_entropy(x: Column, y: Column) -> Column:
    return F.when(x > 0, x * F.ln(x / y)).otherwise(F.lit(0.0))


def _js(shares: DataFrame) -> DataFrame:
    m = (F.col("e") + F.col("a")) / 2
    total = F.sum(_relative_entropy(F.col("e"), m) + _relative_entropy(F.col("a"), m))
    return shares.groupBy("feature").agg(
        F.sqrt(F.greatest(total, F.lit(0.0)) / 2).alias("score")
    )


# --- Kolmogorov-Smirnov -----------------------------------------------------


def ks_statistic(
    reference: DataFrame,
    production: DataFrame,
    columns: Sequence[str] | None = None,
    direct_rows: int = KS_DIRECT_ROWS,
    bucket_rows: int = KS_BUCKET_ROWS,
    law: str = "auto",
) -> DataFrame:
    """(feature, d, n_ref, n_prod, p_value): the largest gap of the two ECDFs.

    ``law`` of the p-value: "exact", "limit", or "auto", exact up to 10 000 rows per side.
    """
    columns = _check(reference, production, columns, "ks")
    both = _both(reference, production, columns)
    return _ks(both, profile_sides(both, columns), direct_rows, bucket_rows, law)


def _ks(both, profiles, direct_rows=KS_DIRECT_ROWS, bucket_rows=KS_BUCKET_ROWS, law="auto") -> DataFrame:
    sizes = local_frame(
        both.sparkSession,
        [(c, i, *p.n) for i, (c, p) in enumerate(profiles.items())],
        "feature string, f int, n_ref long, n_prod long",
    )
    usable = [(i, p.n) for i, p in enumerate(profiles.values()) if min(p.n) > 0]
    small = [i for i, n in usable if sum(n) <= direct_rows]
    gaps = [_ks_direct(both, small, sizes)] if small else []
    large = [(i, n) for i, n in usable if sum(n) > direct_rows]
    gaps += [_ks_bucketed(both, large, bucket_rows)] if large else []
    # one row per feature comes back; the p-value is a function of scalars
    d = {r["f"]: r["d"] for r in union_all(gaps).collect()} if gaps else {}
    rows = [
        (c, *p.n, d.get(i), ks_pvalue(d.get(i), *p.n, law)) for i, (c, p) in enumerate(profiles.items())
    ]
    return local_frame(
        both.sparkSession,
        rows,
        "feature string, n_ref long, n_prod long, d double, p_value double",
    )


def _ks_direct(both: DataFrame, numbers: Sequence[int], sizes: DataFrame) -> DataFrame:
    """One window partition per feature, over its distinct values."""
    r_rows, p_rows = F.count_if(F.col("__side") == 0), F.count_if(F.col("__side") == 1)
    tall = _tall(both).where(F.col("f").isin(list(numbers)))
    # equal values are combined map-side before the shuffle
    counted = tall.groupBy("f", "value").agg(r_rows.alias("r"), p_rows.alias("p"))
    w = Window.partitionBy("f").orderBy("value")
    running = counted.select("f", F.sum("r").over(w).alias("r"), F.sum("p").over(w).alias("p"))
    gap = F.abs(F.col("r") / F.col("n_ref") - F.col("p") / F.col("n_prod"))
    joined = running.join(F.broadcast(sizes), "f")  # one row per feature
    return joined.groupBy("f").agg(F.max(gap).alias("d"))


def _ks_bucketed(both: DataFrame, large: Sequence[tuple[int, tuple[int, int]]], bucket_rows: int) -> DataFrame:
    """Exact D of large features, all of them in the same few passes: (f, d).

    Each column is cut into buckets of about equal mass. Counts per bucket give
    the gap at every bucket edge and, for each bucket, a bound on the gap
    inside it. Only buckets whose bound exceeds the best edge gap are looked
    into; a bucket of many rows is cut again at its own quantiles, with the same bound, so
    that one task ranks about ``bucket_rows`` rows.
    """
    spark = both.sparkSession
    sizes = dict(large)
    most = max(2, min(KS_MAX_BUCKETS, KS_ALL_BUCKETS // len(large)))
    wanted = min(most, max(2, max(map(sum, sizes.values())) // bucket_rows))
    probs = [i / wanted for i in range(1, wanted)]
    digests = _tall(both).where(F.col("f").isin(list(sizes))).groupBy("f")
    found = dict(digests.agg(F.percentile_approx("value", probs, max(1000, 4 * wanted))).collect())
    numbers = list(sizes)
    cells = both.select("__side", *[F.col(VALUES)[i].alias(f"v{i}") for i in numbers])
    bucketizer = Bucketizer(
        splitsArray=[[float("-inf"), *sorted(set(map(float, found[i]))), float("inf")] for i in numbers],
        inputCols=[f"v{i}" for i in numbers],
        outputCols=[f"b{i}" for i in numbers],
        handleInvalid="keep",  # nulls; they are left out below
    )
    per_feature = F.array(
        *[F.struct(F.lit(i).alias("f"), F.col(f"v{i}").alias("value"), F.col(f"b{i}").alias("bucket")) for i in numbers]
    )
    tall = bucketizer.transform(cells).select("__side", F.inline(per_feature)).where(F.col("value").isNotNull())

    r_rows, p_rows = F.count_if(F.col("__side") == 0), F.count_if(F.col("__side") == 1)
    buckets = (
        tall.groupBy("f", "bucket")
        .agg(r_rows.alias("r"), p_rows.alias("p"), F.min("value").alias("lo"), F.max("value").alias("hi"))
        .orderBy("f", "bucket")
        .collect()  # at most KS_ALL_BUCKETS rows
    )
    best, seen, bounds = dict.fromkeys(numbers, 0.0), dict.fromkeys(numbers, (0, 0)), []
    for b in buckets:
        f, before, n = b["f"], seen[b["f"]], sizes[b["f"]]
        past = (before[0] + b["r"], before[1] + b["p"])
        best[f] = max(best[f], abs(past[0] / n[0] - past[1] / n[1]))
        bound = max(past[0] / n[0] - before[1] / n[1], past[1] / n[1] - before[0] / n[0])
        cuts = max(1, (b["r"] + b["p"]) // bucket_rows) if b["hi"] > b["lo"] else 1
        bounds.append(((f, b["bucket"], *before, *n, cuts), bound))
        seen[f] = past
    open_ = [(*row, best[row[0]]) for row, bound in bounds if bound > best[row[0]]]
    edge = local_frame(spark, list(best.items()), "f int, d double")
    if not open_:
        return edge
    starts = local_frame(
        spark, open_, "f int, bucket double, r0 long, p0 long, n_ref long, n_prod long, cuts long, best double"
    )
    group = ["f", "bucket", "cut"]
    inside = tall.join(starts, ["f", "bucket"])
    finest = max(row[-2] for row in open_)
    if finest > 1:
        inner = [i / finest for i in range(1, finest)]
        again = inside.where("cuts > 1").groupBy("f", "bucket").agg(F.percentile_approx("value", inner, max(1000, 4 * finest)).alias("splits"))
        inside = inside.join(again, ["f", "bucket"], "left")
        inside = inside.withColumn("cut", F.coalesce(F.size(F.filter("splits", lambda s: s < F.col("value"))), F.lit(0))).drop("splits")
        w = Window.partitionBy("f", "bucket").orderBy("cut")
        edges = (
            inside.groupBy(*group, "r0", "p0", "n_ref", "n_prod", "best")
            .agg(r_rows.alias("r"), p_rows.alias("p"))
            .withColumns({"r1": F.col("r0") + F.sum("r").over(w), "p1": F.col("p0") + F.sum("p").over(w)})
            .withColumns({"r0": F.col("r1") - F.col("r"), "p0": F.col("p1") - F.col("p")})
        )
        bound = F.greatest(
            F.col("r1") / F.col("n_ref") - F.col("p0") / F.col("n_prod"),
            F.col("p1") / F.col("n_prod") - F.col("r0") / F.col("n_ref"),
        )
        narrow = edges.where(bound > F.col("best")).select(*group, "r0", "p0")
        inside = inside.drop("r0", "p0").join(narrow, group)
    else:
        inside = inside.withColumn("cut", F.lit(0))

    counted = inside.groupBy(*group, "r0", "p0", "n_ref", "n_prod", "value").agg(r_rows.alias("r"), p_rows.alias("p"))
    w = Window.partitionBy(*group).orderBy("value")
    r = (F.col("r0") + F.sum("r").over(w)) / F.col("n_ref")
    p = (F.col("p0") + F.sum("p").over(w)) / F.col("n_prod")
    gaps = counted.select("f", F.abs(r - p).alias("d"))
    return gaps.unionAll(edge).groupBy("f").agg(F.max("d").alias("d"))


def js_positional(
    reference: DataFrame, production: DataFrame, key: Sequence[str], columns: Sequence[str] | None = None
) -> DataFrame:
    """Jensen-Shannon distance of two value vectors paired by key.

    Each column is scaled to sum 1 on its side and compared value by value, as
    if it were a distribution over the keys; a negative share makes the
    distance infinite. Meant for columns of non-negative weights; use the
    binned ``js`` method of :func:`drift` for samples. Keys that stand on one
    side only, or more than once on a side, fail the job; a column that
    sums to zero on a side has no distance (null).
    """
    key = list(key)
    columns = resolve_numeric(reference, columns, key)
    require_columns(production, [*key, *columns])

    def totals(df: DataFrame) -> tuple[int, dict[str, float]]:
        out: dict[str, float] = {}
        n = 0
        for group in chunks(columns):
            sums = [F.sum(as_number(df, c)).alias(f"t{i}") for i, c in enumerate(group)]
            n, *row = df.agg(F.count(F.lit(1)).alias("n"), *sums).first()
            out.update(zip(group, row))
        return n, out

    (n_ref, t_ref), (n_prod, t_prod) = totals(reference), totals(production)

    def scaled(df: DataFrame, side: str, total: dict) -> DataFrame:
        shares = [F.try_divide(as_number(df, c), F.lit(total[c]).cast("double")).alias(f"__{side}_{c}") for c in columns]
        return df.select(*[col(k) for k in key], *shares)

    # with every key once on both sides, and only then, the join has as many rows as either side
    paired = scaled(reference, "r", t_ref).join(scaled(production, "p", t_prod), key, "full_outer")
    fits = (F.count(F.lit(1)) == n_ref) & F.lit(n_ref == n_prod)
    unmatched = F.raise_error(F.lit("reference and production must hold the same keys, each of them once"))

    def entropy(x: Column, y: Column) -> Column:
        return (
            F.when((x > 0) & (y > 0), x * F.ln(x / y))
            .when((x == 0) & (y >= 0), F.lit(0.0))
            .otherwise(F.lit(float("inf")))
        )

    def measures(c: str) -> dict[str, Column]:
        p, q = col(f"__r_{c}"), col(f"__p_{c}")
        m = (p + q) / 2
        total = F.sum(entropy(p, m) + entropy(q, m))
        score = F.sqrt(F.greatest(total, F.lit(0.0)) / 2) if t_ref[c] and t_prod[c] else F.lit(None).cast("double")
        return {"score": F.when(fits, score).otherwise(unmatched)}

    return per_column(paired, columns, measures, name="feature")


# --- detail, summary, ladder ------------------------------------------------


def drift(
    reference: DataFrame,
    production: DataFrame,
    columns: Sequence[str] | None = None,
    method: str = "psi",
    threshold: float = DEFAULT_THRESHOLD,
    bins: int = DEFAULT_BINS,
    model=None,
    law: str = "auto",
) -> DataFrame:
    """Detail table, one row per feature: score, flag, means and stds.

    ``model`` is an optional fitted preprocessor applied to both sides first. With ``ks``
    the score is 1 - p; with the default threshold that flags p < 0.75, so
    pass a threshold of 0.95 or more to agree with the severity ladder. ``law`` is that of ``ks_statistic``.
    """
    if method not in METHODS:
        raise ValueError(f"method '{method}' is not supported, use one of {METHODS}")
    if reference is None:
        raise ValueError("reference data must be set first")
    if model is not None:
        from .features import transformed_names

        columns = transformed_names(model)
        both = _both_transformed(reference, production, model)
    else:
        columns = _check(reference, production, columns, method)
        both = _both(reference, production, columns)
    profiles = profile_sides(both, columns)
    if method == "ks":
        scores = _ks(both, profiles, law=law).select("feature", (1 - F.col("p_value")).alias("score"))
    else:
        shares = _shares(both, profiles, bins)
        scores = _psi(shares) if method == "psi" else _js(shares)
    base = _profile_frame(reference.sparkSession, profiles)
    # one row per feature on both sides; a constant feature has no bins: score 0
    joined = base.join(F.broadcast(scores), "feature", "left")
    known = (F.col("reference_n") > 0) & (F.col("production_n") > 0)
    score = F.when(known, F.coalesce("score", F.lit(0.0)))
    return joined.select(
        "feature",
        score.alias("drift_score"),
        F.coalesce(score > F.lit(float(threshold)), F.lit(False)).alias("drift_detected"),
        "reference_mean",
        "production_mean",
        "reference_std",
        "production_std",
    )


def drift_summary(detail: DataFrame) -> DataFrame:
    """Largest, mean and smallest score, number and share of flagged features."""
    flagged = F.count_if("drift_detected")
    total = F.count(F.lit(1))
    return detail.agg(
        F.max("drift_score").alias("max_drift_score"),
        F.avg("drift_score").alias("mean_drift_score"),
        F.min("drift_score").alias("min_drift_score"),
        flagged.alias("features_with_drift"),
        total.alias("total_features"),
        (flagged > 0).alias("drift_detected"),
        (F.try_divide(flagged, total) * 100).alias("drift_percentage"),
    )


# Severity ladders, upper limits of none, low and moderate.
LADDERS = {"psi": (0.1, 0.25, 0.5), "js": (0.1, 0.3, 0.5)}
P_LADDER = (0.05, 0.01, 0.001)  # ks: lower limits of the p-value


def severity(method: Column | str, score: Column) -> Column:
    """none, low, moderate or high; ``unknown`` for another method."""
    m = F.lit(method) if isinstance(method, str) else method

    def ladder(limits) -> Column:
        return (
            F.when(score < limits[0], "none")
            .when(score < limits[1], "low")
            .when(score < limits[2], "moderate")
            .otherwise("high")
        )

    p = F.lit(1.0) - score
    by_p = (
        F.when(p >= P_LADDER[0], "none")
        .when(p >= P_LADDER[1], "low")
        .when(p >= P_LADDER[2], "moderate")
        .otherwise("high")
    )
    return (
        F.when(m == "psi", ladder(LADDERS["psi"]))
        .when(m == "ks", by_p)
        .when(m == "js", ladder(LADDERS["js"]))
        .otherwise("unknown")
    )


def action(level: Column) -> Column:
    return (
        F.when(level == "high", "retrain now and validate before release")
        .when(level == "moderate", "evaluate the model and monitor more often")
        .otherwise("keep monitoring")
    )


def with_severity(detail: DataFrame, method: str, score: str = "drift_score") -> DataFrame:
    level = severity(method, F.col(score))
    return detail.withColumn("severity", level).withColumn("action", action(F.col("severity")))


def top_drift(detail: DataFrame, n: int = 10) -> DataFrame:
    """The n features with the highest score, ties by name."""
    return detail.orderBy(F.desc("drift_score"), "feature").limit(n)
