"""Profiles of columns that are kept as tables, merged over days, and compared without the rows they came from.

A profile has one row per feature and cell. The cells of a feature grow with the distance from zero, so that
all values of a cell agree to a relative accuracy; a cell holds its count, extremes, and the sums of first and second
powers of the distance to its middle. All of that adds up: the merge of the profiles of parts is the profile of the whole (sums of
doubles up to rounding). A feature has about ln(largest / smallest absolute value) / (2 * accuracy) cells at
most, however many rows it has.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.binning import unit_bin
from ..functions.columns import as_number, resolve_numeric, union_all
from .drift import DEFAULT_BINS, DEFAULT_THRESHOLD, EMPTY_BIN_SHARE

ACCURACY = 0.001
COLUMNS = ("feature", "accuracy", "cell", "n", "low", "high", "s1", "s2")
_LARGEST_LOG = 746.0  # beyond the logarithm of any double, in either direction


def _step(accuracy: float) -> float:
    return math.log1p(accuracy) - math.log1p(-accuracy)


def _offset(accuracy: float) -> int:
    return math.ceil(_LARGEST_LOG / _step(accuracy)) + 1


def _cell(x: Column, accuracy: float) -> Column:
    """Number of a value's cell: 0 for zero, and in the order of the values."""
    k = F.ceil(F.ln(F.abs(x)) / F.lit(_step(accuracy))) + F.lit(_offset(accuracy))
    return F.when(x == 0, F.lit(0)).otherwise(F.signum(x).cast("long") * k).cast("long")


def _middle(cell: Column, accuracy: float) -> Column:
    step, offset = (F.lit(f(accuracy)) for f in (_step, _offset))
    return F.when(cell == 0, F.lit(0.0)).otherwise(F.signum(cell) * F.exp((F.abs(cell) - offset - 0.5) * step))


def stored_profile(df: DataFrame, columns: Sequence[str] | None = None, exclude: Sequence[str] = (), accuracy: float = ACCURACY) -> DataFrame:
    """The profile of a table: rows (feature, accuracy, cell, n, low, high, s1, s2), in one pass combined map-side.

    Missing and infinite values are left out; a feature without any other value has no row.
    """
    if not 0 < accuracy < 0.5:
        raise ValueError("accuracy must lie between 0 and 0.5")
    columns = resolve_numeric(df, columns, exclude)
    pairs = F.array(*[F.struct(F.lit(c).alias("feature"), as_number(df, c).cast("double").alias("x")) for c in columns])
    tall = df.select(F.inline(pairs)).where(F.col("x").isNotNull() & (F.abs("x") < float("inf")))
    placed = tall.withColumn("cell", _cell(F.col("x"), accuracy))
    apart = F.col("x") - _middle(F.col("cell"), accuracy)
    cells = placed.groupBy("feature", "cell").agg(
        F.count("*").alias("n"), F.min("x").alias("low"), F.max("x").alias("high"), F.sum(apart).alias("s1"), F.sum(apart * apart).alias("s2")
    )
    return cells.withColumn("accuracy", F.lit(float(accuracy))).select(*COLUMNS)


def merge_profiles(profiles: Sequence[DataFrame]) -> DataFrame:
    """The profile of all rows that the given ones, of the same accuracy, were made of."""
    rows = union_all([p.select(*COLUMNS) for p in profiles])
    sums = [F.sum(c).alias(c) for c in ("n", "s1", "s2")]
    merged = rows.groupBy("feature", "accuracy", "cell").agg(F.min("low").alias("low"), F.max("high").alias("high"), *sums)
    return merged.select(*COLUMNS)


def save_profile(profile: DataFrame, path: str, part: str) -> None:
    """Keep the profile of one part, such as a day, below ``path``; writing a part again replaces it."""
    if not part or any(c in part for c in "/=\\"):
        raise ValueError(f"'{part}' cannot name a part")
    profile.select(*COLUMNS).coalesce(1).write.mode("overwrite").parquet(f"{path.rstrip('/')}/part={part}")


def load_profile(spark: SparkSession, path: str, first: str | None = None, last: str | None = None) -> DataFrame:
    """The merged profile of the parts from ``first`` to ``last`` (by name, both included), or of all."""
    schema = "feature string, accuracy double, cell long, n long, low double, high double, s1 double, s2 double, part string"
    rows = spark.read.schema(schema).parquet(path)
    if first is not None:
        rows = rows.where(F.col("part") >= first)
    if last is not None:
        rows = rows.where(F.col("part") <= last)
    return merge_profiles([rows])


def _accuracy(*profiles: DataFrame) -> float | None:
    found = union_all([p.select("accuracy") for p in profiles]).distinct().limit(2).collect()
    if len(found) > 1:
        raise ValueError("the profiles differ in accuracy")
    return found[0][0] if found else None


def profile_moments(profile: DataFrame) -> DataFrame:
    """(feature, n, mean, std, min, max), std over the population, from a profile."""
    accuracy = _accuracy(profile) or ACCURACY
    cells = profile.withColumn("c", _middle(F.col("cell"), accuracy))
    mean = F.sum(F.col("n") * F.col("c") + F.col("s1")) / F.sum("n")
    means = cells.groupBy("feature").agg(F.sum("n").alias("total"), mean.alias("mean"), F.min("low").alias("min"), F.max("high").alias("max"))
    shift = F.col("c") - F.col("mean")
    squares = F.sum(F.col("s2") + 2 * shift * F.col("s1") + F.col("n") * shift * shift)
    # one row per feature is joined back to its cells
    one = cells.join(means, "feature").groupBy("feature", "total", "mean", "min", "max")
    std = F.sqrt(F.greatest(squares, F.lit(0.0)) / F.col("total"))
    return one.agg(std.alias("std")).select("feature", F.col("total").alias("n"), "mean", "std", "min", "max")


def profile_quantiles(profile: DataFrame, probabilities: Sequence[float]) -> DataFrame:
    """(feature, p, value): a value within the relative accuracy of the order statistic of rank ceil(p * n), at least 1."""
    accuracy = _accuracy(profile) or ACCURACY
    by_cell = Window.partitionBy("feature").orderBy("cell").rowsBetween(Window.unboundedPreceding, 0)
    ranked = profile.withColumns({"upto": F.sum("n").over(by_cell), "all": F.sum("n").over(Window.partitionBy("feature"))})
    asked = ranked.withColumn("p", F.explode(F.array(*[F.lit(float(p)) for p in probabilities])))
    rank = F.greatest(F.ceil(F.col("p") * F.col("all")), F.lit(1))
    held = asked.where((rank <= F.col("upto")) & (rank > F.col("upto") - F.col("n")))
    value = F.greatest("low", F.least("high", _middle(F.col("cell"), accuracy)))
    return held.select("feature", "p", value.alias("value"))


def _bin_counts(cells: DataFrame, bins: int) -> DataFrame:
    """(feature, bin, sure, maybe, likely) of one side: rows that lie in the bin, rows that may, and a guess by the mean of a cell."""
    at = lambda x: unit_bin((x - F.col("lo")) / (F.col("hi") - F.col("lo")), bins)
    mean = F.greatest("low", F.least("high", F.col("c") + F.col("s1") / F.col("n")))
    spread = cells.select("feature", "n", at(F.col("low")).alias("first"), at(F.col("high")).alias("last"), at(mean).alias("guess"))
    each = spread.select("*", F.explode(F.sequence("first", "last")).alias("bin"))
    return each.groupBy("feature", "bin").agg(
        F.sum(F.when(F.col("first") == F.col("last"), F.col("n")).otherwise(0)).alias("sure"),
        F.sum("n").alias("maybe"),
        F.sum(F.when(F.col("guess") == F.col("bin"), F.col("n")).otherwise(0)).alias("likely"),
    )


def _term(e: Column, a: Column) -> Column:
    return (a - e) * F.ln(a / e)


def drift_of_profiles(reference: DataFrame, production: DataFrame, threshold: float = DEFAULT_THRESHOLD, bins: int = DEFAULT_BINS) -> DataFrame:
    """PSI detail of two profiles, one row per feature of both, without their rows.

    Returns feature, drift_score, score_low, score_high, drift_detected, reference_n, production_n, and means and
    stds of both sides. Bins are those of ``drift``, over the joint range. A cell whose extremes lie in one bin is counted there exactly. One that holds a
    bin's edge leaves its rows unsure: the shares of a bin then lie in an interval, and the PSI that ``drift`` gives for the rows lies between
    score_low and score_high (its terms are convex in both shares, so their largest value is at a corner). drift_score
    puts such a cell where its mean is. Where columns have few values, or none near an edge, all three agree.

    A feature that does not vary scores 0; one with values on one side only has a null score and is not flagged. Shuffled are cells and bins
    alone.
    """
    accuracy = _accuracy(reference, production) or ACCURACY
    sides = [reference, production]
    moments = [
        profile_moments(p).select("feature", *[F.col(c).alias(f"{c}_{k}") for c in ("n", "mean", "std", "min", "max")]) for k, p in zip("ep", sides)
    ]
    both = moments[0].join(moments[1], "feature", "full")
    spans = both.where("n_e is not null and n_p is not null").select(
        "feature", "n_e", "n_p", F.least("min_e", "min_p").alias("lo"), F.greatest("max_e", "max_p").alias("hi")
    ).where("lo < hi")
    grid = spans.select("feature", "n_e", "n_p", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"))
    for k, p in zip("ep", sides):
        cells = p.withColumn("c", _middle(F.col("cell"), accuracy)).join(spans, "feature")
        named = [F.col(c).alias(f"{c}_{k}") for c in ("sure", "maybe", "likely")]
        grid = grid.join(_bin_counts(cells, bins).select("feature", "bin", *named), ["feature", "bin"], "left")

    share = lambda c, k: F.coalesce(f"{c}_{k}", F.lit(0)) / F.col(f"n_{k}")
    filled = lambda x: F.when(x == 0, F.lit(EMPTY_BIN_SHARE)).otherwise(x)
    bounds = {}
    for k in "ep":
        low, high = share("sure", k), share("maybe", k)
        open_ = (low == 0) & (high > 0)  # no row, or one at least
        bounds[f"low_{k}"] = F.when(open_, F.least(1 / F.col(f"n_{k}"), F.lit(EMPTY_BIN_SHARE))).otherwise(filled(low))
        bounds[f"high_{k}"] = F.when(open_, F.greatest(high, F.lit(EMPTY_BIN_SHARE))).otherwise(filled(high))
        bounds[f"at_{k}"] = filled(share("likely", k))
    terms = grid.withColumns(bounds)
    corner = lambda x, y: _term(F.col(f"{x}_e"), F.col(f"{y}_p"))
    most = F.greatest(*[corner(x, y) for x in ("low", "high") for y in ("low", "high")])
    least = (
        F.when(F.col("high_e") < F.col("low_p"), corner("high", "low")).when(F.col("high_p") < F.col("low_e"), corner("low", "high")).otherwise(F.lit(0.0))
    )
    scores = terms.groupBy("feature").agg(F.sum(corner("at", "at")).alias("at"), F.sum(least).alias("least"), F.sum(most).alias("most"))
    known = F.col("n_e").isNotNull() & F.col("n_p").isNotNull()
    score = {name: F.when(known, F.coalesce(c, F.lit(0.0))) for name, c in (("drift_score", "at"), ("score_low", "least"), ("score_high", "most"))}
    return both.join(scores, "feature", "left").select(
        "feature",
        *[c.alias(name) for name, c in score.items()],
        F.coalesce(score["drift_score"] > F.lit(float(threshold)), F.lit(False)).alias("drift_detected"),
        F.coalesce("n_e", F.lit(0)).alias("reference_n"),
        F.coalesce("n_p", F.lit(0)).alias("production_n"),
        F.col("mean_e").alias("reference_mean"),
        F.col("mean_p").alias("production_mean"),
        F.col("std_e").alias("reference_std"),
        F.col("std_p").alias("production_std"),
    )
