"""Profiling: descriptive statistics, missing share, plot data."""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.binning import span_bin, span_edges
from ..functions.columns import (
    as_number,
    chunks,
    col,
    is_missing,
    local_frame,
    resolve_categorical,
    resolve_numeric,
    union_all,
)
from ..functions.quantiles import EXACT_ROWS, quantiles

# Row labels of the statistics tables.
STAT_LABELS = {
    "mean": "Media",
    "std": "Desviacion estandar",
    "min": "Min",
    "25%": "Cuartil 25%",
    "50%": "Mediana/Cuartil 50%",
    "75%": "Cuartil 75%",
    "max": "Max",
}
CARDINALITY_LABEL = "Cardinalidad"
MODE_LABEL = "Moda"

PAIRS_PER_AGG = 300
WIDE_CORRELATION = 60  # the pairs of more columns than this come from moment matrices of whole batches


def per_column(
    df: DataFrame, columns: Sequence[str], measures, name: str = "column"
) -> DataFrame:
    """One row per column from one wide aggregate per group of columns.

    ``measures`` maps a column name to named aggregate expressions. Nothing but
    one partial row per task is shuffled.
    """
    frames = []
    for group in chunks(columns):
        aggs, cells = [], []
        for i, c in enumerate(group):
            named = measures(c)
            aggs += [expr.alias(f"{m}_{i}") for m, expr in named.items()]
            cells.append(
                F.struct(F.lit(c).alias(name), *[F.col(f"{m}_{i}").alias(m) for m in named])
            )
        frames.append(df.agg(*aggs).select(F.inline(F.array(*cells))))
    return union_all(frames)


def quantile_table(
    df: DataFrame,
    columns: Sequence[str] | None = None,
    probs: Sequence[float] = (0.25, 0.5, 0.75),
    exclude: Sequence[str] = (),
    exact: bool = True,
    exact_rows: int = EXACT_ROWS,
) -> DataFrame:
    """Linear-interpolation quantiles as rows (column, prob, value)."""
    columns = resolve_numeric(df, columns, exclude)
    if exact:
        found = quantiles(df, columns, probs, exact_rows=exact_rows)
        rows = [(c, float(p), v) for c in columns for p, v in zip(probs, found[c])]
        return local_frame(df.sparkSession, rows, "column string, prob double, value double")
    table = per_column(
        df,
        columns,
        lambda c: {"values": F.percentile_approx(as_number(df, c), list(probs), 10_000)},
    )
    pairs = F.arrays_zip(F.array(*[F.lit(float(p)) for p in probs]).alias("prob"), F.col("values").alias("value"))
    return table.select("column", F.inline(pairs).alias("prob", "value"))


def stats_numeric(
    df: DataFrame,
    columns: Sequence[str] | None = None,
    exclude: Sequence[str] = (),
    exact_rows: int = EXACT_ROWS,
) -> DataFrame:
    """Mean, sample std, min, quartiles, max: rows (column, statistic, value)."""
    columns = resolve_numeric(df, columns, exclude)
    probs = [0.25, 0.5, 0.75]
    rows = df.count()
    known = None if rows <= exact_rows else quantiles(df, columns, probs, rows, exact_rows)

    def measures(c: str) -> dict[str, Column]:
        x = as_number(df, c)
        if known is None:
            q = F.percentile(x, probs)
        else:
            q = F.any_value(F.array(*[F.lit(v).cast("double") for v in known[c]]))
        return {"mean": F.avg(x), "std": F.stddev_samp(x), "min": F.min(x), "q": q, "max": F.max(x)}

    wide = per_column(df, columns, measures)
    parts = {
        "mean": F.col("mean"),
        "std": F.col("std"),
        "min": F.col("min"),
        "25%": F.col("q")[0],
        "50%": F.col("q")[1],
        "75%": F.col("q")[2],
        "max": F.col("max"),
    }
    cells = [F.struct(F.lit(STAT_LABELS[k]).alias("statistic"), v.alias("value")) for k, v in parts.items()]
    return wide.select("column", F.inline(F.array(*cells)))


def category_counts(
    df: DataFrame, columns: Sequence[str] | None = None, exclude: Sequence[str] = ()
) -> DataFrame:
    """Frequency of every category: rows (column, category, n); nulls not counted."""
    columns = resolve_categorical(df, columns, exclude)
    tall = df.select(*[col(c).cast("string").alias(c) for c in columns]).unpivot(
        [], [col(c) for c in columns], "column", "category"
    )
    # counts are combined map-side, so a hot category costs one row per task
    return (
        tall.where(F.col("category").isNotNull())
        .groupBy("column", "category")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def stats_categorical(
    df: DataFrame, columns: Sequence[str] | None = None, exclude: Sequence[str] = ()
) -> DataFrame:
    """Cardinality and mode: rows (column, statistic, value as text).

    On a tie the smallest value is the mode.
    """
    columns = resolve_categorical(df, columns, exclude)
    counts = category_counts(df, columns)
    best = counts.groupBy("column").agg(
        F.count(F.lit(1)).alias("unique"),
        F.min(F.struct((-F.col("n")).alias("rank"), F.col("category"))).alias("top"),
    )
    listed = local_frame(df.sparkSession, [(c,) for c in columns], "column string")
    full = listed.join(F.broadcast(best), "column", "left")  # one row per column
    cells = [
        F.struct(
            F.lit(CARDINALITY_LABEL).alias("statistic"),
            F.coalesce(F.col("unique"), F.lit(0)).cast("string").alias("value"),
        ),
        F.struct(F.lit(MODE_LABEL).alias("statistic"), F.col("top.category").alias("value")),
    ]
    return full.select("column", F.inline(F.array(*cells)))


def missing_percentage(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Share of NaN or NULL per column in percent: rows (column, missing_pct)."""
    columns = list(columns or df.columns)
    return per_column(
        df,
        columns,
        lambda c: {"missing_pct": F.avg(F.when(is_missing(df, c), 1.0).otherwise(0.0)) * 100},
    )


def missing_total(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Sum of the missing percentages over the columns."""
    return missing_percentage(df, columns).agg(F.sum("missing_pct").alias("total_missing_pct"))


def correlation(
    df: DataFrame, columns: Sequence[str] | None = None, exclude: Sequence[str] = ()
) -> DataFrame:
    """Pearson correlation over the rows where both values are known.

    Long form (column_a, column_b, corr), both directions and the diagonal. A
    column that does not vary over those rows has no correlation: null, on the
    diagonal too, whatever the number of columns.
    """
    columns = resolve_numeric(df, columns, exclude)
    if len(columns) > WIDE_CORRELATION:
        return _correlation_of_moments(df, columns)
    pairs = [(a, b) for i, a in enumerate(columns) for b in columns[i:]]
    frames = []
    for group in chunks(pairs, PAIRS_PER_AGG):
        aggs, cells = [], []
        for i, (a, b) in enumerate(group):
            x, y = as_number(df, a), as_number(df, b)
            known = x.isNotNull() & y.isNotNull()
            x, y = F.when(known, x), F.when(known, y)
            spread = F.stddev_pop(x) * F.stddev_pop(y)
            aggs.append(F.try_divide(F.covar_pop(x, y), spread).alias(f"r{i}"))
            for left, right in dict.fromkeys([(a, b), (b, a)]):
                cells.append(
                    F.struct(
                        F.lit(left).alias("column_a"),
                        F.lit(right).alias("column_b"),
                        F.col(f"r{i}").alias("corr"),
                    )
                )
        frames.append(df.agg(*aggs).select(F.inline(F.array(*cells))))
    out = union_all(frames)
    within = F.greatest(F.lit(-1.0), F.least(F.lit(1.0), F.col("corr")))  # these pass over nulls
    return out.withColumn("corr", F.when(F.col("corr").isNotNull() & ~F.isnan("corr"), within))


_MOMENTS = ("n", "sx", "sy", "sxx", "syy", "sxy")
_NO_SPREAD = 1e-12  # of the squares; what is left of a sum that cancels out


def _matrix_of(k: int):
    """The arrays of a batch as a matrix of k columns; what is missing is NaN. An inner function, which travels to the tasks by value."""

    def matrix(batch: pa.RecordBatch) -> np.ndarray:
        return batch.column(0).flatten().to_numpy(zero_copy_only=False).astype(np.float64, copy=False).reshape(-1, k)

    return matrix


def _fact_rows(k: int):
    """Count, sum, least and largest known value per column over the rows of a task."""
    matrix = _matrix_of(k)

    def facts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total, low, high = np.zeros(k), np.zeros(k), np.full(k, np.inf), np.full(k, -np.inf)
        for batch in batches:
            if batch.num_rows:
                x = matrix(batch)
                known = ~np.isnan(x)
                n += known.sum(axis=0)
                total += np.where(known, x, 0.0).sum(axis=0)
                low = np.minimum(low, np.where(known, x, np.inf).min(axis=0))
                high = np.maximum(high, np.where(known, x, -np.inf).max(axis=0))
        kept = np.flatnonzero(n)
        columns = [pa.array(kept.astype(np.int32)), *[pa.array(v[kept]) for v in (n, total, low, high)]]
        yield pa.RecordBatch.from_arrays(columns, ["i", "n", "total", "low", "high"])

    return facts


def _moment_rows(shift: Sequence[float]):
    """Sums over the rows of a task where both columns of a pair are known, by matrix products of whole batches."""
    k = len(shift)
    upper, matrix = np.triu_indices(k), _matrix_of(k)

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = {m: np.zeros((k, k)) for m in _MOMENTS}
        for batch in batches:
            x = matrix(batch) - np.array(shift)
            known = ~np.isnan(x)
            x, mask = np.where(known, x, 0.0), known.astype(np.float64)
            total["n"] += mask.T @ mask
            total["sx"] += x.T @ mask
            total["sxx"] += (x * x).T @ mask
            total["sxy"] += x.T @ x
        total["sy"], total["syy"] = total["sx"].T, total["sxx"].T
        columns = [pa.array(u.astype(np.int32)) for u in upper] + [pa.array(total[m][upper]) for m in _MOMENTS]
        yield pa.RecordBatch.from_arrays(columns, ["a", "b", *_MOMENTS])

    return sums


def _correlation_of_moments(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """All pairs from one pass, missing values or not: each task sends one row per pair.

    Values are shifted by the mean of their column first, so that sums of squares do not cancel out. Means and ranges
    come from batches too: aggregates of so many columns are one method too long for the JVM to compile.
    """
    k = len(columns)
    # NaN counts as missing in the batches. Spark compiles no ``transform``, so the columns do not become one long method either
    numbers = df.select(F.transform(F.array(*[col(c).cast("double") for c in columns]), lambda x: x + F.lit(0.0)).alias("values"))
    facts = numbers.mapInArrow(_fact_rows(k), "i int, n double, total double, low double, high double")
    facts = facts.groupBy("i").agg((F.sum("total") / F.sum("n")).alias("mean"), F.min("low").alias("low"), F.max("high").alias("high"))
    shift = [0.0] * k
    for r in facts.collect():
        # a column that never varies is shifted by its value: nothing but zeros is left
        shift[r["i"]] = r["low"] if r["low"] == r["high"] else r["mean"]
    rows = numbers.mapInArrow(_moment_rows(shift), "a int, b int, " + ", ".join(f"{m} double" for m in _MOMENTS))
    summed = rows.groupBy("a", "b").agg(*[F.sum(m).alias(m) for m in _MOMENTS])

    def spread(square: str, plain: str) -> Column:
        left = F.col(square) - F.try_divide(F.col(plain) * F.col(plain), F.col("n"))
        return F.when(left > F.col(square) * _NO_SPREAD, left)

    shared = F.col("sxy") - F.try_divide(F.col("sx") * F.col("sy"), F.col("n"))
    corr = shared / (F.sqrt(spread("sxx", "sx")) * F.sqrt(spread("syy", "sy")))
    within = F.greatest(F.lit(-1.0), F.least(F.lit(1.0), corr))
    found = summed.select("a", "b", F.when(corr.isNotNull() & ~F.isnan(corr), within).alias("corr"))
    names = F.array(*[F.lit(c) for c in columns])
    sides = [F.struct(F.get(names, x).alias("column_a"), F.get(names, y).alias("column_b"), F.col("corr")) for x, y in ((F.col("a"), F.col("b")), (F.col("b"), F.col("a")))]
    # the diagonal has one direction only
    both = F.when(F.col("a") == F.col("b"), F.array(sides[0])).otherwise(F.array(*sides))
    return found.select(F.inline(both))


def _ranges(df: DataFrame, columns: Sequence[str]) -> dict[str, tuple[int, float, float]]:
    rows = per_column(
        df,
        columns,
        lambda c: {
            "n": F.count(as_number(df, c)),
            "lo": F.min(as_number(df, c)),
            "hi": F.max(as_number(df, c)),
        },
    ).collect()
    return {r["column"]: (r["n"], r["lo"], r["hi"]) for r in rows}


def histogram(
    df: DataFrame,
    columns: Sequence[str] | None = None,
    bins: int = 50,
    exclude: Sequence[str] = (),
) -> DataFrame:
    """Equal-width counts: rows (column, bin, bin_left, bin_right, n).

    Missing values are left out, the last bin is closed, empty bins are listed.
    """
    columns = resolve_numeric(df, columns, exclude)
    ranges = _ranges(df, columns)
    bounds, numbered = {}, []
    for c in columns:
        n, lo, hi = ranges[c]
        if n == 0:
            continue
        if lo == hi:
            lo, hi = lo - 0.5, hi + 0.5
        bounds[c] = span_edges(lo, hi, bins)
        numbered.append(span_bin(as_number(df, c), lo, hi, bins).alias(c))
    grid = [(c, b, e[b], e[b + 1]) for c, e in bounds.items() for b in range(bins)]
    listed = local_frame(
        df.sparkSession, grid, "column string, bin int, bin_left double, bin_right double"
    )
    if not numbered:
        return listed.withColumn("n", F.lit(0).cast("long"))
    counts = (
        df.select(*numbered)
        .unpivot([], [col(c) for c in bounds], "column", "bin")
        .where(F.col("bin").isNotNull())
        .groupBy("column", "bin")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    # at most columns x bins rows on either side
    return listed.join(F.broadcast(counts), ["column", "bin"], "left").withColumn(
        "n", F.coalesce(F.col("n"), F.lit(0)).cast("long")
    )


KDE_BLOCK = 10  # grid points summed per row and block
KDE_DISTINCT = 10_000  # up to about so many different values are counted before they are spread over the grid
KDE_REACH = 39.0  # bandwidths beyond which exp(-z * z / 2) is 0.0 in double precision


def kde_curve(df: DataFrame, column: str, points: int = 200) -> DataFrame:
    """Gaussian density estimate on a grid from min to max: (point, x, density).

    Bandwidth is Scott's rule, n^(-1/5) times the sample std. A value adds to
    the blocks of the grid within its reach; beyond, its terms are exactly 0.
    Sums are combined map-side: one row per block and task is shuffled. Equal values are counted together
    first where a column has few of them, which at most shuffles that many rows per task.
    """
    x = as_number(df, column)
    n, lo, hi, std, kinds = df.agg(F.count(x), F.min(x), F.max(x), F.stddev_samp(x), F.approx_count_distinct(x)).first()
    schema = "point int, x double, density double"
    if n < 2 or not std:
        return local_frame(df.sparkSession, [], schema)
    width = std * n ** (-0.2)
    step = (hi - lo) / (points - 1)
    scale = 1.0 / (n * width * math.sqrt(2 * math.pi))
    last = math.ceil(points / KDE_BLOCK) - 1
    reach = KDE_REACH * width

    def block_of(value: Column) -> Column:
        block = F.floor((value - F.lit(lo)) / F.lit(step * KDE_BLOCK))
        return F.greatest(F.lit(0), F.least(F.lit(last), block)).cast("int")

    first, final = block_of(F.col("v") - F.lit(reach)), block_of(F.col("v") + F.lit(reach))
    rows = df.select(x.alias("v"), F.lit(1).cast("long").alias("times")).where(F.col("v").isNotNull())
    if kinds <= KDE_DISTINCT:
        rows = rows.groupBy("v").agg(F.count(F.lit(1)).alias("times"))
    aggs, cells = [], []
    for j in range(KDE_BLOCK):
        point = F.col("block") * KDE_BLOCK + j
        at = point * F.lit(step) + F.lit(lo)
        z = (F.col("v") - at) / F.lit(width)
        aggs.append(F.sum(F.col("times") * F.exp(F.lit(-0.5) * z * z)).alias(f"k{j}"))
        cells.append(
            F.struct(
                point.cast("int").alias("point"),
                at.alias("x"),
                (F.col(f"k{j}") * F.lit(scale)).alias("density"),
            )
        )
    summed = rows.select("v", "times", F.explode(F.sequence(first, final)).alias("block")).groupBy("block").agg(*aggs)
    listed = local_frame(df.sparkSession, [(b,) for b in range(last + 1)], "block int")
    # a block that no value reaches has the density 0; a few rows on either side
    full = listed.join(F.broadcast(summed), "block", "left").fillna(0.0, [f"k{j}" for j in range(KDE_BLOCK)])
    return full.select(F.inline(F.array(*cells))).where(F.col("point") < points)


def boxplot_stats(
    df: DataFrame,
    columns: Sequence[str] | None = None,
    exclude: Sequence[str] = (),
    factor: float = 1.5,
    exact_rows: int = EXACT_ROWS,
) -> DataFrame:
    """Quartiles, whiskers and number of points beyond them, per column.

    A whisker ends at the most extreme value inside the fence.
    """
    columns = resolve_numeric(df, columns, exclude)
    fences = _fences(df, columns, factor, exact_rows)

    def measures(c: str) -> dict[str, Column]:
        x = as_number(df, c)
        q1, q2, q3, low, high = (F.lit(v).cast("double") for v in fences[c])
        return {
            "q1": F.any_value(q1),
            "median": F.any_value(q2),
            "q3": F.any_value(q3),
            "whisker_low": F.least(F.min(F.when(x >= low, x)), F.any_value(q1)),
            "whisker_high": F.greatest(F.max(F.when(x <= high, x)), F.any_value(q3)),
            "n_outliers": F.count(F.when((x < low) | (x > high), 1)),
        }

    return per_column(df, columns, measures)


def boxplot_outliers(
    df: DataFrame,
    columns: Sequence[str] | None = None,
    exclude: Sequence[str] = (),
    factor: float = 1.5,
    exact_rows: int = EXACT_ROWS,
) -> DataFrame:
    """All points beyond the whiskers: rows (column, value)."""
    columns = resolve_numeric(df, columns, exclude)
    fences = _fences(df, columns, factor, exact_rows)
    cells = []
    for c in columns:
        x = as_number(df, c)
        low, high = (F.lit(v).cast("double") for v in fences[c][3:])
        cells.append(
            F.struct(F.lit(c).alias("column"), F.when((x < low) | (x > high), x).alias("value"))
        )
    return df.select(F.inline(F.array(*cells))).where(F.col("value").isNotNull())


def _fences(df, columns, factor, exact_rows) -> dict[str, tuple]:
    found = quantiles(df, columns, [0.25, 0.5, 0.75], exact_rows=exact_rows)
    out = {}
    for c, (q1, q2, q3) in found.items():
        if q1 is None:
            out[c] = (None,) * 5
        else:
            out[c] = (q1, q2, q3, q1 - factor * (q3 - q1), q3 + factor * (q3 - q1))
    return out
