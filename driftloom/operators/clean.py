"""Cleaning: sequential IQR outlier removal and mean imputation."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import (
    as_number,
    chunks,
    col,
    is_missing,
    local_frame,
    numeric_columns,
    require_columns,
    resolve_numeric,
)
from ..functions.quantiles import EXACT_ROWS, rows_and_quantiles

LOG_SCHEMA = (
    "column string, ordinal int, before long, after long, removed long, lower double, upper double"
)


def iqr_bounds(
    df: DataFrame,
    columns: Sequence[str] | None = None,
    factor: float = 1.5,
    exclude: Sequence[str] = (),
    exact_rows: int = EXACT_ROWS,
) -> list[tuple]:
    """Fences per column, in order: (column, ordinal, before, after, removed, lower, upper).

    The quartiles of a column come from the rows kept by the columns before
    it. Each step aggregates a filtered scan of the columns so far, which also
    counts the rows left by the step before; the fences found are literals, so
    the plan does not grow with the steps and rows are never shuffled.
    """
    if columns is None:
        columns = numeric_columns(df, exclude)
    require_columns(df, columns)
    kept, rows = df, df.count()
    counts, fences = [], []
    for c in columns:
        rows, found = rows_and_quantiles(kept, [c], [0.25, 0.75], rows, exact_rows)
        counts.append(rows)
        q1, q3 = found[c]
        if q1 is None:
            # no value left: nothing can lie inside the fences
            fences.append((None, None))
            kept = kept.where(F.lit(False))
        else:
            lower, upper = q1 - factor * (q3 - q1), q3 + factor * (q3 - q1)
            fences.append((lower, upper))
            kept = kept.where(col(c).between(lower, upper))
    counts.append(kept.count())
    return [
        (c, i, counts[i], counts[i + 1], counts[i] - counts[i + 1], *fences[i])
        for i, c in enumerate(columns)
    ]


def apply_bounds(df: DataFrame, log: Sequence[tuple]) -> DataFrame:
    """Keep the rows inside all fences; rows with a missing value fall out."""
    conds = [
        F.lit(False) if entry[5] is None else col(entry[0]).between(entry[5], entry[6])
        for entry in log
    ]
    return df.where(reduce(lambda a, b: a & b, conds)) if conds else df


def remove_outliers_iqr(
    df: DataFrame,
    columns: Sequence[str] | None = None,
    factor: float = 1.5,
    exclude: Sequence[str] = (),
    exact_rows: int = EXACT_ROWS,
) -> tuple[DataFrame, DataFrame]:
    """The cleaned table and its log, one row per processed column."""
    log = iqr_bounds(df, columns, factor, exclude, exact_rows)
    return apply_bounds(df, log), local_frame(df.sparkSession, log, LOG_SCHEMA)


def column_means(df: DataFrame, columns: Sequence[str]) -> dict[str, float | None]:
    out: dict[str, float | None] = {}
    for group in chunks(columns):
        row = df.agg(*[F.avg(as_number(df, c)).alias(f"m{i}") for i, c in enumerate(group)]).first()
        out.update(zip(group, row))
    return out


def impute_mean(
    df: DataFrame, columns: Sequence[str] | None = None, exclude: Sequence[str] = ()
) -> DataFrame:
    """Replace NaN and NULL by the mean of the column in the same table."""
    columns = resolve_numeric(df, columns, exclude)
    means = column_means(df, columns)
    return df.select(
        *[
            F.when(is_missing(df, c), F.lit(means[c]).cast("double"))
            .otherwise(col(c).cast("double"))
            .alias(c)
            if c in means
            else col(c)
            for c in df.columns
        ]
    )
