"""Row-keyed column perturbations that build robustness test sets."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import as_number, chunks, col, require_columns, resolve_numeric
from ..functions.hashing import choose_columns, normal, scalar_normal
from ..functions.ranks import HOT_ROWS, rank_ranges
from .clean import column_means
from .split import SEED, sample_n


def _replace(df: DataFrame, new: dict[str, Column]) -> DataFrame:
    return df.select(*[new[c].alias(c) if c in new else col(c) for c in df.columns])


def shift(df: DataFrame, column: str, factor: float = 1.2) -> DataFrame:
    """Add ``mean * (factor - 1)`` to every value of a column."""
    require_columns(df, [column])
    mean = column_means(df, [column])[column]
    delta = None if mean is None else mean * (factor - 1)
    return _replace(df, {column: as_number(df, column) + F.lit(delta).cast("double")})


def add_noise(
    df: DataFrame,
    columns: Sequence[str] | None,
    key: Sequence[str],
    mu: float = 0.5,
    sigma: float = 0.2,
    share: float = 0.2,
    seed: int = SEED,
) -> DataFrame:
    """Add N(mu, sigma) noise per row; without columns, to a seeded share of them."""
    if columns is None:
        names = resolve_numeric(df, None, key)
        columns = choose_columns(names, int(len(names) * share), seed)
    require_columns(df, columns)
    return _replace(
        df,
        {c: as_number(df, c) + F.lit(mu) + F.lit(sigma) * normal(seed, key, c) for c in columns},
    )


def add_shifted_noise(
    df: DataFrame,
    columns: Sequence[str] | None,
    key: Sequence[str],
    mu: float = 0.5,
    sigma: float = 0.2,
    spread: float = 0.3,
    share: float = 0.15,
    seed: int = SEED,
) -> DataFrame:
    """One shift ~ N(mu, sigma) per column, then N(shift, spread) noise per row."""
    if columns is None:
        names = resolve_numeric(df, None, key)
        columns = choose_columns(names, max(1, int(len(names) * share)), seed)
    require_columns(df, columns)
    new = {}
    for c in columns:
        moved = mu + sigma * scalar_normal(seed, c)
        new[c] = as_number(df, c) + F.lit(moved) + F.lit(spread) * normal(seed, key, c)
    return _replace(df, new)


def scale_noise(
    df: DataFrame,
    columns: Sequence[str] | None,
    key: Sequence[str],
    factor: float,
    share: float = 0.3,
    seed: int = SEED,
) -> DataFrame:
    """Multiply by ``1 + factor * z`` with one normal z per row and column."""
    if columns is None:
        names = resolve_numeric(df, None, key)
        columns = choose_columns(names, max(1, int(len(names) * share)), seed)
    require_columns(df, columns)
    return _replace(
        df,
        {
            c: as_number(df, c) * (F.lit(1.0) + F.lit(float(factor)) * normal(seed, key, c))
            for c in columns
        },
    )


def relative_noise(
    df: DataFrame,
    columns: Sequence[str] | None,
    key: Sequence[str],
    level: float = 0.1,
    seed: int = SEED,
) -> DataFrame:
    """Add normal noise of ``level`` times the sample std of each column."""
    columns = resolve_numeric(df, columns, key)
    std: dict[str, float | None] = {}
    for group in chunks(columns):
        aggs = [F.stddev_samp(as_number(df, c)).alias(f"s{i}") for i, c in enumerate(group)]
        std.update(zip(group, df.agg(*aggs).first()))
    return _replace(
        df,
        {
            c: as_number(df, c) + normal(seed, key, c + "|level") * F.lit(std[c]).cast("double") * F.lit(float(level))
            for c in columns
        },
    )


def drop_values(
    df: DataFrame,
    column: str,
    ratio: float,
    key: Sequence[str],
    seed: int | str = SEED,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Set exactly int(rows * ratio) values of a column to null, completely at random."""
    require_columns(df, [column, *key])
    ranged = rank_ranges(
        df,
        [],
        key,
        f"{seed}|{column}",
        lambda n: [F.floor(n * F.lit(float(ratio)))],
        "__range",
        hot_rows,
    )
    kept = F.when(F.col("__range") != 0, col(column))
    return ranged.withColumn("__kept", kept).select(
        *[F.col("__kept").alias(c) if c == column else col(c) for c in df.columns]
    )


def perturbed_sample(
    df: DataFrame,
    label: str,
    key: Sequence[str],
    n: int = 50,
    noise: float = 0.1,
    drift_factor: float = 0.0,
    seed: int = SEED,
) -> DataFrame:
    """Sample n rows, drift a share of the features, add relative noise.

    The label column must exist and is kept as it is.
    """
    require_columns(df, [label, *key])
    sample = sample_n(df, key, n, seed)
    features = resolve_numeric(df, None, [label, *key])
    if drift_factor > 0:
        chosen = choose_columns(features, max(1, int(len(features) * 0.3)), seed)
        sample = scale_noise(sample, chosen, key, drift_factor, seed=seed)
    if noise > 0:
        sample = relative_noise(sample, features, key, noise, seed)
    return sample
