"""Deterministic splits, folds and samples in hash order."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import require_columns
from ..functions.hashing import SPAN, hex_number, token
from ..functions.ranks import HOT_ROWS, rank_ranges, top_by_hash

SEED = 42


def mark_test(
    df: DataFrame,
    label: str | None,
    key: Sequence[str],
    test_size: float = 0.2,
    seed: int | str = SEED,
    hot_rows: int = HOT_ROWS,
    out: str = "is_test",
) -> DataFrame:
    """Flag the test rows: exactly floor(n * test_size + 0.5) rows per class."""
    require_columns(df, [*key, *([label] if label else [])])
    ranged = rank_ranges(
        df,
        [label] if label else [],
        key,
        seed,
        lambda n: [F.floor(n * F.lit(float(test_size)) + F.lit(0.5))],
        "__range",
        hot_rows,
    )
    return ranged.withColumn(out, F.col("__range") == 0).drop("__range")


def stratified_split(
    df: DataFrame,
    label: str,
    key: Sequence[str],
    test_size: float = 0.2,
    seed: int | str = SEED,
    hot_rows: int = HOT_ROWS,
) -> tuple[DataFrame, DataFrame]:
    """(train, test): disjoint, complete, exact share per class."""
    marked = mark_test(df, label, key, test_size, seed, hot_rows, "__test")
    return marked.where(~F.col("__test")).drop("__test"), marked.where("__test").drop("__test")


def random_split(
    df: DataFrame, key: Sequence[str], test_size: float = 0.2, seed: int | str = SEED
) -> tuple[DataFrame, DataFrame]:
    """(train, test) by a hash threshold per row: one pass, near-exact share."""
    is_test = hex_number(token(seed, key)) < F.lit(float(test_size) * SPAN)
    return df.where(~is_test), df.where(is_test)


def train_valid_test(
    df: DataFrame,
    label: str,
    key: Sequence[str],
    test_size: float = 0.2,
    valid_size: float = 0.2,
    seed: int = SEED,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Add ``is_test`` and ``is_validation``, which takes ``valid_size`` of the rest of each class.

    One ranking serves both: the first rows of a class in hash order are its test rows, the next ones
    its validation rows.
    """
    require_columns(df, [*key, label])

    def ends(n):
        test = F.floor(n * F.lit(float(test_size)) + F.lit(0.5))
        return [test, test + F.floor((n - test) * F.lit(float(valid_size)) + F.lit(0.5))]

    ranged = rank_ranges(df, [label], key, seed, ends, "__range", hot_rows)
    return ranged.withColumns({"is_test": F.col("__range") == 0, "is_validation": F.col("__range") == 1}).drop("__range")


def stratified_folds(
    df: DataFrame,
    label: str,
    key: Sequence[str],
    k: int = 5,
    seed: int | str = SEED,
    hot_rows: int = HOT_ROWS,
    out: str = "fold",
) -> DataFrame:
    """Add a fold number 0..k-1; the folds of a class differ by at most one row."""
    require_columns(df, [*key, label])
    if k < 2:
        raise ValueError("k must be at least 2")

    def ends(n):
        whole, extra = F.floor(n / F.lit(k)), n % F.lit(k)
        return [F.lit(i) * whole + F.least(F.lit(i), extra) for i in range(1, k)]

    return rank_ranges(df, [label], key, seed, ends, out, hot_rows)


def sample_n(
    df: DataFrame, key: Sequence[str], n: int, seed: int | str = SEED
) -> DataFrame:
    """Exactly min(n, rows) rows without replacement."""
    require_columns(df, key)
    return top_by_hash(df, key, seed, n)


__all__ = [
    "SEED",
    "mark_test",
    "random_split",
    "sample_n",
    "stratified_folds",
    "stratified_split",
    "train_valid_test",
]
