"""Exact linear-interpolation quantiles at any table size.

``percentile`` is exact but holds a value -> count map of the whole column in
one task, so it is used only while the row count keeps that map small. Beyond,
each wanted order statistic is enclosed between two values of the column: a
pass splits the enclosure with ``percentile_approx`` (bounded state, combined
map-side), the next counts rows below and at the split values exactly, until
a split value is the answer or few rows are left between; these are ranked.
Every pass reads only the columns concerned and shuffles no rows; the result
equals ``percentile``.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .columns import as_number, chunks, col

EXACT_ROWS = 100_000  # up to so many rows ``percentile`` is the cheaper way
RANK_ROWS = 1_000_000  # values one task may rank at the end of a search
_SPLITS = 256
_ACCURACY = 1000


@dataclass
class _Search:
    """Order statistic ``rank`` (from 0), known to lie strictly in (low, high)."""

    column: str
    rank: int
    inside: int
    low: float | None = None
    high: float | None = None
    below: int = 0
    value: float | None = None

    @property
    def range(self) -> tuple:
        return self.column, self.low, self.high


def quantiles(
    df: DataFrame,
    columns: Sequence[str],
    probs: Sequence[float],
    rows: int | None = None,
    exact_rows: int = EXACT_ROWS,
) -> dict[str, list[float | None]]:
    """Quantiles per column as driver scalars; missing values are skipped.

    ``rows`` is an upper bound of the row count if the caller knows one.
    """
    if rows is None:
        rows = df.count()
    return rows_and_quantiles(df, columns, probs, rows, exact_rows)[1]


def rows_and_quantiles(
    df: DataFrame,
    columns: Sequence[str],
    probs: Sequence[float],
    rows: int,
    exact_rows: int = EXACT_ROWS,
) -> tuple[int, dict[str, list[float | None]]]:
    """Quantiles and, from the same pass, the exact row count."""
    every = F.count(F.lit(1)).alias("every")
    out: dict[str, list[float | None]] = {}
    if rows <= exact_rows:
        for group in chunks(columns):
            aggs = [
                F.percentile(as_number(df, c), list(probs)).alias(f"q{i}")
                for i, c in enumerate(group)
            ]
            row = df.agg(*aggs, every).first()
            rows = row["every"]
            for c, values in zip(group, row):
                out[c] = list(values) if values is not None else [None] * len(probs)
        return rows, out
    rank_rows = RANK_ROWS if exact_rows >= EXACT_ROWS else exact_rows
    for group in chunks(columns, 8):
        rows, part = _by_search(df, group, probs, rank_rows)
        out.update(part)
    return rows, out


def _by_search(df, columns, probs, rank_rows) -> tuple[int, dict[str, list[float | None]]]:
    found = _digests(df, [(c, None, None) for c in columns])
    rows = found[None][0]
    n = {c: found[c, None, None][0] for c in columns}
    searches: dict[tuple[str, int], _Search] = {}
    for c in columns:
        for p in probs if n[c] else ():
            for rank in (math.floor((n[c] - 1) * p), math.ceil((n[c] - 1) * p)):
                searches.setdefault((c, rank), _Search(c, rank, inside=n[c]))
    open_ = list(searches.values())
    while open_:
        _narrow(df, open_, found)
        open_ = [s for s in open_ if s.value is None and s.inside > rank_rows]
        if open_:
            found = _digests(df, sorted({s.range for s in open_}, key=repr))
    _rank(df, [s for s in searches.values() if s.value is None])

    out: dict[str, list[float | None]] = {}
    for c in columns:
        out[c] = []
        for p in probs:
            if not n[c]:
                out[c].append(None)
                continue
            at = (n[c] - 1) * p
            low, high = math.floor(at), math.ceil(at)
            a, b = searches[(c, low)].value, searches[(c, high)].value
            out[c].append(a if a == b else (high - at) * a + (at - low) * b)
    return rows, out


def _in_range(df: DataFrame, column: str, low: float | None, high: float | None) -> Column:
    """The value where it lies strictly inside the range, else null."""
    x = as_number(df, column)
    cond = x.isNotNull()
    if low is not None:
        cond &= x > F.lit(low)
    if high is not None:
        cond &= x < F.lit(high)
    return F.when(cond, x)


def _digests(df: DataFrame, ranges: list[tuple]) -> dict[tuple | None, tuple[int, list[float]]]:
    """Row count and approximate splits per range, in one pass; under None all rows."""
    splits = [i / _SPLITS for i in range(_SPLITS + 1)]
    aggs = []
    for i, r in enumerate(ranges):
        x = _in_range(df, *r)
        aggs.append(F.count(x).alias(f"n{i}"))
        aggs.append(F.percentile_approx(x, splits, _ACCURACY).alias(f"s{i}"))
    row = df.agg(*aggs, F.count(F.lit(1)).alias("every")).first()
    found = {r: (row[f"n{i}"], row[f"s{i}"] or []) for i, r in enumerate(ranges)}
    return {**found, None: (row["every"], [])}


def _narrow(df: DataFrame, searches: list[_Search], found: dict) -> None:
    """Count rows below and at the splits next to each rank, in one pass."""
    edges: dict[int, list[float]] = {}
    wanted: dict[tuple[str, float], int] = {}
    for i, s in enumerate(searches):
        at = (s.rank - s.below) / max(s.inside - 1, 1) * _SPLITS
        near = range(max(math.floor(at) - 1, 0), min(math.ceil(at) + 1, _SPLITS) + 1)
        edges[i] = sorted({float(found[s.range][1][k]) for k in near})
        for e in edges[i]:
            wanted.setdefault((s.column, e), len(wanted))
    aggs = []
    for (c, e), j in wanted.items():
        x = col(c).cast("double")  # NaN is neither below nor at a number
        aggs.append(F.count(F.when(x < F.lit(e), 1)).alias(f"lt{j}"))
        aggs.append(F.count(F.when(x <= F.lit(e), 1)).alias(f"le{j}"))
    counts = df.agg(*aggs).first()
    for i, s in enumerate(searches):
        past = s.below + s.inside
        for e in edges[i]:
            j = wanted[s.column, e]
            less, upto = counts[f"lt{j}"], counts[f"le{j}"]
            if s.rank < less:
                s.high, past = e, less
                break
            if s.rank < upto:
                s.value = e
                break
            s.low, s.below = e, upto
        s.inside = past - s.below


def _rank(df: DataFrame, searches: list[_Search]) -> None:
    """Rank the few values left in each range; one window partition per range."""
    if not searches:
        return
    ranges = sorted({s.range for s in searches}, key=repr)
    values = [_in_range(df, *r) for r in ranges]
    any_inside = reduce(lambda a, b: a | b, [v.isNotNull() for v in values])
    cells = [
        F.struct(F.lit(i).alias("range"), v.alias("value")) for i, v in enumerate(values)
    ]
    counted = (
        df.where(any_inside)
        .select(F.inline(F.array(*cells)))
        .where("value is not null")
        .groupBy("range", "value")
        .count()
    )
    w = Window.partitionBy("range").orderBy("value")
    ranked = counted.withColumn("past", F.sum("count").over(w))
    hit = F.lit(False)
    for s in searches:
        at = s.rank - s.below
        hit |= (
            (F.col("range") == ranges.index(s.range))
            & (F.col("past") > at)
            & (F.col("past") - F.col("count") <= at)
        )
    rows = ranked.where(hit).collect()
    for s in searches:
        at = s.rank - s.below
        s.value = next(
            r["value"]
            for r in rows
            if ranges[r["range"]] == s.range and r["past"] - r["count"] <= at < r["past"]
        )
