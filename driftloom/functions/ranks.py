"""Exact rank ranges in hash order, per stratum.

Rows of a stratum are ordered by (md5 token, key) and cut at given ranks. The
rows at the cuts are found first, and every row is then compared with the
cuts of its stratum: the table itself is not shuffled, however wide its rows.
Small strata are ranked with a window over stratum, token and key alone. A
stratum of more than ``hot_rows`` rows would be sorted by one task, so there
counting rows per hash prefix narrows each cut to a few rows, which are ranked.
Only a table of more than ``MAX_HOT`` strata is ranked as a whole.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .columns import col
from .hashing import token

HOT_ROWS = 1_000_000
MAX_HOT = 100_000  # strata cut by search; what is left has under rows / MAX_HOT rows each
_SORT_ROWS = 200_000  # rows one task may rank at the end of a cut search
_CHUNK = 3  # hex digits per narrowing pass, 4096 prefixes
_TOKEN = "__token"

Ends = Callable[[Column], list[Column]]


def rank_ranges(
    df: DataFrame,
    strata: Sequence[str],
    key: Sequence[str],
    seed: int | str,
    ends: Ends,
    out: str,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Add ``out``: 0 for ranks 1..end0, 1 up to end1, ... within each stratum.

    ``ends`` maps the row count of a stratum to the ascending last ranks. The
    key must identify a row. Without strata the cut is always searched.
    """
    strata = list(strata)
    if not strata:
        hot_rows = 0  # a window without groups would bring all rows to one task
    tagged = df.withColumn(_TOKEN, token(seed, key))
    sizes = df.groupBy(*[col(s) for s in strata]).agg(F.count(F.lit(1)).alias("__n"))
    n_ends = len(ends(F.lit(1)))
    sized = sizes.select(
        *[col(s) for s in strata],
        "__n",
        *[e.cast("long").alias(f"__end{i}") for i, e in enumerate(ends(F.col("__n")))],
    )
    found = sized.limit(MAX_HOT + 1).count() if strata else 0
    many = found > MAX_HOT
    hot = sized.where(F.col("__n") > hot_rows).orderBy(F.desc("__n")).limit(MAX_HOT).collect()
    schema = [df.schema[s] for s in strata]
    rest = _without(tagged, hot, strata, schema) if strata else None
    if 0 < found == len(hot):  # no small stratum is left, so the table is not scanned for them
        cold_part = df.sparkSession.createDataFrame([], T.StructType([*df.schema.fields, T.StructField(out, T.IntegerType())]))
    elif strata and many:
        cold_part = _by_window(rest, strata, key, ends, out)
    elif strata:
        narrow = rest.select(*[col(c) for c in dict.fromkeys([*strata, *key])], _TOKEN)
        cold_part = _by_cut(rest, strata, key, _cuts_by_window(narrow, strata, key, ends), n_ends, out)
    if strata and not hot:
        return cold_part
    hot_part = _by_cut(tagged, strata, key, _cuts(tagged, schema, strata, key, hot, n_ends), n_ends, out)
    return hot_part.unionByName(cold_part) if strata else hot_part


def _without(rows: DataFrame, hot, strata, schema) -> DataFrame:
    if not hot:
        return rows
    marks = F.broadcast(rows.sparkSession.createDataFrame([tuple(r[s] for s in strata) for r in hot], T.StructType(schema)))
    return rows.join(marks, _same(rows, marks, strata), "left_anti")


def _me(key) -> Column:
    return F.struct(F.col(_TOKEN).alias("t"), *[col(k).alias(f"k{i}") for i, k in enumerate(key)])


def _cuts_by_window(narrow, strata, key, ends) -> DataFrame:
    """One row per stratum with the (token, key) of every cut row; what is shuffled has no other column."""
    group = Window.partitionBy(*[col(s) for s in strata])
    ranked = narrow.withColumns(
        {"__rank": F.row_number().over(group.orderBy(_TOKEN, *[col(k) for k in key])), "__n": F.count(F.lit(1)).over(group)}
    )
    aggs = []
    for i, end in enumerate(ends(F.col("__n"))):
        found = F.max(F.when(F.col("__rank") == end, _me(key)))
        nothing = [F.lit(None).cast(narrow.schema[k].dataType).alias(f"k{j}") for j, k in enumerate(key)]
        # no row has the rank: all lie behind the cut, or all before it
        outside = F.struct(F.when(F.max(end) <= 0, F.lit("")).otherwise(F.lit("g")).alias("t"), *nothing)
        aggs.append(F.coalesce(found, outside).alias(f"__cut{i}"))
    return ranked.groupBy(*[col(s) for s in strata]).agg(*aggs)


def _by_window(tagged, strata, key, ends, out):
    group = Window.partitionBy(*[col(s) for s in strata])
    order = group.orderBy(_TOKEN, *[col(k) for k in key])
    rank = F.row_number().over(order)
    size = F.count(F.lit(1)).over(group)
    ranked = tagged.withColumn("__rank", rank).withColumn("__n", size)
    part = _total([(F.col("__rank") > e).cast("int") for e in ends(F.col("__n"))])
    return ranked.withColumn(out, part).drop(_TOKEN, "__rank", "__n")


def _by_cut(tagged, strata, key, cuts, n_ends, out):
    if strata:
        joined = tagged.join(F.broadcast(cuts), _same(tagged, cuts, strata)).select(
            tagged["*"], *[cuts[f"__cut{i}"] for i in range(n_ends)]
        )
    else:
        values = cuts.first()
        joined = tagged
        for i in range(n_ends):
            joined = joined.withColumn(f"__cut{i}", _literal_cut(values[f"__cut{i}"], cuts.schema[f"__cut{i}"].dataType))
    me = _me(key)
    part = _total([(me > F.col(f"__cut{i}")).cast("int") for i in range(n_ends)])
    return joined.withColumn(out, part).drop(_TOKEN, *[f"__cut{i}" for i in range(n_ends)])


def _literal_cut(row, schema):
    fields = [F.lit(row[f.name]).cast(f.dataType).alias(f.name) for f in schema.fields]
    return F.struct(*fields)


def _cuts(tagged, schema, strata, key, hot, n_ends) -> DataFrame:
    """One row per hot stratum with the (token, key) of every cut row."""
    spark = tagged.sparkSession
    state_schema = T.StructType(
        [
            *schema,
            T.StructField("__cut", T.IntegerType()),
            T.StructField("__prefix", T.StringType()),
            T.StructField("__at", T.LongType()),  # rank still to go inside the prefix
            T.StructField("__inside", T.LongType()),
        ]
    )
    names = [f.name for f in state_schema.fields]
    fixed: dict[tuple, dict[int, tuple]] = {tuple(r[s] for s in strata): {} for r in hot}
    states = []
    for r in hot:
        stratum = tuple(r[s] for s in strata)
        for i in range(n_ends):
            end = r[f"__end{i}"]
            if end <= 0:
                fixed[stratum][i] = ("", *[None] * len(key))  # before every row
            elif end >= r["__n"]:
                fixed[stratum][i] = ("g", *[None] * len(key))  # behind every row
            else:
                states.append((*stratum, i, "", end, r["__n"]))

    length = 0
    while states and max(s[-1] for s in states) > _SORT_ROWS:
        state = spark.createDataFrame(states, state_schema)
        inside = _inside(tagged, state, strata, length)
        counted = inside.groupBy(
            *[col(s) for s in strata], "__cut", "__prefix", "__at",
            F.substring(_TOKEN, length + 1, _CHUNK).alias("__chunk"),
        ).agg(F.count(F.lit(1)).alias("__rows"))
        w = Window.partitionBy(*[col(s) for s in strata], "__cut").orderBy("__chunk")
        hit = (
            counted.withColumn("__past", F.sum("__rows").over(w))
            .where((F.col("__past") >= F.col("__at")) & (F.col("__past") - F.col("__rows") < F.col("__at")))
            .select(
                *[col(s) for s in strata],
                "__cut",
                F.concat("__prefix", "__chunk").alias("__prefix"),
                (F.col("__at") - F.col("__past") + F.col("__rows")).alias("__at"),
                F.col("__rows").alias("__inside"),
            )
        )
        states = [tuple(r) for r in hit.select(*[col(n) for n in names]).collect()]
        length += _CHUNK

    if states:
        state = spark.createDataFrame(states, state_schema)
        w = Window.partitionBy(*[col(s) for s in strata], "__cut").orderBy(_TOKEN, *[col(k) for k in key])
        at_cut = (
            _inside(tagged, state, strata, length)
            .withColumn("__rank", F.row_number().over(w))
            .where(F.col("__rank") == F.col("__at"))
            .select(*[col(s) for s in strata], "__cut", _TOKEN, *[col(k).alias(f"__key{i}") for i, k in enumerate(key)])
        )
        for r in at_cut.collect():
            stratum = tuple(r[s] for s in strata)
            fixed[stratum][r["__cut"]] = (r[_TOKEN], *[r[f"__key{i}"] for i in range(len(key))])

    cut_type = T.StructType(
        [T.StructField("t", T.StringType())]
        + [T.StructField(f"k{i}", tagged.schema[k].dataType) for i, k in enumerate(key)]
    )
    rows = [(*stratum, *[cuts[i] for i in range(n_ends)]) for stratum, cuts in fixed.items()]
    fields = [*schema, *[T.StructField(f"__cut{i}", cut_type) for i in range(n_ends)]]
    return spark.createDataFrame(rows, T.StructType(fields))


def _inside(tagged, state, strata, length):
    narrow = F.broadcast(state)  # one row per hot stratum and cut
    cond = _same(tagged, narrow, strata)
    starts = F.substring(tagged[_TOKEN], 1, length) == narrow["__prefix"] if length else F.lit(True)
    cond = starts if cond is None else cond & starts
    if not strata and not length:
        return tagged.withColumn("__x", F.explode(F.array(*[
            F.struct(*[F.lit(v).alias(n) for n, v in zip(state.columns, r)]) for r in state.collect()
        ]))).select(tagged["*"], "__x.*")
    return tagged.join(narrow, cond).select(
        tagged["*"], narrow["__cut"], narrow["__prefix"], narrow["__at"]
    )


def _same(left, right, strata):
    conds = [left[f"`{s}`"].eqNullSafe(right[f"`{s}`"]) for s in strata]
    return reduce(lambda a, b: a & b, conds) if conds else None


def _total(terms: list[Column]) -> Column:
    return reduce(lambda a, b: a + b, terms)


def top_by_hash(
    df: DataFrame, key: Sequence[str], seed: int | str, n: int, direct_rows: int = HOT_ROWS
) -> DataFrame:
    """Exactly ``min(n, rows)`` rows, first in hash order.

    A sort with limit merges n rows of every task in one; so it serves small
    tables only, others are filtered by the cut row.
    """
    if df.count() <= direct_rows:
        ordered = df.withColumn(_TOKEN, token(seed, key)).orderBy(_TOKEN, *[col(k) for k in key])
        return ordered.limit(n).drop(_TOKEN)
    ranged = rank_ranges(df, [], key, seed, lambda size: [F.lit(n)], "__part", hot_rows=0)
    return ranged.where(F.col("__part") == 0).drop("__part")
