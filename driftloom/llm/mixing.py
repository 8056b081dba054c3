"""Mixing sources to target weights by cube-method balanced sampling."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .scratch import cut, in_arrow

WEIGHTS = (5, 2, 1)
MAX_REPEAT = 3
BLOCK = 4096
LANDING = 14
SEED = 7
_EPS = 1e-9


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, cap: int = MAX_REPEAT) -> DataFrame:
    """(source, n, source_size, target) from (source, size); one row per source, null last.

    Sources in code-point order take the weights in turn. They share the sum of all
    sizes by weight, but none gets over ``cap`` times its own size; what is cut off
    goes to the others by weight. The share of a weight at which this comes to rest is found in one
    pass: in order of cap / weight, those that reach the cap come first. The
    windows run over one row per source.
    """
    by_source = sizes.groupBy("source").agg(F.count("*").alias("n"), F.sum("size").alias("source_size"))
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    cycle = F.array(*[F.lit(int(w)) for w in weights])
    weighted = by_source.withColumn("weight", F.element_at(cycle, (F.pmod(place, F.lit(len(weights))) + 1).cast("int")))
    weighted = weighted.withColumn("most", F.lit(cap) * F.col("source_size"))
    everything = Window.partitionBy()
    rising = Window.orderBy(F.col("most") / F.col("weight"), F.col("source").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    shared = weighted.select(
        "*",
        F.sum("source_size").over(everything).alias("all_sizes"),
        F.sum("weight").over(everything).alias("all_weights"),
        F.coalesce(F.sum("most").over(rising), F.lit(0)).alias("capped"),
        F.coalesce(F.sum("weight").over(rising), F.lit(0)).alias("capped_weight"),
    )
    # share of one unit of weight if exactly the sources before this one are capped
    share = (F.col("all_sizes") - F.col("capped")) / (F.col("all_weights") - F.col("capped_weight"))
    shared = shared.withColumn("share", share)
    rest = F.min(F.when(F.col("share") * F.col("weight") <= F.col("most"), F.struct("capped_weight", "share"))).over(everything)
    target = F.least(F.col("most").cast("double"), F.col("weight") * F.coalesce(rest["share"], F.lit(0.0)))
    return shared.select("source", "n", "source_size", F.coalesce(target, F.lit(0.0)).alias("target"))


class _Flight:
    """Flight phase over one stream of units, balanced on their number and size.

    Three units at most are undecided. Their inclusion probabilities move
    along the direction that changes neither their sum nor the sum of
    probability times size, until one of them is 0 or 1; with two
    equal sizes two units are enough. A draw from the hash of the row decides
    between the two ways, so that probabilities hold on average.
    """

    def __init__(self):
        self.open: list[list] = []  # [row, probability, size, draw]

    def _move(self, units: list[list], direction: list[float]) -> None:
        up = min((1 - u[1]) / d if d > 0 else u[1] / -d for u, d in zip(units, direction) if d)
        down = min(u[1] / d if d > 0 else (1 - u[1]) / -d for u, d in zip(units, direction) if d)
        step = up if units[-1][3] * (up + down) < down else -down
        for u, d in zip(units, direction):
            u[1] += step * d
            if u[1] < _EPS:
                u[1] = 0.0
            elif u[1] > 1 - _EPS:
                u[1] = 1.0

    def add(self, row, probability: float, size: float, draw: float) -> Iterator[tuple]:
        self.open.append([row, probability, size, draw])
        while True:
            units = self.open
            if len(units) >= 2 and units[-1][2] == units[-2][2]:
                self._move(units[-2:], [1.0, -1.0])
            elif len(units) == 3:
                a, b, c = (u[2] for u in units)
                if a == c:
                    self._move([units[0], units[2]], [1.0, -1.0])
                else:
                    self._move(units, [b - c, c - a, a - b])
            else:
                return
            settled = [u for u in units if u[1] in (0.0, 1.0)]
            self.open = [u for u in units if u[1] not in (0.0, 1.0)]
            yield from ((u[0], u[1]) for u in settled)

    def rest(self) -> Iterator[tuple]:
        yield from ((u[0], u[1]) for u in self.open)
        self.open = []

    def land(self, held: list[list]) -> Iterator[tuple]:
        """Take of the last units, the undecided and those held back, what leaves the least error in size and at most two in number."""
        units = [*self.open, *held]
        self.open = []
        if not units:
            return
        took = (np.arange(1 << len(units))[:, None] >> np.arange(len(units))) & 1
        chance, size = np.array([u[1] for u in units]), np.array([u[2] for u in units])
        number = np.abs(took.sum(axis=1) - chance.sum())
        error = np.where(number <= 2 - _EPS, np.abs(took @ size - chance @ size), np.inf)
        best = np.lexsort((number, error))[0]  # of equal ones the first subset
        yield from ((u[0], float(t)) for u, t in zip(units, took[best]))


def _flown(last: bool):
    def fly(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Columns: block key, size, draw, probability, then whatever is carried along. Rows come sorted by block."""
        flight, block = _Flight(), None
        waiting: list[list] = []  # of the last flight, which has no more rows than a block

        def end() -> list[tuple]:
            if not last:
                return list(flight.rest())
            back = set(np.linspace(0, len(waiting) - 1, min(LANDING, len(waiting))).round().astype(int).tolist())
            done = [d for i, unit in enumerate(waiting) if i not in back for d in flight.add(*unit)]
            done += flight.land([waiting[i] for i in sorted(back)])
            waiting.clear()
            return done

        def out(rows: list[tuple]) -> pa.RecordBatch:
            cols = list(zip(*(r for r, _ in rows))) if rows else [[]] * len(schema)
            arrays = [pa.array(c, f.type) for c, f in zip(cols, schema)]
            arrays[3] = pa.array([p for _, p in rows], pa.float64())
            return pa.RecordBatch.from_arrays(arrays, names=schema.names)

        schema = None
        for batch in batches:
            schema = batch.schema
            done: list[tuple] = []
            columns = [c.to_pylist() for c in batch.columns]
            for row in zip(*columns):
                if row[0] != block:
                    done += end()
                    block = row[0]
                if not 0.0 < row[3] < 1.0:
                    done.append((row, row[3]))
                    continue
                unit = [row, row[3], float(row[1]), row[2]]
                if last:
                    waiting.append(unit)
                else:
                    done += flight.add(*unit)
            yield out(done)
        if schema is not None:
            yield out(end())

    return fly


def _fly(units: DataFrame, blocks, last: bool) -> DataFrame:
    """One flight over (size, draw, p, source_key, ...); ``blocks``: how many streams each source is dealt to.

    Large documents fly first. The last flight of a source holds ``LANDING`` documents of all sizes back:
    the landing problem is to make up with them for what the undecided ones leave open.
    """
    keyed = units.withColumn("block", F.concat_ws(":", F.col("source_key"), F.pmod(F.xxhash64("row_hash", F.lit("block")), blocks).cast("string")))
    rest = [c for c in units.columns if c not in ("size", "draw", "p")]
    keyed = keyed.select("block", "size", "draw", "p", *rest)
    sorted_ = keyed.repartition("block").sortWithinPartitions(F.col("block"), F.col("size") > 0, F.col("size").desc(), F.col("row_hash"))
    return in_arrow(sorted_, _flown(last), keyed.schema).select(units.columns)


def mix_sources(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights: tuple[int, ...] = WEIGHTS,
    cap: int = MAX_REPEAT,
    seed: int = SEED,
) -> DataFrame:
    """How often the mix takes each document.

    Returns for each row: the id, row_hash, size (words of the text),
    source_size and target of its source, copies (0 to ``cap``) and taken
    (copies x size). A source is taken target / source_size times: every row
    gets the whole part of it, and the fraction is an inclusion probability for
    which the cube method picks rows so that per source both the
    words and the number of documents come out.

    Plan: words are counted where the texts are; only ids, sizes and hashes are
    shuffled. Each source is dealt to blocks of about ``BLOCK`` rows by row hash; a
    flight over a sorted block holds three rows in memory and leaves two undecided at most. Those
    fly again together until one block per source is left, which lands with a few documents of all its sizes.

    Everything random is a hash of seed, id, source and text: reruns agree for any
    partitioning. Null text has size 0, a null source is a source of its own (the last), null ids
    are like other ids. Rows that are equal in id, source and text are interchangeable. An
    empty table gives an empty result.
    """
    size = F.coalesce(F.regexp_count(F.col(text_col), F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")
    rows = cut(
        docs.select(
            F.col(id_col).alias("id"),
            F.col(source_col).cast("string").alias("source"),
            size.alias("size"),
            F.xxhash64(F.lit(seed), F.col(id_col), F.col(source_col), F.col(text_col)).alias("row_hash"),
        ),
        "sizes",
    )
    targets = cut(source_targets(rows.select("source", "size"), weights, cap), "targets")
    per_source = targets.select(F.col("source").alias("s"), F.col("n").alias("n_source"), "source_size", "target")
    joined = rows.join(per_source, F.col("source").eqNullSafe(F.col("s"))).drop("s")
    times = F.when(F.col("source_size") > 0, F.least(F.lit(float(cap)), F.col("target") / F.col("source_size"))).otherwise(F.lit(0.0))
    whole = F.floor(times + _EPS)
    fraction = F.greatest(times - whole, F.lit(0.0))
    draw = F.pmod(F.xxhash64("row_hash", F.lit("draw")), F.lit(1 << 53)) / F.lit(float(1 << 53))
    units = joined.select(
        "id", "row_hash", "size", "n_source", "source_size", "target", whole.alias("whole"),
        F.when(fraction < _EPS, F.lit(0.0)).otherwise(fraction).alias("p"),
        draw.alias("draw"),
        F.coalesce(F.concat(F.lit("s"), F.sha2("source", 256)), F.lit("null")).alias("source_key"),
    )
    most = targets.agg(F.max("n")).first()[0] or 0
    decided = None
    per_block = float(BLOCK)
    while True:
        last = most <= per_block
        blocks = F.lit(1) if last else F.ceil(F.col("n_source") / per_block)
        flown = cut(_fly(units, blocks, last), "flown")
        settled = flown.where("p = 0 or p = 1")
        decided = settled if decided is None else decided.union(settled)
        if last:
            break
        units = flown.where("p > 0 and p < 1")
        per_block *= BLOCK / 2  # a block leaves two rows at most
    copies = (F.col("whole") + F.col("p")).cast("long")
    return decided.select(
        F.col("id").alias(id_col), "row_hash", "size", "source_size", "target", copies.alias("copies"), (copies * F.col("size")).alias("taken")
    )


def mixed_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", **options) -> DataFrame:
    """The rows of ``docs``, each as often as ``mix_sources`` takes it.

    Rows equal in id, source and text are interchangeable: the copies that
    they get together are dealt out over them evenly.
    """
    seed = options.get("seed", SEED)
    decisions = mix_sources(docs, id_col, text_col, source_col, **options)
    decisions = decisions.groupBy("row_hash").agg(F.sum("copies").alias("copies"), F.count("*").alias("alike")).where("copies > 0")
    key = F.xxhash64(F.lit(seed), F.col(id_col), F.col(source_col), F.col(text_col))
    own = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"), key.alias("row_hash"))
    joined = own.join(decisions, "row_hash")
    nth = F.row_number().over(Window.partitionBy("row_hash").orderBy(F.lit(1)))
    share = F.floor(F.col("copies") / F.col("alike")) + F.when(nth <= F.pmod("copies", "alike"), F.lit(1)).otherwise(F.lit(0))
    times = joined.select("doc", share.cast("int").alias("times")).where("times > 0")
    return times.select("doc", F.explode(F.array_repeat(F.lit(1), F.col("times"))).alias("one")).select("doc.*")
