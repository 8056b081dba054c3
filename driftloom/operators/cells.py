"""Trees grown on cells: rows alike in the bins of all features count as one weighted entry.

A tree sees a feature through its bins only, so rows in the same bins of all features take the same way through
every tree. Their number per class (and per mark, such as a fold) says all that growing needs. The cells are counted in
one aggregate over all rows; what is left, at most ``MOST_CELLS`` cells whatever the number of rows, is
grown by matrix arithmetic. Bags of rows are drawn as counts: where a row is taken Poisson(1) times, a cell of n rows
is taken Poisson(n) times.
"""

from __future__ import annotations

import json
import math
import pickle
import sys
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.columns import col
from ..session import scratch_path

MOST_CELLS = 1 << 20
MOST_COUNTS = 1 << 22  # cells x marks x classes
MOST_FEATURES = 64
_FEW_VALUES = 1000  # of a feature; up to here each of its values is counted
_FLAT = 1e-12  # a gain below this share of the spread at the root is rounding


@dataclass
class Cells:
    """Bin per cell and feature, rows per cell, mark and class; bin i of feature f ends with ``edges[f][i]``."""

    edges: list[np.ndarray]
    bins: np.ndarray
    counts: np.ndarray

    @property
    def widths(self) -> list[int]:
        return [len(e) + 1 for e in self.edges]

    def points(self) -> np.ndarray:
        """A vector within each cell."""
        ends = [np.append(e, e[-1] + 1 + abs(e[-1])) if len(e) else np.zeros(1) for e in self.edges]
        return np.stack([end[self.bins[:, f]] for f, end in enumerate(ends)], axis=1)


# --- from rows to cells -------------------------------------------------------


def edges_of_counts(values: Sequence[float], counts: Sequence[float], bins: int) -> list[float]:
    """Ends of all bins but the last, for counted values: between all of them if they are few, else so that bins hold about equally many rows."""
    ends = [a + (b - a) / 2 for a, b in zip(values, values[1:])]
    ends = [e if a <= e < b else a for e, a, b in zip(ends, values, values[1:])]
    if len(ends) < bins:
        return ends
    out, stride = [], sum(counts) / bins
    seen, target = counts[0], stride
    for end, n in zip(ends, counts[1:]):
        before, seen = seen, seen + n
        if abs(before - target) < abs(seen - target):
            out.append(end)
            target += stride
    return out


def _edges(rows: DataFrame, facts, size: int, bins: int) -> list[np.ndarray]:
    few = [f for f in range(size) if facts[f"d{f}"] <= _FEW_VALUES]
    found: list[list[tuple[float, int]]] = [[] for _ in range(size)]
    if few:
        pairs = F.array(*[F.struct(F.lit(f).alias("f"), F.col("x")[f].alias("v")) for f in few])
        counted = rows.select(F.explode(pairs).alias("s")).groupBy("s.f", "s.v").count()
        for f, v, n in counted.collect():
            if math.isfinite(v):
                found[f].append((v, n))
    out = []
    for f in range(size):
        if f in few:
            pairs = sorted(found[f])
            ends = edges_of_counts([v for v, _ in pairs], [n for _, n in pairs], bins)
        else:
            ends = sorted({v for v in facts[f"q{f}"] if math.isfinite(v)})
        out.append(np.array(ends, dtype=np.float64))
    return out


def _bin(x: Column, edges: Sequence[float]) -> Column:
    """Number of the bin, by halving; NaN falls into the last one, as it goes right at every split."""

    def place(low: int, high: int) -> Column:
        if low == high:
            return F.lit(low)
        middle = (low + high) // 2
        return F.when(x <= F.lit(float(edges[middle])), place(low, middle)).otherwise(place(middle + 1, high))

    return place(0, len(edges)).cast("short")


def gather(
    df: DataFrame, features: str, label: str, mark: Column | None = None, marks: int = 1, bins: int = 32, edges: list[np.ndarray] | None = None
) -> Cells | None:
    """The cells of all rows, in two narrow passes for the edges and one aggregate; None where they are too many, or codes are none.

    ``mark`` is a number from 0 to ``marks`` - 1, read in the last pass only. Without ``edges`` those of the rows are taken.
    """
    first = df.select(col(features)).where(col(features).isNotNull()).first()
    if first is None or not 0 < len(first[0]) <= MOST_FEATURES:
        return None
    size = len(first[0])
    code, number = col(label).cast("double"), F.lit(0) if mark is None else mark.cast("int")
    rows = df.select(vector_to_array(col(features)).alias("x"), code.alias("c"), number.alias("m"))
    bad = F.col("x").isNull() | F.col("c").isNull() | (F.size("x") != size) | (F.col("c") < 0) | (F.col("c") != F.floor("c"))
    asked = [F.count_if(bad).alias("bad"), F.max("c").alias("classes")]
    if edges is None:
        shares = [i / bins for i in range(1, bins)]
        for f in range(size):
            asked += [F.approx_count_distinct(F.col("x")[f]).alias(f"d{f}"), F.percentile_approx(F.col("x")[f], shares, 2000).alias(f"q{f}")]
    facts = rows.agg(*asked).first()
    if facts["bad"]:
        return None
    classes = int(facts["classes"]) + 1
    edges = _edges(rows, facts, size, bins) if edges is None else edges
    names = [f"b{f}" for f in range(size)]
    binned = rows.select(*[_bin(F.col("x")[f], edges[f]).alias(n) for f, n in enumerate(names)], F.col("c").cast("int").alias("c"), "m")
    most = math.prod(len(e) + 1 for e in edges)
    if most > MOST_CELLS:
        most = binned.agg(F.approx_count_distinct(F.xxhash64(*names))).first()[0]
    if most > MOST_CELLS or most * marks * classes > 2 * MOST_COUNTS:
        return None
    found = binned.groupBy(*names, "c", "m").agg(F.count(F.lit(1)).alias("n")).toArrow()
    if found["m"].null_count:
        return None
    column = lambda name, kind: found[name].to_numpy().astype(kind)
    alike, place = np.unique(np.stack([column(n, np.int16) for n in names], axis=1), axis=0, return_inverse=True)
    at = (place.ravel() * marks + column("m", np.int64)) * classes + column("c", np.int64)
    counts = np.bincount(at, column("n", np.float64), len(alike) * marks * classes).reshape(len(alike), marks, classes)
    return Cells(edges, alike, counts)


def per_node(strategy: str, size: int, trees: int = 1) -> int:
    """Features that a node may split on, by Spark's names of strategies for classification."""
    if strategy == "auto":
        strategy = "all" if trees == 1 else "sqrt"
    named = {"all": size, "sqrt": math.ceil(math.sqrt(size)), "log2": max(1, math.ceil(math.log2(size))), "onethird": math.ceil(size / 3)}
    if strategy in named:
        return named[strategy]
    if strategy.isdigit():
        return min(int(strategy), size)
    return max(1, min(size, math.ceil(float(strategy) * size)))


# --- one tree -----------------------------------------------------------------


@dataclass
class Tree:
    """Nodes in the order of levels, the right child next to the left one. ``feature`` is -1 at a leaf.

    ``rows``, ``weight``, ``sums`` and ``squares`` are those of the bag in the node, ``gain`` per weight; ``at`` is
    the leaf of every cell.
    """

    feature: np.ndarray
    cut: np.ndarray
    left: np.ndarray
    rows: np.ndarray
    weight: np.ndarray
    sums: np.ndarray
    squares: np.ndarray | None
    gain: np.ndarray
    at: np.ndarray | None

    @property
    def spread(self) -> np.ndarray:
        """Gini impurity of class counts, or variance where there are squares."""
        weight = np.maximum(self.weight, 1e-300)
        own = 1.0 if self.squares is None else self.squares / weight
        return np.maximum(own - ((self.sums / weight) ** 2).sum(axis=0), 0.0)

    def values(self) -> np.ndarray:
        return self.sums[0] / np.maximum(self.weight, 1e-300)


def grow(bins, widths, rows, weight, sums, squares, depth, min_rows, some, rng) -> Tree:
    """One tree, level by level. Per cell: ``rows`` in the bag, their ``weight``, ``sums`` (several) and, for variance, ``squares``.

    ``sums`` are class counts (gini) or one weighted sum of the target.
    """
    size, several, width = bins.shape[1], len(sums), max([2, *widths])
    placed = np.ascontiguousarray(bins.T, dtype=np.int64) + np.arange(size)[:, None] * width
    real = np.arange(width - 1) < np.array(widths)[:, None] - 1
    leaf = np.zeros(len(bins), dtype=np.int32)
    active, at = np.arange(len(bins)), np.zeros(len(bins), dtype=np.int64)
    levels, offset, nodes, root = [], 0, 1, None
    for level in range(depth + 1):
        total = lambda v: np.bincount(at, v[active], nodes)
        w = total(weight)
        n = w if rows is weight else total(rows)
        s = np.stack([total(v) for v in sums])
        q = None if squares is None else total(squares)
        with np.errstate(divide="ignore", invalid="ignore"):
            base = np.where(w > 0, (s * s).sum(axis=0) / w, 0.0)
            spread = np.where(w > 0, (w if q is None else q) - base, 0.0)
        root = max(spread[0] / max(w[0], 1e-300), 0.0) if root is None else root
        feature, cut = np.full(nodes, -1), np.zeros(nodes, dtype=np.int64)
        left, gain = np.full(nodes, -1), np.full(nodes, -1.0)
        levels.append([feature, cut, left, n, w, s, q, gain])
        least = _FLAT * root * w
        wanted = (spread > least) & (n >= 2 * max(min_rows, 1)) & (level < depth)
        if not wanted.any():
            leaf[active] = offset + at
            break
        number = np.cumsum(wanted) - 1
        tried = wanted[at]
        leaf[active[~tried]] = offset + at[~tried]
        active, at = active[tried], number[at[tried]]
        ids = np.flatnonzero(wanted)
        best, chosen, place = _best(placed, width, real, rows, weight, sums, active, at, n[ids], w[ids], s[:, ids], base[ids], min_rows, some, rng)
        inner = best > least[ids]
        ended = ~inner[at]
        leaf[active[ended]] = offset + ids[at[ended]]
        if not inner.any():
            break
        feature[ids[inner]], cut[ids[inner]] = chosen[inner], place[inner]
        gain[ids[inner]] = best[inner] / w[ids[inner]]
        left[ids[inner]] = offset + nodes + 2 * np.arange(inner.sum())
        number = np.cumsum(inner) - 1
        active, at = active[~ended], at[~ended]
        right = bins[active, chosen[at]] > place[at]
        at = 2 * number[at] + right
        offset, nodes = offset + nodes, 2 * int(inner.sum())
    joined = [np.concatenate([v[i] for v in levels], axis=-1) if levels[0][i] is not None else None for i in range(8)]
    feature, cut, left, n, w, s, q, gain = joined
    return Tree(feature, cut, left, n, w, s.reshape(several, -1), q, gain, leaf)


def _best(placed, width, real, rows, weight, sums, active, at, n, w, s, base, min_rows, some, rng):
    """(gain times weight, feature, bin) of the best split of every node; of equal ones the first. All features at once."""
    nodes, size = len(n), len(placed)
    key = (placed[:, active] + at * (size * width)).ravel()
    below = lambda v: np.bincount(key, np.tile(v[active], size), nodes * size * width).reshape(nodes, size, width).cumsum(axis=2)[:, :, :-1]
    wide = lambda v: v[:, None, None]
    wl = below(weight)
    nl = wl if rows is weight else below(rows)
    wr, nr = wide(w) - wl, wide(n) - nl
    fit = (nl >= max(min_rows, 1)) & (nr >= max(min_rows, 1)) & (wl > 0) & (wr > 0) & real
    if some < size:
        fit &= (rng.random((nodes, size)).argsort(axis=1).argsort(axis=1) < some)[:, :, None]
    gain, under_l, under_r = -wide(base), np.where(fit, wl, 1.0), np.where(fit, wr, 1.0)
    for own, v in zip(s, sums):
        sl = below(v)
        sr = wide(own) - sl
        gain = gain + sl * sl / under_l + sr * sr / under_r
    gain = np.where(fit, gain, -np.inf).reshape(nodes, -1)
    where = gain.argmax(axis=1)
    return gain[np.arange(nodes), where], where // (width - 1), where % (width - 1)


def pruned(tree: Tree) -> Tree:
    """The tree without splits whose two leaves name the same class."""
    guess, feature = tree.sums.argmax(axis=0), tree.feature.copy()
    for i in range(len(feature) - 1, -1, -1):
        a = tree.left[i]
        if feature[i] >= 0 and feature[a] < 0 and feature[a + 1] < 0 and guess[a] == guess[a + 1]:
            feature[i] = -1
    return _kept(tree, feature, None)[0]


def _kept(tree: Tree, feature: np.ndarray, squares: np.ndarray | None) -> tuple[Tree, np.ndarray]:
    """The tree with fewer splits, as ``feature`` tells, and the new number of every node that stays."""
    kept = np.zeros(len(feature), dtype=bool)
    kept[0] = True
    for i in np.flatnonzero(feature >= 0):
        if kept[i]:
            kept[tree.left[i] : tree.left[i] + 2] = True
    number = np.cumsum(kept) - 1
    left = np.where(feature >= 0, number[np.maximum(tree.left, 0)], -1)[kept]
    gain = np.where(feature >= 0, tree.gain, -1.0)[kept]
    rest = (tree.rows[kept], tree.weight[kept], tree.sums[:, kept], None if squares is None else squares[kept])
    return Tree(feature[kept], tree.cut[kept], left, *rest, gain, None), np.where(kept, number, -1)


def cut_back(tree: Tree, most: int) -> Tree:
    """Opens the node of the highest gain until there are ``most`` leaves, as growth by leaf does."""
    feature, rim, heap = np.full(len(tree.feature), -1), {0: tree.gain[0]}, {0: 1}
    while len(rim) < most:
        i = max(rim, key=lambda n: (rim[n], -heap[n]))
        if rim[i] < 0:
            break
        del rim[i]
        feature[i] = tree.feature[i]
        a = int(tree.left[i])
        heap |= {a: 2 * heap[i], a + 1: 2 * heap[i] + 1}
        rim |= {n: tree.gain[n] if tree.feature[n] >= 0 else -1.0 for n in (a, a + 1)}
    out, number = _kept(tree, feature, tree.squares)
    for i in np.flatnonzero(tree.feature >= 0):
        below = slice(tree.left[i], tree.left[i] + 2)
        number[below] = np.where(number[below] < 0, number[i], number[below])
    out.at = number[tree.at]
    return out


def forest(cells: Cells, trees: int, depth: int, min_rows: int, some: int, seed: int, share: float = 1.0, bootstrap: bool = True) -> list[Tree]:
    """Trees of gini impurity, each on its own bag of the rows."""
    counts = cells.counts.sum(axis=1)
    out = []
    for t in range(trees):
        rng = np.random.default_rng([seed & (2**63 - 1), t])
        if bootstrap:
            bag = rng.poisson(counts * share).astype(np.float64)
        else:
            bag = counts if share >= 1 else rng.binomial(counts.astype(np.int64), share).astype(np.float64)
        rows = bag.sum(axis=1)
        out.append(pruned(grow(cells.bins, cells.widths, rows, rows, list(bag.T), None, depth, min_rows, some, rng)))
    return out


# --- boosting of one class against the rest --------------------------------------


@dataclass
class Boosted:
    """Trees up to the best round, and the margins that they give each cell."""

    trees: list[Tree]
    weights: list[float]
    margins: np.ndarray | None


def boost(bins, widths, train, valid, code, rounds, step, depth, min_rows, some, share, patience, seed) -> Boosted:
    """Boosting of the logistic loss for class ``code``, by rows per cell and class.

    As in ``GBTClassifier``: the first tree is on the classes -1 and 1, later ones on the slope of the loss. With ``valid``
    no more than ``patience`` rounds are grown beyond the best one, which is the last of the result.
    """
    yes, no = train[:, code], train.sum(axis=1) - train[:, code]
    margins, kept = np.zeros(len(bins)), np.zeros(len(bins))
    out, weights, least, best = [], [], math.nan, 0
    for number in range(rounds):
        rng = np.random.default_rng([seed & (2**63 - 1), code, number])
        a, b = (yes, no) if share >= 1 else (rng.binomial(v.astype(np.int64), share).astype(np.float64) for v in (yes, no))
        up, down = (1.0, -1.0) if number == 0 else (4 / (1 + np.exp(2 * margins)), -4 / (1 + np.exp(-2 * margins)))
        rows = a + b
        tree = grow(bins, widths, rows, rows, [a * up + b * down], a * up * up + b * down * down, depth, min_rows, some, rng)
        weights.append(1.0 if number == 0 else step)
        margins = margins + weights[-1] * tree.values()[tree.at]
        tree.at = None
        out.append(tree)
        if valid is None:
            kept, best = margins, number
            continue
        good, total = valid[:, code], valid.sum(axis=1)
        lost = good * np.logaddexp(0, -2 * margins) + (total - good) * np.logaddexp(0, 2 * margins)
        loss = 2 * lost.sum() / total.sum() if total.sum() else math.nan
        if number == 0 or loss < least:
            least, best, kept = loss, number, margins
        elif patience > 0 and number - best >= patience:
            break
    return Boosted(out[: best + 1], weights[: best + 1], kept)


_TASK_WORK = 1 << 20  # cells times rounds, from which each class is boosted by a task


def boost_classes(spark: SparkSession, cells: Cells, early: bool, setting: dict) -> list[Boosted]:
    """``boost`` for every class on the rows of mark 0; ``early`` stops on those of mark 1."""
    train = cells.counts[:, 0]
    valid = (cells.counts[:, 1] if cells.counts.shape[1] > 1 else 0 * train) if early else None
    one = lambda c: boost(cells.bins, cells.widths, train, valid, c, **setting)
    classes = train.shape[1]
    if len(train) * setting["rounds"] < _TASK_WORK:
        return [one(c) for c in range(classes)]
    # the tasks need no package
    cloudpickle.register_pickle_by_value(sys.modules[__name__])

    def found(batches):
        for batch in batches:
            for c in batch.column(0).to_pylist():
                fit = one(c)
                fit.margins = None
                yield pa.RecordBatch.from_arrays([pa.array([c], pa.int32()), pa.array([pickle.dumps(_packed(fit))], pa.binary())], names=["c", "fit"])

    rows = spark.range(0, classes, 1, classes).mapInArrow(found, "c int, fit binary").collect()
    return [_unpacked(pickle.loads(r["fit"])) for r in sorted(rows, key=lambda r: r["c"])]


def _packed(fit: Boosted) -> tuple:
    trees = fit.trees
    parts = [np.concatenate([getattr(t, n) for t in trees], axis=-1) for n in ("feature", "cut", "left", "rows", "sums", "squares", "gain")]
    return [len(t.feature) for t in trees], fit.weights, [p.astype(k) for p, k in zip(parts, (np.int8, np.int16, np.int32, *[np.float64] * 4))]


def _unpacked(packed: tuple) -> Boosted:
    sizes, weights, parts = packed
    ends = np.cumsum(sizes)[:-1]
    each = [np.split(p, ends, axis=-1) for p in parts]
    return Boosted([Tree(f, c, x, n, n, s, q, g, None) for f, c, x, n, s, q, g in zip(*each)], weights, None)


def fold_pairs(cells: Cells, fold: int, setting: dict) -> np.ndarray:
    """Rows per true and predicted class of a fold, by one-versus-rest boosting that stops on the fold's rows."""
    valid = cells.counts[:, fold]
    train = cells.counts.sum(axis=1) - valid
    classes = int(np.flatnonzero(cells.counts.sum(axis=(0, 1))).max()) + 1
    fits = [boost(cells.bins, cells.widths, train, valid, c, **setting).margins for c in range(classes)]
    votes = np.stack([1 / (1 + np.exp(-2 * m)) for m in fits])
    # the first of equal maxima wins
    guess = (votes / votes.sum(axis=0)).argmax(axis=0)
    return np.stack([np.bincount(guess, valid[:, c], classes) for c in range(classes)])


def search(spark: SparkSession, cells: Cells, settings: Sequence[dict], folds: int) -> DataFrame:
    """(trial, fold, true_label, pred_label, n) of every setting on every fold, a task each."""
    # the tasks need no package
    cloudpickle.register_pickle_by_value(sys.modules[__name__])
    schema = "trial int, fold int, true_label int, pred_label int, n long"

    def found(batches):
        for batch in batches:
            for job in batch.column(0).to_pylist():
                trial, fold = divmod(job, folds)
                pairs = fold_pairs(cells, fold, settings[trial])
                rows = [(trial, fold, int(a), int(b), int(pairs[a, b])) for a, b in zip(*np.nonzero(pairs))]
                kinds = (pa.int32(), pa.int32(), pa.int32(), pa.int32(), pa.int64())
                names = ("trial", "fold", "true_label", "pred_label", "n")
                yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], names=names)

    jobs = len(settings) * folds
    return spark.range(0, jobs, 1, jobs).mapInArrow(found, schema)


# --- from trees to fitted models ---------------------------------------------------


_FOREST = ("classification.RandomForestClassificationModel", "classification.DecisionTreeClassificationModel")
_BOOSTED = ("classification.GBTClassificationModel", "regression.DecisionTreeRegressionModel")
_SUMMED = ("regression.GBTRegressionModel", "regression.DecisionTreeRegressionModel")


def stored(spark: SparkSession, kind: tuple[str, str], uid: str, trees: Sequence[Tree], values, weights, edges, classes: int | None = None) -> str:
    """The path of a model of ``trees`` in the form in which ``pyspark.ml`` saves and loads one; ``values`` are the nodes' predictions."""
    path = scratch_path(spark, "trees")
    params = {"paramMap": {"impurity": "variance" if classes is None else "gini"}, "defaultParamMap": {}}
    facts = lambda name, own: {"class": f"org.apache.spark.ml.{name}", "timestamp": 0, "sparkVersion": spark.version, "uid": own} | params
    head = facts(kind[0], uid) | {"numFeatures": len(edges), "numTrees": len(trees)}
    if kind is _FOREST:
        head |= {"numClasses": classes, "paramMap": params["paramMap"] | {"numTrees": len(trees)}}
    spark.createDataFrame([(json.dumps(head),)], "value string").coalesce(1).write.text(f"{path}/metadata")
    each = [(i, json.dumps(facts(kind[1], f"{uid}_{i}")), float(w)) for i, w in enumerate(weights)]
    spark.createDataFrame(each, "_1 int, _2 string, _3 double").write.parquet(f"{path}/treesMetadata")
    sizes = [len(t.feature) for t in trees]
    join = lambda parts: np.concatenate(list(parts))
    feature, left = join(t.feature for t in trees), join(t.left for t in trees)
    ends = join(np.array([edges[f][c] if f >= 0 else 0.0 for f, c in zip(t.feature, t.cut)]) for t in trees)
    inner = feature >= 0
    stats = np.concatenate([np.concatenate([t.sums] if t.squares is None else [[t.weight], t.sums, [t.squares]]) for t in trees], axis=1)
    lists = lambda flat, many: pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(many)]).astype(np.int32)), pa.array(flat))
    table = pa.table(
        {
            "treeID": join(np.full(n, i, dtype=np.int32) for i, n in enumerate(sizes)),
            "id": join(np.arange(n, dtype=np.int32) for n in sizes),
            "prediction": join(np.asarray(v, dtype=np.float64) for v in values),
            "impurity": join(t.spread for t in trees),
            "impurityStats": lists(stats.T.ravel(), np.full(len(feature), len(stats))),
            "rawCount": join(t.rows for t in trees).astype(np.int64),
            "gain": join(t.gain for t in trees),
            "leftChild": left.astype(np.int32),
            "rightChild": np.where(inner, left + 1, -1).astype(np.int32),
            "featureIndex": feature.astype(np.int32),
            "leftCategoriesOrThreshold": lists(ends[inner], inner.astype(np.int64)),
            "numCategories": np.full(len(feature), -1, dtype=np.int32),
        }
    )
    split = ["featureIndex", "leftCategoriesOrThreshold", "numCategories"]
    node = ["id", "prediction", "impurity", "impurityStats", "rawCount", "gain", "leftChild", "rightChild", F.struct(*split).alias("split")]
    spark.createDataFrame(table).select("treeID", F.struct(*node).alias("nodeData")).write.parquet(f"{path}/data")
    return path
