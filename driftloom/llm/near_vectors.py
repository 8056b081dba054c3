"""Near-duplicate vectors by Euclidean p-stable hashing."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .components import components
from .scratch import cut, in_arrow
from .words import mix

THRESHOLD = 0.95
WIDTH = 2.0  # of a quantisation cell, for vectors of length 1
MISS = 0.02  # odds that no table joins a pair at the threshold
EXTRA_PROJECTIONS = 3
SEED = 5
STRAYS_PER_BLOCK = 512
MEMBERS_PER_PART = 8192  # so many members of a bucket go past a block in one group
STILL_TIGHT = 4  # pivots are taken anew while they place one in so many of the open vectors
_SLAB = 128


def collision(distance: float, width: float = WIDTH) -> float:
    """Odds that one quantised Gaussian projection agrees for two points at that distance."""
    if distance <= 0:
        return 1.0
    r = width / distance
    below = 0.5 * math.erfc(r / math.sqrt(2))
    return 1 - 2 * below - 2 / (math.sqrt(2 * math.pi) * r) * (1 - math.exp(-r * r / 2))


def plan(rows: int, threshold: float = THRESHOLD) -> tuple[int, int]:
    """(projections per table, tables) for so many vectors.

    Projections grow with the logarithm of the rows, so that vectors at right angles seldom
    meet in a bucket; tables follow so that a pair at the threshold is missed
    with odds of ``MISS``.
    """
    near, far = collision(math.sqrt(2 - 2 * threshold)), collision(math.sqrt(2))
    k = EXTRA_PROJECTIONS + max(1, math.ceil(math.log(max(rows, 2)) / -math.log(far)))
    return k, math.ceil(math.log(MISS) / math.log(1 - near**k))


def unit(vectors: np.ndarray) -> np.ndarray:
    return vectors / np.linalg.norm(vectors, axis=1, keepdims=True)


def _usable(column: pa.Array) -> tuple[list[int], list[np.ndarray]]:
    """Rows whose vector is not null, not zero, and of finite components, in double precision."""
    at, out = [], []
    for i, v in enumerate(column):
        if not v.is_valid:
            continue
        values = v.values
        if not len(values) or values.null_count:
            continue
        x = values.to_numpy(zero_copy_only=False).astype(np.float64)
        if np.isfinite(x).all() and x.any():
            at.append(i)
            out.append(x)
    return at, out


def _cleaner(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        at, vectors = _usable(batch.column(1))
        # scaled first, so that neither huge nor tiny components overflow or vanish in the norm
        scaled = [x / np.abs(x).max() for x in vectors]
        units = [x / math.sqrt(float(x @ x)) for x in scaled]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0).take(pa.array(at, pa.int64())), pa.array([len(x) for x in units], pa.int32()), pa.array(units, pa.list_(pa.float64()))],
            ["id", "size", "v"],
        )


def _hasher(k: int, tables: int, width: float, seed: int):
    def hash_(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for batch in batches:
            sizes = batch.column(1).to_numpy()
            flat = batch.column(2).flatten().to_numpy()
            ends = np.cumsum(sizes)
            ids, out = [], []
            for size in np.unique(sizes):
                if size not in made:
                    rng = np.random.default_rng([seed, int(size)])
                    made[size] = rng.standard_normal((int(size), k * tables)), rng.uniform(0, width, k * tables)
                a, b = made[size]
                rows = np.flatnonzero(sizes == size)
                vectors = np.stack([flat[ends[i] - size : ends[i]] for i in rows])
                for at in range(0, len(rows), 2048):
                    cells = np.floor((vectors[at : at + 2048] @ a + b) / width).astype(np.int64).astype(np.uint64).reshape(-1, tables, k)
                    key = np.broadcast_to(np.arange(tables, dtype=np.uint64) * np.uint64(1 << 32) + np.uint64(size), cells.shape[:2]).copy()
                    for j in range(k):
                        key = mix(key + cells[:, :, j])
                    ids += rows[at : at + 2048].tolist()
                    out.append(key)
            if out:
                keys = np.concatenate(out).view(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [*batch.take(pa.array(ids, pa.int64())).columns, pa.ListArray.from_arrays(np.arange(0, keys.size + 1, tables, dtype=np.int32), pa.array(keys.ravel()))],
                    ["id", "size", "v", "keys"],
                )

    return hash_


def _cosines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sizes = [np.asarray(pa.compute.list_value_length(batch.column(c))) for c in (2, 3)]
        left, right = (batch.column(c).flatten().to_numpy() for c in (2, 3))
        starts = [np.concatenate([[0], np.cumsum(s)[:-1]]).astype(np.int64) if len(s) else np.zeros(0, np.int64) for s in sizes]
        if len(left) and np.array_equal(sizes[0], sizes[1]):
            dots = np.add.reduceat(left * right, starts[0])
        else:
            dots = np.array([left[a : a + n] @ right[b : b + m] if n == m else -2.0 for a, b, n, m in zip(*starts, *sizes)], np.float64)
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(dots, pa.float64())], ["a", "b", "cosine"])


class _Block:
    """The strays of one block of a bucket, their links so far, and which of them are joined."""

    def __init__(self, ids: list, clusters: list, vectors: list, keys: list, key: int, threshold: float):
        self.ids, self.clusters = np.concatenate(ids), np.concatenate(clusters)
        self.vectors, self.keys, self.key, self.threshold = np.concatenate(vectors), np.concatenate(keys), key, threshold
        self.links = np.zeros(len(self.ids), np.int64)
        self.tree = np.arange(len(self.ids))

    def _met(self, clusters: np.ndarray, vectors: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places of linked pairs (row, stray) of different clusters that meet in this table first."""
        row, stray = np.nonzero(vectors @ self.vectors.T >= self.threshold)
        apart = clusters[row] != self.clusters[stray]
        row, stray = row[apart], stray[apart]
        if not len(row):
            return row, stray
        first = (keys[row] == self.keys[stray]).argmax(axis=1)
        here = keys[row, first] == self.key
        return row[here], stray[here]

    def _join(self, strays: np.ndarray) -> np.ndarray:
        """One stray of each tree among these, which are one tree from now on."""
        roots, at = np.unique(self.tree[strays], return_index=True)
        if len(roots) > 1:
            self.tree[np.isin(self.tree, roots)] = roots[0]
        return strays[at]

    def _edges(self, ids: np.ndarray, row: np.ndarray, stray: np.ndarray, out: tuple[list, list, list]) -> None:
        """Of the links of each row those that join trees, and one at least."""
        starts = np.flatnonzero(np.diff(row, prepend=-1))
        for a, b in zip(starts, np.append(starts[1:], len(row))):
            for k in self._join(stray[a:b]):
                out[0].append(ids[row[a]])
                out[1].append(self.ids[k])
                out[2].append(0)

    def among_strays(self, out: tuple[list, list, list]) -> None:
        for at in range(0, len(self.ids), _SLAB):
            part = slice(at, at + _SLAB)
            row, stray = self._met(self.clusters[part], self.vectors[part], self.keys[part])
            row += at
            row, stray = row[row < stray], stray[row < stray]
            self.links += np.bincount(row, minlength=len(self.ids)) + np.bincount(stray, minlength=len(self.ids))
            self._edges(self.ids, row, stray, out)

    def past(self, ids: np.ndarray, clusters: np.ndarray, vectors: np.ndarray, keys: np.ndarray, out: tuple[list, list, list]) -> None:
        for at in range(0, len(ids), _SLAB):
            part = slice(at, at + _SLAB)
            row, stray = self._met(clusters[part], vectors[part], keys[part])
            row += at
            self.links += np.bincount(stray, minlength=len(self.ids))
            many = np.bincount(row, minlength=len(ids))
            for i in np.flatnonzero(many):
                out[0].append(ids[i])
                out[1].append(None)
                out[2].append(int(many[i]))
            self._edges(ids, row, stray, out)

    def close(self, out: tuple[list, list, list]) -> None:
        for i in np.flatnonzero(self.links):
            out[0].append(self.ids[i])
            out[1].append(None)
            out[2].append(int(self.links[i]))


def _across(threshold: float):
    """Counts (id, null, n) and joining links (a, b, 0) from rows sorted by (key, size, block, part, role), strays (role 0) first."""

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, loading, block = None, None, None
        for batch in batches:
            if not batch.num_rows:
                continue
            out: tuple[list, list, list] = ([], [], [])
            places = np.stack([np.asarray(batch.column(c), np.int64) for c in range(4)])
            role = np.asarray(batch.column(4))
            ids, clusters = (batch.column(c).to_numpy(zero_copy_only=False) for c in (5, 6))
            flat, keys = batch.column(7).flatten().to_numpy(), batch.column(8).flatten().to_numpy().reshape(batch.num_rows, -1)
            ends = np.concatenate([[0], np.cumsum(places[1])])
            changed = np.any(np.diff(places, axis=1) != 0, axis=0) | (np.diff(role) != 0)
            starts = np.concatenate([[0], np.flatnonzero(changed) + 1])
            for a, b in zip(starts, np.append(starts[1:], batch.num_rows)):
                here = tuple(places[:, a])
                if here != group:
                    if loading:
                        block = _Block(*loading, group[0], threshold)
                        if group[3] == 0:
                            block.among_strays(out)
                    if block:
                        block.close(out)
                    group, loading, block = here, None, None
                vectors = flat[ends[a] : ends[b]].reshape(b - a, -1)
                if role[a] == 0:
                    loading = loading or ([], [], [], [])
                    for held, fresh in zip(loading, (ids[a:b], clusters[a:b], vectors, keys[a:b])):
                        held.append(fresh)
                    continue
                if loading:
                    block, loading = _Block(*loading, group[0], threshold), None
                    if group[3] == 0:
                        block.among_strays(out)
                if block:
                    block.past(ids[a:b], clusters[a:b], vectors, keys[a:b], out)
            yield _found(out, batch.schema.field(5).type)
        if loading or block:
            out = ([], [], [])
            if loading:
                block = _Block(*loading, group[0], threshold)
                if group[3] == 0:
                    block.among_strays(out)
            block.close(out)
            yield _found(out, batch.schema.field(5).type)

    return compare


def _found(out: tuple[list, list, list], kind: pa.DataType) -> pa.RecordBatch:
    plain = lambda ids: [i.item() if isinstance(i, np.generic) else i for i in ids]
    return pa.RecordBatch.from_arrays([pa.array(plain(out[0]), kind), pa.array(plain(out[1]), kind), pa.array(out[2], pa.int64())], ["a", "b", "n"])


def _across_rows(placed: DataFrame, hashed: DataFrame) -> DataFrame:
    """What is to be compared across the clusters of a bucket, as rows of groups.

    The members of its largest cluster apart, the members of a bucket are strays, dealt to blocks. Past each block go the members of the largest
    cluster and the strays of later blocks, in parts that each carry the block along; so every
    pair meets once, rows grow with members times blocks and no group with the bucket.
    """
    counts = placed.groupBy("key", "cluster").agg(F.count("*").alias("n"))
    largest = counts.groupBy("key").agg(F.max(F.struct("n", "cluster")).alias("main"), F.sum("n").alias("all"), F.count("*").alias("clusters")).where("clusters > 1")
    blocks = F.ceil((F.col("all") - F.col("main.n")) / STRAYS_PER_BLOCK).cast("int")
    parts = F.ceil(F.col("all") / MEMBERS_PER_PART).cast("int")
    mixed = placed.join(largest.select("key", F.col("main.cluster").alias("main"), blocks.alias("blocks"), parts.alias("parts")), "key")
    hashes = F.xxhash64("id"), F.xxhash64("id", F.lit(1))
    mixed = mixed.withColumn("own", F.when(F.col("cluster") != F.col("main"), F.pmod(hashes[0], F.col("blocks")).cast("int")))
    mixed = cut(mixed.withColumn("part", F.pmod(hashes[1], F.col("parts")).cast("int")), "mixed")
    strays = mixed.where("own is not null").select(
        "key", F.col("own").alias("block"), F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), F.lit(0).alias("role"), "id", "cluster"
    )
    past = F.when(F.col("own").isNull(), F.sequence(F.lit(0), F.col("blocks") - 1)).when(F.col("own") > 0, F.sequence(F.lit(0), F.col("own") - 1))
    stream = mixed.select("key", F.explode(past).alias("block"), "part", F.lit(1).alias("role"), "id", "cluster")
    rows = strays.union(stream).join(hashed, "id").select("key", "size", "block", "part", "role", "id", "cluster", "v", "keys")
    return rows.repartition("key", "block", "part").sortWithinPartitions("key", "size", "block", "part", "role")


def near_vectors(
    rows: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    threshold: float = THRESHOLD,
    seed: int = SEED,
) -> DataFrame:
    """Links between vectors with a cosine of at least ``threshold`` (which must be positive), for each row.

    Returns the id, n_links (other vectors linked to it), component_id (smallest id
    reachable over links, itself included) and kept (id equals component_id).

    Vectors of length 1 are projected on Gaussian directions and quantised; the cells of
    several projections make a bucket, in several independent tables.
    Candidates meet in a bucket and are confirmed by their cosine in double
    precision. ``plan`` tells how many projections and tables; the recall at the
    threshold is 1 - ``MISS``, above it higher.

    In each bucket all members are first held against the smallest id. Vectors within half the threshold's angle of such a pivot
    are surely linked with one another (angles add up at most); they form a tight
    cluster whose links are counted without a pair being made, however large it is. Members left open get new pivots
    while these still place a good part of them. The rest of a bucket goes block by block past its members: pairs of different
    clusters are compared in memory, in the first table that joins them, and only counts per vector and the links that join
    components come out. A loose group, whose vectors are similar but not within half the angle, thus costs products of its square, but neither rows nor a task of that size.

    Null, empty and zero vectors, and those with null or non-finite components, link with nothing, nor do
    vectors of different length. Rows that share an id count as one vector (the
    largest in array order), rows with a null id link with nothing and are kept. An
    empty table gives an empty result; further columns are ignored.
    """
    kind = dict(rows.dtypes)[id_col]
    own = rows.select(F.col(id_col).alias("id"), F.col(vector_col).alias("v"))
    single = own.where("id is not null and v is not null").groupBy("id").agg(F.max("v").alias("v"))
    vectors = cut(in_arrow(single, _cleaner, f"id {kind}, size int, v array<double>"), "vectors")
    k, tables = plan(vectors.count(), threshold)
    hashed = cut(in_arrow(vectors, _hasher(k, tables, WIDTH, seed), f"id {kind}, size int, v array<double>, keys array<long>"), "hashed")
    keyed = hashed.select("id", F.explode("keys").alias("key"))
    shared = keyed.groupBy("key").agg(F.count("*").alias("n")).where("n > 1").select("key")
    members = cut(keyed.join(shared, "key").select("key", "id"), "members")

    def checked(pairs: DataFrame) -> DataFrame:
        side = lambda c: vectors.select(F.col("id").alias(c), F.col("v").alias(f"v_{c}"))
        both = pairs.join(side("a"), "a").join(side("b"), "b").select("a", "b", "v_a", "v_b")
        return in_arrow(both, _cosines, f"a {kind}, b {kind}, cosine double")

    # a little under half the angle, so that rounding never makes an unsure pair sure
    half = math.cos(math.acos(threshold) / 2) + 1e-6
    tight, open_ = None, members
    while True:
        pivots = open_.groupBy("key").agg(F.min("id").alias("pivot"), F.count("*").alias("n")).where("n > 1").select("key", "pivot")
        others = open_.join(pivots, "key").where("id <> pivot")
        to_pivot = others.select(F.col("pivot").alias("a"), F.col("id").alias("b")).distinct()
        near = cut(checked(to_pivot).where(F.col("cosine") >= half).groupBy(F.col("b").alias("id")).agg(F.min("a").alias("cluster")), "tight")
        tight = near if tight is None else tight.union(near)
        settled = near.select("id").union(near.select("cluster")).distinct()
        open_ = cut(others.select("key", "id").join(settled, "id", "left_anti").select("key", "id"), "open")
        if near.count() * STILL_TIGHT < open_.select("id").distinct().count() or open_.isEmpty():
            break
    tight = cut(tight, "tight")
    placed = cut(members.join(tight, "id", "left").select("key", "id", F.coalesce("cluster", "id").alias("cluster")), "placed")
    met = cut(in_arrow(_across_rows(placed, hashed), _across(threshold), f"a {kind}, b {kind}, n long"), "across")
    links = met.where("b is not null").select("a", "b")

    # a pivot belongs to its own cluster unless a smaller pivot took it
    named = tight.select("id", "cluster").union(
        tight.select(F.col("cluster").alias("id")).distinct().join(tight.select("id"), "id", "left_anti").select("id", F.col("id").alias("cluster"))
    )
    named = cut(named, "clusters")
    sizes = named.groupBy("cluster").agg(F.count("*").alias("size"))
    inside = named.join(sizes, "cluster").select("id", (F.col("size") - 1).alias("n"))
    outside = met.where("b is null").select(F.col("a").alias("id"), "n")
    counts = inside.union(outside).groupBy("id").agg(F.sum("n").alias("n_links"))
    found = components(named.select(F.col("id").alias("a"), F.col("cluster").alias("b")).union(links))
    out = own.select("id").join(counts, "id", "left").join(found.withColumnRenamed("node", "id"), "id", "left")
    component = F.coalesce("component", "id")
    return out.select(
        F.col("id").alias(id_col),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.coalesce(component == F.col("id"), F.lit(True)).alias("kept"),
    )
