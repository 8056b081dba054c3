import numpy as np
import pyarrow as pa
from test_near_text import groups

from driftloom.llm import near_vectors


def brute(rows, threshold):
    ids = [i for i, v in rows if v is not None and len(v) and None not in v and np.isfinite(v).all() and np.any(v)]
    vectors = {i: np.array(v, float) / np.linalg.norm(v) for i, v in rows if i in set(ids)}
    links = [(a, b) for n, a in enumerate(ids) for b in ids[n + 1 :] if len(vectors[a]) == len(vectors[b]) and vectors[a] @ vectors[b] >= threshold]
    count = {i: sum(i in e for e in links) for i, _ in rows}
    return {i: (count[i], c) for i, c in groups([i for i, _ in rows], links).items()}


def run(spark, rows):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    return {r.vec_id: (r.n_links, r.component_id) for r in near_vectors.near_vectors(df).collect()}


def made(n=400, dim=16, seed=1):
    """Tight groups, a loose one near the threshold, and single vectors."""
    rng = np.random.default_rng(seed)
    rows = []
    for i in range(n):
        base = np.random.default_rng(i % 20 if i < 200 else i).standard_normal(dim)
        spread = 0.02 if i < 100 else 0.1 if i < 200 else 0.0
        rows.append((i, (base + spread * rng.standard_normal(dim)).astype(np.float32).astype(float).tolist()))
    return rows


def test_links_against_brute_force(spark):
    rows = made()
    want, got = brute(rows, 0.95), run(spark, rows)
    found, there = sum(n for n, _ in got.values()), sum(n for n, _ in want.values())
    assert all(got[i][0] <= want[i][0] for i in want)  # none below the threshold
    assert found >= 0.97 * there


def loose(n=1500, dim=64, seed=3):
    """A group around one direction in which pairs are similar but no vector is within half the angle of many."""
    rng = np.random.default_rng(seed)
    base = rng.standard_normal(dim)
    return [(i, (base + 0.19 * rng.standard_normal(dim)).astype(np.float32).astype(float).tolist()) for i in range(n)]


def test_loose_group_is_counted_in_blocks_and_parts(spark, monkeypatch):
    """Every link once, whatever the blocks and parts; what comes out of a block grows with its rows, not with pairs."""
    rows = loose()
    units = near_vectors.unit(np.array([v for _, v in rows]))
    want = (units @ units.T >= 0.95).sum(axis=1) - 1
    results = []
    for strays, members in ((512, 8192), (100, 300)):
        monkeypatch.setattr(near_vectors, "STRAYS_PER_BLOCK", strays)
        monkeypatch.setattr(near_vectors, "MEMBERS_PER_PART", members)
        results.append(run(spark, rows))
    assert results[0] == results[1]
    found, there = sum(n for n, _ in results[0].values()), int(want.sum())
    assert there > 500_000 and 0.97 * there <= found <= there
    assert all(n <= want[i] for i, (n, _) in results[0].items())
    assert {c for _, c in results[0].values()} == {0}


def test_blocks_give_every_pair_once():
    """Rows of one bucket in several blocks and parts against plain loops."""
    rows = loose(300, 16, 5)
    units = near_vectors.unit(np.array([v for _, v in rows]))
    blocks, parts = 3, 2
    own = [None if i % 4 == 0 else i % blocks for i in range(300)]  # a quarter is the main cluster
    cluster = [0 if o is None else i for i, o in enumerate(own)]
    table = []
    for i, o in enumerate(own):
        if o is not None:
            table += [(7, 16, o, part, 0, i, cluster[i]) for part in range(parts)]
        table += [(7, 16, block, i % parts, 1, i, cluster[i]) for block in range(blocks if o is None else o)]
    table.sort(key=lambda r: r[:5])
    keys = [[1 + (r[5] % 2), 7] for r in table]  # pairs of equal parity met in an earlier table
    columns = [pa.array(c, pa.int64()) for c in zip(*table)]
    batch = pa.RecordBatch.from_arrays(
        [*columns, pa.array([units[r[5]].tolist() for r in table]), pa.array(keys, pa.list_(pa.int64()))],
        ["key", "size", "block", "part", "role", "id", "cluster", "v", "keys"],
    )
    want = [0] * 300
    edges = []
    for i in range(300):
        for j in range(i):
            if cluster[i] != cluster[j] and (i - j) % 2 and units[i] @ units[j] >= 0.95:
                want[i] += 1
                want[j] += 1
                edges.append((j, i))
    for size in (len(table), 37):
        got, joined = [0] * 300, []
        for out in near_vectors._across(0.95)(iter(batch.slice(at, size) for at in range(0, len(table), size))):
            for a, b, n in zip(*(c.to_pylist() for c in out.columns)):
                got[a] += n
                joined += [] if b is None else [(a, b)]
        assert got == want and sum(want) > 1000
        assert groups(range(300), joined) == groups(range(300), edges)
        assert {tuple(sorted(e)) for e in joined} <= set(edges)


def test_whole_table_against_brute_force(spark):
    table = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    rows = [(r.vec_id, list(r.embedding)) for r in table.collect()]
    assert run(spark, rows) == brute(rows, 0.95)


def test_awkward_rows(spark):
    rows = [
        (1, None), (2, []), (3, [0.0, 0.0]), (4, [1.0, float("nan")]), (5, [1.0, float("inf")]), (6, [1.0, None]),
        (7, [1.0, 0.0]), (8, [2.0, 0.0]), (9, [1e-30, 0.0]), (10, [1.0, 0.0, 0.0]), (11, [-1.0, 0.0]), (None, [1.0, 0.0]), (8, [2.0, 0.0]),
    ]
    df = spark.createDataFrame([(*r, "x", "y") for r in rows], "vec_id long, embedding array<float>, v string, key string")
    got = sorted(((r.vec_id or 0, r.n_links, r.component_id, r.kept) for r in near_vectors.near_vectors(df).collect()))
    alone = [(i, 0, i, True) for i in (1, 2, 3, 4, 5, 6)]
    same = [(7, 2, 7, True), (8, 2, 7, False), (8, 2, 7, False), (9, 2, 7, False)]
    assert got == [(0, 0, None, True), *alone, *same, (10, 0, 10, True), (11, 0, 11, True)]


def test_empty_table(spark):
    assert near_vectors.near_vectors(spark.createDataFrame([], "vec_id long, embedding array<float>")).count() == 0


def test_plan_grows_slowly():
    (k1, t1), (k2, t2) = near_vectors.plan(10_000), near_vectors.plan(100_000_000)
    assert k1 < k2 < 2.5 * k1 and t1 < t2 < 10 * t1
