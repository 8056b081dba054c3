import re

import pytest
from pyspark.sql import functions as F
from samples import AWKWARD, docs

from driftloom.llm import mixing


def water(sizes, weights=(5, 2, 1), cap=3):
    """Targets by resharing again and again what is over the cap."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None] * (None in sizes)
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    total, capped = sum(sizes.values()), {}
    while True:
        free = [s for s in names if s not in capped]
        rest = total - sum(capped.values())
        target = {s: rest * weight[s] / max(1, sum(weight[t] for t in free)) for s in free} | capped
        over = [s for s in free if target[s] > cap * sizes[s] * (1 + 1e-12)]
        if not over:
            return target
        capped |= {s: float(cap * sizes[s]) for s in over}


@pytest.mark.parametrize("sizes", [{"a": 10, "b": 1000, "c": 3, None: 50}, {"a": 0, "b": 5}, {"a": 7}, {f"s{i:02}": 2**i for i in range(20)}, {"B": 9, "a": 9, "é": 9, "": 9}])
def test_targets(spark, sizes):
    rows = [(s, n) for s, n in sizes.items()]
    got = {r.source: r.target for r in mixing.source_targets(spark.createDataFrame(rows, "source string, size long")).collect()}
    want = water(sizes)
    assert got.keys() == want.keys()
    assert all(abs(got[s] - want[s]) <= 1e-9 * max(1, want[s]) for s in want)


def test_whole_table(spark):
    table = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    texts = {r.doc_id: r for r in table.collect()}
    rows = mixing.mix_sources(table).collect()
    assert sorted(r.doc_id for r in rows) == sorted(texts)
    sizes, taken, counts, longest = {}, {}, {}, {}
    for r in rows:
        source = texts[r.doc_id].source
        assert r.size == len(re.findall(r"[^\x20\x09-\x0D]+", texts[r.doc_id].text or ""))
        assert r.taken == r.copies * r.size and 0 <= r.copies <= 3
        sizes[source] = sizes.get(source, 0) + r.size
        taken[source] = taken.get(source, 0) + r.taken
        counts.setdefault(source, []).append(r.copies)
        longest[source] = max(longest.get(source, 0), r.size)
    want = water(sizes)
    for s in sizes:
        assert abs(taken[s] - want[s]) <= max(longest[s] / 2, 1e-6 * want[s]) + 1
        assert abs(sum(counts[s]) - len(counts[s]) * want[s] / sizes[s]) <= 2  # documents are balanced too
        assert max(counts[s]) - min(counts[s]) <= 1


def test_reruns_agree_for_any_partitioning(spark):
    table = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    key = lambda df: sorted((r.doc_id, r.copies) for r in df.collect())
    assert key(mixing.mix_sources(table)) == key(mixing.mix_sources(table.repartition(7)))
    assert key(mixing.mix_sources(table)) != key(mixing.mix_sources(table, seed=8))


def test_many_blocks(spark, monkeypatch):
    monkeypatch.setattr(mixing, "BLOCK", 16)
    rows = [(i, "w " * (i % 37 + 1), "ab"[i % 5 == 0]) for i in range(3000)]
    made = mixing.mix_sources(docs(spark, rows)).collect()
    assert len(made) == 3000
    for source in "ab":
        own = [r for r in made if rows[r.doc_id][2] == source]
        assert abs(sum(r.taken for r in own) - own[0].target) <= 37


def test_awkward_rows(spark):
    made = mixing.mix_sources(docs(spark, [*AWKWARD, (8, "x y", None)], clash=True)).collect()
    assert len(made) == len(AWKWARD) + 1
    assert all(r.size == 0 and r.taken == 0 for r in made if r.doc_id in (1, 2, 3))
    assert mixing.mix_sources(docs(spark, [])).count() == 0
    assert mixing.mix_sources(docs(spark, [(1, None), (2, "")])).agg({"taken": "sum"}).first()[0] == 0


def test_documents_come_as_often_as_taken(spark):
    table = docs(spark, [*[(i, "a b c " * (i + 1), "xyz"[i % 3]) for i in range(60)], (3, "a b c " * 4, "x"), (None, "q", None)], clash=True)
    want = {}
    for r in mixing.mix_sources(table).collect():
        want[r.doc_id] = want.get(r.doc_id, 0) + r.copies
    got = {}
    out = mixing.mixed_documents(table)
    assert out.columns == table.columns
    for r in out.collect():
        got[r.doc_id] = got.get(r.doc_id, 0) + 1
    assert got == {k: v for k, v in want.items() if v}


def test_sources_come_near_their_targets_in_small_tables(spark):
    """Within one and a half per cent: the number of documents is balanced too, which leaves few subsets where nearly all are taken."""
    table = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    found = mixing.mix_sources(table).join(table.select("doc_id", "source"), "doc_id")
    sums = found.groupBy("source").agg(
        F.first("target").alias("target"), F.sum("taken").alias("taken"), F.min(F.when(F.col("size") > 0, F.col("size"))).alias("least")
    )
    for r in sums.collect():
        assert abs(r.taken - r.target) <= max(0.015 * r.target, 3 * r.least), r
