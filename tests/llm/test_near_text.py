import itertools
import re

import pytest
from samples import AWKWARD, docs

from driftloom.llm import near_text
from driftloom.llm.components import components


def sets_of(rows):
    low = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
    out = {}
    for i, t in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(low))
        out[i] = {tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()
    return out


def groups(nodes, links):
    top = {n: n for n in nodes}

    def find(n):
        while top[n] != n:
            n = top[n]
        return n

    for a, b in links:
        a, b = sorted((find(a), find(b)))
        top[b] = a
    return {n: find(n) for n in nodes}


def brute(rows, over):
    sets = sets_of(rows)
    links = [
        (a, b)
        for a, b in itertools.combinations([i for i in sets if sets[i]], 2)
        if len(sets[a]) * 100 >= over * len(sets[b]) and len(sets[b]) * 100 >= over * len(sets[a])
        if 100 * len(sets[a] & sets[b]) >= over * len(sets[a] | sets[b])
    ]
    return {i: (len(sets[i]), c) for i, c in groups(sets, links).items()}


@pytest.mark.parametrize("over", [80, 85])
def test_all_documents_against_brute_force(spark, over):
    table = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = [tuple(r) for r in table.select("doc_id", "text").collect()]
    want = brute(rows, over)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in near_text.near_duplicates(table, over=over).collect()}
    assert got == want


def test_a_chain_that_no_hub_sees(spark):
    """Each text is close to the next one only; the smallest id is far from most."""
    words = [f"w{i}" for i in range(100)]
    rows = []
    for k in range(12):
        text = [f"x{k}{i}" if i in range(8 * (k - 1), 8 * k) and k else w for i, w in enumerate(words)]
        rows.append((k, " ".join([w if i >= 8 * k else f"n{i}" for i, w in enumerate(text)])))
    want = brute(rows, 80)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in near_text.near_duplicates(docs(spark, rows), over=80).collect()}
    assert got == want


def test_awkward_rows(spark):
    rows = near_text.near_duplicates(docs(spark, AWKWARD, clash=True)).collect()
    assert len(rows) == len(AWKWARD)
    by_id = {}
    for r in rows:
        by_id.setdefault(r.doc_id, []).append(r)
    assert all(r.n_shingles == 0 and r.kept and r.component_id == r.doc_id for i in (1, 2, 3) for r in by_id[i])
    assert [r.component_id for i in (4, 5) for r in by_id[i]] == [4, 4, 4]
    assert [r.kept for r in by_id[5]] == [False, False]
    assert all(r.component_id is None and r.kept for r in by_id[None])
    assert by_id[6][0].kept


def test_empty_table(spark):
    assert near_text.near_duplicates(docs(spark, [])).count() == 0


def test_components(spark):
    links = [(5, 4), (4, 3), (3, 2), (2, 1), (9, 8), (8, 9), (7, 7)] + [(100, i) for i in range(50, 100)]
    got = {r.node: r.component for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    want = groups({n for e in links for n in e}, links)
    assert got == {n: c for n, c in want.items() if n != 7}
