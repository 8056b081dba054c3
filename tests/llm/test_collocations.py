import re
from collections import Counter
from fractions import Fraction

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from oracle import compare, connect
from samples import AWKWARD, docs

from driftloom.llm import collocations
from driftloom.llm.catalog import ORACLES, QUERIES
from driftloom.llm.words import Texts, sliced


def pieces_of(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    cut = ([w for w in re.split(r"[\x20\x09]+", p) if w] for p in re.split(r"[.,;:!?\x0A-\x0D]", low))
    return [ws for ws in cut if ws]


def plain(rows, least=30, top=2000):
    """rows: (lang, text)."""
    counts = Counter()
    for lang, text in rows:
        for ws in pieces_of(text):
            for m in (1, 2, 3, 4):
                counts.update((lang or "und", tuple(ws[i : i + m])) for i in range(len(ws) - m + 1))
    often = {k: a for k, a in counts.items() if len(k[1]) > 1 and a >= least}
    out = []
    for (lang, ws), a in often.items():
        longer = [o[1] for o in often if o[0] == lang and len(o[1]) > len(ws) and 100 * often[o] >= 80 * a]
        if any(o[i : i + len(ws)] == ws for o in longer for i in range(len(o) - len(ws) + 1)):
            continue
        sides = [(counts[lang, ws[:k]], counts[lang, ws[k:]]) for k in range(1, len(ws))]
        score, k = min((int(Fraction(2000000 * a, x + y)), k) for k, (x, y) in enumerate(sides))
        n = sum(c for (g, w), c in counts.items() if g == lang and len(w) == 1)
        out.append((lang, " ".join(ws), a, *sides[k], n, score))
    ranked = []
    for lang in {r[0] for r in out}:
        own = sorted((r for r in out if r[0] == lang), key=lambda r: (-r[6], -r[2], r[1].encode()))
        ranked += [(r[0], i, *r[1:]) for i, r in enumerate(own[:top], 1)]
    return sorted(ranked)


def with_langs(spark, rows):
    return spark.createDataFrame([(i, t, g) for i, (g, t) in enumerate(rows)], "doc_id long, text string, lang string")


def got(df):
    return sorted(tuple(r) for r in df.select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect())


def test_all_documents_against_sql(spark):
    sf = "/root/testdata/sf0.01"
    assert compare(QUERIES["op11_collocations"](spark, sf), connect(sf), ORACLES["op11_collocations"]) is None


def test_all_documents_against_plain_counts(spark):
    sf = "/root/testdata/sf0.001"
    rows = [(r.lang, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    want = plain(rows)
    assert len(want) >= 50
    assert got(QUERIES["op11_collocations"](spark, sf)) == want


@pytest.mark.parametrize("trigger", [1, 2, 5, 1000])
def test_every_cut_of_the_texts_counts_the_same(spark, trigger):
    rng = np.random.default_rng(3)
    words = ["a", "b", "ça", "the", "The", "x'y", "日本", "a-b", "q\xa0r"]
    joins = [" ", " ", " ", " ", "  \t", ". ", ",", "\n", "\x0c", " ; "]
    rows = []
    for i in range(300):
        text = "".join(rng.choice(words) + rng.choice(joins) for _ in range(int(rng.integers(0, 40))))
        rows.append((["en", "de", None, "und"][i % 4], text))
    rows += [("en", "one passage that comes back word for word every time")] * 40
    assert got(collocations.collocations(with_langs(spark, rows).repartition(3), least=5, top=50, trigger=trigger)) == plain(rows, 5, 50)


def test_gathering_in_small_parts_and_a_full_filter(spark, monkeypatch):
    rows = [("en", f"w{i % 7} w{i % 5} w{i % 3} w{i % 11} common words here") for i in range(2000)]
    want = plain(rows, 10, 100)
    monkeypatch.setattr(collocations, "FILTER_BITS", 64)
    assert got(collocations.collocations(with_langs(spark, rows), least=10, top=100)) == want


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(st.sampled_from("aB c.\n\t,é日"), max_size=30), max_size=8), st.integers(1, 4))
def test_chunks_give_the_pieces_back(texts, trigger):
    import pyarrow as pa

    for at, part in sliced(pa.array(texts, pa.string()), lower=True):
        pieces, text_of = collocations.pieces_of(part)
        want = [(at + i, ws) for i, t in enumerate(texts[at : at + len(part)]) for ws in pieces_of(t)]
        data = pieces.data.tobytes()
        shown = [data[a:b].decode().split(" ") for a, b in zip(pieces.start, pieces.end)]
        shown = [w for (w,) in shown]
        assert [(at + int(t), shown[a:b]) for t, a, b in zip(text_of, pieces.words[:-1], pieces.words[1:])] == want
        first, last, piece, ends = collocations.chunks_of(pieces, trigger)
        again: dict = {}
        for f, g, p, e in zip(first, last, piece, ends):
            again.setdefault(int(p), []).extend(shown[f : g + 1] if e else shown[f : g + 1 - collocations.OVERLAP])
        assert [again[p] for p in sorted(again)] == [ws for _, ws in want]


def test_filter_keeps_what_was_added():
    keys = np.random.default_rng(1).integers(0, 2**63, 3000, dtype=np.uint64)
    for bits in (64, 1 << 16):
        found = collocations.PhraseFilter(bits)
        for word, bit in found.places(keys):
            np.bitwise_or.at(found.words, word, bit)
        assert found.holds(keys).all()
    others = np.random.default_rng(2).integers(0, 2**63, 3000, dtype=np.uint64)
    assert found.holds(others).mean() < 0.05


def test_scores_beyond_64_bits(spark):
    a = 2**62
    frequent = spark.createDataFrame([("en", "x", a + 7), ("en", "y", a + 1), ("en", "x y", a - 3)], "lang string, phrase string, n long")
    assert [tuple(r) for r in collocations.score_phrases(frequent).collect()] == [("en", "x y", a - 3, a + 7, a + 1, 2000000 * (a - 3) // (2 * a + 8))]


def test_awkward_rows(spark):
    rows = [r for r in AWKWARD if r[0] != 6] * 8
    table = docs(spark, rows, clash=True)
    assert got(collocations.collocations(table, least=8)) == plain([("en", r[1]) for r in rows], 8)
    assert collocations.collocations(docs(spark, [])).count() == 0
    assert collocations.collocations(docs(spark, [(1, None), (2, " .,\n")])).count() == 0
    long = docs(spark, [(1, "again and again " * 50_000)])
    assert got(collocations.collocations(long)) == plain([("en", "again and again " * 50_000)])


def test_an_empty_slice():
    pieces, text = collocations.pieces_of(Texts(np.zeros(0, np.uint8), np.array([0, 0])))
    assert len(text) == 0 and len(collocations.chunks_of(pieces)[0]) == 0
