import hashlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from samples import AWKWARD, docs

from driftloom.llm import alignment
from driftloom.llm.catalog import QUERIES, vocabulary_path

A, B = vocabulary_path("byte_bpe_50k.json"), vocabulary_path("piece_bpe_32k.model")


@settings(max_examples=300, deadline=None)
@given(st.sets(st.integers(0, 3000), max_size=400), st.sets(st.integers(0, 3000), max_size=60), st.integers(1, 9))
def test_galloping_finds_each_place(target, driver, lane):
    before, alignment._LANE = alignment._LANE, lane
    try:
        target, driver = (np.array(sorted(x), np.int64) for x in (target, driver))
        assert alignment.gallop(driver, target).tolist() == np.searchsorted(target, driver).tolist()
        assert alignment.gallop(target, driver).tolist() == np.searchsorted(driver, target).tolist()
    finally:
        alignment._LANE = before


class Plain:
    """Both tokenizers, token by token."""

    def __init__(self):
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(A)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=B)
        shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
        hidden = [b for b in range(256) if b not in shown]
        self.byte = {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(hidden)}

    def a_bytes(self, i):
        return bytes(self.byte[c] for c in self.a.id_to_token(i))

    def b_bytes(self, i):
        piece = self.b.id_to_piece(i)
        return bytes([int(piece[3:5], 16)]) if self.b.is_byte(i) else piece.replace("▁", " ").encode()

    def groups(self, text):
        if not text:
            return []
        whole = (" " + text).encode()
        a = [(i, self.a_bytes(i)) for i in self.a.encode(" " + text, add_special_tokens=False).ids]
        b = [(i, self.b_bytes(i)) for i in self.b.encode(text)]
        if b"".join(x for _, x in a) != whole or b"".join(x for _, x in b) != whole:
            return []
        sides = []
        for tokens in (a, b):
            at, ends = 0, {}
            for i, x in tokens:
                at += len(x)
                ends[at] = i
            sides.append(ends)
        common, out = set(sides[0]) & set(sides[1]), []
        for ends in sides:
            cuts, now = [[] for _ in common], 0
            for end, i in ends.items():
                cuts[now].append(i)
                now += end in common
            out.append(cuts)
        out = list(zip(*out))
        return out


def plain_result(rows):
    plain, per_row, count = Plain(), [], Counter()
    for i, text in rows:
        groups = plain.groups(text)
        links = [(a, b) for left, right in groups for a in left for b in right]
        count.update(set(links))
        per_row.append((i, groups, links))
    best = {}
    for (a, _), n in count.items():
        best[a] = max(best.get(a, 0), n)
    out = []
    for i, groups, links in per_row:
        shown = ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in groups)
        out.append(
            (i, sum(len(a) for a, _ in groups), sum(len(b) for _, b in groups), len(groups), len(links),
             sum(count[x] == best[x[0]] for x in links), sum(count[x] for x in links), hashlib.sha256(shown.encode()).hexdigest() if groups else "")
        )
    return out


NAMES = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
ODD = ["a  b ", " x", "▁x", "x <|endoftext|> y <s>", "<0x41>", "é ﬁ Å", "日本語の文 漢字 😀", "tab\tand\r\n\nlines ", "​zero\x00", "ab" * 3000, "1234567890 " * 30, "日本" * 2500, "ÿþ ½Ⅷ"]


def rows_of(df):
    return sorted((tuple(r) for r in df.select(*NAMES).collect()), key=lambda r: (r[0] is None, r))


def by_id(rows):
    return sorted(rows, key=lambda r: (r[0] is None, r))


def test_the_query_on_a_small_table(spark):
    """All documents of the smallest table."""
    sf = "/root/testdata/sf0.001"
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    assert rows_of(QUERIES["op12_alignment"](spark, sf)) == by_id(plain_result(rows))


def test_odd_texts_in_small_chunks(spark, monkeypatch):
    rows = [(i, t) for i, t in enumerate(ODD * 2)]
    want = by_id(plain_result(rows))
    for chunk in (1, 3000, alignment.CHUNK_BYTES):
        assert rows_of(alignment.link_counts(docs(spark, rows).repartition(3), A, B, chunk_bytes=chunk)) == want


def test_awkward_rows(spark):
    got = rows_of(alignment.link_counts(docs(spark, AWKWARD, clash=True), A, B))
    assert got == by_id(plain_result(AWKWARD))
    assert alignment.link_counts(docs(spark, []), A, B).count() == 0
    assert rows_of(alignment.link_counts(docs(spark, [(1, None), (2, "")]), A, B)) == [(i, 0, 0, 0, 0, 0, 0, "") for i in (1, 2)]


def test_wide_groups_are_counted_by_distinct_ids(monkeypatch):
    pair = alignment.tokenizer_pair(A, B)
    texts = [*ODD, "日本語テキスト" * 40]
    want = [x.tolist() for x in alignment.Aligned(pair, texts).links()]
    monkeypatch.setattr(alignment, "_WIDE", 1)
    assert [x.tolist() for x in alignment.Aligned(pair, texts).links()] == want


@pytest.mark.parametrize("clash", [False, True])
def test_groups_as_token_ranges(spark, clash):
    rows = [(i, t) for i, t in enumerate([*ODD, None, ""])]
    plain = Plain()
    for r in alignment.align_documents(docs(spark, rows, clash=clash), A, B).collect():
        ranges = zip([0, *r.a_stops], r.a_stops, [0, *r.b_stops], r.b_stops)
        assert [(r.a_ids[a:b], r.b_ids[c:d]) for a, b, c, d in ranges] == plain.groups(rows[r.doc_id][1])
