import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from samples import AWKWARD, docs

from driftloom.llm import packing
from driftloom.llm.catalog import tokenizer_path

ODD = ["It's   I'LL can't", "x<|endoftext|>y", "ΣΑΣ Σ", "İstanbul ǅ", "é ́e é", "a b c\x1cd", "日本語 漢字", "😀👍🏽", "12 34a ½ Ⅷ", "​zero‍", "''s 's's", "A!!! b&&&", "ﬁ Å Å ẞ"]


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(tokenizer_path())


def ids(data):
    return np.frombuffer(data, "<u4").tolist()


@pytest.mark.parametrize("text", ODD)
def test_encoder_on_odd_texts(tokenizer, text):
    assert ids(packing.encoder(tokenizer_path()).encode(text)) == tokenizer.encode(text, add_special_tokens=False).ids


@settings(max_examples=400, deadline=None)
@given(st.text(max_size=40) | st.text(st.sampled_from("aB'sdlvreT.,!1é ñ\n\t<|>́ß"), max_size=40))
def test_encoder_equals_the_tokenizer(text):
    full = _full(text)
    assert ids(packing.encoder(tokenizer_path()).encode(text)) == full


def _full(text, kept=[]):  # noqa: B006
    if not kept:
        from tokenizers import Tokenizer

        kept.append(Tokenizer.from_file(tokenizer_path()))
    return kept[0].encode(text, add_special_tokens=False).ids


def check(rows, want_ids, capacity=packing.CAPACITY):
    """Pieces cut and hashed rightly, sequences gapless and within capacity; returns the number of sequences."""
    by_doc, by_sequence = {}, {}
    for r in rows:
        by_doc.setdefault(r.doc_id, []).append(r)
        by_sequence.setdefault(r.sequence_id, []).append((r.offset, r.length))
    assert set(by_doc) == set(want_ids)
    for i, pieces in by_doc.items():
        pieces.sort(key=lambda r: r.piece)
        whole = want_ids[i]
        assert [r.piece for r in pieces] == list(range(-(-len(whole) // capacity)))
        for r in pieces:
            part = whole[r.piece * capacity : (r.piece + 1) * capacity]
            assert (r.start, r.length) == (r.piece * capacity, len(part))
            assert r.ids_crc32 == zlib.crc32(np.array(part, "<u4").tobytes())
    for parts in by_sequence.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    return len(by_sequence)


def test_all_documents(spark, tokenizer):
    table = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    want = {r.doc_id: [*tokenizer.encode(r.text, add_special_tokens=False).ids, 1] for r in table.collect()}
    used = check(packing.pack_documents(table, tokenizer_path()).collect(), want)
    assert used <= -(-sum(map(len, want.values())) // packing.CAPACITY) + 1


def test_token_ids_come_back(spark, tokenizer):
    rows = [(i, f"some words number {i} " * (i + 1)) for i in range(40)]
    packed = packing.pack_documents(docs(spark, rows), tokenizer_path(), capacity=64, with_ids=True)
    got = {r.sequence_id: r.ids for r in packing.sequences(packed).collect()}
    want = {i: [*tokenizer.encode(t, add_special_tokens=False).ids, 1] for i, t in rows}
    for r in packed.collect():
        assert got[r.sequence_id][r.offset : r.offset + r.length] == want[r.doc_id][r.start : r.start + r.length]


def test_a_task_leaves_no_cache_behind():
    """Python workers live on: kept words would add to the memory of whatever they run next."""
    import pyarrow as pa

    coder = packing.encoder(tokenizer_path())
    batch = pa.RecordBatch.from_arrays([pa.array([1, 2]), pa.array(["some plain words", "and others"])], ["id", "text"])
    pieces = packing._cutter(tokenizer_path(), 4096, 1, False)(iter([batch, batch]))
    first = next(pieces)
    assert coder.chunks and coder.pieces  # words are kept from batch to batch
    assert first.equals(next(pieces)) and next(pieces, None) is None
    assert not coder.chunks and not coder.pieces
    stopped = packing._cutter(tokenizer_path(), 4096, 1, False)(iter([batch, batch]))
    next(stopped)
    stopped.close()  # a task that ends early
    assert not coder.chunks and not coder.pieces


def test_awkward_rows(spark, tokenizer):
    unlike = [r for r in AWKWARD if r[0] not in (5, None)]
    want = {i: [*tokenizer.encode(t or "", add_special_tokens=False).ids, 1] for i, t in unlike}
    check(packing.pack_documents(docs(spark, unlike, clash=True), tokenizer_path()).collect(), want)
    everything = packing.pack_documents(docs(spark, AWKWARD), tokenizer_path()).collect()
    assert len([r for r in everything if r.doc_id == 5]) == 2 and len([r for r in everything if r.doc_id is None]) == 2
    assert packing.pack_documents(docs(spark, []), tokenizer_path()).count() == 0


@settings(max_examples=200, deadline=None)
@given(st.integers(0, 40), st.dictionaries(st.integers(1, 20), st.integers(1, 3), max_size=6))
def test_fullest_is_the_best_subset(room, available):
    reach = {0}
    for length, count in available.items():
        for _ in range(count):
            reach |= {r + length for r in reach if r + length <= room}
    chosen = packing.fullest(room, sorted(available.items(), reverse=True))
    assert sum(chosen) == max(reach)
    assert all(chosen.count(k) <= available[k] for k in chosen)


def test_a_frequent_length_is_ranked_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(packing, "RANK_BLOCK", 100)
    pieces = spark.range(5000).selectExpr("id", "0 as piece", "0L as start", "if(id % 3 = 0, 1000L, id % 700 + 1) as length", "id as ids_crc32")
    rows = packing.pack(pieces).withColumnRenamed("id", "doc_id").collect()
    slots = {(r.sequence_id, r.offset) for r in rows}
    assert len(rows) == len(slots) == 5000
    by_sequence = {}
    for r in rows:
        by_sequence.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in by_sequence.values():
        parts.sort()
        assert all(a[0] + a[1] == b[0] for a, b in zip(parts, parts[1:])) and parts[0][0] == 0
        assert sum(n for _, n in parts) <= 4096
    assert len(by_sequence) <= 1.01 * sum(r.length for r in rows) / 4096 + 1
