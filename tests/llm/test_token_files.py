import glob
import zlib

import numpy as np
import pyarrow.parquet as pq
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from samples import AWKWARD, docs

from driftloom.llm import byte_bpe, token_files
from driftloom.llm.catalog import QUERIES, vocabulary_path

PATH = vocabulary_path("byte_bpe_50k.json")


def _tokenizer(plain, kept={}):  # noqa: B006
    if plain not in kept:
        from tokenizers import Tokenizer

        kept[plain] = Tokenizer.from_file(PATH)
        kept[plain].encode_special_tokens = plain
    return kept[plain]


def ids_of(text, plain=False):
    return _tokenizer(plain).encode(text, add_special_tokens=False).ids


ODD = ["It's  I'LL\t\tcan't \n", "x<|endoftext|>y", "a\x1cb\x85 \xa0c\x1f d", "日本語 漢字  ", "😀👍🏽", "½ Ⅷ 12 34a", "ǅɐé é", "   ", "\r\n\r\n x", "a \n b\n  c ", " a", "a  b \xa0 c \x85d ", "end "]


@pytest.mark.parametrize("plain", [False, True])
@pytest.mark.parametrize("text", ODD)
def test_encoder_on_odd_texts(text, plain):
    assert np.frombuffer(byte_bpe.byte_encoder(PATH, plain).encode(text), "<u4").tolist() == ids_of(text, plain)


@settings(max_examples=400, deadline=None)
@given(st.text(max_size=40) | st.text(st.sampled_from("aB'sdlvreT.,!1é ñ\n\t\xa0\x85<|>́ß"), max_size=40))
def test_encoder_equals_the_tokenizer(text):
    assert np.frombuffer(byte_bpe.byte_encoder(PATH).encode(text), "<u4").tolist() == ids_of(text)


def test_a_full_cache_is_emptied(monkeypatch):
    monkeypatch.setattr(byte_bpe, "CACHE_PIECES", 3)
    text = "one two three four five one two three " * 3
    assert np.frombuffer(byte_bpe.ByteEncoder(PATH).encode(text), "<u4").tolist() == ids_of(text)


def plain_rows(rows):
    """(id, start, n_tokens, crc) by the plain tokenizer, one text after another."""
    made = []
    for i, text in rows:
        data = np.array([*ids_of(text or ""), 2], "<u4").tobytes()
        made.append((i, len(data) // 4, zlib.crc32(data)))
    made.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    out, at = [], 0
    for i, n, crc in made:
        out.append((i, at, n, crc))
        at += n
    return out


def test_all_documents(spark):
    sf = "/root/testdata/sf0.01"
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    got = sorted(tuple(r) for r in QUERIES["op13_token_files"](spark, sf).select("doc_id", "start", "n_tokens", "ids_crc32").collect())
    assert got == plain_rows(rows)


@pytest.mark.parametrize("encoding", token_files.ENCODINGS)
def test_encodings_row_groups_and_page_indexes(spark, tmp_path, encoding):
    rows = [(i, f"text {i} of many words " * 8) for i in range(5000)]
    path = str(tmp_path / "files")
    token_files.write_token_files(
        docs(spark, rows).repartition(3), path, PATH, metadata=["lang", "source"], encoding=encoding, text_bytes_per_file=200_000, row_group_bytes=8000, page_bytes=4096
    )
    files = sorted(glob.glob(f"{path}/tokens/*.parquet"))
    assert len(files) == -(-sum(len(t) for _, t in rows) // 200_000)
    last = -1
    for file in files:
        read = pq.ParquetFile(file)
        assert read.metadata.num_row_groups > 1
        for g in range(read.metadata.num_row_groups):
            columns = {read.metadata.row_group(g).column(c).path_in_schema: read.metadata.row_group(g).column(c) for c in range(read.metadata.num_columns)}
            assert all(c.has_offset_index and c.has_column_index for c in columns.values())
            found = columns["ids.list.element"].encodings
            if encoding == "delta":
                assert "DELTA_BINARY_PACKED" in found
            else:
                assert any("DICTIONARY" in e for e in found)
        ids = read.read(["id"]).column(0).to_pylist()
        assert ids == sorted(ids) and ids[0] > last
        last = ids[-1]
    got = sorted(tuple(r) for r in token_files.checksums(spark, path).collect())
    assert got == plain_rows(rows)


def test_selective_reads(spark, tmp_path):
    rows = [(i, f"text {i} of some words " * (i % 7 + 1)) for i in range(3000)]
    path = str(tmp_path / "files")
    token_files.write_token_files(docs(spark, rows), path, PATH, metadata=["lang"], text_bytes_per_file=30_000, row_group_bytes=8000)
    stream = [x for _, t in rows for x in [*ids_of(t), 2]]
    for start, stop in [(0, 10), (8990, 9010), (12_345, 23_456), (len(stream) - 3, len(stream) + 50), (10**9, 10**9 + 5)]:
        parts = sorted((r.start, r.ids) for r in token_files.read_span(spark, path, start, stop).collect())
        assert [x for _, p in parts for x in p] == stream[start:stop]
        if parts:
            assert parts[0][0] == start
    one = token_files.read_tokens(spark, path).where("id = 1234").select("meta.lang", "ids")
    assert one.collect()[0].ids == [*ids_of(rows[1234][1]), 2]
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(id,1234)" in plan and "position" not in plan.split("ReadSchema")[1]
    facts = token_files.read_index(spark, path).select("id", "n_tokens")
    assert "ids" not in facts._jdf.queryExecution().executedPlan().toString()


def test_repeated_ids_spread_over_files(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(token_files, "PAGE_ROWS", 200)
    rows = [(7, "the same text")] * 3000 + [(i, f"other {i}") for i in range(100)]
    path = str(tmp_path / "files")
    token_files.write_token_files(docs(spark, rows), path, PATH, text_bytes_per_file=4000)
    sizes = [pq.ParquetFile(f).metadata.num_rows for f in glob.glob(f"{path}/tokens/*.parquet")]
    assert len(sizes) > 8 and max(sizes) < 1500
    assert sorted(tuple(r) for r in token_files.checksums(spark, path).collect()) == plain_rows(rows)


def test_awkward_rows(spark, tmp_path):
    path = str(tmp_path / "files")
    token_files.write_token_files(docs(spark, AWKWARD, clash=True), path, PATH)
    got = sorted((tuple(r) for r in token_files.checksums(spark, path).collect()), key=lambda r: r[1])
    assert got == plain_rows(AWKWARD)
    empty = str(tmp_path / "empty")
    token_files.write_token_files(docs(spark, []), empty, PATH)
    assert token_files.checksums(spark, empty).count() == 0
    assert token_files.read_span(spark, empty, 0, 10).count() == 0
    with pytest.raises(ValueError):
        token_files.write_token_files(docs(spark, []), empty, PATH, encoding="plain")


def test_starts_over_many_files(spark, monkeypatch):
    monkeypatch.setattr(token_files, "_PARTS_PER_BLOCK", 3)
    rows = spark.range(200).selectExpr("(id div 10) << 33 | id % 10 as position", "id % 5 + 1 as n_tokens")
    at = 0
    for r in sorted(token_files.with_starts(rows).collect()):
        assert r.start == at
        at += r.n_tokens
