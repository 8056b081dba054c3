"""Alignment of two tokenizers over the same texts: common token ends, groups between them, and links of token pairs.

The ends of the tokens of each tokenizer, in bytes, form an ascending list.
Their intersection is found by galloping: the shorter list drives an exponential
and then a binary search into the longer one, from where its last search ended. The common ends cut both
token lists into groups; differences of their ranks say how many tokens of each side lie in a group.
"""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .byte_bpe import byte_encoder
from .scratch import cut, in_arrow, ship_code

CHUNK_BYTES = 8 << 20
_SLICE_BYTES = 1 << 19
_LANE = 64
_WIDE = 4096  # links of a group from which its distinct ids are counted first


def gallop(driver: np.ndarray, target: np.ndarray) -> np.ndarray:
    """For each driver value, the position of the first target value that is not below it; both ascend strictly.

    The driver is dealt into lanes of ``_LANE`` neighbours that advance in step. A
    lane gallops from its last position: the bound doubles until it is no longer below
    the value, and a binary search within the last doubling ends the step.
    """
    found = np.zeros(len(driver), np.int64)
    if not len(driver):
        return found
    padded = np.append(target, np.iinfo(np.int64).max)
    end = len(target)
    heads = np.arange(0, len(driver), _LANE)
    at = np.searchsorted(target, driver[heads])
    found[heads] = at
    for k in range(1, min(_LANE, len(driver))):
        lanes = heads[: np.searchsorted(heads, len(driver) - k)]
        want, low = driver[lanes + k], at[: len(lanes)]
        bound = np.ones(len(lanes), np.int64)
        below = padded[np.minimum(low + bound, end)] < want
        while below.any():
            bound[below] *= 2
            below = padded[np.minimum(low + bound, end)] < want
        low, high = low + bound // 2, np.minimum(low + bound, end)
        while (low < high).any():
            middle = (low + high) >> 1
            below = padded[middle] < want
            low, high = np.where(below, middle + 1, low), np.where(below, high, middle)
        at = low
        found[lanes + k] = low
    return found


def _sums(values: np.ndarray, edges: np.ndarray) -> np.ndarray:
    """Sums of values between neighbouring edges."""
    total = np.concatenate([[0], np.cumsum(values)])
    return total[edges[1:]] - total[edges[:-1]]


@dataclass
class Vocabulary:
    """The bytes of every id, and the ids in decimal digits."""

    tokens: list[bytes]

    def __post_init__(self):
        self.sizes = np.array([len(t) for t in self.tokens], np.int64)
        width = len(str(max(len(self.tokens) - 1, 0)))
        self.digits = np.array([str(i) for i in range(len(self.tokens))], f"S{width}").view(np.uint8).reshape(-1, width)

    def joined(self, ids: list[int]) -> bytes:
        tokens = self.tokens
        return b"".join([tokens[i] for i in ids])


class Pair:
    """Both tokenizers: A, a byte-level vocabulary file, reads space and text; B, a piece model, adds the space itself."""

    def __init__(self, a_path: str, b_path: str):
        import sentencepiece

        self.encoder = byte_encoder(a_path, plain=True)
        self.pieces = sentencepiece.SentencePieceProcessor(model_file=b_path)
        self.a = Vocabulary(self.encoder.token_bytes())
        self.b = Vocabulary([self._bytes(i) for i in range(self.pieces.get_piece_size())])

    def _bytes(self, i: int) -> bytes:
        piece = self.pieces.id_to_piece(i)
        return bytes([int(piece[3:-1], 16)]) if self.pieces.is_byte(i) else piece.replace("▁", " ").encode()

    def encode(self, texts: list[str | None]) -> tuple[list[np.ndarray], list[np.ndarray]]:
        """Ids of both sides per text; none on either side where a text is empty or a side does not give its bytes back."""
        none = np.zeros(0, np.int64)
        a_ids, b_ids = [], []
        pieces = iter(self.pieces.encode([t for t in texts if t], num_threads=1))
        for text in texts:
            a = b = none
            if text:
                whole = b" " + text.encode()
                ids, other = np.frombuffer(self.encoder.encode(" " + text), "<u4").astype(np.int64), next(pieces)
                if self.a.joined(ids.tolist()) == whole and self.b.joined(other) == whole:
                    a, b = ids, np.array(other, np.int64)
            a_ids.append(a)
            b_ids.append(b)
        return a_ids, b_ids


@functools.lru_cache(maxsize=1)
def tokenizer_pair(a_path: str, b_path: str) -> Pair:
    return Pair(a_path, b_path)


class Aligned:
    """The groups of some texts.

    ``a``, ``b``: ids of all texts; ``a_text``, ``b_text``, ``groups``: where each text's tokens
    and groups begin; ``a_stop``, ``b_stop``: tokens of either side up to the end of each group.
    """

    def __init__(self, pair: Pair, texts: list[str | None]):
        a_ids, b_ids = pair.encode(texts)
        self.pair = pair
        self.a, self.b = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (a_ids, b_ids))
        n_a, n_b = (np.array([len(x) for x in ids], np.int64) for ids in (a_ids, b_ids))
        self.a_text, self.b_text = (np.concatenate([[0], np.cumsum(n)]) for n in (n_a, n_b))
        # both sides of a text have the same bytes, so ends over all texts still meet only within a text
        a_end, b_end = np.cumsum(pair.a.sizes[self.a]), np.cumsum(pair.b.sizes[self.b])
        a_drives = n_a <= n_b
        drivers = np.flatnonzero(np.repeat(a_drives, n_a))
        spots = gallop(a_end[drivers], b_end)
        met = np.append(b_end, -1)[spots] == a_end[drivers]
        a_rank, b_rank = drivers[met], spots[met]
        drivers = np.flatnonzero(np.repeat(~a_drives, n_b))
        spots = gallop(b_end[drivers], a_end)
        met = np.append(a_end, -1)[spots] == b_end[drivers]
        self.a_stop = np.sort(np.concatenate([a_rank, spots[met]])) + 1
        self.b_stop = np.sort(np.concatenate([b_rank, drivers[met]])) + 1
        self.a_start, self.b_start = (np.concatenate([[0], s[:-1]]) if len(s) else s for s in (self.a_stop, self.b_stop))
        self.groups = np.searchsorted(self.a_stop, self.a_text, side="right")

    def digests(self) -> list[str]:
        """Per text, the sha256 of its groups as ``a1,a2|b1;a3|b2,b3``; empty without tokens."""
        a_of, b_of = (np.repeat(np.arange(len(self.a_stop)), s) for s in (self.a_stop - self.a_start, self.b_stop - self.b_start))
        width = max(self.pair.a.digits.shape[1], self.pair.b.digits.shape[1])
        shown = np.zeros((len(self.a) + len(self.b), width + 1), np.uint8)
        for ids, digits, place, stop, last in (
            (self.a, self.pair.a.digits, np.arange(len(self.a)) + self.b_start[a_of], self.a_stop, b"|"),
            (self.b, self.pair.b.digits, np.arange(len(self.b)) + self.a_stop[b_of], self.b_stop, b";"),
        ):
            mark = np.full(len(ids), ord(","), np.uint8)
            mark[stop - 1] = ord(last)
            shown[place, : digits.shape[1]] = digits[ids]
            shown[place, width] = mark
        edges = (self.a_text + self.b_text).tolist()
        return [
            hashlib.sha256(shown[x:y].tobytes().translate(None, b"\0")[:-1]).hexdigest() if y > x else "" for x, y in zip(edges[:-1], edges[1:])
        ]

    def n_links(self) -> np.ndarray:
        """Per text, the pairs of tokens that share a group."""
        return _sums((self.a_stop - self.a_start) * (self.b_stop - self.b_start), self.groups)

    def links(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(text, code, times): the distinct id pairs linked in each text; code is a's id times the size of B, plus b's id.

        A group with many tokens on both sides is counted by its distinct ids, never written out token by token.
        """
        size_b, codes = len(self.pair.b.tokens), len(self.pair.a.tokens) * len(self.pair.b.tokens)
        n_a, n_b = self.a_stop - self.a_start, self.b_stop - self.b_start
        text_of = np.repeat(np.arange(len(self.groups) - 1), np.diff(self.groups))
        many = n_a * n_b
        plain = np.flatnonzero(many <= _WIDE)
        many = many[plain]
        group = np.repeat(plain, many)
        nth = np.arange(len(group)) - np.repeat(np.cumsum(many) - many, many)
        a, b = self.a[self.a_start[group] + nth // n_b[group]], self.b[self.b_start[group] + nth % n_b[group]]
        keys, times = np.unique(text_of[group] * codes + a * size_b + b, return_counts=True)
        wide = np.flatnonzero(n_a * n_b > _WIDE)
        if len(wide):
            all_keys, all_times = [keys], [times]
            for g in wide:
                a, of_a = np.unique(self.a[self.a_start[g] : self.a_stop[g]], return_counts=True)
                b, of_b = np.unique(self.b[self.b_start[g] : self.b_stop[g]], return_counts=True)
                all_keys.append((text_of[g] * codes + a[:, None] * size_b + b).ravel())
                all_times.append((of_a[:, None] * of_b).ravel())
            keys, times = np.concatenate(all_keys), np.concatenate(all_times)
            order = np.argsort(keys, kind="stable")
            keys, first = np.unique(keys[order], return_index=True)
            times = np.add.reduceat(times[order], first)
        return keys // codes, keys % codes, times


def _slices(batches: Iterator[pa.RecordBatch], text_at: int) -> Iterator[tuple[pa.RecordBatch, list, int]]:
    """Rows of about ``_SLICE_BYTES`` of text, their texts, and their bytes."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(text_at)), 0).to_numpy()
        ends = np.cumsum(sizes + 16)
        at = 0
        while at < batch.num_rows:
            before = ends[at - 1] if at else 0
            until = max(at + 1, int(np.searchsorted(ends, before + _SLICE_BYTES, side="right")))
            part = batch.slice(at, until - at)
            yield part, part.column(text_at).to_pylist(), int(ends[until - 1] - before)
            at = until


def _lists(values: np.ndarray, edges: np.ndarray, kind: pa.DataType) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(edges, pa.int32()), pa.array(values, kind))


def _group_rows(a_path: str, b_path: str):
    def align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair = tokenizer_pair(a_path, b_path)
        for rows, texts, _ in _slices(batches, 1):
            got = Aligned(pair, texts)
            per_text = np.diff(got.groups)
            stops = [_lists(s - np.repeat(t[:-1], per_text), got.groups, pa.int32()) for s, t in ((got.a_stop, got.a_text), (got.b_stop, got.b_text))]
            ids = [_lists(x, t, pa.int32()) for x, t in ((got.a, got.a_text), (got.b, got.b_text))]
            yield pa.RecordBatch.from_arrays([rows.column(0), *ids, *stops], ["id", "a_ids", "b_ids", "a_stops", "b_stops"])

    return align


def align_documents(docs: DataFrame, a_tokenizer: str, b_tokenizer: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, a_ids, b_ids, a_stops, b_stops): tokens of both sides, and how many of each lie up to the end of each group.

    Group g holds a_ids[a_stops[g - 1]:a_stops[g]] and b_ids[b_stops[g - 1]:b_stops[g]].
    Texts that are null, empty, or that a side does not give back byte for byte have empty lists.
    Both tokenizers are paths that every executor can read. Rows are independent: repeated and null ids stay as they are.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kind = dict(docs.dtypes)[id_col]
    schema = f"id {kind}, a_ids array<int>, b_ids array<int>, a_stops array<int>, b_stops array<int>"
    return in_arrow(rows, _group_rows(a_tokenizer, b_tokenizer), schema).withColumnRenamed("id", id_col)


_FACTS = ("n_a", "n_b", "n_groups", "n_links")


def _link_rows(a_path: str, b_path: str, chunk_bytes: int):
    """Rows of texts, and after those of a chunk one row with its distinct pairs; texts name pairs by their place in it."""
    lists = [("places", pa.list_(pa.int32())), *((c, pa.list_(pa.int64())) for c in ("times", "codes", "n_docs"))]

    def chunk_rows(number: int, held: list) -> Iterator[pa.RecordBatch]:
        codes, places = np.unique(np.concatenate([h[3] for h in held]), return_inverse=True)
        n_docs = np.bincount(places, minlength=len(codes))  # a text holds a code once
        schema = pa.schema([("chunk", pa.int64()), ("id", held[0][0].type), *((c, pa.int64()) for c in _FACTS), ("digest", pa.string()), *lists])
        at = 0
        for ids, facts, digests, own, edges, times in held:
            arrays = [pa.array(np.full(len(ids), number)), ids, *(pa.array(f) for f in facts), pa.array(digests, pa.string())]
            arrays += [_lists(places[at : at + len(own)], edges, pa.int32()), _lists(times, edges, pa.int64())]
            arrays += [pa.nulls(len(ids), pa.list_(pa.int64()))] * 2
            at += len(own)
            yield pa.RecordBatch.from_arrays(arrays, schema=schema)
        last = [{"chunk": number, "codes": codes, "n_docs": n_docs}]
        yield pa.RecordBatch.from_pylist(last, schema=schema)

    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair = tokenizer_pair(a_path, b_path)
        number = TaskContext.get().partitionId() << 32
        held, size = [], 0
        for rows, texts, n_bytes in _slices(batches, 1):
            got = Aligned(pair, texts)
            text, codes, times = got.links()
            facts = [np.diff(got.a_text), np.diff(got.b_text), np.diff(got.groups), got.n_links()]
            held.append((rows.column(0), facts, got.digests(), codes, np.searchsorted(text, np.arange(len(texts) + 1)), times))
            size += n_bytes
            if size >= chunk_bytes:
                yield from chunk_rows(number, held)
                number, held, size = number + 1, [], 0
        if held:
            yield from chunk_rows(number, held)

    return link


def _weigh(texts: pa.Table, pairs: pa.Table) -> pa.Table:
    """Texts of one chunk with the corpus counts of its pairs."""
    order = np.argsort(pairs.column("place").to_numpy())
    count = pairs.column("count").to_numpy()[order]
    best = pairs.column("best").to_numpy()[order]
    places, times = (texts.column(c) for c in ("places", "times"))
    edges = np.concatenate([[0], np.cumsum(pc.list_value_length(places).to_numpy())]).astype(np.int64)
    place, n = (pc.list_flatten(c).to_numpy() for c in (places, times))
    out = {c: texts.column(c) for c in ("id", *_FACTS)}
    out["n_best"] = pa.array(_sums(np.where(best[place] == count[place], n, 0), edges))
    out["count_sum"] = pa.array(_sums(count[place] * n, edges))
    return pa.table(out | {"groups_sha256": texts.column("digest")})


def link_counts(
    docs: DataFrame, a_tokenizer: str, b_tokenizer: str, id_col: str = "doc_id", text_col: str = "text", chunk_bytes: int = CHUNK_BYTES
) -> DataFrame:
    """Aligns all documents and weighs their links by how many documents hold the same pair of ids linked.

    Returns per row: the id, n_a, n_b (tokens), n_groups, n_links, n_best (links whose count is the
    highest of their A id, ties included), count_sum (over links), groups_sha256.

    Texts are aligned once. Tasks work in chunks of about ``chunk_bytes`` of text and
    write each text's distinct pairs as places in the chunk's list of pairs. Only those lists
    are counted and looked up: a frequent pair is one row per chunk, not per document. Chunks then meet
    their counts again; a chunk's size is bounded, but for a longer single text.

    Texts that are null, empty, or that a side does not give back byte for byte have zeros and ''.
    Each row is a document: repeated rows count as often as they occur; null ids stay. An empty table gives an empty result.
    """
    ship_code(docs.sparkSession)
    kind = dict(docs.dtypes)[id_col]
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    facts = ", ".join(f"{c} long" for c in _FACTS)
    schema = f"chunk long, id {kind}, {facts}, digest string, places array<int>, times array<long>, codes array<long>, n_docs array<long>"
    linked = cut(in_arrow(rows, _link_rows(a_tokenizer, b_tokenizer, chunk_bytes), schema), "links")
    lists = linked.where("codes is not null").select("chunk", F.posexplode(F.arrays_zip("codes", "n_docs")).alias("place", "pair"))
    pairs = lists.select("chunk", "place", F.col("pair.codes").alias("code"), F.col("pair.n_docs").alias("n"))
    size_b = len(tokenizer_pair(a_tokenizer, b_tokenizer).b.tokens)
    counts = pairs.groupBy("code").agg(F.sum("n").alias("count")).withColumn("a", F.floor(F.col("code") / size_b))
    best = counts.groupBy("a").agg(F.max("count").alias("best"))
    known = pairs.select(F.col("chunk").alias("of"), "place", "code").join(counts.join(best, "a").select("code", "count", "best"), "code").drop("code")
    texts = linked.where("codes is null").select("chunk", "id", *_FACTS, "digest", "places", "times")
    out = f"id {kind}, {facts}, n_best long, count_sum long, groups_sha256 string"
    summed = texts.groupBy("chunk").cogroup(known.groupBy("of")).applyInArrow(_weigh, out)
    return summed.withColumnRenamed("id", id_col)
