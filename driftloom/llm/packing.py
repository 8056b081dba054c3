"""Best-fit packing of token sequences by minimum bin slack."""

from __future__ import annotations

import functools
import unicodedata
import zlib
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .scratch import cut, in_arrow

CAPACITY = 4096
END_ID = 1
RANK_BLOCK = 20_000
CACHE_WORDS = 900_000
# The pre-tokens of this tokenizer family: fixed by its vocabulary file.
_PIECES = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")


class Encoder:
    """Token ids of whole texts, as little-endian unsigned 32-bit integers.

    The tokenizer treats the text between two blanks on its own, so ids are
    kept per such chunk and per pre-token; both caches are emptied when they hold
    ``CACHE_WORDS`` entries, and by ``forget``. Chunks with anything beyond letters, digits and
    common marks of the Latin script go through the tokenizer itself.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.chunks: dict[str, bytes] = {}
        self.pieces: dict[str, bytes] = {}
        # byte-level alphabet: printable bytes stand for themselves, the others for code points from 256 on
        printable = {*range(33, 127), *range(161, 173), *range(174, 256)}
        others = iter(range(256, 512))
        self.alphabet = {b: b if b in printable else next(others) for b in range(256)}

    def forget(self) -> None:
        """A Python worker lives on after its task; what it kept would stand beside whatever it runs next."""
        self.chunks.clear()
        self.pieces.clear()

    def _piece(self, piece: str) -> bytes:
        if (got := self.pieces.get(piece)) is None:
            if len(self.pieces) >= CACHE_WORDS:
                self.pieces.clear()
            ids = [t.id for t in self.model.tokenize(piece.encode().decode("latin-1").translate(self.alphabet))]
            got = self.pieces[piece] = np.array(ids, "<u4").tobytes()
        return got

    def _chunk(self, chunk: str) -> bytes:
        if chunk.isascii() or max(chunk) < "ɐ" and unicodedata.is_normalized("NFC", chunk) and "İ" not in chunk:
            if not any(s in chunk for s in self.special):
                return b"".join([self._piece(p) for p in _PIECES.findall(chunk.lower())])
        return np.array(self.tokenizer.encode(chunk, add_special_tokens=False).ids, "<u4").tobytes()

    def encode(self, text: str) -> bytes:
        found, get, out = self.chunks, self.chunks.get, []
        for chunk in text.replace("\n", " ").split(" "):
            if not chunk:
                continue
            ids = get(chunk)
            if ids is None:
                ids = self._chunk(chunk)
                if len(chunk) <= 64:
                    if len(found) >= CACHE_WORDS:
                        found.clear()
                    found[chunk] = ids
            out.append(ids)
        return b"".join(out)


@functools.lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    return Encoder(path)


def _cutter(path: str, capacity: int, end_id: int, with_ids: bool):
    end = np.array([end_id], "<u4").tobytes()

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoder(path)
        encode = coder.encode
        try:
            for batch in batches:
                row, number, start, length, crc, ids = [], [], [], [], [], []
                for i, text in enumerate(batch.column(1).to_pylist()):
                    data = (encode(text) if text else b"") + end
                    for k, at in enumerate(range(0, len(data), 4 * capacity)):
                        part = data[at : at + 4 * capacity]
                        row.append(i)
                        number.append(k)
                        start.append(at // 4)
                        length.append(len(part) // 4)
                        crc.append(zlib.crc32(part))
                        if with_ids:
                            ids.append(np.frombuffer(part, "<u4").astype(np.int32))
                arrays = [batch.column(0).take(pa.array(row, pa.int64())), pa.array(number, pa.int32())]
                arrays += [pa.array(x, pa.int64()) for x in (start, length, crc)]
                names = ["id", "piece", "start", "length", "ids_crc32"]
                if with_ids:
                    arrays, names = [*arrays, pa.array(ids, pa.list_(pa.int32()))], [*names, "ids"]
                yield pa.RecordBatch.from_arrays(arrays, names)
        finally:
            coder.forget()

    return pieces


def token_pieces(
    docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY, end_id: int = END_ID, with_ids: bool = False
) -> DataFrame:
    """(id, piece, start, length, ids_crc32 and, if asked for, ids): each document's ids and the end id, cut at ``capacity``."""
    kind = dict(docs.dtypes)[id_col]
    schema = f"id {kind}, piece int, start long, length long, ids_crc32 long" + ", ids array<int>" * with_ids
    return in_arrow(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")), _cutter(tokenizer, capacity, end_id, with_ids), schema)


def fullest(room: int, available: Iterable[tuple[int, int]]) -> list[int]:
    """Lengths, longest first, that fill ``room`` as far as any combination of (length, count) can.

    Bit s of a bitset says that sum s can be reached. Each length is shifted
    in as often as it is there and useful; the steps are kept to trace the fullest sum back.
    """
    reach, mask, steps = 1, (1 << (room + 1)) - 1, []
    for length, count in available:
        if length > room:
            continue
        for _ in range(min(count, room // length)):
            grown = (reach | reach << length) & mask
            if grown == reach:
                break
            steps.append((length, reach))
            reach = grown
        if reach >> room:
            break
    total, chosen = reach.bit_length() - 1, []
    for length, before in reversed(steps):
        if not before >> total & 1:  # needs this one more
            chosen.append(length)
            total -= length
    return sorted(chosen, reverse=True)


def slack_plan(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[list[int], int]]:
    """Bins as (lengths, how many such bins) by minimum bin slack.

    Every bin begins with the longest length left; a subset-sum over the
    other lengths finds the fullest combination with it. The combination is
    removed as many times over as all of its lengths last, so each step uses up a
    length or all but a few of it, and the plan is bounded by the number of lengths, not of sequences.
    """
    left = {k: v for k, v in sorted(counts.items(), reverse=True) if v > 0}
    plan = []
    while left:
        longest = next(iter(left))
        left[longest] -= 1
        bin_ = [longest, *fullest(capacity - longest, left.items())]
        left[longest] += 1
        uses = Counter(bin_)
        times = min(left[k] // n for k, n in uses.items())
        for k, n in uses.items():
            left[k] -= n * times
            if not left[k]:
                del left[k]
        plan.append((bin_, times))
    return plan


class _Slots:
    """Where the n-th sequence of a length goes: bins and offsets, looked up by rank."""

    def __init__(self, plan: list[tuple[list[int], int]]):
        taken: Counter[int] = Counter()
        by_length: dict[int, list[tuple[int, int, int]]] = {}
        first_bin = 0
        for bin_, times in plan:
            offset = 0
            for length in bin_:
                by_length.setdefault(length, []).append((taken[length], first_bin, offset))
                taken[length] += times
                offset += length
            first_bin += times
        self.table = {k: tuple(np.array(c, np.int64) for c in zip(*v)) for k, v in by_length.items()}
        self.bins = first_bin

    def find(self, lengths: np.ndarray, ranks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        sequence, offset = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
        order = np.argsort(lengths, kind="stable")
        edges = np.flatnonzero(np.diff(lengths[order])) + 1
        for rows in np.split(order, edges):
            if len(rows):
                start, first, at = self.table[int(lengths[rows[0]])]
                k = np.searchsorted(start, ranks[rows], side="right") - 1
                sequence[rows] = first[k] + ranks[rows] - start[k]
                offset[rows] = at[k]
        return sequence, offset


def _placer(slots: _Slots):
    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sequence, offset = slots.find(batch.column("length").to_numpy(), batch.column("rank").to_numpy())
            names = [n for n in batch.schema.names if n != "rank"]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(n) for n in names), pa.array(sequence), pa.array(offset)], [*names, "sequence_id", "offset"]
            )

    return place


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Adds sequence_id and offset to rows with a length of 1 to ``capacity``.

    ``pieces`` must not change when it is computed again (a written table). Only the number of pieces of each length,
    ``capacity`` integers at most, reaches the driver, which plans the bins. Pieces are then
    ranked within their length (in blocks of about ``RANK_BLOCK``, so that a frequent
    length is no single task) and look up their place in the plan.
    """
    histogram = {r[0]: r[1] for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}
    slots = _Slots(slack_plan(histogram, capacity))
    spread = F.xxhash64(*[c for c in pieces.columns if c != "ids"])
    crowded = {k: n for k, n in histogram.items() if n > RANK_BLOCK}
    if crowded:
        blocks = F.coalesce(
            F.element_at(F.create_map(*[F.lit(x) for k, n in crowded.items() for x in (int(k), -(-n // RANK_BLOCK))]), F.col("length")), F.lit(1)
        )
    else:
        blocks = F.lit(1)
    dealt = pieces.withColumn("block", F.pmod(spread, blocks).cast("int"))
    sizes = dealt.groupBy("length", "block").agg(F.count("*").alias("in_block"))
    before = Window.partitionBy("length").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("length", "block", F.coalesce(F.sum("in_block").over(before), F.lit(0)).alias("ranks_before"))
    keys = [c for c in ("id", "piece", "start", "ids_crc32") if c in pieces.columns]
    nth = F.row_number().over(Window.partitionBy("length", "block").orderBy(*keys))
    ranked = dealt.withColumn("nth", nth).join(starts, ["length", "block"])
    ranked = ranked.select(*pieces.columns, (F.col("ranks_before") + F.col("nth") - 1).cast("long").alias("rank"))
    schema = ", ".join(f"`{n}` {t}" for n, t in pieces.dtypes) + ", sequence_id long, offset long"
    return in_arrow(ranked, _placer(slots), schema)


def pack_documents(
    docs: DataFrame,
    tokenizer: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    capacity: int = CAPACITY,
    end_id: int = END_ID,
    with_ids: bool = False,
) -> DataFrame:
    """Packs all documents into sequences of at most ``capacity`` tokens.

    ``tokenizer`` is the path of a vocabulary file that every executor can
    read. A document is its token ids and ``end_id``; only longer ones are cut. Returns per piece: id,
    piece, start, length, ids_crc32, sequence_id, offset, and with ``with_ids``
    the ids. Pieces of a sequence lie without gaps from 0 on.

    A null or empty text is one piece with the end id alone. Repeated rows
    and null ids are packed like others. An empty table gives an empty result; further
    columns are ignored.
    """
    pieces = cut(token_pieces(docs, tokenizer, id_col, text_col, capacity, end_id, with_ids), "pieces")
    return pack(pieces, capacity).withColumnRenamed("id", id_col)


def sequences(packed: DataFrame) -> DataFrame:
    """(sequence_id, ids) from ``pack_documents(..., with_ids=True)``: the token ids of each sequence in order."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))  # at most one sequence's worth of tokens
    return packed.groupBy("sequence_id").agg(F.flatten(F.transform(parts, lambda p: p["ids"])).alias("ids"))
