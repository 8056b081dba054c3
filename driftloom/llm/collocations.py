"""Phrase collocations by prefix-free parsing.

The words of a piece (text between marks) are cut wherever a window of ``OVERLAP`` words
hashes to a trigger value; a chunk reaches from one trigger window to the end of the next, so
neighbours share that window and the cuts depend on content alone: a passage that occurs
again gives the same chunks again. The distinct chunks with their frequencies are the dictionary. N-grams are
counted within distinct chunks, weighted by frequency; one that begins in the shared
window belongs to the chunk after it, so none is counted twice.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .scratch import cut, in_arrow
from .words import Texts, mix, sliced

MAX_WORDS = 4
OVERLAP = MAX_WORDS - 1
TRIGGER = 16  # one window in so many begins a chunk
LEAST = 30
TOP = 2000
SCALE = 2_000_000
NO_LANG = "und"
GATHER_BYTES = 16 << 20
#: the filter of frequent phrases takes no more than 2 ** 27 bits (16 MB), however many there are
FILTER_BITS = 1 << 27
_BITS_PER_PHRASE = 16
_PROBES = 4
_MARK = np.zeros(256, bool)
_MARK[[*b".,;:!?", 10, 11, 12, 13]] = True
_BLANK = np.zeros(256, bool)
_BLANK[[9, 32]] = True


def pieces_of(texts: Texts) -> tuple[Texts, np.ndarray]:
    """The pieces that hold a word, words one space apart, and the text of each piece."""
    mark = _MARK[texts.data]
    inside = ~(mark | _BLANK[texts.data])
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    edges = texts.bounds[(texts.bounds > 0) & (texts.bounds < len(inside))]
    begins[edges] = inside[edges]
    starts = np.flatnonzero(begins)
    word = np.cumsum(begins)[inside] - 1
    data = np.full(len(word) + len(starts), 32, np.uint8)
    data[np.arange(len(word)) + word] = texts.data[inside]
    spots = np.flatnonzero(inside)[np.searchsorted(word, np.arange(len(starts)))] if len(starts) else starts
    # a word begins a piece if a mark or another text lies between it and the word before
    text = texts.texts_of(spots)
    marks = np.cumsum(mark)[spots]
    new = np.ones(len(starts), bool)
    new[1:] = (np.diff(marks) > 0) | (np.diff(text) > 0)
    at = np.searchsorted(word, np.arange(len(starts))) + np.arange(len(starts))
    return Texts(data, np.append(at[new], len(data))), text[new]


def chunks_of(pieces: Texts, trigger: int = TRIGGER) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(first word, last word, piece, whether no other chunk of the piece follows) of each chunk of the pieces."""
    n = len(pieces.start)
    piece_of = np.repeat(np.arange(len(pieces)), np.diff(pieces.words))
    firsts = np.zeros(n, bool)
    firsts[pieces.words[:-1]] = True
    whole = np.flatnonzero(piece_of[: max(0, n - OVERLAP + 1)] == piece_of[OVERLAP - 1 :])
    hits = pieces.hashes(pieces.start[whole], pieces.end[whole + OVERLAP - 1]) % np.uint64(trigger) == 0
    firsts[whole[hits]] = True
    first = np.flatnonzero(firsts)
    piece = piece_of[first]
    follows = np.zeros(len(first), bool)
    follows[:-1] = piece[1:] == piece[:-1]
    last = pieces.words[piece + 1] - 1
    last[follows] = first[1:][follows[:-1]] + OVERLAP - 1
    return first, last, piece, ~follows


def lang_seeds(langs: list[str]) -> np.ndarray:
    """A fixed 64-bit value per language."""
    seeds = {g: int.from_bytes(hashlib.blake2b(g.encode(), digest_size=8).digest(), "little") for g in set(langs)}
    return np.array([seeds[g] for g in langs], np.uint64)


def _strings(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> pa.Array:
    sizes = end - start
    offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
    taken = data[np.arange(offsets[-1]) + np.repeat(start - offsets[:-1], sizes)]
    return pa.LargeStringArray.from_buffers(len(start), pa.py_buffer(offsets), pa.py_buffer(taken)).cast(pa.string())


class _Gathered:
    """Sums of n per key within a task; each key keeps its row (language, phrase and more)."""

    def __init__(self):
        self.keys, self.n, self.rows, self.size = [], [], [], 0

    def add(self, keys: np.ndarray, n: np.ndarray, data: np.ndarray, start: np.ndarray, end: np.ndarray, others: list) -> None:
        """``others``: functions from positions to an Arrow array."""
        if not len(keys):
            return
        order = np.argsort(keys, kind="stable")
        first = np.flatnonzero(np.concatenate([[True], np.diff(keys[order]) != 0]))
        pick = order[first]
        self.keys.append(keys[pick])
        self.n.append(np.add.reduceat(n[order], first))
        self.rows.append(pa.RecordBatch.from_arrays([*(o(pick) for o in others), _strings(data, start[pick], end[pick])], [str(i) for i in range(len(others) + 1)]))
        self.size += self.rows[-1].nbytes

    def flush(self, names: list[str]) -> Iterator[pa.RecordBatch]:
        if not self.keys:
            return
        keys, n = np.concatenate(self.keys), np.concatenate(self.n)
        order = np.argsort(keys, kind="stable")
        first = np.flatnonzero(np.concatenate([[True], np.diff(keys[order]) != 0]))
        table = pa.Table.from_batches(self.rows).take(pa.array(order[first]))
        sums = np.add.reduceat(n[order], first)
        self.__init__()
        for batch in table.append_column("n", pa.array(sums)).rename_columns([*names, "n"]).to_batches(max_chunksize=20_000):
            yield batch


def _parser(trigger: int):
    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """(lang, text) rows to (lang, ends, chunk, n)."""
        kept = _Gathered()
        for batch in batches:
            langs = batch.column(0)
            seeds = lang_seeds(langs.to_pylist())
            for at, texts in sliced(batch.column(1), lower=True):
                pieces, text = pieces_of(texts)
                if not len(text):
                    continue
                first, last, piece, ends = chunks_of(pieces, trigger)
                row = at + text[piece]
                keys = mix(pieces.hashes(pieces.start[first], pieces.end[last]) + seeds[row] + ends)
                others = [lambda p, row=row, langs=langs: langs.take(pa.array(row[p])), lambda p, ends=ends: pa.array(ends[p])]
                kept.add(keys, np.ones(len(keys), np.int64), pieces.data, pieces.start[first], pieces.end[last], others)
                if kept.size >= GATHER_BYTES:
                    yield from kept.flush(["lang", "ends", "chunk"])
        yield from kept.flush(["lang", "ends", "chunk"])

    return parse


class PhraseFilter:
    """A Bloom filter of phrases: those added are always found, others with small odds."""

    def __init__(self, bits: int, words: np.ndarray | None = None):
        self.bits = bits
        self.words = np.zeros(bits >> 6, np.uint64) if words is None else words

    def places(self, keys: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        step = mix(keys) | np.uint64(1)
        for k in range(_PROBES):
            place = (keys + np.uint64(k) * step) & np.uint64(self.bits - 1)
            yield (place >> np.uint64(6)).astype(np.int64), np.uint64(1) << (place & np.uint64(63))

    def holds(self, keys: np.ndarray) -> np.ndarray:
        found = np.ones(len(keys), bool)
        for word, bit in self.places(keys):
            found &= (self.words[word] & bit) != 0
        return found


def _filter_words(bits: int):
    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = PhraseFilter(bits)
        for batch in batches:
            seeds = lang_seeds(batch.column(0).to_pylist())
            for at, texts in sliced(batch.column(1)):
                keys = mix(texts.hashes(texts.bounds[:-1], texts.bounds[1:]) + seeds[at : at + len(texts)])
                for word, bit in own.places(keys):
                    np.bitwise_or.at(own.words, word, bit)
        some = np.flatnonzero(own.words)
        yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array(own.words[some].view(np.int64))], ["word", "bits"])

    return place


def phrase_filter(frequent: DataFrame, most_bits: int = FILTER_BITS) -> PhraseFilter:
    """A filter of (lang, phrase) rows; its size follows their number up to ``most_bits``, beyond which it only lets more pass."""
    rows = frequent.count()
    bits = max(64, min(most_bits, 1 << (_BITS_PER_PHRASE * rows).bit_length()))
    filled = in_arrow(frequent.select("lang", "phrase"), _filter_words(bits), "word int, bits long").groupBy("word").agg(F.bit_or("bits").alias("bits"))
    got = filled.toPandas()
    found = PhraseFilter(bits)
    found.words[got["word"].to_numpy()] = got["bits"].to_numpy(np.int64).view(np.uint64)
    return found


def _gram_counter(widths: tuple[int, ...], parts: int, passing):
    """(lang, ends, chunk, n) rows to (lang, phrase, n) for phrases of the given widths, whose runs of ``parts`` words all pass the filter."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frequent = passing.value if passing is not None else None
        kept = _Gathered()
        for batch in batches:
            langs, weights = batch.column(0), batch.column(3).to_numpy()
            seeds, closed = lang_seeds(langs.to_pylist()), batch.column(1).to_numpy(zero_copy_only=False).astype(bool)
            for at, chunks in sliced(batch.column(2)):
                row = np.repeat(np.arange(len(chunks)), np.diff(chunks.words)) + at
                left = chunks.words[row - at + 1] - np.arange(len(row))  # words to the end of the chunk
                owned = closed[row] | (left > OVERLAP)

                def keys_of(i, width):
                    return mix(chunks.hashes(chunks.start[i], chunks.end[i + width - 1]) + seeds[row[i]])

                if frequent is not None:
                    whole = np.flatnonzero(left >= parts)
                    good = np.zeros(len(row) + MAX_WORDS, bool)
                    good[whole] = frequent.holds(keys_of(whole, parts))
                for width in widths:
                    fits = owned & (left >= width)
                    if frequent is not None:
                        for k in range(width - parts + 1):
                            fits &= good[k : k + len(row)]
                    i = np.flatnonzero(fits)
                    others = [lambda p, i=i, row=row, langs=langs: langs.take(pa.array(row[i[p]]))]
                    kept.add(keys_of(i, width), weights[row[i]], chunks.data, chunks.start[i], chunks.end[i + width - 1], others)
                if kept.size >= GATHER_BYTES:
                    yield from kept.flush(["lang", "phrase"])
        yield from kept.flush(["lang", "phrase"])

    return count


def parse(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", trigger: int = TRIGGER) -> DataFrame:
    """The dictionary: (lang, ends, chunk, n) for every distinct chunk; ``ends`` tells those at the end of a piece."""
    rows = docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit(NO_LANG)).alias("lang"), F.col(text_col).alias("text"))
    chunks = in_arrow(rows, _parser(trigger), "lang string, ends boolean, chunk string, n long")
    return chunks.groupBy("lang", "ends", "chunk").agg(F.sum("n").alias("n"))


def phrase_counts(dictionary: DataFrame, least: int = LEAST) -> tuple[DataFrame, DataFrame]:
    """Occurrences of all words, and of all phrases of 1 to 4 words that occur ``least`` times or more; both written tables.

    A phrase cannot occur more often than a part of it. So pairs are counted only where both words are
    frequent, and longer phrases where all pairs in them are: a filter of bounded
    size sorts out most others before they are shuffled; those it lets through by chance fail the exact count.
    """
    spark = dictionary.sparkSession

    def count(widths, parts=1, frequent=None):
        passing = None if frequent is None else spark.sparkContext.broadcast(phrase_filter(frequent))
        grams = in_arrow(dictionary.select("lang", "ends", "chunk", "n"), _gram_counter(widths, parts, passing), "lang string, phrase string, n long")
        return grams.groupBy("lang", "phrase").agg(F.sum("n").alias("n"))

    words = cut(count((1,)), "words")
    often = words.where(F.col("n") >= least)
    pairs = cut(count((2,), 1, often).where(F.col("n") >= least), "word-pairs")
    longer = count(tuple(range(3, MAX_WORDS + 1)), 2, pairs).where(F.col("n") >= least)
    return words, cut(often.unionByName(pairs).unionByName(longer), "phrases")


def score_phrases(frequent: DataFrame) -> DataFrame:
    """(lang, phrase, a, l, r, score) of phrases of two words or more, at the cut that scores lowest; contained ones are dropped.

    ``frequent``: (lang, phrase, n) of all frequent phrases, single words included.
    Scores are whole numbers, by decimal arithmetic that does not overflow.
    """
    split = F.split("phrase", " ", -1)
    found = frequent.withColumn("words", split).where(F.size("words") > 1).withColumnRenamed("n", "a")
    part = lambda start, n: F.array_join(F.slice("words", start, n), " ")
    cuts = found.select("lang", "phrase", "a", "words", F.explode(F.sequence(F.lit(1), F.size("words") - 1)).alias("k"))
    cuts = cuts.select("lang", "phrase", "a", "k", part(F.lit(1), F.col("k")).alias("head"), part(F.col("k") + 1, F.size("words")).alias("tail"))
    side = lambda name, count: frequent.select("lang", F.col("phrase").alias(name), F.col("n").alias(count))
    cuts = cuts.join(side("head", "l"), ["lang", "head"]).join(side("tail", "r"), ["lang", "tail"])
    wide = lambda c: F.col(c).cast("decimal(20,0)")
    cuts = cuts.withColumns({"top": F.lit(SCALE).cast("decimal(10,0)") * wide("a"), "under": wide("l") + wide("r")})
    cuts = cuts.withColumn("score", F.expr("top div under"))
    scored = cuts.groupBy("lang", "phrase", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))
    inner = F.expr(
        "flatten(transform(sequence(2, size(words) - 1), m -> transform(sequence(1, size(words) - m + 1), i -> array_join(slice(words, i, m), ' '))))"
    )
    within = found.where(F.size("words") > 2).select("lang", F.explode(inner).alias("phrase"), "a")
    within = within.groupBy("lang", "phrase").agg(F.max("a").alias("longest"))
    kept = scored.join(within, ["lang", "phrase"], "left").where(F.col("longest").isNull() | (wide("longest") * 5 < wide("a") * 4))
    return kept.select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score")


def collocations(
    docs: DataFrame, text_col: str = "text", lang_col: str = "lang", least: int = LEAST, top: int = TOP, trigger: int = TRIGGER
) -> DataFrame:
    """The ``top`` phrases of each language: lang, rank (from 1), phrase, a, l, r, n, score.

    A-Z are lower-cased. Marks and line ends cut texts into pieces, spaces and tabs those into
    words. ``a`` counts a phrase of 2 to 4 words, overlaps included, ``l`` and ``r`` the parts at its lowest-scoring cut,
    ``n`` all words of the language. Phrases are dropped if a longer frequent one holds
    them in 80 % of their occurrences. Ranked by score and ``a`` descending, then by phrase in byte order.

    A null language is "und", a null text empty; repeated rows count again; other
    columns are ignored; an empty table gives an empty result. 64-bit hashes stand for chunks and phrases within a task only.
    """
    dictionary = cut(parse(docs, text_col, lang_col, trigger), "chunks")
    words, frequent = phrase_counts(dictionary, least)
    totals = words.groupBy("lang").agg(F.sum("n").alias("n"))
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = score_phrases(frequent).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return ranked.join(totals, "lang").select("lang", F.col("rank").cast("long"), "phrase", "a", "l", "r", "n", "score")
