"""Quality rules: base rules, and a log-likelihood ratio of hashed n-grams."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .scratch import cut, in_arrow
from .words import Texts, mix, sliced, windows

BUCKET_BITS = 14
ORDERS = (1, 2, 3)
TRUSTED_ROWS = 20_000
THRESHOLD = -0.25
RATIO_BITS = 32
MIN_WORDS = 10
MAX_REPEATED = 20  # percent of the words
REPEAT_WIDTH = 5
_SYMBOLS = np.zeros(256, bool)
_SYMBOLS[[ord(c) for c in "#*$%&|<>"]] = True


def _grams(texts: Texts, order: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash bucket and last byte position of each n-gram of bytes that lies in one text; white space counts as one kind."""
    data = np.where(texts.data <= 32, np.uint8(32), texts.data)
    code = np.zeros(max(0, len(data) - order + 1), np.uint32)
    for k in range(order):
        code = code * np.uint32(257) + data[k : k + len(code)] + np.uint32(1)
    bucket = (code * np.uint32(2654435761)) >> np.uint32(32 - BUCKET_BITS)
    at = np.arange(len(code))
    inside = np.ones(len(code), bool)
    for k in range(1, order):  # windows that reach into the next text
        cut_at = texts.bounds[1:-1] - k
        inside[cut_at[(cut_at >= 0) & (cut_at < len(code))]] = False
    return bucket[inside].astype(np.int64) + ORDERS.index(order) * (1 << BUCKET_BITS), at[inside]


def _counter(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts per bucket of all texts of a task, and of the trusted ones among them."""
    size = len(ORDERS) << BUCKET_BITS
    raw, target = np.zeros(size, np.int64), np.zeros(size, np.int64)
    for batch in batches:
        trusted = np.asarray(batch.column(1).to_numpy(zero_copy_only=False), bool)
        for at, texts in sliced(batch.column(0)):
            own = trusted[at : at + len(texts)]
            for order in ORDERS:
                bucket, where = _grams(texts, order)
                raw += np.bincount(bucket, minlength=size)
                if own.any():
                    target += np.bincount(bucket[own[texts.texts_of(where)]], minlength=size)
    some = np.flatnonzero(raw)
    yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array(raw[some]), pa.array(target[some])], ["bucket", "raw", "target"])


def ratio_table(docs: DataFrame, trusted: DataFrame, id_col: str = "doc_id", text_col: str = "text", trusted_rows: int = TRUSTED_ROWS) -> np.ndarray:
    """log(p_target / p_raw) of every hash bucket.

    The raw counts cover every text. The target counts cover the texts whose id is among the
    ``trusted_rows`` ids of ``trusted`` that come first in hash order (all of
    them if there are fewer); that bound limits what is broadcast. The
    counts that reach the driver are one row per bucket.
    """
    ids = trusted.select(F.col(id_col).alias("id")).where("id is not null").distinct()
    ids = ids.orderBy(F.xxhash64("id"), "id").limit(trusted_rows).withColumn("trusted", F.lit(True))
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    flagged = texts.join(F.broadcast(ids), "id", "left").select("text", F.coalesce("trusted", F.lit(False)).alias("trusted"))
    counts = in_arrow(flagged, _counter, "bucket int, raw long, target long").groupBy("bucket").agg(F.sum("raw").alias("raw"), F.sum("target").alias("target"))
    table = counts.toPandas()
    size = 1 << BUCKET_BITS
    raw, target = np.zeros(len(ORDERS) * size), np.zeros(len(ORDERS) * size)
    raw[table.bucket], target[table.bucket] = table.raw, table.target
    out = np.zeros(len(raw))
    for k in range(len(ORDERS)):  # one multinomial per order
        part = slice(k * size, (k + 1) * size)
        out[part] = np.log((target[part] + 1) / (target[part].sum() + size)) - np.log((raw[part] + 1) / (raw[part].sum() + size))
    return out if target.any() else np.zeros(len(out))


def ratio_scores(texts: Texts, table: np.ndarray) -> np.ndarray:
    """Mean log ratio over all n-grams of each text; 0 for an empty one.

    Ratios are added as whole multiples of 2 ** -``RATIO_BITS``, so a text scores the same to the last bit
    whatever texts stand beside it.
    """
    whole = np.rint(table * 2.0**RATIO_BITS).astype(np.int64)
    total, count = np.zeros(len(texts), np.int64), np.zeros(len(texts), np.int64)
    for order in ORDERS:
        bucket, where = _grams(texts, order)
        sums = np.concatenate([[0], np.cumsum(whole[bucket])])
        span = np.searchsorted(where, texts.bounds)
        total += sums[span[1:]] - sums[span[:-1]]
        count += np.diff(span)
    return total / 2.0**RATIO_BITS / np.maximum(count, 1)


def base_counts(texts: Texts) -> dict[str, np.ndarray]:
    """n_words, word_chars, n_symbols, n_dup_lines and n_repeat_words of each text."""
    n_words = np.diff(texts.words)
    inside = np.zeros(len(texts.data) + 1, np.int8)
    np.add.at(inside, texts.start, 1)
    np.add.at(inside, texts.end, -1)
    inside = np.cumsum(inside[:-1], dtype=np.int8).astype(bool)

    first = np.zeros(len(texts.data) + 1, bool)
    first[texts.bounds] = True
    breaks = np.flatnonzero(texts.raw == 10)
    starts = np.union1d(texts.bounds[:-1][np.diff(texts.bounds) > 0], breaks[~first[breaks + 1]] + 1).astype(np.int64)
    stops = np.concatenate([starts[1:], texts.bounds[-1:]]) if len(starts) else starts
    closed = (stops > starts) & (texts.raw[np.maximum(stops - 1, 0)] == 10) if len(starts) else np.zeros(0, bool)
    stops = stops - closed
    spoken = np.searchsorted(texts.start, starts) < np.searchsorted(texts.start, stops)
    starts, stops = starts[spoken], stops[spoken]
    line_of = texts.texts_of(starts)
    dups = np.zeros(len(texts), np.int64)
    if len(starts):
        order = np.lexsort((texts.hashes(starts, stops), line_of))
        hashes, lines = texts.hashes(starts, stops)[order], line_of[order]
        again = (hashes[1:] == hashes[:-1]) & (lines[1:] == lines[:-1])
        np.add.at(dups, lines[1:][again], 1)

    repeats = np.zeros(len(texts), np.int64)
    words = texts.word_hashes()
    for i in np.flatnonzero(n_words > REPEAT_WIDTH):
        _, inverse, counts = np.unique(windows(words[texts.words[i] : texts.words[i + 1]], REPEAT_WIDTH), return_inverse=True, return_counts=True)
        if len(counts) == len(inverse):
            continue
        many = np.zeros(n_words[i] + 1, np.int32)
        at = np.flatnonzero(counts[inverse] > 1)
        many[at] += 1
        many[at + REPEAT_WIDTH] -= 1  # each window begins once, so no position is met twice
        repeats[i] = np.count_nonzero(np.cumsum(many[:-1]) > 0)
    return {
        "n_words": n_words.astype(np.int64),
        "word_chars": texts.code_points(inside),
        "n_symbols": texts.totals(_SYMBOLS[texts.raw]),
        "n_dup_lines": dups,
        "n_repeat_words": repeats,
    }


COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def _judge(table: np.ndarray, text_at: int, threshold: float):
    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts: dict[str, list] = {k: [np.zeros(0, np.int64)] for k in COUNTS} | {"llr": [np.zeros(0)]}
            for _, texts in sliced(batch.column(text_at)):
                for k, v in base_counts(texts).items():
                    parts[k].append(v)
                parts["llr"].append(ratio_scores(texts, table))
            got = {k: np.concatenate(v) for k, v in parts.items()}
            failed = (got["n_words"] < MIN_WORDS) | (100 * got["n_repeat_words"] > MAX_REPEATED * got["n_words"])
            kept = ~failed & (got["llr"] >= threshold)
            new = [pa.array(got[k].astype(np.int64)) for k in COUNTS] + [pa.array(failed), pa.array(got["llr"]), pa.array(kept)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *new], [f"c{i}" for i in range(batch.num_columns + len(new))])

    return judge


VERDICT = tuple((k, "long") for k in COUNTS) + (("base_failed", "boolean"), ("llr", "double"), ("kept", "boolean"))


def judge_quality(
    docs: DataFrame,
    trusted: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    threshold: float = THRESHOLD,
    trusted_rows: int = TRUSTED_ROWS,
    keep_columns: bool = True,
) -> DataFrame:
    """Base counts, base verdict, log-likelihood ratio and verdict of every row.

    A text is scored by the mean, over its n-grams of one to three bytes,
    of log(p_target / p_raw), with hashed multinomials of the texts of the ids in ``trusted``
    and of all texts. It is kept if no base rule fails and the score is at
    least ``threshold``: 0 is the corpus average, below it a text is less
    like the trusted ones than the corpus is. Two scans and one small
    aggregation; nothing else is shuffled.

    With ``keep_columns`` all columns of ``docs`` come first, then the new ones in
    the order of ``VERDICT``; a column of ``docs`` with the name of a new one is
    dropped. Otherwise only the id stays. Null text counts as empty; an
    empty text has no words and fails. A row with a null id is judged like
    others but never trusted. Without any trusted text all scores are 0.
    Repeated rows are each judged. An empty table gives an empty result.
    """
    table = ratio_table(docs, trusted, id_col, text_col, trusted_rows)
    new = [n for n, _ in VERDICT]
    rows = docs.select(*[F.col(f"`{c}`") for c in docs.columns if c.lower() not in new]) if keep_columns else docs.select(id_col, text_col)
    old = [f.dataType.simpleString() for f in rows.schema.fields]
    schema = ", ".join(f"c{i} {t}" for i, t in enumerate([*old, *(t for _, t in VERDICT)]))
    out = in_arrow(rows, _judge(table, rows.columns.index(text_col), threshold), schema).toDF(*rows.columns, *new)
    return out if keep_columns else out.drop(text_col)
