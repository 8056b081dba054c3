"""Token ids as Parquet list columns: ordered files with chosen encodings, row groups and pages, read selectively.

A folder of token files holds two tables. ``tokens`` has one row per document,
in ascending order of the ids over all files: id, n_tokens, position, ids
(list of 32-bit integers) and, if asked for, meta (a struct of metadata columns).
``index`` has id, start, n_tokens and position. ``position`` is the number of the
file (upper bits) and of the row in it; ``start`` counts the tokens of all documents before.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .byte_bpe import byte_encoder
from .scratch import cut, in_arrow

END_ID = 2
TEXT_BYTES_PER_FILE = 32 << 20
ROW_GROUP_BYTES = 32 << 20
PAGE_BYTES = 64 << 10
PAGE_ROWS = 2000
ENCODINGS = ("dictionary", "delta")
_ROW_BITS = 33  # of monotonically_increasing_id
_PARTS_PER_BLOCK = 1024
_SLICE_IDS = 1 << 20


def _encoder(path: str, end_id: int):
    end = np.array([end_id], "<u4").tobytes()

    def encode_all(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The last column is the text; rows keep their order."""
        encode = byte_encoder(path).encode
        for batch in batches:
            parts: list[bytes] = []
            first, held, last = 0, 0, batch.num_rows - 1
            for i, text in enumerate(batch.column(batch.num_columns - 1)):
                value = text.as_py()
                parts.append(encode(value) + end if value else end)
                held += len(parts[-1])
                if held >= 4 * _SLICE_IDS or i == last:
                    sizes = np.array([len(p) // 4 for p in parts], np.int64)
                    offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
                    ids = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.frombuffer(b"".join(parts), np.int32)))
                    others = [batch.column(k).slice(first, len(parts)) for k in range(batch.num_columns - 1)]
                    yield pa.RecordBatch.from_arrays([*others, pa.array(sizes), ids], [*batch.schema.names[:-1], "n_tokens", "ids"])
                    parts, first, held = [], i + 1, 0

    return encode_all


def _checksums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Position and unsigned crc32 of the ids of each row."""
    for batch in batches:
        lists = batch.column(1)
        values, offsets = lists.values.to_numpy(zero_copy_only=False).astype("<i4", copy=False), lists.offsets.to_numpy()
        crc = [zlib.crc32(values[a:b].tobytes()) for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist())]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(crc, pa.int64())], ["position", "ids_crc32"])


def with_starts(rows: DataFrame) -> DataFrame:
    """Adds ``start`` to rows with position and n_tokens: the tokens of all rows at lower positions.

    Running sums stay within a file, then within a block of ``_PARTS_PER_BLOCK`` files;
    only one number per block of files meets in a single task.
    """
    part = F.shiftright("position", _ROW_BITS)
    before = lambda *by: Window.partitionBy(*by).rowsBetween(Window.unboundedPreceding, -1)
    sums = rows.groupBy(part.alias("part")).agg(F.sum("n_tokens").alias("in_part"))
    sums = sums.withColumn("part_block", F.floor(F.col("part") / _PARTS_PER_BLOCK))
    blocks = sums.groupBy("part_block").agg(F.sum("in_part").alias("in_block"))
    blocks = blocks.select("part_block", F.coalesce(F.sum("in_block").over(before(F.lit(0)).orderBy("part_block")), F.lit(0)).alias("before_block"))
    in_block = F.coalesce(F.sum("in_part").over(before("part_block").orderBy("part")), F.lit(0))
    sums = sums.withColumn("before_part", in_block).join(blocks, "part_block").select("part", (F.col("before_part") + F.col("before_block")).alias("before_part"))
    in_part = F.coalesce(F.sum("n_tokens").over(before("part").orderBy("position")), F.lit(0))
    placed = rows.withColumn("part", part).withColumn("in_part", in_part).join(sums, "part")
    return placed.select(*rows.columns, (F.col("in_part") + F.col("before_part")).cast("long").alias("start"))


def write_token_files(
    docs: DataFrame,
    path: str,
    tokenizer: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    metadata: Sequence[str] = (),
    end_id: int = END_ID,
    encoding: str = "dictionary",
    text_bytes_per_file: int = TEXT_BYTES_PER_FILE,
    row_group_bytes: int = ROW_GROUP_BYTES,
    page_bytes: int = PAGE_BYTES,
    page_rows: int = PAGE_ROWS,
    compression: str = "zstd",
) -> None:
    """Writes the ids of all documents, each followed by ``end_id``, below ``path``.

    ``tokenizer`` is the path of a byte-level vocabulary file that every executor can read.
    ``encoding``: "dictionary" keeps the ids as indices into a dictionary per row group,
    "delta" as binary-packed differences. Row groups end at ``row_group_bytes``, pages at
    ``page_bytes`` or ``page_rows``; page indexes with the bounds of id and position are always written, so a
    reader skips the pages it does not need. Files hold the ids of about ``text_bytes_per_file`` of text.

    Rows are ordered as texts, before they are encoded: a text is smaller than its ids. ``docs`` is
    read three times (sizes, bounds of the files, rows), so pass a table rather than a long plan.

    Null and empty texts are the end id alone. Rows without an id come first;
    rows that share an id are ordered by their bytes in number and content, so reruns agree and no
    frequent id ends in one file. An empty table gives empty files. Columns not named in ``metadata`` are ignored.
    """
    if encoding not in ENCODINGS:
        raise ValueError(f"encoding must be one of {ENCODINGS}")
    spark = docs.sparkSession
    kind = dict(docs.dtypes)[id_col]
    meta = [F.struct(*[F.col(c) for c in metadata]).alias("meta")] if metadata else []
    plain = docs.select(F.col(id_col).alias("id"), *meta, F.col(text_col).alias("text"))
    kinds = ", ".join(f"{n} {t}" for n, t in plain.dtypes[:-1])
    size = F.coalesce(F.octet_length("text"), F.lit(0)).cast("long")
    order = [F.col("id"), size, F.xxhash64("text")]
    alike = plain.select(*[c.alias(f"k{i}") for i, c in enumerate(order)]).groupBy("k0", "k1", "k2").agg(F.count("*").alias("n"))
    total, rows, most = alike.agg(F.coalesce(F.sum(F.col("k1") * F.col("n")), F.lit(0)), F.coalesce(F.sum("n"), F.lit(0)), F.max("n")).first()
    parts = max(1, -(-total // text_bytes_per_file), min(spark.sparkContext.defaultParallelism, rows // PAGE_ROWS))
    if most and most > max(PAGE_ROWS, rows // parts):
        # so many rows are alike that only their place in a written table can part them
        plain = cut(plain, "texts")
        order += [F.xxhash64("_metadata.file_name"), F.col("_metadata.row_index")]
    keys = [f"_k{i}" for i in range(len(order))]
    ordered = plain.select("*", *[c.alias(k) for c, k in zip(order, keys)]).repartitionByRange(parts, *keys).sortWithinPartitions(*keys)
    encoded = in_arrow(ordered.select(plain.columns), _encoder(tokenizer, end_id), f"{kinds}, n_tokens long, ids array<int>")
    ordered = encoded.select("id", "n_tokens", F.monotonically_increasing_id().alias("position"), *[c for c in ("meta",) if metadata], "ids")
    options = {
        "parquet.block.size": row_group_bytes,
        "parquet.page.size": page_bytes,
        "parquet.page.row.count.limit": page_rows,
        "parquet.enable.dictionary": str(encoding == "dictionary").lower(),
        "parquet.writer.version": "PARQUET_1_0" if encoding == "dictionary" else "PARQUET_2_0",
        "compression": compression,
    }
    ordered.write.options(**options).parquet(f"{path}/tokens")
    # a path read without a schema would make Spark open a file to learn it, which an empty table may lack
    written = spark.read.schema(f"id {kind}, n_tokens long, position long").parquet(f"{path}/tokens")
    index = with_starts(written).select("id", "start", "n_tokens", "position").sortWithinPartitions("position")
    index.write.options(**options).parquet(f"{path}/index")


def read_index(spark: SparkSession, path: str) -> DataFrame:
    """(id, start, n_tokens, position) of every document; no token is read."""
    return spark.read.parquet(f"{path}/index")


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """(id, n_tokens, position, meta, ids); filters on id and position reach the page indexes, unused columns stay unread."""
    return spark.read.parquet(f"{path}/tokens")


def read_span(spark: SparkSession, path: str, start: int, stop: int) -> DataFrame:
    """(id, start, ids): the tokens number ``start`` to ``stop`` (exclusive) of the whole collection, cut per document.

    The index gives the rows that hold them; of the tokens only the pages of those rows are read.
    """
    within = read_index(spark, path).where((F.col("start") < stop) & (F.col("start") + F.col("n_tokens") > start))
    low, high, first = within.agg(F.min("position"), F.max("position"), F.min("start")).first()
    tokens = read_tokens(spark, path).where(F.col("position").between(low if low is not None else 1, high if high is not None else 0))
    placed = with_starts(tokens.select("id", "position", "n_tokens", "ids")).withColumn("start", F.col("start") + F.lit(first or 0))
    skip = F.greatest(F.lit(start) - F.col("start"), F.lit(0)).cast("int")
    stop_at = F.least(F.lit(stop) - F.col("start"), F.col("n_tokens")).cast("int")
    return placed.select("id", (F.col("start") + skip).alias("start"), F.slice("ids", skip + 1, stop_at - skip).alias("ids"))


def checksums(spark: SparkSession, path: str) -> DataFrame:
    """(id, start, n_tokens, ids_crc32) of every document, read back from the files."""
    crc = in_arrow(read_tokens(spark, path).select("position", "ids"), _checksums, "position long, ids_crc32 long")
    return read_index(spark, path).join(crc, "position").select("id", "start", "n_tokens", "ids_crc32")
