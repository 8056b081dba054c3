"""From raw documents to packed training sequences, in stages.

Each stage takes (spark, docs, sf_dir) and works on all rows that the one before it left; ``run`` writes
every stage to the shared folder and reads it back. All stages but the last return the columns of ``documents``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from driftloom.llm import catalog, mixing, near_text, packing, pii, quality
from driftloom.llm.scratch import cut

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    return quality.judge_quality(docs, catalog.trusted(spark, sf_dir)).where("kept").select(*COLUMNS)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: the one with the smallest id.

    Of rows that share that id one stays; rows without an id cannot be grouped and stay.
    """
    kept = near_text.near_duplicates(docs).where("kept and doc_id is not null").select("doc_id").distinct()
    single = docs.join(kept, "doc_id").dropDuplicates(["doc_id"])
    return single.select(*COLUMNS).union(docs.where("doc_id is null").select(*COLUMNS))


def mask_pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data gives way to the name of its kind."""
    masked = pii.redact_pii(docs)
    return masked.withColumn("n_chars", F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(F.length("text").cast("long"))).select(*COLUMNS)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them."""
    return mixing.mixed_documents(docs).select(*COLUMNS)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents and their places in training sequences."""
    return packing.pack_documents(docs, catalog.tokenizer_path())


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality rules", keep_quality),
    ("MinHash near-dedup", drop_near_duplicates),
    ("PII", mask_pii),
    ("mixing", mix),
    ("packing", pack),
]

#: Signatures, learned ratios and token ids are beyond SQL; tests hold the stages against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = cut(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
