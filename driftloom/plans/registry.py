"""Registry of named queries, each with the SQL that states its result."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

LINE_KEY = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
MEASURES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def query(name: str, sql: str | None = None):
    """Register a query; ``sql`` is its counterpart in plain SQL, if one exists."""

    def add(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def rounded(df: DataFrame, digits: int = 6, **per_column: int) -> DataFrame:
    """Round doubles (adding 0.0 turns -0.0 into 0.0) so that engines agree."""
    return df.select(
        *[
            (F.round(f.name, per_column.get(f.name, digits)) + F.lit(0.0)).alias(f.name)
            if isinstance(f.dataType, T.DoubleType)
            else F.col(f.name)
            for f in df.schema.fields
        ]
    )
