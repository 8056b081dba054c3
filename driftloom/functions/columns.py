"""Column helpers shared by the operators."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Aggregates over many columns are cut into groups of this many columns, so
# that one generated aggregate stays within what the JVM compiles well. A
# group reads only its own columns from a columnar file.
COLUMNS_PER_AGG = 16


def col(name: str) -> Column:
    """Column by its exact name, also when the name holds dots."""
    return F.col("`" + name.replace("`", "``") + "`")


def numeric_columns(df: DataFrame, exclude: Iterable[str] = ()) -> list[str]:
    """Names of all numeric columns except the excluded (key, target) ones."""
    skip = set(exclude)
    return [
        f.name
        for f in df.schema.fields
        if isinstance(f.dataType, T.NumericType) and f.name not in skip
    ]


def categorical_columns(df: DataFrame, exclude: Iterable[str] = ()) -> list[str]:
    """Names of all text columns except the excluded ones."""
    skip = set(exclude)
    return [
        f.name
        for f in df.schema.fields
        if isinstance(f.dataType, (T.StringType, T.BooleanType)) and f.name not in skip
    ]


def require_columns(df: DataFrame, names: Iterable[str]) -> None:
    missing = [n for n in names if n not in df.columns]
    if missing:
        raise ValueError(f"column(s) {missing} not found in {df.columns}")


def resolve_numeric(
    df: DataFrame, columns: Sequence[str] | None, exclude: Iterable[str] = ()
) -> list[str]:
    """The given columns, or all numeric ones; an empty choice is an error."""
    if columns is None:
        columns = numeric_columns(df, exclude)
    else:
        require_columns(df, columns)
    if not columns:
        raise ValueError("No numeric columns")
    return list(columns)


def resolve_categorical(
    df: DataFrame, columns: Sequence[str] | None, exclude: Iterable[str] = ()
) -> list[str]:
    if columns is None:
        columns = categorical_columns(df, exclude)
    else:
        require_columns(df, columns)
    if not columns:
        raise ValueError("No categorical columns")
    return list(columns)


def as_number(df: DataFrame, name: str) -> Column:
    """Column as double in which NaN counts as missing, like NULL."""
    c = col(name)
    if isinstance(df.schema[name].dataType, (T.DoubleType, T.FloatType)):
        return F.when(~F.isnan(c), c.cast("double"))
    return c.cast("double")


def is_missing(df: DataFrame, name: str) -> Column:
    c = col(name)
    if isinstance(df.schema[name].dataType, (T.DoubleType, T.FloatType)):
        return c.isNull() | F.isnan(c)
    return c.isNull()


def chunks(items: Sequence, size: int = COLUMNS_PER_AGG) -> list[list]:
    return [list(items[i : i + size]) for i in range(0, len(items), size)]


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def local_frame(spark: SparkSession, rows: Sequence[Sequence], schema: str) -> DataFrame:
    """Small driver-side rows as a local relation (no Python worker)."""
    struct = T._parse_datatype_string(schema) if not isinstance(schema, T.StructType) else schema
    columns = list(zip(*rows)) if rows else [[] for _ in struct.fields]
    arrow = {
        f.name: pa.array(list(values), type=_arrow_type(f.dataType))
        for f, values in zip(struct.fields, columns)
    }
    return spark.createDataFrame(pa.table(arrow), schema=struct)


def _arrow_type(t: T.DataType) -> pa.DataType:
    known = {
        T.StringType: pa.string(),
        T.DoubleType: pa.float64(),
        T.LongType: pa.int64(),
        T.IntegerType: pa.int32(),
        T.BooleanType: pa.bool_(),
    }
    if isinstance(t, T.ArrayType):
        return pa.list_(_arrow_type(t.elementType))
    return known[type(t)]
