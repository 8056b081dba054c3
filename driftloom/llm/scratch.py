"""Cutting lineage with tables in the shared folder, and sending this package to the executors."""

from __future__ import annotations

import os
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

from ..session import scratch_path

_PACKAGE = Path(__file__).resolve().parents[1]


def cut(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    What follows no longer depends on the executors that made it, and a table
    used several times is computed once.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def ship_code(spark: SparkSession) -> None:
    """Let the Python workers import this package, as ``--py-files`` does; once per context.

    The driver serves the archive itself; it holds code only.
    """
    context = spark.sparkContext
    if getattr(context, "_shipped_package", None) == str(_PACKAGE):
        return
    path = os.path.join(os.path.realpath(tempfile.mkdtemp()), f"{_PACKAGE.name}.zip")
    with zipfile.ZipFile(path, "w") as archive:
        for file in sorted(_PACKAGE.rglob("*.py")):
            archive.write(file, file.relative_to(_PACKAGE.parent))
    context.addPyFile(path)
    context._shipped_package = str(_PACKAGE)


def in_arrow(df: DataFrame, function, schema) -> DataFrame:
    """``df.mapInArrow`` with this package at hand on every worker."""
    ship_code(df.sparkSession)
    return df.mapInArrow(function, schema)
