"""Compare a query with its SQL counterpart run by DuckDB on the same files."""

from __future__ import annotations

import math

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _cell(v):
    if isinstance(v, float):
        if math.isnan(v):
            return "NaN"
        return repr(v)
    if hasattr(v, "as_tuple"):  # Decimal
        return repr(float(v))
    return str(v)


def _rows(rows, names):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(_cell(r[i]) for i in order) for r in rows), [names[i] for i in order]


def _kind(name: str) -> str:
    name = name.lower()
    for part, kind in (("int", "int"), ("long", "int"), ("double", "double"), ("decimal", "decimal"), ("float", "float")):
        if part in name:
            return kind
    return "other"


def compare(df, con, sql: str):
    """Return a description of the first difference, or None."""
    got, got_names = _rows([tuple(r) for r in df.collect()], df.columns)
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    types = {d[0]: str(d[1]) for d in cursor.description}
    want, want_names = _rows(cursor.fetchall(), names)
    if got_names != want_names:
        return f"columns {got_names} != {want_names}"
    kinds = {f.name: _kind(f.dataType.simpleString()) for f in df.schema.fields}
    for n in got_names:
        if kinds[n] != _kind(types[n]):
            return f"type of {n}: {df.schema[n].dataType.simpleString()} != {types[n]}"
    if len(got) != len(want):
        return f"rows {len(got)} != {len(want)}"
    bad = [(a, b) for a, b in zip(got, want) if a != b]
    return f"{len(bad)} rows differ, first {bad[0]}" if bad else None
