"""Row-keyed hash numbers.

Every random choice in the library comes from md5 over (seed, salt, row key),
so it depends on the row alone: a re-run, another partitioning or a retried
task after a lost executor yields the same value.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from .columns import col

SPAN = 4294967296.0  # 2 ** 32, the number of 8-digit hex prefixes


def token(seed: int | str, key: Sequence[str], salt: str | None = None) -> Column:
    """md5 hex text of ``seed|[salt|]key1|key2...``; a missing key reads as ''."""
    if not key:
        raise ValueError("key columns are required")
    parts = [F.lit(str(seed))]
    if salt is not None:
        parts.append(F.lit(salt))
    parts += [F.coalesce(col(k).cast("string"), F.lit("")) for k in key]
    return F.md5(F.concat_ws("|", *parts))


def hex_number(hexes: Column, digits: int = 8) -> Column:
    return F.conv(F.substring(hexes, 1, digits), 16, 10).cast("double")


def uniform(seed: int | str, key: Sequence[str], salt: str) -> Column:
    """Uniform number in [0, 1)."""
    return hex_number(token(seed, key, salt)) / F.lit(SPAN)


def normal(seed: int | str, key: Sequence[str], salt: str) -> Column:
    """Standard normal number (Box-Muller over two differently salted hashes)."""
    h1 = hex_number(token(seed, key, salt + "|r"))
    h2 = hex_number(token(seed, key, salt + "|a"))
    radius = F.sqrt(F.lit(-2.0) * F.ln((h1 + F.lit(1.0)) / F.lit(SPAN + 1.0)))
    return radius * F.cos(F.lit(2.0 * math.pi) * (h2 / F.lit(SPAN)))


def choose_columns(columns: Sequence[str], count: int, seed: int) -> list[str]:
    """Seeded choice of column names, given back in their table order."""
    ranked = sorted(columns, key=lambda c: (hashlib.md5(f"{seed}|{c}".encode()).hexdigest(), c))
    chosen = set(ranked[:count])
    return [c for c in columns if c in chosen]


def scalar_uniform(seed: int, salt: str) -> float:
    """One uniform number in [0, 1), such as a setting of a run."""
    return int(hashlib.md5(f"{seed}|{salt}".encode()).hexdigest()[:8], 16) / SPAN


def scalar_normal(seed: int, salt: str) -> float:
    """One standard normal number for a whole column, from the same hashing."""
    h1, h2 = (
        int(hashlib.md5(f"{seed}|{salt}|{part}".encode()).hexdigest()[:8], 16)
        for part in ("r", "a")
    )
    return math.sqrt(-2.0 * math.log((h1 + 1) / (SPAN + 1))) * math.cos(2 * math.pi * h2 / SPAN)
