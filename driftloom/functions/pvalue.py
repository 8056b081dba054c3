"""Two-sided p-value of the two-sample Kolmogorov-Smirnov statistic.

Works on the driver on one (D, n, m) triple per compared column, after Spark has
reduced the data to it. The law is the caller's choice: the exact distribution (lattice-path
count, Hodges 1957), Kolmogorov's limit law, or "auto", exact up to ``EXACT_LIMIT`` rows per sample.
"""

from __future__ import annotations

import math

import numpy as np

EXACT_LIMIT = 10_000
LAWS = ("auto", "exact", "limit")
_SWITCH = 1.18  # both series converge fast on their side of this point


def limit_law(d: float, n: int, m: int) -> float:
    lam = d * math.sqrt(n * m / (n + m))
    if lam <= 0.0:
        return 1.0
    if lam >= _SWITCH:
        j = np.arange(1, 101)
        p = 2.0 * np.sum(np.where(j % 2 == 1, 1.0, -1.0) * np.exp(-2.0 * j**2 * lam**2))
    else:
        k = 2 * np.arange(1, 101) - 1
        p = 1.0 - math.sqrt(2 * math.pi) / lam * np.sum(
            np.exp(-(k**2) * math.pi**2 / (8 * lam**2))
        )
    return float(min(1.0, max(0.0, p)))


def exact_law(d: float, n: int, m: int) -> float:
    """1 - share of lattice paths from (0,0) to (n,m) that stay closer than d."""
    if n < m:
        n, m = m, n
    lcm = n * m // math.gcd(n, m)
    h = round(d * lcm)
    if h == 0:
        return 1.0
    a, b = lcm // n, lcm // m
    # row i holds path counts for the j with |i*a - j*b| < h, scaled by 2**shift
    row = np.zeros(m + 1)
    row[: min(m, (h - 1) // b) + 1] = 1.0
    log_scale = 0.0
    for i in range(1, n + 1):
        lo = max(0, -((h - 1 - i * a) // b))
        hi = min(m, (i * a + h - 1) // b)
        fresh = np.zeros(m + 1)
        if lo <= hi:
            fresh[lo : hi + 1] = np.cumsum(row[lo : hi + 1])
        top = fresh.max()
        if top == 0.0:
            return 1.0
        if top > 1e200:
            fresh /= top
            log_scale += math.log(top)
        row = fresh
    if row[m] == 0.0:
        return 1.0
    log_paths = math.lgamma(n + m + 1) - math.lgamma(n + 1) - math.lgamma(m + 1)
    inside = math.exp(math.log(row[m]) + log_scale - log_paths)
    return float(min(1.0, max(0.0, 1.0 - inside)))


def ks_pvalue(d: float | None, n: int, m: int, law: str = "auto") -> float | None:
    if law not in LAWS:
        raise ValueError(f"law must be one of {LAWS}")
    if d is None or min(n, m) == 0:
        return None
    exact = law == "exact" or (law == "auto" and max(n, m) <= EXACT_LIMIT)
    return exact_law(d, n, m) if exact else limit_law(d, n, m)
