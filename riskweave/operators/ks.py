"""P-values of the two-sample Kolmogorov-Smirnov distance."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

KS_EXACT_LIMIT = 10_000
_TERMS = 101


def _kolmogorov_tail(x: Column) -> Column:
    """2 * sum (-1)^(j-1) exp(-2 j^2 x^2), cut to [0, 1]; small x -> 1."""
    series = F.aggregate(
        F.sequence(F.lit(1), F.lit(_TERMS)),
        F.lit(0.0),
        lambda acc, j: acc + F.when(j % 2 == 1, 1.0).otherwise(-1.0) * F.exp(-2.0 * j * j * x * x),
    )
    return F.when(x < 0.04, F.lit(1.0)).otherwise(F.greatest(F.lit(0.0), F.least(F.lit(1.0), 2.0 * series)))


def ks_pvalue_limit(distance: Column, effective_n: Column) -> Column:
    """The limit law at ``distance * sqrt(n*m/(n+m))``."""
    return _kolmogorov_tail(distance * F.sqrt(effective_n))


def inside_probability(n: int, m: int, threshold: int) -> float:
    """Probability that a random merge of n and m items keeps |i*m - j*n| < threshold.

    ``P(i, j) = P(i-1, j) * i/(i+j) + P(i, j-1) * j/(i+j)`` inside the band and
    zero outside, filled diagonal by diagonal (``i + j`` constant); only the
    cells inside the band are kept, so the work is the area of the band.
    """
    if threshold <= 0:
        return 0.0
    low_prev, prev = 0, np.ones(1)
    for s in range(1, n + m + 1):
        # i*m - (s-i)*n = i*(n+m) - s*n must lie strictly inside +-threshold
        low = max(0, s - m, (s * n - threshold) // (n + m) + 1)
        high = min(n, s, -((-(s * n + threshold)) // (n + m)) - 1)
        if low > high:
            return 0.0
        i = np.arange(low, high + 1)
        j = s - i
        padded = np.zeros(high - low + 2)
        # padded[k] = P(low - 1 + k, s - 1 - (low - 1 + k)) on the previous diagonal
        start = low_prev - (low - 1)
        a, b = max(0, start), min(len(padded), start + len(prev))
        if b > a:
            padded[a:b] = prev[a - start : b - start]
        prev = (padded[:-1] * i + padded[1:] * j) / s
        low_prev = low
    return float(prev[0]) if low_prev == n else 0.0


def exact_pvalue(distance: float, n: int, m: int) -> float:
    """P(KS >= distance) for two samples of n and m distinct values."""
    g = math.gcd(n, m)
    lattice = n // g * m
    steps = round(distance * lattice)
    if steps == 0:
        return 1.0
    # |i/n - j/m| >= steps/lattice  <=>  |i*m - j*n| >= steps*g
    return min(1.0, max(0.0, 1.0 - inside_probability(n, m, steps * g)))


def _matrix_power(n: int, distance: float) -> float:
    """P(D_n < distance) as an element of the n-th power of a band matrix.

    With ``n * distance = k - h`` (k whole, 0 <= h < 1) the matrix has 2k - 1 rows
    of inverse factorials and corner terms in powers of h. Powers are kept near
    one by exact powers of two, which are counted apart.
    """
    k = math.floor(n * distance) + 1
    m, h = 2 * k - 1, k - n * distance
    i, j = np.indices((m, m))
    steps = i - j + 1
    log_factorial = np.array([math.lgamma(x + 1) for x in range(m + 1)])
    matrix = np.where(steps < 0, 0.0, np.exp(-log_factorial[np.maximum(steps, 0)]))
    powers = np.array([h**x for x in range(1, m + 1)])
    terms = powers * np.exp(-log_factorial[1 : m + 1])
    matrix[:, 0] -= terms
    matrix[-1, :] -= terms[::-1]
    if 2 * h > 1:
        matrix[-1, 0] += (2 * h - 1) ** m * math.exp(-log_factorial[m])
    result, shift, factor, factor_shift, left = np.eye(m), 0, matrix, 0, n
    while left:
        if left & 1:
            result, shift = result @ factor, shift + factor_shift
            result, shift = _rescaled(result, shift)
        left >>= 1
        if left:
            factor, factor_shift = _rescaled(factor @ factor, 2 * factor_shift)
    centre = result[k - 1, k - 1]
    if centre <= 0:
        return 0.0
    # times n! / n^n
    return math.exp(math.log(centre) + shift * math.log(2) + math.lgamma(n + 1) - n * math.log(n))


def _rescaled(matrix: np.ndarray, shift: int) -> tuple[np.ndarray, int]:
    most = np.abs(matrix).max()
    power = math.frexp(most)[1] if most > 0 else 0
    return np.ldexp(matrix, -power), shift + power


def _series(n: int, distance: float) -> float:
    """P(D_n < distance): the limit law and its terms in 1/sqrt(n), 1/n, 1/n^1.5."""
    z = math.sqrt(n) * distance
    k = np.arange(-20, 21, dtype=float)
    half2, whole2 = (math.pi * (k + 0.5)) ** 2, (math.pi * k) ** 2
    a, b = np.exp(-half2 / (2 * z * z)), np.exp(-whole2 / (2 * z * z))
    root = math.sqrt(math.pi / 2)
    first = root / z * a.sum()
    second = root / (6 * z**4) * ((half2 - z * z) * a).sum()
    third = root / (72 * z**7) * ((6 * z**6 + 2 * z**4 + half2 * (2 * z**4 - 5 * z * z) + half2**2 * (1 - 2 * z * z)) * a).sum()
    third -= root / (36 * z**3) * (whole2 * b).sum()
    fourth = (half2**3 * (5 - 30 * z * z) + half2**2 * (212 * z**4 - 60 * z * z) + half2 * (135 * z**4 - 96 * z**6) - 30 * z**6 - 90 * z**8) * a
    fourth = root / (6480 * z**10) * fourth.sum() + root / (216 * z**6) * ((3 * whole2 * z * z - whole2**2) * b).sum()
    return first + second / math.sqrt(n) + third / n + fourth / n**1.5


def _one_sided_tail(n: int, distance: float) -> float:
    """P(D_n^+ >= distance): the finite sum, or beyond a million rows its expansion."""
    if n > 1_000_000:
        return math.exp(-((6 * n * distance + 1) ** 2) / (18 * n))
    j = np.arange(0, math.floor(n * (1 - distance)) + 1, dtype=float)
    rest = 1 - distance - j / n
    j, rest = j[rest > 0], rest[rest > 0]
    log_binomial = math.lgamma(n + 1) - _lgamma(j + 1) - _lgamma(n - j + 1)
    return float(distance * np.exp(log_binomial + (j - 1) * np.log(distance + j / n) + (n - j) * np.log(rest)).sum())


def _lgamma(x: np.ndarray) -> np.ndarray:
    """log Gamma for arguments of 1 and more: Stirling's series after a shift by eight."""
    shifted = x + 8.0
    product = np.ones_like(x)
    for i in range(8):
        product *= x + i
    inverse = 1.0 / shifted
    series = inverse / 12 - inverse**3 / 360 + inverse**5 / 1260 - inverse**7 / 1680
    return (shifted - 0.5) * np.log(shifted) - shifted + 0.5 * math.log(2 * math.pi) + series - np.log(product)


def finite_pvalue(distance: float, n: int) -> float:
    """P(D_n >= distance) of one sample of n rows against its law, for any n.

    Small distances have a closed form, large ones are twice the one-sided tail
    (both sides at once are rarer than a double can tell); between them the
    matrix power is used while it is small, then the series.
    """
    if n <= 0 or distance >= 1:
        return 0.0 if n > 0 else 1.0
    if 2 * n * distance <= 1:
        return 1.0
    if n * distance <= 1:
        return 1.0 - math.exp(math.lgamma(n + 1) + n * (math.log(2 * distance - 1.0 / n)))
    if n * distance * distance >= 4 or (n * distance * distance >= 2.2 and n > 140):
        return min(1.0, 2.0 * _one_sided_tail(n, distance))
    small = n <= 140 or (n <= 100_000 and n * distance**1.5 <= 1.4)
    inside = _matrix_power(n, distance) if small else _series(n, distance)
    return min(1.0, max(0.0, 1.0 - inside))


@F.pandas_udf(DoubleType())
def ks_pvalue_finite(distance: pd.Series, effective_n: pd.Series) -> pd.Series:
    """The one-sample law at the rounded effective size n*m/(n+m)."""
    values = [finite_pvalue(float(d), round(n)) if pd.notna(d) and pd.notna(n) else None for d, n in zip(distance, effective_n)]
    return pd.Series(values, dtype="float64")


@F.pandas_udf(DoubleType())
def ks_pvalue_exact(distance: pd.Series, n_ref: pd.Series, n_cur: pd.Series) -> pd.Series:
    values = [
        exact_pvalue(float(d), int(n), int(m)) if pd.notna(d) and n > 0 and m > 0 else None
        for d, n, m in zip(distance, n_ref, n_cur)
    ]
    return pd.Series(values, dtype="float64")
