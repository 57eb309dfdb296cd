"""Tail probabilities of the two drift tests."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def kolmogorov_tail(statistic: Column, n_left: Column, n_right: Column, terms: int = 100) -> Column:
    """Asymptotic two-sample p-value with Stephens' small-sample correction, null for an empty sample."""
    left, right = n_left.cast("double"), n_right.cast("double")
    size = F.sqrt(F.try_divide(left * right, left + right))
    scaled = (size + F.lit(0.12) + F.try_divide(F.lit(0.11), size)) * statistic
    series = F.aggregate(
        F.sequence(F.lit(1), F.lit(terms)),
        F.lit(0.0),
        lambda acc, j: acc + F.when(j % 2 == 1, F.lit(2.0)).otherwise(F.lit(-2.0)) * F.exp(-2.0 * j * j * scaled * scaled),
    )
    # Below 0.2 the series needs ever more terms while the probability is 1 to 12 digits.
    bounded = F.greatest(F.lit(0.0), F.least(F.lit(1.0), series))
    return F.when(scaled < 0.2, F.lit(1.0)).when(scaled.isNotNull(), bounded)


def _exact_ks_tail(statistic: float, n_left: int, n_right: int) -> float:
    """Chance of a distance of at least ``statistic`` when all orders of the pooled sample are equally likely.

    ``inside`` holds, by the number of values drawn from the smaller sample, the
    chance that the distance has stayed below ``statistic`` so far, given that
    number; each round draws one more value of the pooled sample. Only counts
    within reach of that distance are worked on.
    """
    few, many = sorted((n_left, n_right))
    exponent = 2.0 * statistic * statistic * few * many / (few + many)
    if exponent > 36.0:  # below the precision of one minus a chance
        return 2.0 * math.exp(-exponent)
    limit = (math.floor(statistic * few * many - 1e-7) + 0.5) / (few * many)
    if limit < 0:
        return 1.0
    reach = 1.0 / few + 1.0 / many
    inside = np.zeros(few + 2)  # the first place stands for one value less than none
    inside[1] = 1.0
    for drawn in range(1, few + many + 1):
        low = max(0, drawn - many, math.ceil((drawn / many - limit) / reach))
        high = min(few, drawn, math.floor((drawn / many + limit) / reach))
        counts = np.arange(low, high + 1)
        stay, step = inside[low + 1 : high + 2], inside[low : high + 1]
        reached = (stay * (drawn - counts) + step * counts) / drawn
        inside[low : low + 1] = 0.0
        inside[low + 1 : high + 2] = reached
        inside[high + 2 : high + 3] = 0.0
    return max(0.0, 1.0 - float(inside[-1]))


@F.pandas_udf(T.DoubleType())
def exact_ks_tail(statistic: pd.Series, n_left: pd.Series, n_right: pd.Series) -> pd.Series:
    """Exact p-values, null for an empty sample; one row per feature, and work that grows with the sample sizes."""
    usable = statistic.notna() & (n_left > 0) & (n_right > 0)
    return pd.Series(
        [
            _exact_ks_tail(float(d), int(n), int(m)) if known else None
            for d, n, m, known in zip(statistic, n_left, n_right, usable)
        ],
        dtype="float64",
    )


MATRIX_SIZES = 1000  # sample sizes up to which the one-sample law is computed by its matrix form


def _matrix_law(distance: float, size: int) -> float:
    """P(D < distance) of the one-sample statistic by powers of a matrix (Marsaglia, Tsang and Wang, 2003)."""
    k = int(size * distance) + 1
    width, rest = 2 * k - 1, k - size * distance
    rows, columns = np.indices((width, width))
    base = (rows - columns + 1 >= 0).astype(float)
    powers = rest ** np.arange(1, width + 1)
    base[:, 0] -= powers
    base[-1] -= powers[::-1]
    base[-1, 0] += max(0.0, 2 * rest - 1) ** width
    factorials = np.cumprod(np.concatenate([[1.0], np.arange(1.0, min(width, 170) + 1)]))
    steps = np.clip(rows - columns + 1, 0, None)
    base = np.where(steps < len(factorials), base / factorials[np.minimum(steps, len(factorials) - 1)], 0.0)
    result, scale, factor, factor_scale, left = np.eye(width), 0, base, 0, size
    while left:  # binary powers; exponents of ten are held apart
        if left % 2:
            result, scale = result @ factor, scale + factor_scale
        factor, factor_scale, left = factor @ factor, 2 * factor_scale, left // 2
        for _ in range(2):
            if factor[k - 1, k - 1] > 1e140:
                factor, factor_scale = factor * 1e-140, factor_scale + 140
            if result[k - 1, k - 1] > 1e140:
                result, scale = result * 1e-140, scale + 140
    logs = math.log(max(result[k - 1, k - 1], 1e-300)) + scale * math.log(10) + math.lgamma(size + 1) - size * math.log(size)
    return min(1.0, math.exp(logs))


def _series_law(distance: float, size: int) -> float:
    """P(D < distance) by the series in 1 / sqrt(size) of Pelz and Good (1976); the work does not depend on the size."""
    z = math.sqrt(size) * distance
    z2, z4, z6 = z**2, z**4, z**6
    half, whole = math.pi**2 * (np.arange(-40, 40) + 0.5) ** 2, math.pi**2 * np.arange(-40.0, 41.0) ** 2
    at_half, at_whole = np.exp(-half / (2 * z2)), np.exp(-whole / (2 * z2))
    root = math.sqrt(math.pi / 2)
    terms = (
        root / z * at_half.sum(),
        root / (6 * z4) * ((half - z2) * at_half).sum(),
        root / (72 * z**7) * ((6 * z6 + 2 * z4 + half * (2 * z4 - 5 * z2) + half**2 * (1 - 2 * z2)) * at_half).sum()
        - root / (36 * z**3) * (whole * at_whole).sum(),
        root / (6480 * z**10) * (
            (half**3 * (5 - 30 * z2) + half**2 * (212 * z4 - 60 * z2) + half * (135 * z4 - 96 * z6) - 30 * z6 - 90 * z**8) * at_half
        ).sum() + root / (216 * z6) * ((3 * whole * z2 - whole**2) * at_whole).sum(),
    )
    return min(1.0, max(0.0, sum(term / size ** (n / 2) for n, term in enumerate(terms))))


def one_sample_tail(distance: float, size: int) -> float:
    """P(D >= distance) of the Kolmogorov statistic of one sample of ``size`` values.

    Exact by a matrix to size 1000, and by a series beyond, which differs by under 1e-6 there. Far tails, of which both would
    lose the digits, are twice the one-sided law: its exact sum, and beyond size 1000 the first
    term of its expansion.
    """
    if size <= 0 or distance >= 1:
        return 0.0 if size > 0 else 1.0
    if size * distance <= 0.5:
        return 1.0
    if size * distance**2 > (4 if size <= MATRIX_SIZES else 12):
        one_sided = math.exp(-((6 * size * distance + 1) ** 2) / (18 * size)) if size > MATRIX_SIZES else _one_sided(distance, size)
        return 2 * one_sided
    return max(0.0, 1.0 - (_matrix_law if size <= MATRIX_SIZES else _series_law)(distance, size))


def _one_sided(distance: float, size: int) -> float:
    """P(D+ >= distance), the exact sum of Smirnov, for sizes that are computed exactly."""
    total = 0.0
    for j in range(int(size * (1 - distance)) + 1):
        rest = 1 - distance - j / size
        if rest <= 0:
            continue
        total += math.exp(
            math.lgamma(size + 1) - math.lgamma(j + 1) - math.lgamma(size - j + 1) + (size - j) * math.log(rest)
            + (j - 1) * math.log(distance + j / size)
        )
    return distance * total


@F.pandas_udf(T.DoubleType())
def one_sample_ks_tail(statistic: pd.Series, n_left: pd.Series, n_right: pd.Series) -> pd.Series:
    """P-values by the one-sample law at the rounded effective size, null for an empty sample; one row per feature."""
    usable = statistic.notna() & (n_left > 0) & (n_right > 0)
    return pd.Series(
        [
            one_sample_tail(float(d), max(1, round(int(n) * int(m) / (int(n) + int(m))))) if known else None
            for d, n, m, known in zip(statistic, n_left, n_right, usable)
        ],
        dtype="float64",
    )


KS_LAWS = {"asymptotic": kolmogorov_tail, "one_sample": one_sample_ks_tail, "exact": exact_ks_tail}


def ks_tail(statistic: Column, n_left: Column, n_right: Column, law: str = "asymptotic") -> Column:
    """Two-sample p-value by one law at every size: asymptotic, that of one sample of the effective size, or exact (work that
    grows with the samples)."""
    return KS_LAWS[law](statistic, n_left, n_right)


def _chi_square_tail(statistic: float, freedom: int) -> float:
    """Q(freedom/2, statistic/2) as the closed finite sum for whole degrees of freedom."""
    if freedom <= 0 or statistic <= 0:
        return 1.0
    half = statistic / 2.0
    odd = freedom % 2
    powers = np.arange(freedom // 2) + odd / 2.0
    logs = np.array([math.lgamma(power + 1.0) for power in powers])
    series = float(np.exp(powers * math.log(half) - half - logs).sum())
    return min(1.0, series + (math.erfc(math.sqrt(half)) if odd else 0.0))


@F.pandas_udf(T.DoubleType())
def chi_square_tail(statistic: pd.Series, freedom: pd.Series) -> pd.Series:
    """P(X > statistic); used on results with one row per feature."""
    return pd.Series(
        [None if pd.isna(s) or pd.isna(f) else _chi_square_tail(float(s), int(f)) for s, f in zip(statistic, freedom)],
        dtype="float64",
    )
