"""Minimum-covariance-determinant estimates of many groups at once.

For each group, concentration steps look for the ``share`` of its rows with the
least covariance determinant: distances under the current centre and covariance,
then centre and covariance of the nearest rows, again and again, from medians
and quartiles. A step is one aggregation. It sums moments per group and distance
bin (a sixteenth of an octave), so a group of any size is pre-aggregated in every
task, and only bins are ordered; the bin that reaches the share counts whole.

Per feature, ``floors`` are the least standard deviations that matter. Their
squares are added to every covariance, so groups of equal rows or features that
are mostly zero stay regular, and a third of copies in a group cannot turn its
other rows into outliers.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from duewatch.llm.scratch import Scratch

BINS_PER_OCTAVE = 16
LEAST_DISTANCE = 2.0**-20


def chi_square_cdf(x: float, df: int) -> float:
    """For an even number of degrees of freedom."""
    if df % 2:
        raise ValueError("an even number of features is expected")
    return 1 - math.exp(-x / 2) * sum((x / 2) ** k / math.factorial(k) for k in range(df // 2))


def chi_square_quantile(p: float, df: int) -> float:
    low, high = 0.0, 1000.0
    for _ in range(200):
        middle = (low + high) / 2
        low, high = (middle, high) if chi_square_cdf(middle, df) < p else (low, middle)
    return high


def consistency(share: float, df: int) -> float:
    """What the covariance of the central ``share`` is to be multiplied by under normality."""
    return share / chi_square_cdf(chi_square_quantile(share, df), df + 2)


def squared_distance(features: Sequence[str], centre: str = "centre", inverse: str = "inverse") -> Column:
    """Mahalanobis distance, squared, as one JVM expression over feature columns and estimate arrays."""
    size = len(features)
    away = [F.col(f) - F.element_at(centre, i + 1) for i, f in enumerate(features)]
    total = F.lit(0.0)
    for i in range(size):
        for j in range(i, size):
            weight = 1.0 if i == j else 2.0
            total = total + away[i] * away[j] * F.element_at(inverse, i * size + j + 1) * F.lit(weight)
    return total


def _inverted(size: int, floors: Sequence[float], factor: float):
    least = np.diag(np.square(floors))

    def run(batches):
        for batch in batches:
            rows = batch.to_pylist()
            centres, inverses = [], []
            for row in rows:
                n, sums, products = row["n"], np.array(row["sums"]), np.array(row["products"])
                centre = sums / n
                spread = np.zeros((size, size))
                spread[np.triu_indices(size)] = products / n
                spread = spread + np.triu(spread, 1).T - np.outer(centre, centre)
                centres.append(centre.tolist())
                inverses.append(np.linalg.inv(factor * spread + least).ravel().tolist())
            yield pa.RecordBatch.from_arrays(
                [batch.column("key"), batch.column("members"), pa.array(centres, pa.list_(pa.float64())),
                 pa.array(inverses, pa.list_(pa.float64()))],
                names=["key", "members", "centre", "inverse"],
            )

    return run


def mcd_estimates(
    rows: DataFrame, features: Sequence[str], floors: Sequence[float], share: float = 0.6, steps: int = 5
) -> DataFrame:
    """Estimates (key, members, centre, inverse) per value of ``rows.key`` over the double columns ``features``.

    ``rows`` is read once per step, so pass a written table; each step's estimates are written too. A group of one row has itself as centre and the floors as
    spread. Null features are not allowed; no rows give no estimates.
    """
    size, scratch = len(features), Scratch(rows.sparkSession)
    schema = "key string, members long, centre array<double>, inverse array<double>"
    quarters = rows.groupBy("key").agg(
        F.count(F.lit(1)).alias("members"),
        *[F.percentile_approx(f, [0.25, 0.5, 0.75], 1000).alias(f"q_{i}") for i, f in enumerate(features)],
    )
    zero = F.lit(0.0)
    spreads = [
        F.lit(1.0) / (F.pow((F.col(f"q_{i}")[2] - F.col(f"q_{i}")[0]) / 1.349, 2) + F.lit(floors[i] ** 2))
        for i in range(size)
    ]
    estimates = quarters.select(
        "key", "members", F.array(*[F.col(f"q_{i}")[1] for i in range(size)]).alias("centre"),
        F.array(*[spreads[i] if i == j else zero for i in range(size) for j in range(size)]).alias("inverse"),
    )
    pairs = [(i, j) for i in range(size) for j in range(i, size)]
    for _ in range(steps):
        near = F.greatest(squared_distance(features), F.lit(LEAST_DISTANCE))
        binned = (
            rows.join(estimates, "key")
            .withColumn("bin", F.floor(F.log2(near) * BINS_PER_OCTAVE).cast("int"))
            .groupBy("key", "members", "bin")
            .agg(
                F.count(F.lit(1)).alias("n"),
                *[F.sum(f).alias(f"s_{i}") for i, f in enumerate(features)],
                *[F.sum(F.col(features[i]) * F.col(features[j])).alias(f"p_{i}_{j}") for i, j in pairs],
            )
        )
        order = Window.partitionBy("key").orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
        central = binned.withColumn("nearer", F.coalesce(F.sum("n").over(order), F.lit(0))).filter(
            F.col("nearer") < F.col("members") * share
        )
        moments = central.groupBy("key", "members").agg(
            F.sum("n").alias("n"),
            F.array(*[F.sum(f"s_{i}") for i in range(size)]).alias("sums"),
            F.array(*[F.sum(f"p_{i}_{j}") for i, j in pairs]).alias("products"),
        )
        inverted = moments.mapInArrow(_inverted(size, floors, consistency(share, size)), schema)
        previous, estimates = estimates, scratch.put(inverted, "mcd")
        scratch.drop(previous)
    return estimates
