"""Feature attributions of boosted trees and the feature sets cut from them.

The attributions are the path-dependent Shapley values of Lundberg et al. (2018).
A leaf with value v reached under conditions on the features j contributes to
feature i, with z the share of training rows passing the conditions of a feature
and o = 1 if the row itself passes them,

    v (o_i - z_i) * integral over t in [0, 1] of prod_{j != i} (z_j (1 - t) + o_j t)

because the Shapley weights are the moments of t^s (1 - t)^(d - 1 - s). The
integrand is a polynomial, so a few Gauss-Legendre points give the exact value.

A condition is a set of bins, whether it came from thresholds or from categories.
Leaves with equally many features on their path are stacked in one array, so that
a few array operations cover all leaves of all trees.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from duewatch.operators.boosting import BoostedTrees

# Edges of the cumulative-share bins and the smallest set kept.
SHARE_EDGES = [0, 0.05, 0.1, 0.2, 0.3, 0.4, 0.5, 0.7, 0.9, 1.1]
SHARE_NAMES = ["0–5%", "5–10%", "10–20%", "20–30%", "30–40%", "40–50%", "50–70%", "70–90%", "90–110%"]
SMALLEST_SET = 3


CELLS = 1 << 21  # rows x leaves x features looked at together


@dataclass(frozen=True)
class LeafStack:
    """Leaves with ``d`` features on their path: values (leaves,), features and shares (leaves, d), and for each of these
    features the bins that pass (leaves, d, bins)."""

    values: np.ndarray
    used: np.ndarray
    shares: np.ndarray
    passing: np.ndarray


def leaf_stacks(model: BoostedTrees) -> list[LeafStack]:
    """All leaves of the model, stacked by the number of features on their path."""
    width = model.binning.width
    by_size: dict[int, list] = {}
    for tree in model.trees:
        open_paths: list[tuple[int, dict]] = [(0, {})]
        while open_paths:
            node, conditions = open_paths.pop()
            feature = tree.feature[node]
            if feature < 0:
                by_size.setdefault(len(conditions), []).append((tree.value[node], conditions))
                continue
            left = np.zeros(width, bool)
            bins = tree.left_bins[node]
            left[list(bins) if not isinstance(bins, int) else slice(0, bins + 1)] = True
            passing, share = conditions.get(feature, (np.ones(width, bool), 1.0))
            for child, side in ((tree.left[node], left), (tree.right[node], ~left)):
                part = share * tree.cover[child] / tree.cover[node]
                open_paths.append((child, {**conditions, feature: (passing & side, part)}))
    stacks = []
    for size, found in sorted(by_size.items()):
        used = [sorted(conditions) for _, conditions in found]
        stacks.append(LeafStack(
            np.array([value for value, _ in found]),
            np.array(used, np.int64).reshape(len(found), size),
            np.array([[c[f][1] for f in own] for own, (_, c) in zip(used, found)]).reshape(len(found), size),
            np.array([[c[f][0] for f in own] for own, (_, c) in zip(used, found)], bool).reshape(len(found), size, width),
        ))
    return stacks


def row_attributions(bins: np.ndarray, stacks: list[LeafStack]) -> np.ndarray:
    """Attributions of rows given as bin numbers: one column per feature, base value left out."""
    result = np.zeros(bins.shape)
    for stack in stacks:
        leaves, size = stack.used.shape
        if not size:
            continue
        points, weights = np.polynomial.legendre.leggauss(size // 2 + 1)
        flat = stack.used.ravel()
        order = np.argsort(flat, kind="stable")
        firsts = np.flatnonzero(np.concatenate([[True], np.diff(flat[order]) > 0]))
        passing, conditions = stack.passing.reshape(leaves * size, -1), np.arange(leaves * size)
        step = max(1, CELLS // (leaves * size))
        for begin in range(0, len(bins), step):
            own = bins[begin : begin + step]
            passed = passing[conditions, own[:, flat]].reshape(len(own), leaves, size)
            total = np.zeros(passed.shape)
            for point, weight in zip((points + 1) / 2, weights / 2):
                factors = np.where(passed, stack.shares * (1 - point) + point, stack.shares * (1 - point))
                total += weight * factors.prod(axis=2, keepdims=True) / factors
            total *= (passed - stack.shares) * stack.values[:, None]
            sums = np.add.reduceat(total.reshape(len(own), -1)[:, order], firsts, axis=1)
            result[begin : begin + step, flat[order][firsts]] += sums
    return result


def base_value(model: BoostedTrees, stacks: list[LeafStack]) -> float:
    """The margin of the average training row; with a row's attributions it adds up to the row's margin."""
    return model.base + float(sum((s.values * s.shares.prod(axis=1)).sum() for s in stacks))


def attribution_totals(model: BoostedTrees, df: DataFrame, tolerance: float = 1e-6) -> DataFrame:
    """Per feature: the sum of absolute attributions over all rows, the rows, and for how many of them base value and
    attributions add up to the margin.

    Each task adds up its own rows, so only one number per feature and batch is shuffled.
    """
    spark = df.sparkSession
    shared = spark.sparkContext.broadcast((model, leaf_stacks(model)))
    names = [f"f{place}" for place in range(len(model.binning.features))]

    def partial_sums(batches):
        model, stacks = shared.value
        base = base_value(model, stacks)
        for batch in batches:
            bins = model.binning.numbered([batch.column(name) for name in names])
            found = row_attributions(bins, stacks)
            exact = np.abs(base + found.sum(axis=1) - model.margins(bins)) <= tolerance
            places = np.array(model.columns)
            yield pa.RecordBatch.from_pydict({
                "place": pa.array(places, pa.int32()),
                "total": pa.array(np.abs(found).sum(axis=0)[places], pa.float64()),
                "rows": pa.array(np.full(len(places), len(bins)), pa.int64()),
                "adds_up": pa.array(np.full(len(places), int(exact.sum())), pa.int64()),
            })

    values = df.select(*[column.alias(name) for column, name in zip(model.binning.columns(), names)])
    listed = F.array(*[F.lit(name) for name in model.binning.features])
    return (
        values.mapInArrow(partial_sums, "place int, total double, rows long, adds_up long")
        .groupBy("place")
        .agg(F.sum("total").alias("total"), F.sum("rows").alias("rows"), F.sum("adds_up").alias("adds_up"))
        .select(F.get(listed, F.col("place")).alias("feature"), "total", "rows", "adds_up")
    )


def ranked_shares(totals: DataFrame) -> DataFrame:
    """Features by falling total with rank and cumulative share, an even one where all totals are 0. One row per feature."""
    order = Window.partitionBy().orderBy(F.col("total").desc(), "feature")
    whole = Window.partitionBy()
    upto = F.sum("total").over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    rank = F.row_number().over(order)
    even = rank / F.count(F.lit(1)).over(whole)
    return totals.select(
        "feature",
        "total",
        rank.alias("rank"),
        F.coalesce(F.try_divide(upto, F.sum("total").over(whole)), even).alias("cumulative"),
        F.count(F.lit(1)).over(whole).alias("features"),
    )


def feature_bins(totals: DataFrame) -> DataFrame:
    """Nested feature sets: a bin of the cumulative share holds its own and all earlier features."""
    names = SHARE_NAMES
    place = F.coalesce(*[F.when(F.col("cumulative") <= edge, F.lit(n)) for n, edge in enumerate(SHARE_EDGES[1:])])
    placed = ranked_shares(totals).withColumn("_own", place)
    nested = placed.withColumn("bin", F.explode(F.sequence(F.col("_own"), F.lit(len(names) - 1))))
    listed = F.transform(F.array_sort(F.collect_list(F.struct("rank", "feature"))), lambda item: item["feature"])
    sets = nested.groupBy("bin").agg(
        F.count_if(F.col("_own") == F.col("bin")).alias("_own_features"),
        F.count(F.lit(1)).alias("features"),
        F.max("cumulative").alias("share"),
        listed.alias("feature_names"),
    )
    kept = sets.where((F.col("_own_features") > 0) & (F.col("features") >= SMALLEST_SET))
    label = F.get(F.array(*[F.lit(name) for name in names]), F.col("bin"))
    return kept.select(label.alias("feature_group"), "features", "share", "feature_names")


def feature_knee(totals: DataFrame) -> DataFrame:
    """The features up to the largest gap between cumulative share and an even spread."""
    gap = F.col("cumulative") - F.col("rank") / F.col("features")
    ranked = ranked_shares(totals).withColumn("_gap", gap)
    first = F.min(F.struct(-F.col("_gap"), "rank")).over(Window.partitionBy())
    upto = ranked.withColumn("_knee", first["rank"]).where(F.col("rank") <= F.col("_knee"))
    listed = F.transform(F.array_sort(F.collect_list(F.struct("rank", "feature"))), lambda item: item["feature"])
    return upto.agg(
        F.count(F.lit(1)).alias("features"), F.max("cumulative").alias("share"), listed.alias("feature_names")
    ).select(F.lit("knee").alias("feature_group"), "features", "share", "feature_names")


def feature_groups(totals: DataFrame) -> dict[str, list[str]]:
    """All feature sets by name; as many as there are bins, plus the knee."""
    sets = feature_bins(totals).unionByName(feature_knee(totals))
    return {row["feature_group"]: list(row["feature_names"]) for row in sets.collect()}
