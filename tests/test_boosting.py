"""Boosted trees against a brute-force fit, and the search's sampler."""

import itertools
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from duewatch.operators import attribution, boosting, learning
from duewatch.operators.boosting import BoostedTrees
from duewatch.operators.search import Sampler

PARAMETERS = [
    {"max_depth": 3, "learning_rate": 0.3},
    {"max_depth": 2, "learning_rate": 0.5, "gamma": 1.5, "reg_alpha": 0.7, "reg_lambda": 3.0, "min_child_weight": 2.0},
    {"max_depth": 3, "reg_alpha": 2.0, "reg_lambda": 0.01, "colsample_bytree": 0.6, "subsample": 0.7},
]


@pytest.fixture(scope="module")
def rows(spark):
    rng = np.random.default_rng(11)
    data = []
    for n in range(200):
        x = [float(v) for v in rng.normal(size=3).round(1)]
        kind = "abcdefg"[rng.integers(7)]
        odd = x[0] + 0.5 * x[1] * x[2] + (1 if kind in "ace" else -1) + 0.3 * rng.normal()
        data.append((f"C{n}", int(odd > 0), *x, kind))
    return spark.createDataFrame(data, "Customer_ID string, label int, a double, b double, c double, k string").cache()


def brute_tree(bins, is_set, g, h, p, drawn, rows, depth):
    """(feature, left bins, left, right) or a leaf's value, by trying every split of every feature."""
    l1, l2 = p.get("reg_alpha", 0.0), p.get("reg_lambda", 1.0)
    shrink = lambda v: math.copysign(max(abs(v) - l1, 0.0), v)
    score = lambda own: shrink(g[own].sum()) ** 2 / (h[own].sum() + l2)
    best = None
    for f in drawn if depth else []:
        values = sorted(set(bins[rows, f]))
        if is_set[f]:
            sums = {v: [s[rows][bins[rows, f] == v].sum() for s in (g, h)] for v in values}
            values.sort(key=lambda v: (sums[v][0] / (sums[v][1] + l2), v))
        for n in range(1, len(values)):
            left = set(values[:n])
            mask = np.isin(bins[rows, f], list(left))
            sides = rows[mask], rows[~mask]
            if min(h[s].sum() for s in sides) < p.get("min_child_weight", 1.0):
                continue
            gain = sum(map(score, sides)) - score(rows)
            if gain > 1e-9 and gain >= p.get("gamma", 0.0) and (best is None or gain > best[0] + 1e-9):
                best = gain, f, left, sides
    if best is None:
        return -p.get("learning_rate", 0.3) * shrink(g[rows].sum()) / (h[rows].sum() + l2)
    _, f, left, sides = best
    return f, left, *[brute_tree(bins, is_set, g, h, p, drawn, s, depth - 1) for s in sides]


def brute_value(tree, row, is_set):
    while isinstance(tree, tuple):
        f, left, low, high = tree
        tree = low if (row[f] in left if is_set[f] else row[f] <= max(left)) else high
    return tree


@pytest.mark.parametrize("parameters", PARAMETERS)
def test_trees_equal_a_brute_force_fit(rows, parameters):
    trees = 4
    binned, binning = learning.numbered_bins(learning.complete_rows(rows, list("abc"), ["k"]), list("abc"), ["k"], 1, 42, 256)
    data = binned.orderBy("number").collect()
    bins = np.array([np.frombuffer(r.bins, np.int16) for r in data])
    labels, numbers = np.array([r.label for r in data]), np.array([r.number for r in data])
    is_set = [False] * 3 + [True]
    model = boosting.grow_models(binned, binning, [boosting.Fit(parameters)], trees, kept_trees=2)[0]
    share = labels.mean()
    margin = np.full(len(labels), math.log(share / (1 - share)))
    assert model.base == pytest.approx(margin[0])
    for place in range(trees):
        p = 1 / (1 + np.exp(-margin))
        g, h = (np.rint(v * boosting.UNIT) / boosting.UNIT for v in (p - labels, p * (1 - p)))
        kept = np.ones(len(labels), bool)
        if "subsample" in parameters:
            kept = boosting.uniform(numbers, hash((42, place))) < parameters["subsample"]
        columns = max(1, int(parameters.get("colsample_bytree", 1.0) * 4))
        drawn = sorted(random.Random(f"42/{place}").sample(range(4), columns))
        tree = brute_tree(bins, is_set, g, h, parameters, drawn, np.flatnonzero(kept), parameters["max_depth"])
        margin += [brute_value(tree, row, is_set) for row in bins]
        partial = BoostedTrees(binning, model.base, model.trees[: place + 1], model.columns)
        assert partial.margins(bins) == pytest.approx(margin, abs=1e-7)


def test_models_do_not_depend_on_layout_or_company(rows):
    one = learning.fit_classifier(rows.coalesce(1), list("abc"), PARAMETERS[0], 3, ["k"])
    many = learning.fit_classifier(rows.repartition(7), list("abc"), PARAMETERS[0], 3, ["k"])
    assert one == many
    binned, binning = learning.numbered_bins(learning.complete_rows(rows, list("abc"), ["k"]), list("abc"), ["k"], 2, 42, 256)
    fits = [boosting.Fit(PARAMETERS[0]), boosting.Fit(PARAMETERS[1], held_out=1), boosting.Fit(PARAMETERS[2], columns=[0, 3])]
    together = boosting.grow_models(binned, binning, fits, 3)
    assert together == [boosting.grow_models(binned, binning, [fit], 3)[0] for fit in fits] and together[0] == one


def test_unseen_categories_and_nulls(spark, rows, tmp_path):
    model = learning.fit_classifier(rows, list("abc"), PARAMETERS[0], 3, ["k"])
    odd = spark.createDataFrame(
        [(1.0, 1.0, 1.0, "new"), (1.0, 1.0, 1.0, None), (None, 1.0, 1.0, "a"), (math.nan, 1.0, 1.0, "a"), (1e9, 1.0, 1.0, "a")],
        "a double, b double, c double, k string",
    )
    found = [r.default_probability for r in learning.scored(model, odd).collect()]
    assert all(0 < p < 1 for p in found) and found[0] == found[1] and found[2] == found[3] == found[4]
    model.save(spark, str(tmp_path / "model"))
    assert BoostedTrees.load(spark, str(tmp_path / "model")) == model


def test_rare_categories_share_a_bin(spark):
    frame = spark.sql("select 1 as label, case when id < 50 then 'often' when id < 70 then 'b' else concat('r', id) end as k from range(100)")
    binning = boosting.learn_bins(frame, [], ["k"], bins=2)
    assert binning.categories == [{"often": 0, "b": 1}] and binning.width == 3


def test_numbers_of_rows_do_not_depend_on_layout(spark):
    rows = [("same", 1)] * 25 + [(f"r{n % 60}", n % 2) for n in range(90)] + [(None, 0)] * 3 + [("n", None)] * 4
    frame = spark.createDataFrame(rows, "Customer_ID string, label int")
    found = [sorted(map(tuple, learning.stratified_folds(f, 4, bucket_rows=b).collect()), key=repr)
             for f in (frame.coalesce(1), frame.repartition(7), frame.orderBy("label")) for b in (8, 4096)]
    assert all(f == found[0] for f in found) and len(found[0]) == len(rows)


def brute_shapley(model, stacks, row):
    """Shapley values by all feature subsets; features outside the subset are averaged by leaf shares."""
    features = len(row)

    def value(known):
        total = 0.0
        for s in stacks:
            for leaf in range(len(s.values)):
                weight = 1.0
                for place, f in enumerate(s.used[leaf]):
                    weight *= float(s.passing[leaf, place, row[f]]) if f in known else s.shares[leaf, place]
                total += s.values[leaf] * weight
        return total

    result = np.zeros(features)
    for feature in range(features):
        others = [f for f in range(features) if f != feature]
        for size in range(features):
            for subset in itertools.combinations(others, size):
                weight = math.factorial(size) * math.factorial(features - size - 1) / math.factorial(features)
                result[feature] += weight * (value({*subset, feature}) - value(set(subset)))
    return result


def test_attributions_equal_brute_force_and_add_up(rows):
    model = learning.fit_classifier(rows, list("abc"), PARAMETERS[0], 4, ["k"])
    stacks = attribution.leaf_stacks(model)
    binned, _ = learning.numbered_bins(learning.complete_rows(rows, list("abc"), ["k"]), list("abc"), ["k"], 1, 42, 256)
    bins = np.array([np.frombuffer(r.bins, np.int16) for r in binned.collect()])
    found = attribution.row_attributions(bins, stacks)
    for row, own in zip(bins[:10], found):
        assert own == pytest.approx(brute_shapley(model, stacks, row), abs=1e-10)
    assert found.sum(axis=1) + attribution.base_value(model, stacks) == pytest.approx(model.margins(bins), abs=1e-9)
    totals = {r.feature: r for r in attribution.attribution_totals(model, rows.repartition(5)).collect()}
    assert [totals[f].total for f in "abck"] == pytest.approx(list(np.abs(found).sum(axis=0)))
    assert all(r.rows == r.adds_up == 200 for r in totals.values())


SPACE = {"x": ("even", -2.0, 2.0), "rate": ("log", 0.001, 1.0), "depth": ("whole", 1, 12), "kind": ("choice", ["p", "q", "r"])}


def bowl(point):
    return -((point["x"] - 0.7) ** 2) - math.log10(point["rate"] / 0.05) ** 2 - ((point["depth"] - 9) / 6) ** 2 + (point["kind"] == "q")


def test_the_sampler_beats_random_draws():
    ahead = []
    for seed in range(15):
        best = []
        for random_trials in (10, 10**9):
            sampler = Sampler(SPACE, seed, random_trials)
            values = []
            for _ in range(50):
                point = sampler.draw()
                assert -2 <= point["x"] <= 2 and 0.001 <= point["rate"] <= 1 and point["depth"] in range(1, 13)
                values.append(bowl(point))
                sampler.tell(point, values[-1])
            best.append(max(values))
        ahead.append(best[0] - best[1])
    assert sum(a > 0 for a in ahead) >= 11 and sum(ahead) > 0


def test_the_sampler_repeats_itself_and_takes_unknown_values():
    runs = []
    for _ in range(2):
        sampler = Sampler(SPACE, 3, 2)
        points = []
        for n in range(8):
            points.append(sampler.draw())
            sampler.tell(points[-1], None if n % 3 == 0 else bowl(points[-1]))
        runs.append(points)
    assert runs[0] == runs[1]


def test_binned_rows_are_dealt_to_the_cores(spark):
    from duewatch.operators.learning import LEAST_ROWS, numbered_bins

    rows = spark.range(5 * LEAST_ROWS).select((F.col("id") % 2).cast("int").alias("label"), F.col("id").cast("double").alias("x"))
    binned, _ = numbered_bins(rows, ["x"], [], 2, 42, 16)
    cores = spark.sparkContext.defaultParallelism
    sizes = [r["count"] for r in binned.groupBy(F.input_file_name()).count().collect()]
    assert len(sizes) == min(5, cores) and max(sizes) < 2 * min(sizes) and sum(sizes) == 5 * LEAST_ROWS


def test_binary_columns_decode_from_any_slice():
    import pyarrow as pa
    from duewatch.operators.boosting import _numbers

    values = np.arange(30, dtype=np.int16).reshape(10, 3)
    column = pa.array([row.tobytes() for row in values], pa.binary())
    assert _numbers(column.slice(4, 3), np.int16).reshape(3, 3).tolist() == values[4:7].tolist()
    assert _numbers(column.slice(0, 0), np.int16).size == 0
