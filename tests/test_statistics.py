"""Order statistics and drift tests against brute force, with the data in many slices."""

import itertools
import math
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from duewatch.functions.pvalues import _chi_square_tail, _exact_ks_tail, _matrix_law, _series_law, kolmogorov_tail, one_sample_tail
from duewatch.operators.drift import chi2_test, density_histogram, drift_report, ks_test
from duewatch.operators.ranking import exact_quantiles, in_slices, roc_auc


@pytest.fixture(autouse=True)
def many_slices(spark):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def brute_auc(labels, scores):
    positive = [s for label, s in zip(labels, scores) if label == 1]
    negative = [s for label, s in zip(labels, scores) if label == 0]
    wins = sum((p > n) + 0.5 * (p == n) for p in positive for n in negative)
    return wins / (len(positive) * len(negative))


def scored_frame(spark, rows):
    return spark.createDataFrame(rows, "key string, label int, default_probability double")


def test_auc_with_a_hot_group_and_ties(spark):
    rng = np.random.default_rng(1)
    rows = [("hot", int(rng.random() < 0.3), float(round(rng.random(), 2))) for _ in range(600)]
    rows += [("hot", int(n % 2), 0.5) for n in range(300)]
    rows += [("small", int(n % 2), float(n)) for n in range(5)]
    frame = scored_frame(spark, rows)
    slices = in_slices(frame, ["key"], "default_probability").select("_slice").distinct().count()
    assert slices > 1
    found = {row.key: row.auc for row in roc_auc(frame, ["key"]).collect()}
    for key in found:
        part = [row for row in rows if row[0] == key]
        assert found[key] == pytest.approx(brute_auc([r[1] for r in part], [r[2] for r in part]), abs=1e-12)


def test_auc_of_reversed_scores(spark):
    rng = np.random.default_rng(2)
    rows = [("k", int(rng.random() < 0.5), float(rng.random())) for _ in range(200)]
    forward = roc_auc(scored_frame(spark, rows), ["key"]).first().auc
    backward = roc_auc(scored_frame(spark, [(k, y, -s) for k, y, s in rows]), ["key"]).first().auc
    assert forward == pytest.approx(1 - backward, abs=1e-12)


def test_auc_needs_two_classes(spark):
    assert roc_auc(scored_frame(spark, [("k", 1, 0.1), ("k", 1, 0.2)]), ["key"]).first().auc is None


def test_quantiles_interpolate_like_numpy(spark):
    rng = np.random.default_rng(3)
    data = {"a": rng.normal(size=501), "b": rng.integers(0, 5, size=400).astype(float), "c": np.array([7.0])}
    rows = [(key, float(v)) for key, values in data.items() for v in values]
    frame = spark.createDataFrame(rows, "key string, value double")
    probabilities = [0.0, 0.25, 0.5, 0.75, 0.9, 1.0]
    found = {(r.key, r.probability): r.quantile for r in exact_quantiles(frame, ["key"], "value", probabilities).collect()}
    assert len(found) == len(data) * len(probabilities)
    for key, values in data.items():
        for p in probabilities:
            assert found[(key, p)] == pytest.approx(np.percentile(values, p * 100), abs=1e-12)


def brute_ks(left, right):
    points = np.concatenate([left, right])
    shares = [np.searchsorted(np.sort(side), points, side="right") / len(side) for side in (left, right)]
    return np.abs(shares[0] - shares[1]).max()


def sides_frame(spark, left, right):
    rows = [(True, float(v)) for v in left] + [(False, float(v)) for v in right]
    return spark.createDataFrame(rows, "is_reference boolean, x double")


def test_ks_statistic(spark):
    rng = np.random.default_rng(4)
    for left, right in [
        (rng.normal(size=300), rng.normal(0.3, size=200)),
        (rng.integers(0, 4, 300), rng.integers(1, 5, 200)),
        (np.zeros(50), np.ones(30)),
        (rng.normal(5, size=100), rng.normal(size=400)),
    ]:
        row = ks_test(sides_frame(spark, left, right), "is_reference", ["x"]).first()
        assert row.statistic == pytest.approx(brute_ks(left, right), abs=1e-12)
        assert (row.n_reference, row.n_current) == (len(left), len(right))


@pytest.mark.parametrize("n, m", [(1, 1), (3, 4), (5, 5), (2, 7), (6, 4)])
def test_exact_ks_p_value_counts_all_orders(n, m):
    distances = []
    for left in itertools.combinations(range(n + m), n):
        right = [place for place in range(n + m) if place not in left]
        distances.append(brute_ks(np.array(left), np.array(right)))
    distances = np.array(distances)
    for distance in np.unique(distances.round(12)):
        expected = (distances >= distance - 1e-9).mean()
        assert _exact_ks_tail(float(distance), n, m) == pytest.approx(expected, abs=1e-12)
        assert _exact_ks_tail(float(distance), m, n) == pytest.approx(expected, abs=1e-12)


def test_exact_and_asymptotic_ks_p_values_meet(spark):
    frame = spark.createDataFrame([(0.03, 4000, 3000)], "d double, n long, m long")
    asymptotic = frame.select(kolmogorov_tail(F.col("d"), F.col("n"), F.col("m"))).first()[0]
    assert _exact_ks_tail(0.03, 4000, 3000) == pytest.approx(asymptotic, rel=0.03)


def test_ks_of_a_table_with_itself(spark):
    values = np.random.default_rng(5).normal(size=200)
    row = ks_test(sides_frame(spark, values, values), "is_reference", ["x"]).first()
    assert (row.statistic, row.p_value, row.drift_detected) == (pytest.approx(0, abs=1e-12), 1.0, False)


def test_ks_skips_gaps_and_bears_an_empty_side(spark):
    rows = [(True, 1.0), (True, None), (True, float("nan")), (False, None)]
    row = ks_test(spark.createDataFrame(rows, "is_reference boolean, x double"), "is_reference", ["x"]).first()
    assert (row.n_reference, row.n_current, row.drift_detected) == (1, 0, False)


def test_kolmogorov_tail(spark):
    frame = spark.createDataFrame([(0.2, 1000, 800), (0.05, 1000, 800), (0.001, 1000, 800)], "d double, n long, m long")
    found = [row[0] for row in frame.select(kolmogorov_tail(F.col("d"), F.col("n"), F.col("m"))).collect()]
    size = math.sqrt(1000 * 800 / 1800)
    for d, p in zip((0.2, 0.05), found):
        scaled = (size + 0.12 + 0.11 / size) * d
        exact = 2 * sum((-1) ** (j - 1) * math.exp(-2 * j * j * scaled * scaled) for j in range(1, 101))
        assert p == pytest.approx(exact, abs=1e-12)
    assert found[2] == 1.0


@pytest.mark.parametrize(
    "critical, freedom", [(3.841458820694124, 1), (5.991464547107979, 2), (7.814727903251179, 3), (18.307038053275146, 10), (124.34211340400407, 100)]
)
def test_chi_square_tail(critical, freedom):
    assert _chi_square_tail(critical, freedom) == pytest.approx(0.05, abs=1e-9)


def categories(spark, left, right):
    rows = [(True, v) for v in left] + [(False, v) for v in right]
    return spark.createDataFrame(rows, "is_reference boolean, c string")


def test_chi2_without_and_with_correction(spark):
    three = categories(spark, ["a"] * 10 + ["b"] * 20, ["a"] * 30 + ["b"] * 15 + ["z"] * 5)
    row = chi2_test(three, "is_reference", ["c"]).first()
    table = np.array([[10, 30], [20, 15], [0, 5]], dtype=float)
    expected = table.sum(1, keepdims=True) * table.sum(0) / table.sum()
    assert row.statistic == pytest.approx(((table - expected) ** 2 / expected).sum())
    assert row.freedom == 2 and row.p_value == pytest.approx(math.exp(-row.statistic / 2))

    two = categories(spark, ["a"] * 10 + ["b"] * 20, ["a"] * 30 + ["b"] * 15)
    row = chi2_test(two, "is_reference", ["c"]).first()
    table = np.array([[10, 30], [20, 15]], dtype=float)
    expected = table.sum(1, keepdims=True) * table.sum(0) / table.sum()
    distance = np.abs(table - expected) - 0.5
    assert row.statistic == pytest.approx((distance**2 / expected).sum())
    assert row.p_value == pytest.approx(math.erfc(math.sqrt(row.statistic / 2)))


def test_chi2_of_one_category_and_of_one_side(spark):
    one = chi2_test(categories(spark, ["a"] * 5, ["a"] * 9), "is_reference", ["c"]).first()
    assert (one.statistic, one.p_value, one.drift_detected, one.notes) == (0.0, 1.0, False, None)
    alone = chi2_test(categories(spark, ["a", "b"], [None]), "is_reference", ["c"]).first()
    assert (alone.p_value, alone.drift_detected, alone.notes) == (None, False, "Test not applicable")


def test_report_has_one_record_per_feature(spark):
    frame = spark.createDataFrame([(n % 2 == 0, float(n), str(n % 3)) for n in range(60)], "is_reference boolean, x double, c string")
    rows = drift_report(frame, "is_reference", ["x"], ["c"]).collect()
    assert sorted((row.feature, row.test) for row in rows) == [("c", "Chi-squared"), ("x", "Kolmogorov-Smirnov")]
    with pytest.raises(ValueError):
        drift_report(frame, "is_reference", [], [])


def numpy_bins(values):
    spread = np.ptp(values)
    if spread == 0:
        return 1
    quartiles = np.percentile(values, [75, 25])
    diaconis = 2 * (quartiles[0] - quartiles[1]) / len(values) ** (1 / 3)
    sturges = spread / (np.log2(len(values)) + 1)
    return int(np.ceil(spread / (min(diaconis, sturges) if diaconis else sturges)))


def test_histograms_match_numpy(spark):
    rng = np.random.default_rng(6)
    left, right = rng.normal(size=400), rng.exponential(size=300)
    found = {}
    for row in density_histogram(sides_frame(spark, left, right), "is_reference", ["x"]).orderBy("bin").collect():
        found.setdefault(row.is_reference, []).append(row.density)
    for side, values in ((True, left), (False, right)):
        density, _ = np.histogram(values, bins=numpy_bins(values), density=True)
        assert found[side] == pytest.approx([d for d in density if d])  # empty bins are not listed


def test_histogram_of_a_long_tail_and_of_a_constant(spark):
    rng = np.random.default_rng(7)
    left = np.concatenate([rng.normal(size=500), [1e4]])
    rows = density_histogram(sides_frame(spark, left, np.full(20, 3.0)), "is_reference", ["x"], bins=250).collect()
    density, _ = np.histogram(left, bins=250, density=True)
    assert {r.bins for r in rows} == {250}
    assert {r.bin: r.density for r in rows if r.is_reference} == pytest.approx({n: d for n, d in enumerate(density) if d})


def test_histogram_of_equal_values(spark):
    rows = density_histogram(sides_frame(spark, [3.0] * 9, [3.0] * 4), "is_reference", ["x"]).collect()
    assert sorted((r.is_reference, r.bin, r.bin_start, r.bin_end, r.density) for r in rows) == [
        (False, 0, 2.5, 3.5, 1.0), (True, 0, 2.5, 3.5, 1.0)
    ]


def test_features_without_values_are_reported(spark):
    rows = [(i % 2 == 0, float(i), None, "a", None) for i in range(40)]
    frame = spark.createDataFrame(rows, "is_reference boolean, x double, e double, c string, n string")
    report = {r.feature: r for r in drift_report(frame, "is_reference", ["x", "e"], ["c", "n"]).collect()}
    assert set(report) == {"x", "e", "c", "n"}
    for name in ("e", "n"):
        assert report[name].notes == "Test not applicable" and not report[name].drift_detected


def test_a_given_number_of_bins_is_used(spark):
    frame = sides_frame(spark, np.arange(50.0), np.arange(10.0))
    bins = density_histogram(frame, "is_reference", ["x"], bins=7).groupBy("is_reference").count().collect()
    assert [row["count"] for row in bins] == [7, 7]


def test_one_sample_law_has_its_published_values():
    assert 1 - one_sample_tail(0.274, 10) == pytest.approx(0.62847961545650, abs=1e-12)
    # Critical distances at five percent by sample size, and at one percent.
    for size, five, one in ((5, 0.56328, 0.66853), (10, 0.40925, 0.48893), (20, 0.29408, 0.35241), (40, 0.21012, 0.25205)):
        assert one_sample_tail(five, size) == pytest.approx(0.05, abs=2e-5)
        assert one_sample_tail(one, size) == pytest.approx(0.01, abs=1e-5)
    # With two values, from 1 / 4: 1 - 2 (2 d - 1 / 2)^2 to d = 1 / 2, then 2 (1 - d)^2.
    for d in (0.3, 0.45, 0.6, 0.9):
        expected = 1 - 2 * (2 * d - 0.5) ** 2 if d <= 0.5 else 2 * (1 - d) ** 2
        assert one_sample_tail(d, 2) == pytest.approx(expected, abs=1e-12)


def test_the_series_meets_the_matrix_and_its_work_does_not_grow():
    for size in (500, 1000):
        for z in (0.4, 0.6, 0.9, 1.2, 1.6, 2.2, 3.0):
            d = z / math.sqrt(size)
            assert _series_law(d, size) == pytest.approx(_matrix_law(d, size), abs=1e-6)
    began = time.perf_counter()
    assert one_sample_tail(1.3581 / math.sqrt(1e12), 10**12) == pytest.approx(0.05, abs=1e-4)
    assert time.perf_counter() - began < 1
    tails = [one_sample_tail(d, size) for size in (900, 1100) for d in (0.05, 0.1, 0.13, 0.2, 0.5, 0.99, 1.0)]
    assert all(0 <= t <= 1 for t in tails) and tails[:7] == sorted(tails[:7], reverse=True) and tails[7:] == sorted(tails[7:], reverse=True)


def test_ks_laws_agree_on_large_samples(spark):
    rng = np.random.default_rng(8)
    rows = [(True, float(x)) for x in rng.normal(size=1500)] + [(False, float(x)) for x in rng.normal(0.06, 1, size=1200)]
    frame = spark.createDataFrame(rows, "s boolean, a double")
    found = [ks_test(frame, "s", ["a"], law).head()["p_value"] for law in ("asymptotic", "one_sample", "exact")]
    assert found == pytest.approx([found[2]] * 3, abs=0.01) and found[1] > 0


def test_one_far_value_does_not_blow_up_a_histogram(spark):
    rows = [(True, float(n % 50)) for n in range(2000)] + [(True, 1e9), (False, 1.0)]
    found = density_histogram(spark.createDataFrame(rows, "s boolean, a double"), "s", ["a"]).collect()
    own = [row for row in found if row.s]
    assert len(own) <= 51 and own[0].bins > 10**8
    assert sum(row.density * (row.bin_end - row.bin_start) for row in own) == pytest.approx(1, abs=1e-6)


def test_histograms_can_list_their_empty_bins(spark):
    rng = np.random.default_rng(8)
    values = np.concatenate([rng.normal(size=300), [40.0]])
    rows = density_histogram(sides_frame(spark, values, [1.0, 2.0]), "is_reference", ["x"], bins=25_000, empty_bins=True).collect()
    found = {side: [r.density for r in sorted(rows, key=lambda r: r.bin) if r.is_reference == side] for side in (True, False)}
    for side, own in ((True, values), (False, [1.0, 2.0])):
        density, _ = np.histogram(own, bins=25_000, density=True)
        assert found[side] == pytest.approx(list(density))


def test_the_histogram_query_lists_every_bin(spark):
    from duewatch.catalog import QUERIES

    found = {}
    for row in QUERIES["stat_histogram"](spark, "/root/testdata/sf0.001").collect():
        found.setdefault((row.feature, row.is_reference, row.bins), []).append(row)
    for (_, _, bins), rows in found.items():
        assert sorted(row.bin for row in rows) == list(range(bins))
    assert any(row.density == 0 for rows in found.values() for row in rows)
