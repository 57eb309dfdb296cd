"""Folds, training, attributions and feature sets."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from duewatch.operators import attribution, learning
from duewatch.operators.labelled import consecutive_overlap, customers_in_both, split_name, training_set
from duewatch.operators.monitor import OOT, SPLIT_CALENDAR, TEST, TRAIN, auc_alerts, highest_level, performance_status

FEATURES = ["a", "b", "c", "d"]


@pytest.fixture(scope="module")
def rows(spark):
    rng = np.random.default_rng(11)
    data = []
    for n in range(240):
        x = rng.normal(size=4)
        label = int(x[0] + 0.5 * x[1] * x[2] + 0.3 * rng.normal() > 0)
        data.append((f"C{n}", label, *map(float, x)))
    return spark.createDataFrame(data, "Customer_ID string, label int, a double, b double, c double, d double").cache()


@pytest.fixture(scope="module")
def model(rows):
    return learning.fit_classifier(rows, FEATURES, {"max_depth": 3, "learning_rate": 0.3}, trees=4)


def test_folds_are_even_per_label_also_for_copies(spark, rows):
    copies = spark.createDataFrame([("same", 1)] * 101 + [("x", 0)] * 47, "Customer_ID string, label int")
    for frame, folds in ((copies, 5), (rows, 4)):
        folded = learning.stratified_folds(frame, folds)
        assert folded.count() == frame.count()
        sizes = {}
        for row in folded.groupBy("label", "fold").count().collect():
            sizes.setdefault(row["label"], []).append(row["count"])
        for counts in sizes.values():
            assert len(counts) == folds and max(counts) - min(counts) <= 1


def test_feature_columns_leave_out_ids(spark):
    frame = spark.createDataFrame([("c", 1, 2.0, "t")], "Customer_ID string, label int, x double, kind string")
    assert learning.feature_columns(frame) == (["x"], ["kind"])
    with pytest.raises(ValueError):
        learning.feature_columns(frame.select("Customer_ID", "label"))


def test_encoding(spark):
    frame = spark.createDataFrame([("1.5", "b"), ("x", "a"), (None, None), ("2", "c")], "n string, k string")
    found = {tuple(row) for row in learning.encoded(frame, ["n"], ["k"]).collect()}
    assert found == {(1.5, 1), (None, 0), (None, None), (2.0, 2)}


def test_encoding_of_many_categories(spark):
    frame = spark.range(3000).selectExpr("lpad(cast(id as string), 5, '0') as k", "id")
    assert learning.encoded(frame, [], ["k"]).where("k <> id").isEmpty()


def test_scores_and_decision(model, rows):
    scored = learning.scored(model, rows, threshold=0.6).collect()
    assert len(scored) == 240
    assert all(row.prediction == int(row.default_probability >= 0.6) for row in scored)
    assert set(rows.columns) < set(scored[0].asDict())


def test_metrics(spark):
    data = [(1, 1, 0.9), (1, 0, 0.8), (1, 1, 0.2), (1, 0, 0.1), (2, 1, 0.1), (2, 0, 0.2)]
    frame = spark.createDataFrame(data, "fold int, label int, default_probability double")
    found = {row.fold: row for row in learning.classification_metrics(frame, ["fold"]).collect()}
    one, two = found[1], found[2]
    assert (one.accuracy, one.precision, one.recall, one.f1, one.auc) == (0.5, 0.5, 0.5, 0.5, 0.75)
    assert one.log_loss == pytest.approx(-(math.log(0.9) + math.log(0.2) + math.log(0.2) + math.log(0.9)) / 4)
    assert (two.precision, two.recall, two.f1, two.auc) == (0.0, 0.0, 0.0, 0.0)


def test_feature_sets(spark):
    totals = spark.createDataFrame([("a", 50.0), ("b", 20.0), ("c", 10.0), ("d", 8.0), ("e", 7.0), ("f", 5.0)], "feature string, total double")
    bins = {row.feature_group: row.feature_names for row in attribution.feature_bins(totals).collect()}
    # Shares .5 .7 .8 .88 .95 1: bins 40-50 (a) and 50-70 (b) are too small to be kept.
    assert bins == {"70–90%": ["a", "b", "c", "d"], "90–110%": ["a", "b", "c", "d", "e", "f"]}
    knee = attribution.feature_knee(totals).first()
    assert (knee.feature_group, knee.feature_names) == ("knee", ["a", "b"])
    assert set(attribution.feature_groups(totals)) == {"70–90%", "90–110%", "knee"}


def test_shares_without_any_attribution_are_even(spark):
    totals = spark.createDataFrame([(f"f{n}", 0.0) for n in range(4)], "feature string, total double")
    assert [row.cumulative for row in attribution.ranked_shares(totals).orderBy("rank").collect()] == [0.25, 0.5, 0.75, 1.0]


def test_random_search_refits_the_best_trial(rows):
    model, best, trials = learning.random_search(rows, FEATURES, trials=3, folds=2, trees=3, together=2)
    trials = trials.collect()
    assert best["cv_auc"] == max(row.mean_auc for row in trials) > 0.6
    assert [(row.trial, row.rows) for row in trials] == [(0, 240), (1, 240), (2, 240)]
    assert all(set(row.parameters) == set(learning.SEARCH_SPACE) for row in trials)
    assert model.features == FEATURES


def test_search_over_feature_groups(rows):
    groups = {"one": ["a", "b", "c"], "two": ["b", "c", "d"]}
    model, best, trials = learning.random_search(rows, FEATURES, trials=2, folds=2, feature_groups=groups, trees=2)
    assert model.features == groups[best["feature_group"]] and {row.feature_group for row in trials.collect()} <= set(groups)


def test_training_set_pairs_months_and_drops_gaps(spark):
    labels = spark.sql("""select * from values ('A', 1, date '2023-07-01'), ('B', 0, date '2023-07-01'), ('A', 0, date '2023-08-01'),
        ('C', 1, date '2023-07-01') as t(Customer_ID, label, snapshot_date)""")
    features = spark.sql("""select * from values ('A', 1.0D, date '2023-01-01'), ('B', null, date '2023-01-01'), ('A', 2.0D, date '2023-02-01'),
        ('C', 3.0D, date '2023-07-01') as t(Customer_ID, x, snapshot_date)""")
    found = sorted(map(tuple, training_set(labels, features).collect()))
    assert found == [("A", 0, 2.0, "2023-02-01"), ("A", 1, 1.0, "2023-01-01")]
    assert training_set(labels, features, months=["2023-08-01"]).count() == 1


def test_customers_in_both_months(spark):
    labels = spark.sql("""select * from values ('A', date '2023-07-01'), ('A', date '2023-08-01'), ('B', date '2023-07-01'), ('A', date '2023-07-01'),
        ('C', date '2023-08-01') as t(Customer_ID, snapshot_date)""")
    assert [row[0] for row in customers_in_both(labels, "2023-07-01", "2023-08-01").collect()] == ["A"]
    assert [row.customers for row in consecutive_overlap(labels).collect()] == [1]


def test_split_calendar(spark):
    days = spark.sql("select explode(array(date '2023-07-01', date '2024-03-01', date '2024-06-01', date '2024-09-01', date '2024-10-01')) as d")
    found = [row[0] for row in days.select(split_name(F.col("d"), SPLIT_CALENDAR)).collect()]
    assert found == [TRAIN, TRAIN, TEST, OOT, "Other"]


def scores(spark, **groups):
    names = {"train": TRAIN, "test": TEST, "oot": OOT}
    rows = [(names.get(key, f"{key[1:].replace('_', '-')} (Inference)"), value) for key, value in groups.items()]
    return spark.createDataFrame(rows, "group string, auc double")


def drifted(spark, *flags):
    rows = [(f"f{n}", 0.01, flag) for n, flag in enumerate(flags)]
    return spark.createDataFrame(rows, "feature string, p_value double, drift_detected boolean")


def test_alert_levels(spark):
    table = scores(spark, oot=0.8, m2024_10=0.9, m2024_11=0.75, m2024_12=0.71, m2025_01=0.6)
    alerts = {row.month: (row.level, row.message) for row in auc_alerts(table).collect()}
    assert {month: level for month, (level, _) in alerts.items()} == {
        "2024-11 (Inference)": "Warning", "2024-12 (Inference)": "Alert", "2025-01 (Inference)": "Critical"
    }
    assert alerts["2024-11 (Inference)"][1] == (
        "2024-11 (Inference) AUC (0.7500) is >5% below OOT AUC (0.8000). Closer observation is advised."
    )
    assert tuple(highest_level(auc_alerts(table), drifted(spark, False)).first()) == ("Critical", False, True)


def test_no_alerts_without_out_of_time_auc(spark):
    table = scores(spark, train=0.9, m2024_10=0.2)
    assert auc_alerts(table).count() == 0
    assert tuple(highest_level(auc_alerts(table), drifted(spark, False)).first()) == ("OK", False, False)
    assert tuple(highest_level(auc_alerts(table), drifted(spark, True, False)).first()) == ("OK", True, True)


@pytest.mark.parametrize(
    "groups, status",
    [
        ({"oot": 0.8, "m2024_10": 0.77}, "Good"), ({"oot": 0.8, "m2024_10": 0.75}, "Bad"),
        ({"test": 0.8, "m2024_10": 0.74}, "Bad"), ({"train": 0.8, "m2024_10": 0.73}, "Good"),
        ({"train": 0.8, "m2024_10": 0.71}, "Bad"), ({"train": 0.8}, "Good"),
    ],
)
def test_status(spark, groups, status):
    row = performance_status(scores(spark, **groups), drifted(spark, True, False, True)).first()
    assert (row.feature_drift, row.model_auc_performance) == ("2 / 3 features drifted", status)
