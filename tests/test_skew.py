"""The same results when a third of all rows share one key and nothing may be broadcast."""

import collections

import numpy as np
import pytest
from pyspark.sql import functions as F

from duewatch.operators.customers import ages_imputed
from duewatch.operators.drift import chi2_test, ks_test
from duewatch.operators.labelled import scored_with_labels, training_set, unmatched_labels, with_label_membership
from duewatch.operators.months import latest_known
from duewatch.operators.ranking import exact_quantiles, roc_auc

# Settings under which adaptive execution splits even small partitions.
SETTINGS = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.0",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1b",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "2k",
}
ROWS = 6000


@pytest.fixture(autouse=True)
def no_broadcast(spark):
    before = {key: spark.conf.get(key, None) for key in SETTINGS}
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    yield
    for key, value in before.items():
        if value is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, value)


@pytest.fixture(scope="module")
def events(spark):
    """Customer-months with a score; one customer holds a third of the rows."""
    n = F.col("id")
    return spark.range(0, ROWS, 1, 6).select(
        F.when(n % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("c"), (n % 400).cast("string"))).alias("Customer_ID"),
        F.add_months(F.lit("2023-01-01").cast("date"), (n % 12).cast("int")).alias("snapshot_date"),
        (n % 2).cast("int").alias("label"),
        (F.pmod(F.xxhash64(n), F.lit(1000)) / 1000).alias("default_probability"),
    )


def labels_of(spark):
    rows = [(f"c{n}", n % 2) for n in range(300)] + [("hot", 1), ("nobody", 0)]
    frame = spark.createDataFrame(rows, "Customer_ID string, label int")
    months = F.sequence(F.lit("2023-01-01").cast("date"), F.lit("2023-12-01").cast("date"), F.expr("interval 1 month"))
    return frame.select("Customer_ID", F.explode(months).alias("snapshot_date"), "label")


def test_joins(spark, events):
    labels = labels_of(spark)
    rows = events.collect()
    known = {(f"c{n}") for n in range(300)} | {"hot"}
    joined = scored_with_labels(events.drop("label"), labels)
    assert joined.count() == sum(row.Customer_ID in known for row in rows)
    present = {(row.Customer_ID, row.snapshot_date) for row in rows}
    wanted = sum((row.Customer_ID, row.snapshot_date) not in present for row in labels.collect())
    assert unmatched_labels(events, labels).agg(F.sum("unmatched")).first()[0] == wanted
    member = with_label_membership(events, labels)
    assert member.count() == ROWS
    assert member.where("label_snapshot_month is not null").count() == sum(row.Customer_ID in known for row in rows)


def test_training_set(spark, events):
    features = events.drop("label").withColumn("snapshot_date", F.add_months("snapshot_date", -6))
    rows = events.collect()
    known = {(f"c{n}") for n in range(300)} | {"hot"}
    assert training_set(labels_of(spark), features).count() == sum(row.Customer_ID in known for row in rows)


def test_group_means_with_a_hot_group(spark, events):
    people = events.select(
        "Customer_ID",
        F.when(F.col("default_probability") < 0.1, F.lit(None)).otherwise(F.col("default_probability") * 100).alias("Age"),
        F.when(F.col("Customer_ID") == "hot", F.lit("big")).otherwise(F.lit("rest")).alias("Occupation"),
        F.lit("2023-01-01").cast("date").alias("snapshot_date"),
    )
    sums = collections.defaultdict(list)
    rows = people.collect()
    for row in rows:
        if row.Age is not None:
            sums[row.Occupation].append(row.Age)
    # Spark rounds halves up.
    expected = collections.Counter(
        (row.Occupation, int(np.floor((row.Age if row.Age is not None else np.mean(sums[row.Occupation])) + 0.5))) for row in rows
    )
    found = collections.Counter((row.Occupation, row.Age) for row in ages_imputed(people).collect())
    assert found == expected


def test_order_statistics(spark, events):
    rows = events.withColumn("key", F.when(F.col("Customer_ID") == "hot", F.lit("hot")).otherwise(F.lit("rest")))
    data = collections.defaultdict(list)
    for row in rows.collect():
        data[row.key].append((row.default_probability, row.label))
    quantiles = {(r.key, r.probability): r.quantile for r in exact_quantiles(rows, ["key"], "default_probability", [0.1, 0.5]).collect()}
    aucs = {row.key: row.auc for row in roc_auc(rows, ["key"]).collect()}
    for key, pairs in data.items():
        scores, labels = np.array([p[0] for p in pairs]), np.array([p[1] for p in pairs])
        for share in (0.1, 0.5):
            assert quantiles[(key, share)] == pytest.approx(np.quantile(scores, share), abs=1e-12)
        good, bad = scores[labels == 1], scores[labels == 0]
        wins = (good[:, None] > bad).sum() + 0.5 * (good[:, None] == bad).sum()
        assert aucs[key] == pytest.approx(wins / (len(good) * len(bad)), abs=1e-12)


def test_drift_with_one_value_on_a_third_of_the_rows(spark, events):
    both = events.select(
        (F.col("label") == 1).alias("is_reference"),
        F.when(F.col("Customer_ID") == "hot", F.lit(0.5)).otherwise(F.col("default_probability")).alias("x"),
        "Customer_ID",
    )
    rows = both.collect()
    left, right = (np.sort([row.x for row in rows if row.is_reference is side]) for side in (True, False))
    points = np.concatenate([left, right])
    gap = np.abs(np.searchsorted(left, points, "right") / len(left) - np.searchsorted(right, points, "right") / len(right)).max()
    assert ks_test(both, "is_reference", ["x"]).first().statistic == pytest.approx(gap, abs=1e-12)
    counts = collections.Counter((row.Customer_ID, row.is_reference) for row in rows)
    table = np.array([[counts[(c, True)], counts[(c, False)]] for c in {row.Customer_ID for row in rows}], dtype=float)
    expected = table.sum(1, keepdims=True) * table.sum(0) / table.sum()
    row = chi2_test(both, "is_reference", ["Customer_ID"]).first()
    assert row.statistic == pytest.approx(((table - expected) ** 2 / expected).sum())
    assert row.freedom == len(table) - 1


def test_newest_row_of_a_hot_customer(spark, events):
    newest = {}
    for row in events.collect():
        for month in range(1, 13):
            if row.snapshot_date.month <= month:
                key, value = (row.Customer_ID, month), (row.snapshot_date, row.label, row.default_probability)
                newest[key] = max(newest.get(key, value), value)
    found = {
        (row.Customer_ID, row.snapshot_date.month): (row.label, row.default_probability)
        for row in latest_known(events, "Customer_ID", "2023-01-01", "2023-12-01").collect()
    }
    assert found == {key: value[1:] for key, value in newest.items()}
