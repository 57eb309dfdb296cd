"""Raw CSV files to the monitoring report, through all written tables."""

import datetime

import pytest
from pyspark.sql import functions as F

from duewatch.catalog.inputs import Inputs
from duewatch.catalog.label_queries import SPLITS
from duewatch.operators.features import FULL_FEATURES
from duewatch.operators.labelled import training_set
from duewatch.plans.monitoring import monitor_and_write
from duewatch.plans.scoring import evaluate_and_write, load_run, score_and_write
from duewatch.plans.tables import RawTables, backfill, gold_features
from duewatch.plans.training import save_run, two_stage_training
from duewatch.sources.snapshots import read_snapshot, read_snapshots

FOLDER = "/root/testdata/sf0.01"
FIRST, LAST = "1995-01-01", "2001-08-01"
FILES = {
    "raw_loans": "lms_loan_daily.csv", "raw_attributes": "features_attributes.csv",
    "raw_clicks": "feature_clickstream.csv", "raw_financials": "features_financials.csv",
}


@pytest.fixture(scope="module")
def root(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("run"))
    inputs = Inputs(spark, FOLDER)
    for view, name in FILES.items():
        inputs.raw(view).write.option("header", True).csv(f"{folder}/data/{name}")
    backfill(RawTables.from_csv(spark, f"{folder}/data"), folder, FIRST, LAST)
    return folder


def test_written_gold_table_equals_the_direct_one(spark, root):
    columns = ["Customer_ID", "snapshot_date", *FULL_FEATURES]
    written = read_snapshots(spark, f"{root}/gold/feature_store_full").select(columns)
    direct = gold_features(RawTables.from_csv(spark, f"{root}/data"), FIRST, LAST).select(columns)
    rounded = [F.round(name, 6).alias(name) if kind == "double" else F.col(f"`{name}`") for name, kind in direct.dtypes]
    left, right = written.select(*rounded), direct.select(*rounded)
    assert left.count() == right.count() > 5000
    assert left.exceptAll(right).isEmpty() and right.exceptAll(left).isEmpty()


def test_a_missing_month_raises(spark, root):
    assert read_snapshot(spark, f"{root}/gold/label_store", "1998-03-01").count() > 0
    with pytest.raises(FileNotFoundError):
        read_snapshot(spark, f"{root}/gold/label_store", "2030-01-01")


def test_month_filters_reach_the_partitions(spark, root):
    plan = read_snapshots(spark, f"{root}/gold/label_store", FIRST, "1996-01-01")._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(snapshot_date" in plan


def test_train_score_evaluate_monitor(spark, root):
    labels = read_snapshots(spark, f"{root}/gold/label_store")
    store = read_snapshots(spark, f"{root}/gold/feature_store_full")
    run = two_stage_training(
        training_set(labels, store), SPLITS, initial_trials=1, refine_trials=1, folds=2, trees=3
    )
    assert set(run.record["selected_features"]) <= set(FULL_FEATURES)
    save_run(spark, run, root, "run_a", datetime.datetime(2024, 1, 1))

    _, features, record = load_run(spark, root)
    assert record["run_id"] == "run_a" and features == run.selected_features
    with pytest.raises(LookupError):
        load_run(spark, root, "run_b")

    score_and_write(spark, root, "2001-01-01", LAST)
    scored = read_snapshots(spark, f"{root}/scored")
    expected = store.where("snapshot_date >= date '2001-01-01'")
    assert scored.count() == expected.count()

    evaluate_and_write(spark, root, "2001-01-01", LAST)
    evaluations = spark.read.json(f"{root}/evaluations")
    matched = read_snapshots(spark, f"{root}/scored_with_labels")
    assert evaluations.agg(F.sum("records")).first()[0] == matched.count() > 0

    raised = monitor_and_write(spark, root, "2001-01-01", LAST)
    report = f"{root}/reports/run_a"
    drift = spark.read.parquet(f"{report}/drift")
    assert drift.count() == len(features)
    assert spark.read.parquet(f"{report}/status").count() == 1
    level = spark.read.parquet(f"{report}/alert_level").collect()
    assert len(level) == 1 and level[0].alert_raised == raised
    assert raised == (level[0].highest_level != "OK" or drift.where("drift_detected").count() > 0)


def test_command_line(spark, root):
    from duewatch.__main__ import earlier_month, main

    assert earlier_month("2023-03-01", 6) == "2022-09-01"
    folder = f"{root}/from_command_line"
    assert main(["--root", folder, "backfill", "--raw", f"{root}/data", "--first", "1998-03-01", "--last", "1998-03-01"]) == 0
    months = read_snapshots(spark, f"{folder}/gold/feature_store_linear").select("snapshot_date").distinct()
    assert months.count() == 7
    same = read_snapshots(spark, f"{root}/gold/label_store", "1998-03-01", "1998-03-01")
    assert read_snapshots(spark, f"{folder}/gold/label_store", "1998-03-01", "1998-03-01").exceptAll(same).isEmpty()
