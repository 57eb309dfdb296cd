"""Scoring of months, and evaluation once their labels are known."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from duewatch.operators.boosting import BoostedTrees
from duewatch.operators.labelled import scored_with_labels, unmatched_labels, with_label_membership
from duewatch.operators.learning import scored
from duewatch.operators.monitor import evaluation_records
from duewatch.plans.tables import DPD, MOB
from duewatch.sources.records import REQUIRED_RUN_KEYS, append_records, latest_record, read_records
from duewatch.sources.snapshots import calendar_months, read_snapshots, write_snapshots


def load_run(spark: SparkSession, root: str, run_id: str | None = None) -> tuple[BoostedTrees, list[str], dict]:
    """Model and features of the newest, or the named, run. One record comes to the driver."""
    record = latest_record(read_records(spark, f"{root}/runs", REQUIRED_RUN_KEYS), run_id).first().asDict(True)
    return BoostedTrees.load(spark, record["stage2_model_path"]), record["selected_features"], record


def score_months(
    store: DataFrame, model: BoostedTrees, features: list[str], labels: DataFrame, threshold: float = 0.5,
    feature_lag_months: int = 0,
) -> DataFrame:
    """Every customer-month with features, probability, decision and the newest month with a label.

    With a lag the features of an earlier month are dated to the scored month.
    """
    absent = [name for name in features if name not in store.columns]
    if absent:
        raise KeyError(f"selected features missing from the feature table: {absent}")
    month = F.add_months("snapshot_date", feature_lag_months).alias("snapshot_date")
    wanted = store.select("Customer_ID", month, *[F.col(f"`{name}`") for name in features])
    return with_label_membership(scored(model, wanted, threshold), labels)


def score_and_write(spark: SparkSession, root: str, first, last, run_id: str | None = None, threshold: float = 0.5) -> None:
    model, features, _ = load_run(spark, root, run_id)
    store = read_snapshots(spark, f"{root}/gold/feature_store_full", first, last)
    labels = read_snapshots(spark, f"{root}/gold/label_store")
    scores = score_months(store, model, features, labels, threshold)
    write_snapshots(scores, f"{root}/scored", months=calendar_months(first, last))


def evaluate_and_write(spark: SparkSession, root: str, first, last, dpd: int = DPD, mob: int = MOB) -> None:
    """Scored rows with labels by month, and one evaluation record per month."""
    rows = read_snapshots(spark, f"{root}/scored", first, last)
    labels = read_snapshots(spark, f"{root}/gold/label_store", first, last)
    labels = labels.where(F.col("label_def") == f"{dpd}dpd_{mob}mob")
    months = calendar_months(first, last)
    write_snapshots(scored_with_labels(rows, labels), f"{root}/scored_with_labels", months=months)
    matched = read_snapshots(spark, f"{root}/scored_with_labels", first, last)
    if matched.isEmpty():
        raise ValueError("no scored row has a label of the same month")
    records = evaluation_records(matched, unmatched_labels(rows, labels), dpd, mob)
    append_records(records.withColumn("evaluated_at", F.current_timestamp()), f"{root}/evaluations")
