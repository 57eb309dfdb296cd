"""The monitoring report of a run: drift, AUC by split and month, status and alerts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from duewatch.operators.drift import drift_report
from duewatch.operators.learning import feature_columns
from duewatch.operators.monitor import (
    SPLIT_CALENDAR,
    alert_table,
    auc_alerts,
    auc_scores,
    auc_trend,
    highest_level,
    performance_status,
)
from duewatch.plans.scoring import load_run
from duewatch.session import staged
from duewatch.sources.snapshots import read_snapshots


def both_sides(reference: DataFrame, current: DataFrame, features: list[str]) -> DataFrame:
    """Reference and current values of the features they share, with a marker column."""
    wanted = [F.col(f"`{name}`") for name in features]
    old = reference.select(F.lit(True).alias("is_reference"), *wanted)
    return old.unionByName(current.select(F.lit(False).alias("is_reference"), *wanted))


def monitoring_report(
    reference: DataFrame, current: DataFrame, features: list[str], splits=SPLIT_CALENDAR
) -> dict[str, DataFrame]:
    """All tables of the report. The two costly ones are written once and feed the others."""
    shared = [name for name in features if name in reference.columns and name in current.columns]
    kinds = feature_columns(reference.select(*[F.col(f"`{name}`") for name in shared]))
    drift = staged(drift_report(both_sides(reference, current, shared), "is_reference", *kinds), "drift")
    scores = staged(auc_scores(reference, current, splits), "auc-scores")
    alerts = auc_alerts(scores)
    return {
        "drift": drift,
        "auc_scores": scores,
        "auc_trend": auc_trend(reference, current, splits),
        "status": performance_status(scores, drift),
        "alert_level": highest_level(alerts, drift),
        "alerts": alert_table(alerts, drift),
    }


def monitor_and_write(spark: SparkSession, root: str, first, last, run_id: str | None = None) -> bool:
    """Report over the evaluated months, below ``reports/<run>``; true when an alert has to be sent."""
    _, features, record = load_run(spark, root, run_id)
    reference = spark.read.parquet(record["reference_data_path"])
    reference = reference.withColumn("feature_snapshot_date", F.col("feature_snapshot_date").cast("date"))
    current = read_snapshots(spark, f"{root}/scored_with_labels", first, last)
    current = current.withColumnRenamed("snapshot_date", "feature_snapshot_date")
    folder = f"{root}/reports/{record['run_id']}"
    for name, table in monitoring_report(reference, current, features).items():
        table.write.mode("overwrite").parquet(f"{folder}/{name}")
    return spark.read.parquet(f"{folder}/alert_level").first()["alert_raised"]
