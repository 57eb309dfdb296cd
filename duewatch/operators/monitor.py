"""Model performance over time, status and alerts.

``auc_scores`` is a table with the columns ``group`` and ``auc``: one row per
split and one per inference month, so all steps after it work on a few rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from duewatch.functions.numeric import month_start
from duewatch.operators.labelled import OTHER_SPLIT, split_name
from duewatch.operators.ranking import roc_auc

# Split names, calendar, tolerated AUC shares and alert texts.
TRAIN, TEST, OOT, CURRENT = "Train/Validation", "Test", "Out-of-Time (OOT)", "Current AUC"
INFERENCE_SUFFIX = " (Inference)"
SPLIT_CALENDAR = [
    (TRAIN, "2023-07-01", "2024-03-01"),
    (TEST, "2024-04-01", "2024-06-01"),
    (OOT, "2024-07-01", "2024-09-01"),
]
TOLERATED = {OOT: 0.95, TEST: 0.93, TRAIN: 0.90}
ALERT_TIERS = [
    (0.85, "Critical", "15%", "Model retraining may be required."),
    (0.90, "Alert", "10%", "Diagnostic investigation is recommended."),
    (0.95, "Warning", "5%", "Closer observation is advised."),
]
LEVELS = ["OK", "Warning", "Alert", "Critical"]


def auc_scores(
    reference: DataFrame,
    current: DataFrame,
    splits: list[tuple[str, str, str]] = SPLIT_CALENDAR,
    lag_months: int = 6,
    date_col: str = "feature_snapshot_date",
    label: str = "label",
    score: str = "default_probability",
) -> DataFrame:
    """AUC per split of the reference data and per month of the current data, in one pass."""
    label_month = F.add_months(month_start(F.col(date_col)), lag_months)
    old = reference.select(split_name(label_month, splits).alias("group"), label, score)
    month = F.date_format(F.col(date_col), "yyyy-MM")
    new = current.select(F.concat(month, F.lit(INFERENCE_SUFFIX)).alias("group"), label, score)
    both = old.where(F.col("group") != OTHER_SPLIT).unionByName(new)
    return roc_auc(both, ["group"], label, score).where(F.col("auc").isNotNull()).select("group", "auc", "records")


def auc_trend(
    reference: DataFrame,
    current: DataFrame,
    splits: list[tuple[str, str, str]] = SPLIT_CALENDAR,
    lag_months: int = 6,
    date_col: str = "feature_snapshot_date",
    label: str = "label",
    score: str = "default_probability",
) -> DataFrame:
    """AUC per month with the name of its split; months outside all splits are left out."""
    label_month = F.add_months(month_start(F.col(date_col)), lag_months)
    old = reference.select(
        label_month.alias("month"), split_name(label_month, splits).alias("group"), label, score
    ).where(F.col("group") != OTHER_SPLIT)
    new = current.select(month_start(F.col(date_col)).alias("month"), F.lit(CURRENT).alias("group"), label, score)
    return roc_auc(old.unionByName(new), ["month", "group"], label, score).select("month", "group", "auc")


def auc_trend_next_month(
    reference: DataFrame,
    current: DataFrame,
    date_col: str = "feature_snapshot_date",
    label: str = "label",
    score: str = "default_probability",
) -> DataFrame:
    """Monthly AUC of the reference, then one point for all current rows in the month after it."""
    old = roc_auc(reference.select(month_start(F.col(date_col)).alias("month"), label, score), ["month"], label, score)
    point = roc_auc(current.select(F.lit(CURRENT).alias("side"), label, score), ["side"], label, score)
    newest = old.groupBy(F.lit(CURRENT).alias("side")).agg(F.add_months(F.max("month"), 1).alias("month"))
    new = point.join(newest, "side").select("month", "auc")
    trend = old.select("month", "auc").unionByName(new)
    return trend.select(F.date_format("month", "yyyy-MM").alias("month"), "auc")


def positive_rate_by_month(
    reference: DataFrame, current: DataFrame, date_col: str = "feature_snapshot_date", label: str = "label"
) -> DataFrame:
    """Percent of positive labels: a column per side, full outer over the months."""
    percent = F.avg((F.col(label) == 1).cast("double")) * 100
    old = reference.groupBy(month_start(F.col(date_col)).alias("month")).agg(percent.alias("reference"))
    newest = old.groupBy(F.lit(CURRENT).alias("side")).agg(F.add_months(F.max("month"), 1).alias("month"))
    point = current.groupBy(F.lit(CURRENT).alias("side")).agg(percent.alias("current"))
    new = newest.join(point, "side").drop("side")
    outer = old.join(new, "month", "full_outer")
    return outer.select(F.date_format("month", "yyyy-MM").alias("month"), "reference", "current")


def against_baseline(scores: DataFrame) -> DataFrame:
    """Inference months, each with the AUC of the three splits."""
    everything = Window.partitionBy()  # a few rows: one per split and month
    baselines = {
        name: F.max(F.when(F.col("group") == split, F.col("auc"))).over(everything)
        for name, split in (("_train", TRAIN), ("_test", TEST), ("_oot", OOT))
    }
    return scores.withColumns(baselines).where(F.col("group").endswith(INFERENCE_SUFFIX))


def performance_status(scores: DataFrame, drift: DataFrame) -> DataFrame:
    """One row: share of drifted features as text, and Good or Bad for the AUC."""
    months = against_baseline(scores)
    weak = (
        (F.col("auc") < F.col("_oot") * TOLERATED[OOT]),
        (F.col("auc") < F.col("_test") * TOLERATED[TEST]),
        (F.col("auc") < F.col("_train") * TOLERATED[TRAIN]),
    )
    any_weak = F.lit(False)
    for condition in weak:
        any_weak = any_weak | F.coalesce(condition, F.lit(False))
    performance = months.agg(F.when(F.bool_or(any_weak), F.lit("Bad")).otherwise(F.lit("Good"))).scalar()
    drifted = F.count_if(F.col("drift_detected")).cast("string")
    text = F.concat(drifted, F.lit(" / "), F.count(F.lit(1)).cast("string"), F.lit(" features drifted"))
    return drift.agg(text.alias("feature_drift")).withColumn("model_auc_performance", performance)


def auc_alerts(scores: DataFrame) -> DataFrame:
    """Inference months whose AUC fell too far below the out-of-time AUC; none without that AUC."""
    months = against_baseline(scores).where(F.col("_oot").isNotNull())
    level, message = F.lit(None).cast("string"), F.lit(None).cast("string")
    for share, name, drop, advice in reversed(ALERT_TIERS):
        hit = F.col("auc") < F.col("_oot") * share
        text = F.format_string(f"%s AUC (%.4f) is >{drop}% below OOT AUC (%.4f). {advice}", "group", "auc", "_oot")
        level = F.when(hit, F.lit(name)).otherwise(level)
        message = F.when(hit, text).otherwise(message)
    alerts = months.select(F.col("group").alias("month"), "auc", level.alias("level"), message.alias("message"))
    return alerts.where(F.col("level").isNotNull())


def highest_level(alerts: DataFrame, drift: DataFrame) -> DataFrame:
    """One row: the most severe level, OK without alerts, and whether anything has to be sent."""
    rank = F.array_position(F.array(*[F.lit(name) for name in LEVELS]), F.col("level"))
    worst = F.coalesce(F.max(rank), F.lit(1)).cast("int")
    level = alerts.agg(F.element_at(F.array(*[F.lit(name) for name in LEVELS]), worst)).scalar()
    drifted = drift.agg(F.coalesce(F.bool_or("drift_detected"), F.lit(False)).alias("feature_drift_detected"))
    needed = (F.col("highest_level") != "OK") | F.col("feature_drift_detected")
    return drifted.select(level.alias("highest_level"), "feature_drift_detected").withColumn("alert_raised", needed)


def alert_table(alerts: DataFrame, drift: DataFrame) -> DataFrame:
    """The messages of a report: one row per drifted feature and per AUC alert."""
    drifted = drift.where("drift_detected").select(
        F.lit("feature drift").alias("kind"),
        F.col("feature").alias("subject"),
        F.format_string("%s (p-value: %.4f)", "feature", "p_value").alias("message"),
    )
    degraded = alerts.select(
        F.lit("AUC degradation").alias("kind"),
        F.col("month").alias("subject"),
        F.concat_ws(": ", "level", "message").alias("message"),
    )
    return drifted.unionByName(degraded)


def evaluation_records(matched: DataFrame, unmatched: DataFrame, dpd: int, mob: int) -> DataFrame:
    """One row per month with labels: scored rows, AUC, label parameters and labels without a score.

    A month none of whose labels has a score has no rows and no AUC.
    """
    scores = roc_auc(matched, ["snapshot_date"])
    return scores.join(unmatched, "snapshot_date", "full_outer").select(
        "snapshot_date",
        F.coalesce("records", F.lit(0).cast("long")).alias("records"),
        "auc",
        F.lit(dpd).alias("dpd"),
        F.lit(mob).alias("mob"),
        F.coalesce(F.col("unmatched"), F.lit(0)).alias("unmatched"),
    )
