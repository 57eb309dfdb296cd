"""Two-stage training: all features, attributions, then a search that also picks the feature set."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from duewatch.functions.numeric import month_start
from duewatch.operators.attribution import attribution_totals, feature_groups
from duewatch.operators.boosting import BoostedTrees
from duewatch.operators.labelled import OTHER_SPLIT, dropped_counts, split_name
from duewatch.operators.learning import DEFAULT_TREES, SEARCH_SPACE, complete_rows, feature_columns, random_search, scored
from duewatch.operators.monitor import OOT, SPLIT_CALENDAR, TEST, TRAIN
from duewatch.operators.ranking import roc_auc
from duewatch.plans.tables import LAG_MONTHS
from duewatch.session import staged
from duewatch.sources.records import append_records


@dataclass(frozen=True)
class TrainingRun:
    model: BoostedTrees
    selected_features: list[str]
    reference: DataFrame  # all split rows with score and split name
    record: dict
    trials: DataFrame  # parameters and mean metrics of every trial of both searches


def with_split(training: DataFrame, splits=SPLIT_CALENDAR, lag_months: int = LAG_MONTHS) -> DataFrame:
    """Rows of the splits with the name of theirs, by the month of the label."""
    label_month = F.add_months(month_start(F.col("feature_snapshot_date").cast("date")), lag_months)
    named = training.withColumn("split", split_name(label_month, splits))
    return named.where(F.col("split") != OTHER_SPLIT)


def split_aucs(reference: DataFrame) -> dict[str, float | None]:
    """AUC per split from one pass over the scored rows."""
    return {row["split"]: row["auc"] for row in roc_auc(reference, ["split"]).collect()}


DEFAULT_TRIALS, DEFAULT_FOLDS = 50, 5


def two_stage_training(
    training: DataFrame,
    splits=SPLIT_CALENDAR,
    lag_months: int = LAG_MONTHS,
    initial_trials: int = DEFAULT_TRIALS,
    refine_trials: int = DEFAULT_TRIALS,
    folds: int = DEFAULT_FOLDS,
    trees: int = DEFAULT_TREES,
    seed: int = 42,
    together: int = 5,
) -> TrainingRun:
    """Numeric and text columns are features alike; rows with a gap in any of them are left out and counted in the record."""
    rows = staged(with_split(training, splits, lag_months), "training-set")
    numeric, categorical = feature_columns(rows.drop("split"))
    train = rows.where(F.col("split") == TRAIN).drop("split")
    gaps = dropped_counts(train, ["label", *numeric, *categorical], F.lit(TRAIN).alias("split")).first()

    first_model, first, first_trials = random_search(
        train, numeric, initial_trials, folds, seed, trees=trees, categorical=categorical, together=together
    )
    groups = feature_groups(attribution_totals(first_model, complete_rows(train, numeric, categorical)))
    model, best, second_trials = random_search(
        train, numeric, refine_trials, folds, seed + 1, groups, trees=trees, categorical=categorical, together=together
    )

    reference = staged(scored(model, rows).drop("prediction"), "reference-data")
    aucs = split_aucs(reference)
    record = {
        "stage1_best_auc": first["cv_auc"],
        "stage2_best_auc": best["cv_auc"],
        "test_auc": aucs.get(TEST),
        "oot_auc": aucs.get(OOT),
        "best_params": {name: float(best[name]) for name in SEARCH_SPACE},
        "selected_feature_group": best["feature_group"],
        "selected_features": best["features"],
        "feature_groups": groups,
        "rows_dropped": gaps["dropped"] if gaps else 0,
    }
    trials = first_trials.withColumn("stage", F.lit(1)).unionByName(
        second_trials.withColumn("stage", F.lit(2)), allowMissingColumns=True
    )
    return TrainingRun(model, best["features"], reference, record, trials)


RECORD_SCHEMA = (
    "run_id string, created_at timestamp, stage1_best_auc double, stage2_best_auc double, test_auc double, "
    "oot_auc double, best_params map<string,double>, selected_feature_group string, "
    "selected_features array<string>, feature_groups map<string,array<string>>, rows_dropped long, "
    "stage2_model_path string, reference_data_path string"
)


def save_run(spark: SparkSession, run: TrainingRun, root: str, run_id: str, created_at) -> None:
    """Model, reference data, trials and one registry record."""
    model_path, reference_path = f"{root}/models/{run_id}", f"{root}/reference/{run_id}"
    run.trials.write.mode("overwrite").parquet(f"{root}/trials/{run_id}")
    run.model.save(spark, model_path)
    run.reference.drop("split").write.mode("overwrite").parquet(reference_path)
    record = {
        **run.record, "run_id": run_id, "created_at": created_at,
        "stage2_model_path": model_path, "reference_data_path": reference_path,
    }
    append_records(spark.createDataFrame([record], RECORD_SCHEMA), f"{root}/runs")
