"""Folds, fitting, cross-validation, search and scoring of boosted trees."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window

from duewatch.functions.parsing import decimal_number
from duewatch.operators.boosting import (
    BINS, BoostedTrees, Fit, binned_rows, grow_models, held_out_scores, learn_bins, probabilities,
)
from duewatch.operators.ranking import SLICE, in_slices, roc_auc, slices_before
from duewatch.operators.search import Sampler
from duewatch.session import staged

# Columns that are never features, and the search space
# (name: kind, low, high).
NOT_FEATURES = ["label", "loan_id", "Customer_ID", "snapshot_date", "feature_snapshot_date"]
SEARCH_SPACE = {
    "learning_rate": ("log", 0.01, 0.3),
    "max_depth": ("whole", 3, 10),
    "gamma": ("even", 0.0, 5.0),
    "subsample": ("even", 0.5, 1.0),
    "colsample_bytree": ("even", 0.5, 1.0),
    "reg_alpha": ("log", 1e-8, 10.0),
    "reg_lambda": ("log", 1e-6, 20.0),
}
DEFAULT_TREES = 100
PROBABILITY_FLOOR = 2.220446049250313e-16


def feature_columns(df: DataFrame) -> tuple[list[str], list[str]]:
    """Numeric and other feature columns: everything that is not an id, a date marker or the label."""
    candidates = [field for field in df.schema.fields if field.name not in NOT_FEATURES]
    numeric = [field.name for field in candidates if isinstance(field.dataType, T.NumericType)]
    others = [field.name for field in candidates if field.name not in numeric]
    if not candidates:
        raise ValueError("no feature columns")
    return numeric, others


def encoded(df: DataFrame, numeric: list[str], categorical: list[str]) -> DataFrame:
    """Numbers as doubles (unreadable ones null) and categories as codes in alphabetical order, nulls as null.

    The distinct categories are numbered in range-partitioned slices and joined back, so there may be any number of them.
    """
    numbers = {name: decimal_number(F.col(f"`{name}`")) for name in numeric}
    typed = df.withColumns(numbers) if numbers else df
    if not categorical:
        return typed
    listed = [
        F.struct(F.lit(place).alias("_column"), F.col(f"`{name}`").cast("string").alias("_value"))
        for place, name in enumerate(categorical)
    ]
    values = typed.select(F.inline(F.array(*listed))).where("_value is not null").distinct()
    sliced = staged(in_slices(values, ["_column"], "_value"), "categories")
    sizes = sliced.groupBy("_column", SLICE).agg(F.count(F.lit(1)).alias("_size"))
    before = F.coalesce(F.sum("_size").over(slices_before(["_column"])), F.lit(0))
    inside = F.row_number().over(Window.partitionBy("_column", SLICE).orderBy("_value"))
    numbered = sliced.join(sizes.withColumn("_before", before), ["_column", SLICE]).select(
        "_column", "_value", (F.col("_before") + inside - 1).cast("int").alias("_code")
    )
    codes = staged(numbered, "category-codes")
    for place, name in enumerate(categorical):
        own = codes.where(F.col("_column") == place).select(
            F.col("_value").alias(f"_value_{place}"), F.col("_code").alias(f"_code_{place}")
        )
        typed = typed.join(own, F.col(f"`{name}`").cast("string") == F.col(f"_value_{place}"), "left")
    coded = {name: F.col(f"_code_{place}") for place, name in enumerate(categorical)}
    return typed.withColumns(coded).select(*[F.col(f"`{name}`") for name in df.columns])


COPIES = 10_000  # copies of a row are written out in lots of so many
LEAST_ROWS, TASK_ROWS = 1 << 12, 1 << 18  # binned rows a task is worth, and as many as it gets at most


def stratified_folds(df: DataFrame, folds: int, label: str = "label", seed: int = 42, bucket_rows: int = 4096) -> DataFrame:
    """Adds ``fold``: a shuffled numbering of the rows of each label, modulo ``folds``. See ``shuffled_numbers``."""
    numbered = shuffled_numbers(df, label, seed, bucket_rows)
    return numbered.withColumn("fold", (F.col("number") % folds).cast("int")).select(*df.columns, "fold")


def shuffled_numbers(df: DataFrame, label: str = "label", seed: int = 42, bucket_rows: int = 4096) -> DataFrame:
    """Adds ``number``: 0, 1, 2, ... over the rows of each label, in an order drawn from a hash of their content.

    Equal rows are counted and written out again with consecutive numbers, so that the numbering depends on nothing but the
    rows themselves, whatever files or partitions they came in. The leading bits of the hash cut each label into even
    buckets which are numbered separately; the bucket sizes give the offset of each. There are as many buckets as keep
    them near ``bucket_rows`` different rows, which does not change the numbering.
    """
    columns = [F.col(f"`{name}`") for name in df.columns]
    counted = staged(df.groupBy(*columns).agg(F.count(F.lit(1)).alias("_copies")), "fold-rows")
    bucket_bits = max(1, math.ceil(math.log2(max(1.0, counted.count() / bucket_rows))))
    drawn = counted.withColumn("_draw", F.xxhash64(*columns, F.lit(seed))).withColumn("_tie", F.xxhash64(F.lit(seed), *columns))
    drawn = drawn.withColumn("_bucket", F.shiftrightunsigned("_draw", 64 - bucket_bits))
    sizes = drawn.groupBy(label, "_bucket").agg(F.sum("_copies").alias("_size"))
    earlier = Window.partitionBy(label).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(label, "_bucket", F.coalesce(F.sum("_size").over(earlier), F.lit(0)).alias("_offset"))
    # At most 2**bucket_bits rows per label. A null label is a label of its own.
    offsets = staged(offsets, "fold-offsets").select(F.col(label).alias("_label"), F.col("_bucket").alias("_of"), "_offset")
    placed = drawn.join(offsets, F.col(label).eqNullSafe(F.col("_label")) & (F.col("_bucket") == F.col("_of")))
    before = Window.partitionBy(label, "_bucket").orderBy("_draw", "_tie").rowsBetween(Window.unboundedPreceding, -1)
    first = F.col("_offset") + F.coalesce(F.sum("_copies").over(before), F.lit(0))
    lots = placed.withColumn("_first", first).withColumn(
        "_lot", F.explode(F.sequence(F.lit(0).cast("long"), F.expr(f"(_copies - 1) div {COPIES}")))
    )
    # Lots spread over the tasks before they become rows.
    lots = lots.hint("rebalance")
    own = F.sequence(F.col("_lot") * COPIES, F.least((F.col("_lot") + 1) * COPIES, F.col("_copies")) - 1)
    rows = lots.withColumn("_copy", F.explode(own))
    return rows.withColumn("number", F.col("_first") + F.col("_copy")).select(*df.columns, "number")


def complete_rows(train: DataFrame, numeric: Sequence[str], categorical: Sequence[str] = ()) -> DataFrame:
    """Label and features of the rows that have all of them, NaN counting as a gap.

    One condition per column: a condition over all of them at once makes the optimizer list a variant of it for every set of
    columns that a later step renames.
    """
    kinds = dict(train.dtypes)
    rows = train.select(*[F.col(f"`{name}`") for name in ["label", *numeric, *categorical]])
    for name in rows.columns:
        column = F.col(f"`{name}`")
        known = column.isNotNull() & ~F.isnan(column) if kinds[name] in ("double", "float") else column.isNotNull()
        rows = rows.where(known)
    return rows


def numbered_bins(rows: DataFrame, numeric: Sequence[str], categorical: Sequence[str], folds: int, seed: int, bins: int):
    """The rows as bin numbers, with fold and a number of their own, written once; and the binning.

    Every level of every tree reads these rows, which are small beside the work on them, so they are dealt by their number
    to as many tasks as there are cores, and to more where a task would get more than ``TASK_ROWS``.
    """
    numbered = staged(shuffled_numbers(rows, seed=seed), "numbered-rows")
    binning = learn_bins(numbered, numeric, categorical, bins)
    count, cores = numbered.count(), rows.sparkSession.sparkContext.defaultParallelism
    parts = max(1, math.ceil(count / TASK_ROWS), min(cores, math.ceil(count / LEAST_ROWS)))
    fold = (F.col("number") % folds).cast("int")
    # Unique over both labels.
    unique = F.col("number") * 2 + F.col("label").cast("int")
    binned = binned_rows(numbered.withColumn("fold", fold).withColumn("number", unique), binning)
    return staged(binned.repartition(parts, "number"), "bins"), binning


def fit_classifier(
    train: DataFrame, numeric: Sequence[str], parameters: dict, trees: int = DEFAULT_TREES, categorical: Sequence[str] = (),
    seed: int = 42, bins: int = BINS,
) -> BoostedTrees:
    """Train on all complete rows. Everything stays on the cluster but one row per node and feature, and the trees."""
    rows, binning = numbered_bins(complete_rows(train, numeric, categorical), numeric, categorical, 1, seed, bins)
    return grow_models(rows, binning, [Fit(parameters, seed=seed)], trees)[0]


def scored(model: BoostedTrees, df: DataFrame, threshold: float = 0.5) -> DataFrame:
    """``df`` with the default probability and the decision at ``threshold``."""
    result = df.withColumn("default_probability", probabilities(model))
    return result.withColumn("prediction", (F.col("default_probability") >= threshold).cast("int"))


def safe_share(top: Column, bottom: Column) -> Column:
    return F.coalesce(F.try_divide(top.cast("double"), bottom.cast("double")), F.lit(0.0))


def classification_metrics(
    predictions: DataFrame, keys: list[str], label: str = "label", score: str = "default_probability", threshold: float = 0.5
) -> DataFrame:
    """AUC, accuracy, precision, recall, F1 and log loss per group."""
    hit, truth = F.col(score) >= threshold, F.col(label) == 1
    clipped = F.greatest(F.lit(PROBABILITY_FLOOR), F.least(F.lit(1.0 - PROBABILITY_FLOOR), F.col(score)))
    loss = -F.when(truth, F.log(clipped)).otherwise(F.log(1.0 - clipped))
    counts = predictions.groupBy(*keys).agg(
        F.count_if(hit & truth).alias("_tp"),
        F.count_if(hit & ~truth).alias("_fp"),
        F.count_if(~hit & truth).alias("_fn"),
        F.count_if(~hit & ~truth).alias("_tn"),
        F.avg(loss).alias("log_loss"),
    )
    tp, fp, fn, tn = (F.col(name) for name in ("_tp", "_fp", "_fn", "_tn"))
    return counts.join(roc_auc(predictions, keys, label, score), keys).select(
        *keys,
        "records",
        "auc",
        safe_share(tp + tn, tp + fp + fn + tn).alias("accuracy"),
        safe_share(tp, tp + fp).alias("precision"),
        safe_share(tp, tp + fn).alias("recall"),
        safe_share(2 * tp, 2 * tp + fp + fn).alias("f1"),
        "log_loss",
    )


METRICS = ["auc", "accuracy", "precision", "recall", "f1", "log_loss"]


def random_search(
    train: DataFrame, numeric: Sequence[str], trials: int, folds: int = 5, seed: int = 42,
    feature_groups: dict[str, list[str]] | None = None, trees: int = DEFAULT_TREES, categorical: Sequence[str] = (),
    together: int = 5, bins: int = BINS,
) -> tuple[BoostedTrees, dict, DataFrame]:
    """Best model refitted on all rows, its parameters, and one row per trial: mean metrics, parameters, feature group.

    Points are drawn by densities of the earlier trials (``Sampler``), ``together`` of them at a time; all folds of these
    grow in the same jobs.
    """
    rows, binning = numbered_bins(complete_rows(train, numeric, categorical), numeric, categorical, folds, seed, bins)
    space = dict(SEARCH_SPACE) | ({"feature_group": ("choice", sorted(feature_groups))} if feature_groups else {})
    sampler = Sampler(space, seed)

    def columns(point: dict) -> list[int] | None:
        return [binning.features.index(f) for f in feature_groups[point["feature_group"]]] if feature_groups else None

    points: list[dict] = []
    records: list[tuple] = []
    while len(points) < trials:
        drawn = [sampler.draw() for _ in range(min(together, trials - len(points)))]
        fits = [Fit(point, columns(point), fold, seed) for point in drawn for fold in range(folds)]
        numbers = [len(points) + n for n in range(len(drawn)) for _ in range(folds)]
        models = grow_models(rows, binning, fits, trees)
        predictions = staged(held_out_scores(rows, models, fits, numbers), "out-of-fold")
        by_fold = classification_metrics(predictions, ["trial", "fold"])
        counts = F.sum("records").cast("long").alias("rows")
        means = {row["trial"]: row for row in by_fold.groupBy("trial").agg(
            counts, *[F.avg(name).alias(f"mean_{name}") for name in METRICS]
        ).collect()}  # one row per trial
        for number, point in enumerate(drawn, len(points)):
            mean = means[number]
            sampler.tell(point, mean["mean_auc"])
            numbers_only = {name: float(point[name]) for name in SEARCH_SPACE}
            records.append((number, *[mean[f"mean_{name}"] for name in METRICS], mean["rows"], numbers_only, point.get("feature_group")))
        points += drawn
    best_trial = max(range(trials), key=lambda n: (records[n][1] is not None, records[n][1] or 0.0, -n))
    best = {**points[best_trial], "cv_auc": records[best_trial][1], "trial": best_trial}
    model = grow_models(rows, binning, [Fit(best, columns(best), seed=seed)], trees)[0]
    schema = "trial int, " + ", ".join(f"mean_{name} double" for name in METRICS)
    schema += ", rows long, parameters map<string,double>, feature_group string"
    return model, {**best, "features": model.features}, train.sparkSession.createDataFrame(records, schema)
