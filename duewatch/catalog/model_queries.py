"""Training, scoring and attribution.

A fitted model has no SQL counterpart, so its queries return what SQL can state of its results: the base margin and the
gains of first splits, every key, label and stamp, that probabilities and decisions are in order, and that attributions
add up to margins.
"""

from __future__ import annotations

from functools import cache

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from duewatch.catalog.inputs import Inputs, rounded
from duewatch.catalog.label_queries import SPLITS, TRAINING_SQL, split_sql
from duewatch.catalog.registry import query
from duewatch.operators import attribution, boosting, learning
from duewatch.operators.features import FULL_FEATURES
from duewatch.operators.labelled import split_name, training_set
from duewatch.operators.learning import DEFAULT_TREES
from duewatch.operators.monitor import OOT, TEST
from duewatch.operators.ranking import roc_auc
from duewatch.plans.scoring import score_months
from duewatch.plans.training import DEFAULT_FOLDS, two_stage_training
from duewatch.session import fresh_path, staged

# A tree is a job per level, so the queries that fit anew grow fewer trees than the model that all others share; the README
# has the time of a full search.
TREES, FIT_TREES, SEARCH_TREES, TRIALS = DEFAULT_TREES, 10, 3, 2
PARAMETERS = {"max_depth": 3, "learning_rate": 0.1}
TEXT_FEATURES = ["Occupation", "Credit_Mix"]
# Features whose values all have a bin of their own, so that SQL can state the gain of their best first split.
FEW_VALUES = ["Num_Bank_Accounts", "Num_Credit_Card", "Num_of_Loan", "Interest_Rate", "Credit_History_Months", "Spend_Level", "Age_Bucket"]


def feature_table(inputs: Inputs) -> DataFrame:
    """The model table with its text columns."""
    return inputs.store().select("Customer_ID", "snapshot_date", *[F.col(f"`{name}`") for name in [*FULL_FEATURES, *TEXT_FEATURES]])


def training_rows(inputs: Inputs) -> DataFrame:
    return training_set(inputs.labels(), staged(feature_table(inputs), "feature-store"))


@cache
def _trained(spark: SparkSession, folder: str, application: str) -> tuple[str, boosting.BoostedTrees]:
    rows = training_rows(Inputs(spark, folder))
    path = fresh_path(spark, "training-rows")
    rows.write.parquet(path)
    return path, learning.fit_classifier(spark.read.parquet(path), FULL_FEATURES, PARAMETERS, TREES, TEXT_FEATURES)


def fitted(inputs: Inputs) -> tuple[DataFrame, boosting.BoostedTrees]:
    """The training rows and a model fitted on all of them, once for all queries over a folder, as one run serves scoring,
    evaluation and attribution."""
    spark = inputs.spark
    path, model = _trained(spark, inputs.folder, spark.sparkContext.applicationId)
    return spark.read.parquet(path), model


def in_order() -> Column:
    """Whether a scored row has a probability and the decision that belongs to it."""
    score = F.col("default_probability")
    return F.coalesce(score.between(0, 1) & (F.col("prediction") == (score >= 0.5).cast("int")), F.lit(False)).alias("in_order")


def first_gains_sql() -> str:
    values = " UNION ALL ".join(
        [f"""SELECT '{name}' AS feature, CAST("{name}" AS DOUBLE) AS number, NULL AS word, label FROM training_rows""" for name in FEW_VALUES]
        + [f"""SELECT '{name}', NULL, CAST("{name}" AS VARCHAR), label FROM training_rows""" for name in TEXT_FEATURES]
    )
    return f"""
SELECT feature, round(base, 6) AS base, round(max(GL * GL / (HL + 1) + (G - GL) * (G - GL) / (H - HL + 1) - G * G / (H + 1)), 6) AS gain
FROM (SELECT feature, base, sum(g) OVER (PARTITION BY feature) AS G, sum(h) OVER (PARTITION BY feature) AS H,
             sum(g) OVER (PARTITION BY feature ORDER BY place, number, word ROWS UNBOUNDED PRECEDING) AS GL,
             sum(h) OVER (PARTITION BY feature ORDER BY place, number, word ROWS UNBOUNDED PRECEDING) AS HL
      FROM (SELECT feature, number, word, base, sum(g) AS g, sum(h) AS h, CASE WHEN word IS NULL THEN 0 ELSE sum(g) / (sum(h) + 1) END AS place
            FROM (SELECT feature, number, word, base, round((p - label) * 16777216) / 16777216 AS g,
                         round(p * (1 - p) * 16777216) / 16777216 AS h
                  FROM ({values}) v CROSS JOIN (SELECT ln(p / (1 - p)) AS base, p FROM (SELECT avg(CAST(label AS DOUBLE)) AS p FROM training_rows) a) b) r
            GROUP BY feature, number, word, base) c) s
WHERE HL >= 1 AND H - HL >= 1 GROUP BY feature, base"""


@query(first_gains_sql(), training_rows=TRAINING_SQL.replace("gold_features", "gold_model"))
def ml_fit_classifier(inputs: Inputs) -> DataFrame:
    """The base margin of a model fitted on the whole training set, and the gain of the best first split by each feature."""
    rows = staged(training_rows(inputs), "training-rows")
    model = learning.fit_classifier(rows, FULL_FEATURES, PARAMETERS, FIT_TREES, TEXT_FEATURES)
    gains = boosting.first_gains(model, rows, PARAMETERS)
    base = F.round(F.lit(model.base), 6).alias("base")
    return gains.where(F.col("feature").isin(*FEW_VALUES, *TEXT_FEATURES) & F.col("gain").isNotNull()).select(
        "feature", base, F.round("gain", 6).alias("gain")
    )


@query("""SELECT label, CAST(fold AS INT) AS fold, n // 5 + CASE WHEN fold < n % 5 THEN 1 ELSE 0 END AS rows
FROM (SELECT label, count(*) AS n FROM scored_orders GROUP BY label) c CROSS JOIN range(5) t(fold)""")
def ml_stratified_folds(inputs: Inputs) -> DataFrame:
    """Fold sizes per label; they differ by at most one row."""
    folded = learning.stratified_folds(inputs.raw("scored_orders"), 5)
    return folded.groupBy("label", "fold").agg(F.count(F.lit(1)).alias("rows"))


@query("""SELECT t.fold, t.records, round(a.auc, 6) AS auc, round((tp + tn) / CAST(records AS DOUBLE), 6) AS accuracy,
       round(coalesce(tp / CAST(NULLIF(tp + fp, 0) AS DOUBLE), 0), 6) AS precision,
       round(coalesce(tp / CAST(NULLIF(tp + fn, 0) AS DOUBLE), 0), 6) AS recall,
       round(coalesce(2 * tp / CAST(NULLIF(2 * tp + fp + fn, 0) AS DOUBLE), 0), 6) AS f1, round(log_loss, 6) AS log_loss
FROM (SELECT fold, count(*) AS records,
             count(CASE WHEN default_probability >= 0.25 AND label = 1 THEN 1 END) AS tp,
             count(CASE WHEN default_probability >= 0.25 AND label = 0 THEN 1 END) AS fp,
             count(CASE WHEN default_probability < 0.25 AND label = 1 THEN 1 END) AS fn,
             count(CASE WHEN default_probability < 0.25 AND label = 0 THEN 1 END) AS tn,
             -avg(CASE WHEN label = 1 THEN ln(default_probability) ELSE ln(1 - default_probability) END) AS log_loss
      FROM folded GROUP BY fold) t JOIN aucs a ON a.fold = t.fold""",
       folded="SELECT CAST(month(snapshot_date) % 5 AS INT) AS fold, label, default_probability FROM scored_orders",
       aucs="""SELECT fold, (sum(pos * (below + (n + 1) / CAST(2 AS DOUBLE))) - sum(pos) * (sum(pos) + 1) / CAST(2 AS DOUBLE))
         / (sum(pos) * (sum(n) - sum(pos))) AS auc
FROM (SELECT *, sum(n) OVER (PARTITION BY fold ORDER BY default_probability) - n AS below
      FROM (SELECT fold, default_probability, CAST(sum(label) AS DOUBLE) AS pos, CAST(count(*) AS DOUBLE) AS n
            FROM folded GROUP BY fold, default_probability) c) r GROUP BY fold""")
def ml_cv_metrics(inputs: Inputs) -> DataFrame:
    """All metrics of every fold from one grouped pass over a table of scores."""
    fold = (F.month("snapshot_date") % 5).cast("int")
    scores = inputs.raw("scored_orders").withColumn("fold", fold)
    return rounded(learning.classification_metrics(scores, ["fold"], threshold=0.25))


COUNT_SQL = "SELECT count(*) AS n FROM training_rows"


@query(f"SELECT CAST(t.trial AS INT) AS trial, n AS rows, true AS in_order FROM range({TRIALS}) t(trial) CROSS JOIN counted",
       training_rows=TRAINING_SQL, counted=COUNT_SQL)
def ml_random_search(inputs: Inputs) -> DataFrame:
    """Per trial the rows scored by a model that has not seen them; metrics and parameters are within their bounds."""
    rows = staged(training_rows(inputs), "training-rows")
    _, best, trials = learning.random_search(rows, FULL_FEATURES, TRIALS, DEFAULT_FOLDS, trees=SEARCH_TREES, categorical=TEXT_FEATURES)
    fine = F.col("mean_auc").between(0, 1) & (F.col("mean_log_loss") > 0) & (F.col("mean_auc") <= F.lit(best["cv_auc"]))
    for name, (_, low, high) in learning.SEARCH_SPACE.items():
        fine &= F.col("parameters")[name].between(low, high)
    return trials.select("trial", "rows", F.coalesce(fine, F.lit(False)).alias("in_order"))


LABEL_MONTH = "CAST(CAST(feature_snapshot_date AS DATE) + INTERVAL 6 MONTH AS DATE)"


@query(f"""SELECT split, count(*) AS records, min(label) < max(label) AS has_auc
FROM (SELECT {split_sql(LABEL_MONTH)} AS split, label FROM training_rows) r GROUP BY split""", training_rows=TRAINING_SQL)
def ml_evaluate_split(inputs: Inputs) -> DataFrame:
    """Rows of one model's AUC on the training, test and out-of-time rows; there is one wherever both labels occur."""
    rows, model = fitted(inputs)
    label_month = F.add_months(F.col("feature_snapshot_date").cast("date"), 6)
    scored = learning.scored(model, rows).withColumn("split", split_name(label_month, SPLITS))
    return roc_auc(scored, ["split"]).select("split", "records", F.coalesce(F.col("auc").between(0, 1), F.lit(False)).alias("has_auc"))


@query(f"""SELECT unnest([{', '.join(repr(name) for name in [*FULL_FEATURES, *TEXT_FEATURES])}]) AS feature, n AS rows, n AS adds_up, true AS known
FROM counted""", training_rows=TRAINING_SQL, counted=COUNT_SQL)
def ml_attribution_totals(inputs: Inputs) -> DataFrame:
    """Per feature the rows explained, and those whose base value and attributions add up to the margin of the model."""
    rows, model = fitted(inputs)
    totals = attribution.attribution_totals(model, rows)
    return totals.select("feature", "rows", "adds_up", F.coalesce(F.col("total") >= 0, F.lit(False)).alias("known"))


@query("""SELECT f.Customer_ID, f.snapshot_date, l.label_snapshot_month, true AS in_order FROM gold_features f
LEFT JOIN (SELECT Customer_ID, strftime(max(snapshot_date), '%Y-%m-%d') AS label_snapshot_month FROM gold_labels GROUP BY Customer_ID) l
  ON l.Customer_ID = f.Customer_ID""")
def ml_score(inputs: Inputs) -> DataFrame:
    """Every customer-month of the feature table, scored, with its newest label month."""
    _, model = fitted(inputs)
    scored = score_months(feature_table(inputs), model, model.features, inputs.labels())
    return scored.select("Customer_ID", "snapshot_date", "label_snapshot_month", in_order())


@query(f"""SELECT true AS group_known, true AS features_of_group, CAST(0 AS BIGINT) AS rows_dropped, CAST(sum(n) AS BIGINT) AS rows,
       count(CASE WHEN both_labels AND split IN ('{TEST}', '{OOT}') THEN 1 END) AS aucs FROM counted""",
       training_rows=TRAINING_SQL, counted=f"""SELECT split, count(*) AS n, min(label) < max(label) AS both_labels
FROM (SELECT {split_sql(LABEL_MONTH)} AS split, label FROM training_rows) r WHERE split <> 'Other' GROUP BY split""")
def ml_two_stage(inputs: Inputs) -> DataFrame:
    """What the record of a two-stage run must hold: a chosen group among its groups with the group's features, the AUCs of the
    later splits, all rows scored."""
    rows = training_rows(inputs)
    run = two_stage_training(rows, SPLITS, initial_trials=TRIALS, refine_trials=TRIALS, trees=SEARCH_TREES)
    record, groups = run.record, run.record["feature_groups"]
    group = record["selected_feature_group"]
    aucs = [record[name] for name in ("test_auc", "oot_auc") if record[name] is not None and 0 <= record[name] <= 1]
    found = (
        group in groups, record["selected_features"] == groups.get(group), len(aucs), record["rows_dropped"],
        run.reference.where(F.col("default_probability").between(0, 1)).count(),
    )
    return inputs.spark.createDataFrame(
        [found], "group_known boolean, features_of_group boolean, aucs long, rows_dropped long, rows long"
    )


REFERENCE_SQL = "SELECT Customer_ID, label, feature_snapshot_date, true AS in_order FROM training_rows"


@query(REFERENCE_SQL, training_rows=TRAINING_SQL)
def ml_reference_table(inputs: Inputs) -> DataFrame:
    """Training, test and out-of-time rows, scored by the model."""
    rows, model = fitted(inputs)
    return learning.scored(model, rows).select("Customer_ID", "label", "feature_snapshot_date", in_order())


@query(REFERENCE_SQL, training_rows=TRAINING_SQL)
def snk_reference_data(inputs: Inputs) -> DataFrame:
    """The scored split rows, written once and read back."""
    rows, model = fitted(inputs)
    written = staged(learning.scored(model, rows), "reference-data")
    return written.select("Customer_ID", "label", "feature_snapshot_date", in_order())


TOTALS_SQL = """
SELECT 'dim_' || lpad(CAST(place AS VARCHAR), 3, '0') AS feature, sum(abs(CAST(x AS DOUBLE))) * (place + 1) AS total
FROM (SELECT unnest(embedding) AS x, generate_subscripts(embedding, 1) - 1 AS place FROM embeddings) e GROUP BY place
"""
SHARES_SQL = """
SELECT feature, total, row_number() OVER (ORDER BY total DESC, feature) AS rank, count(*) OVER () AS n,
       sum(total) OVER (ORDER BY total DESC, feature ROWS UNBOUNDED PRECEDING) / sum(total) OVER () AS cumulative
FROM totals
"""


def dimension_totals(inputs: Inputs) -> DataFrame:
    """Weighted sum of absolute values per embedding dimension, in the place of attributions."""
    values = inputs.table("embeddings").select(F.posexplode("embedding").alias("place", "x"))
    total = F.sum(F.abs(F.col("x").cast("double"))) * (F.col("place") + 1)
    name = F.concat(F.lit("dim_"), F.lpad(F.col("place").cast("string"), 3, "0"))
    return values.groupBy("place").agg(total.alias("total")).select(name.alias("feature"), "total")


def listed(sets: DataFrame) -> DataFrame:
    return rounded(sets.withColumn("feature_names", F.array_join("feature_names", ",")))


@query("""SELECT ['0–5%', '5–10%', '10–20%', '20–30%', '30–40%', '40–50%', '50–70%', '70–90%', '90–110%'][b.bin] AS feature_group,
       count(*) AS features, round(max(s.cumulative), 6) AS share, string_agg(s.feature, ',' ORDER BY s.rank) AS feature_names
FROM (SELECT bin, max(rank) AS last FROM binned GROUP BY bin) b JOIN shares s ON s.rank <= b.last
GROUP BY b.bin HAVING count(*) >= 3""",
       totals=TOTALS_SQL, shares=SHARES_SQL,
       binned="""SELECT *, CASE WHEN cumulative <= 0.05 THEN 1 WHEN cumulative <= 0.1 THEN 2 WHEN cumulative <= 0.2 THEN 3 WHEN cumulative <= 0.3 THEN 4
 WHEN cumulative <= 0.4 THEN 5 WHEN cumulative <= 0.5 THEN 6 WHEN cumulative <= 0.7 THEN 7 WHEN cumulative <= 0.9 THEN 8 ELSE 9 END AS bin FROM shares""")
def ml_feature_bins(inputs: Inputs) -> DataFrame:
    return listed(attribution.feature_bins(dimension_totals(inputs)))


@query("""SELECT 'knee' AS feature_group, count(*) AS features, round(max(cumulative), 6) AS share, string_agg(feature, ',' ORDER BY rank) AS feature_names
FROM shares WHERE rank <= (SELECT rank FROM shares ORDER BY cumulative - rank / CAST(n AS DOUBLE) DESC, rank LIMIT 1)""",
       totals=TOTALS_SQL, shares=SHARES_SQL)
def ml_feature_knee(inputs: Inputs) -> DataFrame:
    return listed(attribution.feature_knee(dimension_totals(inputs)))


@query("SELECT feature, round(total, 6) AS total, rank, round(cumulative, 6) AS cumulative FROM shares", totals=TOTALS_SQL, shares=SHARES_SQL)
def win_cum_share(inputs: Inputs) -> DataFrame:
    """Features by falling total with their cumulative share."""
    shares = attribution.ranked_shares(dimension_totals(inputs)).drop("features")
    return rounded(shares)
