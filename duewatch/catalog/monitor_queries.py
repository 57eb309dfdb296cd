"""Drift tests, AUC monitoring and alerts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from duewatch.catalog.inputs import Inputs, rounded
from duewatch.catalog.label_queries import FIRST_INFERENCE, SPLITS, auc_sql, split_sql
from duewatch.catalog.registry import query
from duewatch.operators import drift, labelled, monitor

NUMERIC = ["l_quantity", "l_extendedprice", "l_discount", "l_tax", "ship_day"]
CATEGORICAL = ["l_returnflag", "l_linestatus", "l_linenumber"]


def sides(inputs: Inputs) -> DataFrame:
    """Line items before and after the middle of the shipping period."""
    items = inputs.table("lineitem")
    return items.select(
        (F.col("l_shipdate") < F.lit("1998-07-01").cast("timestamp_ntz")).alias("is_reference"),
        *NUMERIC[:4],
        F.datediff(F.col("l_shipdate").cast("date"), F.lit("1995-01-01").cast("date")).alias("ship_day"),
        "l_returnflag",
        "l_linestatus",
        F.col("l_linenumber").cast("string").alias("l_linenumber"),
    )


SIDES_SQL = """
SELECT l_shipdate < TIMESTAMP '1998-07-01' AS is_reference, l_quantity, l_extendedprice, l_discount, l_tax,
       date_diff('day', DATE '1995-01-01', CAST(l_shipdate AS DATE)) AS ship_day,
       l_returnflag, l_linestatus, CAST(l_linenumber AS VARCHAR) AS l_linenumber
FROM lineitem
"""


def long_sql(names: list[str], kind: str) -> str:
    return " UNION ALL ".join(
        f"SELECT is_reference, '{name}' AS feature, CAST({name} AS {kind}) AS value FROM sides" for name in names
    )


KS_SQL = """
SELECT feature, statistic, n_reference, n_current, CASE WHEN scaled < 0.2 THEN 1.0 ELSE
       greatest(0, least(1, (SELECT sum((CASE WHEN j % 2 = 1 THEN 2 ELSE -2 END) * exp(-2.0 * j * j * scaled * scaled)) FROM range(1, 101) t(j)))) END AS p_value
FROM (SELECT feature, statistic, n_reference, n_current,
             (sqrt(e) + CAST(0.12 AS DOUBLE) + CAST(0.11 AS DOUBLE) / sqrt(e)) * statistic AS scaled
      FROM (SELECT feature, max(abs(ref_share - cur_share)) AS statistic, max(n_reference) AS n_reference,
                   max(n_current) AS n_current,
                   CAST(max(n_reference) AS DOUBLE) * max(n_current) / (max(n_reference) + max(n_current)) AS e
            FROM (SELECT feature, n_reference, n_current,
                         sum(r) OVER (PARTITION BY feature ORDER BY value) / CAST(n_reference AS DOUBLE) AS ref_share,
                         sum(c) OVER (PARTITION BY feature ORDER BY value) / CAST(n_current AS DOUBLE) AS cur_share
                  FROM (SELECT feature, value, count(CASE WHEN is_reference THEN 1 END) AS r,
                               count(CASE WHEN NOT is_reference THEN 1 END) AS c,
                               CAST(sum(count(CASE WHEN is_reference THEN 1 END)) OVER (PARTITION BY feature) AS BIGINT) AS n_reference,
                               CAST(sum(count(CASE WHEN NOT is_reference THEN 1 END)) OVER (PARTITION BY feature) AS BIGINT) AS n_current
                        FROM numeric_values GROUP BY feature, value) g) s
            GROUP BY feature) d) k
"""

# Critical values of the chi-squared distribution at 5 percent.
CHI2_SQL = """
SELECT feature, sum(contribution) AS statistic, freedom,
       sum(contribution) > CASE freedom WHEN 1 THEN 3.841458820694124 WHEN 2 THEN 5.991464547107979 WHEN 6 THEN 12.591587243743977 END AS drift_detected
FROM (SELECT feature, freedom,
             CASE WHEN freedom = 1 THEN pow(greatest(abs(o - e) - CAST(0.5 AS DOUBLE), 0), 2) / e ELSE pow(o - e, 2) / e END AS contribution
      FROM (SELECT c.feature, c.o, CAST(r.n AS DOUBLE) * s.n / t.n AS e, CAST(t.categories - 1 AS INT) AS freedom
            FROM (SELECT f.feature, f.value, x.is_reference, coalesce(g.o, 0) AS o
                  FROM (SELECT DISTINCT feature, value FROM category_values) f
                  CROSS JOIN (SELECT DISTINCT is_reference FROM category_values) x
                  LEFT JOIN (SELECT feature, value, is_reference, count(*) AS o FROM category_values GROUP BY ALL) g
                    ON g.feature = f.feature AND g.value = f.value AND g.is_reference = x.is_reference) c
            JOIN (SELECT feature, value, count(*) AS n FROM category_values GROUP BY ALL) r ON r.feature = c.feature AND r.value = c.value
            JOIN (SELECT feature, is_reference, count(*) AS n FROM category_values GROUP BY ALL) s ON s.feature = c.feature AND s.is_reference = c.is_reference
            JOIN (SELECT feature, count(*) AS n, count(DISTINCT value) AS categories FROM category_values GROUP BY ALL) t ON t.feature = c.feature) k) z
GROUP BY feature, freedom
"""
# Tails of the chi-squared distribution: closed sums for 2 and 6 degrees of freedom, and for 1 the area under the
# normal curve beyond the root, in 4000 steps.
DRIFT_SQL = """
SELECT feature, 'Kolmogorov-Smirnov' AS test, statistic, p_value, p_value < 0.05 AS drift_detected FROM ks
UNION ALL
SELECT feature, 'Chi-squared', statistic,
       CASE freedom WHEN 2 THEN exp(-statistic / 2)
            WHEN 6 THEN exp(-statistic / 2) * (1 + statistic / 2 + statistic * statistic / 8)
            WHEN 1 THEN (SELECT sum(exp(-pow(sqrt(statistic) + (j + CAST(0.5 AS DOUBLE)) / 400, 2) / 2)) / 400 * sqrt(2 / pi()) FROM range(0, 4000) t(j)) END,
       drift_detected FROM chi
"""
DRIFT_VIEWS = {
    "sides": SIDES_SQL,
    "numeric_values": long_sql(NUMERIC, "DOUBLE"),
    "category_values": long_sql(CATEGORICAL, "VARCHAR"),
    "ks": KS_SQL,
    "chi": CHI2_SQL,
    "drift": DRIFT_SQL,
}


@query("SELECT feature, round(statistic, 6) AS statistic, n_reference, n_current, round(p_value, 6) AS p_value, "
       "p_value < 0.05 AS drift_detected FROM ks", **DRIFT_VIEWS)
def stat_ks_2samp(inputs: Inputs) -> DataFrame:
    return rounded(drift.ks_test(sides(inputs), "is_reference", NUMERIC))


@query("""SELECT c.feature, round(c.statistic, 6) AS statistic, c.freedom, round(d.p_value, 6) AS p_value, c.drift_detected,
       CAST(NULL AS VARCHAR) AS notes FROM chi c JOIN drift d ON d.feature = c.feature""", **DRIFT_VIEWS)
def stat_chi2(inputs: Inputs) -> DataFrame:
    return rounded(drift.chi2_test(sides(inputs), "is_reference", CATEGORICAL))


def full_drift(inputs: Inputs) -> DataFrame:
    return drift.drift_report(sides(inputs), "is_reference", NUMERIC, CATEGORICAL)


@query("""SELECT feature, test, round(statistic, 6) AS statistic, round(p_value, 6) AS p_value, drift_detected,
       CAST(NULL AS VARCHAR) AS notes FROM drift""", **DRIFT_VIEWS)
def mon_drift_report(inputs: Inputs) -> DataFrame:
    return rounded(full_drift(inputs))


HISTOGRAM_VIEWS = {
    "plan_side": """
SELECT s.feature, s.is_reference, s.n, s.low, s.high,
       CAST(CASE WHEN s.high = s.low THEN 1 ELSE ceil((s.high - s.low) / CASE WHEN s.iqr > 0 THEN least(2 * s.iqr / cbrt(s.n), (s.high - s.low) / (log2(s.n) + 1)) ELSE (s.high - s.low) / (log2(s.n) + 1) END) END AS BIGINT) AS bins
FROM (SELECT feature, is_reference, CAST(count(*) AS DOUBLE) AS n, min(value) AS low, max(value) AS high,
             quantile_cont(value, 0.75) - quantile_cont(value, 0.25) AS iqr FROM numeric_values GROUP BY feature, is_reference) s""",
    "binned": """
SELECT feature, is_reference, bin0 - CASE WHEN value < low + bin0 * width THEN 1 ELSE 0 END
         + CASE WHEN value >= low + (bin0 + 1) * width AND bin0 < bins - 1 THEN 1 ELSE 0 END AS bin, count(*) AS n
FROM (SELECT v.feature, v.is_reference, v.value, p.low, p.bins, (p.high - p.low) / p.bins AS width,
             CAST(least(floor((v.value - p.low) * (p.bins / (p.high - p.low))), p.bins - 1) AS BIGINT) AS bin0
      FROM numeric_values v JOIN plan_side p ON p.feature = v.feature AND p.is_reference = v.is_reference) x
GROUP BY ALL""",
}


@query("""SELECT p.feature, p.is_reference, p.bins, p.bin, round(p.low + p.bin * p.width, 6) AS bin_start,
       round(p.low + (p.bin + 1) * p.width, 6) AS bin_end, round(coalesce(b.n, 0) / (p.n * p.width), 6) AS density
FROM (SELECT *, (high - low) / bins AS width, unnest(range(bins)) AS bin FROM plan_side) p
LEFT JOIN binned b ON b.feature = p.feature AND b.is_reference = p.is_reference AND b.bin = p.bin""", **DRIFT_VIEWS, **HISTOGRAM_VIEWS)
def stat_histogram(inputs: Inputs) -> DataFrame:
    return rounded(drift.density_histogram(sides(inputs), "is_reference", NUMERIC, empty_bins=True))


def reference_and_current(inputs: Inputs) -> tuple[DataFrame, DataFrame]:
    """Orders up to 2000, dated by their features six months before, and the months of 2001."""
    rows = inputs.raw("scored_orders")
    boundary = F.lit(FIRST_INFERENCE).cast("date")
    stamped = rows.withColumnRenamed("snapshot_date", "feature_snapshot_date")
    reference = stamped.where(F.col("feature_snapshot_date") < boundary)
    earlier = F.add_months("feature_snapshot_date", -6)
    return reference.withColumn("feature_snapshot_date", earlier), stamped.where(F.col("feature_snapshot_date") >= boundary)


MONITOR_VIEWS = {
    "monitored": f"""
SELECT {split_sql('snapshot_date')} AS "group", label, default_probability FROM scored_orders WHERE snapshot_date < DATE '{FIRST_INFERENCE}'
UNION ALL SELECT strftime(snapshot_date, '%Y-%m') || ' (Inference)', label, default_probability FROM scored_orders WHERE snapshot_date >= DATE '{FIRST_INFERENCE}'""",
    "group_aucs": auc_sql("monitored", '"group"'),
    "auc_scores": 'SELECT "group", auc, records FROM group_aucs WHERE "group" <> \'Other\' AND auc IS NOT NULL',
    "baselines": """
SELECT max(CASE WHEN "group" = 'Train/Validation' THEN auc END) AS train, max(CASE WHEN "group" = 'Test' THEN auc END) AS test,
       max(CASE WHEN "group" = 'Out-of-Time (OOT)' THEN auc END) AS oot FROM auc_scores""",
    "inference": 'SELECT s."group" AS month, s.auc, b.* FROM auc_scores s CROSS JOIN baselines b WHERE s."group" LIKE \'%(Inference)\'',
    "alerts": """
SELECT month, auc, level, printf('%s AUC (%.4f) is >%s below OOT AUC (%.4f). %s', month, auc, fall, oot, advice) AS message
FROM (SELECT *, CASE level WHEN 'Critical' THEN '15%' WHEN 'Alert' THEN '10%' ELSE '5%' END AS fall,
             CASE level WHEN 'Critical' THEN 'Model retraining may be required.' WHEN 'Alert' THEN 'Diagnostic investigation is recommended.'
                  ELSE 'Closer observation is advised.' END AS advice
      FROM (SELECT *, CASE WHEN auc < oot * CAST(0.85 AS DOUBLE) THEN 'Critical' WHEN auc < oot * CAST(0.9 AS DOUBLE) THEN 'Alert'
                           WHEN auc < oot * CAST(0.95 AS DOUBLE) THEN 'Warning' END AS level FROM inference) l
      WHERE level IS NOT NULL) t""",
}


def scores(inputs: Inputs) -> DataFrame:
    return monitor.auc_scores(*reference_and_current(inputs), splits=SPLITS)


@query('SELECT "group", round(auc, 6) AS auc, records FROM auc_scores', **MONITOR_VIEWS)
def mon_auc_scores(inputs: Inputs) -> DataFrame:
    return rounded(scores(inputs))


@query('SELECT month, "group", round(auc, 6) AS auc FROM trend', **MONITOR_VIEWS,
       trend_rows=f"""SELECT snapshot_date AS month, {split_sql('snapshot_date')} AS "group", label, default_probability FROM scored_orders
WHERE snapshot_date < DATE '{FIRST_INFERENCE}' UNION ALL
SELECT snapshot_date, 'Current AUC', label, default_probability FROM scored_orders WHERE snapshot_date >= DATE '{FIRST_INFERENCE}'""",
       trend=auc_sql("trend_rows", 'month, "group"'))
def mon_auc_trend(inputs: Inputs) -> DataFrame:
    return rounded(monitor.auc_trend(*reference_and_current(inputs), splits=SPLITS))


@query("""SELECT strftime(month, '%Y-%m') AS month, round(auc, 6) AS auc FROM old_aucs
UNION ALL SELECT (SELECT strftime(max(month) + INTERVAL 1 MONTH, '%Y-%m') FROM old_aucs), round(auc, 6) FROM new_auc""",
       old_rows=f"""SELECT CAST(snapshot_date - INTERVAL 6 MONTH AS DATE) AS month, label, default_probability FROM scored_orders
WHERE snapshot_date < DATE '{FIRST_INFERENCE}'""",
       new_rows=f"SELECT 1 AS side, label, default_probability FROM scored_orders WHERE snapshot_date >= DATE '{FIRST_INFERENCE}'",
       old_aucs=auc_sql("old_rows", "month"), new_auc=auc_sql("new_rows", "side"))
def mon_auc_trend_next_month(inputs: Inputs) -> DataFrame:
    return rounded(monitor.auc_trend_next_month(*reference_and_current(inputs)))


@query(f"""SELECT strftime(month, '%Y-%m') AS month, round(reference, 6) AS reference, round(current, 6) AS current FROM (
  SELECT CAST(snapshot_date - INTERVAL 6 MONTH AS DATE) AS month, avg(label) * 100 AS reference, CAST(NULL AS DOUBLE) AS current
  FROM scored_orders WHERE snapshot_date < DATE '{FIRST_INFERENCE}' GROUP BY 1
  UNION ALL
  SELECT (SELECT CAST(max(snapshot_date) - INTERVAL 5 MONTH AS DATE) FROM scored_orders WHERE snapshot_date < DATE '{FIRST_INFERENCE}'),
         NULL, avg(label) * 100 FROM scored_orders WHERE snapshot_date >= DATE '{FIRST_INFERENCE}') u""")
def agg_positive_rate_by_month(inputs: Inputs) -> DataFrame:
    return rounded(monitor.positive_rate_by_month(*reference_and_current(inputs)))


@query("""SELECT (SELECT CAST(count(CASE WHEN drift_detected THEN 1 END) AS VARCHAR) || ' / ' || CAST(count(*) AS VARCHAR) || ' features drifted' FROM drift) AS feature_drift,
       CASE WHEN bool_or(auc < oot * CAST(0.95 AS DOUBLE) OR auc < test * CAST(0.93 AS DOUBLE) OR auc < train * CAST(0.9 AS DOUBLE)) THEN 'Bad' ELSE 'Good' END AS model_auc_performance
FROM inference""", **DRIFT_VIEWS, **MONITOR_VIEWS)
def mon_status(inputs: Inputs) -> DataFrame:
    return monitor.performance_status(scores(inputs), full_drift(inputs))


@query("SELECT month, round(auc, 6) AS auc, level, message FROM alerts", **MONITOR_VIEWS)
def mon_auc_alerts(inputs: Inputs) -> DataFrame:
    return rounded(monitor.auc_alerts(scores(inputs)))


@query("""SELECT CASE WHEN count(CASE WHEN level = 'Critical' THEN 1 END) > 0 THEN 'Critical' WHEN count(CASE WHEN level = 'Alert' THEN 1 END) > 0 THEN 'Alert'
            WHEN count(*) > 0 THEN 'Warning' ELSE 'OK' END AS highest_level,
       (SELECT bool_or(drift_detected) FROM drift) AS feature_drift_detected,
       count(*) > 0 OR (SELECT bool_or(drift_detected) FROM drift) AS alert_raised
FROM alerts""", **DRIFT_VIEWS, **MONITOR_VIEWS)
def mon_highest_level(inputs: Inputs) -> DataFrame:
    return monitor.highest_level(monitor.auc_alerts(scores(inputs)), full_drift(inputs))


@query("""SELECT 'feature drift' AS kind, feature AS subject, printf('%s (p-value: %.4f)', feature, p_value) AS message FROM drift WHERE drift_detected
UNION ALL SELECT 'AUC degradation', month, level || ': ' || message FROM alerts""", **DRIFT_VIEWS, **MONITOR_VIEWS)
def mon_alert_table(inputs: Inputs) -> DataFrame:
    return monitor.alert_table(monitor.auc_alerts(scores(inputs)), full_drift(inputs))


@query("""SELECT coalesce(a.snapshot_date, u.snapshot_date) AS snapshot_date, coalesce(a.records, 0) AS records, round(a.auc, 6) AS auc,
       30 AS dpd, 6 AS mob, coalesce(u.unmatched, 0) AS unmatched
FROM matched_aucs a FULL JOIN (SELECT g.snapshot_date, count(*) AS unmatched FROM gold_labels g
  WHERE NOT EXISTS (SELECT 1 FROM scored_orders o WHERE o.Customer_ID = g.Customer_ID AND o.snapshot_date = g.snapshot_date)
  GROUP BY g.snapshot_date) u ON u.snapshot_date = a.snapshot_date""",
       matched="""SELECT s.snapshot_date, l.label, s.default_probability FROM scored_orders s
JOIN gold_labels l ON l.Customer_ID = s.Customer_ID AND l.snapshot_date = s.snapshot_date""",
       matched_aucs=auc_sql("matched", "snapshot_date"))
def mon_eval_record(inputs: Inputs) -> DataFrame:
    """Months of scored rows with labels, their AUC and the labels without a score."""
    scored, labels = inputs.raw("scored_orders").drop("label"), inputs.labels()
    matched = labelled.scored_with_labels(scored, labels)
    return rounded(monitor.evaluation_records(matched, labelled.unmatched_labels(scored, labels), 30, 6))
