"""Joins with labels, aggregates and profiles."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from duewatch.catalog.inputs import Inputs, rounded
from duewatch.catalog.registry import query
from duewatch.catalog.views import ALL_NAMES, feature_sql
from duewatch.functions.parsing import parsed_age
from duewatch.operators import labelled, profile
from duewatch.operators.loans import bad_rate_by_month_on_book, bads_at_installment
from duewatch.operators.monitor import OOT, TEST, TRAIN
from duewatch.operators.ranking import roc_auc
from duewatch.plans.tables import MOB
from duewatch.session import staged
from duewatch.sources.schemas import CLICK_FEATURES

# The given orders run from 1995 to August 2001.
SPLITS = [(TRAIN, "1995-01-01", "1998-12-01"), (TEST, "1999-01-01", "1999-12-01"), (OOT, "2000-01-01", "2000-12-01")]
FIRST_INFERENCE = "2001-01-01"


def split_sql(column: str) -> str:
    cases = " ".join(f"WHEN {column} BETWEEN DATE '{a}' AND DATE '{b}' THEN '{name}'" for name, a, b in SPLITS)
    return f"CASE {cases} ELSE 'Other' END"


def auc_sql(source: str, keys: str) -> str:
    """Rank-sum AUC per group of a relation with label and default_probability."""
    return f"""
SELECT {keys}, CAST(sum(n) AS BIGINT) AS records,
       (sum(pos * (below + (n + 1) / CAST(2 AS DOUBLE))) - sum(pos) * (sum(pos) + 1) / CAST(2 AS DOUBLE))
         / NULLIF(CAST(sum(pos) AS DOUBLE) * CAST(sum(n) - sum(pos) AS DOUBLE), 0) AS auc
FROM (SELECT *, sum(n) OVER (PARTITION BY {keys} ORDER BY default_probability) - n AS below
      FROM (SELECT {keys}, default_probability, CAST(sum(label) AS DOUBLE) AS pos, CAST(count(*) AS DOUBLE) AS n
            FROM {source} GROUP BY {keys}, default_probability) c) r
GROUP BY {keys}"""


TRAINING_SQL = """
SELECT l.label, CAST(strftime(f.snapshot_date, '%Y-%m-%d') AS VARCHAR) AS feature_snapshot_date, f.*
FROM gold_labels l JOIN gold_features f ON f.Customer_ID = l.Customer_ID
 AND f.snapshot_date = CAST(l.snapshot_date - INTERVAL 6 MONTH AS DATE)
"""


def training_rows(inputs: Inputs) -> DataFrame:
    """Labels joined with the written feature table, as in the pipeline."""
    return labelled.training_set(inputs.labels(), staged(inputs.features(), "feature-store"))


@query(f"""SELECT f.Customer_ID, l.label, CAST(strftime(f.snapshot_date, '%Y-%m-%d') AS VARCHAR) AS feature_snapshot_date, f.* EXCLUDE (Customer_ID, snapshot_date)
FROM gold_labels l JOIN (SELECT Customer_ID, snapshot_date, {feature_sql(ALL_NAMES, filled=True)} FROM gold_joined) f ON f.Customer_ID = l.Customer_ID
 AND f.snapshot_date = CAST(l.snapshot_date - INTERVAL 6 MONTH AS DATE)""")
def join_lagged_label(inputs: Inputs) -> DataFrame:
    """Labels with all 72 features of six months before."""
    return rounded(training_rows(inputs))


@query("""SELECT s.Customer_ID, s.snapshot_date, round(s.default_probability, 6) AS default_probability, l.label, u.unmatched
FROM scored_orders s JOIN gold_labels l ON l.Customer_ID = s.Customer_ID AND l.snapshot_date = s.snapshot_date
LEFT JOIN (SELECT g.snapshot_date, count(*) AS unmatched FROM gold_labels g
           WHERE NOT EXISTS (SELECT 1 FROM scored_orders o WHERE o.Customer_ID = g.Customer_ID AND o.snapshot_date = g.snapshot_date)
           GROUP BY g.snapshot_date) u ON u.snapshot_date = s.snapshot_date""")
def join_label_eval(inputs: Inputs) -> DataFrame:
    """Scored rows with their labels, and the labels of the month that have no score."""
    scored, labels = inputs.raw("scored_orders").drop("label"), inputs.labels()
    matched = labelled.scored_with_labels(scored, labels)
    return rounded(matched.join(labelled.unmatched_labels(scored, labels), "snapshot_date", "left"))


@query("""SELECT s.Customer_ID, s.snapshot_date, round(s.default_probability, 6) AS default_probability, m.label_snapshot_month
FROM scored_orders s LEFT JOIN (SELECT Customer_ID, strftime(max(snapshot_date), '%Y-%m-%d') AS label_snapshot_month
                                FROM gold_labels GROUP BY Customer_ID) m ON m.Customer_ID = s.Customer_ID""")
def join_label_membership(inputs: Inputs) -> DataFrame:
    scored = inputs.raw("scored_orders").drop("label")
    return rounded(labelled.with_label_membership(scored, inputs.labels()))


@query("""SELECT a.snapshot_date, count(*) AS customers FROM (SELECT DISTINCT Customer_ID, snapshot_date FROM gold_labels) a
JOIN (SELECT DISTINCT Customer_ID, snapshot_date FROM gold_labels) b
  ON b.Customer_ID = a.Customer_ID AND b.snapshot_date = CAST(a.snapshot_date + INTERVAL 1 MONTH AS DATE)
GROUP BY a.snapshot_date""")
def join_semi_overlap(inputs: Inputs) -> DataFrame:
    """Customers labelled in a month and in the next one, for every month."""
    return labelled.consecutive_overlap(inputs.labels())


@query("""SELECT strftime(coalesce(r.month, c.month), '%Y-%m') AS month, round(r.reference, 6) AS reference, round(c.current, 6) AS current
FROM (SELECT snapshot_date AS month, avg(label) * 100 AS reference FROM scored_orders GROUP BY 1) r
FULL JOIN (SELECT snapshot_date AS month, avg(label) * 100 AS current FROM gold_labels GROUP BY 1) c ON c.month = r.month""")
def join_trend_outer(inputs: Inputs) -> DataFrame:
    """Two monthly series side by side, months of either."""
    def percent(name: str):
        return (F.avg((F.col("label") == 1).cast("double")) * 100).alias(name)

    old = inputs.raw("scored_orders").groupBy("snapshot_date").agg(percent("reference"))
    new = inputs.labels().groupBy("snapshot_date").agg(percent("current"))
    both = old.join(new, "snapshot_date", "full_outer")
    return rounded(both.select(F.date_format("snapshot_date", "yyyy-MM").alias("month"), "reference", "current"))


@query(f"SELECT snapshot_date, {split_sql('snapshot_date')} AS split, count(*) AS rows FROM scored_orders GROUP BY 1, 2")
def join_split_assign(inputs: Inputs) -> DataFrame:
    split = labelled.split_name(F.col("snapshot_date"), SPLITS)
    return inputs.raw("scored_orders").groupBy("snapshot_date", split.alias("split")).agg(F.count(F.lit(1)).alias("rows"))


@query("""SELECT 'loans' AS stage, snapshot_date, count(*) AS rows FROM raw_loans GROUP BY 2
UNION ALL SELECT 'labels', snapshot_date, count(*) FROM gold_labels GROUP BY 2
UNION ALL SELECT 'clickstream', snapshot_date, count(*) FROM raw_clicks GROUP BY 2
UNION ALL SELECT 'features', snapshot_date, count(*) FROM gold_joined GROUP BY 2""")
def agg_row_counts(inputs: Inputs) -> DataFrame:
    stages = {
        "loans": inputs.raw("raw_loans"), "labels": inputs.labels(), "clickstream": inputs.raw("raw_clicks"),
        "features": inputs.joined(),
    }
    counts = [profile.rows_per_month(table).withColumn("stage", F.lit(name)) for name, table in stages.items()]
    union = counts[0]
    for part in counts[1:]:
        union = union.unionByName(part)
    return union


@query("SELECT count(*) AS row_count, count(DISTINCT feature_snapshot_date) AS feature_snapshot_date_count FROM training_rows",
       training_rows=TRAINING_SQL)
def agg_distinct_snapshots(inputs: Inputs) -> DataFrame:
    return profile.distinct_months(training_rows(inputs), ["feature_snapshot_date", "label_snapshot_date"])


@query("SELECT count(*) AS rows, round(avg(default_probability), 6) AS mean_probability FROM scored_orders")
def agg_mean_score(inputs: Inputs) -> DataFrame:
    return rounded(profile.score_summary(inputs.raw("scored_orders")))


@query("""SELECT mob, count(*) AS loans, CAST(sum(CASE WHEN dpd >= 30 THEN 1 ELSE 0 END) AS BIGINT) AS bads,
       round(avg(CASE WHEN dpd >= 30 THEN 1 ELSE 0 END), 6) AS bad_rate
FROM silver_loans WHERE loan_start_date < DATE '2000-01-01' GROUP BY mob""")
def agg_bad_rate_by_mob(inputs: Inputs) -> DataFrame:
    return rounded(bad_rate_by_month_on_book(inputs.loans(), "2000-01-01"))


@query("SELECT Occupation, count(*) AS rows, round(count(*) / CAST((SELECT count(*) FROM raw_attributes) AS DOUBLE), 6) AS share "
       "FROM raw_attributes GROUP BY Occupation")
def agg_value_counts(inputs: Inputs) -> DataFrame:
    return rounded(profile.category_counts(inputs.raw("raw_attributes"), "Occupation"))


AUC_GROUPS_SQL = f"""
SELECT {split_sql('snapshot_date')} AS "group", label, default_probability FROM scored_orders
UNION ALL SELECT strftime(snapshot_date, '%Y-%m'), label, default_probability FROM scored_orders
UNION ALL SELECT 'overall', label, default_probability FROM scored_orders
"""


@query('SELECT "group", records, round(auc, 6) AS auc FROM aucs', grouped=AUC_GROUPS_SQL, aucs=auc_sql("grouped", '"group"'))
def agg_auc_by_group(inputs: Inputs) -> DataFrame:
    """AUC per split, per month and over all rows; each row is counted under its three groups."""
    groups = F.array(
        labelled.split_name(F.col("snapshot_date"), SPLITS), F.date_format("snapshot_date", "yyyy-MM"), F.lit("overall")
    )
    rows = inputs.raw("scored_orders").select(F.explode(groups).alias("group"), "label", "default_probability")
    return rounded(roc_auc(rows, ["group"]))


@query("SELECT snapshot_date, records, round(auc, 6) AS auc FROM aucs", aucs=auc_sql("scored_orders", "snapshot_date"))
def stat_auc(inputs: Inputs) -> DataFrame:
    return rounded(roc_auc(inputs.raw("scored_orders"), ["snapshot_date"]))


@query(" UNION ALL ".join(
    f"SELECT '{name}' AS column_name, count(*) - count({name}) AS nulls, CAST(min({name}) AS DOUBLE) AS smallest, "
    f"CAST(max({name}) AS DOUBLE) AS largest FROM raw_clicks" for name in CLICK_FEATURES))
def prof_null_range(inputs: Inputs) -> DataFrame:
    return profile.null_ranges(inputs.raw("raw_clicks"), CLICK_FEATURES)


SUSPECT_COLUMNS = ["Annual_Income", "Num_of_Loan", "Num_of_Delayed_Payment", "Changed_Credit_Limit", "Amount_invested_monthly",
                   "Credit_Mix", "Payment_of_Min_Amount"]


@query(" UNION ALL ".join(
    f"SELECT '{name}' AS column_name, {name} AS value, count(*) AS rows FROM raw_financials "
    f"WHERE {name} IS NOT NULL AND TRY_CAST({name} AS DOUBLE) IS NULL GROUP BY {name}" for name in SUSPECT_COLUMNS))
def prof_bad_values(inputs: Inputs) -> DataFrame:
    return profile.unreadable_values(inputs.raw("raw_financials"), SUSPECT_COLUMNS)


@query("SELECT CAST(date_trunc('month', l_shipdate) AS DATE) AS month, count(*) AS rows, min(l_extendedprice) AS smallest, "
       "max(l_extendedprice) AS largest FROM lineitem GROUP BY 1")
def agg_month_bucket(inputs: Inputs) -> DataFrame:
    return profile.months_with_rows(inputs.table("lineitem"), "l_shipdate", "l_extendedprice")


@query("""SELECT "group", bin, rows FROM (
  SELECT o_orderpriority AS "group", bin, count(*) AS rows FROM placed GROUP BY 1, 2
  UNION ALL SELECT '(all)', bin, count(*) FROM placed GROUP BY 2) u""",
       placed="""SELECT o_orderpriority, CAST(least(99, floor((o_totalprice - low) / ((high - low) / CAST(100 AS DOUBLE)))) AS INT) AS bin
FROM orders, (SELECT min(o_totalprice) AS low, max(o_totalprice) AS high FROM orders) b""")
def prof_histogram_by_group(inputs: Inputs) -> DataFrame:
    return profile.histogram_by_group(inputs.table("orders"), "o_totalprice", "o_orderpriority")


@query("SELECT Customer_ID, CAST(trunc(TRY_CAST(Age AS DOUBLE)) AS DOUBLE) AS Age FROM raw_attributes "
       "WHERE TRY_CAST(Age AS DOUBLE) NOT BETWEEN 0 AND 100")
def prof_outliers(inputs: Inputs) -> DataFrame:
    ages = inputs.raw("raw_attributes").select("Customer_ID", parsed_age(F.col("Age")).alias("Age"))
    return profile.outside(ages, "Age", 0, 100)


@query("SELECT snapshot_date, count(*) AS loans, CAST(sum(CASE WHEN dpd >= 30 THEN 1 ELSE 0 END) AS BIGINT) AS bads "
       "FROM silver_loans WHERE loan_start_date < DATE '2000-01-01' AND installment_num = 7 GROUP BY snapshot_date")
def agg_bads_at_installment(inputs: Inputs) -> DataFrame:
    """The given loans have seven installments, so the last one is taken."""
    return bads_at_installment(inputs.loans(), "2000-01-01", installment=7)


@query("SELECT loan_id, Customer_ID, mob, dpd, snapshot_date FROM silver_loans WHERE mob = 6")
def flt_mob(inputs: Inputs) -> DataFrame:
    return inputs.loans().where(F.col("mob") == MOB).select("loan_id", "Customer_ID", "mob", "dpd", "snapshot_date")


@query("""SELECT snapshot_date, count(*) AS unmatched FROM gold_labels g
WHERE NOT EXISTS (SELECT 1 FROM scored_orders o WHERE o.Customer_ID = g.Customer_ID AND o.snapshot_date = g.snapshot_date) GROUP BY 1""")
def agg_unmatched_labels(inputs: Inputs) -> DataFrame:
    return labelled.unmatched_labels(inputs.raw("scored_orders"), inputs.labels())


@query("SELECT Customer_ID, strftime(max(snapshot_date), '%Y-%m-%d') AS label_snapshot_month FROM gold_labels GROUP BY Customer_ID")
def win_keep_last(inputs: Inputs) -> DataFrame:
    return labelled.newest_label_month(inputs.labels())


@query("SELECT DISTINCT Customer_ID, snapshot_date FROM gold_labels")
def set_distinct(inputs: Inputs) -> DataFrame:
    return labelled.customer_months(inputs.labels())
