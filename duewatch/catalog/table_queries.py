"""Sources, sinks, snapshot selection and projections."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from duewatch.catalog.inputs import Inputs, rounded
from duewatch.catalog.registry import query
from duewatch.catalog.views import BASE_NAMES, FEATURE_SQL, FIRST_MONTH, LAST_MONTH, LOAN_NAMES, feature_sql
from duewatch.operators.features import LINEAR_FEATURES, model_table
from duewatch.operators.labelled import complete_rows, dropped_counts, training_set
from duewatch.operators.learning import encoded, feature_columns
from duewatch.operators.loans import typed
from duewatch.operators.months import at_month, latest_known, month_list, restamped, run_months
from duewatch.session import fresh_path
from duewatch.sources import schemas
from duewatch.sources.records import append_records, latest_record, read_records
from duewatch.sources.snapshots import read_raw_csv, read_snapshot, read_snapshots, write_snapshots

LOAN_SQL = f"SELECT {', '.join(schemas.LOAN_COLUMNS)} FROM raw_loans"
ONE_MONTH, OTHER_MONTH = "1998-03-01", "1998-04-01"


def written(table: DataFrame, name: str, file_format: str = "parquet") -> str:
    path = fresh_path(table.sparkSession, name)
    write_snapshots(table, path, file_format)
    return path


@query(LOAN_SQL)
def src_csv_scan(inputs: Inputs) -> DataFrame:
    """Raw loans in one folder of headed CSV files, some of which have their columns in another order, read back by name as
    text and typed."""
    path, loans = fresh_path(inputs.spark, "raw-loans"), inputs.raw("raw_loans")
    even = F.xxhash64("loan_id") % 2 == 0
    for part, columns in ((loans.where(even), schemas.LOAN_COLUMNS), (loans.where(~even), list(reversed(schemas.LOAN_COLUMNS)))):
        part.select(*columns).write.mode("append").option("header", True).csv(path)
    return typed(read_raw_csv(inputs.spark, path, schemas.LOAN_COLUMNS), schemas.LOAN_TYPES)


@query(f"SELECT * FROM gold_labels WHERE snapshot_date = DATE '{ONE_MONTH}'")
def src_parquet_scan(inputs: Inputs) -> DataFrame:
    path = written(inputs.labels(), "labels")
    return read_snapshots(inputs.spark, path, ONE_MONTH, ONE_MONTH)


@query("SELECT snapshot_date, count(*) AS rows, CAST(sum(label) AS BIGINT) AS bads FROM gold_labels GROUP BY snapshot_date")
def src_multi_snapshot_scan(inputs: Inputs) -> DataFrame:
    labels = read_snapshots(inputs.spark, written(inputs.labels(), "labels"))
    return labels.groupBy("snapshot_date").agg(F.count(F.lit(1)).alias("rows"), F.sum("label").alias("bads"))


@query("SELECT max(snapshot_date) AS snapshot_date, count(*) AS rows FROM gold_labels "
       "WHERE snapshot_date = (SELECT max(snapshot_date) FROM gold_labels)")
def src_snapshot_resolve(inputs: Inputs) -> DataFrame:
    """The newest month of the label store, found in its partitions; a month without one raises."""
    path = written(inputs.labels(), "labels")
    newest = read_snapshots(inputs.spark, path).agg(F.max("snapshot_date")).first()[0]
    month = read_snapshot(inputs.spark, path, newest)
    return month.groupBy("snapshot_date").agg(F.count(F.lit(1)).alias("rows"))


def run_records(inputs: Inputs) -> DataFrame:
    """One run per label month, with the customers and bad rate it would train on."""
    return inputs.labels().groupBy("snapshot_date").agg(
        F.count(F.lit(1)).alias("records"), F.sum("label").alias("bads")
    ).select(
        F.concat(F.lit("run_"), F.date_format("snapshot_date", "yyyy_MM")).alias("run_id"),
        F.col("snapshot_date").cast("string").alias("created_at"),
        F.concat(F.lit("models/"), F.date_format("snapshot_date", "yyyy_MM")).alias("stage2_model_path"),
        F.array(F.lit("Age"), F.lit("Outstanding_Debt")).alias("selected_features"),
        "records",
        "bads",
    )


RUN_SQL = """
SELECT 'run_' || strftime(snapshot_date, '%Y_%m') AS run_id, CAST(snapshot_date AS VARCHAR) AS created_at,
       'models/' || strftime(snapshot_date, '%Y_%m') AS stage2_model_path, count(*) AS records,
       CAST(sum(label) AS BIGINT) AS bads
FROM gold_labels GROUP BY snapshot_date
"""


@query(RUN_SQL)
def src_metadata_json(inputs: Inputs) -> DataFrame:
    """Run records written as JSON and read back with their required keys."""
    path = fresh_path(inputs.spark, "runs")
    append_records(run_records(inputs), path)
    records = read_records(inputs.spark, path, ["stage2_model_path", "selected_features"])
    return records.select("run_id", "created_at", "stage2_model_path", "records", "bads")


@query(RUN_SQL)
def snk_run_metadata(inputs: Inputs) -> DataFrame:
    """Registry filled by two appends."""
    path = fresh_path(inputs.spark, "runs")
    records = run_records(inputs)
    early = F.col("created_at") < "1998"
    append_records(records.where(early), path)
    append_records(records.where(~early), path)
    return inputs.spark.read.json(path).drop("selected_features")


@query(RUN_SQL + "ORDER BY snapshot_date DESC LIMIT 1")
def topk_latest_run(inputs: Inputs) -> DataFrame:
    return latest_record(run_records(inputs).drop("selected_features"))


@query(f"SELECT loan_id, Customer_ID, CASE WHEN snapshot_date = DATE '{ONE_MONTH}' THEN 1 - label ELSE label END AS label, "
       "label_def, snapshot_date FROM gold_labels")
def snk_snapshot_overwrite(inputs: Inputs) -> DataFrame:
    """One month is written again with other values; every other month stays as it was."""
    labels = inputs.labels()
    path = written(labels, "labels")
    again = at_month(labels, ONE_MONTH).withColumn("label", 1 - F.col("label"))
    write_snapshots(again, path)
    return read_snapshots(inputs.spark, path)


@query(LOAN_SQL)
def snk_bronze_csv(inputs: Inputs) -> DataFrame:
    """Bronze loans: one CSV folder per month, no row passes the driver."""
    loans = inputs.raw("raw_loans")
    as_text = loans.select(*[F.col(name).cast("string").alias(name) for name in loans.columns])
    return typed(read_snapshots(inputs.spark, written(as_text, "bronze", "csv")), schemas.LOAN_TYPES)


@query("SELECT Customer_ID, label, round(default_probability, 6) AS default_probability, "
       "CASE WHEN default_probability >= 0.25 THEN 1 ELSE 0 END AS prediction, snapshot_date FROM scored_orders")
def snk_scored(inputs: Inputs) -> DataFrame:
    """Scored rows with labels, one partition per month."""
    scored = inputs.raw("scored_orders").withColumn("prediction", (F.col("default_probability") >= 0.25).cast("int"))
    return rounded(read_snapshots(inputs.spark, written(scored, "scored")))


@query(f"SELECT loan_id, {', '.join(schemas.LOAN_COLUMNS[1:])} FROM raw_loans WHERE snapshot_date = DATE '{ONE_MONTH}'")
def flt_snapshot_eq(inputs: Inputs) -> DataFrame:
    return at_month(inputs.raw("raw_loans"), ONE_MONTH)


@query(f"SELECT Customer_ID, Name, Age, SSN, Occupation, m.month AS snapshot_date "
       f"FROM raw_attributes a JOIN months m ON a.snapshot_date <= m.month")
def flt_asof_restamp(inputs: Inputs) -> DataFrame:
    return restamped(inputs.raw("raw_attributes"), FIRST_MONTH, LAST_MONTH)


@query("""SELECT Customer_ID, Occupation, Age, month AS snapshot_date
FROM (SELECT a.Customer_ID, a.Occupation, a.Age, m.month,
             row_number() OVER (PARTITION BY m.month, a.Customer_ID ORDER BY a.snapshot_date DESC, a.Occupation DESC, a.Age DESC) AS place
      FROM attribute_history a JOIN months m ON a.snapshot_date <= m.month) s WHERE place = 1""")
def asof_latest(inputs: Inputs) -> DataFrame:
    return latest_known(inputs.raw("attribute_history"), "Customer_ID", FIRST_MONTH, LAST_MONTH)


@query(r"""SELECT Customer_ID, CAST(trunc(TRY_CAST(Age AS DOUBLE)) AS INT) AS Age, SSN, Occupation, snapshot_date, Name FROM raw_attributes""")
def prj_cast_map(inputs: Inputs) -> DataFrame:
    return typed(inputs.raw("raw_attributes"), schemas.ATTRIBUTE_TYPES)


@query(f"SELECT Customer_ID, snapshot_date, {feature_sql([*BASE_NAMES, *LOAN_NAMES, 'unseen', *schemas.CLICK_FEATURES, *FEATURE_SQL], filled=True)} FROM gold_joined")
def prj_model_full(inputs: Inputs) -> DataFrame:
    return rounded(inputs.features())


@query(f"SELECT Customer_ID, snapshot_date, {feature_sql([*BASE_NAMES, *LOAN_NAMES, 'unseen', *FEATURE_SQL], filled=True)} FROM gold_joined")
def prj_model_linear(inputs: Inputs) -> DataFrame:
    return rounded(model_table(inputs.store(), LINEAR_FEATURES))


@query("SELECT 'numeric' AS kind, 'l_quantity' AS column_name, count(l_quantity) AS rows FROM lineitem UNION ALL "
       "SELECT 'numeric', 'l_extendedprice', count(l_extendedprice) FROM lineitem UNION ALL "
       "SELECT 'categorical', 'l_returnflag', count(l_returnflag) FROM lineitem UNION ALL "
       "SELECT 'categorical', 'l_linestatus', count(l_linestatus) FROM lineitem")
def prj_feature_columns(inputs: Inputs) -> DataFrame:
    """Feature columns found by type, ids and dates left out, with their known rows."""
    rows = inputs.table("lineitem").select(
        F.col("l_orderkey").alias("loan_id"), F.col("l_shipdate").alias("snapshot_date"),
        "l_quantity", "l_extendedprice", "l_returnflag", "l_linestatus",
    )
    numeric, categorical = feature_columns(rows)
    names = [*numeric, *categorical]
    counts = rows.agg(*[F.count(name).alias(name) for name in names]).unpivot([], names, "column_name", "rows")
    kind = F.when(F.col("column_name").isin(numeric), F.lit("numeric")).otherwise(F.lit("categorical"))
    return counts.select(kind.alias("kind"), "column_name", "rows")


@query("""SELECT snapshot_date, count(*) AS rows,
       count(CASE WHEN due_amt IS NOT NULL AND overdue_amt IS NOT NULL AND balance IS NOT NULL THEN 1 END) AS kept,
       count(CASE WHEN due_amt IS NULL OR overdue_amt IS NULL OR balance IS NULL THEN 1 END) AS dropped
FROM raw_loans GROUP BY snapshot_date""")
def flt_dropna_any(inputs: Inputs) -> DataFrame:
    """Complete rows and dropped rows per month; the kept rows are those ``complete_rows`` returns."""
    loans, columns = inputs.raw("raw_loans"), ["due_amt", "overdue_amt", "balance"]
    counts = dropped_counts(loans, columns, "snapshot_date")
    kept = complete_rows(loans, columns).groupBy("snapshot_date").agg(F.count(F.lit(1)).alias("kept"))
    return counts.drop("kept").join(kept, "snapshot_date", "left").select(
        "snapshot_date", "rows", F.coalesce("kept", F.lit(0)).alias("kept"), "dropped"
    )


@query("""SELECT l_orderkey AS loan_id, l_linenumber AS line, round(l_quantity, 6) AS l_quantity,
       CAST(dense_rank() OVER (ORDER BY l_returnflag) - 1 AS INT) AS l_returnflag,
       CAST(dense_rank() OVER (ORDER BY l_linestatus) - 1 AS INT) AS l_linestatus FROM lineitem""")
def prj_encode_columns(inputs: Inputs) -> DataFrame:
    rows = inputs.table("lineitem").select(
        F.col("l_orderkey").alias("loan_id"), F.col("l_linenumber").alias("line"),
        F.col("l_quantity").cast("string").alias("l_quantity"), "l_returnflag", "l_linestatus",
    )
    return rounded(encoded(rows, ["l_quantity"], ["l_returnflag", "l_linestatus"]))


@query(f"""SELECT CAST(unnest(generate_series(CAST(date_trunc('month', min(o_orderdate)) - INTERVAL 6 MONTH AS DATE),
       CAST(max(o_orderdate) AS DATE), INTERVAL 1 MONTH)) AS DATE) AS snapshot_date FROM orders""")
def gen_month_sequence(inputs: Inputs) -> DataFrame:
    return month_list(inputs.table("orders"), "o_orderdate", lookback=6)


@query("""SELECT Customer_ID, target_date, is_manual, run_month FROM (
  SELECT Customer_ID, target_date, is_manual,
         CAST(unnest(CASE WHEN is_manual AND target_date > DATE '2000-10-01'
              THEN generate_series(CAST(DATE '2000-10-01' AS TIMESTAMP), CAST(target_date AS TIMESTAMP), INTERVAL 1 MONTH)
              ELSE [CAST(target_date AS TIMESTAMP)] END) AS DATE) AS run_month
  FROM (SELECT concat('CUS_', CAST(o_custkey AS STRING)) AS Customer_ID, CAST(o_orderdate AS DATE) AS target_date,
               o_orderpriority = '1-URGENT' AS is_manual FROM orders) t) r""")
def gen_run_months(inputs: Inputs) -> DataFrame:
    """Every order as a run: urgent ones are manual."""
    runs = inputs.table("orders").select(
        F.concat(F.lit("CUS_"), F.col("o_custkey").cast("string")).alias("Customer_ID"),
        F.col("o_orderdate").cast("date").alias("target_date"),
        (F.col("o_orderpriority") == "1-URGENT").alias("is_manual"),
    )
    return run_months(runs, "2000-10-01")


@query("""SELECT Customer_ID, snapshot_date, label, CAST(NULL AS VARCHAR) AS label_def FROM scored_orders
UNION ALL SELECT Customer_ID, snapshot_date, label, label_def FROM gold_labels""")
def set_union_by_name(inputs: Inputs) -> DataFrame:
    """Two tables with the same keys; a column only one of them has is null for the other."""
    left = inputs.raw("scored_orders").drop("default_probability")
    right = inputs.labels().drop("loan_id")
    return left.unionByName(right, allowMissingColumns=True)


@query("SELECT Customer_ID, label, round(default_probability, 6) AS default_probability, snapshot_date AS feature_snapshot_date "
       "FROM scored_orders")
def set_concat_months(inputs: Inputs) -> DataFrame:
    """All scored months as one table; the partition is the month stamp."""
    path = written(inputs.raw("scored_orders"), "scored")
    return rounded(read_snapshots(inputs.spark, path).withColumnRenamed("snapshot_date", "feature_snapshot_date"))
