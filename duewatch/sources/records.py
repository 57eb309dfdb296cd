"""Run records: one JSON line per training run, evaluation or report."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# What scoring needs to know about a training run.
REQUIRED_RUN_KEYS = ["stage2_model_path", "selected_features"]


def append_records(records: DataFrame, path: str) -> None:
    """Add records to a registry folder as JSON lines."""
    records.write.mode("append").json(path)


def read_records(spark: SparkSession, path: str, required: list[str]) -> DataFrame:
    """Records of a registry; raises when a required key is missing or empty in any record."""
    records = spark.read.option("multiLine", False).json(path)
    absent = [key for key in required if key not in records.columns]
    if absent:
        raise ValueError(f"{absent} missing in {path}")
    types = dict(records.dtypes)
    empty = [
        F.col(key).isNull() | (F.size(key) == 0 if types[key].startswith("array") else F.lit(False))
        for key in required
    ]
    broken = empty[0]
    for condition in empty[1:]:
        broken = broken | condition
    if not records.where(broken).isEmpty():
        raise ValueError(f"a record in {path} has no value for one of {required}")
    return records


def latest_record(records: DataFrame, run_id: str | None = None) -> DataFrame:
    """The newest run, or the named one, which must exist."""
    if run_id is None:
        return records.orderBy(F.col("created_at").desc(), F.col("run_id").desc()).limit(1)
    chosen = records.where(F.col("run_id") == run_id)
    if chosen.isEmpty():
        raise LookupError(f"no run {run_id}")
    return chosen
