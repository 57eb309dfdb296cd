"""Readers and writers of tables that hold one partition per snapshot month.

A table is a folder of commits, each with the months it wrote, and a list of manifests that say which commit holds a
month. A write puts its months beside the old ones and then adds one manifest, so all of them are replaced at once, or
none if the job is lost before. Readers take the newest manifest.
"""

from __future__ import annotations

import csv
import datetime
import json
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from duewatch.session import removed
from duewatch.sources.schemas import text_schema

SNAPSHOT = "snapshot_date"
MANIFESTS = "_manifests"
COMMIT = "commit"

# Types that text columns are tried for, in order; text that fits none stays text.
INFERRED_TYPES = ("int", "bigint", "double", "date", "timestamp", "boolean")


def read_raw_csv(spark: SparkSession, path: str, columns: Sequence[str]) -> DataFrame:
    """The named columns of a headed CSV file or folder as text, whatever their order in each file.

    Spark reads all files of a folder by the header of one of them. So the first line of each file is looked at here, files
    with equal headers are read together, and the parts are put together by name. A file without one of the columns raises.
    """
    by_header: dict[tuple, list[str]] = {}
    for file in data_files(spark, path):
        header = tuple(csv_header(spark, file))
        absent = [name for name in columns if name not in header]
        if absent and header:
            raise ValueError(f"{file} has no column {', '.join(absent)}")
        if header:  # an empty file has no rows
            by_header.setdefault(header, []).append(file)
    parts = [
        spark.read.option("header", True).schema(text_schema(_unique(header))).csv(files).select(*[F.col(f"`{n}`") for n in columns])
        for header, files in sorted(by_header.items())
    ]
    if not parts:
        return spark.createDataFrame([], text_schema(list(columns)))
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part)
    return whole


def _unique(header: Sequence[str]) -> list[str]:
    """Names of a header with empty and repeated ones told apart; they are not read."""
    seen: set[str] = set()
    return [n if n and not (n in seen or seen.add(n)) else f"_unread_{place}" for place, n in enumerate(header)]


def data_files(spark: SparkSession, path: str) -> list[str]:
    """The files of a folder and the folders below it, or the file itself, without hidden ones. Only names come to the driver."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = place.getFileSystem(spark._jsc.hadoopConfiguration())
    if system.getFileStatus(place).isFile():
        return [path]
    found, waiting = [], [place]
    while waiting:
        for status in system.listStatus(waiting.pop()):
            name = status.getPath().getName()
            if name.startswith((".", "_")) and "=" not in name:
                continue
            if status.isDirectory():
                waiting.append(status.getPath())
            else:
                found.append(status.getPath().toString())
    return sorted(found)


def csv_header(spark: SparkSession, file: str) -> list[str]:
    """The names in the first line of a file, which may be compressed."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    place = jvm.org.apache.hadoop.fs.Path(file)
    stream = place.getFileSystem(conf).open(place)
    try:
        codec = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(conf).getCodec(place)
        text = jvm.java.io.InputStreamReader(codec.createInputStream(stream) if codec else stream, "UTF-8")
        line = jvm.java.io.BufferedReader(text).readLine()
    finally:
        stream.close()
    return next(csv.reader([line.lstrip("﻿")]), []) if line else []


def typed_by_content(df: DataFrame) -> DataFrame:
    """Text columns as the first type that all of their values fit, found by one aggregation over all columns."""
    names = [field.name for field in df.schema.fields if isinstance(field.dataType, T.StringType)]
    if not names:
        return df
    checks = []
    for place, name in enumerate(names):
        value = F.when(F.trim(F.col(f"`{name}`")) != "", F.trim(F.col(f"`{name}`")))
        checks.append(F.count(value).alias(f"n_{place}"))
        checks += [F.count(_fitting(value, kind)).alias(f"{kind}_{place}") for kind in INFERRED_TYPES]
    counts = df.agg(*checks).head()
    chosen = {}
    for place, name in enumerate(names):
        known = counts[f"n_{place}"]
        kind = next((k for k in INFERRED_TYPES if known and counts[f"{k}_{place}"] == known), None)
        if kind:
            chosen[name] = _fitting(F.trim(F.col(f"`{name}`")), kind)
    return df.withColumns(chosen) if chosen else df


def _fitting(value, kind: str):
    if kind in ("int", "bigint"):  # no fractions
        return F.when(value.rlike(r"^[+-]?\d+$"), value.try_cast(kind))
    if kind == "date":
        return F.when(value.rlike(r"^\d{4}-\d{1,2}-\d{1,2}$"), value.try_cast(kind))
    if kind == "boolean":
        return F.when(F.lower(value).isin("true", "false"), value.try_cast(kind))
    return value.try_cast(kind)


def calendar_months(first, last) -> list[str]:
    """Every first of month from ``first`` to ``last``, as text."""
    start, end = (datetime.date.fromisoformat(str(day)[:10]) for day in (first, last))
    numbers = range(start.year * 12 + start.month - 1, end.year * 12 + end.month)
    return [f"{number // 12:04d}-{number % 12 + 1:02d}-01" for number in numbers]


def _listed(spark: SparkSession, path: str) -> list[str]:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = place.getFileSystem(spark._jsc.hadoopConfiguration())
    return sorted(status.getPath().getName() for status in system.listStatus(place)) if system.exists(place) else []


def manifest(spark: SparkSession, path: str, back: int = 0) -> dict | None:
    """The newest manifest of a table, or an earlier one: version, months with their commits, schema and format."""
    names = [name for name in _listed(spark, f"{path}/{MANIFESTS}") if name.endswith(".json") and not name.startswith(".")]
    if len(names) <= back:
        return None
    return json.loads(spark.read.text(f"{path}/{MANIFESTS}/{names[-1 - back]}", wholetext=True).head()[0])


def write_snapshots(df: DataFrame, path: str, file_format: str = "parquet", months: list | None = None) -> None:
    """Replace the months present in ``df`` in one commit; other months of the table stay.

    ``months`` lists the months that the caller replaces: those of them without a row in ``df`` are cleared. The rebalance
    hint lets Spark size the files: a month holding much of the data is split over several tasks and small months share one.
    What neither this nor the last manifest names is deleted, so a reader of the last one can finish. Two writers at once:
    the second one raises.
    """
    commit = write_beside(df, path, file_format)
    switch(df, path, commit, file_format, months)


def write_beside(df: DataFrame, path: str, file_format: str = "parquet") -> str:
    """Write the months of ``df`` where no reader looks, and return the name of the commit."""
    commit = uuid.uuid4().hex
    df.hint("rebalance", SNAPSHOT).write.option("header", True).partitionBy(SNAPSHOT).format(file_format).save(
        f"{path}/{COMMIT}={commit}"
    )
    return commit


def switch(df: DataFrame, path: str, commit: str, file_format: str, months: list | None = None) -> None:
    """Make a written commit part of the table."""
    spark = df.sparkSession
    old = manifest(spark, path) or {"version": 0, "months": {}}
    held = _listed(spark, f"{path}/{COMMIT}={commit}")
    new = {name.split("=", 1)[1]: commit for name in held if name.startswith(f"{SNAPSHOT}=")}
    kept = {month: of for month, of in old["months"].items() if month not in {str(m)[:10] for m in months or []}}
    record = {
        "version": old["version"] + 1, "months": kept | new, "schema": df.schema.jsonValue(), "format": file_format,
    }
    _create(spark, f"{path}/{MANIFESTS}", f"{record['version']:012d}.json", json.dumps(record))
    _clear(spark, path, [record["months"], old["months"]])


def _create(spark: SparkSession, folder: str, name: str, text: str) -> None:
    """A file that appears whole or not at all, and that nobody else has created."""
    jvm = spark._jvm
    system = jvm.org.apache.hadoop.fs.Path(folder).getFileSystem(spark._jsc.hadoopConfiguration())
    draft, final = (jvm.org.apache.hadoop.fs.Path(folder, n) for n in (f".{uuid.uuid4().hex}", name))
    stream = system.create(draft, False)
    stream.write(bytearray(text.encode()))
    stream.close()
    if system.exists(final) or not system.rename(draft, final):
        system.delete(draft, False)
        raise RuntimeError(f"another job has written {folder}/{name}")


def _clear(spark: SparkSession, path: str, used: list[dict]) -> None:
    """Delete months that none of the manifests names. Commits without any named month may be in writing and stay."""
    wanted = {(of, month) for months in used for month, of in months.items()}
    for commit in {of for of, _ in wanted}:
        for name in _listed(spark, f"{path}/{COMMIT}={commit}"):
            if name.startswith(f"{SNAPSHOT}=") and (commit, name.split("=", 1)[1]) not in wanted:
                removed(spark, f"{path}/{COMMIT}={commit}/{name}")
    names = [name for name in _listed(spark, f"{path}/{MANIFESTS}") if name.endswith(".json")]
    for name in names[:-2]:
        old = json.loads(spark.read.text(f"{path}/{MANIFESTS}/{name}", wholetext=True).head()[0])["months"]
        for month, of in old.items():
            if (of, month) not in wanted:
                removed(spark, f"{path}/{COMMIT}={of}/{SNAPSHOT}={month}")
        removed(spark, f"{path}/{MANIFESTS}/{name}")


def read_snapshots(spark: SparkSession, path: str, first=None, last=None) -> DataFrame:
    """All months of a table, or those from ``first`` to ``last``; other partitions are not opened."""
    table = manifest(spark, path)
    if table is None:
        raise FileNotFoundError(f"no table in {path}")
    schema = T.StructType.fromJson(table["schema"])
    low, high = (str(day)[:10] if day is not None else None for day in (first, last))
    folders = [
        f"{path}/{COMMIT}={of}/{SNAPSHOT}={month}" for month, of in sorted(table["months"].items())
        if (low is None or month >= low) and (high is None or month <= high)
    ]
    if not folders:
        return spark.createDataFrame([], schema)
    reader = spark.read.option("basePath", path).option("header", True).schema(schema)
    df = reader.format(table["format"]).load(folders).select(*[F.col(f"`{name}`") for name in schema.names])
    if first is not None:
        df = df.where(F.col(SNAPSHOT) >= F.lit(first).cast("date"))
    if last is not None:
        df = df.where(F.col(SNAPSHOT) <= F.lit(last).cast("date"))
    return df


def read_snapshot(spark: SparkSession, path: str, month) -> DataFrame:
    """One month of a table; raises when the table has no such month."""
    df = read_snapshots(spark, path, month, month)
    if df.select(SNAPSHOT).isEmpty():
        raise FileNotFoundError(f"no snapshot {month} in {path}")
    return df
