"""Files by column name, months that become empty, and sessions started elsewhere."""

import gzip
import os
import subprocess
import sys
import textwrap

import pytest

from duewatch.operators.monitor import evaluation_records
from duewatch.sources import snapshots
from duewatch.sources.snapshots import (
    calendar_months, read_raw_csv, read_snapshots, switch, typed_by_content, write_beside, write_snapshots,
)


def test_csv_columns_go_by_name(spark, tmp_path):
    (tmp_path / "a.csv").write_text("snapshot_date,extra,Age,Customer_ID\n2023-01-01,x,30,c1\n")
    row = read_raw_csv(spark, str(tmp_path / "a.csv"), ["Customer_ID", "Age", "snapshot_date"]).head()
    assert tuple(row) == ("c1", "30", "2023-01-01")


def test_each_csv_file_has_its_own_header(spark, tmp_path):
    (tmp_path / "a.csv").write_text("Customer_ID,Age,snapshot_date\nC1,30,2023-01-01\n")
    (tmp_path / "b.csv").write_text("snapshot_date,Customer_ID,Age,more,more\n2023-02-01,C2,40,x,y\n")
    (tmp_path / "c.csv").write_text("")
    with gzip.open(tmp_path / "d.csv.gz", "wt") as file:
        file.write('Age,"snapshot_date",Customer_ID\n"5,0",2023-03-01,C3\n')
    columns = ["Customer_ID", "Age", "snapshot_date"]
    found = sorted(map(tuple, read_raw_csv(spark, str(tmp_path), columns).collect()))
    assert found == [("C1", "30", "2023-01-01"), ("C2", "40", "2023-02-01"), ("C3", "5,0", "2023-03-01")]
    (tmp_path / "e.csv").write_text("Customer_ID,snapshot_date\nC4,2023-04-01\n")
    with pytest.raises(ValueError, match="Age"):
        read_raw_csv(spark, str(tmp_path), columns)


def test_types_of_text_columns(spark):
    rows = [("1", "1", "1.5", "2023-01-01", "true", "x", None, "2023-01-01 10:00:00"),
            (" 2 ", "99999999999", "2", "2023-02-01", "FALSE", "1", None, "2023-01-02 11:00:00"), (None,) * 8, ("",) * 8]
    frame = spark.createDataFrame(rows, ", ".join(f"`c.{n}` string" for n in range(8)))
    typed = typed_by_content(frame)
    assert [kind for _, kind in typed.dtypes] == ["int", "bigint", "double", "date", "boolean", "string", "string", "timestamp"]
    assert [row[0] for row in typed.collect()] == [1, 2, None, None]
    assert typed_by_content(frame.limit(0)).dtypes == frame.dtypes


def three_months(spark):
    frame = spark.createDataFrame([(1, "2023-01-01"), (2, "2023-02-01"), (3, "2023-03-01")], "v int, d string")
    return frame.selectExpr("v", "to_date(d) as snapshot_date")


def test_months_change_in_one_commit(spark, tmp_path):
    path, months = str(tmp_path / "table"), calendar_months("2023-01-01", "2023-03-01")
    frame = three_months(spark)
    write_snapshots(frame, path, months=months)
    before = read_snapshots(spark, path)
    later = frame.selectExpr("v * 10 as v", "snapshot_date").where("v < 30")
    commit = write_beside(later, path)  # the job is lost here
    assert sorted(row.v for row in read_snapshots(spark, path).collect()) == [1, 2, 3]
    switch(later, path, commit, "parquet", months)
    assert sorted(row.v for row in read_snapshots(spark, path).collect()) == [10, 20]
    assert sorted(row.v for row in before.collect()) == [1, 2, 3]  # a reader that began earlier
    for factor in (2, 3):
        write_snapshots(frame.selectExpr(f"v * {factor} as v", "snapshot_date"), path, months=months)
    assert sorted(row.v for row in read_snapshots(spark, path, "2023-02-01").collect()) == [6, 9]
    files = [str(f) for f in (tmp_path / "table").rglob("*.parquet")]
    assert len(files) == 6  # this commit and the last one


def test_two_writers(spark, tmp_path, monkeypatch):
    path, frame = str(tmp_path / "table"), three_months(spark)
    write_snapshots(frame, path)
    stale = snapshots.manifest(spark, path)
    write_snapshots(frame, path)
    monkeypatch.setattr(snapshots, "manifest", lambda *_: stale)
    with pytest.raises(RuntimeError, match="another job"):
        write_snapshots(frame, path)


def test_tables_without_rows(spark, tmp_path):
    path, frame = str(tmp_path / "table"), three_months(spark)
    with pytest.raises(FileNotFoundError):
        read_snapshots(spark, path)
    write_snapshots(frame.limit(0), path)
    assert read_snapshots(spark, path).dtypes == frame.dtypes and read_snapshots(spark, path).isEmpty()


def test_listed_months_without_rows_are_cleared(spark, tmp_path):
    path = str(tmp_path / "table")
    frame = three_months(spark)
    write_snapshots(frame, path, months=calendar_months("2023-01-01", "2023-03-01"))
    write_snapshots(frame.where("v = 1"), path, months=calendar_months("2023-01-01", "2023-02-28"))
    assert sorted(row.v for row in read_snapshots(spark, path).collect()) == [1, 3]


def test_months_cross_years():
    assert calendar_months("2022-11-15", "2023-02-01") == ["2022-11-01", "2022-12-01", "2023-01-01", "2023-02-01"]


def test_months_without_scored_labels_are_recorded(spark):
    matched = spark.createDataFrame(
        [("2024-10-01", 0, 0.2), ("2024-10-01", 1, 0.7)], "snapshot_date string, label int, default_probability double"
    )
    unmatched = spark.createDataFrame([("2024-11-01", 1)], "snapshot_date string, unmatched long")
    found = {r.snapshot_date: (r.records, r.auc, r.unmatched) for r in evaluation_records(matched, unmatched, 30, 6).collect()}
    assert found == {"2024-10-01": (2, 1.0, 0), "2024-11-01": (0, None, 1)}


def test_python_functions_run_from_another_folder(tmp_path):
    code = """
        import sys
        sys.path.insert(0, sys.argv[1])
        from duewatch.session import build_session
        from duewatch.operators.drift import chi2_test
        spark = build_session("away", "local[2]")
        rows = [(i % 2 == 0, "ab"[i % 3 == 0]) for i in range(60)]
        print("P", chi2_test(spark.createDataFrame(rows, "s boolean, c string"), "s", ["c"]).head()["p_value"])
    """
    repo = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    run = subprocess.run(
        [sys.executable, "-c", textwrap.dedent(code), repo], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=200
    )
    assert "\nP " in "\n" + run.stdout, run.stderr[-1500:]
