"""Versions of tables: what readers see while a table is replaced, and after a write that fails."""

from __future__ import annotations

import os
import threading

import pytest
from pyspark.sql import functions as F

from cartmill.sources import tables


def numbers(spark, n, start=0):
    return spark.range(start, start + n, 1, 2).withColumn("half", F.col("id") / 2)


def failing(spark, n):
    """Some rows are written before one fails."""
    return numbers(spark, n).withColumn("half", F.when(F.col("id") == n - 1, F.raise_error(F.lit("broken row"))).otherwise(F.col("half")))


def ids(df):
    return sorted(r["id"] for r in df.collect())


def test_failed_write_leaves_the_old_rows(spark, tmp_path):
    path = str(tmp_path / "t")
    tables.write_table(numbers(spark, 3), path)
    with pytest.raises(Exception, match="broken row"):
        tables.write_table(failing(spark, 100), path)
    assert ids(tables.read_table(spark, path)) == [0, 1, 2]
    assert tables.Versions(spark, path).numbers() == [1]


def test_readers_of_the_old_version_finish(spark, tmp_path):
    path = str(tmp_path / "t")
    before = tables.write_table(numbers(spark, 3), path)
    after = tables.write_table(numbers(spark, 2, 10), path)
    assert (ids(before), ids(after), ids(tables.read_table(spark, path))) == ([0, 1, 2], [10, 11], [10, 11])
    assert ids(tables.read_table(spark, path, version=1)) == [0, 1, 2]


def test_old_versions_go(spark, tmp_path):
    path = str(tmp_path / "t")
    for i in range(5):
        tables.write_table(numbers(spark, 1, i), path, keep=2)
    versions = tables.Versions(spark, path)
    assert versions.numbers() == [4, 5]
    assert sum(n.startswith("snapshot-") for n in os.listdir(path)) == 2
    assert ids(tables.read_table(spark, path, version=4)) == [3]


def test_rows_of_failed_writes_go_after_a_while(spark, tmp_path):
    path = str(tmp_path / "t")
    tables.write_table(numbers(spark, 1), path)
    with pytest.raises(Exception, match="broken row"):
        tables.write_table(failing(spark, 5), path)
    versions = tables.Versions(spark, path)
    versions.drop_old(2)
    assert sum(n.startswith("snapshot-") for n in os.listdir(path)) == 2
    versions.drop_old(2, orphans_after_hours=-1)
    assert sum(n.startswith("snapshot-") for n in os.listdir(path)) == 1
    assert ids(tables.read_table(spark, path)) == [0]


def test_torn_manifest_counts_for_nothing(spark, tmp_path):
    path = tmp_path / "t"
    tables.write_table(numbers(spark, 2), str(path))
    (path / "_versions" / "000000002.json").write_text('{"snapshot": "snap')
    assert ids(tables.read_table(spark, str(path))) == [0, 1]
    assert ids(tables.write_table(numbers(spark, 1, 7), str(path))) == [7]
    assert tables.Versions(spark, str(path)).numbers()[-1] == 3


def test_two_writers_at_once(spark, tmp_path):
    path, versions = str(tmp_path / "t"), []

    def write(i):
        versions.append(ids(tables.write_table(numbers(spark, 1, i), path, keep=10)))

    threads = [threading.Thread(target=write, args=(i,)) for i in range(4)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert tables.Versions(spark, path).numbers() == [1, 2, 3, 4]
    assert sorted(ids(tables.read_table(spark, path, n))[0] for n in range(1, 5)) == [0, 1, 2, 3]


def test_partitions_and_column_order(spark, tmp_path):
    path = str(tmp_path / "t")
    dated = numbers(spark, 6).select(F.date_add(F.lit("2020-01-01").cast("date"), (F.col("id") % 2).cast("int")).alias("day"), "id")
    stored = tables.write_table(dated, path, ["day"])
    assert stored.dtypes == [("day", "date"), ("id", "bigint")] and stored.count() == 6
    plan = stored.filter("day = date'2020-01-02'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(day" in plan


def test_missing_table(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        tables.read_table(spark, str(tmp_path / "none"))


def test_measures_of_the_pass_that_writes(spark, tmp_path):
    measures = {"rows": F.count("*"), "odd": F.count_if(F.col("id") % 2 == 1), "most": F.max("half")}
    stored, seen = tables.write_measured(numbers(spark, 9), str(tmp_path / "t"), measures)
    assert seen == {"rows": 9, "odd": 4, "most": 4.0} and stored.count() == 9
    _, seen = tables.write_measured(numbers(spark, 9), str(tmp_path / "p"), measures, ["half"])
    assert seen["rows"] == 9


def test_saved_table_stays_when_a_write_fails(spark):
    tables.save_table(numbers(spark, 4), "kept_rows", ["id"], 2)
    with pytest.raises(Exception, match="broken row"):
        tables.save_table(failing(spark, 50), "kept_rows", ["id"], 2)
    assert ids(spark.table("kept_rows")) == [0, 1, 2, 3]
    assert not [t.name for t in spark.catalog.listTables() if t.name.startswith("kept_rows__")]
    tables.save_table(numbers(spark, 2, 5), "kept_rows", ["id"], 2)
    assert ids(spark.table("kept_rows")) == [5, 6]
    spark.sql("DROP TABLE kept_rows")
