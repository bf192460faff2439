"""Versioned datasets: a write that dies leaves the version before; audit rows once a run."""

import datetime as dt
import json
import os
import tempfile

import pytest
from pyspark.sql import functions as F

from shopsight import published, sinks
from shopsight.published import Folder, append_once, current, publish, read_table, vacuum
from shopsight.sinks import document_parts, refresh_files, refresh_rows, write_document, write_table


@pytest.fixture
def root():
    return os.path.join(tempfile.mkdtemp(prefix="shopsight-published-"), "t")


def _ids(df):
    return sorted(r[0] for r in df.collect())


def test_versions(spark, root):
    for n in (3, 5, 8):
        assert write_table(spark.range(n), root, "t") == (n, "SUCCESS")
        assert _ids(read_table(spark, root)) == list(range(n))
    assert current(spark, root)["rows"] == 8 and current(spark, root)["version"] == 3
    # the version before is kept for readers that have begun, older ones go
    assert read_table(spark, root, version=2).count() == 5
    assert len([n for n in os.listdir(root) if n.startswith("data-")]) == published.KEPT
    with pytest.raises(FileNotFoundError, match="no version 1"):
        read_table(spark, root, version=1)
    with pytest.raises(FileNotFoundError, match="no version"):
        read_table(spark, root + "-none")


def test_a_write_that_dies_changes_nothing(spark, root, monkeypatch):
    write_table(spark.range(4), root, "t")
    before = _ids(read_table(spark, root))
    # in the middle of the rows
    broken = spark.range(100).select(F.when(F.col("id") < 90, F.col("id")).otherwise(F.raise_error(F.lit("killed"))).alias("id"))
    with pytest.raises(Exception, match="killed"):
        write_table(broken, root, "t")
    assert _ids(read_table(spark, root)) == before

    # after the rows, before the switch
    def dies(self, old, new):
        raise KeyboardInterrupt

    with monkeypatch.context() as m:
        m.setattr(Folder, "rename_new", dies)
        with pytest.raises(KeyboardInterrupt):
            write_table(spark.range(9), root, "t")
    assert _ids(read_table(spark, root)) == before and current(spark, root)["version"] == 1

    # folders of dead jobs go when they are old; a reader's version stays
    assert vacuum(spark, root) == []
    assert len(vacuum(spark, root, older_than_seconds=-60)) >= 1 and _ids(read_table(spark, root)) == before
    assert write_table(spark.range(6), root, "t")[0] == 6 and read_table(spark, root).count() == 6


def test_two_writers_take_two_numbers(spark, root):
    def slow(folder):
        """Another job publishes while this one writes."""
        write_table(spark.range(2), root, "fast")
        spark.range(7).write.parquet(folder)
        return {"rows": 7}

    write_table(spark.range(1), root, "first")
    assert publish(spark, root, slow)["version"] == 3
    assert read_table(spark, root, version=2).count() == 2 and read_table(spark, root).count() == 7


def test_a_taken_number_is_passed_over(spark, root, monkeypatch):
    """The rename decides: a writer that saw the same last version goes on to the next."""
    write_table(spark.range(1), root, "first")
    numbers = published._numbers
    monkeypatch.setattr(published, "_numbers", lambda folder, calls=[]: (calls.append(1), numbers(folder))[1] if calls else (
        calls.append(1), [])[1])
    assert publish(spark, root, lambda p: (spark.range(3).write.parquet(p), {"rows": 3})[1])["version"] == 2
    monkeypatch.undo()
    assert read_table(spark, root).count() == 3 and read_table(spark, root, version=1).count() == 1


def test_partitioned_table(spark, root):
    df = spark.range(10).select("id", (F.col("id") % 3).cast("string").alias("metric"))
    write_table(df, root, "mart", ("metric",))
    assert read_table(spark, root).where("metric = '1'").count() == 3


AT = dt.datetime(2020, 5, 6, 7, 8, 9, tzinfo=dt.timezone.utc)


def _document(spark, path):
    return json.loads("".join(open(p.removeprefix("file:")).read() for p in document_parts(spark, path)))


@pytest.mark.parametrize("bounded", [True, False])
def test_documents_are_replaced_whole(spark, root, bounded):
    payload = spark.range(20).select("id", F.lit("x,y[").alias("name")).orderBy(F.col("id").desc())
    path = f"{root}/data/p.json"
    assert write_document(payload.where("id < 5").orderBy("id"), False, path, AT, bounded) == 5
    assert write_document(payload, False, path, AT, bounded) == 20
    doc = _document(spark, path)
    assert [x["id"] for x in doc["data"]] == list(range(19, -1, -1)) and doc["generated_at"].startswith("2020-05-06T07:08:09")
    broken = payload.select(F.when(F.col("id") < 90, F.raise_error(F.lit("killed"))).cast("long").alias("id"))
    with pytest.raises(Exception, match="killed"):
        write_document(broken, False, path, AT, bounded)
    assert _document(spark, path) == doc
    assert not [n for n in os.listdir(f"{root}/data") if "staging" in n]
    # readers that check sums find no sum of an older file
    assert spark.read.text(document_parts(spark, path)).count() >= 1


@pytest.mark.parametrize(("rows", "single", "bounded"), [(0, False, True), (0, False, False), (1, True, True), (1, False, True),
                                                         (7, False, True), (1, False, False), (7, False, False)])
def test_refresh_rows_are_read_back(spark, root, rows, single, bounded):
    path = f"{root}/d.json"
    write_document(spark.range(rows).select("id", F.lit("[{,{").alias("s")), single, path, AT, bounded)
    files = refresh_files(spark, document_parts(spark, path), "d.json", "run")
    (row,) = refresh_rows(files, AT).collect()
    size = sum(os.path.getsize(p.removeprefix("file:")) for p in document_parts(spark, path))
    assert row.record_count == rows and row.refreshed_at == dt.datetime(2020, 5, 6, 7, 8, 9)
    assert abs(float(row.file_size_kb) - size / 1024) <= 0.005 and sum(r.file_size_bytes for r in files.collect()) == size
    assert files.count() == len(document_parts(spark, path))


def test_sizes_beyond_ten_digits(spark):
    """95 GB no longer end DECIMAL(10,2); the largest BIGINT fits."""
    files = spark.createDataFrame([("r", "f", "a", 1, (1 << 63) - 1), ("r", "f", "b", 2, 96 << 30)],
                                  "refresh_id string, data_file string, file_name string, record_count long, file_size_bytes long")
    (row,) = refresh_rows(files, AT).collect()
    assert row.record_count == 3 and int(row.file_size_kb * 100) == (((1 << 63) - 1 + (96 << 30)) * 200 + 1024) // 2048


def test_append_once(spark, root):
    assert append_once(spark, root, "a", spark.range(3))
    assert not append_once(spark, root, "a", spark.range(5))
    assert append_once(spark, root, "b", spark.range(2))
    with pytest.raises(Exception, match="killed"):
        append_once(spark, root, "c", spark.range(9).select(F.raise_error(F.lit("killed"))))
    assert sorted(tuple(r) for r in spark.read.parquet(root).groupBy("run_id").count().collect()) == [("a", 3), ("b", 2)]
    assert sorted(os.listdir(root)) == ["run_id=a", "run_id=b"]


def test_a_replayed_run_adds_no_rows(spark, root):
    write_document(spark.range(4), False, f"{root}/d.json", AT, False)
    for ms in (1, 2):
        audit = sinks.AuditLog(spark, run_id="night-7")
        audit.timed("k", lambda ms=ms: (ms, "SUCCESS"))
        audit.refreshed(f"{root}/d.json", "d.json")
        audit.close()
        audit.append(f"{root}/analytics", AT)
    log = spark.read.parquet(f"{root}/analytics/execution_log")
    assert [r.rows_returned for r in log.where("kpi_name = 'k'").collect()] == [1] and log.count() == 2
    assert log.select("log_id").distinct().count() == 2
    hist = spark.read.parquet(f"{root}/analytics/refresh_history").collect()
    assert len(hist) == 1 and hist[0].record_count == 4
    files = spark.read.parquet(f"{root}/analytics/refresh_files")
    assert {r.refresh_id for r in files.collect()} == {hist[0].refresh_id}
