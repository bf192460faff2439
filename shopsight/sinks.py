"""Sinks: KPI tables (Parquet), export documents (JSON), and the audit logs.

Tables and documents in parts are versioned datasets (``published.py``): a write
that dies leaves the version before in place. A document of one file replaces
its file by a rename.

Audit rows follow the governance table layouts:
  execution_log  (log_id, kpi_name, executed_at, execution_time_ms, rows_returned, status, error_message)
  refresh_history(refresh_id, data_file, refreshed_at, record_count, file_size_kb)
  refresh_files  (refresh_id, data_file, file_name, record_count, file_size_bytes): the files of a refresh
Identity columns become ids made of the run's, so a replayed run has the same
ones; the tables are append-only Parquet with a folder a run.
"""

from __future__ import annotations

import datetime as dt
import time
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F

from shopsight import published
from shopsight.plans.exports import document, document_lines

EXECUTION_LOG_SCHEMA = (
    "log_id STRING, kpi_name STRING, executed_at TIMESTAMP_NTZ, execution_time_ms INT, "
    "rows_returned BIGINT, status STRING, error_message STRING"
)
#: Kilobytes of any BIGINT number of bytes; DECIMAL(10,2) ends at 95 GB.
FILE_SIZE_KB = "DECIMAL(18,2)"
STATUSES = ("SUCCESS", "FAILED", "PARTIAL")


def utc_now() -> dt.datetime:
    """Aware, so that no step takes it for the host's local time."""
    return dt.datetime.now(dt.timezone.utc)


def _wall_clock(at: dt.datetime):
    """A UTC wall-clock literal (TIMESTAMP_NTZ), whatever the session's zone."""
    return F.lit(at.astimezone(dt.timezone.utc).replace(tzinfo=None).isoformat(sep=" ")).cast("timestamp_ntz")


def write_table(df: DataFrame, path: str | None, name: str, partition_by: tuple[str, ...] = (),
                verify: Callable[[], None] | None = None) -> tuple[int, str]:
    """Publish ``df`` as the current version of ``path`` (or run it into the
    ``noop`` sink when ``path`` is None); ``published.read_table`` reads it.

    The row count is observed during the write (``DataFrame.observe``), not
    by a second ``count()`` pass, and is kept in the version's manifest. ``verify``
    is called between the write and the switch, and may raise.
    """
    obs = Observation(f"rows_{name}")
    observed = df.observe(obs, F.count(F.lit(1)).alias("rows"))
    if path is None:
        observed.write.format("noop").mode("overwrite").save()
        rows = int(obs.get["rows"])
        if verify:
            verify()
        return rows, "SUCCESS"

    def write(folder: str) -> dict:
        observed.write.partitionBy(*partition_by).parquet(folder)
        rows = int(obs.get["rows"])
        if verify:
            verify()
        return {"name": name, "rows": rows}

    return published.publish(df.sparkSession, path, write)["rows"], "SUCCESS"


def write_document(payload: DataFrame, single: bool, path: str | None,
                   generated_at: dt.datetime, bounded: bool = True) -> int:
    """Write an export; returns its number of elements.

    A bounded payload (one object, months, segments, top n) becomes one
    ``{generated_at, data}`` JSON document in one file. A payload with a row per
    entity becomes a versioned dataset of that name whose parts, joined in name
    order, are the same kind of document (``document_text``); many tasks write
    them, in the same way for ten entities as for ten million.
    """
    spark = payload.sparkSession
    obs = Observation("payload_rows")
    counted = payload.observe(obs, F.count(F.lit(1)).alias("rows"))
    at = F.lit(generated_at)
    doc = document(counted, single, generated_at=at) if bounded else document_lines(counted, generated_at=at)
    if path is None:
        doc.write.format("noop").mode("overwrite").save()
    elif bounded:
        parent, name = path.rsplit("/", 1)
        staging = f"_staging-{uuid.uuid4().hex}"
        folder = published.Folder(spark, parent)
        try:
            doc.coalesce(1).write.text(f"{parent}/{staging}")
            (part,) = [n for n in folder.names(staging) if n.startswith("part-")]
            folder.replace(f"{staging}/{part}", name)
        finally:
            folder.delete(staging)
    else:
        def write(folder: str) -> dict:
            doc.write.text(folder)
            return {"name": path.rsplit("/", 1)[-1], "rows": int(obs.get["rows"])}

        published.publish(spark, path, write)
    return int(obs.get["rows"])


def document_parts(spark: SparkSession, path: str) -> list[str]:
    """The files of a document in order: one, or the parts of its current version."""
    folder = published.Folder(spark, path)
    if published.VERSIONS not in folder.names():
        return [path]
    name = published.current(spark, path)["folder"]
    return [f"{path}/{name}/{n}" for n in sorted(folder.names(name)) if n.startswith("part-")]


def _elements(line: Column) -> Column:
    """The elements of a document in one of its lines: a whole document has
    those of its data (an object is one, null none), a part's line has one
    after ``[`` or a comma."""
    data = F.get_json_object(line, "$.data")
    whole = F.coalesce(F.json_array_length(data), F.when(data.isNotNull(), 1), F.lit(0))
    return F.when(line.startswith("{") & line.endswith("}"), whole).otherwise(
        F.when(line.startswith("[{") | line.startswith(",{"), 1).otherwise(0))


def refresh_files(spark: SparkSession, path: str | list[str], data_file: str, run_id: str) -> DataFrame:
    """One row a file of a written document: records and bytes, read back."""
    path = path if isinstance(path, list) else [path]
    name = lambda c: F.substring_index(F.col(c), "/", -1)
    lines = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("file"))
    records = lines.groupBy(name("file").alias("file_name")).agg(F.sum(_elements(F.col("value"))).alias("n"))
    # the binaryFile source reads file contents only when asked; files without rows are listed, too
    files = spark.read.format("binaryFile").load(path).select(name("path").alias("file_name"), "length")
    return files.join(records, "file_name", "left").select(
        F.lit(refresh_id(run_id, data_file)).alias("refresh_id"), F.lit(data_file).alias("data_file"), "file_name",
        F.coalesce(F.col("n"), F.lit(0)).cast("long").alias("record_count"), F.col("length").alias("file_size_bytes"))


def refresh_id(run_id: str, data_file: str) -> str:
    """The same for every replay of a run."""
    return str(uuid.uuid5(uuid.NAMESPACE_URL, f"{run_id}/{data_file}"))


def refresh_rows(files: DataFrame, refreshed_at: dt.datetime) -> DataFrame:
    """refresh_history rows of ``refresh_files``: one a document."""
    size = F.sum(F.col("file_size_bytes").cast("decimal(19,0)"))
    return files.groupBy("refresh_id", "data_file").agg(
        F.sum("record_count").alias("record_count"), (size / F.lit(1024)).cast(FILE_SIZE_KB).alias("file_size_kb")).select(
        "refresh_id", "data_file", _wall_clock(refreshed_at).alias("refreshed_at"), "record_count", "file_size_kb")


class AuditLog:
    """Collects a run's audit rows and appends them at the end. A run that is
    replayed under its ``run_id`` adds no rows to those that it has."""

    def __init__(self, spark: SparkSession, run_id: str | None = None):
        self.spark = spark
        self.run_id = run_id or uuid.uuid4().hex
        self.rows: list[tuple] = []
        self.files: list[DataFrame] = []

    def refreshed(self, path: str, data_file: str) -> None:
        """Note that ``data_file`` was written to ``path``."""
        self.files.append(refresh_files(self.spark, document_parts(self.spark, path), data_file, self.run_id))

    def timed(self, kpi_name: str, fn):
        start, t0 = utc_now().replace(tzinfo=None), time.perf_counter()
        try:
            rows, status = fn()
            err = None
        except Exception as e:  # recorded, then re-raised by the caller's policy
            rows, status, err = None, "FAILED", f"{type(e).__name__}: {e}"[:4000]
        ms = int((time.perf_counter() - t0) * 1000)
        self.rows.append((self._log_id(), kpi_name, start, ms, rows, status, err))
        return status, err

    def close(self, name: str = "run_all") -> str:
        """Add the run's own row: SUCCESS, PARTIAL if some jobs failed, FAILED if all did."""
        failed = sum(r[5] != "SUCCESS" for r in self.rows)
        status = "SUCCESS" if not failed else "FAILED" if failed == len(self.rows) else "PARTIAL"
        start = min((r[2] for r in self.rows), default=utc_now().replace(tzinfo=None))
        ms = sum(r[3] for r in self.rows)
        note = f"{failed} of {len(self.rows)} jobs failed" if failed else None
        self.rows.append((self._log_id(), name, start, ms, None, status, note))
        return status

    def _log_id(self) -> str:
        return refresh_id(self.run_id, f"log/{len(self.rows)}")

    def execution_log(self) -> DataFrame:
        return self.spark.createDataFrame(self.rows, EXECUTION_LOG_SCHEMA)

    def append(self, root: str, refreshed_at: dt.datetime | None = None) -> None:
        published.append_once(self.spark, f"{root}/execution_log", self.run_id, self.execution_log())
        if not self.files:
            return
        files = self.files[0]
        for f in self.files[1:]:
            files = files.unionByName(f)
        published.append_once(self.spark, f"{root}/refresh_files", self.run_id, files)
        # the files may have been replaced since; the history is made of the rows on record
        kept = self.spark.read.parquet(f"{root}/refresh_files/run_id={self.run_id}")
        published.append_once(self.spark, f"{root}/refresh_history", self.run_id, refresh_rows(kept, refreshed_at or utc_now()))
