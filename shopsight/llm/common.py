"""Helpers shared by the corpus operators: columns, checkpoints, Arrow batches."""

from __future__ import annotations

import ctypes
import gc
import sys
import tempfile
import zipfile
from collections.abc import Callable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Bytes of text that a task turns into numpy arrays at a time; a longer text
#: is taken alone. The arrays need about 60 times this.
SLICE_BYTES = 1 << 18


def col(name: str) -> Column:
    """A column by its literal name (dots and spaces included)."""
    return F.col("`" + name.replace("`", "``") + "`")


def fresh(df: DataFrame, name: str) -> str:
    """``name``, with underscores added until no column of ``df`` has it."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def require_checkpoint_dir(spark: SparkSession) -> None:
    """Use the shared folder of ``spark.checkpoint.dir``; only a local master,
    where driver and tasks share one disk, may fall back to a folder of its own."""
    sc = spark.sparkContext
    if sc.getCheckpointDir() is not None:
        return
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder is None:
        if not sc.master.startswith("local[") and sc.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="checkpoint-")
    sc.setCheckpointDir(folder)


def cut(df: DataFrame) -> DataFrame:
    """``df`` computed once and kept in the shared checkpoint folder, so that a
    lost executor costs a reread and several readers cost no second pass."""
    require_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def sweep(spark: SparkSession) -> None:
    """Let Spark's cleaner delete the shuffle files and checkpoints that no
    DataFrame refers to any more; it does so when the driver collects garbage."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


ARROW_BYTES = "8m"

#: A side of a join with at most so many narrow rows (under 100 bytes each, 20 MB
#: in all) is sent to all executors; a larger one is shuffled.
BROADCAST_ROWS = 200_000


def small_side(df: DataFrame, limit: int = BROADCAST_ROWS) -> DataFrame:
    """``df`` (checkpointed, narrow rows), to be broadcast if its row count,
    which is taken here, is within ``limit``. Either way gives the same rows."""
    return F.broadcast(df) if df.count() <= limit else df


def trimmed(run: Callable) -> Callable:
    """``run``, a task's generator of batches, that gives memory back at its end:
    a Python worker lives on for the tasks after, and would keep its largest size."""

    def all_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(batches)
        pa.default_memory_pool().release_unused()
        if sys.platform == "linux":
            ctypes.CDLL(None).malloc_trim(0)

    return all_of


def map_rows(df: DataFrame, arrays: Callable[[pa.RecordBatch], list[pa.Array]], added: list[T.StructField],
             dropped: int = 0) -> DataFrame:
    """``df`` without its last ``dropped`` columns and with ``added`` ones, which
    ``arrays`` makes of each batch. Columns are passed by place under plain
    names, so names with dots are fine."""
    kept = df.schema.fields[: len(df.columns) - dropped]
    names = [f"_{i}" for i in range(len(kept) + len(added))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([*b.columns[: len(kept)], *arrays(b)], names=names)

    schema = T.StructType([T.StructField(n, f.dataType) for n, f in zip(names, [*kept, *added], strict=True)])
    out = df.toDF(*(f"_{i}" for i in range(len(df.columns)))).mapInArrow(trimmed(run), schema)
    return out.toDF(*(f.name for f in [*kept, *added]))


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a string column and its n + 1 offsets; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    if len(column) == 0 or offsets is None:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    off = np.frombuffer(offsets, np.int64 if wide else np.int32)
    off = off[column.offset : column.offset + len(column) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[off[0] : off[-1]], off - off[0]


def slices(offsets: np.ndarray, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of at most ``limit`` bytes each (one row may be longer)."""
    n, at = len(offsets) - 1, 0
    while at < n:
        end = int(np.searchsorted(offsets, offsets[at] + limit, "right")) - 1
        end = min(max(end, at + 1), n)
        yield at, end
        at = end


def ship(spark: SparkSession) -> None:
    """Give the executors this package's sources, once a session, and bound the
    bytes of an Arrow batch: a task holds a few batches of long texts at a time."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", ARROW_BYTES)
    sc = spark.sparkContext
    if getattr(sc, "_shopsight_shipped", False):
        return
    root = Path(__file__).resolve().parents[1]
    archive = Path(tempfile.mkdtemp(prefix="shopsight-")) / "shopsight_src.zip"
    with zipfile.ZipFile(archive, "w") as z:
        for p in sorted(root.rglob("*.py")):
            z.write(p, p.relative_to(root.parent))
    sc.addPyFile(str(archive))
    sc._shopsight_shipped = True


#: 64-bit words of a bit table: 16 MB whatever the input.
TABLE_BITS = 21


def bit_table(often: DataFrame, hashed: str) -> np.ndarray:
    """A table of fixed size with a bit for each 64-bit hash of a column. Spark
    forms its words, so the driver takes 2**TABLE_BITS rows at most."""
    bit = F.expr(f"shiftleft(1L, cast(`{hashed}` & 63 as int))")
    word = F.shiftrightunsigned(hashed, 6).bitwiseAND((1 << TABLE_BITS) - 1)
    found = often.groupBy(word.alias("word")).agg(F.bit_or(bit).alias("bits")).toArrow()
    table = np.zeros(1 << TABLE_BITS, np.uint64)
    table[found.column("word").to_numpy()] = found.column("bits").to_numpy().view(np.uint64)
    return table


def in_table(table: np.ndarray, hashed: np.ndarray) -> np.ndarray:
    """Which hashes may be among those of ``bit_table``: all that are, and few others."""
    word = table[(hashed >> np.uint64(6)) & np.uint64((1 << TABLE_BITS) - 1)]
    return (word >> (hashed & np.uint64(63)) & np.uint64(1)).astype(bool)
