"""SparkSession construction and the shared checkpoint location."""

from __future__ import annotations

import contextvars
import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings the jobs are designed around. On a cluster, the cluster's own
# values for memory and parallelism win; these only fill gaps.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a hot join key even when the split costs an extra shuffle: the
    # line jobs reuse the order join's partitioning, so without this a single
    # hot order_id would stay in one task.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Runtime (measured) broadcast decisions; the static estimate stays at
    # Spark's default so nothing unbounded is broadcast from plan-time guesses.
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "32MB",
    # AQE turns a sort-merge join into a hash join where every measured build
    # partition is at most this large, so the choice follows the data.
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "64MB",
    "spark.sql.session.timeZone": "UTC",
    # Checkpointed ranking inputs are removed from the shared folder once
    # their DataFrames are garbage-collected (otherwise every run leaves
    # customer/store/product-sized copies behind).
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    "spark.sql.ansi.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def cluster_conf(input_bytes: int, total_cores: int,
                 partition_bytes: int = 256 * 1024 * 1024) -> dict[str, str]:
    """Partition sizing for a large run.

    Scans are split into ``partition_bytes`` pieces; the shuffle starts with
    enough partitions that the largest shuffle (order lines, roughly a third
    of the input after column pruning) lands near ``partition_bytes`` per
    partition, at least 3 waves of the cluster's cores. AQE then coalesces
    small partitions and splits skewed ones, so the initial number only has
    to be large enough, never exact. Example: 100 TiB of input on 1000
    executors x 8 cores gives 136,534 initial shuffle partitions and 256 MiB
    scan splits.
    """
    shuffle_bytes = input_bytes // 3
    n = max(3 * total_cores, -(-shuffle_bytes // partition_bytes))
    return {
        "spark.sql.files.maxPartitionBytes": str(partition_bytes),
        "spark.sql.shuffle.partitions": str(n),
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(n),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(partition_bytes),
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(4 * partition_bytes),
    }


def build_session(master: str | None = None, app: str = "shopsight",
                  shuffle_partitions: int | None = None, extra: dict | None = None) -> SparkSession:
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    conf = dict(DEFAULT_CONF)
    if master and master.startswith("local"):
        # local mode: the driver JVM is the only executor
        conf["spark.driver.memory"] = os.environ.get("SHOPSIGHT_DRIVER_MEMORY", "8g")
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    return b.getOrCreate()


def checkpoint_dir(spark: SparkSession) -> str | None:
    """The shared checkpoint folder named by ``spark.checkpoint.dir``.

    The cluster's setting is always used when present. Only when it is unset
    on a local master (local runs and tests) a scratch folder is created and
    registered; on a cluster without the setting this raises instead of
    falling back to a machine-local folder. Under Spark Connect there is no
    SparkContext: the server's own ``spark.checkpoint.dir`` applies.
    """
    current = spark.conf.get("spark.checkpoint.dir", None)
    try:
        sc = spark.sparkContext
    except Exception:  # Spark Connect
        return current
    if current:
        sc.setCheckpointDir(current)
        return current
    if sc.getCheckpointDir():
        return sc.getCheckpointDir()
    if not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a shared folder on the cluster")
    path = tempfile.mkdtemp(prefix="shopsight-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    spark.conf.set("spark.checkpoint.dir", path)
    sc.setCheckpointDir(path)
    return path


class Scope:
    """The intermediate tables and caches of one run, and only those.

    Inside ``with Scope(spark):`` ``materialize`` writes Parquet tables into the
    scope's own folder and ``persist_derived`` caches; leaving the scope drops
    both. Scopes of other runs in the same session are not touched.
    """

    def __init__(self, spark: SparkSession) -> None:
        base = checkpoint_dir(spark)
        if base is None:
            raise RuntimeError("spark.checkpoint.dir is not set")
        self.spark = spark
        self.root = f"{base.rstrip('/')}/shopsight-run-{uuid.uuid4().hex}"
        self.persisted: list = []

    def __enter__(self) -> Scope:
        self._token = _SCOPE.set(self)
        return self

    def __exit__(self, *exc) -> None:
        _SCOPE.reset(self._token)
        while self.persisted:
            self.persisted.pop().unpersist()
        path = self.spark._jvm.org.apache.hadoop.fs.Path(self.root)
        path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


_SCOPE: contextvars.ContextVar[Scope | None] = contextvars.ContextVar("shopsight_scope", default=None)


def materialize(df):
    """``df`` computed once and kept in the shared checkpoint folder: lineage is
    cut and the rows survive lost executors.

    In a ``Scope``: a Parquet table (columnar, compressed), removed with the
    scope. Outside: ``DataFrame.checkpoint``, whose files Spark's cleaner
    removes when the DataFrame is gone (``cleanCheckpoints`` above).
    """
    scope = _SCOPE.get()
    if scope is None:
        checkpoint_dir(df.sparkSession)
        return df.checkpoint(eager=True)
    path = f"{scope.root}/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def persist_derived(df):
    """Cache an intermediate that is cheap to recompute from a materialized
    table, for the length of the scope; outside a scope nothing is cached."""
    scope = _SCOPE.get()
    if scope is None:
        return df
    from pyspark import StorageLevel

    out = df.persist(StorageLevel.MEMORY_AND_DISK)
    scope.persisted.append(out)
    return out
