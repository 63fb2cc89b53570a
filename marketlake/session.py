"""Session helpers.

Library code never creates a session: every operator takes DataFrames (or a session the
caller owns). These helpers exist for tests, the bench and local runs only.
"""

from __future__ import annotations

import os
import tempfile
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "marketlake") -> SparkSession:
    """A local session tuned for small scale factors (tests, bench)."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("MARKETLAKE_DRIVER_MEMORY", "8g"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the cluster's shared checkpoint folder (``spark.checkpoint.dir``).

    On a cluster the setting names shared storage and is used as-is; without it this raises, since a
    machine-local folder would split a table over the executors' disks. Only a single-JVM session
    (``local[...]``: tests, bench) gets a scratch folder of its own.
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        if not (spark.sparkContext.master + "[").startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        d = tempfile.mkdtemp(prefix="marketlake-ckpt-")
        try:
            spark.conf.set("spark.checkpoint.dir", d)
        except Exception:  # noqa: BLE001 - some deployments forbid runtime changes of core confs
            pass
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(d)
    return spark.conf.get("spark.checkpoint.dir", None) or d


def shared_scratch(spark: SparkSession, name: str) -> str:
    """A folder under the shared checkpoint location for materialised intermediate tables."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/marketlake/{name}"


FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_freed(spark: SparkSession):
    """A write's shuffle files go as soon as the write is over: nobody reads that plan again."""
    before = spark.conf.get(FREE_SHUFFLES, "false")
    spark.conf.set(FREE_SHUFFLES, "true")
    try:
        yield
    finally:
        spark.conf.set(FREE_SHUFFLES, before)


def materialize(df, name: str):
    """Write ``df`` once as a Parquet table under the shared checkpoint folder and read it back.

    This cuts lineage like ``checkpoint()`` but computes the input only once (a reliable RDD
    checkpoint of an unpersisted plan runs the plan twice: once for the action, once to save).
    The folder is on the cluster's shared storage, so a lost executor never loses the table.
    Follow-up checks (a loop's convergence count) read the small written table, not the lineage."""
    import uuid

    spark = df.sparkSession
    path = shared_scratch(spark, f"tables/{name}-{uuid.uuid4().hex}")
    with shuffles_freed(spark):
        df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def discard(df) -> None:
    """Delete the files of a table made by :func:`materialize` that nothing reads any more."""
    spark = df.sparkSession
    for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


STORED_PER_TASK = 2 << 20  # bytes of stored input: some 100,000 narrow rows, sorted by several operators at once
_UNKNOWN = 1 << 60  # what Spark takes for the size of a table that it can't tell


def parts_for(*dfs: DataFrame) -> int:
    """How many tasks to deal ``dfs`` into when several sorts and hash tables meet in each: the session's shuffle
    partitions, or more if the files that they are read from have more than ``STORED_PER_TASK`` bytes for each.

    So a task's rows, and with them its memory, stay the same however large the tables are."""
    scans = [_listed(df._jdf.queryExecution().optimizedPlan().collectLeaves()) for df in dfs]
    stored = sum(size for leaves in scans for leaf in leaves if (size := int(str(leaf.stats().sizeInBytes()))) < _UNKNOWN)
    return max(int(dfs[0].sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-stored // STORED_PER_TASK))


def _listed(leaves) -> list:
    return [leaves.apply(i) for i in range(leaves.size())]


def scale_conf(input_bytes: int, cores: int, target_partition_bytes: int = 256 << 20) -> dict[str, str]:
    """Session settings for a job reading ``input_bytes`` on ``cores`` executor cores.

    Library code never sets these (the caller owns the session); this is the recommendation the
    README describes: enough initial shuffle partitions that each holds about
    ``target_partition_bytes`` before AQE coalesces them (at least 2 per core), scan splits of the
    same size, AQE with skew-join splitting, and the broadcast threshold left at its default so only
    genuinely small sides are broadcast."""
    parts = max(2 * cores, -(-input_bytes // target_partition_bytes))
    return {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.files.maxPartitionBytes": str(target_partition_bytes),
        "spark.sql.session.timeZone": "UTC",
    }
