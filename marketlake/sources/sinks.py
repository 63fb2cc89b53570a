"""Sinks: the lake layout, full-refresh and idempotent partition-overwrite Parquet writes, counted
writes without a second scan, and one-document text writes."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Lake:
    """Path convention ``{root}/{layer}/{name}`` for the landing / bronze / silver / gold layers."""

    root: str

    def path(self, layer: str, name: str) -> str:
        return f"{self.root.rstrip('/')}/{layer}/{name}"

    def read(self, spark: SparkSession, layer: str, name: str) -> DataFrame:
        return spark.read.parquet(self.path(layer, name))

    def exists(self, spark: SparkSession, layer: str, name: str) -> bool:
        """Path probe through the Hadoop file system of the session (works for any shared store)."""
        jvm = spark.sparkContext._jvm
        p = jvm.org.apache.hadoop.fs.Path(self.path(layer, name))
        fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        return bool(fs.exists(p))


def write_counted(df: DataFrame, path: str, mode: str = "overwrite", partition_by: str | None = None,
                  max_records_per_file: int | None = None) -> int:
    """Write Parquet and return the row count from an ``Observation`` (no second pass over the data).

    With ``partition_by`` the write uses dynamic partition overwrite, so a rerun of one partition
    value replaces only that partition (idempotent daily loads)."""
    obs = Observation("rows")
    observed = df.observe(obs, F.count(F.lit(1)).alias("n"))
    w = observed.write.mode(mode)
    if max_records_per_file:
        w = w.option("maxRecordsPerFile", max_records_per_file)
    if partition_by:
        w = w.option("partitionOverwriteMode", "dynamic").partitionBy(partition_by)
    w.parquet(path)
    return int(obs.get.get("n", 0))


def write_partition(df: DataFrame, path: str, column: str, value: str) -> int:
    """Stamp a partition value and overwrite only that partition."""
    return write_counted(df.withColumn(column, F.lit(value)), path, partition_by=column)


def write_split(good: DataFrame, rejected: DataFrame, good_path: str, reject_path: str) -> tuple[int, int]:
    """Write a ``(good, rejected)`` split to two tables; returns both counts."""
    return write_counted(good, good_path), write_counted(rejected, reject_path)


def write_document(doc: DataFrame, path: str) -> None:
    """Write a one-row, one-column JSON document as a single text file part (bounded size)."""
    doc.coalesce(1).write.mode("overwrite").text(path)


# ------------------------------------------------------------------ compaction

#: Folder of a table's manifests: ``_manifest/v=N`` lists the files of version N; a version counts once its _SUCCESS is there.
_MANIFEST = "_manifest"


def _fs(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def version(spark: SparkSession, table: str) -> int | None:
    """The last committed manifest of a table; None if it never had one."""
    fs, path = _fs(spark, f"{table}/{_MANIFEST}")
    if not fs.exists(path):
        return None
    done = [int(s.getPath().getName()[2:]) for s in fs.listStatus(path)
            if s.getPath().getName().startswith("v=") and fs.exists(_fs(spark, f"{s.getPath()}/_SUCCESS")[1])]
    return max(done, default=None)


def files(spark: SparkSession, table: str) -> DataFrame:
    """(path, bytes) of a table's files: those of its manifest, or what its folders hold if it has none. Only names and
    sizes are read."""
    last = version(spark, table)
    if last is not None:
        return spark.read.schema("path string, bytes long").parquet(f"{table}/{_MANIFEST}/v={last}")
    return _listed(spark, table)


def _listed(spark: SparkSession, folder: str) -> DataFrame:
    found = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.parquet").load(folder)
    return found.select("path", F.col("length").alias("bytes"))


def read_table(spark: SparkSession, table: str) -> DataFrame:
    """A table by its last manifest: a compaction that is at work, or was killed, is never seen. As with any table format
    the driver plans with the list of file names."""
    if version(spark, table) is None:
        return spark.read.parquet(table)
    names = [r["path"] for r in files(spark, table).select("path").collect()]
    return spark.read.option("basePath", table).parquet(*names)


def compact(spark: SparkSession, table: str, target_bytes: int, partition_by: str | None = None) -> int:
    """Pack the small files of each partition into files of about ``target_bytes``; returns the number of the last manifest.

    Files of at least half the target stay as they are, and so do partitions with a single small file. The others of a
    partition are packed by size, one after another, into bins; a bin is read and written by one task, as one file. New files
    are moved into place and become part of the table only with the manifest that names them and no longer names the
    old ones, which are deleted after that. A run that is killed leaves files that no manifest names; the next run removes
    them."""
    last = version(spark, table)
    if last is None:
        files(spark, table).select("path", "bytes").write.mode("overwrite").parquet(f"{table}/{_MANIFEST}/v=0")
        last = 0
    remove_strays(spark, table)
    listed = files(spark, table).withColumn("folder", F.regexp_extract("path", r"^(.*)/[^/]+$", 1))
    small = F.col("bytes") * 2 < target_bytes
    run = F.sum("bytes").over(Window.partitionBy("folder").orderBy("bytes", "path").rowsBetween(Window.unboundedPreceding, -1))
    bins = listed.where(small).withColumn("bin", F.floor(F.coalesce(run, F.lit(0)) / target_bytes))
    several = F.count("*").over(Window.partitionBy("folder", "bin")) > 1
    # names of the files to be rewritten: Spark plans a scan with their list anyhow
    plan = bins.withColumn("several", several).where("several").select("path", "folder", "bin").collect()
    if not plan:
        return last
    stage = f"{table}/_compacting"
    fs, folder = _fs(spark, stage)
    fs.delete(folder, True)
    numbers = {key: n for n, key in enumerate(sorted({(r["folder"], r["bin"]) for r in plan}))}
    plain = lambda c: F.regexp_replace(F.url_decode(F.replace(c, F.lit("+"), F.lit("%2B"))), "^file:/+", "file:/")
    chosen = spark.createDataFrame([(r["path"], numbers[r["folder"], r["bin"]]) for r in plan], "_name string, _bin int")
    old = spark.read.option("basePath", table).parquet(*[r["path"] for r in plan]).withColumn("_path", plain(F.col("_metadata.file_path")))
    # a left join, so that no row can get lost with a name; the list of names is the plan's own
    rows = old.join(F.broadcast(chosen), F.col("_path") == F.col("_name"), "left").drop("_path", "_name")
    rows.repartition(len(numbers), "_bin").write.partitionBy(*[c for c in (partition_by, "_bin") if c]).parquet(stage)
    moved = []
    for r in _listed(spark, stage).collect():
        home = f"{table}/{r['path'].split('/_compacting/')[1].split('/')[0]}" if partition_by else table
        new = f"{home}/compact-{last + 1:06d}-{len(moved):06d}.parquet"
        if not fs.rename(_fs(spark, r["path"])[1], _fs(spark, new)[1]):
            raise OSError(f"cannot move {r['path']} to {new}")
        moved.append((str(fs.makeQualified(_fs(spark, new)[1])), r["bytes"]))
    gone = chosen.select(F.col("_name").alias("path"))
    live = listed.select("path", "bytes").join(gone, "path", "left_anti").unionByName(spark.createDataFrame(moved, "path string, bytes long"))
    live.write.mode("overwrite").parquet(f"{table}/{_MANIFEST}/v={last + 1}")  # the commit
    fs.delete(folder, True)
    for r in plan:
        fs.delete(_fs(spark, r["path"])[1], False)
    return last + 1


def remove_strays(spark: SparkSession, table: str) -> int:
    """Delete data files that the table's last manifest doesn't name (of a run that was killed); returns their number."""
    if version(spark, table) is None:
        return 0
    everything = _listed(spark, table).select("path")
    strays = [r["path"] for r in everything.join(files(spark, table), "path", "left_anti").collect()]
    for path in strays:
        _fs(spark, path)[0].delete(_fs(spark, path)[1], False)
    return len(strays)
