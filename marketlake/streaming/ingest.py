"""Structured Streaming: incremental JSON-lines ingest, lossless dedupe and windowed velocity.

All are file-source queries with a checkpoint, run with ``trigger(availableNow=True)``: a rerun picks up only new
files. The dedupe and the velocity write one folder per batch and day and overwrite it, so a batch that runs again
after a failure leaves the same rows once, and the work of a batch is that of its own rows and days.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marketlake.operators.dedupe import first_per_key

# Envelope of a raw webhook event as landed (payload kept unparsed).
ENVELOPE_SCHEMA = T.StructType([
    T.StructField("event_id", T.StringType()), T.StructField("event_type", T.StringType()),
    T.StructField("api_version", T.StringType()), T.StructField("created", T.TimestampNTZType()),
    T.StructField("ingested_at", T.TimestampNTZType()), T.StructField("payload", T.StringType()),
    T.StructField("livemode", T.BooleanType()),
])


def read_events(spark: SparkSession, src: str, schema: T.StructType = ENVELOPE_SCHEMA,
                max_files_per_trigger: int | None = None) -> DataFrame:
    """Streaming JSON-lines source with a declared schema (no inference), plus the source file."""
    r = spark.readStream.schema(schema).option("timestampNTZFormat", "yyyy-MM-dd'T'HH:mm:ss[.SSSSSS]")
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.json(src).withColumn("_source_file", F.col("_metadata.file_path"))


def _run(df: DataFrame, dst: str, ckpt: str, mode: str = "append") -> None:
    q = (df.writeStream.format("parquet").option("path", dst).option("checkpointLocation", ckpt)
           .outputMode(mode).trigger(availableNow=True).start())
    q.awaitTermination()
    if q.exception() is not None:  # pragma: no cover - surfaced to the caller
        raise RuntimeError(str(q.exception()))


def ingest_json(spark: SparkSession, src: str, dst: str, ckpt: str) -> None:
    """Append-only Bronze ingest of landed JSON-lines files; payload stays unparsed."""
    _run(read_events(spark, src), dst, ckpt)


def _fs(spark: SparkSession, folder: str):
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), path


def exists(spark: SparkSession, folder: str) -> bool:
    fs, path = _fs(spark, folder)
    return fs.exists(path)


def _day_folder(dst: str, day) -> str:
    return f"{dst}/event_date={'__HIVE_DEFAULT_PARTITION__' if day is None else day}"


def day_folders(spark: SparkSession, dst: str, days, batches=None) -> list[str]:
    """The folders of these days (and batches): only the days' own folders are listed, however long the table's past."""
    out = []
    for day in days:
        fs, path = _fs(spark, _day_folder(dst, day))
        if fs.exists(path):
            for status in fs.listStatus(path):
                name = status.getPath().getName()
                if name.startswith("batch=") and (batches is None or int(name[6:]) in batches):
                    out.append(f"{_day_folder(dst, day)}/{name}")
    return out


def read_days(spark: SparkSession, dst: str, days, schema: T.StructType, batches=None) -> DataFrame:
    """Rows of a table by event_date and batch for these days, from their folders alone."""
    folders = day_folders(spark, dst, days, batches)
    if not folders:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("basePath", dst).parquet(*folders)


def write_batch(rows: DataFrame, dst: str, number: int, day: str = "event_date") -> None:
    """A batch's rows by day, in folders of its own that a second attempt overwrites."""
    (rows.withColumn("batch", F.lit(number).cast("long")).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy(day, "batch").parquet(dst))


def batches_after(spark: SparkSession, dst: str, number: int) -> list[int]:
    """Committed batches behind ``number``: they follow each other, so only their own marks are looked for."""
    out = []
    while exists(spark, f"{dst}.batches/batch={number + 1 + len(out)}"):
        out.append(number + 1 + len(out))
    return out


def batch_days(spark: SparkSession, dst: str, batches) -> list:
    """The event dates of committed batches."""
    if not batches:
        return []
    marks = spark.read.schema("event_date date").parquet(*[f"{dst}.batches/batch={n}" for n in batches])
    return [r[0] for r in marks.distinct().collect()]


def deduped_schema(schema: T.StructType = ENVELOPE_SCHEMA) -> T.StructType:
    """What :func:`dedupe_to` writes: the envelope, its file, and the folders' columns."""
    extra = T.StructType([T.StructField("_source_file", T.StringType()), T.StructField("event_date", T.DateType()), T.StructField("batch", T.LongType())])
    return T.StructType(schema.fields + extra.fields)


def dedupe_to(spark: SparkSession, src: str, dst: str, ckpt: str, key: str = "event_id", ts: str = "created",
              max_files_per_trigger: int | None = None) -> None:
    """The first receipt of every ``key`` goes to ``dst`` (folders event_date, batch); redeliveries are dropped however
    late they come, and no first receipt is ever lost (a watermark would drop events that are older than it).

    Rows without a key can't be told apart as redeliveries: all of them go to ``dst``.missing_id, with the reason
    ``missing_id``. A micro-batch is reduced to one row per key and anti-joined with what earlier batches wrote for the
    event dates it names; only these dates' folders are listed and read. That rests on a redelivery repeating its event's
    ``ts``: the same key with a ``ts`` of another day counts as another event. When a batch is written its days are
    noted in ``dst``.batches, which tells readers that it is complete."""
    def append(batch: DataFrame, number: int) -> None:
        batch = batch.withColumn("event_date", F.to_date(ts)).persist()  # read once for three uses
        try:
            days = [r[0] for r in batch.select("event_date").distinct().collect()]  # as many as days in a batch
            lost = batch.where(F.col(key).isNull()).withColumn("_reject_reason", F.lit("missing_id"))
            write_batch(lost, f"{dst}.missing_id", number)
            fresh = first_per_key(batch.where(F.col(key).isNotNull()), [key], ["ingested_at"])
            if number:
                seen = read_days(spark, dst, days, T.StructType([*fresh.schema.fields, T.StructField("batch", T.LongType())]), range(number))
                fresh = fresh.join(seen.select(key), key, "left_anti").select(*fresh.columns)
            write_batch(fresh, dst, number)
            spark.createDataFrame([(d,) for d in days], "event_date date").coalesce(1).write.mode("overwrite").parquet(f"{dst}.batches/batch={number}")
        finally:
            batch.unpersist()

    for_each(read_events(spark, src, max_files_per_trigger=max_files_per_trigger), append, ckpt)


def for_each(stream: DataFrame, step, ckpt: str):
    """Run ``step(batch, number)`` on what is new, and return the finished query."""
    query = stream.writeStream.foreachBatch(step).option("checkpointLocation", ckpt).trigger(availableNow=True).start()
    query.awaitTermination()
    if query.exception() is not None:  # pragma: no cover - surfaced to the caller
        raise RuntimeError(str(query.exception()))
    return query


def _windows(events: DataFrame, key: str, ts: str, size: str, slide: str) -> DataFrame:
    return (events.groupBy(F.window(F.col(ts), size, slide).alias("w"), F.col(key)).agg(F.count("*").alias("events"))
            .select(F.col("w.start").cast("timestamp_ntz").alias("window_start"),
                    F.col("w.end").cast("timestamp_ntz").alias("window_end"), key, "events"))


def with_account(events: DataFrame) -> DataFrame:
    """The account that an event is for, from its payload."""
    return events.withColumn("account_id", F.get_json_object("payload", "$.on_behalf_of"))


def velocity_to(spark: SparkSession, src: str, dst: str, ckpt: str, key: str = "account_id", ts: str = "created",
                size: str = "5 minutes", slide: str = "1 minute", max_files_per_trigger: int | None = None) -> None:
    """Sliding-window counts per key as a table that every batch adds to: a batch counts its own events by window and
    writes those counts (folders window_date, batch). No watermark: late events add to windows of any age, and nothing
    written before is read again. :func:`velocity_table` is the sum."""
    def add(batch: DataFrame, number: int) -> None:
        counts = _windows(with_account(batch).withColumn("_et", F.col(ts).cast("timestamp")), key, "_et", size, slide)
        write_batch(counts.withColumn("window_date", F.to_date("window_start")), dst, number, "window_date")

    for_each(read_events(spark, src, max_files_per_trigger=max_files_per_trigger), add, ckpt)


def velocity_table(spark: SparkSession, dst: str, key: str = "account_id") -> DataFrame:
    """The windows' counts over all batches so far; a filter on ``window_date`` reads only its folders."""
    parts = spark.read.parquet(dst)
    return (parts.groupBy("window_date", "window_start", "window_end", key).agg(F.sum("events").alias("events"))
            .select("window_start", "window_end", key, "events", "window_date"))


def merge_velocity(spark: SparkSession, dst: str, days, number: int, key: str = "account_id") -> None:
    """Replace the parts of these days by their sums (kept as the part of batch ``number``, one of theirs), so that the parts
    of a day don't pile up. Run it between batches: readers would see both while it works."""
    fields = f"window_start timestamp_ntz, window_end timestamp_ntz, {key} string, events long, window_date date, batch long"
    for day in days:
        folder = f"{dst}/window_date={day}"
        fs, path = _fs(spark, folder)
        own = [s.getPath().getName() for s in fs.listStatus(path)] if fs.exists(path) else []
        old = [n for n in own if n.startswith("batch=") and int(n[6:]) <= number]
        if len(old) < 2:
            continue
        parts = spark.read.schema(fields).option("basePath", dst).parquet(*[f"{folder}/{n}" for n in old])
        merged = parts.groupBy("window_start", "window_end", key, "window_date").agg(F.sum("events").alias("events"))
        side = f"{dst}.merging/window_date={day}"
        merged.drop("window_date").write.mode("overwrite").parquet(side)
        for n in old:
            fs.delete(_fs(spark, f"{folder}/{n}")[1], True)
        fs.rename(_fs(spark, side)[1], _fs(spark, f"{folder}/batch={number}")[1])


def land_jsonl(df: DataFrame, path: str, files: int = 4) -> None:
    """Write a batch DataFrame as JSON-lines landing files (used to feed the streams)."""
    (df.repartition(files).write.mode("append")
       .option("timestampNTZFormat", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").json(path))
