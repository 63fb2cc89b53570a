"""Children and parents that arrive in any order (a dispute before its charge), joined as they come.

A stream-stream join with watermarks pairs the rows that arrive within ``delay`` of each other in event time; its state
(Spark's state store) forgets rows that are too old for new partners. What the watermark gives up is merged in after each
run: rows that came behind the watermark are kept in a table of late rows for as long as partners can still come, and are
joined with the days of the other side that lie within the horizon. Children without a partner so far are a table of their
own, ``pending``: the next one is made from the last one and the run's new children, less those that found a partner.

The outcome depends on what has arrived, not on when: any number of runs over any order of the same events gives the same
pairs and the same pending children as one. The work of a run grows with its own rows, with the late and pending ones and
with the days around late rows, never with the whole past.
"""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marketlake.streaming import ingest

PAIR = "child_id string, parent_id string, parent_key string, child_created timestamp_ntz, parent_created timestamp_ntz"
LATE = "side string, id string, key string, created timestamp_ntz"


def sides(events: DataFrame) -> DataFrame:
    """side ('child' or 'parent'), id, key, created: disputes name their parent, all other events are one."""
    child = F.col("event_type").startswith("charge.dispute.")
    key = F.when(child, F.get_json_object("payload", "$.charge")).otherwise(F.get_json_object("payload", "$.id"))
    return events.select(F.when(child, "child").otherwise("parent").alias("side"), F.col("event_id").alias("id"), key.alias("key"), "created")


def _near(horizon: int) -> Column:
    days = F.make_dt_interval(F.lit(horizon))
    return F.col("parent_created").between(F.col("child_created") - days, F.col("child_created") + days)


def _children(rows: DataFrame) -> DataFrame:
    return rows.where("side = 'child'").select(F.col("id").alias("child_id"), F.col("key").alias("parent_key"), F.col("created").alias("child_created"))


def _parents(rows: DataFrame) -> DataFrame:
    return rows.where("side = 'parent'").select(F.col("id").alias("parent_id"), F.col("key").alias("_key"), F.col("created").alias("parent_created"))


def pairs(children: DataFrame, parents: DataFrame, horizon: int) -> DataFrame:
    """Every child with every parent of its key within the horizon."""
    c, p = _children(children), _parents(parents)
    return (c.join(p, c["parent_key"] == p["_key"]).where(_near(horizon))
            .select("child_id", "parent_id", "parent_key", "child_created", "parent_created"))


def _last_run(spark: SparkSession, dst: str) -> tuple[int, int, str | None]:
    """(run, last batch of the events seen, watermark then) of the last complete run."""
    run = -1
    while ingest.exists(spark, f"{dst}/runs/run={run + 1}"):
        run += 1
    if run < 0:
        return -1, -1, None
    r = spark.read.schema("last_batch long, mark string").parquet(f"{dst}/runs/run={run}").first()
    return run, r["last_batch"], r["mark"]


def reconcile_to(spark: SparkSession, events: str, dst: str, ckpt: str, horizon: int = 60, delay: str = "10 days",
                 state_partitions: int | None = None) -> None:
    """Join what is new in ``events`` (a table of :func:`ingest.dedupe_to`) and bring ``dst`` up to date.

    ``horizon``: days that a child and its parent may lie apart. ``state_partitions``: of the join's state, fixed when
    the checkpoint is made (default: the session's shuffle partitions)."""
    last, seen, mark = _last_run(spark, dst)
    run, schema = last + 1, ingest.deduped_schema()
    batches = ingest.batches_after(spark, events, seen)
    if not batches:
        return
    mark = _streamed(spark, events, dst, ckpt, run, horizon, delay, state_partitions) or mark
    here = f"{dst}/pairs/run={run}"

    new = sides(ingest.read_days(spark, events, ingest.batch_days(spark, events, batches), schema, set(batches)))
    before = F.lit(mark).cast("timestamp")
    late = new.where(F.col("created").cast("timestamp") < before) if mark else new.where("false")
    kept = spark.read.schema(LATE).parquet(f"{dst}/late/run={last}") if last >= 0 else new.where("false")
    now = new.persist()  # a run's new rows, read from their own folders, used several times
    try:
        span = late.agg(F.min("created").alias("low"), F.max("created").alias("high")).first()
        found = pairs(kept, now, horizon).unionByName(pairs(now, kept, horizon))
        if span["low"] is not None:
            low, high = (span["low"] - timedelta(days=horizon)).date(), (span["high"] + timedelta(days=horizon)).date()
            around = sides(ingest.read_days(spark, events, [low + timedelta(days=n) for n in range((high - low).days + 1)], schema,
                                            range(batches[-1] + 1)))
            found = found.unionByName(pairs(late, around, horizon)).unionByName(pairs(around, late, horizon))
        streamed = _read(spark, here, "step=stream-*")
        found = found.distinct().join(streamed.select("child_id", "parent_id"), ["child_id", "parent_id"], "left_anti")
        found.select("child_id", "parent_id", "parent_key", "child_created", "parent_created").write.mode("overwrite").parquet(f"{here}/step=settled")

        paired = _read(spark, here, "step=*").select("child_id").distinct()
        waiting = _children(now)
        if last >= 0:
            waiting = waiting.unionByName(spark.read.parquet(f"{dst}/pending/run={last}"))
        waiting.join(paired, "child_id", "left_anti").write.mode("overwrite").parquet(f"{dst}/pending/run={run}")
        stay = kept.unionByName(late)
        if mark:  # older ones can't have partners among rows that the stream still takes; late ones look for theirs themselves
            stay = stay.where(F.col("created").cast("timestamp") >= before - F.make_dt_interval(F.lit(horizon + 1)))
        stay.write.mode("overwrite").parquet(f"{dst}/late/run={run}")
    finally:
        now.unpersist()
    (spark.createDataFrame([(batches[-1], mark)], "last_batch long, mark string").coalesce(1)
          .write.mode("overwrite").parquet(f"{dst}/runs/run={run}"))


def _read(spark: SparkSession, folder: str, steps: str) -> DataFrame:
    fs, path = ingest._fs(spark, f"{folder}/{steps}")
    found = fs.globStatus(path) if ingest.exists(spark, folder) else []
    names = [str(s.getPath()) for s in found or []]
    return spark.read.schema(PAIR).parquet(*names) if names else spark.createDataFrame([], PAIR)


def _streamed(spark: SparkSession, events: str, dst: str, ckpt: str, run: int, horizon: int, delay: str,
              state_partitions: int | None) -> str | None:
    """Run the stream-stream join over what is new; returns its watermark."""
    def source() -> DataFrame:
        rows = sides(spark.readStream.schema(ingest.deduped_schema()).parquet(events))
        return rows.withColumn("_t", F.col("created").cast("timestamp"))

    children = (source().where("side = 'child'").withWatermark("_t", delay)
                .select(F.col("id").alias("child_id"), F.col("key").alias("parent_key"), F.col("created").alias("child_created"), F.col("_t").alias("_ct")))
    parents = (source().where("side = 'parent'").withWatermark("_t", delay)
               .select(F.col("id").alias("parent_id"), F.col("key").alias("_key"), F.col("created").alias("parent_created"), F.col("_t").alias("_pt")))
    slack = F.expr(f"interval {horizon + 1} days")  # bounds the state; the exact bound, free of time zones, follows
    joined = (children.join(parents, (F.col("parent_key") == F.col("_key")) & (F.col("_pt") >= F.col("_ct") - slack) & (F.col("_pt") <= F.col("_ct") + slack))
              .where(_near(horizon)).select("child_id", "parent_id", "parent_key", "child_created", "parent_created"))

    def write(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{dst}/pairs/run={run}/step=stream-{number}")

    parts = spark.conf.get("spark.sql.shuffle.partitions")
    if state_partitions:
        spark.conf.set("spark.sql.shuffle.partitions", state_partitions)
    try:
        query = ingest.for_each(joined, write, ckpt)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", parts)
    marks = [p["eventTime"]["watermark"] for p in query.recentProgress if "watermark" in p["eventTime"]]
    return max(marks, default=None)


def pairs_table(spark: SparkSession, dst: str) -> DataFrame:
    """All pairs so far, of complete runs."""
    last, _, _ = _last_run(spark, dst)
    folders = [str(s.getPath()) for r in range(last + 1) for s in ingest._fs(spark, dst)[0].globStatus(ingest._fs(spark, f"{dst}/pairs/run={r}/step=*")[1])]
    return spark.read.schema(PAIR).parquet(*folders) if folders else spark.createDataFrame([], PAIR)


def pending_table(spark: SparkSession, dst: str) -> DataFrame:
    """Children without a parent so far: child_id, parent_key, child_created."""
    last, _, _ = _last_run(spark, dst)
    fields = "child_id string, parent_key string, child_created timestamp_ntz"
    return spark.read.schema(fields).parquet(f"{dst}/pending/run={last}") if last >= 0 else spark.createDataFrame([], fields)
