"""Registered source / sink round trips (A01, A02, A04, A06, A07, A12, B10): fixture tables are
written to a fresh folder under the shared checkpoint location in the landing or lake format, read
back with the library readers, and returned - so the readers' schema, lineage and partition
handling are checked against the original rows."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from marketlake.plans.catalog import register
from marketlake.plans.oracle import with_views
from marketlake.session import shared_scratch
from marketlake.sources import fixtures as fx
from marketlake.sources import landing
from marketlake.sources.sinks import compact, read_table, write_counted, write_partition
from marketlake.streaming.ingest import ENVELOPE_SCHEMA, land_jsonl


def _scratch(spark, name):
    return shared_scratch(spark, f"sources/{name}/{uuid.uuid4().hex}")


@register("a01_a04_jsonl_landing", with_views(["f_events_raw"], """
select event_id, event_type, api_version, created, ingested_at, payload, livemode, true as has_lineage
from f_events_raw"""))
def a01_a04_jsonl_landing(spark, sf):
    root = _scratch(spark, "jsonl")
    land_jsonl(fx.f_events_raw(spark, sf), f"{root}/landing")
    df = landing.read_jsonl(spark, f"{root}/landing", ENVELOPE_SCHEMA, ingested_at="2024-06-01 00:00:00")
    return df.select(*[f.name for f in ENVELOPE_SCHEMA.fields],
                     (F.col("_source_file").contains("/landing/") & F.col("_ingested_at").isNotNull()
                      & F.col("_corrupt_record").isNull()).alias("has_lineage"))


@register("a02_a08_csv_landing", with_views(["f_sellers", "f_reviews"], """
select 'sellers' as table_name, cast(seller_id as varchar) as id, city as a, state as b from f_sellers
union all
select 'order_reviews', review_id || '/' || order_id || '/' || v, case when order_id % 5 = 0 then 'said "so",' || chr(10) || 'then' || chr(10) || chr(10) || 'left' else 'fine' end,
       cast(score as varchar) from f_reviews"""))
def a02_a08_csv_landing(spark, sf):
    """Two tables from one call; every fifth review text holds quotes, commas and newlines."""
    root = _scratch(spark, "csv")
    said = F.when(F.col("order_id") % 5 == 0, F.lit('said "so",\nthen\n\nleft')).otherwise(F.lit("fine"))
    out = {"olist_sellers_dataset.csv": fx.f_sellers(spark, sf).select(F.col("seller_id").cast("string").alias("id"), F.col("city").alias("a"), F.col("state").alias("b")),
           "olist_order_reviews_dataset.csv": fx.f_reviews(spark, sf).select(F.concat_ws("/", "review_id", "order_id", "v").alias("id"), said.alias("a"), F.col("score").cast("string").alias("b"))}
    for name, df in out.items():
        df.write.option("header", True).option("escape", '"').csv(f"{root}/landing/{name}")
    tables = landing.land_tables(spark, [f"{root}/landing/{name}" for name in out], multi_line=["order_reviews"])
    parts = [df.select(F.lit(name).alias("table_name"), "id", "a", "b") for name, df in tables.items()]
    return parts[0].unionByName(parts[1])


@register("a06_a07_a12_partition_overwrite", with_views(["f_events_raw"], """
select event_id, ingested_at, cast(cast(created as date) as varchar) as ds, count(*) over () as written
from f_events_raw"""))
def a06_a07_a12_partition_overwrite(spark, sf):
    """Write every day as its own partition, then rerun the last day: the rerun replaces only that
    partition, so the table still holds each row once. ``written`` is the Observation count."""
    root = _scratch(spark, "parts")
    raw = fx.f_events_raw(spark, sf).withColumn("ds", F.to_date("created").cast("string"))
    n = write_counted(raw, root, partition_by="ds")
    last = raw.agg(F.max("ds")).first()[0]
    write_partition(raw.where(F.col("ds") == last).drop("ds"), root, "ds", last)
    return spark.read.parquet(root).select("event_id", "ingested_at", F.col("ds").cast("string").alias("ds"),
                                           F.lit(n).cast("bigint").alias("written"))


@register("b10_compaction", with_views(["f_events_raw"], """
select event_id, ingested_at, cast(cast(created as date) as varchar) as ds from f_events_raw"""))
def b10_compaction(spark, sf):
    """Days of many small files are packed to the target size, a second run over the packed table finds nothing to do;
    rows and partition values stay."""
    root = _scratch(spark, "compact")
    raw = fx.f_events_raw(spark, sf).withColumn("ds", F.to_date("created").cast("string"))
    write_counted(raw.repartition(16), f"{root}/table", partition_by="ds")
    for _ in range(2):
        compact(spark, f"{root}/table", 1 << 20, partition_by="ds")
    return read_table(spark, f"{root}/table").select("event_id", "ingested_at", F.col("ds").cast("string").alias("ds"))
