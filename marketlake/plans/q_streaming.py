"""Registered streaming queries (B01, B02, B03, B14): the fixture envelopes are landed as JSON-lines files under the
shared checkpoint folder, in several drops where arrival matters; each drop is run with ``availableNow``, and the query
returns the tables that the streams keep. Each run uses a new folder, so reruns never see old state."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from marketlake.plans.catalog import register
from marketlake.plans.oracle import with_views
from marketlake.session import shared_scratch
from marketlake.sources import fixtures as fx
from marketlake.streaming import ingest, reconcile


def _tasks(spark):
    """Landing files of a drop and parts of a stream's state: fixed numbers would leave most of a cluster idle."""
    return max(4, spark.sparkContext.defaultParallelism)


def _landed(spark, sf, name):
    root = shared_scratch(spark, f"stream/{name}/{uuid.uuid4().hex}")
    ingest.land_jsonl(fx.f_events_raw(spark, sf), f"{root}/landing", files=_tasks(spark))
    return root


@register("b01_stream_ingest", with_views(["f_events_raw"], """
select event_id, event_type, api_version, created, ingested_at, payload, livemode from f_events_raw"""))
def b01_stream_ingest(spark, sf):
    root = _landed(spark, sf, "ingest")
    ingest.ingest_json(spark, f"{root}/landing", f"{root}/bronze", f"{root}/_ckpt")
    return spark.read.parquet(f"{root}/bronze").drop("_source_file")


def _drops(spark, sf, name, order, n, take=lambda raw: raw):
    """Land the envelopes in ``n`` drops by the number ``order`` gives each; yields the folder after each drop."""
    root = shared_scratch(spark, f"stream/{name}/{uuid.uuid4().hex}")
    raw = take(fx.f_events_raw(spark, sf)).withColumn("_drop", order)
    for k in range(n):
        ingest.land_jsonl(raw.where(F.col("_drop") == k).drop("_drop"), f"{root}/landing", files=_tasks(spark))
        yield root


def _number():
    return F.substring("event_id", 5, 20).cast("long")


def _arrival():
    """Five days of receipts a drop, the last one open-ended."""
    return F.least(F.floor((F.dayofyear("ingested_at") - 1) / 5), F.lit(4))


@register("b02_stream_dedupe", with_views(["f_events_raw"], """
select distinct event_id, event_type, api_version, created, payload, cast(null as varchar) as reject_reason from r where event_id is not null
union all
select event_id, event_type, api_version, created, payload, 'missing_id' from r where event_id is null""", ctes="""
r AS (select case when cast(substr(event_id, 5) as bigint) % 101 <> 0 then event_id end as event_id, event_type, api_version, created, payload
      from f_events_raw)"""))
def b02_stream_dedupe(spark, sf):
    nameless = lambda raw: raw.withColumn("event_id", F.when(_number() % 101 != 0, F.col("event_id")))
    for root in _drops(spark, sf, "dedupe", _arrival(), 5, nameless):
        ingest.dedupe_to(spark, f"{root}/landing", f"{root}/dedup", f"{root}/_ckpt")
    columns = ["event_id", "event_type", "api_version", "created", "payload"]
    return (spark.read.parquet(f"{root}/dedup").select(*columns, F.lit(None).cast("string").alias("reject_reason"))
            .unionByName(spark.read.parquet(f"{root}/dedup.missing_id").select(*columns, F.col("_reject_reason").alias("reject_reason"))))


_HORIZON = 10


@register("b03_reconcile_drops", with_views(["f_events_raw"], f"""
select c.event_id as child_id, c.k as parent_key, p.event_id as parent_id
from o c left join o p on p.k = c.k and not p.child and p.created between c.created - interval {_HORIZON} day and c.created + interval {_HORIZON} day
where c.child""", ctes="""
o AS (select distinct event_id, created, event_type like 'charge.dispute.%' as child,
             json_extract_string(payload, case when event_type like 'charge.dispute.%' then '$.charge' else '$.id' end) as k from f_events_raw)"""))
def b03_reconcile_drops(spark, sf):
    """Three drops, each over the whole time: most rows of the later ones are behind the watermark."""
    for root in _drops(spark, sf, "reconcile", F.pmod(_number() * 7 + F.dayofyear("ingested_at"), F.lit(3)), 3):
        ingest.dedupe_to(spark, f"{root}/landing", f"{root}/dedup", f"{root}/_ckpt1")
        reconcile.reconcile_to(spark, f"{root}/dedup", f"{root}/joined", f"{root}/_ckpt2", _HORIZON, "2 days", state_partitions=_tasks(spark))
    return (reconcile.pairs_table(spark, f"{root}/joined").select("child_id", "parent_key", "parent_id")
            .unionByName(reconcile.pending_table(spark, f"{root}/joined").select("child_id", "parent_key", F.lit(None).cast("string").alias("parent_id"))))


@register("b14_stream_velocity", with_views(["f_events_raw"], """
select window_start, window_start + interval 5 minute as window_end, account_id, count(*) as events
from (select time_bucket(interval 1 minute, created) - to_minutes(k) as window_start,
             json_extract_string(payload, '$.on_behalf_of') as account_id
      from f_events_raw, range(0, 5) r(k))
group by 1, 2, 3"""))
def b14_stream_velocity(spark, sf):
    for root in _drops(spark, sf, "velocity", _arrival(), 5):
        ingest.velocity_to(spark, f"{root}/landing", f"{root}/velocity", f"{root}/_ckpt")
    return ingest.velocity_table(spark, f"{root}/velocity").drop("window_date")
