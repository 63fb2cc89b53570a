"""Streaming: availableNow ingest run twice adds nothing; stream results equal the batch ones."""

import random
import uuid
from datetime import date, datetime, timedelta

import pytest

from pyspark.sql import functions as F

from marketlake.session import shared_scratch
from marketlake.sources import fixtures as fx
from marketlake.streaming import ingest, reconcile


def test_replay_is_idempotent_and_new_files_are_picked_up(spark, sf):
    root = shared_scratch(spark, f"test-stream/{uuid.uuid4().hex}")
    raw = fx.f_events_raw(spark, sf)
    first, second = raw.where(F.col("created") < "2024-01-15"), raw.where(F.col("created") >= "2024-01-15")
    ingest.land_jsonl(first, f"{root}/landing")
    ingest.ingest_json(spark, f"{root}/landing", f"{root}/bronze", f"{root}/ckpt")
    n1 = spark.read.parquet(f"{root}/bronze").count()
    ingest.ingest_json(spark, f"{root}/landing", f"{root}/bronze", f"{root}/ckpt")  # replay: nothing new
    assert spark.read.parquet(f"{root}/bronze").count() == n1 == first.count()
    ingest.land_jsonl(second, f"{root}/landing")
    ingest.ingest_json(spark, f"{root}/landing", f"{root}/bronze", f"{root}/ckpt")
    landed = spark.read.parquet(f"{root}/bronze").drop("_source_file")
    assert landed.count() == raw.count()
    assert landed.exceptAll(raw).count() == 0


def test_stream_dedupe_equals_batch_distinct(spark, sf):
    root = shared_scratch(spark, f"test-stream/{uuid.uuid4().hex}")
    raw = fx.f_events_raw(spark, sf)
    ingest.land_jsonl(raw, f"{root}/landing")
    ingest.dedupe_to(spark, f"{root}/landing", f"{root}/out", f"{root}/ckpt")
    got = spark.read.parquet(f"{root}/out").select("event_id", "payload")
    want = raw.select("event_id", "payload").distinct()
    assert got.count() == want.count() and got.exceptAll(want).count() == 0


def test_no_first_receipt_is_lost_over_many_drops(spark, sf):
    """Events arrive out of order by up to two hours, in seven drops with redeliveries across them, then all again."""
    root = shared_scratch(spark, f"test-stream/{uuid.uuid4().hex}")
    raw = fx.f_events_raw(spark, sf)
    cuts = [f"2024-01-{d:02d}" for d in (1, 4, 8, 12, 16, 20, 25)] + ["2100-01-01"]
    for low, high in zip(cuts, cuts[1:]):
        part = raw.where((F.col("ingested_at") >= F.lit(low).cast("timestamp_ntz")) & (F.col("ingested_at") < F.lit(high).cast("timestamp_ntz")))
        ingest.land_jsonl(part, f"{root}/landing", files=2)
        ingest.dedupe_to(spark, f"{root}/landing", f"{root}/out", f"{root}/ckpt", max_files_per_trigger=1)
    ingest.land_jsonl(raw, f"{root}/landing")
    ingest.dedupe_to(spark, f"{root}/landing", f"{root}/out", f"{root}/ckpt")
    got = spark.read.parquet(f"{root}/out").select("event_id", "payload")
    want = raw.select("event_id", "payload").distinct()
    assert got.count() == want.count() and got.exceptAll(want).count() == 0


def test_a_batch_reads_only_its_days_and_runs_twice_alike(spark, sf):
    root = shared_scratch(spark, f"test-stream/{uuid.uuid4().hex}")
    raw = fx.f_events_raw(spark, sf)
    ingest.land_jsonl(raw, f"{root}/landing", files=3)
    ingest.dedupe_to(spark, f"{root}/landing", f"{root}/out", f"{root}/ckpt", max_files_per_trigger=1)
    days = [date(2024, 1, 3), date(2024, 1, 4), None]
    files = ingest.read_days(spark, f"{root}/out", days, ingest.deduped_schema(), range(2)).inputFiles()
    assert files and {f.split("event_date=")[1].split("/")[0] for f in files} <= {"2024-01-03", "2024-01-04"}
    assert {f.split("batch=")[1].split("/")[0] for f in files} == {"0", "1"}
    whole = spark.read.parquet(f"{root}/out")
    part = whole.where("batch = 2").drop("batch").persist()
    before = whole.count(), part.count()
    ingest.write_batch(part, f"{root}/out", 2)  # the same batch again, as after a failure
    assert spark.read.parquet(f"{root}/out").count() == before[0] and before[1] > 0
    assert ingest.batches_after(spark, f"{root}/out", -1) == [0, 1, 2] and ingest.batches_after(spark, f"{root}/out", 2) == []


def test_rows_without_an_id_are_all_kept_apart(spark, sf):
    root = shared_scratch(spark, f"test-stream/{uuid.uuid4().hex}")
    raw = fx.f_events_raw(spark, sf).withColumn("event_id", F.when(F.crc32("event_id") % 5 != 0, F.col("event_id")))
    ingest.land_jsonl(raw, f"{root}/landing", files=2)
    ingest.dedupe_to(spark, f"{root}/landing", f"{root}/out", f"{root}/ckpt", max_files_per_trigger=1)
    assert spark.read.parquet(f"{root}/out.missing_id").count() == raw.where("event_id is null").count() > 0
    assert spark.read.parquet(f"{root}/out").count() == raw.where("event_id is not null").select("event_id").distinct().count()


def test_velocity_parts_add_up_and_merge(spark, sf):
    root = shared_scratch(spark, f"test-stream/{uuid.uuid4().hex}")
    raw = fx.f_events_raw(spark, sf)
    ingest.land_jsonl(raw, f"{root}/landing", files=4)
    ingest.velocity_to(spark, f"{root}/landing", f"{root}/v", f"{root}/ckpt", max_files_per_trigger=1)
    want = ingest._windows(ingest.with_account(raw).withColumn("_et", F.col("created").cast("timestamp")), "account_id", "_et", "5 minutes", "1 minute")
    columns = ["window_start", "window_end", "account_id", "events"]
    got = ingest.velocity_table(spark, f"{root}/v").select(*columns)
    assert got.exceptAll(want.select(*columns)).isEmpty() and got.count() == want.count()
    days = [r[0] for r in spark.read.parquet(f"{root}/v").select("window_date").distinct().collect()]
    ingest.merge_velocity(spark, f"{root}/v", days[:3], 3)
    after = spark.read.parquet(f"{root}/v")
    assert {r[0] for r in after.where(F.col("window_date").isin(days[:3])).select("batch").distinct().collect()} == {3}
    got = ingest.velocity_table(spark, f"{root}/v").select(*columns)
    assert got.exceptAll(want.select(*columns)).isEmpty() and got.count() == want.count()


def _plain_pairs(events, horizon):
    """(child, parent or None) by plain loops."""
    out = set()
    for i, kind, key, created in events:
        if kind == "child":
            own = [j for j, other, k, t in events if other == "parent" and k == key and k is not None and abs(t - created) <= timedelta(days=horizon)]
            out |= {(i, j) for j in own} or {(i, None)}
    return out


@pytest.mark.parametrize("seed", [1, 2])
def test_five_drops_in_any_order_join_as_one_batch(spark, seed):
    """Arrival is at random: children before parents, parents weeks behind the watermark, keys that never come."""
    rng = random.Random(seed)
    events = []
    for n in range(160):
        kind, key = rng.choice(["child", "parent"]), rng.choice([f"o{rng.randrange(40)}", None] + [f"o{rng.randrange(40)}"] * 8)
        events.append((f"e{n}", kind, key, datetime(2024, 1, 1) + timedelta(hours=rng.randrange(24 * 60))))
    root = shared_scratch(spark, f"test-stream/{uuid.uuid4().hex}")
    drops = [events[k::5] for k in range(5)]
    if seed == 2:  # by event time, but for one drop out of five that comes last
        ordered = sorted(events, key=lambda e: e[3])
        drops = [[e for e in ordered[k * 32 : k * 32 + 32] if int(e[0][1:]) % 5] for k in range(4)] + [[e for e in ordered if int(e[0][1:]) % 5 == 0] + [e for e in ordered[128:] if int(e[0][1:]) % 5]]
    for drop in drops:
        rows = [(i, "charge.dispute.created" if kind == "child" else "charge.succeeded", "v", t, t, ('{"charge":"%s"}' if kind == "child" else '{"id":"%s"}') % key if key else "{}", False)
                for i, kind, key, t in drop]
        ingest.land_jsonl(spark.createDataFrame(rows, ingest.ENVELOPE_SCHEMA), f"{root}/landing", files=1)
        ingest.dedupe_to(spark, f"{root}/landing", f"{root}/events", f"{root}/c1")
        reconcile.reconcile_to(spark, f"{root}/events", f"{root}/out", f"{root}/c2", 10, "1 day", state_partitions=2)
    reconcile.reconcile_to(spark, f"{root}/events", f"{root}/out", f"{root}/c2", 10, "1 day")  # nothing new: nothing changes
    got = [(r["child_id"], r["parent_id"]) for r in reconcile.pairs_table(spark, f"{root}/out").collect()]
    got += [(r["child_id"], None) for r in reconcile.pending_table(spark, f"{root}/out").collect()]
    assert len(got) == len(set(got)) and set(got) == _plain_pairs(events, 10)


def test_drops_and_state_spread_over_the_cores(spark, sf, monkeypatch):
    """Landing and the join's state had 2 and 4 tasks, however many cores there were."""
    from marketlake.plans import q_streaming

    seen = []
    monkeypatch.setattr(q_streaming, "_tasks", lambda spark: 6)
    monkeypatch.setattr(q_streaming.ingest, "land_jsonl", lambda df, path, files=4: seen.append(files))
    monkeypatch.setattr(q_streaming.ingest, "dedupe_to", lambda *a, **b: None)
    monkeypatch.setattr(q_streaming.reconcile, "reconcile_to", lambda *a, **b: seen.append(b["state_partitions"]))
    monkeypatch.setattr(q_streaming.reconcile, "pairs_table", lambda spark, dst: spark.createDataFrame([], "child_id string, parent_key string, parent_id string"))
    monkeypatch.setattr(q_streaming.reconcile, "pending_table", lambda spark, dst: spark.createDataFrame([], "child_id string, parent_key string"))
    assert q_streaming.b03_reconcile_drops(spark, sf).isEmpty() and seen == [6] * 6
