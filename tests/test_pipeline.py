"""End to end on a scratch lake: CSV / JSON-lines landing -> Bronze -> gated Silver / Gold -> export."""

import json
import os

import pytest
from pyspark.sql import functions as F

from marketlake.operators import quality
from marketlake.plans import medallion
from marketlake.sources import fixtures as fx
from marketlake.sources import landing, sinks
from marketlake.sources.sinks import Lake, write_counted, write_partition


def _land_csv(df, path):
    df.select(*[F.col(c).cast("string") for c in df.columns]).coalesce(1).write.option("header", True) \
        .option("escape", '"').mode("overwrite").csv(path)


@pytest.fixture(scope="module")
def lake(spark, sf, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("lake"))
    lk = Lake(root)
    o = fx.f_orders(spark, sf).select(
        "order_id", "customer_id", "order_status", F.col("purchased_at").alias("order_purchase_timestamp"),
        F.col("approved_at").alias("order_approved_at"), F.col("carrier_at").alias("order_delivered_carrier_date"),
        F.col("delivered_at").alias("order_delivered_customer_date"),
        F.col("estimated_at").alias("order_estimated_delivery_date"))
    i = fx.f_items(spark, sf).select("order_id", F.col("item_no").alias("order_item_id"), "product_id", "seller_id",
                                     F.col("ship_by").alias("shipping_limit_date"), F.col("price_brl").alias("price"),
                                     F.col("freight_brl").alias("freight_value"))
    r = fx.f_reviews(spark, sf).select("review_id", "order_id", F.col("score").alias("review_score"),
                                       F.col("created_at").alias("review_creation_date"),
                                       F.col("answered_at").alias("review_answer_timestamp"))
    p = fx.f_products(spark, sf).select("product_id", F.col("category").alias("product_category_name"))
    cat = fx.f_products(spark, sf).select(F.col("category").alias("product_category_name")).distinct() \
        .withColumn("product_category_name_english", F.upper("product_category_name"))
    s = fx.f_sellers(spark, sf).select("seller_id", F.col("city").alias("seller_city"), F.col("state").alias("seller_state"))
    for name, df in [("olist_orders_dataset", o), ("olist_order_items_dataset", i), ("olist_order_reviews_dataset", r),
                     ("olist_products_dataset", p), ("product_category_name_translation", cat),
                     ("olist_sellers_dataset", s)]:
        _land_csv(df, f"{root}/landing/olist/{name}.csv")
    paths = [f"{root}/landing/olist/{n}" for n in sorted(os.listdir(f"{root}/landing/olist"))]
    for name, df in landing.land_tables(spark, paths, ingested_at="2024-06-01 00:00:00").items():
        write_counted(df, lk.path("bronze", f"olist/{name}"))
    # complaints: two daily JSON-lines drops, the second re-delivers some ids
    c = fx.f_complaints(spark, sf).withColumn("date_received", F.col("received_on").cast("string"))
    for v in (0, 1):
        c.where(F.col("v") == v).drop("v", "_ingested_at", "received_on").write.mode("overwrite") \
            .json(f"{root}/landing/cfpb/day{v}")
        b = landing.read_jsonl(spark, f"{root}/landing/cfpb/day{v}", ingested_at=f"2024-06-0{v + 1} 00:00:00")
        write_partition(b, lk.path("bronze", "cfpb_complaints"), "ds", f"day{v}")
    fxr = fx.f_fx(spark, sf).withColumn("date", F.col("date").cast("string"))
    fxr.write.mode("overwrite").json(f"{root}/landing/fx")
    write_partition(landing.read_jsonl(spark, f"{root}/landing/fx", ingested_at="2024-06-01 00:00:00"),
                    lk.path("bronze", "fx_rates"), "ds", "history")
    write_partition(fx.f_events_raw(spark, sf), lk.path("bronze", "stripe_events_raw"), "ds", "2024-01")
    return lk


def test_gate_stops_small_batches(spark, lake, tmp_path):
    with pytest.raises(quality.GateFailed):
        medallion.run(spark, lake, str(tmp_path / "export"), "2024-06-02T00:00:00+00:00", gate=True)
    rep = spark.read.text(lake.path("gold", "_dq/bronze")).first().value
    assert json.loads(rep)["passed"] is False


def test_full_build_and_export(spark, sf, lake, tmp_path):
    out = medallion.run(spark, lake, str(tmp_path / "export"), "2024-06-02T00:00:00+00:00", gate=False)
    assert out["silver"]["olist_orders"] == fx.f_orders(spark, sf).count()
    assert out["silver"]["cfpb_complaints"] == fx.f_complaints(spark, sf).select("complaint_id").distinct().count()
    assert out["silver"]["stripe_events"] + out["silver"]["_rejected/stripe_events"] + 0 >= 1
    assert out["gold"]["merchant_dimension_scores"] > 0
    # the translation table maps categories to upper case
    cats = {r.category for r in lake.read(spark, "silver", "olist_products").collect()}
    assert cats and all(c == c.upper() for c in cats)
    doc = json.loads(spark.read.text(str(tmp_path / "export")).first().value)
    assert set(doc) == {"meta", "merchants", "channel_risk", "cfpb_benchmarks"}
    assert len(doc["merchants"]) <= 200 and len(doc["cfpb_benchmarks"]) <= 15
    scores = [m["mdt_score"] for m in doc["merchants"]]
    assert scores == sorted(scores, reverse=True)


def test_partition_overwrite_is_idempotent(spark, tmp_path):
    path = str(tmp_path / "t")
    a = spark.range(5).withColumn("x", F.lit(1))
    write_partition(a, path, "ds", "d1")
    write_partition(a, path, "ds", "d2")
    write_partition(a, path, "ds", "d1")   # rerun replaces d1 only
    got = spark.read.parquet(path).groupBy("ds").count().collect()
    assert {r.ds: r["count"] for r in got} == {"d1": 5, "d2": 5}


def _small_files(spark, tmp_path):
    table = str(tmp_path / "table")
    spark.range(3000).withColumn("ds", F.when(F.col("id") < 2000, "hot").otherwise((F.col("id") % 3).cast("string"))).repartition(20) \
        .write.partitionBy("ds").parquet(table)
    spark.range(3000, 43000).withColumn("ds", F.lit("hot")).coalesce(1).write.mode("append").partitionBy("ds").parquet(table)
    return table


def _names(tmp_path):
    return {str(p.relative_to(tmp_path)): p.stat().st_size for p in (tmp_path / "table").rglob("*.parquet") if "_manifest" not in str(p)}


def test_compaction_packs_small_files_and_leaves_large_ones(spark, tmp_path):
    table = _small_files(spark, tmp_path)
    before = _names(tmp_path)
    large = {n for n, size in before.items() if size * 2 >= 100_000}
    assert sinks.compact(spark, table, 100_000, "ds") == 1 and len(large) == 1
    after = _names(tmp_path)
    assert large <= set(after) and len(after) < len(before) / 4  # untouched files keep their names
    assert max(s for n, s in after.items() if n not in large) < 200_000
    out = sinks.read_table(spark, table)
    assert out.count() == 43000 == out.select("id").distinct().count()
    assert {r["ds"]: r["count"] for r in out.groupBy("ds").count().collect()} == {"hot": 42000, "0": 333, "1": 333, "2": 334}
    assert sinks.compact(spark, table, 100_000, "ds") == 1 and _names(tmp_path) == after  # nothing left to do
    assert spark.read.parquet(table).count() == 43000  # a reader without the manifest, when no run is at work


def test_a_killed_compaction_is_never_seen(spark, tmp_path, monkeypatch):
    table = _small_files(spark, tmp_path)
    sinks.compact(spark, table, 3_000, "ds")
    last = sinks.version(spark, table)
    before = sinks.read_table(spark, table).count()

    writer = type(spark.range(1).write)
    set_mode = writer.mode

    def killed(self, mode):
        if mode == "overwrite":  # the manifest is the only write that says so
            raise RuntimeError("killed")
        return set_mode(self, mode)

    monkeypatch.setattr(writer, "mode", killed)
    with pytest.raises(RuntimeError):
        sinks.compact(spark, table, 100_000, "ds")
    monkeypatch.undo()
    assert sinks.version(spark, table) == last and sinks.read_table(spark, table).count() == before == 43000
    assert spark.read.parquet(table).count() > 43000  # what was moved and never named
    assert sinks.compact(spark, table, 100_000, "ds") == last + 1 and spark.read.parquet(table).count() == 43000 and sinks.read_table(spark, table).count() == 43000


def test_range_smoke(spark):
    assert spark.range(1_000_000).selectExpr("sum(id) as s").first().s == 499999500000
