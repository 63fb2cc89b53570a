"""Plan shape of every registered query: no cartesian product or nested-loop join, and filters /
projections reach the parquet scans."""

import pytest

import __spark_entry__ as entry

# these execute work while being built (stream runs, model fits); their plans are covered elsewhere
SKIP = {"b01_stream_ingest", "b02_stream_dedupe", "b14_stream_velocity", "b50_fraud_model_scores",
        "b51_calibration", "b62_feature_importance", "b46_shuffle_control", "a01_a04_jsonl_landing",
        "a02_a08_csv_landing", "a06_a07_a12_partition_overwrite", "b10_compaction"}
NAMES = sorted(n for n in entry.queries() if n not in SKIP)


@pytest.mark.parametrize("name", NAMES)
def test_no_cartesian_or_nested_loop(spark, sf, name):
    plan = entry.queries()[name](spark, sf)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan
    assert "BroadcastNestedLoopJoin" not in plan


def test_scan_prunes_columns(spark, sf):
    df = entry.queries()["a133_merchant_payment_risk"](spark, sf)
    plan = df._jdf.queryExecution().executedPlan().toString()
    # events are read with only the columns the projection needs
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz,user_id:bigint,event_type:string,value:double>" in plan


def test_time_range_is_pushed_to_the_scan(spark, sf):
    plan = entry.queries()["b21_share_shift"](spark, sf)._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(ts," in plan and "LessThan(ts," in plan


def test_scale_conf_sizes_partitions_from_input():
    from marketlake.session import scale_conf
    conf = scale_conf(100 * 1024**4, cores=8000)
    assert int(conf["spark.sql.shuffle.partitions"]) == 100 * 1024**4 // (256 << 20)
    assert conf["spark.sql.adaptive.skewJoin.enabled"] == "true"
    assert int(scale_conf(10 << 20, cores=8)["spark.sql.shuffle.partitions"]) == 16


def test_category_median_is_exact_over_any_prices(spark):
    """Bands of prices find the median that a plain sort gives: skewed, negative, repeated and non-finite prices."""
    import random

    from marketlake.operators import gold

    rng, odd = random.Random(5), [None, 0.0, -0.0, float("inf"), float("-inf"), float("nan")]
    rows = [(c, rng.choice(odd)) for c in ["odd"] * 9 + [None] * 9]
    rows += [(c, rng.choice([round(rng.uniform(0, 30000), 2), rng.uniform(-9, 9), 7.25, rng.choice(odd)])) for c in "abcde" for _ in range(rng.randrange(1, 90))]
    got = {r[0]: r[1] for r in gold.category_median(spark.createDataFrame(rows, "category string, price_brl double")).collect()}
    place = lambda p: (p != p, 0.0 if p != p else p)
    prices = {c: sorted((p for k, p in rows if k == c and p is not None), key=place) for c in {c for c, _ in rows}}
    assert {c: place(p) for c, p in got.items()} == {c: place(own[(len(own) - 1) // 2]) for c, own in prices.items() if own}


@pytest.mark.parametrize("name", ["a113_order_seller", "a114_a116_order_flags", "a118_priors", "a128_a130_composite_tier"])
def test_items_are_dealt_by_order_or_product_and_never_by_category(spark, sf, name):
    """A category holds a share of all items: no join or sort may gather it; per order, no partitions are merged."""
    import re

    plan = entry.queries()[name](spark, sf)._jdf.queryExecution().executedPlan().toString()
    assert "REPARTITION_BY_NUM" in plan
    lines = plan.split("\n")
    for n, line in enumerate(lines):
        if re.search(r"Exchange hashpartitioning\(category#\d+, ", line):  # only bands, prices of one band and products
            below = "\n".join(lines[n + 1 : n + 3])
            assert re.search(r"HashAggregate\(keys=\[category|_band|category#\d+ AS|FileScan|CASE WHEN", below) and "l_orderkey" not in below, below


def test_order_stages_get_more_tasks_as_the_tables_grow(spark, sf, monkeypatch):
    """What meets per order is dealt by the size of the stored input, not into a fixed number of tasks; unknown sizes don't count."""
    import re

    from marketlake import session
    from marketlake.sources import fixtures

    monkeypatch.setattr(session, "STORED_PER_TASK", 1 << 12)
    parts = session.parts_for(fixtures.f_items(spark, sf), fixtures.f_orders(spark, sf))
    assert parts > int(spark.conf.get("spark.sql.shuffle.partitions"))
    plan = entry.queries()["a114_a116_order_flags"](spark, sf)._jdf.queryExecution().executedPlan().toString()
    dealt = [int(n) for n in re.findall(r"Exchange hashpartitioning\(order_id#\d+L, (\d+)\), REPARTITION_BY_NUM", plan)]
    assert dealt and set(dealt) == {parts}
    assert not re.search(r"SortMergeJoin \[order_id.*\n(.*\n){0,6}.*Exchange hashpartitioning\(order_id#\d+L, \d+\), ENSURE_REQ", plan)
    made = spark.createDataFrame([(1,)], "a long")
    assert session.parts_for(made) == int(spark.conf.get("spark.sql.shuffle.partitions"))


@pytest.mark.parametrize("name", ["a131_merchant_dimension_scores", "a136_export_leaderboard", "a137_export_document", "a137_document_rows", "a155_dq_gold"])
def test_merchant_queries_make_the_seller_stats_once_and_hold_no_shuffle_of_items(spark, sf, name):
    """The steps per item and order are written tables whose shuffles are freed: what is left reads a row per seller."""
    plan = entry.queries()[name](spark, sf)._jdf.queryExecution().executedPlan().toString()
    assert "l_orderkey" not in plan and "o_orderstatus" not in plan and "seller_stats" in plan


def test_merchant_stats_keep_no_table_or_shuffle_of_their_steps(spark, sf):
    import os
    from pathlib import Path

    from marketlake.operators import gold
    from marketlake.plans.catalog import silver_inputs
    from marketlake.session import ensure_checkpoint_dir

    kept = Path(ensure_checkpoint_dir(spark).removeprefix("file://")) / "marketlake/tables"
    count = lambda: sum(f.startswith("shuffle_") for top in (local,) for _, _, files in os.walk(top) for f in files)
    local = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()[0].getPath()
    s = silver_inputs(spark, sf)
    tables = set(os.listdir(kept)) if kept.exists() else set()
    before = count()
    stats = gold.merchant_stats(s["items"], s["products"], s["orders"], s["reviews"], s["fx"])
    assert {t.split("-")[0] for t in set(os.listdir(kept)) - tables} == {"seller_stats"}
    assert count() <= before
    lazily = gold.seller_stats(gold.order_facts(gold.order_seller(s["items"], s["products"], s["orders"], s["reviews"], s["fx"])))
    near = lambda df: sorted(tuple(f"{v:.9g}" if isinstance(v, float) else v for v in r) for r in df.collect())
    assert near(stats) == near(lazily) and stats.columns == lazily.columns
