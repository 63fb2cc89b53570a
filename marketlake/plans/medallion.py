"""The gated lake build: DQ(bronze) -> Silver -> DQ(silver) -> Gold -> DQ(gold) -> export.

Each layer hand-off is a Parquet table on the shared lake (which also cuts lineage, so a lost
executor re-runs at most one layer). Row counts come from ``Observation`` during the write.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from marketlake.operators import gold, quality, silver
from marketlake.plans import export
from marketlake.sources.sinks import Lake, write_counted, write_document

BRONZE_TABLES = ["olist/orders", "olist/order_items", "olist/order_reviews", "olist/products", "olist/sellers",
                 "cfpb_complaints", "fx_rates", "stripe_events_raw"]


def _maybe(spark: SparkSession, lake: Lake, layer: str, name: str) -> DataFrame | None:
    return lake.read(spark, layer, name) if lake.exists(spark, layer, name) else None


def dq(spark: SparkSession, lake: Lake, layer: str, gate: bool = True, run_at: str = "") -> DataFrame:
    """Run one layer's suite, write the JSON report to ``gold/_dq/<layer>``, and gate on it."""
    spec = quality.SUITES[layer]
    tables = {}
    for name in spec:
        if name == "merchant_accounts":
            m = _maybe(spark, lake, "gold", "merchant_dimension_scores")
            tables[name] = None if m is None else m.select("account_id")
        else:
            tables[name] = _maybe(spark, lake, layer, name)
    report = quality.run_suite(spark, tables, spec)
    write_document(quality.as_json_document(report, layer, run_at), lake.path("gold", f"_dq/{layer}"))
    return quality.gate(report) if gate else report


def build_silver(spark: SparkSession, lake: Lake) -> dict[str, int]:
    """Every Silver table with its row count; rows whose text doesn't parse go to ``_rejected/<table>``, never to NULL."""
    translation = _maybe(spark, lake, "bronze", "olist/product_category_name_translation")
    builds = {
        "olist_orders": ("olist/orders", silver.orders), "olist_order_items": ("olist/order_items", silver.order_items),
        "olist_reviews": ("olist/order_reviews", silver.reviews),
        "olist_products": ("olist/products", lambda df: silver.products(df, translation)),
        "olist_sellers": ("olist/sellers", silver.sellers), "cfpb_complaints": ("cfpb_complaints", silver.complaints),
        "fx_rates": ("fx_rates", silver.fx_rates),
    }
    counts = {}
    for name, (source, build) in builds.items():
        good, bad = silver.parsed(lake.read(spark, "bronze", source), source)
        counts[name] = write_counted(build(good), lake.path("silver", name))
        if source in silver.TYPED:
            counts[f"_rejected/{name}"] = write_counted(bad, lake.path("silver", f"_rejected/{name}"))
    good, rejected = silver.stripe_events(lake.read(spark, "bronze", "stripe_events_raw"))
    counts["stripe_events"] = write_counted(good, lake.path("silver", "stripe_events"))
    counts["_rejected/stripe_events"] = write_counted(rejected, lake.path("silver", "_rejected/stripe_events"))
    return counts


def build_gold(spark: SparkSession, lake: Lake) -> dict[str, int]:
    s = lambda n: lake.read(spark, "silver", n)
    merchants = gold.merchant_scores(s("olist_order_items"), s("olist_products"), s("olist_orders"),
                                     s("olist_reviews"), s("fx_rates"), s("olist_sellers"))
    ev = gold.to_usd(s("stripe_events"), s("fx_rates"))
    outs = {
        "merchant_dimension_scores": merchants,
        "merchant_payment_risk": gold.payment_risk(ev),
        "channel_risk": gold.channel_risk(ev),
        "external_dispute_benchmarks": gold.benchmarks(s("cfpb_complaints")),
    }
    return {name: write_counted(df, lake.path("gold", name)) for name, df in outs.items()}


def export_document(spark: SparkSession, lake: Lake, out_path: str, generated_at: str) -> None:
    g = lambda n: lake.read(spark, "gold", n)
    doc = export.document(g("merchant_dimension_scores"), g("merchant_payment_risk"), g("channel_risk"),
                          g("external_dispute_benchmarks"), generated_at)
    write_document(doc, out_path)


def run(spark: SparkSession, lake: Lake, export_path: str, generated_at: str, gate: bool = True) -> dict:
    """The whole gated build; raises ``quality.GateFailed`` at the first failing layer."""
    out = {"dq_bronze": dq(spark, lake, "bronze", gate, generated_at)}
    out["silver"] = build_silver(spark, lake)
    out["dq_silver"] = dq(spark, lake, "silver", gate, generated_at)
    out["gold"] = build_gold(spark, lake)
    out["dq_gold"] = dq(spark, lake, "gold", gate, generated_at)
    export_document(spark, lake, export_path, generated_at)
    return out
