"""Gold -> one nested JSON document (leaderboard, tier counts, channel risk, complaint benchmarks).

Everything is assembled in Spark: the top-k is a ``TakeOrdered`` (k rows per partition, merged),
nesting uses ``struct`` / ``array_sort(collect_list)`` / ``map_from_entries`` and the final
document is one ``to_json`` value. Each collected list is bounded by construction (top 200
merchants, top 15 benchmarks, one row per tier or channel), so nothing unbounded passes through one
task or the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marketlake.operators.gold import DIMENSIONS, MIN_ORDERS

TOP_MERCHANTS = 200
TOP_BENCHMARKS = 15

# Fixed text of the published document (dimension descriptions, data sources and scoring note).
DIMENSION_TEXT = {
    "delivery": "Share of delivered orders arriving on or before the promised date.",
    "price": "Item price vs category median (cheaper = higher).",
    "contract": "Severity of broken delivery promises (mean days late).",
    "latency": "Days from payment approval to carrier handoff.",
    "dispute": "Share of orders cancelled/unavailable or rated <=2 stars (inverted).",
    "consistency": "Spread of delivery delay (lower variance = higher).",
    "comms": "PROXY: share of orders handed to carrier before the seller's own ship-by date.",
    "resolution": "PROXY: share of late orders that still ended with a >=4 star review.",
}
SOURCES = [
    ("Olist Brazilian E-Commerce", "real",
     "Public marketplace data 2016-2018; merchant dimensions are computed from it. Sellers are anonymised."),
    ("CFPB Consumer Complaints", "real",
     "Daily incremental feed; used only as an external dispute/resolution benchmark, not joined to merchants."),
    ("Frankfurter FX (ECB)", "real", "BRL->USD conversion of ticket sizes."),
    ("Stripe-shaped agent payment events", "synthetic",
     "Generated to spec/data-contract.md; payment_risk fields are synthetic."),
]
SCORING_TEXT = ("Each dimension in [0,1], Bayesian-smoothed toward marketplace mean (m=10); "
                "mdt_score = equal-weight mean.")


DOC_DIGITS = 4  # floats in the published document are rounded to 4 places


def _rounded(df: DataFrame, digits: int = DOC_DIGITS) -> DataFrame:
    """Round every double column, and doubles inside struct columns, for the published document."""
    def rnd(c, dtype):
        if isinstance(dtype, (T.DoubleType, T.FloatType)):
            return F.round(c, digits)
        if isinstance(dtype, T.StructType):
            return F.when(c.isNotNull(), F.struct(*[rnd(c[f.name], f.dataType).alias(f.name) for f in dtype.fields]))
        return c
    return df.select(*[rnd(F.col(f"`{f.name}`"), f.dataType).alias(f.name) for f in df.schema.fields])


def leaderboard(merchants: DataFrame, pay_risk: DataFrame, k: int = TOP_MERCHANTS) -> DataFrame:
    """Eligible merchants, best ``k`` by score (ties by merchant id), with nested dimensions and an
    optional payment-risk struct (NULL when the account has no payments)."""
    pay = pay_risk.select("account_id", "payments", "volume_usd", "agent_share", "dispute_rate",
                          "mandate_violation_rate")
    top = (merchants.where(F.col("eligible"))
           .orderBy(F.desc("mdt_score"), F.asc("merchant_id")).limit(k))
    risk = F.when(F.col("payments").isNotNull(), F.struct(
        "payments", "volume_usd", "agent_share", "dispute_rate", "mandate_violation_rate"))
    return (top.join(pay, "account_id", "left")
               .select("merchant_id", F.col("merchant_name").alias("name"), "state",
                       F.col("n_orders").alias("orders"), "mdt_score", "tier",
                       F.struct(*DIMENSIONS).alias("dimensions"), "avg_review", "avg_ticket_usd",
                       risk.alias("payment_risk")))


def tier_counts(merchants: DataFrame) -> DataFrame:
    """Eligible merchants per tier: ``(tier, n)``."""
    return merchants.where(F.col("eligible")).groupBy("tier").agg(F.count("*").alias("n"))


def top_benchmarks(bench: DataFrame, k: int = TOP_BENCHMARKS) -> DataFrame:
    """Most-complained products (ties by product name, so the cut is deterministic)."""
    return bench.orderBy(F.desc("complaints"), F.asc("product")).limit(k)


def document(merchants: DataFrame, pay_risk: DataFrame, channel: DataFrame, bench: DataFrame,
             generated_at: str, merchants_kept: int = TOP_MERCHANTS, benchmarks_kept: int = TOP_BENCHMARKS) -> DataFrame:
    """The whole export as a one-row DataFrame with a single JSON string column ``value``.

    The four parts are one-row aggregates combined as scalar subqueries (no join, no driver trip)."""
    board = leaderboard(merchants, pay_risk, merchants_kept)
    shown = board.columns
    # the order is that of the scores as they are, not as they are shown
    board = _rounded(board.withColumn("_order", -F.col("mdt_score").cast("decimal(38,18)")))
    channel, bench = _rounded(channel), _rounded(bench)
    lb = board.agg(F.transform(
        F.array_sort(F.collect_list(F.struct(F.col("_order").alias("_k"), F.col("merchant_id").alias("_m"), F.struct(*shown).alias("m")))),
        lambda s: s["m"]).alias("merchants"))
    tiers = tier_counts(merchants).agg(F.map_from_entries(F.collect_list(F.struct("tier", "n"))).alias("t"))
    ch = channel.agg(F.array_sort(F.collect_list(F.struct(*channel.columns))).alias("c"))
    bm = top_benchmarks(bench, benchmarks_kept).agg(F.transform(
        F.array_sort(F.collect_list(F.struct(F.negative("complaints").alias("_k"), F.col("product").alias("_p"),
                                             F.struct(*bench.columns).alias("b")))),
        lambda s: s["b"]).alias("b"))
    meta = F.struct(
        F.lit(generated_at).alias("generated_at"),
        F.array(*[F.struct(F.lit(n).alias("name"), F.lit(k).alias("kind"), F.lit(t).alias("note")) for n, k, t in SOURCES]).alias("sources"),
        F.create_map(*[x for k, v in DIMENSION_TEXT.items() for x in (F.lit(k), F.lit(v))]).alias("dimensions"),
        F.lit(SCORING_TEXT).alias("scoring"), F.lit(MIN_ORDERS).alias("eligible_min_orders"),
        tiers.scalar().alias("tier_counts"))
    return lb.select(F.to_json(F.struct(
        meta.alias("meta"), F.col("merchants"), ch.scalar().alias("channel_risk"),
        bm.scalar().alias("cfpb_benchmarks")), {"ignoreNullFields": "false"}).alias("value"))


PARSED = ("struct<meta: struct<tier_counts: map<string, bigint>>, merchants: array<struct<merchant_id: string, orders: bigint, tier: string>>, "
          "channel_risk: array<struct<initiation_channel: string, payments: bigint>>, cfpb_benchmarks: array<struct<product: string, complaints: bigint>>>")


def parsed(doc: DataFrame) -> DataFrame:
    """A document read back as rows: (section, place, name, note, n), lists in their order."""
    d = doc.select(F.from_json("value", PARSED).alias("d"))
    nothing = F.lit(None).cast("string")

    def part(section: str, items, name, note, n) -> DataFrame:
        rows = d.select(F.posexplode(items).alias("place", "x"))
        return rows.select(F.lit(section).alias("section"), "place", name.alias("name"), note.alias("note"), n.alias("n"))

    x = F.col("x")
    tiers = part("tier_counts", F.array_sort(F.map_entries("d.meta.tier_counts")), x["key"], nothing, x["value"])
    return (tiers.unionByName(part("merchants", F.col("d.merchants"), x["merchant_id"], x["tier"], x["orders"]))
            .unionByName(part("channel_risk", F.col("d.channel_risk"), x["initiation_channel"], nothing, x["payments"]))
            .unionByName(part("cfpb_benchmarks", F.col("d.cfpb_benchmarks"), x["product"], nothing, x["complaints"])))
