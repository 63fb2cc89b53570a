"""Projections of the driver tables onto the marketplace schemas (the ``f_*`` views of FIXTURES.md).

Each function reads the driver parquet tables and returns the projected DataFrame; the oracle side
(``marketlake.plans.oracle``) declares the same views in DuckDB SQL. Every derived value is plain
integer / double arithmetic so both engines agree row for row. Row fan-outs that the SQL writes
as ``cross join (values ...)`` or ``union all`` of the same table are written here as one scan plus
``explode`` of a literal array, so no cartesian product or second scan appears in the plan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketlake.session import parts_for
from marketlake.sources.tables import table


def f_orders(spark: SparkSession, sf: str) -> DataFrame:
    return (
        table(spark, sf, "orders")
        .selectExpr(
            "o_orderkey", "o_custkey", "o_orderdate",
            """case when o_orderstatus in ('F', 'O') then 'delivered'
                    when o_orderkey % 7 = 3 then 'canceled'
                    when o_orderkey % 7 = 5 then 'unavailable' else 'shipped' end as st""")
        .selectExpr(
            "o_orderkey as order_id", "o_custkey as customer_id", "st as order_status",
            "o_orderdate as purchased_at",
            "o_orderdate + make_dt_interval(0, 0, 0, (o_orderkey % 48) * 3600) as approved_at",
            """case when st in ('delivered', 'shipped')
                    then o_orderdate + make_dt_interval(cast(1 + (o_orderkey div 10) % 4 as int)) end as carrier_at""",
            """case when st = 'delivered'
                    then o_orderdate + make_dt_interval(cast(8 + (o_orderkey % 10) * 2 + o_custkey % 3 as int))
               end as delivered_at""",
            "o_orderdate + make_dt_interval(cast(14 + o_custkey % 8 as int)) as estimated_at")
    )


def f_items(spark: SparkSession, sf: str) -> DataFrame:
    # sellers differ in volume: lines of small sellers go to the large seller (number ...8) of their ten
    # lines are dealt by order into as many tasks as their size needs: what the queries do per order follows in the same tasks
    lines = table(spark, sf, "lineitem")
    li = lines.repartition(parts_for(lines), "l_orderkey").withColumn("seller", F.expr(
        """case when l_suppkey % 10 = 9 and l_orderkey % 400 <> 7 or l_suppkey % 10 < 8 and l_orderkey % 10 > l_suppkey % 10 + 1
                then l_suppkey - l_suppkey % 10 + 8 else l_suppkey end"""))
    o = table(spark, sf, "orders").select("o_orderkey", "o_orderdate")
    return li.join(o, li.l_orderkey == o.o_orderkey).selectExpr(
        "l_orderkey as order_id", "l_linenumber as item_no", "l_partkey as product_id", "seller as seller_id",
        "o_orderdate + make_dt_interval(cast(3 + seller % 6 as int)) as ship_by",
        "l_extendedprice * (4 + seller % 7) / 8 as price_brl",
        "l_tax * 100 as freight_brl")


def f_reviews(spark: SparkSession, sf: str) -> DataFrame:
    return (
        table(spark, sf, "orders")
        .select("o_orderkey", "o_custkey", "o_orderdate",
                F.explode(F.when(F.col("o_orderkey") % 11 == 0, F.array(F.lit(0), F.lit(1)))
                          .otherwise(F.array(F.lit(0)))).alias("v"))
        .selectExpr(
            "o_orderkey div 2 as review_id", "o_orderkey as order_id", "v",
            """case when o_orderkey % 7 = 0 then null when v = 1 then 3 when o_custkey % 6 = 0 then 5
                    else cast(5 - (o_orderkey % 10) div 2 as int) end as score""",
            "o_orderdate + make_dt_interval(30) as created_at",
            "o_orderdate + make_dt_interval(cast(33 - v as int)) as answered_at")
    )


def f_products(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "part").selectExpr(
        "p_partkey as product_id",
        "case when p_partkey % 50 = 0 or p_brand = 'Brand#7' then 'unknown' else lower(p_brand) end as category")


def f_sellers(spark: SparkSession, sf: str) -> DataFrame:
    s = table(spark, sf, "supplier").select("s_suppkey", "s_nationkey")
    n = table(spark, sf, "nation").select("n_nationkey", "n_name", "n_regionkey")
    r = table(spark, sf, "region").select("r_regionkey", "r_name")
    return (s.join(n, s.s_nationkey == n.n_nationkey).join(r, F.col("n_regionkey") == r.r_regionkey)
            .selectExpr("s_suppkey as seller_id", "lower(n_name) as city", "lower(substr(r_name, 1, 2)) as state"))


# Fixed values of the FX fixture: currency and base rate per USD.
FX_BASE_RATES = [("BRL", 3.5), ("EUR", 0.9), ("GBP", 0.8), ("JPY", 110.0)]


def f_fx(spark: SparkSession, sf: str) -> DataFrame:
    days = (table(spark, sf, "orders").select(F.to_date("o_orderdate").alias("d"))
            .union(table(spark, sf, "events").select(F.to_date("ts").alias("d")))
            .distinct())
    ccy = F.array(*[F.struct(F.lit(c).alias("c"), F.lit(float(b)).alias("b")) for c, b in FX_BASE_RATES])
    return (days.select("d", F.inline(ccy))
            .select(F.col("d").alias("date"), F.lit("USD").alias("base"), F.col("c").alias("currency"),
                    F.when(~((F.col("c") == "BRL") & (F.month("d") == 4)),  # no rate that month
                           F.round(F.col("b") * (1 + (F.dayofmonth("d") % 7) / F.lit(100.0)), 6)).alias("rate")))


def f_complaints(spark: SparkSession, sf: str) -> DataFrame:
    return (
        table(spark, sf, "documents").select("doc_id", "source")
        .select("doc_id", "source",
                F.explode(F.when(F.col("doc_id") % 13 == 0, F.array(F.lit(0), F.lit(1)))
                          .otherwise(F.array(F.lit(0)))).alias("v"))
        .selectExpr(
            "doc_id as complaint_id", "concat('co', doc_id % 20) as company", "source as product",
            "concat('issue', doc_id % 5) as issue", "v",
            "case when doc_id % 9 = v then 'No' else 'Yes' end as timely",
            """case doc_id % 4 when 0 then 'Closed with monetary relief'
                               when 1 then 'Closed with non-monetary relief'
                               when 2 then 'Closed with explanation' end as company_response""",
            "date_add(date'2024-01-01', cast(doc_id % 90 as int)) as received_on",
            "timestamp_ntz'2024-06-01 00:00:00' + make_dt_interval(cast(v as int)) as _ingested_at")
    )


def f_events_raw(spark: SparkSession, sf: str) -> DataFrame:
    """Payment webhook envelopes with the four delivery quirks: redelivery (every 33rd event twice,
    seven minutes later), disorder, unknown / NULL api version, unknown and zero-decimal currency."""
    e = table(spark, sf, "events").selectExpr(
        "event_id", "ts", "user_id", "value",
        """case when event_type in ('purchase', 'signup', 'view') then 'payment_intent.created'
                when event_type = 'click' then 'payment_intent.succeeded'
                when event_id % 3 = 0 then 'charge.dispute.created' else 'payment_intent.canceled' end as typ""",
        """case when event_id % 20 < 12 then 'human_initiated' when event_id % 20 < 18 then 'agent_delegated'
                else 'agent_to_agent' end as chan""",
        """case when event_id % 500 = 3 then 'xxx' when event_id % 10 < 6 then 'usd' when event_id % 10 < 8 then 'eur'
                when event_id % 10 = 8 then 'gbp' else 'jpy' end as ccy""")
    r = e.selectExpr(
        "event_id as k", "typ", "chan", "ccy", "user_id", "value",
        "case when typ = 'charge.dispute.created' then ts + make_dt_interval(5) else ts end as created")
    r = r.selectExpr(
        "k", "concat('evt_', k) as event_id", "typ as event_type",
        """case when k % 100 = 0 then '2099-01-01.unknown' when k % 97 = 1 then null
                when k % 4 = 0 then '2023-10-16' when k % 4 = 1 then '2024-06-20' else '2025-03-31' end as api_version""",
        "created", "created + make_dt_interval(0, 0, 0, (k * 3701) % 7200) as ingested_at",
        """concat('{"object":"', split_part(typ, '.', 1), '","id":"obj_', k div 3,
                  '","amount":', cast(round(value * case when ccy = 'jpy' then 110 else 100 end) as bigint),
                  ',"currency":"', ccy, '","on_behalf_of":"acct_', user_id % 40, '","initiation_channel":"', chan, '"',
                  case when chan <> 'human_initiated'
                       then concat(',"mandate_id":"mand_', user_id % 60, '","mandate_violation":',
                                   case when k % 17 = 0 then 'true' else 'false' end,
                                   ',"metadata":{"agent_id":"agt_', user_id % 50, '","session_id":"ses_', k % 300,
                                   '","attestation_token_hash":"h', k % 7, '","human_confirmed":"',
                                   case when k % 3 = 0 then 'true' else 'false' end, '"}')
                       else '' end,
                  case when typ = 'charge.dispute.created'
                       then concat(',"charge":"', case when k % 2 = 0 then concat('obj_', (k + 3) div 3) else concat('ch_', k) end, '","reason":"',
                                   case when k % 2 = 0 then 'fraudulent' else 'product_not_received' end, '"')
                       else '' end,
                  '}') as payload""")
    redeliver = F.explode(F.when(F.col("k") % 33 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))
    return (r.select("*", redeliver.alias("copy"))
            .selectExpr("event_id", "event_type", "api_version", "created",
                        "ingested_at + make_dt_interval(0, 0, 0, copy * 420) as ingested_at",
                        "payload", "false as livemode"))


def f_mandates(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "customer").selectExpr(
        "c_custkey as mandate_id", "c_custkey as customer_id", "c_custkey % 50 as agent_id",
        "timestamp_ntz'2024-01-01 00:00:00' as issued_at",
        "timestamp_ntz'2024-01-05 00:00:00' + make_dt_interval(cast(c_custkey % 40 as int)) as expires_at",
        "case when c_custkey % 21 = 0 then timestamp_ntz'2024-01-15 00:00:00' end as revoked_at",
        "50 + c_custkey % 200 as max_amount_per_txn", "1 + c_custkey % 30 as max_txn_count",
        "c_custkey % 8 = 0 as single_use",
        "case when c_custkey % 5 <> 0 then c_custkey - 1 end as parent_mandate_id",
        """case when c_custkey % 4 <> 0 then array(concat('cat', c_custkey % 6), concat('cat', (c_custkey + 2) % 6))
           end as allowed_merchant_categories""")


def f_accounts(spark: SparkSession, sf: str) -> DataFrame:
    """Versions of merchants' external accounts: bank, owner and standing from ``valid_from`` to before ``valid_to``."""
    return (table(spark, sf, "customer")
            .selectExpr("c_custkey as k", "timestamp_ntz'2023-10-01 00:00:00' + make_dt_interval(cast(c_custkey * 13 % 125 as int)) as valid_from")
            .selectExpr("k as account_version", "k % 40 as merchant_id", "500000000 + k * 7 % 31 + k % 13 div 12 * k as bank_id",
                        "600000000 + k * 11 % 53 as owner_id", "valid_from",
                        "case when k % 3 <> 0 then valid_from + make_dt_interval(cast(5 + k % 30 as int)) end as valid_to",
                        "k % 7 <> 0 as charges_enabled", "k % 11 <> 0 as payouts_enabled", "cast(k % 5 as int) as requirements_due"))


def f_edges(spark: SparkSession, sf: str) -> DataFrame:
    c = F.col("c_custkey")
    kinds = F.array(
        F.struct(F.lit("customer_device").alias("kind"), (F.lit(100000000) + F.expr("c_custkey div 3")).alias("dst")),
        # two of ten customers share an address, the others have their own
        F.struct(F.lit("customer_ip").alias("kind"),
                 F.expr("case when c_custkey % 5 = 0 then 200000000 + c_custkey div 10 else 300000000 + c_custkey end").alias("dst")))
    seen = F.expr("timestamp_ntz'2023-12-01 00:00:00' + make_dt_interval(cast(c_custkey % 90 as int))")
    return (table(spark, sf, "customer").select(c.alias("src"), seen.alias("valid_from"), F.inline(kinds))
            .select("kind", "src", "dst", "valid_from"))


def f_agents(spark: SparkSession, sf: str) -> DataFrame:
    return (table(spark, sf, "customer").selectExpr("c_custkey % 50 as a").distinct().selectExpr(
        "a as agent_id", "concat('op', a % 7) as claimed_operator",
        "case when a % 9 <> 0 then concat('op', a % 7) end as verified_operator",
        """case a % 4 when 0 then 'none' when 1 then 'self_asserted' when 2 then 'operator_attested'
                else 'issuer_verified' end as attestation_level""",
        "timestamp_ntz'2024-01-10 00:00:00' + make_dt_interval(cast(a as int)) as attestation_expires_at",
        "timestamp_ntz'2023-12-01 00:00:00' + make_dt_interval(cast(a as int)) as first_seen"))


def f_txns(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "events").selectExpr(
        "event_id as txn_id", "user_id as customer_id", "(event_id * 31) % 40 as merchant_id",
        "user_id % 50 as agent_id", "case when event_id % 20 >= 12 then user_id end as mandate_id", "user_id * 100 + day(ts) as session_id",
        "(user_id div 3) + (event_id % 29) div 28 * 1000 as device_id",
        "concat('C', (user_id + (event_id % 37) div 36) % 12) as country",
        "cast(user_id % 60 - 30 + event_id % 3 as double) as lat",
        "cast(user_id % 120 - 60 + event_id % 5 as double) as lon",
        "ts", "value as amount",
        """case when event_id % 20 < 12 then 'human_initiated' when event_id % 20 < 18 then 'agent_delegated'
                else 'agent_to_agent' end as channel""",
        "event_type = 'error' as declined", "event_id % 41 = 0 as refunded",
        "cast((event_id * 7919) % 100 as int) as risk_score",
        "concat('cat', (event_id * 31) % 40 % 6) as merchant_category",
        "event_id % 13 = 0 and event_id % 4 <> 1 as is_fraud",
        "case when event_id % 13 = 0 and event_id % 4 <> 1 then concat('scn', event_id % 7) end as scenario")


def f_disputes(spark: SparkSession, sf: str) -> DataFrame:
    return (table(spark, sf, "events").where("event_id % 13 = 0")
            .selectExpr("event_id", "ts + make_dt_interval(cast(7 + event_id % 39 as int)) as c")
            .selectExpr(
                "event_id as dispute_id", "event_id as txn_id", "c as created",
                "case when event_id % 5 <> 0 then c + make_dt_interval(cast(20 + event_id % 56 as int)) end as resolved_at",
                """case when event_id % 5 = 0 then 'needs_response' when event_id % 2 = 0 then 'lost'
                        else 'won' end as final_status""",
                """case event_id % 4 when 0 then 'fraudulent' when 1 then 'product_not_received'
                                     when 2 then 'fraudulent' else 'subscription_canceled' end as reason"""))


def f_sessions(spark: SparkSession, sf: str) -> DataFrame:
    return (table(spark, sf, "events")
            .groupBy("user_id", F.dayofmonth("ts").alias("d"))
            .agg(F.min("ts").alias("t0"), F.max("ts").alias("t1"), F.min("event_id").alias("e0"))
            .selectExpr(
                "user_id * 100 + d as session_id", "user_id as customer_id", "user_id % 50 as agent_id",
                "t0 - make_dt_interval(0, 0, 0, e0 % 90) as started_at", "t1 as ended_at",
                "e0 % 8 <> 0 as user_intent_present", "cast(e0 % 12 as int) as tool_calls_count", "cast(10 + e0 % 50 as int) as tool_call_every_s"))


FIXTURES = {
    "f_orders": f_orders, "f_items": f_items, "f_reviews": f_reviews, "f_products": f_products,
    "f_sellers": f_sellers, "f_fx": f_fx, "f_complaints": f_complaints, "f_events_raw": f_events_raw,
    "f_mandates": f_mandates, "f_edges": f_edges, "f_agents": f_agents, "f_txns": f_txns,
    "f_disputes": f_disputes, "f_sessions": f_sessions, "f_accounts": f_accounts,
}
