"""Registered queries: Silver (A100-A110), payment / channel / complaint Gold (A132-A135), export
(A136-A138), data quality (A150-A156) and the primitives no composite covers."""

from __future__ import annotations

from pyspark.sql import functions as F

from marketlake.operators import events, gold, quality, silver
from marketlake.plans import export
from marketlake.plans.catalog import _MERCHANT_SQL, SCORE_VIEWS, SQL_SCORES, merchant_table, r6, register, silver_inputs
from marketlake.plans.oracle import with_views
from marketlake.plans.present import present
from marketlake.sources import fixtures as fx
from marketlake.sources import landing

# ------------------------------------------------------------------ Silver (A100-A106)


@register("a100_silver_orders", with_views(["f_orders"], "select * from f_orders"))
def a100_silver_orders(spark, sf):
    return present(silver.orders(fx.f_orders(spark, sf)))


@register("a100_orders_landed_text", with_views(["f_orders"], """
select order_id, customer_id, order_status, purchased_at, approved_at, carrier_at, delivered_at, estimated_at, cast(null as varchar) as reason
from f_orders where order_id % 13 <> 0 and not (order_id % 19 = 0 and delivered_at is not null)
union all
select order_id, customer_id + k, order_status, null, null, null, null, null, case when order_id % 13 = 0 then 'bad_order_purchase_timestamp' else 'bad_order_delivered_customer_date' end
from f_orders, range(0, 2) r(k)
where (order_id % 13 = 0 or (order_id % 19 = 0 and delivered_at is not null)) and (k = 0 or order_id % 10 = 0)"""))
def a100_orders_landed_text(spark, sf):
    """Orders as landed: text columns, some of which don't parse, and every tenth order twice (with another customer)."""
    raw = fx.f_orders(spark, sf).withColumn("k", F.explode(F.when(F.col("order_id") % 10 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))))
    text = raw.selectExpr("order_id", "customer_id + k as customer_id", "order_status",
                          "case when order_id % 13 = 0 then 'last week' else cast(purchased_at as string) end as order_purchase_timestamp",
                          "cast(approved_at as string) as order_approved_at", "cast(carrier_at as string) as order_delivered_carrier_date",
                          "case when order_id % 19 = 0 then substr(cast(delivered_at as string), 1, 5) || '?' else cast(delivered_at as string) end as order_delivered_customer_date",
                          "cast(estimated_at as string) as order_estimated_delivery_date")
    good, bad = silver.parsed(text, "olist/orders")
    empty = [F.lit(None).cast("timestamp_ntz").alias(c) for c in ("purchased_at", "approved_at", "carrier_at", "delivered_at", "estimated_at")]
    return silver.orders(good).withColumn("reason", F.lit(None).cast("string")).unionByName(
        bad.select("order_id", "customer_id", "order_status", *empty, F.col("_reject_reason").alias("reason")))


@register("a101_silver_order_items", with_views(["f_items"], f"""
select order_id, item_no, product_id, seller_id, ship_by, {r6('price_brl freight_brl')} from f_items"""))
def a101_silver_order_items(spark, sf):
    return present(silver.order_items(fx.f_items(spark, sf)))


@register("a102_silver_reviews", with_views(["f_reviews"], """
select review_id, order_id, score, created_at, answered_at from (
  select *, row_number() over (partition by review_id, order_id order by answered_at desc) as rn from f_reviews)
where rn = 1"""))
def a102_silver_reviews(spark, sf):
    return present(silver.reviews(fx.f_reviews(spark, sf)))


# a translation for the categories that don't end in 3: the others become 'unknown'
@register("a103_silver_products", with_views(["f_products"], """
select product_id, case when category like '%3' then 'unknown' else 'en ' || category end as category from f_products"""))
def a103_silver_products(spark, sf):
    p = fx.f_products(spark, sf).withColumnRenamed("category", "product_category_name")
    translation = p.where("product_category_name not like '%3'").selectExpr(
        "product_category_name", "concat('en ', product_category_name) as product_category_name_english").distinct()
    return present(silver.products(p, translation))


# orders as text, with an amount and a date that don't parse in some rows and are missing in others
@register("a21_a22_typed_or_rejected", with_views(["f_orders"], """
select order_id, purchased_at, amount, reason from (
  select order_id, case when order_id % 13 = 0 then 'bad_purchased_at' when order_id % 17 = 0 then 'bad_amount' end as reason,
         case when order_id % 13 <> 0 and order_id % 17 <> 0 and order_id % 11 <> 0 then purchased_at end as purchased_at,
         case when order_id % 13 <> 0 and order_id % 17 <> 0 and order_id % 7 <> 0 then order_id * 1.5 end as amount
  from f_orders)"""))
def a21_a22_typed_or_rejected(spark, sf):
    text = fx.f_orders(spark, sf).selectExpr(
        "order_id",
        """case when order_id % 13 = 0 then 'on a Monday' when order_id % 11 <> 0 then cast(purchased_at as string) end as purchased_at""",
        """case when order_id % 17 = 0 then '1,5 or so' when order_id % 7 <> 0 then cast(order_id * 1.5D as string) end as amount""")
    good, bad = silver.typed_or_rejected(text, {"purchased_at": "timestamp", "amount": "double"})
    return good.selectExpr("order_id", "purchased_at", "amount", "cast(null as string) as reason").unionByName(
        bad.selectExpr("order_id", "cast(null as timestamp_ntz) as purchased_at", "cast(null as double) as amount",
                       "_reject_reason as reason"))


@register("a104_silver_sellers", with_views(["f_sellers"], "select seller_id, city, state from f_sellers"))
def a104_silver_sellers(spark, sf):
    return present(silver.sellers(fx.f_sellers(spark, sf)))


SQL_SILVER_COMPLAINTS = """cs AS (
  select complaint_id, company, product, issue, company_response, timely = 'Yes' as timely, received_on from (
    select *, row_number() over (partition by complaint_id order by _ingested_at desc) as rn from f_complaints)
  where rn = 1)"""


@register("a105_silver_complaints", with_views(["f_complaints"], """
select complaint_id, company, product, issue, company_response, timely, cast(received_on as timestamp) as received_on
from cs""", ctes=SQL_SILVER_COMPLAINTS))
def a105_silver_complaints(spark, sf):
    return present(silver.complaints(fx.f_complaints(spark, sf)))


@register("a106_silver_fx_rates", with_views(["f_fx"], """
select cast(date as timestamp) as date, base, currency, round(rate, 6) as rate from f_fx"""))
def a106_silver_fx_rates(spark, sf):
    return present(silver.fx_rates(fx.f_fx(spark, sf)))


@register("a106_fx_latest_receipt", with_views(["f_fx"], """
select cast(date as timestamp) as date, base, currency, round(rate + case when day(date) % 3 = 0 then 0.5 else 0 end, 6) as rate from f_fx"""))
def a106_fx_latest_receipt(spark, sf):
    """Rates received twice on some days: the later receipt counts."""
    first = fx.f_fx(spark, sf).withColumn("_ingested_at", F.lit("2024-05-01 00:00:00").cast("timestamp_ntz"))
    later = (first.where(F.dayofmonth("date") % 3 == 0).withColumn("rate", F.col("rate") + 0.5)
             .withColumn("_ingested_at", F.lit("2024-05-02 00:00:00").cast("timestamp_ntz")))
    return present(silver.fx_rates(first.unionByName(later)))


# ------------------------------------------------------------------ payment events (A107-A110, A11, B03, B04)

KNOWN = "('2023-10-16', '2024-06-20', '2025-03-31')"
SQL_EVENTS = f"""gd AS (select * from f_events_raw where coalesce(api_version in {KNOWN}, false)),
bad_version AS (select *, 'unknown_api_version' as _reject_reason from f_events_raw
                where not coalesce(api_version in {KNOWN}, false)),
dd AS (select * exclude (rn) from (
  select *, row_number() over (partition by event_id order by ingested_at, created, payload) as rn from gd) where rn = 1),
pj AS (
  select dd.*,
    json_extract_string(payload, '$.id') as object_id,
    json_extract_string(payload, '$.on_behalf_of') as account_id,
    json_extract_string(payload, '$.initiation_channel') as initiation_channel,
    json_extract_string(payload, '$.mandate_id') as mandate_id,
    coalesce(cast(json_extract_string(payload, '$.mandate_violation') as boolean), false) as mandate_violation,
    json_extract_string(payload, '$.payment_intent') as payment_intent_id,
    json_extract_string(payload, '$.charge') as charge_id,
    json_extract_string(payload, '$.reason') as dispute_reason,
    cast(json_extract_string(payload, '$.risk_score') as integer) as risk_score,
    json_extract_string(payload, '$.currency') as currency,
    cast(json_extract_string(payload, '$.amount') as bigint) as amount_minor
  from dd),
bad_ccy AS (select event_id, event_type, api_version, created, ingested_at, payload, 'unknown_currency' as _reject_reason
            from pj where not coalesce(currency in ('usd', 'eur', 'gbp', 'brl', 'jpy'), false)),
ev AS (
  select event_id, event_type, api_version, created, ingested_at, object_id, account_id, initiation_channel, mandate_id,
         mandate_violation, payment_intent_id, charge_id, dispute_reason, risk_score, currency, amount_minor,
         cast(amount_minor / power(10, case currency when 'jpy' then 0 else 2 end) as decimal(20, 4)) as amount,
         cast(created as date) as created_on
  from pj where currency in ('usd', 'eur', 'gbp', 'brl', 'jpy')),
spot AS (
  select lower(currency) as currency, arg_max(rate, date) as per_usd from f_fx where lower(currency) <> 'usd' group by 1
  union all select 'usd', 1.0),
evu AS (select ev.*, cast(ev.amount as double) / s.per_usd as amount_usd from ev left join spot s on ev.currency = s.currency)"""
EVENT_VIEWS = ["f_events_raw", "f_fx"]


def silver_events(spark, sf):
    return silver.stripe_events(fx.f_events_raw(spark, sf))


@register("a107_quarantine_versions", with_views(EVENT_VIEWS, """
select event_id, api_version, ingested_at, _reject_reason from bad_version""", ctes=SQL_EVENTS))
def a107_quarantine_versions(spark, sf):
    _, rejected = silver.quarantine(fx.f_events_raw(spark, sf))
    return rejected.select("event_id", "api_version", "ingested_at", "_reject_reason")


@register("a108_dedupe_events", with_views(EVENT_VIEWS, "select event_id, created, ingested_at from dd",
                                           ctes=SQL_EVENTS))
def a108_dedupe_events(spark, sf):
    good, _ = silver.quarantine(fx.f_events_raw(spark, sf))
    return silver.dedupe_events(good).select("event_id", "created", "ingested_at")


@register("a11_reject_split", with_views(EVENT_VIEWS, """
select event_id, ingested_at, _reject_reason from bad_version
union all select event_id, ingested_at, _reject_reason from bad_ccy""", ctes=SQL_EVENTS))
def a11_reject_split(spark, sf):
    _, rejected = silver_events(spark, sf)
    return rejected.select("event_id", "ingested_at", "_reject_reason")


@register("a110_silver_stripe_events", with_views(EVENT_VIEWS, """
select * exclude (amount, created_on), round(cast(amount as double), 6) as amount,
       cast(created_on as timestamp) as created_on from ev""", ctes=SQL_EVENTS))
def a110_silver_stripe_events(spark, sf):
    good, _ = silver_events(spark, sf)
    return present(good)


@register("a110_events_without_ids", with_views(["f_events_raw"], f"""
select event_id, ingested_at, reason from (
  select *, case when event_id is null then 'missing_id' when not coalesce(api_version in {KNOWN}, false) then 'unknown_api_version'
                 when not coalesce(json_extract_string(payload, '$.currency') in ('usd', 'eur', 'gbp', 'brl', 'jpy'), false) then 'unknown_currency' end as reason
  from n)
qualify reason in ('missing_id', 'unknown_api_version') or row_number() over (partition by event_id order by ingested_at) = 1""", ctes="""
n AS (select * replace (case when cast(substr(event_id, 5) as bigint) % 7 <> 0 then event_id end as event_id) from f_events_raw)"""))
def a110_events_without_ids(spark, sf):
    """Every seventh event has no id: each receipt of it is a reject of its own."""
    raw = fx.f_events_raw(spark, sf).withColumn("event_id", F.when(F.substring("event_id", 5, 20).cast("long") % 7 != 0, F.col("event_id")))
    good, rejected = silver.stripe_events(raw)
    return good.select("event_id", "ingested_at", F.lit(None).cast("string").alias("reason")).unionByName(
        rejected.select("event_id", "ingested_at", F.col("_reject_reason").alias("reason")))


@register("b03_orphan_disputes", with_views(EVENT_VIEWS, """
select d.event_id, d.charge_id from ev d
where d.event_type = 'charge.dispute.created'
  and not exists (select 1 from ev p where p.object_id = d.charge_id)""", ctes=SQL_EVENTS))
def b03_orphan_disputes(spark, sf):
    ev, _ = silver_events(spark, sf)
    disputes = ev.where(F.col("event_type") == "charge.dispute.created")
    return silver.orphans(disputes, ev, "charge_id", "object_id").select("event_id", "charge_id")


@register("b04_promote_metadata", with_views(["f_events_raw"], """
select event_id, ingested_at,
  coalesce(json_extract_string(payload, '$.metadata.agent_id'), json_extract_string(payload, '$.agent_id')) as agent_id,
  coalesce(json_extract_string(payload, '$.metadata.mandate_id'), json_extract_string(payload, '$.mandate_id')) as mandate_id,
  coalesce(json_extract_string(payload, '$.metadata.session_id'), json_extract_string(payload, '$.session_id')) as session_id,
  coalesce(json_extract_string(payload, '$.metadata.attestation_token_hash'),
           json_extract_string(payload, '$.attestation_token_hash')) as attestation_token_hash,
  cast(coalesce(json_extract_string(payload, '$.metadata.human_confirmed'),
                json_extract_string(payload, '$.human_confirmed')) as boolean) as human_confirmed
from f_events_raw"""))
def b04_promote_metadata(spark, sf):
    df = silver.promote_metadata(fx.f_events_raw(spark, sf))
    return df.select("event_id", "ingested_at", *[n for n, _ in silver.METADATA_FIELDS])


@register("b08_silver_objects", with_views(EVENT_VIEWS, """
select kind, object_id, arg_max(event_type, (created, event_id)) as status, count(*) as n_events, min(created) as first_at, max(created) as last_at,
       round(cast(arg_max(amount, (created, event_id)) as double), 6) as amount, arg_max(account_id, (created, event_id)) as account_id
from (select *, case when event_type like 'charge.dispute.%' then 'dispute' else 'payment_intent' end as kind from ev)
group by kind, object_id""", ctes=SQL_EVENTS))
def b08_silver_objects(spark, sf):
    """The object tables that events build: payment intents and disputes, each object once in its current state."""
    ev, _ = silver_events(spark, sf)
    tables = [silver.objects(ev, kind).withColumn("kind", F.lit(kind)).drop("ladder") for kind in ("payment_intent", "dispute")]
    return present(tables[0].unionByName(tables[1]))


@register("b08_b09_object_state", with_views(EVENT_VIEWS, """
select s.object_id, s.status, l.ladder, s.n_events, s.first_at, s.last_at
from (select object_id, arg_max(event_type, (created, event_id)) as status, count(*) as n_events,
             min(created) as first_at, max(created) as last_at from ev group by object_id) s
join (select object_id, string_agg(event_type, '>' order by created, event_id) as ladder
      from (select * from ev qualify row_number() over (partition by object_id, event_type
                                                        order by created, event_id) = 1)
      group by object_id) l on s.object_id = l.object_id""", ctes=SQL_EVENTS))
def b08_b09_object_state(spark, sf):
    ev, _ = silver_events(spark, sf)
    st = silver.latest_state(ev, "object_id")
    return st.select("object_id", "status", F.array_join("ladder", ">").alias("ladder"), "n_events",
                     "first_at", "last_at")


# ------------------------------------------------------------------ payment / channel / complaints (A132-A135)

@register("a132_events_usd", with_views(EVENT_VIEWS, """
select event_id, currency, round(cast(amount as double), 6) as amount, round(amount_usd, 6) as amount_usd from evu""",
                                        ctes=SQL_EVENTS))
def a132_events_usd(spark, sf):
    ev, _ = silver_events(spark, sf)
    return present(gold.to_usd(ev, silver.fx_rates(fx.f_fx(spark, sf)))
                   .select("event_id", "currency", "amount", "amount_usd"))


SQL_PAY_RISK = """pay_risk AS (
  select account_id,
    count(*) filter (where event_type = 'payment_intent.created') as payments,
    sum(amount_usd) filter (where event_type = 'payment_intent.created') as volume_usd,
    avg(cast(initiation_channel <> 'human_initiated' as int)) filter (where event_type = 'payment_intent.created') as agent_share,
    cast(sum(cast(mandate_violation as int)) filter (where event_type = 'payment_intent.created') as bigint) as mandate_violations,
    count(*) filter (where event_type = 'charge.dispute.created') as disputes
  from evu group by account_id
  having count(*) filter (where event_type = 'payment_intent.created') > 0)"""


def payment_risk_df(spark, sf):
    ev, _ = silver_events(spark, sf)
    return gold.payment_risk(gold.to_usd(ev, silver.fx_rates(fx.f_fx(spark, sf))))


@register("a133_merchant_payment_risk", with_views(EVENT_VIEWS, f"""
select account_id, payments, round(volume_usd, 2) as volume_usd, {r6('agent_share')}, mandate_violations, disputes,
       round(disputes / payments, 6) as dispute_rate, round(mandate_violations / payments, 6) as mandate_violation_rate
from pay_risk""", ctes=SQL_EVENTS + ",\n" + SQL_PAY_RISK))
def a133_merchant_payment_risk(spark, sf):
    return present(payment_risk_df(spark, sf), money=["volume_usd"])


@register("a134_channel_risk", with_views(EVENT_VIEWS, """
select initiation_channel, payments, round(avg_amount_usd, 6) as avg_amount_usd, round(volume_usd, 2) as volume_usd,
       disputes, canceled, round(disputes / payments, 6) as dispute_rate, round(canceled / payments, 6) as cancel_rate
from (select initiation_channel,
        count(*) filter (where event_type = 'payment_intent.created') as payments,
        avg(amount_usd) filter (where event_type = 'payment_intent.created') as avg_amount_usd,
        sum(amount_usd) filter (where event_type = 'payment_intent.created') as volume_usd,
        count(*) filter (where event_type = 'charge.dispute.created') as disputes,
        count(*) filter (where event_type = 'payment_intent.canceled') as canceled
      from evu group by initiation_channel)
where payments > 0""", ctes=SQL_EVENTS))
def a134_channel_risk(spark, sf):
    ev, _ = silver_events(spark, sf)
    return present(gold.channel_risk(gold.to_usd(ev, silver.fx_rates(fx.f_fx(spark, sf)))), money=["volume_usd"])


SQL_BENCH = SQL_SILVER_COMPLAINTS + """,
bench AS (
  select product, count(*) as complaints, avg(cast(timely as int)) as timely_response_rate,
         avg(cast(company_response in ('Closed with monetary relief', 'Closed with non-monetary relief') as int)) as relief_rate,
         avg(cast(company_response = 'Closed with explanation' as int)) as explanation_only_rate
  from cs group by product)"""


def benchmarks_df(spark, sf):
    return gold.benchmarks(silver.complaints(fx.f_complaints(spark, sf)))


@register("a135_dispute_benchmarks", with_views(["f_complaints"], f"""
select product, complaints, {r6('timely_response_rate relief_rate explanation_only_rate')} from bench""",
                                               ctes=SQL_BENCH))
def a135_dispute_benchmarks(spark, sf):
    return present(benchmarks_df(spark, sf))


# ------------------------------------------------------------------ export (A136-A138)

_LB_DIMS = ", ".join(f"round(m.{d}, 6) as {d}" for d in gold.DIMENSIONS)


@register("a136_export_leaderboard", with_views(SCORE_VIEWS + ["f_events_raw"], f"""
select m.merchant_id, m.merchant_name as name, m.state, cast(m.n_orders as bigint) as orders,
       round(m.mdt_score, 6) as mdt_score, m.tier, {_LB_DIMS}, round(m.avg_review, 6) as avg_review,
       round(m.avg_ticket_usd, 2) as avg_ticket_usd, p.payments, round(p.volume_usd, 2) as volume_usd,
       round(p.agent_share, 6) as agent_share, round(p.disputes / p.payments, 6) as dispute_rate,
       round(p.mandate_violations / p.payments, 6) as mandate_violation_rate
from (select * from merchants where eligible order by mdt_score desc, merchant_id limit 200) m
left join pay_risk p on m.account_id = p.account_id""",
                                               ctes=SQL_SCORES + ",\n" + SQL_EVENTS + ",\n" + SQL_PAY_RISK))
def a136_export_leaderboard(spark, sf):
    lb = export.leaderboard(merchant_table(spark, sf), payment_risk_df(spark, sf))
    return present(lb.select("merchant_id", "name", "state", "orders", "mdt_score", "tier", "dimensions.*",
                             "avg_review", "avg_ticket_usd", "payment_risk.*"),
                   money=["avg_ticket_usd", "volume_usd"])


@register("a137_export_tier_counts", with_views(SCORE_VIEWS, """
select tier, count(*) as n from merchants where eligible group by tier""", ctes=SQL_SCORES))
def a137_export_tier_counts(spark, sf):
    return export.tier_counts(merchant_table(spark, sf))


@register("a137_document_rows", with_views(SCORE_VIEWS + ["f_events_raw", "f_complaints"], """
select 'tier_counts' as section, cast(row_number() over (order by tier) - 1 as int) as place, tier as name, cast(null as varchar) as note, count(*) as n
from merchants where eligible group by tier
union all
select 'merchants', cast(place as int), cast(merchant_id as varchar), tier, n_orders
from (select *, row_number() over (order by mdt_score desc, merchant_id) - 1 as place from merchants where eligible) where place < 40
union all
select 'channel_risk', cast(row_number() over (order by initiation_channel) - 1 as int), initiation_channel, null, count(*) filter (where event_type = 'payment_intent.created')
from evu group by initiation_channel
union all
select 'cfpb_benchmarks', cast(place as int), product, null, complaints
from (select product, complaints, row_number() over (order by complaints desc, product) - 1 as place from bench) where place < 3""",
    ctes=SQL_SCORES + ",\n" + SQL_EVENTS + ",\n" + SQL_BENCH))
def a137_document_rows(spark, sf):
    """The nested document, written with limits that bite and read back."""
    ev_usd = gold.to_usd(silver_events(spark, sf)[0], silver.fx_rates(fx.f_fx(spark, sf)))
    doc = export.document(merchant_table(spark, sf), gold.payment_risk(ev_usd), gold.channel_risk(ev_usd), benchmarks_df(spark, sf),
                          "2024-06-01T00:00:00Z", merchants_kept=40, benchmarks_kept=3)
    return export.parsed(doc)


@register("a137_export_document")
def a137_export_document(spark, sf):
    """The full nested JSON document (one row); checked for shape in tests."""
    ev, _ = silver_events(spark, sf)
    ev_usd = gold.to_usd(ev, silver.fx_rates(fx.f_fx(spark, sf)))
    return export.document(merchant_table(spark, sf), gold.payment_risk(ev_usd), gold.channel_risk(ev_usd),
                           benchmarks_df(spark, sf), "1970-01-01T00:00:00+00:00")


@register("a138_top15_benchmarks", with_views(["f_complaints"], f"""
select product, complaints, {r6('timely_response_rate relief_rate explanation_only_rate')} from bench
order by complaints desc, product limit 15""", ctes=SQL_BENCH))
def a138_top15_benchmarks(spark, sf):
    return present(export.top_benchmarks(benchmarks_df(spark, sf)))


# ------------------------------------------------------------------ data quality (A150-A156)

def _sql_str(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _dq_sql(name: str, source: str, spec: dict) -> str:
    """Oracle rows of one table's checks, one SELECT per check (independent of the Spark plan)."""
    parts = []
    mr = spec.get("min_rows", 1)
    parts.append(f"select {_sql_str(name)} as \"table\", 'min_rows' as \"check\", count(*) >= {mr} as ok, "
                 f"cast(count(*) as varchar) || {_sql_str(f' >= {mr}')} as detail from {source}")
    for c in spec.get("not_null", []):
        parts.append(f"select {_sql_str(name)}, {_sql_str(f'not_null[{c}]')}, count(*) filter (where {c} is null) = 0, "
                     f"cast(count(*) filter (where {c} is null) as varchar) || ' nulls' from {source}")
    u = spec.get("unique", [])
    if u:
        cols = ", ".join(u)
        dup = f"((select count(*) from {source}) - (select count(*) from (select distinct {cols} from {source})))"
        parts.append(f"select {_sql_str(name)}, {_sql_str(f'unique{list(u)}')}, {dup} = 0, "
                     f"cast({dup} as varchar) || ' duplicates'")
    for c, (lo, hi) in spec.get("between", {}).items():
        cnt = f"count(*) filter (where {c} is not null and ({c} < {lo} or {c} > {hi}))"
        parts.append(f"select {_sql_str(name)}, {_sql_str(f'range[{c}]')}, {cnt} = 0, "
                     f"cast({cnt} as varchar) || {_sql_str(f' outside [{lo},{hi}]')} from {source}")
    return "\nunion all\n".join(parts)


_SILVER_SOURCES = {
    "olist_orders": "f_orders", "olist_reviews": "rv", "cfpb_complaints": "cs", "fx_rates": "f_fx",
    "stripe_events": "ev", "olist_order_items": "f_items", "olist_products": "f_products",
    "olist_sellers": "f_sellers",
}
_DQ_CTES = (
    """rv AS (select review_id, order_id, score, created_at, answered_at from (
  select *, row_number() over (partition by review_id, order_id order by answered_at desc) as rn from f_reviews)
  where rn = 1),\n""" + SQL_SILVER_COMPLAINTS + ",\n" + SQL_EVENTS)


@register("a150_a156_dq_silver", with_views(
    ["f_orders", "f_reviews", "f_complaints", "f_fx", "f_events_raw", "f_items", "f_products", "f_sellers"],
    "\nunion all\n".join(_dq_sql(n, _SILVER_SOURCES[n], quality.SILVER[n]) for n in quality.SILVER),
    ctes=_DQ_CTES))
def a150_a156_dq_silver(spark, sf):
    s = silver_inputs(spark, sf)
    ev, _ = silver_events(spark, sf)
    tables = {"olist_orders": s["orders"], "olist_reviews": s["reviews"],
              "cfpb_complaints": silver.complaints(fx.f_complaints(spark, sf)), "fx_rates": s["fx"],
              "stripe_events": ev, "olist_order_items": s["items"], "olist_products": s["products"],
              "olist_sellers": s["sellers"]}
    return quality.run_suite(spark, tables, quality.SILVER)


_BRONZE_SOURCES = {"olist/orders": "f_orders", "olist/order_items": "f_items", "olist/sellers": "f_sellers", "cfpb_complaints": "f_complaints", "fx_rates": "f_fx"}


@register("a155_dq_bronze", with_views(["f_orders", "f_items", "f_sellers", "f_complaints", "f_fx"],
    "\nunion all\n".join(_dq_sql(n, src, quality.BRONZE[n]) for n, src in _BRONZE_SOURCES.items())
    + "\nunion all select 'stripe_events_raw', 'exists', false, 'stripe_events_raw'"))
def a155_dq_bronze(spark, sf):
    """The Bronze suite; the events have not landed, which is a failed check and not an error."""
    read = {"olist/orders": fx.f_orders, "olist/order_items": fx.f_items, "olist/sellers": fx.f_sellers, "cfpb_complaints": fx.f_complaints, "fx_rates": fx.f_fx}
    tables = {name: f(spark, sf) for name, f in read.items()} | {"stripe_events_raw": None}
    return quality.run_suite(spark, tables, quality.BRONZE)


_GOLD_VIEWS = sorted({*SCORE_VIEWS, *EVENT_VIEWS, "f_complaints"})
_GOLD_CTES = f"""{SQL_SCORES},
{SQL_EVENTS},
{SQL_PAY_RISK},
g_merchants AS (select * from ({_MERCHANT_SQL})),
g_payments AS (select *, disputes / payments as dispute_rate, mandate_violations / payments as mandate_violation_rate from pay_risk),
g_channels AS (select initiation_channel, count(*) filter (where event_type = 'payment_intent.created') as payments from evu group by 1),
g_complaints AS (select product, count(*) as complaints, avg(cast(timely = 'Yes' as int)) as timely_response_rate
                 from (select * from f_complaints qualify row_number() over (partition by complaint_id order by _ingested_at desc) = 1) group by product)"""
_GOLD_SOURCES = {"merchant_dimension_scores": "g_merchants", "merchant_accounts": "g_merchants", "merchant_payment_risk": "g_payments",
                 "channel_risk": "g_channels", "external_dispute_benchmarks": "g_complaints"}


@register("a155_dq_gold", with_views(_GOLD_VIEWS, "\nunion all\n".join(_dq_sql(n, src, quality.GOLD[n]) for n, src in _GOLD_SOURCES.items()), ctes=_GOLD_CTES))
def a155_dq_gold(spark, sf):
    merchants = merchant_table(spark, sf)
    ev = gold.to_usd(silver_events(spark, sf)[0], silver.fx_rates(fx.f_fx(spark, sf)))
    tables = {"merchant_dimension_scores": merchants, "merchant_accounts": merchants.select("account_id"), "merchant_payment_risk": gold.payment_risk(ev),
              "channel_risk": gold.channel_risk(ev), "external_dispute_benchmarks": gold.benchmarks(silver.complaints(fx.f_complaints(spark, sf)))}
    return quality.run_suite(spark, tables, quality.GOLD)


# ------------------------------------------------------------------ primitives

@register("a09_flatten_fx_documents", with_views(["f_fx"], """
select cast(date as timestamp) as date, 'USD' as base, currency, round(rate, 6) as rate from f_fx"""))
def a09_flatten_fx_documents(spark, sf):
    """FX rows -> monthly ``{date: {ccy: rate}}`` JSON documents -> flattened back to rows."""
    rates = silver.fx_rates(fx.f_fx(spark, sf))
    per_day = rates.groupBy("date").agg(
        F.map_from_entries(F.collect_list(F.struct("currency", "rate"))).alias("by_ccy"))
    docs = (per_day.groupBy(F.trunc("date", "month").alias("month"))
            .agg(F.to_json(F.map_from_entries(F.collect_list(
                F.struct(F.date_format("date", "yyyy-MM-dd"), "by_ccy")))).alias("rates")))
    flat = landing.flatten_fx(docs)
    return present(flat.select(F.to_date("date").alias("date"), "base", "currency", "rate"))


@register("a10_batch_completeness", with_views(["f_events_raw"], """
select coalesce(l.d, m.d) as day, coalesce(l.landed, 0) as landed, m.announced,
       coalesce(coalesce(l.landed, 0) = m.announced, false) as complete
from (select cast(created as date) as d, count(*) as landed from f_events_raw group by 1) l
full join (select cast(created as date) as d, count(distinct event_id) as announced from f_events_raw group by 1) m
  on l.d = m.d"""))
def a10_batch_completeness(spark, sf):
    raw = fx.f_events_raw(spark, sf).withColumn("day", F.to_date("created"))
    manifest = raw.groupBy("day").agg(F.countDistinct("event_id").alias("announced"))
    return present(landing.completeness(raw, manifest, "day").select("day", "landed", "announced", "complete"))


@register("a90_hash_sample", with_views(["f_events_raw"], """
select event_id, ingested_at from f_events_raw
where (('0x' || substr(sha256('7:' || event_id), 1, 8))::bigint % 10000) < 300"""))
def a90_hash_sample(spark, sf):
    return events.hash_sample(fx.f_events_raw(spark, sf), 0.03, "event_id", seed=7).select("event_id", "ingested_at")


@register("a83_dense_index", with_views(["f_sellers"], """
select seller_id, 'acct_' || substr(cast(seller_id as varchar), 1, 16) as acct,
       row_number() over (order by seller_id) - 1 as sidx from f_sellers"""))
def a83_dense_index(spark, sf):
    sellers = silver.sellers(fx.f_sellers(spark, sf)).select(
        "seller_id", F.concat(F.lit("acct_"), F.substring(F.col("seller_id").cast("string"), 1, 16)).alias("acct"))
    return events.dense_index(sellers, ["seller_id"], "sidx")


@register("a109_event_time_rank", with_views(EVENT_VIEWS, """
select event_id, account_id, created, rank() over (partition by account_id order by created) as event_rank,
       rank() over (partition by account_id order by ingested_at) as arrival_rank
from ev""", ctes=SQL_EVENTS))
def a109_event_time_rank(spark, sf):
    """Consumers order by event time (``created``), never by arrival: per account, the event-time
    rank next to the arrival rank shows the disorder. Ranks come from the hot-key-safe running
    count (1 + events of the account strictly earlier), not from a window over the whole account."""
    from marketlake.operators.windows import prior_running
    ev, _ = silver_events(spark, sf)
    r = prior_running(ev.select("event_id", "account_id", "created", "ingested_at"), ["account_id"], "created",
                      prefix="_c")
    r = prior_running(r, ["account_id"], "ingested_at", prefix="_a")
    return r.select("event_id", "account_id", "created", (F.col("_c_n") + 1).alias("event_rank"),
                    (F.col("_a_n") + 1).alias("arrival_rank"))
