"""DuckDB side of the fixture projections (the ``f_*`` views of FIXTURES.md) and a CTE builder.

The oracle SQL for every registered query is written independently of the Spark code and starts
from these views, declared as CTEs so each oracle string is self-contained.
"""

from __future__ import annotations

VIEWS: dict[str, str] = {}

VIEWS["f_orders"] = """
select o_orderkey as order_id, o_custkey as customer_id, st as order_status, o_orderdate as purchased_at,
       o_orderdate + to_seconds((o_orderkey % 48) * 3600) as approved_at,
       case when st in ('delivered','shipped') then o_orderdate + to_days(cast(1 + (o_orderkey // 10) % 4 as int)) end as carrier_at,
       case when st = 'delivered' then o_orderdate + to_days(cast(8 + (o_orderkey % 10) * 2 + o_custkey % 3 as int)) end as delivered_at,
       o_orderdate + to_days(cast(14 + o_custkey % 8 as int)) as estimated_at
from (select *, case when o_orderstatus in ('F','O') then 'delivered'
                     when o_orderkey % 7 = 3 then 'canceled'
                     when o_orderkey % 7 = 5 then 'unavailable' else 'shipped' end as st from orders)
"""

VIEWS["f_items"] = """
select l_orderkey as order_id, l_linenumber as item_no, l_partkey as product_id, seller as seller_id,
       o_orderdate + to_days(cast(3 + seller % 6 as int)) as ship_by,
       l_extendedprice * (4 + seller % 7) / 8 as price_brl, l_tax * 100 as freight_brl
from (select *, case when l_suppkey % 10 = 9 and l_orderkey % 400 <> 7 or l_suppkey % 10 < 8 and l_orderkey % 10 > l_suppkey % 10 + 1
                     then l_suppkey - l_suppkey % 10 + 8 else l_suppkey end as seller from lineitem)
join orders on l_orderkey = o_orderkey
"""

VIEWS["f_reviews"] = """
select o_orderkey // 2 as review_id, o_orderkey as order_id, v,
       case when o_orderkey % 7 = 0 then null when v = 1 then 3 when o_custkey % 6 = 0 then 5 else cast(5 - (o_orderkey % 10) // 2 as int) end as score,
       o_orderdate + to_days(30) as created_at, o_orderdate + to_days(cast(33 - v as int)) as answered_at
from orders cross join (values (0),(1)) t(v)
where v = 0 or o_orderkey % 11 = 0
"""

VIEWS["f_products"] = """
select p_partkey as product_id, case when p_partkey % 50 = 0 or p_brand = 'Brand#7' then 'unknown' else lower(p_brand) end as category
from part
"""

VIEWS["f_sellers"] = """
select s_suppkey as seller_id, lower(n_name) as city, lower(substr(r_name, 1, 2)) as state
from supplier join nation on s_nationkey = n_nationkey join region on n_regionkey = r_regionkey
"""

VIEWS["f_fx"] = """
select d as date, 'USD' as base, c as currency,
       case when not (c = 'BRL' and month(d) = 4) then round(b * (1 + (day(d) % 7) / 100.0), 6) end as rate
from (select distinct cast(o_orderdate as date) d from orders union select distinct cast(ts as date) from events) x
cross join (values ('BRL',3.5),('EUR',0.9),('GBP',0.8),('JPY',110.0)) t(c,b)
"""

VIEWS["f_complaints"] = """
select doc_id as complaint_id, 'co' || (doc_id % 20) as company, source as product, 'issue' || (doc_id % 5) as issue, v,
       case when doc_id % 9 = v then 'No' else 'Yes' end as timely,
       case doc_id % 4 when 0 then 'Closed with monetary relief' when 1 then 'Closed with non-monetary relief'
                       when 2 then 'Closed with explanation' end as company_response,
       date '2024-01-01' + cast(doc_id % 90 as int) as received_on,
       timestamp '2024-06-01' + to_days(cast(v as int)) as _ingested_at
from documents cross join (values (0),(1)) t(v) where v = 0 or doc_id % 13 = 0
"""

VIEWS["f_events_raw"] = """
with e as (
  select *, case when event_type in ('purchase','signup','view') then 'payment_intent.created'
                 when event_type = 'click' then 'payment_intent.succeeded'
                 when event_id % 3 = 0 then 'charge.dispute.created' else 'payment_intent.canceled' end as typ,
         case when event_id % 20 < 12 then 'human_initiated' when event_id % 20 < 18 then 'agent_delegated' else 'agent_to_agent' end as chan,
         case when event_id % 500 = 3 then 'xxx' when event_id % 10 < 6 then 'usd' when event_id % 10 < 8 then 'eur'
              when event_id % 10 = 8 then 'gbp' else 'jpy' end as ccy from events),
t as (select *, case when typ = 'charge.dispute.created' then ts + to_days(5) else ts end as created from e),
r as (
  select 'evt_' || event_id as event_id, typ as event_type,
         case when event_id % 100 = 0 then '2099-01-01.unknown' when event_id % 97 = 1 then null
              when event_id % 4 = 0 then '2023-10-16' when event_id % 4 = 1 then '2024-06-20' else '2025-03-31' end as api_version,
         created, created + to_seconds((event_id * 3701) % 7200) as ingested_at,
         '{"object":"' || split_part(typ, '.', 1) || '","id":"obj_' || event_id // 3
         || '","amount":' || cast(round(value * case when ccy = 'jpy' then 110 else 100 end) as bigint)
         || ',"currency":"' || ccy || '","on_behalf_of":"acct_' || (user_id % 40) || '","initiation_channel":"' || chan || '"'
         || case when chan <> 'human_initiated' then ',"mandate_id":"mand_' || (user_id % 60) || '","mandate_violation":'
              || case when event_id % 17 = 0 then 'true' else 'false' end
              || ',"metadata":{"agent_id":"agt_' || (user_id % 50) || '","session_id":"ses_' || (event_id % 300)
              || '","attestation_token_hash":"h' || (event_id % 7) || '","human_confirmed":"'
              || case when event_id % 3 = 0 then 'true' else 'false' end || '"}' else '' end
         || case when typ = 'charge.dispute.created' then ',"charge":"' || case when event_id % 2 = 0 then 'obj_' || (event_id + 3) // 3 else 'ch_' || event_id end || '","reason":"'
              || case when event_id % 2 = 0 then 'fraudulent' else 'product_not_received' end || '"' else '' end || '}' as payload,
         event_id as k from t)
select event_id, event_type, api_version, created, ingested_at, payload, false as livemode from r
union all
select event_id, event_type, api_version, created, ingested_at + to_seconds(420), payload, false from r where k % 33 = 0
"""

VIEWS["f_mandates"] = """
select c_custkey as mandate_id, c_custkey as customer_id, c_custkey % 50 as agent_id,
       timestamp '2024-01-01' as issued_at, timestamp '2024-01-05' + to_days(cast(c_custkey % 40 as int)) as expires_at,
       case when c_custkey % 21 = 0 then timestamp '2024-01-15' end as revoked_at,
       50 + c_custkey % 200 as max_amount_per_txn, 1 + c_custkey % 30 as max_txn_count, c_custkey % 8 = 0 as single_use,
       case when c_custkey % 5 <> 0 then c_custkey - 1 end as parent_mandate_id,
       case when c_custkey % 4 <> 0 then ['cat' || (c_custkey % 6), 'cat' || ((c_custkey + 2) % 6)] end as allowed_merchant_categories
from customer
"""

VIEWS["f_edges"] = """
select 'customer_device' as kind, c_custkey as src, 100000000 + c_custkey // 3 as dst,
       timestamp '2023-12-01' + to_days(cast(c_custkey % 90 as int)) as valid_from from customer
union all
select 'customer_ip', c_custkey, case when c_custkey % 5 = 0 then 200000000 + c_custkey // 10 else 300000000 + c_custkey end,
       timestamp '2023-12-01' + to_days(cast(c_custkey % 90 as int)) from customer
"""

VIEWS["f_accounts"] = """
select k as account_version, k % 40 as merchant_id, 500000000 + k * 7 % 31 + k % 13 // 12 * k as bank_id, 600000000 + k * 11 % 53 as owner_id, valid_from,
       case when k % 3 <> 0 then valid_from + to_days(cast(5 + k % 30 as int)) end as valid_to,
       k % 7 <> 0 as charges_enabled, k % 11 <> 0 as payouts_enabled, cast(k % 5 as int) as requirements_due
from (select c_custkey as k, timestamp '2023-10-01' + to_days(cast(c_custkey * 13 % 125 as int)) as valid_from from customer)
"""

VIEWS["f_agents"] = """
select distinct c_custkey % 50 as agent_id, 'op' || (c_custkey % 50 % 7) as claimed_operator,
       case when c_custkey % 50 % 9 <> 0 then 'op' || (c_custkey % 50 % 7) end as verified_operator,
       case c_custkey % 50 % 4 when 0 then 'none' when 1 then 'self_asserted' when 2 then 'operator_attested' else 'issuer_verified' end as attestation_level,
       timestamp '2024-01-10' + to_days(cast(c_custkey % 50 as int)) as attestation_expires_at,
       timestamp '2023-12-01' + to_days(cast(c_custkey % 50 as int)) as first_seen
from customer
"""

VIEWS["f_txns"] = """
select event_id as txn_id, user_id as customer_id, (event_id * 31) % 40 as merchant_id, user_id % 50 as agent_id,
       case when event_id % 20 >= 12 then user_id end as mandate_id, user_id * 100 + day(ts) as session_id, (user_id // 3) + (event_id % 29) // 28 * 1000 as device_id,
       'C' || ((user_id + (event_id % 37) // 36) % 12) as country,
       cast(user_id % 60 - 30 + event_id % 3 as double) as lat, cast(user_id % 120 - 60 + event_id % 5 as double) as lon,
       ts, value as amount,
       case when event_id % 20 < 12 then 'human_initiated' when event_id % 20 < 18 then 'agent_delegated' else 'agent_to_agent' end as channel,
       event_type = 'error' as declined, event_id % 41 = 0 as refunded, cast((event_id * 7919) % 100 as int) as risk_score,
       'cat' || ((event_id * 31) % 40 % 6) as merchant_category, event_id % 13 = 0 and event_id % 4 <> 1 as is_fraud,
       case when event_id % 13 = 0 and event_id % 4 <> 1 then 'scn' || (event_id % 7) end as scenario
from events
"""

VIEWS["f_disputes"] = """
select event_id as dispute_id, event_id as txn_id, c as created, case when event_id % 5 <> 0 then c + to_days(cast(20 + event_id % 56 as int)) end as resolved_at,
       case when event_id % 5 = 0 then 'needs_response' when event_id % 2 = 0 then 'lost' else 'won' end as final_status,
       case event_id % 4 when 0 then 'fraudulent' when 1 then 'product_not_received' when 2 then 'fraudulent' else 'subscription_canceled' end as reason
from (select *, ts + to_days(cast(7 + event_id % 39 as int)) as c from events where event_id % 13 = 0)
"""

VIEWS["f_sessions"] = """
select user_id * 100 + day(ts) as session_id, any_value(user_id) as customer_id, any_value(user_id % 50) as agent_id,
       min(ts) - to_seconds(min(event_id) % 90) as started_at, max(ts) as ended_at,
       min(event_id) % 8 <> 0 as user_intent_present, cast(min(event_id) % 12 as int) as tool_calls_count,
       cast(10 + min(event_id) % 50 as int) as tool_call_every_s
from events group by user_id, day(ts)
"""



def with_views(views: list[str] | tuple[str, ...], body: str, ctes: str = "") -> str:
    """``WITH <views>, <ctes> <body>``: the fixture views a query needs, then its own CTEs."""
    parts = [f"{v} AS (\n{VIEWS[v]})" for v in views]
    if ctes.strip():
        parts.append(ctes.strip())
    return ("WITH " + ",\n".join(parts) + "\n" if parts else "") + body
