"""Registered queries: point-in-time features B12-B27 over the fixture transactions."""

from __future__ import annotations

from marketlake.operators import features as ft
from marketlake.plans.catalog import register
from marketlake.plans.oracle import with_views
from marketlake.plans.present import present
from marketlake.sources import fixtures as fx

TX = ["f_txns"]


def _r(c: str, d: int = 6) -> str:
    return f"round({c}, {d}) as {c}"


_W60 = "partition by customer_id order by epoch_us(ts) range between 60000000 preceding and 1 preceding"
_W300 = "partition by customer_id order by epoch_us(ts) range between 300000000 preceding and 1 preceding"


@register("b12_velocity", with_views(TX, f"""
select txn_id, count(*) over ({_W60}) as customer_id_txn_count_60s,
       round(coalesce(sum(amount) over ({_W60}), 0), 6) as customer_id_amount_60s,
       count(*) over ({_W300}) as customer_id_txn_count_300s,
       round(coalesce(sum(amount) over ({_W300}), 0), 6) as customer_id_amount_300s
from f_txns"""))
def b12_velocity(spark, sf):
    t = fx.f_txns(spark, sf)
    v = ft.velocity(t, "customer_id", "ts", (60, 300))
    return present(v.select("txn_id", "customer_id_txn_count_60s", "customer_id_amount_60s",
                            "customer_id_txn_count_300s", "customer_id_amount_300s"))


@register("b13_distinct_merchants_5m", with_views(TX, """
select txn_id, count(distinct merchant_id) over (partition by agent_id order by epoch_us(ts)
         range between 300000000 preceding and 1 preceding) as agent_unique_merchants_5m
from f_txns"""))
def b13_distinct_merchants_5m(spark, sf):
    t = fx.f_txns(spark, sf)
    return ft.distinct_in_window(t, "agent_id", "merchant_id", "ts", 300, "agent_unique_merchants_5m") \
        .select("txn_id", "agent_unique_merchants_5m")


@register("b15_velocity_ratio", with_views(TX, """
select day, round(agent_avg, 6) as agent_avg, round(human_avg, 6) as human_avg,
       round(agent_avg / nullif(human_avg, 0), 6) as agent_vs_human_velocity_ratio
from (select cast(ts as date) as day,
        avg(c) filter (where channel in ('agent_delegated', 'agent_to_agent')) as agent_avg,
        avg(c) filter (where channel not in ('agent_delegated', 'agent_to_agent')) as human_avg
      from (select ts, channel, count(*) over (partition by agent_id order by epoch_us(ts)
                   range between 60000000 preceding and 1 preceding) as c from f_txns)
      group by 1)"""))
def b15_velocity_ratio(spark, sf):
    t = fx.f_txns(spark, sf)
    v = ft.velocity(t, "agent_id", "ts", (60,), prefix="agent")
    return present(ft.velocity_ratio(v, "agent_txn_count_60s"))


@register("b16_novelty", with_views(TX, """
select txn_id,
  ts <= min(ts) over (partition by customer_id, device_id) as new_device,
  ts <= min(ts) over (partition by customer_id, country) as new_country,
  round(amount / (sum(amount) over w / nullif(count(*) over w, 0)), 6) as amount_vs_customer_avg
from f_txns
window w as (partition by customer_id order by epoch_us(ts) range between unbounded preceding and 1 preceding)"""))
def b16_novelty(spark, sf):
    return present(ft.novelty(fx.f_txns(spark, sf)).select(
        "txn_id", "new_device", "new_country", "amount_vs_customer_avg"))


@register("b17_distance_prev", with_views(TX, """
select txn_id,
  round(2 * 6371.0 * asin(sqrt(pow(sin(radians(lat - plat) / 2), 2)
        + cos(radians(plat)) * cos(radians(lat)) * pow(sin(radians(lon - plon) / 2), 2))), 6) as distance_from_previous_txn,
  date_sub('second', pts, ts) as seconds_since_previous_txn
from (select *, lag(lat) over w as plat, lag(lon) over w as plon, lag(ts) over w as pts
      from f_txns window w as (partition by customer_id order by ts))"""))
def b17_distance_prev(spark, sf):
    return present(ft.distance_prev(fx.f_txns(spark, sf)).select(
        "txn_id", "distance_from_previous_txn", "seconds_since_previous_txn"))


SQL_DAILY = """fs AS (select merchant_id, customer_id, min(ts) as first from f_txns group by 1, 2),
dly AS (
  select t.merchant_id, cast(t.ts as date) as day, count(*) as txns, sum(amount) as volume, avg(amount) as avg_ticket,
         count(*) filter (where t.ts <= fs.first) as new_customers
  from f_txns t join fs on t.merchant_id = fs.merchant_id and t.customer_id = fs.customer_id group by 1, 2)"""


@register("b18_trend", with_views(TX, """
select merchant_id, cast(day as timestamp) as day, txns, round(volume, 6) as volume, round(avg_ticket, 6) as avg_ticket,
       new_customers,
       round(volume / vm, 6) as volume_growth, round(avg_ticket / tm, 6) as avg_ticket_change,
       round(new_customers / nm, 6) as new_customer_spike,
       round((volume - vm) / vs, 6) as volume_z, round((avg_ticket - tm) / ts_, 6) as ticket_z
from (select *, avg(volume) over w as vm, stddev_samp(volume) over w as vs, avg(avg_ticket) over w as tm,
             stddev_samp(avg_ticket) over w as ts_, avg(new_customers) over w as nm
      from dly window w as (partition by merchant_id order by day range between interval 28 day preceding
                                                                          and interval 1 day preceding))""",
                                       ctes=SQL_DAILY))
def b18_trend(spark, sf):
    t = fx.f_txns(spark, sf)
    return present(ft.trend(ft.daily(t)))


_B19_CTES = """dk AS (select t.merchant_id, cast(d.created as date) as day, count(*) as disputes
       from f_disputes d join f_txns t on d.txn_id = t.txn_id group by 1, 2),
td AS (select merchant_id, cast(ts as date) as day, count(*) as n, count(*) filter (where refunded) as refunds,
              count(*) filter (where declined) as declines from f_txns group by 1, 2),
b AS (select coalesce(td.merchant_id, dk.merchant_id) as merchant_id, coalesce(td.day, dk.day) as day,
             coalesce(n, 0) as n, coalesce(refunds, 0) as refunds, coalesce(declines, 0) as declines,
             coalesce(disputes, 0) as disputes
      from td full join dk on td.merchant_id = dk.merchant_id and td.day = dk.day),
r AS (select merchant_id, day,
        sum(disputes) over w7 / nullif(sum(n) over w7, 0) as dispute_rate_7d,
        sum(refunds) over w7 / nullif(sum(n) over w7, 0) as refund_rate_7d,
        sum(declines) over w7 / nullif(sum(n) over w7, 0) as decline_rate_7d,
        sum(disputes) over w30 / nullif(sum(n) over w30, 0) as dispute_rate_30d,
        sum(refunds) over w30 / nullif(sum(n) over w30, 0) as refund_rate_30d,
        sum(declines) over w30 / nullif(sum(n) over w30, 0) as decline_rate_30d
      from b
      window w7 as (partition by merchant_id order by day range between interval 7 day preceding and interval 1 day preceding),
             w30 as (partition by merchant_id order by day range between interval 30 day preceding and interval 1 day preceding))"""


@register("b19_rolling_rates", with_views(TX + ["f_disputes"], """
select t.txn_id, round(r.dispute_rate_7d, 6) as dispute_rate_7d, round(r.refund_rate_7d, 6) as refund_rate_7d,
       round(r.decline_rate_7d, 6) as decline_rate_7d, round(r.dispute_rate_30d, 6) as dispute_rate_30d,
       round(r.refund_rate_30d, 6) as refund_rate_30d, round(r.decline_rate_30d, 6) as decline_rate_30d
from f_txns t left join r on t.merchant_id = r.merchant_id and cast(t.ts as date) = r.day""", ctes=_B19_CTES))
def b19_rolling_rates(spark, sf):
    t, d = fx.f_txns(spark, sf), fx.f_disputes(spark, sf)
    return present(ft.rolling_rates(t, d).select(
        "txn_id", "dispute_rate_7d", "refund_rate_7d", "decline_rate_7d",
        "dispute_rate_30d", "refund_rate_30d", "decline_rate_30d"))


AS_OF = "2024-01-29 00:00:00"


@register("b20_customer_mix", with_views(TX + ["f_disputes"], f"""
select t.merchant_id, count(*) as txns, round(avg(cast(t.ts > fs.first as int)), 6) as repeat_rate,
       round(count(distinct t.customer_id) / count(*), 6) as new_customer_ratio,
       round(avg(cast(coalesce(fd.first_dispute < t.ts, false) as int)), 6) as risky_customer_ratio
from tt t join fs on t.merchant_id = fs.merchant_id and t.customer_id = fs.customer_id
left join (select t2.customer_id, min(d.created) as first_dispute from f_disputes d join tt t2 on d.txn_id = t2.txn_id
           group by 1) fd on t.customer_id = fd.customer_id
group by t.merchant_id""", ctes=f"""tt AS (select * from f_txns where ts < timestamp '{AS_OF}'),
fs AS (select merchant_id, customer_id, min(ts) as first from tt group by 1, 2)"""))
def b20_customer_mix(spark, sf):
    return present(ft.customer_mix(fx.f_txns(spark, sf), fx.f_disputes(spark, sf), AS_OF))



@register("b21_share_shift", with_views(TX, f"""
select merchant_id, round(0.5 * sum(abs(coalesce(pr, 0) - coalesce(pb, 0))), 6) as country_shift_tvd
from (select merchant_id, country, r / nullif(sum(r) over (partition by merchant_id), 0) as pr,
             b / nullif(sum(b) over (partition by merchant_id), 0) as pb
      from (select merchant_id, country,
                   count(*) filter (where ts >= timestamp '{AS_OF}' - interval 7 day and ts < timestamp '{AS_OF}') as r,
                   count(*) filter (where ts >= timestamp '{AS_OF}' - interval 14 day
                                      and ts < timestamp '{AS_OF}' - interval 7 day) as b
            from f_txns where ts >= timestamp '{AS_OF}' - interval 14 day and ts < timestamp '{AS_OF}'
            group by 1, 2))
group by merchant_id"""))
def b21_share_shift(spark, sf):
    return present(ft.share_shift(fx.f_txns(spark, sf), AS_OF))


@register("b22_mandate_scope", with_views(TX + ["f_mandates"], """
select t.txn_id, round(t.amount / m.max_amount_per_txn, 6) as amount_over_mandate_ratio,
       round(date_sub('second', m.issued_at, t.ts) / date_sub('second', m.issued_at, m.expires_at), 6) as mandate_age_vs_expiry,
       t.ts > m.expires_at as after_expiry, coalesce(t.ts > m.revoked_at, false) as after_revocation,
       count(*) over (partition by t.mandate_id order by epoch_us(t.ts) range between unbounded preceding and 1 preceding)
         as mandate_txn_count_used,
       count(*) over (partition by t.mandate_id order by epoch_us(t.ts) range between unbounded preceding and 1 preceding)
         >= m.max_txn_count as over_txn_count,
       list_contains(m.allowed_merchant_categories, t.merchant_category) as category_in_mandate
from f_txns t join f_mandates m on t.mandate_id = m.mandate_id"""))
def b22_mandate_scope(spark, sf):
    out = ft.mandate_scope(fx.f_txns(spark, sf), fx.f_mandates(spark, sf))
    return present(out.select("txn_id", "amount_over_mandate_ratio", "mandate_age_vs_expiry", "after_expiry",
                              "after_revocation", "mandate_txn_count_used", "over_txn_count", "category_in_mandate"))


@register("b23_injection", with_views(TX + ["f_sessions"], """
select t.txn_id, not s.user_intent_present as intent_signal_absent,
       date_sub('second', s.started_at, t.ts) as session_duration_to_purchase,
       t.ts <= min(t.ts) over (partition by t.session_id, t.merchant_id) as merchant_first_seen_in_session,
       cast(greatest(0, least(s.tool_calls_count, floor((date_sub('second', s.started_at, t.ts) - 1) / s.tool_call_every_s))) as int)
         as tool_calls_before_purchase
from f_txns t left join f_sessions s on t.session_id = s.session_id"""))
def b23_injection(spark, sf):
    out = ft.injection(fx.f_txns(spark, sf), fx.f_sessions(spark, sf))
    return out.select("txn_id", "intent_signal_absent", "session_duration_to_purchase",
                      "merchant_first_seen_in_session", "tool_calls_before_purchase")


@register("b24_attestation", with_views(TX + ["f_agents"], """
select t.txn_id, a.attestation_level, t.ts > a.attestation_expires_at as attestation_expired,
       not coalesce(a.claimed_operator = a.verified_operator, false) as operator_claim_vs_verified,
       date_diff('day', cast(a.first_seen as date), cast(t.ts as date)) as agent_first_seen_days
from f_txns t left join f_agents a on t.agent_id = a.agent_id"""))
def b24_attestation(spark, sf):
    out = ft.attestation(fx.f_txns(spark, sf), fx.f_agents(spark, sf))
    return out.select("txn_id", "attestation_level", "attestation_expired", "operator_claim_vs_verified",
                      "agent_first_seen_days")


@register("b25_asof_last_dispute", with_views(TX + ["f_disputes"], """
select t.txn_id, d.reason as asof_reason, d.final_status as asof_final_status, d.created as asof_ts
from f_txns t
left join (select t2.customer_id, d.created, d.reason, d.final_status, d.dispute_id
           from f_disputes d join f_txns t2 on d.txn_id = t2.txn_id) d
  on d.customer_id = t.customer_id and d.created < t.ts
qualify row_number() over (partition by t.txn_id order by d.created desc nulls last, d.reason desc, d.final_status desc) = 1"""))
def b25_asof_last_dispute(spark, sf):
    """Latest dispute of the same customer created strictly before each transaction."""
    t, d = fx.f_txns(spark, sf), fx.f_disputes(spark, sf)
    dc = d.join(t.select("txn_id", "customer_id"), "txn_id").select("customer_id", "created", "reason", "final_status")
    out = ft.asof(t.select("txn_id", "customer_id", "ts"), dc, "customer_id", "ts", "created",
                  ["reason", "final_status"])
    return out.select("txn_id", "asof_reason", "asof_final_status", "asof_ts")


_B26_CTES = """chain(mandate_id, cur, depth, revoked_any) as (
  select mandate_id, parent_mandate_id, 0, false from f_mandates
  union all
  select c.mandate_id, p.parent_mandate_id, c.depth + 1, c.revoked_any or p.revoked_at is not null
  from chain c join f_mandates p on p.mandate_id = c.cur)"""
_B26_SQL = with_views(["f_mandates"], """
select m.mandate_id, max(c.depth) as delegation_depth, bool_or(c.revoked_any) as parent_mandate_revoked,
       coalesce(any_value(m.max_amount_per_txn > p.max_amount_per_txn), false) as child_scope_exceeds_parent
from f_mandates m join chain c on c.mandate_id = m.mandate_id
left join f_mandates p on p.mandate_id = m.parent_mandate_id
group by m.mandate_id""", ctes=_B26_CTES).replace("WITH ", "WITH RECURSIVE ", 1)


@register("b26_delegation", _B26_SQL)
def b26_delegation(spark, sf):
    out = ft.delegation(fx.f_mandates(spark, sf))
    return out.select("mandate_id", "delegation_depth", "parent_mandate_revoked", "child_scope_exceeds_parent")


@register("b27_replay", with_views(TX + ["f_mandates"], """
select t.txn_id,
  case when t.mandate_id is not null then count(*) over (partition by t.mandate_id order by epoch_us(t.ts)
    range between unbounded preceding and 1 preceding) + 1 end as mandate_use_count,
  coalesce(m.single_use, false) and count(*) over (partition by t.mandate_id order by epoch_us(t.ts)
    range between unbounded preceding and 1 preceding) >= 1 as single_use_violated,
  case when t.mandate_id is not null
    then date_sub('second', lag(t.ts) over (partition by t.mandate_id order by t.ts), t.ts) end as token_reuse_interval
from f_txns t left join f_mandates m on t.mandate_id = m.mandate_id"""))
def b27_replay(spark, sf):
    out = ft.replay(fx.f_txns(spark, sf), fx.f_mandates(spark, sf))
    return out.select("txn_id", "mandate_use_count", "single_use_violated", "token_reuse_interval")

