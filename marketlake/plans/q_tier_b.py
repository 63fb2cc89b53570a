"""Registered queries: graph (B28-B32), labels (B40-B42), trust (B47-B49), policy (B52-B56),
evaluation (B57-B61, B67), evidence (B63-B65) and Silver monitors (B05-B07, B11)."""

from __future__ import annotations

from pyspark.sql import functions as F

from marketlake.operators import evaluate, events, evidence, graph, isotonic, labels, policy, quality, trust
from marketlake.plans.catalog import register
from marketlake.plans.oracle import with_views
from marketlake.plans.present import present
from marketlake.plans.q_tier_a import EVENT_VIEWS, SQL_EVENTS, silver_events
from marketlake.sources import fixtures as fx

_REVIEW_CAPACITY = 200  # below the busiest days' candidates, so that the cap is seen at work
GRAPH_AS_OF = "2024-02-15 00:00:00"
LABEL_AS_OF = "2024-05-15 00:00:00"
TRUST_AS_OF = "2024-01-29 00:00:00"


def _clip(x: str) -> str:
    return f"greatest(0.0, least(1.0, {x}))"


def _component(*signals: str) -> str:
    """SQL of trust.component: mean of the non-NULL clipped signals."""
    tot = " + ".join(f"case when ({s}) is not null then {_clip(s)} else 0.0 end" for s in signals)
    n = " + ".join(f"case when ({s}) is not null then 1 else 0 end" for s in signals)
    return f"((0.0 + {tot}) / nullif(0 + {n}, 0))"


# ------------------------------------------------------------------ graph

_EDGE_VIEWS = ["f_txns", "f_edges", "f_accounts", "f_mandates"]
_EDGE_CTES = """raw_edges AS (
  select 'customer_device' as kind, customer_id as src, device_id as dst, ts as f, ts + interval 3 day as u from f_txns
  union all select 'agent_device', agent_id, device_id, ts, ts + interval 3 day from f_txns
  union all select 'customer_merchant', customer_id, merchant_id, ts, null from f_txns
  union all select 'agent_merchant', agent_id, merchant_id, ts, null from f_txns
  union all select kind, src, dst, valid_from, null from f_edges where kind = 'customer_ip'
  union all select 'merchant_bank', merchant_id, bank_id, valid_from, valid_to from f_accounts
  union all select 'merchant_owner', merchant_id, owner_id, valid_from, valid_to from f_accounts
  union all select 'customer_mandate_agent', customer_id, agent_id, issued_at, least(expires_at, coalesce(revoked_at, expires_at)) from f_mandates),
open_edges AS (select kind, src, dst, f, coalesce(u, timestamp '9999-12-31') as u from raw_edges where src is not null and dst is not null and (u is null or f < u)),
starts AS (select *, coalesce(cast(f > max(u) over (partition by kind, src, dst order by f, u rows between unbounded preceding and 1 preceding) as int), 0) as gap
           from open_edges),
isles AS (select *, sum(gap) over (partition by kind, src, dst order by f, u rows unbounded preceding) as isle from starts),
edges AS (select kind, src, dst, min(f) as valid_from, nullif(max(u), timestamp '9999-12-31') as valid_to from isles group by kind, src, dst, isle)"""


def _edges(spark, sf):
    ips = fx.f_edges(spark, sf).where("kind = 'customer_ip'")
    return graph.edge_tables(fx.f_txns(spark, sf), ips, fx.f_accounts(spark, sf), fx.f_mandates(spark, sf))


@register("b28_edges", with_views(_EDGE_VIEWS, "select kind, src, dst, valid_from, valid_to from edges", ctes=_EDGE_CTES))
def b28_edges(spark, sf):
    return _edges(spark, sf)


@register("b29_shared_infrastructure", with_views(_EDGE_VIEWS, f"""
select s.kind, s.src, count(distinct o.src) as shared, any_value(s.hubs) as hubs
from (select kind, src, count(distinct dst) as hubs from at_t group by 1, 2) s
join at_t m on m.kind = s.kind and m.src = s.src
left join at_t o on o.kind = m.kind and o.dst = m.dst and o.src <> m.src group by 1, 2""", ctes=_EDGE_CTES + f""",
at_t AS (select distinct kind, src, dst from edges where kind in ('customer_device', 'merchant_bank', 'merchant_owner', 'agent_device')
         and valid_from < timestamp '{TRUST_AS_OF}' and (valid_to is null or valid_to >= timestamp '{TRUST_AS_OF}'))"""))
def b29_shared_infrastructure(spark, sf):
    kinds = ["customer_device", "merchant_bank", "merchant_owner", "agent_device"]
    e = graph.valid_at(_edges(spark, sf).where(F.col("kind").isin(kinds)), TRUST_AS_OF)
    return graph.shared_distinct(e, exact=1 << 12).select("kind", "src", "shared", "hubs")


_B30_SQL = with_views(["f_edges"], """
select c.node, l.component, count(*) over (partition by l.component) as component_size
from (select distinct src as node from f_edges) c join lab l on c.node = l.node""", ctes="""
e AS (select src as a, dst as b from f_edges union select dst, src from f_edges),
reach(node, lbl) AS (select a, a from e union select e.b, r.lbl from reach r join e on e.a = r.node),
lab AS (select node, min(lbl) as component from reach group by node)""").replace("WITH ", "WITH RECURSIVE ", 1)


@register("b30_components", _B30_SQL)
def b30_components(spark, sf):
    e = fx.f_edges(spark, sf)
    comp = graph.components(e)
    return graph.component_sizes(comp, e.select(F.col("src").alias("node")))


@register("b31_risky_neighbours", with_views(["f_edges", "f_txns", "f_disputes"], f"""
select s.src, count(p.nb) as neighbours, count(p.nb) filter (where p.nb in (select src from fl)) as risky_neighbours,
       round(count(p.nb) filter (where p.nb in (select src from fl)) / nullif(count(p.nb), 0), 6) as risky_neighbor_ratio
from (select distinct src from k) s
left join (select a.src, b.src as nb from k a join k b on a.dst = b.dst and a.src <> b.src) p on s.src = p.src
group by s.src""", ctes=f"""k AS (select distinct src, dst from f_edges where valid_from < timestamp '{GRAPH_AS_OF}'),
fl AS (select distinct t.customer_id as src from f_disputes d join f_txns t on d.txn_id = t.txn_id
       where d.created < timestamp '{GRAPH_AS_OF}')"""))
def b31_risky_neighbours(spark, sf):
    t, d = fx.f_txns(spark, sf), fx.f_disputes(spark, sf)
    flags = (d.where(F.col("created") < F.lit(GRAPH_AS_OF).cast("timestamp_ntz"))
              .join(t.select("txn_id", "customer_id"), "txn_id")
              .select(F.col("customer_id").alias("src")).distinct().withColumn("risky", F.lit(True)))
    return present(graph.risky_neighbours(graph.as_of(fx.f_edges(spark, sf), GRAPH_AS_OF), flags))


@register("b31_risky_neighbours_at", with_views(_EDGE_VIEWS + ["f_disputes"], """
select t.txn_id, count(o.src) as neighbours, count(o.src) filter (where r.risky_from < t.ts) as risky_neighbours,
       round(count(o.src) filter (where r.risky_from < t.ts) / nullif(count(o.src), 0), 6) as risky_neighbor_ratio
from f_txns t
left join dev m on m.src = t.customer_id and m.valid_from < t.ts and (m.valid_to is null or t.ts <= m.valid_to)
left join dev o on o.dst = m.dst and o.src <> m.src and o.valid_from < t.ts and (o.valid_to is null or t.ts <= o.valid_to)
left join rf r on r.src = o.src
group by t.txn_id""", ctes=_EDGE_CTES + """,
dev AS (select * from edges where kind = 'customer_device'),
rf AS (select t.customer_id as src, min(d.created) as risky_from from f_disputes d join f_txns t on d.txn_id = t.txn_id group by 1)"""))
def b31_risky_neighbours_at(spark, sf):
    """Every transaction at its own time, in one pass."""
    t, d = fx.f_txns(spark, sf), fx.f_disputes(spark, sf)
    devices = graph.sighted(t, [("customer_device", "customer_id", "device_id", 3)])
    risky = (d.join(t.select("txn_id", "customer_id"), "txn_id").groupBy(F.col("customer_id").alias("src")).agg(F.min("created").alias("risky_from")))
    out = graph.risky_at(t.select("txn_id", "customer_id", "ts"), devices, risky, "txn_id", "customer_id")
    return present(out.drop("customer_id", "ts"))


_B32_SQL = with_views(["f_edges", "f_txns", "f_disputes"], """
select e.src, min(b.hops) as distance_to_confirmed_fraud
from (select src from k union select src from seeds) e left join bfs b on e.src = b.src group by e.src""", ctes=f"""
k AS (select distinct src, dst from f_edges where valid_from < timestamp '{LABEL_AS_OF}'),
seeds AS (select distinct t.customer_id as src from f_disputes d join f_txns t on d.txn_id = t.txn_id
          where d.final_status = 'lost' and d.reason = 'fraudulent' and d.resolved_at < timestamp '{LABEL_AS_OF}'),
bfs(src, hops) AS (select src, 0 from seeds
                   union select k2.src, b.hops + 1 from bfs b join k k1 on k1.src = b.src
                   join k k2 on k2.dst = k1.dst where b.hops < 64)""").replace("WITH ", "WITH RECURSIVE ", 1)


@register("b32_distance_to_fraud", _B32_SQL)
def b32_distance_to_fraud(spark, sf):
    t, d = fx.f_txns(spark, sf), fx.f_disputes(spark, sf)
    seeds = (d.where((F.col("final_status") == "lost") & (F.col("reason") == "fraudulent")
                     & (F.col("resolved_at") < F.lit(LABEL_AS_OF).cast("timestamp_ntz")))
              .join(t.select("txn_id", "customer_id"), "txn_id").select(F.col("customer_id").alias("src")))
    return graph.distance(graph.as_of(fx.f_edges(spark, sf), LABEL_AS_OF), seeds)


# ------------------------------------------------------------------ labels

_REASON_SQL = ("case d.reason when 'fraudulent' then 'fraud' when 'product_not_received' then 'friendly' "
               "when 'subscription_canceled' then 'friendly' when 'credit_not_processed' then 'friendly' else 'other' end")
_LABEL_CTES = f"""lb AS (
  select t.txn_id, t.ts,
    case when d.created is not null and d.resolved_at < timestamp '{LABEL_AS_OF}' and d.final_status in ('won', 'lost') then 'final'
         when d.created is not null then 'provisional'
         when t.ts < timestamp '{LABEL_AS_OF}' - interval 120 day then 'final' else 'unknown' end as label_state,
    case when d.created is null and t.ts < timestamp '{LABEL_AS_OF}' - interval 120 day then 0
         when d.resolved_at < timestamp '{LABEL_AS_OF}' and d.final_status in ('won', 'lost')
         then cast(d.final_status = 'lost' and {_REASON_SQL} = 'fraud' as int) end as label,
    case when d.created is not null then {_REASON_SQL} end as reason_class
  from f_txns t left join (select * from f_disputes where created < timestamp '{LABEL_AS_OF}') d on t.txn_id = d.txn_id
  where t.ts < timestamp '{LABEL_AS_OF}')"""


def _label_state(spark, sf):
    return labels.state(fx.f_txns(spark, sf), fx.f_disputes(spark, sf), LABEL_AS_OF)


@register("b40_label_state", with_views(["f_txns", "f_disputes"], "select * from lb", ctes=_LABEL_CTES))
def b40_label_state(spark, sf):
    return _label_state(spark, sf)


@register("b41_reason_class", with_views(["f_disputes"], f"""
select d.dispute_id, d.reason, {_REASON_SQL} as reason_class from f_disputes d"""))
def b41_reason_class(spark, sf):
    d = fx.f_disputes(spark, sf)
    return d.select("dispute_id", "reason", labels.reason_class("reason").alias("reason_class"))


@register("b42_training_set", with_views(["f_txns", "f_disputes"], f"""
select txn_id, label from lb where label_state = 'final' and ts < timestamp '{LABEL_AS_OF}' - interval 120 day""",
                                        ctes=_LABEL_CTES))
def b42_training_set(spark, sf):
    return labels.training(_label_state(spark, sf), LABEL_AS_OF).select("txn_id", "label")


# ------------------------------------------------------------------ trust

_TRUST_VIEWS = ["f_txns", "f_disputes", "f_accounts", "f_agents", "f_mandates", "f_sessions"]
_MERCHANT_EDGES = """raw_edges AS (
  select 'bank' as kind, merchant_id as src, bank_id as dst, valid_from as f, valid_to as u from f_accounts
  union all select 'owner', merchant_id, owner_id, valid_from, valid_to from f_accounts
  union all select 'device', merchant_id, device_id, ts, ts + interval 3 day from f_txns),"""
_AGENT_EDGES = """raw_edges AS (select 'device' as kind, agent_id as src, device_id as dst, ts as f, ts + interval 3 day as u from f_txns),"""


def _grid_sql(key: str) -> str:
    """Edges with validities (from raw_edges), and a row of every day for each key: day, snapshot d."""
    isles = _EDGE_CTES[_EDGE_CTES.index("open_edges AS"):]
    return f"""{isles},
days AS (select {key}, cast(unnest(generate_series(f, (select max(cast(ts as date)) from f_txns), interval 1 day)) as date) as day
         from (select {key}, min(cast(ts as date)) as f from f_txns group by 1)),
g AS (select {key}, day, cast(day as timestamp) + interval 1 day as d from days),
bad AS (select {key} as src, created as risky_from from (
          select t.{key}, x.created, row_number() over (partition by t.{key} order by x.created, x.dispute_id) as nth
          from f_disputes x join f_txns t on x.txn_id = t.txn_id where {{bad}}) where nth = 2),
net AS (select g.{key}, g.d, count(o.src) as nb, count(o.src) filter (where z.risky_from < g.d) as risky,
               {', '.join(f"count(o.src) filter (where z.risky_from < g.d and o.kind = '{k}') as {k}_risky" for k in ('bank', 'owner', 'device'))}
        from g left join edges m on m.src = g.{key} and m.valid_from < g.d and (m.valid_to is null or g.d <= m.valid_to)
        left join edges o on o.kind = m.kind and o.dst = m.dst and o.src <> m.src and o.valid_from < g.d and (o.valid_to is null or g.d <= o.valid_to)
        left join bad z on z.src = o.src group by 1, 2)"""


_MERCHANT_CTES = _MERCHANT_EDGES + _grid_sql("merchant_id").replace("{bad}", "x.reason = 'fraudulent'") + f""",
t2 AS (select t.*, t.ts <= min(t.ts) over (partition by t.merchant_id, t.customer_id) as fresh, r.c as turned
       from f_txns t left join (select y.customer_id, min(x.created) as c from f_disputes x join f_txns y on x.txn_id = y.txn_id group by 1) r
         on r.customer_id = t.customer_id),
w AS (select g.merchant_id, g.d, min(t.ts) as first_txn,
        count(*) filter (where t.ts >= g.d - interval 30 day) as n30, count(*) filter (where t.ts >= g.d - interval 7 day) as n7,
        count(*) filter (where t.ts >= g.d - interval 14 day and t.ts < g.d - interval 7 day) as p7,
        coalesce(sum(t.amount) filter (where t.ts >= g.d - interval 7 day), 0) as v7,
        coalesce(sum(t.amount) filter (where t.ts >= g.d - interval 14 day and t.ts < g.d - interval 7 day), 0) as vp,
        count(*) filter (where t.refunded and t.ts >= g.d - interval 30 day) as refunds, count(*) filter (where t.declined and t.ts >= g.d - interval 30 day) as declines,
        sum(t.risk_score) filter (where t.ts >= g.d - interval 30 day) as risk, count(*) filter (where t.fresh and t.ts >= g.d - interval 30 day) as fresh30,
        count(*) filter (where t.fresh and t.ts >= g.d - interval 7 day) as fresh7,
        count(*) filter (where t.fresh and t.ts >= g.d - interval 14 day and t.ts < g.d - interval 7 day) as freshp,
        count(*) filter (where t.turned < g.d and t.ts >= g.d - interval 30 day) as turned30
      from g join t2 t on t.merchant_id = g.merchant_id and t.ts < g.d group by 1, 2),
ds AS (select g.merchant_id, g.d, count(*) filter (where x.created >= g.d - interval 30 day) as disputes,
              count(*) filter (where x.created >= g.d - interval 30 day and x.reason = 'fraudulent') as frauds30,
              count(*) filter (where x.created >= g.d - interval 7 day and x.reason = 'fraudulent') as frauds7
       from g join f_txns t on t.merchant_id = g.merchant_id join f_disputes x on x.txn_id = t.txn_id and x.created < g.d group by 1, 2),
dv AS (select g.merchant_id, g.d, coalesce(v.vol, 0) as vol, v.vol / nullif(v.n, 0) as ticket from g
       left join (select merchant_id, cast(ts as date) as day, sum(amount) as vol, count(*) as n from f_txns group by 1, 2) v
         on v.merchant_id = g.merchant_id and v.day = g.day),
z AS (select merchant_id, d, (vol - avg(vol) over m) / nullif(stddev_samp(vol) over m, 0) as volume_z,
             (ticket - avg(ticket) over m) / nullif(stddev_samp(ticket) over m, 0) as ticket_z
      from dv window m as (partition by merchant_id order by d rows between 27 preceding and current row)),
cs AS (select merchant_id, d, 0.5 * sum(abs(coalesce(r / nullif(sr, 0), 0) - coalesce(b / nullif(sb, 0), 0))) as shift
       from (select *, sum(r) over (partition by merchant_id, d) as sr, sum(b) over (partition by merchant_id, d) as sb from (
         select g.merchant_id, g.d, t.country, count(*) filter (where t.ts >= g.d - interval 7 day) as r, count(*) filter (where t.ts < g.d - interval 7 day) as b
         from g join f_txns t on t.merchant_id = g.merchant_id and t.ts < g.d and t.ts >= g.d - interval 14 day group by 1, 2, 3)) group by 1, 2),
ac AS (select g.merchant_id, g.d, a.* exclude (merchant_id) from g join f_accounts a on a.merchant_id = g.merchant_id and a.valid_from < g.d
       qualify row_number() over (partition by g.merchant_id, g.d order by a.valid_from desc, a.account_version desc) = 1),
nb AS (select g.merchant_id, g.d, count(*) as versions from g join f_accounts a on a.merchant_id = g.merchant_id and a.valid_from < g.d
         and a.valid_from >= g.d - interval 30 day group by 1, 2),
mi AS (select w.merchant_id, w.d, coalesce(ds.disputes, 0) / nullif(n30, 0) as dispute_rate, coalesce(ds.frauds7, 0) / nullif(n7, 0) as fraud7,
        coalesce(ds.frauds30, 0) / nullif(n30, 0) as fraud30, refunds / nullif(n30, 0) as refund_rate, declines / nullif(n30, 0) as decline_rate,
        v7 / nullif(vp, 0) as growth, (v7 / nullif(n7, 0)) / nullif(vp / nullif(p7, 0), 0) as ticket_change,
        date_sub('second', first_txn, w.d) / 86400.0 as age, ac.charges_enabled, ac.payouts_enabled, ac.requirements_due,
        date_sub('second', ac.valid_from, w.d) / 86400.0 as ext_age, coalesce(nb.versions, 0) as new_banks, fresh30 / nullif(n30, 0) as new_ratio,
        turned30 / nullif(n30, 0) as risky_ratio, risk / nullif(n30, 0) / 100 as customer_risk, fresh7 / nullif(freshp, 0) as spike,
        z.volume_z, z.ticket_z, coalesce(cs.shift, 0) as shift, net.bank_risky, net.owner_risky, net.device_risky, net.risky / nullif(net.nb, 0) as neighbor_ratio,
        case when bad.risky_from < w.d then 0 when net.risky > 0 then 1 end as hops
       from w left join ds using (merchant_id, d) left join z using (merchant_id, d) left join cs using (merchant_id, d)
       left join ac using (merchant_id, d) left join nb using (merchant_id, d) left join net using (merchant_id, d) left join bad on bad.src = w.merchant_id),
mt AS (select *,
    {_component('1 - dispute_rate / 0.05', '1 - fraud7 / 0.05', '1 - fraud30 / 0.03', '1 - refund_rate / 0.10', '1 - decline_rate / 0.30', '2 - growth', '2 - ticket_change')} as transaction,
    {_component('age / 90', 'cast(charges_enabled as double)', 'cast(payouts_enabled as double)', '1 - requirements_due / 5', 'ext_age / 60', '1 - new_banks / 3')} as identity,
    {_component('1 - abs(volume_z) / 4', '1 - abs(ticket_z) / 4', '2 - spike', '1 - shift')} as behavioral,
    {_component('1 - new_ratio', '1 - risky_ratio', '1 - customer_risk')} as customer,
    {_component('1 - bank_risky / 3', '1 - owner_risky / 3', '1 - device_risky / 100', '1 - neighbor_ratio * 2', 'coalesce(hops / 2, 1.0)')} as network
  from mi)"""

_MT_COLS = "transaction identity behavioral customer network".split()
_MERCHANT_SQL = f"""
select merchant_id, d as snapshot, {', '.join(f'round({c}, 6) as {c}' for c in _MT_COLS)},
  round(100.0 * (0.0 + coalesce(transaction, 0.0) * 0.30 + coalesce(identity, 0.0) * 0.20
        + coalesce(behavioral, 0.0) * 0.20 + coalesce(customer, 0.0) * 0.15 + coalesce(network, 0.0) * 0.15), 6)
    as merchant_trust_score
from mt"""


def _merchant_trust(spark, sf, at=None):
    daily = trust.merchant_daily(fx.f_txns(spark, sf), fx.f_disputes(spark, sf), fx.f_accounts(spark, sf), at)
    return trust.merchant(daily).select("merchant_id", "snapshot", *_MT_COLS, "merchant_trust_score")


@register("b47_merchant_trust", with_views(_TRUST_VIEWS, f"{_MERCHANT_SQL} where d = timestamp '{TRUST_AS_OF}'", ctes=_MERCHANT_CTES))
def b47_merchant_trust(spark, sf):
    return present(_merchant_trust(spark, sf, TRUST_AS_OF))


_AGENT_CTES = _AGENT_EDGES + _grid_sql("agent_id").replace("{bad}", "true") + f""",
u AS (select t.*, t.amount > m.max_amount_per_txn or t.ts > m.expires_at or coalesce(t.ts > m.revoked_at, false) as beyond, not s.user_intent_present as unasked,
             coalesce(m.single_use, false) and (select count(*) from f_txns e where e.mandate_id = t.mandate_id and e.ts < t.ts) > 0 as replayed
      from f_txns t left join f_mandates m on t.mandate_id = m.mandate_id left join f_sessions s on t.session_id = s.session_id),
w AS (select g.agent_id, g.d, count(*) as n, count(*) filter (where u.ts >= g.d - interval 30 day) as n30, count(*) filter (where u.ts >= g.d - interval 7 day) as n7,
        count(*) filter (where beyond and u.ts >= g.d - interval 30 day) as beyond30, count(*) filter (where unasked and u.ts >= g.d - interval 30 day) as unasked30,
        count(*) filter (where replayed and u.ts >= g.d - interval 30 day) as replayed30, count(distinct merchant_id) filter (where u.ts >= g.d - interval 30 day) as merchants
      from g join u on u.agent_id = g.agent_id and u.ts < g.d group by 1, 2),
dd AS (select g.agent_id, g.d, count(distinct x.txn_id) as disputed from g join f_txns t on t.agent_id = g.agent_id join f_disputes x on x.txn_id = t.txn_id and x.created < g.d group by 1, 2),
sg AS (select agent_id, ts, sum(cast(ts >= prev + interval 2 hour as int)) over (partition by agent_id order by ts, txn_id rows unbounded preceding) as session
       from (select *, coalesce(lag(ts) over (partition by agent_id order by ts, txn_id), ts) as prev from f_txns)),
ss AS (select agent_id, count(*) as k, min(ts) as b, max(ts) + interval 2 hour as e from sg group by agent_id, session),
sx AS (select g.agent_id, g.d, count(*) as sessions, sum(k) as k, sum(date_sub('second', b, e)) as secs from g
       join ss on ss.agent_id = g.agent_id and ss.e < g.d and ss.e >= g.d - interval 30 day group by 1, 2),
mr AS (select g.agent_id, g.d, count(*) filter (where m.revoked_at < g.d) / nullif(count(*) filter (where m.issued_at < g.d), 0) as revoked
       from g join f_mandates m on m.agent_id = g.agent_id group by 1, 2),
norm AS (select d, avg(n7) as norm from w group by 1),
ai AS (select w.agent_id, w.d, beyond30 / nullif(n30, 0) as violation_rate, replayed30 / nullif(n30, 0) as replay_rate, mr.revoked, unasked30 / nullif(n30, 0) as no_intent,
        coalesce(dd.disputed, 0) / nullif(w.n, 0) as disputed_rate, n7 / nullif(norm.norm, 0) as pace, merchants, sx.k / nullif(sx.sessions, 0) as per_session,
        sx.secs / nullif(sx.sessions, 0) / 3600 as hours, net.risky / nullif(net.nb, 0) as neighbor_ratio,
        case a.attestation_level when 'none' then 0.0 when 'self_asserted' then 1.0 / 3 when 'operator_attested' then 2.0 / 3 when 'issuer_verified' then 1.0 end as level,
        cast(a.attestation_expires_at > w.d as double) as valid, cast(coalesce(a.claimed_operator = a.verified_operator, false) as double) as verified,
        date_sub('second', a.first_seen, w.d) / 86400.0 as known
       from w left join dd using (agent_id, d) left join sx using (agent_id, d) left join mr using (agent_id, d) left join norm using (d)
       left join net using (agent_id, d) left join f_agents a on a.agent_id = w.agent_id),
sc AS (select *,
    {_component('level', 'valid', 'verified', 'known / 60')} as attestation,
    {_component('1 - violation_rate', '1 - replay_rate * 5', '1 - coalesce(revoked, null) * 5')} as mandate_compliance,
    {_component('2 - pace', 'merchants / 20', '1 - (per_session - 1) / 4', 'hours / 4')} as behavioral,
    {_component('1 - disputed_rate * 5', '1 - neighbor_ratio * 2')} as network, {_component('1 - no_intent')} as injection
  from ai)"""
_AT_COLS = "attestation mandate_compliance behavioral network injection".split()
_AGENT_SQL = f"""
select agent_id, d as snapshot, {', '.join(f'round({c}, 6) as {c}' for c in _AT_COLS)},
  round(100.0 * (0.0 + coalesce(attestation, 0.0) * 0.30 + coalesce(mandate_compliance, 0.0) * 0.25
        + coalesce(behavioral, 0.0) * 0.20 + coalesce(network, 0.0) * 0.15 + coalesce(injection, 0.0) * 0.10), 6) as agent_trust_score
from sc"""


def _agent_trust(spark, sf, at=None):
    daily = trust.agent_daily(fx.f_txns(spark, sf), fx.f_agents(spark, sf), fx.f_mandates(spark, sf), fx.f_sessions(spark, sf), fx.f_disputes(spark, sf), at)
    return trust.agent(daily).select("agent_id", "snapshot", *_AT_COLS, "agent_trust_score")


@register("b48_agent_trust", with_views(_TRUST_VIEWS, f"{_AGENT_SQL} where d = timestamp '{TRUST_AS_OF}'", ctes=_AGENT_CTES))
def b48_agent_trust(spark, sf):
    return present(_agent_trust(spark, sf, TRUST_AS_OF))


@register("b49_merchant_trust_daily", with_views(_TRUST_VIEWS, _MERCHANT_SQL, ctes=_MERCHANT_CTES))
def b49_merchant_trust_daily(spark, sf):
    return present(_merchant_trust(spark, sf))


@register("b49_agent_trust_daily", with_views(_TRUST_VIEWS, _AGENT_SQL, ctes=_AGENT_CTES))
def b49_agent_trust_daily(spark, sf):
    return present(_agent_trust(spark, sf))


# ------------------------------------------------------------------ policy

_DECISION_CTES = """pt AS (select t.*, t.risk_score / 100.0 as p_fraud, s.user_intent_present
       from f_txns t left join f_sessions s on t.session_id = s.session_id),
pc AS (select *, p_fraud * (amount + 25.0) as cost_approve, (1.0 - p_fraud) * 45.0 as cost_decline, 5.0 as cost_review
       from pt),
pd AS (select *, case when 5.0 < cost_approve and 5.0 < cost_decline then 'REVIEW'
                      when cost_approve > cost_decline then 'DECLINE' else 'APPROVE' end as d0 from pc),
rk AS (select txn_id, row_number() over (partition by cast(ts as date)
                                         order by least(cost_approve, cost_decline) - cost_review desc, txn_id) as rnk
       from pd where d0 = 'REVIEW'),
pcap AS (select pd.*, case when d0 = 'REVIEW' and rk.rnk > 200
                           then case when cost_approve > cost_decline then 'DECLINE' else 'APPROVE' end
                           else d0 end as d1
         from pd left join rk on pd.txn_id = rk.txn_id),
dec AS (select pcap.*, case when channel = 'agent_delegated'
                             and (coalesce(amount > m.max_amount_per_txn, false)
                                  or (d1 = 'REVIEW' and coalesce(user_intent_present, false)))
                            then 'STEP_UP' else d1 end as decision
        from pcap left join f_mandates m on pcap.mandate_id = m.mandate_id),
dc AS (select *, decision <> 'APPROVE' as caught, risk_score >= 75 as baseline_flag from dec)"""
_DEC_VIEWS = ["f_txns", "f_sessions", "f_mandates"]


def decisions(spark, sf):
    t = fx.f_txns(spark, sf).withColumn("p_fraud", F.col("risk_score") / 100.0)
    s = fx.f_sessions(spark, sf).select("session_id", "user_intent_present")
    d = policy.cap_review(policy.costs(t.join(s, "session_id", "left")), _REVIEW_CAPACITY)
    d = policy.decide(policy.step_up(d, fx.f_mandates(spark, sf)))
    return (d.withColumn("caught", F.col("decision") != "APPROVE")
             .withColumn("baseline_flag", F.col("risk_score") >= 75))


@register("b52_b55_decisions", with_views(_DEC_VIEWS, """
select txn_id, round(p_fraud, 6) as p_fraud, round(cost_approve, 6) as cost_approve, round(cost_decline, 6) as cost_decline,
       decision, 'cost-v1' as decision_policy_version from dec""", ctes=_DECISION_CTES))
def b52_b55_decisions(spark, sf):
    return present(decisions(spark, sf).select("txn_id", "p_fraud", "cost_approve", "cost_decline", "decision",
                                               "decision_policy_version"))


@register("b53_review_queue", with_views(_DEC_VIEWS, """
select cast(ts as date)::timestamp as day, count(*) filter (where d0 = 'REVIEW') as review_candidates,
       count(*) filter (where d1 = 'REVIEW') as review_kept from pcap group by 1""", ctes=_DECISION_CTES))
def b53_review_queue(spark, sf):
    t = fx.f_txns(spark, sf).withColumn("p_fraud", F.col("risk_score") / 100.0)
    c = policy.costs(t)
    capped = policy.cap_review(c, _REVIEW_CAPACITY)
    cand = c.groupBy(F.to_date("ts").alias("day")).agg(F.count_if(F.col("decision") == "REVIEW").alias("review_candidates"))
    kept = capped.groupBy(F.to_date("ts").alias("day")).agg(F.count_if(F.col("decision") == "REVIEW").alias("review_kept"))
    return present(cand.join(kept, "day"))


_SWEEP = [{"cost_false_decline_usd": v} for v in (30, 45, 60, 90)]


@register("b54_step_up_arms", with_views(_TRUST_VIEWS, """
select p.txn_id, coalesce(x.arm, 'none') as arm, case when x.arm is not null then 'STEP_UP' else d1 end as decision
from pcap p left join (
  select p.txn_id, case when p.amount > m.threshold then 'confirmation' when p.d1 = 'REVIEW' and coalesce(p.user_intent_present, false) then 'review'
                        when p.amount > m.max_amount_per_txn and t.agent_trust_score >= 60 then 'trusted_agent' end as arm
  from pcap p left join (select *, case when mandate_id % 3 = 0 then max_amount_per_txn * 2 end as threshold from f_mandates) m on p.mandate_id = m.mandate_id
  left join (""" + _AGENT_SQL + """) t on t.agent_id = p.agent_id and t.snapshot = cast(cast(p.ts as date) as timestamp)
  where p.channel = 'agent_delegated') x on x.txn_id = p.txn_id""", ctes=_AGENT_CTES + ",\n" + _DECISION_CTES.replace("sc AS", "sc2 AS")))
def b54_step_up_arms(spark, sf):
    """All three arms: a confirmation threshold on every third mandate, reviews with a reachable human, and scopes exceeded
    by agents whose trust of that morning is high."""
    t = fx.f_txns(spark, sf).withColumn("p_fraud", F.col("risk_score") / 100.0)
    s = fx.f_sessions(spark, sf).select("session_id", "user_intent_present")
    mandates = fx.f_mandates(spark, sf).withColumn("requires_human_confirmation_above", F.when(F.col("mandate_id") % 3 == 0, F.col("max_amount_per_txn") * 2))
    scores = _agent_trust(spark, sf).select(F.col("agent_id"), F.to_date("snapshot").alias("_day"), "agent_trust_score")
    d = policy.cap_review(policy.costs(t.join(s, "session_id", "left")), _REVIEW_CAPACITY)
    d = d.withColumn("_day", F.to_date("ts")).join(scores, ["agent_id", "_day"], "left")
    out = policy.step_up(d, mandates, agent_trust="agent_trust_score", trust_min=60.0, arm="arm")
    return out.select("txn_id", F.coalesce("arm", F.lit("none")).alias("arm"), "decision")


@register("b56_threshold_sweep", with_views(["f_txns"], """
select cfd as cost_false_decline_usd, 5.0 as review_cost_usd,
       count(*) filter (where d = 'APPROVE') as approve, count(*) filter (where d = 'DECLINE') as decline,
       count(*) filter (where d = 'REVIEW') as review
from (select v.cfd, case when 5.0 < p * (amount + 25.0) and 5.0 < (1.0 - p) * v.cfd then 'REVIEW'
                          when p * (amount + 25.0) > (1.0 - p) * v.cfd then 'DECLINE' else 'APPROVE' end as d
      from (select risk_score / 100.0 as p, amount from f_txns) t, (values (30.0), (45.0), (60.0), (90.0)) v(cfd))
group by 1"""))
def b56_threshold_sweep(spark, sf):
    t = fx.f_txns(spark, sf).withColumn("p_fraud", F.col("risk_score") / 100.0)
    return present(policy.sweep(t, _SWEEP))


# ------------------------------------------------------------------ evaluation

_PR_CTES = """per AS (select risk_score / 100.0 as threshold,
               count(*) filter (where is_fraud) as pos, count(*) filter (where not is_fraud) as neg
        from f_txns group by 1),
cur AS (select threshold, pos, neg,
               sum(pos) over (order by threshold desc rows between unbounded preceding and current row) as tp,
               sum(neg) over (order by threshold desc rows between unbounded preceding and current row) as fp
        from per),
pr AS (select *, tp / (tp + fp) as precision, tp / (select sum(pos) from per) as recall from cur)"""


@register("b51_isotonic_fit", with_views(["f_txns"], """
select txn_id, round(fitted, 6) as fitted from f_txns join fit on fit.x = risk_score""", ctes="""
sc AS (select risk_score as x, count(*) as w, count(*) filter (where risk_score * 7 + txn_id % 50 > 400 + 30 * (risk_score % 9)) as s from f_txns group by 1),
cu AS (select x, w, s, sum(w) over (order by x) as cw, sum(s) over (order by x) as cs from sc),
-- the fit at x: the greatest, over starts a up to x, of the least mean over ends b from x on
mm AS (select m.x, a.x as a, min((b.cs - a.cs + a.s) / (b.cw - a.cw + a.w)) as least from cu m join cu a on a.x <= m.x join cu b on b.x >= m.x group by 1, 2),
fit AS (select x, max(least) as fitted from mm group by 1)"""))
def b51_isotonic_fit(spark, sf):
    """Calibration of the platform's own score against a planted signal that rises unevenly."""
    t = fx.f_txns(spark, sf).withColumn("y", F.expr("int(risk_score * 7 + txn_id % 50 > 400 + 30 * (risk_score % 9))"))
    return present(isotonic.apply(t.select("txn_id", "risk_score"), isotonic.fit(t, "risk_score", "y"), "risk_score", "fitted").select("txn_id", "fitted"))


@register("b57_pr_curve", with_views(["f_txns"], """
select round(threshold, 6) as threshold, pos, neg, cast(tp as bigint) as tp, cast(fp as bigint) as fp,
       round(precision, 6) as precision, round(recall, 6) as recall from pr""", ctes=_PR_CTES))
def b57_pr_curve(spark, sf):
    t = fx.f_txns(spark, sf).withColumn("p_fraud", F.col("risk_score") / 100.0)
    return present(evaluate.pr_curve(t))


@register("b57_pr_auc", with_views(["f_txns"], """
select round(sum((recall - coalesce(prev, 0.0)) * precision), 6) as pr_auc
from (select *, lag(recall) over (order by threshold desc) as prev from pr)""", ctes=_PR_CTES))
def b57_pr_auc(spark, sf):
    t = fx.f_txns(spark, sf).withColumn("p_fraud", F.col("risk_score") / 100.0)
    return present(evaluate.pr_auc(evaluate.pr_curve(t)))


@register("b57_confusion", with_views(_DEC_VIEWS, """
select count(*) filter (where caught and is_fraud) as tp, count(*) filter (where caught and not is_fraud) as fp,
       count(*) filter (where not caught and is_fraud) as fn, count(*) filter (where not caught and not is_fraud) as tn,
       round(count(*) filter (where caught and is_fraud) / nullif(count(*) filter (where caught), 0), 6) as precision,
       round(count(*) filter (where caught and is_fraud) / nullif(count(*) filter (where is_fraud), 0), 6) as recall,
       round(count(*) filter (where caught and not is_fraud) / nullif(count(*) filter (where not is_fraud), 0), 6) as fpr
from dc""", ctes=_DECISION_CTES))
def b57_confusion(spark, sf):
    return present(evaluate.confusion(decisions(spark, sf), "caught"))


@register("b58_recall_by_scenario", with_views(_DEC_VIEWS, """
select scenario, count(*) as positives, count(*) filter (where caught) as caught,
       round(count(*) filter (where caught) / count(*), 6) as recall
from dc where is_fraud group by scenario""", ctes=_DECISION_CTES))
def b58_recall_by_scenario(spark, sf):
    return present(evaluate.recall_by(decisions(spark, sf), "scenario", "caught"))


@register("b58_recall_by_channel", with_views(_DEC_VIEWS, """
select channel, count(*) as positives, count(*) filter (where caught) as caught,
       round(count(*) filter (where caught) / count(*), 6) as recall
from dc where is_fraud group by channel""", ctes=_DECISION_CTES))
def b58_recall_by_channel(spark, sf):
    return present(evaluate.recall_by(decisions(spark, sf), "channel", "caught"))


@register("b59_reliability", with_views(["f_txns"], """
select cast(least(floor(p * 10), 9) as int) as bin, count(*) as n, round(avg(p), 6) as mean_p,
       round(avg(cast(is_fraud as int)), 6) as observed_rate
from (select risk_score / 100.0 as p, is_fraud from f_txns) group by 1"""))
def b59_reliability(spark, sf):
    t = fx.f_txns(spark, sf).withColumn("p_fraud", F.col("risk_score") / 100.0)
    return present(evaluate.reliability(t))


@register("b60_vs_baseline", with_views(_DEC_VIEWS, """
select count(*) filter (where is_fraud and caught and baseline_flag) as both,
       count(*) filter (where is_fraud and caught and not baseline_flag) as model_only,
       count(*) filter (where is_fraud and not caught and baseline_flag) as baseline_only,
       count(*) filter (where is_fraud and not caught and not baseline_flag) as neither,
       count(*) filter (where not is_fraud and caught) as model_false_declines,
       count(*) filter (where not is_fraud and baseline_flag) as baseline_false_declines
from dc""", ctes=_DECISION_CTES))
def b60_vs_baseline(spark, sf):
    return evaluate.vs_baseline(decisions(spark, sf), "caught", "baseline_flag")


@register("b61_dollars", with_views(_DEC_VIEWS, """
select cast(ts as date)::timestamp as day,
       round(sum(case when is_fraud and decision = 'DECLINE' then amount else 0.0 end), 6) as fraud_captured_usd,
       round(sum(case when is_fraud and decision = 'APPROVE' then amount else 0.0 end), 6) as fraud_lost_usd,
       round(sum(case when not is_fraud and decision = 'DECLINE' then amount else 0.0 end), 6) as false_decline_usd
from dc group by 1""", ctes=_DECISION_CTES))
def b61_dollars(spark, sf):
    return present(evaluate.dollars(decisions(spark, sf)))


@register("b61_queues", with_views(_DEC_VIEWS, """
select cast(ts as date)::timestamp as day, count(*) filter (where decision = 'REVIEW') as review,
       count(*) filter (where decision = 'STEP_UP') as step_up, 200 as capacity,
       count(*) filter (where decision = 'REVIEW') > 200 as over_capacity
from dc group by 1""", ctes=_DECISION_CTES))
def b61_queues(spark, sf):
    return present(evaluate.queues(decisions(spark, sf), _REVIEW_CAPACITY))


@register("b67_compare_sample", with_views(_DEC_VIEWS, """
select coalesce(a.channel, b.channel) as channel, round(a.recall, 6) as a, round(b.recall, 6) as b,
       round(b.recall - a.recall, 6) as delta
from (select channel, count(*) filter (where caught) / count(*) as recall from dc where is_fraud group by 1) a
full join (select channel, count(*) filter (where caught) / count(*) as recall from dc
           where is_fraud and (('0x' || substr(sha256('11:' || txn_id), 1, 8))::bigint % 10000) < 5000 group by 1) b
  on a.channel = b.channel""", ctes=_DECISION_CTES))
def b67_compare_sample(spark, sf):
    d = decisions(spark, sf)
    full = evaluate.recall_by(d, "channel", "caught")
    half = evaluate.recall_by(events.hash_sample(d, 0.5, "txn_id", seed=11), "channel", "caught")
    return present(evaluate.compare(full, half, "channel"))


# ------------------------------------------------------------------ evidence

_MERCHANT_INPUT_CTES = f"""tx AS (select * from f_txns where ts < timestamp '{TRUST_AS_OF}'),
drec AS (select t.merchant_id, count(*) as disputes_30d from f_disputes d join f_txns t on d.txn_id = t.txn_id
         where d.created < timestamp '{TRUST_AS_OF}' and d.created >= timestamp '{TRUST_AS_OF}' - interval 30 day group by 1),
risky AS (select distinct t.customer_id from f_disputes d join f_txns t on d.txn_id = t.txn_id
          where d.created < timestamp '{TRUST_AS_OF}'),
fs AS (select merchant_id, customer_id, min(ts) as first from tx group by 1, 2),
base AS (
  select tx.merchant_id,
    count(*) filter (where ts >= timestamp '{TRUST_AS_OF}' - interval 30 day) as txns_30d,
    count(*) filter (where ts >= timestamp '{TRUST_AS_OF}' - interval 30 day and refunded) as refunds_30d,
    count(*) filter (where ts >= timestamp '{TRUST_AS_OF}' - interval 30 day and declined) as declines_30d,
    min(ts) as first_txn, avg(cast(ts > fs.first as int)) as repeat_rate,
    avg(cast(r.customer_id is not null as int)) as risky_customer_ratio, count(*) as txns
  from tx join fs on tx.merchant_id = fs.merchant_id and tx.customer_id = fs.customer_id
  left join risky r on tx.customer_id = r.customer_id group by 1),
cty AS (select merchant_id, max(c) as top from (select merchant_id, country, count(*) as c from tx group by 1, 2) group by 1),
mi AS (
  select b.*, coalesce(d.disputes_30d, 0) as disputes_30d,
    coalesce(d.disputes_30d, 0) / nullif(txns_30d, 0) as dispute_rate_30d, refunds_30d / nullif(txns_30d, 0) as refund_rate_30d,
    declines_30d / nullif(txns_30d, 0) as decline_rate_30d,
    date_sub('second', first_txn, timestamp '{TRUST_AS_OF}') / 86400.0 as account_age_days,
    c.top / nullif(txns, 0) as top_country_share
  from base b left join drec d on b.merchant_id = d.merchant_id left join cty c on b.merchant_id = c.merchant_id)"""


def _merchant_inputs(spark, sf):
    return trust.merchant_inputs(fx.f_txns(spark, sf), fx.f_disputes(spark, sf), TRUST_AS_OF)


_BUNDLE_COLS = ["txns", "txns_30d", "disputes_30d", "dispute_rate_30d", "refund_rate_30d", "decline_rate_30d",
                "repeat_rate", "risky_customer_ratio", "account_age_days", "top_country_share"]
_BUNDLE_SQL = " union all ".join(f"select merchant_id as entity, '{c}' as feature, cast({c} as double) as value from mi"
                                 for c in _BUNDLE_COLS)


@register("b63_evidence_bundle", with_views(["f_txns", "f_disputes"], f"""
select entity, feature, round(value, 6) as value from ({_BUNDLE_SQL})""", ctes=_MERCHANT_INPUT_CTES))
def b63_evidence_bundle(spark, sf):
    return present(evidence.bundle(_merchant_inputs(spark, sf), "merchant_id", _BUNDLE_COLS))


# Claims of four numbers with literal text between them: "payments N, dispute rate D. range R-4 customers C."
_CLAIM_SQL = """cl AS (
  select merchant_id as claim_id, merchant_id as entity,
    [cast(txns_30d as varchar), cast(floor(coalesce(dispute_rate_30d, 0) * 10000 + 0.5) / 10000 as varchar),
     cast(txns as varchar), '4', cast(txns_30d + 1000 as varchar)] as n,
    ['payments ', ', dispute rate ', '. range ', '-', ' customers ', '.'] as t
  from mi),
bv AS (select distinct entity, round(value, 4) as v from (""" + _BUNDLE_SQL + """)),
chk AS (select *, list_transform(n, lambda x: list_contains(vs, round(cast(x as double), 4))) as ok
        from cl join (select entity as e, list(v) as vs from bv group by 1) on e = entity)"""


@register("b64_claim_verification", with_views(["f_txns", "f_disputes"], """
select claim_id, entity, t[1] || n[1] || t[2] || n[2] || t[3] || n[3] || t[4] || n[4] || t[5] || n[5] || t[6] as text,
       cast(5 as bigint) as numbers, cast(len(list_filter(ok, lambda x: not x)) as bigint) as unsupported,
       t[1] || case when ok[1] then n[1] else '[unverified]' end || t[2] || case when ok[2] then n[2] else '[unverified]' end
         || t[3] || case when ok[3] then n[3] else '[unverified]' end || t[4] || case when ok[4] then n[4] else '[unverified]' end
         || t[5] || case when ok[5] then n[5] else '[unverified]' end || t[6] as verified_text,
       len(list_filter(ok, lambda x: not x)) = 0 as passed
from chk""", ctes=_MERCHANT_INPUT_CTES + ",\n" + _CLAIM_SQL))
def b64_claim_verification(spark, sf):
    from marketlake.plans.present import round_half_away
    mi = _merchant_inputs(spark, sf)
    claims = mi.select(
        F.col("merchant_id").alias("claim_id"), F.col("merchant_id").alias("entity"),
        F.concat(F.lit("payments "), F.col("txns_30d").cast("string"), F.lit(", dispute rate "),
                 round_half_away(F.coalesce("dispute_rate_30d", F.lit(0.0)), 4).cast("string"),
                 F.lit(". range "), F.col("txns").cast("string"), F.lit("-4 customers "),
                 (F.col("txns_30d") + 1000).cast("string"), F.lit(".")).alias("text"))
    v = evidence.verify(claims, evidence.bundle(mi, "merchant_id", _BUNDLE_COLS))
    return v.select("claim_id", "entity", "text", "numbers", "unsupported", "verified_text", "passed")


@register("b65_dashboard", with_views(_DEC_VIEWS, """
select date_trunc('hour', ts) as bucket, channel, count(*) as txns, round(sum(amount), 6) as amount,
       count(*) filter (where decision = 'DECLINE') as declined, count(*) filter (where decision = 'REVIEW') as review,
       count(*) filter (where decision = 'STEP_UP') as step_up, round(avg(p_fraud), 6) as avg_p_fraud
from dc group by 1, 2""", ctes=_DECISION_CTES))
def b65_dashboard(spark, sf):
    return present(evidence.dashboard(decisions(spark, sf)))


@register("b65_trust_detail", with_views(_TRUST_VIEWS, f"""
select s.merchant_id, s.snapshot, round(s.merchant_trust_score, 6) as score, round(o.merchant_trust_score, 6) as score_before, s.weakest,
       l.lowest, l.lowest_at, round(s.merchant_trust_score - o.merchant_trust_score, 6) as change
from (select *, (select name from (values (transaction, 'transaction'), (identity, 'identity'), (behavioral, 'behavioral'), (customer, 'customer'), (network, 'network')) v(x, name)
                 order by x, name limit 1) as weakest from mts where snapshot = (select max(snapshot) from mts)) s
left join mts o on o.merchant_id = s.merchant_id and o.snapshot = s.snapshot - interval 7 day
join (select merchant_id, min(merchant_trust_score) as lowest, arg_min(snapshot, (merchant_trust_score, snapshot)) as lowest_at from mts group by 1) l
  on l.merchant_id = s.merchant_id""", ctes=_MERCHANT_CTES + f",\nmts AS ({_MERCHANT_SQL})"))
def b65_trust_detail(spark, sf):
    daily = present(_merchant_trust(spark, sf))  # rounded first, as the view's readers see the scores
    return present(evidence.trust_detail(daily, "merchant_id", "merchant_trust_score", _MT_COLS))


@register("b65_investigation", with_views(_DEC_VIEWS + ["f_disputes"], f"""
select dc.txn_id, dc.decision, rank() over (partition by cast(dc.ts as date), dc.decision order by cast(round(dc.amount * 1000000) as bigint) desc) as queue_rank,
       round(mi.dispute_rate_30d, 6) as dispute_rate_30d, round(mi.risky_customer_ratio, 6) as risky_customer_ratio, x.dispute_reason
from dc left join mi on mi.merchant_id = dc.merchant_id
left join (select txn_id, arg_max(reason, created) as dispute_reason from f_disputes where created < timestamp '{{TRUST_AS_OF}}' group by 1) x on x.txn_id = dc.txn_id
where dc.decision <> 'APPROVE'""".replace("{TRUST_AS_OF}", TRUST_AS_OF), ctes=_MERCHANT_INPUT_CTES + ",\n" + _DECISION_CTES))
def b65_investigation(spark, sf):
    facts = evidence.bundle(_merchant_inputs(spark, sf), "merchant_id", _BUNDLE_COLS)
    out = evidence.investigation(decisions(spark, sf), facts, fx.f_disputes(spark, sf), TRUST_AS_OF)
    return present(out.select("txn_id", "decision", "queue_rank", F.col("facts")["dispute_rate_30d"].alias("dispute_rate_30d"),
                              F.col("facts")["risky_customer_ratio"].alias("risky_customer_ratio"), "dispute_reason"))


@register("b66_stratified_sample", with_views(["f_txns"], """
select channel, count(*) as sampled, round(sum(1.0 / f), 6) as estimated_txns, round(sum(amount / f), 6) as estimated_amount
from (select *, case channel when 'human_initiated' then 0.05 when 'agent_delegated' then 0.5 else 1.0 end as f
      from f_txns)
where (('0x' || substr(sha256('0:' || txn_id), 1, 8))::bigint % 10000) / 10000.0 < f
group by channel"""))
def b66_stratified_sample(spark, sf):
    """Stratified hash sample of transactions (agents and mandates kept at higher rates than
    human micropayments), with the weighted per-channel totals it estimates."""
    t = fx.f_txns(spark, sf)
    s = evidence.sample(t, {"human_initiated": 0.05, "agent_delegated": 0.5, "agent_to_agent": 1.0}, "txn_id")
    return present(s.groupBy("channel").agg(
        F.count("*").alias("sampled"), F.sum("sample_weight").alias("estimated_txns"),
        F.sum(F.col("amount") * F.col("sample_weight")).alias("estimated_amount")))


# ------------------------------------------------------------------ Silver monitors

_RULES = {"known_api_version": "api_version in ('2023-10-16', '2024-06-20', '2025-03-31')",
          "not_livemode": "not livemode", "payload_present": "payload is not null",
          "created_not_after_ingest": "created <= ingested_at"}


@register("b05_row_expectations", with_views(["f_events_raw"], """
select event_id, ingested_at, array_to_string(list_filter([
         case when not coalesce(api_version in ('2023-10-16', '2024-06-20', '2025-03-31'), false) then 'known_api_version' end,
         case when not coalesce(not livemode, false) then 'not_livemode' end,
         case when not coalesce(payload is not null, false) then 'payload_present' end,
         case when not coalesce(created <= ingested_at, false) then 'created_not_after_ingest' end],
         lambda x: x is not null), ',') as failed
from f_events_raw
where not (coalesce(api_version in ('2023-10-16', '2024-06-20', '2025-03-31'), false) and coalesce(not livemode, false)
           and payload is not null and coalesce(created <= ingested_at, false))"""))
def b05_row_expectations(spark, sf):
    """Envelope expectations on raw events; every failed rule is listed (NULL counts as failed)."""
    _, rejected = quality.expect(fx.f_events_raw(spark, sf), _RULES)
    return rejected.select("event_id", "ingested_at", F.array_join("_failed", ",").alias("failed"))


@register("b05_silver_expectations", with_views(EVENT_VIEWS, """
select event_id, array_to_string(list_filter([case when object_id is null then 'transaction_id' end, case when acc is null then 'account_id' end,
         case when not coalesce(a > 0, false) then 'amount_positive' end,
         case when not coalesce(a * case currency when 'jpy' then 1 else 100 end = amount_minor, false) then 'minor_units' end],
         lambda x: x is not null), ',') as failed
from nv where object_id is null or acc is null or not coalesce(a > 0, false) or not coalesce(a * case currency when 'jpy' then 1 else 100 end = amount_minor, false)""",
         ctes=SQL_EVENTS + """,
nv AS (select *, case when k % 45 <> 0 then account_id end as acc,
              case when k % 40 = 0 then cast(amount_minor / 100.0 as decimal(20, 4)) when k % 41 = 0 then 0 else amount end as a
       from (select *, cast(substr(event_id, 5) as bigint) as k from ev))"""))
def b05_silver_expectations(spark, sf):
    """Rules of Silver events against planted faults: amounts divided by 100 whatever the currency, zero amounts, no account."""
    k = F.substring("event_id", 5, 20).cast("long")
    ev, _ = silver_events(spark, sf)
    wrong = (F.when(k % 40 == 0, (F.col("amount_minor") / 100.0).cast("decimal(20,4)")).when(k % 41 == 0, F.lit(0).cast("decimal(20,4)")).otherwise(F.col("amount")))
    _, rejected = quality.expect(ev.withColumn("amount", wrong).withColumn("account_id", F.when(k % 45 != 0, F.col("account_id"))), quality.EVENT_RULES)
    return rejected.select("event_id", F.array_join("_failed", ",").alias("failed"))


@register("b06_schema_report", with_views(["f_events_raw"], """
select k.version, k.key, k.n_events, round(k.n_events / t.n, 6) as share
from (select api_version as version, key, count(*) as n_events
      from (select api_version, unnest(json_keys(payload)) as key from f_events_raw) group by 1, 2) k
join (select api_version as version, count(*) as n from f_events_raw group by 1) t
  on k.version is not distinct from t.version"""))
def b06_schema_report(spark, sf):
    return present(quality.schema_report(fx.f_events_raw(spark, sf)))


# payloads of one version in which every other amount has become a string
_DRIFT_CTES = """dr AS (select api_version, case when api_version = '2025-03-31' and cast(substr(event_id, 5) as bigint) % 8 = 2
                       then regexp_replace(payload, '"amount":([0-9]+)', '"amount":"\\1"') else payload end as payload from f_events_raw),
ks AS (select api_version as version, unnest(json_keys(payload)) as key, payload from dr),
ty AS (select version, key, case json_type(payload, '$.' || key) when 'UBIGINT' then 'BIGINT' when 'VARCHAR' then 'STRING' else json_type(payload, '$.' || key) end as type,
              count(*) as n_events from ks group by 1, 2, 3)"""


def _drifted(spark, sf):
    strings = (F.col("api_version") == "2025-03-31") & (F.substring("event_id", 5, 20).cast("long") % 8 == 2)
    return fx.f_events_raw(spark, sf).withColumn("payload", F.when(strings, F.regexp_replace("payload", '"amount":([0-9]+)', '"amount":"$1"')).otherwise(F.col("payload")))


@register("b06_schema_types", with_views(["f_events_raw"], """
select version, key, type, n_events, coalesce(d.drifted, false) as drifted
from ty left join (select key, count(distinct type) > 1 as drifted from ty group by 1) d using (key)""", ctes=_DRIFT_CTES))
def b06_schema_types(spark, sf):
    return quality.schema_types(_drifted(spark, sf))


@register("b06_schema_versions", with_views(["f_events_raw"], """
select s.version, 'OBJECT<' || string_agg(s.key || ': ' || case when s.key = 'metadata' then m.nested else s.type end, ', ' order by s.key) || '>' as schema,
       any_value(t.n) as n_events
from (select version, key, case when count(*) > 1 then 'VARIANT' else any_value(type) end as type from ty group by 1, 2) s
join (select api_version as version, count(*) as n from dr group by 1) t on t.version is not distinct from s.version
left join (select version, 'OBJECT<' || string_agg(distinct k || ': STRING', ', ' order by k || ': STRING') || '>' as nested
           from (select api_version as version, unnest(json_keys(payload, '$.metadata')) as k from dr where json_type(payload, '$.metadata') = 'OBJECT') group by 1) m
  on m.version is not distinct from s.version
group by s.version""", ctes=_DRIFT_CTES))
def b06_schema_versions(spark, sf):
    return quality.schema_versions(_drifted(spark, sf))


_NOW = "2024-03-15 00:00:00"


@register("b07_freshness", with_views(["f_events_raw"], f"""
select max(created) as max_created, max(ingested_at) as max_ingested_at,
       date_sub('second', max(created), timestamp '{_NOW}') as lag_s_created,
       date_sub('second', max(ingested_at), timestamp '{_NOW}') as lag_s_ingested_at
from f_events_raw"""))
def b07_freshness(spark, sf):
    return quality.freshness(fx.f_events_raw(spark, sf), ["created", "ingested_at"],
                             F.lit(_NOW).cast("timestamp_ntz"))


@register("b11_shape_tail", with_views(EVENT_VIEWS, """
select sum(n) as rows, count(*) as keys,
       round((select sum(n) from (select n from c order by n desc, account_id limit 10)) / sum(n), 6) as top_k_share,
       round(max(n) / sum(n), 6) as top1_share
from c""", ctes=SQL_EVENTS + ",\nc AS (select account_id, count(*) as n from ev group by 1)"))
def b11_shape_tail(spark, sf):
    ev, _ = silver_events(spark, sf)
    tail, _ = quality.shape(ev, "account_id", "created", "initiation_channel")
    return present(tail)


@register("b11_shape_hours", with_views(EVENT_VIEWS, """
select initiation_channel, hour(created) as hour, count(*) as n from ev group by 1, 2""", ctes=SQL_EVENTS))
def b11_shape_hours(spark, sf):
    ev, _ = silver_events(spark, sf)
    _, hours = quality.shape(ev, "account_id", "created", "initiation_channel")
    return hours
