"""The query catalogue: every registered query (Spark) and its independently written DuckDB oracle.

Keys are ``<survey id>_<name>``. Each Spark query reads the driver tables at ``sf_dir`` through the
fixture projections, runs the library operators and returns a DataFrame (never collected here).
Double columns are rounded by ``present`` (money to 2 places, the rest to 6) on both sides.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketlake.operators import gold, silver
from marketlake.plans.oracle import with_views
from marketlake.plans.present import present
from marketlake.sources import fixtures as fx

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


# ------------------------------------------------------------------ shared Silver inputs

def silver_inputs(spark: SparkSession, sf: str) -> dict[str, DataFrame]:
    """Silver tables built from the fixture projections (lazy; nothing is materialised)."""
    return dict(
        orders=silver.orders(fx.f_orders(spark, sf)),
        items=silver.order_items(fx.f_items(spark, sf)),
        reviews=silver.reviews(fx.f_reviews(spark, sf)),
        products=silver.products(fx.f_products(spark, sf)),
        sellers=silver.sellers(fx.f_sellers(spark, sf)),
        fx=silver.fx_rates(fx.f_fx(spark, sf)),
    )


def scored_sellers(spark: SparkSession, sf: str) -> DataFrame:
    s = silver_inputs(spark, sf)
    g = gold.seller_stats(gold.order_facts(
        gold.order_seller(s["items"], s["products"], s["orders"], s["reviews"], s["fx"])))
    return gold.composite(gold.dimensions(g))


def merchant_table(spark: SparkSession, sf: str) -> DataFrame:
    s = silver_inputs(spark, sf)
    return gold.merchant_scores(s["items"], s["products"], s["orders"], s["reviews"], s["fx"], s["sellers"])


# ------------------------------------------------------------------ oracle building blocks (DuckDB)

SQL_SILVER_REVIEWS = """rv AS (
  select review_id, order_id, score, created_at, answered_at from (
    select *, row_number() over (partition by review_id, order_id order by answered_at desc, v) as rn from f_reviews)
  where rn = 1)"""

SQL_ORDER_SELLER = SQL_SILVER_REVIEWS + """,
items_p AS (select i.*, p.category from f_items i left join f_products p on i.product_id = p.product_id),
med AS (select category, quantile_disc(price_brl, 0.5) as cat_median from items_p group by category),
items_r AS (select i.*, m.cat_median, i.price_brl / m.cat_median as price_ratio from items_p i left join med m on i.category = m.category),
worst AS (select order_id, min(score) as score from rv group by order_id),
brl AS (select date_trunc('month', date) as m, cast(sum(cast(rate as decimal(30, 6))) as double) / count(rate) as brl_per_usd
        from f_fx where currency = 'BRL' group by 1),
fb AS (select coalesce(avg(brl_per_usd), 3.5) as fallback from brl),
os AS (
  select a.order_id, a.seller_id, a.order_value_brl, a.price_ratio, a.ship_by,
         o.order_status, o.purchased_at, o.approved_at, o.carrier_at, o.delivered_at, o.estimated_at, w.score,
         a.order_value_brl / coalesce(b.brl_per_usd, (select fallback from fb)) as order_value_usd
  from (select order_id, seller_id, sum(price_brl) as order_value_brl, avg(price_ratio) as price_ratio,
               max(ship_by) as ship_by from items_r group by order_id, seller_id) a
  join f_orders o on a.order_id = o.order_id
  left join worst w on a.order_id = w.order_id
  left join brl b on b.m = date_trunc('month', o.purchased_at)),
fl AS (
  select *,
    cast(dlv as int) as is_delivered,
    case when dlv then date_diff('day', cast(estimated_at as date), cast(delivered_at as date)) end as delay_days,
    case when dlv then cast(date_diff('day', cast(estimated_at as date), cast(delivered_at as date)) <= 0 as int) end as on_time,
    case when dlv then greatest(date_diff('day', cast(estimated_at as date), cast(delivered_at as date)), 0) end as late_days,
    (epoch(carrier_at) - epoch(approved_at)) / 86400.0 as handoff_days,
    case when carrier_at is not null and ship_by is not null then cast(carrier_at <= ship_by as int) end as handoff_ok,
    cast(order_status in ('canceled', 'unavailable') or score <= 2 as int) as bad,
    case when dlv then cast(date_diff('day', cast(estimated_at as date), cast(delivered_at as date)) > 0 as int) end as late,
    case when dlv and date_diff('day', cast(estimated_at as date), cast(delivered_at as date)) > 0
         then cast(score >= 4 as int) end as late_and_happy
  from (select *, delivered_at is not null and order_status = 'delivered' as dlv from os))"""

SQL_SCORES = SQL_ORDER_SELLER + """,
g AS (
  select seller_id, count(*) as n_orders, sum(is_delivered) as n_delivered,
         sum(on_time) as k_on_time, count(on_time) as n_on_time, sum(late_days) as s_late_days,
         sum(handoff_days) as s_handoff, count(handoff_days) as n_handoff,
         sum(handoff_ok) as k_handoff_ok, count(handoff_ok) as n_handoff_ok, sum(bad) as k_bad,
         sum(late) as n_late, sum(late_and_happy) as k_late_happy,
         avg(price_ratio) as avg_price_ratio, stddev_samp(delay_days) as sd_delay,
         avg(order_value_usd) as avg_ticket_usd, sum(order_value_usd) as gmv_usd, avg(score) as avg_review
  from fl group by seller_id),
pr AS (
  select coalesce(sum(k_on_time), 0) / greatest(coalesce(sum(n_on_time), 0), 1) as p_on_time,
         coalesce(sum(s_late_days), 0) / greatest(coalesce(sum(n_on_time), 0), 1) as p_late_days,
         coalesce(sum(s_handoff), 0) / greatest(coalesce(sum(n_handoff), 0), 1) as p_handoff,
         coalesce(sum(k_handoff_ok), 0) / greatest(coalesce(sum(n_handoff_ok), 0), 1) as p_handoff_ok,
         coalesce(sum(k_bad), 0) / greatest(coalesce(sum(n_orders), 0), 1) as p_bad,
         coalesce(sum(k_late_happy), 0) / greatest(coalesce(sum(n_late), 0), 1) as p_happy
  from g),
sm AS (
  select g.*,
    (coalesce(k_on_time, 0) + 10 * p_on_time) / (coalesce(n_on_time, 0) + 10) as on_time_rate,
    (coalesce(s_late_days, 0) + 10 * p_late_days) / (coalesce(n_on_time, 0) + 10) as mean_late_days,
    (coalesce(s_handoff, 0) + 10 * p_handoff) / (coalesce(n_handoff, 0) + 10) as mean_handoff_days,
    (coalesce(k_handoff_ok, 0) + 10 * p_handoff_ok) / (coalesce(n_handoff_ok, 0) + 10) as handoff_ok_rate,
    (coalesce(k_bad, 0) + 10 * p_bad) / (coalesce(n_orders, 0) + 10) as bad_rate,
    (coalesce(k_late_happy, 0) + 5 * p_happy) / (coalesce(n_late, 0) + 5) as recovery_rate
  from g, pr),
dm AS (
  select *,
    greatest(0.0, least(1.0, on_time_rate)) as delivery,
    greatest(0.0, least(1.0, 1.5 - coalesce(avg_price_ratio, 1.0))) as price,
    greatest(0.0, least(1.0, 1 - mean_late_days / 7)) as contract,
    greatest(0.0, least(1.0, 1 - mean_handoff_days / 7)) as latency,
    greatest(0.0, least(1.0, 1 - bad_rate / 0.3)) as dispute,
    greatest(0.0, least(1.0, 1 - coalesce(sd_delay, 10.0) / 15)) as consistency,
    greatest(0.0, least(1.0, handoff_ok_rate)) as comms,
    greatest(0.0, least(1.0, recovery_rate)) as resolution
  from sm),
sc AS (
  select *,
    0.0 + delivery * 0.125 + price * 0.125 + contract * 0.125 + latency * 0.125 + dispute * 0.125
        + consistency * 0.125 + comms * 0.125 + resolution * 0.125 as mdt_score,
    n_orders >= 20 as eligible
  from dm),
scored AS (
  select *, case when mdt_score >= 0.75 then 'trusted' when mdt_score >= 0.60 then 'watch' else 'risk' end as tier
  from sc),
merchants AS (
  select s.seller_id as merchant_id, 'acct_' || substring(cast(s.seller_id as varchar), 1, 16) as account_id,
         'Seller ' || substring(cast(s.seller_id as varchar), 1, 5) || ' · '
           || array_to_string(list_transform(string_split(c.city, ' '),
                                             lambda x: upper(substring(x, 1, 1)) || lower(substring(x, 2))), ' ')
           || ', ' || upper(c.state) as merchant_name,
         c.city, c.state, s.*
  from scored s left join f_sellers c on s.seller_id = c.seller_id)"""

SCORE_VIEWS = ["f_orders", "f_items", "f_reviews", "f_products", "f_fx", "f_sellers"]


def r6(cols: str) -> str:
    return ", ".join(f"round({c}, 6) as {c}" for c in cols.split())


def r2(cols: str) -> str:
    return ", ".join(f"round({c}, 2) as {c}" for c in cols.split())


# ------------------------------------------------------------------ fixture projections

def _fixture_query(name: str):
    fn = fx.FIXTURES[name]

    def query(spark, sf):
        df = fn(spark, sf)
        lists = {c: F.array_join(c, ",") for c, kind in df.dtypes if kind.startswith("array")}
        return present(df.withColumns(lists) if lists else df)

    return query


_FIXTURE_SELECT = {
    "f_mandates": "select * replace (array_to_string(allowed_merchant_categories, ',') as allowed_merchant_categories) from f_mandates",
    "f_items": "select order_id, item_no, product_id, seller_id, ship_by, round(price_brl, 6) as price_brl, "
               "round(freight_brl, 6) as freight_brl from f_items",
    "f_fx": "select cast(date as timestamp) as date, base, currency, round(rate, 6) as rate from f_fx",
    "f_complaints": "select complaint_id, company, product, issue, v, timely, company_response, "
                    "cast(received_on as timestamp) as received_on, _ingested_at from f_complaints",
}

for _name in fx.FIXTURES:
    register(f"fixture_{_name}", with_views([_name], _FIXTURE_SELECT.get(_name, f"select * from {_name}")))(
        _fixture_query(_name))


# ------------------------------------------------------------------ Gold: merchant trust (A111-A131)

@register("a111_price_ratio", with_views(SCORE_VIEWS, f"""
select product_id, order_id, item_no, seller_id, category, {r6('price_brl cat_median price_ratio')}
from items_r""", ctes=SQL_ORDER_SELLER))
def a111_price_ratio(spark, sf):
    s = silver_inputs(spark, sf)
    df = gold.price_ratio(s["items"], s["products"])
    return present(df.select("product_id", "order_id", "item_no", "seller_id", "category", "price_brl",
                             "cat_median", "price_ratio"))


@register("a112_monthly_fx", with_views(SCORE_VIEWS, """
select cast(m as timestamp) as m, round(brl_per_usd, 6) as brl_per_usd, round((select fallback from fb), 6) as fallback
from brl""", ctes=SQL_ORDER_SELLER))
def a112_monthly_fx(spark, sf):
    s = silver_inputs(spark, sf)
    brl = gold.monthly_fx(s["fx"])
    return present(brl.select("m", "brl_per_usd", gold.fx_fallback(brl).alias("fallback")))


@register("a113_order_seller", with_views(SCORE_VIEWS, f"""
select order_id, seller_id, {r6('order_value_brl price_ratio')}, {r2('order_value_usd')}, ship_by, score
from os""", ctes=SQL_ORDER_SELLER))
def a113_order_seller(spark, sf):
    s = silver_inputs(spark, sf)
    os_ = gold.order_seller(s["items"], s["products"], s["orders"], s["reviews"], s["fx"])
    return present(os_.select("order_id", "seller_id", "order_value_brl", "order_value_usd", "price_ratio",
                              "ship_by", "score"), money=["order_value_usd"])


@register("a114_a116_order_flags", with_views(SCORE_VIEWS, f"""
select order_id, seller_id, is_delivered, delay_days, on_time, late_days, {r6('handoff_days')}, handoff_ok,
       bad, late, late_and_happy
from fl""", ctes=SQL_ORDER_SELLER))
def a114_a116_order_flags(spark, sf):
    s = silver_inputs(spark, sf)
    f = gold.order_facts(gold.order_seller(s["items"], s["products"], s["orders"], s["reviews"], s["fx"]))
    as_int = {"is_delivered": "delivered", "on_time": "days_over <= 0", "handoff_ok": "handed_in_time", "bad": "went_wrong",
              "late": "days_over > 0", "late_and_happy": "liked_though_late"}
    return present(f.selectExpr("order_id", "seller_id", "days_over as delay_days", "days_late as late_days",
                                "days_to_carrier as handoff_days",
                                *[f"cast({cond} as int) as {name}" for name, cond in as_int.items()]))


_G_INT = ("n_orders n_delivered k_on_time n_on_time s_late_days n_handoff k_handoff_ok n_handoff_ok k_bad n_late "
          "k_late_happy")


@register("a117_seller_stats", with_views(SCORE_VIEWS, f"""
select seller_id, {', '.join(f'cast({c} as bigint) as {c}' for c in _G_INT.split())},
       {r6('s_handoff avg_price_ratio sd_delay avg_review')}, {r2('avg_ticket_usd gmv_usd')}
from g""", ctes=SQL_SCORES))
def a117_seller_stats(spark, sf):
    s = silver_inputs(spark, sf)
    g = gold.seller_stats(gold.order_facts(
        gold.order_seller(s["items"], s["products"], s["orders"], s["reviews"], s["fx"])))
    sums = {"k_on_time": "on_time_rate_top", "n_on_time": "on_time_rate_of", "s_late_days": "mean_late_days_top",
            "n_handoff": "mean_handoff_days_of", "k_handoff_ok": "handoff_ok_rate_top", "n_handoff_ok": "handoff_ok_rate_of",
            "k_bad": "bad_rate_top", "n_late": "recovery_rate_of", "k_late_happy": "recovery_rate_top"}
    g = g.select("seller_id", *[F.col(sums.get(c, c)).cast("bigint").alias(c) for c in _G_INT.split()],
                 F.col("mean_handoff_days_top").alias("s_handoff"), "avg_price_ratio", "sd_delay", "avg_review",
                 "avg_ticket_usd", "gmv_usd")
    return present(g, money=["avg_ticket_usd", "gmv_usd"])


@register("a118_priors", with_views(SCORE_VIEWS, """
select round(p_on_time, 6) as on_time, round(p_late_days, 6) as late_days, round(p_handoff, 6) as handoff,
       round(p_handoff_ok, 6) as handoff_ok, round(p_bad, 6) as bad, round(p_happy, 6) as happy
from pr""", ctes=SQL_SCORES))
def a118_priors(spark, sf):
    s = silver_inputs(spark, sf)
    g = gold.seller_stats(gold.order_facts(
        gold.order_seller(s["items"], s["products"], s["orders"], s["reviews"], s["fx"])))
    p = gold.priors(g)
    return present(p.select(*[F.col(r).alias(n) for r, n in zip(_RATES.split(), "on_time late_days handoff handoff_ok bad happy".split())]))


_DIMS = " ".join(gold.DIMENSIONS)
_RATES = "on_time_rate mean_late_days mean_handoff_days handoff_ok_rate bad_rate recovery_rate"


@register("a119_a127_dimensions", with_views(SCORE_VIEWS, f"""
select seller_id, {r6(_RATES)}, {r6(_DIMS)} from dm""", ctes=SQL_SCORES))
def a119_a127_dimensions(spark, sf):
    d = scored_sellers(spark, sf)
    return present(d.select("seller_id", *_RATES.split(), *gold.DIMENSIONS))


@register("a128_a130_composite_tier", with_views(SCORE_VIEWS, """
select seller_id, cast(n_orders as bigint) as n_orders, round(mdt_score, 6) as mdt_score, eligible, tier
from scored""", ctes=SQL_SCORES))
def a128_a130_composite_tier(spark, sf):
    d = scored_sellers(spark, sf)
    return present(d.select("seller_id", "n_orders", "mdt_score", "eligible", "tier"))


_MERCHANT_SQL = f"""
select merchant_id, account_id, merchant_name, city, state, cast(n_orders as bigint) as n_orders, eligible,
       round(mdt_score, 6) as mdt_score, tier, {r6(_DIMS)}, round(avg_review, 6) as avg_review,
       {r2('avg_ticket_usd gmv_usd')}, {r6(_RATES)}, {r6('avg_price_ratio sd_delay')}
from merchants"""


@register("a131_merchant_dimension_scores", with_views(SCORE_VIEWS, _MERCHANT_SQL, ctes=SQL_SCORES))
def a131_merchant_dimension_scores(spark, sf):
    return present(merchant_table(spark, sf), money=["avg_ticket_usd", "gmv_usd"])
