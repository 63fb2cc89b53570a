"""Golden rows for the semantic traps (three-valued flags, quarantine, ties, units, clamps)."""

import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from marketlake.functions.exprs import clip01, minor_to_major, shrunk
from marketlake.operators import dedupe, gold, silver

T0 = dt.datetime(2024, 1, 1)


def _raw(spark, rows):
    return spark.createDataFrame(rows, "event_id string, event_type string, api_version string, "
                                       "created timestamp_ntz, ingested_at timestamp_ntz, payload string, livemode boolean")


def test_null_version_is_quarantined_and_nothing_vanishes(spark):
    p = '{"id":"o1","amount":100,"currency":"usd","on_behalf_of":"acct_1"}'
    raw = _raw(spark, [("e1", "payment_intent.created", "2024-06-20", T0, T0, p, False),
                       ("e2", "payment_intent.created", None, T0, T0, p, False),
                       ("e3", "payment_intent.created", "2099-01-01.unknown", T0, T0, p, False)])
    good, bad = silver.quarantine(raw)
    assert {r.event_id for r in good.collect()} == {"e1"}
    assert {r.event_id for r in bad.collect()} == {"e2", "e3"}
    assert good.count() + bad.count() == raw.count()


def test_unknown_currency_rejected_and_zero_decimal_units(spark):
    mk = lambda i, ccy, amt: (f"e{i}", "payment_intent.created", "2024-06-20", T0, T0,
                              f'{{"id":"o{i}","amount":{amt},"currency":"{ccy}","on_behalf_of":"a"}}', False)
    raw = _raw(spark, [mk(1, "usd", 1234), mk(2, "jpy", 1234), mk(3, "xxx", 1234)])
    good, rejected = silver.stripe_events(raw)
    amounts = {r.event_id: r.amount for r in good.collect()}
    assert amounts == {"e1": Decimal("12.3400"), "e2": Decimal("1234.0000")}
    assert [r._reject_reason for r in rejected.collect()] == ["unknown_currency"]


def test_first_receipt_wins_and_redelivery_is_dropped(spark):
    p = '{"id":"o1","amount":1,"currency":"usd"}'
    raw = _raw(spark, [("e1", "x", "2024-06-20", T0, T0 + dt.timedelta(minutes=7), p + " ", False),
                       ("e1", "x", "2024-06-20", T0, T0, p, False)])
    out = silver.dedupe_events(raw).collect()
    assert len(out) == 1 and out[0].ingested_at == T0


def test_latest_per_key_breaks_ties_on_the_full_row(spark):
    df = spark.createDataFrame([(1, T0, "b"), (1, T0, "a"), (2, None, "z"), (2, T0, "y")],
                               "k int, t timestamp_ntz, v string")
    rows = {r.k: r.v for r in dedupe.latest_per_key(df, ["k"], ["t"]).collect()}
    # same t -> greatest remaining value wins deterministically; NULL time loses
    assert rows == {1: "b", 2: "y"}
    again = {r.k: r.v for r in dedupe.latest_per_key(df.repartition(3), ["k"], ["t"]).collect()}
    assert again == rows


def test_clip01_of_null_is_one(spark):
    r = spark.range(1).select(clip01(F.lit(None).cast("double")).alias("c"),
                              clip01(F.lit(1.7)).alias("hi"), clip01(F.lit(-2.0)).alias("lo")).first()
    assert (r.c, r.hi, r.lo) == (1.0, 1.0, 0.0)


def test_smoothing_pulls_small_samples_to_the_prior(spark):
    r = spark.range(1).select(shrunk(F.lit(1), F.lit(1), F.lit(0.5), 10).alias("s"),
                              shrunk(F.lit(None), F.lit(None), F.lit(0.5), 10).alias("empty")).first()
    assert abs(r.s - (1 + 5) / 11) < 1e-12 and r.empty == 0.5


def test_bad_flag_is_null_for_unreviewed_open_orders(spark):
    os_ = spark.createDataFrame(
        [(1, 10, "shipped", None, T0, T0, None, T0, T0),
         (2, 10, "canceled", None, T0, T0, None, T0, T0),
         (3, 10, "delivered", 5, T0, T0 + dt.timedelta(days=1), T0 + dt.timedelta(days=9), T0 + dt.timedelta(days=5), T0 + dt.timedelta(days=2))],
        "order_id int, seller_id int, order_status string, score int, approved_at timestamp_ntz, "
        "carrier_at timestamp_ntz, delivered_at timestamp_ntz, estimated_at timestamp_ntz, ship_by timestamp_ntz")
    f = {r.order_id: r for r in gold.order_facts(os_).collect()}
    assert f[1].went_wrong is None and f[2].went_wrong is True and f[3].went_wrong is False
    assert f[3].days_over == f[3].days_late == 4 and f[3].liked_though_late is True
    assert f[1].days_over is None and f[1].handed_in_time is True and f[3].handed_in_time is True
    assert abs(f[3].days_to_carrier - 1.0) < 1e-12


def test_spot_fx_matches_lower_case_event_currencies(spark):
    fx = spark.createDataFrame([(dt.date(2024, 1, 1), "EUR", 0.9), (dt.date(2024, 1, 2), "EUR", 0.8)],
                               "date date, currency string, rate double")
    ev = spark.createDataFrame([("e1", "eur", Decimal("8.0000")), ("e2", "usd", Decimal("2.0000"))],
                               "event_id string, currency string, amount decimal(20,4)")
    out = {r.event_id: r.amount_usd for r in gold.to_usd(ev, fx).collect()}
    assert out == {"e1": 10.0, "e2": 2.0}


def test_minor_units_never_divide_by_100_blindly(spark):
    r = spark.range(1).select(minor_to_major(F.lit(500), F.lit("jpy"), {"jpy": 0, "usd": 2}).alias("j"),
                              minor_to_major(F.lit(500), F.lit("usd"), {"jpy": 0, "usd": 2}).alias("u"),
                              minor_to_major(F.lit(500), F.lit("zzz"), {"jpy": 0, "usd": 2}).alias("z")).first()
    assert (r.j, r.u, r.z) == (Decimal("500.0000"), Decimal("5.0000"), None)


def test_channel_risk_fills_counts_not_averages(spark):
    ev = spark.createDataFrame(
        [("payment_intent.created", "agent", None), ("charge.dispute.created", "agent", 3.0),
         ("charge.dispute.created", "human", 1.0)],
        "event_type string, initiation_channel string, amount_usd double")
    out = {r.initiation_channel: r for r in gold.channel_risk(ev).collect()}
    # human has disputes but no payments -> dropped; agent's NULL average stays NULL
    assert set(out) == {"agent"} and out["agent"].avg_amount_usd is None and out["agent"].disputes == 1


def test_claims_are_judged_number_by_number(spark):
    from marketlake.operators import evidence

    claims = spark.createDataFrame([(1, 7, "dispute rate is 0.91."), (2, 7, "range 5-3 and -2, v1.2.3, 0.5"), (3, 8, "none here"), (4, 7, "3 of 3 but 33")],
                                   "claim_id int, entity int, text string")
    facts = spark.createDataFrame([(7, "a", 3.0), (7, "b", -2.0), (7, "c", 0.5)], "entity int, feature string, value double")
    out = {r.claim_id: (r.numbers, r.unsupported, r.verified_text) for r in evidence.verify(claims, facts).collect()}
    assert out == {1: (1, 1, "dispute rate is [unverified]."), 2: (4, 1, "range [unverified]-3 and -2, v1.2.3, 0.5"),
                   3: (0, 0, "none here"), 4: (3, 1, "3 of 3 but [unverified]")}


def test_pr_curve_keeps_every_score(spark):
    from marketlake.operators import evaluate

    df = spark.range(5000).selectExpr("id / 5000.0D as p_fraud", "id % 7 = 0 as is_fraud")
    curve = evaluate.pr_curve(df)
    last = curve.orderBy("threshold").first()
    assert curve.count() == 5000 and (last.tp, last.fp, last.recall) == (715, 4285, 1.0)
    middle = curve.where("threshold = 0.5").first()
    assert (middle.tp, middle.fp) == (sum(i % 7 == 0 for i in range(2500, 5000)), sum(i % 7 != 0 for i in range(2500, 5000)))
