"""Merchant and agent trust scores (0-100, 100 = trusted) for every day, each as of that day's midnight.

The spec names components and weights but no formulas; fixed here: each component is the mean of
sub-signals already clipped to [0, 1] (higher = more trusted), and the score is
``100 * sum(weight * component)``. Every input is computed from rows strictly before the snapshot.

All days come from one pass. A key has a row for every day from its first transaction on (a day without rows carries the
state forward); what is added up by day lies on these rows and is summed over frames of days. What begins and ends (a
customer turned risky, a merchant seen in the last 30 days, a revoked mandate) is a change of +1 and -1 on the days it
does so. Windows run over one row per key and day. The score as of a time is the snapshot of its day.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marketlake.functions.exprs import clip01, ratio, seconds_between
from marketlake.operators import features, graph

# Component weights (hand-set priors, not learned).
MERCHANT_WEIGHTS = {"transaction": 0.30, "identity": 0.20, "behavioral": 0.20, "customer": 0.15, "network": 0.15}
AGENT_WEIGHTS = {"attestation": 0.30, "mandate_compliance": 0.25, "behavioral": 0.20, "network": 0.15,
                 "injection": 0.10}
ATTESTATION_SCORE = {"none": 0.0, "self_asserted": 1 / 3, "operator_attested": 2 / 3, "issuer_verified": 1.0}


def component(*signals: Column) -> Column:
    """Mean of the non-NULL clipped sub-signals."""
    n = sum((F.when(s.isNotNull(), 1).otherwise(0) for s in signals), F.lit(0))
    # clip01(NULL) is 1.0, so a NULL sub-signal must not reach the sum: mask it explicitly
    tot = sum((F.when(s.isNotNull(), clip01(s)).otherwise(F.lit(0.0)) for s in signals), F.lit(0.0))
    return ratio(tot, n)


def score(df: DataFrame, weights: Mapping[str, float], name: str) -> DataFrame:
    """``name = 100 * sum(weight * component)``; components must already be columns of ``df``."""
    s = sum((F.coalesce(F.col(c), F.lit(0.0)) * F.lit(w) for c, w in weights.items()), F.lit(0.0))
    return df.withColumn(name, F.lit(100.0) * s)


BAD_AFTER = 2  # disputes after which a merchant (fraudulent ones) or an agent counts as bad
DEVICE_DAYS = 3
SESSION_GAP = "2 hours"


def merchant_inputs(txns: DataFrame, disputes: DataFrame, as_of: str, days: int = 30) -> DataFrame:
    """What an evidence bundle states of a merchant, from rows before T: 30-day dispute / refund / decline rates (disputes by creation
    time), account age, repeat-customer rate, risky-customer share, country concentration."""
    t = F.lit(as_of).cast("timestamp_ntz")
    start = t - F.make_dt_interval(days=F.lit(days))
    tx = txns.where(F.col("ts") < t)
    recent = F.col("ts") >= start
    d_recent = (disputes.where((F.col("created") < t) & (F.col("created") >= start))
                        .join(txns.select("txn_id", "merchant_id"), "txn_id")
                        .groupBy("merchant_id").agg(F.count("*").alias("disputes_30d")))
    cust_first_dispute = (disputes.where(F.col("created") < t).join(txns.select("txn_id", "customer_id"), "txn_id")
                                  .groupBy("customer_id").agg(F.lit(True).alias("_risky")))
    first = tx.groupBy("merchant_id", "customer_id").agg(F.min("ts").alias("_first"))
    base = (tx.join(first, ["merchant_id", "customer_id"]).join(cust_first_dispute, "customer_id", "left")
              .groupBy("merchant_id").agg(
                  F.count_if(recent).alias("txns_30d"),
                  F.count_if(recent & F.col("refunded")).alias("refunds_30d"),
                  F.count_if(recent & F.col("declined")).alias("declines_30d"),
                  F.min("ts").alias("first_txn"),
                  F.avg((F.col("ts") > F.col("_first")).cast("int")).alias("repeat_rate"),
                  F.avg(F.coalesce("_risky", F.lit(False)).cast("int")).alias("risky_customer_ratio"),
                  F.count("*").alias("txns")))
    by_cty = tx.groupBy("merchant_id", "country").agg(F.count("*").alias("_c")) \
        .groupBy("merchant_id").agg(F.max("_c").alias("_top_country"))
    return (base.join(d_recent, "merchant_id", "left").join(by_cty, "merchant_id", "left")
                .withColumn("disputes_30d", F.coalesce("disputes_30d", F.lit(0)))
                .withColumn("dispute_rate_30d", ratio("disputes_30d", "txns_30d"))
                .withColumn("refund_rate_30d", ratio("refunds_30d", "txns_30d"))
                .withColumn("decline_rate_30d", ratio("declines_30d", "txns_30d"))
                .withColumn("account_age_days", seconds_between(t, F.col("first_txn")) / F.lit(86400.0))
                .withColumn("top_country_share", ratio("_top_country", "txns"))
                .drop("_top_country"))


def _day(c: str) -> Column:
    return F.to_date(c)


def _before(df: DataFrame, ts: str, at: str | None) -> DataFrame:
    """What was known by then, as a plain comparison that reaches the scan."""
    return df.where(F.col(ts) < F.lit(at).cast("timestamp_ntz")) if at else df


def _grid(rows: DataFrame, key: str, until: str | None) -> DataFrame:
    """A row for each key and day, from its first row to the last day of all (or the day before ``until``)."""
    first = rows.groupBy(key).agg(F.min("ts").alias("first_txn"))
    last = F.date_sub(F.lit(until).cast("date"), 1) if until else rows.agg(F.max(_day("ts"))).scalar()
    return (first.where(_day("first_txn") <= last)
            .select(key, "first_txn", F.explode(F.sequence(_day("first_txn"), last, F.expr("interval 1 day"))).alias("day"))
            .withColumn("snapshot", F.date_add("day", 1).cast("timestamp_ntz")))


def _changes(parts: Sequence[tuple[str, DataFrame]], key: str, grid: DataFrame) -> DataFrame:
    """Sums by key and day of changes (key, day, name, n), as columns; what changed before the key's first day counts on it."""
    names = [name for name, _ in parts]
    first = grid.groupBy(key).agg(F.min("day").alias("_first"))
    flat = None
    for name, df in parts:
        own = df.select(key, "day", F.lit(name).alias("name"), F.col("n").cast("long").alias("n"))
        flat = own if flat is None else flat.unionByName(own)
    return (flat.join(first, key).groupBy(key, F.greatest("day", "_first").alias("day"))
            .agg(*[F.sum(F.when(F.col("name") == n, F.col("n")).otherwise(0)).alias(n) for n in names]))


def _span(df: DataFrame, key: str, begin: Column, end: Column, n: Column | None = None) -> DataFrame:
    """+n on ``begin`` and -n on ``end`` (dates; spans that end before they begin are none)."""
    n = F.lit(1).cast("long") if n is None else n
    return (df.where(begin < end).select(key, F.inline(F.array(F.struct(begin.alias("day"), n.alias("n")), F.struct(end.alias("day"), (-n).alias("n"))))))


def _bad_from(disputed: DataFrame, key: str) -> DataFrame:
    """(src, risky_from): when the key's disputes reached BAD_AFTER (a group limit keeps the rest out of the shuffle)."""
    nth = F.row_number().over(Window.partitionBy(key).orderBy("created", "dispute_id"))
    return (disputed.withColumn("_nth", nth).where(F.col("_nth") <= BAD_AFTER).where(F.col("_nth") == BAD_AFTER)
            .select(F.col(key).alias("src"), F.col("created").alias("risky_from")))


def _frames(key: str):
    own = Window.partitionBy(key).orderBy("day")

    def over(name: str, days: int, skip: int = 0) -> Column:
        """Sum over the last ``days`` days, or over those before the last ``skip``."""
        return F.sum(name).over(own.rowsBetween(-days - skip + 1, -skip))

    def total(name: str) -> Column:
        return F.sum(name).over(own.rowsBetween(Window.unboundedPreceding, 0))

    return own, over, total


def _country_shift(txns: DataFrame, key: str) -> DataFrame:
    """Total-variation distance of country shares, last 7 days against the 7 before, per key and day."""
    daily = txns.groupBy(key, "country", _day("ts").alias("_d")).agg(F.count("*").alias("_c"))
    reach = daily.select(key, "country", "_c", "_d", F.explode(F.sequence(F.lit(0), F.lit(13))).alias("_k"))
    now = F.col("_k") < 7
    by = (reach.groupBy(key, F.date_add("_d", F.col("_k")).alias("day"), "country")
          .agg(F.sum(F.when(now, F.col("_c")).otherwise(0)).alias("_r"), F.sum(F.when(~now, F.col("_c")).otherwise(0)).alias("_b")))
    whole = Window.partitionBy(key, "day")  # a row per country
    apart = F.abs(F.coalesce(ratio(F.col("_r"), F.sum("_r").over(whole)), F.lit(0.0)) - F.coalesce(ratio(F.col("_b"), F.sum("_b").over(whole)), F.lit(0.0)))
    return by.select(key, "day", apart.alias("_a")).groupBy(key, "day").agg((F.lit(0.5) * F.sum("_a")).alias("country_shift"))


def merchant_daily(txns: DataFrame, disputes: DataFrame, accounts: DataFrame, at: str | None = None) -> DataFrame:
    """The inputs of the merchant score, per merchant and snapshot, or for the one snapshot ``at`` (a midnight). ``accounts``:
    versions (merchant_id, account_version, bank_id, owner_id, valid_from, valid_to, charges_enabled, payouts_enabled,
    requirements_due)."""
    key = "merchant_id"
    txns, disputes, accounts = _before(txns, "ts", at), _before(disputes, "created", at), _before(accounts, "valid_from", at)
    grid = _grid(txns, key, at)
    pair = txns.groupBy(key, "customer_id").agg(F.min("ts").alias("_first"))
    daily = (txns.join(pair, [key, "customer_id"]).groupBy(key, _day("ts").alias("day"))
             .agg(F.count("*").alias("n"), F.sum("amount").alias("volume"), F.count_if("refunded").alias("refunds"), F.count_if("declined").alias("declines"),
                  F.sum("risk_score").alias("risk"), F.count_if(F.col("ts") <= F.col("_first")).alias("fresh")))
    disputed = disputes.select("dispute_id", "txn_id", "created", "reason").join(txns.select("txn_id", key, "customer_id"), "txn_id")
    filed = disputed.groupBy(key, _day("created").alias("day")).agg(F.count("*").alias("disputes"), F.count_if(F.col("reason") == "fraudulent").alias("frauds"))
    turned = disputed.groupBy("customer_id").agg(F.min(_day("created")).alias("_turned"))
    met = (txns.join(turned, "customer_id").groupBy(key, _day("ts").alias("_d"), "_turned").agg(F.count("*").alias("n")))
    banks = accounts.select(key, _day("valid_from").alias("_d"))
    changes = _changes([("risky", _span(met, key, F.greatest("_d", "_turned"), F.date_add("_d", 30), F.col("n"))),
                        ("new_banks", _span(banks, key, F.col("_d"), F.date_add("_d", 30)))], key, grid)
    rows = (grid.join(daily, [key, "day"], "left").join(filed, [key, "day"], "left").join(changes, [key, "day"], "left")
            .na.fill(0, ["n", "volume", "refunds", "declines", "risk", "fresh", "disputes", "frauds", "risky", "new_banks"]))
    own, over, total = _frames(key)
    month = own.rowsBetween(-27, 0)
    ticket = ratio("volume", "n")
    rows = rows.withColumn("_ticket", ticket).select(
        key, "day", "snapshot",
        ratio(over("disputes", 30), over("n", 30)).alias("dispute_rate_30d"), ratio(over("frauds", 7), over("n", 7)).alias("fraud_rate_7d"),
        ratio(over("frauds", 30), over("n", 30)).alias("fraud_rate_30d"), ratio(over("refunds", 30), over("n", 30)).alias("refund_rate_30d"),
        ratio(over("declines", 30), over("n", 30)).alias("decline_rate_30d"), ratio(over("volume", 7), over("volume", 7, 7)).alias("volume_growth"),
        ratio(ratio(over("volume", 7), over("n", 7)), ratio(over("volume", 7, 7), over("n", 7, 7))).alias("ticket_change"),
        (seconds_between("snapshot", "first_txn") / F.lit(86400.0)).alias("account_age_days"), total("new_banks").alias("bank_changes_30d"),
        ratio(total("risky"), over("n", 30)).alias("risky_customer_ratio"), ratio(over("fresh", 30), over("n", 30)).alias("new_customer_ratio"),
        (ratio(over("risk", 30), over("n", 30)) / 100).alias("customer_risk"), ratio(over("fresh", 7), over("fresh", 7, 7)).alias("new_customer_spike"),
        ratio(F.col("volume") - F.avg("volume").over(month), F.stddev_samp("volume").over(month)).alias("volume_z"),
        ratio(F.col("_ticket") - F.avg("_ticket").over(month), F.stddev_samp("_ticket").over(month)).alias("ticket_z"))
    rows = as_of(rows, at) if at else rows
    shift = _country_shift(txns, key)
    standing = ["account_version", "valid_from", "valid_to", "charges_enabled", "payouts_enabled", "requirements_due"]
    rows = rows.join(shift, [key, "day"], "left").na.fill(0.0, ["country_shift"])
    # what needs only key and day is looked up for these, apart from the sums
    days = grid.select(key, "day", "snapshot")
    state = features.asof(as_of(days, at) if at else days, accounts, key, "snapshot", "valid_from", standing, "acct")
    state = state.withColumn("external_account_age_days", seconds_between("snapshot", "acct_valid_from") / F.lit(86400.0))
    edges = (graph.recorded(accounts, "bank", key, "bank_id", "valid_from", F.col("valid_to"))
             .unionByName(graph.recorded(accounts, "owner", key, "owner_id", "valid_from", F.col("valid_to")))
             .unionByName(graph.sighted(txns, [("device", key, "device_id", DEVICE_DAYS)])))
    bad = _bad_from(disputed.where(F.col("reason") == "fraudulent"), key)
    state = state.withColumn("_id", F.col(key).cast("long") * 1_000_000 + F.unix_date("day"))
    state = graph.risky_at(state, edges, bad, "_id", key, "snapshot", ["bank", "owner", "device"])
    rows = rows.drop("snapshot").join(state, [key, "day"])
    hops = F.when(F.col("risky_from") < F.col("snapshot"), 0).when(F.col("risky_neighbours") > 0, 1)
    return rows.join(bad.withColumnRenamed("src", key), key, "left").withColumn("bad_merchant_hops", hops).drop("risky_from", "_id", "acct_ts")


def merchant(inputs: DataFrame, weights: Mapping[str, float] = MERCHANT_WEIGHTS) -> DataFrame:
    """``merchant_trust_score`` and its five components from ``merchant_daily``."""
    c = F.col
    flag = lambda name: c(name).cast("double")
    df = (inputs
          .withColumn("transaction", component(1 - c("dispute_rate_30d") / 0.05, 1 - c("fraud_rate_7d") / 0.05, 1 - c("fraud_rate_30d") / 0.03,
                                               1 - c("refund_rate_30d") / 0.10, 1 - c("decline_rate_30d") / 0.30, 2 - c("volume_growth"), 2 - c("ticket_change")))
          .withColumn("identity", component(c("account_age_days") / 90, flag("acct_charges_enabled"), flag("acct_payouts_enabled"),
                                            1 - c("acct_requirements_due") / 5, c("external_account_age_days") / 60, 1 - c("bank_changes_30d") / 3))
          .withColumn("behavioral", component(1 - F.abs("volume_z") / 4, 1 - F.abs("ticket_z") / 4, 2 - c("new_customer_spike"), 1 - c("country_shift")))
          .withColumn("customer", component(1 - c("new_customer_ratio"), 1 - c("risky_customer_ratio"), 1 - c("customer_risk")))
          .withColumn("network", component(1 - c("bank_risky") / 3, 1 - c("owner_risky") / 3, 1 - c("device_risky") / 100, 1 - c("risky_neighbor_ratio") * 2,
                                           F.coalesce(c("bad_merchant_hops") / 2, F.lit(1.0)))))
    return score(df, weights, "merchant_trust_score")


def agent_daily(txns: DataFrame, agents: DataFrame, mandates: DataFrame, sessions: DataFrame, disputes: DataFrame,
                at: str | None = None) -> DataFrame:
    """The inputs of the agent score, per agent and snapshot (or for the one snapshot ``at``): attestation, mandate violations, replays and revocations, pace
    against the other agents of the day, merchant diversity, session shape, flagged agents on its devices, missing intent."""
    key = "agent_id"
    txns, disputes = _before(txns, "ts", at), _before(disputes, "created", at)
    grid = _grid(txns, key, at)
    scope = mandates.select("mandate_id", "max_amount_per_txn", "expires_at", "revoked_at")
    intent = sessions.select("session_id", "user_intent_present")
    used = features.replay(txns, mandates).join(scope, "mandate_id", "left").join(intent, "session_id", "left")
    beyond = (F.col("amount") > F.col("max_amount_per_txn")) | (F.col("ts") > F.col("expires_at")) | F.coalesce(F.col("ts") > F.col("revoked_at"), F.lit(False))
    sure = lambda b: F.count_if(F.coalesce(b, F.lit(False)))
    daily = used.groupBy(key, _day("ts").alias("day")).agg(F.count("*").alias("n"), sure(beyond).alias("violations"), sure(F.col("single_use_violated")).alias("replays"),
                                                          sure(~F.col("user_intent_present")).alias("unasked"))
    disputed = disputes.select("dispute_id", "txn_id", "created").join(txns.select("txn_id", key), "txn_id")
    filed = disputed.groupBy(key, "txn_id").agg(F.min(_day("created")).alias("day")).groupBy(key, "day").agg(F.count("*").alias("disputed"))
    # sessions count on the day that their gap ends; Spark merges them per agent from partial sessions
    shape = (txns.groupBy(key, F.session_window("ts", SESSION_GAP).alias("w")).agg(F.count("*").alias("_n"))
             .groupBy(key, _day("w.end").alias("day")).agg(F.count("*").alias("sessions"), F.sum("_n").alias("session_txns"),
                                                           F.sum(seconds_between(F.col("w.end"), F.col("w.start"))).alias("session_seconds")))
    seen = txns.select(key, "merchant_id", _day("ts").alias("_d")).distinct()
    again = F.lead("_d").over(Window.partitionBy(key, "merchant_id").orderBy("_d"))  # a row per pair and day
    seen = seen.withColumn("_until", F.least(F.date_add("_d", 30), F.coalesce(again, F.date_add("_d", 30))))
    never = F.lit("9999-12-31").cast("date")
    changes = _changes([("merchants", _span(seen, key, F.col("_d"), F.col("_until"))),
                        ("issued", _span(mandates, key, _day("issued_at"), never)),
                        ("revoked", _span(mandates.where("revoked_at is not null"), key, _day("revoked_at"), never))], key, grid)
    rows = (grid.join(daily, [key, "day"], "left").join(filed, [key, "day"], "left").join(shape, [key, "day"], "left").join(changes, [key, "day"], "left")
            .na.fill(0, ["n", "violations", "replays", "unasked", "disputed", "sessions", "session_txns", "session_seconds", "merchants", "issued", "revoked"]))
    _, over, total = _frames(key)
    rows = rows.select(
        key, "day", "snapshot", ratio(over("violations", 30), over("n", 30)).alias("violation_rate"), ratio(over("replays", 30), over("n", 30)).alias("replay_rate"),
        ratio(total("revoked"), total("issued")).alias("revoked_share"), ratio(over("unasked", 30), over("n", 30)).alias("no_intent_rate"),
        ratio(total("disputed"), total("n")).alias("disputed_rate"), over("n", 7).alias("_week"), total("merchants").alias("merchants_30d"),
        ratio(over("session_txns", 30), over("sessions", 30)).alias("txns_per_session"),
        (ratio(over("session_seconds", 30), over("sessions", 30)) / 3600).alias("hours_per_session"))
    rows = as_of(rows, at) if at else rows
    norm = rows.groupBy("day").agg(F.avg("_week").alias("_norm"))
    rows = rows.join(norm, "day").withColumn("pace", ratio("_week", "_norm")).drop("_week", "_norm")
    edges = graph.sighted(txns, [("device", key, "device_id", DEVICE_DAYS)])
    days = grid.select(key, "day", "snapshot").withColumn("_id", F.col(key).cast("long") * 1_000_000 + F.unix_date("day"))
    near = graph.risky_at(as_of(days, at) if at else days, edges, _bad_from(disputed, key), "_id", key, "snapshot").drop("_id")
    rows = rows.drop("snapshot").join(near, [key, "day"])
    level = F.create_map(*[x for k, v in ATTESTATION_SCORE.items() for x in (F.lit(k), F.lit(float(v)))])
    known = agents.select(key, level[F.col("attestation_level")].alias("attestation_level_score"), "attestation_expires_at",
                          F.coalesce(F.col("claimed_operator") == F.col("verified_operator"), F.lit(False)).alias("operator_verified"),
                          F.col("first_seen").alias("_seen"))
    return (rows.join(known, key, "left").withColumn("attestation_valid", F.col("attestation_expires_at") > F.col("snapshot"))
            .withColumn("known_days", seconds_between("snapshot", "_seen") / F.lit(86400.0)).drop("attestation_expires_at", "_seen"))


def agent(inputs: DataFrame, weights: Mapping[str, float] = AGENT_WEIGHTS) -> DataFrame:
    """``agent_trust_score`` and its five components from ``agent_daily``."""
    c = F.col
    df = (inputs
          .withColumn("attestation", component(c("attestation_level_score"), c("attestation_valid").cast("double"),
                                               c("operator_verified").cast("double"), c("known_days") / 60))
          .withColumn("mandate_compliance", component(1 - c("violation_rate"), 1 - c("replay_rate") * 5, 1 - c("revoked_share") * 5))
          .withColumn("behavioral", component(2 - c("pace"), c("merchants_30d") / 20, 1 - (c("txns_per_session") - 1) / 4, c("hours_per_session") / 4))
          .withColumn("network", component(1 - c("disputed_rate") * 5, 1 - c("risky_neighbor_ratio") * 2))
          .withColumn("injection", component(1 - c("no_intent_rate"))))
    return score(df, weights, "agent_trust_score")


def as_of(daily: DataFrame, at: str) -> DataFrame:
    """The snapshot of one day."""
    return daily.where(F.col("snapshot") == F.lit(at).cast("timestamp_ntz"))
