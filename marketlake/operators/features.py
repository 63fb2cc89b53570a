"""Point-in-time transaction features (every value uses only rows strictly before the transaction).

Inputs are transaction rows ``(txn_id, customer_id, merchant_id, agent_id, mandate_id, session_id,
device_id, country, lat, lon, ts, amount, channel, declined, refunded, ...)`` plus dimension
tables (mandates, sessions, agents, disputes). Hot keys are handled by the range-cut helpers
in ``marketlake.operators.windows``; first-seen style signals are partial aggregates joined back.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from marketlake.functions.exprs import haversine_km, ratio, seconds_between
from marketlake.operators.windows import distinct_sliding, prior_last, prior_running, sliding
from marketlake.session import discard, materialize

AGENT_CHANNELS = ["agent_delegated", "agent_to_agent"]


def velocity(df: DataFrame, key: str, ts: str = "ts", windows: Sequence[int] = (60, 300),
             prefix: str | None = None) -> DataFrame:
    """Count and amount of the key's transactions in the previous ``w`` seconds, per window."""
    prefix = prefix or key
    return sliding(df, [key], ts, windows, "amount", {w: (f"{prefix}_txn_count_{w}s", f"{prefix}_amount_{w}s") for w in windows})


def distinct_in_window(df: DataFrame, key: str, item: str, ts: str = "ts", width_s: int = 300,
                       name: str | None = None) -> DataFrame:
    """Number of distinct ``item`` values the key touched in the previous ``width_s`` seconds."""
    return distinct_sliding(df, [key], item, ts, width_s, name or f"{key}_unique_{item}_{width_s}s")


def velocity_ratio(vel: DataFrame, count_col: str, channel: str = "channel", ts: str = "ts") -> DataFrame:
    """Per day: mean short-window count on agent channels vs human ones, and their ratio."""
    is_agent = F.col(channel).isin(*AGENT_CHANNELS)
    return (vel.groupBy(F.to_date(ts).alias("day"))
               .agg(F.avg(F.when(is_agent, F.col(count_col))).alias("agent_avg"),
                    F.avg(F.when(~is_agent, F.col(count_col))).alias("human_avg"))
               .withColumn("agent_vs_human_velocity_ratio", ratio("agent_avg", "human_avg")))


def first_seen(df: DataFrame, keys: Sequence[str], ts: str = "ts", name: str = "first_seen") -> DataFrame:
    """First time each key combination appears (partial aggregate, one row per combination)."""
    return df.groupBy(*keys).agg(F.min(ts).alias(name))


def novelty(df: DataFrame, customer: str = "customer_id", ts: str = "ts") -> DataFrame:
    """New device / new country for the customer, and amount relative to the customer's earlier
    average (NULL when the customer has no earlier transaction)."""
    dev = first_seen(df, [customer, "device_id"], ts, "_dev_first")
    cty = first_seen(df, [customer, "country"], ts, "_cty_first")
    out = (df.join(dev, [customer, "device_id"]).join(cty, [customer, "country"])
             .withColumn("new_device", F.col(ts) <= F.col("_dev_first"))
             .withColumn("new_country", F.col(ts) <= F.col("_cty_first"))
             .drop("_dev_first", "_cty_first"))
    out = prior_running(out, [customer], ts, "amount", prefix="_cust")
    return (out.withColumn("amount_vs_customer_avg",
                           ratio(F.col("amount"), ratio(F.col("_cust_sum"), F.col("_cust_n"))))
               .drop("_cust_n", "_cust_sum"))


def distance_prev(df: DataFrame, key: str = "customer_id", ts: str = "ts") -> DataFrame:
    """Great-circle km from the key's previous transaction (NULL for the first)."""
    out = prior_last(df, [key], ts, ["lat", "lon"], prefix="_prev")
    return (out.withColumn("distance_from_previous_txn",
                           haversine_km(F.col("_prev_lat"), F.col("_prev_lon"), F.col("lat"), F.col("lon")))
               .withColumn("seconds_since_previous_txn",
                           seconds_between(F.col(ts), F.col("_prev_ts")))
               .drop("_prev_lat", "_prev_lon", "_prev_ts"))


def daily(df: DataFrame, key: str = "merchant_id", ts: str = "ts") -> DataFrame:
    """Daily per-key aggregates: transactions, volume, average ticket, new customers that day."""
    fs = first_seen(df, [key, "customer_id"], ts, "_first")
    d = df.join(fs, [key, "customer_id"]).withColumn("_new", F.col(ts) <= F.col("_first"))
    return d.groupBy(key, F.to_date(ts).alias("day")).agg(
        F.count("*").alias("txns"), F.sum("amount").alias("volume"), F.avg("amount").alias("avg_ticket"),
        F.count_if("_new").alias("new_customers"))


def trend(daily_df: DataFrame, key: str = "merchant_id", days: int = 28) -> DataFrame:
    """Bust-out trend per key and day against the previous ``days`` calendar days: volume growth,
    ticket change, new-customer spike and z-scores (window over one row per key and day)."""
    w = Window.partitionBy(key).orderBy(F.unix_date("day")).rangeBetween(-days, -1)
    d = daily_df
    for c in ["volume", "avg_ticket", "new_customers", "txns"]:
        d = (d.withColumn(f"_{c}_mean", F.avg(c).over(w))
              .withColumn(f"_{c}_sd", F.stddev_samp(c).over(w)))
    return d.select(
        key, "day", "txns", "volume", "avg_ticket", "new_customers",
        ratio(F.col("volume"), F.col("_volume_mean")).alias("volume_growth"),
        ratio(F.col("avg_ticket"), F.col("_avg_ticket_mean")).alias("avg_ticket_change"),
        ratio(F.col("new_customers"), F.col("_new_customers_mean")).alias("new_customer_spike"),
        ratio(F.col("volume") - F.col("_volume_mean"), F.col("_volume_sd")).alias("volume_z"),
        ratio(F.col("avg_ticket") - F.col("_avg_ticket_mean"), F.col("_avg_ticket_sd")).alias("ticket_z"))


def rolling_rates(txns: DataFrame, disputes: DataFrame, key: str = "merchant_id",
                  windows: Sequence[int] = (7, 30)) -> DataFrame:
    """Dispute, refund and decline rates over the ``d`` calendar days before each transaction's day.

    Disputes count on the day they were *created* (not the charge day), so a dispute filed after
    the transaction's day is invisible to it. Per key and day counts are partial aggregates; the
    range windows run over one row per key and day."""
    tx_daily = txns.groupBy(key, F.to_date("ts").alias("day")).agg(
        F.count("*").alias("n"), F.count_if("refunded").alias("refunds"), F.count_if("declined").alias("declines"))
    dk = (disputes.join(txns.select("txn_id", key), "txn_id")
                  .groupBy(key, F.to_date("created").alias("day")).agg(F.count("*").alias("disputes")))
    both = (tx_daily.join(dk, [key, "day"], "full")
                    .na.fill(0, ["n", "refunds", "declines", "disputes"]))
    for d in windows:
        w = Window.partitionBy(key).orderBy(F.unix_date("day")).rangeBetween(-d, -1)
        both = (both.withColumn(f"_n{d}", F.sum("n").over(w))
                    .withColumn(f"dispute_rate_{d}d", ratio(F.sum("disputes").over(w), F.col(f"_n{d}")))
                    .withColumn(f"refund_rate_{d}d", ratio(F.sum("refunds").over(w), F.col(f"_n{d}")))
                    .withColumn(f"decline_rate_{d}d", ratio(F.sum("declines").over(w), F.col(f"_n{d}")))
                    .drop(f"_n{d}"))
    rates = both.drop("n", "refunds", "declines", "disputes")
    return txns.withColumn("day", F.to_date("ts")).join(rates, [key, "day"], "left").drop("day")


def customer_mix(txns: DataFrame, disputes: DataFrame, as_of: str, key: str = "merchant_id") -> DataFrame:
    """Per key, from transactions before ``as_of``: repeat rate (customer seen earlier at the key),
    distinct-customer ratio and risky customer ratio (customer had a dispute created before the transaction)."""
    txns = txns.where(F.col("ts") < F.lit(as_of).cast("timestamp_ntz"))
    fs = first_seen(txns, [key, "customer_id"], "ts", "_first")
    first_dispute = (disputes.join(txns.select("txn_id", "customer_id"), "txn_id")
                             .groupBy("customer_id").agg(F.min("created").alias("_first_dispute")))
    t = (txns.join(fs, [key, "customer_id"])
             .join(first_dispute, "customer_id", "left"))
    return t.groupBy(key).agg(
        F.count("*").alias("txns"),
        F.avg((F.col("ts") > F.col("_first")).cast("int")).alias("repeat_rate"),
        (F.countDistinct("customer_id") / F.count("*")).alias("new_customer_ratio"),
        F.avg(F.coalesce(F.col("_first_dispute") < F.col("ts"), F.lit(False)).cast("int")).alias("risky_customer_ratio"))


def share_shift(txns: DataFrame, as_of: str, key: str = "merchant_id", cat: str = "country",
                days: int = 7) -> DataFrame:
    """Total-variation distance between the key's category shares in ``[T-days, T)`` and in
    ``[T-2*days, T-days)``: ``0.5 * sum(|p_recent - p_before|)``."""
    t = F.lit(as_of).cast("timestamp_ntz")
    start_recent = t - F.make_dt_interval(days=F.lit(days))
    start_before = t - F.make_dt_interval(days=F.lit(2 * days))
    period = (F.when((F.col("ts") >= start_recent) & (F.col("ts") < t), F.lit("recent"))
               .when((F.col("ts") >= start_before) & (F.col("ts") < start_recent), F.lit("before")))
    # the time range first, as a plain comparison on the scanned column, so it reaches the scan
    c = (txns.where((F.col("ts") >= start_before) & (F.col("ts") < t))
             .withColumn("_p", period)
             .groupBy(key, cat).agg(F.count_if(F.col("_p") == "recent").alias("_r"),
                                    F.count_if(F.col("_p") == "before").alias("_b")))
    tot = F.sum("_r").over(Window.partitionBy(key)), F.sum("_b").over(Window.partitionBy(key))
    shares = c.select(key, cat, ratio(F.col("_r"), tot[0]).alias("_pr"), ratio(F.col("_b"), tot[1]).alias("_pb"))
    return shares.groupBy(key).agg(
        (F.lit(0.5) * F.sum(F.abs(F.coalesce("_pr", F.lit(0.0)) - F.coalesce("_pb", F.lit(0.0))))).alias("country_shift_tvd"))


def mandate_scope(txns: DataFrame, mandates: DataFrame) -> DataFrame:
    """Scope signals of mandated transactions: amount over the per-transaction cap, category allowed
    (when the mandate lists categories), age vs expiry, transactions already used on the mandate."""
    m = mandates.select("mandate_id", "issued_at", "expires_at", "revoked_at", "max_amount_per_txn",
                        "max_txn_count", *[c for c in ["allowed_merchant_categories"] if c in mandates.columns])
    t = prior_running(txns, ["mandate_id"], "ts", prefix="_used")
    t = t.join(m, "mandate_id")
    life = seconds_between(F.col("expires_at"), F.col("issued_at"))
    out = (t.withColumn("amount_over_mandate_ratio", ratio(F.col("amount"), F.col("max_amount_per_txn")))
            .withColumn("mandate_age_vs_expiry",
                        ratio(seconds_between(F.col("ts"), F.col("issued_at")), life))
            .withColumn("after_expiry", F.col("ts") > F.col("expires_at"))
            .withColumn("after_revocation", F.coalesce(F.col("ts") > F.col("revoked_at"), F.lit(False)))
            .withColumn("mandate_txn_count_used", F.col("_used_n"))
            .withColumn("over_txn_count", F.col("_used_n") >= F.col("max_txn_count")))
    if "allowed_merchant_categories" in m.columns:
        out = out.withColumn("category_in_mandate",
                             F.array_contains("allowed_merchant_categories", F.col("merchant_category")))
    return out.drop("_used_n")


def injection(txns: DataFrame, sessions: DataFrame) -> DataFrame:
    """Prompt-injection signals: no user intent, seconds from session start to purchase, merchant
    first seen in the session, tool calls in the session before the purchase (call k is made k times
    ``tool_call_every_s`` seconds after the start)."""
    s = sessions.select("session_id", "started_at", "user_intent_present", "tool_calls_count", "tool_call_every_s")
    made = F.floor((seconds_between(F.col("ts"), F.col("started_at")) - 1) / F.col("tool_call_every_s"))
    fs = first_seen(txns, ["session_id", "merchant_id"], "ts", "_first")
    return (txns.join(s, "session_id", "left").join(fs, ["session_id", "merchant_id"])
                .withColumn("intent_signal_absent", ~F.col("user_intent_present"))
                .withColumn("session_duration_to_purchase", seconds_between(F.col("ts"), F.col("started_at")))
                .withColumn("merchant_first_seen_in_session", F.col("ts") <= F.col("_first"))
                .withColumn("tool_calls_before_purchase",
                            F.when(F.col("tool_calls_count").isNotNull(), F.greatest(F.lit(0), F.least("tool_calls_count", made))).cast("int"))
                .drop("_first", "started_at", "user_intent_present", "tool_calls_count", "tool_call_every_s"))


def attestation(txns: DataFrame, agents: DataFrame) -> DataFrame:
    """Impersonation signals from the agent registry (looked up by ``agent_id``)."""
    a = agents.select("agent_id", "attestation_level", "attestation_expires_at", "claimed_operator",
                      "verified_operator", F.col("first_seen").alias("_agent_first_seen"))
    return (txns.join(a, "agent_id", "left")
                .withColumn("attestation_expired", F.col("ts") > F.col("attestation_expires_at"))
                .withColumn("operator_claim_vs_verified",
                            ~F.coalesce(F.col("claimed_operator") == F.col("verified_operator"), F.lit(False)))
                .withColumn("agent_first_seen_days", F.datediff(F.to_date("ts"), F.to_date("_agent_first_seen")))
                .drop("attestation_expires_at", "claimed_operator", "verified_operator", "_agent_first_seen"))


def asof(left: DataFrame, right: DataFrame, key: str, left_ts: str, right_ts: str,
         cols: Sequence[str], prefix: str = "asof") -> DataFrame:
    """As-of join: for each left row, the latest right row of the same key with time strictly
    before the left row's time (``{prefix}_{col}``, ``{prefix}_ts``). Implemented as a union plus a
    running maximum over ranges - no non-equi join, no pair explosion."""
    cols = list(cols)
    l_cols = left.columns
    lt = left.select(*[F.col(c) for c in l_cols], F.col(left_ts).alias("_at"), F.lit(True).alias("_left"),
                     *[F.lit(None).cast(right.schema[c].dataType).alias(f"_r_{c}") for c in cols])
    rt = right.select(*[F.lit(None).cast(left.schema[c].dataType).alias(c) if c != key else F.col(key)
                        for c in l_cols],
                      F.col(right_ts).alias("_at"), F.lit(False).alias("_left"),
                      *[F.col(c).alias(f"_r_{c}") for c in cols])
    u = lt.unionByName(rt)
    out = prior_last(u, [key], "_at", [f"_r_{c}" for c in cols], prefix="_p", source=~F.col("_left"))
    return (out.where("_left")
               .select(*l_cols, *[F.col(f"_p__r_{c}").alias(f"{prefix}_{c}") for c in cols],
                       F.col("_p_ts").alias(f"{prefix}_ts")))


def delegation(mandates: DataFrame) -> DataFrame:
    """Delegation chains: depth (root = 0), root mandate, whether any ancestor is revoked, whether the
    mandate's per-transaction cap exceeds its parent's, and whether the chain runs into a cycle (then depth
    and root are NULL, and every ancestor met counts).

    Pointer doubling: each round a mandate's pointer jumps to its pointer's pointer, so a chain of n levels
    takes log2(n) rounds (written tables). Pointers left after more rounds than a chain could need are cycles."""
    m = mandates.select("mandate_id", "parent_mandate_id", "revoked_at", "max_amount_per_txn")
    parent = m.select(F.col("mandate_id").alias("_pid"), (F.col("revoked_at").isNotNull()).alias("_prev"),
                      F.col("max_amount_per_txn").alias("_pcap"))
    start = m.join(parent, F.col("parent_mandate_id") == F.col("_pid"), "left")
    facts = start.select("mandate_id", "parent_mandate_id", "revoked_at", "max_amount_per_txn",
                         F.coalesce(F.col("max_amount_per_txn") > F.col("_pcap"), F.lit(False)).alias("child_scope_exceeds_parent"))
    cur = materialize(start.select("mandate_id", F.col("_pid").alias("up"), F.coalesce("_pid", "mandate_id").alias("root"),
                                   F.coalesce("_prev", F.lit(False)).alias("revoked"),
                                   F.when(F.col("_pid").isNull(), 0).otherwise(1).cast("long").alias("steps")), "delegation")
    longest, reach = cur.count(), 1
    while reach <= longest and not cur.where("up is not null").isEmpty():
        far = cur.select(F.col("mandate_id").alias("_m"), F.col("up").alias("_up"), F.col("root").alias("_root"),
                         F.col("revoked").alias("_revoked"), F.col("steps").alias("_steps"))
        after = materialize(cur.join(far, F.col("up") == F.col("_m"), "left").select(
            "mandate_id", F.col("_up").alias("up"), F.coalesce("_root", "root").alias("root"),
            (F.col("revoked") | F.coalesce("_revoked", F.lit(False))).alias("revoked"),
            (F.col("steps") + F.coalesce("_steps", F.lit(0))).alias("steps")), "delegation")
        discard(cur)
        cur, reach = after, 2 * reach
    cyclic = F.col("up").isNotNull()
    ends = cur.select("mandate_id", F.when(~cyclic, F.col("steps").cast("int")).alias("delegation_depth"),
                      F.when(~cyclic, F.col("root")).alias("root_mandate_id"), F.col("revoked").alias("parent_mandate_revoked"),
                      cyclic.alias("delegation_cycle"))
    return facts.join(ends, "mandate_id")


def replay(txns: DataFrame, mandates: DataFrame) -> DataFrame:
    """Mandate replay: uses of the mandate before this one, single-use violated, seconds since the
    mandate's previous use."""
    t = prior_last(txns, ["mandate_id"], "ts", [], prefix="_prev", counted="_uses_n")
    m = mandates.select("mandate_id", "single_use")
    return (t.join(m, "mandate_id", "left")
             .withColumn("mandate_use_count", F.col("_uses_n") + 1)
             .withColumn("single_use_violated", F.coalesce(F.col("single_use"), F.lit(False)) & F.coalesce(F.col("_uses_n") >= 1, F.lit(False)))
             .withColumn("token_reuse_interval", seconds_between(F.col("ts"), F.col("_prev_ts")))
             .drop("_uses_n", "_prev_ts", "single_use"))
