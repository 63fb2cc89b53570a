"""Cost-based decision policy: expected costs, amount-aware decision, review capacity, STEP_UP.

``p_fraud`` is a calibrated probability per transaction. Decisions are column expressions; the only
shuffle is the per-day review ranking, which is a top-``capacity`` per day (partial top-k before the
exchange, ``WindowGroupLimit``), joined back by transaction id.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# Fixed values of the policy configuration. The review cost is not given by the spec: a parameter.
COST_FALSE_DECLINE_USD = 45.0
DISPUTE_FEE_USD = 25.0
REVIEW_CAPACITY_PER_DAY = 400
REVIEW_COST_USD = 5.0
POLICY_VERSION = "cost-v1"


def costs(df: DataFrame, p: str = "p_fraud", amount: str = "amount",
          false_decline: float = COST_FALSE_DECLINE_USD, dispute_fee: float = DISPUTE_FEE_USD,
          review_cost: float = REVIEW_COST_USD) -> DataFrame:
    """Expected cost of approve / decline / review and the uncapped decision.

    approve = p * (amount + fee); decline = (1 - p) * false_decline; review = review_cost (an analyst
    resolves the case). REVIEW when review is cheaper than both, else the cheaper of the other two."""
    ap = F.col(p) * (F.col(amount) + F.lit(dispute_fee))
    de = (F.lit(1.0) - F.col(p)) * F.lit(false_decline)
    rv = F.lit(review_cost)
    decision = (F.when((rv < ap) & (rv < de), "REVIEW")
                 .when(ap > de, "DECLINE").otherwise("APPROVE"))
    return (df.withColumn("cost_approve", ap).withColumn("cost_decline", de).withColumn("cost_review", rv)
              .withColumn("decision", decision))


def cap_review(df: DataFrame, capacity: int = REVIEW_CAPACITY_PER_DAY, ts: str = "ts", key: str = "txn_id") -> DataFrame:
    """Keep at most ``capacity`` REVIEW decisions per day - those with the largest saving
    ``min(cost_approve, cost_decline) - cost_review`` (ties by ``key``); the rest fall back to the
    cheaper of approve / decline."""
    saving = F.least("cost_approve", "cost_decline") - F.col("cost_review")
    cand = df.where(F.col("decision") == "REVIEW").select(key, F.to_date(ts).alias("_day"), saving.alias("_saving"))
    w = Window.partitionBy("_day").orderBy(F.desc("_saving"), F.asc(key))
    kept = (cand.withColumn("_rank", F.row_number().over(w)).where(F.col("_rank") <= capacity)
                .select(key, F.lit(True).alias("_kept")))
    fallback = F.when(F.col("cost_approve") > F.col("cost_decline"), "DECLINE").otherwise("APPROVE")
    return (df.join(kept, key, "left")
              .withColumn("decision", F.when((F.col("decision") == "REVIEW") & F.col("_kept").isNull(), fallback)
                          .otherwise(F.col("decision")))
              .drop("_kept"))


def step_up(df: DataFrame, mandates: DataFrame, threshold_col: str = "requires_human_confirmation_above",
            agent_trust: str | None = None, trust_min: float = 70.0, arm: str | None = None) -> DataFrame:
    """STEP_UP for ``agent_delegated`` transactions when the amount exceeds the mandate's
    human-confirmation threshold, or the decision is REVIEW and a human principal is reachable, or
    the mandate scope is exceeded while the agent's trust is otherwise high. ``arm``: also tell, under this
    name, which of these held first (``confirmation``, ``review``, ``trusted_agent``)."""
    cols = ["mandate_id", "max_amount_per_txn"] + ([threshold_col] if threshold_col in mandates.columns else [])
    m = mandates.select(*cols)
    t = df.join(m, "mandate_id", "left")
    thr = F.col(threshold_col) if threshold_col in mandates.columns else F.col("max_amount_per_txn")
    reachable = F.col("user_intent_present") if "user_intent_present" in df.columns else F.lit(True)
    exceeded = F.col("amount") > F.col("max_amount_per_txn")
    trusted = (F.col(agent_trust) >= trust_min) if agent_trust else F.lit(False)
    sure = lambda c: F.coalesce(c, F.lit(False))
    held = (F.when(sure(F.col("amount") > thr), "confirmation").when(sure((F.col("decision") == "REVIEW") & reachable), "review")
             .when(sure(exceeded & trusted), "trusted_agent"))
    out = (t.withColumn("_arm", F.when(F.col("channel") == "agent_delegated", held))
            .withColumn("decision", F.when(F.col("_arm").isNotNull(), "STEP_UP").otherwise(F.col("decision")))
            .drop(*[c for c in cols if c != "mandate_id"]))
    return out.withColumnRenamed("_arm", arm) if arm else out.drop("_arm")


def decide(df: DataFrame, version: str = POLICY_VERSION) -> DataFrame:
    return df.withColumn("decision_policy_version", F.lit(version))


def sweep(df: DataFrame, params: Sequence[Mapping[str, float]], p: str = "p_fraud",
          amount: str = "amount") -> DataFrame:
    """Threshold sensitivity: decisions under each parameter set. The (small, literal) parameter list
    is expanded per row with ``inline`` - no join - then one grouped count per parameter set."""
    arr = F.array(*[F.struct(F.lit(float(q["cost_false_decline_usd"])).alias("cost_false_decline_usd"),
                             F.lit(float(q.get("review_cost_usd", REVIEW_COST_USD))).alias("review_cost_usd"))
                    for q in params])
    x = df.select(p, amount, F.inline(arr))
    ap = F.col(p) * (F.col(amount) + F.lit(DISPUTE_FEE_USD))
    de = (F.lit(1.0) - F.col(p)) * F.col("cost_false_decline_usd")
    rv = F.col("review_cost_usd")
    dec = F.when((rv < ap) & (rv < de), "REVIEW").when(ap > de, "DECLINE").otherwise("APPROVE")
    return (x.withColumn("decision", dec)
             .groupBy("cost_false_decline_usd", "review_cost_usd")
             .agg(F.count_if(F.col("decision") == "APPROVE").alias("approve"),
                  F.count_if(F.col("decision") == "DECLINE").alias("decline"),
                  F.count_if(F.col("decision") == "REVIEW").alias("review")))
