"""Evidence bundles, claim verification, dashboard aggregates and stratified stream sampling."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketlake.functions.exprs import hash_bucket_sha
from marketlake.operators.windows import prior

# A number: a minus sign only at the start or after white space ("5-3" holds 5 and 3); not part of a longer
# dotted run ("1.2.3" is none), but a full stop may follow ("0.91." holds 0.91).
NUMBER = r"(?:(?<=^|\s)-)?(?<![0-9.])[0-9]+(?:\.[0-9]+)?(?!\.?[0-9])"
_MARK = "\ue000"  # a private-use character set around numbers while a text is taken apart


def bundle(features: DataFrame, entity: str, cols: Sequence[str] | None = None) -> DataFrame:
    """Long form ``(entity, feature, value)`` via ``stack`` (unpivot) of numeric feature columns."""
    cols = list(cols or [c for c, t in features.dtypes if c != entity and t in ("int", "bigint", "double", "float")])
    pairs = ", ".join(f"'{c}', cast(`{c}` as double)" for c in cols)
    return features.selectExpr(f"`{entity}` as entity", f"stack({len(cols)}, {pairs}) as (feature, value)")


def bundle_nested(long: DataFrame) -> DataFrame:
    """One row per entity with ``array<struct<feature, value>>`` sorted by feature name; the array is
    bounded by the number of features, not by data volume."""
    return long.groupBy("entity").agg(F.array_sort(F.collect_list(F.struct("feature", "value"))).alias("evidence"))


def verify(claims: DataFrame, long_bundle: DataFrame, digits: int = 4) -> DataFrame:
    """Every number in a claim must equal (to ``digits`` places) some value of the same entity's
    bundle; numbers that do not are stripped from the text.

    ``claims``: ``(claim_id, entity, text)``. Numbers are marked in place and exploded (one row per
    number), matched by a left join on ``(entity, rounded value)`` against the de-duplicated bundle
    values; the text is put together again from its pieces, so every number is judged where it stands."""
    marked = F.regexp_replace(F.translate("text", _MARK, ""), NUMBER, _MARK + "$0" + _MARK)
    taken = claims.withColumn("_pieces", F.split(marked, _MARK))  # text, number, text, ..., text
    nums = (taken.select("claim_id", "entity", F.posexplode("_pieces").alias("_at", "num")).where("_at % 2 = 1")
                 .withColumn("_v", F.round(F.col("num").cast("double"), digits)))
    vals = long_bundle.select("entity", F.round("value", digits).alias("_v")).distinct().withColumn("_ok", F.lit(True))
    per_claim = nums.join(vals, ["entity", "_v"], "left").groupBy("claim_id").agg(
        F.count("*").alias("numbers"), F.count_if(F.col("_ok").isNull()).alias("unsupported"),
        F.collect_set(F.when(F.col("_ok").isNull(), F.col("_at"))).alias("_bad"))  # as many as the claim has numbers
    verified = F.array_join(F.transform("_pieces", lambda x, i: F.when(
        F.array_contains(F.coalesce("_bad", F.array().cast("array<int>")), i), F.lit("[unverified]")).otherwise(x)), "")
    return (taken.join(per_claim, "claim_id", "left")
                 .withColumn("numbers", F.coalesce("numbers", F.lit(0)))
                 .withColumn("unsupported", F.coalesce("unsupported", F.lit(0)))
                 .withColumn("verified_text", verified)
                 .withColumn("passed", F.col("unsupported") == 0)
                 .drop("_bad", "_pieces"))


def dashboard(decisions: DataFrame, ts: str = "ts") -> DataFrame:
    """Risk-operations view: per hour and channel, decisions by outcome and amount. The hour bucket
    is built from the date and the hour field (wall clock, no time-zone round trip)."""
    hour = F.to_date(ts).cast("timestamp_ntz") + F.make_dt_interval(hours=F.hour(ts))
    return (decisions.groupBy(hour.alias("bucket"), "channel")
                     .agg(F.count("*").alias("txns"), F.sum("amount").alias("amount"),
                          F.count_if(F.col("decision") == "DECLINE").alias("declined"),
                          F.count_if(F.col("decision") == "REVIEW").alias("review"),
                          F.count_if(F.col("decision") == "STEP_UP").alias("step_up"),
                          F.avg("p_fraud").alias("avg_p_fraud")))


def trust_detail(daily: DataFrame, key: str, score: str, components: Sequence[str], days: int = 7) -> DataFrame:
    """Trust-detail view: for each key its last snapshot, the change since ``days`` snapshots before, the weakest component
    (ties by name) and the lowest score so far. One pass over the snapshots: the last two of interest per key are kept by
    partial aggregates."""
    last = daily.agg(F.max("snapshot")).scalar()
    before = F.col("snapshot") == last - F.make_dt_interval(F.lit(days))
    now = F.col("snapshot") == last
    weakest = F.array_min(F.array(*[F.struct(F.col(c).alias("v"), F.lit(c).alias("name")) for c in components]))
    return (daily.withColumn("_weak", F.when(now, weakest["name"])).groupBy(key)
            .agg(F.max("snapshot").alias("snapshot"), F.max(F.when(now, F.col(score))).alias("score"), F.max(F.when(before, F.col(score))).alias("score_before"),
                 F.max("_weak").alias("weakest"), F.min(score).alias("lowest"), F.min_by("snapshot", F.struct(F.col(score), F.col("snapshot"))).alias("lowest_at"))
            .withColumn("change", F.col("score") - F.col("score_before")))


def investigation(decisions: DataFrame, evidence: DataFrame, disputes: DataFrame, as_of: str, entity: str = "merchant_id") -> DataFrame:
    """Investigation view: every transaction not approved, with what its entity's evidence says (as a map), the dispute that
    was known by ``as_of``, and its rank by amount in the day's queue (1 + those of greater amounts, as a running count that
    cuts large days into ranges)."""
    facts = evidence.groupBy("entity").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("feature", "value")))).alias("facts"))  # as many as features
    t = F.lit(as_of).cast("timestamp_ntz")
    known = disputes.where(F.col("created") < t).groupBy("txn_id").agg(F.max_by("reason", "created").alias("dispute_reason"))
    flagged = decisions.where(F.col("decision") != "APPROVE")
    keyed = flagged.withColumns({"_day": F.to_date("ts"), "_t": -F.round(F.col("amount") * 1_000_000).cast("long")})
    ranked = prior(keyed, ["_day", "decision"], "_t", {"queue_rank": F.lit(1).cast("long")}).drop("_day", "_t")
    return (ranked.withColumn("queue_rank", F.col("queue_rank") + 1)
            .join(facts, F.col(entity) == F.col("entity"), "left").drop("entity").join(known, "txn_id", "left"))


def sample(df: DataFrame, fractions: Mapping[str, float], key: str, stratum: str = "channel",
           seed: int = 0) -> DataFrame:
    """Stratified hash sample: each stratum keeps its own fraction; a row is kept iff its hash
    bucket of ``(seed, key)`` falls below the fraction (stable under reruns and repartitioning,
    resolution 1/10000). Adds the inverse inclusion weight so sums stay unbiased."""
    frac = F.create_map(*[x for k, v in fractions.items() for x in (F.lit(k), F.lit(float(v)))])[F.col(stratum)]
    u = hash_bucket_sha(key, seed) / F.lit(10_000.0)
    return (df.withColumn("_f", F.coalesce(frac, F.lit(1.0))).where(u < F.col("_f"))
              .withColumn("sample_weight", F.lit(1.0) / F.col("_f")).drop("_f"))
