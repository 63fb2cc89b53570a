"""Evaluation harness: PR curve and PR-AUC, confusion, recall by group, reliability, baseline
comparison, dollars and queues - all as aggregates (no driver-side metric loops).

The PR curve has a point for every distinct score, however many there are: counts per score are running
sums over ranges of scores (``windows.prior``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketlake.operators.windows import ROWS, prior


def pr_curve(df: DataFrame, score: str = "p_fraud", label: str = "is_fraud", rows: int = ROWS) -> DataFrame:
    """Per threshold (distinct score): pos, neg at the score, tp, fp at or above it, precision, recall."""
    per = df.groupBy(F.col(score).alias("threshold")).agg(F.count_if(F.col(label)).alias("pos"), F.count_if(~F.col(label)).alias("neg"))
    total = df.agg(F.count_if(F.col(label))).scalar()
    above = prior(per.withColumns({"_k": F.lit(0), "_t": -F.col("threshold")}), ["_k"], "_t", {"tp": F.col("pos"), "fp": F.col("neg")}, rows=rows, through=True)
    return (above.select("threshold", "pos", "neg", "tp", "fp")
                 .withColumn("precision", F.col("tp") / (F.col("tp") + F.col("fp")))
                 .withColumn("recall", F.try_divide(F.col("tp"), total)))


def pr_auc(curve: DataFrame) -> DataFrame:
    """Average precision: every positive's precision at its own score, averaged. One row."""
    return curve.agg(F.try_divide(F.sum(F.col("pos") * F.col("precision")), F.sum("pos")).alias("pr_auc"))


def confusion(df: DataFrame, flag: str, label: str = "is_fraud") -> DataFrame:
    """tp / fp / fn / tn, precision, recall and false-positive rate for a boolean decision column."""
    a = df.agg(F.count_if(F.col(flag) & F.col(label)).alias("tp"), F.count_if(F.col(flag) & ~F.col(label)).alias("fp"),
               F.count_if(~F.col(flag) & F.col(label)).alias("fn"), F.count_if(~F.col(flag) & ~F.col(label)).alias("tn"))
    return (a.withColumn("precision", F.try_divide(F.col("tp"), F.col("tp") + F.col("fp")))
             .withColumn("recall", F.try_divide(F.col("tp"), F.col("tp") + F.col("fn")))
             .withColumn("fpr", F.try_divide(F.col("fp"), F.col("fp") + F.col("tn"))))


def recall_by(df: DataFrame, group: str, flag: str, label: str = "is_fraud") -> DataFrame:
    """Recall of the decision per group value (scenario, channel), over positives only."""
    return (df.where(F.col(label)).groupBy(group)
              .agg(F.count("*").alias("positives"), F.count_if(F.col(flag)).alias("caught"))
              .withColumn("recall", F.col("caught") / F.col("positives")))


def reliability(df: DataFrame, p: str = "p_fraud", label: str = "is_fraud", bins: int = 10) -> DataFrame:
    """Reliability curve: per probability bin, mean predicted vs observed rate."""
    b = F.least(F.floor(F.col(p) * bins), F.lit(bins - 1)).cast("int").alias("bin")
    return df.groupBy(b).agg(F.count("*").alias("n"), F.avg(p).alias("mean_p"),
                             F.avg(F.col(label).cast("int")).alias("observed_rate"))


def vs_baseline(df: DataFrame, model_flag: str, baseline_flag: str, label: str = "is_fraud") -> DataFrame:
    """Caught by both / model only / baseline only / neither (positives), and false declines of each."""
    m, b, y = F.col(model_flag), F.col(baseline_flag), F.col(label)
    return df.agg(F.count_if(y & m & b).alias("both"), F.count_if(y & m & ~b).alias("model_only"),
                  F.count_if(y & ~m & b).alias("baseline_only"), F.count_if(y & ~m & ~b).alias("neither"),
                  F.count_if(~y & m).alias("model_false_declines"), F.count_if(~y & b).alias("baseline_false_declines"))


def dollars(df: DataFrame, ts: str = "ts", amount: str = "amount", label: str = "is_fraud",
            decision: str = "decision") -> DataFrame:
    """Per day: fraud dollars captured (declined) and lost (approved), false-decline dollars."""
    dec, y = F.col(decision), F.col(label)
    return df.groupBy(F.to_date(ts).alias("day")).agg(
        F.sum(F.when(y & (dec == "DECLINE"), F.col(amount)).otherwise(0.0)).alias("fraud_captured_usd"),
        F.sum(F.when(y & (dec == "APPROVE"), F.col(amount)).otherwise(0.0)).alias("fraud_lost_usd"),
        F.sum(F.when(~y & (dec == "DECLINE"), F.col(amount)).otherwise(0.0)).alias("false_decline_usd"))


def queues(df: DataFrame, capacity: int, ts: str = "ts", decision: str = "decision") -> DataFrame:
    """Per day: review and step-up queue volume vs capacity."""
    return (df.groupBy(F.to_date(ts).alias("day"))
              .agg(F.count_if(F.col(decision) == "REVIEW").alias("review"),
                   F.count_if(F.col(decision) == "STEP_UP").alias("step_up"))
              .withColumn("capacity", F.lit(capacity))
              .withColumn("over_capacity", F.col("review") > F.col("capacity")))


def compare(a: DataFrame, b: DataFrame, key: str, metric: str = "recall") -> DataFrame:
    """Two recall tables (e.g. two scales) side by side with the delta; keys missing on one side kept."""
    return (a.select(key, F.col(metric).alias("a")).join(b.select(key, F.col(metric).alias("b")), key, "full")
             .withColumn("delta", F.col("b") - F.col("a")))
