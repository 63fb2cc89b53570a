"""Registered model queries (B46, B50, B51, B62). Rows-only: fitted models have no SQL twin; the
leak and shuffle checks live in tests/test_leakage.py.

The feature table is written once per query and everything is fitted and measured on it: models on the
earliest six tenths of the rows with final labels, calibration on the next two, metrics on the last two."""

from __future__ import annotations

from pyspark.sql import functions as F

from marketlake.operators import evaluate, labels, model
from marketlake.operators import features as ft
from marketlake.plans.catalog import register
from marketlake.plans.q_tier_b import LABEL_AS_OF
from marketlake.session import materialize
from marketlake.sources import fixtures as fx

FEATURES = ["amount", "customer_id_txn_count_300s", "new_device", "new_country", "amount_vs_customer_avg",
            "operator_claim_vs_verified", "attestation_expired", "intent_signal_absent",
            "session_duration_to_purchase", "merchant_first_seen_in_session"]


def feature_table(spark, sf):
    """Point-in-time features per transaction plus the maturing label as of ``LABEL_AS_OF``.
    Ground-truth columns (``is_fraud``, ``scenario``) are dropped before any feature is built."""
    t = fx.f_txns(spark, sf).drop(*labels.TRUTH_COLUMNS)
    f = ft.velocity(t, "customer_id", "ts", (300,))
    f = ft.novelty(f)
    f = ft.attestation(f, fx.f_agents(spark, sf))
    f = ft.injection(f, fx.f_sessions(spark, sf))
    lab = labels.state(t, fx.f_disputes(spark, sf), LABEL_AS_OF).select("txn_id", "label_state", "label")
    return f.join(lab, "txn_id", "left")


def _split(spark, sf):
    """The written feature table, and its rows with final labels for training, calibration and test, by time."""
    every = materialize(feature_table(spark, sf), "features")
    final = labels.training(every, LABEL_AS_OF)
    at = F.unix_micros(F.col("ts").cast("timestamp"))
    first, second = final.agg(F.percentile_approx(at, [0.6, 0.8], 10_000).alias("cut")).first()["cut"] or (0, 0)
    return every, final.where(at <= first), final.where((at > first) & (at <= second)), final.where(at > second)


@register("b50_fraud_model_scores")
def b50_fraud_model_scores(spark, sf):
    """Logistic baseline and boosted trees trained on final labels; both scores for every transaction."""
    every, tr, _, _ = _split(spark, sf)
    lr = model.train(tr, FEATURES, "logistic")
    gbt = model.train(tr, FEATURES, "gbt")
    a = model.score(lr, every, FEATURES).select("txn_id", F.col("p_raw").alias("p_logistic"))
    b = model.score(gbt, every, FEATURES).select("txn_id", F.col("p_raw").alias("p_gbt"))
    return a.join(b, "txn_id")


@register("b51_calibration")
def b51_calibration(spark, sf):
    """Isotonic calibration of the logistic score on later rows; reliability on rows later still."""
    _, tr, cal, test = _split(spark, sf)
    lr = model.train(tr, FEATURES, "logistic")
    curve = model.calibrate(model.score(lr, cal, FEATURES))
    calibrated = model.calibrated(curve, model.score(lr, test, FEATURES))
    return evaluate.reliability(calibrated.withColumn("y", F.col("label") == 1), "p_fraud", "y")


@register("b62_feature_importance")
def b62_feature_importance(spark, sf):
    gbt = model.train(_split(spark, sf)[1], FEATURES, "gbt")
    return model.importance(spark, gbt, FEATURES)


@register("b46_shuffle_control")
def b46_shuffle_control(spark, sf):
    """PR-AUC on later rows of a model of real labels vs one of labels replaced by a base-rate hash draw."""
    _, tr, _, test = _split(spark, sf)
    shuffled = labels.shuffled(tr, "txn_id")

    def auc(df):
        scored = model.score(model.train(df, FEATURES, "logistic"), test, FEATURES).withColumn("y", F.col("label") == 1)
        return evaluate.pr_auc(evaluate.pr_curve(scored, "p_raw", "y")).scalar()

    return test.agg(F.avg("label").alias("base_rate")).select(
        "base_rate", auc(tr).alias("pr_auc_real"), auc(shuffled).alias("pr_auc_shuffled"))
