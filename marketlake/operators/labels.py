"""Maturing dispute labels as of a scoring time T, and the leakage checks.

State as of T for a transaction (only transactions with ``ts < T`` are labelled):

* ``final``       the dispute was created AND resolved (won / lost) before T; or no dispute was
                  created before T and the transaction is older than both windows
                  (dispute window + resolution window) - a final negative (fixed here);
* ``provisional`` a dispute was created before T but is not resolved before T;
* ``unknown``     no dispute before T and still inside the windows.

The label is 1 when the final dispute was lost and its reason is fraud, else 0.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

DISPUTE_WINDOW_DAYS = 45
RESOLUTION_WINDOW_DAYS = 75

# Dispute reason -> class (fraudulent is fraud; the rest is mostly friendly fraud).
REASON_CLASS = {
    "fraudulent": "fraud",
    "product_not_received": "friendly",
    "subscription_canceled": "friendly",
    "credit_not_processed": "friendly",
}

TRUTH_COLUMNS = ["is_fraud", "scenario", "fraud_scenario"]


def reason_class(reason: str | Column) -> Column:
    r = F.col(reason) if isinstance(reason, str) else reason
    m = F.create_map(*[x for k, v in REASON_CLASS.items() for x in (F.lit(k), F.lit(v))])
    return F.coalesce(m[r], F.lit("other"))


def state(txns: DataFrame, disputes: DataFrame, as_of: str, dispute_days: int = DISPUTE_WINDOW_DAYS,
          resolution_days: int = RESOLUTION_WINDOW_DAYS) -> DataFrame:
    """``(txn_id, ts, label_state, label, reason_class)`` as of ``as_of``; disputes are visible only when
    created before T, outcomes only when resolved before T. One dispute per transaction is assumed
    (the latest created before T is used otherwise; of several at one time that of the greatest id)."""
    t = F.lit(as_of).cast("timestamp_ntz")
    d = (disputes.where(F.col("created") < t)
                 .groupBy("txn_id")
                 .agg(F.max(F.struct("created", "dispute_id", "resolved_at", "final_status", "reason")).alias("d"))
                 .select("txn_id", "d.*"))
    resolved = F.col("resolved_at").isNotNull() & (F.col("resolved_at") < t) & F.col("final_status").isin("won", "lost")
    matured = F.col("ts") < t - F.make_dt_interval(days=F.lit(dispute_days + resolution_days))
    st = (F.when(F.col("created").isNotNull() & resolved, "final")
           .when(F.col("created").isNotNull(), "provisional")
           .when(matured, "final").otherwise("unknown"))
    rc = reason_class("reason")
    label = (F.when(F.col("created").isNull() & matured, F.lit(0))
              .when(resolved, ((F.col("final_status") == "lost") & (rc == "fraud")).cast("int")))
    return (txns.where(F.col("ts") < t).select("txn_id", "ts").join(d, "txn_id", "left")
                .select("txn_id", "ts", st.alias("label_state"), label.alias("label"),
                        F.when(F.col("created").isNotNull(), rc).alias("reason_class")))


def training(labelled: DataFrame, as_of: str, dispute_days: int = DISPUTE_WINDOW_DAYS,
             resolution_days: int = RESOLUTION_WINDOW_DAYS) -> DataFrame:
    """Training rows: final labels on transactions past both windows."""
    t = F.lit(as_of).cast("timestamp_ntz")
    return labelled.where((F.col("label_state") == "final") &
                          (F.col("ts") < t - F.make_dt_interval(days=F.lit(dispute_days + resolution_days))))


def diff_count(a: DataFrame, b: DataFrame) -> int:
    """Rows in ``a`` not in ``b`` plus rows in ``b`` not in ``a`` (multiset difference, two aggregates)."""
    return a.exceptAll(b).count() + b.exceptAll(a).count()


def check_asof(build, source: DataFrame, as_of: str, ts_col: str = "ts") -> int:
    """As-of reconstruction: features built from the full source, restricted to rows before T, must
    equal features built from a snapshot holding only rows before T. Returns the differing row count."""
    t = F.lit(as_of).cast("timestamp_ntz")
    full = build(source).where(F.col(ts_col) < t)
    snap = build(source.where(F.col(ts_col) < t))
    return diff_count(full, snap)


def check_future(build, source: DataFrame, future: DataFrame, as_of: str, ts_col: str = "ts") -> int:
    """Future deletion: removing future rows (e.g. disputes created at or after T) from ``future`` must
    not change any feature of rows before T. ``build(source, future)``."""
    t = F.lit(as_of).cast("timestamp_ntz")
    a = build(source, future).where(F.col(ts_col) < t)
    b = build(source, future.where(F.col("created") < t)).where(F.col(ts_col) < t)
    return diff_count(a, b)


def check_maturity(train: DataFrame) -> int:
    """Training rows whose label is not final (must be 0)."""
    return train.where((F.col("label_state") != "final") | F.col("label").isNull()).count()


def check_columns(df: DataFrame, banned: Iterable[str] = TRUTH_COLUMNS) -> list[str]:
    """Ground-truth columns present in a feature / training frame (must be empty)."""
    return [c for c in df.columns if c in set(banned)]


def shuffled(df: DataFrame, key: str, label: str = "label", base_rate: float | None = None) -> DataFrame:
    """Shuffle control: replace the label with a hash draw of the key that keeps the base rate and is
    independent of every feature (a model trained on it must fall to base-rate PR-AUC)."""
    rate = base_rate if base_rate is not None else df.agg(F.avg(label)).scalar()
    u = (F.pmod(F.xxhash64(F.col(key), F.lit("shuffle")), F.lit(1_000_000)) / F.lit(1_000_000.0))
    return df.withColumn(label, (u < rate).cast("int"))
