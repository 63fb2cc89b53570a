"""Data-quality checks: declarative specs evaluated with ONE aggregate scan per table.

A spec per table: ``min_rows``, ``not_null`` columns, ``unique`` column set, ``between`` ranges.
All counters of one table are computed in a single ``agg`` (``count``, ``count_if``) and unpivoted into report rows
``(table, check, ok, detail)`` with ``inline`` - no job per check, nothing collected to the driver. Uniqueness is apart from
the counters (``duplicates``), so that no row is expanded for it.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marketlake.functions.exprs import seconds_between

REPORT_SCHEMA = "table string, check string, ok boolean, detail string"


class GateFailed(RuntimeError):
    """Raised by ``gate`` when any check of a report failed."""


def _num(v) -> str:
    return str(v)


def duplicates(df: DataFrame, keys: Sequence[str]) -> Column:
    """Rows beyond the first of each key (NULL is a value), as a scalar subquery.

    Only 64-bit hashes of the keys are counted first (partial counts in each task); a key is suspect if its hash occurs
    twice, by itself or by collision. The keys themselves are shuffled and counted for suspects alone: none on a unique
    table, but for a collision now and then."""
    mark = F.xxhash64(*[F.col(k) for k in keys])
    suspect = df.groupBy(mark.alias("_h")).agg(F.count("*").alias("_n")).where("_n > 1").select("_h")
    rows = df.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], mark.alias("_h")).join(suspect, "_h", "left_semi")
    counts = rows.groupBy(*[f"_k{i}" for i in range(len(keys))]).agg(F.count("*").alias("_n"))
    return counts.agg(F.coalesce(F.sum(F.col("_n") - 1), F.lit(0))).scalar()


def table_checks(name: str, df: DataFrame, spec: Mapping) -> DataFrame:
    """Evaluate one table's spec in a single aggregate; returns report rows."""
    min_rows = spec.get("min_rows", 1)
    aggs = [F.count(F.lit(1)).alias("n")]
    for c in spec.get("not_null", []):
        aggs.append(F.count_if(F.col(c).isNull()).alias(f"nn_{c}"))
    uniq = list(spec.get("unique", []))
    if uniq:
        aggs.append(duplicates(df, uniq).alias("duplicates"))
    for c, (lo, hi) in spec.get("between", {}).items():
        x = F.col(c)
        aggs.append(F.count_if(x.isNotNull() & ((x < F.lit(lo)) | (x > F.lit(hi)))).alias(f"bw_{c}"))
    a = df.agg(*aggs)

    def row(check: str, ok, detail):
        return F.struct(F.lit(name).alias("table"), F.lit(check).alias("check"), ok.alias("ok"),
                        detail.cast("string").alias("detail"))

    rows = [row("min_rows", F.col("n") >= min_rows, F.concat(F.col("n"), F.lit(f" >= {min_rows}")))]
    for c in spec.get("not_null", []):
        rows.append(row(f"not_null[{c}]", F.col(f"nn_{c}") == 0, F.concat(F.col(f"nn_{c}"), F.lit(" nulls"))))
    if uniq:
        rows.append(row(f"unique{uniq}", F.col("duplicates") == 0, F.concat("duplicates", F.lit(" duplicates"))))
    for c, (lo, hi) in spec.get("between", {}).items():
        rows.append(row(f"range[{c}]", F.col(f"bw_{c}") == 0,
                        F.concat(F.col(f"bw_{c}"), F.lit(f" outside [{_num(lo)},{_num(hi)}]"))))
    return a.select(F.inline(F.array(*rows)))


def run_suite(spark: SparkSession, tables: Mapping[str, DataFrame | None], specs: Mapping[str, Mapping]) -> DataFrame:
    """Report for every table in ``specs``; a missing table (``None``) yields a failed ``exists`` row."""
    parts = []
    for name, spec in specs.items():
        df = tables.get(name)
        if df is None:
            parts.append(spark.createDataFrame([(name, "exists", False, name)], REPORT_SCHEMA))
        else:
            parts.append(table_checks(name, df, spec))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def gate(report: DataFrame) -> DataFrame:
    """Stop the build when any check failed (one small aggregate over the report)."""
    failed = report.where(~F.col("ok")).select("table", "check", "detail").collect()  # as many rows as the specs have checks
    if failed:
        raise GateFailed("; ".join(f"{r['table']}.{r['check']}: {r['detail']}" for r in failed))
    return report


def as_json_document(report: DataFrame, layer: str, run_at: str) -> DataFrame:
    """One-row JSON document ``{layer, run_at, passed, results[]}`` built in Spark (report sink)."""
    return report.agg(
        F.to_json(F.struct(
            F.lit(layer).alias("layer"), F.lit(run_at).alias("run_at"),
            F.coalesce(F.bool_and("ok"), F.lit(True)).alias("passed"),
            F.array_sort(F.collect_list(F.struct("table", "check", "ok", "detail"))).alias("results"))).alias("value"))


# The checks of each layer, and their row floors.
BRONZE = {
    "olist/orders": dict(min_rows=90000, not_null=["order_id"]),
    "olist/order_items": dict(min_rows=100000, not_null=["order_id", "seller_id"]),
    "olist/sellers": dict(min_rows=3000, unique=["seller_id"]),
    "cfpb_complaints": dict(min_rows=1000, not_null=["complaint_id"]),
    "fx_rates": dict(min_rows=100, not_null=["date", "currency", "rate"]),
    "stripe_events_raw": dict(min_rows=10000, not_null=["event_id", "payload"]),
}
SILVER = {
    "olist_orders": dict(min_rows=90000, unique=["order_id"]),
    "olist_reviews": dict(min_rows=90000, between={"score": (1, 5)}),
    "cfpb_complaints": dict(min_rows=1000, unique=["complaint_id"], not_null=["company", "received_on"]),
    "fx_rates": dict(min_rows=100, unique=["date", "currency"], between={"rate": (0.0001, 100000)}),
    "stripe_events": dict(min_rows=10000, unique=["event_id"], not_null=["account_id", "amount"],
                          between={"amount": (0, 1e7)}),
    # added: item, product and seller tables had no checks
    "olist_order_items": dict(min_rows=1, not_null=["order_id", "seller_id"]),
    "olist_products": dict(min_rows=1, unique=["product_id"], not_null=["category"]),
    "olist_sellers": dict(min_rows=1, unique=["seller_id"]),
}
_SCORES = ["mdt_score", "delivery", "price", "contract", "latency", "dispute", "consistency", "comms", "resolution"]
GOLD = {
    # added: account_id uniqueness on merchants (it keeps only 16 characters of the seller id)
    "merchant_dimension_scores": dict(min_rows=2000, unique=["merchant_id"], not_null=["mdt_score"],
                                      between={k: (0, 1) for k in _SCORES}),
    "merchant_accounts": dict(min_rows=1, unique=["account_id"]),
    "merchant_payment_risk": dict(min_rows=100, unique=["account_id"],
                                  between={"dispute_rate": (0, 1), "mandate_violation_rate": (0, 1)}),
    "channel_risk": dict(min_rows=3),
    "external_dispute_benchmarks": dict(min_rows=3, between={"timely_response_rate": (0, 1)}),
}
SUITES = {"bronze": BRONZE, "silver": SILVER, "gold": GOLD}


# ---------------------------------------------------------------- Tier B monitors

#: Row rules of Silver events; ``minor_units`` says that no zero-decimal currency was divided by 100.
EVENT_RULES = {
    "transaction_id": "object_id is not null",
    "account_id": "account_id is not null",
    "amount_positive": "amount > 0",
    "minor_units": "amount * case currency when 'jpy' then 1 else 100 end = amount_minor",
    "created_not_after_ingest": "created <= ingested_at",
}


def expect(df: DataFrame, rules: Mapping[str, str]) -> tuple[DataFrame, DataFrame]:
    """Row expectations ``{name: sql_condition_that_must_hold}`` -> ``(good, rejected)``.

    Rejected rows carry ``_failed`` (array of every failed rule name). A rule that evaluates to
    NULL fails, so good + rejected = input."""
    failed = F.filter(F.array(*[F.when(~F.coalesce(F.expr(cond), F.lit(False)), F.lit(name))
                                for name, cond in rules.items()]), lambda x: x.isNotNull())
    tagged = df.withColumn("_failed", failed)
    return (tagged.where(F.size("_failed") == 0).drop("_failed"), tagged.where(F.size("_failed") > 0))


def schema_report(df: DataFrame, payload: str = "payload", version: str = "api_version") -> DataFrame:
    """Observed payload keys per version: ``(version, key, n_events, share)``.

    Keys come from ``json_object_keys`` on each row; ``explode`` + ``groupBy`` is a partial
    aggregate, so a version holding most events costs one row per key per partition."""
    keys = df.select(F.col(version).alias("version"), F.explode(F.json_object_keys(payload)).alias("key"))
    per_key = keys.groupBy("version", "key").agg(F.count("*").alias("n_events"))
    totals = df.groupBy(F.col(version).alias("version")).agg(F.count("*").alias("n_version"))
    return (per_key.join(totals, per_key.version.eqNullSafe(totals.version))
            .select(per_key.version, "key", "n_events", (F.col("n_events") / F.col("n_version")).alias("share")))


def schema_types(df: DataFrame, payload: str = "payload", version: str = "api_version") -> DataFrame:
    """Observed types per version and payload key: ``(version, key, type, n_events, drifted)``, from the payload read as
    VARIANT. ``drifted``: the key has more than one type over all versions. A payload that doesn't parse counts under the
    type ``INVALID`` without a key; nested objects and arrays are told as ``OBJECT`` and ``ARRAY``."""
    rows = df.select(F.col(version).alias("version"), F.try_parse_json(payload).alias("_v"))
    broken = (rows.where("_v is null").groupBy("version").agg(F.count("*").alias("n_events"))
              .select("version", F.lit(None).cast("string").alias("key"), F.lit("INVALID").alias("type"), "n_events"))
    keys = rows.where("_v is not null").lateralJoin(df.sparkSession.tvf.variant_explode(F.col("_v").outer()))
    kind = F.regexp_extract(F.schema_of_variant("value"), "^[A-Z]+", 0)
    per = keys.groupBy("version", "key", kind.alias("type")).agg(F.count("*").alias("n_events")).unionByName(broken)
    several = per.where("key is not null and type <> 'VOID'").groupBy("key").agg((F.count_distinct("type") > 1).alias("drifted"))
    return per.join(several, "key", "left").select("version", "key", "type", "n_events", F.coalesce("drifted", F.lit(False)).alias("drifted"))


def schema_versions(df: DataFrame, payload: str = "payload", version: str = "api_version") -> DataFrame:
    """One schema per version that holds all its payloads, nested fields included (``schema_of_variant_agg``; a field of
    several types is VARIANT), and the number of events."""
    return (df.groupBy(F.col(version).alias("version"))
            .agg(F.schema_of_variant_agg(F.try_parse_json(payload)).alias("schema"), F.count("*").alias("n_events")))


def freshness(df: DataFrame, cols: list[str], now_col) -> DataFrame:
    """Latest value of each time column and its lag in seconds behind ``now_col`` (one aggregate)."""
    aggs = []
    for c in cols:
        aggs.append(F.max(c).alias(f"max_{c}"))
    a = df.agg(*aggs)
    return a.select(*[F.col(f"max_{c}") for c in cols],
                    *[seconds_between(now_col, F.col(f"max_{c}")).alias(f"lag_s_{c}") for c in cols])


def shape(df: DataFrame, key: str, ts: str, channel: str, top_k: int = 10) -> tuple[DataFrame, DataFrame]:
    """Distribution shape: (1) long tail - share of rows held by the ``top_k`` keys and by the single
    largest key; (2) hour-of-day histogram per channel.

    The per-key counts are aggregated first (partial aggregation); the top-k is a ``TakeOrdered``
    (k rows per partition, merged) feeding a scalar subquery - no global window over the keys."""
    counts = df.groupBy(key).agg(F.count("*").alias("n"))
    top = counts.orderBy(F.desc("n"), F.col(key)).limit(top_k).agg(F.sum("n")).scalar()
    tail = counts.agg(
        F.sum("n").alias("rows"), F.count("*").alias("keys"),
        (top / F.sum("n")).alias("top_k_share"), (F.max("n") / F.sum("n")).alias("top1_share"))
    hours = df.groupBy(channel, F.hour(ts).alias("hour")).agg(F.count("*").alias("n"))
    return tail, hours
