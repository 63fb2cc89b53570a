"""Property tests: dedupe is idempotent and order-free, splits are lossless, scores stay in range."""

import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from marketlake.functions.exprs import shrunk
from marketlake.operators import dedupe, quality

T0 = dt.datetime(2024, 1, 1)
rows = st.lists(st.tuples(st.integers(0, 4), st.integers(0, 3), st.sampled_from(["a", "b", None])),
                min_size=0, max_size=25)
SETTINGS = settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))


def _df(spark, data):
    return spark.createDataFrame([(k, T0 + dt.timedelta(minutes=m), v) for k, m, v in data],
                                 "k int, t timestamp_ntz, v string")


@SETTINGS
@given(rows)
def test_dedupe_idempotent_and_partition_free(spark, data):
    df = _df(spark, data)
    once = dedupe.latest_per_key(df, ["k"], ["t"])
    twice = dedupe.latest_per_key(once, ["k"], ["t"])
    shuffled = dedupe.latest_per_key(df.repartition(5), ["k"], ["t"])
    a = sorted(once.collect())
    assert a == sorted(twice.collect()) == sorted(shuffled.collect())
    assert len(a) == len({k for k, _, _ in data})


@SETTINGS
@given(rows)
def test_split_is_lossless(spark, data):
    df = _df(spark, data)
    good, bad = dedupe.split_rejects(df, [("no_v", F.col("v").isNull()), ("big_k", F.col("k") > 2)])
    assert good.count() + bad.count() == df.count()
    good2, bad2 = quality.expect(df, {"has_v": "v is not null", "small_k": "k <= 2"})
    assert good2.count() + bad2.count() == df.count() and good2.count() == good.count()


@SETTINGS
@given(st.integers(0, 50), st.integers(0, 50), st.floats(0, 1), st.sampled_from([5, 10]))
def test_smoothing_lies_between_rate_and_prior(spark, k, extra, p, m):
    n = k + extra
    v = spark.range(1).select(shrunk(F.lit(k), F.lit(n), F.lit(p), m).alias("s")).first().s
    lo, hi = (min(k / n, p), max(k / n, p)) if n else (p, p)
    assert lo - 1e-12 <= v <= hi + 1e-12


def test_scores_in_unit_interval(spark, sf):
    import __spark_entry__ as entry
    from marketlake.operators.gold import DIMENSIONS
    df = entry.queries()["a131_merchant_dimension_scores"](spark, sf)
    bad = df.where(" or ".join(f"{c} < 0 or {c} > 1" for c in DIMENSIONS + ["mdt_score"])).count()
    assert bad == 0
