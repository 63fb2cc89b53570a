"""Running values over cut keys against plain loops: hot keys, bursts, equal times, rows without key or time."""

import random
from functools import partial

import pytest
from pyspark.sql import functions as F

from marketlake.operators import evaluate, windows


def _rows(seed):
    rng = random.Random(seed)
    out = []
    for i in range(400):
        key = rng.choice(["hot"] * 5 + ["a", "b", None, "c"])
        t = rng.choice([None] + [rng.randrange(1000)] * 9 + [500] * 5)  # a burst at 500
        out.append((i, key, t, rng.choice([None, rng.randrange(-5, 50)]), rng.choice(["x", "y", "z"])))
    return out


@pytest.mark.parametrize("rows", [3, 40, 1000])
@pytest.mark.parametrize("through", [False, True])
def test_prior_as_by_loops(spark, rows, through):
    data = _rows(rows)
    df = spark.createDataFrame(data, "id int, k string, t long, v long, item string").repartition(5)
    out = windows.prior(df, ["k"], "t", {"n": F.lit(1).cast("long"), "s": F.col("v")}, {"l": F.col("v")}, rows=rows, through=through)
    for r in out.collect():
        if r["k"] is None or r["t"] is None:
            assert (r["n"], r["s"], r["l"]) == (None, None, None)
            continue
        own = [(t, v) for _, k, t, v, _ in data if k == r["k"] and t is not None and (t < r["t"] or through and t == r["t"])]
        latest = [x for x in own if x[1] is not None]
        assert (r["n"], r["s"]) == (len(own), sum(v for _, v in own if v is not None))
        assert r["l"] == (max(latest)[1] if latest else None)
    assert out.count() == len(data)


def test_a_cut_key_spans_several_ranges(spark):
    df = spark.createDataFrame(_rows(1), "id int, k string, t long, v long, item string").where("k is not null and t is not null")
    number, hot = windows.cut(df, ["k"], "t", 20)
    seen = df.select("k", "t", number.alias("b"), hot.alias("hot"))
    sizes = {(r["k"], r["b"]): r["count"] for r in seen.groupBy("k", "b").count().collect()}
    assert len([1 for k, _ in sizes if k == "hot"]) > 5
    assert seen.groupBy("k", "t").agg(F.count_distinct("b").alias("n")).where("n > 1").isEmpty()
    ordered = sorted((r["t"], r["b"]) for r in seen.where("k = 'hot'").collect())
    assert [b for _, b in ordered] == sorted(b for _, b in ordered)
    assert windows.cut(df, ["k"], "t", 10_000) is None


def test_many_cut_points(spark):
    """More points than one step of the search holds."""
    df = spark.range(5000).select(F.lit(1).alias("k"), (F.col("id") * 7919 % 5000).alias("t"), F.lit(1).cast("long").alias("v"))
    out = windows.prior(df, ["k"], "t", {"n": F.col("v")}, rows=30)
    assert out.where("n != t").isEmpty() and out.count() == 5000
    assert df.select(windows.cut(df, ["k"], "t", 30)[0].alias("b")).distinct().count() > 100


def test_sliding_counts_over_cut_keys(spark, monkeypatch):
    data = [(i, k, t, None if v is None else float(v), x) for i, k, t, v, x in _rows(9) if t is not None]
    df = (spark.createDataFrame(data, "id int, k string, sec long, amount double, item string")
          .withColumn("ts", F.timestamp_seconds("sec").cast("timestamp_ntz")))
    monkeypatch.setattr(windows, "prior", partial(windows.prior, rows=11))
    out = windows.sliding(df, ["k"], "ts", [50], "amount", {50: ("n", "s")}).collect()
    for r in out:
        own = [v for _, k, t, v, _ in data if k == r["k"] and r["sec"] - 50 <= t < r["sec"]]
        assert (r["n"], r["s"]) == ((len(own), sum(v or 0 for v in own)) if r["k"] is not None else (None, None))
    out = windows.distinct_sliding(df, ["k"], "item", "ts", 50, "d").collect()
    for r in out:
        own = {x for _, k, t, _, x in data if k == r["k"] and r["sec"] - 50 <= t < r["sec"]}
        assert r["d"] == (len(own) if r["k"] is not None else None)
    assert len(out) == len(data)


def test_curve_of_many_scores_over_ranges(spark):
    rng = random.Random(2)
    data = [(rng.choice([rng.random(), 0.5, 0.25]), rng.random() < 0.3) for _ in range(300)]
    df = spark.createDataFrame(data, "p_fraud double, is_fraud boolean")
    for r in evaluate.pr_curve(df, rows=20).collect():
        above = [y for p, y in data if p >= r["threshold"]]
        assert (r["tp"], r["fp"]) == (sum(above), len(above) - sum(above))
        assert r["recall"] == pytest.approx(sum(above) / sum(y for _, y in data))
