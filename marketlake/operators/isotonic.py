"""Isotonic regression over any number of scores: distributed pool-adjacent-violators.

Pooling adjacent violators gives the slopes of the lower convex hull of the cumulative diagram (weights so far, labels so
far). A hull of a union is the hull of the parts' hulls: counts per distinct score are summed up over ranges of scores
(``windows.prior``), each range keeps the corners of its own hull, groups of FAN ranges are merged until one hull is left.
No scores are pooled beforehand. With whole-number weights a hull over n rows has at most about n^(2/3) corners, and in
practice a few hundred, so the last merge is small however long the table is.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketlake.operators.windows import ROWS, cut, prior

FAN = 32
_POINT = "x double, w double, s double"


def _exact(v: float):
    return int(v) if v == int(v) else v


def corners(points: list[tuple[float, float, float]]) -> list[tuple[float, float, float]]:
    """The corners of the lower hull of (x, w, s) in order of w (whole numbers are compared exactly)."""
    hull: list[tuple] = []
    for x, w, s in points:
        here = (x, _exact(w), _exact(s))
        while len(hull) > 1:
            (_, w0, s0), (_, w1, s1) = hull[-2:]
            if (s1 - s0) * (here[1] - w1) < (here[2] - s1) * (w1 - w0):
                break
            hull.pop()
        hull.append(here)
    return hull


def _hull(table: pa.Table) -> pa.Table:
    rows = sorted(zip(*(table.column(c).to_pylist() for c in ("w", "s", "x"))))
    # the first point of all (before any score) has w = 0 and belongs to the first range
    kept = corners([(x, w, s) for w, s, x in rows])
    return pa.table({"g": pa.array([table.column("g")[0].as_py()] * len(kept), pa.int64()), "x": [float(x) for x, _, _ in kept],
                     "w": [float(w) for _, w, _ in kept], "s": [float(s) for _, _, s in kept]})


def fit(df: DataFrame, score: str, label: str, weight: str | None = None, rows: int = ROWS) -> DataFrame:
    """The blocks of the non-decreasing fit: (upto, value, weight): scores above the block before and at most ``upto`` get
    ``value``. Rows without a score or label take no part; of equal scores the mean label counts."""
    w = F.lit(1.0) if weight is None else F.col(weight).cast("double")
    per = (df.where(F.col(score).isNotNull() & F.col(label).isNotNull()).groupBy(F.col(score).cast("double").alias("x"))
           .agg(F.sum(w).alias("own"), F.sum(w * F.col(label).cast("double")).alias("hit")).withColumn("_k", F.lit(0)))
    summed = prior(per, ["_k"], "x", {"w": F.col("own"), "s": F.col("hit")}, rows=rows, through=True)
    ranges = cut(per, ["_k"], "x", rows)
    number = ranges[0].cast("long") if ranges else F.lit(0).cast("long")
    points = summed.select(number.alias("g"), "x", "w", "s")
    start = per.limit(1).select(F.lit(0).cast("long").alias("g"), F.lit(float("-inf")).alias("x"), F.lit(0.0).alias("w"), F.lit(0.0).alias("s"))
    hulls = points.unionByName(start).groupBy("g").applyInArrow(_hull, f"g long, {_POINT}")
    left = int(per.count() // rows + 1) if ranges else 1
    while left > 1:
        left = -(-left // FAN)
        hulls = hulls.withColumn("g", F.floor(F.col("g") / FAN).cast("long")).groupBy("g").applyInArrow(_hull, f"g long, {_POINT}")
    return hulls.withColumn("g", F.lit(0).cast("long")).groupBy("g").applyInArrow(_blocks, "upto double, value double, weight double")


def _blocks(table: pa.Table) -> pa.Table:
    """The last hull as blocks."""
    hull = corners(sorted(zip(*(table.column(c).to_pylist() for c in ("x", "w", "s"))), key=lambda p: (p[1], p[2])))
    pairs = list(zip(hull, hull[1:]))
    return pa.table({"upto": [float(b[0]) for _, b in pairs], "value": [(b[2] - a[2]) / (b[1] - a[1]) for a, b in pairs],
                     "weight": [float(b[1] - a[1]) for a, b in pairs]})


def apply(df: DataFrame, blocks: DataFrame, score: str, name: str, rows: int = ROWS) -> DataFrame:
    """Add ``name``: the value of the first block that reaches the score; above all blocks the last one's. One pass over
    rows and blocks together in falling order of score, so nothing is broadcast."""
    row = F.struct(*df.columns)
    asked = df.select(row.alias("_row"), (-F.col(score).cast("double")).alias("_t"), F.lit(None).cast("double").alias("_v"))
    known = blocks.select(F.lit(None).cast(df.select(row).schema[0].dataType).alias("_row"), (-F.col("upto")).alias("_t"), F.col("value").alias("_v"))
    both = asked.unionByName(known).withColumn("_k", F.lit(0))
    met = prior(both, ["_k"], "_t", last={"_found": F.col("_v")}, rows=rows, through=True).where("_row is not null")
    top = blocks.agg(F.max("value")).scalar()
    return met.select("_row.*", F.when(F.col(f"_row.{score}").isNotNull(), F.coalesce("_found", top)).alias(name))
