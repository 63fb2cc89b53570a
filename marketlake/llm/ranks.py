"""Gapless numbers within groups, without one task per group.

A window over the group alone would send a whole group to one task. Here a group's rows are dealt into buckets by a
hash of their order key; each bucket is numbered on its own and starts where the buckets before it end. The table of
bucket sizes has (groups * buckets) rows at most.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def numbered(df: DataFrame, group: str, bucket_by: list[str], order: list[str], name: str, buckets: int = 256,
             counted: DataFrame | None = None) -> DataFrame:
    """Add ``name``: 0, 1, 2, ... within each value of ``group``, ordered by (bucket, ``order``).

    ``bucket_by`` decides the bucket, so rows with equal ``order`` are best in one bucket. ``counted``: the same rows
    with fewer columns, if those are cheaper to read for the bucket sizes. Rows that are equal in ``order`` get their
    numbers in any order."""
    bucket = F.pmod(F.xxhash64(*bucket_by), F.lit(buckets)).cast("int")
    sizes = (counted if counted is not None else df).groupBy(group, bucket.alias("_b")).agg(F.count("*").alias("_n"))
    before = F.sum("_n").over(Window.partitionBy(group).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1))
    starts = sizes.select(F.col(group).alias("_g"), F.col("_b").alias("_sb"), F.coalesce(before, F.lit(0)).alias("_s"))
    dealt = df.withColumn("_b", bucket)
    inner: Column = F.row_number().over(Window.partitionBy(group, "_b").orderBy(*order))
    out = dealt.withColumn("_i", inner)
    # null-safe: a null group or key is a group like any other
    return (out.join(starts, out[group].eqNullSafe(starts["_g"]) & (out["_b"] == starts["_sb"]))
            .withColumn(name, (F.col("_s") + F.col("_i") - 1).cast("long"))
            .drop("_b", "_sb", "_g", "_s", "_i"))
