"""Point-in-time window building blocks that survive hot keys and bursts.

A plain ``Window.partitionBy(key)`` sends every row of a key to one task; if one customer, agent or
merchant holds a third of the table, that task sorts a third of the table. ``cut`` finds such keys and
cuts each into ranges of time of about equal size, so a hot key, or a hot hour of it, spans several
tasks. The cut points are literals (as many as CUTS together), so a row's range is a pure function of
its key and time: nothing is written, and a retried task finds the same range. Running values come from
a window over ``(key, range)``; what a hot key had in its earlier ranges (the carry) is one partial
aggregate row per range, CUTS rows in all at most, which is why it may be broadcast.

Sliding windows are running values too: a row that leaves a window of width ``w`` is an event at
``t + w`` that takes its contribution back (``sliding``). The work is linear in the rows, however many of
them fall into one window.

"Strictly earlier" means time ``< t``: rows at the same microsecond are never visible to each
other, which is the point-in-time rule for features; equal ``(key, time)`` always share a range. Rows
whose key or time is NULL have no history: their results are NULL.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marketlake.functions.exprs import exact_seconds
#: A key of more rows than this is cut into ranges; no table is cut into more than CUTS ranges by and large.
ROWS, CUTS = 500_000, 1024
_STEP = 32


def _epoch_ntz() -> Column:
    return F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")


def _is_ntz(df: DataFrame, ts: str) -> bool:
    return isinstance(df.schema[ts].dataType, T.TimestampNTZType)


def micros(df: DataFrame, ts: str) -> Column:
    """Microseconds since the epoch, independent of the session time zone (wall-clock for
    ``timestamp_ntz``, instant for ``timestamp``) - so no DST fold can reorder rows."""
    if _is_ntz(df, ts):
        return (exact_seconds(F.col(ts), _epoch_ntz()) * 1_000_000).cast("bigint")
    return F.unix_micros(F.col(ts))


def from_micros(df: DataFrame, ts: str, us: Column) -> Column:
    """Inverse of ``micros`` with the input column's type."""
    if _is_ntz(df, ts):
        return _epoch_ntz() + F.make_dt_interval(secs=(us.cast("decimal(30,0)") / 1_000_000).cast("decimal(18,6)"))
    return F.timestamp_micros(us)


def cut(df: DataFrame, keys: Sequence[str], t: str, rows: int = ROWS) -> tuple[Column, Column] | None:
    """(number of a row's range within its key, whether the key is cut), or None if no key has more than ``rows``
    rows. Ranges follow ``t``; rows of equal key and ``t`` share one. Counts of keys come from one aggregate, quantiles
    only from the keys to be cut; no more than CUTS keys and cut points a key come to the driver."""
    spread = F.xxhash64(*keys) if keys else F.lit(0).cast("long")
    slim = df.select(spread.alias("h"), F.col(t).alias("t"))
    per = slim.groupBy("h").agg(F.count("*").alias("n"))
    total, most = per.agg(F.sum("n"), F.max("n")).first()
    rows = max(rows, -(-(total or 0) // CUTS))
    if (most or 0) <= rows:
        return None
    hot = {r["h"]: r["n"] for r in per.where(F.col("n") > rows).collect()}
    grid = -(-most // rows)
    quantiles = (slim.where(F.col("h").isin(list(hot))).groupBy("h")
                 .agg(F.percentile_approx("t", [i / grid for i in range(1, grid)], 20 * grid).alias("q")).collect())
    coarse, fine = [], []
    for r in quantiles:
        parts = -(-hot[r["h"]] // rows)
        points = sorted({r["q"][round(i * grid / parts) - 1] for i in range(1, parts)})
        literal = lambda xs: F.array(*map(F.lit, xs)).cast(f"array<{df.schema[t].dataType.simpleString()}>")
        coarse += [F.lit(r["h"]), literal(points[_STEP - 1 :: _STEP])]
        fine += [F.lit(r["h"]), literal(points)]
    below = lambda points: F.size(F.filter(points, lambda p: p <= F.col(t)))
    upper = _STEP * below(F.create_map(*coarse)[spread])
    number = upper + below(F.slice(F.create_map(*fine)[spread], upper + 1, F.lit(_STEP)))
    return F.coalesce(F.when(spread.isin(list(hot)), number), F.lit(0)), spread.isin(list(hot))


def prior(df: DataFrame, keys: Sequence[str], t: str, sums: Mapping[str, Column] | None = None,
          last: Mapping[str, Column] | None = None, rows: int = ROWS, through: bool = False) -> DataFrame:
    """Over the strictly earlier rows (by the long column ``t``) of the same ``keys``: for each of ``sums``
    the sum of its column, and for each of ``last`` its value in the latest row in which it is not NULL
    (several: the greatest; orderable types). ``through``: rows of equal ``t`` count as well (any orderable ``t``)."""
    keys, sums, last = list(keys), dict(sums or {}), dict(last or {})
    whole = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in [*keys, t]])
    values = {f"_v_{n}": c for n, c in sums.items()} | {
        f"_l_{n}": F.when(c.isNotNull(), F.struct(F.col(t).alias("t"), c.alias("v"))) for n, c in last.items()}
    found = cut(df.where(whole), keys, t, rows)
    hashable = [c for c, kind in df.dtypes if "map<" not in kind and "variant" not in kind]
    # rows without a key or a time have no history; they are dealt out by their own hash
    apart = -1 - F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in hashable]), F.lit(1 << 20)).cast("int")
    d = df.withColumns(values | {"_b": F.when(whole, found[0] if found else F.lit(0)).otherwise(apart)})
    within = Window.partitionBy(*keys, "_b").orderBy(t).rangeBetween(Window.unboundedPreceding, 0 if through else -1)
    out = d.select("*", *[F.sum(f"_v_{n}").over(within).alias(f"_wv_{n}") for n in sums],
                   *[F.max(f"_l_{n}").over(within).alias(f"_wl_{n}") for n in last])
    if found:
        before = Window.partitionBy(*[f"_k{i}" for i in range(len(keys))]).orderBy("_cb").rowsBetween(Window.unboundedPreceding, -1)
        carry = (d.where(whole & found[1]).groupBy(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], F.col("_b").alias("_cb"))
                 .agg(F.count("*").alias("_rows"), *[F.sum(f"_v_{n}").alias(f"_cv_{n}") for n in sums], *[F.max(f"_l_{n}").alias(f"_cl_{n}") for n in last])
                 .select(*[f"_k{i}" for i in range(len(keys))], "_cb", *[F.sum(f"_cv_{n}").over(before).alias(f"_cv_{n}") for n in sums],
                         *[F.max(f"_cl_{n}").over(before).alias(f"_cl_{n}") for n in last]))
        on = reduce(lambda a, b: a & b, [F.col(k) == F.col(f"_k{i}") for i, k in enumerate(keys)], F.col("_b") == F.col("_cb"))
        out = out.join(F.broadcast(carry), on, "left")  # a row per range of a cut key
    carried = lambda n: [F.col(n)] if found else []
    add = lambda n: F.coalesce(*([F.col(f"_cv_{n}") + F.col(f"_wv_{n}"), F.col(f"_cv_{n}")] if found else []), F.col(f"_wv_{n}"))
    return out.select(*df.columns, *[F.when(whole, F.coalesce(add(n), F.col(f"_v_{n}") * 0, F.lit(0))).alias(n) for n in sums],
                      *[F.when(whole, F.coalesce(F.col(f"_wl_{n}"), *carried(f"_cl_{n}"))["v"]).alias(n) for n in last])


def prior_running(df: DataFrame, keys: Sequence[str], ts: str, value: str | None = None, prefix: str = "prior") -> DataFrame:
    """Add ``{prefix}_n`` (count) and, with ``value``, ``{prefix}_sum`` over all strictly-earlier
    rows of the same ``keys``. Sums are exact to 6 decimals, so they don't depend on the cut."""
    sums = {f"{prefix}_n": F.lit(1).cast("long")}
    if value:
        sums[f"{prefix}_sum"] = F.col(value).cast("decimal(38,6)")
    out = prior(df.withColumn("_t", micros(df, ts)), keys, "_t", sums).drop("_t")
    return out.withColumn(f"{prefix}_sum", F.col(f"{prefix}_sum").cast("double")) if value else out


def prior_last(df: DataFrame, keys: Sequence[str], ts: str, cols: Sequence[str], prefix: str = "prev",
               source: Column | None = None, counted: str | None = None) -> DataFrame:
    """For every row, the latest strictly-earlier row of the same ``keys``: ``{prefix}_{col}`` for
    each of ``cols`` plus ``{prefix}_ts``. With ``source`` (a boolean column) only rows where it is
    true are candidates (as-of lookups from a unioned right side). ``counted``: also add the number of
    strictly-earlier rows under this name, from the same pass."""
    packed = F.struct(F.col("_t").alias("t"), *[F.col(c).alias(c) for c in cols])
    d = df.withColumn("_t", micros(df, ts))
    sums = {counted: F.lit(1).cast("long")} if counted else {}
    out = prior(d, keys, "_t", sums, {"_last": F.when(source, packed) if source is not None else packed})
    return (out.select("*", *[F.col(f"_last.{c}").alias(f"{prefix}_{c}") for c in cols],
                       from_micros(df, ts, F.col("_last.t")).alias(f"{prefix}_ts"))
               .drop("_t", "_last"))


def sliding(df: DataFrame, keys: Sequence[str], ts: str, widths_s: Sequence[int], value: str,
            names: Mapping[int, tuple[str, str]]) -> DataFrame:
    """For each width ``w``: the count and the sum of ``value`` of the rows of the same ``keys`` with time in
    ``[t - w, t)``, under ``names[w]``. One pass for all widths; sums are exact to 6 decimals."""
    zero, amount = F.lit(0).cast("decimal(38,6)"), F.coalesce(F.col(value), F.lit(0)).cast("decimal(38,6)")
    entry = lambda own, at, sign: F.struct(
        F.lit(own).alias("own"), at.alias("_t"),
        *[x for w in widths_s for x in (F.lit(sign.get(w, 0)).cast("long").alias(f"_n{w}"),
                                        (amount * sign[w] if sign.get(w) else zero).cast("decimal(38,6)").alias(f"_a{w}"))])
    at = micros(df, ts)
    events = [entry(True, at, {w: 1 for w in widths_s})] + [entry(False, at + w * 1_000_000, {w: -1}) for w in widths_s]
    flat = df.select(F.struct(*df.columns).alias("_row"), *[F.col(k).alias(f"_key{i}") for i, k in enumerate(keys)],
                     F.inline(F.array(*events)))
    flat = flat.withColumn("_row", F.when(F.col("own"), F.col("_row")))
    sums = {x: F.col(x) for w in widths_s for x in (f"_n{w}", f"_a{w}")}
    out = prior(flat.select("_row", "own", "_t", *[f"_key{i}" for i in range(len(keys))], *[F.col(x).alias(f"_d{x}") for x in sums]),
                [f"_key{i}" for i in range(len(keys))], "_t", {x: F.col(f"_d{x}") for x in sums})
    return out.where("own").select("_row.*", *[c for w in widths_s for c in (
        F.col(f"_n{w}").alias(names[w][0]), F.col(f"_a{w}").cast("double").alias(names[w][1]))])


def distinct_sliding(df: DataFrame, keys: Sequence[str], item: str, ts: str, width_s: int, name: str) -> DataFrame:
    """The number of distinct ``item`` values of the same ``keys`` with time in ``[t - width_s, t)``.

    A value counts from its occurrence until its next one or until it leaves the window, whichever is
    first, so at any time at most one occurrence of it counts."""
    keyed = [F.col(k).alias(f"_key{i}") for i, k in enumerate(keys)]
    names = [f"_key{i}" for i in range(len(keys))]
    seen = df.select(*keyed, F.col(item).alias("_item"), micros(df, ts).alias("_t")).where("_item is not null").distinct()
    # the next occurrence is the latest one before, in reversed time
    seen = prior(seen.withColumn("_r", -F.col("_t")), [*names, "_item"], "_r", last={"_following": F.col("_t")})
    until = F.least("_following", F.col("_t") + width_s * 1_000_000)
    row = F.struct(*df.columns)
    turns = (seen.withColumn("_until", until)
             .select(F.lit(None).cast(df.select(row).schema[0].dataType).alias("_row"), *names,
                     F.inline(F.array(F.struct(F.col("_t").alias("_at"), F.lit(1).cast("long").alias("_d")),
                                      F.struct(F.col("_until").alias("_at"), F.lit(-1).cast("long").alias("_d"))))))
    asked = df.select(row.alias("_row"), *keyed, micros(df, ts).alias("_at"), F.lit(0).cast("long").alias("_d"))
    out = prior(asked.unionByName(turns), names, "_at", {"_n": F.col("_d")})
    return out.where("_row is not null").select("_row.*", F.col("_n").alias(name))
