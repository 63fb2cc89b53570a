"""Column-expression builders. All return ``Column`` built from Spark built-ins (JVM side,
whole-stage codegen); nothing here runs Python per row."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def clip01(c: str | Column) -> Column:
    """The value held between 0 and 1; NULL counts as 1.0 (kept on purpose: the published scores read it so)."""
    c = F.coalesce(col(c), F.lit(1.0))
    return F.when(c < 0, 0.0).when(c > 1, 1.0).otherwise(c)


def shrunk(top: str | Column, of: str | Column, prior: str | Column, weight: float) -> Column:
    """A rate as the weighted mean of what was observed (``top / of``, of weight ``of``) and a prior (of weight
    ``weight``). NULL counts weigh nothing."""
    seen = F.coalesce(col(of), F.lit(0))
    total = seen + F.lit(weight)
    return F.coalesce(col(top), F.lit(0)) / total + col(prior) * (F.lit(weight) / total)


def flag(cond: Column) -> Column:
    """Boolean -> 0/1 integer, NULL stays NULL (three-valued)."""
    return cond.cast("int")


def ratio(a: str | Column, b: str | Column) -> Column:
    """``a / b`` that yields NULL for a zero divisor instead of raising under ANSI mode."""
    return F.try_divide(col(a), col(b))


def exact_seconds(later: str | Column, earlier: str | Column) -> Column:
    """``later - earlier`` in seconds as ``decimal(30,6)``, from the interval difference.

    Subtracting two ``timestamp_ntz`` values is wall-clock arithmetic, free of the session time
    zone; ``timestamp_diff`` on ``timestamp_ntz`` is not (it goes through the zone, so a wall time in
    a DST gap shifts the result by an hour)."""
    return (col(later) - col(earlier)).cast("interval second").cast("decimal(30,6)")


def seconds_between(later: str | Column, earlier: str | Column) -> Column:
    """Whole seconds from ``earlier`` to ``later``, truncated toward zero (NULL if either is NULL)."""
    return exact_seconds(later, earlier).cast("bigint")


def epoch_seconds(ts: str | Column) -> Column:
    """Whole seconds since 1970-01-01 00:00 (wall clock for ``timestamp_ntz``)."""
    return F.floor(exact_seconds(ts, F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")))


def days_between_frac(later: str | Column, earlier: str | Column) -> Column:
    """Fractional days between two timestamps from whole epoch seconds, like casting both to long."""
    return (epoch_seconds(later) - epoch_seconds(earlier)).cast("double") / F.lit(86400.0)


def literal_map(mapping: Mapping) -> Column:
    """A ``map<k, v>`` literal for lookups (constant-folded by Catalyst)."""
    return F.create_map(*[x for k, v in mapping.items() for x in (F.lit(k), F.lit(v))])


def minor_to_major(amount_minor: str | Column, currency: str | Column, exponents: Mapping[str, int],
                   precision: int = 20, scale: int = 4) -> Column:
    """Integer minor units -> decimal major units by the currency's exponent (never a naive /100).

    Unknown currency -> NULL (the caller rejects it)."""
    exp = literal_map(exponents)[col(currency)]
    return (col(amount_minor).cast(f"decimal({precision},0)") / F.pow(F.lit(10), exp).cast("decimal(20,0)")) \
        .cast(f"decimal({precision},{scale})")


def null_safe_isin(c: str | Column, values: Iterable) -> Column:
    """Membership that is never NULL: a NULL value is 'not in' (so good + rejected = input)."""
    return F.coalesce(col(c).isin(list(values)), F.lit(False))


def haversine_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Great-circle distance in km from degrees (Earth radius 6371 km)."""
    r1, r2 = F.radians(lat1), F.radians(lat2)
    dlat, dlon = F.radians(lat2 - lat1), F.radians(lon2 - lon1)
    a = F.pow(F.sin(dlat / 2), 2) + F.cos(r1) * F.cos(r2) * F.pow(F.sin(dlon / 2), 2)
    return F.lit(2 * 6371.0) * F.asin(F.sqrt(a))


def hash_bucket_sha(key: str | Column, seed: int = 0, buckets: int = 10_000) -> Column:
    """Bucket in ``[0, buckets)`` from the first 32 bits of ``sha256(f"{seed}:{key}")``: a pure
    function of seed and key (stable under any partitioning, retry or rerun) that SQL engines
    with a sha256 function can reproduce exactly."""
    k = col(key).cast("string")
    return F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), k), 256), 1, 8), 16, 10).cast("bigint") % buckets
