"""Keep-one-row-per-key operators and reject splitting.

Keep-latest / keep-first are written as a hash aggregate of ``max``/``min`` over a struct whose
leading fields are the ordering columns and whose remaining fields are every other column. That
gives (a) a total order, so ties are broken deterministically on the full row (no "any row"
results), and (b) partial aggregation before the shuffle: each map task reduces its rows to one
per key, so a key that holds a third of the table costs one row per partition in the exchange
instead of a third of the data in one sort task.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _pick(df: DataFrame, keys: Sequence[str], order: Sequence[str], newest: bool) -> DataFrame:
    keys, order = list(keys), list(order)
    rest = [c for c in df.columns if c not in keys and c not in order]
    packed = F.struct(*[F.col(c) for c in order + rest])
    agg = (F.max if newest else F.min)(packed).alias("_row")
    out = df.groupBy(*keys).agg(agg)
    return out.select(*keys, *[F.col(f"_row.{c}").alias(c) for c in order + rest]).select(*df.columns)


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per key: the greatest ``order`` tuple (NULLs lose, as with ``desc nulls last``);
    remaining ties broken on the rest of the row."""
    return _pick(df, keys, order, newest=True)


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per key: the smallest ``order`` tuple (NULLs first, as with ``asc``)."""
    return _pick(df, keys, order, newest=False)


def distinct_on(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Deterministic ``dropDuplicates(keys)``: the kept row is the smallest full row per key."""
    return _pick(df, keys, [], newest=False)


def split_rejects(df: DataFrame, rules: Iterable[tuple[str, Column]],
                  reason_col: str = "_reject_reason") -> tuple[DataFrame, DataFrame]:
    """Split rows by reject rules ``(reason, bad_condition)``.

    A row is rejected with the first matching reason; a rule whose condition is NULL counts as
    *not* matched, so good + rejected = input always holds (no row vanishes in three-valued logic).
    Both outputs come from one lineage; Catalyst evaluates the rules per row with no extra shuffle.
    """
    reason = F.lit(None).cast("string")
    for name, cond in reversed(list(rules)):
        reason = F.when(F.coalesce(cond, F.lit(False)), F.lit(name)).otherwise(reason)
    tagged = df.withColumn(reason_col, reason)
    good = tagged.where(F.col(reason_col).isNull()).drop(reason_col)
    rejected = tagged.where(F.col(reason_col).isNotNull())
    return good, rejected
