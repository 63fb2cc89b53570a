"""Result presentation shared by registered queries: fixed rounding of doubles so two engines that
add in different orders still print the same digits, and dates as timestamps."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def round_half_away(c, digits: int):
    """``round(x, d)`` as ``sign(x) * floor(|x| * 10^d + 0.5) / 10^d`` in double arithmetic.

    Spark's ``round`` on doubles goes through the shortest decimal string of the value, so a
    quotient that prints as ``...225`` rounds up while the binary value is below the tie; scaling
    in binary first gives the same digits as engines that round with ``x * 10^d``."""
    m = float(10 ** digits)
    x = c.cast("double")
    return F.when(x >= 0, F.floor(x * m + 0.5)).otherwise(-F.floor(-x * m + 0.5)) / F.lit(m)


def present(df: DataFrame, money: Iterable[str] = (), digits: int = 6, money_digits: int = 2) -> DataFrame:
    """Round every double (and decimal) column: ``money`` columns to ``money_digits``, the rest to
    ``digits``; dates become ``timestamp_ntz``. Column order and names are unchanged."""
    money = set(money)
    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.DoubleType, T.FloatType, T.DecimalType)):
            c = round_half_away(c, money_digits if f.name in money else digits)
        elif isinstance(f.dataType, T.DateType):
            c = c.cast("timestamp_ntz")
        cols.append(c.alias(f.name))
    return df.select(*cols)
