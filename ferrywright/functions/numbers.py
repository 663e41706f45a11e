"""Cutting numbers at a decimal place."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def cut(x: Column, n: int) -> Column:
    """Towards zero at ``n`` decimal places, or before the point for negative ``n``; decimals stay decimals and doubles doubles.

    A double counts by the digits that it is written with: times a power of ten it need not have them (0.29 * 100 is less
    than 29). Numbers beyond 20 digits before the point, infinities and NaN stay as they are.
    """
    exact = x.cast("string").try_cast("decimal(38,18)")
    # The types of both are taken together: with a double it is a double.
    return F.coalesce(F.when(exact >= 0, F.floor(exact, F.lit(n))).otherwise(F.ceil(exact, F.lit(n))), x)
