"""Rounding that does not depend on the order in which partial sums arrive."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_GUARD_DIGITS = 4


def rounded(col: Column | str, digits: int) -> Column:
    """Round half up after removing summation noise far below the last digit.

    A mean of cents often lies exactly half-way between two results. Distributed sums reach such
    a value from above or below depending on task order; the inner rounding makes it one value.
    """
    return F.round(F.round(col, digits + _GUARD_DIGITS), digits)
