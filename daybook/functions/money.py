"""Exact arithmetic on stored amounts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from daybook.schema import VALUE


def times(amount: Column, unit: Column) -> Column:
    """amount decimal(19,4) x unit of up to decimal(23,4) as decimal(38,8) without loss, for products below 10**29.

    The product's own type would need 39 digits or more and lose places, so the unit's
    whole and fractional parts are multiplied apart: the first keeps its four places, the second has
    24 digits. A larger product is an error, not a rounded value."""
    whole = F.when(unit < 0, F.ceil(unit)).otherwise(F.floor(unit)).cast("decimal(19,0)")
    rest = (unit - whole).cast("decimal(4,4)")
    return ((amount * whole).cast("decimal(37,8)") + (amount * rest).cast("decimal(24,8)")).cast(VALUE)
