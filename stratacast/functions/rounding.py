"""Decimal rounding of doubles, by scaling, with an explicit rule for ties.

Spark's own two-argument round works on the shortest decimal text of the
double, so 1.005 becomes 1.01; scaling first sees 100.49999999999999 and
gives 1.0, as SQL engines and numpy do.
"""

from pyspark.sql import Column
from pyspark.sql import functions as F


def round_half_away(value: Column, digits: int) -> Column:
    """Ties move away from zero (SQL round)."""
    scale = 10.0**digits
    return F.round(value * scale, 0) / scale


def round_half_even(value: Column, digits: int) -> Column:
    """Ties move to the even neighbour (numpy and pandas round)."""
    scale = 10.0**digits
    return F.rint(value * scale) / scale
