"""Temperature units and calendar signals."""

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

CELSIUS = "C"
FAHRENHEIT = "F"
DAYS_PER_YEAR = 365.25


def display_temperature(celsius: Column, unit: str = CELSIUS) -> Column:
    if unit == CELSIUS:
        return celsius
    if unit == FAHRENHEIT:
        return celsius * 9 / 5 + 32
    raise ValueError(f"unknown temperature unit {unit!r}")


def unit_label(unit: str) -> str:
    return f"°{unit}"


def year_angle(day: Column) -> Column:
    """Position of a date within the year, in radians."""
    return F.lit(2 * math.pi) * F.dayofyear(day) / F.lit(DAYS_PER_YEAR)
