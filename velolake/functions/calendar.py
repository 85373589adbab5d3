"""Calendar attributes of a date or timestamp column."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Last hour of each band, and its name.
TIME_OF_DAY_BANDS = ((5, "late night"), (9, "morning rush"), (15, "daytime"), (19, "evening rush"))
TIME_OF_DAY_REST = "night"

# Names by number, from Sunday = 1 and January = 1.
DAY_NAMES = ("Sunday", "Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday")
MONTH_NAMES = ("January", "February", "March", "April", "May", "June",
               "July", "August", "September", "October", "November", "December")


def time_of_day(hour: Column) -> Column:
    bands = F
    for last_hour, name in TIME_OF_DAY_BANDS:
        bands = bands.when(hour <= last_hour, F.lit(name))
    return bands.otherwise(F.lit(TIME_OF_DAY_REST))


def is_weekend_day(day: Column) -> Column:
    """Saturday or Sunday; dayofweek counts from Sunday = 1."""
    return F.dayofweek(day).isin(1, 7)


def day_name(day: Column) -> Column:
    return F.element_at(F.lit(list(DAY_NAMES)), F.dayofweek(day))


def month_name(day: Column) -> Column:
    return F.element_at(F.lit(list(MONTH_NAMES)), F.month(day))
