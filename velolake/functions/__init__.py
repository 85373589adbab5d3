"""Column expressions shared by the operators; all of them run inside the JVM."""

from .calendar import day_name, is_weekend_day, month_name, time_of_day
from .geo import EARTH_RADIUS_METRES, great_circle_metres
from .numeric import from_hundredths, mean_from_hundredths, to_hundredths
from .text import category, trimmed

__all__ = [
    "EARTH_RADIUS_METRES",
    "category",
    "day_name",
    "from_hundredths",
    "great_circle_metres",
    "is_weekend_day",
    "mean_from_hundredths",
    "month_name",
    "time_of_day",
    "to_hundredths",
    "trimmed",
]
