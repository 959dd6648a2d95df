"""Two-part change times: (year - 1900) * 1000 + day of year, and seconds of day."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Values outside this range have a year outside 1..9999.
_MIN_JULIAN, _MAX_JULIAN = -1_899_000, 8_099_999


def julian_to_date(julian: Column) -> Column:
    """Date of a whole-number Julian value, or null.

    Day 0 is the last day of the year before, and a day past the year's end rolls
    over into the next year.
    """
    safe = F.when(julian.between(_MIN_JULIAN, _MAX_JULIAN), julian)
    day = F.pmod(safe, F.lit(1000))
    year = ((safe - day) / 1000 + 1900).cast("int")
    found = F.date_add(F.make_date(year, F.lit(1), F.lit(1)), (day - 1).cast("int"))
    return F.when(F.year(found).between(1, 9999), found)


def date_to_julian(moment: Column) -> Column:
    """Julian value of a date or timestamp."""
    return ((F.year(moment) - 1900) * 1000 + F.dayofyear(moment)).cast("bigint")


def seconds_of_day(moment: Column) -> Column:
    """Whole seconds since midnight of a timestamp."""
    return (F.hour(moment) * 3600 + F.minute(moment) * 60 + F.second(moment)).cast("bigint")
