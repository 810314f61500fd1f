"""Parsing of times and ages.

``try_*`` parsers are used throughout: a bad text gives NULL, also under ANSI mode.
"""

from __future__ import annotations

import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

from cardlens.schema import DATE_FORMAT, TIME_FORMAT

DAYS_PER_YEAR = 365.25  # fixed value


def parse_time(text: Column) -> Column:
    return F.try_to_timestamp(text, F.lit(TIME_FORMAT))


def parse_date(text: Column) -> Column:
    """Birth date as a timestamp at midnight."""
    return F.try_to_timestamp(text, F.lit(DATE_FORMAT))


def as_of_date(as_of: datetime.date | str | None) -> Column:
    """A fixed reference date, or today's when none is given."""
    return F.current_date() if as_of is None else F.lit(str(as_of)).cast("date")


def age_years(born: Column, as_of: datetime.date | str | None = None) -> Column:
    """Difference of calendar years; month and day do not count."""
    return (F.year(as_of_date(as_of)) - F.year(born)).cast("int")


def age_exact(born: Column, as_of: datetime.date | str | None = None) -> Column:
    """Days lived over 365.25."""
    return F.datediff(as_of_date(as_of), born.try_cast("date")) / F.lit(DAYS_PER_YEAR)


def trans_hour(time: Column) -> Column:
    return F.hour(time).cast("double")


def trans_day(time: Column) -> Column:
    return F.date_format(time, DATE_FORMAT)


def clock_time(time_text: Column) -> Column:
    """Clock part of ``yyyy-MM-dd HH:mm:ss``; ``Now`` when there is none."""
    part = F.substring_index(time_text, " ", -1)
    return F.when(part != time_text, part).otherwise(F.lit("Now"))
