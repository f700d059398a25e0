"""Calendar rules of the ranking reports. Weeks run from Wednesday to Tuesday."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# Period names in the reports' output folders.
WEEK_NAMES = ("first", "second", "third", "fourth", "fifth", "sixth")
SEASON_NAMES = ("first_season", "second_season", "third_season", "fourth_season")
MODES = ("day", "week", "month", "season")

_WEDNESDAY = 4  # Spark's dayofweek: Sunday = 1


def week_start(day: Column) -> Column:
    """Wednesday on or before ``day``; for a month's first week it may lie in the month before."""
    return F.date_sub(day, F.pmod(F.dayofweek(day) - _WEDNESDAY, F.lit(7)))


def week_of_month(day: Column) -> Column:
    """Number (1-6) of the Wednesday week within the month of ``day``."""
    lead = F.pmod(F.dayofweek(F.trunc(day, "MM")) - _WEDNESDAY, F.lit(7))
    return (F.floor((F.dayofmonth(day) - 1 + lead) / 7) + 1).cast("int")


def sunday_week_of_month(day: Column) -> Column:
    lead = F.dayofweek(F.trunc(day, "MM")) - 1
    return (F.floor((F.dayofmonth(day) - 1 + lead) / 7) + 1).cast("int")


def week_name(day: Column) -> Column:
    return F.element_at(F.array(*[F.lit(n) for n in WEEK_NAMES]), week_of_month(day))


def season_name(day: Column) -> Column:
    return F.element_at(F.array(*[F.lit(n) for n in SEASON_NAMES]), F.quarter(day))


def period_start(day: Column, mode: str) -> Column:
    """First day of the period of ``day``; a run for ``day`` covers start..day."""
    if mode == "day":
        return day
    if mode == "week":
        return week_start(day)
    if mode == "month":
        return F.trunc(day, "MM").cast("date")
    if mode == "season":
        return F.trunc(day, "quarter").cast("date")
    raise ValueError(f"mode must be one of {MODES}, not {mode!r}")


def month_weeks(day: Column) -> Column:
    """Months whose week list holds ``day``, each with its week number.

    A day belongs to its own month; the tail of a month from its last Wednesday on
    also opens week 1 of the next month, unless that month starts on a Wednesday.
    """
    own = F.struct(F.trunc(day, "MM").cast("date").alias("month"), week_of_month(day).alias("week"))
    next_month = F.add_months(F.trunc(day, "MM"), 1)
    also = F.struct(next_month.cast("date").alias("month"), F.lit(1).alias("week"))
    return F.when(day >= week_start(next_month), F.array(own, also)).otherwise(F.array(own))


def run_date(output_path: str, given: str | None = None) -> str:
    """Run date as yyyyMMdd: the given text, else the last 10 path characters without '/'."""
    if given is not None:
        if not re.search(r"\d{8}", given):
            raise ValueError(f"not a date: {given!r}")
        return given
    return output_path[-10:].replace("/", "")
