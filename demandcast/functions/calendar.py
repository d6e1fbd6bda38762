"""Date expressions and the few date computations the driver needs to build literals."""

from __future__ import annotations

from datetime import date, timedelta
from math import pi

from pyspark.sql import Column
from pyspark.sql import functions as F

# 1970-01-05 is a Monday, so week numbers count Mondays from there.
_MONDAY_ZERO = date(1970, 1, 5)


def week_start(day: Column) -> Column:
    """Monday of the week that holds ``day``; date arithmetic only, no time zone involved."""
    return F.trunc(day, "week")


def week_no(monday: Column) -> Column:
    """Running number of a Monday; consecutive weeks differ by one."""
    return F.floor(F.datediff(monday, F.lit(_MONDAY_ZERO)) / 7).cast("int")


def week_no_of(day: date) -> int:
    """Number of the first Monday on or after ``day``: history is ``week_no < week_no_of(as_of)``."""
    return -((_MONDAY_ZERO - day).days // 7)


def monday_of_no(no: Column) -> Column:
    return F.date_add(F.lit(_MONDAY_ZERO), no * 7)


def month_no(day: Column) -> Column:
    return F.year(day) * 12 + F.month(day) - 1


def season_of_month(month: Column) -> Column:
    """1 winter (Dec-Feb), 2 spring, 3 summer, 4 autumn."""
    return (F.floor((month % 12) / 3) + 1).cast("int")


def week_angle(week_of_year: Column) -> Column:
    return week_of_year * F.lit(2 * pi) / F.lit(52.0)


def align_sunday(day: Column, forward: bool) -> Column:
    """Sunday on or after ``day`` (``forward``) or on or before it."""
    if forward:
        return F.next_day(F.date_sub(day, 1), "Sun")
    return F.date_sub(F.next_day(day, "Sun"), 7)


def to_date_key(day: Column) -> Column:
    """DATE to the integer YYYYMMDD."""
    return F.date_format(day, "yyyyMMdd").cast("int")


def parse_date(text: Column) -> Column:
    """YYYYMMDD or ISO text (or integer) to DATE, anything else to null.

    Casting ISO text reports failure by null; format-driven parsing would raise and catch an
    exception for each row in another format.
    """
    trimmed = F.trim(text.cast("string"))
    eight_digits = F.concat_ws("-", F.substring(trimmed, 1, 4), F.substring(trimmed, 5, 2), F.substring(trimmed, 7, 2))
    iso = F.when(trimmed.rlike(r"^\d{8}$"), eight_digits).when(trimmed.rlike(r"^\d{4}-\d{1,2}-\d{1,2}"), trimmed)
    return iso.try_cast("date")


# --- driver-side date arithmetic on single values --------------------------------------------


def sunday_on_or_after(day: date) -> date:
    return day + timedelta(days=(6 - day.weekday()) % 7)


def sunday_on_or_before(day: date) -> date:
    return day - timedelta(days=(day.weekday() + 1) % 7)


def months_before(day: date, months: int) -> date:
    """``day`` shifted back by calendar months, clamped to the end of the month."""
    index = day.year * 12 + day.month - 1 - months
    year, month = divmod(index, 12)
    first_of_next = date(year + (month == 11), (month + 1) % 12 + 1, 1)
    return date(year, month + 1, min(day.day, (first_of_next - timedelta(days=1)).day))


def mondays(first: date, last: date) -> list[date]:
    """All Mondays in ``[first, last]``."""
    day = first + timedelta(days=-first.weekday() % 7)
    return [day + timedelta(weeks=i) for i in range(max(0, (last - day).days // 7 + 1))]
