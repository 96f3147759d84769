"""Dates held in text: day-first dates, dates in file names, the Persian calendar."""

from __future__ import annotations

import datetime as dt
import itertools

from pyspark.sql import Column
from pyspark.sql import functions as F

from almoner.functions.text import let


def dmy_to_date(col: Column) -> Column:
    """``dd/mm/yyyy`` text as a date; impossible dates give null."""
    return F.try_to_timestamp(col, F.lit("dd/MM/yyyy")).cast("date")


def page_dates(col: Column) -> Column:
    """Every ``dd/mm/yyyy`` in a text, as an array of text."""
    return F.regexp_extract_all(col, F.lit(r"([0-9]{2}/[0-9]{2}/[0-9]{4})"), 1)


def date_in_path(col: Column) -> Column:
    """ISO date inside a file path, as text; empty when there is none."""
    return F.regexp_extract(col, r"[0-9]{4}-[0-9]{2}-[0-9]{2}", 0)


# Persian years at which the published 33-year leap cycle is re-started.
CYCLE_STARTS = [
    -61, 9, 38, 199, 426, 686, 756, 818, 1111, 1181, 1210,
    1635, 2060, 2097, 2192, 2262, 2324, 2394, 2456, 3178,
]
EPOCH = dt.date(1970, 1, 1)


def persian_new_years(first: int = 1, last: int = 2400) -> list[int]:
    """Days since 1970-01-01 of 1 Farvardin for each year ``first .. last``.

    Year lengths are summed away from a known new year, 1 Farvardin 1360 =
    21 March 1981.
    """
    leap = set().union(*(leap_years(a, b) for a, b in zip(CYCLE_STARTS, CYCLE_STARTS[1:], strict=False)))
    lengths = [365 + (y in leap) for y in range(first, last)]
    starts = [0, *itertools.accumulate(lengths)]
    shift = (dt.date(1981, 3, 21) - EPOCH).days - starts[1360 - first]
    return [s + shift for s in starts]


def leap_years(start: int, end: int) -> set[int]:
    """Leap years of one span of Borkowski's arithmetic calendar.

    Leap years are four years apart, every eighth time five, from the span's
    first year on; the last one is five years before the next span.
    """
    gaps = itertools.cycle([4] * 7 + [5])
    regular = itertools.takewhile(lambda year: year < end - 5, itertools.accumulate(gaps, initial=start))
    return {*regular, end - 5}


def _calendar(first: int, last: int) -> Column:
    """The new-year days, and that after ``last``, as one constant array, folded when the plan is optimised."""
    return F.split(F.lit(",".join(map(str, persian_new_years(first, last + 1)))), ",").cast("array<int>")


def jalaali_to_date(col: Column, order: str = "dmy", first: int = 1, last: int = 2400) -> Column:
    """Slash-separated Persian date text as a Gregorian date; invalid dates give null."""
    place = {part: order.index(part) for part in "dmy"}
    well_formed = col.rlike(r"^\s*[0-9]{1,4}/[0-9]{1,4}/[0-9]{1,4}\s*$")
    fields = F.transform(F.split(F.trim(col), "/"), lambda x: x.try_cast("int"))

    def convert(parts: Column) -> Column:
        day, month, year = (F.get(parts, F.lit(place[p])) for p in "dmy")
        starts = _calendar(first, last)
        new_year = F.get(starts, year - first)
        year_days = F.get(starts, year - first + 1) - new_year
        offset = F.when(month <= 7, (month - 1) * 31).otherwise(186 + (month - 7) * 30)
        month_days = F.when(month <= 6, 31).when(month <= 11, 30).otherwise(year_days - 336)
        valid = year.between(first, last) & month.between(1, 12) & (day >= 1) & (day <= month_days)
        return F.when(valid, F.date_from_unix_date(new_year + offset + day - 1))

    return F.when(well_formed, let(fields, convert))


def date_to_jalaali(col: Column, order: str = "ymd", first: int = 1, last: int = 2400) -> Column:
    """Gregorian date as slash-separated Persian date text; null outside the years ``first .. last``."""

    def convert(day: Column) -> Column:
        starts = _calendar(first, last)
        guess = F.year(day) - 621
        number = F.unix_date(day)
        year = F.when(F.get(starts, guess - first) <= number, guess).otherwise(guess - 1)
        in_year = number - F.get(starts, year - first)
        month = F.when(in_year < 186, F.floor(in_year / 31) + 1).otherwise(F.floor((in_year - 186) / 30) + 7)
        in_month = F.when(in_year < 186, in_year % 31).otherwise((in_year - 186) % 30) + 1
        named = {"d": in_month, "m": month, "y": year}
        return F.when(year.between(first, last), F.concat_ws("/", *[named[p].cast("string") for p in order]))

    return let(col.cast("date"), convert)
