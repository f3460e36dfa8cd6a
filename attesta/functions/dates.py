"""Dates and periods: Column -> Column. `as_of` is always an argument, never the clock."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from attesta.functions.text import as_col


def quarter(c) -> Column:
    """A date or timestamp as YYYYQn; null stays null."""
    d = as_col(c)
    return F.concat(F.year(d), F.lit("Q"), F.quarter(d))


def quarter_of_text(c) -> Column:
    """N12 for text dates: digits only, fewer than six digits give null."""
    d = F.regexp_replace(as_col(c), "[^0-9]", "")
    month = F.substring(d, 5, 2).cast("int")
    return F.when(F.length(d) >= 6, F.concat(F.substring(d, 1, 4), F.lit("Q"),
                                             (F.floor((month - 1) / 3) + 1).cast("string")))


def rel_date(c, as_of) -> Column:
    """N13: 'today', 'yesterday' or 'N days ago' as struct(date, kind). 'N+' is a floor, not a date: null."""
    s = F.lower(F.coalesce(as_col(c), F.lit("")))
    run = as_col(as_of).cast("date")
    days = F.regexp_extract(s, r"(\d+)\+?\s*day", 1)
    counted = (days != "") & ~F.contains(s, F.lit("+"))
    date = (F.when(F.contains(s, F.lit("today")), run)
            .when(F.contains(s, F.lit("yesterday")), F.date_sub(run, 1))
            .when(counted, F.date_sub(run, days.try_cast("int"))))
    kind = (F.when(F.contains(s, F.lit("today")), F.lit("workday_posted_today"))
            .when(F.contains(s, F.lit("yesterday")) | counted, F.lit("workday_posted_rel")))
    return F.struct(date.alias("date"), kind.alias("kind"))


def feed_date(c) -> Column:
    """An RFC-822 publication date as a date; anything else is null."""
    s = F.regexp_replace(F.trim(as_col(c)), r"^[A-Za-z]{3},\s*", "")
    s = F.regexp_replace(s, r"(?i)\b(GMT|UTC|UT|Z)$", "+0000")
    return F.to_date(F.try_to_timestamp(s, F.lit("d MMM yyyy HH:mm:ss Z")))


def in_window(date, as_of, days: int) -> Column:
    """Dated on or after as_of - days; undated rows are out."""
    return F.coalesce(as_col(date) >= F.date_sub(as_col(as_of).cast("date"), days), F.lit(False))
