"""Dates written in several ways."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def iso_text(c: Column) -> Column:
    """DAT-01: ``M/D/YYYY`` or an ISO date or timestamp as ``YYYY-MM-DD`` text.

    Nothing is parsed into a calendar, so no value raises; text of another form
    is returned trimmed and in lower case, blank is null.
    """
    s = F.trim(F.regexp_replace(c, r"^[\s ]+|[\s ]+$", ""))
    part = F.split(s, "/")
    two = lambda x: F.lpad(x, 2, "0")
    us = F.concat_ws("-", F.substring(part[2], 1, 4), two(part[0]), two(part[1]))
    return (
        F.when(s == "", None)
        .when(s.rlike(r"^\d{1,2}/\d{1,2}/\d{4}"), us)
        .when(s.rlike(r"^\d{4}-\d{2}-\d{2}"), F.substring(s, 1, 10))
        .otherwise(F.lower(s))
    )


def iso_date(c: Column) -> Column:
    """DAT-01/02/04: the same as a date; null where there is no such day."""
    return F.try_to_date(F.substring(iso_text(c), 1, 10), "yyyy-MM-dd")


def years_between(later: Column, earlier: Column) -> Column:
    """DAT-05: elapsed years as days / 365.25."""
    return F.datediff(later, earlier) / F.lit(365.25)
