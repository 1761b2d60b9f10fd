"""Dates from text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values: what counts as a date, with an optional time and zone ------
# Group 1 is the date: year, month and day with the same separator twice.
_DAY = r"(?:0*(?=[0-9])|(?=-))(-?[0-9]{1,7}([-/ \\])[0-9]{1,2}\2[0-9]{1,2})"
_HOUR_TO_SECOND = (
    r"(?:0{0,6}(?:[01]?[0-9]|2[0-3]):(?:[0-5]?[0-9](?::(?:[0-5]?[0-9](?:\.[0-9]*)?)?)?)?"
    r"|0{0,6}24:0{1,2}(?::0{1,2}(?:\.0*)?)?)"
)
_ZONE = r"(?:Z|[+-][0-9]{2}(?::?[0-9]{2}|:[0-9]{2}:[0-9]{2})?| [A-Za-z0-9/_+:-]+)"
_DATE_SHAPE = rf"^\s*{_DAY}(?:(?:T|\s)\s*{_HOUR_TO_SECOND}{_ZONE}?)?\s*$"


def try_date(col: Column | str) -> Column:
    """The date a text starts with, or NULL when the text is not a full date.

    Spark alone would read '2021' as 1 January and ignore any tail; one regular
    expression checks the shape first and a failed match never reaches a cast.
    Spark wants four digits of a year, so shorter years are tried with zeros.
    Words ('epoch', 'infinity') and years marked BC are not dates here.
    """
    c = F.col(col) if isinstance(col, str) else col
    day = F.translate(F.regexp_extract(c, _DATE_SHAPE, 1), "/ \\", "---")
    padded = F.concat(F.lit("000"), day)
    return F.coalesce(day.try_cast("date"), padded.try_cast("date"))


def duration_days(start: Column | str, end: Column | str) -> Column:
    """Whole days from start to end; negative when the end comes first."""
    return F.datediff(end, start).cast("bigint")
