"""Date parsing for the calendar tables: month names, compact dates, footnotes."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from polidata.functions.nullsafe import _c

# English month names and their three-letter abbreviations.
MONTHS = ["January", "February", "March", "April", "May", "June", "July",
          "August", "September", "October", "November", "December"]
MONTH_ABBR = ["Jan", "Feb", "Mar", "Apr", "May", "Jun", "Jul", "Aug", "Sep",
              "Oct", "Nov", "Dec"]


def abbreviate_months(c) -> Column:
    """Replace full month names by their abbreviation ('March 4' -> 'Mar 4')."""
    return reduce(lambda acc, mn: F.regexp_replace(acc, mn[0], mn[1]),
                  zip(MONTHS, MONTH_ABBR), _c(c))


def cut_year_footnote(c) -> Column:
    """'Dec 22, 19942' -> 'Dec 22, 1994': keep four digits after the comma."""
    c = _c(c)
    parts = F.split(c, ",", 2)
    year = F.substring(F.coalesce(F.get(parts, 1), F.lit("")), 2, 4)
    return F.concat_ws(", ", F.get(parts, 0), year)


def month_day_year(c) -> Column:
    """'Jan. 3, 1995' / 'January 3, 1995' -> DATE; anything else -> NULL."""
    s = F.regexp_replace(_c(c), r"^([^.]*)\.", "$1")   # first period only
    s = abbreviate_months(F.trim(s))
    return F.try_to_date(s, "MMM d, yyyy")


def compact_date(c) -> Column:
    """'20160229' -> DATE; invalid calendar dates (e.g. 20150229) -> NULL."""
    return F.try_to_date(_c(c), "yyyyMMdd")
