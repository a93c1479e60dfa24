"""Labels, dates and ages."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def labelled(prefix: str, text: Column) -> Column:
    """Prefix and text; a NULL text stays NULL."""
    return F.concat(F.lit(prefix), text)


def pair(first: Column, second: Column, keep_partial: bool = False) -> Column:
    """Two texts with a blank between. One NULL half voids the whole, unless
    ``keep_partial``, which shows the half that is there."""
    if keep_partial:
        shown = F.concat_ws(" ", first, second)
        return F.when(first.isNotNull() | second.isNotNull(), shown)
    return F.concat(first, F.lit(" "), second)


def no_text() -> Column:
    return F.lit(None).cast("string")


def first_known(first: Column, second: Column, type_of_first: str) -> Column:
    """``first`` or else ``second``, in the type of ``first``."""
    return F.coalesce(first, second.cast(type_of_first)).cast(type_of_first)


def day(ts: Column) -> Column:
    """The date of a time."""
    return ts.cast("date")


def moment(as_of: dt.datetime) -> Column:
    return F.lit(as_of.isoformat(sep=" ")).cast("timestamp_ntz")


def cutoff(as_of: dt.datetime, years: int) -> Column:
    """The moment ``years`` before; time of day kept, Feb 29 becomes Feb 28."""
    return moment(as_of) - F.make_ym_interval(F.lit(years), F.lit(0))


def within_years(ts: Column, as_of: dt.datetime, years: int) -> Column:
    return ts > cutoff(as_of, years)


def year_boundaries(earlier: Column, later: Column) -> Column:
    """New Year's Days between two moments (not full years)."""
    return F.year(later) - F.year(earlier)


def age_at(current_age: Column, event: Column, as_of: dt.datetime) -> Column:
    """Age now less the calendar years since the event; NULL without a time."""
    return (current_age - year_boundaries(event, moment(as_of))).cast("int")
