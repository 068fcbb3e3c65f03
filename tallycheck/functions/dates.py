"""Day bounds, day stamps and day spines.

Bounds are ``YYYYMMDD`` strings, both inclusive. A day stamp is the string
``YYYYMMDD00`` used as the Bronze ``timestamp`` column.
"""

from __future__ import annotations

import datetime as dt
import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from tallycheck.constants import DAY_STAMP_PATTERN

_BOUND_RE = re.compile(r"^\d{8}$")


def check_bound(value: str, name: str = "date") -> dt.date:
    """Parse one ``YYYYMMDD`` parameter; exactly eight digits, a real day."""
    if not isinstance(value, str) or not _BOUND_RE.match(value):
        raise ValueError(f"{name} must be YYYYMMDD (8 digits), got {value!r}")
    try:
        return dt.datetime.strptime(value, "%Y%m%d").date()
    except ValueError as exc:
        raise ValueError(f"{name} is not a calendar day: {value!r}") from exc


def parse_bound(col: Column | str) -> Column:
    """Column form of :func:`check_bound`: the DATE of exactly eight digits that are a real day, else NULL."""
    c = F.col(col) if isinstance(col, str) else col
    return F.when(c.rlike("^(?!0000)[0-9]{8}$") & ~c.contains("\n"), F.try_to_date(c, "yyyyMMdd"))


def check_range(start: str, end: str) -> tuple[dt.date, dt.date]:
    """Validate an inclusive range of run parameters; start must not pass end."""
    s = check_bound(start, "start_date")
    e = check_bound(end, "end_date")
    if s > e:
        raise ValueError(f"start_date {start} is after end_date {end}")
    return s, e


def stamp_of(day: dt.date) -> str:
    """Day stamp of a Python date (for parameters only)."""
    return day.strftime("%Y%m%d") + "00"


def day_stamp(col: Column | str) -> Column:
    """DATE column to the ``YYYYMMDD00`` stamp."""
    c = F.col(col) if isinstance(col, str) else col
    return F.date_format(c, DAY_STAMP_PATTERN)


def day_spine(start: str, end: str) -> Column:
    """Array of every DATE from start to end inclusive (validated parameters).

    Used with ``explode`` next to the rows it belongs to, so no day list is
    built on the driver and no join is needed to attach days.
    """
    s, e = check_range(start, end)
    return F.sequence(F.lit(s), F.lit(e), F.expr("INTERVAL 1 DAY"))


def stamp_range(start: str, end: str) -> tuple[str, str]:
    """Lowest and highest day stamp of the range (for range filters)."""
    s, e = check_range(start, end)
    return stamp_of(s), stamp_of(e)
