"""Column functions built from Spark built-ins (no UDFs)."""

from tallycheck.functions.dates import (
    check_bound,
    check_range,
    day_spine,
    day_stamp,
    parse_bound,
    stamp_range,
)
from tallycheck.functions.status import severity_of, status_from_count
from tallycheck.functions.text import percent_encode, request_url

__all__ = [
    "check_bound",
    "check_range",
    "day_spine",
    "day_stamp",
    "parse_bound",
    "stamp_range",
    "severity_of",
    "status_from_count",
    "percent_encode",
    "request_url",
]
