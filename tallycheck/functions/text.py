"""String functions: title percent-encoding and request URLs."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tallycheck.constants import (
    DEFAULT_ACCESS,
    DEFAULT_AGENT,
    DEFAULT_GRANULARITY,
    DEFAULT_PROJECT,
    PAGEVIEWS_BASE_URL,
)


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def percent_encode(col: Column | str) -> Column:
    """Percent-encode UTF-8 text with no character left safe but ``A-Z a-z 0-9 _ . - ~``.

    Spark's ``url_encode`` is form encoding: it writes a space as ``+``, keeps
    ``*`` and encodes ``~``. Three replacements turn it into plain
    percent-encoding. A literal ``+`` or ``%`` is already encoded by then
    (``%2B``, ``%25``), so the replacements only touch what they should.
    """
    encoded = F.url_encode(_col(col))
    encoded = F.replace(encoded, F.lit("+"), F.lit("%20"))
    encoded = F.replace(encoded, F.lit("*"), F.lit("%2A"))
    return F.replace(encoded, F.lit("%7E"), F.lit("~"))


def request_url(
    title: Column | str,
    start_date: Column | str,
    end_date: Column | str,
    base_url: str = PAGEVIEWS_BASE_URL,
    project: str = DEFAULT_PROJECT,
    access: str = DEFAULT_ACCESS,
    agent: str = DEFAULT_AGENT,
    granularity: str = DEFAULT_GRANULARITY,
) -> Column:
    """Daily per-article request URL for one title and an inclusive window."""
    prefix = f"{base_url.rstrip('/')}/per-article/{project}/{access}/{agent}/"
    return F.concat(
        F.lit(prefix),
        percent_encode(title),
        F.lit(f"/{granularity}/"),
        _col(start_date),
        F.lit("/"),
        _col(end_date),
    )
