"""Text to UTC timestamps. The session zone must be UTC (see `session.pin_utc`)."""

from __future__ import annotations

from collections.abc import Mapping
from functools import cache
from zoneinfo import available_timezones

from pyspark.sql import Column, functions as F

ISO_SPACED = "yyyy-M-d H:m:s"
DAY_FIRST = "d/M/yyyy H:m:s"
MONTH_FIRST = "M/d/yyyy H:m:s"
MONTH_NAME = "MMM d, yyyy H:m:s"

# Zone tokens found in ledger exports and the region each stands for.
# Daylight tokens (PDT, EDT, CEST) are left out on purpose: they are not accepted.
ZONE_TOKENS = {
    "UTC": "UTC",
    "GMT": "UTC",
    "PST": "America/Los_Angeles",
    "MST": "America/Phoenix",
    "CST": "America/Chicago",
    "EST": "America/Panama",
    "CET": "Europe/Paris",
    "EET": "Europe/Helsinki",
    "WET": "Europe/Lisbon",
}

#: How a report names its first and last day in its file name: a fixed format.
_INTERVAL_IN_NAME = r"_([0-9]{8})_([0-9]{8})[.]csv$"


@cache
def region_names() -> tuple[str, ...]:
    """Area/City names a row may use directly as its zone."""
    return tuple(sorted(n for n in available_timezones() if "/" in n and not n.startswith("Etc/")))


def local_clock(text: Column, pattern: str) -> Column:
    """Clock reading without a zone; an impossible calendar date is NULL."""
    return F.try_to_timestamp(text, F.lit(pattern))


def joined(date_text: str, time_text: str) -> Column:
    """Date and time columns as one text, NULL if either is missing."""
    return F.concat(F.col(date_text), F.lit(" "), F.col(time_text))


def zone_of(token: Column, zones: Mapping[str, str] | None = None) -> Column:
    """Region for a zone token, NULL for tokens outside the allow-list."""
    region = F.when(token.isin(*region_names()), token)
    for name, target in (ZONE_TOKENS if zones is None else zones).items():
        region = region.when(token == name, F.lit(target))
    return region


def to_utc(clock: Column, token: Column, zones: Mapping[str, str] | None = None) -> Column:
    """Local clock reading and a per-row zone token to UTC."""
    return F.to_utc_timestamp(clock, zone_of(token, zones))


def interval_of_file(source_file: Column) -> tuple[Column, Column]:
    """First and last day declared at the end of a file name `..._yyyyMMdd_yyyyMMdd.csv`."""

    def edge(group: int) -> Column:
        return F.try_to_date(F.regexp_extract(source_file, _INTERVAL_IN_NAME, group), "yyyyMMdd")

    return edge(1), edge(2)


def day_or_month_first(text: Column, first_day: Column, last_day: Column) -> Column:
    """Day-first reading if it lies in the interval, else month-first if that does, else NULL."""
    by_day, by_month = local_clock(text, DAY_FIRST), local_clock(text, MONTH_FIRST)
    return F.when(by_day.cast("date").between(first_day, last_day), by_day).when(
        by_month.cast("date").between(first_day, last_day), by_month
    )


def iso_z(ts: Column | str) -> Column:
    """2026-06-01T09:30:00Z."""
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss'Z'")
