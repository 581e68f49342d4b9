"""Time expressions on zone-free timestamps.

Texts are cut from the plain cast, never from `date_format` on the timestamp:
that would pass through the session time zone and shift daylight-saving gaps.
"""

from __future__ import annotations


def to_time(value: str) -> str:
    return f"try_cast({value} AS timestamp_ntz)"


def seconds_between(start: str, end: str) -> str:
    """From the interval: `timestampdiff` would go through the session zone."""
    return f"CAST(try_cast({end} - {start} AS decimal(18, 6)) AS double)"


def minutes_between(start: str, end: str) -> str:
    return f"({seconds_between(start, end)} / 60D)"


def time_text(value: str) -> str:
    """`yyyy-MM-dd HH:mm:ss`"""
    return f"substring(CAST({value} AS string), 1, 19)"


def compact_time(value: str) -> str:
    """`yyyyMMddHHmmss`"""
    return f"translate({time_text(value)}, '- :', '')"


def day_text(value: str) -> str:
    return f"CAST(CAST({value} AS date) AS string)"


def day_name(value: str) -> str:
    return f"date_format(CAST({value} AS date), 'EEEE')"


def is_weekend(value: str) -> str:
    return f"CAST(weekday({value}) IN (5, 6) AS int)"
