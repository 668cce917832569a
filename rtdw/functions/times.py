"""Time expressions. Every conversion uses the session time zone.

Arguments are SQL expressions, mostly plain column names.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, functions as F

# The text form records carry.
SECOND_FORMAT = "yyyy-MM-dd HH:mm:ss"

_UNIT_MS = {
    "millisecond": 1,
    "second": 1_000,
    "minute": 60_000,
    "hour": 3_600_000,
    "day": 86_400_000,
}
YEAR_MS = 365 * _UNIT_MS["day"]


def duration_ms(text: str) -> int:
    """Milliseconds of a duration such as ``'10 seconds'`` or ``'-15 minutes'``."""
    match = re.fullmatch(r"\s*(-?\d+)\s+([a-z]+?)s?\s*", text)
    if not match or match[2] not in _UNIT_MS:
        raise ValueError(f"not a duration: {text!r}")
    return int(match[1]) * _UNIT_MS[match[2]]


def millis_to_ts(millis: str) -> Column:
    return F.expr(f"timestamp_millis({millis})")


def millis_to_second(millis: str) -> Column:
    """Event time cut to whole seconds."""
    return F.expr(f"date_trunc('second', timestamp_millis({millis}))")


def millis_to_text(millis: str) -> Column:
    return F.expr(f"date_format(timestamp_millis({millis}), '{SECOND_FORMAT}')")


def millis_to_day(millis: str) -> Column:
    return F.expr(f"to_date(timestamp_millis({millis}))")


def text_to_ts(text: str) -> Column:
    """The instant of a ``SECOND_FORMAT`` text. A cast reads it several times faster than a
    pattern does; text that is no time fails the job."""
    return F.expr(f"cast({text} as timestamp)")


def text_to_millis(text: str) -> Column:
    return F.expr(f"unix_millis(cast({text} as timestamp))")


def ts_to_text(ts: str) -> Column:
    return F.expr(f"date_format({ts}, '{SECOND_FORMAT}')")


def day_number(ts: str) -> Column:
    """The day as an integer, yyyyMMdd."""
    return F.expr(f"cast(date_format({ts}, 'yyyyMMdd') as int)")


def time_parts(create_time: str) -> dict[str, Column]:
    """Date text, hour text and epoch millis of a creation time."""
    return {
        "create_date": F.expr(f"split({create_time}, ' ')[0]"),
        "create_hour": F.expr(f"split(split({create_time}, ' ')[1], ':')[0]"),
        "create_ts": text_to_millis(create_time),
    }


def age_years(birthday: str, as_of: str | None = None) -> Column:
    """Whole 365-day years from a yyyy-MM-dd birthday to ``as_of`` (default now)."""
    now = f"cast('{as_of}' as timestamp)" if as_of else "current_timestamp()"
    born = f"cast({birthday} as timestamp)"
    return F.expr(f"cast((unix_millis({now}) - unix_millis({born})) div {YEAR_MS} as int)")
