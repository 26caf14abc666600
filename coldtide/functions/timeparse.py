"""Event-time text to epoch milliseconds, and time-window settings to seconds."""

from __future__ import annotations

import calendar
import re
from datetime import date, datetime, timezone
from decimal import ROUND_FLOOR, Decimal
from typing import Any

import pandas as pd

_NUMBER = re.compile(r"([0-9]+)(?:\.([0-9]+))?", re.ASCII)
_MOMENT = re.compile(
    r"([0-9]{4})-([0-9]{2})-([0-9]{2})T? ?([0-9]{2}):([0-9]{2})(?::([0-9]{2}))?(?:\.([0-9]{1,9}))?"
    r"(Z|[+-][0-9]{2}:[0-9]{2}(?::[0-9]{2})?|[+-][0-9]{4})?",
    re.ASCII | re.IGNORECASE,
)
_INSTANT = re.compile(r"([0-9]{4}-[0-9]{2}-[0-9]{2}T[0-9]{2}:[0-9]{2}(?::[0-9]{2}(?:\.[0-9]{1,9})?)?)Z", re.ASCII | re.IGNORECASE)
_EPOCH_DAY = date(1970, 1, 1).toordinal()
#: Integers of more digits than this are milliseconds already.
SECOND_DIGITS = 11


def parse_millis(text: str | bytes | None) -> int | None:
    """Milliseconds since the epoch, or None for text that is no time.

    Numbers of up to 11 integer digits are seconds, rounded half up to a
    millisecond; longer ones are milliseconds, their fraction cut. Dates need a
    time of day; without an offset they are UTC. A day past the month's end is
    its last day, and 24:00 is the next midnight.
    """
    if text is None:
        return None
    if isinstance(text, bytes):
        text = text.decode("utf-8", "replace")
    start, end = 0, len(text)
    while start < end and text[start] <= " ":
        start += 1
    while end > start and text[end - 1] <= " ":
        end -= 1
    text = text[start:end]
    if found := _NUMBER.fullmatch(text):
        if len(found[1]) > SECOND_DIGITS:
            value = int(found[1])
        else:
            value = int((Decimal(text) * 1000 + Decimal("0.5")).to_integral_value(ROUND_FLOOR))
        return value if value < 1 << 63 else None
    found = _MOMENT.fullmatch(text)
    if not found:
        return None
    year, month, day, hour, minute = (int(found[i]) for i in range(1, 6))
    second, nanos = int(found[6] or 0), int((found[7] or "").ljust(9, "0") or 0)
    if not (1 <= month <= 12 and 1 <= day <= 31 and year and minute < 60 and second < 60):
        return None
    if hour > 23 and not (hour == 24 and minute == second == nanos == 0):
        return None
    day = min(day, calendar.monthrange(year, month)[1])
    total = (date(year, month, day).toordinal() - _EPOCH_DAY) * 86_400 + hour * 3600 + minute * 60 + second
    offset = found[8]
    if offset and offset not in "Zz":
        digits = offset[1:].replace(":", "").ljust(6, "0")
        shift = int(digits[:2]) * 3600 + int(digits[2:4]) * 60 + int(digits[4:6])
        if shift > 18 * 3600 or int(digits[2:4]) > 59:
            return None
        total -= -shift if offset[0] == "-" else shift
    return total * 1000 + nanos // 1_000_000


def epoch_seconds(name: str, value: Any) -> int | None:
    """A window bound: a number (cut), integer text or an ISO-8601 instant."""
    if value is None or (isinstance(value, str) and not value.strip()):
        return None
    if isinstance(value, (int, float)) and not isinstance(value, bool):
        return int(value)
    text = str(value).strip()
    if re.fullmatch(r"[+-]?[0-9]+", text, re.ASCII):
        return int(text)
    if found := _INSTANT.fullmatch(text):
        moment = found[1].upper()
        moment = moment if moment.count(":") == 2 else moment + ":00"
        try:
            return int(datetime.fromisoformat(moment[:19]).replace(tzinfo=timezone.utc).timestamp())
        except ValueError:
            pass
    raise ValueError(f"[{name}] must be epoch seconds or an ISO-8601 instant, got [{value}]")


def parse_event_time(column):
    """``parse_millis`` over a string column, as a vectorised function."""
    from pyspark.sql import SparkSession
    from pyspark.sql import functions as F

    from coldtide.session import ship_code

    if active := SparkSession.getActiveSession():
        ship_code(active)

    @F.pandas_udf("long")
    def parse(texts: pd.Series) -> pd.Series:
        return texts.map(parse_millis, na_action="ignore").astype("Int64")

    return parse(column)
