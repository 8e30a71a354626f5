"""Named date ranges for the during/not-during predicates."""

from __future__ import annotations

import re
from datetime import date, timedelta

from pyspark.sql import SparkSession

_FIXED = {"yesterday": -1, "today": 0, "tomorrow": 1}
_RELATIVE = re.compile(r"^(this|last|next) (day|week|month|quarter|year)$")
_LAST_N = re.compile(r"^last (\d+) (day|week|month|quarter|year)s?$")
_MONTHS = {"month": 1, "quarter": 3, "year": 12}


def session_today() -> date:
    """The session's current date, in its own time zone."""
    spark = SparkSession.getActiveSession()
    return spark.sql("SELECT current_date()").first()[0] if spark else date.today()


def _period_start(day: date, unit: str, offset: int) -> date:
    """First day of the period ``offset`` periods away from the one holding ``day``."""
    if unit == "day":
        return day + timedelta(days=offset)
    if unit == "week":
        return day - timedelta(days=day.weekday()) + timedelta(weeks=offset)
    span = _MONTHS[unit]
    months = (day.year * 12 + day.month - 1) // span * span + offset * span
    return date(months // 12, months % 12 + 1, 1)


def date_range(spec: str | tuple, as_of: date | None = None) -> tuple:
    """Half-open ``(start, end)`` for a range name or an explicit pair.

    Weeks start on Monday. "last N units" are the N complete units before the current one.
    """
    if isinstance(spec, (tuple, list)):
        if len(spec) != 2:
            raise ValueError("a range needs a start and an end")
        return tuple(spec)
    today = as_of or session_today()
    text = " ".join(spec.lower().split())
    if text in _FIXED:
        start = today + timedelta(days=_FIXED[text])
        return start, start + timedelta(days=1)
    if match := _RELATIVE.match(text):
        step = {"last": -1, "this": 0, "next": 1}[match[1]]
        return _period_start(today, match[2], step), _period_start(today, match[2], step + 1)
    if match := _LAST_N.match(text):
        return _period_start(today, match[2], -int(match[1])), _period_start(today, match[2], 0)
    raise ValueError(f"unknown range: {spec!r}")
