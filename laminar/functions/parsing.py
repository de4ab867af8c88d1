"""Parsing raw strings into dates and times.

Raw layers hold times as text. A malformed raw value becomes NULL (the cleaning
step must not abort a whole day for one bad row), while a malformed *run date*
is a caller error and raises.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def lenient_date(c: Column | str) -> Column:
    """String -> DATE; leading ``yyyy-MM-dd`` of a date or date-time, NULL if malformed."""
    return F.try_to_date(F.col(c) if isinstance(c, str) else c)


def lenient_timestamp(c: Column | str) -> Column:
    """String -> TIMESTAMP (session time zone), NULL if malformed."""
    return F.try_to_timestamp(F.col(c) if isinstance(c, str) else c)


def resolve_run_date(value: str | _dt.date | None = None, today: _dt.date | None = None) -> str:
    """The day a run processes: the given day, else yesterday. Always ``yyyy-MM-dd``.

    An unparseable value raises ``ValueError``.
    """
    if value is None:
        return ((today or _dt.date.today()) - _dt.timedelta(days=1)).isoformat()
    if isinstance(value, _dt.date):
        return value.isoformat()
    return _dt.date.fromisoformat(str(value)).isoformat()


def run_date_literal(day: str) -> Column:
    """The run date as a DATE literal; ANSI cast, so a bad value raises."""
    return F.lit(resolve_run_date(day)).cast("date")
