"""Tolerant parsing of landed strings: bad input becomes NULL, never an error."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def iso_instant(s: Column) -> Column:
    """ISO-8601 string (offset honoured) -> timestamp in the session zone."""
    return s.try_cast("timestamp")


def iso_calendar_date(s: Column) -> Column:
    """Calendar date *as written* in an ISO-8601 string: the offset does not
    move it (``2024-11-01T23:30:00-02:00`` -> 2024-11-01)."""
    return s.try_cast("date")


def json_field(s: Column, ddl: str, field: str) -> Column:
    """One field of a JSON object string, typed by ``ddl`` (``"k INT"``)."""
    return F.from_json(s, ddl).getField(field)
