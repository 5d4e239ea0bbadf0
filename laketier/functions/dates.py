"""Calendar attributes of a date column (the date dimension's columns)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Spark's dayofweek numbers Sunday 1 .. Saturday 7.
WEEKEND_DAYS = [1, 7]


def date_attributes(d: Column) -> dict[str, Column]:
    """Ordered mapping column name -> expression; ISO week, Sunday = 1."""
    return {
        "year": F.year(d),
        "month": F.month(d),
        "day": F.dayofmonth(d),
        "quarter": F.quarter(d),
        "week_of_year": F.weekofyear(d),
        "day_of_week": F.dayofweek(d),
        "month_name": F.date_format(d, "MMMM"),
        "day_name": F.date_format(d, "EEEE"),
        "is_weekend": F.dayofweek(d).isin(WEEKEND_DAYS),
    }
