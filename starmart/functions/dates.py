"""Calendar helpers: integer ``yyyymmdd`` keys and the calendar attributes of a date."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def parse_yyyymmdd(c: str | Column) -> Column:
    """Integer (or text) ``20200113`` to DATE."""
    return F.to_date(_col(c).cast("string"), "yyyyMMdd")


def date_id(c: str | Column) -> Column:
    """DATE (or timestamp) to its integer ``yyyymmdd`` key, by arithmetic on the parts
    (no per-row string formatting)."""
    d = _col(c)
    return (F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)).cast("int")


def calendar_columns(c: str | Column) -> dict[str, Column]:
    """Calendar attributes in warehouse order (without the key and the date itself).

    Monday is day 1; ``week`` is the ISO-8601 week (so 2021-01-01 is in week 53).
    """
    d = _col(c)
    weekday = F.weekday(d)  # Monday = 0 ... Sunday = 6
    return {
        "day_name": F.date_format(d, "EEEE"),
        "day_of_week": (weekday + 1).cast("int"),
        "day": F.dayofmonth(d),
        "day_of_year": F.dayofyear(d),
        "month": F.month(d),
        "month_name": F.date_format(d, "MMMM"),
        "week": F.weekofyear(d),
        "quarter": F.quarter(d),
        "year": F.year(d),
        "year_half": F.when(F.month(d) < 7, F.lit(1)).otherwise(F.lit(2)),
        "is_weekend": weekday >= 5,
    }
