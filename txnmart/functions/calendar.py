"""Calendar expressions. Weeks are ISO weeks (Monday first); years are calendar years."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def date_key(c: Column) -> Column:
    """Integer ``YYYYMMDD``."""
    return (F.year(c) * 10000 + F.month(c) * 100 + F.day(c)).cast("int")


def week_start(c: Column) -> Column:
    return F.date_trunc("week", c).cast("date")


def month_start(c: Column) -> Column:
    return F.trunc(c.cast("date"), "month")


def date_attributes(day: Column) -> list[Column]:
    """All columns of the date dimension for a DATE column."""
    dow = (F.weekday(day) + 1).cast("int")
    return [
        date_key(day).alias("date_key"),
        day.alias("date_actual"),
        week_start(day).alias("week_start"),
        month_start(day).alias("month_start"),
        F.year(day).alias("year_num"),
        F.quarter(day).alias("quarter_num"),
        F.month(day).alias("month_num"),
        F.weekofyear(day).alias("week_num"),
        dow.alias("day_of_week_num"),
        F.date_format(day, "EEEE").alias("day_name"),
        dow.isin(6, 7).alias("is_weekend"),
    ]
