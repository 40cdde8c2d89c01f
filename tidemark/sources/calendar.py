"""Date dimension, computed by rule for any range."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

START, END = "2020-01-01", "2028-12-31"


def _on(d: Column, month: int, day: int) -> Column:
    return (F.month(d) == month) & (F.dayofmonth(d) == day)


def _nth(d: Column, month: int, weekday: int, first_day: int) -> Column:
    """Weekday (Monday 0) that falls in the seven days from ``first_day``."""
    day = F.dayofmonth(d)
    return (F.month(d) == month) & (F.weekday(d) == weekday) & day.between(first_day, first_day + 6)


def us_federal_holiday(d: Column) -> Column:
    """Federal holiday on its actual date (no observed-day shift)."""
    rules = [
        _on(d, 1, 1),  # New Year
        _nth(d, 1, 0, 15),  # Martin Luther King Jr. Day
        _nth(d, 2, 0, 15),  # Presidents' Day
        _nth(d, 5, 0, 25),  # Memorial Day
        _on(d, 6, 19) & (F.year(d) >= 2021),  # Juneteenth
        _on(d, 7, 4),  # Independence Day
        _nth(d, 9, 0, 1),  # Labor Day
        _nth(d, 10, 0, 8),  # Columbus Day
        _on(d, 11, 11),  # Veterans Day
        _nth(d, 11, 3, 22),  # Thanksgiving
        _on(d, 12, 25),  # Christmas
    ]
    out = rules[0]
    for r in rules[1:]:
        out = out | r
    return out


def season(d: Column) -> Column:
    m = F.month(d)
    return (
        F.when(m.isin(12, 1, 2), "Winter")
        .when(m.between(3, 5), "Spring")
        .when(m.between(6, 8), "Summer")
        .otherwise("Fall")
    )


def expand_dates(bounds: DataFrame, first: str = "first_day", last: str = "last_day") -> DataFrame:
    """Date dimension from a one-row frame that holds the two bounds."""
    days = bounds.select(F.explode(F.sequence(first, last)).alias("full_date"))
    d = F.col("full_date")
    return days.select(
        d,
        F.date_format(d, "yyyyMMdd").cast("int").alias("date_key"),
        F.year(d).alias("year"),
        F.month(d).alias("month"),
        F.date_format(d, "MMMM").alias("month_name"),
        F.quarter(d).alias("quarter"),
        F.date_format(d, "EEEE").alias("day_name"),
        (F.weekday(d) >= 5).alias("is_weekend"),
        us_federal_holiday(d).alias("is_us_federal_holiday"),
        season(d).alias("season"),
    )


def date_dimension(spark: SparkSession, start: str = START, end: str = END) -> DataFrame:
    """Date dimension for a fixed range, both ends included."""
    bounds = spark.range(1).select(
        F.lit(start).cast("date").alias("first_day"), F.lit(end).cast("date").alias("last_day")
    )
    return expand_dates(bounds)
