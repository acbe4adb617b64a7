"""Calendar dimension."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskmart.functions.expr import date_id, us_week

# Fixed values: (month, day, name) of the holidays marked in the calendar.
HOLIDAYS = ((1, 1, "New Year's Day"), (7, 4, "Independence Day"), (12, 25, "Christmas Day"))


def build_date_dim(spark: SparkSession, start: str = "1999-01-01", end: str = "2030-12-31") -> DataFrame:
    """One row per day between ``start`` and ``end`` inclusive; the size depends on the span only."""
    d = F.col("FullDate")
    days = spark.range(1).select(
        F.explode(F.sequence(F.lit(start).cast("date"), F.lit(end).cast("date"))).alias("FullDate")
    )
    holiday = F.lit(None).cast("string")
    for month, day, name in HOLIDAYS:
        holiday = F.when((F.month(d) == month) & (F.dayofmonth(d) == day), F.lit(name)).otherwise(holiday)
    weekend = F.dayofweek(d).isin(1, 7)
    return days.select(
        date_id(d).alias("DateID"),
        d,
        F.dayofmonth(d).alias("DayOfMonth"),
        F.date_format(d, "EEEE").alias("DayName"),
        F.dayofweek(d).alias("DayOfWeek"),
        F.dayofyear(d).alias("DayOfYear"),
        us_week(d).alias("WeekOfYear"),
        F.month(d).alias("MonthNumber"),
        F.date_format(d, "MMMM").alias("MonthName"),
        F.quarter(d).alias("Quarter"),
        F.year(d).alias("Year"),
        weekend.cast("int").alias("IsWeekend"),
        holiday.isNotNull().cast("int").alias("IsHoliday"),
        holiday.alias("HolidayName"),
        (~weekend & holiday.isNull()).cast("int").alias("IsBusinessDay"),
    )


def date_key(df: DataFrame, date_col: str, dim: DataFrame, out: str = "DateID") -> DataFrame:
    """Key of the date dimension, computed from the date itself where the calendar has no such day.

    The calendar is a few thousand rows for any data size (one per day of its span), hence the broadcast.
    """
    days = F.broadcast(dim.select(F.col("FullDate").alias("_day"), F.col("DateID").alias("_key")))
    joined = df.join(days, F.to_date(F.col(date_col)) == F.col("_day"), "left")
    return joined.withColumn(out, F.coalesce(F.col("_key"), date_id(F.to_date(F.col(date_col))))).drop("_day", "_key")
