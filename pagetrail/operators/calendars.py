"""Calendar rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.fixed import CALENDAR_END, CALENDAR_START


def calendar(
    spark: SparkSession, start: str = CALENDAR_START, end: str = CALENDAR_END
) -> DataFrame:
    """One row per day from start to end, both included."""
    bounds = spark.range(1).select(
        F.lit(start).cast("date").alias("start"), F.lit(end).cast("date").alias("end")
    )
    return calendar_between(bounds, F.col("start"), F.col("end"))


def calendar_between(bounds: DataFrame, start: Column, end: Column) -> DataFrame:
    """Calendar attributes of every day between the two dates of a one-row DataFrame."""
    days = bounds.select(F.explode(F.sequence(start, end)).alias("date"))
    return days.selectExpr("date", *[f"{sql} AS {name}" for name, sql in attributes("date").items()])


def attributes(day: str) -> dict[str, str]:
    """SQL of each calendar attribute of a date."""
    weekday, quarter_start = f"dayofweek({day})", f"trunc({day}, 'quarter')"
    return {
        "year": f"cast(year({day}) AS bigint)",
        "quarter": f"cast(quarter({day}) AS bigint)",
        "month": f"cast(month({day}) AS bigint)",
        "day": f"cast(dayofmonth({day}) AS bigint)",
        "day_of_week": f"cast({weekday} AS bigint)",
        # weeks start on Sunday; days before the year's first Sunday are week 0
        "week_of_year": f"(dayofyear({day}) + 7 - {weekday}) div 7",
        "day_name": f"date_format({day}, 'EEEE')",
        "month_name": f"date_format({day}, 'MMMM')",
        "year_month": f"date_format({day}, 'yyyy-MM')",
        "year_quarter": f"concat(year({day}), '-Q', quarter({day}))",
        "is_weekend": f"{weekday} IN (1, 7)",
        "is_weekday": f"{weekday} IN (2, 3, 4, 5, 6)",
        "month_start": f"trunc({day}, 'month')",
        "month_end": f"last_day({day})",
        "quarter_start": quarter_start,
        "quarter_end": f"last_day(add_months({quarter_start}, 2))",
        "year_start": f"trunc({day}, 'year')",
        "approx_year_end": f"date_add(trunc({day}, 'year'), 364)",
    }
