"""Hourly calendar that ends on a given day."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tenantlens.functions.columns import calendar_attributes
from tenantlens.schemas import CALENDAR_DAYS_BACK


def calendar_hours(
    spark: SparkSession, today: dt.date, days_back: int = CALENDAR_DAYS_BACK
) -> DataFrame:
    """One row per hour from ``days_back`` days ago 00:00 to today 23:00."""
    first = F.lit((today - dt.timedelta(days=days_back)).isoformat()).cast("timestamp")
    hours = spark.range((days_back + 1) * 24)
    return hours.select(
        F.timestamp_seconds(F.unix_timestamp(first) + F.col("id") * 3600).alias("start_of_hour")
    )


def calendar_table(hours: DataFrame) -> DataFrame:
    attributes = calendar_attributes("start_of_hour")
    return hours.select("start_of_hour", *[c.alias(n) for n, c in attributes.items()])
