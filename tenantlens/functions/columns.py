"""Column rules of the typed layer. All are built-in JVM expressions."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from tenantlens.schemas import EARLIEST_REAL_DATE, PRINCIPAL_TYPE_CODES


def parse_timestamp(text: Column | str) -> Column:
    """Timestamp of an API string; text that is no timestamp gives NULL."""
    return F.try_to_timestamp(F.col(text) if isinstance(text, str) else text)


def null_before(ts: Column, earliest: str = EARLIEST_REAL_DATE) -> Column:
    """NULL for placeholder dates such as 0001-01-01."""
    return F.when(ts >= F.lit(earliest).cast("timestamp"), ts)


def normalize_code(code: Column, codes: Mapping[str, str] = PRINCIPAL_TYPE_CODES) -> Column:
    """Replace the codes listed, keep all others."""
    renamed = code
    for old, new in codes.items():
        renamed = F.when(code == old, F.lit(new)).otherwise(renamed)
    return renamed


def only_when(condition: Column, value: Column) -> Column:
    """Value where the condition holds, NULL elsewhere."""
    return F.when(condition, value)


def first_present(*candidates: Column | str) -> Column:
    return F.coalesce(*candidates)


def calendar_attributes(hour: str = "start_of_hour") -> dict[str, Column]:
    """Date, hour, full English day name and weekend flag of an hour column."""
    ts = F.col(hour)
    return {
        "date": F.to_date(ts),
        "hour": F.hour(ts),
        "day_of_week": F.date_format(ts, "EEEE"),
        "is_weekend": F.weekday(ts) >= 5,
    }
