"""Time parsing, buckets and calendar features."""

from __future__ import annotations

import math

from pyspark.sql import Column, functions as F

LOCAL_ZONE = "Asia/Ho_Chi_Minh"

# Peak hours of the panel path and of the lake path.
PEAK_HOURS = (7, 8, 9, 16, 17, 18, 19)
LAKE_PEAK_HOURS = (7, 8, 9, 11, 12, 13, 17, 18, 19)

# Public holidays.
HOLIDAYS = (
    "2024-01-01", "2024-02-10", "2024-02-11", "2024-02-12", "2024-02-13", "2024-04-18", "2024-04-30", "2024-05-01",
    "2024-09-02", "2024-09-03",
    "2025-01-01", "2025-01-29", "2025-01-30", "2025-01-31", "2025-02-01", "2025-02-02", "2025-04-18", "2025-04-30",
    "2025-05-01", "2025-09-02", "2025-09-03",
    "2026-01-01", "2026-02-17", "2026-02-18", "2026-02-19", "2026-02-20", "2026-02-21", "2026-04-18", "2026-04-30",
    "2026-05-01", "2026-09-02", "2026-09-03",
)


def epoch(ts: Column) -> Column:
    """Whole seconds since 1970 of a zone-less or zoned timestamp (session zone is UTC)."""
    return F.unix_seconds(ts.cast("timestamp"))


def epoch_micros(ts: Column) -> Column:
    return F.unix_micros(ts.cast("timestamp"))


def from_epoch(seconds: Column) -> Column:
    return F.timestamp_seconds(seconds).cast("timestamp_ntz")


def parse_utc(text: Column) -> Column:
    """ISO text with or without offset → UTC instant; bad text → null."""
    return text.try_cast("timestamp")


def local_wall_time(text: Column, zone: str = LOCAL_ZONE) -> Column:
    """ISO text → local time without zone."""
    return F.from_utc_timestamp(parse_utc(text), zone).cast("timestamp_ntz")


def local_to_utc(wall: Column, zone: str = LOCAL_ZONE) -> Column:
    return F.to_utc_timestamp(wall.cast("timestamp"), zone)


def shift_hours(ts: Column, hours: int = 7) -> Column:
    """Fixed offset, cut to whole seconds."""
    return F.date_trunc("second", ts + F.expr(f"INTERVAL {hours} HOURS"))


def floor_bucket(ts: Column, minutes: int) -> Column:
    """Start of the N-minute bucket counted from the epoch."""
    size = minutes * 60
    return from_epoch(F.floor(epoch(ts) / size) * size)


def floor_within_hour(ts: Column, minutes: int) -> Column:
    """Collector variant: the grid restarts each hour."""
    hour = F.date_trunc("hour", ts)
    return from_epoch(epoch(hour) + F.floor(F.minute(ts) / minutes) * minutes * 60)


def calendar(ts: Column, peak: tuple[int, ...] = PEAK_HOURS) -> dict[str, Column]:
    """Clock and calendar features; weekday runs from Monday = 0."""
    return {
        "hour_of_day": F.hour(ts),
        "day_of_week": F.weekday(ts),
        "day_of_month": F.dayofmonth(ts),
        "month_of_year": F.month(ts),
        "week_of_year": F.weekofyear(ts),
        "date": F.date_format(ts, "yyyy-MM-dd"),
        "is_weekend": F.weekday(ts).isin(5, 6).cast("int"),
        "is_peak_hour": F.hour(ts).isin(*peak).cast("int"),
    }


def is_holiday(ts: Column, days: tuple[str, ...] = HOLIDAYS) -> Column:
    return F.date_format(ts, "yyyy-MM-dd").isin(*days).cast("int")


def cyclic(value: Column, period: int) -> tuple[Column, Column]:
    angle = value * (2 * math.pi / period)
    return F.sin(angle), F.cos(angle)


def text_date(text: Column, year: Column) -> Column:
    """First d/m/yyyy in the text, else first d/m in ``year``; invalid dates give null."""
    full = r"\b(\d{1,2})[/-](\d{1,2})[/-](20\d{2})\b"
    short = r"\b(\d{1,2})[/-](\d{1,2})\b"

    def build(pattern: str, year_col: Column) -> Column:
        day, month = F.regexp_extract(text, pattern, 1), F.regexp_extract(text, pattern, 2)
        stamp = F.concat_ws("-", year_col.cast("string"), F.lpad(month, 2, "0"), F.lpad(day, 2, "0"))
        return stamp.try_cast("timestamp_ntz")

    return F.when(text.rlike(full), build(full, F.regexp_extract(text, full, 3))).when(
        text.rlike(short), build(short, year)
    )


def freshness_seconds(latest: Column, as_of: Column) -> Column:
    """Whole seconds of age, never negative."""
    return F.greatest(F.lit(0).cast("long"), epoch(as_of) - epoch(latest))
