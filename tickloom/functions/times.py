"""Time expressions. Timestamps are UTC; zone-less columns are read as UTC."""

from pyspark.sql import Column
from pyspark.sql import functions as F

# The trading session in exchange time and the exchange's fixed offset from UTC.
SESSION_OPEN = "09:30"
SESSION_CLOSE = "16:00"
EXCHANGE_OFFSET_HOURS = -4


def _minutes(clock: str) -> int:
    hours, minutes = clock.split(":")
    return int(hours) * 60 + int(minutes)


def utc(ts: Column) -> Column:
    """A time without zone in UTC, whatever the session's zone: zoned times are converted, others are UTC."""
    bare = ts.cast("timestamp_ntz")
    converted = F.convert_timezone(F.current_timezone(), F.lit("UTC"), bare)
    return F.when(F.typeof(ts) == "timestamp", converted).otherwise(bare)


def exchange_time(ts: Column, offset_hours: int = EXCHANGE_OFFSET_HOURS, zone: str | None = None) -> Column:
    """Shift UTC to exchange time by a fixed offset, or by a named zone with daylight saving."""
    if zone is not None:
        return F.convert_timezone(F.lit("UTC"), F.lit(zone), utc(ts))
    return utc(ts) + F.expr(f"INTERVAL '{offset_hours}' HOUR")


def market_open(
    ts: Column,
    opens: str = SESSION_OPEN,
    closes: str = SESSION_CLOSE,
    offset_hours: int = EXCHANGE_OFFSET_HOURS,
    zone: str | None = None,
) -> Column:
    """Weekday and opens <= time of day < closes; a missing time means now."""
    local = exchange_time(F.coalesce(utc(ts), utc(F.current_timestamp())), offset_hours, zone)
    minute = F.hour(local) * 60 + F.minute(local)
    return (F.weekday(local) < 5) & (minute >= _minutes(opens)) & (minute < _minutes(closes))


def iso_text(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss")


def clock_text(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd HH:mm:ss")


def day_text(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd")


def parse_time(text: Column) -> Column:
    """ISO text, with or without offset, to a timestamp; unreadable text gives null."""
    return F.try_to_timestamp(text)


def session_date(text: Column) -> Column:
    """Calendar date of a bar in the session time zone."""
    return F.to_date(parse_time(text))


def exchange_date(text: Column) -> Column:
    """Calendar date as written in the text, i.e. in the zone the exchange stamped it with."""
    return F.try_to_date(F.substring(text, 1, 10))
