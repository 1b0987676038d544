"""Time ranges and symbol lists over tick or bar tables."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def latest_time(df: DataFrame, ts: str = "ts") -> Column:
    """The newest time in the table as a scalar; stands in for the clock, so results can be repeated."""
    return df.agg(F.max(ts)).scalar()


def between(df: DataFrame, start: Column, end: Column, ts: str = "ts") -> DataFrame:
    """Rows with start <= time < end."""
    return df.filter((F.col(ts) >= start) & (F.col(ts) < end))


def since(df: DataFrame, symbol: str, start: Column, ts: str = "ts", key: str = "stock") -> DataFrame:
    """One symbol's rows from a start time on."""
    return df.filter((F.col(key) == symbol) & (F.col(ts) >= start))


def look_back(df: DataFrame, as_of: Column, minutes: int = 1, ts: str = "ts") -> DataFrame:
    """Rows of the last ``minutes`` up to and including ``as_of``."""
    start = as_of - F.expr(f"INTERVAL {minutes} MINUTES")
    return df.filter((F.col(ts) > start) & (F.col(ts) <= as_of))


def history_start(df: DataFrame, symbol: str, as_of: Column, ts: str = "ts", key: str = "stock") -> DataFrame:
    """Day of the symbol's first row within the month before ``as_of``."""
    month = df.filter((F.col(key) == symbol) & (F.col(ts) >= as_of - F.expr("INTERVAL 1 MONTH")))
    return month.agg(F.date_format(F.min(ts), "yyyy-MM-dd").alias("start_date"))


def symbol_list(symbols: str | None) -> list[str]:
    """A comma list of symbols; an empty one gives no symbols."""
    return symbols.split(",") if symbols else []


def of_symbols(df: DataFrame, symbols: str | None, key: str = "stock") -> DataFrame:
    """Rows of the listed symbols; an empty list gives no rows."""
    return df.filter(F.col(key).isin(symbol_list(symbols)))
