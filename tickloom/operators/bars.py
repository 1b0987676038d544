"""Forming price bars from ticks, and the latest row per symbol."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.operators.updates import last_per_key


def ohlc_bars(
    ticks: DataFrame,
    interval: str = "2 minutes",
    ts: str = "ts",
    price: str = "price",
    tie_break: str | None = "event_id",
) -> DataFrame:
    """Open, high, low, close and tick count per symbol and interval.

    Equal times are ordered by ``tie_break``. With ``tie_break=None`` (times unique per symbol) the
    are combined before the shuffle, so a hot symbol sends one row per bar and input task.
    """
    order = F.col(ts) if tie_break is None else F.struct(ts, tie_break)
    # Grouped by the window itself: its end is what lets a stream's state expire.
    bars = ticks.groupBy("stock", F.window(ts, interval).alias("__window")).agg(
        F.min_by(price, order).alias("open"),
        F.max(price).alias("high"),
        F.min(price).alias("low"),
        F.max_by(price, order).alias("close"),
        F.count("*").cast("double").alias("volume"),
    )
    return bars.select("stock", F.col("__window.start").alias("bar_start"), "open", "high", "low", "close", "volume")


def bar_states(
    ticks: DataFrame, interval: str = "2 minutes", ts: str = "ts", price: str = "price", tie_break: str = "event_id"
) -> DataFrame:
    """Partial bars (stock, bar_start, first, last, high, low, count), which ``merge_states`` adds up in any order."""
    place = F.struct(F.col(ts).alias("at"), F.col(tie_break).alias("tie"), F.col(price).alias("price"))
    return (
        ticks.groupBy("stock", F.window(ts, interval).alias("__window"))
        .agg(
            F.min(place).alias("first"),
            F.max(place).alias("last"),
            F.max(price).alias("high"),
            F.min(price).alias("low"),
            F.count("*").alias("count"),
        )
        .select("stock", F.col("__window.start").alias("bar_start"), "first", "last", "high", "low", "count")
    )


def merge_states(states: DataFrame) -> DataFrame:
    """One state per symbol and bar from any number of partial ones."""
    return states.groupBy("stock", "bar_start").agg(
        F.min("first").alias("first"),
        F.max("last").alias("last"),
        F.max("high").alias("high"),
        F.min("low").alias("low"),
        F.sum("count").alias("count"),
    )


def bars_of_states(states: DataFrame) -> DataFrame:
    """Merged states as bars, equal to ``ohlc_bars`` over all their ticks."""
    return states.select(
        "stock",
        "bar_start",
        F.col("first.price").alias("open"),
        "high",
        "low",
        F.col("last.price").alias("close"),
        F.col("count").cast("double").alias("volume"),
    )


def latest_per_symbol(df: DataFrame, order: list[str], columns: list[str], key: str = "stock") -> DataFrame:
    """The newest row of each symbol, as an aggregate instead of a sort of each symbol's rows."""
    needed = list(dict.fromkeys([key, *order, *columns]))
    return last_per_key(df.select(*needed), [key], order).select(key, *columns)


def bar_table(bars: DataFrame, date: Column) -> DataFrame:
    """Lower-case bars as the stored table: Date, Open, High, Low, Close, Volume and ``stock``."""
    return bars.select(
        date.alias("Date"),
        F.col("open").alias("Open"),
        F.col("high").alias("High"),
        F.col("low").alias("Low"),
        F.col("close").alias("Close"),
        F.col("volume").alias("Volume"),
        "stock",
    )
