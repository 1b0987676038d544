"""Open and closed sessions: live rows while open, null heartbeats while closed."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.functions.times import market_open
from tickloom.sources.ranges import of_symbols, symbol_list

BAR_MEASURES = ["open", "high", "low", "close", "volume"]


def session_feed(bars: DataFrame, ts: str = "bar_start", measures: list[str] = BAR_MEASURES, **session) -> DataFrame:
    """Bars whose measures are null outside the trading session."""
    is_open = market_open(F.col(ts), **session)
    return bars.withColumns({c: F.when(is_open, F.col(c)) for c in measures})


def heartbeats(times: DataFrame, symbols: str | None, ts: str = "ts", **session) -> DataFrame:
    """One row without measures per symbol for every time the market is closed; batch or stream.

    The symbols come as an argument and are laid out with ``explode``, so there is no join.
    """
    listed = F.array(*[F.lit(s) for s in symbol_list(symbols)]).cast("array<string>")
    closed = times.filter(~market_open(F.col(ts), **session))
    return closed.select(
        F.explode(listed).alias("stock"),
        F.col(ts).alias("date"),
        *[F.lit(None).cast("double").alias(c) for c in BAR_MEASURES],
    )


def live_or_heartbeat(
    bars: DataFrame, polls: DataFrame, symbols: str | None, ts: str = "bar_start", **session
) -> DataFrame:
    """Bars of the listed symbols while the market is open, heartbeats at the polls while it is closed."""
    live = of_symbols(bars, symbols).filter(market_open(F.col(ts), **session))
    live = live.select("stock", F.col(ts).alias("date"), *BAR_MEASURES)
    return live.unionByName(heartbeats(polls, symbols, ts, **session))


def has_rows(df: DataFrame, symbol: str | Column, key: str = "stock") -> bool:
    """Whether a symbol has any row; reads no more than needed to find one."""
    return not df.filter(F.col(key) == symbol).isEmpty()
