"""Ticks, bars and the session feed derived from the supplied tables, in Spark and in check SQL."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.functions.times import iso_text
from tickloom.operators.bars import bar_table, ohlc_bars
from tickloom.operators.market import session_feed


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def ticks(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "events").select(
        F.col("event_type").alias("stock"), "ts", F.col("value").alias("price"), "event_id", "props"
    )


def bars(spark: SparkSession, folder: str, interval: str = "1 hour") -> DataFrame:
    return ohlc_bars(ticks(spark, folder), interval)


def feed(spark: SparkSession, folder: str, interval: str = "1 hour") -> DataFrame:
    """Bars with null measures outside the trading session."""
    return session_feed(bars(spark, folder, interval))


def feed_table(spark: SparkSession, folder: str, interval: str = "1 hour") -> DataFrame:
    """The feed in the stored layout: Date text, title-case measures, stock."""
    return bar_table(feed(spark, folder, interval), iso_text(F.col("bar_start")))


# The same tables for the checks; each starts or continues a WITH list.
TICKS = """
WITH ticks AS (
  SELECT event_type AS stock, ts, value AS price, event_id, props FROM events
)"""

SESSION = """(isodow({t} - INTERVAL 4 HOUR) <= 5
  AND CAST({t} - INTERVAL 4 HOUR AS TIME) >= TIME '09:30:00'
  AND CAST({t} - INTERVAL 4 HOUR AS TIME) < TIME '16:00:00')"""


def bars_sql(interval: str = "1 hour", source: str = "ticks", name: str = "bars") -> str:
    return f""",
{name} AS (
  SELECT stock, time_bucket(INTERVAL '{interval}', ts) AS bar_start,
         arg_min(price, row(ts, event_id)) AS open, max(price) AS high, min(price) AS low,
         arg_max(price, row(ts, event_id)) AS close, CAST(count(*) AS DOUBLE) AS volume
  FROM {source} GROUP BY ALL
)"""


FEED = (
    TICKS
    + bars_sql()
    + """,
feed AS (
  SELECT stock, bar_start, """
    + ", ".join(
        f"CASE WHEN {SESSION.format(t='bar_start')} THEN {c} END AS {c}"
        for c in ["open", "high", "low", "close", "volume"]
    )
    + """
  FROM bars
),
feed_table AS (
  SELECT strftime(bar_start, '%Y-%m-%dT%H:%M:%S') AS "Date", open AS "Open", high AS "High",
         low AS "Low", close AS "Close", volume AS "Volume", stock
  FROM feed
)"""
)
BARS = TICKS + bars_sql()
