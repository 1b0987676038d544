"""Sources and ranges."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.operators.bars import ohlc_bars
from tickloom.operators.clean import drop_missing
from tickloom.plans.registry import query
from tickloom.plans.tables import BARS, FEED, TICKS, bars, bars_sql, feed_table, ticks
from tickloom.sinks.files import append_bars_by_symbol
from tickloom.sources.files import load_symbol, read_all_symbols, read_bars_inferred, symbol_path
from tickloom.sources.ranges import (
    between,
    history_start,
    latest_time,
    look_back,
    of_symbols,
    since,
)
from tickloom.storage import new_path

SYMBOL = "click"
UNIVERSE = "click,view,unlisted"


def _store_symbol(spark: SparkSession, folder: str) -> str:
    """The feed of one symbol as ``<new folder>/<symbol>.csv``."""
    store = new_path(spark, "store")
    one = feed_table(spark, folder).filter(F.col("stock") == SYMBOL).drop("stock")
    one.write.option("header", True).option("nullValue", "None").csv(symbol_path(store, SYMBOL))
    return store


@query(BARS + " SELECT * FROM bars")
def ohlc_bars_1h(spark: SparkSession, folder: str) -> DataFrame:
    return bars(spark, folder, "1 hour")


@query(TICKS + bars_sql("2 minutes") + " SELECT * FROM bars")
def ohlc_bars_2m(spark: SparkSession, folder: str) -> DataFrame:
    return bars(spark, folder, "2 minutes")


@query(
    FEED
    + f""" SELECT "Date", "Open", "High", "Low", "Close", "Volume" FROM feed_table WHERE stock = '{SYMBOL}'"""
)
def scan_csv_schema(spark: SparkSession, folder: str) -> DataFrame:
    return load_symbol(spark, _store_symbol(spark, folder), SYMBOL)


@query(
    FEED
    + f""" SELECT CAST("Date" AS TIMESTAMP) AS "Date", "Open", "High", "Low", "Close", "Volume"
FROM feed_table WHERE stock = '{SYMBOL}'"""
)
def scan_csv_infer(spark: SparkSession, folder: str) -> DataFrame:
    store = _store_symbol(spark, folder)
    inferred = read_bars_inferred(spark, symbol_path(store, SYMBOL))
    return inferred.withColumn("Date", F.col("Date").cast("timestamp_ntz"))


@query(
    FEED
    + """ SELECT "Date", "Open", "High", "Low", "Close", "Volume", stock AS "Stock" FROM feed_table"""
)
def scan_csv_all_symbols(spark: SparkSession, folder: str) -> DataFrame:
    store = new_path(spark, "store")
    append_bars_by_symbol(feed_table(spark, folder), store)
    return read_all_symbols(spark, store, partitioned=True)


@query(
    TICKS
    + f""",
limits AS (SELECT max(ts) AS as_of FROM ticks),
start AS (SELECT CAST(CAST(min(ts) AS DATE) AS TIMESTAMP) AS s FROM ticks, limits
  WHERE stock = '{SYMBOL}' AND ts >= as_of - INTERVAL 1 MONTH),
ranged AS (SELECT ticks.* FROM ticks, limits, start
  WHERE ts >= s AND ts < as_of AND stock IN ('click', 'view', 'unlisted'))"""
    + bars_sql("2 minutes", "ranged")
    + " SELECT * FROM bars"
)
def bars_history_range(spark: SparkSession, folder: str) -> DataFrame:
    all_ticks = ticks(spark, folder)
    as_of = latest_time(all_ticks)
    first_day = history_start(all_ticks, SYMBOL, as_of)
    start = first_day.select(F.col("start_date").cast("timestamp_ntz")).scalar()
    history = between(of_symbols(all_ticks, UNIVERSE), start, as_of)
    return drop_missing(ohlc_bars(history, "2 minutes"), ["open", "high", "low", "close", "volume"])


@query(
    TICKS
    + f""" SELECT strftime(min(ts), '%Y-%m-%d') AS start_date FROM ticks
WHERE stock = '{SYMBOL}' AND ts >= (SELECT max(ts) FROM ticks) - INTERVAL 1 MONTH"""
)
def history_start_date(spark: SparkSession, folder: str) -> DataFrame:
    all_ticks = ticks(spark, folder)
    return history_start(all_ticks, SYMBOL, latest_time(all_ticks))


@query(
    TICKS
    + """ SELECT stock, ts, price, event_id FROM ticks
WHERE ts > (SELECT max(ts) FROM ticks) - INTERVAL 60 MINUTE AND ts <= (SELECT max(ts) FROM ticks)"""
)
def bars_live_lookback(spark: SparkSession, folder: str) -> DataFrame:
    rows = ticks(spark, folder).select("stock", "ts", "price", "event_id")
    return look_back(rows, latest_time(rows), minutes=60)


@query(
    TICKS
    + bars_sql("1 day")
    + f""" SELECT * FROM bars WHERE stock = '{SYMBOL}' AND bar_start >= TIMESTAMP '2024-01-10'"""
)
def bars_since_date(spark: SparkSession, folder: str) -> DataFrame:
    start = F.lit("2024-01-10").cast("timestamp_ntz")
    return ohlc_bars(since(ticks(spark, folder), SYMBOL, start), "1 day")


@query(
    TICKS
    + """ SELECT stock, count(*) AS n, min(ts) AS first_ts, max(ts) AS last_ts FROM ticks
WHERE stock IN (SELECT unnest(string_split('click,view,unlisted', ','))) GROUP BY stock"""
)
def symbol_universe(spark: SparkSession, folder: str) -> DataFrame:
    return (
        of_symbols(ticks(spark, folder), UNIVERSE)
        .groupBy("stock")
        .agg(F.count("*").alias("n"), F.min("ts").alias("first_ts"), F.max("ts").alias("last_ts"))
    )


@query(
    FEED
    + f""" SELECT '{SYMBOL}' AS "Stock", "Date", "Open", "Close" FROM feed_table"""
)
def literal_symbol_column(spark: SparkSession, folder: str) -> DataFrame:
    every = feed_table(spark, folder).select("Date", "Open", "Close")
    return every.withColumn("Stock", F.lit(SYMBOL))
