"""Sinks, each read back."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.functions.times import iso_text, parse_time
from tickloom.operators.bars import ohlc_bars
from tickloom.operators.messages import bar_to_message, to_messages, to_text_messages
from tickloom.operators.updates import history_then_live
from tickloom.plans.registry import query
from tickloom.plans.tables import FEED, TICKS, bars, bars_sql, feed_table, ticks
from tickloom.schemas import QUOTE_DOCUMENT, TICK_TABLE
from tickloom.sinks.files import (
    append_bars_by_symbol,
    append_ticks,
    pretty_document,
    write_snapshot,
    write_table_csv,
)
from tickloom.sources.files import read_all_symbols
from tickloom.sources.ranges import between, latest_time
from tickloom.storage import new_path

SPLIT_AT = "2024-01-16"


@query(
    FEED
    + """ SELECT stock AS key, CAST(to_json({stock: stock, date: "Date", open: "Open", high: "High",
low: "Low", close: "Close", volume: "Volume"}) AS VARCHAR) AS value FROM feed_table"""
)
def bars_to_json_messages(spark: SparkSession, folder: str) -> DataFrame:
    rows = feed_table(spark, folder)
    return to_messages(bar_to_message(rows, F.col("Date"), F.col("stock")))


@query(TICKS + " SELECT stock AS key, CAST(price AS VARCHAR) AS value FROM ticks")
def ticks_to_text_messages(spark: SparkSession, folder: str) -> DataFrame:
    return to_text_messages(ticks(spark, folder), "stock", "price")


@query(
    FEED
    + """ SELECT bar_start AS "Date", open AS "Open", high AS "High", low AS "Low", close AS "Close",
volume AS "Volume", stock AS "Stock" FROM feed"""
)
def sink_csv_by_symbol(spark: SparkSession, folder: str) -> DataFrame:
    """Two appends to the per-symbol store, read back whole."""
    store = new_path(spark, "store")
    rows = feed_table(spark, folder)
    append_bars_by_symbol(rows.filter(F.col("Date") < SPLIT_AT), store)
    append_bars_by_symbol(rows.filter(F.col("Date") >= SPLIT_AT), store)
    stored = read_all_symbols(spark, store, partitioned=True)
    return stored.withColumn("Date", parse_time(F.col("Date")).cast("timestamp_ntz"))


@query(TICKS + " SELECT CAST(price AS VARCHAR) AS price, true AS has_time FROM ticks")
def sink_tick_csv_append(spark: SparkSession, folder: str) -> DataFrame:
    """Two appends of ticks; the arrival time itself is a clock reading and only tested for presence."""
    store = new_path(spark, "ticks")
    rows = ticks(spark, folder)
    cut = F.lit(SPLIT_AT).cast("timestamp_ntz")
    append_ticks(rows.filter(F.col("ts") < cut), store, "price")
    append_ticks(rows.filter(F.col("ts") >= cut), store, "price")
    stored = spark.read.schema(TICK_TABLE).option("header", True).csv(store)
    return stored.select("price", F.to_timestamp("time").isNotNull().alias("has_time"))


def quote_document(price):
    """A quote in the vendor's nesting around a price."""
    meta = F.struct(F.struct(price.alias("regularMarketPrice")).alias("meta"))
    return F.struct(F.array(meta).alias("result")).alias("chart")


@query(
    TICKS
    + " SELECT arg_max(price, row(ts, event_id)) AS price FROM ticks"
)
def sink_json_snapshot(spark: SparkSession, folder: str) -> DataFrame:
    """Write an early document, then replace it by the last one."""
    path = new_path(spark, "snapshot")
    rows = ticks(spark, folder)
    for part in (rows.filter(F.col("ts") < F.lit(SPLIT_AT).cast("timestamp_ntz")), rows):
        last = part.agg(F.max_by("price", F.struct("ts", "event_id")).alias("price"))
        document = last.select(pretty_document(quote_document(F.col("price"))).alias("document"))
        write_snapshot(document, path)
    stored = spark.read.schema(QUOTE_DOCUMENT).json(path, multiLine=True)
    return stored.select(F.col("chart.result")[0]["meta"]["regularMarketPrice"].alias("price"))


@query(
    TICKS
    + bars_sql("1 day")
    + """ SELECT strftime(bar_start, '%Y-%m-%dT%H:%M:%S') AS "Date", stock, open, high, low, close, volume
FROM bars"""
)
def sink_csv_table(spark: SparkSession, folder: str) -> DataFrame:
    """A whole daily table with its date first, written over an older copy."""
    path = new_path(spark, "table")
    daily = ohlc_bars(ticks(spark, folder), "1 day")
    dated = daily.withColumn("Date", iso_text(F.col("bar_start"))).drop("bar_start")
    write_table_csv(dated.filter(F.col("Date") < SPLIT_AT), path, "Date")
    write_table_csv(dated, path, "Date")
    columns = "Date string, stock string, open double, high double, low double, close double, volume double"
    return spark.read.schema(columns).option("header", True).csv(path)


@query(
    TICKS
    + bars_sql("1 hour")
    + " SELECT * FROM bars"
)
def history_plus_live(spark: SparkSession, folder: str) -> DataFrame:
    """A backfill and a live part that overlap by a day: every bar once."""
    rows = bars(spark, folder)
    end = latest_time(ticks(spark, folder))
    day = F.expr("INTERVAL 1 DAY")
    history = rows.filter(F.col("bar_start") < end - day)
    live = between(rows, end - day * 2, end + day, "bar_start")
    return history_then_live(history, live, ["stock", "bar_start"])
