"""Series work: latest, sampling, summaries, unions, de-duplication, returns, chart data."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.functions.times import session_date
from tickloom.operators import charts, clean, updates
from tickloom.operators.bars import latest_per_symbol
from tickloom.plans.registry import query
from tickloom.plans.tables import FEED, TICKS, bars_sql, feed_table, table, ticks


@query(
    TICKS
    + """ SELECT stock, max(ts) AS ts, arg_max(price, row(ts, event_id)) AS price,
arg_max(event_id, row(ts, event_id)) AS event_id FROM ticks GROUP BY stock"""
)
def latest_bar_per_symbol(spark: SparkSession, folder: str) -> DataFrame:
    return latest_per_symbol(ticks(spark, folder), ["ts", "event_id"], ["ts", "price", "event_id"])


@query(
    TICKS
    + """,
numbered AS (
  SELECT stock, ts, price, event_id,
         row_number() OVER (PARTITION BY stock ORDER BY ts, event_id) - 1 AS rn,
         count(*) OVER (PARTITION BY stock) AS n
  FROM ticks
)
SELECT stock, ts, price, event_id FROM numbered WHERE rn % greatest(1, n // 1000) = 0"""
)
def stride_sample(spark: SparkSession, folder: str) -> DataFrame:
    rows = ticks(spark, folder).select("stock", "ts", "price", "event_id")
    return charts.stride_sample(rows, ["stock"], ["ts", "event_id"])


@query(
    TICKS
    + """,
q AS (
  SELECT stock, count(*) AS n, quantile_cont(price, 0.25) AS q1, quantile_cont(price, 0.5) AS median,
         quantile_cont(price, 0.75) AS q3
  FROM ticks GROUP BY stock
)
SELECT stock, n, round(q1, 6) AS q1, round(median, 6) AS median, round(q3, 6) AS q3,
       min(CASE WHEN price >= q1 - 1.5 * (q3 - q1) AND price <= q3 + 1.5 * (q3 - q1) THEN price END) AS whisker_low,
       max(CASE WHEN price >= q1 - 1.5 * (q3 - q1) AND price <= q3 + 1.5 * (q3 - q1) THEN price END) AS whisker_high,
       count(CASE WHEN price < q1 - 1.5 * (q3 - q1) OR price > q3 + 1.5 * (q3 - q1) THEN 1 END) AS outliers
FROM ticks JOIN q USING (stock) GROUP BY ALL"""
)
def box_summary(spark: SparkSession, folder: str) -> DataFrame:
    boxes = charts.box_summary(ticks(spark, folder).select("stock", "price"), ["stock"], "price")
    return boxes.withColumns({c: F.round(c, 6) for c in ["q1", "median", "q3"]})


@query(TICKS + " SELECT event_id, ts, stock, price FROM ticks ORDER BY ts, event_id LIMIT 5")
def first_rows(spark: SparkSession, folder: str) -> DataFrame:
    rows = ticks(spark, folder).select("event_id", "ts", "stock", "price")
    return charts.first_rows(rows, ["ts", "event_id"], 5)


@query(TICKS + " SELECT event_id, ts, price FROM ticks ORDER BY ts, event_id LIMIT 1000")
def first_n_bars(spark: SparkSession, folder: str) -> DataFrame:
    rows = ticks(spark, folder).select("event_id", "ts", "price")
    return charts.first_rows(rows, ["ts", "event_id"])


@query(
    TICKS
    + """ SELECT stock, ts, price FROM ticks
UNION ALL SELECT o_orderpriority, o_orderdate, o_totalprice FROM orders"""
)
def union_all_symbols(spark: SparkSession, folder: str) -> DataFrame:
    """Two series tables put together by column name."""
    orders = table(spark, folder, "orders").select(
        F.col("o_totalprice").alias("price"),
        F.col("o_orderdate").alias("ts"),
        F.col("o_orderpriority").alias("stock"),
    )
    return updates.union_all([ticks(spark, folder).select("stock", "ts", "price"), orders])


@query(
    TICKS
    + """ SELECT stock, strftime(ts, '%Y-%m-%d') AS day, arg_max(ts, row(ts, event_id)) AS ts,
arg_max(price, row(ts, event_id)) AS price, arg_max(event_id, row(ts, event_id)) AS event_id
FROM ticks GROUP BY ALL"""
)
def updates_only(spark: SparkSession, folder: str) -> DataFrame:
    """Per symbol and day the last value only."""
    day = F.date_format("ts", "yyyy-MM-dd").alias("day")
    rows = ticks(spark, folder).select("stock", day, "ts", "price", "event_id")
    return updates.last_per_key(rows, ["stock", "day"], ["ts", "event_id"])


@query(
    TICKS
    + """ SELECT stock, event_id, round(price / first_value(price)
OVER (PARTITION BY stock ORDER BY ts, event_id) - 1, 6) AS "return" FROM ticks"""
)
def relative_returns(spark: SparkSession, folder: str) -> DataFrame:
    rows = ticks(spark, folder).select("stock", "ts", "event_id", "price")
    returns = charts.relative_returns(rows, ["stock"], ["ts", "event_id"], "price")
    return returns.select("stock", "event_id", F.round("return", 6).alias("return"))


@query(FEED + """ SELECT "Date", "Close" FROM feed_table WHERE stock = 'click'""")
def close_series(spark: SparkSession, folder: str) -> DataFrame:
    return charts.symbol_series(feed_table(spark, folder), "click")


_LONG_SQL = """,
long AS (
  SELECT stock, "Date", 'Open' AS series, "Open" AS value FROM feed_table
  UNION ALL SELECT stock, "Date", 'High', "High" FROM feed_table
  UNION ALL SELECT stock, "Date", 'Low', "Low" FROM feed_table
  UNION ALL SELECT stock, "Date", 'Close', "Close" FROM feed_table
)"""


@query(FEED + _LONG_SQL + " SELECT * FROM long")
def series_unpivot(spark: SparkSession, folder: str) -> DataFrame:
    return charts.long_series(feed_table(spark, folder), ["stock", "Date"], ["Open", "High", "Low", "Close"])


@query(
    FEED
    + _LONG_SQL
    + """ SELECT stock, "Date", series, value, chart
FROM long, (VALUES ('Line Chart'), ('Bar Chart')) c(chart) WHERE series <> 'Open'"""
)
def chart_series_selected(spark: SparkSession, folder: str) -> DataFrame:
    """Two of the three chart types chosen."""
    rows = feed_table(spark, folder)
    return charts.selected_charts(rows, ["Line Chart", "Bar Chart"], ["stock", "Date"])


@query(TICKS + bars_sql("1 day") + " SELECT * FROM bars WHERE stock = 'purchase'")
def candlestick_1d(spark: SparkSession, folder: str) -> DataFrame:
    return charts.candles(ticks(spark, folder), "purchase")


@query(
    FEED
    + """ SELECT substr("Date", 1, 10) AS day, round(avg("Open"), 6) AS open FROM feed_table
WHERE "Open" IS NOT NULL GROUP BY 1"""
)
def bar_points(spark: SparkSession, folder: str) -> DataFrame:
    rows = clean.not_null(feed_table(spark, folder))
    dated = rows.select(session_date(F.col("Date")).cast("string").alias("day"), F.col("Open").alias("open"))
    return charts.mean_per_x(dated, "day", "open").withColumn("open", F.round("open", 6))
