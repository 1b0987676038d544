"""Row-wise work: projections, filters, cleaning, messages and scalar functions."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.functions.documents import (
    DETAIL_FIELDS,
    json_path,
    quote_price,
    symbol_details,
    to_json,
)
from tickloom.functions.texts import csv_line, quote_url as url_of, to_bytes, to_text
from tickloom.functions.times import (
    clock_text,
    day_text,
    exchange_date,
    iso_text,
    market_open as is_open,
    parse_time,
    session_date,
)
from tickloom.operators import charts, clean, messages
from tickloom.operators.market import heartbeats, live_or_heartbeat
from tickloom.plans.registry import query
from tickloom.plans.stores import quote_document
from tickloom.plans.tables import FEED, SESSION, TICKS, bars, feed, feed_table, table, ticks
from tickloom.schemas import FEATURES, LABEL, MEASURES

PRICE_COLUMNS = '"Date", "Open", "High", "Low", "Close"'
ALL_COLUMNS = PRICE_COLUMNS + ', "Volume", stock'


@query(FEED + f' SELECT {PRICE_COLUMNS} FROM feed_table WHERE "Open" IS NOT NULL')
def sql_price_columns(spark: SparkSession, folder: str) -> DataFrame:
    feed_table(spark, folder).createOrReplaceTempView("stock")
    return spark.sql("SELECT Date, Open, High, Low, Close FROM stock WHERE Open IS NOT NULL")


@query(FEED + f" SELECT {PRICE_COLUMNS} FROM feed_table")
def project_price_columns(spark: SparkSession, folder: str) -> DataFrame:
    return charts.price_columns(feed_table(spark, folder))


@query(FEED + ' SELECT "Open", "High", "Low", "Volume", "Close" FROM feed_table')
def feature_projection(spark: SparkSession, folder: str) -> DataFrame:
    return feed_table(spark, folder).select(*FEATURES, LABEL)


@query(FEED + f' SELECT {ALL_COLUMNS} FROM feed_table WHERE "Open" IS NOT NULL')
def filter_open_not_null(spark: SparkSession, folder: str) -> DataFrame:
    return clean.not_null(feed_table(spark, folder))


@query(FEED + f" SELECT {ALL_COLUMNS} FROM feed_table WHERE stock = 'view'")
def filter_symbol(spark: SparkSession, folder: str) -> DataFrame:
    return feed_table(spark, folder).filter(F.col("stock") == "view")


_COMPLETE = " AND ".join(f'"{c}" IS NOT NULL' for c in MEASURES)


@query(FEED + f' SELECT {ALL_COLUMNS} FROM feed_table WHERE "Date" IS NOT NULL AND stock IS NOT NULL AND {_COMPLETE}')
def dropna_any(spark: SparkSession, folder: str) -> DataFrame:
    return clean.drop_missing(feed_table(spark, folder))


@query(FEED + f" SELECT {ALL_COLUMNS} FROM feed_table WHERE {_COMPLETE}")
def dropna_subset(spark: SparkSession, folder: str) -> DataFrame:
    return clean.drop_missing(feed_table(spark, folder), MEASURES)


@query(
    FEED
    + ' SELECT "Date", stock, '
    + ", ".join(f'coalesce("{c}", 0.0::DOUBLE) AS "{c}"' for c in MEASURES)
    + " FROM feed_table"
)
def fill_missing_zero(spark: SparkSession, folder: str) -> DataFrame:
    return clean.fill_missing(feed_table(spark, folder))


_ALL_NULL = " AND ".join(f'"{c}" IS NULL' for c in MEASURES)


@query(FEED + f' SELECT {ALL_COLUMNS}, CAST({_ALL_NULL} AS INTEGER) AS "MarketClosed" FROM feed_table')
def market_closed_flag(spark: SparkSession, folder: str) -> DataFrame:
    return clean.flag_closed(feed_table(spark, folder))


def _decimals_as_double(df: DataFrame) -> DataFrame:
    """Decimal values in a type both engines hand over alike."""
    return df.withColumns({c: F.col(c).cast("double") for c in MEASURES})


@query(
    FEED
    + f""" SELECT "Date", stock, CAST(CAST("Open" AS DECIMAL(10,2)) AS DOUBLE) AS "Open",
CAST(CAST("High" AS DECIMAL(10,2)) AS DOUBLE) AS "High", CAST(CAST("Low" AS DECIMAL(10,2)) AS DOUBLE) AS "Low",
CAST(CAST("Close" AS DECIMAL(10,2)) AS DOUBLE) AS "Close",
CAST(TRY_CAST("Volume" * 60000000 AS DECIMAL(10,2)) AS DOUBLE) AS "Volume" FROM feed_table"""
)
def cast_decimal(spark: SparkSession, folder: str) -> DataFrame:
    """Volumes are scaled so that some no longer fit the decimal type."""
    rows = feed_table(spark, folder).withColumn("Volume", F.col("Volume") * 60000000)
    return _decimals_as_double(clean.to_decimals(rows, volume_precision=10))


@query(
    FEED
    + ' SELECT "Date", stock, '
    + ", ".join(
        f'CAST(TRY_CAST(coalesce("{c}", 0.0::DOUBLE) AS DECIMAL(10,2)) AS DOUBLE) AS "{c}"' for c in MEASURES
    )
    + f', CAST({_ALL_NULL} AS INTEGER) AS "MarketClosed" FROM feed_table'
)
def clean_bars(spark: SparkSession, folder: str) -> DataFrame:
    """The whole cleaning chain."""
    return _decimals_as_double(clean.clean_bars(feed_table(spark, folder)))


@query(TICKS + f" SELECT event_id, ts, {SESSION.format(t='ts')} AS open_now FROM ticks")
def market_open(spark: SparkSession, folder: str) -> DataFrame:
    return ticks(spark, folder).select("event_id", "ts", is_open(F.col("ts")).alias("open_now"))


@query(FEED + " SELECT * FROM feed")
def market_session_feed(spark: SparkSession, folder: str) -> DataFrame:
    return feed(spark, folder)


@query(
    FEED
    + """ SELECT stock, count(*) > 0 AS has_rows, count("Open") > 0 AS has_open_rows FROM feed_table GROUP BY stock"""
)
def symbol_has_rows(spark: SparkSession, folder: str) -> DataFrame:
    """The emptiness test for every symbol at once."""
    return (
        feed_table(spark, folder)
        .groupBy("stock")
        .agg((F.count("*") > 0).alias("has_rows"), (F.count("Open") > 0).alias("has_open_rows"))
    )


@query(
    TICKS
    + f""",
closed AS (SELECT DISTINCT time_bucket(INTERVAL '1 hour', ts) AS ts FROM ticks)
SELECT s.stock, c.ts AS date, CAST(NULL AS DOUBLE) AS open, CAST(NULL AS DOUBLE) AS high,
       CAST(NULL AS DOUBLE) AS low, CAST(NULL AS DOUBLE) AS close, CAST(NULL AS DOUBLE) AS volume
FROM closed c, (SELECT unnest(string_split('AAPL,MSFT,GOOGL', ',')) AS stock) s
WHERE NOT {SESSION.format(t='c.ts')}"""
)
def closed_heartbeat_rows(spark: SparkSession, folder: str) -> DataFrame:
    hours = ticks(spark, folder).select(F.window("ts", "1 hour").start.alias("ts")).distinct()
    return heartbeats(hours, "AAPL,MSFT,GOOGL")


@query(
    FEED
    + f""",
closed AS (SELECT DISTINCT bar_start FROM bars WHERE NOT {SESSION.format(t='bar_start')})
SELECT stock, bar_start AS date, open, high, low, close, volume FROM bars
WHERE {SESSION.format(t='bar_start')} AND stock IN ('click', 'view')
UNION ALL
SELECT s.stock, bar_start, NULL, NULL, NULL, NULL, NULL
FROM closed, (SELECT unnest(string_split('click,view', ',')) AS stock) s"""
)
def live_or_heartbeat_rows(spark: SparkSession, folder: str) -> DataFrame:
    """What a poller sends: bars of the listed symbols while open, a null row for each while closed."""
    rows = bars(spark, folder)
    closed_polls = rows.select("bar_start").distinct()
    return live_or_heartbeat(rows, closed_polls, "click,view")


@query(
    FEED
    + """ SELECT stock, "Date" AS date, "Open" AS open, "High" AS high, "Low" AS low, "Close" AS close,
"Volume" AS volume FROM feed_table"""
)
def bar_to_message(spark: SparkSession, folder: str) -> DataFrame:
    return messages.bar_to_message(feed_table(spark, folder), F.col("Date"), F.col("stock"))


@query(FEED + f" SELECT {ALL_COLUMNS} FROM feed_table")
def message_to_bar(spark: SparkSession, folder: str) -> DataFrame:
    """Bars to JSON text and back."""
    rows = feed_table(spark, folder)
    sent = messages.to_messages(messages.bar_to_message(rows, F.col("Date"), F.col("stock")))
    return messages.accepted(sent)


@query(
    FEED
    + """,
sent AS (SELECT stock, "Date", "Open", bar_start_day, cut FROM (
  SELECT stock, "Date", "Open", substr("Date", 1, 10) AS bar_start_day, substr("Date", 12, 2) = '03' AS cut
  FROM feed_table))
SELECT CASE WHEN cut THEN NULL ELSE stock END AS stock, count(*) AS n,
       count(CASE WHEN NOT cut THEN "Open" END) AS opens,
       sum(CAST(cut AS BIGINT))::BIGINT AS rejects
FROM sent GROUP BY ALL"""
)
def reject_malformed(spark: SparkSession, folder: str) -> DataFrame:
    """Messages of one hour of the day are cut short; they end up as rejects, the rest as bars."""
    rows = feed_table(spark, folder)
    sent = messages.to_messages(messages.bar_to_message(rows, F.col("Date"), F.col("stock")))
    damaged = F.col("value").rlike('"date":"[^"]*T03:')
    sent = sent.withColumn(
        "value", F.when(damaged, F.substring("value", 1, 9)).otherwise(F.col("value"))
    )
    good = messages.accepted(sent).groupBy("stock").agg(
        F.count("*").alias("n"), F.count("Open").alias("opens"), F.lit(0).cast("bigint").alias("rejects")
    )
    bad = messages.rejected(sent).agg(
        F.lit(None).cast("string").alias("stock"),
        F.count("*").alias("n"),
        F.lit(0).cast("bigint").alias("opens"),
        F.count("*").alias("rejects"),
    )
    return good.unionByName(bad)


_DETAILS_SQL = ", ".join(
    f"CAST(json_extract_string(props, '$.k') AS DOUBLE) AS \"{name}\""
    if name == "MarketCap"
    else (f"'{default}' AS \"{name}\"" if default == "" else f'0.0::DOUBLE AS "{name}"')
    for name, _, default in DETAIL_FIELDS
)


@query(TICKS + f""" SELECT strftime(ts, '%Y-%m-%d') AS "Date", stock AS "Symbol", {_DETAILS_SQL} FROM ticks""")
def symbol_details_defaults(spark: SparkSession, folder: str) -> DataFrame:
    """The supplied documents hold one key, read as the market value; the other fields take defaults."""
    fields = [(n, "k" if n == "MarketCap" else key, d) for n, key, d in DETAIL_FIELDS]
    rows = ticks(spark, folder)
    return symbol_details(rows, F.col("stock"), day_text(F.col("ts")), F.col("props"), fields)


@query(TICKS + " SELECT event_id, json_extract_string(props, '$.k') AS k FROM ticks")
def json_extract(spark: SparkSession, folder: str) -> DataFrame:
    return ticks(spark, folder).select("event_id", json_path(F.col("props"), "$.k").alias("k"))


@query(
    TICKS
    + """ SELECT event_id, CAST(json_extract_string(
to_json({chart: {result: [{meta: {regularMarketPrice: price}}]}}),
'$.chart.result[0].meta.regularMarketPrice') AS DOUBLE) AS price FROM ticks"""
)
def quote_json_path(spark: SparkSession, folder: str) -> DataFrame:
    documents = ticks(spark, folder).select(
        "event_id", to_json(quote_document(F.col("price"))).alias("document")
    )
    return documents.select("event_id", quote_price(F.col("document")).alias("price"))


@query(
    TICKS
    + """ SELECT event_id, 'https://www.google.com/finance/quote/' || replace(stock || '.NS', '.NS', '')
|| ':NASDAQ' AS url FROM ticks"""
)
def quote_url(spark: SparkSession, folder: str) -> DataFrame:
    listed = F.concat(F.col("stock"), F.lit(".NS"))
    return ticks(spark, folder).select("event_id", url_of(listed).alias("url"))


@query(
    """SELECT page_id, url AS text, CAST(strlen(html) AS BIGINT) AS n_bytes FROM pages"""
)
def message_bytes_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "pages").select(
        "page_id",
        to_text(to_bytes(F.col("url"))).alias("text"),
        F.octet_length(to_bytes(F.col("html"))).cast("bigint").alias("n_bytes"),
    )


@query(
    FEED
    + """ SELECT concat_ws(',', "Date", """
    + ", ".join(f"coalesce(CAST(\"{c}\" AS VARCHAR), 'None')" for c in MEASURES)
    + ") AS line FROM feed_table"
)
def bar_to_csv_line(spark: SparkSession, folder: str) -> DataFrame:
    columns = [F.col(c) for c in ["Date", *MEASURES]]
    return feed_table(spark, folder).select(csv_line(*columns).alias("line"))


@query(
    TICKS
    + """ SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%S') AS iso, strftime(ts, '%Y-%m-%d %H:%M:%S') AS clock,
strftime(ts, '%Y-%m-%d') AS day FROM ticks"""
)
def date_formats(spark: SparkSession, folder: str) -> DataFrame:
    ts = F.col("ts")
    return ticks(spark, folder).select(
        "event_id", iso_text(ts).alias("iso"), clock_text(ts).alias("clock"), day_text(ts).alias("day")
    )


@query(
    TICKS
    + """ SELECT event_id, date_trunc('second', ts) + INTERVAL 5 HOUR AS parsed,
strftime(ts + INTERVAL 5 HOUR, '%Y-%m-%d') AS session_day, strftime(ts, '%Y-%m-%d') AS exchange_day FROM ticks"""
)
def parse_dates(spark: SparkSession, folder: str) -> DataFrame:
    """Texts that carry an offset of five hours behind UTC."""
    text = F.concat(iso_text(F.col("ts")), F.lit("-05:00"))
    stamped = ticks(spark, folder).select("event_id", text.alias("text"))
    return stamped.select(
        "event_id",
        parse_time(F.col("text")).cast("timestamp_ntz").alias("parsed"),
        session_date(F.col("text")).cast("string").alias("session_day"),
        exchange_date(F.col("text")).cast("string").alias("exchange_day"),
    )


@query(
    FEED
    + """ SELECT CAST(CAST("Date" AS DATE) AS VARCHAR) AS day, "Low" AS low FROM feed_table WHERE "Open" IS NOT NULL"""
)
def date_price_pairs(spark: SparkSession, folder: str) -> DataFrame:
    rows = clean.not_null(feed_table(spark, folder))
    dated = rows.select(session_date(F.col("Date")).cast("string").alias("day"), F.col("Low").alias("low"))
    return charts.pairs(dated, "day", "low")
