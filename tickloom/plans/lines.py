"""The operators on large tables and on stored layouts: order lines, rolled-up summaries, pruned and mixed files."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.operators import charts, clean, model
from tickloom.operators.bars import ohlc_bars
from tickloom.plans.registry import query
from tickloom.plans.scans import SYMBOL, UNIVERSE
from tickloom.plans.streams import _in_runs, _numbered, _zoned_ticks
from tickloom.plans.tables import BARS, FEED, TICKS, bars, bars_sql, feed_table, table, ticks
from tickloom.schemas import MEASURES
from tickloom.sources.files import read_mixed, symbol_path
from tickloom.sources.ranges import history_start, latest_time, symbol_list
from tickloom.sources.sorted import read_range, write_sorted
from tickloom.storage import new_path
from tickloom.streaming import ingest, store

ORDER = ["l_shipdate", "l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_extendedprice"]


def _lines(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "lineitem")


@query(
    """
WITH numbered AS (
  SELECT *, row_number() OVER w - 1 AS rn, count(*) OVER (PARTITION BY l_suppkey) AS n FROM lineitem
  WINDOW w AS (PARTITION BY l_suppkey ORDER BY l_shipdate, l_orderkey, l_linenumber, l_partkey, l_quantity, l_extendedprice)
)
SELECT l_suppkey, l_shipdate, l_orderkey, l_linenumber, l_partkey, l_quantity, l_extendedprice
FROM numbered WHERE rn % greatest(1, n // 20) = 0"""
)
def stride_sample_many_keys(spark: SparkSession, folder: str) -> DataFrame:
    """About 20 order lines of every supplier, evenly over time."""
    rows = _lines(spark, folder).select("l_suppkey", *ORDER)
    return charts.stride_sample(rows, ["l_suppkey"], ORDER, max_points=20, bucket_seconds=86_400)


_COLUMNS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
_SERIES = "SELECT l_orderkey, l_linenumber, series, value, l_shipdate, l_partkey FROM lineitem UNPIVOT (value FOR series IN (l_quantity, l_extendedprice, l_discount, l_tax))"


@query(_SERIES)
def lines_unpivot(spark: SparkSession, folder: str) -> DataFrame:
    """The measures of all order lines as series."""
    return charts.long_series(_lines(spark, folder), ["l_orderkey", "l_linenumber", "l_shipdate", "l_partkey"], _COLUMNS)


@query(
    f"""
WITH series AS ({_SERIES}),
first AS (
  SELECT l_orderkey, l_linenumber, series, arg_min(value, row(l_shipdate, l_partkey, value)) AS f FROM series GROUP BY ALL
)
SELECT l_orderkey, l_linenumber, series, l_partkey, value, round(value / f - 1, 6) AS "return"
FROM series JOIN first USING (l_orderkey, l_linenumber, series) WHERE f <> 0"""
)
def returns_many_keys(spark: SparkSession, folder: str) -> DataFrame:
    """Every measure of every order line against the first of its key: several keys for a few rows each."""
    keys, order = ["l_orderkey", "l_linenumber"], ["l_shipdate", "l_partkey"]
    # The check joins on the keys, so rows with a null one are left out.
    rows = _lines(spark, folder).select(*keys, *order, *_COLUMNS).dropna(subset=keys)
    found = charts.series_returns(rows, keys, order, _COLUMNS)
    return found.select(*keys, "series", "l_partkey", "value", F.round("return", 6).alias("return"))


@query(
    """
WITH gaps AS (
  SELECT l_orderkey, l_linenumber, l_partkey, l_shipdate,
         CASE WHEN l_linenumber % 5 <> 0 THEN l_quantity END AS o, CASE WHEN l_linenumber % 5 <> 0 THEN l_extendedprice END AS h,
         CASE WHEN l_linenumber % 5 <> 0 THEN l_discount END AS l, CASE WHEN l_linenumber % 5 <> 0 AND l_linenumber <> 3 THEN l_tax END AS c,
         CASE WHEN l_linenumber % 5 <> 0 THEN l_quantity * 1000 END AS v
  FROM lineitem
)
SELECT l_orderkey, l_linenumber, l_partkey, l_shipdate, CAST(CAST(coalesce(o, 0) AS DECIMAL(10, 2)) AS DOUBLE) AS "Open",
       CAST(CAST(coalesce(h, 0) AS DECIMAL(10, 2)) AS DOUBLE) AS "High", CAST(CAST(coalesce(l, 0) AS DECIMAL(10, 2)) AS DOUBLE) AS "Low",
       CAST(CAST(coalesce(c, 0) AS DECIMAL(10, 2)) AS DOUBLE) AS "Close", CAST(CAST(coalesce(v, 0) AS DECIMAL(20, 2)) AS DOUBLE) AS "Volume",
       CAST(o IS NULL AS INTEGER) AS "MarketClosed"
FROM gaps"""
)
def lines_cleaned(spark: SparkSession, folder: str) -> DataFrame:
    """The cleaning chain over all order lines as bars with gaps."""
    there, close = F.col("l_linenumber") % 5 != 0, F.col("l_linenumber") != 3
    measures = {
        "Open": F.when(there, F.col("l_quantity")),
        "High": F.when(there, F.col("l_extendedprice")),
        "Low": F.when(there, F.col("l_discount")),
        "Close": F.when(there & close, F.col("l_tax")),
        "Volume": F.when(there, F.col("l_quantity") * 1000),
    }
    rows = _lines(spark, folder).select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_shipdate", *[v.alias(c) for c, v in measures.items()]
    )
    cleaned = clean.clean_bars(rows)
    return cleaned.withColumns({c: F.col(c).cast("double") for c in MEASURES})


@query(
    """
SELECT l_partkey, count(*) AS n, round(regr_intercept(l_extendedprice, l_quantity), 3) AS intercept,
       round(regr_slope(l_extendedprice, l_quantity), 3) AS slope
FROM lineitem GROUP BY l_partkey HAVING var_pop(l_quantity) > 1"""
)
def ols_many_keys(spark: SparkSession, folder: str) -> DataFrame:
    """One price model per part."""
    rows = _lines(spark, folder)
    models = model.least_squares_per_key(rows, ["l_partkey"], ["l_quantity"], "l_extendedprice")
    spread = rows.groupBy("l_partkey").agg(F.var_pop("l_quantity").alias("v")).filter("v > 1").drop("v")
    return models.join(spread, "l_partkey", "left_semi").select(
        "l_partkey", "n", F.round("intercept", 3).alias("intercept"), F.round("coef_l_quantity", 3).alias("slope")
    )


_BOXES = (
    TICKS
    + """ SELECT stock, count(*) AS n, min(price) AS least, max(price) AS most, true AS q1, true AS median, true AS q3,
true AS outliers FROM ticks GROUP BY stock"""
)


def _ranks_of_boxes(rows: DataFrame, boxes: DataFrame) -> DataFrame:
    """Whether the exact ranks of rolled-up quartiles, and the share of outliers, are within the stated bound."""
    reach = 1.5 * (F.col("q3") - F.col("q1"))
    joined = rows.join(F.broadcast(boxes), "stock")  # one row per symbol of the event table
    outside = (F.col("price") < F.col("q1") - reach) | (F.col("price") > F.col("q3") + reach)
    shares = {name: F.avg((F.col("price") <= F.col(name)).cast("int")) for name in ("q1", "median", "q3")}
    below = {name: F.avg((F.col("price") < F.col(name)).cast("int")) for name in ("q1", "median", "q3")}
    found = joined.groupBy("stock", "n", "least", "most", "outlier_share").agg(
        *[v.alias(f"{name}_to") for name, v in shares.items()],
        *[v.alias(f"{name}_from") for name, v in below.items()],
        F.avg(outside.cast("int")).alias("outside"),
    )
    bound = F.lit(charts.SKETCH_RANK_ERROR)
    ok = [
        ((F.col(f"{name}_from") - bound <= q) & (F.col(f"{name}_to") + bound >= q)).alias(name)
        for name, q in (("q1", 0.25), ("median", 0.5), ("q3", 0.75))
    ]
    near = (F.abs(F.col("outside") - F.col("outlier_share")) <= 2 * bound + 1 / charts.OUTLIER_STEPS).alias("outliers")
    return found.select("stock", "n", "least", "most", *ok, near)


@query(_BOXES)
def box_summary_rolled_up(spark: SparkSession, folder: str) -> DataFrame:
    """Box summaries of all days from one sketch per symbol and day; the exact ranks are checked."""
    rows = ticks(spark, folder).select("stock", "price", F.to_date("ts").alias("day"))
    daily = charts.value_sketches(rows, ["stock", "day"], "price")
    boxes = charts.box_of_sketches(charts.merge_sketches(daily, ["stock"]))
    return _ranks_of_boxes(rows, boxes)


@query(_BOXES)
def stream_box_summary(spark: SparkSession, folder: str) -> DataFrame:
    """The same from sketches that a stream keeps, trigger by trigger."""
    target, progress = new_path(spark, "sketches"), new_path(spark, "progress")
    keys = ["stock", "day"]
    rows = _zoned_ticks(spark, folder).select("stock", "price", F.to_date("ts").alias("day"), "event_id")
    _in_runs(
        spark, rows, _numbered(F.col("event_id") % 3, 3),
        lambda some: ingest.ingest_summaries(
            some, target, progress, lambda batch: charts.value_sketches(batch, keys, "price"),
            lambda sketches: charts.merge_sketches(sketches, keys), available_now=True,
        ),
    )
    boxes = charts.box_of_sketches(charts.merge_sketches(store.read(spark, target), ["stock"]))
    return _ranks_of_boxes(rows, boxes)


_ROLLING = (
    BARS
    + """,
rolled AS (
  SELECT stock, CAST(bar_start AS DATE) AS day, count(*) OVER w AS n, regr_intercept(close, high) OVER w AS intercept,
         regr_slope(close, high) OVER w AS slope
  FROM bars
  WINDOW w AS (PARTITION BY stock ORDER BY CAST(bar_start AS DATE) RANGE BETWEEN INTERVAL 6 DAY PRECEDING AND CURRENT ROW)
)
SELECT DISTINCT stock, CAST(day AS TIMESTAMP) AS day, n,
       CASE WHEN round(intercept, 3) = 0 THEN 0.0 ELSE round(intercept, 3) END AS intercept, round(slope, 4) AS slope
FROM rolled"""
)


def _rolling_models(moments: DataFrame) -> DataFrame:
    rolled = model.rolling_moments(moments, ["stock"], "day", 7)
    models = model.models_of_moments(rolled, ["stock", "day"], ["high"])
    intercept = F.round("intercept", 3)
    return models.select(
        "stock",
        F.col("day").cast("timestamp_ntz").alias("day"),
        "n",
        # A zero has no sign here.
        F.when(intercept == 0, 0.0).otherwise(intercept).alias("intercept"),
        F.round("coef_high", 4).alias("slope"),
    )


@query(_ROLLING)
def ols_rolling_window(spark: SparkSession, folder: str) -> DataFrame:
    """A model per symbol and day over the last seven days, from one row of moments per symbol and day."""
    rows = bars(spark, folder).withColumn("day", F.to_date("bar_start"))
    return _rolling_models(model.moment_sums(rows, ["stock", "day"], ["high"], "close"))


@query(_ROLLING)
def stream_ols_rolling(spark: SparkSession, folder: str) -> DataFrame:
    """The same from moments that a stream keeps, with the bars in no order."""
    target, progress = new_path(spark, "moments"), new_path(spark, "progress")
    keys = ["stock", "day"]
    rows = bars(spark, folder).withColumn("day", F.to_date("bar_start")).drop("bar_start")
    _in_runs(
        spark, rows, _numbered(F.pmod(F.xxhash64("high", "close"), F.lit(3)), 3),
        lambda some: ingest.ingest_summaries(
            some, target, progress, lambda batch: model.moment_sums(batch, keys, ["high"], "close"),
            lambda sums: model.merge_moments(sums, keys), available_now=True,
        ),
    )
    return _rolling_models(model.merge_moments(store.read(spark, target), keys))


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
def bars_range_pruned(spark: SparkSession, folder: str) -> DataFrame:
    """The bars of ``bars_history_range`` from a sorted store, whose other files are not opened."""
    all_ticks, path = ticks(spark, folder), new_path(spark, "sorted")
    write_sorted(all_ticks, path, order=["event_id"], rows_per_file=500)
    as_of = latest_time(all_ticks)
    start = history_start(all_ticks, SYMBOL, as_of).select(F.col("start_date").cast("timestamp_ntz")).scalar()
    history = read_range(spark, path, symbol_list(UNIVERSE), start, as_of)
    return clean.drop_missing(ohlc_bars(history, "2 minutes"), ["open", "high", "low", "close", "volume"])


@query(
    FEED
    + """ SELECT CAST("Date" AS TIMESTAMP) AS "Date", "Open", "High", "Low", "Close",
CASE WHEN stock = 'view' THEN NULL ELSE "Volume" END AS "Volume",
CASE WHEN stock = 'click' THEN CAST("Volume" AS BIGINT) WHEN stock = 'purchase' THEN "Volume" / 2 END AS "Traded", stock AS "Stock"
FROM feed_table"""
)
def scan_mixed_headers(spark: SparkSession, folder: str) -> DataFrame:
    """Symbols whose files have swapped, missing and added columns, one of them whole numbers in some files only."""
    path = new_path(spark, "mixed")
    rows = feed_table(spark, folder)
    usual = ["Date", "Open", "High", "Low", "Close", "Volume"]
    layouts = {
        "view": usual[:-1],
        "click": ["Volume", "Close", "Date", "Low", "High", "Open", "Traded"],
        "purchase": [*usual, "Traded"],
    }
    for symbol in [r["stock"] for r in rows.select("stock").distinct().collect()]:  # the five event types
        traded = F.col("Volume").cast("long") if symbol == "click" else F.col("Volume") / 2
        own = rows.filter(F.col("stock") == symbol).withColumn("Traded", traded).select(layouts.get(symbol, usual))
        own.write.option("header", True).option("nullValue", "None").csv(symbol_path(path, symbol))
    found = read_mixed(spark, path)
    return found.withColumn("Date", F.col("Date").cast("timestamp_ntz"))
