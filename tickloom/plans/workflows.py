"""Whole jobs over a folder of stored bars, for callers that start from files rather than tables."""

from pyspark.ml.regression import LinearRegressionModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.functions.times import iso_text, market_open
from tickloom.operators import charts, clean, model
from tickloom.operators.bars import bar_table, latest_per_symbol, ohlc_bars
from tickloom.operators.market import BAR_MEASURES, heartbeats
from tickloom.operators.messages import bar_to_message, to_messages
from tickloom.schemas import FEATURES, LABEL
from tickloom.sources.files import load_symbol, read_all_symbols
from tickloom.sources.ranges import between, history_start, look_back, of_symbols, symbol_list
from tickloom.storage import materialise

# Training shares and seeds of the pooled and of the single-symbol model.
POOLED_SPLIT = (0.7, 42)
SYMBOL_SPLIT = (0.8, 123)


def cleaned_bars(
    spark: SparkSession, folder: str, partitioned: bool = False, file_format: str = "csv", **cleaning
) -> DataFrame:
    """All symbols' bars, cleaned: missing values, decimals, closed-market flag."""
    return clean.clean_bars(read_all_symbols(spark, folder, partitioned, file_format=file_format), **cleaning)


def _fit_and_score(rows: DataFrame, share: float, seed: int) -> tuple[LinearRegressionModel, DataFrame, float]:
    # Written first: a random split must be drawn from the same rows when it is read again.
    rows = materialise(rows, "model-rows")
    train, test = model.split_random(rows, share, seed)
    fitted = model.fit(model.assemble(train))
    predictions = model.score(fitted, test)
    return fitted, predictions, model.rmse_value(predictions)


def pooled_model(
    spark: SparkSession, folder: str, share: float = POOLED_SPLIT[0], seed: int = POOLED_SPLIT[1], **cleaning
) -> tuple[LinearRegressionModel, DataFrame, float]:
    """One model over all symbols: (model, held-out predictions, RMSE)."""
    rows = cleaned_bars(spark, folder, **cleaning).select(*FEATURES, LABEL)
    return _fit_and_score(rows.filter(F.col(LABEL).isNotNull()), share, seed)


def predict_symbol(
    spark: SparkSession, folder: str, symbol: str, share: float = SYMBOL_SPLIT[0], seed: int = SYMBOL_SPLIT[1],
    **store,
) -> tuple[DataFrame, float]:
    """One symbol's model: (features, prediction, Close of held-out rows; RMSE).

    ``store`` (partitioned, file_format) tells how the bars are stored.
    """
    rows = clean.drop_missing(load_symbol(spark, folder, symbol, **store)).select(*FEATURES, LABEL)
    _, predictions, error = _fit_and_score(rows, share, seed)
    return model.feature_array(predictions).select("features", "prediction", LABEL), error


def dashboard_series(
    spark: SparkSession, folder: str, symbol: str, chart_types: list[str], **store
) -> DataFrame:
    """The series of the chosen charts of one symbol."""
    return charts.selected_charts(load_symbol(spark, folder, symbol, **store), chart_types, ["Date"])


def query_prices(spark: SparkSession, bars: DataFrame, sql: str | None = None, view: str = "stock") -> DataFrame:
    """Register bars as a view and run SQL on it; by default all price columns of bars with a price."""
    bars.createOrReplaceTempView(view)
    return spark.sql(sql or f"SELECT Date, Open, High, Low, Close FROM {view} WHERE Open IS NOT NULL")


def _messages_of(bars: DataFrame) -> DataFrame:
    stored = bar_table(bars, iso_text(F.col("bar_start")))
    return to_messages(bar_to_message(stored, F.col("Date"), F.col("stock")))


def history_messages(ticks: DataFrame, symbols: str, as_of: Column, interval: str = "2 minutes") -> DataFrame:
    """Backfill: complete bars of the listed symbols since the first symbol's start day, as messages."""
    listed = symbol_list(symbols)
    if not listed:
        return _messages_of(ohlc_bars(ticks.filter(F.lit(False)), interval))
    start = history_start(ticks, listed[0], as_of).select(F.col("start_date").cast("timestamp_ntz")).scalar()
    bars = ohlc_bars(between(of_symbols(ticks, symbols), start, as_of), interval)
    return _messages_of(clean.drop_missing(bars, BAR_MEASURES))


def poll_messages(
    ticks: DataFrame, symbols: str, as_of: Column, look_back_minutes: int = 1, interval: str = "2 minutes", **session
) -> DataFrame:
    """One poll: the newest bar per symbol while the market is open, a null row per symbol while closed.

    A symbol without ticks in the look-back sends nothing.
    """
    bars = ohlc_bars(look_back(of_symbols(ticks, symbols), as_of, look_back_minutes), interval)
    newest = latest_per_symbol(bars, ["bar_start"], ["bar_start", *BAR_MEASURES])
    live = newest.filter(market_open(as_of, **session)).withColumnRenamed("bar_start", "date")
    now = ticks.sparkSession.range(1).select(as_of.alias("ts"))
    sent = live.unionByName(heartbeats(now, symbols, **session))
    return to_messages(sent.withColumn("date", iso_text(F.col("date"))))
