"""Linear price models."""

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.functions.times import iso_text
from tickloom.operators import clean, model
from tickloom.operators.bars import bar_table
from tickloom.operators.spread import join_on_keys
from tickloom.plans.registry import query
from tickloom.plans.tables import BARS, bars
from tickloom.schemas import FEATURES, LABEL
from tickloom.storage import materialise

FEATURE_COLUMNS = ["open", "high", "low", "volume"]
DIGITS = 4


def _complete_bars(spark: SparkSession, folder: str) -> DataFrame:
    """Bars without missing values, written once: fitting and scoring both read them."""
    return materialise(bars(spark, folder).na.drop("any"), "bars")


def _key() -> list:
    return [F.col("stock"), iso_text(F.col("bar_start"))]


def _fitted(spark: SparkSession, folder: str):
    rows = _complete_bars(spark, folder)
    train, test = model.split_by_key(rows, 0.8, *_key())
    return model.fit(model.assemble(train, FEATURE_COLUMNS), "close"), train, test


_BUCKET = (
    "CAST('0x' || substr(md5(stock || '|' || strftime(bar_start, '%Y-%m-%dT%H:%M:%S')), 1, 7) AS BIGINT) % 100"
)


def least_squares_sql(source: str, partition: str = "") -> str:
    """Least squares with four features by successive orthogonalisation; ``tr`` marks training rows.

    Continues a WITH list; reads columns tr, y, x1..x4 of ``source`` and ends in ``fitted`` with ``p``.
    """
    over = f"FILTER (tr) OVER ({'PARTITION BY ' + partition if partition else ''})"

    def s(expr: str) -> str:
        return f"sum({expr}) {over}"

    def ratio(a: str, b: str) -> str:
        return f"coalesce({s(f'{a} * {b}')} / nullif({s(f'{a} * {a}')}, 0), 0)"

    return f""",
c0 AS (SELECT * REPLACE (x1 - avg(x1) {over} AS x1, x2 - avg(x2) {over} AS x2, x3 - avg(x3) {over} AS x3,
  x4 - avg(x4) {over} AS x4), avg(y) {over} AS p FROM {source}),
c1 AS (SELECT * REPLACE (p + x1 * {ratio('x1', 'y')} AS p, x2 - x1 * {ratio('x1', 'x2')} AS x2,
  x3 - x1 * {ratio('x1', 'x3')} AS x3, x4 - x1 * {ratio('x1', 'x4')} AS x4) FROM c0),
c2 AS (SELECT * REPLACE (p + x2 * {ratio('x2', 'y')} AS p, x3 - x2 * {ratio('x2', 'x3')} AS x3,
  x4 - x2 * {ratio('x2', 'x4')} AS x4) FROM c1),
c3 AS (SELECT * REPLACE (p + x3 * {ratio('x3', 'y')} AS p, x4 - x3 * {ratio('x3', 'x4')} AS x4) FROM c2),
fitted AS (SELECT * REPLACE (p + x4 * {ratio('x4', 'y')} AS p) FROM c3)"""


_ROWS = (
    BARS
    + f""",
d AS (SELECT stock, bar_start, open, high, low, volume, close, {_BUCKET} < 80 AS tr,
  close AS y, open AS x1, high AS x2, low AS x3, volume AS x4 FROM bars)"""
)


@query(BARS + " SELECT stock, bar_start, open AS f1, high AS f2, low AS f3, volume AS f4, close FROM bars")
def assemble_features(spark: SparkSession, folder: str) -> DataFrame:
    rows = model.assemble(bars(spark, folder), FEATURE_COLUMNS)
    values = rows.withColumn("f", vector_to_array("features"))
    return values.select(
        "stock", "bar_start", *[F.col("f")[i].alias(f"f{i + 1}") for i in range(4)], "close"
    )


@query(_ROWS + " SELECT stock, bar_start, tr AS in_train FROM d")
def split_by_key(spark: SparkSession, folder: str) -> DataFrame:
    train, test = model.split_by_key(bars(spark, folder), 0.8, *_key())
    return train.select("stock", "bar_start", F.lit(True).alias("in_train")).unionByName(
        test.select("stock", "bar_start", F.lit(False).alias("in_train"))
    )


@query(
    BARS
    + """ SELECT stock, bar_start, 1 AS parts, true AS share_in_bounds FROM bars"""
)
def split_random(spark: SparkSession, folder: str) -> DataFrame:
    """A seeded random split of written rows: every bar is in one part, and the shares are near 70 and 30.

    Which rows are drawn depends on the layout, so the check is on what every split must satisfy.
    """
    rows = materialise(bars(spark, folder).select("stock", "bar_start"), "split-rows")
    train, test = model.split_random(rows, 0.7, seed=42)
    both = train.withColumn("in_train", F.lit(1)).unionByName(test.withColumn("in_train", F.lit(0)))
    drawn = both.agg(F.avg("in_train").alias("share"), F.count("*").alias("n")).first()
    # Four standard errors of a share drawn row by row.
    near = bool(drawn["n"] and abs(drawn["share"] - 0.7) < 4 * (0.21 / drawn["n"]) ** 0.5)
    parts = both.groupBy("stock", "bar_start").agg(F.count("*").cast("int").alias("parts"))
    return parts.withColumn("share_in_bounds", F.lit(near))


# Predictions at the origin and one step along each feature give intercept and coefficients.
_UNIT_ROWS = """,
e AS (SELECT tr, y, x1, x2, x3, x4, NULL AS term FROM d
  UNION ALL SELECT false, 0, 0, 0, 0, 0, 'intercept'
  UNION ALL SELECT false, 0, 1, 0, 0, 0, 'open'
  UNION ALL SELECT false, 0, 0, 1, 0, 0, 'high'
  UNION ALL SELECT false, 0, 0, 0, 1, 0, 'low'
  UNION ALL SELECT false, 0, 0, 0, 0, 1, 'volume')"""


@query(
    _ROWS
    + _UNIT_ROWS
    + least_squares_sql("e")
    + """ SELECT term, round(CASE WHEN term = 'intercept' THEN p
ELSE p - (SELECT p FROM fitted WHERE term = 'intercept') END, 4) AS value FROM fitted WHERE term IS NOT NULL"""
)
def ols_coefficients(spark: SparkSession, folder: str) -> DataFrame:
    fitted, train, _ = _fitted(spark, folder)
    found = model.coefficients(fitted, train, FEATURE_COLUMNS)
    return found.select("term", F.round("value", DIGITS).alias("value"))


@query(
    _ROWS + least_squares_sql("d") + " SELECT stock, bar_start, round(p, 4) AS prediction FROM fitted WHERE NOT tr"
)
def ols_predictions(spark: SparkSession, folder: str) -> DataFrame:
    fitted, _, test = _fitted(spark, folder)
    scored = model.score(fitted, test, FEATURE_COLUMNS)
    return scored.select("stock", "bar_start", F.round("prediction", DIGITS).alias("prediction"))


@query(_ROWS + least_squares_sql("d") + " SELECT round(sqrt(avg(pow(y - p, 2))), 4) AS rmse FROM fitted WHERE NOT tr")
def rmse(spark: SparkSession, folder: str) -> DataFrame:
    fitted, _, test = _fitted(spark, folder)
    error = model.rmse(model.score(fitted, test, FEATURE_COLUMNS), label="close")
    return error.select(F.round("rmse", DIGITS).alias("rmse"))


@query(
    _ROWS
    + least_squares_sql("d")
    + """ SELECT stock, bar_start, open, high, low, volume, close, round(p, 4) AS prediction,
round(sqrt(avg(pow(y - p, 2)) OVER ()), 4) AS rmse FROM fitted WHERE NOT tr"""
)
def predict_prices(spark: SparkSession, folder: str) -> DataFrame:
    """Bars, split, fit, held-out predictions and their error: the whole chain."""
    rows = _complete_bars(spark, folder)
    predictions, error = model.predict_prices(rows, _key(), 0.8, "close", FEATURE_COLUMNS)
    values = model.feature_array(predictions)
    return values.select(
        "stock",
        "bar_start",
        *[F.col("features")[i].alias(c) for i, c in enumerate(FEATURE_COLUMNS)],
        "close",
        F.round("prediction", DIGITS).alias("prediction"),
        F.lit(round(error, DIGITS)).alias("rmse"),
    )


@query(
    _ROWS
    + """,
e AS (SELECT tr, y, x1, x2, x3, x4 FROM d UNION ALL SELECT false, 0, 170, 172, 168, 1000
  UNION ALL SELECT false, 0, 20, 25, 15, 3)"""
    + least_squares_sql("e")
    + """,
asked AS (SELECT fitted.*, row_number() OVER () AS r FROM fitted WHERE y = 0 AND NOT tr)
SELECT round(p, 4) AS prediction FROM asked"""
)
def score_new_rows(spark: SparkSession, folder: str) -> DataFrame:
    """Predictions of the fitted model for two hand-given rows."""
    fitted, _, _ = _fitted(spark, folder)
    asked = spark.createDataFrame([(170.0, 172.0, 168.0, 1000.0), (20.0, 25.0, 15.0, 3.0)], FEATURE_COLUMNS)
    scored = model.score(fitted, asked, FEATURE_COLUMNS)
    return scored.select(F.round("prediction", DIGITS).alias("prediction"))


@query(
    BARS
    + """ SELECT count(*) AS n, count(*) AS predicted, sum(v) AS volume, min(v) AS least, max(v) AS most
FROM (SELECT CAST(volume * 100000000 AS DECIMAL(20, 2))::DOUBLE AS v FROM bars)"""
)
def pooled_model_cleaned(spark: SparkSession, folder: str) -> DataFrame:
    """Clean, assemble, fit and score with volumes beyond the range of prices: no bar and no volume is lost on the way."""
    wide = bar_table(bars(spark, folder), iso_text(F.col("bar_start"))).withColumn("Volume", F.col("Volume") * 1e8)
    cleaned = clean.clean_bars(wide)
    rows = materialise(cleaned.select(*[F.col(c).cast("double").alias(c) for c in [*FEATURES, LABEL]]), "cleaned")
    scored = model.score(model.fit(model.assemble(rows)), rows)
    return scored.agg(
        F.count("*").alias("n"),
        F.count("prediction").alias("predicted"),
        F.sum("Volume").alias("volume"),
        F.min("Volume").alias("least"),
        F.max("Volume").alias("most"),
    )


@query(
    BARS
    + """ SELECT stock, count(*) AS n, round(regr_intercept(close, high), 4) AS intercept,
round(regr_slope(close, high), 4) AS slope,
round(sqrt(regr_syy(close, high) / count(*) * (1 - regr_r2(close, high))), 4) AS rmse FROM bars GROUP BY stock"""
)
def ols_per_symbol(spark: SparkSession, folder: str) -> DataFrame:
    """One-feature model of every symbol, with its error on the rows it was fitted on."""
    rows = _complete_bars(spark, folder)
    models = model.least_squares_per_key(rows, ["stock"], ["high"], "close")
    scored = model.score_per_key(rows, models, ["stock"], ["high"])
    errors = model.rmse(scored, ["stock"], "close")
    return join_on_keys(models, errors, ["stock"], "inner").select(
        "stock",
        "n",
        F.round("intercept", DIGITS).alias("intercept"),
        F.round("coef_high", DIGITS).alias("slope"),
        F.round("rmse", DIGITS).alias("rmse"),
    )


@query(
    _ROWS
    + least_squares_sql("d", "stock")
    + " SELECT stock, bar_start, close, round(p, 4) AS prediction FROM fitted WHERE NOT tr"
)
def predict_prices_per_symbol(spark: SparkSession, folder: str) -> DataFrame:
    """Four-feature models of all symbols in one aggregation, scored on held-out bars."""
    rows = _complete_bars(spark, folder)
    scored = model.predict_prices_per_symbol(rows, _key(), "stock", 0.8, "close", FEATURE_COLUMNS)
    return scored.select("stock", "bar_start", "close", F.round("prediction", DIGITS).alias("prediction"))


@query(
    BARS
    + """,
led AS (SELECT *, lead(close) OVER (PARTITION BY stock ORDER BY bar_start) AS label FROM bars),
kept AS (SELECT * FROM led WHERE label IS NOT NULL),
cut AS (SELECT floor(epoch(min(bar_start)) + (epoch(max(bar_start)) - epoch(min(bar_start))) * 0.8) AS moment FROM kept),
d AS (SELECT stock, bar_start, label, epoch(bar_start) < moment AS tr, label AS y, open AS x1, high AS x2, low AS x3,
  volume AS x4 FROM kept, cut)"""
    + least_squares_sql("d")
    + " SELECT stock, bar_start, label, round(p, 4) AS prediction FROM fitted WHERE NOT tr"
)
def predict_next_close(spark: SparkSession, folder: str) -> DataFrame:
    """The next bar's close, trained on the earlier part of the time and tested on the later one."""
    labelled = model.next_close(_complete_bars(spark, folder)).filter(F.col("label").isNotNull())
    labelled = materialise(labelled, "labelled")
    train, test = model.split_by_time(labelled, 0.8, "bar_start")
    fitted = model.fit(model.assemble(train, FEATURE_COLUMNS), "label")
    scored = model.score(fitted, test, FEATURE_COLUMNS)
    return scored.select("stock", "bar_start", "label", F.round("prediction", DIGITS).alias("prediction"))
