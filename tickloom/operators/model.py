"""Linear price models: features, splits, pooled and per-symbol least squares, error metric."""

from itertools import combinations_with_replacement

from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import LinearRegression, LinearRegressionModel
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickloom.operators.spread import attach_per_key, following
from tickloom.schemas import FEATURES, LABEL

# A feature whose remaining variance falls below this share of its own is taken as a combination of the
# ones before it and gets the coefficient 0.
COLLINEAR = 1e-10


def assemble(df: DataFrame, features: list[str] = FEATURES, on_missing: str = "error") -> DataFrame:
    """Add the ``features`` vector; a row with a missing feature is an error (or ``skip`` / ``keep``)."""
    return VectorAssembler(inputCols=features, outputCol="features", handleInvalid=on_missing).transform(df)


def feature_array(df: DataFrame) -> DataFrame:
    """The feature vector as a plain array."""
    return df.withColumn("features", vector_to_array("features"))


def split_random(df: DataFrame, share: float, seed: int) -> tuple[DataFrame, DataFrame]:
    """Random split; the rows chosen depend on the partitioning, as with any ``randomSplit``."""
    train, test = df.randomSplit([share, 1 - share], seed=seed)
    return train, test


def split_bucket(*keys: Column) -> Column:
    """0-99 from the row's key text, the same on every run, layout and engine."""
    digest = F.md5(F.concat_ws("|", *keys))
    return F.conv(F.substring(digest, 1, 7), 16, 10).cast("int") % 100


def split_by_key(df: DataFrame, share: float, *keys: Column) -> tuple[DataFrame, DataFrame]:
    """Repeatable random-like split on the row key."""
    in_train = split_bucket(*keys) < round(share * 100)
    return df.filter(in_train), df.filter(~in_train)


def fit(train: DataFrame, label: str = LABEL) -> LinearRegressionModel:
    """Ordinary least squares over assembled rows: one distributed pass over the moments."""
    return LinearRegression(featuresCol="features", labelCol=label).fit(train)


def coefficients(model: LinearRegressionModel, df: DataFrame, features: list[str] = FEATURES) -> DataFrame:
    """Intercept and coefficients as rows (term, value)."""
    values = [("intercept", float(model.intercept))]
    values += [(name, float(c)) for name, c in zip(features, model.coefficients)]
    return df.sparkSession.createDataFrame(values, "term string, value double")


def score(model: LinearRegressionModel, rows: DataFrame, features: list[str] = FEATURES) -> DataFrame:
    """Predictions for rows with feature columns, known or hand-given."""
    return model.transform(assemble(rows, features))


def rmse_value(predictions: DataFrame, label: str = LABEL) -> float:
    return RegressionEvaluator(labelCol=label, predictionCol="prediction", metricName="rmse").evaluate(predictions)


def rmse(predictions: DataFrame, keys: list[str] | None = None, label: str = LABEL) -> DataFrame:
    """Root mean squared error, overall or per key, as a table."""
    error = F.sqrt(F.avg(F.pow(F.col(label) - F.col("prediction"), 2))).alias("rmse")
    return predictions.groupBy(*(keys or [])).agg(error)


def predict_prices(
    bars: DataFrame, keys: list[Column], share: float = 0.8, label: str = LABEL, features: list[str] = FEATURES
) -> tuple[DataFrame, float]:
    """Drop incomplete rows, split, fit, score the held-out rows: (predictions, RMSE)."""
    complete = bars.na.drop("any")
    train, test = split_by_key(complete, share, *keys)
    predictions = score(fit(assemble(train, features), label), test, features)
    return predictions, rmse_value(predictions, label)


def least_squares_per_key(
    rows: DataFrame, keys: list[str], features: list[str] = FEATURES, label: str = LABEL
) -> DataFrame:
    """One least-squares model per key: columns ``n``, ``intercept`` and ``coef_<feature>``.

    The data is read once: counts, means and covariances per key are combined before the shuffle, so a
    hot symbol needs no more memory than a rare one. The small normal equations are then eliminated
    column by column in Catalyst expressions, one row per key.
    """
    columns = [*features, label]
    complete = rows.na.drop("any", subset=columns)
    moments = complete.groupBy(*keys).agg(
        F.count("*").alias("n"),
        *[F.avg(c).alias(f"__mean_{i}") for i, c in enumerate(columns)],
        *[
            F.covar_pop(columns[i], columns[j]).alias(f"__m_{i}_{j}")
            for i, j in combinations_with_replacement(range(len(columns)), 2)
        ],
    )
    return _solved(moments, keys, features)


def _solved(moments: DataFrame, keys: list[str], features: list[str]) -> DataFrame:
    """Least squares from ``n``, means ``__mean_i`` and covariances ``__m_i_j``, eliminated column by column."""
    k = len(features)
    state = moments.withColumns({f"__v_{i}": F.col(f"__m_{i}_{i}") for i in range(k)})
    for p in range(k):
        pivot = F.col(f"__m_{p}_{p}")
        usable = pivot > COLLINEAR * F.col(f"__v_{p}")
        state = state.withColumns(
            {
                f"__f_{p}_{j}": F.when(usable, F.col(f"__m_{p}_{j}") / pivot).otherwise(0.0)
                for j in range(p + 1, k + 1)
            }
        )
        state = state.withColumns(
            {
                f"__m_{i}_{j}": F.col(f"__m_{i}_{j}") - F.col(f"__f_{p}_{i}") * F.col(f"__m_{p}_{j}")
                for i in range(p + 1, k + 1)
                for j in range(i, k + 1)
            }
        )
    for p in reversed(range(k)):
        value = F.col(f"__f_{p}_{k}")
        for j in range(p + 1, k):
            value = value - F.col(f"__f_{p}_{j}") * F.col(f"coef_{features[j]}")
        state = state.withColumn(f"coef_{features[p]}", value)
    intercept = F.col(f"__mean_{k}")
    for i, name in enumerate(features):
        intercept = intercept - F.col(f"coef_{name}") * F.col(f"__mean_{i}")
    return state.select(
        *keys, "n", intercept.alias("intercept"), *[F.col(f"coef_{name}") for name in features]
    )


def moment_sums(rows: DataFrame, keys: list[str], features: list[str] = FEATURES, label: str = LABEL) -> DataFrame:
    """Counts, sums and sums of products per key (such as symbol and day), which add up in any order.

    Rows with a missing value are left out. Sums are of doubles; features of very different size from their spread
    should be centred by a constant first.
    """
    columns = [*features, label]
    values = [F.col(c).cast("double") for c in columns]
    return rows.na.drop("any", subset=columns).groupBy(*keys).agg(
        F.count("*").alias("n"),
        *[F.sum(v).alias(f"s_{i}") for i, v in enumerate(values)],
        *[
            F.sum(values[i] * values[j]).alias(f"s_{i}_{j}")
            for i, j in combinations_with_replacement(range(len(columns)), 2)
        ],
    )


def merge_moments(sums: DataFrame, keys: list[str]) -> DataFrame:
    """The moments of each key added up."""
    return sums.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in sums.columns if c == "n" or c.startswith("s_")])


def rolling_moments(sums: DataFrame, keys: list[str], day: str, days: int) -> DataFrame:
    """Per key and day the moments of the last ``days`` days, that day included.

    The window sees one row per key and day, however many rows a day has; days join and leave its sums.
    """
    number = F.datediff(F.col(day), F.lit("1970-01-01").cast("date"))
    window = Window.partitionBy(*keys).orderBy(number).rangeBetween(1 - days, 0)
    names = [c for c in sums.columns if c == "n" or c.startswith("s_")]
    return sums.select(*keys, day, *[F.sum(c).over(window).alias(c) for c in names])


def models_of_moments(
    sums: DataFrame, keys: list[str], features: list[str] = FEATURES
) -> DataFrame:
    """One least-squares model per row of moments: ``keys``, ``n``, ``intercept`` and ``coef_<feature>``."""
    count = len(features) + 1
    means = {f"__mean_{i}": F.col(f"s_{i}") / F.col("n") for i in range(count)}
    pairs = list(combinations_with_replacement(range(count), 2))
    central = {
        f"__m_{i}_{j}": F.col(f"s_{i}_{j}") / F.col("n") - F.col(f"__mean_{i}") * F.col(f"__mean_{j}") for i, j in pairs
    }
    return _solved(sums.withColumns(means).withColumns(central), keys, features)


def score_per_key(
    rows: DataFrame, models: DataFrame, keys: list[str], features: list[str] = FEATURES
) -> DataFrame:
    """Score each row with its key's model; rows of keys without a model get a null prediction."""
    names = [f"coef_{f}" for f in features]
    joined = attach_per_key(rows, models, keys, "n")
    prediction = F.col("intercept")
    for feature, name in zip(features, names):
        prediction = prediction + F.col(feature) * F.col(name)
    return joined.withColumn("prediction", prediction).drop("n", "intercept", *names)


def predict_prices_per_symbol(
    bars: DataFrame, keys: list[Column], symbol: str = "stock", share: float = 0.8, label: str = LABEL,
    features: list[str] = FEATURES,
) -> DataFrame:
    """Held-out predictions of one model per symbol, for all symbols in one job."""
    complete = bars.na.drop("any")
    train, test = split_by_key(complete, share, *keys)
    models = least_squares_per_key(train, [symbol], features, label)
    return score_per_key(test, models, [symbol], features)


def next_close(bars: DataFrame, symbol: str = "stock", time: str = "bar_start", close: str = "close") -> DataFrame:
    """Add ``label``: the close of the symbol's next bar; null on its last bar."""
    day = F.to_date(F.col(time))
    return following(bars, [symbol], time, day, close, "label")


def split_by_time(df: DataFrame, share: float, time: str) -> tuple[DataFrame, DataFrame]:
    """Earlier rows train, later rows test; the cut lies at ``share`` of the covered time.

    The cut is a scalar of the column's own type, so the comparison reaches the file scan.
    """
    seconds = F.unix_seconds(F.col(time).cast("timestamp"))
    ends = df.agg(F.min(seconds).alias("lo"), F.max(seconds).alias("hi"))
    at = F.timestamp_seconds(F.floor(F.col("lo") + (F.col("hi") - F.col("lo")) * share))
    cut = ends.select(at.cast(df.schema[time].dataType)).scalar()
    return df.filter(F.col(time) < cut), df.filter(F.col(time) >= cut)
