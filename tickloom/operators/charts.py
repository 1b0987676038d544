"""Chart-ready data. Drawing is left to the caller."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tickloom.operators.bars import ohlc_bars
from tickloom.operators.spread import (
    attach_per_key,
    join_on_keys,
    ordered_chunks,
    row_numbers,
    running_total,
    with_key_values,
)
from tickloom.schemas import PRICES
from tickloom.storage import materialise

# Chart types offered by the dashboard; each shows these series.
CHART_TYPES = ["Line Chart", "Area Chart", "Bar Chart"]
CHART_SERIES = ["Close", "High", "Low"]
MAX_POINTS = 1000

# Groups of tasks that merge their first rows before the last merge.
FIRST_ROWS_GROUPS = 200


def symbol_series(df: DataFrame, symbol: str, column: str = "Close", date: str = "Date", key: str = "stock") -> DataFrame:
    """(date, value) of one symbol; sort it where it is shown."""
    return df.filter(F.col(key) == symbol).select(date, column)


def price_columns(df: DataFrame) -> DataFrame:
    """Date and prices together, so no column has to be matched up by row position."""
    return df.select("Date", *PRICES)


def pairs(df: DataFrame, x: str, y: str) -> DataFrame:
    return df.select(x, y)


def long_series(df: DataFrame, ids: list[str], columns: list[str]) -> DataFrame:
    """Each column as a named series: ids, series, value."""
    return df.unpivot(ids, columns, "series", "value")


def selected_charts(df: DataFrame, chart_types: list[str], ids: list[str]) -> DataFrame:
    """One copy of the series per chosen chart type; nothing chosen gives no rows."""
    chosen = [c for c in CHART_TYPES if c in chart_types]
    listed = F.array(*[F.lit(c) for c in chosen]).cast("array<string>")
    series = long_series(df, ids, CHART_SERIES)
    return series.withColumn("chart", F.explode(listed))


def candles(ticks: DataFrame, symbol: str, interval: str = "1 day") -> DataFrame:
    """Open, high, low and close per period of one symbol."""
    return ohlc_bars(ticks.filter(F.col("stock") == symbol), interval)


def first_rows(df: DataFrame, order: list[str], n: int = MAX_POINTS) -> DataFrame:
    """The first ``n`` rows in a stated order.

    In two levels: every task keeps its first ``n``, groups of tasks keep theirs, and the last merge sees
    ``FIRST_ROWS_GROUPS * n`` rows however large the table is.
    """
    group = "__group"
    grouped = df.withColumn(group, F.pmod(F.spark_partition_id(), F.lit(FIRST_ROWS_GROUPS)))
    place = F.row_number().over(Window.partitionBy(group).orderBy(*order))
    return grouped.withColumn("__place", place).filter(F.col("__place") <= n).drop(group, "__place").orderBy(*order).limit(n)


def mean_per_x(df: DataFrame, x: str, y: str) -> DataFrame:
    """Bar heights: the mean of ``y`` for each ``x``."""
    return df.groupBy(x).agg(F.avg(y).alias(y))


def stride_sample(
    df: DataFrame, keys: list[str], order: list[str], max_points: int = MAX_POINTS, bucket_seconds: int = 60
) -> DataFrame:
    """Every ``step``-th row per key, step = max(1, rows div max_points). ``order[0]`` is a timestamp.

    Rows are first only counted per key and time bucket. The running count tells which buckets hold a
    wanted position; just their rows are then put in order, so the table as a whole is never shuffled.
    """
    micros = F.unix_micros(F.col(order[0]).cast("timestamp"))
    bucketed = df.withColumn("__bucket", F.floor(micros / F.lit(bucket_seconds * 1_000_000)))
    buckets = [*keys, "__bucket"]
    counted = materialise(bucketed.groupBy(*buckets).agg(F.count("*").alias("__c")), "counted")
    ranked = running_total(ordered_chunks(counted, keys, ["__bucket"]), keys, "__c", "__upto", "__n")
    first = F.col("__upto") - F.col("__c")
    step = F.greatest(F.lit(1), F.expr(f"__n div {max_points}"))
    wanted = ranked.select(*buckets, "__c", first.alias("__before"), step.alias("__step")).filter(
        F.ceil(F.col("__before") / F.col("__step")) * F.col("__step") < F.col("__before") + F.col("__c")
    )
    inside = attach_per_key(bucketed, wanted, buckets, "__c", how="inner").drop("__c")
    # Written before sorting: a range shuffle evaluates its input twice, and this input is a full scan.
    numbered = row_numbers(materialise(inside, "wanted"), buckets, order, "__rn", "__rows")
    position = F.col("__before") + F.col("__rn") - 1
    return numbered.filter(position % F.col("__step") == 0).select(*df.columns)


def box_summary(df: DataFrame, keys: list[str], value: str, whisker: float = 1.5) -> DataFrame:
    """Exact quartiles, whisker ends and outlier count per key. Nulls are left out.

    Equal values are counted first; quartiles are then read off a running count over the distinct values,
    so no task holds all values of a key.
    """
    counted = (
        df.filter(F.col(value).isNotNull())
        .groupBy(*keys, F.col(value).alias("__v"))
        .agg(F.count("*").alias("__c"))
    )
    chunked = ordered_chunks(materialise(counted, "counted"), keys, ["__v"])
    ranked = running_total(chunked, keys, "__c", "__upto", "n")

    quartiles = {"q1": 0.25, "median": 0.5, "q3": 0.75}
    around = []
    for name, q in quartiles.items():
        position = (F.col("n") - 1) * q
        for side, rank in [("lo", F.floor(position)), ("hi", F.ceil(position))]:
            reached = F.when(F.col("__upto") > rank, F.col("__v"))
            around.append(F.min(reached).alias(f"{name}_{side}"))
    found = ranked.groupBy(*keys, "n").agg(*around)
    boxes = found.select(
        *keys,
        "n",
        *[
            (
                F.col(f"{name}_lo")
                + (F.col(f"{name}_hi") - F.col(f"{name}_lo")) * ((F.col("n") - 1) * q % 1)
            ).alias(name)
            for name, q in quartiles.items()
        ],
    )
    boxes = materialise(boxes, "boxes")
    reach = whisker * (F.col("q3") - F.col("q1"))
    inside = F.col("__v").between(F.col("q1") - reach, F.col("q3") + reach)
    whiskers = (
        attach_per_key(chunked, boxes, keys, "n")
        .groupBy(*keys)
        .agg(
            F.min(F.when(inside, F.col("__v"))).alias("whisker_low"),
            F.max(F.when(inside, F.col("__v"))).alias("whisker_high"),
            F.sum(F.when(inside, 0).otherwise(F.col("__c"))).alias("outliers"),
        )
    )
    return join_on_keys(boxes, whiskers, keys)


def relative_returns(df: DataFrame, keys: list[str], order: list[str], value: str) -> DataFrame:
    """``value`` over the key's first value, minus one.

    The first value is an aggregate of the key that ``with_key_values`` adds, not a window over a whole symbol.
    """
    joined = with_key_values(df, keys, {"__first": F.min_by(value, F.struct(*order))})
    return joined.withColumn("return", F.col(value) / F.col("__first") - 1).drop("__first")


def series_returns(df: DataFrame, keys: list[str], order: list[str], columns: list[str]) -> DataFrame:
    """``columns`` as named series, each value with its return: over the first one of its key and series, minus one.

    First is the least by ``order``, then by value. A series that starts at 0 or null has no returns and is left
    out. The rows become several only after they have met, so that they cross the network once and unmultiplied.
    """
    firsts = {c: f"__first_{i}" for i, c in enumerate(columns)}
    joined = with_key_values(df, keys, {f: F.min_by(c, F.struct(*order, c)) for c, f in firsts.items()})
    each = [F.struct(F.lit(c).alias("series"), F.col(c).alias("value"), F.col(f).alias("__first")) for c, f in firsts.items()]
    others = [c for c in df.columns if c not in columns]
    series = joined.select(*others, F.inline(F.array(*each))).filter("__first <> 0")
    return series.withColumn("return", F.col("value") / F.col("__first") - 1).drop("__first")


#: Values a sketch keeps, and how far the rank of its quantiles may be off, as a share of all rows (99 % sure).
SKETCH_VALUES = 400
SKETCH_RANK_ERROR = 0.0095
OUTLIER_STEPS = 200


def value_sketches(df: DataFrame, keys: list[str], value: str, values: int = SKETCH_VALUES) -> DataFrame:
    """A quantile sketch of ``value`` per key (such as symbol and day), with n, least and most; nulls are left out.

    Sketches are small and merge: ``merge_sketches`` rolls them up over any of the keys, in any order, so that
    a summary of a longer span never reads the rows again.
    """
    number = F.col(value).cast("double")
    known = df.filter(number.isNotNull())
    return known.groupBy(*keys).agg(
        F.kll_sketch_agg_double(number, F.lit(values)).alias("sketch"),
        F.count("*").alias("n"),
        F.min(number).alias("least"),
        F.max(number).alias("most"),
    )


def merge_sketches(sketches: DataFrame, keys: list[str]) -> DataFrame:
    """The sketches of each key as one."""
    return sketches.groupBy(*keys).agg(
        F.kll_merge_agg_double("sketch").alias("sketch"),
        F.sum("n").alias("n"),
        F.min("least").alias("least"),
        F.max("most").alias("most"),
    )


def box_of_sketches(sketches: DataFrame, whisker: float = 1.5) -> DataFrame:
    """Box summary of each sketch: quartiles, least, most, and the share of rows beyond the whiskers' reach.

    Ranks are off by ``SKETCH_RANK_ERROR`` of the rows at most, with 99 % certainty; the share of outliers, read off
    quantiles half a percent apart, by twice that and half a percent.
    """
    steps = [i / OUTLIER_STEPS for i in range(OUTLIER_STEPS + 1)]
    quartiles = F.kll_sketch_get_quantile_double("sketch", F.array(*map(F.lit, [0.25, 0.5, 0.75])))
    grid = F.kll_sketch_get_quantile_double("sketch", F.array(*map(F.lit, steps)))
    boxes = sketches.withColumns({"__q": quartiles, "__grid": grid}).withColumns(
        {name: F.col("__q")[i] for i, name in enumerate(["q1", "median", "q3"])}
    )
    reach = whisker * (F.col("q3") - F.col("q1"))
    outside = F.filter("__grid", lambda v: (v < F.col("q1") - reach) | (v > F.col("q3") + reach))
    return boxes.withColumn("outlier_share", F.size(outside) / len(steps)).drop("__q", "__grid", "sketch")
