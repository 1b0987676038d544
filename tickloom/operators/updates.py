"""Unions and de-duplication of re-sent rows."""

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def union_all(frames: list[DataFrame]) -> DataFrame:
    """Bag union by column name. For files of one folder prefer a single scan."""
    return reduce(DataFrame.unionByName, frames)


# Types whose aggregation buffers Spark updates in place, which hash aggregation needs.
_FIXED_WIDTH = {
    "boolean", "tinyint", "smallint", "int", "bigint", "float", "double", "date", "timestamp", "timestamp_ntz",
}


def last_per_key(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The last row per key. Combined before the shuffle, so many copies of one key cost one row per task.

    With one order column and fixed-width columns only, each column is picked by itself, which allows
    hash aggregation; the pick falls on the same row for all. Otherwise the row is carried as a struct.
    """
    columns = [c for c in df.columns if c not in keys]
    types = dict(df.dtypes)
    if len(order) == 1 and all(types[c] in _FIXED_WIDTH for c in [*columns, *order]):
        last = df.groupBy(*keys).agg(*[F.max_by(c, order[0]).alias(c) for c in columns])
        return last.select(*df.columns)
    position = F.struct(*order) if len(order) > 1 else F.col(order[0])
    row = F.max_by(F.struct(*columns), position).alias("row")
    return df.groupBy(*keys).agg(row).select(*keys, "row.*").select(*df.columns)


def history_then_live(
    history: DataFrame, live: DataFrame, keys: list[str], arrival: list[str] | None = None
) -> DataFrame:
    """Backfilled rows followed by live rows; where both have a key, the live row counts.

    Of several live versions of a key the last by the ``arrival`` columns (in both tables) counts. Without
    them the live rows must be unique per key; should they not be, the largest row counts, on every run.
    """
    both = union_all([history.withColumn("__live", F.lit(0)), live.withColumn("__live", F.lit(1))])
    rest = [c for c in history.columns if c not in keys]
    return last_per_key(both, keys, ["__live", *(arrival or rest)]).drop("__live")


def current_rows(stored: DataFrame, keys: list[str], arrival: list[str]) -> DataFrame:
    """The last stored version of each key by its ``arrival`` columns, which are dropped."""
    return last_per_key(stored, keys, arrival).drop(*arrival)
