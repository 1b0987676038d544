"""Missing values, decimals and the closed-market flag."""

from functools import reduce
from operator import and_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.functions.texts import money
from tickloom.schemas import MEASURES

# Volumes pass the ten digits of prices.
VOLUME_PRECISION = 20


def not_null(df: DataFrame, column: str = "Open") -> DataFrame:
    return df.filter(F.col(column).isNotNull())


def drop_missing(df: DataFrame, subset: list[str] | None = None) -> DataFrame:
    """Drop rows with a null or NaN in any (listed) column."""
    return df.na.drop("any", subset=subset)


def fill_missing(df: DataFrame, value: float = 0.0, subset: list[str] = MEASURES) -> DataFrame:
    """Replace null and NaN measures."""
    return df.na.fill(value, subset=subset)


def flag_closed(df: DataFrame, measures: list[str] = MEASURES) -> DataFrame:
    """``MarketClosed`` = 1 where every measure is null."""
    closed = reduce(and_, [F.col(c).isNull() for c in measures])
    return df.withColumn("MarketClosed", closed.cast("int"))


def to_decimals(
    df: DataFrame, measures: list[str] = MEASURES, precision: int = 10, scale: int = 2,
    volume_precision: int = VOLUME_PRECISION,
) -> DataFrame:
    """Measures as decimals, null where too large; volumes get a wider type than prices."""
    widths = {c: precision for c in measures}
    if "Volume" in widths:
        widths["Volume"] = volume_precision
    return df.withColumns({c: money(F.col(c), w, scale) for c, w in widths.items()})


def clean_bars(
    df: DataFrame,
    policy: str = "fill",
    flag_before_fill: bool = True,
    volume_precision: int = VOLUME_PRECISION,
) -> DataFrame:
    """The cleaning chain: missing values, decimals, flag.

    ``policy`` is ``fill`` (zeros) or ``drop``. The flag is taken before filling, where it can still see
    the nulls; ``flag_before_fill=False`` takes it at the end, where it is always 0.
    """
    if policy not in ("fill", "drop"):
        raise ValueError("policy must be 'fill' or 'drop'")
    if policy == "drop":
        return flag_closed(to_decimals(drop_missing(df, MEASURES), volume_precision=volume_precision))
    flagged = flag_closed(df) if flag_before_fill else df
    cleaned = to_decimals(fill_missing(flagged), volume_precision=volume_precision)
    return cleaned if flag_before_fill else flag_closed(cleaned)
