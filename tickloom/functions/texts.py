"""Text, byte and number expressions."""

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

# The quote page address and the suffix dropped from a symbol.
QUOTE_PREFIX = "https://www.google.com/finance/quote/"
QUOTE_SUFFIX = ":NASDAQ"
LOCAL_SUFFIX = ".NS"


def quote_url(symbol: Column, prefix: str = QUOTE_PREFIX, suffix: str = QUOTE_SUFFIX) -> Column:
    return F.concat(F.lit(prefix), F.replace(symbol, F.lit(LOCAL_SUFFIX), F.lit("")), F.lit(suffix))


def split_symbols(symbols: Column) -> Column:
    """Comma list to array; an empty or missing list gives an empty array."""
    return F.when(symbols != "", F.split(symbols, ",")).otherwise(F.array().cast("array<string>"))


def to_bytes(text: Column) -> Column:
    return F.encode(text, "UTF-8")


def to_text(data: Column) -> Column:
    return F.decode(data, "UTF-8")


def csv_line(*columns: Column, missing: str = "None") -> Column:
    """Comma-joined text of a row; missing values are spelled out, as the stored files do."""
    return F.concat_ws(",", *[F.coalesce(c.cast("string"), F.lit(missing)) for c in columns])


def money(value: Column, precision: int = 10, scale: int = 2) -> Column:
    """Round half up to a decimal; a value too large for the type gives null instead of failing."""
    return value.try_cast(DecimalType(precision, scale))
