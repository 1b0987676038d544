"""Bars and ticks as keyed text messages, and back."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tickloom.functions.documents import from_json, to_json
from tickloom.schemas import BAR_MESSAGE, MEASURES

_DAMAGED = "__damaged"


def bar_to_message(bars: DataFrame, date: Column, symbol: Column) -> DataFrame:
    """Stored bar columns to message fields; columns outside the message are dropped."""
    return bars.select(
        symbol.alias("stock"), date.alias("date"), *[F.col(c).alias(c.lower()) for c in MEASURES]
    )


def to_messages(records: DataFrame, key: str = "stock") -> DataFrame:
    """Keyed JSON messages; null measures stay visible as ``null``."""
    return records.select(F.col(key).alias("key"), to_json(*records.columns).alias("value"))


def to_text_messages(df: DataFrame, key: str, value: str) -> DataFrame:
    """Keyed plain-text messages."""
    return df.select(F.col(key).alias("key"), F.col(value).cast("string").alias("value"))


def parse_messages(messages: DataFrame, value: str = "value", keep: list[str] | None = None) -> DataFrame:
    """Message fields beside the raw text (and columns to keep); unreadable text has no ``stock``."""
    parsed = messages.withColumn("__m", from_json(F.col(value), BAR_MESSAGE))
    return parsed.select(value, *(keep or []), "__m.*")


def _parsed(value: str) -> Column:
    """The message's fields, and the whole text in ``__damaged`` where a field has another type."""
    fields = StructType([*BAR_MESSAGE.fields, StructField(_DAMAGED, StringType())])
    return from_json(F.col(value), fields, damaged=_DAMAGED)


def _values(value: str) -> Column:
    """How many JSON values the text holds, separated by commas; null if it is no JSON."""
    # Not-a-number is no JSON, but a measure like any other here.
    plain = F.regexp_replace(F.col(value), r":\s*-?(NaN|Infinity)\b", ":null")
    return F.json_array_length(F.concat(F.lit("["), plain, F.lit("]")))


def _readable(value: str) -> Column:
    """The message as an array of one, or of none if it is not a whole, well-typed message.

    Symbol and date must be there, and nothing may follow the object; a field of another type is a fault,
    a ``null`` measure is not. Testing inside the array parses each text once; a filter on a parsed column
    would be moved before the parsing and parse a second time.
    """
    single = _values(value) == 1
    return F.filter(
        F.array(_parsed(value)),
        lambda m: m["stock"].isNotNull() & m["date"].isNotNull() & m[_DAMAGED].isNull() & single,
    )


def judged(messages: DataFrame, value: str = "value") -> DataFrame:
    """Every message with its fields as struct ``bar`` and the ``reason`` it is rejected for, null if it is not.

    The reasons, first to hold: ``no text``, ``not json``, ``not one object`` (several values, or none), ``wrong
    type``, ``no symbol``, ``no date``. Rows without a reason are those that ``accepted`` gives.
    """
    rows = messages.select(F.col(value).alias("value"), _parsed(value).alias("bar"), _values(value).alias("n"))
    faults = [
        (F.col("value").isNull(), "no text"),
        (F.col("n").isNull(), "not json"),
        (F.col("n") != 1, "not one object"),
        (F.col("bar").isNull() | F.col(f"bar.{_DAMAGED}").isNotNull(), "wrong type"),
        (F.col("bar.stock").isNull(), "no symbol"),
        (F.col("bar.date").isNull(), "no date"),
    ]
    reason = F.coalesce(*[F.when(test, F.lit(name)) for test, name in faults])
    return rows.select("value", F.col("bar").dropFields(_DAMAGED).alias("bar"), reason.alias("reason"))


def stored_bars(judged_rows: DataFrame) -> DataFrame:
    """The accepted rows of ``judged`` as stored bars, like ``accepted``."""
    good = judged_rows.filter(F.col("reason").isNull())
    return good.select(
        F.col("bar.date").alias("Date"), *[F.col(f"bar.{c.lower()}").alias(c) for c in MEASURES], F.col("bar.stock").alias("stock")
    )


def accepted(messages: DataFrame, value: str = "value") -> DataFrame:
    """Readable messages as stored bars: Date, Open, High, Low, Close, Volume, stock."""
    return messages.select(F.inline(_readable(value))).drop(_DAMAGED).select(
        F.col("date").alias("Date"), *[F.col(c.lower()).alias(c) for c in MEASURES], "stock"
    )


def rejected(messages: DataFrame, value: str = "value") -> DataFrame:
    """Raw text of all other messages, a missing text included."""
    return messages.filter(F.coalesce(F.size(_readable(value)), F.lit(0)) < 1).select(value)
