"""JSON expressions over text columns."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

QUOTE_PRICE_PATH = "$.chart.result[0].meta.regularMarketPrice"

# Fields of a symbol's details, the key each is read from, and the default for a missing key.
DETAIL_FIELDS = [
    ("ShortName", "shortName", ""),
    ("LongName", "longName", ""),
    ("Industry", "industry", ""),
    ("Sector", "sector", ""),
    ("MarketCap", "marketCap", 0),
    ("ForwardPE", "forwardPE", 0),
    ("TrailingPE", "trailingPE", 0),
    ("Currency", "currency", ""),
    ("FiftyTwoWeekHigh", "fiftyTwoWeekHigh", 0),
    ("FiftyTwoWeekLow", "fiftyTwoWeekLow", 0),
    ("FiftyDayAverage", "fiftyDayAverage", 0),
    ("Exchange", "exchange", ""),
    ("ShortRatio", "shortRatio", 0),
]


def to_json(*columns: Column | str, pretty: bool = False, keep_nulls: bool = True) -> Column:
    options = {"ignoreNullFields": str(not keep_nulls).lower(), "pretty": str(pretty).lower()}
    return F.to_json(F.struct(*columns), options)


def from_json(text: Column, schema: StructType, damaged: str | None = None) -> Column:
    """Permissive parse: wrong-typed fields and malformed documents give nulls, never an error.

    ``damaged`` names a string field of the schema that takes the text where that happened.
    """
    options = {"mode": "PERMISSIVE"}
    if damaged:
        options["columnNameOfCorruptRecord"] = damaged
    return F.from_json(text, schema, options)


def json_path(document: Column, path: str) -> Column:
    return F.get_json_object(document, path)


def quote_price(document: Column) -> Column:
    return json_path(document, QUOTE_PRICE_PATH).try_cast("double")


def symbol_details(
    details: DataFrame, symbol: Column, day: Column, document: Column, fields=DETAIL_FIELDS
) -> DataFrame:
    """The details row of each symbol: date, symbol and one column per field.

    The document is parsed once for all fields. A missing key takes the field's default, which also sets
    the column's type.
    """
    wanted = StructType(
        [
            StructField(key, StringType() if isinstance(default, str) else DoubleType())
            for key, default in {key: default for _, key, default in fields}.items()
        ]
    )
    parsed = details.select(
        day.alias("Date"), symbol.alias("Symbol"), from_json(document, wanted).alias("__d")
    )
    values = [
        F.coalesce(
            F.col("__d").getField(key), F.lit(default if isinstance(default, str) else float(default))
        ).alias(name)
        for name, key, default in fields
    ]
    return parsed.select("Date", "Symbol", *values)
