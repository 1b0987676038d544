"""Table and message schemas. Every field is nullable: closed-market rows carry no measures."""

from pyspark.sql.types import (
    ArrayType,
    DoubleType,
    StringType,
    StructField,
    StructType,
)

MEASURES = ["Open", "High", "Low", "Close", "Volume"]
PRICES = ["Open", "High", "Low", "Close"]
FEATURES = ["Open", "High", "Low", "Volume"]
LABEL = "Close"

# Stored bar table. CSV binds an explicit schema by position, so writers keep this order.
BAR_TABLE = StructType(
    [StructField("Date", StringType())] + [StructField(c, DoubleType()) for c in MEASURES]
)

BAR_MESSAGE = StructType(
    [StructField("stock", StringType()), StructField("date", StringType())]
    + [StructField(c.lower(), DoubleType()) for c in MEASURES]
)

TICK_TABLE = StructType([StructField("time", StringType()), StructField("price", StringType())])

QUOTE_DOCUMENT = StructType(
    [
        StructField(
            "chart",
            StructType(
                [
                    StructField(
                        "result",
                        ArrayType(
                            StructType(
                                [
                                    StructField(
                                        "meta",
                                        StructType(
                                            [StructField("regularMarketPrice", DoubleType())]
                                        ),
                                    )
                                ]
                            )
                        ),
                    )
                ]
            ),
        )
    ]
)
