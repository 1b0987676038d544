"""File sinks. Reader and writer agree on column order and on ``None`` for a missing measure."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.functions.documents import to_json
from tickloom.functions.times import clock_text


def append_bars_by_symbol(bars: DataFrame, folder: str, file_format: str = "csv") -> None:
    """Append a bar table with column ``stock`` to ``<folder>/stock=<symbol>/``.

    CSV is the compatible layout; Parquet is read column by column and skips row groups. The rebalance
    hint gathers each symbol into few files and lets adaptive execution split a hot symbol over several
    tasks.
    """
    writer = bars.hint("rebalance", "stock").write.mode("append").partitionBy("stock")
    if file_format == "csv":
        writer = writer.option("header", True).option("nullValue", "None")
    writer.format(file_format).save(folder)


def append_ticks(ticks: DataFrame, folder: str, price: str = "value") -> None:
    """Append (arrival time, price as text) rows."""
    arrived = clock_text(F.current_timestamp()).alias("time")
    rows = ticks.select(arrived, F.col(price).cast("string").alias("price"))
    rows.write.mode("append").option("header", True).csv(folder)


def write_snapshot(document: DataFrame, path: str, column: str = "document") -> None:
    """Replace the stored snapshot by one document, pretty-printed."""
    document.select(F.col(column)).write.mode("overwrite").text(path, lineSep="\n")


def pretty_document(*columns: Column) -> Column:
    """Struct columns as indented JSON text."""
    return to_json(*columns, pretty=True)


def write_table_csv(df: DataFrame, path: str, index: str) -> None:
    """Replace a CSV copy of a whole table, its index as the first column."""
    ordered = df.select(index, *[c for c in df.columns if c != index])
    ordered.write.mode("overwrite").option("header", True).option("nullValue", "").csv(path)
