"""A table stored sorted by symbol and time, with the range of each file, so that range scans skip files."""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.sources.files import decoded_path

ROWS_PER_FILE = 4_000_000


def write_sorted(
    df: DataFrame, folder: str, key: str = "stock", ts: str = "ts", order: list[str] | None = None,
    rows_per_file: int = ROWS_PER_FILE,
) -> None:
    """Store ``df`` in files of neighbouring (symbol, time) ranges, and a table of those ranges beside them.

    One range shuffle, which also divides a hot symbol over many files. ``order`` are further sort columns, such as
    the event number, that part rows of equal times.
    """
    by = [key, ts, *(order or [])]
    rows = df.repartitionByRange(*by).sortWithinPartitions(*by)
    rows.write.mode("overwrite").option("maxRecordsPerFile", rows_per_file).parquet(f"{folder}/rows")
    stored = df.sparkSession.read.schema(df.schema).parquet(f"{folder}/rows")
    ranges = stored.groupBy(decoded_path(F.col("_metadata.file_path")).alias("path")).agg(
        F.min(ts).alias("ts_from"),
        F.max(ts).alias("ts_to"),
        F.min(F.struct(key, ts)).alias("first"),
        F.max(F.struct(key, ts)).alias("last"),
        F.count("*").alias("rows"),
    )
    ranges.write.mode("overwrite").parquet(f"{folder}/ranges")


def files_in_range(
    spark: SparkSession, folder: str, symbols: list[str], start: Column, end: Column, ts: str = "ts", key: str = "stock"
) -> list[str]:
    """Files that may hold rows of a listed symbol with start <= time < end.

    A file runs from its first to its last (symbol, time); a symbol's range meets it unless it lies before or behind.
    """
    ranges = spark.read.parquet(f"{folder}/ranges")
    low = [F.struct(F.lit(s).alias(key), start.alias(ts)) for s in symbols]
    high = [F.struct(F.lit(s).alias(key), end.alias(ts)) for s in symbols]
    meets = F.lit(False)
    for a, b in zip(low, high, strict=True):
        meets = meets | ((F.col("last") >= a) & (F.col("first") < b))
    meets = meets & (F.col("ts_to") >= start) & (F.col("ts_from") < end)
    return [r["path"] for r in ranges.filter(meets).select("path").toLocalIterator()]


def read_range(
    spark: SparkSession, folder: str, symbols: list[str], start: Column, end: Column, ts: str = "ts", key: str = "stock"
) -> DataFrame:
    """Rows of the listed symbols with start <= time < end; other files are not opened.

    Inside the files left, the filter reaches the scan and skips row groups.
    """
    files = files_in_range(spark, folder, symbols, start, end, ts, key)
    schema = spark.read.parquet(f"{folder}/rows").schema
    reader = spark.read.schema(schema)
    rows = reader.parquet(*files) if files else spark.createDataFrame([], schema)
    return rows.filter(F.col(key).isin(symbols) & (F.col(ts) >= start) & (F.col(ts) < end))
