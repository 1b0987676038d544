"""Bar tables in files: one symbol, all symbols, fixed or inferred schema."""

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tickloom.schemas import BAR_TABLE


def symbol_path(folder: str, symbol: str) -> str:
    return f"{folder.rstrip('/')}/{symbol}.csv"


def read_bars(
    spark: SparkSession, path: str | list[str], schema: StructType = BAR_TABLE, check_header: bool = False
) -> DataFrame:
    """CSV bars with a fixed schema; the text ``None`` is not a number and reads as null.

    Columns are bound by position. ``check_header=True`` binds nothing silently: a file whose header is
    in another order fails.
    """
    return (
        spark.read.schema(schema)
        .option("header", True)
        .option("nullValue", "None")
        .option("enforceSchema", not check_header)
        .csv(path)
    )


def read_bars_inferred(spark: SparkSession, path: str | list[str], null_value: str = "None") -> DataFrame:
    """CSV bars with an inferred schema (an extra pass over the files)."""
    return spark.read.csv(path, header=True, inferSchema=True, nullValue=null_value)


def load_symbol(
    spark: SparkSession, folder: str, symbol: str, partitioned: bool = False, file_format: str = "csv"
) -> DataFrame:
    """All bars of one symbol: from ``<folder>/<symbol>.csv``, or only its folder of a partitioned store."""
    if not partitioned:
        return read_bars(spark, symbol_path(folder, symbol))
    every = read_all_symbols(spark, folder, partitioned=True, file_format=file_format)
    return every.filter(F.col("Stock") == symbol).drop("Stock")


def decoded_path(path: Column) -> Column:
    """A file's path as it can be read again: Spark's paths are percent-encoded but keep a plus sign."""
    # Decoding would turn the plus sign into a space.
    return F.url_decode(F.replace(path, F.lit("+"), F.lit("%2B")))


def symbol_from_path(path: Column) -> Column:
    """The symbol in ``…/AAPL.csv`` or ``…/AAPL.csv/part-0.csv``."""
    return decoded_path(F.regexp_extract(path, r"([^/]+)\.csv(?:/[^/]*)?$", 1))


def read_all_symbols(
    spark: SparkSession,
    folder: str,
    partitioned: bool = False,
    schema: StructType = BAR_TABLE,
    file_format: str = "csv",
) -> DataFrame:
    """Every symbol's bars in one scan, with the symbol as column ``Stock``.

    ``partitioned=False`` reads a flat folder of ``<symbol>.csv`` files; ``partitioned=True`` reads
    ``stock=<symbol>/`` folders, where a filter on the symbol prunes whole folders. A folder without
    files of the format gives an empty table.
    """
    reader = spark.read.format(file_format).option("pathGlobFilter", f"*.{file_format}")
    if file_format == "csv":
        reader = reader.option("header", True).option("nullValue", "None")
    if partitioned:
        fields = StructType([*schema.fields, StructField("stock", StringType())])
        return reader.schema(fields).load(folder).withColumnRenamed("stock", "Stock")
    bars = reader.schema(schema).load(folder)
    return bars.withColumn("Stock", symbol_from_path(F.col("_metadata.file_path")))


# Types a column may have in some files, and the one that holds both; anything else becomes text.
_NUMBERS = ["int", "bigint", "double"]


def wider(a: str, b: str) -> str:
    """The narrowest type that both columns can be read as."""
    if a == b:
        return a
    if a in _NUMBERS and b in _NUMBERS:
        return max(a, b, key=_NUMBERS.index)
    if {a, b} <= {"date", "timestamp", "timestamp_ntz"}:
        return "timestamp"
    return "string"


def headers(spark: SparkSession, folder: str) -> DataFrame:
    """(header, files): the CSV files below a folder, grouped by their first line. One pass over the files."""
    lines = spark.read.option("pathGlobFilter", "*.csv").option("recursiveFileLookup", True).text(folder)
    place = F.struct(F.col("_metadata.file_block_start"), F.monotonically_increasing_id())
    path = decoded_path(F.col("_metadata.file_path")).alias("path")
    first = lines.select(path, F.col("value"), place.alias("place")).groupBy("path").agg(
        F.min_by("value", "place").alias("header")
    )
    header = F.regexp_replace("header", "^\ufeff|\\s+$", "").alias("header")
    return first.groupBy(header).agg(F.sort_array(F.collect_list("path")).alias("files"))


def read_mixed(spark: SparkSession, folder: str, null_value: str = "None") -> DataFrame:
    """CSV files of different headers as one table, its columns bound by name, with the symbol of each file.

    Files are grouped by header; each group is read with inferred types (an extra pass, as ``read_bars_inferred``), which
    are then widened to hold all groups. A column that a file lacks is null, whatever the order in the files.
    Only the list of files and headers reaches the driver.
    """
    groups = []
    for row in headers(spark, folder).orderBy("header").toLocalIterator():
        bars = spark.read.csv(
            row["files"], header=True, inferSchema=True, nullValue=null_value,
            ignoreLeadingWhiteSpace=True, ignoreTrailingWhiteSpace=True,
        )
        groups.append(bars.withColumn("Stock", symbol_from_path(F.col("_metadata.file_path"))))
    if not groups:
        raise FileNotFoundError(f"no CSV files in {folder}")
    kinds: dict[str, str] = {}
    for bars in groups:
        # A column without any value is inferred as text, but holds nothing that would need it.
        empty = bars.select([F.count(c).alias(c) for c, kind in bars.dtypes if kind == "string"]).first().asDict()
        for name, kind in bars.dtypes:
            if empty.get(name) != 0:
                kinds[name] = wider(kinds.get(name, kind), kind)
    for bars in groups:
        kinds = {**{name: "string" for name in bars.columns if name not in kinds}, **kinds}
    names = list(dict.fromkeys(name for bars in groups for name in bars.columns if name != "Stock"))
    return reduce(
        DataFrame.unionByName,
        [
            bars.select(*[(F.col(c) if c in bars.columns else F.lit(None)).cast(kinds[c]).alias(c) for c in [*names, "Stock"]])
            for bars in groups
        ],
    )
