"""Reading tables, safe column names and intermediate tables shared by the operators."""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.storage import materialise

# A word is a run of characters other than ASCII blanks.
WORD = r"[^\x20\x09-\x0D]+"


def read(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def documents(spark: SparkSession, folder: str) -> DataFrame:
    return read(spark, folder, "documents")


def count_words(text: Column) -> Column:
    """Number of words of a text; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def free_name(df: DataFrame, wanted: str) -> str:
    """``wanted``, with underscores in front until no column of ``df`` has that name in any case."""
    taken = {c.lower() for c in df.columns}
    while wanted.lower() in taken:
        wanted = f"_{wanted}"
    return wanted


def text_key(text: Column) -> list[Column]:
    """Two independent 64-bit hashes that stand for a text; null counts as the empty text."""
    text = F.coalesce(text, F.lit(""))
    return [F.xxhash64(text), F.xxhash64(F.lit(7), text)]


def partitions(df: DataFrame) -> int:
    """Shuffle partitions to use: the session's setting."""
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


__all__ = [
    "WORD",
    "count_words",
    "documents",
    "free_name",
    "materialise",
    "partitions",
    "read",
    "text_key",
]
