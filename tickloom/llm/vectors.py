"""What the vector searches share: usable vectors, blocks of rows against blocks of queries, merging."""

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def finite(table: DataFrame, *columns: Column | str) -> DataFrame:
    """Rows (vec_id, v, and ``columns``) of an embeddings table whose vector is whole: v as doubles.

    Vectors that are null or hold null or non-finite components are left out, and rows without a vec_id.
    """
    v = F.transform("embedding", lambda x: x.cast("double"))
    rows = table.select(F.col("vec_id").cast("long").alias("vec_id"), v.alias("v"), *columns)

    def bad(x: Column) -> Column:
        return x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))

    return rows.filter(F.col("vec_id").isNotNull() & F.col("v").isNotNull() & ~F.exists("v", bad))


def usable(table: DataFrame, component: str = "double", nonzero: bool = False) -> DataFrame:
    """Rows (row, vec_id, v) of an embeddings table whose vector can be compared; write them before use.

    Vectors that are null or hold null or non-finite components are left out, also zero ones if
    ``nonzero``; so are rows without a vec_id. Every row counts, also repeated ones: ``row`` tells them apart.
    """
    rows = finite(table)
    if nonzero:
        rows = rows.filter(F.exists("v", lambda x: x != 0))
    if component != "double":
        rows = rows.withColumn("v", F.transform("v", lambda x: F.floor(x * 1024)))
    return rows.select(F.monotonically_increasing_id().alias("row"), "vec_id", "v")


def matrix(column: pa.ChunkedArray, width: int, kind: type) -> np.ndarray:
    """A column of number lists as a matrix; shorter lists are filled with zeros."""
    lists = column.combine_chunks()
    lengths = np.diff(lists.offsets.to_numpy())
    values = lists.flatten().to_numpy(zero_copy_only=False)
    if len(lengths) and (lengths == width).all():
        return values.reshape(len(lengths), width).astype(kind)
    out = np.zeros((len(lengths), width), kind)
    rows = np.repeat(np.arange(len(lengths)), lengths)
    starts = np.repeat(np.cumsum(lengths) - lengths, lengths)
    out[rows, np.arange(len(values)) - starts] = values
    return out


def best(found: DataFrame, k: int) -> DataFrame:
    """The ``k`` best rows (query_id, query_row, vec_id, score) of each query, ties to the smaller vec_id, ranked from 1."""
    order = Window.partitionBy("query_row").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
