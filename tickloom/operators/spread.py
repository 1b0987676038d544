"""Per-key order statistics that never gather one key's rows in one task.

A single symbol may own a third of all rows, so nothing here uses a window over a whole symbol.
Rows are range-partitioned on (keys, order) instead: a hot symbol spans many partitions, and only one
small row per (key, partition) is combined across them.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickloom.storage import materialise

# Per-key tables within both bounds are broadcast; larger ones take the salted join.
BROADCAST_ROWS = 100_000
BROADCAST_BYTES = 64 * 1024 * 1024
# Rows of one key a single join task should handle in the salted join.
ROWS_PER_SLICE = 5_000_000
# Slices of every key where the hot ones are too many to list.
ALL_SLICES = 32
# Rows of one range partition.
ROWS_PER_CHUNK = 20_000_000
# Buckets of hashed keys in which rows are counted; half of them are filled by about as many keys as are broadcast.
KEY_BUCKETS = 131_072
# Rows that a task puts in order of their keys in memory.
ROWS_PER_TASK = 2_000_000


def key_of(keys: list[str]) -> Column:
    """The key columns as one value: as a struct, a null in a key equals another null."""
    return F.struct(*keys)


def join_on_keys(left: DataFrame, right: DataFrame, keys: list[str], how: str = "left") -> DataFrame:
    """Equi-join on ``keys`` where null matches null; keeps the left key columns once."""
    left = left.withColumn("__key", key_of(keys))
    right = right.withColumn("__key", key_of(keys)).drop(*keys)
    return left.join(right, "__key", how).drop("__key")


def fits_broadcast(df: DataFrame, rows: int = BROADCAST_ROWS) -> bool:
    """Measure a written table: whether its rows and their text size stay within the bounds."""
    text = F.octet_length(F.to_json(F.struct(*df.columns)))
    size = df.agg(F.count("*").alias("n"), F.coalesce(F.sum(text), F.lit(0)).alias("bytes")).first()
    return size["n"] <= rows and size["bytes"] <= BROADCAST_BYTES


def attach_per_key(
    rows: DataFrame,
    per_key: DataFrame,
    keys: list[str],
    count_col: str,
    broadcast_rows: int = BROADCAST_ROWS,
    rows_per_slice: int = ROWS_PER_SLICE,
    how: str = "left",
) -> DataFrame:
    """Add the columns of ``per_key`` (one row per key, ``count_col`` = rows of that key) to ``rows``.

    ``how="inner"`` keeps only rows whose key is listed.

    The table is written and measured first: small ones are broadcast. Otherwise only the hot keys are
    salted, each in proportion to its row count. The list of hot keys is itself broadcast only when it
    passes the same check.
    """
    per_key = materialise(per_key, "per-key")
    if fits_broadcast(per_key, broadcast_rows):
        return join_on_keys(rows, F.broadcast(per_key), keys, how)

    slices = F.ceil(F.col(count_col) / F.lit(rows_per_slice)).cast("int")
    hot = per_key.filter(F.col(count_col) > rows_per_slice).select(*keys, slices.alias("__slices"))
    # The partition number also spreads exact copies of a row, and stays the same when a task is re-run.
    # Maps and variants have no hash.
    hashable = [c for c, kind in rows.dtypes if "map<" not in kind and "variant" not in kind]
    spread = F.xxhash64(*hashable) + F.spark_partition_id()
    if how == "inner" and hot.isEmpty():
        # A plain join on the keys. The filter, true for all rows, marks the table as selective: from it Spark makes a
        # Bloom filter for the scan of ``rows`` (see ``session.SETTINGS``), so that others never reach the shuffle.
        return join_on_keys(rows, per_key.filter(F.col(count_col) > 0), keys, how)
    if fits_broadcast(hot, broadcast_rows):
        salt = F.pmod(spread, F.coalesce("__slices", F.lit(1))).cast("int")
        salted = join_on_keys(rows, F.broadcast(hot), keys).withColumn("__salt", salt).drop("__slices")
    else:
        # Too many hot keys to tell them apart without a shuffle on the key: all keys are salted alike.
        slices = F.lit(ALL_SLICES)
        salted = rows.withColumn("__salt", F.pmod(spread, slices).cast("int"))
    copies = per_key.withColumn(
        "__salt", F.explode(F.sequence(F.lit(0), F.greatest(slices, F.lit(1)) - 1))
    )
    return join_on_keys(salted, copies, keys + ["__salt"], how).drop("__salt")


def with_key_values(
    rows: DataFrame,
    keys: list[str],
    values: dict[str, Column],
    key_buckets: int = KEY_BUCKETS,
    rows_per_slice: int = ROWS_PER_SLICE,
    rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """Add ``values``, aggregates over all rows of a key, to each of its rows; a null in a key equals another null.

    Rows are first counted per bucket of hashed keys. For few keys the values are a table that ``attach_per_key``
    joins. For many, that table would be about as large as the rows and cross the network with them; instead the
    rows are shuffled once on their keys, into tasks that hold them in memory. The keys of a bucket with more than
    ``rows_per_slice`` rows are left out of that shuffle and joined.
    """
    bucket = F.pmod(F.xxhash64(*keys), F.lit(key_buckets))
    counted = rows.groupBy(bucket.alias("__bucket")).agg(F.count("*").alias("__c"))
    # Of all buckets only the hot ones are listed: at most one in ``rows_per_slice`` rows.
    hot = F.collect_list(F.when(F.col("__c") > rows_per_slice, F.col("__bucket")))
    filled, total, hot = counted.agg(F.count("*"), F.coalesce(F.sum("__c"), F.lit(0)), hot).first()

    def joined(some: DataFrame) -> DataFrame:
        per_key = some.groupBy(*keys).agg(*[v.alias(c) for c, v in values.items()], F.count("*").alias("__n"))
        return attach_per_key(some, per_key, keys, "__n").drop("__n")

    if filled <= key_buckets // 2:
        return joined(rows)
    asked = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    needed = -(-total // rows_per_task)
    met = rows.filter(~bucket.isin(hot)) if hot else rows
    # Shuffled here, as the window's own shuffle would also carry what the aggregates are made of.
    met = met.repartition(*([needed] if needed > asked else []), *keys)
    met = met.withColumns({c: v.over(Window.partitionBy(*keys)) for c, v in values.items()})
    return met.unionByName(joined(rows.filter(bucket.isin(hot)))) if hot else met


def range_partitions(df: DataFrame, rows_per_chunk: int = ROWS_PER_CHUNK) -> list[int]:
    """How many range partitions the rows of ``df`` need, or nothing if the session's setting is enough."""
    asked = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    needed = -(-df.count() // rows_per_chunk)
    return [needed] if needed > asked else []


def ordered_chunks(
    df: DataFrame, keys: list[str], order: list[str], rows_per_chunk: int = ROWS_PER_CHUNK
) -> DataFrame:
    """``df`` in order over all partitions: ``__chunk`` is the partition, ``__pos`` grows inside it.

    ``df`` should be a written table, or a projection of one: it is counted, so that partitions stay within
    ``rows_per_chunk`` whatever the session's setting, and read twice by the range shuffle. The result is
    written, because recomputing a range shuffle may choose other bounds. ``keys + order`` should identify
    a row; should there be many rows with equal values, the partition they come from parts them.
    """
    by = [*keys, *order, "__from"]
    parts = range_partitions(df, rows_per_chunk)
    ranged = df.withColumn("__from", F.spark_partition_id()).repartitionByRange(*parts, *by)
    placed = ranged.sortWithinPartitions(*by).withColumns(
        {"__chunk": F.spark_partition_id(), "__pos": F.monotonically_increasing_id()}
    )
    return materialise(placed.drop("__from"), "ordered")


def _before(chunks: DataFrame, keys: list[str], total: str, whole: str) -> DataFrame:
    """Per (key, chunk): the sum over the key's earlier chunks and over all of them.

    The windows see one row per key and partition, however many rows the key has.
    """
    per_key = Window.partitionBy(*keys)
    earlier = per_key.orderBy("__chunk").rowsBetween(Window.unboundedPreceding, -1)
    return chunks.withColumns(
        {
            "__offset": F.coalesce(F.sum(total).over(earlier), F.lit(0)),
            whole: F.sum(total).over(per_key),
        }
    )


def row_numbers(
    df: DataFrame, keys: list[str], order: list[str], name: str = "row", whole: str = "rows"
) -> DataFrame:
    """Number the rows of each key in ``order`` from 1, and add the key's row count.

    One range shuffle; numbers follow from positions inside the partitions, without a window over rows.
    """
    chunked = ordered_chunks(df, keys, order)
    chunks = chunked.groupBy(*keys, "__chunk").agg(
        F.min("__pos").alias("__first"), F.count("*").alias("__rows")
    )
    placed = _before(chunks, keys, "__rows", whole)
    joined = attach_per_key(chunked, placed, keys + ["__chunk"], "__rows")
    number = F.col("__offset") + F.col("__pos") - F.col("__first") + 1
    return joined.withColumn(name, number).drop("__chunk", "__pos", "__first", "__rows", "__offset")


def running_total(
    chunked: DataFrame,
    keys: list[str],
    weight: str,
    name: str = "running_total",
    whole: str = "whole_total",
) -> DataFrame:
    """Inclusive running sum of a whole-number ``weight`` per key, and the key's total.

    ``chunked`` comes from ``ordered_chunks``. Rows are summed inside their chunk, whose size the range
    shuffle bounds.
    """
    chunks = chunked.groupBy(*keys, "__chunk").agg(
        F.sum(weight).alias("__total"), F.count("*").alias("__rows")
    )
    placed = _before(chunks, keys, "__total", whole)
    inside = (
        Window.partitionBy(*keys, "__chunk")
        .orderBy("__pos")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    summed = chunked.withColumn("__inside", F.sum(weight).over(inside))
    joined = attach_per_key(summed, placed, keys + ["__chunk"], "__rows")
    return joined.withColumn(name, F.col("__offset") + F.col("__inside")).drop(
        "__chunk", "__pos", "__inside", "__total", "__rows", "__offset"
    )


def following(df: DataFrame, keys: list[str], order: str, chunk: Column, value: str, name: str) -> DataFrame:
    """``value`` of the next row per key, like ``lead``, in chunks (e.g. days) of bounded size.

    ``chunk`` must grow with ``order``. Rows meet only inside their chunk; the last row of a chunk takes
    the first value of the key's next chunk, from a table with one row per (key, chunk). Window and join
    share one partitioning, so ``df`` is shuffled once.
    """
    df = df.withColumn("__chunk", chunk)
    df = df.withColumn("__key", key_of([*keys, "__chunk"]))
    boxed = F.struct(F.col(value).alias("v"))
    inside = df.withColumn("__next", F.lead(boxed).over(Window.partitionBy("__key").orderBy(order)))
    first = df.groupBy(*keys, "__chunk").agg(F.min_by(value, order).alias("v"))
    next_first = F.lead(F.struct("v")).over(Window.partitionBy(*keys).orderBy("__chunk"))
    across = first.select(
        key_of([*keys, "__chunk"]).alias("__key"), next_first.alias("__across")
    )
    joined = inside.join(across, "__key", "left")
    return joined.withColumn(name, F.coalesce("__next", "__across")["v"]).drop(
        "__key", "__chunk", "__next", "__across"
    )
