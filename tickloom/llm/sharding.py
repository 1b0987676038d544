"""Sharding: a uniform shuffle into shards of exact sizes, planned by a communication matrix.

The rows lie in blocks (of input partitions). How many rows of each block go to each shard follows the
multivariate hypergeometric law, which is what a uniform shuffle of all rows would show. So the matrix of
counts is drawn first; then each block permutes its rows and cuts them by its counts, the pieces are
exchanged, and each shard permutes what it got. The shard sizes are exact: they differ by one row at most.
"""

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tickloom.llm.tables import free_name, materialise
from tickloom.operators.spread import attach_per_key, row_numbers

#: Blocks at most: input partitions beyond share them, so that the driver's matrix stays small.
MOST_BLOCKS = 16_384
#: Numpy's own generator is exact below this population; above it the law is summed around its mode.
NUMPY_LIMIT = 500_000_000


def hypergeometric(rng: np.random.Generator, good: int, bad: int, draws: int) -> int:
    """Good ones among ``draws`` from ``good + bad``, for populations of any size."""
    if good + bad < NUMPY_LIMIT:
        return int(rng.hypergeometric(good, bad, draws)) if draws else 0
    low, high = max(0, draws - bad), min(draws, good)
    total = good + bad
    mean = draws * good / total
    spread = (draws * (good / total) * (bad / total) * (total - draws) / max(1, total - 1)) ** 0.5
    first, last = max(low, int(mean - 12 * spread - 20)), min(high, int(mean + 12 * spread + 20))
    k = np.arange(first, last, dtype=np.float64)
    step = np.log((good - k) * (draws - k)) - np.log((k + 1) * (bad - draws + k + 1))
    logs = np.concatenate(([0.0], np.cumsum(step)))
    chances = np.exp(logs - logs.max())
    return first + int(np.searchsorted(np.cumsum(chances), rng.random() * chances.sum()))


def shard_sizes(rows: int, shards: int) -> list[int]:
    return [rows // shards + (s < rows % shards) for s in range(shards)]


def communication_matrix(blocks: list[int], shards: list[int], seed: int) -> list[list[int]]:
    """How many rows of each block go to each shard: a uniform draw among all shuffles."""
    rng = np.random.default_rng(seed)
    open_places = list(shards)
    matrix = []
    for rows in blocks:
        left, places, given = rows, sum(open_places), []
        for free in open_places:
            taken = hypergeometric(rng, free, places - free, left)
            given.append(taken)
            left, places = left - taken, places - free
        open_places = [free - taken for free, taken in zip(open_places, given, strict=True)]
        matrix.append(given)
    return matrix


def shard_rows(rows: DataFrame, shards: int, seed: int = 0) -> DataFrame:
    """Add ``shard`` (0 to shards - 1) and ``slot`` (gapless from 0 in each shard) to ``rows``.

    The rows are written once with their block and place, so that counts and permutations see the same
    blocks even if a task is run again. Permutations work on places; whole rows move once, in the exchange.
    The driver holds one number per (block, shard), of at most ``MOST_BLOCKS`` blocks, never rows. Any columns and any repeated rows are kept;
    columns that are called shard or slot are replaced. A table without rows gives none.
    """
    kept = [c for c in rows.columns if c.lower() not in ("shard", "slot")]
    block, place = free_name(rows, "block"), free_name(rows, "place")
    stored = materialise(
        rows.select(*kept).withColumns({block: F.spark_partition_id() % MOST_BLOCKS, place: F.monotonically_increasing_id()}),
        "blocks",
    )
    places = stored.select(F.col(block).alias("block"), F.col(place).alias("place"))
    counts = {r["block"]: r["n"] for r in places.groupBy("block").agg(F.count("*").alias("n")).collect()}
    blocks = sorted(counts)
    sizes = shard_sizes(sum(counts.values()), shards)
    matrix = communication_matrix([counts[b] for b in blocks], sizes, seed)
    entries = [
        (b, np.cumsum(given).tolist(), counts[b]) for b, given in zip(blocks, matrix, strict=True)
    ]
    ends = rows.sparkSession.createDataFrame(entries, "block int, ends array<long>, rows long")
    # First permutation: inside the block, on places alone.
    local = Window.partitionBy("block").orderBy(F.xxhash64(F.lit(seed), "place"), "place")
    told = attach_per_key(places.withColumn("rank", F.row_number().over(local)), ends, ["block"], "rows")
    passed = F.size(F.filter("ends", lambda end: end < F.col("rank")))
    sent = told.select("place", passed.alias("shard"), F.xxhash64(F.lit(seed + 1), "place").alias("draw"))
    sent = materialise(sent, "sent")
    # Second permutation: numbers in a range order of (shard, draw), so that a shard of any size is spread
    # over many tasks.
    numbered = row_numbers(sent, ["shard"], ["draw", "place"], "slot", "whole")
    slots = numbered.select(F.col("place").alias(place), "shard", (F.col("slot") - 1).alias("slot"))
    return stored.join(slots, place).drop(block, place)


def write_shards(docs: DataFrame, shards: int, path: str, seed: int = 0) -> DataFrame:
    """Write ``docs`` as one folder per shard, each file sorted by slot; returns the written table."""
    sharded = shard_rows(docs, shards, seed)
    (
        sharded.repartitionByRange("shard", "slot")
        .sortWithinPartitions("shard", "slot")
        .write.partitionBy("shard")
        .parquet(path)
    )
    return docs.sparkSession.read.parquet(path)
