"""Approximate nearest neighbours by shifted space-filling curves.

Each curve projects the vectors at random to a few dimensions, shifts them, and orders them along a Hilbert
curve. The orders are range-partitioned in Spark and numbered. A query looks at the rows whose numbers lie
within a window of its own in any of the orders; what the windows hold is scored on the original vectors
and merged.

The width of the windows is fitted: for a bounded sample of queries the true neighbours are searched in
all rows, and the window is what brings in the wanted share of them. Vectors without structure (such as
random directions) need wide windows, clustered ones narrow ones.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickloom.llm.tables import materialise
from tickloom.llm.vectors import best, matrix, usable
from tickloom.operators.spread import row_numbers

CURVES = 8
DIMS = 6
BITS = 10
#: Bounds of the two samples the index is fitted on.
FIT_ROWS = 4_096
FIT_QUERIES = 128
TARGET_RECALL = 0.96
#: Rows of one curve that a task compares at once, and queries it compares them with.
BLOCK_ROWS = 65_536
BLOCK_QUERIES = 65_536


def hilbert_keys(places: np.ndarray, bits: int) -> np.ndarray:
    """Number along the Hilbert curve of each column of ``places`` (dimension x point, below 2**bits).

    The transform works bit by bit from the top: it undoes the turn that the curve makes in each cell, then
    reads the bits across the dimensions.
    """
    x = places.astype(np.int64).copy()
    dims = len(x)
    for level in range(bits - 1, 0, -1):
        bit, low = 1 << level, (1 << level) - 1
        for i in range(dims):
            inside = (x[i] & bit) != 0
            swap = np.where(inside, 0, (x[0] ^ x[i]) & low)
            x[0] ^= np.where(inside, low, swap)
            if i:
                x[i] ^= swap
    for i in range(1, dims):
        x[i] ^= x[i - 1]
    turn = np.zeros(x.shape[1], np.int64)
    for level in range(bits - 1, 0, -1):
        turn ^= np.where((x[-1] & (1 << level)) != 0, (1 << level) - 1, 0)
    x ^= turn
    keys = np.zeros(x.shape[1], np.int64)
    for level in range(bits - 1, -1, -1):
        for i in range(dims):
            keys = (keys << 1) | ((x[i] >> level) & 1)
    return keys


class Curves:
    """Random projections, shifts and scales of several curves, fitted on a sample of rows.

    The largest inner product is a nearest neighbour once every row gets one more component that brings
    it to the largest length, and queries a zero there.
    """

    def __init__(self, sample: np.ndarray, longest: float, curves: int, seed: int):
        rng = np.random.default_rng(seed)
        self.longest = longest
        self.projections = rng.standard_normal((curves, sample.shape[1] + 1, DIMS))
        self.shifts = rng.random((curves, DIMS))
        spread = [self.raised(sample, False) @ p for p in self.projections]
        self.middle = np.array([s.mean(axis=0) for s in spread])
        self.scale = np.array([s.std(axis=0) for s in spread]) + 1e-12

    def raised(self, vectors: np.ndarray, query: bool) -> np.ndarray:
        square = (vectors**2).sum(axis=1)
        if query:
            last = np.zeros(len(vectors))
            vectors = vectors * (self.longest / np.sqrt(square))[:, None]
        else:
            last = np.sqrt(np.maximum(self.longest**2 - square, 0))
        return np.column_stack((vectors, last))

    def keys(self, vectors: np.ndarray, query: bool) -> np.ndarray:
        """A row per curve."""
        raised, size = self.raised(vectors, query), 1 << BITS
        out = []
        for p, shift, middle, scale in zip(self.projections, self.shifts, self.middle, self.scale, strict=True):
            at = ((raised @ p - middle) / scale / 8 + 0.5 + (shift - 0.5) / 4) * size
            out.append(hilbert_keys(np.clip(at, 0, size - 1).T, BITS))
        return np.array(out)


def best_of_block(
    data: np.ndarray, rows: tuple[np.ndarray, np.ndarray], queries: np.ndarray, own: tuple[np.ndarray, np.ndarray], k: int
) -> dict[str, np.ndarray]:
    """The ``k`` best rows of a block for each query, scored row by row so that equal vectors score alike.

    ``rows`` and ``own`` hold the vec_id and the mark, a row's number, of the rows and of the queries.
    """
    (ids, marks), (own_ids, own_marks) = rows, own
    out: dict[str, list[np.ndarray]] = {"query_id": [], "query_mark": [], "vec_id": [], "mark": [], "score": []}
    for begin in range(0, len(queries), 256):
        asked, asking = queries[begin : begin + 256], own_marks[begin : begin + 256]
        scores = asked @ data.T
        scores[asking[:, None] == marks[None, :]] = -np.inf
        take = min(k, len(ids))
        kth = np.partition(scores, len(ids) - take, axis=1)[:, len(ids) - take]
        slack = 1e-9 * (1 + np.abs(kth))
        near = scores >= np.where(np.isfinite(kth), kth - slack, -np.finfo(float).max)[:, None]
        for i, chosen in enumerate(near):
            at = np.flatnonzero(chosen)
            exact = (data[at] * asked[i]).sum(axis=1)
            order = np.lexsort((marks[at], ids[at], -exact))[:k]
            out["query_id"].append(np.full(len(order), own_ids[begin + i]))
            out["query_mark"].append(np.full(len(order), asking[i]))
            out["vec_id"].append(ids[at][order])
            out["mark"].append(marks[at][order])
            out["score"].append(exact[order])
    kinds = {n: np.float64 if n == "score" else np.int64 for n in out}
    return {n: np.concatenate(v).astype(kinds[n]) if v else np.zeros(0, kinds[n]) for n, v in out.items()}


FOUND = "query_id long, query_mark long, vec_id long, mark long, score double"


def keys_of(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    return table["vec_id"].to_numpy(), table["mark"].to_numpy()


def true_neighbours(
    rows: DataFrame, queries: np.ndarray, own: tuple[np.ndarray, np.ndarray], dims: int, k: int
) -> DataFrame:
    """The exact ``k`` best rows for a bounded number of queries, which every task gets."""

    def run(batches):
        for batch in batches:
            table = pa.Table.from_batches([batch])
            data = matrix(table["v"], dims, np.float64)
            if len(data):
                yield from pa.table(best_of_block(data, keys_of(table), queries, own, k)).to_batches()

    order = Window.partitionBy("query_mark").orderBy(F.desc("score"), "vec_id", "mark")
    found = rows.select("vec_id", "mark", "v").mapInArrow(run, FOUND)
    return found.withColumn("__rank", F.row_number().over(order)).filter(F.col("__rank") <= k).drop("__rank")


def nearest(
    table: DataFrame, is_query: Column, k: int = 20, curves: int = CURVES, recall: float = TARGET_RECALL, seed: int = 1
) -> DataFrame:
    """Per query: query_id, rank (from 1), vec_id and score (inner product) of the ``k`` best others found.

    ``is_query`` picks the queries by vec_id. Of equal vectors only the ``k + 1`` with the smallest vec_id
    can appear in an answer, so no more are indexed; all of them are queries if chosen. Every row but the query's own
    is a candidate, repeated rows and others of its vec_id too, and every query row is answered by itself. Vectors of
    fewer components are filled with zeros. Fewer rows than ``k`` are all returned; without queries or rows the
    result is empty.
    """
    spark = table.sparkSession
    every = materialise(usable(table, nonzero=True).withColumnRenamed("row", "mark"), "vectors")
    copies = Window.partitionBy("v").orderBy("vec_id", "mark")
    rows = every.withColumn("__copy", F.row_number().over(copies)).filter(F.col("__copy") <= k + 1).drop("__copy")
    rows = materialise(rows, "indexed")
    asking = every.filter(is_query)
    length = F.sqrt(F.aggregate("v", F.lit(0.0), lambda s, x: s + x * x))
    facts = every.agg(F.max(F.size("v")).alias("d"), F.max(length).alias("longest"), F.count("*").alias("n"), F.count(F.when(is_query, 1)).alias("q")).first()
    if not facts["n"]:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    dims = facts["d"]
    draw = F.xxhash64(F.lit(seed), "vec_id")
    sample = rows.orderBy(draw, "vec_id", "mark").limit(FIT_ROWS).select("v").toArrow()
    index = Curves(matrix(sample["v"], dims, np.float64), facts["longest"], curves, seed)

    def keyed(query: bool):
        def run(batches):
            for batch in batches:
                if batch.num_rows:
                    part = pa.Table.from_batches([batch])
                    keys = index.keys(matrix(part["v"], dims, np.float64), query)
                    ids, marks = keys_of(part)
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(np.repeat(np.arange(curves, dtype=np.int32), len(ids))),
                            pa.array(keys.ravel()),
                            pa.array(np.full(keys.size, query)),
                            pa.array(np.tile(ids, curves)),
                            pa.array(np.tile(marks, curves)),
                        ],
                        ["curve", "key", "asks", "vec_id", "mark"],
                    )

        return run

    kind = "curve int, key long, asks boolean, vec_id long, mark long"
    on_curves = rows.select("vec_id", "mark", "v").mapInArrow(keyed(False), kind).unionByName(
        asking.select("vec_id", "mark", "v").mapInArrow(keyed(True), kind)
    )
    numbered = row_numbers(materialise(on_curves, "curves"), ["curve"], ["key", "asks", "vec_id", "mark"], "at", "__whole")
    numbered = materialise(numbered.select("curve", "asks", "vec_id", "mark", "at"), "numbered")

    # The window: how far the true neighbours of the sample are, in the order that has them closest.
    chosen = asking.orderBy(draw, "vec_id", "mark").limit(FIT_QUERIES).toArrow()
    if not chosen.num_rows:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    truth = true_neighbours(rows, matrix(chosen["v"], dims, np.float64), keys_of(chosen), dims, k)
    here = numbered.filter("asks").select(
        "curve", F.col("vec_id").alias("query_id"), F.col("mark").alias("query_mark"), F.col("at").alias("here")
    )
    there = numbered.filter("NOT asks").select("curve", "vec_id", "mark", F.col("at").alias("there"))
    away = truth.join(here, ["query_id", "query_mark"]).join(there, ["curve", "vec_id", "mark"])
    away = away.groupBy("query_id", "query_mark", "vec_id", "mark").agg(F.min(F.abs(F.col("here") - F.col("there"))).alias("away"))
    reach = away.agg(F.percentile("away", F.lit(recall)).alias("w")).first()["w"]
    window = max(k, int(np.ceil(reach or 0)))

    width = min(max(2 * window, 1024), BLOCK_ROWS)
    block = F.floor(F.col("at") / width)
    # No more queries can reach a block than have their places around it; beyond a bound they are dealt.
    parts = -(-min(facts["q"], width + 2 * window) // BLOCK_QUERIES)
    every_part = F.explode(F.sequence(F.lit(0), F.lit(parts - 1))).alias("part")
    part = F.pmod(F.xxhash64(F.lit(seed + 1), "vec_id"), F.lit(parts)).cast("int").alias("part")
    stored = numbered.filter("NOT asks").select("curve", block.alias("block"), every_part, "vec_id", "mark").join(rows, ["vec_id", "mark"])
    blocks = F.sequence(F.floor(F.greatest(F.col("at") - window, F.lit(0)) / width), F.floor((F.col("at") + window) / width))
    asked = numbered.filter("asks").select("curve", F.explode(blocks).alias("block"), part, "vec_id", "mark").join(asking, ["vec_id", "mark"])

    def search(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows or not right.num_rows:
            none = np.zeros((0, dims)), (np.zeros(0, np.int64), np.zeros(0, np.int64))
            return pa.table(best_of_block(*none, *none, k))
        return pa.table(best_of_block(
            matrix(left["v"], dims, np.float64), keys_of(left), matrix(right["v"], dims, np.float64), keys_of(right), k
        ))

    asked = asked.toDF(*asked.columns)  # columns of its own: both sides come from one table
    task = ("curve", "block", "part")
    found = stored.groupBy(*task).cogroup(asked.groupBy(*task)).applyInArrow(search, FOUND)
    once = found.groupBy("query_id", F.col("query_mark").alias("query_row"), "vec_id", "mark").agg(F.max("score").alias("score"))
    return best(once, k)
