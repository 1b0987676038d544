"""Exact largest inner products by the threshold algorithm over sorted per-dimension lists.

The rows are dealt over shards, the queries over blocks; a task has one of each. A shard keeps one list of
its rows per dimension, sorted by that component. A query walks all lists at once, from the end that its
own sign favours, scores every row it meets, and stops when no row further down can beat its k-th result:
such a row scores at most the sum of the components that the walk has reached. So each task returns the
exact best rows of its shard, and their best are the exact best of all.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.llm.tables import materialise
from tickloom.llm.vectors import best, matrix, usable

SHARD_ROWS = 16_384
BLOCK_QUERIES = 512
FIRST_DEPTH = 32
EXACT_IN_DOUBLE = 2**53


def threshold_search(
    rows: np.ndarray, ids: np.ndarray, lists: np.ndarray, query: np.ndarray, own: int, k: int
) -> tuple[np.ndarray, np.ndarray]:
    """(ids, scores) of the ``k`` best rows for a query, ties to smaller ids; the row at place ``own`` is left out.

    ``lists[d]`` orders the rows by component d, rising. The walk deepens twofold; it ends once the k-th
    score is above the bound for unseen rows. Equal is not enough, as ties go by id.
    """
    count, dims = rows.shape
    used = np.flatnonzero(query)
    seen = np.zeros(count, np.bool_)
    top_ids, top_scores = np.zeros(0, np.int64), np.zeros(0, rows.dtype)
    done, depth = 0, min(count, FIRST_DEPTH)
    while True:
        before = seen.copy()
        reached = np.zeros(dims, rows.dtype)
        for d in used:
            part = lists[d, count - depth : count - done] if query[d] > 0 else lists[d, done:depth]
            seen[part] = True
            reached[d] = rows[part[0] if query[d] > 0 else part[-1], d]
        new = np.flatnonzero(seen & ~before) if len(used) else np.arange(count)
        scores = rows[new] @ query
        keep = new != own
        top_ids = np.concatenate((top_ids, ids[new][keep]))
        top_scores = np.concatenate((top_scores, scores[keep]))
        order = np.lexsort((top_ids, -top_scores))[:k]
        top_ids, top_scores = top_ids[order], top_scores[order]
        bound = reached @ query
        if depth == count or not len(used) or (len(top_ids) == k and top_scores[-1] > bound):
            return top_ids, top_scores
        done, depth = depth, min(count, depth * 2)


def exact_top_k(table: DataFrame, is_query: Column, k: int = 10) -> DataFrame:
    """Per query: query_id, rank (from 1), vec_id and score of its ``k`` best other rows.

    Scores are inner products of the components floor(1024 * x), as whole numbers; ties go to the smaller
    vec_id. ``is_query`` picks the queries by vec_id. Every row but the query's own is a candidate, repeated rows and
    others of its vec_id too, and every query row is answered by itself. Fewer rows than ``k`` are all returned;
    without queries or rows the result is empty. Vectors of fewer components are filled with zeros.
    """
    rows = materialise(usable(table, "long"), "whole-vectors")
    size = rows.agg(
        F.count("*").alias("n"), F.count(F.when(is_query, 1)).alias("q"), F.max(F.size("v")).alias("d")
    ).first()
    shards, blocks, dims = -(-size["n"] // SHARD_ROWS), -(-size["q"] // BLOCK_QUERIES), size["d"] or 0

    def to_all(count: int) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(max(1, count) - 1)))

    shard = F.pmod(F.xxhash64("row"), F.lit(max(1, shards))).cast("int")
    block = F.pmod(F.xxhash64(F.lit(3), "row"), F.lit(max(1, blocks))).cast("int")
    left = rows.select(shard.alias("shard"), to_all(blocks).alias("block"), "row", "vec_id", "v")
    right = rows.filter(is_query).select(to_all(shards).alias("shard"), block.alias("block"), "row", "vec_id", "v")

    right = right.toDF(*right.columns)  # columns of its own: both sides come from one table

    def search(stored: pa.Table, asked: pa.Table) -> pa.Table:
        out = {"query_id": [], "query_row": [], "vec_id": [], "score": []}
        if stored.num_rows and asked.num_rows and dims:
            data, queries = (matrix(t["v"], dims, np.int64) for t in (stored, asked))
            if float(np.abs(data).max()) * float(np.abs(queries).max()) * dims < EXACT_IN_DOUBLE:
                data, queries = data.astype(np.float64), queries.astype(np.float64)
            lists = np.argsort(data.T, axis=1, kind="stable")
            ids = stored["vec_id"].to_numpy()
            place = {row: at for at, row in enumerate(stored["row"].to_pylist())}
            asking = zip(asked["vec_id"].to_pylist(), asked["row"].to_pylist(), queries, strict=True)
            for query_id, row, query in asking:
                found, scores = threshold_search(data, ids, lists, query, place.get(row, -1), k)
                out["query_id"] += [query_id] * len(found)
                out["query_row"] += [row] * len(found)
                out["vec_id"] += found.tolist()
                out["score"] += scores.astype(np.int64).tolist()
        kinds = pa.schema([(name, pa.int64()) for name in out])
        return pa.table(out, schema=kinds)

    found = (
        left.groupBy("shard", "block")
        .cogroup(right.groupBy("shard", "block"))
        .applyInArrow(search, "query_id long, query_row long, vec_id long, score long")
    )
    return best(found, k)
