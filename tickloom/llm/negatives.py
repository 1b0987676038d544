"""Hard negatives for anchors of an embeddings table, by exact integer scores.

Candidates are dealt over shards and anchors over blocks; a task has one of each, as matrices of whole
numbers. Scores come tile by tile from Strassen's recursive multiplication: tiles are padded with zeros to
even sides, seven products replace eight, and all additions are 64-bit integers. Those wrap around, so the
result is exact whenever it fits, whatever the steps between. A first pass keeps each anchor's best rows of
its own label, a second one the best rows of other labels inside each positive's window of scores. Both keep
bounded heaps, which merge between tiles, and between tasks by a ranked union.
"""

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickloom.llm.tables import materialise
from tickloom.llm.vectors import finite, matrix

# Bytes of one shard of candidates and of one block of anchors, as 64-bit numbers.
SHARD_BYTES = 4 << 20
BLOCK_BYTES = 16 << 20
# Rows of a tile: anchors, candidates. Tiles bound the memory for scores.
TILE = (256, 4096)
# The recursion ends where a side is this short.
LEAF = 16
EXACT_IN_DOUBLE = 2**53
LOWEST, HIGHEST = -(2**63), 2**63 - 1


def peak(a: np.ndarray) -> int:
    """The largest magnitude in a matrix."""
    return max(int(a.max()), -int(a.min())) if a.size else 0


def plain_product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """``a @ b`` of whole numbers; in doubles where every sum provably stays exact in them."""
    if a.dtype == np.int64 and peak(a) * peak(b) * a.shape[1] < EXACT_IN_DOUBLE:
        return (a.astype(np.float64) @ b.astype(np.float64)).astype(np.int64)
    return a @ b


def strassen(a: np.ndarray, b: np.ndarray, leaf: int = LEAF) -> np.ndarray:
    """``a @ b`` by seven products of half the size, as long as every side is longer than ``leaf``."""
    (m, k), n = a.shape, b.shape[1]
    if min(m, k, n) <= leaf:
        return plain_product(a, b)
    a = np.pad(a, ((0, m % 2), (0, k % 2)))
    b = np.pad(b, ((0, k % 2), (0, n % 2)))
    r, s, t = a.shape[0] // 2, a.shape[1] // 2, b.shape[1] // 2
    a11, a12, a21, a22 = a[:r, :s], a[:r, s:], a[r:, :s], a[r:, s:]
    b11, b12, b21, b22 = b[:s, :t], b[:s, t:], b[s:, :t], b[s:, t:]
    p1 = strassen(a11 + a22, b11 + b22, leaf)
    p2 = strassen(a21 + a22, b11, leaf)
    p3 = strassen(a11, b12 - b22, leaf)
    p4 = strassen(a22, b21 - b11, leaf)
    p5 = strassen(a11 + a12, b22, leaf)
    p6 = strassen(a21 - a11, b11 + b12, leaf)
    p7 = strassen(a12 - a22, b21 + b22, leaf)
    out = np.empty((2 * r, 2 * t), p1.dtype)
    out[:r, :t] = p1 + p4 - p5 + p7
    out[:r, t:] = p3 + p5
    out[r:, :t] = p2 + p4
    out[r:, t:] = p1 - p2 + p3 + p6
    return out[:m, :n]


def scores_of(anchors: np.ndarray, candidates: np.ndarray) -> np.ndarray:
    """Inner products of rows; scores beyond 64 bits are held at the limits."""
    if peak(anchors) * peak(candidates) * anchors.shape[1] <= HIGHEST:
        return strassen(anchors, candidates.T)
    wide = strassen(anchors.astype(object), candidates.T.astype(object))
    return np.clip(wide, LOWEST, HIGHEST).astype(np.int64)


class Heaps:
    """The first ``k`` entries of every key, scores falling, ties by rising id; takes more at any time."""

    def __init__(self, k: int):
        self.k = k
        self.keys, self.scores, self.ids = (np.zeros(0, np.int64) for _ in range(3))

    def add(self, keys: np.ndarray, scores: np.ndarray, ids: np.ndarray) -> None:
        keys = np.concatenate((self.keys, keys))
        scores = np.concatenate((self.scores, scores))
        ids = np.concatenate((self.ids, ids))
        # The complement falls as the score rises, and never overflows.
        order = np.lexsort((ids, ~scores, keys))
        keys = keys[order]
        place = np.arange(len(keys)) - np.searchsorted(keys, keys)
        order = order[place < self.k]
        self.keys, self.scores, self.ids = keys[place < self.k], scores[order], ids[order]

    def add_tile(self, keys: np.ndarray, scores: np.ndarray, ids: np.ndarray, allowed: np.ndarray) -> None:
        """Add the allowed entries of a tile; row i has key ``keys[i]``, column j has id ``ids[j]``."""
        width = scores.shape[1]
        reach = np.full(len(keys), LOWEST)
        if width > self.k:
            masked = np.where(allowed, scores, LOWEST)
            reach = np.partition(masked, width - self.k, axis=1)[:, width - self.k]
        row, column = np.nonzero(allowed & (scores >= reach[:, None]))
        self.add(keys[row], scores[row, column], ids[column])


def tiles(rows: int, columns: int):
    for i in range(0, rows, TILE[0]):
        for j in range(0, columns, TILE[1]):
            yield slice(i, i + TILE[0]), slice(j, j + TILE[1])


def _columns(table: pa.Table, *names: str) -> list[np.ndarray]:
    return [table[name].to_numpy() for name in names]


def _positives(stored: pa.Table, asked: pa.Table, dims: int, k: int) -> pa.Table:
    """The best rows of the same label for every anchor of the block, within the shard."""
    heaps = Heaps(k)
    # Both by label: an anchor meets only the candidates of its label.
    stored, asked = stored.sort_by("label"), asked.sort_by("label")
    rows, labels, ids = _columns(stored, "row", "label", "vec_id")
    own, wanted = _columns(asked, "row", "label")
    data, queries = (matrix(t["v"], dims, np.int64) for t in (stored, asked))
    for label in np.unique(wanted):
        a, c = (slice(np.searchsorted(x, label), np.searchsorted(x, label, side="right")) for x in (wanted, labels))
        for i, j in tiles(a.stop - a.start, c.stop - c.start):
            found = scores_of(queries[a][i], data[c][j])
            other = rows[c][j][None, :] != own[a][i][:, None]
            heaps.add_tile(np.arange(a.start, a.stop)[i], found, ids[c][j], other)
    return pa.table({"anchor": own[heaps.keys], "vec_id": heaps.ids, "score": heaps.scores})


def _negatives(stored: pa.Table, asked: pa.Table, dims: int, k: int, percent: int) -> pa.Table:
    """The best rows of other labels inside the window of every positive of the block, within the shard."""
    heaps = Heaps(k)
    labels, ids = _columns(stored, "label", "vec_id")
    (wanted,) = _columns(asked, "label")
    data, queries = (matrix(t["v"], dims, np.int64) for t in (stored, asked))
    counts = pa.compute.list_value_length(asked["positive_scores"]).to_numpy()
    width = int(counts.max())
    upper = matrix(asked["positive_scores"], width, np.int64)
    lower = np.array([[-(-percent * p // 100) for p in some] for some in upper.tolist()], np.int64)
    for i, j in tiles(len(queries), len(data)):
        found = scores_of(queries[i], data[j])
        other = labels[j][None, :] != wanted[i][:, None]
        for place in range(width):
            inside = other & (found <= upper[i, place, None]) & (found >= lower[i, place, None])
            inside &= (counts[i] > place)[:, None]
            heaps.add_tile(np.arange(len(queries))[i] * width + place, found, ids[j], inside)
    anchor, place = np.divmod(heaps.keys, width)
    own, anchor_id = _columns(asked, "row", "vec_id")
    return pa.table(
        {
            "anchor": own[anchor],
            "place": place,
            "anchor_id": anchor_id[anchor],
            "positive_id": matrix(asked["positive_ids"], width, np.int64)[anchor, place],
            "positive_score": upper[anchor, place],
            "vec_id": heaps.ids,
            "score": heaps.scores,
        }
    )


def _against_all(rows: DataFrame, anchors: DataFrame, shards: int, blocks: int, task, schema: str) -> DataFrame:
    """``task`` on every (shard of rows, block of anchors); each row lies in one shard, each anchor in one block."""

    def part(count: int, salt: int) -> Column:
        return F.pmod(F.xxhash64(F.lit(salt), "row"), F.lit(count)).cast("int")

    def to_all(count: int) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(count - 1)))

    left = rows.select(part(shards, 1).alias("shard"), to_all(blocks).alias("block"), "*")
    right = anchors.select(to_all(shards).alias("shard"), part(blocks, 2).alias("block"), "*")
    right = right.toDF(*right.columns)  # columns of its own: both sides come from one table
    names = [f.split()[0] for f in schema.split(",")]
    empty = pa.table({name: pa.array([], pa.int64()) for name in names})

    def run(stored: pa.Table, asked: pa.Table) -> pa.Table:
        if not stored.num_rows or not asked.num_rows:
            return empty
        return task(stored, asked).select(names)

    return left.groupBy("shard", "block").cogroup(right.groupBy("shard", "block")).applyInArrow(run, schema)


def hard_negatives(
    table: DataFrame,
    is_anchor: Column,
    label: Column | str = "label",
    positives: int = 5,
    negatives: int = 5,
    percent: int = 80,
    scale: int = 256,
) -> DataFrame:
    """Per anchor and positive, the hardest negatives: anchor_id, positive_id, rank, negative_id and both scores.

    Scores are inner products of the components floor(scale * x), as whole numbers; higher ones come first,
    ties by smaller vec_id. An anchor's positives are its first ``positives`` other rows of the same label. The
    negatives of a positive are the first ``negatives`` rows of other labels whose score is at most the
    positive's and at least ``percent`` hundredths of it (so none for a positive below 0).

    Rows without a vec_id or label, and vectors that are null or hold null or non-finite components, take no
    part. Only a row itself is not its own candidate: repeated rows and repeated vec_ids count one by one,
    as candidates and as anchors; ``positive_place`` (from 1) tells an anchor's equal positives apart. Shorter
    vectors are filled with zeros. Components and scores beyond 64 bits are held at the limits. Without
    anchors, positives or negatives there are no rows, and an empty table gives an empty one. Other columns
    are not read.
    """
    whole = F.transform("v", lambda x: F.floor(x * scale))
    rows = finite(table, F.expr(label).alias("__l") if isinstance(label, str) else label.alias("__l"))
    rows = rows.filter(F.col("__l").isNotNull()).select(
        F.monotonically_increasing_id().alias("row"), "vec_id", F.col("__l").cast("long").alias("label"), whole.alias("v")
    )
    rows = materialise(rows, "labelled-vectors")
    size = rows.agg(
        F.count("*").alias("n"), F.count(F.when(is_anchor, 1)).alias("a"), F.max(F.size("v")).alias("d")
    ).first()
    dims = max(1, size["d"] or 0)
    shards = max(1, -(-size["n"] * dims * 8 // SHARD_BYTES))
    blocks = max(1, -(-size["a"] * dims * 8 // BLOCK_BYTES))

    anchors = rows.filter(is_anchor)
    found = _against_all(
        rows, anchors, shards, blocks, lambda s, a: _positives(s, a, dims, positives),
        "anchor long, vec_id long, score long",
    )
    order = Window.partitionBy("anchor").orderBy(F.desc("score"), "vec_id")
    found = found.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= positives)
    best = F.sort_array(F.collect_list(F.struct("place", "vec_id", "score")))
    own = found.groupBy(F.col("anchor").alias("row")).agg(best.alias("best"))
    own = own.select("row", F.col("best.vec_id").alias("positive_ids"), F.col("best.score").alias("positive_scores"))
    with_positives = materialise(anchors.join(own, "row"), "anchors")

    mined = _against_all(
        rows, with_positives, shards, blocks, lambda s, a: _negatives(s, a, dims, negatives, percent),
        "anchor long, place long, anchor_id long, positive_id long, positive_score long, vec_id long, score long",
    )
    order = Window.partitionBy("anchor", "place").orderBy(F.desc("score"), "vec_id")
    ranked = mined.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= negatives)
    return ranked.select(
        "anchor_id",
        "positive_id",
        "rank",
        F.col("vec_id").alias("negative_id"),
        "positive_score",
        F.col("score").alias("negative_score"),
        (F.col("place") + 1).cast("int").alias("positive_place"),
    )
