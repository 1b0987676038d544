"""Near-duplicates among word-shingle sets by SetSketch registers.

A register holds the smallest of the points that all shingles of a set throw at it, truncated on an
exponential scale: registers of a union are the larger ones of both, and two sets agree in a register about
as often as they overlap. Groups of registers (bands) bring similar sets together; for sets that meet, the
share of common shingles is estimated by maximum likelihood from how many registers are larger, equal and
smaller, given the known set sizes. What may be similar is then verified on the full sets.

No pairs of a group are listed. Sets that meet in a band are linked by a search that only compares with
sets not yet reached, which gives a forest; likewise on the full sets of each cluster. Equal sets are one
node from the start.
"""

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.llm import hashing
from tickloom.llm.components import components
from tickloom.llm.tables import free_name, materialise, partitions

REGISTERS = 128
SCALE = 1.02
TOP_REGISTER = 2000
#: The estimate's standard error is at most 0.045 with 128 registers; this leaves over three of them.
MARGIN = 0.15
#: Chance to miss a pair exactly at the threshold.
MISS = 1e-6
SHINGLE_BASE = 0xC2B2AE3D27D4EB4F
#: Sets of one band value, and shingles of one cluster, that a single task compares; larger ones are dealt
#: over tasks by pairs of blocks.
BAND_BLOCK = 20_000
CLUSTER_BLOCK = 4_000_000


def rows_per_band(threshold: float, registers: int = REGISTERS) -> int:
    """The most registers a band can have while a pair at the threshold is missed with chance ``MISS``."""
    fitting = [r for r in range(1, 17) if (1 - threshold**r) ** (registers // r) <= MISS]
    return max(fitting, default=1)


def shingle_sets(texts: list[bytes], width: int) -> list[np.ndarray]:
    """Per text the sorted distinct hashes of its ``width``-word shingles, in lower case.

    A text of fewer words has its whole sequence as the only shingle, one without words none.
    """
    words = hashing.Words(texts, lower=True)
    rolled = hashing.windows(words.hashes, width, SHINGLE_BASE)
    out = []
    for first, count in zip(words.first.tolist(), words.counts.tolist(), strict=True):
        if count >= width:
            own = np.sort(rolled[first : first + count - width + 1])
            out.append(own[np.concatenate(([True], own[1:] != own[:-1]))])
        elif count:
            out.append(hashing.windows(words.hashes[first : first + count], count, SHINGLE_BASE) + np.uint64(count))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def registers_of(sets: list[np.ndarray], count: int = REGISTERS) -> np.ndarray:
    """SetSketch registers, a row per set (zeros for an empty one).

    Each shingle throws points at rate ``count`` along a line, each at a random register. The points below
    9 / size fill all registers of most sets; the others look twice as far, and again.
    """
    out = np.zeros((len(sets), count), np.uint16)
    todo = np.array([i for i, s in enumerate(sets) if len(s)], np.int64)
    reach = 9.0
    while len(todo):
        sizes = np.array([len(sets[i]) for i in todo])
        least = np.full(len(todo) * count, np.inf)
        state = np.concatenate([sets[i] for i in todo])
        owner = np.repeat(np.arange(len(todo)), sizes)
        limit = np.repeat(reach / sizes, sizes)
        at = np.zeros(len(state))
        while len(state):
            state = hashing.scramble(state + np.uint64(0x9E3779B97F4A7C15))
            at = at - np.log((state >> np.uint64(11)).astype(np.float64) + 0.5) / count + 53 * math.log(2) / count
            near = at < limit
            state, owner, limit, at = state[near], owner[near], limit[near], at[near]
            target = hashing.scramble(state ^ np.uint64(0x5851F42D4C957F2D)) % np.uint64(count)
            np.minimum.at(least, owner * count + target.astype(np.int64), at)
        least = least.reshape(len(todo), count)
        full = np.isfinite(least).all(axis=1)
        value = np.floor(1 - np.log(least[full]) / math.log(SCALE)) + TOP_REGISTER / 4
        out[todo[full]] = np.clip(value, 1, TOP_REGISTER).astype(np.uint16)
        todo, reach = todo[~full], reach * 2
    return out


def band_values(registers: np.ndarray, rows: int) -> np.ndarray:
    """Per set one number per band: its registers and the band's number, hashed."""
    bands = registers.shape[1] // rows
    parts = registers[:, : bands * rows].reshape(len(registers), bands, rows).astype(np.uint64)
    mixed = np.broadcast_to(hashing.scramble(np.arange(1, bands + 1, dtype=np.uint64)), parts.shape[:2])
    for i in range(rows):
        mixed = hashing.scramble(mixed * np.uint64(hashing.BASE) + parts[:, :, i])
    return mixed.view(np.int64)


def similarity(one: np.ndarray, size: int, others: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Maximum-likelihood estimate of the Jaccard similarity of one set to others, from registers and sizes."""
    larger = (one > others).sum(axis=1)
    smaller = (one < others).sum(axis=1)
    equal = others.shape[1] - larger - smaller
    u = (size / (size + sizes))[:, None]
    v = 1 - u
    grid = np.linspace(0.0, 1.0, 101)[None, :] * np.minimum(u, v) / np.maximum(u, v)

    def chance(x: np.ndarray) -> np.ndarray:
        return np.clip(-np.log1p(-np.maximum(x, 0) * (SCALE - 1) / SCALE) / math.log(SCALE), 1e-9, 1)

    up, down = chance(u - v * grid), chance(v - u * grid)
    level = np.clip(1 - up - down, 1e-9, 1)
    likelihood = larger[:, None] * np.log(up) + smaller[:, None] * np.log(down) + equal[:, None] * np.log(level)
    return np.take_along_axis(grid, likelihood.argmax(axis=1)[:, None], axis=1)[:, 0]


def estimated_links(registers: np.ndarray, sizes: np.ndarray, least: float) -> list[tuple[int, int]]:
    """A forest over sets whose estimate is at least ``least``: each set is compared with unreached ones only."""
    waiting = np.arange(len(sizes))
    links = []
    while len(waiting):
        reached, waiting = [waiting[0]], waiting[1:]
        while reached and len(waiting):
            x = reached.pop()
            equal = (registers[x] == registers[waiting]).sum(axis=1)
            # Far fewer equal registers than the bound asks for: no need for the likelihood.
            hopeful = np.flatnonzero(equal >= (least - 0.1) * registers.shape[1])
            if not len(hopeful):
                continue
            some = waiting[hopeful]
            near = similarity(registers[x], sizes[x], registers[some], sizes[some]) >= least
            links += [(int(x), int(y)) for y in some[near]]
            reached += some[near].tolist()
            waiting = np.delete(waiting, hopeful[near])
    return links


def verified_links(sets: list[np.ndarray], percent: int) -> list[tuple[int, int]]:
    """A forest over sets with 100 * intersection >= percent * union, which keeps their components.

    Sets are reached one from another; a set is compared, through the lists of which sets hold a shingle,
    with the unreached ones only. The lists are made anew whenever half of the sets they name are reached.
    """
    sizes = np.array([len(s) for s in sets])
    links: list[tuple[int, int]] = []
    if len(sets) == 2:
        both = len(np.intersect1d(sets[0], sets[1], assume_unique=True))
        return [(0, 1)] if 100 * both >= percent * (sizes.sum() - both) else []
    _, ids = np.unique(np.concatenate(sets), return_inverse=True)
    begins = np.concatenate(([0], np.cumsum(sizes)))
    owners = np.repeat(np.arange(len(sets)), sizes)
    by_id = np.argsort(ids, kind="stable")
    waiting = np.ones(len(sets), np.bool_)
    left = listed = len(sets)
    holders = owners[by_id]
    ends = np.cumsum(np.bincount(ids, minlength=ids.max() + 1 if len(ids) else 1))
    starts = np.concatenate(([0], ends[:-1]))
    for seed in range(len(sets)):
        if not waiting[seed]:
            continue
        waiting[seed] = False
        left -= 1
        reached = [seed]
        while reached and left:
            if left * 2 < listed:
                keep = waiting[owners[by_id]]
                by_id, listed = by_id[keep], left
                holders = owners[by_id]
                ends = np.cumsum(np.bincount(ids[by_id], minlength=len(ends)))
                starts = np.concatenate(([0], ends[:-1]))
            x = reached.pop()
            own = ids[begins[x] : begins[x + 1]]
            lengths = ends[own] - starts[own]
            if not lengths.sum():
                continue
            steps = np.ones(lengths.sum(), np.int64)
            jump = lengths > 0
            at = np.concatenate(([0], np.cumsum(lengths[jump])[:-1]))
            steps[at] = starts[own][jump]
            steps[at[1:]] -= ends[own][jump][:-1] - 1
            both = np.bincount(holders[np.cumsum(steps)], minlength=len(sets))
            found = np.flatnonzero(waiting & (100 * both >= percent * (sizes[x] + sizes - both)) & (both > 0))
            links += [(x, int(y)) for y in found]
            waiting[found] = False
            left -= len(found)
            reached += found.tolist()
    return links


SIGNATURES = "n_shingles long, s1 long, s2 long, registers binary, bands array<long>"


def signatures(docs: DataFrame, width: int, threshold: float) -> DataFrame:
    """Per row: doc_id, n_shingles, the set's 128-bit sum (s1, s2), registers and band values."""
    rows = rows_per_band(threshold)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for begin, end in hashing.slices(whole.column(1)):
                batch = whole.slice(begin, end - begin)
                texts = [t or b"" for t in batch.column(1).cast(pa.large_binary()).to_pylist()]
                sets = shingle_sets(texts, width)
                filled = registers_of(sets)
                s1 = [int(hashing.scramble(s).sum(dtype=np.uint64).view(np.int64)) for s in sets]
                s2 = [int(hashing.scramble(s ^ np.uint64(SHINGLE_BASE)).sum(dtype=np.uint64).view(np.int64)) for s in sets]
                bands = band_values(filled, rows)
                offsets = pa.array(np.arange(len(sets) + 1, dtype=np.int32) * bands.shape[1])
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0),
                        pa.array([len(s) for s in sets], pa.int64()),
                        pa.array(s1, pa.int64()),
                        pa.array(s2, pa.int64()),
                        pa.array([r.tobytes() for r in filled], pa.binary()),
                        pa.ListArray.from_arrays(offsets, pa.array(bands.ravel())),
                    ],
                    ["doc_id", "n_shingles", "s1", "s2", "registers", "bands"],
                )

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id long, {SIGNATURES}")


def likely_pairs(pairs: DataFrame, least: float) -> DataFrame:
    """Of rows (u, v, size_u, size_v, registers_u, registers_v): the (u, v) whose estimate is high enough."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            size_u, size_v = (batch.column(i).to_numpy() for i in (2, 3))
            one, other = (
                np.frombuffer(b"".join(batch.column(i).to_pylist()), np.uint16).reshape(batch.num_rows, -1)
                for i in (4, 5)
            )
            near = np.zeros(batch.num_rows, np.bool_)
            hopeful = np.flatnonzero((one == other).sum(axis=1) >= (least - 0.1) * one.shape[1])
            for i in hopeful:
                near[i] = similarity(one[i], int(size_u[i]), other[i : i + 1], size_v[i : i + 1])[0] >= least
            chosen = batch.filter(pa.array(near))
            yield pa.RecordBatch.from_arrays([chosen.column(0), chosen.column(1)], ["u", "v"])

    order = ("u", "v", "size_u", "size_v", "registers_u", "registers_v")
    return pairs.select(*order).mapInArrow(run, "u long, v long")


def grouped(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[pa.Table]:
    """The groups of sorted batches: rows that follow each other with equal values in the first columns."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(keys)]
        new = np.zeros(batch.num_rows, np.bool_)
        for c in columns:
            new[1:] |= c[1:] != c[:-1]
        cuts = np.concatenate(([0], np.flatnonzero(new), [batch.num_rows]))
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            key = tuple(c[a] for c in columns)
            if held and key != last:
                yield pa.Table.from_batches(held)
                held = []
            held.append(batch.slice(a, b - a))
            last = key
    if held:
        yield pa.Table.from_batches(held)


def in_blocks(rows: DataFrame, key: str, weight: str, block: int) -> DataFrame:
    """Deal the rows of a key over tasks: once if the key's total ``weight`` is within ``block``.

    A larger key is cut into blocks, and every pair of blocks meets in one task, so that any two of its rows
    do. Adds ``__task``, a number per key and pair of blocks.
    """
    blocks = F.ceil(F.col(weight) / block).cast("int")
    own = F.pmod(F.xxhash64("node"), F.greatest(blocks, F.lit(1))).cast("int")
    others = F.transform(
        F.sequence(F.lit(0), F.greatest(blocks, F.lit(1)) - 1),
        lambda b: F.struct(F.least(own, b).alias("a"), F.greatest(own, b).alias("b")),
    )
    dealt = rows.withColumn("__pair", F.explode(others))
    return dealt.withColumn("__task", F.xxhash64(key, "__pair.a", "__pair.b")).drop("__pair")


def forest(batches: Iterator[pa.RecordBatch], link) -> Iterator[pa.RecordBatch]:
    """The links of each group of sorted batches (__task, node, ..., set as bytes), each set of a node once."""
    u, v = [], []
    for group in grouped(batches, 1):
        nodes = group.column(1).to_numpy()
        sets = group.column(group.num_columns - 1).to_pylist()
        first = list({(node, held): at for at, (node, held) in enumerate(zip(nodes.tolist(), sets, strict=True))}.values())
        if len(first) > 1:
            for a, b in link(group.take(pa.array(first))):
                u.append(int(nodes[first[a]]))
                v.append(int(nodes[first[b]]))
        if len(u) > 50_000:
            yield pa.RecordBatch.from_arrays([pa.array(u, pa.int64()), pa.array(v, pa.int64())], ["u", "v"])
            u, v = [], []
    yield pa.RecordBatch.from_arrays([pa.array(u, pa.int64()), pa.array(v, pa.int64())], ["u", "v"])


def candidate_links(nodes: DataFrame, least: float) -> DataFrame:
    """Links (u, v) of likely similar nodes; any two that meet in a band and look similar end up connected.

    First every band value ties its members to its smallest node. Where that connects all of them, nothing
    is left to do. The members of the other values come together with their registers.
    """
    members = nodes.select("node", F.explode("bands").alias("band"))
    met = members.groupBy("band").agg(F.count("*").alias("members"), F.min("node").alias("first")).filter("members > 1")
    met = materialise(members.join(met, "band"), "bands")
    sketch = nodes.select("node", "n_shingles", "registers")
    pairs = met.filter("node <> first").select(F.col("first").alias("u"), F.col("node").alias("v")).distinct()
    for side in ("u", "v"):
        pairs = pairs.join(
            sketch.withColumnsRenamed({"node": side, "n_shingles": f"size_{side}", "registers": f"registers_{side}"}), side
        )
    stars = materialise(likely_pairs(pairs, least), "likely")
    reached = components(stars)
    placed = met.filter("members > 2").join(reached, "node", "left")
    placed = placed.withColumn("component", F.coalesce("component", "node"))
    open_bands = placed.groupBy("band").agg(
        F.min("component").alias("low"), F.max("component").alias("high")
    ).filter("low <> high").select("band")
    meet = met.join(open_bands, "band", "left_semi").select("band", "node", "members")
    tasks = in_blocks(meet, "band", "members", BAND_BLOCK).join(sketch, "node")

    def link(group: pa.Table) -> list[tuple[int, int]]:
        registers = np.frombuffer(b"".join(group["registers"].to_pylist()), np.uint16).reshape(group.num_rows, -1)
        return estimated_links(registers, group["n_shingles"].to_numpy(), least)

    dealt = met.select("band", "members").distinct().agg(dealt_weight("members", BAND_BLOCK)).first()[0]
    local = _grouped_links(tasks.select("__task", "node", "n_shingles", "registers"), link, dealt, BAND_BLOCK)
    return stars.unionByName(local)


def dealt_weight(weight: str, block: int) -> Column:
    """What ``in_blocks`` deals of all keys together: a key of several blocks stands once in each pair of them."""
    return F.coalesce(F.sum(F.col(weight) * F.ceil(F.col(weight) / block)), F.lit(0))


def _grouped_links(tasks: DataFrame, link, dealt: int, block: int) -> DataFrame:
    """The links of all tasks, in as many partitions as their weight fills blocks, or as the session asks for."""
    count = max(partitions(tasks), -(-int(dealt) // block))
    return (
        tasks.repartition(count, "__task")
        .sortWithinPartitions("__task")
        .mapInArrow(lambda batches: forest(batches, link), "u long, v long")
    )


def verified(docs: DataFrame, clusters: DataFrame, width: int, percent: int) -> DataFrame:
    """Links (u, v) between nodes of one cluster, confirmed on their full shingle sets."""

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for begin, end in hashing.slices(whole.column(2)):
                batch = whole.slice(begin, end - begin)
                found = shingle_sets(batch.column(2).cast(pa.large_binary()).to_pylist(), width)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), batch.column(1), pa.array([s.tobytes() for s in found], pa.binary())],
                    ["__task", "node", "shingles"],
                )

    weights = materialise(clusters.groupBy("component").agg(F.sum("n_shingles").alias("weight")), "weights")
    dealt = weights.agg(dealt_weight("weight", CLUSTER_BLOCK)).first()[0]
    tasks = in_blocks(clusters.join(weights, "component"), "component", "weight", CLUSTER_BLOCK)
    texts = docs.select(F.col("doc_id").alias("node"), "text").filter(F.col("text").isNotNull())
    rows = texts.join(tasks.select("__task", "node"), "node").select("__task", "node", "text")
    rows = rows.mapInArrow(sets, "__task long, node long, shingles binary")

    def link(group: pa.Table) -> list[tuple[int, int]]:
        return verified_links([np.frombuffer(s, np.uint64) for s in group["shingles"].to_pylist()], percent)

    return _grouped_links(rows, link, dealt, CLUSTER_BLOCK)


def near_duplicates(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """Per row: doc_id, n_shingles, component_id, kept.

    Documents are linked if 100 * intersection >= percent * union of their ``width``-word shingle sets;
    component_id is the smallest doc_id reachable, and the document that bears it is kept. Texts without
    words (null, empty, blank) are linked with nothing and kept. Rows with equal doc_id count as one
    document, linked with whatever any of its texts is; doc_id is taken as a whole number. Null doc_ids
    are linked with nothing. An empty table gives an empty one; other columns are not read.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    signed = materialise(signatures(docs, width, percent / 100), "signatures")
    nodes = materialise(
        signed.filter("n_shingles > 0 AND doc_id IS NOT NULL")
        .groupBy("s1", "s2")
        .agg(
            F.min("doc_id").alias("node"),
            F.first("n_shingles").alias("n_shingles"),
            F.first("registers").alias("registers"),
            F.first("bands").alias("bands"),
        ),
        "nodes",
    )
    likely = components(candidate_links(nodes, percent / 100 - MARGIN))
    clusters = materialise(likely.join(nodes.select("node", "n_shingles"), "node"), "clusters")
    links = materialise(verified(docs, clusters, width, percent), "links")
    found = components(links)
    placed = nodes.select("s1", "s2", "node").join(found, "node", "left")
    placed = placed.select("s1", "s2", F.coalesce("component", "node").alias("component_id"))
    told = signed.select("doc_id", "n_shingles", "s1", "s2").join(placed, ["s1", "s2"], "left")
    component = F.when(F.col("n_shingles") > 0, F.col("component_id"))
    return told.select(
        "doc_id",
        "n_shingles",
        F.coalesce(component, F.col("doc_id")).alias("component_id"),
    ).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def drop_near_duplicates(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """``docs`` with one document of each group of near copies, in all their columns.

    Every row is a document of its own, also where doc_ids repeat or are texts. Of a group the row with the
    smallest doc_id stays (one of them where several have it); rows that are like no other all stay, also those with an
    equal doc_id, and so do texts without words (null, empty, blank) and rows without a doc_id. Texts of any length
    count as a whole. An empty table gives an empty one, and columns of any name are kept.
    """
    row = free_name(docs, "row")
    rows = materialise(docs.withColumn(row, F.monotonically_increasing_id()), "numbered")
    named = rows.filter(F.col("doc_id").isNotNull())
    told = near_duplicates(named.select(F.col(row).alias("doc_id"), "text"), width, percent)
    groups = materialise(told.select(F.col("doc_id").alias(row), "component_id"), "near")
    several = groups.groupBy("component_id").agg(F.count("*").alias("n")).filter("n > 1").select("component_id")
    members = groups.join(several, "component_id", "left_semi").join(rows.select(row, "doc_id"), row)
    first = members.groupBy("component_id").agg(F.min_by(row, F.struct("doc_id", row)).alias(row)).select(row)
    gone = members.select(row).join(first, row, "left_anti")
    return rows.join(gone, row, "left_anti").select(*docs.columns)
