"""Exact substring de-duplication over word windows, by fixed-block anchors.

A window of ``width`` words that occurs twice covers, in either place, one whole block of that text's grid
of neighbouring blocks of ``(width + 1) // 2`` words. So every text gives

* the index: its non-overlapping blocks, and
* the probes: a hash of every rolling window of block length.

A block that more than one probe hits is an anchor. Anchors are extended: the windows around them are
compared as a whole, and neighbouring repeated windows join to maximal exact repeats.

Equal texts are taken together first. Texts lie in buckets (a stored table, so that later passes find
them without another shuffle); hashes travel as packed arrays, one per (bucket, part of the hash range),
in which a value stands once however often the bucket has it. A passage that a third of all texts share
therefore reaches its part once per bucket. Nothing but these arrays is ever gathered by hash, and no pairs
are formed.
"""

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.llm import hashing
from tickloom.llm.tables import free_name, materialise, partitions, text_key
from tickloom.storage import new_path

WIDTH = 35
#: Bytes of text of one bucket, which a task holds at once (0.6 GB of memory), and the most buckets. The exchange of
#: hashes has a row per bucket and part of the hash range, so beyond 65,536 buckets (8 TB) they grow instead: 1.5 GB of
#: text each, and 7 GB of a task's memory, at 100 TB.
BUCKET_BYTES = 1 << 27
MOST_BUCKETS = 1 << 16
ANCHOR_BASE = 0xD1B54A32D192ED03
WINDOW_BASES = (0x8CB92BA72F3D8DD7, 0xABC98388FB8FAC03)

ANCHORS = "part int, bucket int, probes binary, blocks binary, texts binary, numbers binary"
HITS = "bucket int, part int, texts binary, numbers binary, bits binary"
WINDOWS = "part int, bucket int, hashes binary, checks binary, several binary"
KEPT = "k1 long, k2 long, n_words long, n_removed long, kept_sha256 string, starts array<int>, ends array<int>"


def pack(values: np.ndarray) -> bytes:
    """An array of numbers in rising order, as compressed differences, byte by byte of equal weight."""
    steps = np.diff(values, prepend=values.dtype.type(0))
    planes = steps.view(np.uint8).reshape(-1, values.dtype.itemsize).T.tobytes()
    return zstandard.ZstdCompressor(level=1).compress(planes)


def unpack(data: bytes, kind: type) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8)
    size = np.dtype(kind).itemsize
    steps = np.ascontiguousarray(planes.reshape(size, -1).T).view(kind).ravel()
    return np.cumsum(steps, dtype=kind)


def cuts(ordered: np.ndarray, parts: int) -> np.ndarray:
    """Where each of ``parts`` equal ranges of 64-bit numbers starts in ``ordered``, and its end."""
    bounds = np.array([(p << 64) // parts for p in range(1, parts)], np.uint64)
    return np.concatenate(([0], np.searchsorted(ordered, bounds), [len(ordered)]))


class Bucket:
    """The texts of a bucket, in the order of their keys whatever order they come in."""

    def __init__(self, table: pa.Table):
        k1, k2 = table["k1"].to_numpy(), table["k2"].to_numpy()
        self.order = np.lexsort((k2, k1))
        self.k1, self.k2 = k1[self.order], k2[self.order]
        self.copies = table["copies"].to_numpy()[self.order]
        self.column = table["text"].cast(pa.large_binary())

    def texts(self, chosen: np.ndarray) -> Iterator[tuple[int, list[bytes]]]:
        """The chosen texts, some at a time, each time with the number of those before."""
        column = self.column.take(pa.array(self.order[chosen]))
        for begin, end in hashing.slices(column):
            yield begin, column.slice(begin, end - begin).to_pylist()


def anchor_rows(table: pa.Table, bucket: int, parts: int, width: int) -> pa.Table:
    """Index and probes of a bucket, a row per part of the hash range."""
    block = (width + 1) // 2
    texts = Bucket(table)
    rolled, indexed, owners, numbers = [], [], [], []
    for before, some in texts.texts(np.arange(len(texts.order))):
        words = hashing.Words(some)
        hashes = hashing.windows(words.hashes, block, ANCHOR_BASE)
        long_enough = np.repeat(words.counts >= width, words.counts)[: len(hashes)]
        whole = (words.left()[: len(hashes)] >= block) & long_enough
        place = (np.arange(len(words.hashes)) - np.repeat(words.first, words.counts))[: len(hashes)]
        index = np.flatnonzero(whole & (place % block == 0))
        owner = np.repeat(np.arange(before, before + len(some), dtype=np.uint32), words.counts)
        rolled.append(hashes[whole])
        indexed.append(hashes[index])
        owners.append(owner[index])
        numbers.append((place[index] // block).astype(np.uint32))
    probes, blocks = np.concatenate(rolled), np.concatenate(indexed)
    owner, number = np.concatenate(owners), np.concatenate(numbers)
    order = np.argsort(blocks, kind="stable")
    block_hashes, owner, number = blocks[order], owner[order], number[order]
    probes.sort()
    if len(probes) > 2:
        # Two of a kind tell as much as more.
        probes = probes[np.concatenate(([True, True], probes[2:] != probes[:-2]))]
    rows = {name: [] for name in ("part", "bucket", "probes", "blocks", "texts", "numbers")}
    probe_cuts, block_cuts = cuts(probes, parts), cuts(block_hashes, parts)
    for part in range(parts):
        a, b = probe_cuts[part], probe_cuts[part + 1]
        c, d = block_cuts[part], block_cuts[part + 1]
        if a < b:
            rows["part"].append(part)
            rows["bucket"].append(bucket)
            rows["probes"].append(pack(np.sort(probes[a:b].astype(np.uint32))))
            rows["blocks"].append(block_hashes[c:d].astype(np.uint32).tobytes())
            rows["texts"].append(owner[c:d].tobytes())
            rows["numbers"].append(number[c:d].tobytes())
    return pa.table(rows, schema=arrow_schema(ANCHORS))


def arrow_schema(ddl: str) -> pa.Schema:
    kinds = {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary(), "string": pa.string()}
    kinds["array<int>"] = pa.list_(pa.int32())
    return pa.schema([(name, kinds[kind]) for name, kind in (field.split() for field in ddl.split(", "))])


def hit_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of one part of the hash range: the blocks that more than one probe hits, by bucket."""
    rows = [r for batch in batches for r in batch.to_pylist()]
    out = {name: [] for name in ("bucket", "part", "texts", "numbers", "bits")}
    for part in sorted({r["part"] for r in rows}):
        own = [r for r in rows if r["part"] == part]
        probes = np.sort(np.concatenate([unpack(r["probes"], np.uint32) for r in own]))
        several = probes[1:][probes[1:] == probes[:-1]]
        for r in own:
            blocks = np.frombuffer(r["blocks"], np.uint32)
            at = np.searchsorted(several, blocks)
            hit = np.zeros(len(blocks), np.bool_)
            inside = at < len(several)
            hit[inside] = several[at[inside]] == blocks[inside]
            if hit.any():
                out["bucket"].append(r["bucket"])
                out["part"].append(part)
                out["texts"].append(np.frombuffer(r["texts"], np.uint32)[hit].tobytes())
                out["numbers"].append(np.frombuffer(r["numbers"], np.uint32)[hit].tobytes())
                out["bits"].append(None)
    yield from pa.table(out, schema=arrow_schema(HITS)).to_batches()


class Candidates:
    """The windows around a bucket's anchors, as hashes that stand once each."""

    def __init__(self, texts: Bucket, hits: pa.Table, parts: int, width: int):
        block = (width + 1) // 2
        hits = hits.filter(pa.compute.is_null(hits["bits"]))
        joined = [b"".join(hits[name].to_pylist()) for name in ("texts", "numbers")]
        owner, number = (np.frombuffer(x, np.uint32).astype(np.int64) for x in joined)
        order = np.argsort(owner, kind="stable")
        owner, number = owner[order], number[order]
        self.chosen, owner = np.unique(owner, return_inverse=True)
        counts, places, mains, checks, total = [], [], [], [], 0
        for before, some in texts.texts(self.chosen):
            words = hashing.Words(some)
            a, b = np.searchsorted(owner, (before, before + len(some)))
            own = owner[a:b] - before
            place = number[a:b, None] * block - np.arange(block)[None, :]
            fits = (place >= 0) & (place + width <= words.counts[own][:, None])
            at = np.sort((words.first[own][:, None] + place)[fits])
            for base, out in zip(WINDOW_BASES, (mains, checks), strict=True):
                hashes = hashing.windows(words.hashes, width, base)
                out.append(hashes[at] if len(at) else np.zeros(0, np.uint64))
            checks[-1] = (checks[-1] >> np.uint64(32)).astype(np.uint32)
            places.append(at + total)
            counts.append(words.counts)
            total += len(words.hashes)
        self.counts, self.places = np.concatenate(counts), np.concatenate(places)
        self.first = np.cumsum(self.counts) - self.counts
        main, check = np.concatenate(mains), np.concatenate(checks)
        self.order = np.argsort(main, kind="stable")
        main, check = main[self.order], check[self.order]
        new = np.ones(len(main), np.bool_)
        new[1:] = (main[1:] != main[:-1]) | (check[1:] != check[:-1])
        self.run = np.cumsum(new) - 1
        self.hashes, self.checks = main[new], check[new]
        self.several = np.bincount(self.run, minlength=len(self.hashes)) > 1
        self.cuts = cuts(self.hashes, parts)


def window_rows(texts: pa.Table, hits: pa.Table, bucket: int, parts: int, width: int) -> pa.Table:
    """Hashes of a bucket's candidate windows, a row per part of the hash range."""
    rows = {name: [] for name in ("part", "bucket", "hashes", "checks", "several")}
    if texts.num_rows and hits.num_rows:
        found = Candidates(Bucket(texts), hits, parts, width)
        for part in range(parts):
            a, b = found.cuts[part], found.cuts[part + 1]
            if a < b:
                rows["part"].append(part)
                rows["bucket"].append(bucket)
                rows["hashes"].append(pack(found.hashes[a:b]))
                rows["checks"].append(found.checks[a:b].tobytes())
                rows["several"].append(np.packbits(found.several[a:b]).tobytes())
    return pa.table(rows, schema=arrow_schema(WINDOWS))


def repeated_windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of one part of the hash range: for each bucket's windows, whether each occurs anywhere else."""
    rows = [r for batch in batches for r in batch.to_pylist()]
    out = {name: [] for name in ("bucket", "part", "texts", "numbers", "bits")}
    for part in sorted({r["part"] for r in rows}):
        own = [r for r in rows if r["part"] == part]
        hashes = [unpack(r["hashes"], np.uint64) for r in own]
        ends = np.cumsum([len(h) for h in hashes])
        several = np.concatenate([
            np.unpackbits(np.frombuffer(r["several"], np.uint8), count=len(h)) for r, h in zip(own, hashes, strict=True)
        ]).astype(np.bool_)
        main = np.concatenate(hashes)
        check = np.concatenate([np.frombuffer(r["checks"], np.uint32) for r in own])
        order = np.lexsort((check, main))
        main, check = main[order], check[order]
        same = (main[1:] == main[:-1]) & (check[1:] == check[:-1])
        twice = np.zeros(len(main), np.bool_)
        twice[1:] |= same
        twice[:-1] |= same
        several[order] |= twice
        for r, bits in zip(own, np.split(several, ends[:-1]), strict=True):
            out["bucket"].append(r["bucket"])
            out["part"].append(part)
            out["texts"].append(None)
            out["numbers"].append(None)
            out["bits"].append(np.packbits(bits).tobytes())
    yield from pa.table(out, schema=arrow_schema(HITS)).to_batches()


def kept_rows(texts: pa.Table, told: pa.Table, parts: int, width: int) -> pa.Table:
    """What is left of each text of a bucket, and the word ranges of its maximal exact repeats."""
    bucket = Bucket(texts)
    covered: dict[int, np.ndarray] = {}
    if told.num_rows:
        found = Candidates(bucket, told, parts, width)
        answers = told.filter(pa.compute.is_valid(told["bits"])).to_pydict()
        repeated = np.zeros(len(found.hashes), np.bool_)
        for part, bits in zip(answers["part"], answers["bits"], strict=True):
            a, b = found.cuts[part], found.cuts[part + 1]
            repeated[a:b] = np.unpackbits(np.frombuffer(bits, np.uint8), count=b - a)
        starts = found.places[found.order[repeated[found.run]]] if len(found.places) else found.places
        total = int(found.counts.sum())
        edges = np.bincount(starts, minlength=total + 1) - np.bincount(starts + width, minlength=total + 1)
        inside = np.cumsum(edges[:total]) > 0
        for text, first, count in zip(found.chosen, found.first, found.counts, strict=True):
            covered[int(text)] = inside[first : first + count]
    out = {name: [] for name in ("n_words", "n_removed", "kept_sha256", "starts", "ends")}
    every = ((before + i, t) for before, some in bucket.texts(np.arange(len(bucket.order))) for i, t in enumerate(some))
    for at, text in every:
        words = text.split()
        gone = covered.get(at)
        if bucket.copies[at] > 1 and len(words) >= width:
            gone = np.ones(len(words), np.bool_)
        if gone is None or not gone.any():
            kept, starts, ends = words, [], []
        else:
            kept = [w for w, g in zip(words, gone.tolist(), strict=True) if not g]
            edge = np.flatnonzero(np.diff(gone.astype(np.int8), prepend=0, append=0))
            starts, ends = edge[0::2].tolist(), edge[1::2].tolist()
        out["n_words"].append(len(words))
        out["n_removed"].append(len(words) - len(kept))
        out["kept_sha256"].append(hashlib.sha256(b" ".join(kept)).hexdigest())
        out["starts"].append(starts)
        out["ends"].append(ends)
    return pa.table({"k1": bucket.k1, "k2": bucket.k2, **out}, schema=arrow_schema(KEPT))


def first_of_each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Within a task: the first row of each text, the second without its text, no others."""
    seen: dict[tuple[int, int], int] = {}
    for batch in batches:
        passed, bare = [], []
        for at, key in enumerate(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)):
            times = seen.get(key, 0)
            if times < 2:
                seen[key] = times + 1
                passed.append(at)
                bare.append(times == 1)
        rows = batch.take(pa.array(passed, pa.int64()))
        text = pa.compute.if_else(pa.array(bare, pa.bool_()), pa.scalar(None, pa.string()), rows.column(2))
        yield pa.RecordBatch.from_arrays([rows.column(0), rows.column(1), text], ["k1", "k2", "text"])


def bucketed_texts(keyed: DataFrame, buckets: int) -> str:
    """The name of a table of distinct texts (bucket, k1, k2, text, copies), stored by bucket; drop it after use.

    ``copies`` is exact only up to 2.
    """
    spark = keyed.sparkSession
    distinct = (
        keyed.select("k1", "k2", "text")
        .mapInArrow(first_of_each, "k1 long, k2 long, text string")
        .withColumn("bucket", F.pmod("k1", F.lit(buckets)).cast("int"))
        .repartition(buckets, "bucket")
        .groupBy("bucket", "k1", "k2")
        .agg(F.first("text", ignorenulls=True).alias("text"), F.count("*").alias("copies"))
    )
    path = new_path(spark, "texts")
    name = path.rsplit("/", 1)[1].replace("-", "_")
    (
        distinct.write.bucketBy(buckets, "bucket")
        .option("path", path)
        .option("compression", "zstd")
        .saveAsTable(name)
    )
    return name


def find_repeats(
    docs: DataFrame, width: int = WIDTH, bucket_bytes: int = BUCKET_BYTES, most_buckets: int = MOST_BUCKETS
) -> tuple[DataFrame, DataFrame]:
    """Two tables: the rows' keys (doc_id, k1, k2), and per text (k1, k2) what is left of it.

    A row of the second has n_words, n_removed, kept_sha256 and the word ranges (starts, ends) of the
    maximal exact repeats: every word that a window covers whose words also start anywhere else. Buckets
    are as many as the session's shuffle partitions, or more where they would pass ``bucket_bytes``, up to
    ``most_buckets``.
    """
    k1, k2 = text_key(F.col("text"))
    plain = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    keyed = plain.select("doc_id", k1.alias("k1"), k2.alias("k2"), "text")
    size = F.octet_length("text").cast("long").alias("n_bytes")
    keys = materialise(keyed.select("doc_id", "k1", "k2", size), "text-keys")
    total = keys.agg(F.sum("n_bytes")).first()[0] or 0
    parts = min(most_buckets, max(partitions(docs), -(-total // bucket_bytes)))

    def anchors(key: tuple, table: pa.Table) -> pa.Table:
        return anchor_rows(table, key[0].as_py(), parts, width)

    def candidates(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
        return window_rows(left, right, key[0].as_py(), parts, width)

    def kept(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
        return kept_rows(left, right, parts, width)

    name = bucketed_texts(keyed, parts)
    try:
        texts = docs.sparkSession.table(name)
        sent = texts.groupBy("bucket").applyInArrow(anchors, ANCHORS)
        hits = materialise(sent.repartitionById(parts, F.col("part")).mapInArrow(hit_blocks, HITS), "anchors")
        around = texts.groupBy("bucket").cogroup(hits.groupBy("bucket")).applyInArrow(candidates, WINDOWS)
        bits = around.repartitionById(parts, F.col("part")).mapInArrow(repeated_windows, HITS)
        told = hits.unionByName(materialise(bits, "repeats"))
        left = texts.groupBy("bucket").cogroup(told.groupBy("bucket")).applyInArrow(kept, KEPT)
        return keys, materialise(left, "kept")
    finally:
        # Only the catalogue's entry goes; the files are working files like any other.
        docs.sparkSession.sql(f"DROP TABLE IF EXISTS {name}")


def digest(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """Per row: doc_id, n_words, n_removed, kept_sha256 (kept words joined by one space, UTF-8).

    A null text has no words. Repeated rows count as copies of each other; an empty table gives an empty
    one; other columns are not read.
    """
    keys, left = find_repeats(docs, width)
    return keys.join(left, ["k1", "k2"]).select("doc_id", "n_words", "n_removed", "kept_sha256")


def remove_repeats(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """``docs`` with the repeated words taken out of ``text``; texts without any stay as they are.

    Every row and column is kept. A null text stays null. What is left of a text that loses words is
    joined by single spaces, and may be empty.
    """
    _, left = find_repeats(docs, width)
    k1, k2, keeps = (free_name(docs, name) for name in ("k1", "k2", "keeps"))
    # The word ranges between the repeats: (first word from 1, number of words).
    begins = F.concat(F.array(F.lit(0)), "ends")
    lengths = F.zip_with(begins, F.concat("starts", F.array(F.col("n_words").cast("int"))), lambda a, b: b - a)
    ranges = F.zip_with(begins, lengths, lambda a, n: F.struct((a + 1).alias("at"), n.alias("n")))
    lossy = left.filter("n_removed > 0").select(
        F.col("k1").alias(k1), F.col("k2").alias(k2), F.filter(ranges, lambda r: r["n"] > 0).alias(keeps)
    )
    key1, key2 = text_key(F.col("text"))
    joined = docs.withColumns({k1: key1, k2: key2}).join(lossy, [k1, k2], "left")
    words = F.filter(F.split(F.col("text"), r"[\x20\x09-\x0D]+"), lambda w: w != "")
    kept = F.flatten(F.transform(keeps, lambda r: F.slice(words, r["at"], r["n"])))
    text = F.when(F.col(keeps).isNull(), F.col("text")).otherwise(F.array_join(kept, " "))
    return joined.withColumn("text", F.when(F.col("text").isNotNull(), text)).select(*docs.columns)
