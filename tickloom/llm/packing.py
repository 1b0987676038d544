"""Best-fit packing of tokenised documents into sequences of a fixed capacity.

Pieces above a third of the capacity fit at most twice into a sequence: those above a half open one each,
and the others are matched to them greedily, the tightest gap first and the largest piece that fits it;
what stays is paired among itself. Smaller pieces then go, largest first, into the tightest remaining gap.

The plan depends only on how many pieces there are of each length, so it is made from that histogram (at
most ``capacity`` counts, however many documents), as groups of equal sequences. A piece finds its place
by its number among the pieces of its length.
"""

import bisect
import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.llm.hashing import slices
from tickloom.llm.tables import materialise
from tickloom.operators.spread import row_numbers

CAPACITY = 2048
#: Below this code point both tokenizer libraries agree on which characters are letters, digits or blanks.
LATIN = "ɐ"


class ByteTokenizer:
    """Ids as the tokenizers library gives them for its JSON file, without added special tokens.

    ``ranks`` names a file with the same vocabulary as ranks. Latin texts without a special string are
    encoded from it by tiktoken, which gives the same ids five times as fast; all others take the
    reference path.
    """

    def __init__(self, vocabulary: str, ranks: str | None = None, pattern: str | None = None):
        from tokenizers import Tokenizer

        self.exact = Tokenizer.from_file(vocabulary)
        self.special = [t.content for t in self.exact.get_added_tokens_decoder().values()]
        self.fast = None
        if ranks and pattern:
            import base64

            import tiktoken

            with open(ranks, "rb") as lines:
                table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
            self.fast = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=table, special_tokens={})

    def encode(self, text: str) -> np.ndarray:
        latin = self.fast is not None and (text.isascii() or max(text) < LATIN)
        if latin and not any(s in text for s in self.special):
            return np.asarray(self.fast.encode_ordinary(text), np.dtype("<u4"))
        return np.asarray(self.exact.encode(text, add_special_tokens=False).ids, np.dtype("<u4"))


def public_vocabulary(name: str = "byte_bpe_50k") -> dict[str, str]:
    """Arguments of ``ByteTokenizer`` for an installed public vocabulary."""
    import public_tokenizers

    return {
        "vocabulary": public_tokenizers.path(f"{name}.json"),
        "ranks": public_tokenizers.path(f"{name}.tiktoken"),
        "pattern": public_tokenizers.PATTERN,
    }


def cut(length: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of a document: full ones, with the shorter one in front."""
    first = length % capacity or capacity
    return [(0, first)] + [(start, capacity) for start in range(first, length, capacity)]


def tokenised_pieces(docs: DataFrame, tokenizer: dict[str, str], capacity: int = CAPACITY, end: int = 0) -> DataFrame:
    """Per piece: doc_id, piece, start, length, ids (with ``end`` after the document's last id).

    A null text counts as empty: one piece that holds the end id alone.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = ByteTokenizer(**tokenizer)
        for batch in (w.slice(a, b - a) for w in batches for a, b in slices(w.column(1))):
            rows = {"at": [], "piece": [], "start": [], "length": [], "crc": [], "ids": []}
            for at, text in enumerate(batch.column(1).to_pylist()):
                ids = np.append(encoder.encode(text or ""), np.array([end], "<u4")).astype("<u4")
                for piece, (start, length) in enumerate(cut(len(ids), capacity)):
                    part = ids[start : start + length]
                    rows["at"].append(at)
                    rows["piece"].append(piece)
                    rows["start"].append(start)
                    rows["length"].append(length)
                    rows["crc"].append(zlib.crc32(part.tobytes()))
                    rows["ids"].append(part.tobytes())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(pa.array(rows["at"], pa.int64())),
                    pa.array(rows["piece"], pa.int32()),
                    pa.array(rows["start"], pa.int64()),
                    pa.array(rows["length"], pa.int64()),
                    pa.array(rows["crc"], pa.int64()),
                    pa.array(rows["ids"], pa.binary()),
                ],
                ["doc_id", "piece", "start", "length", "ids_crc32", "ids"],
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, piece int, start long, length long, ids_crc32 long, ids binary"
    return docs.select("doc_id", "text").mapInArrow(run, schema)


class Plan:
    """Groups of equal sequences, planned from a histogram of lengths.

    A group is a number of sequences and the (length, times) that each holds; ``gaps`` keeps the groups by
    the room that is left.
    """

    def __init__(self, histogram: dict[int, int], capacity: int):
        self.capacity = capacity
        self.left = {s: n for s, n in histogram.items() if n > 0}
        self.gaps: dict[int, list[tuple[list[tuple[int, int]], int]]] = defaultdict(list)
        self.open: list[int] = []
        self.match_large()
        for length in sorted((s for s in self.left if self.left[s]), reverse=True):
            self.best_fit(length, self.left.pop(length))

    def add(self, holds: list[tuple[int, int]], count: int, gap: int) -> None:
        if gap not in self.gaps or not self.gaps[gap]:
            bisect.insort(self.open, gap)
        self.gaps[gap].append((holds, count))

    def match_large(self) -> None:
        half, third = self.capacity / 2, self.capacity / 3
        medium = sorted(s for s in self.left if third < s <= half)
        for big in sorted((s for s in self.left if s > half), reverse=True):
            count, gap = self.left.pop(big), self.capacity - big
            while count:
                at = bisect.bisect_right(medium, gap)
                if not at:
                    self.add([(big, 1)], count, gap)
                    break
                other = medium[at - 1]
                pairs = min(count, self.left[other])
                self.add([(big, 1), (other, 1)], pairs, gap - other)
                count -= pairs
                self.left[other] -= pairs
                if not self.left[other]:
                    medium.pop(at - 1)
        spare = None
        for length in reversed(medium):
            count = self.left.pop(length)
            if spare:
                self.add([(spare, 1), (length, 1)], 1, self.capacity - spare - length)
                spare, count = None, count - 1
            if count > 1:
                self.add([(length, 2)], count // 2, self.capacity - 2 * length)
            if count % 2:
                spare = length
        if spare:
            self.add([(spare, 1)], 1, self.capacity - spare)

    def best_fit(self, length: int, count: int) -> None:
        while count:
            at = bisect.bisect_left(self.open, length)
            if at == len(self.open):
                times = self.capacity // length
                if count >= times:
                    self.add([(length, times)], count // times, self.capacity - times * length)
                if count % times:
                    rest = count % times
                    self.add([(length, rest)], 1, self.capacity - rest * length)
                return
            gap = self.open[at]
            holds, sequences = self.gaps[gap].pop()
            if not self.gaps[gap]:
                self.open.pop(at)
            times = gap // length
            filled = min(sequences, count // times)
            if filled:
                self.add([*holds, (length, times)], filled, gap - times * length)
                count -= filled * times
                sequences -= filled
            if sequences and count:
                self.add([*holds, (length, count)], 1, gap - count * length)
                sequences, count = sequences - 1, 0
            if sequences:
                self.add(holds, sequences, gap)

    def places(self) -> dict[int, list[tuple[int, int, int, int]]]:
        """By length: (first number, sequences, first sequence, offset) of the groups that hold it, in order.

        Piece number ``n`` of the run goes to sequence ``first + (n - first number) % sequences``.
        """
        taken: dict[int, int] = defaultdict(int)
        out: dict[int, list[tuple[int, int, int, int]]] = defaultdict(list)
        sequence = 0
        for gap in sorted(self.gaps):
            for holds, count in self.gaps[gap]:
                offset = 0
                for length, times in holds:
                    out[length].append((taken[length], count, sequence, offset))
                    taken[length] += count * times
                    offset += length * times
                sequence += count
        self.sequences = sequence
        return out


def place_pieces(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to written ``pieces`` with a ``length`` column (1 to ``capacity``).

    The plan is broadcast: its rows are bounded by the capacity, not by the data. Numbers among the pieces
    of one length come from range partitions, so a common length may hold any share of the rows.
    """
    histogram = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}
    places = sorted(Plan(histogram, capacity).places().items())
    kind = "__length long, __runs array<struct<first: long, sequences: long, sequence: long, offset: long>>"
    plan = pieces.sparkSession.createDataFrame(places, kind)
    numbered = row_numbers(pieces, ["length"], ["doc_id", "piece"], "__number", "__whole")
    joined = numbered.join(F.broadcast(plan), F.col("length") == F.col("__length"))
    number = F.col("__number") - 1
    run = F.element_at(F.filter("__runs", lambda r: r["first"] <= number), -1)
    inside = number - F.col("__run")["first"]
    return (
        joined.withColumn("__run", run)
        .withColumn("sequence_id", F.col("__run")["sequence"] + inside % F.col("__run")["sequences"])
        .withColumn(
            "offset",
            F.col("__run")["offset"]
            + (F.floor(inside / F.col("__run")["sequences"]) * F.col("length")).cast("long"),
        )
        .drop("__length", "__runs", "__run", "__number", "__whole")
    )


def pack(docs: DataFrame, tokenizer: dict[str, str], capacity: int = CAPACITY) -> DataFrame:
    """Per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    Documents beyond the capacity are cut into full pieces with the shorter one in front. Repeated rows are
    packed as often as they stand; null texts as empty; an empty table gives no pieces; other columns are
    not read.
    """
    pieces = materialise(tokenised_pieces(docs, tokenizer, capacity).drop("ids"), "pieces")
    return place_pieces(pieces, capacity)


def sequences(docs: DataFrame, tokenizer: dict[str, str], capacity: int = CAPACITY) -> DataFrame:
    """The packed sequences themselves: sequence_id and its ids as little-endian unsigned 32-bit numbers."""
    pieces = materialise(tokenised_pieces(docs, tokenizer, capacity), "pieces")
    placed = place_pieces(pieces, capacity)
    parts = F.transform(F.array_sort(F.collect_list(F.struct("offset", "ids"))), lambda p: p["ids"])
    joined = F.aggregate(parts, F.lit(b"").cast("binary"), lambda a, b: F.concat(a, b))
    return placed.groupBy("sequence_id").agg(joined.alias("ids"))
