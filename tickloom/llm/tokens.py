"""Token counts of whole texts, with overlapping chunks for huge ones.

A text beyond ``chunk`` characters is encoded in overlapping chunks with offsets. Two neighbours are spliced
at a token boundary that both show inside their overlap and that is proven stable: no piece of the
vocabulary can cross it, so what stands on one side cannot change the other. Where an overlap has no such
boundary, it is widened, up to the whole text.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame

from tickloom.llm.hashing import slices

CHUNK = 32_768
OVERLAP = 512
BATCH = 256
BLANK = "▁"


class PieceCounter:
    """Counts the pieces of a SentencePiece BPE model; special strings in a text are ordinary text."""

    def __init__(self, model: str, chunk: int = CHUNK, overlap: int = OVERLAP):
        import sentencepiece

        self.encoder = sentencepiece.SentencePieceProcessor(model_file=model)
        self.chunk, self.overlap = max(2, chunk), max(1, min(overlap, chunk // 2))
        pieces = [self.encoder.id_to_piece(i) for i in range(self.encoder.get_piece_size())]
        longer = [p for p in pieces if len(p) > 1]
        # Characters inside pieces of several characters; any other character always stands alone.
        self.joining = set("".join(longer)) | {" ", BLANK}
        self.words_end = not any(
            a != BLANK and b == BLANK for p in longer for a, b in zip(p, p[1:], strict=False)
        )

    def stable(self, text: str, at: int) -> bool:
        """Whether no piece can cover both sides of position ``at``."""
        left, right = text[at - 1], text[at]
        if left not in self.joining or right not in self.joining:
            return True
        return self.words_end and left not in (" ", BLANK) and right in (" ", BLANK)

    def starts(self, text: str, begin: int, end: int) -> np.ndarray:
        """Places in ``text`` where the pieces of ``text[begin:end]`` start, in order."""
        pieces = self.encoder.encode(text[begin:end], return_type="proto").pieces
        at = np.fromiter((p.begin for p in pieces), np.int64, len(pieces))
        # Offsets count UTF-8 bytes; the bytes that open a character give its place.
        raw = np.frombuffer(text[begin:end].encode() + b"$", np.uint8)
        return begin + np.cumsum((raw & 0xC0) != 0x80)[at] - 1

    def count_long(self, text: str) -> int:
        length = len(text)
        begin, end, counted_to, total = 0, min(len(text), self.chunk), 0, 0
        here = self.starts(text, begin, end)
        while end < length:
            overlap = self.overlap
            while True:
                start, stop = end - overlap, min(length, end - overlap + self.chunk)
                if start <= begin or stop <= end:
                    # Widened over the whole chunk: take one twice as long instead.
                    end = min(length, begin + max(2 * (end - begin), self.chunk))
                    here = self.starts(text, begin, end)
                    break
                there = self.starts(text, start, stop)
                common = np.intersect1d(here, there)
                common = common[(common > max(start, counted_to)) & (common < end)]
                splice = next((int(x) for x in common[::-1] if self.stable(text, int(x))), None)
                if splice is not None:
                    total += int(np.count_nonzero((here >= counted_to) & (here < splice)))
                    begin, end, counted_to, here = start, stop, splice, there
                    break
                overlap *= 2
        return total + int(np.count_nonzero(here >= counted_to))

    def count(self, texts: list[str]) -> list[int]:
        counts = [0] * len(texts)
        short = [i for i, t in enumerate(texts) if len(t) <= self.chunk]
        for first in range(0, len(short), BATCH):
            some = short[first : first + BATCH]
            for i, ids in zip(some, self.encoder.encode([texts[i] for i in some], num_threads=1), strict=True):
                counts[i] = len(ids)
        for i, text in enumerate(texts):
            if len(text) > self.chunk:
                counts[i] = self.count_long(text)
        return counts


def count_tokens(
    docs: DataFrame, model: str, limit: int = 4096, chunk: int = CHUNK, overlap: int = OVERLAP
) -> DataFrame:
    """Per row: doc_id, n_bytes (UTF-8), n_tokens and over_limit (more than ``limit`` tokens).

    Each row is handled on its own, so there is no shuffle and a lost task is simply run again. A null text
    counts as empty: 0 bytes, 0 tokens. Repeated rows give repeated rows, an empty table an empty one;
    other columns are not read.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = PieceCounter(model, chunk, overlap)
        for batch in batches:
            counts: list[int] = []
            for begin, end in slices(batch.column(1)):
                counts += counter.count([t or "" for t in batch.column(1).slice(begin, end - begin).to_pylist()])
            size = pa.compute.fill_null(pa.compute.binary_length(batch.column(1)), 0)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    size.cast(pa.int64()),
                    pa.array(counts, pa.int64()),
                    pa.array([n > limit for n in counts], pa.bool_()),
                ],
                ["doc_id", "n_bytes", "n_tokens", "over_limit"],
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, n_bytes long, n_tokens long, over_limit boolean"
    return docs.select("doc_id", "text").mapInArrow(run, schema)
