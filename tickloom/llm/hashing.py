"""Hashes of words and of windows of words, for many texts at once."""

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute

# One step covers about so many bytes of text, or windows, however many there are.
STEP = 1 << 18
# Texts are handled together up to about so many bytes.
SLICE_BYTES = 1 << 21
BLANKS = b" \t\n\x0b\x0c\r"
BASE = 0x9E3779B97F4A7C15
MASK = (1 << 64) - 1

_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def powers(base: int, count: int) -> tuple[np.ndarray, np.ndarray]:
    """``base**i`` and ``base**-i`` modulo 2**64 for i below ``count``; ``base`` is odd."""
    known = _powers.get(base)
    if known is None or len(known[0]) < count:
        size = max(count, STEP + 1024)
        known = []
        for factor in (base, pow(base, -1, 1 << 64)):
            steps = np.full(size, factor, np.uint64)
            steps[0] = 1
            known.append(np.cumprod(steps))
        known = _powers[base] = tuple(known)
    return known[0][:count], known[1][:count]


def scramble(x: np.ndarray) -> np.ndarray:
    """Spread every bit of 64-bit numbers over all others."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xC4CEB9FE1A85EC53)
    x ^= x >> np.uint64(33)
    return x


def byte_classes(lower: bool) -> tuple[np.ndarray, np.ndarray]:
    """Per byte value: the number it counts as, and whether it is a blank."""
    values = np.arange(1, 257, dtype=np.uint64)
    if lower:
        values[65:91] = values[97:123]
    gaps = np.zeros(256, np.bool_)
    gaps[list(BLANKS)] = True
    return values, gaps


class Words:
    """The words of several texts: ``hashes``, and per text where its words start and end in them."""

    def __init__(self, texts: list[bytes], lower: bool = False):
        joined = b" ".join(texts) + b" "
        lengths = np.fromiter((len(t) + 1 for t in texts), np.int64, len(texts))
        text_ends = np.cumsum(lengths)
        values, gaps = byte_classes(lower)
        blank = re.compile(rb"[\x20\x09-\x0D]")
        hashes, starts, begin = [], [], 0
        while begin < len(joined):
            end = min(len(joined), begin + STEP)
            if end < len(joined):
                # A step ends after a blank, so no word is cut.
                found = blank.search(joined, end)
                end = found.end() if found else len(joined)
            raw = np.frombuffer(joined, np.uint8, end - begin, begin)
            gap = gaps[raw]
            edge = np.flatnonzero(gap[1:] != gap[:-1]) + 1
            if not gap[0]:
                edge = np.concatenate(([0], edge))
            first, last = edge[0::2], edge[1::2]
            forward, back = powers(BASE, len(raw))
            sums = np.zeros(len(raw) + 1, np.uint64)
            np.cumsum(values[raw] * forward, out=sums[1:])
            hashes.append(scramble((sums[last] - sums[first]) * back[first]))
            starts.append(first + begin)
            begin = end
        self.hashes = np.concatenate(hashes) if hashes else np.zeros(0, np.uint64)
        at = np.concatenate(starts) if starts else np.zeros(0, np.int64)
        ends = np.searchsorted(at, text_ends)
        self.first = np.concatenate(([0], ends[:-1])).astype(np.int64)
        self.counts = (ends - self.first).astype(np.int64)

    def left(self) -> np.ndarray:
        """Per word: how many words of its text are left, itself included."""
        ends = np.repeat(self.first + self.counts, self.counts)
        return ends - np.arange(len(self.hashes))


def windows(hashes: np.ndarray, width: int, base: int) -> np.ndarray:
    """Hash of ``width`` neighbouring word hashes from each place that has so many after it."""
    count = max(0, len(hashes) - width + 1)
    out = np.zeros(count, np.uint64)
    for begin in range(0, count, STEP):
        end = min(count, begin + STEP)
        some = hashes[begin : end + width - 1]
        forward, back = powers(base, len(some))
        sums = np.zeros(len(some) + 1, np.uint64)
        np.cumsum(some * forward, out=sums[1:])
        out[begin:end] = scramble((sums[width:] - sums[:-width]) * back[: end - begin])
    return out


def slices(texts: pa.Array | pa.ChunkedArray, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of rows with about ``limit`` bytes of text together, at least one row each."""
    sizes = pa.compute.fill_null(pa.compute.binary_length(texts), 0).to_numpy(zero_copy_only=False)
    ends = np.cumsum(sizes, dtype=np.int64)
    begin = 0
    while begin < len(sizes):
        done = ends[begin - 1] if begin else 0
        end = max(begin + 1, int(np.searchsorted(ends, done + limit, side="right")))
        yield begin, end
        begin = end
