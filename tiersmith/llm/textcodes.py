"""Words of whole texts as 64-bit codes, computed on the bytes of an Arrow column.

A word is a run of bytes outside a set of separators. Its code is a polynomial
over per-byte random values, read off a running sum, so a column of texts
costs a few array passes and no Python object per word. Texts are taken in
slices of some megabytes; a longer text is a slice of its own.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

SLICE_BYTES = 2_000_000

_U = np.uint64
_MULTIPLIER = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_MULTIPLIER, -1, 1 << 64)
_BYTE_VALUES = np.random.default_rng(20240607).integers(1, 1 << 63, 256, dtype=np.int64).astype(_U)
_POWERS: dict[int, np.ndarray] = {}

WHITE = np.zeros(256, bool)
WHITE[[9, 10, 11, 12, 13, 32]] = True

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

#: Everything but ASCII letters and the bytes of other alphabets separates.
NOT_LETTER = np.ones(256, bool)
NOT_LETTER[65:91] = NOT_LETTER[97:123] = NOT_LETTER[128:] = False


def _powers(n: int, base: int) -> np.ndarray:
    known = _POWERS.get(base)
    if known is None or len(known) < n:
        steps = np.full(max(n, SLICE_BYTES + 1), base, _U)
        steps[0] = 1
        known = np.multiply.accumulate(steps)
        if n <= 4 * SLICE_BYTES:
            _POWERS[base] = known
    return known[:n]


def mix(x: np.ndarray) -> np.ndarray:
    """Spread every bit of 64-bit codes over all bits."""
    x = x ^ (x >> _U(32))
    x = x * _U(0xD6E8FEB86659FD93)
    x = x ^ (x >> _U(29))
    x = x * _U(0xCA6B3F4B0C6B2D35)
    return x ^ (x >> _U(32))


@dataclass
class Slice:
    """Some texts of a batch: their bytes, and where each text begins."""

    first: int  # number of the first text in the batch
    data: np.ndarray  # bytes
    offsets: np.ndarray  # of each text, and the end

    def __len__(self) -> int:
        return len(self.offsets) - 1

    def words(self, separators: np.ndarray = WHITE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Starts and ends of all words, and the number of the first word of each text (and the end)."""
        n = len(self.data)
        if n == 0:
            none = np.zeros(0, np.int64)
            return none, none, np.zeros(len(self) + 1, np.int64)
        inside = ~separators[self.data]
        begins = np.zeros(n + 1, bool)
        begins[self.offsets] = True
        fresh = begins[:-1].copy()
        fresh[1:] |= ~inside[:-1]
        last = begins[1:].copy()
        last[:-1] |= ~inside[1:]
        starts = np.flatnonzero(inside & fresh)
        ends = np.flatnonzero(inside & last) + 1
        return starts, ends, np.searchsorted(starts, self.offsets)

    def prefix_sums(self, case: np.ndarray | None = LOWER) -> np.ndarray:
        """Running sums from which ``code`` reads any span."""
        data = self.data if case is None else case[self.data]
        sums = np.zeros(len(data) + 1, _U)
        np.cumsum(_BYTE_VALUES[data] * _powers(len(data), _MULTIPLIER), out=sums[1:])
        return sums


def code(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The 64-bit codes of the spans."""
    spans = (sums[ends] - sums[starts]) * _powers(len(sums), _INVERSE)[starts]
    return mix(spans + (ends - starts).astype(_U) * _U(0x632BE59BD9B4E019))


def follow(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """The code of a sequence that ``first`` stands for, followed by ``second``."""
    return mix(first * _U(0x9FB21C651E98DF25) + second + _U(0x2545F4914F6CDD1D))


def slices(texts: pa.Array | pa.ChunkedArray, limit: int = SLICE_BYTES) -> Iterator[Slice]:
    """The texts of a column in slices of about ``limit`` bytes; NULL is empty."""
    done = 0
    for chunk in texts.chunks if isinstance(texts, pa.ChunkedArray) else [texts]:
        chunk = chunk.fill_null("").cast(pa.large_string())
        n = len(chunk)
        buffers = chunk.buffers()
        if n:
            offsets = np.frombuffer(buffers[1], np.int64)[chunk.offset : chunk.offset + n + 1]
            data = np.frombuffer(buffers[2], np.uint8) if buffers[2] else np.zeros(0, np.uint8)
            at = 0
            while at < n:
                to = int(np.searchsorted(offsets, offsets[at] + limit, "right")) - 1
                to = min(n, max(at + 1, to))
                yield Slice(done + at, data[offsets[at] : offsets[to]], offsets[at : to + 1] - offsets[at])
                at = to
        done += n


def text_of_batch(batch: pa.RecordBatch, name: str = "text") -> pa.Array:
    return batch.column(batch.schema.get_field_index(name))


def sorted_distinct(x: np.ndarray) -> np.ndarray:
    """The distinct values in order; ``np.unique`` hashes, which is far slower here."""
    x = np.sort(x)
    if len(x) < 2:
        return x
    keep = np.empty(len(x), bool)
    keep[0] = True
    np.not_equal(x[1:], x[:-1], out=keep[1:])
    return x[keep]
