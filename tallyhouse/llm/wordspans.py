"""Words of whole texts as spans of one byte buffer, found with numpy over Arrow columns.

A word is a run of bytes other than space and 0x09-0x0D. Those six bytes occur in UTF-8 only as
themselves, so byte spans are word spans. Null texts have no words.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: The words of Spark SQL and DuckDB regular expressions.
WORD = r"[^\x20\x09-\x0D]+"
#: Bytes of text handled at once; one longer text is still taken whole.
CHUNK_BYTES = 1 << 20
#: Rows handled at once: the row number must fit the upper 12 bits of a sort key.
CHUNK_ROWS = 4096
#: Bits of a hash that stand beside the row number in a sort key.
KEY_BITS = np.uint64(52)

_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BASE = 0x9E3779B97F4A7C15
_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser that spreads every input bit over the 64 bits of the result."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    """base ** i and its inverse modulo 2 ** 64, for i below ``size``."""
    have = _POWERS.get(0)
    if have is None or len(have[0]) < size:
        room = max(size, CHUNK_BYTES + (1 << 16))
        tables = []
        for base in (_BASE, pow(_BASE, -1, 1 << 64)):
            table = np.full(room, base, dtype=np.uint64)
            table[0] = 1
            tables.append(np.multiply.accumulate(table))
        have = (tables[0], tables[1])
        if room <= CHUNK_BYTES + (1 << 16):
            _POWERS[0] = have
    return have


def rolling(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hash of values[start:end] for each span, by differences of one running sum."""
    power, inverse = _powers(len(values) + 1)
    total = np.empty(len(values) + 1, dtype=np.uint64)
    total[0] = 0
    np.cumsum(values * power[: len(values)], out=total[1:])
    return mix((total[ends] - total[starts]) * inverse[starts])


@dataclass
class Words:
    """Words of a chunk of rows: row number and place of each, and the bytes they stand in."""

    rows: int
    data: np.ndarray
    row: np.ndarray
    start: np.ndarray
    end: np.ndarray

    def counts(self) -> np.ndarray:
        return np.bincount(self.row, minlength=self.rows)

    def hashes(self) -> np.ndarray:
        """64-bit hash of each word, taken block by block to bound the memory."""
        out = np.empty(len(self.start), dtype=np.uint64)
        first = 0
        while first < len(out):
            lo = int(self.start[first])
            last = max(first + 1, int(np.searchsorted(self.end, lo + CHUNK_BYTES, side="right")))
            block = self.data[lo : int(self.end[last - 1])].astype(np.uint64) + np.uint64(1)
            out[first:last] = rolling(block, self.start[first:last] - lo, self.end[first:last] - lo)
            first = last
        return out

    def packed(self) -> tuple[bytes, np.ndarray]:
        """All words, one space after each, and where each word starts there (one more entry: the end)."""
        size = self.end - self.start + 1
        place = np.zeros(len(size) + 1, dtype=np.int64)
        np.cumsum(size, out=place[1:])
        out = np.full(place[-1], 0x20, dtype=np.uint8)
        if len(size):
            inside = np.ones(place[-1], dtype=bool)
            inside[place[1:] - 1] = False
            out[inside] = self.data[_covered(self.start, self.end, len(self.data))]
        return out.tobytes(), place


def _covered(starts: np.ndarray, ends: np.ndarray, size: int) -> np.ndarray:
    step = np.zeros(size + 1, dtype=np.int8)
    step[starts] += 1
    step[ends] -= 1  # a word may start where the one of the row before ends
    return np.cumsum(step[:-1], dtype=np.int8).view(bool)


def buffer_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all rows and the offsets of each row in them."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = pc.fill_null(texts, "")
    wide = pa.types.is_large_string(texts.type)
    _, offsets, data = texts.buffers()
    if data is None or not len(texts):
        return np.zeros(0, dtype=np.uint8), np.zeros(len(texts) + 1, dtype=np.int64)
    at = np.frombuffer(offsets, dtype=np.int64 if wide else np.int32)[texts.offset : texts.offset + len(texts) + 1]
    at = at.astype(np.int64)
    return np.frombuffer(data, dtype=np.uint8)[at[0] : at[-1]], at - at[0]


def find_words(texts: pa.Array, lower: bool = False) -> Words:
    """Words of each row; ``lower`` turns A-Z into a-z first."""
    data, at = buffer_of(texts)
    if lower:
        data = _LOWER[data]
    inside = ~_SPACE[data]
    begins, stops = inside.copy(), inside.copy()
    begins[1:] &= ~inside[:-1]
    stops[:-1] &= ~inside[1:]
    edge = np.unique(at[:-1])
    edge = edge[edge < len(data)]
    begins[edge] = inside[edge]
    edge = edge[edge > 0] - 1
    stops[edge] = inside[edge]
    start = np.flatnonzero(begins)
    return Words(len(texts), data, np.searchsorted(at, start, side="right") - 1, start, np.flatnonzero(stops) + 1)


def chunks(batches: Iterator[pa.RecordBatch], text: str, rows: int = CHUNK_ROWS, size: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """The same rows in slices of bounded bytes and rows, so that memory doesn't follow the batch."""
    for batch in batches:
        lengths = pc.fill_null(pc.binary_length(batch.column(batch.schema.get_field_index(text))), 0)
        ends = np.cumsum(lengths.to_numpy(zero_copy_only=False).astype(np.int64))
        first = 0
        while first < batch.num_rows:
            before = ends[first - 1] if first else 0
            last = min(first + rows, max(first + 1, int(np.searchsorted(ends, before + size, side="right"))))
            yield batch.slice(first, last - first)
            first = last
    let_go()


def let_go() -> None:
    """Give freed memory back to the system, so that a worker that waits for its next task is small."""
    for pool in (pa.default_memory_pool(), pa.system_memory_pool()):
        pool.release_unused()


def runs(flags: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the stretches of True."""
    step = np.diff(np.concatenate(([0], flags.view(np.int8), [0])))
    return np.flatnonzero(step == 1), np.flatnonzero(step == -1)
