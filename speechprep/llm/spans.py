"""Words and lines of many texts at once, as numpy arrays over their UTF-8 bytes.

White space is the six ASCII characters 0x09-0x0D and 0x20. No byte of a longer
UTF-8 sequence has such a value, so words can be cut in the bytes.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of text that are worked on at once; a longer text is worked on alone.
CHUNK_BYTES = 1 << 20

IN_WORD = np.ones(256, dtype=bool)
IN_WORD[[0x20, *range(0x09, 0x0E)]] = False
LOWER_AZ = np.arange(256, dtype=np.uint8)
LOWER_AZ[ord("A") : ord("Z") + 1] += 32

_FACTOR = np.uint64(0x9E3779B97F4A7C15)


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit numbers (the finaliser of splitmix64)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


_LETTERS = mix(np.arange(1, 257, dtype=np.uint64) * _FACTOR)


class _Powers:
    """Powers of an odd factor modulo 2**64, and of its inverse."""

    factor = 0xD6E8FEB86659FD93
    inverse = pow(factor, -1, 1 << 64)

    def __init__(self) -> None:
        self.up = self.down = np.ones(1, dtype=np.uint64)

    def upto(self, n: int) -> None:
        if len(self.up) <= n:
            size = (n | 0xFFFFF) + 1  # in steps of a million
            self.up = self._run(self.factor, size)
            self.down = self._run(self.inverse, size)

    @staticmethod
    def _run(factor: int, size: int) -> np.ndarray:
        out = np.full(size, factor, dtype=np.uint64)
        out[0] = 1
        return np.multiply.accumulate(out)


_POWERS = _Powers()


@dataclass
class Texts:
    """Texts one after the other: ``data[starts[i]:starts[i + 1]]`` is text i."""

    data: np.ndarray
    starts: np.ndarray

    def __len__(self) -> int:
        return len(self.starts) - 1

    def lower(self) -> Texts:
        return Texts(LOWER_AZ[self.data], self.starts)

    def words(self) -> tuple[np.ndarray, np.ndarray]:
        """Starts and ends of all words, in order; none crosses two texts."""
        inside = IN_WORD[self.data]
        return self._runs(inside)

    def _runs(self, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        n = len(inside)
        if n == 0:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        cuts = self.starts[(self.starts > 0) & (self.starts < n)]
        before = np.empty(n, dtype=bool)
        before[0] = False
        before[1:] = inside[:-1]
        before[cuts] = False
        after = np.empty(n, dtype=bool)
        after[-1] = False
        after[:-1] = inside[1:]
        after[cuts - 1] = False
        return np.flatnonzero(inside & ~before), np.flatnonzero(inside & ~after) + 1

    def lines(self) -> tuple[np.ndarray, np.ndarray]:
        """Starts and ends of all lines, empty ones included; a text has one more
        line than line feeds."""
        feeds = np.flatnonzero(self.data == 10)
        starts = np.sort(np.concatenate([self.starts[:-1], feeds + 1]), kind="stable")
        ends = np.sort(np.concatenate([self.starts[1:], feeds]), kind="stable")
        return starts, ends

    def owners(self, starts: np.ndarray) -> np.ndarray:
        """The text that each non-empty span belongs to."""
        return np.searchsorted(self.starts, starts, "right") - 1

    def hashes(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """64-bit hashes of spans, from differences of one polynomial prefix sum."""
        n = len(self.data)
        _POWERS.upto(n)
        sums = np.zeros(n + 1, dtype=np.uint64)
        np.cumsum(_LETTERS[self.data] * _POWERS.up[:n], out=sums[1:])
        value = (sums[ends] - sums[starts]) * _POWERS.down[starts]
        return mix(value + (ends - starts).astype(np.uint64) * _FACTOR)

    def characters(self) -> np.ndarray:
        """Running number of code points before each byte, and at the end."""
        out = np.zeros(len(self.data) + 1, dtype=np.int64)
        np.cumsum((self.data & 0xC0) != 0x80, out=out[1:])
        return out


def texts_of(column: pa.Array) -> Texts:
    """The bytes and offsets of a text column without nulls."""
    if pa.types.is_large_string(column.type):
        kind = np.int64
    else:
        column, kind = column.cast(pa.string()), np.int32
    buffers = column.buffers()
    if len(column) == 0 or buffers[2] is None:
        return Texts(np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64))
    starts = np.frombuffer(buffers[1], kind, len(column) + 1, column.offset * kind().itemsize)
    starts = starts.astype(np.int64)
    data = np.frombuffer(buffers[2], np.uint8, starts[-1] - starts[0], starts[0])
    return Texts(data, starts - starts[0])


def parts_of(batch: pa.RecordBatch, text: str, limit: int) -> Iterator[pa.RecordBatch]:
    """Slices of a batch with at most ``limit`` bytes of text, or one row."""
    column = batch.column(batch.schema.get_field_index(text))
    sizes = pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False)
    ends = np.cumsum(sizes, dtype=np.int64)
    first = 0
    while first < len(sizes):
        base = ends[first - 1] if first else 0
        last = max(int(np.searchsorted(ends, base + limit, "right")), first + 1)
        yield batch.slice(first, last - first)
        first = last


def pieces(
    batches: Iterator[pa.RecordBatch], text: str, limit: int = CHUNK_BYTES
) -> Iterator[tuple[pa.RecordBatch, Texts]]:
    """Slices of the batches with their texts' bytes. Null texts are empty."""
    for batch in batches:
        at = batch.schema.get_field_index(text)
        for part in parts_of(batch, text, limit):
            yield part, texts_of(pc.fill_null(part.column(at), ""))


def grams(words: np.ndarray, owners: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the runs of ``n`` words within one text, and their first words."""
    count = len(words) - n + 1
    if count <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    firsts = np.flatnonzero(owners[:count] == owners[n - 1 :])
    value = np.zeros(len(firsts), dtype=np.uint64)
    for k in range(n):
        value = value * np.uint64(_Powers.factor) + words[firsts + k]
    return mix(value), firsts
