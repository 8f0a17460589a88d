"""Words of a batch of texts as arrays: spans, 64-bit hashes and rolling hashes, without a loop over words."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

from phraseloom.llm.scratch import process_cache

MASK = (1 << 64) - 1
BYTE_BASE = 0x9E3779B97F4A7C15
WORD_BASE = 0xD1342543DE82EF95
SLICE_BYTES = 1 << 19


def byte_class(*ranges: tuple[int, int]) -> np.ndarray:
    """True for the bytes that split words."""
    table = np.zeros(256, bool)
    for low, high in ranges:
        table[low : high + 1] = True
    return table


BLANKS = byte_class((0x20, 0x20), (0x09, 0x0D))
NOT_ALNUM = byte_class((0x00, 0x2F), (0x3A, 0x60), (0x7B, 0x7F))
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def mix(h: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values (a bijection)."""
    h = h ^ (h >> np.uint64(30))
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def byte_values() -> np.ndarray:
    return mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xA0761D6478BD642F))


def powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """base**i and base**-i modulo 2**64 for i below n; kept in the process, grown when needed."""
    cache = process_cache()
    have = cache.get(("powers", base))
    if have is None or len(have[0]) < n:
        size = 1 << max(16, (n - 1).bit_length())
        pair = []
        for b in (base, pow(base, -1, 1 << 64)):
            a = np.ones(size, np.uint64)
            step, length = b, 1
            while length < size:
                a[length : 2 * length] = a[:length] * np.uint64(step)
                step, length = step * step & MASK, 2 * length
            pair.append(a)
        have = cache[("powers", base)] = tuple(pair)
    return have[0][:n], have[1][:n]


class Words:
    """Words of some texts. `start`, `end`: bytes; `first`: index of each text's first word, and their number last."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, split: np.ndarray, lower: bool):
        self.data = LOWER[data] if lower else data
        n = len(data)
        inside = np.zeros(n + 2, bool)
        np.logical_not(split[self.data], out=inside[1:-1])
        begins = inside[1:-1] & ~inside[:-2]
        ends = inside[1:-1] & ~inside[2:]
        edge = offsets[:-1][offsets[:-1] < offsets[1:]]  # a text starts a word, and ends the one before it
        begins[edge] = inside[1:-1][edge]
        edge = offsets[1:][offsets[:-1] < offsets[1:]] - 1
        ends[edge] = inside[1:-1][edge]
        self.start = np.flatnonzero(begins)
        self.end = np.flatnonzero(ends) + 1
        self.first = np.searchsorted(self.start, offsets)
        self._hash: np.ndarray | None = None

    def __len__(self) -> int:
        return len(self.start)

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    @property
    def text(self) -> np.ndarray:
        """For each word, the index of its text."""
        return np.repeat(np.arange(len(self.first) - 1), self.counts)

    @property
    def hash(self) -> np.ndarray:
        if self._hash is None:
            self._hash = mix(self.bytes_between(self.start, self.end))
        return self._hash

    def bytes_between(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Unmixed hashes of the byte sequences [a, b)."""
        if not hasattr(self, "_byte_sums"):
            up, self._byte_down = powers(BYTE_BASE, len(self.data) + 1)
            self._byte_sums = np.zeros(len(self.data) + 1, np.uint64)
            np.cumsum(byte_values()[self.data] * up[:-1], out=self._byte_sums[1:])
        return (self._byte_sums[b] - self._byte_sums[a]) * self._byte_down[a]

    def rolling(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of k consecutive words by first word, and which of them lie within one text."""
        n = len(self) - k + 1
        if n <= 0:
            return np.zeros(0, np.uint64), np.zeros(0, bool)
        text = self.text
        return mix(self.between(np.arange(n), np.arange(k, n + k))), text[: n] == text[k - 1 :]

    def between(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Unmixed hashes of the word sequences [a, b)."""
        if not hasattr(self, "_sums"):
            up, self._down = powers(WORD_BASE, len(self) + 1)
            self._sums = np.zeros(len(self) + 1, np.uint64)
            np.cumsum(self.hash * up[:-1], out=self._sums[1:])
        return (self._sums[b] - self._sums[a]) * self._down[a]


def text_slices(batch: pa.RecordBatch, column: str = "text") -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(from row, to row, bytes, offsets) for pieces of a batch of about SLICE_BYTES; null texts are empty."""
    texts = batch.column(column).cast(pa.large_binary()).fill_null(b"")
    if len(texts) == 0:
        return
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    raw = texts.buffers()[2]
    data = np.frombuffer(raw, np.uint8) if raw is not None else np.zeros(0, np.uint8)
    row = 0
    while row < len(texts):
        to = int(np.searchsorted(offsets, offsets[row] + SLICE_BYTES, side="right")) - 1
        to = min(max(to, row + 1), len(texts))
        yield row, to, data[offsets[row] : offsets[to]], offsets[row : to + 1] - offsets[row]
        row = to
