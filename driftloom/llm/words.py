"""Words and their hashes for whole Arrow batches of texts.

A word is a run of characters other than space and U+0009 to U+000D. All of
these are single bytes in UTF-8, so words are found in the bytes of a batch
without decoding it. Hashes are 64 bits wide: polynomial prefix sums over
random byte values give the hash of any byte range, and a final mixing step
spreads it. Two different words of a text share a hash with odds of about
2 ** -64.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 1 << 20
_BASE = 0x9E3779B97F4A7C15  # odd, so it has an inverse modulo 2 ** 64
_INVERSE = pow(_BASE, -1, 1 << 64)
_RANDOM = np.random.default_rng(20240607)
_BYTE_VALUES = _RANDOM.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_POWERS: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit changes about half of the output bits."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xFF51AFD7ED558CCD)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xC4CEB9FE1A85EC53)
    x ^= x >> np.uint64(33)
    return x


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_POWERS[0]) < n:
        size = max(n, SLICE_BYTES + 1)
        for k, base in enumerate((_BASE, _INVERSE)):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            _POWERS[k] = np.cumprod(steps)
    return _POWERS[0], _POWERS[1]


class Texts:
    """Some texts of a batch: their bytes, and where each text and each word begins and ends."""

    def __init__(self, data: np.ndarray, bounds: np.ndarray, lower: bool = False):
        self.raw, self.bounds = data, bounds
        self.data = _LOWER[data] if lower else data
        space = _SPACE[data]
        word = ~space
        first = np.zeros(len(data) + 1, bool)
        first[bounds] = True  # of a text; also cuts words at the end of the text before
        before = np.empty(len(data), bool)
        before[:1] = False
        before[1:] = word[:-1]
        after = np.empty(len(data), bool)
        after[-1:] = False
        after[:-1] = word[1:]
        self.start = np.flatnonzero(word & (~before | first[:-1]))
        self.end = np.flatnonzero(word & (~after | first[1:])) + 1
        #: words[i]:words[i + 1] are the words of text i
        self.words = np.searchsorted(self.start, bounds)
        self._sums: np.ndarray | None = None

    def __len__(self) -> int:
        return len(self.bounds) - 1

    def hashes(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """One hash per byte range."""
        powers, inverse = _powers(len(self.data) + 1)
        if self._sums is None:
            self._sums = np.zeros(len(self.data) + 1, np.uint64)
            np.cumsum(_BYTE_VALUES[self.data] * powers[: len(self.data)], out=self._sums[1:])
        return mix((self._sums[end] - self._sums[start]) * inverse[start] + (end - start).astype(np.uint64))

    def word_hashes(self) -> np.ndarray:
        return self.hashes(self.start, self.end)

    def texts_of(self, positions: np.ndarray) -> np.ndarray:
        """The text that holds each byte position."""
        return np.searchsorted(self.bounds, positions, side="right") - 1

    def code_points(self, mask: np.ndarray) -> np.ndarray:
        """Per text, how many code points begin at bytes under the mask."""
        return self.totals(mask & ((self.raw & 0xC0) != 0x80))

    def totals(self, mask: np.ndarray) -> np.ndarray:
        """Per text, how many bytes are under the mask."""
        sums = np.zeros(len(mask) + 1, np.int64)
        np.cumsum(mask, out=sums[1:])
        return sums[self.bounds[1:]] - sums[self.bounds[:-1]]


def windows(hashes: np.ndarray, width: int) -> np.ndarray:
    """Hash of every window of ``width`` neighbours; windows[i] begins at i."""
    n = len(hashes) - width + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.zeros(n, np.uint64)
    for k in range(width):
        out = out * np.uint64(_BASE) + hashes[k : k + n]
    return mix(out)


def sliced(column: pa.Array, lower: bool = False) -> Iterator[tuple[int, Texts]]:
    """The texts of a column (null: empty) in slices of about a megabyte; a longer text is a slice of its own.

    Yields the index of the slice's first text and the slice.
    """
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_string()), "")
    if not len(column):
        return
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    buffer = column.buffers()[2]
    data = np.frombuffer(buffer, np.uint8) if buffer is not None else np.zeros(0, np.uint8)
    at = 0
    while at < len(column):
        until = max(at + 1, int(np.searchsorted(offsets, offsets[at] + SLICE_BYTES, side="right")) - 1)
        yield at, Texts(data[offsets[at] : offsets[until]], offsets[at : until + 1] - offsets[at], lower)
        at = until
