"""Words of many texts as numpy arrays, for use inside tasks.

Texts arrive as Arrow arrays; their UTF-8 bytes are classified, hashed and
cut into words without a Python object per word. Batches are cut into slices
of half a megabyte, so memory does not depend on the batch size; one text
longer than that is a slice of its own.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

SLICE_BYTES = 1 << 19

_BASE = 0x9E3779B97F4A7C15
_SHIFT = np.uint64(29)
_MASK = (1 << 64) - 1


def mixed(values: np.ndarray) -> np.ndarray:
    """A 64-bit finalizer: every input bit reaches every output bit."""
    values = values ^ (values >> np.uint64(30))
    values = values * np.uint64(0xBF58476D1CE4E5B9)
    values = values ^ (values >> np.uint64(27))
    values = values * np.uint64(0x94D049BB133111EB)
    return values ^ (values >> np.uint64(31))


def _byte_values(lower: bool) -> np.ndarray:
    codes = np.arange(256, dtype=np.uint64)
    if lower:
        codes[65:91] += np.uint64(32)
    return mixed((codes + np.uint64(1)) * np.uint64(_BASE))


FOLDED, EXACT = _byte_values(True), _byte_values(False)

BLANK_BYTES = np.zeros(256, bool)
BLANK_BYTES[[0x20, *range(0x09, 0x0E)]] = True
# After folding, a letter or digit or a byte of a longer code point is part of a word.
NOT_ALNUM = np.ones(256, bool)
NOT_ALNUM[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = False


class _Powers:
    """Powers of an odd number and of its inverse modulo 2^64, grown on demand."""

    def __init__(self) -> None:
        self.up = self.down = np.ones(1, np.uint64)

    def __reduce__(self) -> tuple:
        return (_Powers, ())  # tasks grow their own

    def first(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = max(n, SLICE_BYTES + 1)
            factor = np.full(size, 0x5851F42D4C957F2D, np.uint64)
            inverse = np.full(size, pow(0x5851F42D4C957F2D, -1, 1 << 64), np.uint64)
            factor[0] = inverse[0] = 1
            self.up, self.down = np.cumprod(factor), np.cumprod(inverse)
        return self.up[:n], self.down[:n]


_POWERS = _Powers()


@dataclass
class Words:
    """Words of the texts of a slice: hashes, byte ranges, and the first word of each text."""

    hashes: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray  # one more entry than texts

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    @property
    def owner(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), self.counts)


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts and the offsets of each; a null text is empty."""
    texts = texts.cast(pa.large_string()).fill_null("") if texts.null_count else texts.cast(pa.large_string())
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    if texts.buffers()[2] is None or offsets[-1] == offsets[0]:
        return np.empty(0, np.uint8), np.zeros(len(texts) + 1, np.int64)
    return np.frombuffer(texts.buffers()[2], np.uint8)[offsets[0] : offsets[-1]], offsets - offsets[0]


def slices(texts: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Runs of texts of ``SLICE_BYTES`` together, or one longer text: first, end, bytes, offsets."""
    data, offsets = text_bytes(texts)
    first = 0
    while first < len(texts):
        end = int(np.searchsorted(offsets, offsets[first] + SLICE_BYTES, "right")) - 1
        end = min(max(end, first + 1), len(texts))
        yield first, end, data[offsets[first] : offsets[end]], offsets[first : end + 1] - offsets[first]
        first = end


def words_in(data: np.ndarray, offsets: np.ndarray, separators: np.ndarray, values: np.ndarray) -> Words:
    """Words between ``separators`` with hashes over ``values`` of their bytes."""
    n = len(data)
    if n == 0:
        none = np.empty(0, np.int64)
        return Words(np.empty(0, np.uint64), none, none, np.zeros(len(offsets), np.int64))
    inside = ~separators[data]
    edges = offsets[:-1][np.diff(offsets) > 0]
    before = np.empty(n, bool)
    before[0], before[1:] = False, inside[:-1]
    before[edges] = False
    after = np.empty(n, bool)
    after[-1], after[:-1] = False, inside[1:]
    after[edges[1:] - 1] = False
    starts, ends = np.flatnonzero(inside & ~before), np.flatnonzero(inside & ~after) + 1
    up, down = _POWERS.first(n)
    terms = values[data] * up
    total = np.cumsum(terms)
    hashes = mixed((total[ends - 1] - total[starts] + terms[starts]) * down[starts])
    return Words(hashes, starts, ends, np.searchsorted(starts, offsets))


def runs_of(words: Words, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of ``size`` words inside one text, and the index of each run's first word."""
    n = len(words.hashes) - size + 1
    if n <= 0:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    hashes = np.zeros(n, np.uint64)
    for k in range(size):
        hashes = hashes * np.uint64(_BASE) + words.hashes[k : k + n]
    owner = words.owner
    at = np.flatnonzero(owner[:n] == owner[size - 1 :])
    return mixed(hashes[at] + np.uint64(size)), at
