"""Words of many texts at once: numpy over the UTF-8 bytes of an Arrow column.

Hashes are 64-bit polynomials, the same in every process. They choose, group
and sample; where a result must be exact its user compares the words as well
or uses two independent hashes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Bytes of text handled at once; a longer text is a block of its own.
BLOCK_BYTES = 1 << 20

SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
#: Separators of normalised words: all of ASCII but letters and digits.
PUNCTUATION = np.array([b < 128 and not chr(b).isalnum() for b in range(256)])

_BASE = np.uint64(0x9E3779B97F4A7C17)
_BYTE = np.random.default_rng(20).integers(0, 2**64, 256, np.uint64)


class _PerProcess(list):
    """A list that stays empty when functions are sent to tasks."""

    def __reduce__(self):
        return _PerProcess, ()


_powers: list[np.ndarray] = _PerProcess()


def _inverse(a: int) -> int:
    return pow(a, -1, 1 << 64)


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first ``n`` powers of the base and of its inverse mod 2**64."""
    if not _powers or len(_powers[0]) < n:
        size = max(n, BLOCK_BYTES + 1)
        out = []
        for base in (_BASE, np.uint64(_inverse(int(_BASE)))):
            a = np.full(size, base, np.uint64)
            a[0] = 1
            out.append(np.cumprod(a))
        _powers[:] = out
    return _powers[0][:n], _powers[1][:n]


def mix(h: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit hashes."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def column(array) -> pa.Array:
    """A text column without nulls; null counts as empty."""
    if isinstance(array, pa.ChunkedArray):
        array = array.combine_chunks()
    array = array.cast(pa.large_string())
    return array.fill_null("") if array.null_count else array


def blocks(texts: pa.Array, limit: int | None = None) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets) of runs of whole texts of about ``limit`` bytes."""
    limit = limit or BLOCK_BYTES
    n = len(texts)
    if not n:
        return
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + n + 1]
    raw = texts.buffers()[2]
    data = np.frombuffer(raw, np.uint8) if raw is not None else np.zeros(0, np.uint8)
    lo = 0
    while lo < n:
        hi = int(np.searchsorted(offsets, offsets[lo] + limit, "right")) - 1
        hi = min(n, max(hi, lo + 1))
        yield lo, hi, data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo]
        lo = hi
    give_back()


def give_back() -> None:
    """Return freed memory to the system: workers live on for the next job and count against their executor."""
    pa.default_memory_pool().release_unused()


class Words:
    """Words of a block: byte ranges, bounds per text, hashes."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, separators: np.ndarray = SPACE):
        self.data, self.offsets = data, offsets
        n = len(data)
        if n:
            sep = separators[data]
            edge = np.empty(n + 1, bool)
            edge[0] = edge[n] = True
            edge[1:n] = sep[:-1]
            edge[offsets] = True
            self.starts = np.flatnonzero(edge[:n] & ~sep)
            edge[1:n] = sep[1:]
            edge[offsets] = True
            self.stops = np.flatnonzero(edge[1:] & ~sep) + 1
        else:
            self.starts = self.stops = np.zeros(0, np.int64)
        self.bounds = np.searchsorted(self.starts, offsets)
        self.counts = np.diff(self.bounds)

    @property
    def sums(self) -> np.ndarray:
        """Prefix sums of the byte polynomial."""
        if not hasattr(self, "_sums"):
            n = len(self.data)
            self._sums = np.zeros(n + 1, np.uint64)
            np.cumsum(_BYTE[self.data] * powers(n)[0], out=self._sums[1:])
        return self._sums

    def hashes(self) -> np.ndarray:
        """A hash for each word."""
        c = self.sums
        return mix((c[self.stops] - c[self.starts]) * powers(len(self.data) + 1)[1][self.starts])

    def grams(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of the n-byte runs inside each text and the bounds of the texts among them."""
        size = len(self.data)
        lengths = np.maximum(np.diff(self.offsets) - n + 1, 0)
        bounds = np.concatenate([[0], np.cumsum(lengths)])
        if not bounds[-1]:
            return np.zeros(0, np.uint64), bounds
        c, inv = self.sums, powers(size + 1)[1]
        h = (c[n:] - c[:-n]) * inv[: size + 1 - n]
        keep = np.ones(size + 1 - n, bool)
        for k in range(1, n):
            at = self.offsets[1:-1] - k
            keep[at[(at >= 0) & (at < len(keep))]] = False
        return mix(h[keep]), bounds

    def owner(self) -> np.ndarray:
        """The text of each word."""
        return np.repeat(np.arange(len(self.counts)), self.counts)

    def left(self) -> np.ndarray:
        """Words from each word to the end of its text, itself included."""
        return np.repeat(self.bounds[1:], self.counts) - np.arange(len(self.starts))


def window_hashes(h: np.ndarray, k: int, left: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hash, valid) of the k words from each word on; not valid where the text ends first."""
    n = len(h)
    valid = left >= k
    out = np.zeros(n, np.uint64)
    if n >= k:
        p, inv = powers(n + 1)
        q = np.zeros(n + 1, np.uint64)
        np.cumsum(h * p[:n], out=q[1:])
        out[: n - k + 1] = mix((q[k:] - q[:-k]) * inv[: n - k + 1])
    return out, valid


def sums_by(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Sum of the values of each range of ``bounds``."""
    c = np.concatenate([[0], np.cumsum(values, dtype=np.float64)])
    return c[bounds[1:]] - c[bounds[:-1]]
