"""Words of a batch of texts as arrays: where they are and a 64-bit fingerprint of each.

Texts are handled as UTF-8 bytes. The byte classes below hold for every use in this subpackage, because all
separators are ASCII, and a byte of a longer character is never below 0x80.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

_BYTES = np.arange(256)
#: Words are runs of anything but ASCII white space.
SPACED = ~((_BYTES == 0x20) | ((_BYTES >= 0x09) & (_BYTES <= 0x0D)))
#: Words are runs of ASCII letters and digits and of all characters beyond ASCII.
ALPHANUMERIC = (_BYTES >= 0x80) | np.array([chr(b).isalnum() and b < 0x80 for b in range(256)])
#: Lower-cases A-Z alone.
LOWER = np.where((_BYTES >= 0x41) & (_BYTES <= 0x5A), _BYTES + 32, _BYTES).astype(np.uint8)

_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)
_BYTE_CODE = np.random.default_rng(20240229).integers(1, 2**63, 256, dtype=np.uint64)
#: Bytes of text that are turned into arrays at a time; bounds the memory of a task.
PIECE_BYTES = 3 << 20


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit over all others."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xFF51AFD7ED558CCD)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xC4CEB9FE1A85EC53)
    x ^= x >> np.uint64(33)
    return x


def give_back() -> None:
    """Return the memory that Arrow keeps for later. A worker lives on between stages, beside those of other stages."""
    pa.default_memory_pool().release_unused()


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string column, and the offsets of its rows in them. Null reads as empty."""
    column = column.cast(pa.large_binary())
    if column.null_count:
        column = column.fill_null(b"")
    if len(column) == 0:
        return np.empty(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    bounds = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    whole = np.frombuffer(data, np.uint8) if data is not None and data.size else np.empty(0, np.uint8)
    return whole[bounds[0] : bounds[-1]], bounds - bounds[0]


def pieces(offsets: np.ndarray, limit: int = PIECE_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of rows with about ``limit`` bytes each; a longer row is a range of its own."""
    first = 0
    while first < len(offsets) - 1:
        last = int(np.searchsorted(offsets, offsets[first] + limit, "right")) - 1
        last = min(max(last, first + 1), len(offsets) - 1)
        yield first, last
        first = last


class Words:
    """The words of consecutive texts.

    ``starts`` and ``ends`` are byte positions in ``data``; the words of text ``i`` are those from
    ``bounds[i]`` to ``bounds[i + 1]``.
    """

    def __init__(self, data: np.ndarray, offsets: np.ndarray, inside: np.ndarray = SPACED, fold: bool = False):
        self.data = LOWER[data] if fold else data
        word = inside[self.data]
        edge = word.copy()
        edge[1:] &= ~word[:-1]
        cuts = offsets[(offsets > 0) & (offsets < len(data))]
        edge[cuts] = word[cuts]
        self.starts = np.flatnonzero(edge)
        edge = word.copy()
        edge[:-1] &= ~word[1:]
        edge[cuts - 1] = word[cuts - 1]
        self.ends = np.flatnonzero(edge) + 1
        self.bounds = np.searchsorted(self.starts, offsets)

    def __len__(self) -> int:
        return len(self.starts)

    def fingerprints(self) -> np.ndarray:
        """A 64-bit number for each word; equal words have equal numbers."""
        if not len(self):
            return np.empty(0, np.uint64)
        lengths = self.ends - self.starts
        power = np.full(int(lengths.max()), _MULTIPLIER)
        power[0] = 1
        power = np.cumprod(power, dtype=np.uint64)
        total, out = np.concatenate([np.zeros(1, np.int64), np.cumsum(lengths)]), np.empty(len(self), np.uint64)
        for first, end in pieces(total):  # a very long text takes no more room than several short ones
            own = lengths[first:end]
            before = np.cumsum(own) - own
            at = np.arange(int(own.sum()), dtype=np.int64) - np.repeat(before, own)
            value = power[at]
            value *= _BYTE_CODE[self.data[np.repeat(self.starts[first:end], own) + at]]
            out[first:end] = np.add.reduceat(value, before) + own.astype(np.uint64)
        return mix(out)

    def text_of(self) -> np.ndarray:
        """For each word the number of its text."""
        return np.repeat(np.arange(len(self.bounds) - 1), np.diff(self.bounds))


def chain(fingerprints: np.ndarray, length: int) -> np.ndarray:
    """Fingerprints of all runs of ``length`` consecutive words; there are ``length - 1`` fewer than words."""
    n = len(fingerprints) - length + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    out = fingerprints[:n].copy()
    for k in range(1, length):
        out *= _MULTIPLIER
        out += fingerprints[k : k + n]
    return mix(out)


def run_starts(bounds: np.ndarray, length: int, n_words: int) -> np.ndarray:
    """Marks the words at which a run of ``length`` words starts that stays in its text."""
    inside = np.ones(max(n_words - length + 1, 0), bool)
    for k in range(1, length):
        last = bounds[1:] - k
        last = last[(last >= 0) & (last < len(inside))]
        inside[last] = False
    return inside
