"""Words of many texts at once, as arrays: where they are, and hashes of them and of runs of them."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)  # odd; powers of it weigh the bytes of a word
_AT_ONCE = 1 << 18  # bytes that are worked on together; a longer text, or word, is worked on alone
BLANK = np.zeros(256, dtype=bool)
BLANK[[0x20, *range(0x09, 0x0E)]] = True


def mixed(keys: np.ndarray) -> np.ndarray:
    keys = (keys ^ (keys >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return keys ^ (keys >> np.uint64(29))


@dataclass(frozen=True)
class Words:
    """Words of some texts: bytes of the texts, where each text ends, first and last byte of each word, and the first word of each text."""

    rows: slice
    data: np.ndarray
    texts: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    firsts: np.ndarray  # one more than there are texts

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.firsts)

    def hashes(self) -> np.ndarray:
        """A 64-bit hash of every word, from a polynomial of its bytes."""
        sizes = self.ends - self.starts
        found = np.empty(len(sizes), dtype=np.uint64)
        longest = int(sizes.max(initial=0))
        powers = np.cumprod(np.full(longest, _MULTIPLIER), dtype=np.uint64)
        total = np.cumsum(sizes)
        cuts = np.searchsorted(total, np.arange(0, int(total[-1]) if len(total) else 0, _AT_ONCE), side="right")
        for a, b in zip(cuts, [*cuts[1:], len(sizes)]):
            if a == b:
                continue
            size = sizes[a:b]
            first = np.cumsum(size) - size
            place = np.arange(int(size.sum())) - np.repeat(first, size)
            values = self.data[np.repeat(self.starts[a:b], size) + place].astype(np.uint64) + np.uint64(1)
            found[a:b] = np.add.reduceat(values * powers[place], first)
        return mixed(found)

    def joined(self) -> list[bytes]:
        """Each text's words with one blank between two of them."""
        inside = np.zeros(len(self.data) + 1, dtype=np.int8)
        inside[self.starts] += 1
        inside[self.ends] -= 1
        keep = np.cumsum(inside[:-1], dtype=np.int8).astype(bool)
        last = np.zeros(len(self.starts), dtype=bool)
        last[self.firsts[1:][self.counts > 0] - 1] = True
        behind = self.ends[~last]  # the byte behind a word that is not its text's last is a blank
        keep[behind] = True
        data = self.data.copy()
        data[behind] = 0x20
        ends = np.concatenate([[0], np.cumsum(keep)])[self.texts]
        flat = data[keep].tobytes()
        return [flat[a:b] for a, b in zip([0, *ends], ends)]


def words_in(column: pa.Array) -> Iterator[Words]:
    """The words of a column of texts without nulls, some texts at a time."""
    column = column.cast(pa.large_binary())
    _, offsets, values = column.buffers()
    offsets = np.frombuffer(offsets, dtype=np.int64)[column.offset : column.offset + len(column) + 1] if len(column) else np.zeros(1, np.int64)
    data = np.frombuffer(values, dtype=np.uint8) if values is not None else np.zeros(0, np.uint8)
    a = 0
    while a < len(column):
        b = max(a + 1, int(np.searchsorted(offsets, offsets[a] + _AT_ONCE, side="right")) - 1)
        texts = offsets[a : b + 1] - offsets[a]
        part = data[offsets[a] : offsets[b]]
        word = ~BLANK[part]
        left, right = word.copy(), word.copy()
        left[1:] &= ~word[:-1]
        right[:-1] &= ~word[1:]
        edge = texts[:-1][texts[:-1] < texts[1:]]  # texts touch each other
        left[edge] = word[edge]
        edge = texts[1:][texts[:-1] < texts[1:]] - 1
        right[edge] = word[edge]
        starts = np.flatnonzero(left)
        yield Words(slice(a, b), part, texts[1:], starts, np.flatnonzero(right) + 1, np.searchsorted(starts, texts))
        a = b


def rolled(hashes: np.ndarray, size: int, places: np.ndarray | None = None) -> np.ndarray:
    """A hash of every run of `size` words, or of those that start at the given places."""
    n = max(0, len(hashes) - size + 1)
    found = np.zeros(n if places is None else len(places), dtype=np.uint64)
    for k in range(size):
        found = (found ^ (hashes[k : k + n] if places is None else hashes[places + k])) * _MULTIPLIER
        found ^= found >> np.uint64(29)
    return found
