"""Word and shingle hashes of many texts at once, in numpy.

Texts are UTF-8 bytes. Words are runs of bytes outside ``[\\x20\\x09-\\x0D]``,
which in UTF-8 are the same as runs of characters outside it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

from stationlake.llm.common import WHITESPACE_BYTES

SHINGLE = 5
BLOCK_BYTES = 1 << 20
_BASE = 0x9E3779B97F4A7C15
_BASE_INVERSE = pow(_BASE, -1, 1 << 64)
_SPREAD = np.uint64(0xD6E8FEB86659FD93)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that scatters every bit."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


class Powers:
    """Powers of the hash base and of its inverse modulo 2 ** 64, as long as needed."""

    def __init__(self):
        self.up = self.down = np.ones(1, np.uint64)

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            n = max(n, 2 * len(self.up))
            self.up, self.down = (
                np.multiply.accumulate(np.r_[np.uint64(1), np.full(n, b, np.uint64)])
                for b in (_BASE, _BASE_INVERSE)
            )
        return self.up, self.down


def blocks(sizes: np.ndarray, limit: int = BLOCK_BYTES) -> Iterator[slice]:
    """Slices of neighbouring texts of about ``limit`` bytes, or one longer text."""
    at = total = 0
    for i, size in enumerate(sizes):
        if total and total + size > limit:
            yield slice(at, i)
            at, total = i, 0
        total += int(size)
    if at < len(sizes):
        yield slice(at, len(sizes))


def text_bytes(column: pa.Array) -> list[bytes]:
    """A text column as bytes, empty where there is no text."""
    return [b if b is not None else b"" for b in column.cast(pa.binary()).to_pylist()]


def gaps(characters: bytes) -> np.ndarray:
    """A table of the bytes that separate words."""
    table = np.zeros(256, bool)
    table[list(characters)] = True
    return table


def spans(texts: list[bytes], gap: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """All texts as one array of bytes, A-Z as a-z; where words start and end in
    it; and which words are whose, as bounds."""
    data = np.frombuffer(b"\n".join([*texts, b""]).lower(), np.uint8)
    edges = np.diff(np.r_[True, gap[data], True].view(np.int8))
    starts, ends = np.flatnonzero(edges == -1), np.flatnonzero(edges == 1)
    begins = np.cumsum([0, *(len(t) + 1 for t in texts)])
    return data, starts, ends, np.searchsorted(starts, begins)


def sums(data: np.ndarray, powers: Powers) -> np.ndarray:
    """Running sums from which ``part_hashes`` takes the hash of any part."""
    up, _ = powers.upto(len(data) + 1)
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[: len(data)], out=total[1:])
    return total


def part_hashes(total: np.ndarray, starts, ends, powers: Powers) -> np.ndarray:
    _, down = powers.upto(len(total))
    return mix((total[ends] - total[starts]) * down[starts] + (ends - starts).astype(np.uint64))


def hashed_words(texts: list[bytes], powers: Powers) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words in order, and which words are whose."""
    data, starts, ends, bounds = spans(texts, gaps(WHITESPACE_BYTES))
    return part_hashes(sums(data, powers), starts, ends, powers), bounds


def shingle_sets(texts: list[bytes], powers: Powers) -> list[np.ndarray]:
    """Per text the sorted distinct hashes of its 5-word shingles.

    A text of one to four words is one shingle; one without words has none.
    """
    words, bounds = hashed_words(texts, powers)
    grams = words[: max(0, len(words) - SHINGLE + 1)].copy()
    for j in range(1, SHINGLE):
        grams *= _SPREAD
        grams += words[j : len(grams) + j]
    grams = mix(grams)
    found = []
    for a, b in zip(bounds[:-1], bounds[1:], strict=True):
        if b - a >= SHINGLE:
            found.append(np.unique(grams[a : b - SHINGLE + 1]))
        elif b > a:
            whole = np.array([b - a], np.uint64)
            for w in words[a:b]:
                whole = whole * _SPREAD + w
            found.append(mix(whole))
        else:
            found.append(np.empty(0, np.uint64))
    return found
