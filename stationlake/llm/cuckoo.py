"""A cuckoo filter over 16-byte keys: a set summary that can also forget.

A key leaves a 32-bit fingerprint in one of two buckets of four; the second
bucket follows from the first and the fingerprint, so entries can be moved, and
deleted, without their keys. Only keys that were inserted may be deleted.
"""

from __future__ import annotations

import numpy as np

SLOTS = 4
_KICKS = 500


def _split(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """16-byte keys to 64-bit places and non-zero 32-bit fingerprints."""
    halves = keys.view(np.uint64).reshape(-1, 2)
    prints = (halves[:, 1] >> np.uint64(32)).astype(np.uint32)
    prints[prints == 0] = 1
    return halves[:, 0], prints


def _other(places: np.ndarray, prints: np.ndarray, mask: int) -> np.ndarray:
    spread = prints.astype(np.uint64) * np.uint64(0x5BD1E9955BD1E995)
    return (places ^ (spread >> np.uint64(20))) & np.uint64(mask)


def as_keys(values: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(values), np.dtype((np.void, 16)))


class CuckooFilter:
    def __init__(self, table: np.ndarray):
        self.table = table  # buckets x SLOTS; 0 is free

    @classmethod
    def sized(cls, keys: int) -> CuckooFilter:
        """Room for so many keys at a load of three quarters."""
        buckets = 1
        while buckets * SLOTS * 3 < keys * 4:
            buckets *= 2
        return cls(np.zeros((buckets, SLOTS), np.uint32))

    @classmethod
    def read(cls, blob: bytes) -> CuckooFilter:
        return cls(np.frombuffer(blob, np.uint32).reshape(-1, SLOTS).copy())

    def blob(self) -> bytes:
        return self.table.tobytes()

    def _buckets(self, keys: np.ndarray):
        places, prints = _split(keys)
        mask = len(self.table) - 1
        first = places & np.uint64(mask)
        return first.astype(np.int64), _other(first, prints, mask).astype(np.int64), prints

    def contains(self, keys: np.ndarray) -> np.ndarray:
        """Per key whether it may be in the set; never false for one that is."""
        if not len(keys):
            return np.zeros(0, bool)
        first, second, prints = self._buckets(keys)
        wanted = prints[:, None]
        return (self.table[first] == wanted).any(1) | (self.table[second] == wanted).any(1)

    def insert(self, keys: np.ndarray) -> bool:
        """False if the table is too full; then build a larger one."""
        table, mask = self.table, len(self.table) - 1
        turn = 0
        for a, b, fp in zip(*self._buckets(keys), strict=True) if len(keys) else ():
            at = a if (table[a] == 0).any() else b
            for _ in range(_KICKS):
                free = np.flatnonzero(table[at] == 0)
                if len(free):
                    table[at, free[0]] = fp
                    break
                turn = (turn + 1) % SLOTS
                fp, table[at, turn] = table[at, turn], fp
                at = int(_other(np.array([at], np.uint64), np.array([fp], np.uint32), mask)[0])
            else:
                return False
        return True

    def delete(self, keys: np.ndarray) -> None:
        for a, b, fp in zip(*self._buckets(keys), strict=True) if len(keys) else ():
            for at in (a, b):
                held = np.flatnonzero(self.table[at] == fp)
                if len(held):
                    self.table[at, held[0]] = 0
                    break
