"""Sorted runs of byte strings: front coding, and merging by a loser tree that
knows common prefixes.

A run keeps of every string only what follows the prefix it shares with the one
before it. The tree compares two strings only from the position up to which both
are known to agree with the last string that left the tree.
"""

from __future__ import annotations

import struct
from collections.abc import Iterable, Iterator

import numpy as np

_HEAD = "<HIH"


def common(a: bytes, b: bytes, at: int = 0) -> int:
    """Length of the common prefix, known to be ``at`` at least."""
    n = min(len(a), len(b))
    step = 16
    while at < n:
        end = min(n, at + step)
        if a[at:end] != b[at:end]:
            x = np.frombuffer(a, np.uint8, end - at, at)
            y = np.frombuffer(b, np.uint8, end - at, at)
            return at + int((x != y).argmax())
        at, step = end, step * 4
    return n


def front_coded(items: Iterable[tuple[bytes, bytes]]) -> bytes:
    """Sorted (string, payload) pairs as one run."""
    out, last = [], b""
    for key, payload in items:
        shared = common(last, key)
        out += [struct.pack(_HEAD, shared, len(key) - shared, len(payload)), key[shared:], payload]
        last = key
    return b"".join(out)


def decoded(run: bytes) -> Iterator[tuple[bytes, int, bytes]]:
    """(string, length of the prefix shared with the one before, payload)."""
    at, key = 0, b""
    while at < len(run):
        shared, rest, extra = struct.unpack_from(_HEAD, run, at)
        at += struct.calcsize(_HEAD)
        key = key[:shared] + run[at : at + rest]
        at += rest
        yield key, shared, run[at : at + extra]
        at += extra


def merged(runs: list[bytes]) -> Iterator[tuple[bytes, int, bytes]]:
    """All strings of the runs in order, each with the prefix it shares with the
    string before it."""
    sources = [decoded(r) for r in runs]
    width = 1
    while width < len(sources):
        width *= 2
    done = (None, -1, b"")
    heads = [next(s, done) for s in sources] + [done] * (width - len(sources))
    # A node holds (run, shared): the loser of its match and the prefix that it
    # shares with the winner.
    losers: list[tuple[int, int]] = [(0, 0)] * width

    def match(a: tuple[int, int], b: tuple[int, int]) -> tuple[tuple[int, int], tuple[int, int]]:
        """Winner and loser of two strings that share so much with the last one out."""
        if a[1] != b[1]:
            return (a, b) if a[1] > b[1] else (b, a)
        x, y = heads[a[0]][0], heads[b[0]][0]
        if x is None or y is None:
            return (b, a) if x is None else (a, b)
        shared = common(x, y, a[1])
        if x[shared:] <= y[shared:]:
            return a, (b[0], shared)
        return b, (a[0], shared)

    def build(node: int) -> tuple[int, int]:
        if node >= width:
            run = node - width
            return run, (0 if heads[run][0] is not None else -1)
        winner, losers[node] = match(build(2 * node), build(2 * node + 1))
        return winner

    winner = build(1)
    while heads[winner[0]][0] is not None:
        run, shared = winner
        key, _, payload = heads[run]
        yield key, shared, payload
        heads[run] = next(sources[run], done)
        contender = (run, heads[run][1])
        node = (run + width) // 2
        while node:
            contender, losers[node] = match(contender, losers[node])
            node //= 2
        winner = contender
