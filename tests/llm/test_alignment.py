"""Token alignment against sets of ends and plain counting."""

import hashlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from llm_text import make, odd_rows, prose  # noqa: F401
from tokenizers import Tokenizer

from stationlake.llm import bpe_automaton, token_alignment
from stationlake.llm.token_alignment import alignment, shared_cuts

A_FILE, B_FILE = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def tokenizers():
    a = Tokenizer.from_file(A_FILE)
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=B_FILE)


def aligned(tokenizers, text):
    """n_a, n_b, groups as text, links; None without tokens."""
    a, b = tokenizers
    letters = bpe_automaton.byte_letters()
    a_ids, b_ids = a.encode(f" {text}", add_special_tokens=False).ids, b.encode(text or "")
    a_bytes = [bytes(letters[c] for c in a.id_to_token(i)) for i in a_ids]
    b_bytes = [
        bytes([int(b.id_to_piece(i)[3:-1], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode()
        for i in b_ids
    ]
    whole = f" {text}".encode()
    if not text or b"".join(a_bytes) != whole or b"".join(b_bytes) != whole:
        return None
    a_ends, b_ends = np.cumsum([len(x) for x in a_bytes]), np.cumsum([len(x) for x in b_bytes])
    groups, links, i, j = [], Counter(), 0, 0
    for cut in sorted(set(a_ends.tolist()) & set(b_ends.tolist())):
        x, y = int(np.searchsorted(a_ends, cut)) + 1, int(np.searchsorted(b_ends, cut)) + 1
        groups.append(",".join(map(str, a_ids[i:x])) + "|" + ",".join(map(str, b_ids[j:y])))
        links[a_ids[x - 1], b_ids[y - 1]] += 1
        i, j = x, y
    return len(a_ids), len(b_ids), ";".join(groups), links


def brute_force(tokenizers, rows):
    found = [aligned(tokenizers, t) for _, t in rows]
    total = Counter()
    for f in found:
        if f:
            total.update(f[3])
    best = {}
    for (_, b), n in total.items():
        best[b] = max(best.get(b, 0), n)
    out = []
    for (doc_id, _), f in zip(rows, found, strict=True):
        if not f:
            out.append((doc_id, 0, 0, 0, 0, 0, 0, ""))
            continue
        links = f[3]
        out.append(
            (
                doc_id,
                f[0],
                f[1],
                f[2].count(";") + 1,
                sum(links.values()),
                sum(n for p, n in links.items() if total[p] == best[p[1]]),
                sum(n * total[p] for p, n in links.items()),
                hashlib.sha256(f[2].encode()).hexdigest(),
            )
        )
    return sorted(out, key=repr)


ODD = [
    " two  spaces ", "\n\n x \t", " ", "▁", "a▁b", "<s> <unk> <0x41> <|endoftext|>", "é 日本語 😀", "x\x00y",
    "=" * 3000, "ﬁ ①", "0123456789" * 200,
]


def columns(df):
    return sorted(
        map(tuple, df.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256").collect()),
        key=repr,
    )


@pytest.mark.parametrize("hot_share", [token_alignment.HOT_SHARE, 5])
def test_equals_brute_force(make, odd_rows, tokenizers, monkeypatch, hot_share):
    monkeypatch.setattr(token_alignment, "HOT_SHARE", hot_share)
    monkeypatch.setattr(token_alignment, "CHUNK_TOKENS", 500)
    rows = odd_rows + [(200 + i, t) for i, t in enumerate(ODD)] + [(300 + s, prose(s, 40)) for s in range(20)]
    got = columns(alignment(make(rows, clashes=True), A_FILE, B_FILE))
    assert got == brute_force(tokenizers, rows)
    assert sum(r[1] for r in got) > 1000 and any(r[1] == 0 for r in got)


def test_empty_table(make, odd_rows):
    assert alignment(make(odd_rows).limit(0), A_FILE, B_FILE).count() == 0
    only_null = alignment(make([(1, None), (2, "")]), A_FILE, B_FILE)
    assert columns(only_null) == [(1, 0, 0, 0, 0, 0, 0, ""), (2, 0, 0, 0, 0, 0, 0, "")]


@pytest.mark.parametrize("seed", range(20))
def test_cuts_equal_sets(seed):
    rng = np.random.default_rng(seed)
    a, b, a_bounds, b_bounds, at = [], [], [0], [0], 0
    for _ in range(int(rng.integers(1, 6))):
        size = int(rng.integers(1, 400))
        # Ends from few places or from odd and even ones: dense cuts, and none.
        where = np.arange(1, size)
        keep = (where % 2 == 0, where % 2 == 1) if rng.random() < 0.3 else rng.random((2, size - 1)) < rng.random()
        for ends, bounds, chosen in ((a, a_bounds, keep[0]), (b, b_bounds, keep[1])):
            ends += (at + where[chosen]).tolist() + [at + size]
            bounds.append(len(ends))
        at += size
    a, b = np.array(a), np.array(b)
    x, y = shared_cuts(a, b, np.array(a_bounds), np.array(b_bounds))
    assert a[x].tolist() == b[y].tolist() == sorted(set(a.tolist()) & set(b.tolist()))


def test_a_long_stretch_without_cuts_is_one_leaf():
    n = 300_000
    a = np.r_[np.arange(1, n, 2), n]
    b = np.r_[np.arange(2, n, 2), n]
    x, y = shared_cuts(a, b, np.array([0, len(a)]), np.array([0, len(b)]))
    assert a[x].tolist() == [n] and b[y].tolist() == [n]


def test_driver_builds_no_tables(make, monkeypatch):
    """The vocabulary's tables, hundreds of MB of Python objects, are built by
    the executors; the driver only reads and broadcasts the file's text."""

    built, build = [], bpe_automaton.build

    def counted(*args, **kwargs):
        built.append(1)  # in the process that builds
        return build(*args, **kwargs)

    monkeypatch.setattr(bpe_automaton, "build", counted)
    got = columns(alignment(make([(1, "a plain text"), (2, None)]), A_FILE, B_FILE))
    assert [r[0] for r in got] == [1, 2] and got[0][1] > 0
    assert built == []
