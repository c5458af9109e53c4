"""The BPE automaton against merges applied one by one, and against the library."""

import hashlib
import random

import public_tokenizers
import pytest
from llm_text import make, odd_rows, plan, prose  # noqa: F401
from tokenizers import Tokenizer

from stationlake.llm import bpe_automaton as bpe

FILE = public_tokenizers.path("byte_bpe_50k.json")
ODD = [
    "", " ", "  \n ", "a<|endoftext|> b<|endoftext|>", "<|endoftext|>", "=" * 500 + " " * 70 + "x",
    "\x1c\x85 x　 yy\x00", "a \U00031350 b՘  c", "don't we'll  I'VE", "é 日本語 😀﻿", "ab" * 400,
]


@pytest.fixture(scope="module")
def tables():
    return bpe.read_vocabulary(FILE)


def by_merging(word, merges):
    """Ids of a word: every merge in turn, from left to right."""
    ids = list(word)
    for u, v, made in merges:
        i = 0
        while i + 1 < len(ids):
            if (ids[i], ids[i + 1]) == (u, v):
                ids[i : i + 2] = [made]
            i += 1
    return ids


@pytest.mark.parametrize("seed", range(30))
def test_gadgets_accept_what_merging_makes(seed):
    rng = random.Random(seed)
    labels = [bytes([b]) for b in range(3)]
    merges = []
    while len(merges) < 12:
        u, v = rng.randrange(len(labels)), rng.randrange(len(labels))
        if labels[u] + labels[v] not in labels:
            merges.append((u, v, len(labels)))
            labels.append(labels[u] + labels[v])
    automaton = bpe.Automaton(bpe.build(labels, [0, 1, 2], merges))
    for _ in range(200):
        word = bytes(rng.randrange(3) for _ in range(rng.randint(1, 14)))
        assert automaton.path(word) == by_merging(word, merges)


def test_merges_out_of_order_are_refused():
    labels = [b"a", b"b", b"ab", b"aab"]
    with pytest.raises(ValueError, match="not made yet"):
        bpe.build(labels, [0, 1], [(0, 2, 3), (0, 1, 2)])


def test_ids_equal_the_librarys(tables):
    library, automaton = Tokenizer.from_file(FILE), bpe.Automaton(tables, held=500)
    texts = ODD + [prose(s, 300) for s in range(20)]
    rng = random.Random(5)
    texts += ["".join(chr(rng.choice([32, 39, 10, rng.randrange(33, 0x2FFF)])) for _ in range(200)) for _ in range(50)]
    for text in texts:
        ids = automaton.encode(text).tolist()
        assert ids == library.encode(text, add_special_tokens=False).ids, text
        assert automaton.decode(ids).decode() == text
    library.encode_special_tokens = True
    plain = bpe.Automaton(tables, specials=False)
    assert plain.encode(ODD[3]).tolist() == library.encode(ODD[3], add_special_tokens=False).ids


def test_latin_texts_are_split_as_others_are(tables):
    library, automaton = Tokenizer.from_file(FILE), bpe.Automaton(tables)
    for code in range(0x2C0):
        text = f"a{chr(code)}1{chr(code)}! {chr(code)}{chr(code)} b'{chr(code)}"
        ids = library.encode(text, add_special_tokens=False).ids
        assert automaton.encode(text).tolist() == ids, hex(code)


def test_a_token_of_any_length_ends(tables):
    word = "".join(random.Random(1).choices("abcdefABCDEF0123+/", k=200_000))
    ids = bpe.Automaton(tables).encode(word).tolist()
    assert bpe.Automaton(tables).decode(ids).decode() == word


def test_query_columns(make, odd_rows, tables):
    rows = odd_rows + [(100 + i, t) for i, t in enumerate(ODD)]
    library = Tokenizer.from_file(FILE)
    want = []
    for doc_id, text in rows:
        ids = library.encode(text or "", add_special_tokens=False).ids
        joined = ",".join(map(str, ids))
        back = library.decode(ids, skip_special_tokens=False)
        want.append((doc_id, len(ids), *(hashlib.sha256(t.encode()).hexdigest() for t in (joined, back))))
    for clashes in (False, True):
        docs = make(rows, clashes)
        got = [tuple(r) for r in bpe.round_trip(docs, FILE).collect()]
        assert sorted(got, key=repr) == sorted(want, key=repr)
    assert bpe.round_trip(make(rows).limit(0), FILE).count() == 0
    assert "Exchange" not in plan(bpe.round_trip(make(rows).coalesce(1), FILE)).replace("Exchange Round", "")


def test_encode_then_decode_tables(make, odd_rows):
    docs = make(odd_rows)
    back = bpe.decoded(bpe.encoded(docs, FILE), FILE)
    want = [(i, t or "") for i, t in odd_rows]
    assert sorted(map(tuple, back.collect()), key=repr) == sorted(want, key=repr)
