"""Random tokens in small classes, and in texts without letters before them."""

import hashlib
import random

from llm_text import by_id, make  # noqa: F401

from stationlake.llm import secrets_scan

BASE64URL = secrets_scan.ALPHABETS["base64url"]


def key(seed, n):
    rng = random.Random(seed)
    return "".join(rng.choice(BASE64URL) for _ in range(n))


def random_spans(got):
    return {i: [s for s in r.spans.split(",") if s.startswith("random")] for i, r in got.items()}


def test_one_random_token_is_found_in_any_corpus(make):
    words = "some ordinary words of a text that go before it and more of the same kind of them "
    alone = [(1, words * 4 + key(1, 60) + " after"), (2, key(2, 100) + " begins a text")]
    plain = [(10 + i, words * 3 + "donaudampfschifffahrtsgesellschaft " * 2) for i in range(60)]
    for rows in (alone[:1], alone[1:], alone, alone + plain):
        found = random_spans(by_id(secrets_scan.secret_scan(make(rows))))
        assert {i for i, spans in found.items() if spans} == {i for i, _ in rows if i < 10}
        for i, text in rows[: len(alone)]:
            if i == 1:
                first = text.index(key(1, 60))
                assert found[1] == [f"random:{first}:{first + 60}"]


def test_tokens_without_decoys_do_not_loosen_the_bound(make):
    tables = [(i, "\n".join(f"{'0' * 18}{i:03}{j:03} {'=-' * 15} {'7' * 24}" for j in range(4))) for i in range(120)]
    words = "the usual words of a text, of which there are enough before what follows here: "
    texts = [
        (1000 + i, words * 3 + hashlib.sha512(str(i).encode()).hexdigest().upper()[:48] + " " + words * 2 + "1" * 24)
        for i in range(30)
    ]
    found = random_spans(by_id(secrets_scan.secret_scan(make(tables + texts))))
    assert not any(found[i] for i, _ in tables)
    assert all(len(found[i]) <= 1 for i, _ in texts) and sum(map(bool, (found[i] for i, _ in texts))) >= 20
