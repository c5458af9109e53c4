"""Very long tokens and very many of them: time in proportion, every place right."""

import hashlib
import random
import re
import time

from llm_text import by_id, make, prose  # noqa: F401

from stationlake.llm import secrets_scan

BASE64 = secrets_scan.ALPHABETS["base64"]


def timed(make, rows):
    """Results, and the seconds beyond those of a text of one short token."""
    docs, short = make(rows).cache(), make([(1, "a short text " + "0a1b2c3d" * 4)]).cache()
    docs.count(), short.count()
    secrets_scan.secret_scan(short).collect()
    start = time.perf_counter()
    secrets_scan.secret_scan(short).collect()
    fixed = time.perf_counter() - start
    got = by_id(secrets_scan.secret_scan(docs))
    return got, time.perf_counter() - start - 2 * fixed


def test_a_token_of_100_kb(make):
    rng = random.Random(1)
    uri = "".join(rng.choice(BASE64) for _ in range(100_000))
    plain = "ab" * 50_000
    before = prose(1, 60) + " data:image/png;base64,"
    got, seconds = timed(make, [(1, before + uri + " after"), (2, before + plain)])
    spans = [s for s in got[1].spans.split(",") if s.startswith("random")]
    assert spans in ([f"random:{len(before)}:{len(before) + len(uri)}"], [])
    # A known form inside it (hex by chance) is the only thing that may keep it out.
    assert spans or re.search("[0-9a-f]{16}", uri)
    assert "random" not in got[2].spans
    assert seconds < 5


def test_ten_thousand_tokens_in_a_text(make):
    keys = [hashlib.md5(str(i).encode()).hexdigest() for i in range(10_000)]
    upper = [k.upper() for k in keys]
    got, seconds = timed(make, [(1, " ".join(keys)), (2, prose(2, 60) + " ".join(upper)), (3, "xé " + "\n".join(keys[:300]))])
    assert got[1].spans == ",".join(f"hex:{33 * i}:{33 * i + 32}" for i in range(10_000))
    shift = len(prose(2, 60))
    places = {f"random:{shift + 33 * i}:{shift + 33 * i + 32}" for i in range(10_000)}
    assert {s for s in got[2].spans.split(",") if s.startswith("random")} <= places
    assert got[3].spans == ",".join(f"hex:{3 + 33 * i}:{35 + 33 * i}" for i in range(300))
    assert seconds < 20  # two such texts


def test_places_across_blocks(make):
    """Numbers of matches just at, below and above the size of a block."""
    rows = []
    for n in (1, 127, 128, 129, 256, 257):
        rng = random.Random(n)
        parts = [f"{'é' * rng.randint(0, 3)} AKIA{'Q' * rng.randint(14, 40)}" for _ in range(n)]
        rows.append((n, " ".join(parts)))
    got = by_id(secrets_scan.secret_scan(make(rows)))
    for n, text in rows:
        want = [f"access:{m.start()}:{m.end()}" for m in re.finditer("AKIA[A-Z0-9]+", text)]
        assert [s for s in got[n].spans.split(",") if s.startswith("access")] == want
        assert got[n].n_access == n
