"""Packing, fingerprints, line and near-duplicate removal, repeats, toxicity and
the pipeline, against brute force."""

import hashlib
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pytest
from llm_text import by_id, make, odd_rows, prose, words  # noqa: F401
from tokenizers import Tokenizer

import corpus_pipeline
from stationlake.llm import (
    catalog,
    cuckoo,
    fingerprints,
    line_dedup,
    minhash,
    packing,
    repeats,
    runs,
    toxicity,
)


def shingles(text):
    found = words("".join(c.lower() if c.isascii() else c for c in text or ""))
    if len(found) < 5:
        return {tuple(found)} if found else set()
    return {tuple(found[i : i + 5]) for i in range(len(found) - 4)}


# --- packing ----------------------------------------------------------------


def test_pieces_cover_every_id_once(make, odd_rows):
    docs = make(odd_rows, clashes=True)
    tokenizer = Tokenizer.from_file(catalog.vocabulary())
    got = packing.packed(packing.token_pieces(docs, catalog.vocabulary(), with_ids=True)).collect()
    want = Counter()
    for i, text in odd_rows:
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [packing.END]
        want[(i, np.array(ids, "<u4").tobytes())] += 1
    pieces = defaultdict(list)
    for r in got:
        assert zlib.crc32(bytes(r.ids)) == r.ids_crc32 and len(r.ids) == 4 * r.length
        pieces[(r.doc_id, r.doc_tokens)].append((r.start, bytes(r.ids)))
    joined = Counter()
    for (i, _), parts in pieces.items():
        starts = Counter(s for s, _ in parts)
        copies = starts[0]
        same = {b"".join(p for _, p in sorted(set(parts)))} if len(set(parts)) == len(starts) else set()
        for data in same or {d for (j, d) in want if j == i}:
            joined[(i, data)] += copies if same else want[(i, data)]
    assert joined == want
    sequences = defaultdict(list)
    for r in got:
        sequences[r.sequence_id].append((r.offset, r.length))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= packing.CAPACITY


def test_sequences_hold_the_ids_in_order(make):
    docs = make([(i, prose(i, 50 + 40 * i)) for i in range(30)])
    pieces = packing.packed(packing.token_pieces(docs, catalog.vocabulary(), 512, with_ids=True), 512)
    by_sequence = defaultdict(list)
    for r in pieces.collect():
        by_sequence[r.sequence_id].append((r.offset, np.frombuffer(r.ids, "<u4")))
    total = padding = 0
    for r in packing.sequences(pieces, 512).collect():
        want = np.concatenate([ids for _, ids in sorted(by_sequence[r.sequence_id], key=lambda x: x[0])])
        assert list(want) == r.ids
        total, padding = total + len(r.ids), padding + r.padding
    assert padding < 0.05 * total


@pytest.mark.parametrize("length", [1, 63, 64, 2048, 2049, 4095, 4096, 4097, 50_000])
def test_cuts(length):
    pieces = packing.cut(length)
    assert sum(pieces) == length and all(0 < p <= 4096 for p in pieces)


def test_words_get_the_tokenizers_own_ids():
    odd = ["İstanbul ΣΑΣ ſ ǅ ﬀ don't I'LL <|endoftext|>x ỵ́ \x1c\x85 z\tq ½² 한국 ÀÉ", "a.b,c!d?... !", ""]
    texts = odd + [prose(i, 80) for i in range(5)]
    tokenizer = Tokenizer.from_file(catalog.vocabulary())
    ours = packing.WordTokenizer(catalog.vocabulary(), held=20)
    for text in texts * 2:
        assert list(ours.ids(text)) == tokenizer.encode(text, add_special_tokens=False).ids


# --- fingerprints -----------------------------------------------------------


def test_edited_texts_and_likeness(make, odd_rows):
    rows = [r for r in odd_rows if r[0] not in (3, None)] + [(100 + i, prose(i, 40 + i)) for i in range(60)]
    got = by_id(fingerprints.edited(make(rows, clashes=True)))
    order = sorted(rows, key=lambda r: -r[0])
    for (i, text), (_, after) in zip(order, order[1:] + order[:1], strict=True):
        text, after = text or "", after or ""
        swapped = len(text) // 3
        edited = text[: len(text) - swapped] + after[:swapped]
        r = got[i]
        assert r.n_chars == len(text)
        assert r.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        a, b = shingles(text), shingles(edited)
        if len(a | b) <= fingerprints.K:
            assert r.near_edited == (len(a & b) / len(a | b) if a | b else 1.0)
        else:
            assert abs(r.near_edited - len(a & b) / len(a | b)) < 0.3
    assert got[4].fingerprint == got[5].fingerprint == ""


def test_repeated_and_null_ids_get_a_row_each(make, odd_rows):
    assert fingerprints.edited(make(odd_rows)).count() == len(odd_rows)
    one = fingerprints.edited(make([(1, "abcdef")])).first()
    assert one.near_next == 1.0 and one.edited_sha256 == hashlib.sha256(b"abcdab").hexdigest()
    assert fingerprints.edited(make([(1, "x")]).limit(0)).count() == 0


def test_merged_sketches_estimate_the_union(make):
    rows = [(i, prose(i % 25, 60)) for i in range(50)]
    docs = make(rows)
    merged = fingerprints.merged(fingerprints.fingerprints(docs).selectExpr("*", "1 AS part"), "part").first()
    want = len(set().union(*(shingles(t) for _, t in rows)))
    assert abs(merged.n_shingles - want) < 0.4 * want
    sketch = fingerprints.sketches_of([rows[0][1].encode(), rows[25][1].encode()], fingerprints.Powers())
    assert fingerprints.resemblance(*sketch) == fingerprints.containment(*sketch) == 1.0
    assert fingerprints.distinct_shingles(sketch[0]) == len(shingles(rows[0][1]))


# --- lines ------------------------------------------------------------------


def without_frequent(rows, least):
    key = lambda line: line.strip(" \t\n\x0b\x0c\r").translate({c: c + 32 for c in range(65, 91)})
    lines = [(t or "").split("\n") for _, t in rows]
    counts = Counter(k for ls in lines for k in {key(x) for x in ls} if k)
    out = []
    for (i, _), ls in zip(rows, lines, strict=True):
        kept = [x for x in ls if not key(x) or counts[key(x)] < least]
        out.append((i, len(ls), len(ls) - len(kept), "\n".join(kept)))
    return out


@pytest.fixture
def line_rows(odd_rows):
    common = [(50 + i, f" Shared LINE\t\nown {i}\n\nshared line\nend É{i}") for i in range(12)]
    return odd_rows + common + [(90 + i, f"nine docs\nx{i}") for i in range(9)]


def test_lines_of_many_documents_go(make, line_rows):
    docs = make(line_rows, clashes=True)
    got = sorted(map(tuple, line_dedup.line_dedup(docs).collect()), key=repr)
    want = [(i, n, d, hashlib.sha256(t.encode()).hexdigest()) for i, n, d, t in without_frequent(line_rows, 10)]
    assert got == sorted(want, key=repr)
    kept = line_dedup.without_frequent_lines(docs)
    assert kept.columns == docs.columns and kept.count() == len(line_rows)
    assert {r.doc_id for r in kept.collect() if r.text is None} == {4, None}


def test_documents_can_be_taken_back(make, line_rows):
    first, second = line_rows[:20], line_rows[20:]
    docs, more = make(first), make(second)
    both = line_dedup.added(line_dedup.new_state(docs, 3), more)
    back = line_dedup.deleted(both, more)
    alone = line_dedup.new_state(docs, 3)

    def refs(state):
        return sorted((bytes(r.key), r.refs) for r in state.refs.collect())

    assert refs(back) == refs(alone) and len(refs(both)) > len(refs(alone))
    for state, want in ((both, without_frequent(line_rows, 3)), (back, without_frequent(first, 3))):
        rows = line_rows if state is both else first
        texts = Counter(r.lines.kept for r in line_dedup.cleaned(make(rows), state).collect())
        assert texts == Counter(t for *_, t in want)
    assert line_dedup.line_dedup(docs.limit(0)).count() == 0


def test_cuckoo_filter_forgets():
    rng = random.Random(5)
    values = [rng.randbytes(16) for _ in range(3000)]
    keys = cuckoo.as_keys(values)
    full = cuckoo.CuckooFilter.sized(2000)
    assert full.insert(keys[:2000]) and full.contains(keys[:2000]).all()
    assert full.contains(keys[2000:]).mean() < 0.01
    full.delete(keys[:1000])
    assert full.contains(keys[1000:2000]).all() and full.contains(keys[:1000]).mean() < 0.01
    assert not cuckoo.CuckooFilter.sized(8).insert(keys)


# --- near duplicates ---------------------------------------------------------


def linked(rows):
    sets = [shingles(t) for _, t in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if sets[a] and sets[b] and 100 * both >= 85 * (len(sets[a]) + len(sets[b]) - both):
                parent[find(a)] = find(b)
    groups = defaultdict(list)
    for k in range(len(rows)):
        groups[find(k)].append(k)
    out = []
    for members in groups.values():
        least = min((rows[k][0] for k in members if rows[k][0] is not None), default=None)
        out += [(rows[k][0], len(sets[k]), least, rows[k][0] == least) for k in members]
    return sorted(out, key=repr)


@pytest.fixture(scope="module")
def near_rows():
    """Chains: each text has a few more changes, so ends are not alike; and one
    base with many copies that are like it but not like each other."""
    rows, rng = [], random.Random(3)
    text = prose(77, 300).split(" ")
    for i in range(12):
        text[rng.randrange(len(text))] = f"chain{i}"
        rows.append((200 + i, " ".join(text)))
    base = prose(78, 200).split(" ")
    for i in range(40):
        copy = list(base)
        for _ in range(i % 6):
            copy[rng.randrange(len(copy))] = f"star{i}x"
        rows.append((300 + i, " ".join(copy)))
    return rows


def test_components_are_those_of_all_pairs(make, odd_rows, near_rows):
    rows = odd_rows + near_rows
    docs = make(rows, clashes=True)
    found = minhash.near_duplicates(docs).select("doc_id", "n_shingles", "component_id", "kept")
    assert sorted(map(tuple, found.collect()), key=repr) == linked(rows)
    kept = minhash.without_near_duplicates(docs)
    assert kept.columns == docs.columns
    # One row per group; rows without words stay unless equal in id and text.
    assert kept.count() == len({(r[2], r[0] if not r[1] else "") for r in linked(rows)})
    assert minhash.near_duplicates(docs.limit(0)).count() == 0


def test_blocks_find_every_link_between_components():
    rng = np.random.default_rng(7)
    base = rng.integers(0, 1 << 62, 200)
    sets = [np.sort(np.r_[base[: 200 - 3 * k], rng.integers(0, 1 << 62, 3 * k)]) for k in range(14)]
    names = [bytes([k]) * 16 for k in range(14)]
    rows = [(k, asks) for k in range(14) for asks in ([False, True] if k % 2 else [False])]
    table = pa.table(
        {
            "component": pa.array([names[k // 2] for k, _ in rows], pa.binary()),
            "asks": pa.array([a for _, a in rows]),
            "shingles": pa.array([sets[k] for k, _ in rows], pa.list_(pa.int64())),
        }
    )
    got = set(map(tuple, zip(*(c.to_pylist() for c in minhash._linked_blocks(table).columns), strict=True)))
    want = set()
    for a in range(1, 14, 2):
        for b in range(14):
            both = len(np.intersect1d(sets[a], sets[b]))
            if a // 2 != b // 2 and 100 * both >= 85 * (400 - both):
                want.add((names[a // 2], names[b // 2]))
    assert got == want and want
    for only in (True, False):
        assert minhash._linked_blocks(table.filter(pc.equal(table["asks"], only))).num_rows == 0


def test_circulant_signature_estimates_jaccard():
    rng = np.random.default_rng(1)
    a = rng.integers(0, 1 << 63, 400).astype(np.uint64)
    b = np.r_[a[:300], rng.integers(0, 1 << 63, 100).astype(np.uint64)]
    same = (minhash.signature(a, 512) == minhash.signature(b, 512)).mean()
    assert abs(same - 300 / 500) < 0.08


# --- repeats -----------------------------------------------------------------


def removed(rows):
    data = [(t or "").encode() for _, t in rows]
    n = repeats.LENGTH
    counts = Counter(d[i : i + n] for d in data for i in range(len(d) - n + 1))
    out = []
    for (i, _), d in zip(rows, data, strict=True):
        gone = bytearray(len(d))
        for k in range(len(d) - n + 1):
            if counts[d[k : k + n]] > 1:
                gone[k : k + n] = b"\x01" * n
        kept = bytes(x for x, g in zip(d, gone, strict=True) if not g)
        spans = sum(g and not (k and gone[k - 1]) for k, g in enumerate(gone))
        out.append((i, len(d), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


@pytest.mark.parametrize("part_bytes", [2000, 1 << 24])
def test_repeats_are_those_of_all_strings(make, odd_rows, monkeypatch, part_bytes):
    monkeypatch.setattr(repeats, "PART_BYTES", part_bytes)
    passage, other = prose(40, 90), prose(41, 120)
    rows = odd_rows + [(60 + i, prose(100 + i, 40) + passage + prose(200 + i, 30)) for i in range(8)]
    # Variants: one shares what follows, another what goes before; exact edges; runs.
    rows += [
        (80, other[:500] + prose(42, 30)), (81, prose(43, 30) + other[150:]),
        (82, other[100:620]), (83, "ab" * 700), (84, "x" * 401), (85, "y" * 400), (86, "é" * 300),
        (87, prose(44, 10) + other[:400]), (88, other[:399] + "!"),
    ]
    got = sorted(map(tuple, repeats.repeats(make(rows, clashes=True)).collect()), key=repr)
    assert got == removed(rows)


def test_no_repeats_in_nothing(make):
    assert repeats.repeats(make([(1, "x")]).limit(0)).count() == 0
    assert tuple(repeats.repeats(make([(1, None)])).first())[:4] == (1, 0, 0, 0)


def test_loser_tree_merges_and_knows_prefixes():
    rng = random.Random(9)
    strings = [bytes(rng.choice(b"ab") for _ in range(rng.randint(0, 12))) for _ in range(400)]
    for k in (1, 2, 3, 7):
        parts = [sorted((s, str(i).encode()) for i, s in enumerate(strings) if i % k == r) for r in range(k)]
        merged = list(runs.merged([runs.front_coded(p) for p in parts]))
        assert [s for s, _, _ in merged] == sorted(strings)
        for (a, _, _), (b, shared, _) in zip(merged, merged[1:], strict=False):
            assert shared == runs.common(a, b)
    assert list(runs.merged([])) == list(runs.merged([b"", b""])) == []


# --- toxicity ----------------------------------------------------------------


@pytest.fixture(scope="module")
def labeled(spark, make):
    rng, rows, labels = random.Random(2), [], []
    for i in range(400):
        text, toxic = prose(i, 80), int(i % 5 == 0)
        if toxic:
            parts = text.split(" ")
            for _ in range(4):
                parts[rng.randrange(len(parts))] = rng.choice(["vileword", "nastyword", "vilewording"])
            text = " ".join(parts)
        rows.append((i, text))
        labels.append((i, 1, toxic))
    rows += [(1000, None), (1001, ""), (1002, "so vilewordish, nastyword and vileword here"), (None, "x")]
    labels += [(3, 1, None), (None, 1, 1), (5, 1, 0), (9999, 1, 1)]
    return make(rows, clashes=True), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_held_out_documents_are_told_apart(labeled):
    docs, labels = labeled
    got = by_id(toxicity.toxicity(docs, labels))
    assert len(got) == 404
    held = [i for i in range(400) if zlib.crc32(str(i).encode()) % 5 == 0]
    assert [got[i].held_out for i in range(400)] == [i in set(held) for i in range(400)]
    right = sum(got[i].predicted == int(i % 5 == 0) for i in held)
    assert right >= 0.97 * len(held)
    assert got[1000].score == got[1001].score < 0.5 < got[1002].score
    clean = toxicity.without_toxic(docs, labels)
    assert clean.columns == docs.columns
    assert {r.doc_id for r in clean.select("doc_id").collect()} == {i for i, r in got.items() if not r.predicted}


def test_passages_are_where_the_words_are(make, labeled):
    model = toxicity.fit(*labeled)
    text = prose(900, 60) + " vileword nastyword vileword nastyword " + prose(901, 60)
    found = toxicity.passages(make([(1, "é😀 " + text)]), model).collect()
    assert len(found) == 1
    part = ("é😀 " + text)[found[0].first : found[0].end]
    assert part.startswith("vileword") and part.endswith("nastyword")


def test_columns_named_like_the_labels_do_no_harm(labeled):
    docs, labels = labeled
    clashing = docs.selectExpr("*", "'x' AS labeled_id", "'y' AS toxic", "'z' AS quality", "1 AS score")
    got = by_id(toxicity.toxicity(clashing, labels))
    want = by_id(toxicity.toxicity(docs, labels))
    assert {i: r.predicted for i, r in got.items()} == {i: r.predicted for i, r in want.items()}
    kept = toxicity.without_toxic(clashing, labels)
    assert kept.columns == clashing.columns
    assert kept.count() == toxicity.without_toxic(docs, labels).count()


def test_without_usable_labels_nothing_is_toxic(labeled):
    docs, labels = labeled
    assert {r.score for r in toxicity.toxicity(docs, labels.limit(0)).collect()} == {0.0}
    assert toxicity.without_toxic(docs, labels.filter("toxic = 0")).count() == 404
    assert toxicity.toxicity(docs.limit(0), labels).count() == 0


def test_all_maximal_segments():
    rng = random.Random(4)
    for _ in range(200):
        scores = np.array([rng.choice([-3, -1, 1, 2]) for _ in range(rng.randint(1, 14))], float)
        assert sorted(toxicity.segments(scores)) == sorted(recursive_segments(scores, 0))


def recursive_segments(scores, at):
    """The best segment, then those on its left and right."""
    best = max(
        ((scores[a:b].sum(), -(b - a), a, b) for a in range(len(scores)) for b in range(a + 1, len(scores) + 1)),
        default=(0, 0, 0, 0),
    )
    if best[0] <= 0:
        return []
    _, _, a, b = best
    return (
        recursive_segments(scores[:a], at)
        + [(at + a, at + b, float(best[0]))]
        + recursive_segments(scores[b:], at + b)
    )


# --- pipeline ----------------------------------------------------------------


def test_stages_do_what_their_operators_do(spark, make, tmp_path, labeled):
    docs, labels = labeled
    docs = docs.select("doc_id", "text", "lang", "source", "n_chars")
    extra = make([(500 + i, prose(500, 100) + "\nthe shared line") for i in range(8)])
    docs.unionByName(extra).write.parquet(f"{tmp_path}/documents.parquet")
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["toxicity", "line_dedup", "near_dedup", "mixing", "packing"]
    found, sizes = spark.read.parquet(f"{tmp_path}/documents.parquet"), []
    for name, stage in corpus_pipeline.STAGES:
        found = stage(spark, found, str(tmp_path))
        path = f"{tmp_path}/{name}"
        found.write.parquet(path)
        found = spark.read.parquet(path)
        sizes.append(found.count())
        if name != "packing":
            assert found.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    assert sizes[0] == sizes[1] > sizes[2]
    assert found.groupBy("sequence_id").sum("length").filter("`sum(length)` > 4096").isEmpty()
