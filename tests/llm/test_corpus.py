"""What the pipeline asks of its stages, against brute force."""

import numpy as np
import pyarrow as pa
from llm_text import make, odd_rows, prose  # noqa: F401
from test_text import shingles

import corpus_pipeline
from stationlake.llm import minhash


def jaccard(a, b):
    a, b = shingles(a), shingles(b)
    return len(a & b) / len(a | b)


def changed(text, n):
    """n words far apart replaced by new ones."""
    parts = text.split(" ")
    for k in range(n):
        parts[20 + 40 * k] = f"changed{n}x{k}"
    return " ".join(parts)


def test_near_stage_links_at_four_fifths(spark, make):
    base, other = prose(71, 300), prose(72, 300)
    rows = [(1, base), (2, changed(base, 6)), (3, other), (4, changed(other, 7))]
    assert 0.80 < jaccard(rows[0][1], rows[1][1]) < 0.83 and 0.77 < jaccard(rows[2][1], rows[3][1]) < 0.80
    kept = corpus_pipeline.drop_near_duplicates(spark, make(rows), "")
    assert {r.doc_id for r in kept.collect()} == {1, 3, 4}
    # The bound of op9 stays.
    assert minhash.near_duplicates(make(rows)).filter("kept").count() == 4


def test_blocks_link_at_the_bound_asked_for():
    rng = np.random.default_rng(8)
    base = rng.integers(0, 1 << 62, 200)
    sets = [np.sort(base), np.sort(np.r_[base[:180], rng.integers(0, 1 << 62, 20)])]  # 180 of 220
    table = pa.table(
        {
            "component": pa.array([b"a", b"b"], pa.binary()),
            "asks": pa.array([False, True]),
            "shingles": pa.array(sets, pa.list_(pa.int64())),
        }
    )
    assert minhash._linked_blocks(table, 80).num_rows == 1 and minhash._linked_blocks(table).num_rows == 0


def test_rows_without_ids_meet_their_own_class_only(make, monkeypatch):
    rows = [(None, changed(prose(800 + i, 120), k)) for i in range(6) for k in (0, 1)]
    docs = make(rows)
    read, plain = [], type(docs).mapInArrow

    def counted(df, function, schema, *more):
        if function is minhash._sets:
            read.append(df.count())
        return plain(df, function, schema, *more)

    monkeypatch.setattr(type(docs), "mapInArrow", counted)
    assert minhash.near_duplicates(docs).select("component").distinct().count() == 6
    assert read == [12]
