"""The Merkle manifest against a tree built level by level in one place."""

import hashlib
import zlib

import pytest
from llm_text import make, odd_rows, prose  # noqa: F401

from stationlake.llm import merkle


def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row, text):
    fields = [row["doc_id"], row["source"], row["lang"], row["n_chars"], text]
    return sha(*("-" if f is None else f"{len(str(f).encode())}:{f}" for f in fields))


def levels_of(nodes):
    levels = [nodes]
    while len(levels[-1]) > 1:
        below = levels[-1]
        levels.append([sha(*below[i : i + 16]) for i in range(0, len(below), 16)])
    return levels


def proof_of(levels, n):
    """Per level the run's others, and where the node stands among them."""
    steps = []
    for level in levels[:-1]:
        run = n - n % 16
        steps.append((level[run:n], level[n + 1 : run + 16]))
        n //= 16
    return steps


def brute_force(rows):
    trees = {}
    for row in rows:
        trees.setdefault(row["source"], []).append(row)
    order = sorted(trees, key=lambda s: (s is not None, (s or "").encode()))
    built = {}
    for source in order:
        own = sorted(
            ((r["doc_id"] is not None, r["doc_id"] or 0, leaf(r, r["text"]), r["text"]) for r in trees[source]),
            key=lambda x: x[:3],
        )
        rows_in_order = sorted(
            trees[source], key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, leaf(r, r["text"]))
        )
        built[source] = (rows_in_order, levels_of([x[2] for x in own]))
    above = levels_of([built[s][1][-1][0] for s in order])
    root = above[-1][0] if order else ""
    out = []
    for place, source in enumerate(order):
        members, levels = built[source]
        for n, row in enumerate(members):
            steps = proof_of(levels, n) + proof_of(above, place)
            proof = sha(*("".join(a + b) for a, b in steps))
            hit = row["doc_id"] is not None and zlib.crc32(str(row["doc_id"]).encode()) % 5 == 0
            text = row["text"]
            if hit and text is not None:
                text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text)
            top = leaf(row, text)
            for a, b in steps:
                top = sha(*a, top, *b)
            out.append((row["doc_id"], levels[0][n], levels[-1][0], root, proof, top, top == root))
    return sorted(out, key=repr)


def check(docs):
    got = sorted(map(tuple, merkle.manifest(docs).select(*merkle._MANIFEST).collect()), key=repr)
    want = brute_force([r.asDict() for r in docs.select("doc_id", "source", "lang", "n_chars", "text").collect()])
    assert got == want
    return got


def documents(spark, sizes):
    rows, n = [], 0
    for source, size in sizes:
        for _ in range(size):
            rows.append((n * 7 % 100_003, f"{prose(n, 3)} Upper é{n}", "en", source, n))
            n += 1
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(5)


@pytest.mark.parametrize(
    "sizes",
    [
        [("a", 1)],
        [("a", 16), ("b", 17), (None, 1), ("", 2)],
        [("one", 1), ("hot", 700), ("edge", 257), ("ä", 256), ("z", 33)],
    ],
)
def test_equals_brute_force(spark, sizes):
    got = check(documents(spark, sizes))
    assert any(r[-1] for r in got) or len(got) < 3
    assert not all(r[-1] for r in got) or len(got) < 30


def test_many_sources(spark):
    check(documents(spark, [(f"s{i:03}", 1 + i % 3) for i in range(300)]))


def test_four_sweeps(spark):
    n = 66_000
    docs = spark.range(n).selectExpr("id AS doc_id", "concat('T ', id) AS text", "'en' AS lang", "'hot' AS source", "id AS n_chars")
    small = spark.createDataFrame([(n, "x", "en", "small", 1)], docs.schema)
    check(docs.unionByName(small))


def test_odd_rows_and_clashes(make, odd_rows):
    check(make(odd_rows, clashes=True).selectExpr("*", "'x' AS tree", "1 AS number", "'y' AS digest", "2 AS slab"))


def test_empty_table(make, odd_rows):
    assert merkle.manifest(make(odd_rows).limit(0)).count() == 0


def test_a_slab_never_holds_more_than_its_bound(spark):
    docs = documents(spark, [("hot", 1500)])
    leaves = merkle._numbered(merkle._leaves(docs), ["doc_id", "digest"], "test-numbered")
    slabs = leaves.selectExpr(f"floor(number / {merkle.SLAB}) AS s", "tree").groupBy("tree", "s").count()
    assert slabs.agg({"count": "max"}).first()[0] <= merkle.SLAB
    assert leaves.selectExpr("max(number)", "count(DISTINCT number)").first() == (1499, 1500)


@pytest.mark.parametrize("n", [1, 2, 15, 16, 17, 255, 256, 257, 4097])
def test_levels(n):
    assert [len(x) for x in levels_of([str(i) for i in range(n)])] == merkle.widths(n)
