"""A Merkle manifest of a table of documents, by time-forward processing.

Leaves of a source form a tree of up to ``FAN`` children a node, subroots of all
sources one more. Nodes are numbered within their level; a node's label is its
tree, level and number. Digests travel up to parents in order of labels: the
external part of the priority queue is a table sorted by label, in which a
parent two levels up finds its slab of nodes side by side; within a slab a heap
delivers every digest to the node that its label names. A sweep in reverse order
then hands each node the proof of its parent, down to the leaves, where the
node's own siblings go before it.

A slab has at most ``FAN ** LEVELS`` nodes, so no task holds a source, and the
number of sweeps is the logarithm of the largest source's size to that base.
The driver sees only the number of levels left, and one root.

Defined results: a NULL column counts as ``-``. NULL sources are one source, in
front of all others; the empty source is another one. Within a source NULL
doc_ids come first; rows of equal doc_id are in order of their digest, so
repeated rows have the same leaf and a place of their own each. An empty table
gives no rows. Documents without doc_id are never tampered with. Other columns
of the table are not read, whatever their names.
"""

from __future__ import annotations

import hashlib
from heapq import heappop, heappush

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stationlake.llm.common import forget, step

FAN = 16
LEVELS = 2  # levels that one sweep climbs
SLAB = FAN**LEVELS
_NODES = ["tree", "number", "digest"]
_BATCH = 4096


def digest_of(text: bytes) -> str:
    return hashlib.sha256(text).hexdigest()


def widths(n: int) -> list[int]:
    """Nodes of every level of a tree of n leaves, from the leaves to one node."""
    found = [n]
    while found[-1] > 1:
        found.append(-(-found[-1] // FAN))
    return found


def _field(value: Column) -> Column:
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_of(text: Column) -> Column:
    """Leaf digest of a documents row with the given text."""
    fields = [_field(F.col(c)) for c in ("doc_id", "source", "lang", "n_chars")]
    return F.sha2(F.concat(*fields, _field(text)), 256)


def _leaves(docs: DataFrame) -> DataFrame:
    """One row per document: its tree, digest, and digest after tampering."""
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    hit = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    tampered = F.when(hit, leaf_of(F.translate(F.col("text").cast("string"), upper, lower)))
    # Sorting texts by bytes puts the tree of NULL sources first.
    tree = F.coalesce(F.concat(F.lit("="), F.col("source").cast("string")), F.lit(""))
    return docs.select(
        tree.alias("tree"),
        F.col("doc_id").cast("long"),
        leaf_of(F.col("text")).alias("digest"),
        tampered.alias("forged"),
    )


def _numbered(rows: DataFrame, order: list[str], label: str) -> DataFrame:
    """Stored rows with ``number``, their place within ``tree`` from 0 on, and
    ``total``, the size of the tree.

    Rows are dealt into ranges of (tree, order), so one tree fills as many tasks
    as it needs; places are counted per task and moved by what lies before.
    """
    tasks = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keys = ["tree", *order]
    ranged = step(
        rows.repartitionByRange(tasks, *keys)
        .sortWithinPartitions(*keys)
        .withColumns(
            {
                "part": F.spark_partition_id(),
                "place": F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)),
            }
        ),
        f"ranged-{label}",
    )
    counts = ranged.groupBy("tree", "part").agg(
        F.count(F.lit(1)).alias("n"), F.min("place").alias("first")
    )
    # A tree's window has one row per task that it fills.
    tree = Window.partitionBy("tree")
    before = F.sum("n").over(tree.orderBy("part")) - F.col("n")
    shifts = counts.select(
        "tree",
        "part",
        (before - F.col("first")).alias("shift"),
        F.sum("n").over(tree).alias("total"),
    )
    numbered = step(
        ranged.join(shifts, ["tree", "part"])
        .withColumn("number", F.col("place") + F.col("shift"))
        .drop("part", "place", "shift"),
        label,
    )
    forget(ranged)
    return numbered


def _by_slab(nodes: DataFrame, order: list[str]) -> DataFrame:
    """Nodes of a slab side by side, in order of their labels."""
    return (
        nodes.withColumn("slab", F.floor(F.col("number") / SLAB).cast("long"))
        .repartition("tree", "slab")
        .sortWithinPartitions("tree", "slab", *order)
    )


def _climbed(digests: list[str], total: int) -> list[list[str]]:
    """Digests of a slab's nodes, level by level, up to LEVELS further ones or
    the root of a tree of ``total`` nodes at the lowest.

    A heap holds the messages: (label of the receiver, place among its children,
    digest). Labels ascend by level and number, so a node is reached after all
    its children have sent.
    """
    limit = min(LEVELS, len(widths(total)) - 1)
    levels = [digests]
    queue: list[tuple[tuple[int, int], int, str]] = []
    if limit:
        for number, digest in enumerate(digests):
            heappush(queue, ((1, number // FAN), number, digest))
    while queue:
        label = queue[0][0]
        children = []
        while queue and queue[0][0] == label:
            children.append(heappop(queue)[2])
        level, number = label
        digest = digest_of("".join(children).encode())
        if level == len(levels):
            levels.append([])
        levels[level].append(digest)
        if level < limit:
            heappush(queue, ((level + 1, number // FAN), number, digest))
    return levels


def _slabs(rows):
    """(tree, slab) and its rows, from rows of which equal ones are neighbours."""
    key, held = None, []
    for row in rows:
        if row[:2] != key:
            if held:
                yield key, held
            key, held = row[:2], []
        held.append(row)
    if held:
        yield key, held


def _tuples(batches):
    for batch in batches:
        yield from zip(*(column.to_pylist() for column in batch.columns), strict=True)


def _batched(rows, names: list[str], types: list[pa.DataType]):
    def made(held):
        columns = zip(*held, strict=True)
        return pa.record_batch([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=names)

    held = []
    for row in rows:
        held.append(row)
        if len(held) == _BATCH:
            yield made(held)
            held = []
    if held:
        yield made(held)


def _tops(batches):
    """Of every slab its highest node."""

    def rows():
        for (tree, slab), members in _slabs(_tuples(batches)):
            total = members[0][4]
            levels = _climbed([m[3] for m in members], total)
            yield tree, slab, levels[-1][0], -(-total // SLAB)

    text, number = pa.string(), pa.int64()
    yield from _batched(rows(), [*_NODES, "total"], [text, number, text, number])


def _rise(leaves: DataFrame) -> list[DataFrame]:
    """Nodes of every LEVELS-th level; the last table has the trees' roots."""
    stored = [leaves]
    while (stored[-1].agg(F.max("total")).first()[0] or 0) > 1:
        sorted_nodes = _by_slab(stored[-1], ["number"]).select("tree", "slab", "number", "digest", "total")
        tops = sorted_nodes.mapInArrow(_tops, "tree string, number long, digest string, total long")
        stored.append(step(tops, "merkle-nodes"))
    return stored


def _handed_down(batches):
    """For every member of a slab the digests that prove it: its siblings, then
    its parent's, then what the slab's highest node got from above.

    Rows are (tree, slab, number, digest, total, proof, ...): the slab's message
    first (no digest), then its members.
    """

    def rows():
        for (tree, _slab), (message, *members) in _slabs(_tuples(batches)):
            from_above = message[5]
            levels = _climbed([m[3] for m in members], members[0][4])
            above = [from_above] * len(levels[-1])
            for level in reversed(levels[:-1]):
                above = [_siblings(level, n) + above[n // FAN] for n in range(len(level))]
            for member, proof in zip(members, above, strict=True):
                yield tree, member[2], proof

    text, number = pa.string(), pa.int64()
    yield from _batched(rows(), ["tree", "number", "proof"], [text, number, text])


def _siblings(level: list[str], number: int) -> str:
    run = number - number % FAN
    return "".join(level[run:number] + level[number + 1 : run + FAN])


def _with_messages(nodes: DataFrame, messages: DataFrame, extra: list[str]) -> DataFrame:
    """Slabs of nodes, each with its message (tree, slab as number, proof and
    ``extra``) in front."""
    down = messages.select(
        "tree",
        F.col("number").alias("slab"),
        F.lit(None).cast("long").alias("number"),
        "proof",
        *extra,
    )
    return (
        nodes.withColumn("slab", F.floor(F.col("number") / SLAB).cast("long"))
        .unionByName(down, allowMissingColumns=True)
        .repartition("tree", "slab")
        .sortWithinPartitions("tree", "slab", F.col("number").asc_nulls_first())
    )


def _descend(stored: list[DataFrame], messages: DataFrame) -> DataFrame:
    """Proofs of the nodes of the second lowest table, from those of the roots:
    the messages that the lowest nodes' slabs get."""
    for nodes in reversed(stored[1:-1]):
        slabs = _with_messages(nodes, messages, []).select(
            "tree", "slab", "number", "digest", "total", "proof"
        )
        messages = step(
            slabs.mapInArrow(_handed_down, "tree string, number long, proof string"), "merkle-proofs"
        )
    return messages


def folded(digest: str, number: int, total: int, proof: str) -> tuple[str, str]:
    """The root that a node and its siblings make, and the rest of the proof."""
    for width in widths(total)[:-1]:
        run = number - number % FAN
        others = min(FAN, width - run) - 1
        before = 64 * (number - run)
        siblings, proof = proof[: 64 * others], proof[64 * others :]
        digest = digest_of((siblings[:before] + digest + siblings[before:]).encode())
        number //= FAN
    return digest, proof


def _proved(root: str):
    """The manifest rows of every slab of leaves."""

    def run(batches):
        def rows():
            for _key, (message, *members) in _slabs(_tuples(batches)):
                _, _, _, _, _, from_above, subroot, place, places, _, _ = message
                levels = _climbed([m[3] for m in members], members[0][4])
                above = [from_above] * len(levels[-1])
                for level in reversed(levels[:-1]):
                    above = [_siblings(level, n) + above[n // FAN] for n in range(len(level))]
                for member, proof in zip(members, above, strict=True):
                    number, leaf, total, forged, doc_id = member[2], member[3], member[4], member[9], member[10]
                    mine, rest = folded(forged or leaf, number, total, proof)
                    top, _ = folded(mine, place, places, rest)
                    yield doc_id, leaf, subroot, root, digest_of(proof.encode()), top, top == root

        types = [pa.int64(), *[pa.string()] * 5, pa.bool_()]
        yield from _batched(rows(), _MANIFEST, types)

    return run


_MANIFEST = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]


def manifest(docs: DataFrame) -> DataFrame:
    """doc_id, leaf, subroot, root, proof_sha256, folded_root, verified."""
    raw = step(_leaves(docs), "merkle-leaves")
    leaves = _numbered(raw, ["doc_id", "digest"], "merkle-numbered")
    forget(raw)
    trees = _rise(leaves)

    # The subroots are the leaves of one more tree.
    roots = trees[-1].select(F.lit("").alias("tree"), F.col("tree").alias("of"), "digest")
    sources = _numbered(roots, ["of"], "merkle-sources")
    top = _rise(sources)
    found = top[-1].select("digest").head(1)  # one row, or none of an empty table
    root = found[0]["digest"] if found else ""

    down = top[-1].select("tree", "number", F.lit("").alias("proof"))
    if len(top) > 1:
        down = _descend(top, down)
        slabs = _with_messages(sources.drop("of"), down, []).select(
            "tree", "slab", "number", "digest", "total", "proof"
        )
        proofs = step(
            slabs.mapInArrow(_handed_down, "tree string, number long, proof string"), "merkle-top"
        )
    else:
        proofs = down
    named = sources.select("number", F.col("of").alias("tree"), F.col("digest").alias("subroot"), "total")
    about = step(
        proofs.select("number", "proof")
        .join(named, "number")
        .select(
            "tree", "subroot", "proof", F.col("number").alias("place"), F.col("total").alias("places")
        ),
        "merkle-about",
    )
    forget(*top, *([] if proofs is down else [proofs]))
    # A tree of one leaf has no slab above it: its leaf is the subroot.
    messages = about.select("tree", F.lit(0).cast("long").alias("number"), "proof")
    if len(trees) > 1:
        messages = _descend(trees, messages)
        forget(*trees[1:])
    messages = messages.join(about.drop("proof"), "tree")
    slabs = _with_messages(leaves, messages, ["subroot", "place", "places"])
    return slabs.select(
        "tree", "slab", "number", "digest", "total", "proof", "subroot", "place", "places", "forged", "doc_id"
    ).mapInArrow(
        _proved(root),
        "doc_id long, leaf string, subroot string, root string, proof_sha256 string, "
        "folded_root string, verified boolean",
    )
