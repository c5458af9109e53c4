"""Near-duplicate documents by circulant MinHash.

Shingle hashes are folded onto a circle of 2 ** 32 slots. One permutation
scatters a set over it; a second one, shifted by k slots, gives the k-th
coordinate of the signature. ``BANDS`` bands of ``ROWS`` coordinates propose
candidates, and a link is what the full shingle sets confirm.

Documents with equal sets form a class and are compared once. A bucket of
classes is not expanded into pairs: its most typical class is compared with all
others, which connects nearly all that belongs together. What is then left in a
bucket outside its largest component is compared with the rest of the bucket in
blocks, set against set within a task, and only links between components leave
the task. Every pair of a bucket is therefore confirmed, refuted, or already
connected, and no bucket meets in one task.

What counts as alike is a parameter, in percent of the union. Two documents at
Jaccard J share a bucket with probability ``1 - (1 - J ** ROWS) ** BANDS``:
0.9999996 at 0.85, 0.99997 at 0.80.

Results: documents without words are linked with nothing. ``component_id`` is
the smallest non-null doc_id of the component; a row is ``kept`` if it carries
it. Repeated rows have one class and so one component.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stationlake.llm.common import forget, step, text_of
from stationlake.llm.hashing import Powers, blocks, shingle_sets, text_bytes

BANDS, ROWS = 20, 4
THRESHOLD = 85  # percent of the union, unless a caller asks for another
_SLICE = 4096
BLOCK_SHINGLES = 400_000


def _permute(x: np.ndarray) -> np.ndarray:
    """A fixed permutation of 32-bit slots, in place."""
    x ^= x >> np.uint32(16)
    x *= np.uint32(0x85EBCA6B)
    x ^= x >> np.uint32(13)
    x *= np.uint32(0xC2B2AE35)
    x ^= x >> np.uint32(16)
    return x


def signature(shingles: np.ndarray, length: int = BANDS * ROWS) -> np.ndarray:
    """The circulant MinHash signature of a set of 64-bit hashes."""
    slots = _permute((shingles >> np.uint64(32)).astype(np.uint32) ^ shingles.astype(np.uint32))
    shifts = np.arange(1, length + 1, dtype=np.uint32)[:, None] * np.uint32(0x9E3779B1)
    least = np.full(length, 0xFFFFFFFF, np.uint32)
    for at in range(0, len(slots), _SLICE):
        shifted = slots[None, at : at + _SLICE] + shifts
        np.minimum(least, _permute(shifted).min(axis=1), out=least)
    return least


def band_keys(sig: np.ndarray) -> np.ndarray:
    """One 64-bit key per band; equal coordinates in other bands differ."""
    parts = sig.reshape(BANDS, ROWS)
    return np.array(
        [xxhash.xxh3_64_intdigest(p.tobytes(), seed=i) for i, p in enumerate(parts)], np.uint64
    ).view(np.int64)


def _sketches(batches):
    powers = Powers()
    for batch in batches:
        texts, ids, digests = text_bytes(batch["text"]), batch["doc_id"], batch["digest"]
        for part in blocks(np.array([len(t) for t in texts])):
            classes, sizes, bands = [], [], []
            for s in shingle_sets(texts[part], powers):
                classes.append(xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None)
                sizes.append(len(s))
                bands.append(band_keys(signature(s)) if len(s) else None)
            yield pa.record_batch(
                {
                    "doc_id": ids[part],
                    "digest": digests[part],
                    "class": pa.array(classes, pa.binary()),
                    "n_shingles": pa.array(sizes, pa.int64()),
                    "bands": pa.array(bands, pa.list_(pa.int64())),
                }
            )


def sketches(docs: DataFrame) -> DataFrame:
    """doc_id, digest (of the text), class (of equal shingle sets), n_shingles, bands."""
    return docs.select(
        F.col("doc_id").cast("long"), F.col("text").cast("string"), F.md5(text_of()).alias("digest")
    ).mapInArrow(
        _sketches,
        "doc_id long, digest string, class binary, n_shingles long, bands array<long>",
    )


def _sets(batches):
    powers = Powers()
    for batch in batches:
        texts, wanted = text_bytes(batch["text"]), batch["class"].to_pylist()
        for part in blocks(np.array([len(t) for t in texts])):
            found = [
                (c, s.view(np.int64))
                for c, s in zip(wanted[part], shingle_sets(texts[part], powers), strict=True)
                if xxhash.xxh3_128_digest(s.tobytes()) == c
            ]
            yield pa.record_batch(
                {
                    "class": pa.array([c for c, _ in found], pa.binary()),
                    "shingles": pa.array([s for _, s in found], pa.list_(pa.int64())),
                }
            )


def class_sets(docs: DataFrame, classes: DataFrame) -> DataFrame:
    """The shingle sets of classes, from one document of each: its doc_id and the
    digest of its text, as NULL ids are many."""
    text = F.col("text").cast("string")
    texts = docs.select(
        F.col("doc_id").cast("long").alias("row_id"), text.alias("text"), F.md5(text_of(text)).alias("row_digest")
    )
    asked = classes.select("member.doc_id", "member.digest", "class")
    same = (F.col("row_digest") == F.col("digest")) & F.col("row_id").eqNullSafe(F.col("doc_id"))
    return (
        texts.join(asked, same)
        .select("class", "text")
        .mapInArrow(_sets, "class binary, shingles array<long>")
        .dropDuplicates(["class"])
    )


def _alike(a: Column, b: Column, threshold: int) -> Column:
    both = F.size(F.array_intersect(a, b))
    return 100 * both >= threshold * (F.size(a) + F.size(b) - both)


def confirmed(pairs: DataFrame, sets: DataFrame, threshold: int = THRESHOLD) -> DataFrame:
    """The pairs (a, b) whose full sets reach the threshold."""
    left = sets.select(F.col("class").alias("a"), F.col("shingles").alias("sa"))
    right = sets.select(F.col("class").alias("b"), F.col("shingles").alias("sb"))
    alike = _alike(F.col("sa"), F.col("sb"), threshold)
    return pairs.join(left, "a").join(right, "b").filter(alike).select("a", "b")


def components(links: DataFrame) -> DataFrame:
    """(class, component) of all linked classes; component is the least class.

    Every round each class takes the least label next to it, then the label of
    that label; the number of rounds grows with the logarithm of a chain.
    """
    both = step(links.union(links.select("b", "a")).distinct(), "links")
    labels = step(
        both.groupBy(F.col("a").alias("class")).agg(
            F.least(F.min("b"), F.col("class")).alias("component")
        ),
        "labels",
    )
    stored = labels
    while True:
        near = (
            both.join(labels.select(F.col("class").alias("b"), "component"), "b")
            .groupBy("a")
            .agg(F.min("component").alias("near"))
        )
        lower = labels.join(near, F.col("class") == F.col("a")).select(
            "class", F.col("component").alias("old"), F.least("component", "near").alias("to")
        )
        onward = labels.select(F.col("class").alias("to"), F.col("component").alias("onward"))
        moved = step(
            lower.join(onward, "to", "left").select(
                "class", "old", F.least("to", F.coalesce("onward", "to")).alias("component")
            ),
            "labels",
        )
        settled = moved.filter(F.col("old") != F.col("component")).isEmpty()
        forget(stored)
        labels, stored = moved.select("class", "component"), moved
        if settled:
            forget(both)
            return labels


def near_duplicates(docs: DataFrame, threshold: int = THRESHOLD) -> DataFrame:
    """Per document: doc_id, n_shingles, component_id, kept, class."""
    drawn = step(sketches(docs), "sketches")
    labels = class_components(docs, drawn, threshold)
    by_class = (
        drawn.filter(F.col("class").isNotNull())
        .groupBy("class")
        .agg(F.min("doc_id").alias("first_id"))
        .join(labels, "class", "left")
        .withColumn("component", F.coalesce("component", "class"))
    )
    firsts = by_class.groupBy("component").agg(F.min("first_id").alias("component_id"))
    ids = by_class.join(firsts, "component").select("class", "component", "component_id")
    full = drawn.join(step(ids, "component-ids"), "class", "left")
    own = F.when(F.col("class").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return full.select(
        "doc_id",
        "n_shingles",
        own.alias("component_id"),
        F.col("doc_id").eqNullSafe(own).alias("kept"),
        "component",
        "digest",
    )


def class_components(docs: DataFrame, drawn: DataFrame, threshold: int = THRESHOLD) -> DataFrame:
    """(class, component) of the classes that are linked with another one."""
    classes = (
        drawn.filter(F.col("class").isNotNull())
        .groupBy("class")
        .agg(
            F.min(F.struct("doc_id", "digest")).alias("member"),
            F.first("n_shingles").alias("n"),
            F.first("bands").alias("bands"),
        )
    )
    entries = classes.select("class", "member", "n", F.explode("bands").alias("bucket"))
    sizes = entries.groupBy("bucket").agg(F.count(F.lit(1)).alias("members")).filter("members > 1")
    shared = step(entries.join(sizes, "bucket"), "buckets")
    typical = shared.groupBy("class").agg(
        F.sum(F.log2(F.col("members").cast("double"))).alias("typical"), F.first("member").alias("member")
    )
    members = step(
        shared.select("bucket", "class", "n").join(typical.select("class", "typical"), "class"), "members"
    )
    sets = step(class_sets(docs, typical.select("class", "member")), "sets")

    leaders = members.groupBy("bucket").agg(
        F.max_by(F.struct("class", "n"), F.struct("typical", "class")).alias("leader")
    )
    links = step(confirmed(_against(members, leaders, threshold), sets, threshold), "star-links")
    labels = components(links)
    led = leaders.select("bucket", F.col("leader.class").alias("class"))
    rest = members.join(led, ["bucket", "class"], "left_anti").join(labels, "class", "left")
    rest = rest.withColumn("component", F.coalesce("component", "class"))
    more = step(_across(rest, sets, threshold), "more-links")
    none = more.isEmpty()
    forget(shared, members, sets, links)
    if none:
        return labels
    # The components so far are the nodes of a smaller graph.
    joined = components(more.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct())
    onward = joined.toDF("component", "joined")
    single = joined.join(labels.select("component"), joined["class"] == labels["component"], "left_anti")
    return step(
        labels.join(onward, "component", "left")
        .select("class", F.coalesce("joined", "component").alias("component"))
        .unionByName(single),
        "labels",
    )


def _across(rest: DataFrame, sets: DataFrame, threshold: int) -> DataFrame:
    """Links (x, y) between components that share a bucket.

    ``rest``: bucket, class, n, component, without the classes that were
    compared with their whole bucket. Only classes outside a bucket's largest
    component need a comparison with the others. Both sides are dealt into
    blocks of about ``BLOCK_SHINGLES``, each pair of blocks is one small task,
    and one link per component is all that leaves it.
    """
    counts = rest.groupBy("bucket", "component").agg(
        F.count(F.lit(1)).alias("k"), F.sum("n").alias("shingles")
    )
    share = F.struct("k", "component")
    open_buckets = (
        counts.groupBy("bucket")
        .agg(
            F.count(F.lit(1)).alias("parts"),
            F.max_by("component", share).alias("main"),
            F.sum("shingles").alias("all"),
            F.max_by("shingles", share).alias("in_main"),
        )
        .filter("parts > 1")
        .select(
            "bucket",
            "main",
            F.ceil(F.col("all") / BLOCK_SHINGLES).alias("blocks"),
            F.ceil((F.col("all") - F.col("in_main")) / BLOCK_SHINGLES).alias("chunks"),
        )
    )
    place = F.xxhash64("class")
    everywhere = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.col(n) - 1))
    entered = rest.join(open_buckets, "bucket")
    kept = ["bucket", "class", "component"]
    stay = entered.select(
        *kept,
        F.pmod(place, F.col("blocks")).alias("block"),
        everywhere("chunks").alias("chunk"),
        F.lit(False).alias("asks"),
    )
    asking = entered.filter(F.col("component") != F.col("main")).select(
        *kept,
        everywhere("blocks").alias("block"),
        F.pmod(place, F.col("chunks")).alias("chunk"),
        F.lit(True).alias("asks"),
    )

    def linked(rows: pa.Table) -> pa.Table:
        return _linked_blocks(rows, threshold)

    return (
        stay.unionByName(asking)
        .join(sets, "class")
        .groupBy("bucket", "block", "chunk")
        .applyInArrow(linked, "x binary, y binary")
        .distinct()
    )


def _linked_blocks(rows: pa.Table, threshold: int = THRESHOLD) -> pa.Table:
    """Components (x, y) with a link between the asking rows and the others."""
    components_, asks = rows["component"].to_pylist(), rows["asks"].to_pylist()
    column = rows["shingles"].combine_chunks()
    lists = [column[i].values.to_numpy() for i in range(len(column))]
    others = [i for i, a in enumerate(asks) if not a]
    sizes = np.array([len(lists[i]) for i in others], np.int64)
    owner = np.repeat(np.arange(len(others)), sizes)
    content = np.concatenate([lists[i] for i in others]) if others else np.empty(0, np.int64)
    order = np.argsort(content, kind="stable")
    content, owner = content[order], owner[order]
    labels = np.array([hash(components_[i]) for i in others], np.int64)
    found = set()
    for i in (i for i, a in enumerate(asks) if a):
        own = lists[i]
        low = np.searchsorted(content, own, "left")
        lengths = np.searchsorted(content, own, "right") - low
        steps = np.arange(lengths.sum()) - np.repeat(np.cumsum(lengths) - lengths, lengths)
        both = np.bincount(owner[np.repeat(low, lengths) + steps], minlength=len(others))
        linked = 100 * both >= threshold * (sizes + len(own) - both)
        linked &= labels != hash(components_[i])
        for j in np.flatnonzero(linked):
            found.add((components_[i], components_[others[j]]))
    pairs = list(found)
    return pa.table(
        {
            "x": pa.array([x for x, _ in pairs], pa.binary()),
            "y": pa.array([y for _, y in pairs], pa.binary()),
        }
    )


def _against(members: DataFrame, leaders: DataFrame, threshold: int) -> DataFrame:
    """Distinct pairs of leaders with the members of their buckets, a < b,
    without those whose sizes alone rule out a link."""
    other = F.col("leader.class")
    sizes = F.array("n", "leader.n")
    fits = (F.col("class") != other) & (100 * F.array_min(sizes) >= threshold * F.array_max(sizes))
    return (
        members.join(leaders, "bucket")
        .filter(fits)
        .select(F.least("class", other).alias("a"), F.greatest("class", other).alias("b"))
        .distinct()
    )


def without_near_duplicates(docs: DataFrame, threshold: int = THRESHOLD) -> DataFrame:
    """One document of each component: the one with the smallest doc_id.

    Of several rows with that doc_id the one with the least text digest stays;
    of rows equal in both, any one. Documents without words all stay, but for
    rows equal in doc_id and text.
    """
    found = near_duplicates(docs, threshold).filter("kept")
    keeper = F.min(F.struct("doc_id", "digest")).alias("keeper")
    alone = F.when(F.col("component").isNull(), F.struct("doc_id", "digest"))
    keepers = found.groupBy("component", alone.alias("alone")).agg(keeper).select("keeper.*")
    keepers = step(keepers.toDF("keep_id", "keep_digest"), "keepers")
    names = docs.columns
    rows = docs.select(
        F.struct(*names).alias("document"),
        F.col("doc_id").cast("long").alias("row_id"),
        F.md5(text_of(F.col("text").cast("string"))).alias("row_digest"),
    )
    same = (F.col("row_digest") == F.col("keep_digest")) & F.col("row_id").eqNullSafe(F.col("keep_id"))
    copies = Window.partitionBy("row_digest", "row_id").orderBy(F.lit(0))
    return (
        rows.join(keepers, same, "left_semi")
        .withColumn("copy", F.row_number().over(copies))
        .filter(F.col("copy") == 1)
        .select("document.*")
    )
