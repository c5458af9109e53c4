"""Document fingerprints: the K smallest shingle hashes of a text.

Shingles are five words, A-Z lower-cased; a shorter text is one shingle. Hashes
are 63-bit numbers. Two sketches give the sketch of the union by merging, and
from it estimates of resemblance, containment and the number of distinct
shingles; they are exact where a text has no more than K. Equal texts have equal
fingerprints. A NULL or empty text has the empty fingerprint, which is like
itself (1) and unlike any other (0).

``edited`` pairs every document with the next one in descending doc_id (NULL
last, then by digest of the text; after the last comes the first) without
sorting all in one task: rows are dealt by ranges of doc_id, and the first row
of each range is also sent to the range before it.
"""

from __future__ import annotations

import base64
import hashlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stationlake.llm.hashing import Powers, blocks, shingle_sets, text_bytes

K = 64
RANGES_PER_TASK = 4


def sketches_of(texts: list[bytes], powers: Powers) -> list[np.ndarray]:
    """The bottom-K sketches of many texts, ascending."""
    found = []
    for part in blocks(np.array([len(t) for t in texts], np.int64)):
        found += [s[:K] >> np.uint64(1) for s in shingle_sets(texts[part], powers)]
    return found


def merge(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The sketch of the union."""
    return np.union1d(a, b)[:K]


def resemblance(a: np.ndarray, b: np.ndarray) -> float:
    """Estimated Jaccard similarity: what of the union's sketch is in both."""
    union = merge(a, b)
    if not len(union):
        return 1.0
    both = np.isin(union, a, assume_unique=True) & np.isin(union, b, assume_unique=True)
    return float(both.sum() / len(union))


def distinct_shingles(a: np.ndarray) -> float:
    """Estimated number of distinct shingles."""
    return float(len(a)) if len(a) < K else (K - 1) * 2.0**63 / float(a[-1])


def containment(a: np.ndarray, b: np.ndarray) -> float:
    """Estimated share of a's shingles that b has too."""
    if not len(a):
        return 1.0
    like, n, m = resemblance(a, b), distinct_shingles(a), distinct_shingles(b)
    return min(1.0, like / (1 + like) * (n + m) / n)


def as_text(sketch: np.ndarray) -> str:
    return base64.b64encode(sketch.astype(">u8").tobytes()).decode()


def _sketched(batches):
    powers = Powers()
    for batch in batches:
        found = sketches_of(text_bytes(batch["text"]), powers)
        yield pa.record_batch(
            {
                "doc_id": batch["doc_id"],
                "sketch": pa.array([s.view(np.int64) for s in found], pa.list_(pa.int64())),
                "fingerprint": pa.array(map(as_text, found), pa.string()),
            }
        )


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id, sketch (ascending hashes) and fingerprint (the same as text)."""
    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return rows.mapInArrow(_sketched, "doc_id long, sketch array<long>, fingerprint string")


def merged(sketched: DataFrame, *parts: str) -> DataFrame:
    """The sketch of each part of a corpus, from those of its documents.

    Only the K smallest hashes of a part leave a task.
    """
    rank = F.row_number().over(Window.partitionBy(*parts).orderBy("hash"))
    hashes = sketched.select(*parts, F.explode("sketch").alias("hash")).distinct()
    least = hashes.withColumn("rank", rank).filter(F.col("rank") <= K)
    sketch = F.array_sort(F.collect_list("hash"))
    distinct = F.when(F.size("sketch") < K, F.size("sketch").cast("double")).otherwise(
        (K - 1) * 2.0**63 / F.element_at("sketch", -1)
    )
    return least.groupBy(*parts).agg(sketch.alias("sketch")).withColumn("n_shingles", distinct)


def estimated_resemblance(a: Column, b: Column) -> Column:
    """``resemblance`` of two sketch columns."""
    union = F.slice(F.array_sort(F.array_union(a, b)), 1, K)
    both = F.size(F.array_intersect(F.array_intersect(union, a), b))
    return F.when(F.size(union) == 0, 1.0).otherwise(both / F.size(union))


# --- a document and its edited text -----------------------------------------


def _dealt(splits: np.ndarray, heads: dict[int, int | None]):
    """Per row the ranges it goes to: twice its own range, and for the first
    document of a range also twice the range before it plus one."""
    ranges = sorted(heads)
    before = dict(zip(ranges, [ranges[-1], *ranges[:-1]], strict=True)) if ranges else {}

    def run(ids: pd.Series) -> pd.Series:
        return pd.Series(
            [
                [2 * r, 2 * before[r] + 1] if (None if pd.isna(i) else int(i)) == heads[r] else [2 * r]
                for i, r in zip(ids, _ranges(splits, ids), strict=True)
            ]
        )

    return run


def _ranges(splits: np.ndarray, ids: pd.Series) -> list[int]:
    """Ranges count from the largest doc_id down; NULL is the last."""
    return [
        len(splits) + 1 if pd.isna(i) else len(splits) - int(np.searchsorted(splits, int(i), "left"))
        for i in ids
    ]


def _range_of(splits: np.ndarray):
    def run(ids: pd.Series) -> pd.Series:
        return pd.Series(_ranges(splits, ids), dtype="int64")

    return run


def _edited(batches):
    """Rows in order within their ranges; a range ends with the row after it."""
    powers = Powers()
    held = None  # the row whose next one has not come yet
    for batch in batches:
        rows = list(
            zip(
                batch["slot"].to_pylist(), batch["doc_id"].to_pylist(), batch["text"].to_pylist(), strict=True
            )
        )
        rows = [(slot, i, text or "") for slot, i, text in rows]
        rows = [held, *rows] if held else rows
        pairs = []
        for (slot, i, text), (_, _, following) in zip(rows, rows[1:], strict=False):
            if slot % 2 == 0:
                swapped = len(text) // 3
                edited = text[: len(text) - swapped] + following[:swapped]
                pairs.append((i, text, edited, following))
        held = rows[-1] if rows else None
        for at in range(0, len(pairs), 500):
            yield _compared(pairs[at : at + 500], powers)


def _compared(pairs, powers):
    ids, texts, edits, following = (list(x) for x in zip(*pairs, strict=True))
    own, edited, after = (sketches_of([t.encode() for t in x], powers) for x in (texts, edits, following))
    return pa.record_batch(
        {
            "doc_id": pa.array(ids, pa.int64()),
            "n_chars": pa.array([len(t) for t in texts], pa.int64()),
            "edited_sha256": pa.array(hashlib.sha256(t.encode()).hexdigest() for t in edits),
            "fingerprint": pa.array(map(as_text, own), pa.string()),
            "edited_fingerprint": pa.array(map(as_text, edited), pa.string()),
            "near_edited": pa.array(map(resemblance, own, edited), pa.float64()),
            "near_next": pa.array(map(resemblance, own, after), pa.float64()),
        }
    )


_EDITED = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string, "
    "edited_fingerprint string, near_edited double, near_next double"
)


def edited(docs: DataFrame) -> DataFrame:
    """Fingerprints of all documents and of their edited texts, and likenesses."""
    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    ranges = RANGES_PER_TASK * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    shares = [i / ranges for i in range(1, ranges)]
    found = rows.agg(F.percentile_approx("doc_id", shares, 20 * ranges)).first()[0]
    splits = np.unique(np.array(found or [], np.int64))
    range_of = F.pandas_udf(_range_of(splits), "long")
    # As many rows as there are ranges.
    firsts = rows.groupBy(range_of("doc_id").alias("range")).agg(F.max("doc_id").alias("head")).collect()
    heads = {r["range"]: r["head"] for r in firsts}
    slots = F.pandas_udf(_dealt(splits, heads), "array<long>")
    digest = F.md5(F.coalesce("text", F.lit("")))
    return (
        rows.withColumn("slot", F.explode(slots("doc_id")))
        .withColumn("digest", digest)
        .repartition(F.floor(F.col("slot") / 2))
        .sortWithinPartitions(
            F.floor(F.col("slot") / 2), F.col("slot"), F.desc_nulls_last("doc_id"), "digest"
        )
        .select("slot", "doc_id", "text")
        .mapInArrow(_edited, _EDITED)
    )
