"""Line de-duplication that can be taken back.

The state is an exact table of reference counts, ``(shard, key, refs)``: in how
many documents a line's key occurs. In front of it stands one cuckoo filter per
shard that holds the keys found in at least ``MIN_DOCUMENTS``. Adding documents
raises counts and inserts the keys that come to the threshold; deleting
documents lowers counts and deletes the keys that fall below, so a state never
depends on the way that led to it. The filters only spare lines the way to the
exact table: what they let through is looked up there.

A document is a row; a NULL or empty text is one empty line. A line's key is the
line stripped of ``[\\x20\\x09-\\x0D]`` with A-Z lower-cased, kept as a 128-bit
hash; empty keys are never counted. Rows equal in doc_id and text count as
several documents and get the same result. Extra columns stay as they are.

Counts are summed before and after the shuffle, so a frequent line is one row
per task. Filters travel to the tasks only while they are below
``FILTER_BYTES`` together; beyond that, all lines take the exact way.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stationlake.llm.common import WHITESPACE_BYTES, forget, step, text_of
from stationlake.llm.cuckoo import CuckooFilter, as_keys
from stationlake.llm.hashing import text_bytes

MIN_DOCUMENTS = 10
SHARD_KEYS = 100_000
FILTER_BYTES = 32 << 20
_COUNTS = "key binary, refs long"
_FILTERS = "shard long, blob binary, full boolean"


@dataclass(frozen=True)
class LineState:
    refs: DataFrame  # shard, key, refs > 0
    filters: DataFrame  # shard, blob, full
    shards: int
    min_documents: int = MIN_DOCUMENTS


def _key(line: bytes) -> bytes | None:
    bare = line.strip(WHITESPACE_BYTES).lower()
    return xxhash.xxh3_128_digest(bare) if bare else None


def _count_lines(batches):
    for batch in batches:
        counts = Counter()
        for text in text_bytes(batch["text"]):
            counts.update({_key(line) for line in text.split(b"\n")})
        counts.pop(None, None)
        yield pa.record_batch(
            {
                "key": pa.array(list(counts), pa.binary()),
                "refs": pa.array(list(counts.values()), pa.int64()),
            }
        )


def line_counts(docs: DataFrame) -> DataFrame:
    """(key, refs): in how many of these documents each key occurs."""
    counted = docs.select(F.col("text").cast("string")).mapInArrow(_count_lines, _COUNTS)
    return counted.groupBy("key").agg(F.sum("refs").alias("refs"))


def _shard(shards: int) -> Column:
    return F.pmod(F.xxhash64("key"), F.lit(shards)).alias("shard")


def _changed_filter(key, old: pd.DataFrame, changes: pd.DataFrame) -> pd.DataFrame:
    """One shard's filter after its insertions and deletions."""
    added = as_keys(list(changes.loc[changes.active, "key"]))
    removed = as_keys(list(changes.loc[~changes.active, "key"]))
    if len(old):
        cuckoo = CuckooFilter.read(old.blob.iloc[0])
        cuckoo.delete(removed)
    else:
        cuckoo = CuckooFilter.sized(len(added))
    fits = cuckoo.insert(added)
    return pd.DataFrame({"shard": [key[0]], "blob": [cuckoo.blob()], "full": [not fits]})


def _new_filter(key, keys: pd.DataFrame) -> pd.DataFrame:
    held, room = as_keys(list(keys.key)), 2 * len(keys)
    while True:
        cuckoo = CuckooFilter.sized(room)
        if cuckoo.insert(held):
            return pd.DataFrame({"shard": [key[0]], "blob": [cuckoo.blob()], "full": [False]})
        room *= 2


def empty_state(spark, shards: int = 1, min_documents: int = MIN_DOCUMENTS) -> LineState:
    refs = spark.createDataFrame([], "shard long, key binary, refs long")
    return LineState(refs, spark.createDataFrame([], _FILTERS), shards, min_documents)


def new_state(docs: DataFrame, min_documents: int = MIN_DOCUMENTS) -> LineState:
    """The state of a first load, with shards of about ``SHARD_KEYS`` keys."""
    counts = step(line_counts(docs), "line-counts")
    shards = max(1, -(-counts.filter(F.col("refs") >= min_documents).count() // SHARD_KEYS))
    state = _merged(empty_state(docs.sparkSession, shards, min_documents), counts)
    forget(counts)
    return state


def added(state: LineState, docs: DataFrame) -> LineState:
    return _merged(state, line_counts(docs))


def deleted(state: LineState, docs: DataFrame) -> LineState:
    """Takes back documents that were added before, with their texts."""
    return _merged(state, line_counts(docs).withColumn("refs", -F.col("refs")))


def _merged(state: LineState, changes: DataFrame) -> LineState:
    old = state.refs.select("key", "refs", F.lit(0).cast("long").alias("change"))
    new = changes.select("key", F.lit(0).cast("long").alias("refs"), F.col("refs").alias("change"))
    both = step(
        old.unionByName(new)
        .groupBy("key")
        .agg(F.sum("refs").alias("before"), (F.sum("refs") + F.sum("change")).alias("refs"))
        .select(_shard(state.shards), "key", "before", "refs"),
        "line-refs",
    )
    least = state.min_documents
    turned = both.filter((F.col("before") >= least) != (F.col("refs") >= least)).select(
        "shard", "key", (F.col("refs") >= least).alias("active")
    )
    changed = step(
        state.filters.groupBy("shard").cogroup(turned.groupBy("shard")).applyInPandas(_changed_filter, _FILTERS),
        "line-filters",
    )
    refs = both.filter("refs > 0").select("shard", "key", "refs")
    if not changed.filter("full").isEmpty():  # built anew, larger, from the exact table
        overfull = changed.filter("full").select("shard")
        held = refs.filter(F.col("refs") >= least).join(overfull, "shard", "left_semi")
        rebuilt = held.groupBy("shard").applyInPandas(_new_filter, _FILTERS)
        changed = step(changed.filter("NOT full").unionByName(rebuilt), "line-filters")
    return LineState(refs, changed, state.shards, least)


def _small_filters(state: LineState) -> dict[int, bytes] | None:
    """All filters, if they are small enough to send to every task."""
    total = state.filters.agg(F.sum(F.length("blob"))).first()[0] or 0
    if total > FILTER_BYTES:
        return None
    return {row.shard: row.blob for row in state.filters.select("shard", "blob").collect()}


def _suspects(filters: dict[int, bytes] | None):
    """Lines that may be frequent: one row per document and key, with places."""

    def run(batches):
        table = None if filters is None else {k: CuckooFilter.read(b) for k, b in filters.items()}
        for batch in batches:
            ids, digests = batch["doc_id"], batch["digest"]
            rows, keys, places = [], [], []
            for row, text in enumerate(text_bytes(batch["text"])):
                found: dict[bytes, list[int]] = {}
                for place, line in enumerate(text.split(b"\n")):
                    key = _key(line)
                    if key is not None:
                        found.setdefault(key, []).append(place)
                rows += [row] * len(found)
                keys += found
                places += found.values()
            if table is not None and keys:
                packed, maybe = as_keys(keys), np.zeros(len(keys), bool)
                for cuckoo in table.values():
                    maybe |= cuckoo.contains(packed)
                kept = np.flatnonzero(maybe)
                rows, keys, places = ([x[i] for i in kept] for x in (rows, keys, places))
            at = pa.array(rows, pa.int64())
            yield pa.record_batch(
                {
                    "doc_id": ids.take(at),
                    "digest": digests.take(at),
                    "key": pa.array(keys, pa.binary()),
                    "places": pa.array(places, pa.list_(pa.int32())),
                }
            )

    return run


def _without_lines(texts: pd.Series, places: pd.Series) -> pd.DataFrame:
    rows = []
    for text, dropped in zip(texts, places, strict=True):
        lines = text.split("\n")
        if dropped is None:
            rows.append((len(lines), 0, text))
        else:
            gone = set(dropped)
            left = [line for i, line in enumerate(lines) if i not in gone]
            rows.append((len(lines), len(lines) - len(left), "\n".join(left)))
    return pd.DataFrame(rows, columns=["n_lines", "n_dropped", "kept"])


def cleaned(docs: DataFrame, state: LineState) -> DataFrame:
    """All columns of the documents in a struct ``document``, and ``lines``:
    n_lines, n_dropped and the kept text."""
    frequent = state.refs.filter(F.col("refs") >= state.min_documents).select("key")
    identity = [
        F.col("doc_id").cast("string").alias("doc_id"),
        F.md5(text_of(F.col("text").cast("string"))).alias("digest"),
    ]
    suspects = docs.select(*identity, F.col("text").cast("string")).mapInArrow(
        _suspects(_small_filters(state)), "doc_id string, digest string, key binary, places array<int>"
    )
    dropped = step(
        suspects.join(frequent, "key")
        .groupBy("doc_id", "digest")
        .agg(F.flatten(F.collect_set("places")).alias("places")),
        "dropped-lines",
    )
    rows = docs.select(F.struct(*docs.columns).alias("document"), *identity)
    same = rows["doc_id"].eqNullSafe(dropped["doc_id"]) & (rows["digest"] == dropped["digest"])
    text = text_of(F.col("document.text").cast("string"))
    without_lines = F.pandas_udf(_without_lines, "n_lines long, n_dropped long, kept string")
    return rows.join(dropped, same, "left").select(
        "document", without_lines(text, F.col("places")).alias("lines")
    )


def line_dedup(docs: DataFrame, min_documents: int = MIN_DOCUMENTS) -> DataFrame:
    """Per document: doc_id, n_lines, n_dropped, kept_sha256."""
    return cleaned(docs, new_state(docs, min_documents)).select(
        "document.doc_id",
        "lines.n_lines",
        "lines.n_dropped",
        F.sha2("lines.kept", 256).alias("kept_sha256"),
    )


def without_frequent_lines(docs: DataFrame, min_documents: int = MIN_DOCUMENTS) -> DataFrame:
    """The documents with their frequent lines removed; n_chars follows the text.

    A document whose text is NULL stays as it is; no document goes.
    """
    found = cleaned(docs, new_state(docs, min_documents))
    kept = F.when(F.col("document.text").isNotNull(), F.col("lines.kept"))
    changed = F.col("lines.n_dropped") > 0
    own = {"text": kept}
    if "n_chars" in docs.columns:
        own["n_chars"] = F.when(changed, F.length(kept).cast("long")).otherwise(F.col("document.n_chars"))
    return found.select(*(own.get(c, F.col(f"document.`{c}`")).alias(c) for c in docs.columns))


ORACLE = """
WITH lines AS (
  SELECT rowid AS r, doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS place
  FROM (SELECT row_number() OVER () AS rowid, * FROM documents)),
keyed AS (
  SELECT *, translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM lines),
frequent AS (
  SELECT key FROM keyed WHERE key <> '' GROUP BY key HAVING count(DISTINCT r) >= 10)
SELECT doc_id, count(*) AS n_lines, count(f.key) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (f.key IS NULL), '')) AS kept_sha256
FROM keyed LEFT JOIN frequent f USING (key) GROUP BY r, doc_id
"""
