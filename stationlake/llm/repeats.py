"""Removal of long repeated byte strings by distributed suffix sorting.

Every byte goes that is covered by a ``LENGTH``-byte string which also starts
anywhere else. Sorting all suffixes is not needed to find them: each such string
has an anchor, the first of its ``CORE``-byte substrings with the least hash, and
equal strings have it at the same place. All strings with one anchor form a
segment, a few hundred bytes of text. Segments that occur more than once are
repeats as a whole; segments whose anchors agree while they differ are compared:

* Each task sorts its segments twice, as suffixes from the anchor on and as
  reversed prefixes before it, and front-codes the sorted runs.
* Runs are cut at splitters taken from a sample, exchanged, and merged by loser
  trees that never compare a known common prefix again. The merge yields how far
  neighbours agree.
* A segment's strings reach at most as far as its best neighbour to the right and
  its best one to the left. If one and the same neighbour reaches both, that
  settles it. Where it does not (one variant shares what follows, another what
  goes before), the strings in question are hashed and counted.

A segment is exchanged once, however many copies it has, so a passage in a third
of all documents is one string. NULL texts are empty. Rows equal in doc_id and
text are repeats of each other. Texts are bytes of UTF-8; what is kept of one may
end within a character, so it is binary.
"""

from __future__ import annotations

import bisect
import struct

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stationlake.llm.common import forget, step, text_of
from stationlake.llm.hashing import Powers, blocks, part_hashes, sums, text_bytes
from stationlake.llm.runs import common, front_coded, merged

LENGTH = 400
CORE = 64
PART_BYTES = 16 << 20
SAMPLE_PER_PART = 24
_WINDOW = LENGTH - CORE + 1
_CHUNK = 8 << 20
_PLACE = np.uint64((1 << 24) - 1)
_ID = "<qqHH"
_BLOCK = 1 << 20
#: A range is kept as one number: its start times this, plus its length.
_SPAN = 1 << 16


# --- anchors ----------------------------------------------------------------


def _sliding_least(x: np.ndarray, width: int) -> np.ndarray:
    """The least of every ``width`` neighbours, from running minima of blocks."""
    full = -(-len(x) // width) * width
    padded = np.full(full, np.iinfo(np.uint64).max, np.uint64)
    padded[: len(x)] = x
    table = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(table, axis=1).ravel()
    behind = np.minimum.accumulate(table[:, ::-1], axis=1)[:, ::-1].ravel()
    n = len(x) - width + 1
    return np.minimum(behind[:n], ahead[width - 1 : width - 1 + n])


def _pieces(texts: list[bytes]):
    """(text number, offset, bytes) with pieces of long texts overlapping so that
    every string lies in exactly one."""
    for i, text in enumerate(texts):
        for at in range(0, max(1, len(text) - LENGTH + 1), _CHUNK):
            piece = text[at : at + _CHUNK + LENGTH - 1]
            if len(piece) >= LENGTH:
                yield i, at, piece


def segments_of(texts: list[bytes], powers: Powers) -> dict[str, np.ndarray]:
    """All segments: row (text), start, strings (how many), anchor (offset in
    the segment), and hashes of the core and of the whole segment, which
    together name the segment by 128 bits."""
    pieces = list(_pieces(texts))
    names = ["row", "start", "strings", "anchor", "core", "segment"]
    found: list[list[np.ndarray]] = []
    for part in blocks(np.array([len(p) for _, _, p in pieces]), _BLOCK):
        chosen = pieces[part]
        data = np.frombuffer(b"".join(p for _, _, p in chosen), np.uint8)
        lengths = np.array([len(p) for _, _, p in chosen])
        begins = np.cumsum(lengths) - lengths
        total = sums(data, powers)
        grams = np.arange(len(data) - CORE + 1)
        cores = part_hashes(total, grams, grams + CORE, powers)
        least = _sliding_least((cores & ~_PLACE) | grams.astype(np.uint64), _WINDOW)
        anchors = (least & _PLACE).astype(np.int64)
        places = np.concatenate(
            [np.arange(b, b + n - LENGTH + 1) for b, n in zip(begins, lengths, strict=True)]
        )
        own = anchors[places]
        new = np.r_[True, (own[1:] != own[:-1]) | (places[1:] != places[:-1] + 1)]
        first = places[new]
        strings = np.diff(np.r_[np.flatnonzero(new), len(places)])
        owner = np.searchsorted(begins, first, "right") - 1
        ends = first + strings - 1 + LENGTH
        found.append(
            [
                np.array([i for i, _, _ in chosen])[owner],
                first - begins[owner] + np.array([at for _, at, _ in chosen])[owner],
                strings,
                own[new] - first,
                cores[own[new]].view(np.int64),
                part_hashes(total, first, ends, powers).view(np.int64),
            ]
        )
    columns = [np.concatenate(c) for c in zip(*found, strict=True)] if found else [np.empty(0, np.int64)] * 6
    return dict(zip(names, columns, strict=True))


def _anchored(batches):
    powers = Powers()
    for batch in batches:
        found = segments_of(text_bytes(batch["text"]), powers)
        rows = pa.array(found.pop("row"))
        yield pa.record_batch(
            {"doc_id": batch["doc_id"].take(rows), "digest": batch["digest"].take(rows)}
            | {name: pa.array(column.astype(np.int64)) for name, column in found.items()}
        )


def _keyed(docs: DataFrame) -> DataFrame:
    text = F.col("text").cast("string")
    return docs.select(
        F.col("doc_id").cast("long"), F.xxhash64(text_of(text)).alias("digest"), text.alias("text")
    )


_ANCHORS = (
    "doc_id long, digest long, start long, strings long, anchor long, core long, segment long"
)
_SEGMENT = ["core", "segment"]


# --- segments that differ: sort, exchange, merge -----------------------------


def _cut_out(batches):
    """The bytes of asked segments."""
    names = [*_SEGMENT, "anchor", "strings", "bytes"]
    kinds = [pa.int64()] * 4 + [pa.binary()]
    for batch in batches:
        rows = [
            (w["core"], w["segment"], w["anchor"], w["strings"],
             text[w["start"] : w["start"] + w["strings"] - 1 + LENGTH])
            for text, wanted in zip(text_bytes(batch["text"]), batch["asked"].to_pylist(), strict=True)
            for w in wanted
        ]
        columns = list(zip(*rows, strict=True)) or [()] * 5
        yield pa.record_batch({n: pa.array(c, k) for n, c, k in zip(names, columns, kinds, strict=True)})


def _order_key(core: int, anchor: int, data: bytes, order: int) -> bytes:
    """Order 0: what follows the anchor first; order 1: what goes before it, reversed."""
    ahead, behind = data[anchor:], data[:anchor][::-1]
    return struct.pack("<q", core) + (ahead + behind if order == 0 else behind + ahead)


def _samples(share: float):
    bar = int(share * (1 << 32))

    def run(batches):
        for batch in batches:
            keys = [
                (order, _order_key(r["core"], r["anchor"], r["bytes"], order))
                for r in batch.to_pylist()
                if (r["segment"] & 0xFFFFFFFF) < bar
                for order in (0, 1)
            ]
            yield pa.record_batch(
                {
                    "order": pa.array([o for o, _ in keys], pa.int32()),
                    "key": pa.array([k for _, k in keys], pa.binary()),
                }
            )

    return run


def _sorted_runs(splitters: list[list[bytes]]):
    """One front-coded run per batch, order and range."""

    def run(batches):
        task = TaskContext.get()
        partition = task.partitionId() if task else 0
        for number, batch in enumerate(batches):
            slots: dict[int, list[tuple[bytes, bytes]]] = {}
            for r in batch.to_pylist():
                payload = struct.pack(_ID, r["core"], r["segment"], r["anchor"], r["strings"])
                for order in (0, 1):
                    key = _order_key(r["core"], r["anchor"], r["bytes"], order)
                    part = bisect.bisect_right(splitters[order], key)
                    slots.setdefault(2 * part + order, []).append((key, payload))
            yield pa.record_batch(
                {
                    "slot": pa.array(list(slots), pa.int64()),
                    "run": pa.array([(partition << 20) + number] * len(slots), pa.int64()),
                    "data": pa.array([front_coded(sorted(v)) for v in slots.values()], pa.binary()),
                }
            )

    return run


class _Neighbours:
    """What a segment shares with those before and after it in one order."""

    def __init__(self, order: int):
        self.order, self.last, self.rows = order, None, []

    def add(self, key: bytes, shared: int, payload: bytes) -> None:
        core, segment, anchor, strings = struct.unpack(_ID, payload)
        item = {"key": key, "id": (core, segment), "anchor": anchor, "strings": strings, "reach": 0, "sure": []}
        last = self.last
        if last and last["id"] == item["id"]:
            return
        if last and last["id"][0] == core:
            self._pair(last, item, shared)
        if last:
            self.rows.append(last)
        self.last = item

    def _pair(self, a: dict, b: dict, shared: int) -> None:
        def halves(x):
            split = 8 + (len(x["key"]) - 8 - x["anchor"] if self.order == 0 else x["anchor"])
            return x["key"][8:split], x["key"][split:]

        (a1, a2), (b1, b2) = halves(a), halves(b)
        first = min(shared - 8, len(a1), len(b1))
        other = common(a2, b2)
        right, left = (first, other) if self.order == 0 else (other, first)
        for x in (a, b):
            x["reach"] = max(x["reach"], first)
            # Strings that start ``d`` before the anchor, LENGTH - right <= d <= left.
            low, high = max(LENGTH - right, x["anchor"] - x["strings"] + 1), min(left, x["anchor"])
            if low <= high:
                x["sure"].append((x["anchor"] - high, x["anchor"] - low))

    def finished(self) -> list[dict]:
        return self.rows + ([self.last] if self.last else [])


_MERGED = (
    "slot long, core long, segment long, anchor long, strings long, order int, reach long, "
    "sure array<struct<low:long,high:long>>, edge binary"
)


def _as_rows(slot: int | None, order: int, items: list[dict], edges: bool) -> pa.Table:
    n = len(items)
    keep = {0, n - 1} if edges else set()
    return pa.table(
        {
            "slot": pa.array([slot] * n, pa.int64()),
            "core": pa.array([x["id"][0] for x in items], pa.int64()),
            "segment": pa.array([x["id"][1] for x in items], pa.int64()),
            "anchor": pa.array([x["anchor"] for x in items], pa.int64()),
            "strings": pa.array([x["strings"] for x in items], pa.int64()),
            "order": pa.array([order] * n, pa.int32()),
            "reach": pa.array([x["reach"] for x in items], pa.int64()),
            "sure": pa.array(
                [[{"low": a, "high": b} for a, b in x["sure"]] for x in items],
                pa.list_(pa.struct([("low", pa.int64()), ("high", pa.int64())])),
            ),
            "edge": pa.array([x["key"] if i in keep else None for i, x in enumerate(items)], pa.binary()),
        }
    )


def _merge_slot(rows: pa.Table) -> pa.Table:
    slot = rows["slot"][0].as_py()
    found = _Neighbours(slot % 2)
    for key, shared, payload in merged(rows["data"].to_pylist()):
        found.add(key, shared, payload)
    return _as_rows(slot, slot % 2, found.finished(), True)


def neighbours(segments: DataFrame) -> DataFrame:
    """Per segment and order: ``reach``, how far it agrees with any other, and
    ``sure``, ranges of its strings that a neighbour has too."""
    spark = segments.sparkSession
    sizes = segments.agg(F.count(F.lit(1)), F.sum(F.length("bytes"))).first()
    parts = max(1, -(-(sizes[1] or 0) // PART_BYTES))
    splitters: list[list[bytes]] = [[], []]
    if parts > 1:
        share = min(1.0, parts * SAMPLE_PER_PART / sizes[0])
        drawn = segments.mapInArrow(_samples(share), "order int, key binary").collect()
        for order in (0, 1):
            keys = sorted(r["key"] for r in drawn if r["order"] == order)
            splitters[order] = [keys[i * len(keys) // parts] for i in range(1, parts)] if keys else []
    runs = segments.mapInArrow(_sorted_runs(splitters), "slot long, run long, data binary")
    found = step(runs.groupBy("slot").applyInArrow(_merge_slot, _MERGED), "merged-runs")
    # Neighbours across a range's end: two rows of a range come here.
    ends = found.filter("edge IS NOT NULL").select("slot", *_SEGMENT, "anchor", "strings", "edge").collect()
    extra = []
    for order in (0, 1):
        across = _Neighbours(order)
        for r in sorted((r for r in ends if r["slot"] % 2 == order), key=lambda r: (r["edge"])):
            payload = struct.pack(_ID, r["core"], r["segment"], r["anchor"], r["strings"])
            last = across.last
            across.add(r["edge"], common(last["key"], r["edge"]) if last else 0, payload)
        extra.append(_as_rows(None, order, across.finished(), False))
    joined = spark.createDataFrame(pa.concat_tables(extra), _MERGED) if parts > 1 else None
    return found.unionByName(joined) if joined is not None else found


# --- strings that neighbours leave open --------------------------------------


def _string_hashes(batches):
    """A hash of every string in question; its core makes that 128 bits. Those
    that a neighbour settled are marked: others may equal them."""
    powers = Powers()
    for batch in batches:
        rows = batch.to_pylist()
        for part in blocks(np.array([len(r["bytes"]) for r in rows], np.int64), _BLOCK):
            chosen = rows[part]
            data = np.frombuffer(b"".join(r["bytes"] for r in chosen), np.uint8)
            lengths = np.array([len(r["bytes"]) for r in chosen])
            counts = np.array([r["high"] - r["low"] + 1 for r in chosen])
            owner = np.repeat(np.arange(len(chosen)), counts)
            at = np.concatenate([np.arange(r["low"], r["high"] + 1) for r in chosen])
            start = (np.cumsum(lengths) - lengths)[owner] + at
            hashes = part_hashes(sums(data, powers), start, start + LENGTH, powers)
            known = np.zeros(len(at), bool)
            for r, end, n in zip(chosen, np.cumsum(counts), counts, strict=True):
                for s in r["sure"]:
                    first = max(s["low"] - r["low"], 0)
                    known[end - n + first : end - n + max(first, min(s["high"] - r["low"] + 1, n))] = True
            yield pa.record_batch(
                {
                    "core": pa.array(np.array([r["core"] for r in chosen])[owner]),
                    "segment": pa.array(np.array([r["segment"] for r in chosen])[owner]),
                    "at": pa.array(at),
                    "hash": pa.array(hashes.view(np.int64)),
                    "known": pa.array(known),
                }
            )


def _repeated_strings(segments: DataFrame) -> DataFrame:
    """core, segment, low, high: ranges of strings of these segments, by
    their place in the segment, that another of them has too."""
    near = neighbours(segments)
    reach = lambda order: F.coalesce(F.max(F.when(F.col("order") == order, F.col("reach"))), F.lit(0))
    known = step(
        near.groupBy(*_SEGMENT)
        .agg(
            F.first("anchor").alias("anchor"),
            F.first("strings").alias("strings"),
            reach(0).alias("right"),
            reach(1).alias("left"),
            F.flatten(F.collect_list("sure")).alias("sure"),
        )
        .withColumns(
            {
                # Places in the segment of the strings that may have a partner.
                "low": F.greatest(F.col("anchor") - F.col("left"), F.lit(0)),
                "high": F.least(F.col("anchor") - LENGTH + F.col("right"), F.col("strings") - 1),
            }
        ),
        "segment-reach",
    )
    sure = known.select(*_SEGMENT, F.explode("sure").alias("s")).select(*_SEGMENT, "s.low", "s.high")
    # Settled if one range of a neighbour is all that is possible.
    settled = (F.col("low") > F.col("high")) | F.exists(
        "sure", lambda s: (s["low"] <= F.col("low")) & (s["high"] >= F.col("high"))
    )
    open_cores = known.filter(~settled).select("core").distinct()
    asked = (
        known.filter("low <= high")
        .join(open_cores, "core", "left_semi")
        .select(*_SEGMENT, "low", "high", "sure")
        .join(segments.select(*_SEGMENT, "bytes"), _SEGMENT)
    )
    hashed = asked.mapInArrow(_string_hashes, "core long, segment long, at long, hash long, known boolean")
    twice = (
        hashed.groupBy("core", "hash")
        .agg(F.count(F.lit(1)).alias("n"))
        .filter("n > 1")
        .select("core", "hash")
    )
    more = hashed.filter(~F.col("known")).join(twice, ["core", "hash"], "left_semi").select(
        *_SEGMENT, F.col("at").alias("low"), F.col("at").alias("high")
    )
    return sure.unionByName(more)


# --- the operator -----------------------------------------------------------


def repeated_ranges(docs: DataFrame) -> DataFrame:
    """doc_id, digest (a hash of the text), ranges: byte ranges to remove, as
    numbers (see ``_SPAN``)."""
    keyed = _keyed(docs)
    anchors = step(keyed.mapInArrow(_anchored, _ANCHORS), "anchors")
    distinct = step(
        anchors.groupBy(*_SEGMENT).agg(
            F.count(F.lit(1)).alias("n"),
            F.min(F.struct("doc_id", "digest", "start", "strings", "anchor")).alias("sample"),
        ),
        "distinct-segments",
    )
    variants = distinct.groupBy("core").agg(F.count(F.lit(1)).alias("k")).filter("k > 1").select("core")
    wanted = (
        distinct.join(variants, "core", "left_semi")
        .groupBy(F.col("sample.doc_id").alias("i"), F.col("sample.digest").alias("d"))
        .agg(
            F.collect_list(
                F.struct(*_SEGMENT, "sample.anchor", "sample.strings", "sample.start")
            ).alias("asked")
        )
    )
    same = keyed["doc_id"].eqNullSafe(F.col("i")) & (keyed["digest"] == F.col("d"))
    segments = step(
        keyed.join(wanted, same)
        .select("text", "asked")
        .mapInArrow(
            _cut_out, "core long, segment long, anchor long, strings long, bytes binary"
        ),
        "segments",
    )
    whole = distinct.filter("n > 1").select(
        *_SEGMENT, F.lit(0).cast("long").alias("low"), (F.col("sample.strings") - 1).alias("high")
    )
    ranges = whole.unionByName(_repeated_strings(segments)).distinct()
    low = F.col("start") + F.col("low")
    length = F.col("high") - F.col("low") + LENGTH
    found = step(
        anchors.select("doc_id", "digest", "start", *_SEGMENT)
        .join(ranges, _SEGMENT)
        .select("doc_id", "digest", (low * _SPAN + length).alias("range"))
        .groupBy("doc_id", "digest")
        .agg(F.collect_list("range").alias("ranges")),
        "repeated-ranges",
    )
    forget(anchors, distinct, segments)
    return found


def united(ranges) -> list[tuple[int, int]]:
    """Ranges as (low, end), overlapping or touching ones made one."""
    out: list[list[int]] = []
    for low, length in (divmod(r, _SPAN) for r in sorted(ranges)):
        end = low + length
        if out and low <= out[-1][1]:
            out[-1][1] = max(out[-1][1], end)
        else:
            out.append([low, end])
    return [(a, b) for a, b in out]


def _kept(batches):
    for batch in batches:
        rows = []
        for text, ranges in zip(text_bytes(batch["text"]), batch["ranges"].to_pylist(), strict=True):
            gone = united(ranges or [])
            starts, ends = [0, *(b for _, b in gone)], [*(a for a, _ in gone), len(text)]
            kept = b"".join(text[a:b] for a, b in zip(starts, ends, strict=True))
            rows.append((len(text), len(text) - len(kept), len(gone), kept))
        n, removed, spans, kept = zip(*rows, strict=True) if rows else ((),) * 4
        yield pa.record_batch(
            {
                "doc_id": batch["doc_id"],
                "n_bytes": pa.array(n, pa.int64()),
                "n_removed": pa.array(removed, pa.int64()),
                "n_spans": pa.array(spans, pa.int64()),
                "kept": pa.array(kept, pa.binary()),
            }
        )


def without_repeats(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans and the kept bytes of every document."""
    ranges = repeated_ranges(docs).toDF("i", "d", "ranges")
    keyed = _keyed(docs)
    same = keyed["doc_id"].eqNullSafe(ranges["i"]) & (keyed["digest"] == ranges["d"])
    return (
        keyed.join(ranges, same, "left")
        .select("doc_id", "text", "ranges")
        .mapInArrow(_kept, "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary")
    )


def repeats(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256."""
    return without_repeats(docs).withColumn("kept_sha256", F.sha2("kept", 256)).drop("kept")
