"""Packing documents into sequences by reciprocal-capacity classes.

A document's ids are cut into pieces: full sequences first, then parts whose
lengths are a capacity divided by a whole number (2048, 1365, 1024, ...), and a
rest. A piece of length in (capacity / (k + 1), capacity / k] is of class k, and
exactly k pieces of a class share a sequence. Pieces cut to size fill it to
within k ids; a rest of class k wastes less than 1 / (k + 1) of it.

A class needs no knowledge of another and its sequences none of each other, so
workers fill them on their own: pieces are dealt into groups of about
``GROUP_ROWS`` by a hash, ranked within group and class, and every k of them
make a sequence. What is left over of a group and class, fewer than k pieces, is
ranked once more per class. At the end at most one sequence per class is short;
these few are put together first fit. A length that is a power of two needs no
padding.

NULL and empty texts have one id, the end mark. Rows equal in doc_id and text
are packed as often as they occur. Where texts are equal their pieces are too.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stationlake.llm.common import step

CAPACITY = 4096
END = 2
CUTS = 3  # parts cut to size from what is left of a document
LEAST_CUT = 64  # a shorter rest is not cut again
GROUP_ROWS = 1_000_000
GROUP_BINS = 8
WORDS_HELD = 400_000
_MARKS = ".,;:!?"


class WordTokenizer:
    """Ids of a tokenizer that never joins text across a blank or line feed.

    Each stretch between those is encoded once and kept; the store is emptied
    when full. The tokenizer's vocabulary file is a parameter.
    """

    def __init__(self, path: str, held: int = WORDS_HELD):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.held = held
        self.known: dict[str, bytes] = {"": b""}  # stretches to ids, four bytes each
        self.roots: dict[str, bytes] = {}  # words and marks they are made of
        # Bytes as the letters that byte-level vocabularies write them with.
        shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
        hidden = (b for b in range(256) if b not in shown)
        self.letters = {b: chr(256 + i) for i, b in enumerate(hidden)}

    def _stretch(self, part: str) -> bytes:
        """One stretch: letters with marks after them go straight to the model."""
        bare = part.rstrip(_MARKS)
        if not bare.isalpha() or not (bare.isascii() or (max(bare) < "ƀ" and "İ" not in bare)):
            return self._root(part, self._encoded)
        if len(bare) == len(part):
            return self._root(bare.lower(), self._word)
        return self._root(bare.lower(), self._word) + self._root(part[len(bare) :], self._encoded)

    def _root(self, text: str, encode) -> bytes:
        found = self.roots.get(text)
        if found is None:
            found = self.roots[text] = np.array(encode(text), "<u4").tobytes()
        return found

    def _word(self, low: str) -> list[int]:
        if not low.isascii():
            low = low.encode().decode("latin-1").translate(self.letters)
        return [t.id for t in self.model.tokenize(low)]

    def _encoded(self, part: str) -> list[int]:
        return self.tokenizer.encode(part, add_special_tokens=False).ids

    def ids(self, text: str) -> np.ndarray:
        known = self.known
        parts = text.replace("\n", " ").split(" ")
        for part in set(parts).difference(known):
            known[part] = self._stretch(part)
        found = np.frombuffer(b"".join(map(known.__getitem__, parts)), "<u4")
        if len(known) > self.held:
            self.known, self.roots = {"": b""}, {}
        return found


def cut(length: int, capacity: int = CAPACITY) -> list[int]:
    """Lengths of the pieces of a document, in order."""
    pieces = [capacity] * (length // capacity)
    rest = length % capacity
    for _ in range(CUTS):
        if rest < LEAST_CUT:
            break
        share = capacity // -(-capacity // rest)  # the largest share that fits
        pieces.append(share)
        rest -= share
    return pieces + [rest] * (rest > 0)


def _pieces(path: str, capacity: int, with_ids: bool):
    def run(batches):
        tokenizer = WordTokenizer(path)
        for batch in batches:
            ids, rows, starts, sizes, totals, sums, parts = batch["doc_id"], [], [], [], [], [], []
            for row, text in enumerate(batch["text"].to_pylist()):
                found = np.append(tokenizer.ids(text or ""), END).astype("<u4")
                at = 0
                for size in cut(len(found), capacity):
                    data = found[at : at + size].tobytes()
                    rows.append(row)
                    starts.append(at)
                    sizes.append(size)
                    totals.append(len(found))
                    sums.append(zlib.crc32(data))
                    if with_ids:
                        parts.append(data)
                    at += size
            columns = {
                "doc_id": ids.take(pa.array(rows, pa.int64())),
                "start": pa.array(starts, pa.int64()),
                "length": pa.array(sizes, pa.int64()),
                "ids_crc32": pa.array(sums, pa.int64()),
                "doc_tokens": pa.array(totals, pa.int64()),
            }
            if with_ids:
                columns["ids"] = pa.array(parts, pa.binary())
            yield pa.record_batch(columns)

    return run


def token_pieces(
    docs: DataFrame, vocabulary: str, capacity: int = CAPACITY, with_ids: bool = False
) -> DataFrame:
    """doc_id, start, length, ids_crc32, doc_tokens and, if asked for, the ids
    as little-endian unsigned 32-bit numbers."""
    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    schema = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"
    return rows.mapInArrow(
        _pieces(vocabulary, capacity, with_ids), schema + ", ids binary" * with_ids
    )


def packed(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Pieces with their ``sequence_id`` and ``offset``.

    ``pieces`` should be a stored table: it is counted first, to deal each class
    into groups that are small enough for a task and large against its k.
    """
    own = pieces.columns
    k = F.col("kind")
    spread = F.xxhash64("doc_id", "start", "ids_crc32")
    sorted_out = pieces.withColumns(
        {"kind": F.floor(F.lit(capacity) / F.col("length")).cast("long"), "spread": spread}
    )
    # One row per class, so never more than the capacity, and few of them.
    counts = {r["kind"]: r["n"] for r in sorted_out.groupBy("kind").agg(F.count(F.lit(1)).alias("n")).collect()}
    tasks = int(pieces.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    usual = min(GROUP_ROWS, max(1, sum(counts.values()) // (4 * tasks)))
    deals = {kind: max(1, n // max(usual, GROUP_BINS * kind)) for kind, n in counts.items()}
    most = max(deals.values(), default=1)
    deal = F.pmod(F.shiftright("spread", 8), _looked_up(k, deals))

    by_class = Window.partitionBy("kind", "deal")
    order = ["spread", "doc_id", "start", "ids_crc32", "length"]
    first = (
        sorted_out.withColumn("deal", deal)
        .withColumn("rank", F.row_number().over(by_class.orderBy(*order)) - 1)
        .withColumn("whole", F.count(F.lit(1)).over(by_class))
        .withColumn("whole", F.col("rank") < F.col("whole") - F.col("whole") % k)
    )
    left = step(
        first.filter(~F.col("whole"))
        .withColumn("deal", F.lit(most).cast("long"))
        .withColumn("rank", F.row_number().over(by_class.orderBy(*order)) - 1)
        .withColumn("whole", F.count(F.lit(1)).over(by_class))
        .withColumn("whole", F.col("rank") < F.col("whole") - F.col("whole") % k),
        "left-pieces",
    )
    # What is short now is less than one sequence per class.
    short = {
        r["kind"]: r["length"]
        for r in left.filter(~F.col("whole")).groupBy("kind").agg(F.sum("length").alias("length")).collect()
    }
    shared = _first_fit(short, capacity)
    seated = first.filter("whole").unionByName(left).withColumn("bin", F.floor(F.col("rank") / k))
    earlier = (
        Window.partitionBy("kind", "deal", "bin")
        .orderBy("rank")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    per_bin = (most + 1) * (capacity + 1)
    full = (F.col("bin") * (most + 1) + F.col("deal")) * (capacity + 1) + k
    sequence = _looked_up(k, {kind: seq * per_bin for kind, (seq, _) in shared.items()})
    base = _looked_up(k, {kind: at for kind, (_, at) in shared.items()})
    offset = F.coalesce(F.sum("length").over(earlier), F.lit(0))
    return seated.withColumns(
        {
            "sequence_id": F.when(F.col("whole"), full).otherwise(sequence).cast("long"),
            "offset": F.when(F.col("whole"), offset).otherwise(base + offset).cast("long"),
        }
    ).select(*own, "sequence_id", "offset")


def _first_fit(lengths: dict[int, int], capacity: int) -> dict[int, tuple[int, int]]:
    """Per class the shared sequence and the offset that its short one gets."""
    used: list[int] = []
    places = {}
    for kind, length in sorted(lengths.items(), key=lambda item: (-item[1], item[0])):
        at = next((i for i, n in enumerate(used) if n + length <= capacity), len(used))
        if at == len(used):
            used.append(0)
        places[kind] = (at, used[at])
        used[at] += length
    return places


def _looked_up(key: Column, values: dict[int, int]) -> Column:
    if not values:
        return F.lit(1)
    pairs = F.create_map(*(F.lit(x).cast("long") for item in sorted(values.items()) for x in item))
    return F.element_at(pairs, key)


def sequences(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """sequence_id, ids (array of int) and padding, from packed pieces with ids.

    A sequence has at most ``capacity`` ids, so its group is small. One whose
    length is a power of two is not padded.
    """
    in_order = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    joined = pieces.groupBy("sequence_id").agg(
        F.concat_ws("", F.transform(in_order, lambda p: F.hex(p["ids"]))).alias("text"),
        F.sum("length").alias("length"),
    )
    ids = F.transform(
        F.sequence(F.lit(0), F.col("length") - 1),
        lambda i: F.conv(
            F.concat(*(F.substring("text", (i * 8 + at).cast("int"), F.lit(2)) for at in (7, 5, 3, 1))), 16, 10
        ).cast("int"),
    )
    padding = F.when(F.bit_count("length") == 1, 0).otherwise(F.lit(capacity) - F.col("length"))
    return joined.select("sequence_id", ids.alias("ids"), padding.cast("long").alias("padding"))


def pack(docs: DataFrame, vocabulary: str, capacity: int = CAPACITY) -> DataFrame:
    """All documents cut, encoded and packed: one row per piece."""
    return packed(step(token_pieces(docs, vocabulary, capacity), "pieces"), capacity)
