"""Alignment of two tokenizers over the same bytes.

Both tokenizers cut a text's bytes into tokens. Where tokens of both end at the
same byte, the text has a shared cut; the tokens between two neighbouring cuts
are a group. Cuts are found by divide and conquer: of an interval between two
known cuts take the token in the middle, bisect the other side's ends for it,
and go on to its neighbours until a common end turns up; both halves are then
intervals of their own. An interval in which no common end is found is a leaf:
one group. All intervals of many texts are halved together, in arrays.

A link is a pair of tokens, one of each tokenizer, whose bytes end together. As
tokens have at least one byte, each cut has one link. How often the corpus links
two ids is counted by Spark; counts meet the texts again by a join in two parts:
pairs with more than 1 in ``HOT_SHARE`` of all links are fewer than that, so
they are broadcast, and no other pair is a hot key of the shuffle.

NULL and empty texts, and texts that one of the tokenizers does not give back
byte by byte, have no tokens: zeros and an empty ``groups_sha256``. Rows are
independent: repeated rows and equal or NULL doc_ids come out as often as they
come in, and all count. Ids with equal counts are all best. Other columns of the
table are not read.
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stationlake.llm.bpe_automaton import Automaton, shipped
from stationlake.llm.common import step

SPACE = "▁"
HOT_SHARE = 50_000
CHUNK_TOKENS = 200_000
PROBES = 8
RUNS_HELD = 400_000
LONGEST_HELD = 64
_RUNS = re.compile(" +[^ ]*")


class Pieces:
    """Ids and token bytes of a sentence-piece model that puts a space in front.

    If no piece has a space after another letter, merges never reach across the
    start of a run of spaces; texts are then encoded run by run, and short runs
    seen before keep their ids in a bounded store. Other models take whole texts.
    """

    def __init__(self, model: bytes, held: int = RUNS_HELD):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_proto=model)
        pieces = [self.model.id_to_piece(i) for i in range(self.model.get_piece_size())]
        self.labels = [self._label(i, p) for i, p in enumerate(pieces)]
        self.sizes = np.array([len(b) for b in self.labels], np.int64)
        self.space = self.model.piece_to_id(SPACE)
        self.by_run = not any(SPACE in p.lstrip(SPACE) for p in pieces) and self._keeps_spaces()
        self.held = held
        self.known: dict[str, bytes] = {}

    def _label(self, number: int, piece: str) -> bytes:
        if self.model.is_byte(number):
            return bytes([int(piece[3:-1], 16)])
        return piece.replace(SPACE, " ").encode()

    def _keeps_spaces(self) -> bool:
        text = "a  b   c "
        return b"".join(self.labels[i] for i in self.model.encode(text)) == f" {text}".encode()

    def encode(self, text: str) -> np.ndarray:
        # A text may have the mark for spaces itself, which starts no run.
        if not self.by_run or SPACE in text:
            return np.array(self.model.encode(text, num_threads=1), "<u4")
        runs, known = _RUNS.findall(f" {text}"), self.known
        new = list(set(runs).difference(known))
        for run, ids in zip(new, self.model.encode([r[1:] for r in new], num_threads=1), strict=True):
            known[run] = np.array(ids if run != " " else [self.space], "<u4").tobytes()
        found = np.frombuffer(b"".join(map(known.__getitem__, runs)), "<u4")
        for run in new:
            if len(run) > LONGEST_HELD:
                del known[run]
        if len(known) > self.held:
            self.known = {}
        return found


def shared_cuts(
    a: np.ndarray, b: np.ndarray, a_bounds: np.ndarray, b_bounds: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """Places in ``a`` and in ``b`` of the ends that both have.

    ``a`` and ``b`` are ascending ends of many texts behind each other; text k
    has a[a_bounds[k]:a_bounds[k + 1]] and likewise in b, at least one of each,
    and its last ends are equal.
    """
    found_a, found_b = [a_bounds[1:] - 1], [b_bounds[1:] - 1]
    # Intervals: the ends strictly between two known cuts, as half-open ranges.
    low, high, b_low, b_high = a_bounds[:-1], a_bounds[1:] - 1, b_bounds[:-1], b_bounds[1:] - 1
    while True:
        open_ones = (high > low) & (b_high > b_low)
        low, high, b_low, b_high = low[open_ones], high[open_ones], b_low[open_ones], b_high[open_ones]
        if not len(low):
            break
        cut, b_cut = _near_middle(a, b, low, high, b_low, b_high)
        split = cut >= 0
        cut, b_cut = cut[split], b_cut[split]
        found_a.append(cut)
        found_b.append(b_cut)
        low, high = np.r_[low[split], cut + 1], np.r_[cut, high[split]]
        b_low, b_high = np.r_[b_low[split], b_cut + 1], np.r_[b_cut, b_high[split]]
    cuts_a, cuts_b = np.concatenate(found_a), np.concatenate(found_b)
    return np.sort(cuts_a), np.sort(cuts_b)


def _near_middle(a, b, low, high, b_low, b_high) -> tuple[np.ndarray, np.ndarray]:
    """Of every interval the common end next to its middle token, or -1."""
    middle = (low + high) // 2
    cut, b_cut = np.full(len(low), -1), np.full(len(low), -1)
    pending = np.arange(len(low))
    for probe in range(PROBES):
        off = (probe + 1) // 2 * (1 if probe % 2 else -1)
        at = middle[pending] + off
        inside = (at >= low[pending]) & (at < high[pending])
        at = np.where(inside, at, low[pending])
        place = np.searchsorted(b, a[at])
        hit = inside & (place < b_high[pending]) & (b[np.minimum(place, len(b) - 1)] == a[at])
        cut[pending[hit]], b_cut[pending[hit]] = at[hit], place[hit]
        # Intervals of which all tokens were tried are leaves.
        reach = np.maximum(middle - low, high - 1 - middle)
        pending = pending[~hit & (reach[pending] > probe // 2)]
        if not len(pending):
            return cut, b_cut
    for k in pending:  # long stretches without a cut: all their tokens at once
        ends = a[low[k] : high[k]]
        place = np.searchsorted(b[b_low[k] : b_high[k]], ends)
        common = np.flatnonzero(
            (place < b_high[k] - b_low[k]) & (b[np.minimum(place + b_low[k], len(b) - 1)] == ends)
        )
        if len(common):
            best = common[np.abs(common + low[k] - middle[k]).argmin()]
            cut[k], b_cut[k] = low[k] + best, b_low[k] + place[best]
    return cut, b_cut


def written_groups(a_ids, b_ids, cuts_a, cuts_b, words: list[str], shift: int) -> list[str]:
    """Parts of ``a1,a2|b1;a3|b2``: ids with the mark that follows them, in order.

    ``words`` has two entries an id: id and comma, id and the mark that ends its
    side of a group; those of the second tokenizer start at ``shift``.
    """
    last_a, last_b = np.zeros(len(a_ids), bool), np.zeros(len(b_ids), bool)
    last_a[cuts_a], last_b[cuts_b] = True, True
    group_a = np.cumsum(last_a) - last_a
    group_b = np.cumsum(last_b) - last_b
    sizes_a, sizes_b = np.diff(np.r_[-1, cuts_a]), np.diff(np.r_[-1, cuts_b])
    a_upto, b_before = np.cumsum(sizes_a), np.cumsum(sizes_b) - sizes_b
    order = np.empty(len(a_ids) + len(b_ids), np.int64)
    order[np.arange(len(a_ids)) + b_before[group_a]] = a_ids.astype(np.int64) * 2 + last_a
    order[np.arange(len(b_ids)) + a_upto[group_b]] = shift + b_ids.astype(np.int64) * 2 + last_b
    return list(map(words.__getitem__, order.tolist()))


def _aligned(tables, model):
    def run(batches):
        first = Automaton(tables.value, specials=False)
        second = Pieces(model.value)
        a_sizes = np.array([len(x) for x in first.labels], np.int64)
        shift = 2 * len(first.labels)
        words = [f"{i}{mark}" for i in range(len(first.labels)) for mark in ",|"]
        words += [f"{i}{mark}" for i in range(len(second.labels)) for mark in ",;"]

        def aligned_texts(held):
            """Rows of some texts, each a tuple of ids or None."""
            some = [ids for ids in held if ids is not None]
            if some:
                a_bounds = np.cumsum([0, *(len(x) for x, _ in some)])
                b_bounds = np.cumsum([0, *(len(y) for _, y in some)])
                a_all, b_all = (np.concatenate([ids[s] for ids in some]).astype(np.int64) for s in (0, 1))
                # Ends of all texts behind each other ascend, as texts have the
                # same bytes on both sides.
                a_ends, b_ends = np.cumsum(a_sizes[a_all]), np.cumsum(second.sizes[b_all])
                cuts_a, cuts_b = shared_cuts(a_ends, b_ends, a_bounds, b_bounds)
                parts = written_groups(a_all, b_all, cuts_a, cuts_b, words, shift)
                pairs = a_all[cuts_a] << 32 | b_all[cuts_b]
                starts = np.searchsorted(cuts_a, a_bounds)
            at = 0
            for ids in held:
                if ids is None:
                    yield 0, 0, 0, "", [], []
                    continue
                n_a, n_b = len(ids[0]), len(ids[1])
                lo, hi = a_bounds[at] + b_bounds[at], a_bounds[at + 1] + b_bounds[at + 1]
                text = "".join(parts[lo:hi])[:-1]
                linked, times = np.unique(pairs[starts[at] : starts[at + 1]], return_counts=True)
                groups = int(starts[at + 1] - starts[at])
                yield n_a, n_b, groups, hashlib.sha256(text.encode()).hexdigest(), linked, times
                at += 1

        def both(text):
            if not text:
                return None
            # Paths of the automaton spell their text; pieces may not.
            b = second.encode(text)
            if b"".join(map(second.labels.__getitem__, b.tolist())) != f" {text}".encode():
                return None
            return first.encode(f" {text}"), b

        def chunks(texts):
            held, tokens = [], 0
            for text in texts:
                ids = both(text)
                held.append(ids)
                tokens += 0 if ids is None else len(ids[0])
                if tokens >= CHUNK_TOKENS:
                    yield from aligned_texts(held)
                    held, tokens = [], 0
            yield from aligned_texts(held)

        for batch in batches:
            doc_ids, texts = batch["doc_id"], batch["text"].to_pylist()
            n_a, n_b, groups, digests, linked, times = zip(*chunks(texts), strict=True)
            offsets = pa.array(np.cumsum([0, *map(len, linked)]), pa.int32())
            values = pa.StructArray.from_arrays(
                [
                    pa.array(np.concatenate([np.empty(0, np.int64), *linked]).astype(np.int64)),
                    pa.array(np.concatenate([np.empty(0, np.int64), *times]).astype(np.int64)),
                ],
                names=["pair", "n"],
            )
            yield pa.record_batch(
                {
                    "doc_id": doc_ids,
                    "n_a": pa.array(n_a, pa.int64()),
                    "n_b": pa.array(n_b, pa.int64()),
                    "n_groups": pa.array(groups, pa.int64()),
                    "groups_sha256": pa.array(digests, pa.string()),
                    "links": pa.ListArray.from_arrays(offsets, values),
                }
            )

    return run


def aligned(docs: DataFrame, byte_vocabulary: str, piece_model: str) -> DataFrame:
    """Every text's tokens, groups and links: doc_id, n_a, n_b, n_groups,
    groups_sha256, links (pair = id of A times 2 ** 32 plus id of B, and how often
    the text has it)."""
    with open(piece_model, "rb") as file:  # as large as the vocabulary
        model = docs.sparkSession.sparkContext.broadcast(file.read())
    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return rows.mapInArrow(
        _aligned(shipped(docs, byte_vocabulary), model),
        "doc_id long, n_a long, n_b long, n_groups long, groups_sha256 string, "
        "links array<struct<pair:bigint,n:bigint>>",
    )


def pair_counts(texts: DataFrame) -> DataFrame:
    """pair, count (links of the corpus that hold it), best (is that the highest
    of its B id?), of aligned texts."""
    counts = (
        texts.select(F.explode("links").alias("link"))
        .groupBy(F.col("link.pair").alias("pair"))
        .agg(F.sum("link.n").alias("count"))
    )
    counts = step(counts, "pair-counts")
    b = F.col("pair").bitwiseAND(F.lit((1 << 32) - 1)).alias("b")
    highest = counts.groupBy(b).agg(F.max("count").alias("highest"))
    return counts.withColumn("b", b).join(highest, "b").select(
        "pair", "count", (F.col("count") == F.col("highest")).alias("best")
    )


def alignment(docs: DataFrame, byte_vocabulary: str, piece_model: str) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256."""
    texts = step(
        aligned(docs, byte_vocabulary, piece_model).withColumn("row", F.monotonically_increasing_id()),
        "aligned",
    )
    counts = step(pair_counts(texts), "pair-counts-best")
    all_links = texts.agg(F.sum("n_groups")).first()[0] or 0
    # Fewer than HOT_SHARE pairs can each have more than this of all links.
    bar = all_links // HOT_SHARE
    hot = counts.filter(F.col("count") > bar)
    rare = counts.filter(F.col("count") <= bar)
    links = texts.select("row", F.explode("links").alias("link")).select("row", "link.pair", "link.n")
    met = links.join(F.broadcast(hot), "pair", "left")
    value = F.struct(
        F.sum(F.when(F.col("best"), F.col("n"))).alias("n_best"),
        F.sum(F.col("n") * F.col("count")).alias("count_sum"),
    )
    # Links of one text lie in one task, so they are summed before they travel.
    from_hot = met.filter(F.col("count").isNotNull()).groupBy("row").agg(value.alias("v"))
    from_rare = (
        links.join(F.broadcast(hot.select("pair")), "pair", "left_anti")
        .join(rare, "pair")
        .groupBy("row")
        .agg(value.alias("v"))
    )
    sums = (
        from_hot.unionByName(from_rare)
        .groupBy("row")
        .agg(F.sum("v.n_best").alias("n_best"), F.sum("v.count_sum").alias("count_sum"))
    )
    return texts.drop("links").join(sums, "row", "left").select(
        "doc_id",
        "n_a",
        "n_b",
        "n_groups",
        F.col("n_groups").alias("n_links"),
        F.coalesce("n_best", F.lit(0)).alias("n_best"),
        F.coalesce("count_sum", F.lit(0)).alias("count_sum"),
        "groups_sha256",
    )
