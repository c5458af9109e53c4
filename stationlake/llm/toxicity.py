"""Toxic passages by maximum-scoring segments.

Words score their log-odds of occurring in toxic rather than other labelled
documents, less a constant, so ordinary text drifts down and every maximal
scoring segment (Ruzzo and Tompa, one pass) is a passage denser in toxic words
than what surrounds it. Log-odds have Dirichlet priors: a word's prior is the
odds of its first letters, theirs that of all text, so inflected or compound
forms that were never seen still count.

Segment scores of clean text follow an extreme-value law. Its scale comes from
the score distribution of clean words, its place from the best segments of clean
documents; ``log_e`` = scale * score - ln(K * words) is minus the logarithm of
the number of such segments expected by chance. A document's evidence is that of
its best segment and what further significant ones add; a logistic curve fitted
on the training documents turns it into a score.

Training uses labelled documents outside the held-out fifth, about
``MAX_TRAINING`` of them, picked by a hash of doc_id: a bounded sample, which
bounds what is broadcast. Word statistics meet in two tables of ``BUCKETS``.
Only texts are looked at when scoring.

NULL or empty texts have no segment and score as clean. Labels of NULL are not
used; of contradicting labels of one document the toxic one counts. Without
usable labels of both kinds all scores are 0.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stationlake.llm.common import step
from stationlake.llm.hashing import Powers, blocks, gaps, part_hashes, spans, sums, text_bytes

MAX_TRAINING = 50_000
BUCKETS = 1 << 18
STEM = 4  # bytes of a word that its prior is taken from
PRIOR = 5.0  # weight of a prior, in documents
DRIFT = 2.0  # what a word must exceed to add to a segment
LEAST_DOCUMENTS = 3
SIGNIFICANT = 3.0  # log_e of a passage worth reporting
_EULER = 0.5772156649
_HISTOGRAM = np.arange(-12.0, 12.01, 0.1)
_NOT_LETTERS = bytes(b for b in range(128) if not chr(b).isalpha())


@dataclass(frozen=True)
class Model:
    words: np.ndarray  # 2 x BUCKETS: documents with the word, toxic and other
    stems: np.ndarray  # BUCKETS: share of toxic documents among those with the stem
    share: float  # of toxic documents
    scale: float = 1.0
    place: float = 0.0  # ln K
    intercept: float = 0.0
    slope: float = 1.0


def _features(texts: list[bytes], powers: Powers):
    """Word and stem hashes of all words, their byte spans, and which are whose."""
    data, starts, ends, bounds = spans(texts, gaps(_NOT_LETTERS))
    total = sums(data, powers)
    words = part_hashes(total, starts, ends, powers)
    stems = part_hashes(total, starts, np.minimum(ends, starts + STEM), powers)
    return words, stems, starts, ends, bounds


def _word_scores(model: Model, words: np.ndarray, stems: np.ndarray) -> np.ndarray:
    mask = np.uint64(BUCKETS - 1)
    prior = model.stems[(stems & mask).astype(np.int64)]
    at = (words & mask).astype(np.int64)
    odds = (model.words[0, at] + PRIOR * prior) / (model.words[1, at] + PRIOR * (1 - prior))
    return np.log(odds) - np.log(model.share / (1 - model.share)) - DRIFT


def segments(scores: np.ndarray) -> list[tuple[int, int, float]]:
    """All maximal scoring segments as (first, end, score), in linear time."""
    positive = np.flatnonzero(scores > 0)
    if not len(positive):
        return []
    total = np.r_[0.0, np.cumsum(scores)]
    breaks = np.flatnonzero(np.diff(positive) > 1)
    firsts = positive[np.r_[0, breaks + 1]]
    ends = positive[np.r_[breaks, len(positive) - 1]] + 1
    found: list[tuple[int, int, float, float, int]] = []  # first, end, low, high, lower one
    for first, end in zip(firsts.tolist(), ends.tolist(), strict=True):
        low, high = total[first], total[end]
        while True:
            below = len(found) - 1
            while below >= 0 and found[below][2] >= low:
                below = found[below][4]
            if below < 0 or found[below][3] >= high:
                found.append((first, end, low, high, below))
                break
            first, low = found[below][0], found[below][2]
            del found[below:]
    return [(first, end, float(high - low)) for first, end, low, high, _ in found]


# --- learning ---------------------------------------------------------------


def held_out() -> Column:
    """The fifth of all documents that no model learns from."""
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0


def training_labels(labels: DataFrame, most: int = MAX_TRAINING) -> DataFrame:
    """(doc_id, toxic), one row per document, about ``most`` rows at most."""
    usable = (
        labels.filter(F.col("doc_id").isNotNull() & F.col("toxic").isin(0, 1) & ~held_out())
        .groupBy(F.col("doc_id").cast("long").alias("labeled_id"))
        .agg(F.max("toxic").cast("int").alias("toxic"))
    )
    usable = step(usable, "labels")
    share = min(1.0, most / max(1, usable.count()))
    picked = F.pmod(F.xxhash64("labeled_id"), F.lit(1 << 30)) < int(share * (1 << 30))
    return usable.filter(picked)


def _counted(batches):
    powers = Powers()
    for batch in batches:
        texts, toxic = text_bytes(batch["text"]), batch["toxic"].to_numpy(zero_copy_only=False)
        for part in blocks(np.array([len(t) for t in texts])):
            words, stems, _, _, bounds = _features(texts[part], powers)
            owners = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
            for kind, hashes in ((0, words), (1, stems)):
                if not len(hashes):
                    continue
                order = np.lexsort((hashes, owners))
                h, o = hashes[order], owners[order]
                new = np.r_[True, (h[1:] != h[:-1]) | (o[1:] != o[:-1])]
                h, y = h[new], toxic[part][o[new]]
                keys, at = np.unique(h, return_inverse=True)
                yield pa.record_batch(
                    {
                        "kind": pa.array(np.full(len(keys), kind, np.int32)),
                        "hash": pa.array(keys.view(np.int64)),
                        "toxic": pa.array(np.bincount(at, y, len(keys)).astype(np.int64)),
                        "other": pa.array(np.bincount(at, 1 - y, len(keys)).astype(np.int64)),
                    }
                )


def _scored_segments(shared):
    """Per document: number of words and scores of its segments, best first."""

    def run(batches):
        model, powers = Model(**shared.value), Powers()
        for batch in batches:
            texts = text_bytes(batch["text"])
            for part in blocks(np.array([len(t) for t in texts])):
                words, stems, _, _, bounds = _features(texts[part], powers)
                scores = _word_scores(model, words, stems)
                found = [
                    sorted((s for _, _, s in segments(scores[a:b])), reverse=True)
                    for a, b in zip(bounds[:-1], bounds[1:], strict=True)
                ]
                kept = {c: batch.column(c)[part] for c in batch.schema.names if c != "text"}
                histogram = {}
                if "toxic" in kept:
                    toxic = np.repeat(kept["toxic"].to_numpy(zero_copy_only=False), np.diff(bounds))
                    bins = np.clip(np.digitize(scores[toxic == 0], _HISTOGRAM) - 1, 0, len(_HISTOGRAM) - 1)
                    counts = np.bincount(bins, minlength=len(_HISTOGRAM))
                    histogram["clean"] = pa.array(
                        [counts, *[None] * (len(found) - 1)], pa.list_(pa.int64())
                    )
                yield pa.record_batch(
                    kept
                    | {
                        "words": pa.array(np.diff(bounds)),
                        "segments": pa.array(found, pa.list_(pa.float64())),
                    }
                    | histogram
                )

    return run


def _evidence(scale: float, place: float) -> Column:
    """Minus the log of the chance of the best segment, and of further significant ones."""
    base = F.lit(place) + F.log(F.greatest(F.col("words"), F.lit(1)).cast("double"))
    best = F.coalesce(F.get("segments", F.lit(0)), F.lit(0.0)) * scale - base
    rest = F.aggregate(
        F.slice("segments", 2, F.greatest(F.size("segments") - 1, F.lit(0))),
        F.lit(0.0),
        lambda total, s: total + F.greatest(s * scale - base, F.lit(0.0)),
    )
    return best + rest


def _scale(counts: np.ndarray) -> float:
    """The root of E[exp(scale * score)] = 1 over clean words."""
    share = counts / max(1, counts.sum())
    low, high = 0.05, 3.0
    for _ in range(60):
        middle = (low + high) / 2
        if (share * np.exp(middle * _HISTOGRAM)).sum() > 1:
            high = middle
        else:
            low = middle
    return (low + high) / 2


def _logistic(x: np.ndarray, y: np.ndarray, n: np.ndarray) -> tuple[float, float]:
    """A logistic curve through counts n of (x, y), by Newton steps with a slight ridge."""
    a, b = 0.0, 0.1
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a + b * x, -30, 30)))
        g = np.array([(n * (y - p)).sum(), (n * (y - p) * x).sum() - 1e-3 * b])
        w = n * p * (1 - p)
        h = np.array([[w.sum() + 1e-6, (w * x).sum()], [(w * x).sum(), (w * x * x).sum() + 1e-3]])
        move = np.clip(np.linalg.solve(h, g), -2, 2)
        a, b = a + move[0], b + move[1]
        if np.abs(move).max() < 1e-6:
            break
    return float(a), float(b)


def fit(docs: DataFrame, labels: DataFrame, most: int = MAX_TRAINING) -> Model | None:
    """None if the labels do not name documents of both kinds."""
    context = docs.sparkSession.sparkContext
    # At most about MAX_TRAINING rows of two numbers.
    chosen = F.broadcast(training_labels(labels, most))
    # Only these two columns of documents, whatever others are called.
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    training = texts.join(chosen, F.col("doc_id") == F.col("labeled_id")).select("text", "toxic")
    sizes = {r["toxic"]: r["n"] for r in training.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not sizes.get(0) or not sizes.get(1):
        return None
    share = sizes[1] / (sizes[0] + sizes[1])
    counted = training.mapInArrow(_counted, "kind int, hash long, toxic long, other long")
    bucket = F.pmod("hash", F.lit(BUCKETS)).cast("int").alias("bucket")
    rows = (
        counted.groupBy("kind", "hash")
        .agg(F.sum("toxic").alias("toxic"), F.sum("other").alias("other"))
        .filter(F.col("toxic") + F.col("other") >= LEAST_DOCUMENTS)
        .groupBy("kind", bucket)
        .agg(F.sum("toxic").alias("toxic"), F.sum("other").alias("other"))
        .toPandas()  # at most 2 * BUCKETS rows
    )
    tables = np.zeros((2, 2, BUCKETS), np.float32)
    for column, place in (("toxic", 0), ("other", 1)):
        tables[rows.kind, place, rows.bucket] = rows[column]
    stems = (tables[1, 0] + PRIOR * share) / (tables[1].sum(0) + PRIOR)
    model = Model(tables[0], stems.astype(np.float32), share)

    shared = context.broadcast(vars(model))
    seen = step(
        training.mapInArrow(
            _scored_segments(shared), "toxic int, words long, segments array<double>, clean array<long>"
        ),
        "training-segments",
    )
    counts = np.zeros(len(_HISTOGRAM))
    for row in (
        seen.filter("clean IS NOT NULL").select(F.posexplode("clean").alias("bin", "n")).groupBy("bin").agg(F.sum("n").alias("n"))
    ).collect():
        counts[row["bin"]] = row["n"]
    scale = _scale(counts)
    best = F.coalesce(F.get("segments", F.lit(0)), F.lit(0.0)) * scale
    words = F.log(F.greatest(F.col("words"), F.lit(1)).cast("double"))
    place = seen.filter("toxic = 0").agg(F.avg(best - words)).first()[0] - _EULER
    binned = (
        seen.groupBy("toxic", F.round(_evidence(scale, place), 1).alias("x")).agg(F.count(F.lit(1)).alias("n")).toPandas()
    )
    intercept, slope = _logistic(
        binned.x.clip(-50, 50).to_numpy(), binned.toxic.to_numpy(), binned.n.to_numpy()
    )
    shared.unpersist()
    return Model(model.words, model.stems, share, scale, place, intercept, slope)


# --- applying ---------------------------------------------------------------


def _score(model: Model) -> Column:
    x = F.least(F.greatest(_evidence(model.scale, model.place), F.lit(-50.0)), F.lit(50.0))
    return 1 / (1 + F.exp(-(F.lit(model.intercept) + F.lit(model.slope) * x)))


def scored(docs: DataFrame, model: Model | None) -> DataFrame:
    """doc_id, digest of the text, score."""
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col("text").cast("string").alias("text"),
        F.md5(F.coalesce(F.col("text").cast("string"), F.lit(""))).alias("digest"),
    )
    if model is None:
        return rows.select("doc_id", "digest", F.lit(0.0).alias("score"))
    shared = docs.sparkSession.sparkContext.broadcast(vars(model))
    found = rows.mapInArrow(
        _scored_segments(shared), "doc_id long, digest string, words long, segments array<double>"
    )
    return found.select("doc_id", "digest", _score(model).alias("score"))


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Per document: doc_id, held_out, score, predicted."""
    return scored(docs, fit(docs, labels)).select(
        "doc_id",
        F.coalesce(held_out(), F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


def _passages(shared):
    def run(batches):
        model, powers = Model(**shared.value), Powers()
        for batch in batches:
            ids = batch["doc_id"]
            for row, text in enumerate(text_bytes(batch["text"])):
                words, stems, starts, ends, _ = _features([text], powers)
                base = model.place + np.log(max(1, len(words)))
                rows = [
                    (len(text[: starts[a]].decode()), len(text[: ends[b - 1]].decode()), s, s * model.scale - base)
                    for a, b, s in segments(_word_scores(model, words, stems))
                ]
                rows = [r for r in rows if r[3] >= SIGNIFICANT]
                if rows:
                    columns = list(zip(*rows, strict=True))
                    yield pa.record_batch(
                        {
                            "doc_id": ids.take(pa.array([row] * len(rows))),
                            "first": pa.array(columns[0], pa.int64()),
                            "end": pa.array(columns[1], pa.int64()),
                            "score": pa.array(columns[2], pa.float64()),
                            "log_e": pa.array(columns[3], pa.float64()),
                        }
                    )

    return run


def passages(docs: DataFrame, model: Model) -> DataFrame:
    """Every significant toxic passage: doc_id, first, end (code points), score, log_e."""
    shared = docs.sparkSession.sparkContext.broadcast(vars(model))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(_passages(shared), "doc_id long, first long, end long, score double, log_e double")


def without_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that the model does not call toxic, all columns."""
    model = fit(docs, labels)
    if model is None:
        return docs
    shared = docs.sparkSession.sparkContext.broadcast(vars(model))
    names = docs.columns
    is_clean = F.pandas_udf(_clean(shared), "boolean")
    packed = docs.select(F.struct(*names).alias("document"))
    return packed.filter(is_clean(F.col("document.text").cast("string"))).select("document.*")


def _clean(shared):
    def run(texts: pd.Series) -> pd.Series:
        model, powers, verdicts = Model(**shared.value), Powers(), []
        data = [t.encode() if isinstance(t, str) else b"" for t in texts]
        for part in blocks(np.array([len(t) for t in data])):
            words, stems, _, _, bounds = _features(data[part], powers)
            scores = _word_scores(model, words, stems)
            for a, b in zip(bounds[:-1], bounds[1:], strict=True):
                found = sorted((s for _, _, s in segments(scores[a:b])), reverse=True) or [0.0]
                gains = np.array(found) * model.scale - model.place - np.log(max(1, b - a))
                x = np.clip(gains[0] + np.maximum(gains[1:], 0).sum(), -50, 50)
                verdicts.append(model.intercept + model.slope * x < 0)
        return pd.Series(verdicts, dtype=bool)

    return run
