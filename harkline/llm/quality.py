"""Quality by importance resampling over hashed n-gram models.

Two generative models count hashed n-grams: one over the target text (documents labelled
good), one over all text. A document's log weight is the log of the ratio of its
probabilities under both. Documents are then drawn without replacement by Gumbel top-k:
log weight plus Gumbel noise, the k largest stay. k is the number of documents whose log
weight reaches the threshold that best separates labelled good from labelled bad ones.

N-grams are single words and pairs of words, once as words and once as shapes (length
class, kind of the last character, number of symbols), so that a model sees both what is
written and how. A word that repeats the one before is a pair of its own. Each n-gram falls
into one of `BUCKETS` buckets; the counts of a bucket in target text are smoothed towards
what the raw model expects there (`PRIOR` pseudo counts), so that rare buckets say nothing.

Counts of the raw model cover all documents. The target model and the threshold are fitted
on at most `MAX_LABELLED` labelled documents, drawn by a hash of their id, whose ids are
broadcast; scoring and drawing cover all documents. The models have a fixed size.

Defined cases: a null or empty text has log weight 0; rows without doc_id are drawn like
others and have no label; repeated rows get the same noise and the same decision; ties
with the k-th key stay; a document labelled twice counts as bad if one label says so;
without labels of both kinds every document stays; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from harkline.llm.common import joined_bytes, lower_ascii, map_arrow, pieces, word_bounds, word_hashes
from harkline.session import written

#: Buckets of each of the four n-gram views.
BUCKETS = 1 << 14
VIEWS = 4
PRIOR = 20.0
#: Most labelled documents the target model and the threshold are fitted on.
MAX_LABELLED = 20_000
#: Noise is scaled down by this factor: weights to the power 1 / TEMPERATURE.
TEMPERATURE = 0.25
SEED = 7
#: Bins of one pass that narrows down the k-th key, and of the labelled log weights.
BINS = 4096
#: Log weights beyond this are alike for the threshold.
FAR = 64.0

_CLASS = np.full(256, 3, dtype=np.uint8)  # 0 letter, 1 digit, 2 sentence mark, 3 symbol
_CLASS[[c for c in range(256) if chr(c).isascii() and chr(c).isalpha() or c >= 128]] = 0
_CLASS[[c for c in b"0123456789"]] = 1
_CLASS[[c for c in b".,;:!?'\"()-"]] = 2


def features(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bucket of every n-gram of the texts, all views in a row per word, and the words of each text."""
    data, lengths = joined_bytes(column)
    starts, ends, counts = word_bounds(data, lengths)
    words = word_hashes(lower_ascii(data), starts, ends)
    symbols = np.concatenate(([0], np.cumsum(_CLASS[data] == 3)))
    marks = np.minimum(symbols[ends] - symbols[starts], 3).astype(np.uint64)
    length = np.minimum(np.log2(ends - starts + 1).astype(np.uint64), 6)
    last = _CLASS[data[ends - 1]].astype(np.uint64) if len(ends) else np.zeros(0, np.uint64)
    shapes = (marks * np.uint64(4) + last) * np.uint64(7) + length + np.uint64(1)
    first = np.zeros(len(words), dtype=bool)
    begins = np.cumsum(counts) - counts
    first[begins[counts > 0]] = True

    def before(values: np.ndarray) -> np.ndarray:
        shifted = np.zeros_like(values)
        shifted[1:] = values[:-1]
        shifted[first] = 0
        return shifted

    before_words = before(words)
    same = (words == before_words).astype(np.uint64)
    mixed = before_words * np.uint64(0x9E3779B97F4A7C15) ^ words
    pairs = np.where(same == 1, np.uint64(1), mixed ^ (mixed >> np.uint64(31)))
    shape_pairs = (before(shapes) * np.uint64(128) + shapes) * np.uint64(2) + same
    views = np.stack([words, pairs, shapes, shape_pairs * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(20)], axis=1)
    buckets = (views % np.uint64(BUCKETS)).astype(np.int64) + np.arange(VIEWS) * BUCKETS
    return buckets, counts


def ratios(target: np.ndarray, raw: np.ndarray) -> np.ndarray:
    """Log ratio of the smoothed target model to the raw model, per bucket."""
    target, raw = target.reshape(VIEWS, BUCKETS).astype(float), raw.reshape(VIEWS, BUCKETS).astype(float)
    total_target, total_raw = target.sum(axis=1, keepdims=True), raw.sum(axis=1, keepdims=True)
    expected = raw * (total_target / np.maximum(total_raw, 1))
    return np.log((target + PRIOR) / (expected + PRIOR)).reshape(-1)


def _labelled(labels: DataFrame) -> DataFrame:
    """Bounded sample of labelled ids with `good` (1 or 0)."""
    known = labels.where("doc_id is not null and quality is not null")
    return (
        known.groupBy("doc_id").agg(F.min((F.col("quality") == 1).cast("int")).alias("good"))
        .orderBy(F.xxhash64("doc_id", F.lit(SEED)), "doc_id").limit(MAX_LABELLED)
    )


def fit(docs: DataFrame, labelled: DataFrame) -> np.ndarray:
    """Log ratio per bucket: target model of the good documents against raw model of all."""
    source = docs.select("doc_id", docs["text"].cast("string").alias("text")).join(
        F.broadcast(labelled), "doc_id", "left"
    ).select("text", "good")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        target, raw = np.zeros((2, VIEWS * BUCKETS), dtype=np.int64)
        for piece in pieces(batches, "text"):
            buckets, counts = features(piece["text"])
            good = np.array([g == 1 for g in piece["good"].to_pylist()], dtype=bool)
            raw += np.bincount(buckets.ravel(), minlength=len(raw))
            target += np.bincount(buckets[np.repeat(good, counts)].ravel(), minlength=len(raw))
        seen = np.flatnonzero(raw)
        yield pa.RecordBatch.from_arrays(
            [pa.array(seen), pa.array(target[seen]), pa.array(raw[seen])], ["bucket", "target", "raw"]
        )

    # at most VIEWS * BUCKETS rows come back
    totals = (
        map_arrow(source, run, "bucket long, target long, raw long")
        .groupBy("bucket").agg(F.sum("target").alias("target"), F.sum("raw").alias("raw")).toArrow()
    )
    target, raw = np.zeros((2, VIEWS * BUCKETS), dtype=np.int64)
    at = totals["bucket"].to_numpy()
    target[at], raw[at] = totals["target"].to_numpy(), totals["raw"].to_numpy()
    return ratios(target, raw)


def add_log_weights(docs: DataFrame, model: np.ndarray, keep: list[str]) -> DataFrame:
    """The columns `keep` as they are, then `_words` and `_weight`."""
    source = docs.select(*[docs[c].alias(f"c{i}") for i, c in enumerate(keep)], docs["text"].cast("string").alias("t"))
    schema = T.StructType(
        [*source.schema.fields[:-1], T.StructField("_words", T.LongType()), T.StructField("_weight", T.DoubleType())]
    )
    table = model.astype(np.float32)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches, "t"):
            buckets, counts = features(piece["t"])
            rows = np.repeat(np.arange(len(counts)), counts)
            weight = np.bincount(rows, table[buckets].sum(axis=1, dtype=np.float64), minlength=len(counts))
            yield pa.RecordBatch.from_arrays(
                [*piece.columns[:-1], pa.array(counts.astype(np.int64)), pa.array(weight)], schema.names
            )

    return map_arrow(source, run, schema)


def gumbel_key(weight: Column, doc_id: Column) -> Column:
    """Tempered log weight plus Gumbel noise that depends on the document and the seed only."""
    uniform = (F.shiftrightunsigned(F.xxhash64(doc_id, F.lit(SEED), F.round(weight, 6)), 11) + F.lit(0.5)) / float(1 << 53)
    return weight / F.lit(TEMPERATURE) - F.log(-F.log(uniform))


def best_threshold(scored: DataFrame, labelled: DataFrame) -> float | None:
    """Log weight that best separates labelled good from bad; None without both kinds."""
    clipped = F.greatest(F.least(F.col("weight"), F.lit(FAR)), F.lit(-FAR))
    place = F.floor((clipped + FAR) * (BINS / (2 * FAR))).cast("int")
    rows = (
        scored.join(F.broadcast(labelled), "doc_id").groupBy(place.alias("bin"), "good").count().collect()
    )  # at most two rows per bin
    bins = np.zeros((2, BINS + 1))
    for r in rows:
        bins[r["good"], r["bin"]] += r["count"]
    if not bins[0].sum() or not bins[1].sum():
        return None
    bad_below = np.concatenate(([0], np.cumsum(bins[0]))) / bins[0].sum()
    good_below = np.concatenate(([0], np.cumsum(bins[1]))) / bins[1].sum()
    gain = bad_below - good_below
    best = np.flatnonzero(gain >= gain.max() - 1e-12)
    middle = (best[0] + best[-1]) / 2
    return middle * (2 * FAR / BINS) - FAR


def kth_largest(keys: DataFrame, name: str, k: int) -> float:
    """The k-th largest value of a column, by counting in ever finer bins; no sort."""
    low, high = keys.agg(F.min(name), F.max(name)).head()
    above = 0
    while low < high:
        width = (high - low) / BINS
        if low + width <= low:
            break
        place = F.least(F.floor((F.col(name) - low) / width), F.lit(BINS - 1))
        inside = keys.where(F.col(name).between(low, high))
        found = (
            inside.groupBy(place.alias("bin"))
            .agg(F.count("*").alias("n"), F.min(name).alias("lo"), F.max(name).alias("hi")).collect()
        )  # at most BINS rows
        for r in sorted(found, key=lambda r: -r["bin"]):
            if above + r["n"] >= k:
                low, high = r["lo"], r["hi"]
                break
            above += r["n"]
    return low


def draw(docs: DataFrame, labels: DataFrame) -> tuple[np.ndarray, DataFrame, float]:
    """The model, (doc_id, n_words, weight, key) of every row, and the smallest key that stays."""
    labelled = written(_labelled(labels), "quality-labels")
    model = fit(docs, labelled)
    scored = add_log_weights(docs, model, ["doc_id"]).toDF("doc_id", "n_words", "weight")
    scored = written(scored.withColumn("key", gumbel_key(F.col("weight"), F.col("doc_id"))), "quality-scores")
    threshold = best_threshold(scored, labelled)
    stays = 0 if threshold is None else scored.where(F.col("weight") >= threshold).count()
    if stays == 0:
        return model, scored, float("-inf")
    return model, scored, kth_largest(scored, "key", stays)


def quality_report(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """`doc_id`, `n_words`, `log_weight`, `draw_key` and `kept` of every document."""
    _, scored, least = draw(docs, labels)
    return scored.select(
        "doc_id", "n_words", F.col("weight").alias("log_weight"), F.col("key").alias("draw_key"),
        (F.col("key") >= least).alias("kept"),
    )


def keep_drawn(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows that are drawn, all columns."""
    model, _, least = draw(docs, labels)
    marked = add_log_weights(docs, model, docs.columns)
    at = f"c{docs.columns.index('doc_id')}"
    kept = marked.where(gumbel_key(F.col("_weight"), F.col(at)) >= least)
    return kept.select(*[f"c{i}" for i in range(len(docs.columns))]).toDF(*docs.columns)
