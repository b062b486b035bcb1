"""Quality classifier by importance resampling.

Texts are bags of hashed words and word pairs. A generative model of the target (documents labelled
good) and one of the raw corpus give each text a log importance weight; documents are drawn without
replacement in proportion to the weights by taking the largest weights plus Gumbel noise.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from arealens.llm.words import chunks, mix, split_words, window_hashes
from arealens.operators.materialize import TEXT_ROWS, materialize

BUCKETS = 1 << 16
#: Bounds of the labelled samples: rows labelled good (half for the target model, half for the cut)
#: and rows labelled bad (only the cut), taken in the order of a hash of doc_id.
TARGET_ROWS = 20_000
BAD_ROWS = 5_000
#: The weight is that of a text of so many grams: the mean log ratio times this number, drawn
#: towards 0 for shorter texts.
GRAMS = 100
#: Scale of the Gumbel noise; 1 is sampling in proportion to the weights, smaller is sharper.
TEMPERATURE = 0.25
#: A lost share of good rows weighs so many times a missed share of bad rows when the cut is set.
GOOD_TO_BAD = 20
_SEED = np.uint64(0x5DEECE66D)


def _grams(hashes: np.ndarray) -> np.ndarray:
    return (np.concatenate([hashes, window_hashes(hashes, 2)]) >> np.uint64(48)).astype(np.int64)


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (bucket, raw, target) with the counts of this task."""
    raw, target = np.zeros(BUCKETS, np.int64), np.zeros(BUCKETS, np.int64)
    for batch in batches:
        good = np.array([x == 1 for x in batch.column("good").to_pylist()], bool)
        for lo, hi, data, offsets in chunks(batch.column("text")):
            words = split_words(data, offsets, lower=True)
            row = np.repeat(np.arange(hi - lo), np.diff(words.first))
            pair = window_hashes(words.hashes, 2)[row[1:] == row[:-1]] if len(row) > 1 else words.hashes[:0]
            pair_row = row[:-1][row[1:] == row[:-1]]
            for hashes, rows in ((words.hashes, row), (pair, pair_row)):
                bucket = (hashes >> np.uint64(48)).astype(np.int64)
                raw += np.bincount(bucket, minlength=BUCKETS)
                target += np.bincount(bucket[good[lo:hi][rows]], minlength=BUCKETS)
    seen = np.flatnonzero(raw)
    yield pa.RecordBatch.from_arrays([pa.array(seen.astype(np.int32)), pa.array(raw[seen]), pa.array(target[seen])], names=["bucket", "raw", "target"])


def _weigh(batch: pa.RecordBatch, ratio: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Log weight of each row, and the weight with its noise."""
    weight, noise = np.zeros(batch.num_rows), np.zeros(batch.num_rows, np.uint64)
    ids = batch.column("doc_id").cast(pa.int64()).fill_null(-1).to_numpy(zero_copy_only=False).view(np.uint64)
    for lo, hi, data, offsets in chunks(batch.column("text")):
        words = split_words(data, offsets, lower=True)
        for row in range(hi - lo):
            own = words.hashes[words.first[row] : words.first[row + 1]]
            if len(own):
                grams = _grams(own)
                weight[lo + row] = ratio[grams].sum() / (len(grams) + GRAMS) * GRAMS
            noise[lo + row] = own.sum(dtype=np.uint64)
    uniform = (mix(mix(ids + _SEED) ^ noise) >> np.uint64(11)).astype(float) / 2**53 + 2**-54
    return weight, weight - TEMPERATURE * np.log(-np.log(uniform))


def _sample(labels: DataFrame) -> DataFrame:
    """(doc_id, good): the bounded sample of labelled rows; a doc_id labelled both ways is left out.

    ``good`` is 1 for the target model, 2 for good rows kept for the cut, 0 for bad rows.
    """
    one = labels.where("doc_id is not null and quality in (0, 1)").groupBy("doc_id").agg(F.min("quality").alias("good"), F.max("quality").alias("top")).where("good = top")
    key = F.xxhash64("doc_id")
    parts = [one.where(F.col("good") == g).orderBy(key, "doc_id").limit(n).select(F.col("doc_id").cast("long").alias("doc_id"), F.col("good").cast("int").alias("good")) for g, n in ((1, TARGET_ROWS), (0, BAD_ROWS))]
    both = parts[0].union(parts[1])
    return both.withColumn("good", F.when(F.col("good") == 1, 1 + F.pmod(F.xxhash64(F.col("doc_id"), F.lit("cut")), F.lit(2))).otherwise(0).cast("int"))


def _kth_largest(values: DataFrame, column: str, k: int) -> float:
    """The k-th largest value, by histograms of shrinking ranges; ties count as often as they occur."""
    lo, hi = values.agg(F.min(column), F.max(column)).first()
    above = 0
    while True:
        inside = values.where(F.col(column).between(lo, hi))
        step = (hi - lo) / 1024
        if step <= abs(hi) * 1e-15 or step == 0:
            return lo
        at = F.least(F.floor((F.col(column) - lo) / step), F.lit(1023))
        bins = sorted(((r["at"], r["n"], r["low"], r["high"]) for r in inside.groupBy(at.alias("at")).agg(F.count("*").alias("n"), F.min(column).alias("low"), F.max(column).alias("high")).collect()), reverse=True)
        for _, n, low, high in bins:
            if above + n >= k:
                break
            above += n
        if low == high:
            return low
        lo, hi = low, high


def _cut(good: np.ndarray, bad: np.ndarray) -> float:
    """The middle of the gap between two weights that parts the bad from the good sample best."""
    weight = np.concatenate([good, bad])
    order = np.argsort(weight, kind="stable")
    is_good = order < len(good)
    lost, caught = np.append(0, np.cumsum(is_good)) / len(good), np.append(0, np.cumsum(~is_good)) / len(bad)
    at = int(np.argmax(caught - GOOD_TO_BAD * lost))
    ordered = weight[order]
    return float(ordered[0] - 1) if at == 0 else float((ordered[at - 1] + ordered[min(at, len(ordered) - 1)]) / 2)


class Importance:
    """Fitted log ratios by bucket, and the least noisy weight of a drawn document."""

    def __init__(self, ratio: np.ndarray, least: float):
        self.ratio, self.least = ratio, least


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))


def fit_importance(docs: DataFrame, labels: DataFrame) -> tuple[Importance, DataFrame]:
    """Count both models over all rows of ``docs`` (doc_id, text), weigh every row, and draw.

    ``labels`` (doc_id, quality) marks the target. The number drawn is the number of rows whose weight
    reaches the cut. Without good or bad labelled rows all rows are drawn. Also returns
    the rows (doc_id, log_weight, sample_key, kept).
    """
    spark = docs.sparkSession
    sample = materialize(_sample(labels), "sample")
    marked = _texts(docs).join(F.broadcast(sample), "doc_id", "left")
    counts = marked.mapInArrow(_count, "bucket int, raw long, target long").groupBy("bucket").agg(F.sum("raw").alias("raw"), F.sum("target").alias("target")).toPandas()
    raw, target = np.zeros(BUCKETS), np.zeros(BUCKETS)
    raw[counts["bucket"]], target[counts["bucket"]] = counts["raw"], counts["target"]
    ratio = np.zeros(BUCKETS)
    if target.sum():
        ratio = np.log((target + 1) / (target.sum() + BUCKETS)) - np.log((raw + 1) / (raw.sum() + BUCKETS))
    sent = spark.sparkContext.broadcast(ratio)

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            weight, key = _weigh(batch, sent.value)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(weight), pa.array(key), batch.column("good")], names=["doc_id", "log_weight", "sample_key", "good"])

    scored = materialize(marked.mapInArrow(weigh, "doc_id long, log_weight double, sample_key double, good int"), "weights", TEXT_ROWS)
    known = scored.where("good is not null").groupBy("doc_id").agg(F.max("good").alias("good"), F.min("log_weight").alias("w")).select("good", "w").toPandas()
    held = known["good"] == (2 if (known["good"] == 2).any() else 1)
    good, bad = known["w"][held].to_numpy(float), known["w"][known["good"] == 0].to_numpy(float)
    least = -np.inf
    if target.sum() and len(good) and len(bad):
        cut = _cut(good, bad)
        k = scored.where(F.col("log_weight") >= cut).count()
        least = _kth_largest(scored, "sample_key", k) if k else np.inf
    return Importance(ratio, float(least)), scored.select("doc_id", "log_weight", "sample_key", (F.col("sample_key") >= float(least)).alias("kept"))


def keep_drawn(docs: DataFrame, model: Importance) -> DataFrame:
    """The rows of ``docs`` drawn by a model fitted on them, with their columns."""
    sent = docs.sparkSession.sparkContext.broadcast(model.ratio)
    least = model.least

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            _, key = _weigh(batch, sent.value)
            yield batch.filter(pa.array(key >= least))

    return docs.mapInArrow(run, docs.schema)


def resample(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Per row of ``docs``: doc_id, log_weight, sample_key (weight plus noise), kept.

    Null and empty texts weigh 0. Repeated rows share weight and noise; rows that tie at the last place
    are all drawn. Further columns are ignored; an empty table gives no rows.
    """
    return fit_importance(docs, labels)[1]
