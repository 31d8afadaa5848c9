"""Importance resampling: draw the documents that look most like a target corpus.

A document's features are its runs of one to three words, hashed to a fixed number of buckets. A bucket's gain is
the logarithm of how much more common it is in the target than in the documents; a document's weight is the sum of
its features' gains, looked up in an array. Weights with Gumbel noise are the scores: the highest scores are a draw
without replacement in proportion to the weights' exponentials.

Scores are written to the shared folder once. The cutoff is found by bisection: jobs that count, exactly, how many
rows reach some thresholds, first over scores and then, among rows of the cutoff's score, over ids. Only selected
rows are put in order, by a range partitioning; their ranks follow from the partitions' sizes.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from kerbside.llm.exchange import blocks_for
from kerbside.llm.words import text_slices
from kerbside.operators.staging import staged

BUCKETS = 10_000
PERCENT = 5
MIN_WORDS = 20
SEED = 42
#: Thresholds that one job counts.
CUTS = 16
#: A text is cut into words in pieces of about this many bytes.
PIECE_BYTES = 1 << 20

_WORD, _GAP = re.compile(rb"[0-9a-z\x80-\xff]+"), re.compile(rb"[^0-9a-z\x80-\xff]")


def feature_buckets(text: bytes, buckets: int = BUCKETS, piece: int = PIECE_BYTES) -> Iterator[tuple[int, np.ndarray]]:
    """(words, buckets of the features that end in it) for each piece of a text; words are never cut."""
    text, at, before = text.lower(), 0, []
    while at < len(text):
        gap = _GAP.search(text, at + piece)
        end = gap.start() if gap else len(text)
        found = _WORD.findall(text, at, end)
        at = end
        if not found:
            continue
        words, old = before + found, len(before)
        onward = [b" " + w for w in words]
        one = list(map(crc32, words))
        two = list(map(crc32, onward[1:], one))
        three = list(map(crc32, onward[2:], two))
        yield len(found), np.array(one[old:] + two[max(old - 1, 0):] + three, np.int64) % buckets
        before = words[-2:]


def bucket_counts(texts: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """Features of all ``text`` in each bucket. Tasks send their sums, so ``buckets`` bounds what reaches the driver."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for _, slices in text_slices(batches):
            for text in slices:
                for _, found in feature_buckets(text, buckets):
                    total += np.bincount(found, minlength=buckets)
        held = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(held), pa.array(total[held])], ["bucket", "n"])

    counted = texts.select(F.col("text").cast("string").alias("text")).mapInArrow(run, "bucket long, n long")
    out = np.zeros(buckets, np.int64)
    for bucket, n in counted.groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        out[bucket] = n
    return out


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 ln) of the smoothed ratio of each bucket's shares in target and source."""
    all_source, all_target, buckets = int(source.sum()), int(target.sum()), len(source)
    return np.array([
        math.floor(1000 * math.log(float((t + 1) * (all_source + buckets)) / float((s + 1) * (all_target + buckets))))
        for s, t in zip(source.tolist(), target.tolist())
    ], np.int64)


def noise(doc_id: int, seed: int = SEED) -> int:
    """Gumbel noise of a document, in thousandths."""
    h = int(hashlib.sha256(f"{seed}:{doc_id}".encode()).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


def document_weights(documents: DataFrame, gain: np.ndarray, seed: int = SEED) -> DataFrame:
    """``doc_id, n_words, n_features, weight, score`` of every row; a row without ``doc_id`` has no score."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in text_slices(batches):
            rows = []
            for doc_id, text in zip(batch.column(0).to_pylist(), texts):
                words = features = weight = 0
                for n, found in feature_buckets(text, len(gain)):
                    words, features, weight = words + n, features + len(found), weight + int(gain[found].sum())
                rows.append((doc_id, words, features, weight, None if doc_id is None else weight + noise(doc_id, seed)))
            names = ["doc_id", "n_words", "n_features", "weight", "score"]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows)], names)

    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, n_words long, n_features long, weight long, score long")


def least_reaching(rows: DataFrame, key: Column, need: int) -> int:
    """The smallest value that at least ``need`` rows' keys don't exceed, found by counting; ``need`` rows exist."""
    low, high = rows.agg(F.min(key), F.max(key)).first()
    while low < high:
        cuts = sorted({low + (high - low) * i // CUTS for i in range(CUTS)})
        counts = rows.agg(*[F.count_if(key <= F.lit(c).cast("long")) for c in cuts]).first()
        high = min([c for c, n in zip(cuts, counts) if n >= need], default=high)
        low = max([c + 1 for c, n in zip(cuts, counts) if n < need], default=low)
    return high


def ranked(rows: DataFrame, *order: Column) -> DataFrame:
    """``rows`` with ``rank`` 1, 2, 3... in this order, over evenly cut ranges; no task sees more than its range."""
    parts = blocks_for(rows)
    in_order = rows.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    placed = staged(in_order.withColumn("_place", F.monotonically_increasing_id()))
    part, place = F.shiftright("_place", 33), F.col("_place").bitwiseAND(F.lit((1 << 33) - 1))
    sizes = dict(placed.groupBy(part.alias("part")).count().collect())  # a row for each partition
    offsets, seen = [], 0
    for number in sorted(sizes):
        offsets.append((number, seen))
        seen += sizes[number]
    offset = rows.sparkSession.createDataFrame(offsets, "_part long, _offset long")
    return placed.withColumn("_part", part).join(F.broadcast(offset), "_part").withColumn(
        "rank", F.col("_offset") + place + 1).drop("_part", "_offset", "_place")


def resample(
    documents: DataFrame,
    target: DataFrame,
    percent: int = PERCENT,
    min_words: int = MIN_WORDS,
    buckets: int = BUCKETS,
    seed: int = SEED,
) -> DataFrame:
    """``doc_id, n_features, weight, score, rank`` of every row of ``documents``; ``rank`` is NULL where not drawn.

    Of the N rows with a ``doc_id`` and ``min_words`` words, ``percent`` in a hundred are drawn, rounded down: those
    with the highest scores, ties to the smaller ``doc_id``, and of rows that repeat a ``doc_id`` and score any. A
    NULL text is empty: no features, weight 0. Rows without ``doc_id`` count among the documents' features, have no
    score and are not drawn. Without target texts all gains still follow from the formula. Other columns are not read.
    """
    gain = gains(bucket_counts(documents, buckets), bucket_counts(target, buckets))
    scored = staged(document_weights(documents, gain, seed).withColumn("_row", F.monotonically_increasing_id()))
    open_ = F.col("doc_id").isNotNull() & (F.col("n_words") >= min_words)
    wanted = scored.where(open_).count() * percent // 100
    columns = ["doc_id", "n_features", "weight", "score"]
    if not wanted:
        return scored.select(*columns, F.lit(None).cast("long").alias("rank"))
    cutoff = -least_reaching(scored.where(open_), -F.col("score"), wanted)
    above = scored.where(open_ & (F.col("score") > cutoff)).count()
    last = least_reaching(scored.where(open_ & (F.col("score") == cutoff)), F.col("doc_id"), wanted - above)
    reached = (F.col("score") > cutoff) | ((F.col("score") == cutoff) & (F.col("doc_id") <= last))
    drawn = F.coalesce(open_ & reached, F.lit(False))
    order = (F.desc("score"), F.asc("doc_id"), F.asc("_row"))
    # Rows that repeat the last id and score may be one too many.
    first = ranked(scored.where(drawn), *order).select(*columns, F.when(F.col("rank") <= wanted, F.col("rank")).alias("rank"))
    return first.unionByName(scored.where(~drawn).select(*columns, F.lit(None).cast("long").alias("rank")))
