"""Quality rules: two fixed rules, then gradient-boosted trees over document statistics.

The statistics of a document come from one pass over its whole text. The trees are fitted on a bounded sample of
labelled documents and sent to the tasks as NumPy arrays of fixed size. Signs of decay (symbols, repeated lines
and words) may only lower a document's score.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from kerbside.llm import boosting
from kerbside.llm.words import text_slices

#: The most labelled documents that the trees are fitted on; those with the smallest hash of their id.
MAX_LABELLED = 20_000
#: A document stays unless the trees are this sure that it is bad.
LEAST_PROBABILITY = 0.2
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50

_SYMBOLS = b"#*$%&|<>"
_BLANKS = " \t\n\r\x0b\x0c"

COUNTS = [
    "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
    "n_distinct", "n_lines", "n_ended_lines", "n_letters", "n_digits", "n_long_words",
]
#: Features and the sign of their constraint.
FEATURES = {
    "symbols_per_word": -1, "dup_line_share": -1, "repeat_share": -1, "mean_word": 0, "distinct_share": 0,
    "ended_line_share": 0, "letter_share": 1, "digit_share": 0, "long_word_share": -1, "words_per_line": 0,
    "log_words": 0,
}


def _counts(text: bytes) -> list[int]:
    words = text.split()
    n = len(words)
    lines = [line for line in text.split(b"\n") if line.strip()]
    covered = 0
    if n >= 3:
        seen = Counter(zip(words, words[1:], words[2:]))
        if len(seen) < n - 2:
            last = 0  # end of the words counted so far
            for i, window in enumerate(zip(words, words[1:], words[2:])):
                if seen[window] > 1:
                    covered += i + 3 - max(i, last)
                    last = i + 3
    chars = text.decode("utf-8", "replace")
    raw = np.frombuffer(text, np.uint8)
    lower = raw | 0x20
    letters = int(((lower >= 97) & (lower <= 122)).sum()) + int((raw >= 0xC0).sum())
    return [
        n, len(chars) - sum(map(chars.count, _BLANKS)), len(text) - len(text.translate(None, _SYMBOLS)),
        len(lines) - len(set(lines)), covered, len(set(words)), len(lines),
        sum(line.rstrip()[-1:] in b".!?\"'" for line in lines), letters,
        int(((raw >= 48) & (raw <= 57)).sum()), sum(len(w) > 30 for w in words),
    ]


def document_statistics(documents: DataFrame) -> DataFrame:
    """``doc_id`` and the counts of every row. A NULL or empty text counts nothing; other columns are not read."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in text_slices(batches):
            rows = list(zip(*map(_counts, texts)))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(c, pa.int64()) for c in rows)], ["doc_id", *COUNTS]
            )

    schema = ", ".join(["doc_id long", *(f"{c} long" for c in COUNTS)])
    return documents.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, schema)


def features(counts: np.ndarray) -> np.ndarray:
    """The features, in the order of ``FEATURES``, from counts in the order of ``COUNTS``; shares of nothing are 0."""
    c = dict(zip(COUNTS, counts.astype(float).T))
    words, lines, chars = (np.maximum(c[n], 1) for n in ("n_words", "n_lines", "word_chars"))
    return np.stack([
        c["n_symbols"] / words, c["n_dup_lines"] / lines, c["n_repeat_words"] / words, c["word_chars"] / words,
        c["n_distinct"] / words, c["n_ended_lines"] / lines, c["n_letters"] / chars, c["n_digits"] / chars,
        c["n_long_words"] / words, c["n_words"] / lines, np.log1p(c["n_words"]),
    ], axis=1)


def base_failed(counts: np.ndarray) -> np.ndarray:
    words, repeated = counts[:, COUNTS.index("n_words")], counts[:, COUNTS.index("n_repeat_words")]
    return (words < MIN_WORDS) | (100 * repeated > MAX_REPEAT_PERCENT * words)


def fit_quality(documents: DataFrame, labels: DataFrame, max_labelled: int = MAX_LABELLED) -> boosting.Forest:
    """Trees that tell good from bad, on at most ``max_labelled`` labels and of these on what the fixed rules leave.

    Labels without a quality or document are passed over; a document with two labels counts with each, and of rows
    that repeat a document the text with the smallest hash counts. With no labels at all, every document is as good
    as any other. The labels that count are broadcast: their number is bounded, and so is what reaches the driver.
    """
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("double").alias("label"))
    sample = known.dropna().orderBy(F.xxhash64("doc_id"), "doc_id", "label").limit(max_labelled)
    texts = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    labelled = texts.join(F.broadcast(sample), "doc_id").groupBy("doc_id", "label").agg(
        F.min_by("text", F.xxhash64("text")).alias("text"))
    found = document_statistics(labelled.select(F.col("label").cast("long").alias("doc_id"), "text")).toPandas()
    found = found.sort_values(found.columns.tolist())
    counts = found[COUNTS].to_numpy(np.int64)
    left = ~base_failed(counts) if len(counts) else np.zeros(0, bool)
    y = found["doc_id"].to_numpy(float)[left]
    x = features(counts[left]) if left.any() else np.zeros((0, len(FEATURES)))
    return boosting.fit(x, y, tuple(FEATURES.values()))


def _judge(forest: boosting.Forest, least: float, texts: list[bytes]):
    """Counts of some texts, which of them fail the fixed rules, their probabilities, and which stay."""
    counts = np.array([_counts(t) for t in texts], np.int64).reshape(-1, len(COUNTS))
    failed, quality = base_failed(counts), forest.probability(features(counts))
    return counts, failed, quality, ~failed & (quality >= least)


def quality_verdicts(
    documents: DataFrame, labels: DataFrame, max_labelled: int = MAX_LABELLED, least: float = LEAST_PROBABILITY
) -> DataFrame:
    """Statistics, ``base_failed``, ``quality`` (probability of a good document) and ``kept`` of every row.

    A NULL or empty text fails; rows that repeat a document get a row each; other columns are not read.
    """
    forest = fit_quality(documents, labels, max_labelled)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in text_slices(batches):
            counts, *verdict = _judge(forest, least, texts)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *map(pa.array, counts.T), *map(pa.array, verdict)],
                ["doc_id", *COUNTS, "base_failed", "quality", "kept"],
            )

    schema = ", ".join(["doc_id long", *(f"{c} long" for c in COUNTS), "base_failed boolean", "quality double", "kept boolean"])
    return documents.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, schema)


def keep_good(
    documents: DataFrame, labels: DataFrame, max_labelled: int = MAX_LABELLED, least: float = LEAST_PROBABILITY
) -> DataFrame:
    """The rows of ``documents`` that the verdicts keep, with all their columns, in one pass without a shuffle."""
    forest = fit_quality(documents, labels, max_labelled)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in text_slices(batches):
            yield batch.filter(pa.array(_judge(forest, least, texts)[3]))

    return documents.mapInArrow(run, documents.schema)
