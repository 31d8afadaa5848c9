"""Words and windows of words as NumPy arrays, inside Arrow batches.

A word is a run of bytes other than the ASCII white space 0x20 and 0x09 to 0x0D. Words are known by a keyed
64-bit SipHash and windows by a polynomial of their words' hashes, so equal windows always have equal hashes.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import SparkSession

SLICE_BYTES = 2 << 20
#: Bytes of an Arrow batch on its way to Python, besides its last row.
BATCH_BYTES = 4 << 20

_FACTOR = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))


def bound_batches(spark: SparkSession) -> None:
    """Bound the session's Arrow batches by bytes: 10,000 rows of long texts would be hundreds of megabytes a task.

    A lower bound that the session has already stays.
    """
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    now = spark.conf.get(key, None)
    if now is None or not 0 < int(re.sub(r"\D", "", now)) <= BATCH_BYTES:
        spark.conf.set(key, str(BATCH_BYTES))


def text_slices(
    batches: Iterator[pa.RecordBatch], text: str = "text", limit: int = SLICE_BYTES
) -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    """Arrow batches cut to about ``limit`` bytes of text, with the texts as bytes; a NULL text is empty.

    A text is never cut, so one longer than ``limit`` is a slice of its own.
    """
    for batch in batches:
        column = batch.column(batch.schema.get_field_index(text)).cast(pa.binary())
        first, size = 0, 0
        lengths = np.array([0 if x is None else x for x in pa.compute.binary_length(column).to_pylist()])
        for row, length in enumerate(lengths):
            if size and size + length > limit:
                yield batch.slice(first, row - first), [x or b"" for x in column.slice(first, row - first).to_pylist()]
                first, size = row, 0
            size += length
        if first < batch.num_rows:
            yield batch.slice(first), [x or b"" for x in column.slice(first).to_pylist()]
    pa.default_memory_pool().release_unused()  # workers live on between tasks


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values evenly (the finaliser of MurmurHash3)."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def word_hashes(words: list[bytes]) -> np.ndarray:
    if not words:
        return np.zeros(0, np.uint64)
    return pd.util.hash_array(np.array(words, dtype=object), categorize=False)


def window_hashes(hashes: np.ndarray, size: int) -> np.ndarray:
    """Hash of each run of ``size`` consecutive words; empty where there are fewer words."""
    n = len(hashes)
    if n < size:
        return np.zeros(0, np.uint64)
    powers = np.cumprod(np.full(n, _FACTOR))
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(hashes * powers)])
    back = np.cumprod(np.full(n - size + 1, _INVERSE))
    return mix((sums[size:] - sums[:-size]) * back)
