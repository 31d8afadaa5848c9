"""Which keys of a row occur elsewhere too: a distributed count of packed 64-bit keys.

Rows ask about their keys; the answer to a row is those of its keys that occur at least twice over all rows, each
with a count (up to ``HOT``) and an owner, one of the rows that hold it. Keys travel packed, about 6 or 10 bytes
each, in blocks by key range, and answers travel back in blocks by row. Both kinds of block are even, because keys
and rows are hashed.

A key that many rows share is counted before it is shuffled: a slice of rows in which it occurs ``hot`` times
knows the answer, gives it to its own rows, and sends one note for them all. So no task meets more than ``hot``
occurrences of a key from any slice.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from kerbside.llm.words import mix, text_slices

#: Counts stop here.
HOT = 64

_PACKED = "part int, kind int, rows binary, keys binary, counts binary, owners binary"
_NAMES = ["part", "kind", "rows", "keys", "counts", "owners"]
_TYPES = [pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.binary(), pa.binary()]
_ASK, _NOTE, _ANSWER = 0, 1, 2

ANSWERS = "row_id long, keys binary, counts binary, owners binary"


def pack_ids(ids: np.ndarray) -> bytes:
    """Integers as the first one and the steps between them, in the narrowest type that holds these."""
    steps = np.diff(ids)
    for kind in (np.int8, np.int16, np.int32):
        info = np.iinfo(kind)
        if not len(steps) or (steps.min() >= info.min and steps.max() <= info.max):
            return bytes([info.bits // 8]) + ids[:1].tobytes() + steps.astype(kind).tobytes()
    return b"\x08" + ids[:1].tobytes() + steps.tobytes()


def unpack_ids(data: bytes) -> np.ndarray:
    kind = {1: np.int8, 2: np.int16, 4: np.int32, 8: np.int64}[data[0]]
    steps = np.frombuffer(data, kind, offset=9).astype(np.int64)
    return np.cumsum(np.concatenate([np.frombuffer(data[1:9], np.int64), steps]))


def block_of(keys: np.ndarray, blocks: int) -> np.ndarray:
    """Block of a key, by its upper half."""
    return (((keys >> np.uint64(32)) * np.uint64(blocks)) >> np.uint64(32)).astype(np.int64)


def short_keys(keys: np.ndarray, blocks: int) -> np.ndarray:
    """Keys as far as ``width=4`` tells them apart: block and lower half."""
    return (block_of(keys, blocks).astype(np.uint64) << np.uint64(32)) | (keys & np.uint64(0xFFFFFFFF))


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), _TYPES)], _NAMES)


def _cuts(parts: np.ndarray) -> Iterator[tuple[int, slice]]:
    """(part, its slice) of a sorted array of parts."""
    found, first = np.unique(parts, return_index=True)
    for part, a, b in zip(found.tolist(), first, [*first[1:], len(parts)]):
        yield part, slice(int(a), int(b))


def _row_parts(rows: np.ndarray, blocks: int) -> np.ndarray:
    return (mix(rows.view(np.uint64)) % np.uint64(blocks)).astype(np.int64)


def _answers(rows, keys, counts, owners, blocks: int, owned: bool) -> list[tuple]:
    parts = _row_parts(rows, blocks)
    order = np.lexsort((rows, parts))
    parts, rows, keys, counts, owners = (x[order] for x in (parts, rows, keys, counts, owners))
    return [
        (p, _ANSWER, pack_ids(rows[s]), keys[s].tobytes(), counts[s].tobytes(), owners[s].tobytes() if owned else b"")
        for p, s in _cuts(parts)
    ]


def _ask(keys_of: Callable, blocks: int, width: int, hot: int, owned: bool):
    kind = np.uint32 if width == 4 else np.uint64

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in text_slices(batches):
            row_ids = batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64)
            place, keys = keys_of(texts)
            if not len(keys):
                continue
            rows = row_ids[place]
            order = np.lexsort((rows, keys))
            keys, rows = keys[order], rows[order]
            first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
            sizes = np.diff(np.append(first, len(keys)))
            known = sizes >= hot
            often = np.repeat(known, sizes)
            out = []
            part_of = (lambda k: (k >> np.uint64(32)).astype(np.int64)) if width == 4 else (lambda k: block_of(k, blocks))
            if known.any():
                owners = rows[first]  # the smallest row of the slice that holds the key
                k, r, o = keys[often], rows[often], np.repeat(owners, sizes)[often]
                keep = np.concatenate([[True], (k[1:] != k[:-1]) | (r[1:] != r[:-1])])
                out += _answers(r[keep], k[keep], np.full(keep.sum(), HOT, np.uint8), o[keep], blocks, owned)
                k, o = keys[first][known], owners[known]
                out += [
                    (p, _NOTE, pack_ids(o[s]), k[s].astype(kind).tobytes(), b"", b"") for p, s in _cuts(part_of(k))
                ]
            keys, rows = keys[~often], rows[~often]
            parts = part_of(keys)
            order = np.lexsort((rows, parts))
            parts, keys, rows = parts[order], keys[order].astype(kind), rows[order]
            out += [(p, _ASK, pack_ids(rows[s]), keys[s].tobytes(), b"", b"") for p, s in _cuts(parts)]
            yield _batch(out)

    return run


def _count(blocks: int, width: int, owned: bool):
    """One block of keys: finds those that occur more than once and answers the rows that asked."""
    kind = np.uint32 if width == 4 else np.uint64

    def read(rows: list[tuple]) -> tuple[np.ndarray, np.ndarray]:
        if not rows:
            return np.zeros(0, np.int64), np.zeros(0, np.uint64)
        keys = [np.frombuffer(k, kind).astype(np.uint64) | np.uint64(p << 32 if width == 4 else 0) for p, k, _ in rows]
        return np.concatenate([unpack_ids(r) for _, _, r in rows]), np.concatenate(keys)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asks, notes = [], []
        for batch in batches:
            columns = [c.to_pylist() for c in batch.columns]
            passed = []
            for part, what, rows, keys, counts, owners in zip(*columns):
                if what == _ANSWER:
                    passed.append((part, what, rows, keys, counts, owners))
                else:
                    (asks if what == _ASK else notes).append((part, keys, rows))
            if passed:
                yield _batch(passed)
        rows, keys = read(asks)
        asks.clear()
        noted_rows, noted = read(notes)
        if not len(keys):
            return
        order = np.argsort(keys, kind="stable")
        keys, rows = keys[order], rows[order]
        del order
        first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
        sizes = np.diff(np.append(first, len(keys)))
        totals, owners = np.minimum(sizes, HOT), np.minimum.reduceat(rows, first)
        if len(noted):
            group = np.searchsorted(keys[first], noted)
            known = (group < len(first)) & (keys[first][np.minimum(group, len(first) - 1)] == noted)
            totals[group[known]] = HOT
            np.minimum.at(owners, group[known], noted_rows[known])
        shared = totals > 1
        if shared.any():
            keep, sizes = np.repeat(shared, sizes), sizes[shared]
            counts, owners = np.repeat(totals[shared].astype(np.uint8), sizes), np.repeat(owners[shared], sizes)
            yield _batch(_answers(rows[keep], keys[keep], counts, owners, blocks, owned))

    return run


def _collect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One block of rows: a row of packed answers each."""
    parts = []
    for batch in batches:
        for rows, keys, counts, owners in zip(*(batch.column(c).to_pylist() for c in _NAMES[2:])):
            keys = np.frombuffer(keys, np.uint64)
            owners = np.frombuffer(owners, np.int64) if owners else np.zeros(len(keys), np.int64)
            parts.append((unpack_ids(rows), keys, np.frombuffer(counts, np.uint8), owners))
    if not parts:
        return
    rows, keys, counts, owners = (np.concatenate(x) for x in zip(*parts))
    order = np.lexsort((owners, keys, rows))
    rows, keys, counts, owners = rows[order], keys[order], counts[order], owners[order]
    # A row that stands in several slices may be answered by each. Every owner it is told of stays: as the owner of
    # one slice it is expected there, also where another names a smaller one.
    new = np.concatenate([[True], (rows[1:] != rows[:-1]) | (keys[1:] != keys[:-1]) | (owners[1:] != owners[:-1])])
    rows, keys, counts, owners = rows[new], keys[new], counts[new], owners[new]
    out = [(r, keys[s].tobytes(), counts[s].tobytes(), owners[s].tobytes()) for r, s in _cuts(rows)]
    for at in range(0, len(out), 2000):
        columns = zip(*out[at:at + 2000])
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(columns, [pa.int64(), pa.binary(), pa.binary(), pa.binary()])],
            ["row_id", "keys", "counts", "owners"],
        )


def blocks_for(df: DataFrame) -> int:
    """Twice the session's shuffle partitions, a setting that follows the size of the data: a block fits in a task."""
    return 2 * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def shared_keys(
    rows: DataFrame,
    keys_of: Callable[[list[bytes]], tuple[np.ndarray, np.ndarray]],
    blocks: int,
    width: int = 8,
    hot: int = 2,
    owned: bool = True,
) -> DataFrame:
    """Answers for the rows ``(row_id, text)`` of which any key occurs twice or more over all rows.

    ``keys_of`` maps the texts of a slice to (index of the text, key), one per occurrence; ``row_id`` must not be
    NULL. With ``width=4`` keys must be ``short_keys``: told apart by block and 32 bits only, some may look shared
    that are not.
    Counts are of occurrences and stop at ``HOT``; keys are sorted within a row. A key has an entry for each owner
    that the row was told of, and an owner is always told of itself. Without ``owned`` owners are zeros and keys
    stand once.
    """
    return (
        rows.select(F.col("row_id").cast("long"), "text")
        .mapInArrow(_ask(keys_of, blocks, width, hot, owned), _PACKED)
        .repartitionById(blocks, F.col("part"))
        .mapInArrow(_count(blocks, width, owned), _PACKED)
        .repartitionById(blocks, F.col("part"))
        .mapInArrow(_collect, ANSWERS)
    )
