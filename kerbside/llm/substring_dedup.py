"""Removal of word windows that occur elsewhere, by suffix automata of reference shards.

The reference is what the documents themselves repeat. It is found by hashes and cut into shards by the document
that owns a repeated window, so a document meets only the shards that hold something of its own:

1. Each window of ``size`` words has an anchor, its smallest n-gram by hash. Equal windows have equal anchors, so
   a window whose anchor stands at one place only is not repeated.
2. Documents with repeated anchors are cut to segments, the runs of windows whose anchors repeat.
3. Windows of segments that occur twice or more get an owner, one of the rows that hold them. Owners' own runs are
   the reference; every run goes to its owner's shard.
4. A shard's task builds the suffix automaton of one owner's passages, streams the runs through it, and keeps the
   maximal spans whose matching statistics reach ``size``.

A passage that very many documents share has an owner in each slice of documents that holds it twice, which
splits its runs. A row that stands in several slices follows every owner they name, itself included.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from kerbside.llm.exchange import blocks_for, shared_keys
from kerbside.llm.suffix_automaton import SuffixAutomaton
from kerbside.llm.words import text_slices, window_hashes, word_hashes
from kerbside.operators.staging import staged

WINDOW_WORDS = 35
ANCHOR_WORDS = 8

_WORD = re.compile(rb"[^ \t-\r]+")


def _slide(values: np.ndarray, width: int, pick) -> np.ndarray:
    """Minimum or maximum of each run of ``width`` values."""
    done, out = 1, values
    while done < width:
        step = min(done, width - done)
        out = pick(out[:-step], out[step:])
        done += step
    return out


def _anchors(texts: list[bytes], size: int, gram: int):
    """Words and counts of a slice; n-gram hashes, anchors of windows (0 where none starts), places of anchors."""
    words = [t.split() for t in texts]
    counts = np.array([len(w) for w in words], np.int64)
    hashes = word_hashes([w for own in words for w in own])
    if len(hashes) < size:
        return words, counts, None, np.zeros(0, np.uint64), np.zeros(0, np.int64)
    grams = window_hashes(hashes, gram) | np.uint64(1)
    reach = size - gram + 1
    anchors = _slide(grams, reach, np.minimum)
    ends = np.repeat(np.cumsum(counts), counts)
    anchors = np.where(np.arange(len(anchors)) + size <= ends[: len(anchors)], anchors, np.uint64(0))
    around = np.concatenate([np.zeros(reach - 1, np.uint64), anchors, np.zeros(reach - 1, np.uint64)])
    places = np.flatnonzero(_slide(around, reach, np.maximum) == grams)
    return words, counts, grams, anchors, places


def _anchor_keys(size: int, gram: int):
    def keys_of(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        _, counts, grams, _, places = _anchors(texts, size, gram)
        if grams is None:
            return np.zeros(0, np.int64), np.zeros(0, np.uint64)
        return np.repeat(np.arange(len(texts)), counts)[places], grams[places]

    return keys_of


def _runs(starts: np.ndarray) -> list[tuple[int, int]]:
    """Runs of consecutive integers, as (first, last)."""
    if not len(starts):
        return []
    breaks = np.flatnonzero(np.diff(starts) != 1)
    return list(zip(starts[np.append(0, breaks + 1)].tolist(), starts[np.append(breaks, len(starts) - 1)].tolist()))


def _segments(size: int, gram: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in text_slices(batches):
            words, counts, grams, anchors, _ = _anchors(texts, size, gram)
            if grams is None:
                continue
            rows, keys = batch.column(0).to_pylist(), batch.column(2).to_pylist()
            out, at = [], 0
            for row, own, packed in zip(rows, words, keys):
                mine = anchors[at:at + len(own)]
                at += len(own)
                repeated = np.flatnonzero(np.isin(mine, np.frombuffer(packed, np.uint64)))
                for first, last in _runs(repeated):
                    out.append((row, first, b" ".join(own[first:last + size])))
            if out:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*out), [pa.int64(), pa.int64(), pa.binary()])],
                    ["row_id", "start", "text"],
                )

    return run


def _window_keys(size: int):
    def keys_of(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        found = [window_hashes(word_hashes(t.split()), size) for t in texts]
        return np.repeat(np.arange(len(found)), [len(x) for x in found]), np.concatenate([np.zeros(0, np.uint64), *found])

    return keys_of


def _owned_runs(size: int):
    """Cuts segments to runs of repeated windows that have one owner; a window of several is in a run of each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for row, start, text, keys, owners in zip(*(c.to_pylist() for c in batch.columns)):
                words = text.split()
                hashes = window_hashes(word_hashes(words), size)
                keys, owners = np.frombuffer(keys, np.uint64), np.frombuffer(owners, np.int64)
                first, until = np.searchsorted(keys, hashes), np.searchsorted(keys, hashes, "right")
                places = np.repeat(np.arange(len(hashes)), until - first)
                nth = np.arange(len(places)) - np.repeat(np.cumsum(until - first) - (until - first), until - first)
                owner = owners[first[places] + nth]
                order = np.lexsort((places, owner))
                places, owner = places[order], owner[order]
                cuts = np.flatnonzero(np.diff(owner)) + 1
                for mine, who in zip(np.split(places, cuts), np.split(owner, cuts)):
                    for a, b in _runs(mine):
                        out.append((int(who[0]), row, start + a, b" ".join(words[a:b + size])))
            if out:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*out), [pa.int64(), pa.int64(), pa.int64(), pa.binary()])],
                    ["owner", "row_id", "start", "text"],
                )

    return run


def _match(size: int):
    """Runs in the order of their owners, an owner's own first: spans that its automaton covers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        owner, passages, automaton = None, set(), None
        for batch in batches:
            out = []
            for who, row, start, text in zip(*(c.to_pylist() for c in batch.columns)):
                if who != owner:
                    owner, passages, automaton = who, set(), None
                if row == who:
                    passages.add(text)
                    automaton = None
                    spans = [(0, len(text.split()))]
                else:
                    automaton = automaton or SuffixAutomaton([p.split() for p in sorted(passages)])
                    spans = automaton.spans(text.split(), size)
                out += [(row, start + a, start + b) for a, b in spans]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, pa.int64()) for c in (zip(*out) if out else ([], [], []))], ["row_id", "first", "until"]
            )

    return run


def repeated_spans(documents: DataFrame, size: int = WINDOW_WORDS, gram: int = ANCHOR_WORDS) -> DataFrame:
    """``row_id`` (hash of ``doc_id`` and ``text``) and ``spans`` of words to remove, of rows that have any.

    A word goes when a window of ``size`` consecutive words of its row covers it whose words also start anywhere
    else, in this row or another. Rows that repeat a document repeat its windows.
    """
    blocks = blocks_for(documents)
    rows = _rows(documents)
    anchored = shared_keys(rows, _anchor_keys(size, gram), blocks, owned=False).select("row_id", "keys")
    segments = staged(
        rows.join(anchored, "row_id").select("row_id", "text", "keys")
        .mapInArrow(_segments(size, gram), "row_id long, start long, text binary")
    )
    repeated = shared_keys(segments, _window_keys(size), blocks).select("row_id", "keys", "owners")
    runs = segments.join(repeated, "row_id").select("row_id", "start", "text", "keys", "owners").mapInArrow(
        _owned_runs(size), "owner long, row_id long, start long, text binary"
    )
    spans = (
        runs.repartition("owner")
        .sortWithinPartitions("owner", (F.col("row_id") != F.col("owner")), "row_id", "start")
        .mapInArrow(_match(size), "row_id long, first long, until long")
    )
    return spans.groupBy("row_id").agg(F.collect_set(F.struct("first", "until")).alias("spans"))


def _rows(documents: DataFrame) -> DataFrame:
    columns = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return columns.select(F.xxhash64("doc_id", "text").alias("row_id"), "doc_id", "text")


def _removed(n: int, spans: list[dict] | None) -> np.ndarray:
    gone = np.zeros(n, bool)
    for span in spans or ():
        gone[span["first"]:span["until"]] = True
    return gone


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch, texts in text_slices(batches):
        out = []
        for text, spans in zip(texts, batch.column(2).to_pylist()):
            words = text.split()
            gone = _removed(len(words), spans)
            kept = words if not spans else [w for w, g in zip(words, gone.tolist()) if not g]
            out.append((len(words), len(words) - len(kept), hashlib.sha256(b" ".join(kept)).hexdigest()))
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), *(pa.array(c) for c in zip(*out))], ["doc_id", "n_words", "n_removed", "kept_sha256"]
        )


def removal_digests(documents: DataFrame, size: int = WINDOW_WORDS) -> DataFrame:
    """``doc_id, n_words, n_removed, kept_sha256`` of every row of ``documents``; a NULL text has no words.

    ``kept_sha256`` is over the kept words joined by one space. Rows without ``doc_id`` are judged like others;
    other columns are not read.
    """
    found = _rows(documents).join(repeated_spans(documents, size), "row_id", "left").select("doc_id", "text", "spans")
    return found.mapInArrow(_digest, "doc_id long, n_words long, n_removed long, kept_sha256 string")


def remove_spans(text: str, spans: list[dict] | None) -> str:
    """``text`` without the words of ``spans``; each kept word keeps the white space before it."""
    raw = text.encode()
    places = [m.span() for m in _WORD.finditer(raw)]
    gone = _removed(len(places), spans)
    parts, before = [], 0
    for (start, end), removed in zip(places, gone.tolist()):
        if not removed:
            parts.append(raw[before:end])
        before = end
    return (b"".join(parts) + raw[before:]).decode("utf-8", "replace").strip(" \t\r\n\x0b\x0c")


def _cleaned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        at = batch.schema.get_field_index("text")
        texts = [
            t if t is None or not s else remove_spans(t, s)
            for t, s in zip(batch.column(at).to_pylist(), batch.column(batch.num_columns - 1).to_pylist())
        ]
        columns = [pa.array(texts, pa.string()) if i == at else c for i, c in enumerate(batch.columns)]
        yield pa.RecordBatch.from_arrays(columns[:-1], batch.schema.names[:-1])


def remove_repeated(documents: DataFrame, size: int = WINDOW_WORDS) -> DataFrame:
    """``documents`` with repeated windows cut out of ``text``; texts without any are unchanged."""
    key = F.xxhash64(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    keyed = documents.select(key.alias("row_id"), F.struct("*").alias("doc"))
    found = keyed.join(repeated_spans(documents, size), "row_id", "left").select("doc.*", "spans")
    return found.mapInArrow(_cleaned, documents.schema)
