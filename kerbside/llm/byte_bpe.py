"""Byte-level BPE encoding and decoding, long texts in overlapping chunks.

A text of more than ``CHUNK`` characters is cut into chunks that overlap. Each chunk is split into pre-tokens
on its own. The splitting pattern looks forward only, so where two neighbours begin a pre-token at the same
character they agree from there on: the first such place in the overlap is where one hands over to the other.
Each chunk then encodes the pre-tokens between its two hand-overs, and the chunks' ids are joined per text. A
text in which some neighbours never meet (one pre-token longer than the overlap) is split as a whole instead.
Decoding concatenates the bytes of the ids.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from kerbside.llm.words import text_slices

CHUNK = 65_536
OVERLAP = 2_048
#: Characters at a chunk's end whose absence could still change how the pattern matches before them.
MARGIN = 8
CACHE_PIECES = 150_000

ENCODED = "doc_id long, ids binary"
DECODED = ENCODED + ", decoded binary"


class Codec:
    """Ranks and pattern of one vocabulary; remembers the ids of pieces it has seen, up to a bound."""

    def __init__(self, ranks_path: str, pattern: str):
        import regex
        import tiktoken

        with open(ranks_path, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.pattern = regex.compile(pattern)
        self._core = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})._core_bpe
        self._cache: dict[str, bytes] = {}
        self.bytes_of = [b""] * (max(ranks.values()) + 1)
        for piece, rank in ranks.items():
            self.bytes_of[rank] = piece

    def encode(self, pieces: list[str]) -> bytes:
        """Ids of the pieces as little-endian unsigned 32-bit integers."""
        cache = self._cache
        missing = {p for p in pieces if p not in cache}
        if missing:
            if len(cache) + len(missing) > CACHE_PIECES:
                cache = self._cache = {p: cache[p] for p in set(pieces) - missing}
            for piece in missing:
                cache[piece] = np.array(self._core.encode_single_piece(piece.encode()), "<u4").tobytes()
        return b"".join(map(cache.__getitem__, pieces))

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, np.frombuffer(ids, "<u4").tolist()))

    def starts(self, text: str) -> list[int]:
        """Starts of the pre-tokens, and the end of the last, as far as they don't depend on what follows."""
        ends = [m.end() for m in self.pattern.finditer(text)]
        return [0, *(e for e in ends if e <= len(text) - MARGIN)]

    def pieces(self, text: str, first: int, last: int) -> list[str]:
        """Pre-tokens from one place where a pre-token starts to another."""
        found = []
        for m in self.pattern.finditer(text, first):
            if m.start() >= last:
                break
            found.append(m.group())
        return found


@lru_cache(maxsize=2)
def codec(ranks_path: str, pattern: str) -> Codec:
    return Codec(ranks_path, pattern)


def _cut(chunk: int, overlap: int):
    """Rows (doc_id, text_key, k, start, total, text): one per chunk."""
    step = chunk - overlap

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for doc_id, key, text in zip(*(c.to_pylist() for c in batch.columns)):
                starts = range(0, max(len(text) - overlap, 1), step)
                for k, start in enumerate(starts):
                    yield pa.RecordBatch.from_pydict({
                        "doc_id": pa.array([doc_id], pa.int64()), "text_key": pa.array([key], pa.string()),
                        "k": pa.array([k], pa.int32()), "start": pa.array([start], pa.int64()),
                        "total": pa.array([len(text)], pa.int64()), "last": pa.array([start == starts[-1]]),
                        "text": pa.array([text[start:start + chunk]]),
                    })

    return run


def _boundaries(ranks_path: str, pattern: str, chunk: int, overlap: int):
    """Adds ``head`` and ``tail``: where pre-tokens start in the overlap with the chunk before and after."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = codec(ranks_path, pattern)
        for batch in batches:
            heads, tails = [], []
            for start, text in zip(batch.column("start").to_pylist(), batch.column("text").to_pylist()):
                at = np.array(found.starts(text), np.int64)
                heads.append((start + at[at <= overlap]).tolist())
                tails.append((start + at[at >= chunk - overlap]).tolist())
            lists = [pa.array(x, pa.list_(pa.int64())) for x in (heads, tails)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *lists], [*batch.schema.names, "head", "tail"])

    return run


def _encode_spans(ranks_path: str, pattern: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = codec(ranks_path, pattern)
        for batch in batches:
            columns = (batch.column(c).to_pylist() for c in ("text", "start", "sync", "until"))
            ids = [found.encode(found.pieces(t, a - s, b - s)) for t, s, a, b in zip(*columns)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("text_key"), batch.column("k"), pa.array(ids, pa.binary())],
                ["doc_id", "text_key", "k", "ids"],
            )

    return run


def _decoded(found: Codec, ids: list[bytes], decode: bool) -> dict[str, pa.Array]:
    return {"decoded": pa.array([found.decode(x) for x in ids], pa.binary())} if decode else {}


def _join_chunks(ranks_path: str, pattern: str, decode: bool):
    """One text's ids. Rows that repeat a document bring each chunk as often and get a row each."""

    def run(table: pa.Table) -> pa.Table:
        k = table.column("k").to_pylist()
        by_place = dict(zip(k, table.column("ids").to_pylist()))
        ids = [b"".join(by_place[i] for i in sorted(by_place))] * k.count(0)
        doc_ids = pa.array([table.column("doc_id")[0].as_py()] * len(ids), pa.int64())
        return pa.table({"doc_id": doc_ids, "ids": ids} | _decoded(codec(ranks_path, pattern), ids, decode))

    return run


def _encode_whole(ranks_path: str, pattern: str, decode: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = codec(ranks_path, pattern)
        for batch, texts in text_slices(batches):
            ids = [found.encode(found.pattern.findall(t.decode())) for t in texts]
            columns = {"doc_id": batch.column(0), "ids": pa.array(ids, pa.binary())} | _decoded(found, ids, decode)
            yield pa.RecordBatch.from_pydict(columns)

    return run


def encode_documents(
    documents: DataFrame,
    ranks_path: str,
    pattern: str,
    chunk: int = CHUNK,
    overlap: int = OVERLAP,
    decode: bool = False,
) -> DataFrame:
    """``doc_id`` and ``ids`` (little-endian unsigned 32-bit integers) of every row of ``documents``.

    A NULL or empty text has no ids. Each row gets a row, repeated rows and NULL ids too; other columns are not
    read. Special tokens are ordinary text. Only chunks of long texts are shuffled; a text's ids meet in one
    task, so a single text must fit in a task's memory. ``decode`` adds the bytes that the ids decode to as
    ``decoded``, in the same pass.
    """
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    size = F.coalesce(F.octet_length("text"), F.lit(0))
    short = rows.where(size <= chunk)
    whole, out = _encode_whole(ranks_path, pattern, decode), DECODED if decode else ENCODED

    long = rows.where(size > chunk).select("doc_id", F.sha2("text", 256).alias("text_key"), "text")
    cut = "doc_id long, text_key string, k int, start long, total long, last boolean, text string"
    chunks = (
        long.mapInArrow(_cut(chunk, overlap), cut)
        .repartition("doc_id", "text_key", "k")
        .mapInArrow(_boundaries(ranks_path, pattern, chunk, overlap), cut + ", head array<long>, tail array<long>")
    )
    of_text = ["doc_id", "text_key"]
    # Equal rows bring equal chunks: the neighbour is looked up by number, not by row.
    before = Window.partitionBy(*of_text).orderBy("k").rangeBetween(-1, -1)
    synced = chunks.withColumn("before", F.first("tail").over(before))
    meet = F.array_min(F.array_intersect("head", "before"))
    synced = synced.withColumn("sync", F.when(F.col("k") == 0, F.lit(0)).otherwise(meet)).drop("head", "tail", "before")
    after = Window.partitionBy(*of_text).orderBy("k").rangeBetween(1, 1)
    spans = synced.withColumns({
        "until": F.when(F.col("last"), F.col("total")).otherwise(F.min("sync").over(after)),
        "broken": F.max(F.col("sync").isNull()).over(Window.partitionBy(*of_text)),
    })
    joined = (
        spans.where(~F.col("broken"))
        .mapInArrow(_encode_spans(ranks_path, pattern), "doc_id long, text_key string, k int, ids binary")
        .groupBy(*of_text).applyInArrow(_join_chunks(ranks_path, pattern, decode), out)
    )
    broken = spans.where(F.col("broken")).select("text_key").distinct()
    unmet = long.join(broken, "text_key", "left_semi").select("doc_id", "text")
    return (
        short.mapInArrow(whole, out).unionByName(joined).unionByName(unmet.mapInArrow(whole, out))
    )


def decode_documents(encoded: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    """``encoded`` with the bytes of its ids as ``decoded``; NULL ids decode to no bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = codec(ranks_path, pattern)
        for batch, ids in text_slices(batches, "ids"):
            decoded = pa.array([found.decode(x) for x in ids], pa.binary())
            yield pa.RecordBatch.from_arrays([*batch.columns, decoded], ["doc_id", "ids", "decoded"])

    return encoded.select("doc_id", "ids").mapInArrow(run, DECODED)


def digests(decoded: DataFrame) -> DataFrame:
    """Per row: number of ids, and the SHA-256 of the ids and of the decoded bytes."""
    return decoded.select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
