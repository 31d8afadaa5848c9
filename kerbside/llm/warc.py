"""WARC archives as seekable Zstandard bundles.

Pages become WARC records, and records go in groups into independent Zstandard frames, so that one group can be
read without those before it. A bundle is some frames, their index and a footer, and is a file of its own. The
footer is a seek table in a skippable frame, with the compressed and decompressed size of every frame, ending in the
seek table's magic number. The index, a skippable frame too, maps each record's identifier to its frame and its
offset in the decompressed frame; records are read through it. Plain Zstandard tools read a bundle as one stream.

Of records with equal payloads the one with the smallest page id keeps its payload (response); the others refer
to it (revisit) and keep their headers, which hold the payload's length and digest.
"""

from __future__ import annotations

import base64
import hashlib
import struct
import uuid
from collections.abc import Iterator
from itertools import groupby

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession, functions as F

from kerbside.llm.words import text_slices

FRAME_BYTES = 1 << 20
BUNDLE_BYTES = 16 << 20

# Fixed values of the seekable format: magic number of the skippable frame that holds the table, magic number
# at the end of the table, and its descriptor byte (no checksums). The index has a skippable frame of another number.
SKIPPABLE_MAGIC = 0x184D2A5E
INDEX_MAGIC = 0x184D2A50
SEEKABLE_MAGIC = b"\xb1\xea\x92\x8f"
DESCRIPTOR = 0

#: A record in the index: number of its identifier, page id and whether it has one, frame, offset.
_ENTRY = "<16sq?II"
_URN = "<urn:uuid:{}>"

REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP_HEAD = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {}\r\n\r\n"
RECORD_DATE = "1970-01-01T00:00:00Z"

RECORD_SCHEMA = (
    "record_id string, page_id long, record_type string, refers_to long, payload_bytes long, "
    "payload_digest string, payload binary"
)


def record_id(page_id: int | None, url: str) -> str:
    """Identifier of a page's record; pages without an id are told apart by their address."""
    name = f"url:{url}" if page_id is None else f"page:{page_id}"
    return _URN.format(uuid.uuid5(uuid.NAMESPACE_URL, name))


def _record(page_id: int | None, url: str, payload: bytes, first: int | None, digest: str) -> bytes:
    head = HTTP_HEAD.format(len(payload)).encode()
    fields = [
        ("WARC-Type", "response" if first is None else "revisit"),
        ("WARC-Record-ID", record_id(page_id, url)),
        ("WARC-Date", RECORD_DATE),
        ("WARC-Target-URI", "".join(url.split()) or "about:blank"),
        ("WARC-Payload-Digest", f"sha1:{digest}"),
        ("Content-Type", "application/http; msgtype=response"),
    ]
    if page_id is not None:
        fields.append(("X-Page-ID", str(page_id)))
    if first is None:
        body = head + payload
    else:
        body = head
        fields += [
            ("WARC-Profile", REVISIT_PROFILE),
            ("WARC-Refers-To", record_id(first, "")),
            ("X-Refers-To-Page-ID", str(first)),
        ]
    fields.append(("Content-Length", str(len(body))))
    lines = "".join(f"{k}: {v}\r\n" for k, v in fields)
    return b"WARC/1.1\r\n" + lines.encode() + b"\r\n" + body + b"\r\n\r\n"


def parse_records(data: bytes, at: int = 0) -> Iterator[tuple[int, dict[str, str], bytes]]:
    """(offset, header fields, block) of the records in a decompressed frame, from the one at ``at``."""
    while at < len(data):
        end = data.index(b"\r\n\r\n", at)
        lines = data[at:end].decode().split("\r\n")
        if lines[0] != "WARC/1.1":
            raise ValueError(f"no WARC record at {at}")
        fields = dict(line.split(": ", 1) for line in lines[1:])
        length = int(fields["Content-Length"])
        yield at, fields, data[end + 4:end + 4 + length]
        at = end + 4 + length + 4


def seek_table(sizes: list[tuple[int, int]]) -> bytes:
    """Footer for frames of these (compressed, decompressed) sizes."""
    body = b"".join(struct.pack("<II", *s) for s in sizes) + struct.pack("<IB", len(sizes), DESCRIPTOR)
    return struct.pack("<II", SKIPPABLE_MAGIC, len(body) + len(SEEKABLE_MAGIC)) + body + SEEKABLE_MAGIC


def read_seek_table(bundle: bytes) -> list[tuple[int, int, int]]:
    """(offset, compressed size, decompressed size) of every frame."""
    if bundle[-4:] != SEEKABLE_MAGIC:
        raise ValueError("no seek table at the bundle's end")
    count, _ = struct.unpack("<IB", bundle[-9:-4])
    table = bundle[-9 - 8 * count:-9]
    found, at = [], 0
    for i in range(count):
        packed, plain = struct.unpack_from("<II", table, 8 * i)
        found.append((at, packed, plain))
        at += packed
    return found


def index_frame(entries: list[tuple[str, int | None, int, int]]) -> bytes:
    """Skippable frame with (identifier, page id, frame, offset) of a bundle's records."""
    body = b"".join(
        struct.pack(_ENTRY, uuid.UUID(name[10:-1]).bytes, page_id or 0, page_id is not None, frame, offset)
        for name, page_id, frame, offset in entries
    )
    return struct.pack("<II", INDEX_MAGIC, len(body)) + body


def read_index(bundle: bytes) -> list[tuple[str, int | None, int, int]]:
    """(identifier, page id, frame, offset) of a bundle's records, without touching their frames."""
    at, packed, plain = read_seek_table(bundle)[-1]
    magic, size = struct.unpack_from("<II", bundle, at)
    if plain or magic != INDEX_MAGIC or size != packed - 8:
        raise ValueError("no index before the seek table")
    return [
        (_URN.format(uuid.UUID(bytes=number)), page_id if known else None, frame, offset)
        for number, page_id, known, frame, offset in struct.iter_unpack(_ENTRY, bundle[at + 8:at + packed])
    ]


def read_frame(bundle: bytes, frame: int) -> bytes:
    """One frame of a bundle, decompressed without touching the others."""
    at, packed, plain = read_seek_table(bundle)[frame]
    return zstandard.ZstdDecompressor().decompress(bundle[at:at + packed], max_output_size=plain)


def read_record(bundle: bytes, frame: int, offset: int) -> tuple[dict[str, str], bytes]:
    """The record that the index places at ``offset`` of ``frame``."""
    _, fields, block = next(parse_records(read_frame(bundle, frame), offset))
    return fields, block


def indexed_records(bundle: bytes) -> Iterator[list[tuple[dict[str, str], bytes]]]:
    """Every record that a bundle's index names, by frame; each frame is decompressed once."""
    for frame, entries in groupby(read_index(bundle), key=lambda entry: entry[2]):
        data, found = read_frame(bundle, frame), []
        for name, _, _, offset in entries:
            _, fields, block = next(parse_records(data, offset))
            if fields["WARC-Record-ID"] != name:
                raise ValueError(f"no record {name} at {offset}")
            found.append((fields, block))
        yield found


def classify(pages: DataFrame, min_payload: int = 0) -> DataFrame:
    """``page_id`` and ``first``: the smallest page id with an equal payload, NULL for responses.

    Pages that repeat the smallest id are all responses, as are pages in a group without any id, and payloads
    under ``min_payload`` bytes. Only digests are shuffled; the smallest id of a digest is found on the map
    side first, and the join may split a hot digest.
    """
    payload = F.coalesce(F.col("html").cast("binary"), F.lit(b""))
    keyed = pages.select(
        F.col("page_id").cast("long").alias("page_id"),
        F.sha2(payload, 256).alias("digest"),
        F.octet_length(payload).alias("size"),
    )
    firsts = (
        keyed.where(F.col("size") >= min_payload).groupBy("digest").agg(
            F.min("page_id").alias("first"), F.count(F.lit(1)).alias("n"))
        .where((F.col("n") > 1) & F.col("first").isNotNull()).select("digest", "first")
    )
    return keyed.join(firsts, "digest").where(
        F.col("page_id").isNull() | (F.col("page_id") != F.col("first"))
    ).select("page_id", "digest", "first").distinct()


def _bundles(frame_bytes: int, bundle_bytes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = zstandard.ZstdCompressor(level=3)
        frames, sizes, pending, index, total = [], [], bytearray(), [], 0

        def close_frame() -> None:
            nonlocal total
            if pending:
                frames.append(packer.compress(bytes(pending)))
                sizes.append((len(frames[-1]), len(pending)))
                total += len(frames[-1])
                pending.clear()

        def close_bundle() -> pa.RecordBatch:
            nonlocal total
            # The file sink appends the last four bytes, the table's magic number, as its line separator.
            frames.append(index_frame(index))
            sizes.append((len(frames[-1]), 0))
            bundle = b"".join(frames) + seek_table(sizes)[:-4]
            frames.clear(), sizes.clear(), index.clear()
            total = 0
            return pa.RecordBatch.from_pydict({"bundle": pa.array([bundle], pa.binary())})

        for batch, texts in text_slices(batches, "html"):
            columns = (batch.column(c).to_pylist() for c in ("page_id", "url", "first"))
            for page_id, url, first, payload in zip(*columns, texts):
                digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
                index.append((record_id(page_id, url or ""), page_id, len(sizes), len(pending)))
                pending += _record(page_id, url or "", payload, first, digest)
                if len(pending) >= frame_bytes:
                    close_frame()
                    if total >= bundle_bytes:
                        yield close_bundle()
        close_frame()
        if frames:
            yield close_bundle()

    return run


def write_archive(
    pages: DataFrame, path: str, frame_bytes: int = FRAME_BYTES, bundle_bytes: int = BUNDLE_BYTES, min_payload: int = 0
) -> None:
    """Write every page's record to bundles under ``path``, through Spark's own file committer.

    A NULL html is an empty payload, a NULL url an empty address; repeated pages are records of their own. Other
    columns are not read. Each bundle, with its index, is one file.
    """
    payload = F.coalesce(F.col("html").cast("binary"), F.lit(b""))
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
        F.col("html").cast("string").alias("html"),
    )
    later = classify(pages, min_payload)
    same = F.col("r.page_id").eqNullSafe(F.col("l.page_id")) & (F.col("r.digest") == F.col("l.digest"))
    marked = (
        rows.withColumn("digest", F.sha2(payload, 256)).alias("r").join(later.alias("l"), same, "left")
        .select("r.page_id", "url", "html", "first")
    )
    (
        marked.mapInArrow(_bundles(frame_bytes, bundle_bytes), "bundle binary")
        .select(F.col("bundle").cast("string"))
        .write.option("maxRecordsPerFile", 1).option("encoding", "ISO-8859-1").option("lineSep", SEEKABLE_MAGIC.decode("latin-1"))
        .text(path)
    )


def _files(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.format("binaryFile").option("pathGlobFilter", "*.txt").load(path).select("path", "content")


def read_archive(spark: SparkSession, path: str, payloads: bool = True) -> DataFrame:
    """Every record that the archive's indexes name: its identity, what it refers to, and payload length and digest.

    Length and digest of a response come from the payload as read, and a digest other than the header's stops
    the job; those of a revisit come from its headers.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for bundle in batch.column("content").to_pylist():
                for records in indexed_records(bundle):
                    rows = [_row(fields, block, payloads) for fields, block in records]
                    yield pa.RecordBatch.from_pylist(rows, _ARROW)

    return _files(spark, path).mapInArrow(run, RECORD_SCHEMA)


_ARROW = pa.schema([
    ("record_id", pa.string()), ("page_id", pa.int64()), ("record_type", pa.string()), ("refers_to", pa.int64()),
    ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("payload", pa.binary()),
])


def _row(fields: dict[str, str], block: bytes, payloads: bool) -> dict:
    head, _, payload = block.partition(b"\r\n\r\n")
    stated = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    size, digest = int(stated["Content-Length"]), fields["WARC-Payload-Digest"].removeprefix("sha1:")
    revisit = fields["WARC-Type"] == "revisit"
    if not revisit:
        size, read = len(payload), base64.b32encode(hashlib.sha1(payload).digest()).decode()
        if read != digest:
            raise ValueError(f"payload of {fields['WARC-Record-ID']} does not have its digest")
    page_id, first = fields.get("X-Page-ID"), fields.get("X-Refers-To-Page-ID")
    return {
        "record_id": fields["WARC-Record-ID"], "page_id": None if page_id is None else int(page_id),
        "record_type": fields["WARC-Type"], "refers_to": None if first is None else int(first),
        "payload_bytes": size, "payload_digest": digest, "payload": payload if payloads and not revisit else None,
    }


def index_archive(spark: SparkSession, path: str) -> DataFrame:
    """(record_id, page_id, file, frame, offset): where each record stands, from the bundles' indexes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["record_id", "page_id", "file", "frame", "offset"]
        types = [pa.string(), pa.int64(), pa.string(), pa.int32(), pa.int64()]
        for batch in batches:
            for file, bundle in zip(batch.column("path").to_pylist(), batch.column("content").to_pylist()):
                rows = [(name, page_id, file, frame, offset) for name, page_id, frame, offset in read_index(bundle)]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names)

    return _files(spark, path).mapInArrow(run, "record_id string, page_id long, file string, frame int, offset long")


def look_up(spark: SparkSession, path: str, wanted: DataFrame) -> DataFrame:
    """The records whose ``record_id`` stands in ``wanted``: only their frames are decompressed, once each.

    Identifiers that the archive does not hold give no row. The index is joined with what is wanted, and a bundle's
    places, which its size bounds, go with the bundle's file. Other columns are not read.
    """
    names = wanted.select(F.col("record_id").cast("string").alias("record_id"))
    places = index_archive(spark, path).join(names, "record_id", "left_semi").groupBy("file").agg(
        F.array_sort(F.collect_list(F.struct("frame", "offset"))).alias("places"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for bundle, at in zip(batch.column("content").to_pylist(), batch.column("places").to_pylist()):
                for frame, group in groupby(at, key=lambda place: place["frame"]):
                    data = read_frame(bundle, frame)
                    records = (next(parse_records(data, place["offset"])) for place in group)
                    yield pa.RecordBatch.from_pylist([_row(fields, block, True) for _, fields, block in records], _ARROW)

    held = _files(spark, path).join(places, F.col("path") == F.col("file")).select("content", "places")
    return held.mapInArrow(run, RECORD_SCHEMA)
