"""N-gram Jaccard join as a blocked sparse product of the document by n-gram incidence with its transpose.

The product's entries are overlaps of n-gram sets. Only those that can reach the threshold are accumulated:

* Incidence is counted in blocks of n-grams. An overlap can't exceed the number of a document's n-grams that any
  other document has, so documents with too few of these drop out: they link with nothing.
* Of the others, only the rarest columns count at first: two documents that link share one of the few rarest
  n-grams of each, as many as the threshold lets a partner miss.
* Equal sets are one row of the product. Rows found linked with the hub of a column are one component, and from
  then on only rows of different components meet.
* These meet in tiles of two blocks of rows, bounded by rows and by n-grams. Overlaps accumulate over the rarest
  columns; with what the other columns can still add by the two sizes they discard pairs below the bound, and the
  rest are computed over all columns. A tile answers with the links that join its components, so no group of copies
  yields all its pairs.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from kerbside.llm.components import components
from kerbside.llm.exchange import HOT, blocks_for, shared_keys, short_keys
from kerbside.llm.words import bound_batches, mix, text_slices, window_hashes, word_hashes
from kerbside.operators.staging import staged

SHINGLE_WORDS = 5
PERCENT = 75
#: Rows and n-grams in a block of the product, and columns that are multiplied at once.
BLOCK_ROWS, BLOCK_GRAMS, TILE_COLUMNS = 256, 1 << 19, 2048


def shingle_set(text: bytes, size: int = SHINGLE_WORDS) -> np.ndarray:
    """Sorted hashes of the distinct shingles; with fewer words, of the whole sequence; else empty."""
    hashes = word_hashes(text.lower().split())
    if not len(hashes):
        return hashes
    if len(hashes) < size:
        return mix(window_hashes(hashes, len(hashes)) + np.uint64(len(hashes)))
    return np.unique(window_hashes(hashes, size))


def digest(packed_set: bytes) -> bytes | None:
    """What stands for a set; equal sets have equal digests, the empty set has none."""
    return hashlib.blake2b(packed_set, digest_size=16).digest() if packed_set else None


def least_share(n, percent: int = PERCENT):
    """Least overlap of a set of ``n`` with any set it links with: n * percent / 100, rounded up."""
    return -(-n * percent // 100)


def _sets(size: int, blocks: int):
    """Per row: size of its set, the same when told apart by short keys, and a digest of the set; hash of the text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in text_slices(batches):
            sets = [shingle_set(t, size) for t in texts]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0), batch.column(1), pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([len(np.unique(short_keys(s, blocks))) for s in sets], pa.int64()),
                    pa.array([digest(s.tobytes()) for s in sets], pa.binary()),
                ],
                ["doc_id", "text_hash", "n", "n_keys", "digest"],
            )

    return run


def _incidence(size: int, blocks: int):
    def keys_of(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        sets = [np.unique(short_keys(shingle_set(t, size), blocks)) for t in texts]
        place = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
        return place, np.concatenate([np.zeros(0, np.uint64), *sets])

    return keys_of


def _rarest(percent: int):
    """The shared n-grams of a row among its rarest, as (count, key); rows without enough shared ones drop out."""
    schema = pa.schema([
        ("id", pa.binary()), ("n", pa.int64()), ("slack", pa.int64()), ("rest", pa.int64()), ("shared", pa.int64()),
        ("last_count", pa.int32()), ("last_key", pa.int64()), ("grams", pa.list_(pa.int64())),
    ])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for row, n, n_keys, own, keys, counts in zip(*(c.to_pylist() for c in batch.columns)):
                keys, counts = np.frombuffer(keys, np.uint64), np.frombuffer(counts, np.uint8)
                need = max(int(least_share(n, percent)) - (n - n_keys), 1)
                if len(keys) < need:
                    continue
                # Answers that another text of the same document shares in can't be told apart: all count.
                order = np.lexsort((keys, counts))[: len(keys) - need + 1 if own else len(keys)]
                grams = keys[order].view(np.int64)
                rest = need - 1 if own else n
                out.append((row, n, n - n_keys, rest, len(keys) if own else n, int(counts[order[-1]]), int(grams[-1]), grams))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), schema.types)], schema.names)

    return run


def _full_sets(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in text_slices(batches):
            sets = [shingle_set(t, size) for t in texts]
            keep = pa.array([digest(s.tobytes()) == d for s, d in zip(sets, batch.column(1).to_pylist())])
            listed = pa.array([s.view(np.int64) for s in sets], pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([batch.column(1), listed], ["id", "full"]).filter(keep)

    return run


def linked(overlap: Column, a: Column, b: Column, percent: int = PERCENT) -> Column:
    return 100 * overlap >= percent * (a + b - overlap)


def needed(a: Column, b: Column, percent: int) -> Column:
    """Least overlap with which sets of these sizes link."""
    return F.ceil(percent * (a + b) / (100 + percent) - 1e-9)


class _Product:
    """The incidence of the rows that are left, and the links found in it."""

    def __init__(self, rows: DataFrame, sets: DataFrame, percent: int):
        self._rows, self._sets, self._percent = rows, sets, percent
        self.links = None
        self.labels = None

    def _entries(self, *more: str) -> DataFrame:
        """A row for each n-gram among the rarest of a row: (gram, id, n, most, ...)."""
        rows = self._rows.withColumn("most", F.col("shared") + F.col("slack"))
        return rows.select(F.explode("grams").alias("gram"), "id", "n", "most", *more)

    def _keep(self, found: DataFrame) -> None:
        self.links = found if self.links is None else self.links.unionByName(found)
        self.labels = components(self.links)

    def meet_hubs(self) -> None:
        """Rows meet the hubs of their columns: of a column's rows the one with the fewest n-grams of its own.

        That is one order for all columns, so the rows of a group of edited copies, which share most columns, meet
        the same few hubs, those nearest to all others, whatever the size of the group.
        """
        rows = self._entries()
        hub = F.min(F.struct((F.col("n") - F.col("most")).alias("own"), "id", "n", "most")).alias("hub")
        hubs = rows.groupBy("gram").agg(hub)
        n, m = F.col("n"), F.col("hub.n")
        # By sizes alone: an overlap can't exceed either row's n-grams that stand elsewhere too.
        may = F.least("most", "hub.most") >= needed(n, m, self._percent)
        pairs = rows.join(hubs, "gram").where((F.col("id") != F.col("hub.id")) & may).select(
            F.least("id", "hub.id").alias("a"), F.greatest("id", "hub.id").alias("b")).distinct()
        a, b = (self._sets.select(F.col("id").alias(i), F.col("full").alias(f"full_{i}")) for i in "ab")
        both = pairs.join(a, "a").join(b, "b")
        overlap = F.size(F.array_intersect("full_a", "full_b"))
        self._keep(staged(both.where(linked(overlap, F.size("full_a"), F.size("full_b"), self._percent)).select("a", "b")))

    def meet_all(self) -> None:
        """Rows of different components that share a column meet in tiles of the product.

        Rows that share columns of several components, directly or over other rows, are a cluster. Rows are put in
        order of cluster and component and cut into blocks, so most rows share columns with rows of their own block
        only. A tile is two blocks that share a column, not both of the column's first component alone. It finds
        the links that join components and returns these.
        """
        labelled = self._rows.join(self.labels, "id", "left").withColumn("label", F.coalesce("label", "id"))
        entries = labelled.select(F.explode("grams").alias("gram"), "id", "label")
        main = entries.groupBy("gram").agg(
            F.min("label").alias("main"), F.max("label").alias("last"), F.min("id").alias("first")
        ).where(F.col("main") != F.col("last")).select("gram", "main", "first")
        mixed = staged(entries.join(main, "gram"))
        clusters = components(mixed.select(F.col("id").alias("a"), F.col("first").alias("b")).distinct())
        meeting = labelled.select("id", "label", "n").join(clusters.withColumnRenamed("label", "cluster"), "id")
        blocks = staged(_blocks(staged(meeting)))
        held = mixed.join(blocks.select("id", "block"), "id").groupBy("gram", "block").agg(
            F.bool_and(F.col("label") == F.col("main")).alias("only_main"))
        others = held.where(~F.col("only_main")).select("gram", F.col("block").alias("other"))
        tiles = held.join(others, "gram").select(
            F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high")).distinct()
        sides = tiles.select("low", "high", F.explode(F.array_distinct(F.array("low", "high"))).alias("block"))
        dealt = (
            sides.join(blocks.select("id", "label", "block"), "block").join(self._rows, "id").join(self._sets, "id")
            .withColumn("other", F.when(F.col("block") == F.col("low"), F.col("high")).otherwise(F.col("low")))
        )
        percent = self._percent
        found = dealt.groupBy("low", "high").applyInArrow(lambda tile: _tile_links(tile, percent), "a binary, b binary")
        self._keep(staged(found))


def _blocks(rows: DataFrame) -> DataFrame:
    """Rows (id, label, cluster, n) with ``block``: runs in order of cluster and label, of ``BLOCK_ROWS`` rows or
    ``BLOCK_GRAMS`` n-grams.

    Numbers follow from running totals within evenly cut ranges, so no task sees all rows of a cluster.
    """
    order = ("cluster", "label", "id")
    parts = min(blocks_for(rows), rows.count() // (16 * BLOCK_ROWS) + 1)
    ranges = rows.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    placed = staged(ranges.withColumn("place", F.monotonically_increasing_id()))
    within = Window.partitionBy(F.shiftright("place", 33)).orderBy("place")
    at = F.row_number().over(within) / BLOCK_ROWS + F.sum("n").over(within) / BLOCK_GRAMS
    return placed.withColumn("block", F.shiftright("place", 33) * (1 << 33) + F.floor(at)).drop("place")


def _tile_links(tile: pa.Table, percent: int) -> pa.Table:
    """Links of a tile that join components: overlaps of the rarest columns first, then of all where they may do."""
    ids, labels = tile.column("id").to_pylist(), tile.column("label").to_pylist()
    n, slack, rest, shared = (tile.column(c).to_numpy().astype(np.int64) for c in ("n", "slack", "rest", "shared"))
    last = list(zip(tile.column("last_count").to_pylist(), tile.column("last_key").to_pylist()))
    place = np.argsort(np.array(sorted(range(len(ids)), key=last.__getitem__)))
    block, other = (tile.column(c).to_numpy() for c in ("block", "other"))
    grams = tile.column("grams").combine_chunks()
    row_of = np.repeat(np.arange(len(ids)), grams.value_lengths().to_numpy())
    codes = np.unique(grams.flatten().to_numpy(), return_inverse=True)[1]
    order = np.argsort(codes, kind="stable")
    codes, row_of = codes[order], row_of[order]
    met = np.zeros((len(ids), len(ids)), np.float32)
    for start in range(0, int(codes[-1]) + 1, TILE_COLUMNS):
        a, b = np.searchsorted(codes, [start, start + TILE_COLUMNS])
        part = np.zeros((len(ids), TILE_COLUMNS), np.float32)
        part[row_of[a:b], codes[a:b] - start] = 1
        met += part @ part.T
    least = -(-percent * (n[:, None] + n[None, :]) // (100 + percent))
    most = shared + slack
    ends_first = place[:, None] <= place[None, :]
    reach = met + np.where(ends_first, rest[:, None], rest[None, :]) + np.maximum(slack[:, None], slack[None, :])
    _, label = np.unique(np.array([x.hex() for x in labels]), return_inverse=True)
    may = (met > 0) & (reach >= least) & (np.minimum(most[:, None], most[None, :]) >= least)
    may &= (label[:, None] != label[None, :]) & ((block == other)[:, None] | (block[:, None] != block[None, :]))
    first, second = np.nonzero(np.triu(may, 1))
    root = list(range(int(label.max()) + 1))

    def find(x: int) -> int:
        while root[x] != x:
            root[x] = x = root[root[x]]
        return x

    sets: dict[int, np.ndarray] = {}
    links = []
    for k in np.argsort(-met[first, second], kind="stable").tolist():
        i, j = int(first[k]), int(second[k])
        x, y = find(int(label[i])), find(int(label[j]))
        if x == y:
            continue
        for r in (i, j):
            if r not in sets:
                sets[r] = tile.column("full")[r].values.to_numpy()
        overlap = len(np.intersect1d(sets[i], sets[j], assume_unique=True))
        if 100 * overlap >= percent * (len(sets[i]) + len(sets[j]) - overlap):
            root[x] = y
            links.append((ids[i], ids[j]))
    return pa.table({"a": pa.array([x for x, _ in links], pa.binary()), "b": pa.array([y for _, y in links], pa.binary())})


def _classes(documents: DataFrame, size: int, percent: int) -> tuple[DataFrame, DataFrame]:
    """Rows (doc_id, text_hash, n, n_keys, digest), and classes of equal sets (digest, doc_id, label).

    A class's ``doc_id`` is the smallest of its rows, and classes that links join share a label.
    """
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    bound_batches(documents.sparkSession)
    blocks = blocks_for(documents)
    sets = staged(rows.select("doc_id", F.xxhash64("text").alias("text_hash"), "text").mapInArrow(
        _sets(size, blocks), "doc_id long, text_hash long, n long, n_keys long, digest binary"))
    known = sets.where(F.col("doc_id").isNotNull() & F.col("digest").isNotNull())
    classes = known.groupBy("digest", "n", "n_keys").agg(F.min("doc_id").alias("doc_id"))
    own = known.groupBy("doc_id").agg((F.min("digest") == F.max("digest")).alias("own"))

    asked = rows.where(F.col("doc_id").isNotNull()).withColumnRenamed("doc_id", "row_id")
    shared = shared_keys(asked, _incidence(size, blocks), blocks, width=4, hot=HOT, owned=False)
    candidates = (
        shared.withColumnRenamed("row_id", "doc_id").join(classes, "doc_id").join(own, "doc_id")
        .select(F.col("digest").alias("id"), "n", "n_keys", "own", "keys", "counts")
    )
    left = staged(candidates.mapInArrow(
        _rarest(percent),
        "id binary, n long, slack long, rest long, shared long, last_count int, last_key long, grams array<long>",
    ))
    wanted = left.select(F.col("id").alias("digest")).join(classes, "digest").select("doc_id", "digest")
    full = staged(
        rows.join(wanted, "doc_id").select("text", "digest")
        .mapInArrow(_full_sets(size), "id binary, full array<long>").dropDuplicates(["id"])
    )
    product = _Product(left, full, percent)
    product.meet_hubs()
    product.meet_all()
    reached = product.labels
    labelled = classes.join(reached, classes["digest"] == reached["id"], "left").select(
        "digest", "doc_id", F.coalesce("label", "digest").alias("label"))
    return sets, labelled


def near_duplicates(documents: DataFrame, size: int = SHINGLE_WORDS, percent: int = PERCENT) -> DataFrame:
    """``doc_id, n_shingles, component_id`` of every row of ``documents``.

    Two documents link when ``100 * intersection >= percent * union`` of their shingle sets; ``component_id`` is the
    smallest ``doc_id`` that links reach. A document without words has no shingles and links with nothing. Each row
    is judged by its own text, also where rows repeat a ``doc_id``; a row without ``doc_id`` links with nothing
    and has no component. Other columns are not read.
    """
    sets, labelled = _classes(documents, size, percent)
    smallest = labelled.groupBy("label").agg(F.min("doc_id").alias("component"))
    of_class = labelled.join(smallest, "label").select("digest", "component")
    return sets.join(of_class, "digest", "left").select(
        "doc_id", F.col("n").alias("n_shingles"),
        F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id")).alias("component_id"),
    )


def keep_one_of_each(documents: DataFrame, size: int = SHINGLE_WORDS, percent: int = PERCENT) -> DataFrame:
    """One row of ``documents`` for each group of near duplicates: that of the smallest ``doc_id``.

    Each row is judged by its own text, so rows that repeat a ``doc_id`` with texts that don't link all stay. Of a
    group's rows with the smallest ``doc_id`` one stays. Documents without words and rows without ``doc_id`` stay.
    """
    sets, labelled = _classes(documents, size, percent)
    rows = sets.where(F.col("doc_id").isNotNull() & F.col("digest").isNotNull()).groupBy("doc_id", "text_hash", "digest").agg(
        F.count(F.lit(1)).alias("copies"))
    first = labelled.groupBy("label").agg(F.min(F.struct("doc_id", "digest"))["digest"].alias("digest"))
    named = first.join(labelled.select("digest", "doc_id"), "digest").join(rows, ["doc_id", "digest"]).groupBy("doc_id", "digest").agg(
        F.min("text_hash").alias("text_hash"))
    dropped = rows.join(named, ["doc_id", "digest", "text_hash"], "left_anti").select(
        F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash"))
    repeated = rows.where("copies > 1").join(named, ["doc_id", "digest", "text_hash"]).select(
        F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash"))

    def same(keys: DataFrame) -> Column:
        text = F.xxhash64(documents["text"].cast("string"))
        return (documents["doc_id"].cast("long") == keys["_id"]) & (text == keys["_hash"])

    dropped, repeated = staged(dropped), staged(repeated)
    both = dropped.unionByName(repeated)
    once = documents.join(both, same(both), "left_anti")
    several = documents.join(repeated, same(repeated), "left_semi")
    return once.unionByName(several.dropDuplicates(["doc_id", "text"]))
