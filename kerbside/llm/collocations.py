"""Phrase collocations: n-grams that stand together more often than their parts suggest.

1. Slices of texts become word lists and codes. Words are counted over all slices, those of at least ``LEAST``
   occurrences are numbered, and each slice learns the numbers of its own words by a join: no vocabulary is broadcast.
2. Tasks count the n-grams of two to four frequent words in counting quotient filters and send these in parts, by the
   upper bits of the quotient. A part's filters are merged in order, which gives exact counts over all slices.
3. Cuts, containment and ranks are joins and aggregates over the frequent n-grams, which are few.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window, functions as F

from kerbside.llm import quotient_filter as qf
from kerbside.llm.exchange import blocks_for
from kerbside.llm.words import bound_batches, text_slices
from kerbside.operators.staging import staged

#: Occurrences that a phrase needs, and phrases reported for each language.
LEAST, MOST = 30, 2000
#: A longer phrase that stands for this share of a phrase's occurrences, in percent, replaces it.
CONTAINED = 80
SCALE = 2_000_000
#: Texts of a slice in bytes, words in a row of codes, and n-grams that a task holds before it sends its filters.
SLICE_BYTES, ROW_WORDS, HELD = 4 << 20, 1 << 19, 1_500_000
#: Groups in which the best phrases of a language are found side by side first.
SALTS = 32

# Bytes that end a piece of text become a full stop that stands alone; only blanks and tabs part words.
_ENDS = re.compile(rb"[.,;:!?\n-\r]+")
_STOP = b"."
# White space to Python that is none here can't occur: 0x0A to 0x0D end a piece.

_CODED = "slice long, lang string, words array<binary>, counts array<int>, codes binary, n_codes int, own int"
_FILTER = "part int, n int, quotient_bits int, runs binary, remainders binary, counts binary"
_GRAM = ["w1", "w2", "w3", "w4"]


def _packed(codes: np.ndarray) -> bytes:
    """Codes byte by byte, compressed: words that stand often come early and have small codes."""
    planes = np.ascontiguousarray(codes.astype("<u4").view(np.uint8).reshape(-1, 4).T)
    return pa.compress(planes.tobytes(), codec="zstd", asbytes=True)


def _unpacked(data: bytes, n: int) -> np.ndarray:
    planes = np.frombuffer(pa.decompress(data, 4 * n, codec="zstd", asbytes=True), np.uint8)
    return np.ascontiguousarray(planes.reshape(4, n).T).view("<u4").ravel().astype(np.int64)


def _coded(slice_bytes: int, row_words: int):
    """Texts by language as lists of distinct words and codes: 0 ends a piece, k is the k-th word.

    A row has ``own`` codes and then up to three more, which n-grams that start in it may reach.
    """
    reach = qf.MOST_WORDS - 1

    def rows(lang: str, texts: list[bytes], number: list[int]) -> Iterator[tuple]:
        joined = _ENDS.sub(b" . ", b".".join(texts).lower()) + b" ."
        codes, words = pd.factorize(np.array(joined.split(), dtype=object))
        stop = np.flatnonzero(words == _STOP)[0]
        codes = np.where(codes == stop, 0, codes + 1)
        for start in range(0, len(codes), row_words):
            held = codes[start:start + row_words + reach]
            own = min(row_words, len(held))
            found, local = np.unique(held, return_inverse=True)
            if found[0] != 0:
                found, local = np.concatenate([[0], found]), local + 1
            if len(found) == 1:
                continue
            counts = np.bincount(local[:own], minlength=len(found))[1:]
            number[0] += 1
            own_id = (TaskContext.get().partitionId() << 32) + number[0]
            yield own_id, lang, words[found[1:] - 1].tolist(), counts, _packed(local), len(local), own

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, held, size = [0], {}, 0
        types = [pa.int64(), pa.string(), pa.list_(pa.binary()), pa.list_(pa.int32()), pa.binary(), pa.int32(), pa.int32()]
        names = ["slice", "lang", "words", "counts", "codes", "n_codes", "own"]

        def flush() -> Iterator[pa.RecordBatch]:
            for lang, texts in held.items():
                for row in rows(lang, texts, number):
                    yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row, types)], names)
            held.clear()

        for batch, texts in text_slices(batches, limit=slice_bytes):
            for lang, text in zip(batch.column(0).to_pylist(), texts):
                held.setdefault(lang, []).append(text)
                size += len(text)
                if size >= slice_bytes:
                    yield from flush()
                    size = 0
        yield from flush()

    return run


def _numbered(words: DataFrame) -> DataFrame:
    """``words`` with ``id`` 1, 2, 3...: places within the stored table's partitions after those of partitions before."""
    placed = staged(words.withColumn("_place", F.monotonically_increasing_id()))
    part, place = F.shiftright("_place", 33), F.col("_place").bitwiseAND(F.lit((1 << 33) - 1))
    sizes = dict(placed.groupBy(part.alias("part")).count().collect())  # a row for each partition
    offsets, seen = [], 1
    for number in sorted(sizes):
        offsets.append((number, seen))
        seen += sizes[number]
    offset = words.sparkSession.createDataFrame(offsets, "_part long, _offset long")
    return staged(placed.withColumn("_part", part).join(F.broadcast(offset), "_part").withColumn(
        "id", F.col("_offset") + place).drop("_part", "_offset", "_place"))


def _filters(width: int, bits: int, held_most: int):
    """The n-grams of a task's slices in counting quotient filters, one for each part."""

    def grams(codes: bytes, n_codes: int, own: int, known: pa.StructArray) -> tuple[np.ndarray, ...]:
        local = _unpacked(codes, n_codes)
        of_code = np.zeros(int(local.max()) + 1, np.int64)
        of_code[known.field("place").to_numpy() + 1] = known.field("id").to_numpy()
        words = of_code[local]
        packed = []
        for size in range(2, qf.MOST_WORDS + 1):
            n = min(own, len(words) - size + 1)
            if n <= 0:
                break
            runs = [words[i:i + n] for i in range(size)]
            whole = np.logical_and.reduce([r > 0 for r in runs])
            packed.append(qf.pack([r[whole] for r in runs], width))
        high, low = (np.concatenate([np.zeros(0, np.uint64), *x]) for x in zip(*packed)) if packed else (np.zeros(0, np.uint64),) * 2
        return qf.counted(*qf.permute(high, low, width))

    def parts(entries: tuple[np.ndarray, ...]) -> Iterator[pa.RecordBatch]:
        high, low, counts = entries
        found, first = np.unique(qf.parts_of(high, width, bits), return_index=True)
        rows = [
            (int(part), *qf.write(high[a:b], low[a:b], counts[a:b], width, bits))
            for part, a, b in zip(found, first, [*first[1:], len(high)])
        ]
        if rows:
            types = [pa.int32(), pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.binary()]
            names = ["part", "n", "quotient_bits", "runs", "remainders", "counts"]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            for i in range(batch.num_rows):
                found = grams(*(batch.column(c)[i].as_py() for c in range(3)), batch.column(3)[i].values)
                held.append(found)
                size += len(found[0])
                if size >= held_most:
                    held = [qf.counted(*map(np.concatenate, zip(*held)))]
                    size = len(held[0][0])
                    if size >= held_most // 2:
                        yield from parts(held[0])
                        held, size = [], 0
        if held:
            yield from parts(qf.counted(*map(np.concatenate, zip(*held))))

    return run


def _merged(width: int, bits: int, least: int, held_most: int):
    """Merge the filters of each part and give its n-grams of at least ``least`` occurrences."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size, base = [], 0, 0
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                held.append(qf.read(*row, width, bits))
                size += row[1]
                if size >= base + held_most:
                    held = [qf.counted(*map(np.concatenate, zip(*held)))]
                    size = base = len(held[0][0])
        if not held:
            return
        high, low, counts = qf.counted(*map(np.concatenate, zip(*held)))
        often = counts >= least
        ids = qf.unpack(*qf.restore(high[often], low[often], width), width)
        yield pa.RecordBatch.from_arrays([pa.array(x.astype(np.int64)) for x in (*ids, counts[often])], [*_GRAM, "f"])

    return run


def frequent_ngrams(
    documents: DataFrame, least: int = LEAST, slice_bytes: int = SLICE_BYTES, row_words: int = ROW_WORDS, held: int = HELD
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(lang, n) of all words; (id, lang, word, f) of frequent words; (w1..w4, f) of all frequent n-grams, words included."""
    bound_batches(documents.sparkSession)
    texts = documents.select(
        F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), F.col("text").cast("string").alias("text"))
    coded = staged(texts.mapInArrow(_coded(slice_bytes, row_words), _CODED))
    listed = coded.select("slice", "lang", F.posexplode(F.arrays_zip("words", "counts")).alias("place", "x")).select(
        "slice", "lang", "place", F.col("x.words").alias("word"), F.col("x.counts").alias("count"))
    totals = listed.groupBy("lang").agg(F.sum("count").alias("n"))
    words = _numbered(listed.groupBy("lang", "word").agg(F.sum("count").alias("f")).where(F.col("f") >= least))
    single = words.select(F.col("id").alias("w1"), *[F.lit(0).cast("long").alias(w) for w in _GRAM[1:]], "f")
    width = max(1, int(words.agg(F.max("id")).first()[0] or 0).bit_length())
    blocks = blocks_for(documents)
    bits = qf.part_bits(blocks, width)
    known = listed.select("slice", "lang", "place", "word").join(words.select("lang", "word", "id"), ["lang", "word"]).groupBy("slice").agg(
        F.collect_list(F.struct("place", "id")).alias("known"))  # a slice's own words: bounded by its size
    filters = coded.select("slice", "codes", "n_codes", "own").join(known, "slice").select("codes", "n_codes", "own", "known").mapInArrow(
        _filters(width, bits, held), _FILTER)
    grams = filters.repartitionById(1 << bits, F.col("part")).mapInArrow(
        _merged(width, bits, least, held), ", ".join(f"{c} long" for c in [*_GRAM, "f"]))
    return totals, words.withColumn("word", F.col("word").cast("string")), staged(single.unionByName(staged(grams)))


def _exact(value: Column) -> Column:
    return value.cast("decimal(19,0)")


def _cuts(grams: DataFrame) -> DataFrame:
    """The lowest-scoring cut of each n-gram of two words and more: (w1..w4, a, l, r, score)."""
    zero, w = F.lit(0).cast("long"), [F.col(x) for x in _GRAM]

    def part(first: int, last: int) -> Column:
        held = [*w[first:last], *[zero] * (qf.MOST_WORDS - (last - first))]
        return F.struct(*[c.alias(n) for c, n in zip(held, _GRAM)])

    size = sum((F.when(x > 0, 1).otherwise(0) for x in w[1:]), F.lit(1))
    cuts = F.array(*[F.struct(F.lit(k).alias("k"), part(0, k).alias("first"), part(k, qf.MOST_WORDS).alias("rest")) for k in (1, 2, 3)])
    each = grams.where(F.col("w2") > 0).select(*_GRAM, F.col("f").alias("a"), F.explode(F.slice(cuts, F.lit(1), size - 1)).alias("cut"))
    first = grams.select(F.struct(*_GRAM).alias("_first"), F.col("f").alias("l"))
    rest = grams.select(F.struct(*_GRAM).alias("_rest"), F.col("f").alias("r"))
    # The rest of a cut after k words has zeros where the n-gram is shorter, so its parts are found as they stand.
    scored = (
        each.select(*_GRAM, "a", "cut.k", F.col("cut.first").alias("_first"), F.col("cut.rest").alias("_rest"))
        .join(first, "_first").join(rest, "_rest")
        .withColumn("score", F.expr(f"cast(a as decimal(19,0)) * {SCALE} div (cast(l as decimal(19,0)) + cast(r as decimal(19,0)))"))
    )
    best = F.min(F.struct("score", "k", "l", "r"))
    return scored.groupBy(*_GRAM, "a").agg(best.alias("best")).select(*_GRAM, "a", "best.l", "best.r", "best.score")


def _without_contained(cut: DataFrame, grams: DataFrame, contained: int) -> DataFrame:
    """Candidates without those that a longer one replaces.

    A longer phrase is no more frequent than the phrases inside it, so those of one word more decide.
    """
    zero = F.lit(0).cast("long")
    longer = grams.where(F.col("w3") > 0)
    ends = F.when(F.col("w4") > 0, F.array(
        F.struct("w1", "w2", "w3", zero.alias("w4")), F.struct(*[F.col(a).alias(b) for a, b in zip(_GRAM[1:], _GRAM)], zero.alias("w4")))
    ).otherwise(F.array(
        F.struct("w1", "w2", zero.alias("w3"), zero.alias("w4")),
        F.struct(F.col("w2").alias("w1"), F.col("w3").alias("w2"), zero.alias("w3"), zero.alias("w4"))))
    inside = longer.select("f", F.explode(ends).alias("e")).groupBy("e.w1", "e.w2", "e.w3", "e.w4").agg(F.max("f").alias("longer"))
    replaced = _exact(F.col("longer")) * 100 >= _exact(F.col("a")) * contained
    return cut.join(inside, _GRAM, "left").where(~F.coalesce(replaced, F.lit(False))).drop("longer")


def collocations(documents: DataFrame, least: int = LEAST, most: int = MOST, contained: int = CONTAINED, **sizes: int) -> DataFrame:
    """The best phrases of each language: (lang, rank, phrase, a, l, r, n, score).

    Texts are split at ``.,;:!?`` and line ends into pieces and these at blanks and tabs into words, A-Z in lower
    case. A phrase is 2 to 4 words of one piece with ``a >= least`` occurrences; its score is that of the cut where
    2,000,000 a / (l + r) is lowest. A NULL or empty text has no words, a NULL ``lang`` is ``und``; rows that repeat
    count as often as they stand. A language without such phrases has no row. Other columns are not read.
    """
    totals, words, grams = frequent_ngrams(documents, least, **sizes)
    left = _without_contained(_cuts(grams), grams, contained)
    named = left
    for w in _GRAM:
        name = words.select(F.col("id").alias(w), F.col("word").alias(f"_{w}"), *([F.col("lang")] if w == "w1" else []))
        named = named.join(name, w, "inner" if w in ("w1", "w2") else "left")
    phrases = named.select("lang", F.concat_ws(" ", *[f"_{w}" for w in _GRAM]).alias("phrase"), "a", "l", "r", "score")
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    salted = phrases.withColumn("_salt", F.pmod(F.xxhash64("phrase"), F.lit(SALTS)))
    near = salted.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "_salt").orderBy(*order))).where(F.col("rank") <= most)
    best = near.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).where(F.col("rank") <= most)
    return best.join(totals, "lang").select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", F.col("n").cast("long").alias("n"),
        F.col("score").cast("long").alias("score"))
