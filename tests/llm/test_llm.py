"""The training-data operators against brute force, on planted and edge cases."""

from __future__ import annotations

import base64
import hashlib
import random
import re
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest

import __spark_entry__ as entry
from kerbside.llm import (
    boosting, byte_bpe, chat_quotes, decontaminate, exchange, license_scan, ngram_join, quality, sharding,
    substring_dedup, token_counts, warc,
)

DOCS = "doc_id long, text string, lang string, _row_id string, label string"
RANKS, PATTERN = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(5)
    words = ["".join(rng.choices("abcdeäñ", k=rng.randint(1, 6))) for _ in range(400)]
    prose = lambda n: " ".join(rng.choices(words, k=n))
    passage, base = prose(60), prose(120).split()
    found = [None, "", " \n\t ", "one", "two words here", "two words here", "aa " * 90, prose(3000)]
    for _ in range(25):
        found += [prose(rng.randint(1, 150)), f"{prose(20)}\n{passage} {prose(15)}"]
    for _ in range(30):
        copy = list(base)
        for _ in range(rng.randint(0, 5)):
            copy[rng.randrange(120)] = rng.choice(words)
        found.append(" ".join(copy).upper() if rng.random() < 0.2 else " ".join(copy))
    return found


@pytest.fixture(scope="module")
def docs(spark, texts):
    rows = [(i, t, "en", "x", "y") for i, t in enumerate(texts)]
    rows += [rows[9], (None, texts[9], None, None, None), (3, texts[20], "en", "x", "y")]
    return spark.createDataFrame(rows, DOCS).repartition(5)


def empty(spark):
    return spark.createDataFrame([], DOCS)


def test_near_duplicates(docs):
    rows = [(r.doc_id, (r.text or "").encode().lower().split()) for r in docs.collect()]
    sets = [{tuple(w[i:i + 5]) for i in range(len(w) - 4)} or ({tuple(w)} if w else set()) for _, w in rows]
    root = list(range(len(rows)))
    for _ in rows:
        for i, a in enumerate(sets):
            for j, b in enumerate(sets[:i]):
                both = None in (rows[i][0], rows[j][0])
                if a and b and not both and 100 * len(a & b) >= 75 * len(a | b):
                    root[i] = root[j] = min(root[i], root[j])
    smallest = {}
    for (i, _), r in zip(rows, root):
        if i is not None:
            smallest[r] = min(smallest.get(r, i), i)
    want = Counter((i, len(s), None if i is None else smallest[r]) for (i, _), s, r in zip(rows, sets, root))
    assert Counter(map(tuple, ngram_join.near_duplicates(docs).collect())) == want


def test_repeated_windows(docs):
    rows = [(r.doc_id, (r.text or "").encode().split()) for r in docs.collect()]
    seen = Counter(tuple(w[i:i + 35]) for _, w in rows for i in range(len(w) - 34))
    want = Counter()
    for doc_id, w in rows:
        gone = set()
        for i in range(len(w) - 34):
            if seen[tuple(w[i:i + 35])] > 1:
                gone |= set(range(i, i + 35))
        kept = b" ".join(x for i, x in enumerate(w) if i not in gone)
        want[(doc_id, len(w), len(gone), hashlib.sha256(kept).hexdigest())] += 1
    assert Counter(map(tuple, substring_dedup.removal_digests(docs).collect())) == want
    cleaned = substring_dedup.remove_repeated(docs)
    assert cleaned.columns == docs.columns and cleaned.count() == docs.count()


def test_bpe(docs):
    import tiktoken

    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(RANKS, "rb"))}
    library = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
    extra = docs.sparkSession.createDataFrame([(900, "x" * 700 + " " * 90 + "it's  \n\n" * 80, "", "", ""), (901, "a" * 2000, "", "", "")], DOCS)
    both = docs.unionByName(extra).unionByName(extra)
    want = Counter((r.doc_id, tuple(library.encode_ordinary(r.text or "")), (r.text or "").encode()) for r in both.collect())
    encoded = byte_bpe.encode_documents(both, RANKS, PATTERN, chunk=300, overlap=60)
    got = byte_bpe.decode_documents(encoded, RANKS, PATTERN).collect()
    assert Counter((r.doc_id, tuple(np.frombuffer(r.ids, "<u4").tolist()), bytes(r.decoded)) for r in got) == want
    at_once = byte_bpe.encode_documents(both, RANKS, PATTERN, chunk=300, overlap=60, decode=True)
    assert Counter(map(tuple, byte_bpe.digests(at_once).collect())) == Counter(
        map(tuple, byte_bpe.digests(byte_bpe.decode_documents(encoded, RANKS, PATTERN)).collect()))


def test_owner_in_several_slices():
    size = 5
    passage = " ".join(f"w{i}" for i in range(8)).encode()
    # Row 2 owns the passage in the first slice and hears of the smaller row 1 in the second.
    slices = [[(2, passage), (2, passage), (3, passage)], [(1, passage), (1, passage), (2, passage)]]
    for asked in (slices, slices[::-1]):
        batches = [pa.record_batch({"row_id": pa.array([r for r, _ in s]), "text": pa.array([t for _, t in s])}) for s in asked]
        keys_of = substring_dedup._window_keys(size)
        answers = exchange._ask(keys_of, 1, 8, 2, True)(iter(batches))
        answers = exchange._collect(exchange._count(1, 8, True)(answers))
        told = {r: (k, o) for b in answers for r, k, o in zip(*(b.column(c).to_pylist() for c in ("row_id", "keys", "owners")))}
        joined = pa.record_batch(
            [pa.array(x) for x in zip(*((r, 0, passage, *told[r]) for r in (1, 2, 3)))],
            ["row_id", "start", "text", "keys", "owners"],
        )
        runs = [r for b in substring_dedup._owned_runs(size)(iter([joined])) for r in b.to_pylist()]
        runs.sort(key=lambda r: (r["owner"], r["row_id"] != r["owner"], r["row_id"], r["start"]))
        ordered = pa.RecordBatch.from_pylist(runs)
        spans = {tuple(r.values()) for b in substring_dedup._match(size)(iter([ordered])) for r in b.to_pylist()}
        assert spans == {(1, 0, 8), (2, 0, 8), (3, 0, 8)}


def test_licenses(spark):
    texts = ["Used under the MIT License, under the mit license.", "Apache License, Version 2.0", "cc-by-nc cc by nc-sa 4.0", None, "", "no",
             "Licensed under the GNU General Public License version 3 or so", "mit licence"]
    df = spark.createDataFrame([(i, t, None, None, None) for i, t in enumerate(texts)] * 2, DOCS)
    got = {r.doc_id: r for r in license_scan.scan_licenses(df).collect()}
    pattern = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    for i, text in enumerate(texts):
        w = pattern.findall("".join(c.lower() if c.isascii() else c for c in text or ""))
        at = [(k, label) for p, label in license_scan.BASE for k in range(len(w)) if w[k:k + len(p.split())] == p.split()]
        r = got[i]
        assert (r.n_words, r.n_base, r.base_labels) == (len(w), len(at), ",".join(sorted({x for _, x in at})))
        assert (r.first_word, r.last_word) == (min((k for k, _ in at), default=None), max((k for k, _ in at), default=None))
        assert 0 <= r.score <= 1 and set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(","))
    assert got[6].labels == "gpl-3" and got[7].labels == "mit" and got[2].labels == "cc-by-nc,cc-by-nc-sa"


def rule_examples(expression):
    """Texts that a rule matches: with its optional words and without, by each alternative in turn."""
    plain = expression.removeprefix("(?<= )").removesuffix("(?= )")
    plain = plain.replace("licen[sc]e", "licence").replace("[sc]", "s").replace("[1-4] [05]", "4 0")
    plain = re.sub(r"\[(.)[^]]*\]", r"\1", plain)
    group = re.compile(r"\(\?:([^()]*)\)(\??)")
    found, open_ = set(), {plain}
    while open_:
        text = open_.pop()
        m = group.search(text)
        if m is None:
            found |= {re.sub(r".\?", "", text), text.replace("?", "")}
            continue
        for word in [*m[1].split("|"), *([""] if m[2] else [])]:
            open_.add(text[:m.start()] + word + text[m.end():])
    return sorted(found)


def test_every_license_rule_passes_its_gate(spark):
    rng, examples = random.Random(9), []
    for label, key, expression, *_ in license_scan.rules():
        for text in rng.sample(own := rule_examples(expression), min(len(own), 12)):
            assert re.search(expression, f" {text} ") and key in f" {text} ", (expression, key, text)
            examples.append((len(examples), text.upper().replace(" ", "\n  ")))
    examples.append((len(examples), "limit, discuss, account and the freebsdé"))
    df = spark.createDataFrame(examples, "doc_id long, text string")
    got = {r.doc_id: r for r in license_scan.scan_licenses(df).collect()}
    assert [examples[i] for i in got if not got[i].labels] == examples[-1:]


def test_leaks(spark):
    item = "Anna has 12 apples and gives 5 apples to Peter while she walks 3 km along the old river road"
    benchmark = spark.createDataFrame([(1, item), (2, "too short"), (None, item), (3, None)], "item_id long, text string")
    other = item.replace("Anna", "Clara").replace("Peter", "Jonas").replace("12", "40").replace("5", "7")
    docs = spark.createDataFrame([
        (1, f"before {item} after", "", "", ""), (2, other, "", "", ""), (3, "nothing of that kind at all", "", "", ""),
        (4, None, "", "", ""), (None, item, "", "", ""), (1, f"before {item} after", "", "", ""),
    ], DOCS)
    assert {(r.doc_id, r.item_id) for r in decontaminate.leaks(docs, benchmark).collect()} == {(1, 1), (2, 1), (None, 1)}
    assert sorted(str(r.doc_id) for r in decontaminate.drop_leaks(docs, benchmark).collect()) == ["3", "4"]


def test_leaks_by_place_short_items_and_runs(spark):
    item = "Anna has 12 apples and gives 5 apples to Peter while she walks 3 km along the old river road"
    other = item.replace("Anna", "Clara").replace("Peter", "Jonas").replace("12", "40").replace("5", "7")
    third = item.replace("Anna", "Mia").replace("Peter", "Tom").replace("12", "60").replace("5", "9")
    long_ = " ".join(f"{'abcdefghij'[i % 10]}word{'klmnopqrst'[i // 10]}" for i in range(60))
    benchmark = spark.createDataFrame(
        [(1, item), (2, "What is the capital of France?"), (3, "12 + 7 = 19 km, 3 + 4 = 7 km, 8 - 1 = 7 kg, 5"), (4, long_), (5, "a b c")],
        "item_id long, text string")
    mixed = item.replace("5 apples", "8 pears").replace("12", "13").replace("Anna", "Bea").replace("walks 3 km", "runs 4 km")
    docs = spark.createDataFrame([
        (1, f"{item}. Some words between them here. {other}", "", "", ""), (2, f"{other}. And then {third}", "", "", ""),
        (3, "He asked: what is the capital of France? Nobody knew.", "", "", ""), (4, "so 12 + 7 = 19 km, 3 + 4 = 7 km, 8 - 1 = 7 kg, 5 it is", "", "", ""),
        (5, "x " + " ".join(long_.split()[20:35]) + " y", "", "", ""), (6, "x " + " ".join(long_.split()[20:32]) + " y", "", "", ""),
        (7, "a b c", "", "", ""), (8, "the capital of France is what it is", "", "", ""), (9, mixed, "", "", ""), (10, "nothing here", "", "", ""), (10, item, "", "", ""),
    ], DOCS)
    found = {(r.doc_id, r.item_id) for r in decontaminate.leaks(docs, benchmark).collect()}
    assert found == {(1, 1), (2, 1), (3, 2), (4, 3), (5, 4), (10, 1)}
    assert sorted((r.doc_id, r.text) for r in decontaminate.drop_leaks(docs, benchmark).collect() if r.doc_id > 8) == [(9, mixed), (10, "nothing here")]


def test_quotes(spark):
    rows = [(1, 0, "user", "First line.\nSecond line."), (1, 1, "assistant", "Other words"),
            (1, 2, "user", "A wrote:\n> first  LINE.\n> Second line.\nI agree."), (1, 3, "assistant", ">> First line.\n> I agree.\nFine"),
            (2, 0, None, None), (None, 1, "user", "> x"), (2, None, "user", "")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = {(r.conv_id, r.turn): r for r in chat_quotes.conversations(df).collect()}
    assert len(got) == len(rows)
    assert [(got[1, t].reply_to, got[1, t].thread) for t in range(4)] == [(None, 0), (None, 1), (0, 0), (2, 0)]
    nested = spark.createDataFrame(
        [(1, 0, "u", "First line is quite long here."), (1, 1, "u", "x"), (1, 2, "u", "I agree."),
         (1, 3, "u", ">> First line is quite long here.\n> I agree.\nWell")] * 2, "conv_id long, turn long, role string, text string")
    assert Counter((r.turn, r.reply_to, r.thread) for r in chat_quotes.conversations(nested).collect()) == {
        (0, None, 0): 2, (1, None, 1): 2, (2, None, 2): 2, (3, 2, 2): 2}
    assert got[1, 2].content == "I agree." and got[1, 3].content == "Fine" and got[2, 0].role == "unknown"


def test_one_row_of_each_group(spark):
    a, b = "a b c d e f g h", "q r s t u v w x y"
    rows = [(1, a), (2, a), (2, b), (2, b), (3, ""), (3, b + " q"), (None, a), (4, None), (5, "z Z"), (5, "Z z")]
    kept = ngram_join.keep_one_of_each(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert Counter(map(tuple, kept)) - Counter([(5, "z Z"), (5, "Z z")]) == Counter([(1, a), (2, b), (3, ""), (None, a), (4, None)])
    assert sum(r.doc_id == 5 for r in kept) == 1


def test_tiles_of_small_blocks(spark, monkeypatch):
    rng = random.Random(11)
    monkeypatch.setattr(ngram_join, "BLOCK_ROWS", 3)
    monkeypatch.setattr(ngram_join, "TILE_COLUMNS", 16)
    monkeypatch.setattr(ngram_join._Product, "meet_hubs", lambda self: self._keep(self._rows.limit(0).selectExpr("id AS a", "id AS b")))
    words, texts = [f"w{i}" for i in range(50)], []
    for _ in range(6):
        base = rng.choices(words, k=60)
        for _ in range(9):
            copy = list(base)
            for _ in range(rng.randint(0, 3)):
                copy[rng.randrange(60)] = rng.choice(words)
            texts.append(" ".join(copy))
    docs = spark.createDataFrame([(i, t, "", "", "") for i, t in enumerate(texts)], DOCS)
    test_near_duplicates(docs)


def test_warc(spark, tmp_path):
    rows = [(5, "u", "same"), (2, "v w", "same"), (9, None, None), (7, "x", ""), (None, "n", "same"), (3, "y", "ünique" * 999), (2, "v", "same")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    path = str(tmp_path / "archive")
    warc.write_archive(pages, path, frame_bytes=500, bundle_bytes=100)
    got = Counter((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in warc.read_archive(spark, path).collect())
    want = Counter()
    for page_id, _, html in rows:
        body = (html or "").encode()
        first = min((p for p, _, h in rows if p is not None and (h or "") == (html or "")))
        later = page_id != first
        want[(page_id, len(body), base64.b32encode(hashlib.sha1(body).digest()).decode(), "revisit" if later else "response", first if later else None)] += 1
    assert got == want
    place = warc.index_archive(spark, path).where("page_id = 3").first()
    bundle = open(place.file.removeprefix("file:"), "rb").read()
    fields, block = warc.read_record(bundle, place.frame, place.offset)
    assert fields["WARC-Record-ID"] == place.record_id and block.endswith(("ünique" * 999).encode())
    import zstandard

    assert zstandard.ZstdDecompressor().stream_reader(bundle, read_across_frames=True).read().count(b"WARC/1.1") >= 1

    files = sorted((tmp_path / "archive").glob("*.txt"))
    assert len(files) > 1 and all(file.read_bytes()[-4:] == warc.SEEKABLE_MAGIC for file in files)
    assert sum(len(warc.read_index(file.read_bytes())) for file in files) == len(rows)
    asked = spark.createDataFrame([(warc.record_id(3, ""), 1), (warc.record_id(7, ""), 2), ("<urn:uuid:none>", 3)], "record_id string, page_id int")
    found = {r.page_id: (r.record_type, bytes(r.payload)) for r in warc.look_up(spark, path, asked).collect()}
    assert found == {3: ("response", ("ünique" * 999).encode()), 7: ("response", b"")}


def test_warc_index_in_small_frames():
    bundle = b"".join(batch.column("bundle")[0].as_py() for batch in warc._bundles(300, 1 << 20)(iter([pa.RecordBatch.from_pydict({
        "page_id": pa.array(range(50)), "url": pa.array(["u"] * 50), "html": pa.array(["x" * i for i in range(50)]),
        "first": pa.array([None] * 50, pa.int64())})]))) + warc.SEEKABLE_MAGIC
    places = warc.read_index(bundle)
    assert [page_id for _, page_id, _, _ in places] == list(range(50)) and len({frame for _, _, frame, _ in places}) > 10
    for name, page_id, frame, offset in places:
        fields, block = warc.read_record(bundle, frame, offset)
        assert fields["WARC-Record-ID"] == name and block.partition(b"\r\n\r\n")[2] == b"x" * page_id
    assert sum(map(len, warc.indexed_records(bundle))) == 50


def test_sharding(spark, docs):
    shards = [f"s{i}" for i in range(7)]
    table = sharding.lookup_table(shards, 997)
    sizes = np.bincount(table)
    assert sizes.max() - sizes.min() <= 1
    fewer = sharding.lookup_table(shards[:-1], 997)
    assert (fewer != table)[table < 6].mean() < 0.25
    got = sharding.place(docs, "doc_id", shards, 997).collect()
    assert len(got) == docs.count() and len({(r.doc_id, r.shard) for r in got}) == len({r.doc_id for r in got})
    for r in got:
        slot = int(hashlib.md5(str("" if r.doc_id is None else r.doc_id).encode()).hexdigest()[:15], 16) % 997
        assert (r.slot, r.shard) == (slot, shards[table[slot]])


def test_token_counts(docs):
    scores = token_counts.vocabulary(public_tokenizers.path("piece_bpe_32k.model"))
    worst = min(scores.values()) - token_counts.UNKNOWN_PENALTY

    def count(word: str) -> int:
        best = [(0.0, 0)]
        for end in range(1, len(word) + 1):
            options = [(best[s][0] + scores[word[s:end]], best[s][1] - 1) for s in range(end) if word[s:end] in scores]
            if word[end - 1] not in scores:
                options.append((best[end - 1][0] + worst, best[end - 1][1] - len(word[end - 1].encode())))
            best.append(max(options))
        return -best[-1][1]

    once = docs.where("doc_id <> 3")
    for r in token_counts.token_counts(once, public_tokenizers.path("piece_bpe_32k.model")).join(once, "doc_id").limit(30).collect():
        words = re.findall(r"[^ \t-\r]+", r.text or "")
        assert (r.n_words, r.n_tokens) == (len(words), sum(count("▁" + w) for w in words))


def test_quality(spark, docs):
    rng = np.random.default_rng(3)
    x = rng.random((3000, 3))
    y = ((x[:, 0] > 0.5) ^ (rng.random(3000) < 0.05)).astype(float)
    forest = boosting.fit(x[:2000], y[:2000], (1, -1, 0))
    assert ((forest.probability(x[2000:]) > 0.5) == y[2000:]).mean() > 0.9
    grid = np.tile(x[:1], (50, 1))
    grid[:, 0] = np.linspace(0, 1, 50)
    assert (np.diff(forest.margin(grid)) >= -1e-9).all()
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(60)] + [(None, 1, 0), (5, None, 0)], "doc_id long, quality int, toxic int")
    by_id = {}
    for r in quality.quality_verdicts(docs, labels).collect():
        by_id.setdefault(r.doc_id, []).append(r)
    for r in docs.collect():
        w, lines = (r.text or "").encode().split(), [x for x in (r.text or "").split("\n") if x.strip(" \t\n\r\x0b\x0c")]
        seen = Counter(zip(w, w[1:], w[2:]))
        again = {k for i in range(len(w) - 2) if seen[tuple(w[i:i + 3])] > 1 for k in range(i, i + 3)}
        want = (len(w), sum(len(x.decode()) for x in w), sum(map((r.text or "").count, "#*$%&|<>")), len(lines) - len(set(lines)), len(again))
        failed = len(w) < 50 or 100 * len(again) > 50 * len(w)
        assert any((g.n_words, g.word_chars, g.n_symbols, g.n_dup_lines, g.n_repeat_words) == want and g.base_failed == failed and not (failed and g.kept) for g in by_id[r.doc_id])
    assert quality.keep_good(docs, labels.limit(0)).columns == docs.columns


def test_empty_tables(spark):
    none, benchmark = empty(spark), spark.createDataFrame([], "item_id long, text string")
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    for found in (
        ngram_join.near_duplicates(none), substring_dedup.removal_digests(none), quality.quality_verdicts(none, labels),
        decontaminate.leaks(none, benchmark), license_scan.scan_licenses(none), sharding.place(none, "doc_id", ["a"], 11),
        byte_bpe.digests(byte_bpe.decode_documents(byte_bpe.encode_documents(none, RANKS, PATTERN), RANKS, PATTERN)),
        token_counts.token_counts(none, public_tokenizers.path("piece_bpe_32k.model")),
        chat_quotes.conversations(spark.createDataFrame([], "conv_id long, turn long, role string, text string")),
    ):
        assert found.count() == 0


def test_pipeline(spark):
    rows = entry.queries()["pipeline"](spark, "/root/testdata/sf0.001").collect()
    assert rows and len({r.doc_id for r in rows}) == len(rows) and all(r.n_tokens > 0 for r in rows)
