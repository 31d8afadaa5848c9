"""Collocations, personal data and importance resampling against brute force."""

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from kerbside.llm import collocations, importance, personal_data, quotient_filter as qf

DOCS = "doc_id long, text string, lang string, rank long, _row string, spans string"


def frame(spark, texts):
    return spark.createDataFrame([(i, t, lang, 1, "x", "y") for i, (t, lang) in enumerate(texts)], DOCS).repartition(3)


@pytest.mark.parametrize("width", [1, 7, 16, 32])
def test_quotient_filter_loses_nothing(width):
    rng = np.random.default_rng(width)
    words = [rng.integers(0, 1 << width, 5000, dtype=np.uint64) for _ in range(4)]
    high, low = qf.pack(words, width)
    moved = qf.permute(high, low, width)
    assert all((a == b).all() for a, b in zip(qf.restore(*moved, width), (high, low)))
    assert all((a == b).all() for a, b in zip(qf.unpack(high, low, width), words))
    entries = qf.counted(*moved, rng.choice([1, 2, 254, 255, 256, 1 << 40], 5000))
    for blocks in (1, 6):
        bits, back = qf.part_bits(blocks, width), []
        parts = qf.parts_of(entries[0], width, bits)
        for part in np.unique(parts):
            held = [x[parts == part] for x in entries]
            back.append(qf.read(int(part), *qf.write(*held, width, bits), width, bits))
        assert all((np.concatenate(a) == b).all() for a, b in zip(zip(*back), entries))


def plain_collocations(rows, least, most):
    count, n = {}, Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        text = "".join(c.lower() if c.isascii() else c for c in text or "")
        for piece in re.split("[.,;:!?\n-\r]", text):
            words = re.findall("[^ \t]+", piece)
            n[lang] += len(words)
            for k in range(1, 5):
                for i in range(len(words) - k + 1):
                    key = (lang, tuple(words[i:i + k]))
                    count[key] = count.get(key, 0) + 1
    often = {k: a for k, a in count.items() if a >= least and len(k[1]) > 1}
    out = {}
    for (lang, words), a in often.items():
        if any(
            ln == lang and len(longer) > len(words) and 100 * b >= 80 * a
            and any(longer[i:i + len(words)] == words for i in range(len(longer)))
            for (ln, longer), b in often.items()
        ):
            continue
        cuts = [(2_000_000 * a // (count[lang, words[:k]] + count[lang, words[k:]]), k) for k in range(1, len(words))]
        score, k = min(cuts)
        out.setdefault(lang, []).append((-score, -a, " ".join(words).encode(), a, count[lang, words[:k]], count[lang, words[k:]]))
    return {
        (lang, rank, p.decode(), a, left, right, n[lang], -s)
        for lang, found in out.items() for rank, (s, _, p, a, left, right) in enumerate(sorted(found)[:most], 1)
    }


def test_collocations(spark):
    rng = random.Random(4)
    words = ["New", "york", "city", "é", "x-y", "\x1f", "a'b", "ÀB", "w8"]
    texts = [(None, "en"), ("", None), ("a b " * 400, "en"), ("New York\tcity\x0bhall. new york", None), (" .,;\n", "de")] * 2
    for i in range(120):
        body = "".join(rng.choice(words) + rng.choice([" ", "  ", "\t", " ", " ", ". ", "\r\n", ";"]) for _ in range(rng.randint(1, 120)))
        texts.append((body + "new york city hall " * rng.randint(0, 2), rng.choice(["en", "en", "de", None, "und"])))
    docs = frame(spark, texts)
    for least, most, sizes in ((5, 40, {}), (30, 2000, {"slice_bytes": 700, "row_words": 50, "held": 300})):
        got = collocations.collocations(docs, least, most, **sizes).collect()
        want = plain_collocations(texts, least, most)
        assert len(want) > 20 and len(got) == len(want) and {tuple(r) for r in got} == want
    assert not collocations.collocations(docs.where("false")).count()
    assert not collocations.collocations(docs.withColumn("text", docs.lang.substr(9, 1))).count()


BASE = [
    ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"), ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    ("card", r"[0-9]([\x20-]?[0-9])+"), ("phone", r"\+[0-9][\x20().0-9-]+[0-9]"),
]


def luhn(digits):
    total = 0
    for i, c in enumerate(map(int, reversed(digits))):
        total += c if i % 2 == 0 else (2 * c - 9 if c > 4 else 2 * c)
    return total % 10 == 0


def plain_spans(text):
    def passes(kind, match):
        digits = re.sub("[^0-9]", "", match)
        return {
            "email": True, "ip": kind != "ip" or all(int(p) <= 255 for p in match.split(".")),
            "card": 13 <= len(digits) <= 19 and luhn(digits), "phone": 9 <= len(digits) <= 15,
        }[kind]

    return [(k, m.start(), m.end()) for k, p in BASE for m in re.finditer(p, text or "") if passes(k, m[0])]


def test_personal_data(spark):
    rng = random.Random(8)
    atoms = ["a@b.c", "x_y%z+@d-e.f.g", "@", "..", "1.2.3.4", "256.1.1.1", "0001.2.3.255", "1.2.3.4.5", "4111 1111 1111 1111", "4111111111111112",
             "5500-0000-0000-0004", "+1 (988) 555-2485", "+49 30 12", "+1234567890123456", "é", "😀", "-", " ", "  ", "12", "7", "+", "_d@e.f", "\n", "word"]
    texts = [(None, "en"), ("", "en"), ("a" * 50_000 + " 1" * 20_000 + "a." * 20_000, "en"), ("x@y.z " * 3000, "en")]
    texts += [("".join(rng.choice(atoms) for _ in range(rng.randint(1, 60))), "en") for _ in range(300)]
    got = personal_data.span_digests(frame(spark, texts + texts[:5])).collect()
    assert len(got) == len(texts) + 5
    added = 0
    for r in got:
        text = (texts + texts[:5])[r.doc_id][0]
        want = plain_spans(text)
        assert (r.n_email, r.n_ip, r.n_card, r.n_phone) == tuple(sum(k == kind for k, *_ in want) for kind, _ in BASE), text
        assert r.base_sha256 == hashlib.sha256(",".join(f"{k}:{a}:{b}" for k, a, b in want).encode()).hexdigest()
        all_ = [(k, int(a), int(b)) for k, a, b in (x.split(":") for x in r.spans.split(",") if x)]
        places = [(personal_data.KINDS.index(k), a) for k, a, _ in all_]
        assert set(want) <= set(all_) and len(set(all_)) == len(all_) and places == sorted(places)
        added += len(all_) - len(want)
    assert added


def test_personal_data_checks_and_context(spark):
    texts = [
        "IBAN DE89 3704 0044 0532 0130 00 IS", "DE88 3704 0044 0532 0130 00", "GB82WEST12345698765432", "my SSN is 123-45-6789", "part 123-45-6789",
        "SSN 000-12-3456", "+1 (269) 555-3296 4524132264652876 and", "call 555 123-4567 now", "lot 555 123-4567 now", "telephone number +1 (269) 555-3296",
    ]
    rows = personal_data.find_spans(frame(spark, [(t, "en") for t in texts]))
    assert rows.columns == ["doc_id", "text", "lang", "rank", "_row", "spans"]
    got = {r.doc_id: {(s.kind, texts[r.doc_id][s.start:s.end]) for s in r.spans} for r in rows.collect()}
    card = ("card", "4524132264652876") if luhn("4524132264652876") else None
    assert got == {
        0: {("iban", "DE89 3704 0044 0532 0130 00")}, 1: set(), 2: {("iban", "GB82WEST12345698765432")}, 3: {("ssn", "123-45-6789")}, 4: set(),
        5: set(), 6: {("phone", "+1 (269) 555-3296"), card} - {None}, 7: {("phone", "555 123-4567")}, 8: set(), 9: {("phone", "+1 (269) 555-3296")},
    }
    masked = {r.doc_id: r.text for r in personal_data.masked(frame(spark, [(t, "en") for t in texts] + [(None, "en")])).collect()}
    assert masked[0] == "IBAN <iban> IS" and masked[8] == texts[8] and masked[10] is None and masked[9] == "telephone number <phone>"
    assert not personal_data.span_digests(frame(spark, texts and [("x", "y")]).where("false")).count()


def test_resampling(spark):
    rng = random.Random(2)
    vocabulary = ["".join(rng.choices("abcdé0Z", k=rng.randint(1, 5))) for _ in range(80)]
    texts = [(None, "en"), ("", "en"), ("..", "en")] + [
        (rng.choice([" ", "-", "_"]).join(rng.choices(vocabulary, k=rng.randint(1, 90))), "en") for _ in range(400)]
    docs = frame(spark, texts)
    docs = docs.unionByName(docs.where("doc_id % 7 = 0")).unionByName(docs.where("doc_id in (5, 6, 70)").withColumn("doc_id", docs.doc_id * None))
    target = spark.createDataFrame([(" ".join(rng.choices(vocabulary[:20], k=50)),) for _ in range(9)] + [(None,)], "text string")

    def features(text):
        words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(c.lower() if c.isascii() else c for c in text or ""))
        runs = [" ".join(words[i:i + k]) for k in (1, 2, 3) for i in range(len(words) - k + 1)]
        return len(words), [zlib.crc32(r.encode()) % 10000 for r in runs]

    rows = [(r.doc_id, *features(r.text)) for r in docs.collect()]
    s, t = Counter(), Counter()
    for *_, f in rows:
        s.update(f)
    for (text,) in target.collect():
        t.update(features(text)[1])
    s_all, t_all = sum(s.values()), sum(t.values())
    gain = {b: math.floor(1000 * math.log((t[b] + 1) * (s_all + 10000) / ((s[b] + 1) * (t_all + 10000)))) for b in range(10000)}
    want, open_ = [], []
    for doc_id, n, f in rows:
        weight = sum(gain[b] for b in f)
        if doc_id is None:
            want.append((None, len(f), weight, None, None))
            continue
        h = int(hashlib.sha256(f"42:{doc_id}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        (open_ if n >= 20 else want).append((doc_id, len(f), weight, score, None))
    for percent in (5, 100, 33):
        open_.sort(key=lambda r: (-r[3], r[0]))
        drawn = [(*r[:4], i + 1 if i < len(open_) * percent // 100 else None) for i, r in enumerate(open_)]
        got = importance.resample(docs, target, percent).collect()
        assert Counter(map(tuple, got)) == Counter(want + drawn)
    small = list(importance.feature_buckets(b"a b c d e f g", piece=3))
    assert sorted(np.concatenate([b for _, b in small]).tolist()) == sorted(features("a b c d e f g")[1]) and len(small) > 2
    assert not importance.resample(docs.where("false"), target).count()
    assert importance.resample(docs, target.where("false")).count() == docs.count()
