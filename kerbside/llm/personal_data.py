"""Personal data in texts, in DataFrame functions only.

Rules are regular expressions that propose spans, each with a check that confirms them: Luhn for cards, the
remainder by 97 for bank accounts, ranges for addresses, digit counts for phones. Words nearby raise or lower a
span's score. The spans of base rules always stay; other rules' spans stay when their score is high enough.

Positions come without Python and without a shuffle: a rule's matches and the pieces of text between them alternate,
so a match starts where the lengths before it add up to. Sums run in blocks, so a text of a million matches costs
little more than in proportion. Quantifiers are possessive and matches begin at the beginning of a run of their
characters or where the match before ended, which finds the same spans without trying every place of a long run.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

#: Spans of rules other than the base ones need this score.
LEAST_SCORE = 0.5
#: How much a word nearby raises a score or lowers it, and how many characters on each side are searched for one.
CONTEXT_WEIGHT = 0.3
CONTEXT_BEFORE, CONTEXT_AFTER = 48, 24
#: Matches whose lengths are added up together, and places in the list of spans that are searched for overlaps.
BLOCK, NEAR = 256, 3

# Kinds in the order in which spans are listed.
KINDS = ["email", "ip", "card", "phone", "iban", "ssn"]

# Length of a bank account number by country.
IBAN_LENGTHS = {
    "NO": 15, "BE": 16, "DK": 18, "FI": 18, "NL": 18, "MK": 19, "SI": 19, "AT": 20, "BA": 20, "EE": 20, "LT": 20,
    "LU": 20, "CH": 21, "HR": 21, "LI": 21, "LV": 21, "BG": 22, "DE": 22, "GB": 22, "GE": 22, "IE": 22, "ME": 22,
    "RS": 22, "AE": 23, "GI": 23, "IL": 23, "AD": 24, "CZ": 24, "ES": 24, "MD": 24, "PK": 24, "RO": 24, "SA": 24,
    "SE": 24, "SK": 24, "TN": 24, "VG": 24, "PT": 25, "IS": 26, "TR": 26, "FR": 27, "GR": 27, "IT": 27, "MC": 27,
    "MR": 27, "SM": 27, "AL": 28, "AZ": 28, "CY": 28, "HU": 28, "LB": 28, "PL": 28, "BR": 29, "QA": 29, "MU": 30,
    "JO": 30, "KW": 30, "MT": 31,
}


def _digits(match: Column) -> Column:
    return F.regexp_replace(match, "[^0-9]", "")


def _is_email(match: Column) -> Column:
    return F.lit(True)


def _is_ip(match: Column) -> Column:
    part = "0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]{1,2})"
    return F.rlike(match, F.lit(rf"^{part}(?:\.{part}){{3}}$"))


def _is_card(match: Column) -> Column:
    # The digits of a match may be many; only 13 to 19 are summed.
    digits = F.when(F.length(match) <= 40, _digits(match)).otherwise("")
    return F.length(digits).between(13, 19) & F.call_function("luhn_check", digits)


def _is_phone(match: Column) -> Column:
    return F.length(_digits(match)).between(9, 15)


def _is_iban(match: Column) -> Column:
    """The number with its first four characters last, letters as 10 to 35, leaves 1 when divided by 97."""
    plain = F.replace(match, F.lit(" "), F.lit(""))
    turned = F.split(F.concat(F.substr(plain, F.lit(5)), F.substr(plain, F.lit(1), F.lit(4))), "")

    def add(left: Column, char: Column) -> Column:
        number = F.when(char.between("0", "9"), left * 10 + F.ascii(char) - 48).otherwise(left * 100 + F.ascii(char) - 55)
        return F.pmod(number, F.lit(97))

    return F.aggregate(turned, F.lit(0), lambda left, char: F.when(char == "", left).otherwise(add(left, char)).cast("int")) == 1


def _any(match: Column) -> Column:
    return F.lit(True)


def _iban_pattern() -> str:
    by_length: dict[int, list[str]] = {}
    for country, length in IBAN_LENGTHS.items():
        by_length.setdefault(length, []).append(country)
    forms = [rf"(?:{'|'.join(sorted(c))})[0-9]{{2}}(?: ?[A-Z0-9]){{{n - 4}}}" for n, c in sorted(by_length.items())]
    return rf"(?<![A-Za-z0-9])(?:{'|'.join(forms)})(?![A-Za-z0-9])"


@dataclass(frozen=True)
class Rule:
    """``gate`` is a test that every text with a span of this rule passes."""

    kind: str
    pattern: str
    check: Callable[[Column], Column]
    score: float
    gate: Callable[[Column], Column]
    words: str
    against: str = ""
    base: bool = False


def _holds(part: str) -> Callable[[Column], Column]:
    return lambda text: F.contains(text, F.lit(part))


def _matches(pattern: str) -> Callable[[Column], Column]:
    return lambda text: F.rlike(text, F.lit(pattern))


_LOCAL = "A-Za-z0-9._%+-"

# The rules, base ones first; words that speak for and against a span are lower-case expressions.
RULES = [
    Rule("email", rf"(?:(?<![{_LOCAL}])|\G)[{_LOCAL}]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++", _is_email, 0.9,
         _holds("@"), r"mail|contact|write to|courriel|correo", base=True),
    Rule("ip", r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++", _is_ip, 0.6,
         _matches(r"[0-9]\.[0-9]++\.[0-9]++\.[0-9]"), r"ip\b|address|host|server|adresse", r"version|release|section|chapter", base=True),
    Rule("card", r"[0-9](?:[ -]?[0-9])++", _is_card, 0.7,
         _matches(r"[0-9](?:[ -]?[0-9]){12}"), r"card|visa|master|amex|credit|karte|carte|tarjeta", r"isbn|serial|order|tracking|imei", base=True),
    Rule("phone", r"\+[0-9][ ().0-9-]+[0-9]", _is_phone, 0.7,
         _holds("+"), r"phone|tel|call|mobile|fax|cell|anruf|appel|llam", base=True),
    # Well-formed cards and phones beside other digits, which the base rules take together.
    Rule("card", r"(?<![0-9])[3-6][0-9]{3}([ -]?)[0-9]{4}\1[0-9]{4}\1[0-9]{4}(?![0-9])", _is_card, 0.5,
         _matches(r"[0-9]{4}[ -]?[0-9]{4}[ -]?[0-9]{4}[ -]?[0-9]{4}"), r"card|visa|master|amex|credit|karte|carte|tarjeta", r"isbn|serial|order|tracking|imei"),
    Rule("phone", r"\+[0-9]{1,3}[ .-]?(?:\([0-9]{2,4}\)|[0-9]{2,4})[ .-]?[0-9]{3,4}[ .-][0-9]{4}(?![0-9])", _is_phone, 0.5,
         _holds("+"), r"phone|tel|call|mobile|fax|cell|anruf|appel|llam"),
    Rule("phone", r"(?<![0-9+().-])(?:\([0-9]{3}\) ?|[0-9]{3}[ .-])[0-9]{3}[.-][0-9]{4}(?![0-9-])", _any, 0.3,
         _matches(r"[0-9]{3}[.-][0-9]{4}"), r"phone|tel|call|mobile|fax|cell|anruf|appel|llam", r"order|serial|part"),
    Rule("iban", _iban_pattern(), _is_iban, 0.8,
         _matches(r"[A-Z]{2}[0-9]{2} ?[A-Z0-9]"), r"iban|account|bank|konto|compte|cuenta"),
    Rule("ssn", r"(?<![0-9-])(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}(?![0-9-])", _any, 0.3,
         _matches(r"[0-9]{3}-[0-9]{2}-[0-9]{4}"), r"ssn\b|social security|taxpayer|tax id"),
]

SPAN = "struct<kind_no: int, start: int, end: int, base: boolean, score: double>"


def _parts(rule: Rule) -> tuple[Column, Column]:
    """A text's matches of a rule, and the pieces around them: one more than matches."""
    text = F.col("_text")
    held = rule.gate(text)
    none = F.array().cast("array<string>")
    found = F.when(held, F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(0))).otherwise(none)
    return found, F.when(held, F.split(text, rule.pattern, -1)).otherwise(none)


def _judged(rule: Rule, found: Column, pieces: Column) -> Column:
    """Per match: characters before it since the last one, its length, and its score; NULL where the check fails."""
    def judge(x: Column) -> Column:
        near = F.lower(F.concat(F.right(x["before"], F.lit(CONTEXT_BEFORE)), F.lit(" "), F.left(x["after"], F.lit(CONTEXT_AFTER))))
        score = F.lit(rule.score) + F.when(F.rlike(near, F.lit(rf"\b(?:{rule.words})")), CONTEXT_WEIGHT).otherwise(0.0)
        if rule.against:
            score = score - F.when(F.rlike(near, F.lit(rf"\b(?:{rule.against})")), CONTEXT_WEIGHT).otherwise(0.0)
        score = F.least(F.greatest(F.round(score, 6), F.lit(0.0)), F.lit(1.0))
        kept = rule.check(x["match"]) if rule.base else rule.check(x["match"]) & (score >= LEAST_SCORE)
        return F.struct(
            F.length(x["before"]).alias("gap"), F.length(x["match"]).alias("size"), F.when(kept, score).alias("score"))

    n = F.size(found)
    around = F.arrays_zip(
        F.slice(pieces, F.lit(1), n).alias("before"), found.alias("match"), F.slice(pieces, F.lit(2), n).alias("after"))
    return F.transform(around, judge)


def _located(rule: Rule, judged: Column) -> Column:
    """Spans of the matches that have a score."""
    kind, spans = F.lit(KINDS.index(rule.kind)), F.array().cast(f"array<{SPAN}>")

    def span(start: Column, end: Column, score: Column) -> Column:
        return F.struct(
            kind.alias("kind_no"), start.alias("start"), end.alias("end"), F.lit(rule.base).alias("base"), score.alias("score"))

    def add(done: Column, x: Column) -> Column:
        start, end = done["at"] + x["gap"], done["at"] + x["gap"] + x["size"]
        more = F.when(x["score"].isNull(), done["spans"]).otherwise(
            F.concat(done["spans"], F.array(span(start, end, x["score"]))))
        return F.struct(end.alias("at"), more.cast(f"array<{SPAN}>").alias("spans"))

    def join(done: Column, block: Column) -> Column:
        moved = F.transform(block["spans"], lambda s: span(s["start"] + done["at"], s["end"] + done["at"], s["score"]))
        more = F.concat(done["spans"], F.array(moved.cast(f"array<{SPAN}>")))
        return F.struct((done["at"] + block["at"]).alias("at"), more.cast(f"array<array<{SPAN}>>").alias("spans"))

    numbers = F.sequence(F.lit(0), ((F.size(judged) - 1) / BLOCK).cast("int"))
    start = F.struct(F.lit(0).alias("at"), spans.alias("spans"))
    blocks = F.transform(numbers, lambda b: F.aggregate(F.slice(judged, b * BLOCK + 1, F.lit(BLOCK)), start, add))
    whole = F.struct(F.lit(0).alias("at"), F.array().cast(f"array<array<{SPAN}>>").alias("spans"))
    found = F.aggregate(blocks, whole, join, lambda done: F.flatten(done["spans"]))
    return F.when(F.size(judged) > 0, found).otherwise(spans)


def find_spans(documents: DataFrame) -> DataFrame:
    """The rows with ``spans``: (kind, start, end, base, score) in order of kind and start, code points, end exclusive.

    A NULL text has no spans. A span that another rule finds too stands once; a span of another rule that overlaps
    a base span of its kind goes, if that is at most ``NEAR`` places away in the list. All columns of ``documents`` stay; a column ``spans`` of its own is
    replaced, and rows that repeat get a row each.
    """
    rows = documents.withColumn("_text", F.coalesce(F.col("text").cast("string"), F.lit("")))
    # Each step's columns are used more than once by the next, so the optimizer keeps them apart.
    for step in range(len(RULES)):
        rows = rows.withColumns(dict(zip((f"_found{step}", f"_pieces{step}"), _parts(RULES[step]))))
    rows = rows.withColumns({
        f"_judged{i}": _judged(r, F.col(f"_found{i}"), F.col(f"_pieces{i}")) for i, r in enumerate(RULES)})
    located = F.concat(*[_located(r, F.col(f"_judged{i}")) for i, r in enumerate(RULES)])
    order = lambda a, b: F.when(_key(a) < _key(b), -1).when(_key(a) > _key(b), 1).otherwise(0)
    rows = rows.withColumn("_all", F.array_sort(located, order))

    def overlaps(x: Column, other: Column) -> Column:
        return F.coalesce(
            other["base"] & (other["kind_no"] == x["kind_no"]) & (other["start"] < x["end"]) & (x["start"] < other["end"]),
            F.lit(False))

    def stays(x: Column, i: Column) -> Column:
        before = F.get("_all", i - 1)
        gone = F.coalesce(
            (before["kind_no"] == x["kind_no"]) & (before["start"] == x["start"]) & (before["end"] == x["end"]), F.lit(False))
        for step in (*range(-NEAR, 0), *range(1, NEAR + 1)):
            gone = gone | overlaps(x, F.get("_all", i + step))
        return x["base"] | ~gone

    names = F.array(*map(F.lit, KINDS))
    spans = F.transform(F.filter("_all", stays), lambda s: F.struct(
        F.get(names, s["kind_no"]).alias("kind"), s["start"].alias("start"), s["end"].alias("end"),
        s["base"].alias("base"), s["score"].alias("score")))
    kept = [c for c in documents.columns if c != "spans"]
    return rows.select(*kept, spans.alias("spans"))


def _key(span: Column) -> Column:
    return F.struct(span["kind_no"], span["start"], ~span["base"], span["end"])


def masked(documents: DataFrame) -> DataFrame:
    """The rows with every span's characters in ``text`` replaced by its kind in angle brackets.

    Of spans that overlap, the one that starts first (and then the longest) names the replacement. NULL texts stay.
    """
    found = find_spans(documents).withColumn("_spans", F.array_sort(F.transform(
        "spans", lambda s: F.struct(s["start"].alias("start"), (-s["end"]).alias("end"), s["kind"].alias("kind")))))
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("parts"))

    def add(done: Column, s: Column) -> Column:
        between = F.substr(F.col("text"), done["at"] + 1, s["start"] - done["at"])
        more = F.concat(done["parts"], F.array(between, F.concat(F.lit("<"), s["kind"], F.lit(">"))))
        return F.when(s["start"] < done["at"], F.struct(F.greatest(done["at"], -s["end"]).alias("at"), done["parts"].alias("parts"))).otherwise(
            F.struct((-s["end"]).alias("at"), more.alias("parts")))

    whole = F.aggregate("_spans", start, add, lambda done: F.concat(
        F.array_join(done["parts"], ""), F.substr(F.col("text"), done["at"] + 1)))
    text = F.when(F.size("_spans") > 0, whole).otherwise(F.col("text"))
    return found.withColumn("text", text).select(*documents.columns)


def _equals(value: str) -> Callable[[Column], Column]:
    return lambda x: x == value


def span_digests(documents: DataFrame) -> DataFrame:
    """Per row: base spans of each kind, a digest of the base spans, and all spans as one string."""
    def listed(spans: Column) -> Column:
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    found = find_spans(documents.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")))
    found = found.withColumn("_base", F.filter("spans", lambda s: s["base"]))
    kinds = F.transform("_base", lambda s: s["kind"])
    counts = [F.size(F.filter(kinds, _equals(kind))).cast("long").alias(f"n_{kind}") for kind in KINDS[:4]]
    return found.select("doc_id", *counts, F.sha2(listed(F.col("_base")), 256).alias("base_sha256"), listed(F.col("spans")).alias("spans"))
