"""Benchmark decontamination by templates, in DataFrame functions only.

Numbers, units after numbers and capitalised names become typed placeholders, so a question with other numbers
and names has the same template. Windows of the documents' templates are joined by hash with those of the
benchmark's items. Where they meet, the slots are compared: a re-parameterised question puts one value wherever
the item has one value. Each place of an item in a document (an alignment) is judged by itself, and all of them
together: a document is a leak where enough of an item's windows stand with consistent slots, or ``RUN_TOKENS``
tokens of it stand word for word. Items too short or too full of placeholders for template windows are sought word
for word.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from kerbside.operators.staging import staged

WINDOW_TOKENS = 10
#: Literal tokens that a benchmark window needs; a window of placeholders says too little.
MIN_LITERALS = 5
#: Share of an item's windows that a document must hold, and of the item's slot values that must be consistent.
MIN_COVERAGE = 0.5
MIN_CONSISTENT = 0.5
#: Tokens in a row that are a leak whatever share of the item they are.
RUN_TOKENS = 13
#: Items of fewer tokens are found nowhere: anyone may write them.
MIN_TOKENS = 5

NUMBER, NAME, UNIT = "0", "\ue000", "\ue001"
# Units of measure that may follow a number.
UNITS = "km|m|cm|mm|kg|g|mg|t|s|sec|min|h|ml|l|eur|usd|dollars|euros|percent|miles|feet|inches|pounds|hours|minutes|days"

_NUMBER = r"\p{N}[\p{N}.,]*"
_LETTERS = r"[\p{L}\p{M}]"


def tokens(text: Column) -> Column:
    """Numbers and runs of letters, as they stand."""
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(rf"{_NUMBER}|{_LETTERS}+"), F.lit(0))


def template(text: Column) -> Column:
    """The same tokens with placeholders, the rest in lower case."""
    held = F.regexp_replace(F.coalesce(text, F.lit("")), _NUMBER, f" {NUMBER} ")
    held = F.regexp_replace(held, rf" {NUMBER} +(?i:{UNITS})(?!{_LETTERS})", f" {NUMBER} {UNIT} ")
    held = F.regexp_replace(held, rf"(?<!{_LETTERS})\p{{Lu}}{_LETTERS}*", NAME)
    words = F.split(F.lower(held), rf"[^\p{{L}}\p{{M}}{NUMBER}{NAME}{UNIT}]+")
    return F.filter(words, lambda w: w != "")


def window_hashes(template_tokens: Column, size: int) -> Column:
    """Hash of every window of ``size`` tokens, in order; empty where there are fewer tokens."""
    n = F.size(template_tokens) - size + 1
    return F.when(
        n > 0,
        F.transform(F.sequence(F.lit(1), F.greatest(n, F.lit(1))), lambda i: F.xxhash64(F.slice(template_tokens, i, size))),
    ).otherwise(F.array().cast("array<bigint>"))


def _items(benchmark: DataFrame) -> DataFrame:
    return benchmark.select(
        F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text")
    ).where(F.col("item_id").isNotNull()).distinct()


def _item_windows(benchmark: DataFrame, size: int) -> DataFrame:
    held = _items(benchmark).select("item_id", template(F.col("text")).alias("template"))
    windows = held.select("item_id", "template", F.posexplode(window_hashes(F.col("template"), size)).alias("item_at", "window"))
    literal = F.size(F.filter(F.slice("template", F.col("item_at") + 1, F.lit(size)), lambda t: ~t.isin(NUMBER, NAME, UNIT)))
    return windows.where(literal >= MIN_LITERALS).select("item_id", "item_at", "window")


def _rows(documents: DataFrame) -> DataFrame:
    columns = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return columns.withColumn("row_id", F.xxhash64("doc_id", "text"))


_PLACE = ["row_id", "doc_id", "item_id"]


def _word_for_word(rows: DataFrame, benchmark: DataFrame, wanted: DataFrame, size: int, min_coverage: float) -> DataFrame | None:
    """(row_id, doc_id, item_id, n_windows, coverage) of items without template windows, by windows of their tokens."""
    items = _items(benchmark).join(wanted.select("item_id").distinct(), "item_id", "left_anti").select(
        "item_id", F.transform(tokens(F.col("text")), F.lower).alias("tokens")).where(F.size("tokens") >= MIN_TOKENS)
    items = staged(items.withColumn("length", F.least(F.size("tokens"), F.lit(size))))
    lengths = sorted(r.length for r in items.select("length").distinct().collect())  # MIN_TOKENS to size
    if not lengths:
        return None

    def windows(frame: DataFrame, key: list[str], length: int, at: str) -> DataFrame:
        hashes = window_hashes(F.col("tokens"), length)
        return frame.select(*key, F.lit(length).alias("length"), F.posexplode(hashes).alias(at, "window"))

    def all_lengths(frame: DataFrame, key: list[str], at: str, own: bool) -> DataFrame:
        found = None
        for length in lengths:
            part = windows(frame.where(F.col("length") == length) if own else frame, key, length, at)
            found = part if found is None else found.unionByName(part)
        return found

    of_items = all_lengths(items, ["item_id"], "item_at", True)
    totals = of_items.groupBy("item_id").agg(F.count(F.lit(1)).alias("total"))
    texts = rows.select("row_id", "doc_id", F.transform(tokens(F.col("text")), F.lower).alias("tokens"))
    met = all_lengths(texts, ["row_id", "doc_id"], "doc_at", False).join(of_items, ["length", "window"])
    return (
        met.groupBy(*_PLACE, (F.col("doc_at") - F.col("item_at")).alias("shift")).agg(F.count_distinct("item_at").alias("n_windows"))
        .join(totals, "item_id").withColumn("coverage", F.col("n_windows") / F.col("total"))
        .where(F.col("coverage") >= min_coverage).select(*_PLACE, "n_windows", "coverage")
    )


def _aligned(met: DataFrame, size: int) -> DataFrame:
    """Meeting windows with their alignment: shifts that follow each other closely; and all again as alignment -1."""
    shifts = met.select(*_PLACE, "shift").distinct()
    order = Window.partitionBy(*_PLACE).orderBy("shift")
    far = F.coalesce(F.col("shift") - F.lag("shift").over(order) > size, F.lit(False)).cast("int")
    numbered = shifts.withColumn("far", far).withColumn("alignment", F.sum("far").over(order)).drop("far")
    joined = met.alias("m").join(
        numbered.alias("s"), (F.col("m.row_id") == F.col("s.row_id")) & F.col("m.doc_id").eqNullSafe(F.col("s.doc_id"))
        & (F.col("m.item_id") == F.col("s.item_id")) & (F.col("m.shift") == F.col("s.shift"))
    ).select("m.*", "s.alignment")
    return joined.withColumn("alignment", F.explode(F.array("alignment", F.lit(-1).cast("long"))))


def _verbatim_runs(met: DataFrame, of_rows: DataFrame, of_items: DataFrame, totals: DataFrame, size: int) -> DataFrame:
    """Runs of windows of one shift whose slots hold the item's own values, long enough to be a leak."""
    step = F.explode(F.sequence(F.lit(0), F.lit(size - 1))).alias("step")
    slots = met.select(*_PLACE, "shift", "item_at", step).select(
        *_PLACE, "shift", F.col("item_at").alias("start"), (F.col("item_at") + F.col("step")).alias("item_at"),
        (F.col("item_at") + F.col("step") + F.col("shift")).alias("doc_at"))
    same = F.col("doc_value").eqNullSafe(F.col("item_value"))
    windows = (
        slots.join(of_rows, ["row_id", "doc_at"], "left").join(of_items, ["item_id", "item_at"], "left")
        .groupBy(*_PLACE, "shift", "start").agg(F.bool_and(same).alias("same")).where("same")
    )
    order = Window.partitionBy(*_PLACE, "shift").orderBy("start")
    runs = windows.withColumn("run", F.col("start") - F.row_number().over(order)).groupBy(*_PLACE, "shift", "run").agg(
        F.count(F.lit(1)).alias("n_windows")).where(F.col("n_windows") + size - 1 >= RUN_TOKENS)
    return runs.join(totals, "item_id").select(*_PLACE, "n_windows", (F.col("n_windows") / F.col("total")).alias("coverage"))


def _leaks_by_row(
    documents: DataFrame, benchmark: DataFrame, size: int, min_coverage: float, min_consistent: float
) -> DataFrame:
    """(row_id, doc_id, item_id, n_windows, coverage, n_slots, consistent), a row for each reason to call a leak."""
    rows = _rows(documents)
    wanted = staged(_item_windows(benchmark, size))
    totals = wanted.groupBy("item_id").agg(F.count(F.lit(1)).alias("total"))
    windows = rows.select("row_id", "doc_id", template(F.col("text")).alias("template")).select(
        "row_id", "doc_id", F.posexplode(window_hashes(F.col("template"), size)).alias("doc_at", "window")
    )
    # No hint: the planner broadcasts the items' windows while the table is under the session's threshold.
    met = staged(windows.join(wanted, "window").select(*_PLACE, "doc_at", "item_at").distinct()).withColumn(
        "shift", F.col("doc_at") - F.col("item_at"))
    # Staged, so that the planner knows how few they are and need not shuffle every text to find theirs.
    found_in = staged(met.select("row_id").distinct())
    held = rows.join(found_in, "row_id", "left_semi").dropDuplicates(["row_id"])
    of_rows = staged(_slots(held, "row_id", "doc_at", "doc_value"))
    of_items = staged(_slots(_items(benchmark), "item_id", "item_at", "item_value"))

    aligned = staged(_aligned(met, size))
    group = [*_PLACE, "alignment"]
    covered = (
        aligned.groupBy(*group).agg(F.count_distinct("item_at").alias("n_windows"))
        .join(totals, "item_id").withColumn("coverage", F.col("n_windows") / F.col("total"))
        .where(F.col("coverage") >= min_coverage).drop("total")
    )
    step = F.explode(F.sequence(F.lit(0), F.lit(size - 1))).alias("step")
    places = aligned.select(*group, "doc_at", "item_at", step).select(
        *group, (F.col("doc_at") + F.col("step")).alias("doc_at"), (F.col("item_at") + F.col("step")).alias("item_at")
    ).distinct()
    paired = places.join(of_rows, ["row_id", "doc_at"]).join(of_items, ["item_id", "item_at"])
    per_value = paired.groupBy(*group, "item_value").agg(F.count_distinct("doc_value").alias("values"))
    checked = per_value.groupBy("row_id", "item_id", "alignment").agg(
        F.count(F.lit(1)).alias("n_slots"), F.avg((F.col("values") == 1).cast("double")).alias("consistent")
    )
    found = (
        covered.join(checked, ["row_id", "item_id", "alignment"], "left")
        .withColumns({"n_slots": F.coalesce("n_slots", F.lit(0)), "consistent": F.coalesce("consistent", F.lit(1.0))})
        .where(F.col("consistent") >= min_consistent).drop("alignment")
    )
    exact = _verbatim_runs(met, of_rows, of_items, totals, size)
    short = _word_for_word(rows, benchmark, wanted, size, min_coverage)
    exact = exact if short is None else exact.unionByName(short)
    return found.unionByName(exact.select("*", F.lit(0).cast("long").alias("n_slots"), F.lit(1.0).alias("consistent")))


def leaks(
    documents: DataFrame,
    benchmark: DataFrame,
    size: int = WINDOW_TOKENS,
    min_coverage: float = MIN_COVERAGE,
    min_consistent: float = MIN_CONSISTENT,
) -> DataFrame:
    """(doc_id, item_id, n_windows, coverage, n_slots, consistent) of the documents that hold a benchmark item.

    ``coverage`` is the share of the item's windows found at one place (or all places together), ``consistent`` the
    share of the item's distinct slot values that stand for one value there; the place with the highest coverage
    counts. Items of fewer than ``MIN_TOKENS`` tokens are found nowhere; NULL texts hold nothing. Each row is judged
    by its own text, rows without ``doc_id`` too; rows of one ``doc_id`` give one row per item. Other columns are
    not read.
    """
    found = _leaks_by_row(documents, benchmark, size, min_coverage, min_consistent)
    best = F.max(F.struct("coverage", "consistent", "n_windows", "n_slots")).alias("b")
    return found.groupBy("doc_id", "item_id").agg(best).select(
        "doc_id", "item_id", "b.n_windows", "b.coverage", "b.n_slots", "b.consistent")


def _slots(rows: DataFrame, key: str, at: str, value: str) -> DataFrame:
    """Values of the slots of each row: (key, place, value)."""
    both = F.arrays_zip(template(F.col("text")).alias("kind"), tokens(F.col("text")).alias("value"))
    return rows.select(key, F.posexplode(both).alias(at, "slot")).where(
        F.col("slot.kind").isin(NUMBER, NAME, UNIT)
    ).select(key, at, F.lower("slot.value").alias(value))


def drop_leaks(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``documents`` that hold no benchmark item, with all their columns."""
    found = _leaks_by_row(documents, benchmark, WINDOW_TOKENS, MIN_COVERAGE, MIN_CONSISTENT)
    held = found.select(F.col("row_id").alias("_leaked")).distinct()
    own = F.xxhash64(documents["doc_id"].cast("long"), documents["text"].cast("string"))
    return documents.join(held, own == held["_leaked"], "left_anti")
