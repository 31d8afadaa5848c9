"""Conversations from messages that quote each other, in DataFrame functions only.

Lines that start with ``>`` are quotes, as deep as they have such marks. Quoted lines, and blocks of quoted lines of
one depth, are hashed in normal form and joined to the first message of the conversation that says them itself.
A message replies to the one that its least deep known quotes come from, by most of their characters; deeper quotes
belong to what that one replied to. Messages come out without quotes, with their place in the conversation: the thread (the first message that replies lead back to) and turn.
Replies point to earlier turns, so within a thread the order of turns is a reply order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from kerbside.operators.staging import staged

_MARKS = r"^(?:[ \t]*>)+"
_QUOTE_LINES = r"(?m)^[ \t]*>.*(?:\r?\n|$)"
_ATTRIBUTION = r"(?m)^[^\r\n>]{0,200}\bwrote:[ \t]*\r?\n(?=[ \t]*>)"


def normal_form(text: Column) -> Column:
    """Hash of the text in lower case with single blanks; NULL without any letter or digit."""
    plain = F.trim(F.regexp_replace(F.lower(text), r"\s+", " "))
    return F.when(plain.rlike(r"[\p{L}\p{N}]"), F.md5(plain))


def without_quotes(text: Column) -> Column:
    """The text without quoted lines and the line that introduces them."""
    bare = F.regexp_replace(F.regexp_replace(F.coalesce(text, F.lit("")), _ATTRIBUTION, ""), _QUOTE_LINES, "")
    return F.regexp_replace(F.regexp_replace(bare, r"^\s+|\s+$", ""), r"(?:\r?\n){3,}", "\n\n")


def _keyed(messages: DataFrame) -> DataFrame:
    return messages.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.col("role").cast("string").alias("role"), F.col("text").cast("string").alias("text"),
    )


def _quoted(messages: DataFrame) -> DataFrame:
    """Quoted passages: (conv_id, turn, level, passage, size), lines and blocks of lines of one depth."""
    quoting = messages.where(F.col("text").rlike(r"(?m)^[ \t]*>")).select("conv_id", "turn", "text").distinct()
    lines = quoting.select(
        "conv_id", "turn", F.xxhash64("conv_id", "turn", "text").alias("row_id"),
        F.posexplode(F.split("text", r"\r?\n")).alias("line", "body"),
    ).withColumns({
        "level": F.length(F.regexp_replace(F.regexp_extract("body", _MARKS, 0), "[^>]", "")),
        "body": F.regexp_replace("body", _MARKS, ""),
    })
    order = Window.partitionBy("row_id").orderBy("line")
    changed = (F.col("level") != F.lag("level", 1, -1).over(order)).cast("int")
    blocks = lines.withColumn("changed", changed).withColumn("block", F.sum("changed").over(order)).where(F.col("level") > 0)
    whole = blocks.groupBy("conv_id", "turn", "row_id", "block", "level").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("line", "body"))), lambda x: x["body"]), " ").alias("body")
    )
    columns = ["conv_id", "turn", "level", "body"]
    return blocks.select(*columns).unionByName(whole.select(*columns)).select(
        "conv_id", "turn", "level", normal_form(F.col("body")).alias("passage"), F.length("body").alias("size")
    )


def _said(messages: DataFrame) -> DataFrame:
    """First turn of each conversation that says a passage itself: its lines, paragraphs and whole texts."""
    own = messages.withColumn("own", without_quotes(F.col("text")))
    passages = F.array_distinct(F.concat(
        F.array("own"), F.split("own", r"\r?\n\s*\r?\n"), F.split("own", r"\r?\n")
    ))
    said = own.select("conv_id", "turn", F.explode(passages).alias("body"))
    return said.select("conv_id", "turn", normal_form(F.col("body")).alias("passage")).where(
        F.col("passage").isNotNull()
    ).groupBy("conv_id", "passage").agg(F.min("turn").alias("original"))


def reply_links(messages: DataFrame) -> DataFrame:
    """(conv_id, turn, reply_to) of the messages whose quotes lead to an earlier turn of their conversation."""
    known = _keyed(messages).where(F.col("conv_id").isNotNull() & F.col("turn").isNotNull())
    quoted = staged(_quoted(known))
    # Only conversations that quote at all are searched for originals.
    quoting = quoted.select("conv_id").distinct()
    said = _said(known.join(quoting, "conv_id", "left_semi"))
    led = quoted.join(said, ["conv_id", "passage"]).where(F.col("original") < F.col("turn"))
    votes = led.groupBy("conv_id", "turn", "level", "original").agg(F.sum("size").alias("size"))
    best = F.max(F.struct((-F.col("level")).alias("near"), "size", "original"))["original"]
    return votes.groupBy("conv_id", "turn").agg(best.alias("reply_to"))


def _threads(links: DataFrame) -> DataFrame:
    """``thread`` of every linked message: the turn that its replies lead back to; found by doubling steps."""
    roots = staged(links.withColumn("thread", F.col("reply_to")))
    while True:
        onward = roots.select("conv_id", F.col("turn").alias("thread"), F.col("thread").alias("further"))
        following = staged(roots.join(onward, ["conv_id", "thread"], "left").select(
            "conv_id", "turn", "reply_to", F.coalesce("further", "thread").alias("thread"),
            F.col("further").isNotNull().alias("moved"),
        ))
        roots = following.drop("moved")
        if not following.where("moved").limit(1).count():
            return roots


def conversations(messages: DataFrame) -> DataFrame:
    """Every message without its quotes, with ``reply_to`` and ``thread`` (both turns), as a chat turn.

    ``content`` is the text without quotes, ``formatted`` the same under its role, and (conv_id, thread, turn) the
    reply order; a message that replies to nothing known starts a thread. A NULL text is empty, a NULL role is
    ``unknown``; messages without conversation or turn reply to nothing and have no thread. Rows that repeat a turn
    share its links. No conversation is gathered in one task. Other columns are not read.
    """
    rows = _keyed(messages)
    threads = _threads(reply_links(messages))
    content = without_quotes(F.col("text"))
    role = F.coalesce("role", F.lit("unknown"))
    quotes = F.coalesce(F.regexp_count("text", F.lit(r"(?m)^[ \t]*>")), F.lit(0))
    return rows.join(threads, ["conv_id", "turn"], "left").select(
        "conv_id", F.when(F.col("conv_id").isNotNull(), F.coalesce("thread", "turn")).alias("thread"), "turn", "reply_to",
        role.alias("role"), quotes.cast("long").alias("n_quoted_lines"), content.alias("content"),
        F.concat(F.lit("<|"), role, F.lit("|>\n"), content, F.lit("\n<|end|>\n")).alias("formatted"),
    )
