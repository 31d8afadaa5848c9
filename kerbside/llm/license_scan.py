"""License detection by ordered signature rules, in DataFrame functions only.

A rule is a regular expression over the words of a text, with a label, a keyword that it cannot match without, a
priority and a weight. Only texts with a keyword are looked at, and of these only the rules whose keyword they hold.
Rules are names of licenses in the turns of phrase that prose uses, and sentences of the licenses. Detections are
intervals of words. Where two start alike the longer comes first, then the one with the higher priority; a detection that
lies inside one before it is suppressed. Base phrases are never suppressed.
"""

from __future__ import annotations

import json
import re

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

# Characters between words, before and after A-Z is lower-cased.
NO_WORD = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

# Base phrases and their labels.
BASE = [
    ("under the mit license", "mit"),
    ("apache license version 2", "apache-2"),
    ("cc by nc", "cc-by-nc"),
]

# Label, keyword, and the license's name as words.
FAMILIES = [
    ("mit", " mit ", "mit"),
    ("x11", " x11 ", "x11"),
    ("isc", " isc ", "isc"),
    ("bsd-2-clause", "bsd ", "(?:simplified bsd|freebsd|bsd 2 clause)"),
    ("bsd-3-clause", " bsd ", "(?:new bsd|modified bsd|revised bsd|bsd 3 clause)"),
    ("bsd-4-clause", " bsd ", "(?:original bsd|bsd 4 clause)"),
    ("0bsd", " 0bsd ", "0bsd"),
    ("apache-1", " apache ", "apache(?: software)?(?: license)?(?: version)? (?:v?1|v?1 [01])"),
    ("apache-2", " apache ", "apache(?: software)?(?: license)?(?: version)? (?:v?2|v?2 0)"),
    ("gpl-1", " gpl", "gpl ?v?1(?: 0)?"),
    ("gpl-2", " gpl", "gpl ?v?2(?: 0)?"),
    ("gpl-3", " gpl", "gpl ?v?3(?: 0)?"),
    ("gpl-2", " gnu ", "gnu general public license(?: as published by the free software foundation)?(?: either)? version 2"),
    ("gpl-3", " gnu ", "gnu general public license(?: as published by the free software foundation)?(?: either)? version 3"),
    ("lgpl-2.1", " lgpl", "lgpl ?v?2(?: [01])?"),
    ("lgpl-3", " lgpl", "lgpl ?v?3(?: 0)?"),
    ("lgpl-2.1", " gnu ", "gnu (?:lesser|library) general public license(?: version)? 2(?: [01])?"),
    ("lgpl-3", " gnu ", "gnu lesser general public license(?: version)? 3"),
    ("agpl-3", " agpl", "agpl ?v?3(?: 0)?"),
    ("agpl-3", " gnu ", "gnu affero general public license(?: version)?(?: 3)?"),
    ("mpl-1.1", " mozilla ", "mozilla public license(?: version)? 1(?: [01])?"),
    ("mpl-2", " mozilla ", "mozilla public license(?: version)? 2(?: 0)?"),
    ("mpl-2", " mpl", "mpl ?v?2(?: 0)?"),
    ("epl-1", " eclipse ", "eclipse public license(?: version)? 1(?: 0)?"),
    ("epl-2", " eclipse ", "eclipse public license(?: version)? 2(?: 0)?"),
    ("cddl-1", " cddl", "cddl(?: 1(?: [01])?)?"),
    ("eupl-1.2", " european ", "european union public licence(?: v?1 2)?"),
    ("eupl-1.2", " eupl", "eupl(?: v?1 2)?"),
    ("cc0-1", " cc0 ", "cc0(?: 1 0)?"),
    ("cc-by", " cc ", "cc by(?: [1-4] [05])?"),
    ("cc-by-sa", " cc ", "cc by sa(?: [1-4] [05])?"),
    ("cc-by-nd", " cc ", "cc by nd(?: [1-4] [05])?"),
    ("cc-by-nc", " cc ", "cc by nc(?: [1-4] [05])?"),
    ("cc-by-nc-sa", " cc ", "cc by nc sa(?: [1-4] [05])?"),
    ("cc-by-nc-nd", " cc ", "cc by nc nd(?: [1-4] [05])?"),
    ("cc-by", " commons ", "creative commons attribution(?: [1-4] [05])?"),
    ("cc-by-sa", " commons ", "creative commons attribution share ?alike(?: [1-4] [05])?"),
    ("cc-by-nc", " commons ", "creative commons attribution non ?commercial(?: [1-4] [05])?"),
    ("cc-by-nd", " commons ", "creative commons attribution no ?deriv(?:ative)?s(?: [1-4] [05])?"),
    ("unlicense", " unlicense ", "unlicense"),
    ("wtfpl", " wtfpl ", "wtfpl"),
    ("zlib", " zlib ", "zlib(?: libpng)?"),
    ("boost-1", " boost ", "boost software(?: license)?(?: version)?(?: 1 0)?"),
    ("artistic-2", " artistic ", "artistic(?: license)? 2(?: 0)?"),
    ("python-2", " python ", "python software foundation"),
    ("ofl-1.1", " font ", "(?:sil )?open font license(?: 1 1)?"),
    ("ofl-1.1", " ofl ", "(?:sil )?ofl(?: 1 1)?"),
    ("odbl-1", " database ", "open database license(?: 1 0)?"),
    ("odbl-1", " odbl ", "odbl(?: 1 0)?"),
    ("postgresql", " postgresql ", "postgresql"),
    ("ms-pl", " microsoft ", "microsoft public"),
]

# How a license is named in prose; weight, best first. ``{}`` is the name.
TEMPLATES = [
    (1.0, "licen[sc]ed (?:to you )?under (?:the )?(?:terms of (?:the )?)?{}(?: licen[sc]e)?"),
    (1.0, "spdx licen[sc]e identifier {}(?: only| or later)?"),
    (0.95, "(?:released|distributed|available|published|provided) under (?:the |an? )?{}(?: licen[sc]e)?"),
    (0.9, "under (?:the |an? )?{} licen[sc]e"),
    (0.9, "(?:subject to|terms of) (?:the )?{}(?: licen[sc]e)?"),
    (0.8, "{} licen[sc]e"),
    (0.8, "licen[sc]e {}"),
]
# Signatures other than names in prose: label, keyword, weight, words.
STATEMENTS = [
    ("public-domain", " domain ", 0.9, "(?:released|dedicated|placed) (?:in|in to|into|to) the public domain"),
    ("public-domain", " domain ", 0.6, "public domain"),
    ("all-rights-reserved", " rights ", 0.7, "all rights reserved"),
    ("copyleft", " copyleft ", 0.5, "copyleft"),
    ("generic-license", " license ", 0.5, "see (?:the )?license(?: file)?(?: for details)?"),
    ("generic-license", " licensed ", 0.4, "licensed under (?:the )?(?:following )?(?:terms|license)"),
    # Sentences of the licenses themselves.
    ("mit", " hereby ", 0.9, "permission is hereby granted free of charge to any person obtaining a copy of this software"),
    ("mit", " noninfringement ", 0.6, "warranties of merchantability fitness for a particular purpose and noninfringement"),
    ("x11", " consortium ", 0.9, "except as contained in this notice the name of the x consortium shall not be used"),
    ("isc", " hereby ", 0.9, "permission to use copy modify and(?: or)? distribute this software for any purpose with or without fee is hereby granted"),
    ("bsd-2-clause", " redistributions ", 0.7, "redistributions in binary form must reproduce the above copyright notice"),
    ("bsd-2-clause", " redistribution ", 0.7, "redistribution and use in source and binary forms with or without modification are permitted"),
    ("bsd-3-clause", " neither ", 0.9, "neither the names? of .{1,80}? nor the names of its contributors may be used to endorse or promote products"),
    ("bsd-4-clause", " advertising ", 0.9, "all advertising materials mentioning features or use of this software must display the following acknowledge?ment"),
    ("apache-2", " apache ", 0.9, "www apache org licenses license 2 0"),
    ("apache-2", " governing ", 0.6, "see the license for the specific language governing permissions and limitations under the license"),
    ("gpl-2", " redistribute ", 0.9, "you can redistribute it and or modify it under the terms of the gnu general public license(?: as published by the free software foundation)? either version 2"),
    ("gpl-3", " redistribute ", 0.9, "you can redistribute it and or modify it under the terms of the gnu general public license(?: as published by the free software foundation)? either version 3"),
    ("lgpl-2.1", " redistribute ", 0.9, "you can redistribute it and or modify it under the terms of the gnu lesser general public license(?: as published by the free software foundation)? either version 2"),
    ("agpl-3", " redistribute ", 0.9, "you can redistribute it and or modify it under the terms of the gnu affero general public license"),
    ("copyleft", " merchantability ", 0.4, "without even the implied warranty of merchantability or fitness for a particular purpose"),
    ("mpl-2", " mozilla ", 1.0, "this source code form is subject to the terms of the mozilla public license"),
    ("zlib", " misrepresented ", 0.9, "the origin of this software must not be misrepresented"),
    ("unlicense", " unencumbered ", 1.0, "this is free and unencumbered software released into the public domain"),
    ("cc0-1", " waived ", 0.8, "has waived all copyright and related or neighboring rights"),
    ("boost-1", " boost ", 0.9, "distributed under the boost software license version 1 0"),
    ("no-warranty", " warranty ", 0.3, "provided as is without warranty of any kind"),
]


def rules() -> list[tuple[str, str, str, float, int, bool]]:
    """(label, keyword, expression, weight, priority, base) of all rules, best priority first."""
    key_of = {label: key for label, key, _ in reversed(FAMILIES)}
    found = [(label, key_of[label], words, 1.0, True) for words, label in BASE]
    found += [(label, key, t.format(name), w, False) for w, t in TEMPLATES for label, key, name in FAMILIES]
    found += [(label, key, name, 0.7, False) for label, key, name in FAMILIES if label.startswith("cc")]
    found += [(label, key, words, w, False) for label, key, w, words in STATEMENTS]
    return [(label, key, rf"(?<= )(?:{e})(?= )", w, p, base) for p, (label, key, e, w, base) in enumerate(found)]


def _rules_frame(spark: SparkSession) -> DataFrame:
    names = ("label", "keyword", "expression", "weight", "priority", "base")
    listed = F.lit(json.dumps([dict(zip(names, rule)) for rule in rules()]))
    kind = "array<struct<label: string, keyword: string, expression: string, weight: double, priority: int, base: boolean>>"
    return spark.range(1).select(F.explode(F.from_json(listed, kind)).alias("rule")).select("rule.*")


def _keywords() -> list[str]:
    return sorted({rule[1] for rule in rules()})


def gate(text: Column) -> Column:
    """True of every text whose ``spaced_words`` hold the keyword of any rule, and of some others.

    Keywords are sought without their word ends, which is a plain search for bytes; a keyword that holds another one
    needs no search of its own.
    """
    bare = {key.strip() for key in _keywords()}
    least = sorted(key for key in bare if not any(other != key and other in key for other in bare))
    found = F.contains(text, F.lit(least[0]))
    for key in least[1:]:
        found = found | F.contains(text, F.lit(key))
    return found


def spaced_words(text: Column) -> Column:
    """The words with A-Z lower-cased, one space before, between and after them."""
    plain = F.regexp_replace(F.translate(text, UPPER, LOWER), F.lit(NO_WORD), F.lit(" "))
    return F.concat(F.lit(" "), F.trim(plain), F.lit(" "))


def detections(documents: DataFrame) -> DataFrame:
    """Every place where a rule matches: (row_id, label, weight, priority, base, first, last), words from 0.

    ``row_id`` is a hash of ``doc_id`` and ``text``; rows that repeat a document are looked at once.
    """
    def once(value: Column) -> Column:
        """Generated, not projected: computed once a row however often it is used."""
        return F.explode(F.array(value))

    lowered = _rows(documents).select("row_id", "text", once(F.lower("text")).alias("lowered")).where(gate(F.col("lowered")))
    spaced = lowered.select("row_id", once(spaced_words(F.col("text"))).alias("words"))
    keywords = F.array(*[F.lit(k) for k in _keywords()])
    holds = F.filter(keywords, lambda k: F.contains(F.col("words"), k))
    gated = spaced.select("row_id", "words", holds.alias("keywords")).where(F.size("keywords") > 0)
    held = gated.dropDuplicates(["row_id"]).withColumn("keyword", F.explode("keywords")).drop("keywords")
    # The rules are a fixed table of some hundred rows.
    paired = held.join(F.broadcast(_rules_frame(documents.sparkSession)), "keyword").where(
        F.expr("words rlike expression")
    )
    marked = F.split(F.trim(F.expr("regexp_replace(words, expression, '\u0001$0\u0002')")), " ")
    places = paired.withColumn("marked", marked).select(
        "row_id", "label", "weight", "priority", "base",
        F.expr("filter(transform(marked, (w, i) -> if(startswith(w, '\u0001'), i, null)), x -> x is not null)").alias("firsts"),
        F.expr("filter(transform(marked, (w, i) -> if(endswith(w, '\u0002'), i, null)), x -> x is not null)").alias("lasts"),
    )
    return places.withColumn("place", F.explode(F.arrays_zip("firsts", "lasts"))).select(
        "row_id", "label", "weight", "priority", "base",
        F.col("place.firsts").alias("first"), F.col("place.lasts").alias("last"),
    )


def unsuppressed(found: DataFrame) -> DataFrame:
    """Detections without those inside one that comes before them; base detections all stay."""
    order = Window.partitionBy("row_id").orderBy("first", F.desc("last"), "priority")
    reach = F.max("last").over(order.rowsBetween(Window.unboundedPreceding, -1))
    return found.withColumn("reach", reach).where(
        F.col("base") | F.col("reach").isNull() | (F.col("last") > F.col("reach"))
    ).drop("reach")


def _rows(documents: DataFrame) -> DataFrame:
    columns = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return columns.withColumn("row_id", F.xxhash64("doc_id", "text"))


def scan_licenses(documents: DataFrame) -> DataFrame:
    """Per row of ``documents``: words, base places with the first and last of them, labels and a score.

    The score is that of the best detection, 1 for a base phrase and 0 without any. A NULL text is empty: no words,
    no labels (empty strings), NULL first and last word. Rows without ``doc_id`` and repeated rows get a row each;
    other columns are not read.
    """
    def joined(labels: Column) -> Column:
        return F.array_join(F.array_sort(labels), ",")

    is_base = F.col("base")
    per_row = unsuppressed(detections(documents)).groupBy("row_id").agg(
        F.count_if(is_base).alias("n_base"),
        F.min(F.when(is_base, F.col("first"))).cast("long").alias("first_word"),
        F.max(F.when(is_base, F.col("first"))).cast("long").alias("last_word"),
        joined(F.collect_set(F.when(is_base, F.col("label")))).alias("base_labels"),
        joined(F.collect_set("label")).alias("labels"),
        F.max("weight").alias("score"),
    )
    counted = _rows(documents).select(
        "doc_id", "row_id", F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long").alias("n_words")
    )
    return counted.join(per_row, "row_id", "left").select(
        "doc_id", "n_words", F.coalesce("n_base", F.lit(0)).cast("long").alias("n_base"), "first_word", "last_word",
        F.coalesce("base_labels", F.lit("")).alias("base_labels"), F.coalesce("labels", F.lit("")).alias("labels"),
        F.coalesce("score", F.lit(0.0)).alias("score"),
    )
