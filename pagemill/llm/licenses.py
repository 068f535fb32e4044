"""License scans: phrases of words, and text blocks that contain a notice's words.

A block of a notice is any run of adjacent words of the text, half as long again as the
notice, wherever lines end. Notices are found by an exact set-similarity join: the words of
all notices are ordered by how many texts of the corpus hold them, rarest first; a text can
contain enough of a notice only if it holds one of the first few of its words (prefix), has
notice words enough (length), and enough are left in both orders after the first word they
share (position). What passes is verified block by block. Everything is built from column
functions.
"""

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from math import ceil
from string import ascii_lowercase, ascii_uppercase

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagemill.llm.chars import text_or_empty
from pagemill.sources.scratch import materialize

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
PHRASES = (
    ("cc by", "cc-by"),
    ("general public license", "gpl"),
    ("all rights reserved", "reserved"),
)
CONTAINED = 0.8
# Words of a block for each word of the notice.
ROOM = 1.5
# Opening words of common public license notices, and their labels.
NOTICES = (
    ("Released under the MIT License", "mit"),
    ("Permission is hereby granted free of charge to any person obtaining a copy of this software", "mit"),
    ("Licensed under the Apache License Version 2.0", "apache"),
    ("This work is licensed under the GNU General Public License", "gpl"),
    ("This program is free software you can redistribute it and or modify it", "gpl"),
    ("Redistribution and use in source and binary forms with or without modification are permitted", "bsd"),
    ("This work is licensed under a Creative Commons Attribution License", "cc-by"),
    ("Licensed under CC BY 4.0", "cc-by"),
    ("This Source Code Form is subject to the terms of the Mozilla Public License", "mpl"),
)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is worked out once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def words(text: Column) -> Column:
    lower = F.translate(text, ascii_uppercase, ascii_lowercase)
    return F.regexp_extract_all(lower, F.lit(WORD), F.lit(0))


def places(ws: Column, phrase: Sequence[str]) -> Column:
    """Where the phrase's words stand consecutively, as numbers of its first word."""

    def stands(i: Column) -> Column:
        here = F.get(ws, i) == phrase[0]
        for k, word in enumerate(phrase[1:], 1):
            here = here & (F.get(ws, i + k) == word)
        return here

    last = F.size(ws) - len(phrase)
    held = F.array_contains(ws, phrase[0])
    for word in phrase[1:]:
        held = held & F.array_contains(ws, word)
    none = F.array().cast("array<int>")
    return F.when(held & (last >= 0), F.filter(F.sequence(F.lit(0), F.greatest(last, F.lit(0))), stands)).otherwise(none)


def phrase_places(ws: Column, phrases: Sequence[tuple[str, str]]) -> Column:
    """(label, at) of every place of every phrase."""

    def named(label: str) -> Callable[[Column], Column]:
        return lambda i: F.struct(F.lit(label).alias("label"), i.alias("at"))

    return F.concat(*(F.transform(places(ws, phrase.split()), named(label)) for phrase, label in phrases))


@dataclass(frozen=True)
class Notice:
    """The distinct words of a notice, how many of them a block needs, and of how many words
    a block is."""

    label: str
    words: list[str]
    need: int
    room: int


def notice_sets(notices: Sequence[tuple[str, str]], share: float) -> list[Notice]:
    keep = str.maketrans({c: " " for c in map(chr, range(128)) if not c.isalnum()})
    sets = []
    for text, label in notices:
        ws = text.lower().translate(keep).split()
        distinct = sorted(set(ws))
        sets.append(Notice(label, distinct, ceil(share * len(distinct)), ceil(ROOM * len(ws))))
    return sets


def vocabulary_of(sets: Sequence[Notice]) -> list[str]:
    return sorted({w for notice in sets for w in notice.words})


def notice_hits(ws: Column, sets: Sequence[Notice]) -> tuple[Column, Column]:
    """The distinct notice words among ``ws``, and the places of all of them: the number of a
    word in the text times the size of the vocabulary, plus its number there. Places are null
    where the whole text has not the words of any notice."""
    vocabulary = vocabulary_of(sets)
    if not vocabulary:
        return F.array().cast("array<string>"), F.lit(None).cast("array<bigint>")
    present = F.array_intersect(ws, F.lit(vocabulary))

    def coded(w: Column, i: Column) -> Column:
        number = F.array_position(F.lit(vocabulary), w)
        return F.when(number > 0, i.cast("bigint") * len(vocabulary) + number - 1)

    enough = F.lit(False)
    for notice in sets:
        enough = enough | (F.size(F.array_intersect(present, F.lit(notice.words))) >= notice.need)
    return present, F.when(enough, F.filter(F.transform(ws, coded), lambda c: c.isNotNull()))


def contained_notices(texts: DataFrame, sets: Sequence[Notice]) -> DataFrame:
    """(doc_id, _key, label, contained) of every row of (doc_id, _key, present, hits) and notice
    a block of which holds as many of its distinct words as it needs; ``contained`` is the
    largest share in a block.

    The notices are a parameter; their words, a few hundred at most, are all that
    reaches the driver or is broadcast. Texts are never shuffled.
    """
    vocabulary = vocabulary_of(sets)
    counted = texts.select(F.explode("present").alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("n")).collect()
    often = {r.word: r.n for r in counted}
    order = sorted(vocabulary, key=lambda w: (often.get(w, 0), w))
    rows = []
    for number, notice in enumerate(sets):
        ranked = sorted(notice.words, key=order.index)
        numbers = [vocabulary.index(w) for w in ranked]
        prefix = ranked[: len(ranked) - notice.need + 1]
        rows += [(w, number, notice.label, p, notice.need, notice.room, ranked, numbers) for p, w in enumerate(prefix)]
    schema = "word string, notice int, label string, p int, need int, room int, notice_words array<string>, numbers array<bigint>"
    postings = F.broadcast(texts.sparkSession.createDataFrame(rows, schema))

    least = min(notice.need for notice in sets)
    held = texts.where("hits IS NOT NULL").withColumn("held", F.array_intersect(F.lit(order), F.col("present")))
    met = held.where(F.size("held") >= least).select("*", F.posexplode("held").alias("q", "word")).join(postings, "word")
    first = ~F.arrays_overlap(F.slice("held", F.lit(1), F.col("q")), F.col("notice_words"))
    left = F.least(F.size("notice_words") - F.col("p"), F.size("held") - F.col("q"))
    size, need, room = F.lit(len(vocabulary)), F.col("need"), F.col("room")

    def place(hit: Column) -> Column:
        return F.floor(hit / size)

    def most_held(own: Column) -> Column:
        """Most distinct words of the notice in a block, of those blocks with hits enough."""

        def stands(k: Column) -> Column:
            return place(F.get(own, k + need - 1)) < place(F.get(own, k)) + room

        def words_held(k: Column) -> Column:
            block = F.filter(F.slice(own, k + 1, room), lambda c: place(c) < place(F.get(own, k)) + room)
            return F.size(F.array_distinct(F.transform(block, lambda c: c % size)))

        starts = F.sequence(F.lit(0), F.greatest(F.size(own) - need, F.lit(0)))
        return F.when(F.size(own) >= need, F.array_max(F.transform(F.filter(starts, stands), words_held)))

    own = F.filter("hits", lambda c: F.array_contains(F.col("numbers"), c % size))
    # Exploded, not filtered: a filter would be pushed below and work the blocks out again.
    best = F.explode(F.filter(F.array(let(own, most_held)), lambda n: n >= need)).alias("best")
    found = met.where(first & (left >= need)).select("doc_id", "_key", "label", F.size("numbers").alias("of"), best)
    return found.select("doc_id", "_key", "label", (F.col("best") / F.col("of")).alias("contained"))


def scan(
    docs: DataFrame,
    phrases: Sequence[tuple[str, str]] = PHRASES,
    notices: Sequence[tuple[str, str]] = NOTICES,
    share: float = CONTAINED,
) -> DataFrame:
    """(doc_id, n_words, places array<struct<label, at>>, notices array<string>, score) of
    every row of (doc_id, text).

    ``places`` are the phrases found, ``notices`` the sorted labels of the notices that
    a block contains. The score is 1 with a phrase, else the best share contained, else
    0. Texts are cut into words once. A null or empty text has no words. Rows equal in id and
    text are scanned alike, null ids too; an empty table gives no rows, and without notices
    there are phrases only.
    """
    sets = notice_sets(notices, share)
    text = text_or_empty(F.col("text"))
    none = F.array().cast("array<struct<label:string,at:int>>")

    def read(ws: Column) -> Column:
        present, hits = notice_hits(ws, sets)
        found = F.coalesce(phrase_places(ws, phrases), none)
        return F.struct(F.size(ws).cast("bigint").alias("n_words"), found.alias("places"), present.alias("present"), hits.alias("hits"))

    rows = docs.select("doc_id", F.xxhash64(text).alias("_key"), let(words(text), read).alias("b"))
    rows = materialize(rows.select("doc_id", "_key", "b.*"))
    scanned = rows.select("doc_id", "_key", "n_words", "places")
    labels = F.array().cast("array<string>")
    if not sets:
        scanned = scanned.withColumns({"notices": labels, "best": F.lit(0.0)})
    else:
        found = contained_notices(rows.select("doc_id", "_key", "present", "hits"), sets)
        found = found.groupBy(F.col("doc_id").alias("_id"), F.col("_key").alias("_k")).agg(
            F.array_sort(F.collect_set("label")).alias("notices"), F.max("contained").alias("best")
        )
        same = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("_key") == F.col("_k"))
        scanned = scanned.join(found, same, "left")
    return scanned.select(
        "doc_id",
        "n_words",
        "places",
        F.coalesce("notices", labels).alias("notices"),
        F.when(F.size("places") > 0, 1.0).otherwise(F.coalesce("best", F.lit(0.0))).alias("score"),
    )


def digest(scanned: DataFrame) -> DataFrame:
    """One row of counts and joined labels per document."""
    at = F.transform("places", lambda p: p["at"])
    own = F.transform("places", lambda p: p["label"])

    def joined(labels: Column) -> Column:
        return F.array_join(F.array_sort(F.array_distinct(labels)), ",")

    return scanned.select(
        "doc_id",
        "n_words",
        F.size("places").cast("bigint").alias("n_base"),
        F.array_min(at).cast("bigint").alias("first_word"),
        F.array_max(at).cast("bigint").alias("last_word"),
        joined(own).alias("base_labels"),
        joined(F.concat(own, "notices")).alias("labels"),
        "score",
    )
