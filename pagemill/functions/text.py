"""Text cleaning and word cutting as native column expressions."""

import re
from collections.abc import Callable, Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

from pagemill.constants import (
    ARTICLE_BOILERPLATE,
    BLANK_STEPS,
    HAN_CLASS,
    HTML_STEPS,
    RULER,
    RULER_MARK,
    SQUASHED,
    TAG,
)

# A character that trimming keeps, and two of them in a row but for blanks.
VISIBLE = r"[^\x00-\x20]"
_TWO_VISIBLE = rf"{VISIBLE}[\x00-\x20]*{VISIBLE}"
_EDGE_BLANKS = r"^[\x00-\x20]+|[\x00-\x20]+$"

# ``TAG`` where lines are not joined yet: ``.`` stops at the other line ends only.
_TAG_OVER_LINES = r"<[^>\r\u0085\u2028\u2029]*+>"

_HAN = r"\p{IsHan}"
_OTHER_LETTER = rf"[\p{{L}}&&[^{_HAN}]]"
_WORD_PATTERNS = {
    "letters": r"(\p{L}+)",
    # The lookahead lets bigrams overlap; a lone character stands for itself.
    "han": rf"(?=({_HAN}{{2}}|(?<!{_HAN}){_HAN}(?!{_HAN})))",
    "mixed": (
        rf"(?=({_HAN}{{2}}|(?<!{_HAN}){_HAN}(?!{_HAN})"
        rf"|(?<!{_OTHER_LETTER}){_OTHER_LETTER}++))"
    ),
}


def blank_if_null(c: Column) -> Column:
    return F.coalesce(c, F.lit(""))


def trim_blanks(c: Column) -> Column:
    """Cut every character up to U+0020 at both ends; SQL ``trim`` cuts spaces only."""
    return F.regexp_replace(c, _EDGE_BLANKS, "")


def nonblank(c: Column) -> Column:
    """Not null and longer than one character once trimmed, so with a first and a
    last visible character. The search stops there instead of copying the text."""
    return F.coalesce(c.rlike(_TWO_VISIBLE), F.lit(False))


def nonblank_sql(c: Column) -> Column:
    """As ``nonblank``, but only spaces count as blank."""
    return F.coalesce(F.length(F.trim(c)) > 1, F.lit(False))


def decode_b64(c: Column) -> Column:
    """Base64 text to UTF-8: null for bad base64, U+FFFD for malformed bytes."""
    return F.make_valid_utf8(F.try_to_binary(c, F.lit("base64")).cast("string"))


def keep_script(c: Column, char_class: str) -> Column:
    """Replace each run of characters outside ``char_class`` by one space."""
    return F.regexp_replace(blank_if_null(c), rf"[^{char_class}]+", " ")


def keep_han(c: Column) -> Column:
    return keep_script(c, HAN_CLASS)


def strip_tags(c: Column) -> Column:
    """Light clean-up: trim, join lines, tags to spaces."""
    one_line = F.regexp_replace(trim_blanks(blank_if_null(c)), "\n", " ")
    return F.regexp_replace(one_line, TAG, " ")


def _noise(boilerplate: Sequence[str]) -> str:
    return "|".join([rf"(\Q{p}\E)" for p in boilerplate] + [RULER])


def strip_html(c: Column, boilerplate: Sequence[str] = ARTICLE_BOILERPLATE) -> Column:
    """Full clean-up of an article body."""
    for pattern, replacement in (*HTML_STEPS, (_noise(boilerplate), " "), *BLANK_STEPS):
        c = F.regexp_replace(c, pattern, replacement)
    return blank_if_null(c)


def _where_held(c: Column, parts: Sequence[str], change: Callable[[Column], Column]) -> Column:
    """``change`` of texts that hold one of ``parts``; others stay as they are, found by a plain search."""

    def changed(text: Column) -> Column:
        held = reduce(or_, (F.contains(text, F.lit(part)) for part in parts))
        return F.when(held, change(text)).otherwise(text)

    # A list of one text, so that it is worked out once only.
    return F.get(F.transform(F.array(c), changed), F.lit(0))


def untagged(c: Column) -> Column:
    """As ``strip_tags``, for text that is then cut into words. Blanks at the ends and line ends
    are no part of any word, so they stay; text without a tag is passed over."""
    return _where_held(blank_if_null(c), ["<"], lambda text: F.regexp_replace(text, _TAG_OVER_LINES, " "))


def untagged_html(c: Column, boilerplate: Sequence[str] = ARTICLE_BOILERPLATE) -> Column:
    """As ``strip_html``, for text that is then cut into words. Runs of blanks stay, and so do
    rulers unless a phrase shares their marks, since neither is part of a word; text
    without tags or phrases is passed over."""

    def untag(text: Column) -> Column:
        for pattern, replacement in HTML_STEPS:
            text = F.regexp_replace(text, pattern, replacement)
        return text

    def cut(text: Column) -> Column:
        return F.regexp_replace(text, _noise(boilerplate), " ")

    one_line = F.replace(c, F.lit("\n"), F.lit(" "))
    plain = _where_held(one_line, ["<"], untag)
    if any(re.search(RULER_MARK, phrase) for phrase in boilerplate):
        plain = cut(plain)
    elif boilerplate:
        plain = _where_held(plain, boilerplate, cut)
    return blank_if_null(plain)


def squash(c: Column) -> Column:
    """Remove runs of line ends, tabs, spaces and commas."""
    return F.regexp_replace(blank_if_null(c), SQUASHED, "")


def site_of(c: Column) -> Column:
    """Scheme and host: the first three ``/`` parts, without trailing empty ones."""
    return F.substring_index(F.regexp_replace(blank_if_null(c), "/+$", ""), "/", 3)


def words(c: Column, mode: str = "letters") -> Column:
    """Lower-case words in text order.

    ``letters`` takes runs of letters, ``han`` takes overlapping character pairs
    of Han runs, and ``mixed`` takes pairs from Han runs and whole other runs.
    """
    return F.regexp_extract_all(F.lower(blank_if_null(c)), F.lit(_WORD_PATTERNS[mode]), F.lit(1))


def min_word_len(ws: Column, n: int) -> Column:
    return F.filter(ws, lambda w: F.length(w) >= n)


def drop_listed(ws: Column, listed: Sequence[str]) -> Column:
    """Drop the given words; Spark turns the list into one hash set."""
    return F.filter(ws, lambda w: ~w.isin(*listed)) if listed else ws


def parse_tagged(c: Column) -> Column:
    """``w/c,w/c`` to (word, cls) pairs; cls is null where the tag is missing."""

    def pair(token: Column) -> Column:
        parts = F.split(token, "/")
        return F.struct(F.get(parts, 0).alias("word"), F.get(parts, 1).alias("cls"))

    return F.transform(F.split(c, ","), pair)


def has_class(cls: Column, classes: str) -> Column:
    """Whether the class starts with one of the initials in ``classes``."""
    return F.coalesce(F.substring(cls, 1, 1).isin(*classes), F.lit(False))


def drop_tagged(pairs: Column, classes: str) -> Column:
    """Words of (word, cls) pairs whose class is not listed."""
    kept = F.filter(pairs, lambda p: ~has_class(p["cls"], classes))
    return F.transform(kept, lambda p: p["word"])


def join_words(ws: Column, sep: str = " ") -> Column:
    return F.array_join(ws, sep)
