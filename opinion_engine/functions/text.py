"""Text expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The patterns that the results depend on.
WHITESPACE_RUN = r"\s+"
LINE_BREAK_RUN = r"[\r\n]+"
DIGITS_AND_SPACE_ONLY = r"^[0-9\s]+$"
NON_LETTERS = r"[^\p{L}]+"
# Uploads are named after their time, as in 20240131235959_reviews.csv.
STAMP = r"^(\d{14})"
STAMP_FORMAT = "yyyyMMddHHmmss"
SHORT_WORDS = 5
SHORT_CHARS = 30

# Unicode white space, and the four information separators that count as white space between words.
_SPACE = r"[\s\x1c-\x1f]"
_WORD = r"[^\s\x1c-\x1f]"


def normalize_text(text: Column) -> Column:
    """Lower case, strip spaces at both ends, then turn each white-space run into one space."""
    return F.regexp_replace(F.trim(F.lower(text)), WHITESPACE_RUN, " ")


def clean_review(text: Column) -> Column:
    """Strip spaces at both ends and lower-case; inner white space stays."""
    return F.lower(F.trim(text))


def strip_line_breaks(text: Column) -> Column:
    return F.regexp_replace(text, LINE_BREAK_RUN, " ")


def text_length(text: Column) -> Column:
    """Length in code points."""
    return F.char_length(text)


def is_digits_only(text: Column) -> Column:
    return text.rlike(DIGITS_AND_SPACE_ONLY)


def has_words(text: Column, n: int) -> Column:
    """Whether the text has at least ``n`` words.

    The pattern is anchored and possessive, so it stops at the n-th word and never backtracks.
    """
    return text.rlike(rf"(?U)^{_SPACE}*+(?:{_WORD}++{_SPACE}++){{{n - 1}}}{_WORD}")


def is_short(text: Column) -> Column:
    """Fewer than five words or fewer than thirty characters; a missing text is short."""
    short = (text_length(text) < SHORT_CHARS) | ~has_words(text, SHORT_WORDS)
    return F.coalesce(short, F.lit(True))


def tokens(text: Column) -> Column:
    """The distinct words (runs of letters of any script, in lower case) of a text."""
    return F.array_remove(F.array_distinct(F.split(F.lower(text), NON_LETTERS)), "")


def text_digest(text: Column) -> Column:
    """16 bytes that stand for a text as a grouping, join or shuffle key."""
    return F.substring(F.unhex(F.sha2(text, 256)), 1, 16)


def upload_time(file_name: Column) -> Column:
    """The time that an upload's file name begins with; null where it begins with none."""
    return F.try_to_timestamp(F.regexp_extract(file_name, STAMP, 1), F.lit(STAMP_FORMAT))
