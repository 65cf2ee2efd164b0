"""Tokenisers. The jobs differ on purpose in alphabet, punctuation and minimum length, so each has its own rule."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# What separates words under each rule.
UNICODE_GAP = r"[^\p{L}\p{N}_]+"
ASCII_PUNCTUATION = r"[^\w\s]"
SPACE_GAP = r"\s+"
DELIMITER_GAP = r'[ ",()*]+'


def words_unicode(text: Column) -> Column:
    """Lower-cased runs of letters, digits and underscore of any script; may hold an empty string at either end."""
    return F.split(F.lower(text), UNICODE_GAP)


def strip_punctuation(text: Column) -> Column:
    return F.regexp_replace(text, ASCII_PUNCTUATION, "")


def words_stripped(text: Column) -> Column:
    """Punctuation removed first (``don't`` becomes ``dont``), then split on white space."""
    return F.split(strip_punctuation(F.lower(text)), SPACE_GAP)


def lines(text: Column) -> Column:
    return F.split(text, r"\r?\n")


def words_delimited(line: Column) -> Column:
    return F.split(F.lower(line), DELIMITER_GAP)
