"""Words, hashtags, lengths and any-of matching."""

from __future__ import annotations

import operator
from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def words(text: Column, separator: str = " ") -> Column:
    """Pieces between separators (a regular expression); empty pieces count as words."""
    return F.split(text, separator)


def hashtags(text: Column) -> Column:
    """The blank-separated words that begin with ``#``."""
    return F.filter(words(text), lambda word: word.startswith("#"))


def hashtag_count(text: Column) -> Column:
    """How many words :func:`hashtags` gives.

    Counted as the places where ``#`` follows a blank or the start, which takes
    half the time of building the array.
    """
    padded = F.concat(F.lit(" "), text)
    without = F.replace(padded, F.lit(" #"), F.lit(""))
    return F.shiftright(F.octet_length(padded) - F.octet_length(without), 1)


def has_hashtag(text: Column) -> Column:
    """Whether :func:`hashtags` gives any word."""
    return text.startswith("#") | text.contains(" #")


def character_count(text: Column, split_style: bool = False) -> Column:
    """Characters of a text; null for null.

    ``split_style`` gives what counting the pieces of an empty-pattern split
    gave before Spark 3.4 with ANSI mode off: one more than the length, and
    -1 for null.
    """
    if split_style:
        return F.coalesce(F.char_length(text) + 1, F.lit(-1))
    return F.char_length(text)


def contains_any(text: Column, needles: Iterable[str]) -> Column:
    """True where the text holds at least one of the needles; false for no needles."""
    return reduce(operator.or_, (text.contains(needle) for needle in needles), F.lit(False))


def matches_any(text: Column, names: Iterable[str]) -> Column:
    """True where the text holds one of the names in lower case, read as patterns.

    A match of no characters does not count, so no names match nothing.
    """
    return F.regexp_extract(text, "|".join(name.lower() for name in names), 0) != ""
