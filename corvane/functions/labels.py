"""Codes and numbers turned into labels."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# The labels and closed ranges published analyses use.
POST_TYPES = {1: "photo", 2: "video", 3: "multy"}
COUNTRY_NAMES = {"US": "United States"}
FOLLOWER_RANGES = [
    (0, 1000, "0_to_1k_followers"),
    (1001, 10000, "1k_to_10k_followers"),
    (10001, 100000, "10k_to_100k_followers"),
    (100001, 1000000, "100k_to_1m_followers"),
    (1000001, None, "more_than_1m_followers"),
]
CHARACTER_RANGES = [
    (0, 50, "0_to_50_characters"),
    (51, 100, "50_to_100_characters"),
    (101, 150, "100_to_150_characters"),
    (151, 200, "150_to_200_characters"),
    (201, 250, "200_to_250_characters"),
    (251, 300, "250_to_300_characters"),
    (301, None, "more_than_300_characters"),
]
HASHTAG_RANGES = [
    (0, 10, "0_to_10_hashtags"),
    (11, 20, "10_to_20_hashtags"),
    (21, 30, "20_to_30_hashtags"),
    (31, 40, "30_to_40_hashtags"),
    (41, 50, "40_to_50_hashtags"),
    (51, None, "more_than_50_hashtags"),
]


def _first_case(cases: Iterable[tuple[Column, Column]]) -> Column:
    first, *others = cases
    chain = F.when(*first)
    for condition, value in others:
        chain = chain.when(condition, value)
    return chain


def code_label(code: Column, labels: Mapping, otherwise: Column | None = None) -> Column:
    """The label of a code; an unlisted code gives ``otherwise`` (null by default)."""
    chain = _first_case((code == F.lit(key), F.lit(label)) for key, label in labels.items())
    return chain if otherwise is None else chain.otherwise(otherwise)


def range_label(value: Column, ranges: Sequence[tuple[int, int | None, str]]) -> Column:
    """The label of the closed range a whole number falls in; an upper end of None is open."""
    return _first_case(
        (value >= F.lit(low) if high is None else value.between(low, high), F.lit(label))
        for low, high, label in ranges
    )


def post_type_label(code: Column) -> Column:
    return code_label(code, POST_TYPES)


def country_label(code: Column) -> Column:
    return code_label(code, COUNTRY_NAMES, otherwise=code)
