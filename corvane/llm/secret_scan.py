"""Secrets in texts: three fixed patterns, and strings a Markov model finds random.

The model compares two first-order character chains, one of random strings and
one of ordinary identifiers, by the mean log-likelihood ratio of a string's
transitions. Both are trained by counting labelled samples. All work is done by
SQL functions; only the table of transitions, whose size is that of the
alphabet squared, passes the driver.
"""

from __future__ import annotations

import json
import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corvane.llm.tables import id_and_text

# The patterns of the base kinds, in the order in which kinds are listed.
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ASSIGN_LENGTH = 12
ACCESS = r"AKIA[A-Z0-9]{14,}"  # AKIA[A-Z0-9]+ of 18 or more: a run's later starts are shorter still
HEX = r"[0-9a-f]{16,}"  # [0-9a-f]+ of 16 or more
KINDS = ("assign", "access", "hex", "markov")

CANDIDATE = r"[A-Za-z0-9+/_=-]{16,}"
IDENTIFIER = r"[A-Za-z0-9+/_=-]{4,}"
CODES = 128
TRAINING_DOCUMENTS = 4000
DIGESTS = 4
THRESHOLD = 1.5

_MATCH = "struct<start:bigint,stop:bigint,value:string>"
_MATCHES = f"array<{_MATCH}>"


def _bound(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often the body uses it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def running(numbers: Column, combine: Callable[[Column, Column], Column], levels: int = 3) -> Column:
    """For each of some numbers, the combination of all up to it: running sums or maxima.

    Appending to an array copies it, so the array is folded in pieces of a
    length that is the root of its own, and so are the totals of the pieces.
    """
    zero = F.lit(0).cast("long")

    def folded(part: Column, first: Column) -> Column:
        grown = F.aggregate(
            part, F.array(first), lambda done, number: F.concat(done, F.array(combine(F.element_at(done, -1), number)))
        )
        return F.slice(grown, F.lit(2), F.size(part))

    def whole(values: Column) -> Column:
        length = F.greatest(F.size(values), F.lit(1))
        step = F.ceil(F.pow(length, F.lit(1 / levels))).cast("int")
        starts = F.sequence(F.lit(1), length, step)
        return _bound(F.transform(starts, lambda at: F.slice(values, at, step)), carried)

    def carried(parts: Column) -> Column:
        totals = F.transform(parts, lambda part: F.aggregate(part, zero, combine))
        before = F.concat(F.array(zero), running(totals, combine, levels - 1))
        return F.flatten(F.zip_with(parts, F.slice(before, F.lit(1), F.size(parts)), folded))

    return _bound(numbers, whole) if levels > 1 else folded(numbers, zero)


def located(text: Column, pattern: str) -> Column:
    """Leftmost, non-overlapping matches with their code point offsets, end exclusive."""

    def placed(values: Column) -> Column:
        gaps = F.slice(F.split(text, pattern, -1), F.lit(1), F.size(values))
        steps = F.zip_with(values, gaps, lambda value, gap: (F.length(gap) + F.length(value)).cast("long"))
        return F.zip_with(
            values,
            running(steps, lambda done, step: done + step),
            lambda value, stop: F.struct((stop - F.length(value)).alias("start"), stop.alias("stop"), value.alias("value")),
        )

    found = _bound(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), placed)
    return F.when(text.rlike(pattern), found).otherwise(F.array().cast(_MATCHES))


def apart(matches: Column, taken: Column) -> Column:
    """Those of some matches, in order and none overlapping another, that overlap none of ``taken``.

    Walks through the starts of ``taken`` and the ends of the matches in their
    order: a match is free when nothing that began before its end goes beyond
    its start.
    """

    def event(match: Column, taking: bool) -> Column:
        value = F.lit(None).cast("string") if taking else match["value"]
        return F.struct(
            (match["start"] if taking else match["stop"]).alias("at"),
            F.lit(taking).alias("taking"),  # at one place, ends of matches come first
            match["start"].alias("start"),
            match["stop"].alias("stop"),
            value.alias("value"),
        )

    def freed(events: Column) -> Column:
        ends = F.transform(events, lambda each: F.when(each["taking"], each["stop"]).otherwise(F.lit(0).cast("long")))
        reached = F.zip_with(
            events,
            running(ends, lambda done, end: F.greatest(done, end)),
            lambda each, reach: F.struct(
                (~each["taking"] & (reach <= each["start"])).alias("free"),
                F.struct(each["start"], each["stop"], each["value"]).cast(_MATCH).alias("match"),
            ),
        )
        return F.transform(F.filter(reached, lambda each: each["free"]), lambda each: each["match"])

    def merged(known: Column) -> Column:
        events = F.concat(
            F.transform(known, lambda match: event(match, False)), F.transform(taken, lambda match: event(match, True))
        )
        return F.when(F.size(known) == 0, known).otherwise(_bound(F.array_sort(events), freed))

    return _bound(matches, merged)


def base_matches(texts: DataFrame) -> DataFrame:
    """Adds the arrays ``assign``, ``access`` and ``hex`` to (doc_id, text)."""
    long_enough = lambda match: F.length(F.regexp_extract(match["value"], ASSIGN, 2)) >= ASSIGN_LENGTH
    return texts.select(
        "doc_id",
        "text",
        F.filter(located(F.col("text"), ASSIGN), long_enough).alias("assign"),
        located(F.col("text"), ACCESS).alias("access"),
        located(F.col("text"), HEX).alias("hex"),
    )


def labelled_samples(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                     documents: int = TRAINING_DOCUMENTS) -> DataFrame:
    """(sample, random) from about ``documents`` rows, chosen by a hash of their ids.

    Ordinary identifiers are the words outside base matches. Random strings are
    the values of base matches and, for every row, ``DIGESTS`` digests of its
    id, written as hexadecimal, as base64 and as its upper-case part.
    """
    texts = id_and_text(docs, id_col, text_col)
    every = max(1, texts.count() // documents)
    hashed = F.xxhash64(F.col("doc_id").cast("string"))
    chosen = texts.filter(F.pmod(hashed, F.lit(every)) == 0)
    rest = F.col("text")
    for pattern in (ASSIGN, ACCESS, HEX):
        rest = F.regexp_replace(rest, pattern, " ")
    ordinary = chosen.select(F.explode(F.regexp_extract_all(rest, F.lit(IDENTIFIER), F.lit(0))).alias("sample"))
    digests = [
        F.sha2(F.concat_ws(":", F.lit(at), F.col("doc_id").cast("string")), 256) for at in range(DIGESTS)
    ]
    shown = [F.base64(F.unhex(digest)) for digest in digests]
    upper = F.regexp_replace(F.concat(*shown), "[a-z+/=]", "")
    values = F.concat(
        F.array(digests[0], *shown, upper),
        F.regexp_extract_all("text", F.lit(ASSIGN), F.lit(2)),
        F.regexp_extract_all("text", F.lit(ACCESS), F.lit(0)),
        F.regexp_extract_all("text", F.lit(HEX), F.lit(0)),
    )
    made = chosen.select(F.explode(values).alias("sample")).filter("length(sample) >= 12")
    return ordinary.withColumn("random", F.lit(False)).unionByName(made.withColumn("random", F.lit(True)))


def _characters(value: Column) -> Column:
    return F.split(value, "")


def _neighbours(values: Column) -> tuple[Column, Column]:
    """The array without its last, and without its first element."""
    fewer = F.greatest(F.size(values) - 1, F.lit(0))
    return F.slice(values, F.lit(1), fewer), F.slice(values, F.lit(2), fewer)


def train(samples: DataFrame, smoothing: float = 2.0) -> list[float]:
    """Log-likelihood ratio of each transition, at index first * 128 + second.

    A chain that has seen little of a character falls back on how often the
    second one occurs at all, with the weight of ``smoothing`` transitions.
    Characters outside ASCII are left out; without samples every ratio is 0.
    """
    pairs = _bound(
        _characters(F.col("sample")), lambda each: F.zip_with(*_neighbours(each), lambda one, two: F.concat(one, two))
    )
    counted = (
        samples.filter("length(sample) >= 2")
        .select("random", F.explode(pairs).alias("pair"))
        .filter(F.col("pair").rlike("^[\\x00-\\x7F]{2}$"))
        .groupBy("random", "pair")
        .count()
    )
    counts = {True: {}, False: {}}
    for row in counted.toLocalIterator():  # at most 2 * 128 * 128 rows
        counts[row["random"]][row["pair"]] = row["count"]
    alphabet = sorted({character for pairs in counts.values() for pair in pairs for character in pair})
    ratios = [0.0] * (CODES * CODES)
    share = {}
    for kind, pairs in counts.items():
        total = sum(pairs.values()) + 0.5 * len(alphabet)
        held = {second: sum(pairs.get(first + second, 0) for first in alphabet) for second in alphabet}
        share[kind] = {second: (held[second] + 0.5) / total for second in alphabet}
    for first in alphabet:
        totals = {kind: sum(counts[kind].get(first + second, 0) for second in alphabet) for kind in counts}
        for second in alphabet:
            likely = {
                kind: (counts[kind].get(first + second, 0) + smoothing * share[kind][second])
                / (totals[kind] + smoothing)
                for kind in counts
            }
            ratios[ord(first) * CODES + ord(second)] = round(math.log(likely[True] / likely[False]), 4)
    return ratios


def randomness(value: Column, ratios: list[float]) -> Column:
    """Mean log-likelihood ratio of the transitions of an ASCII string."""
    table = F.from_json(F.lit(json.dumps(ratios)), "array<double>")
    steps = _bound(
        F.transform(_characters(value), F.ascii),
        lambda codes: F.zip_with(*_neighbours(codes), lambda one, two: F.get(table, one * CODES + two)),
    )
    return F.aggregate(steps, F.lit(0.0), lambda total, step: total + F.coalesce(step, F.lit(0.0))) / F.greatest(
        F.length(value) - 1, F.lit(1)
    )


def scan(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    ratios: list[float] | None = None,
    threshold: float = THRESHOLD,
) -> DataFrame:
    """doc_id and the match arrays ``assign``, ``access``, ``hex`` and ``markov`` per row.

    A match is (start, stop, value). The base kinds follow their patterns; the
    model adds strings of 16 or more characters that overlap no base match and
    whose mean ratio exceeds ``threshold``. ``ratios`` defaults to a model
    trained on samples of ``docs``. Null and empty texts have no match; ids may
    be null; repeated rows are scanned each; an empty table gives an empty
    result.
    """
    if ratios is None:
        ratios = train(labelled_samples(docs, id_col, text_col))
    base = base_matches(id_and_text(docs, id_col, text_col))
    free = apart(located(F.col("text"), CANDIDATE), F.concat("assign", "access", "hex"))
    new = F.filter(free, lambda match: randomness(match["value"], ratios) > threshold)
    return base.select("doc_id", "assign", "access", "hex", new.alias("markov"))


def span_text(*kinds: str) -> Column:
    """kind:start:stop of all matches, by start and then by kind, comma-joined."""
    def shown(kind: str) -> Column:
        return F.transform(
            kind,
            lambda match: F.struct(
                match["start"].alias("start"),
                F.lit(KINDS.index(kind)).alias("rank"),
                F.concat_ws(":", F.lit(kind), match["start"], match["stop"]).alias("shown"),
            ),
        )

    rows = F.concat(*map(shown, kinds))
    return F.array_join(F.transform(F.array_sort(rows), lambda row: row["shown"]), ",")
