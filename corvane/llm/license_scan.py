"""Licence notices in texts, by the Dice coefficient over word bigrams.

Each line, each paragraph and the whole text is normalised to lower-case words
and compared to licence templates. Two sets of sizes a and b reach a
coefficient of t only if both a and b are at least t / (2 - t) times the other,
so a template whose size lies outside these bounds is passed over before any
bigram is compared. All work happens inside each row; nothing is shuffled.

A notice inside other words (in a line, wrapped, in a comment block) is found by
windows: as many words as the template has, from each of its bigrams on, wherever
lines end. A window that reaches t holds at least t / (2 - t) of the template's
bigrams, so a text without any of the few words that all such windows need, or
with too few of the bigrams, is passed over before windows are cut.
"""

from __future__ import annotations

import math
import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corvane.llm.tables import id_and_text

MINIMUM = 0.8

# Common notices of licences, and the full text of the shortest ones.
TEMPLATES = [
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file '
                   "except in compliance with the License. You may obtain a copy of the License at "
                   "http://www.apache.org/licenses/LICENSE-2.0"),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", 'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and '
            'associated documentation files (the "Software"), to deal in the Software without restriction, including '
            "without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell "
            "copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the "
            "following conditions:"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
                "General Public License as published by the Free Software Foundation, either version 3 of the "
                "License, or (at your option) any later version."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("AGPL-3.0", "This work is licensed under the GNU Affero General Public License, version 3."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of "
                "the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."),
    ("BSD-2-Clause", "Redistributions in binary form must reproduce the above copyright notice, this list of "
                     "conditions and the following disclaimer in the documentation and/or other materials provided "
                     "with the distribution."),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
            "hereby granted, provided that the above copyright notice and this permission notice appear in all "
            "copies."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC0-1.0", "To the extent possible under law, the author has waived all copyright and related or neighboring "
                "rights to this work."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
    ("Proprietary", "All rights reserved."),
]


def words_of(text: Column) -> Column:
    """Lower-case runs of letters and digits."""
    return F.filter(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), lambda word: word != "")


def bigrams_of(words: Column) -> Column:
    """The distinct pairs of neighbouring words; none for fewer than two words."""
    return F.array_distinct(pairs_of(words))


def pairs_of(words: Column) -> Column:
    """All pairs of neighbouring words, in order."""
    pairs = F.zip_with(
        words, F.slice(words, F.lit(2), F.greatest(F.size(words), F.lit(0))), lambda a, b: F.concat_ws(" ", a, b)
    )
    return F.slice(pairs, F.lit(1), F.greatest(F.size(words) - 1, F.lit(0)))


def template_words(text: str) -> list[str]:
    return re.findall(r"[^\W_]+", text.lower())


def template_bigrams(text: str) -> list[str]:
    words = template_words(text)
    return list(dict.fromkeys(f"{a} {b}" for a, b in zip(words, words[1:], strict=False)))


@dataclass(frozen=True)
class Template:
    """A licence, its distinct bigrams and the bigrams of a window of its length."""

    licence: str
    pairs: list[str]
    length: int

    def needed(self, minimum: float) -> int:
        """How many of the distinct bigrams a window of that coefficient holds at least."""
        return math.ceil(minimum / (2 - minimum) * len(self.pairs) - 1e-9)

    def telling(self, minimum: float) -> set[str]:
        """Words of which every window of that coefficient holds one: it cannot miss as many bigrams as are chosen here.

        Long words are chosen, because they are rare in most texts.
        """
        words = sorted((max(pair.split(" "), key=lambda word: (len(word), word)) for pair in self.pairs), key=len)
        return set(words[self.needed(minimum) - 1:])


def templates_of(texts: list[tuple[str, str]]) -> list[Template]:
    """Templates of two words or more, by licence."""
    found = (Template(name, template_bigrams(text), len(template_words(text)) - 1) for name, text in texts)
    return sorted((each for each in found if each.pairs), key=lambda each: (each.licence, each.pairs))


def notices(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    templates: list[tuple[str, str]] | None = None,
    minimum: float = MINIMUM,
) -> DataFrame:
    """doc_id, ``notices`` and ``windows`` per row.

    ``notices`` holds (licence, dice, part) of every part that matches; ``part``
    counts the parts of a text: its lines from 0 on, then its paragraphs, then
    -1 for the whole. Of several templates the one with the highest coefficient
    counts, of equal ones the first licence by name. ``windows`` holds (licence,
    dice, start, words) of each licence that a window matches, by licence: its
    highest coefficient, of equal ones the first place, then the fewest words;
    ``start`` counts the words of the text from 0 on. Windows end with the text.

    Null and empty texts have no notice; ids may be null; repeated rows are
    compared each; an empty table gives an empty result; other columns of the
    table are left out, whatever their names.
    """
    models = templates_of(templates or TEMPLATES)
    known = [(model.licence, model.pairs) for model in models]
    share = minimum / (2 - minimum)
    smallest = min((len(pairs) for _, pairs in known), default=1)
    largest = max((len(pairs) for _, pairs in known), default=0)
    # Each line is cut into words once; the words of the whole text are those of its lines in order.
    worded = id_and_text(docs, id_col, text_col).select(
        "doc_id",
        F.transform(F.split("text", r"\n"), words_of).alias("lines"),
        F.split("text", r"\n\s*\n").alias("paragraphs"),
    )
    none = F.array().cast("array<struct<words:array<string>,part:int>>")
    parts = F.concat(
        F.transform("lines", lambda words, at: F.struct(words.alias("words"), at.alias("part"))),
        F.when(
            F.size("paragraphs") > 1,
            F.transform(
                "paragraphs",
                lambda part, at: F.struct(words_of(part).alias("words"), (at + F.size("lines")).alias("part")),
            ),
        ).otherwise(none),
        F.when(
            F.size("lines") > 1, F.array(F.struct(F.flatten("lines").alias("words"), F.lit(-1).alias("part")))
        ).otherwise(none),
    )
    # Distinct bigrams are fewer than words.
    fitting = F.filter(parts, lambda part: F.size(part["words"]) > share * smallest)
    sets = F.transform(
        fitting, lambda part: F.struct(bigrams_of(part["words"]).alias("pairs"), part["part"].alias("part"))
    )
    sets = F.filter(
        sets,
        lambda part: (F.size(part["pairs"]) >= share * smallest) & (F.size(part["pairs"]) * share <= largest),
    )
    empty = F.lit(None).cast("struct<dice:double,licence:string>")

    def best(pairs: Column) -> Column:
        scored = [
            F.when(
                (F.size(pairs) * share <= len(own)) & (F.size(pairs) >= share * len(own)),
                F.struct(
                    (
                        2.0
                        * F.size(F.array_intersect(pairs, F.array(*map(F.lit, own))))
                        / (F.size(pairs) + len(own))
                    ).alias("dice"),
                    F.lit(name).alias("licence"),
                ),
            )
            for name, own in known
        ] or [empty]
        return F.reduce(
            F.array(*scored),
            empty,
            lambda kept, other: F.when(
                other.isNotNull() & (kept.isNull() | (other["dice"] > kept["dice"])), other
            ).otherwise(kept),
        )

    scored = F.transform(
        F.col("sets"), lambda part: F.struct(best(part["pairs"]).alias("best"), part["part"].alias("part"))
    )
    kept = F.filter(scored, lambda part: part["best"]["dice"] >= minimum)
    cut = worded.select("doc_id", sets.alias("sets"), F.flatten("lines").alias("words"))
    return _with_windows(cut, models, minimum).select(
        "doc_id",
        F.transform(
            kept,
            lambda part: F.struct(
                part["best"]["licence"].alias("licence"), part["best"]["dice"].alias("dice"), part["part"].alias("part")
            ),
        ).alias("notices"),
        "windows",
    )


def _with_windows(worded: DataFrame, models: list[Template], minimum: float) -> DataFrame:
    """The rows with ``windows``, from their ``words``."""
    result = "array<struct<licence:string,dice:double,start:int,words:int>>"
    if not models:
        return worded.withColumn("windows", F.array().cast(result))
    telling = sorted(set().union(*(model.telling(minimum) for model in models)))
    every = sorted({pair for model in models for pair in model.pairs})
    paired = worded.withColumn(
        "pairs",
        F.when(F.arrays_overlap("words", F.array(*map(F.lit, telling))), pairs_of(F.col("words"))).otherwise(
            F.array().cast("array<string>")
        ),
    ).withColumn("shared", F.array_intersect("pairs", F.array(*map(F.lit, every))))

    def found(model: Template) -> Column:
        own = F.array(*map(F.lit, model.pairs))
        places = F.filter(
            F.transform("pairs", lambda pair, at: F.when(F.array_contains(own, pair), at)), lambda at: at.isNotNull()
        )

        def scored(at: Column) -> Column:
            window = F.array_distinct(F.slice("pairs", at + 1, F.lit(model.length)))
            dice = 2.0 * F.size(F.array_intersect(window, own)) / (F.size(window) + len(model.pairs))
            words = F.least(F.lit(model.length), F.size("pairs") - at) + 1
            return F.struct(dice.alias("dice"), (-at).alias("back"), (-words).alias("fewer"))

        best = F.array_max(F.transform(places, scored))
        return F.when(F.size(F.array_intersect("shared", own)) >= model.needed(minimum), best)

    def of_licence(licence: str) -> Column:
        best = F.array_max(F.array(*(found(model) for model in models if model.licence == licence)))
        return F.struct(F.lit(licence).alias("licence"), best.alias("best"))

    licences = sorted({model.licence for model in models})
    matched = F.filter(F.array(*map(of_licence, licences)), lambda each: each["best"]["dice"] >= minimum)
    return paired.withColumn(
        "windows",
        F.transform(
            matched,
            lambda each: F.struct(
                each["licence"].alias("licence"),
                each["best"]["dice"].alias("dice"),
                (-each["best"]["back"]).alias("start"),
                (-each["best"]["fewer"]).alias("words"),
            ),
        ).cast(result),
    )


def summary(found: DataFrame) -> DataFrame:
    """Per row: doc_id, n_notices and n_windows, the best licence of both (null without one) and its coefficient."""
    matches = F.concat(
        *(F.transform(name, lambda each: F.struct(each["licence"].alias("licence"), each["dice"].alias("dice")))
          for name in ("notices", "windows"))
    )
    best = F.reduce(
        matches,
        F.lit(None).cast("struct<licence:string,dice:double>"),
        lambda kept, other: F.when(
            kept.isNull()
            | (other["dice"] > kept["dice"])
            | ((other["dice"] == kept["dice"]) & (other["licence"] < kept["licence"])),
            other,
        ).otherwise(kept),
    )
    return found.select(
        "doc_id",
        F.size("notices").cast("long").alias("n_notices"),
        F.size("windows").cast("long").alias("n_windows"),
        best.alias("best"),
    ).select("doc_id", "n_notices", "n_windows", F.col("best.licence").alias("licence"), F.round("best.dice", 6).alias("dice"))
