import random
import re

from corvane.llm import license_scan

TEXTS = [
    None, "", "one", "Released under the MIT License.", "x y z\nreleased UNDER the mit license!\nmore",
    "Licensed under CC BY-NC 4.0.", "Licensed under CC BY 4.0.", "some text. Released under the MIT License. more text",
    "All rights reserved.\n\nLicensed under the Apache License, Version 2.0.",
    "Permission to use, copy, modify, and/or distribute this software for any purpose\nwith or without fee is hereby granted, "
    "provided that the above copyright notice\nand this permission notice appear in all copies.\n\nunrelated words here",
    "word " * 30_000,
    "if you use it: permission to use copy modify and or distribute this software for any\npurpose with or without fee is "
    "hereby granted, provided that the above\ncopyright notice and this permission notice appear in all copies.\n" + " ".join(map(str, range(60))),
    "# This program is free software: you can redistribute it\n#\n# and/or modify it under the terms of the GNU General\n#\n"
    "# Public License as published by the Free Software Foundation,\n *\n * either version 3 of the License, or (at your option)\n"
    " * any later version.\n" + "\n".join(map(str, range(60))),
    "x this work is licensed under the gnu general public license version 2 or see gnu general public license version 3 y",
    "this is free and unencumbered text released into the public domain, all rights are reserved",
    "pad " * 20_000 + "licensed under cc by 4.0 " * 300 + "pad " * 20_000, "licensed under the licensed under the",
]


def expected(text, minimum=0.8):
    text = text or ""
    lines, paragraphs = text.split("\n"), re.split(r"\n\s*\n", text)
    parts = lines + (paragraphs if len(paragraphs) > 1 else []) + ([text] if len(lines) > 1 else [])
    hits = []
    for part in parts:
        own = set(license_scan.template_bigrams(part))
        scores = []
        for name, template in license_scan.TEMPLATES:
            other = set(license_scan.template_bigrams(template))
            dice = 2 * len(own & other) / (len(own) + len(other))
            if dice >= minimum:
                scores.append((-dice, name))
        if scores:
            hits.append(min(scores))
    seen = windows(text, minimum)
    best = min([*hits, *((-dice, name) for name, (dice, _) in seen.items())], default=(None, None))
    return len(hits), len(seen), best[1], None if best[0] is None else round(-best[0], 6)


def windows(text, minimum=0.8):
    """Per licence the best window and its place: every place where a bigram of the template stands is tried."""
    words = license_scan.template_words(text)
    pairs = [f"{a} {b}" for a, b in zip(words, words[1:], strict=False)]
    seen = {}
    for name, template in license_scan.TEMPLATES:
        own, length = set(license_scan.template_bigrams(template)), len(license_scan.template_words(template)) - 1
        for at, pair in enumerate(pairs):
            if pair in own:
                window = set(pairs[at : at + length])
                dice = 2 * len(own & window) / (len(own) + len(window))
                if dice >= minimum and (name not in seen or (-dice, at) < (-seen[name][0], seen[name][1])):
                    seen[name] = (dice, at)
    return seen


def any_window(text, minimum=0.8):
    """Licences of which some window of the template's length reaches the coefficient, wherever it begins."""
    words = license_scan.template_words(text)
    pairs = [f"{a} {b}" for a, b in zip(words, words[1:], strict=False)]
    seen = set()
    for name, template in license_scan.TEMPLATES:
        own, length = set(license_scan.template_bigrams(template)), len(license_scan.template_words(template)) - 1
        for at in range(len(pairs)):
            window = set(pairs[at : at + length])
            if 2 * len(own & window) >= minimum * (len(own) + len(window)):
                seen.add(name)
    return seen


def test_against_plain_comparison(documents):
    rows = license_scan.summary(license_scan.notices(documents(enumerate(TEXTS)))).collect()
    assert {row.doc_id: (row.n_notices, row.n_windows, row.licence, row.dice) for row in rows} == {
        at: expected(text) for at, text in enumerate(TEXTS)
    }
    assert sum(expected(text)[0] > 0 for text in TEXTS) == 6
    assert [rows_of.licence for rows_of in sorted(rows, key=lambda row: row.doc_id)][7] == "MIT"


def test_places_of_windows(documents):
    rows = license_scan.notices(documents(enumerate(TEXTS))).collect()
    assert {row.doc_id: {each.licence: (each.dice, each.start) for each in row.windows} for row in rows} == {
        at: windows(text or "") for at, text in enumerate(TEXTS)
    }
    inside, isc, gpl = (rows[at].windows for at in (7, 11, 12))
    assert [tuple(each) for each in inside] == [("MIT", 1.0, 2, 5)]
    assert [(each.licence, each.start) for each in isc] == [("ISC", 4)]
    assert [(each.licence, each.dice) for each in gpl] == [("GPL-3.0", 1.0)]


def test_notices_with_changed_words_inside_other_words(documents):
    """Windows found are those that plain search over all places finds, whatever words of the notice are changed."""
    chance, texts = random.Random(4), []
    for _ in range(25):
        for _, template in license_scan.TEMPLATES:
            words = [
                word if chance.random() > 0.08 else chance.choice(["", "some other", "thing"])
                for word in template.split()
            ]
            before, after = (" ".join(chance.choices(["we", "under", "license", "of", "the"], k=9)) for _ in "ab")
            texts.append(f"{before}\n{' '.join(words)} {after}")
    rows = license_scan.notices(documents(enumerate(texts))).collect()
    for row in rows:
        assert {each.licence for each in row.windows} == any_window(texts[row.doc_id]), texts[row.doc_id]
    assert sum(bool(row.windows) for row in rows) > 250


def test_ties_own_templates_and_parts(documents):
    templates = [("B", "alpha beta gamma"), ("A", "alpha beta gamma"), ("C", "q")]
    row = license_scan.notices(documents([(1, "zero\nalpha beta gamma")]), templates=templates).first()
    assert [(each.licence, each.dice, each.part) for each in row.notices] == [("A", 1.0, 1), ("A", 0.8, -1)]


def test_empty_table_null_id_and_native_plan(documents, plan_of):
    assert license_scan.notices(documents([])).count() == 0
    frame = license_scan.summary(license_scan.notices(documents([(None, TEXTS[3]), (None, TEXTS[3])])))
    assert [row.licence for row in frame.collect()] == ["MIT", "MIT"]
    assert "Python" not in plan_of(frame)
    assert license_scan.notices(documents([(1, "a b")]), templates=[("X", "q")]).first().notices == []
