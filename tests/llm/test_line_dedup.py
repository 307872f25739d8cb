import random

import numpy as np

from corvane.llm import line_dedup
from corvane.llm.shingles import gram_hashes
from corvane.llm.tables import id_and_text
from test_near_dedup import roots

WIDTH, PERCENT = line_dedup.CHARACTERS, 80


def shingles(line):
    return {line[at : at + WIDTH] for at in range(len(line) - WIDTH + 1)} or ({line} if line else set())


def brute_force(pairs):
    lines = [(doc, at, line_dedup.normalised(line)) for doc, text in pairs for at, line in enumerate((text or "").split("\n"))]
    distinct = sorted({line for *_, line in lines if line})
    sets = {line: shingles(line) for line in distinct}
    links = [
        (a, b)
        for at, a in enumerate(distinct)
        for b in distinct[at + 1 :]
        if 100 * len(sets[a] & sets[b]) >= PERCENT * len(sets[a] | sets[b])
    ]
    found = roots(distinct, links)
    first = {}
    for doc, at, line in sorted(lines, key=lambda each: (each[0] is None, each[0] or 0, each[1])):
        if line:
            first.setdefault(found[line], (doc, at))
    return {(doc, at): not line or first[found[line]] == (doc, at) for doc, at, line in lines}


def edited(draw, line):
    letters = list(line)
    for _ in range(draw.choice([0, 0, 1, 1, 2, 3])):
        letters[draw.randrange(len(letters))] = draw.choice("abcdefghij ")
    return "".join(letters)


def test_against_all_pairs(documents):
    draw = random.Random(4)
    words = ["".join(draw.choice("abcdefghijklmnop") for _ in range(draw.randrange(3, 9))) for _ in range(300)]
    bases = [" ".join(draw.choice(words) for _ in range(draw.randrange(2, 25))) for _ in range(40)]
    pairs = [
        (doc, "\n".join(edited(draw, draw.choice(bases)) if draw.random() < 0.8 else "" for _ in range(8)))
        for doc in range(60)
    ]
    rows = line_dedup.near_lines(documents(pairs)).collect()
    found = {(row.doc_id, row.line_no): row.kept for row in rows}
    expected = brute_force(pairs)
    assert found.keys() == expected.keys()
    assert sum(found[key] != expected[key] for key in expected) <= 0.005 * len(expected)


def test_cases(documents):
    pairs = [(1, None), (2, ""), (3, "One  Line here\n\none line HERE \nshort"), (4, "short\nSHORT"), (None, "short\nlast of all"),
             (6, "é" * 9), (7, "x" * 40_000), (8, "x" * 40_001)]
    rows = line_dedup.near_lines(documents(pairs)).collect()
    assert {(row.doc_id, row.line_no): row.kept for row in rows} == brute_force(pairs)
    assert line_dedup.near_lines(documents([])).count() == 0


def test_texts_without_the_repeats(documents):
    pairs = [(1, "first line of text\nsecond line of text\n\nfirst line of text"), (2, "second line of text\nown words here"), (3, None)]
    kept = {row.doc_id: row.text for row in line_dedup.keep_first_lines(documents(pairs)).collect()}
    assert kept == {1: "first line of text\nsecond line of text\n", 2: "own words here", 3: ""}


def test_a_task_signs_a_line_once(documents):
    pairs = [(doc, "the same line in every text\n\nline of its own " + "abcdefghij"[doc] * 9) for doc in range(10)]
    texts = id_and_text(documents(pairs), "doc_id", "text").coalesce(1)
    signed = line_dedup._signed(texts, WIDTH, 0).collect()
    assert len(signed) == 30
    assert sum(bool(row["keys"]) for row in signed) == 11


def test_candidates_that_share_a_number(documents, monkeypatch):
    numbers = line_dedup.nodes
    salts = []

    def signed(texts, width, salt, signed=line_dedup._signed):
        salts.append(salt)
        return signed(texts, width, salt)

    monkeypatch.setattr(line_dedup, "nodes", lambda ids, salt: numbers(ids, salt) if salt else numbers(ids, salt) & 1)
    monkeypatch.setattr(line_dedup, "_signed", signed)
    draw = random.Random(5)
    bases = ["".join(draw.choice("abcdefghij ") for _ in range(120)) for _ in range(4)]
    pairs = [(doc, "\n".join(edited(draw, base) for base in bases)) for doc in range(9)]
    rows = line_dedup.near_lines(documents(pairs)).collect()
    assert salts == [0, 1]
    assert {(row.doc_id, row.line_no): row.kept for row in rows} == brute_force(pairs)


def test_white_space():
    odd = "".join(chr(code) for code in range(0x11000) if chr(code).isspace() or not 0xD800 <= code < 0xE000 and code % 97 == 0)
    texts = ["", " a ", "a  b", "one two\nthree\n\n four", "ΑΣ\nΣΑΣ Σ\nΟΔΟΣ", *(f"A{each}B{each}\n{each}C" for each in odd)]
    for text in texts:
        assert line_dedup.normalised_lines(text) == [line_dedup.normalised(line) for line in text.split("\n")]


def test_runs_of_every_width():
    lines = ["abcabcabcab", "", "ab", "é", "abcabc", "xab"]
    for width in range(1, 13):
        hashes, sizes = gram_hashes(lines, width)
        runs = [line[at : at + width] for line in lines for at in range(max(len(line) - width + 1, min(len(line), 1)))]
        assert sizes.sum() == len(runs) == len(hashes)
        assert len(set(zip(runs, hashes.tolist(), strict=True))) == len(set(runs)) == len(set(hashes.tolist()))


def test_sketches_agree_as_often_as_sets():
    draw = np.random.default_rng(6)
    for common, own in ((8, 1), (40, 5), (200, 25)):  # a similarity of 0.8
        base = draw.integers(0, 1 << 64, (400, common + 2 * own), dtype=np.uint64)
        sizes = np.full(400, common + own)
        one = line_dedup.sketches(base[:, own:].reshape(-1), sizes, 40)
        other = line_dedup.sketches(base[:, : common + own].reshape(-1), sizes, 40)
        assert abs((one == other).mean() - 0.8) < 0.02
    empty = line_dedup.sketches(np.array([5, 5], dtype=np.uint64), np.array([0, 2]), 40)
    assert (empty[0] == np.uint64(0xFFFFFFFFFFFFFFFF)).all() and (empty[1] != np.uint64(0xFFFFFFFFFFFFFFFF)).all()


def test_compared_lines():
    draw = random.Random(7)
    own = ["".join(draw.choice("ab") for _ in range(draw.randrange(1, 60))) for _ in range(200)]
    other = [edited(draw, line) for line in own]
    *sizes, left, rare = line_dedup._compared(own, other, 4)
    sets = [[{line[at : at + 4] for at in range(len(line) - 3)} or {line} for line in side] for side in (own, other)]
    expected = [(len(a), len(b), len(a & b), len(a - b)) for a, b in zip(*sets, strict=True)]
    assert list(zip(*(each.tolist() for each in (*sizes, left)), strict=True)) == expected
    assert len(rare) == left.sum()
