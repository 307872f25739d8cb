import random
import re
from collections import Counter

import pytest

from corvane.llm import phrases

COLUMNS = ["rank", "phrase", "a", "l", "r", "n", "score", "row", "spot", "id", "token"]


@pytest.fixture
def texts(spark):
    """(text, lang) pairs with extra columns under names the operator uses."""

    def make(pairs):
        schema = "text string, lang string, " + ", ".join(f"{name} string" for name in COLUMNS)
        return spark.createDataFrame([(*pair, *["x"] * len(COLUMNS)) for pair in pairs], schema)

    return make


def brute_force(pairs, longest=3, least=10, share=50, top=2000):
    counts, totals = {}, Counter()
    for text, lang in pairs:
        lang = "und" if lang is None else lang
        lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lowered):
            words = re.findall(r"[^\x20\x09]+", piece)
            totals[lang] += len(words)
            for size in range(1, longest + 1):
                for at in range(len(words) - size + 1):
                    counts.setdefault(lang, Counter())[tuple(words[at : at + size])] += 1
    found = []
    for lang, counted in counts.items():
        candidates = {words: a for words, a in counted.items() if len(words) > 1 and a >= least}
        scored = []
        for words, a in candidates.items():
            held = [
                other
                for other, f in candidates.items()
                if len(other) > len(words) and 100 * f >= share * a
                and any(other[at : at + len(words)] == words for at in range(len(other)))
            ]
            if not held:
                cuts = [(counted[words[:k]], counted[words[k:]], k) for k in range(1, len(words))]
                score, _, left, right = min((10**6 * a * a // (lo * hi), k, lo, hi) for lo, hi, k in cuts)
                scored.append((-score, -a, " ".join(words).encode(), left, right))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(scored)[:top], 1):
            found.append((lang, rank, phrase.decode(), -a, left, right, totals[lang], -score))
    return sorted(found)


def rows_of(df):
    return sorted(tuple(row) for row in df.collect())


def sample(seed, rows):
    draw = random.Random(seed)
    words = [f"w{at}" for at in range(12)] + ["Äpfel", "ÄPFEL", "can't", "x y", "HOT"]
    ends = [" ", " ", " ", "\t", "  ", ". ", ",", "\n", "! ", "\r", ";:", "?"]
    pairs = []
    for _ in range(rows):
        text = "".join(draw.choice(words) + draw.choice(ends) for _ in range(draw.randrange(0, 60)))
        pairs.append((text, draw.choice(["en", "en", "en", "de", None, "und", ""])))
    return pairs


@pytest.mark.parametrize("broadcast_rows", [phrases.BROADCAST_ROWS, 0])
def test_against_brute_force(texts, broadcast_rows):
    pairs = sample(1, 150) + [("new york city! New York CITY", "en")] * 9 + [("a a a a a a a a a a a a", "fr")] * 3
    pairs += [(None, "en"), ("", "en"), ("   \t", "de"), (".;!", None)] + sample(2, 1) * 12
    found = phrases.collocations(texts(pairs), broadcast_rows=broadcast_rows)
    assert found.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert {kind for name, kind in found.dtypes if name not in ("lang", "phrase")} == {"bigint"}
    assert rows_of(found) == brute_force(pairs)


@pytest.mark.parametrize("longest", [2, 4])
def test_other_parameters(texts, longest):
    pairs = sample(3, 120)
    found = phrases.collocations(texts(pairs), longest=longest, least=3, share=80, top=40)
    assert rows_of(found) == brute_force(pairs, longest, 3, 80, 40)


def test_long_texts_and_pieces(texts):
    draw = random.Random(5)
    long = " ".join(draw.choice("abcdefg") for _ in range(30_000))
    pairs = [(long, "en"), ("z" * 100_000 + " z", "en")]
    assert rows_of(phrases.collocations(texts(pairs))) == brute_force(pairs)


def test_nothing_to_find(texts):
    for pairs in ([], [(None, None)], [("one two three", "en")] * 9):
        assert rows_of(phrases.collocations(texts(pairs))) == []


def test_relations_are_merged_without_a_shuffle(spark, texts, plan_of, monkeypatch):
    plans = []
    numbered = phrases._numbered
    monkeypatch.setattr(phrases, "_numbered", lambda groups, name: plans.append(plan_of(groups)) or numbered(groups, name))
    phrases.collocations(texts(sample(4, 60)))
    joined = [plan for plan in plans if "SortMergeJoin" in plan]
    assert len(joined) == 2
    for plan in joined:
        assert plan.count("Exchange") == 1 and plan.index("Exchange") < plan.index("SortMergeJoin"), plan
    assert not [row for row in spark.sql("SHOW TABLES").collect() if "corvane_occurrences" in row.tableName]
    assert spark.conf.get("spark.sql.requireAllClusterKeysForCoPartition") == "true"
