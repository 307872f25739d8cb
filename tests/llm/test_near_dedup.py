import random
import re

import numpy as np
import pytest

from corvane.llm import near_dedup
from corvane.llm.components import components
from corvane.llm.shingles import gram_hashes, shingle_sets
from corvane.llm.tables import written


def roots(nodes, links):
    parent = {node: node for node in nodes}

    def find(node):
        while parent[node] != node:
            node = parent[node]
        return node

    for a, b in links:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {node: find(node) for node in nodes}


def word_sets(pairs, width):
    sets = {}
    for doc, text in pairs:
        lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        words = re.findall(r"[^\x20\x09-\x0D]+", lowered)
        sets[doc] = {tuple(words[at : at + width]) for at in range(len(words) - width + 1)} or (
            {tuple(words)} if words else set()
        )
    return sets


def brute_force(pairs, width, percent):
    sets = word_sets(pairs, width)
    ids = sorted(sets)
    links = [
        (a, b)
        for at, a in enumerate(ids)
        for b in ids[at + 1 :]
        if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])
    ]
    found = roots(ids, links)
    return sorted(((doc, len(sets[doc]), found[doc], doc == found[doc]) for doc in ids), key=repr)


def copies(seed, families, members, words, rates):
    """Families of texts made by dropping words of one base text at various rates."""
    draw = random.Random(seed)
    texts = []
    for _ in range(families):
        base = [f"w{draw.randrange(400)}" for _ in range(words)]
        for _ in range(members):
            rate = draw.choice(rates)
            texts.append(" ".join(word for word in base if draw.random() > rate))
    draw.shuffle(texts)
    return list(enumerate(texts))


@pytest.mark.parametrize("width", [4, 5])
def test_families_of_edited_copies(documents, values, width):
    pairs = copies(width, 12, 12, 120, [0, 0.01, 0.02, 0.03, 0.05, 0.08])
    assert values(near_dedup.near_duplicates(documents(pairs), width=width)) == brute_force(pairs, width, 80)


def test_one_large_group_with_members_apart(documents, values):
    pairs = copies(9, 1, 150, 150, [0.005, 0.01, 0.02, 0.04, 0.06]) + [(900, "alone in the world today")]
    assert values(near_dedup.near_duplicates(documents(pairs), width=4)) == brute_force(pairs, 4, 80)


def test_cases(documents, values):
    pairs = [(1, None), (2, ""), (3, " \t\n"), (4, "One two"), (5, "one two"), (6, "ONE  TWO"), (7, "a b c d"),
             (8, "a b c d e"), (9, "É b c d"), (10, "é b c d"), (11, "w " * 30_000), (12, "W w w w")]
    assert values(near_dedup.near_duplicates(documents(pairs), width=4)) == brute_force(pairs, 4, 80)


def test_null_ids_and_repeated_rows(documents, values):
    docs = documents([(None, "a b c d e"), (3, "a b c d e"), (2, "a b c d e"), (2, "q r s t u"), (2, "q r s t u"), (5, "q r s t u")])
    rows = values(near_dedup.near_duplicates(docs, width=4))
    assert rows == sorted(
        [(None, 2, None, True), (3, 2, 2, False), (2, 2, 2, True), (2, 2, 2, True), (2, 2, 2, True), (5, 2, 2, False)],
        key=repr,
    )


def test_empty_table_and_keep_one(documents):
    assert near_dedup.near_duplicates(documents([])).count() == 0
    docs = documents([(1, "a b c d e f"), (2, "a b c d e f"), (3, None), (None, "a b c d e f")])
    kept = near_dedup.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted((row.doc_id for row in kept.collect()), key=repr) == [1, 3, None]


def test_components_against_union_find(spark):
    draw = random.Random(3)
    links = [(draw.randrange(300), draw.randrange(300)) for _ in range(220)] + [(n, n + 1) for n in range(500, 560)]
    links += [(1000, n) for n in range(1001, 1200)] + [(7, 7)]
    frame = spark.createDataFrame([*links, (None, 4)], "a bigint, b bigint")
    ends = {node for a, b in links if a != b for node in (a, b)}
    assert {row.node: row.component for row in components(frame).collect()} == roots(ends, [x for x in links if x[0] != x[1]])
    assert components(frame.limit(0)).count() == 0


def test_super_minhash_is_unbiased_and_varies_less():
    draw = np.random.default_rng(5)
    errors = []
    for _ in range(300):
        base = draw.integers(0, 2**63, 110, dtype=np.uint64)
        signed = near_dedup.super_minhash(np.concatenate((base[:60], base[20:])), np.array([60, 90]), 96)
        errors.append((signed[0] == signed[1]).mean() - 40 / 110)
    share = 40 / 110
    assert abs(np.mean(errors)) < 0.01
    assert np.std(errors) < (share * (1 - share) / 96) ** 0.5


def test_short_sets_fill_every_slot():
    signed = near_dedup.super_minhash(np.array([5], dtype=np.uint64), np.array([1, 0]), 40)
    assert sorted(signed[0] >> np.uint64(32)) == list(range(40))
    assert (signed[1] == np.uint64(2**64 - 1)).all()


def test_shingles_match_words():
    texts = ["Ab c  d\te", "x", "", "ab C d e ab c d e", "é É"]
    sets = shingle_sets([text.encode() for text in texts], 2)
    assert [len(each) for each in sets] == [len(own) for own in word_sets(enumerate(texts), 2).values()]
    assert set(sets[0].tolist()) <= set(sets[3].tolist())
    grams, sizes = gram_hashes(["abcab", "", "ab", "é"], 2)
    assert sizes.tolist() == [4, 0, 1, 1]
    assert grams[0] == grams[3] == grams[4] != grams[1]


def test_groups_within_the_work_take_one_round(spark, monkeypatch):
    draw = random.Random(8)
    links = [(draw.randrange(80), draw.randrange(80)) for _ in range(60)] + [(5, 5), (None, 3)]
    frame = spark.createDataFrame(links, "a bigint, b bigint")
    least = {row.node: row.component for row in components(frame).collect()}
    first = {row.node: row.component for row in near_dedup.first_groups(frame).collect()}
    assert first and all(least[node] == least[component] and node > component for node, component in first.items())
    tables = []
    monkeypatch.setattr("corvane.llm.components.written", lambda df, name: (tables.append(name), written(df, name))[1])
    sets = [(at, list(range(at, at + 40))) for at in range(30)]  # a chain: each set is linked with the next ones only
    content = spark.createDataFrame(sets, "doc_id bigint, content array<bigint>")
    buckets = spark.createDataFrame([(at // 3 + side, at) for at in range(30) for side in (0, 1)], "key bigint, doc_id bigint")
    found = near_dedup.link_buckets(buckets, content, 80)
    assert tables == ["hung", "hung"]
    assert {row.component for row in components(found).collect()} == {0}
