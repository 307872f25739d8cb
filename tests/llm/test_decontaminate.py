import random

import numpy as np

from corvane.llm import decontaminate

DATA = "/root/testdata/sf0.01"


def words(draw, count, stock):
    return [draw.choice(stock) for _ in range(count)]


def corpus(seed):
    """Documents of which some hold an item whole, with gaps and changed words, or in small part."""
    draw = random.Random(seed)
    common = [f"c{n}" for n in range(40)]
    stock = common * 20 + ["".join(draw.choice("abcdefghijklmnop") for _ in range(6)) for _ in range(3000)]
    items = [(n, " ".join(words(draw, draw.randrange(15, 60), stock))) for n in range(30)]
    docs, truth = [], set()
    for doc in range(300):
        body = words(draw, draw.choice([5, 60, 300, 900]), stock)
        if doc % 3 == 0:
            item, text = draw.choice(items)
            own = text.split()
            kind = doc // 3 % 3
            if kind == 0:
                truth.add((doc, item))
            elif kind == 1:  # a paraphrase: some words lost, some added
                own = [word for word in own if draw.random() > 0.12]
                for _ in range(len(own) // 10):
                    own.insert(draw.randrange(len(own)), draw.choice(common))
                truth.add((doc, item))
            else:
                own = own[: len(own) // 4]
            at = draw.randrange(len(body) + 1)
            body[at:at] = own
        docs.append((doc, " ".join(body).capitalize() + "."))
    return docs, items, truth


def test_items_are_found_and_clean_texts_left(spark, documents):
    docs, items, truth = corpus(1)
    benchmark = spark.createDataFrame(items, "item_id bigint, text string")
    found = decontaminate.matches(documents(docs), benchmark).collect()
    assert {(row.doc_id, row.item_id) for row in found} == truth
    assert all(row.lcs_share >= 0.5 for row in found)
    kept = decontaminate.keep_clean(documents(docs), benchmark)
    assert {row.doc_id for row in kept.collect()} == {doc for doc, _ in docs} - {doc for doc, _ in truth}
    assert kept.columns == documents(docs).columns


def test_common_subsequence_against_dynamic_programming():
    draw = random.Random(2)
    for _ in range(200):
        a, b = (words(draw, draw.randrange(0, 30), "abcde") for _ in "ab")
        rows = [0] * (len(b) + 1)
        for x in a:
            before = 0
            for at, y in enumerate(b, 1):
                before, rows[at] = rows[at], before + 1 if x == y else max(rows[at], rows[at - 1])
        assert decontaminate.common_subsequence(a, b) == rows[-1]


def test_axes_come_near_the_exact_decomposition(spark, documents):
    docs, items, _ = corpus(3)
    index = decontaminate.build_index(
        documents(docs).select("doc_id", "text"), [(item, text) for item, text in items], rank=12
    )
    rows = []
    for _, text in docs:
        passage, word, number, *_ = decontaminate._cells([decontaminate.plain(text)], index.words, index.slots)
        for at in np.unique(passage):
            row = np.zeros(len(index.words))
            row[word[passage == at]] = number[passage == at]
            row *= index.weights
            if row.any():
                rows.append(row / np.linalg.norm(row))
    exact = np.linalg.svd(np.array(rows), compute_uv=False)
    caught = np.linalg.norm(np.array(rows) @ index.axes) ** 2
    assert caught > 0.7 * (exact[:12] ** 2).sum()


def test_cases(spark, documents):
    text = "the quick zebra quilted yonder xylophones while vexed wizards jumped over lazy quartz dogs"
    benchmark = spark.createDataFrame([(1, text), (1, text), (2, None), (3, ""), (None, "x")], "item_id bigint, text string")
    docs = [(1, None), (2, ""), (3, text), (3, text), (None, text.upper()), (5, "z " * 100_000 + text), (6, "other words")]
    rows = decontaminate.matches(documents(docs), benchmark).collect()
    assert {(row.doc_id, row.item_id) for row in rows} == {(3, 1), (None, 1), (5, 1)}
    kept = decontaminate.keep_clean(documents(docs), benchmark)
    assert sorted((row.doc_id for row in kept.collect()), key=repr) == [1, 2, 6, None]
    assert decontaminate.matches(documents([]), benchmark).count() == 0
    assert decontaminate.matches(documents(docs), benchmark.limit(0)).count() == 0


def test_recall_against_every_passage_of_planted_paraphrases(spark, documents):
    """Documents of the words of a large benchmark; leaks have other weighted words beside them."""
    draw = random.Random(5)
    stock = ["".join(draw.choice("abcdefghijklmnop") for _ in range(6)) for _ in range(4000)]
    items = [(n, " ".join(words(draw, draw.randrange(15, 45), stock))) for n in range(400)]
    docs = []
    for doc in range(400):
        own = [word for word in items[doc][1].split() if draw.random() > (0, 0.15, 0.3)[doc % 3]]
        body = words(draw, 120, stock)
        body[60:60] = own
        docs.append((doc, " ".join(body)))
    brute = set()
    for doc, text in docs:
        split = text.split()
        item = decontaminate.Item(doc, tuple(items[doc][1].split()), frozenset())
        if decontaminate.common_subsequence(item.words, split[60 : 60 + len(item.words)]) / len(item.words) >= 0.7:
            brute.add((doc, doc))
    benchmark = spark.createDataFrame(items, "item_id bigint, text string")
    found = decontaminate.matches(documents(docs), benchmark).collect()
    assert len(brute) > 300 and brute <= {(row.doc_id, row.item_id) for row in found}
    assert any(row.cosine < decontaminate.COSINE for row in found)


def test_one_leaked_document_alone(spark, documents):
    text = "the quick zebra quilted yonder xylophones while vexed wizards jumped over lazy quartz dogs"
    benchmark = spark.createDataFrame([(1, text)], "item_id bigint, text string")
    assert [row.doc_id for row in decontaminate.matches(documents([(7, text)]), benchmark).collect()] == [7]
    assert decontaminate.keep_clean(documents([(7, text), (8, text)]), benchmark).count() == 0


def test_items_without_id(spark, documents):
    text = "the quick zebra quilted yonder xylophones while vexed wizards jumped over lazy quartz dogs"
    items = [(None, text), (2, "nothing of that kind"), (None, "another text"), (3, None)]
    benchmark = spark.createDataFrame(items, "item_id bigint, text string")
    docs = documents([(7, text), (8, "other words")])
    assert [(row.doc_id, row.item_id) for row in decontaminate.matches(docs, benchmark).collect()] == [(7, None)]
    assert [row.doc_id for row in decontaminate.keep_clean(docs, benchmark).collect()] == [8]


def test_paraphrases_that_swap_the_rare_words(spark, documents):
    """Texts over 200 common words; leaks lose an item's rare words, or any of its words, and some gain words."""
    draw = random.Random(8)
    common = [f"c{n}" for n in range(200)]
    rare = iter("".join(draw.choice("abcdefghijklmnop") for _ in range(9)) for _ in range(20_000))
    items = []
    for item in range(40):
        own = words(draw, 32, common) + [next(rare) for _ in range(8)]
        draw.shuffle(own)
        items.append((item, " ".join(own)))
    docs, truth = [], set()
    for doc in range(600):
        body = words(draw, draw.choice([30, 200, 500]), common)
        if doc % 3 == 0:
            item, text = items[doc // 3 % 40]
            own = text.split()
            if doc % 2:
                own = [word if word in common else next(rare) for word in own]
            else:
                swapped = set(draw.sample(range(40), 12))
                own = [next(rare) if at in swapped else word for at, word in enumerate(own)]
            if doc % 5 == 0:
                own[20:20] = words(draw, 2, common)
            if doc % 4 == 0:
                body = []  # a document of its own
            at = draw.randrange(len(body) + 1)
            body[at:at] = own
            assert decontaminate.common_subsequence(text.split(), own) / 40 >= 0.7
            truth.add((doc, item))
        docs.append((doc, " ".join(body)))
    benchmark = spark.createDataFrame(items, "item_id bigint, text string")
    found = decontaminate.matches(documents(docs), benchmark).collect()
    assert {(row.doc_id, row.item_id) for row in found} == truth


def test_pairs_against_a_plain_list():
    draw = random.Random(9)
    texts = [" ".join(words(draw, count, "abcdefg")) for count in (0, 1, 2, 3, 60, 200)]
    hashes, counts = decontaminate.word_hashes([text.encode() for text in texts])
    mixed, places = decontaminate._paired(hashes, counts)
    split = [(at, word) for at, text in enumerate(texts) for word in text.split()]
    by_pair = {}
    begin = 0
    for gap in (1, 2):
        own = [at for at in range(len(split) - gap) if split[at][0] == split[at + gap][0]]
        assert places[begin : begin + len(own)].tolist() == own
        for at, value in zip(own, mixed[begin : begin + len(own)].tolist(), strict=True):
            by_pair.setdefault((split[at][1], split[at + gap][1]), set()).add(value)
        begin += len(own)
    assert begin == len(mixed)
    assert all(len(values) == 1 for values in by_pair.values())
    assert len({value for values in by_pair.values() for value in values}) == len(by_pair)


def test_recall_on_the_given_tables(spark):
    """Against the common subsequence of every passage of every document with every item."""
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    benchmark = spark.read.parquet(f"{DATA}/benchmark.parquet")
    items = [(row.item_id, tuple(decontaminate.words_of(row.text))) for row in benchmark.collect()]
    brute = set()
    for row in docs.collect():
        split = decontaminate.words_of(row.text or "")
        for item, own in items:
            reach = 2 * decontaminate.BLOCK + 2 * len(own)
            for begin in range(0, max(len(split) - len(own), 1), decontaminate.BLOCK):
                near = split[begin : begin + reach]
                held = set(near)  # words in common, in any order, bound the subsequence
                if sum(word in held for word in own) < decontaminate.LCS_SHARE * len(own):
                    continue
                if decontaminate.common_subsequence(own, near) / len(own) >= decontaminate.LCS_SHARE:
                    brute.add((row.doc_id, item))
    found = {(row.doc_id, row.item_id) for row in decontaminate.matches(docs, benchmark).collect()}
    assert brute and brute <= found
