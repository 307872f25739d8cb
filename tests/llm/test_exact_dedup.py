import hashlib

from pyspark.sql import functions as F

from corvane.llm import exact_dedup

PAIRS = [(1, "a b"), (2, "a b"), (3, "a  b"), (4, None), (5, ""), (None, "a b"), (None, "z"), (7, "x" * 200_000),
         (8, "x" * 200_000), (9, "x" * 199_999 + "y"), (10, "A b"), (10, "A b")]


def expected(pairs):
    groups = {}
    for doc, text in pairs:
        groups.setdefault(text or "", []).append(doc)
    rows = []
    for doc, text in pairs:
        ids = groups[text or ""]
        keep = max((i for i in ids if i is not None), default=None)
        rows.append((doc, keep, len(ids), doc == keep, hashlib.sha256((text or "").encode()).hexdigest()))
    return sorted(rows, key=repr)


def test_groups_of_all_cases(documents, values):
    assert values(exact_dedup.memberships(documents(PAIRS))) == expected(PAIRS)


def test_colliding_digests_keep_texts_apart(documents, values):
    weak = lambda text: F.substring(exact_dedup.sha256_hex(text), 1, 0)  # noqa: E731  every text has this digest
    rows = values(exact_dedup.memberships(documents(PAIRS), digest=weak))
    assert [row[:4] for row in rows] == sorted((row[:4] for row in expected(PAIRS)), key=repr)
    kept = values(exact_dedup.keep_one(documents(PAIRS), digest=weak).select("doc_id", F.length("text")))
    assert kept == values(exact_dedup.keep_one(documents(PAIRS)).select("doc_id", F.length("text")))


def test_keep_one_leaves_one_row_per_text_and_all_columns(documents):
    docs = documents(PAIRS)
    kept = exact_dedup.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted(((row.doc_id, row.text or "") for row in kept.collect()), key=repr) == sorted(
        [(2, "a b"), (3, "a  b"), (5, ""), (None, "z"), (8, "x" * 200_000), (9, "x" * 199_999 + "y"), (10, "A b")],
        key=repr,
    )


def test_normalisation_and_other_names(documents, values):
    docs = documents([(1, "A"), (2, "a")], "own_id", "body_text")
    rows = values(exact_dedup.memberships(docs, "own_id", "body_text", normalise=F.lower))
    assert [row[1:4] for row in rows] == [(2, 2, False), (2, 2, True)]


def test_empty_table(documents):
    assert exact_dedup.memberships(documents([])).count() == 0
    assert exact_dedup.keep_one(documents([])).count() == 0


def test_plan_has_no_python(documents, plan_of):
    assert "Python" not in plan_of(exact_dedup.memberships(documents(PAIRS)))
