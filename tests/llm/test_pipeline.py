"""The pipeline's stages one by one, each next to a plain version over what it was given."""

import base64

import pytest
import tiktoken

import corpus_pipeline
from corvane.llm import quality
from corvane.llm.queries import quality_model, rank_file
from corvane.llm.tables import table, written
from test_near_dedup import brute_force

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def steps(spark):
    frames = [table(spark, DATA, "documents")]
    for name, stage in corpus_pipeline.STAGES:
        frames.append(written(stage(spark, frames[-1], DATA), name.replace(" ", "-")))
    return frames


def pairs(frame):
    return sorted((row.doc_id, row.text) for row in frame.collect())


def test_all_but_the_last_keep_the_columns(steps):
    assert all(frame.dtypes == steps[0].dtypes for frame in steps[1:-1])
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "quality classifier", "exact dedup", "MinHash near-dedup", "benchmark decontamination", "byte-level BPE"
    ]


def test_quality(spark, steps):
    model = quality_model(spark, DATA)
    kept = {doc for doc, _ in pairs(steps[1])}
    for doc, text in pairs(steps[0]):
        assert (doc in kept) == (model.chances([quality.features(text)])[0] >= 0.5)
    labels = {row.doc_id: row.quality for row in table(spark, DATA, "labels").collect()}
    assert sum(labels[doc] == (doc in kept) for doc in labels) >= 0.97 * len(labels)


def test_exact(steps):
    best = {}
    for doc, text in pairs(steps[1]):
        best[text] = max(doc, best.get(text, doc))
    assert pairs(steps[2]) == sorted((doc, text) for text, doc in best.items())


def test_near(steps):
    own = pairs(steps[2])
    kept = {doc for doc, _, component, stays in brute_force(own, 5, 80) if stays}
    assert [doc for doc, _ in pairs(steps[3])] == sorted(kept)


def test_leaks(spark, steps):
    items = [row.text for row in table(spark, DATA, "benchmark").collect()]
    clean = {doc for doc, text in pairs(steps[3]) if not any(item in text for item in items)}
    kept = {doc for doc, _ in pairs(steps[4])}
    assert kept <= clean and len(clean - kept) <= 1


def test_tokens(steps):
    file, pattern = rank_file()
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file.splitlines())}
    known = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    found = {row.doc_id: row for row in steps[5].collect()}
    assert len(found) == steps[4].count()
    for doc, text in pairs(steps[4]):
        assert found[doc].ids == known.encode_ordinary(text) and found[doc].exact
        assert found[doc].n_tokens == len(found[doc].ids)


def test_run_is_the_stages_in_order(spark, steps):
    run = corpus_pipeline.run(spark, DATA)
    assert sorted((row.doc_id, row.n_tokens) for row in run.collect()) == sorted(
        (row.doc_id, row.n_tokens) for row in steps[-1].collect()
    )


def test_stages_take_empty_tables_and_nulls(spark):
    for rows in ([], [(None, None, None, None, None), (1, None, "en", None, 0), (2, "", None, "s", None)]):
        docs = spark.createDataFrame(rows, table(spark, DATA, "documents").schema)
        for _, stage in corpus_pipeline.STAGES:
            docs = written(stage(spark, docs, DATA), "cases")
        assert docs.count() <= len(rows)
