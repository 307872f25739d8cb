import random

import numpy as np
from pyspark.sql import functions as F

from corvane.llm import quality
from corvane.llm.queries import held_out, op5_quality

DATA = "/root/testdata/sf0.01"


def made(seed, rows):
    draw = random.Random(seed)
    words = ["river", "stone", "garden", "window", "letter", "morning", "paper", "silver", "music", "harbour"]
    good = lambda: " ".join(draw.choice(words) for _ in range(draw.randrange(30, 90))).capitalize() + "."
    bad = lambda: " ".join(draw.choice(words).upper() + "!!$" for _ in range(draw.randrange(30, 90)))
    return [(n, good() if n % 3 else bad(), int(n % 3 > 0)) for n in range(rows)]


def test_held_out_accuracy_on_the_tables(spark):
    labels = spark.read.parquet(f"{DATA}/labels.parquet").select("doc_id", "quality")
    scored = op5_quality(spark, DATA).join(labels, "doc_id").filter("held_out").toPandas()
    assert len(scored) > 50
    assert (scored.predicted == scored.quality).mean() > 0.95
    assert scored.score.between(0, 1).all()
    assert ((scored.score >= 0.5) == (scored.predicted == 1)).all()


def test_held_out_rows_never_shape_the_model(spark):
    labels = spark.read.parquet(f"{DATA}/labels.parquet")
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    used = labels.filter(~held_out())
    turned = labels.withColumn("quality", F.when(held_out(), 1 - F.col("quality")).otherwise(F.col("quality")))
    first = quality.fit(quality.labelled_texts(docs, used))
    second = quality.fit(quality.labelled_texts(docs, turned.filter(~held_out())))
    assert np.array_equal(first.weights, second.weights) and first.cut == second.cut


def test_threshold_is_the_quantile_of_label_scores(spark):
    rows = made(1, 300)
    frame = spark.createDataFrame(rows, "doc_id bigint, text string, label int")
    model = quality.fit(frame)
    chances = model.chances(np.array([quality.features(text) for _, text, _ in rows]))
    assert ((chances >= 0.5) == [label == 1 for *_, label in rows]).all()


def test_one_label_or_none_scores_half(spark, documents):
    for rows in ([], [(1, "a b", 1), (2, "c", 1)]):
        model = quality.fit(spark.createDataFrame(rows, "doc_id bigint, text string, label int"))
        scored = quality.scores(documents([(1, "a"), (None, None)]), model).collect()
        assert [(row.score, row.predicted) for row in scored] == [(0.5, 1), (0.5, 1)]


def test_cases(spark, documents):
    model = quality.fit(spark.createDataFrame(made(2, 90), "doc_id bigint, text string, label int"))
    docs = documents([(1, None), (2, ""), (3, "x"), (3, "x"), (None, "A!!" * 60_000), (5, " \n"), (6, "é")])
    rows = quality.scores(docs, model).collect()
    assert len(rows) == 7 and all(0 <= row.score <= 1 for row in rows)
    assert rows[0].score == rows[1].score and rows[2].score == rows[3].score
    kept = quality.keep_good(docs, model)
    assert kept.columns == docs.columns and kept.count() == sum(row.predicted for row in rows)
    assert quality.scores(documents([]), model).count() == 0
    assert quality.keep_good(documents([]), model).count() == 0


def test_labels_with_nulls_and_the_sample_bound(spark, documents):
    docs = documents([(n, f"text {n}") for n in range(1000)])
    labels = spark.createDataFrame([(n, n % 2) for n in range(1000)] + [(None, 1), (5, None), (6, 7)], "doc_id bigint, quality int")
    assert quality.labelled_texts(docs, labels).count() == 1000
    assert 50 < quality.labelled_texts(docs, labels, sample=100).count() < 200
