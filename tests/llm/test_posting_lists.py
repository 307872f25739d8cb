from itertools import accumulate

import numpy as np
import pytest

from corvane.llm import posting_lists
from corvane.llm.centroid_graph import CentroidGraph, balanced_clusters, squared_distances

DATA = "/root/testdata/sf0.01"


@pytest.fixture
def vectors(spark):
    def make(rows):
        schema = "vec_id bigint, embedding array<float>, label int, query bigint, list int, hits string"
        return spark.createDataFrame([(a, b, 1, 2, 3, "x") for a, b in rows], schema)

    return make


def product(first, second):
    """Added up from the left; sum() would round otherwise."""
    return list(accumulate(a * b for a, b in zip(first, second, strict=True)))[-1]


def brute_force(rows, most=20, every=20):
    found = {}
    sound = {}
    for name, vector in rows:
        if name is not None and vector and None not in vector and np.isfinite(vector).all() and np.any(vector):
            vector = tuple(np.asarray(vector, dtype=np.float32).astype(float).tolist())
            sound[name] = min(sound.get(name, vector), vector)
    for query, vector in sound.items():
        if query % every == 0:
            scores = [(-product(vector, other), name) for name, other in sound.items() if name != query]
            for rank, (score, name) in enumerate(sorted(scores)[:most], 1):
                found[query, rank] = (name, -score)
    return found


def found_in(df):
    return {(row.query_id, row.rank): (row.vec_id, row.score) for row in df.collect()}


def test_small_tables_are_searched_whole(vectors):
    draw = np.random.default_rng(3)
    some = [tuple(draw.integers(-3, 4, 6).astype(float).tolist()) for _ in range(60)]
    rows = [(name, some[name % 60] if name % 3 else some[7]) for name in range(400)]  # a third of all rows are equal
    rows += [(1000, None), (1020, (0.0,) * 6), (1040, (1.0, None, 2.0, 3.0, 4.0, 5.0)), (1060, (float("nan"),) * 6),
             (1080, (float("inf"),) * 6), (1100, (1e3, -2e3, 0.5, 0.0, 0.0, 1.0)), (None, some[3]),
             (1120, (1.0, 2.0)), (1140, ()), (20, some[9]), (40, rows[40][1])]
    expected = brute_force([row for row in rows if row[0] != 1120])
    assert found_in(posting_lists.nearest(vectors(rows))) == expected


def test_few_rows(vectors):
    assert found_in(posting_lists.nearest(vectors([]))) == {}
    assert found_in(posting_lists.nearest(vectors([(0, None), (20, (0.0, 0.0))]))) == {}
    assert found_in(posting_lists.nearest(vectors([(0, (1.0, 2.0))]))) == {}
    rows = [(0, (1.0, 2.0)), (3, (1.0, 2.0)), (20, (2.0, -1.0)), (5, (-1.0, 0.5))]
    assert found_in(posting_lists.nearest(vectors(rows))) == brute_force(rows)


@pytest.mark.parametrize("clustered", [False, True])
def test_recall_over_many_lists(vectors, clustered):
    draw = np.random.default_rng(8)
    middles = 3 * draw.standard_normal((25, 16))
    lengths = draw.uniform(0.2, 3.0, (3000, 1))
    spread = draw.standard_normal((3000, 16))
    points = (middles[draw.integers(0, 25, 3000)] + spread if clustered else lengths * spread).round(3)
    rows = list(enumerate(points.tolist()))
    expected = brute_force(rows)
    found = found_in(posting_lists.nearest(vectors(rows), list_size=30))
    assert found.keys() == expected.keys()
    least = {query: score for (query, rank), (_, score) in expected.items() if rank == 20}
    hits = [score >= least[query] - 1e-9 for (query, _), (_, score) in found.items()]
    assert np.mean(hits) >= 0.95
    assert all(len({found[query, rank][0] for rank in range(1, 21)}) == 20 for query in least)


def test_recall_on_the_given_table(spark):
    table = spark.read.parquet(f"{DATA}/embeddings.parquet")
    rows = [(row.vec_id, tuple(row.embedding)) for row in table.collect()]
    expected = brute_force(rows)
    assert found_in(posting_lists.nearest(table)) == expected
    split = found_in(posting_lists.nearest(table, list_size=32))
    least = {query: score for (query, rank), (_, score) in expected.items() if rank == 20}
    assert np.mean([score >= least[query] for (query, _), (_, score) in split.items()]) >= 0.9


def test_graph_finds_the_nearest_centroids():
    points = np.random.default_rng(2).standard_normal((4000, 12))
    centres = balanced_clusters(points, 10)
    assert 256 <= len(centres) <= 512
    graph = CentroidGraph.over(centres)
    rows, numbers, distances = graph.near(points[:300], 8, 1.0)
    apart = squared_distances(points[:300], centres)
    exact = np.argsort(apart, axis=1)[:, :8]
    assert np.mean([len(set(numbers[rows == at]) & set(exact[at])) / 8 for at in range(300)]) > 0.97
    rows, numbers, distances = graph.near(points[:50], 1, 1.2)
    within = [(apart[at] <= 1.44 * apart[at].min()).sum() for at in range(50)]
    assert np.mean([np.sum(rows == at) / within[at] for at in range(50)]) > 0.97
    assert (np.diff(distances)[np.diff(rows) == 0] >= 0).all()
