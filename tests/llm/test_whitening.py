import numpy as np
import pytest

from corvane.llm import whitening


@pytest.fixture
def vectors(spark):
    def make(rows, kind="double"):
        schema = f"vec_id bigint, embedding array<{kind}>, x string, n int, component int"
        return spark.createDataFrame([(a, b, "x", 1, 2) for a, b in rows], schema)

    return make


def expected(points, components=8):
    """(n, exact deviations, whitened up to sign, explained) of rows in memory."""
    x = np.floor(1024 * np.asarray(points, dtype=float)).astype(np.int64) + 100_000
    n, sums = len(x), x.sum(axis=0)
    deviations = [sum((n * int(a) - int(s)) ** 2 for a, s in zip(row, sums, strict=True)) for row in x]
    centred = x - x.mean(axis=0)
    values, axes = np.linalg.eigh(centred.T @ centred / n)
    values, axes = values[::-1], axes[:, ::-1]
    kept = [at for at in range(min(components, len(values))) if values[at] > 1e-9 * values[0]]
    return n, deviations, centred @ axes[:, kept] / np.sqrt(values[kept]), values[kept] / values.sum()


def checked(df, names, points, components=8, distinct=True):
    n, deviations, white, explained = expected(points, components)
    rows = df.collect()
    assert len(rows) == len(points) * white.shape[1]
    found = np.full(white.shape, np.nan)
    place = {name: at for at, name in enumerate(names)}
    for row in rows:
        found[place[row.vec_id], row.component - 1] = row.whitened
        assert row.n == n and row.deviation == deviations[place[row.vec_id]]
        assert abs(row.explained / explained[row.component - 1] - 1) < 1e-9
        assert 0 <= row.identity_error < 1e-9
    if distinct:
        assert np.abs(np.abs(found) - np.abs(white)).max() < 1e-7
    else:
        assert np.abs(found.T @ found / n - np.eye(white.shape[1])).max() < 1e-9


@pytest.mark.parametrize(("rows", "width"), [(500, 12), (40, 5), (6, 20), (2, 3)])
def test_against_eigenvectors(vectors, rows, width):
    points = np.random.default_rng(rows).standard_normal((rows, width)) @ np.diag(0.9 ** np.arange(width))
    df = whitening.whiten(vectors(list(enumerate(points.tolist()))))
    checked(df, range(rows), points)


def test_wide_vectors_stop_when_converged(vectors, monkeypatch):
    points = np.random.default_rng(5).standard_normal((300, 60)) @ np.diag(0.8 ** np.arange(60))
    monkeypatch.setattr(whitening, "ALL_STEPS", 10)
    steps = []
    plain = whitening._converged
    monkeypatch.setattr(whitening, "_converged", lambda *given: steps.append(1) or plain(*given))
    checked(whitening.whiten(vectors(list(enumerate(points.tolist())))), range(300), points)
    assert 8 < len(steps) < 60


def test_equal_deviations_are_all_found(vectors):
    points = [(1.0, 0, 0, 0), (-1.0, 0, 0, 0), (0, 1.0, 0, 0), (0, -1.0, 0, 0), (0, 0, 1.0, 0), (0, 0, -1.0, 0)]
    points = [[float(c) for c in point] for point in points]
    checked(whitening.whiten(vectors(list(enumerate(points)))), range(6), points, distinct=False)


def test_rows_that_take_no_part(vectors):
    points = np.random.default_rng(9).standard_normal((30, 4)).tolist()
    odd = [(100, None), (101, [1.0, None, 2.0, 3.0]), (102, [float("nan")] * 4), (103, [float("inf"), 0.0, 0.0, 0.0]),
           (104, []), (105, [1.0, 2.0]), (106, [1e300] * 4)]
    df = whitening.whiten(vectors(list(enumerate(points)) + odd), components=3)
    checked(df, range(30), points, components=3)


def test_nothing_to_whiten(vectors):
    for rows in ([], [(1, None)], [(1, [1.0, 2.0])], [(1, [1.0, 2.0]), (2, [1.0, 2.0]), (None, [1.0, 2.0])]):
        df = whitening.whiten(vectors(rows))
        assert df.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
        assert df.count() == 0


def test_repeated_rows_null_ids_and_floats(vectors):
    points = np.random.default_rng(1).standard_normal((20, 3)).astype(np.float32).astype(float)
    doubled = np.concatenate((points, points[:5]))
    df = whitening.whiten(vectors([(at, row.tolist()) for at, row in enumerate(doubled)], "float"))
    checked(df, range(25), doubled)
    nameless = whitening.whiten(vectors([(None, row.tolist()) for row in points]))
    assert nameless.filter("vec_id IS NULL").count() == 60


def test_deviations_past_64_bits():
    x = np.array([[1 << 40, 0], [0, 3]])
    n, sums = 1000, np.array([5, 7])
    found = whitening.squared_deviations(x, n, sums)
    assert found == [None, 5**2 + (3000 - 7) ** 2]
