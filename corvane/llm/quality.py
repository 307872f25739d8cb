"""Text quality by a Bradley-Terry model over preference pairs.

A text's score is a weighted sum of its features. A pair of a text labelled 1
and one labelled 0 says that the first is preferred; the logistic loss on the
difference of their features fits the weights. The threshold is the quantile of
the scores of the labelled texts at the share of label 0, and the score given
out is the chance that a text beats one at the threshold.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corvane.llm.tables import id_and_text, named, ship

SAMPLE = 20_000  # most labelled texts that a model is fitted on, in expectation
PAIRS_PER_TEXT = 8

FEATURES = [
    "letters", "upper", "digits", "blanks", "sentence marks", "other marks", "beyond ASCII", "word length",
    "long words", "distinct words", "distinct lines", "line length", "length", "shouted words", "marked words",
    "repeated pairs", "doubled words", "empty",
]

_KIND = np.full(256, 5, dtype=np.int64)
_KIND[list(range(97, 123))] = 0
_KIND[list(range(65, 91))] = 1
_KIND[list(range(48, 58))] = 2
_KIND[[9, 10, 11, 12, 13, 32]] = 3
_KIND[[ord(mark) for mark in ".,;:?'\"-()"]] = 4
_KIND[128:] = 6


def features(text: str | None) -> list[float]:
    """The features of one text, each within fixed bounds; null counts as empty."""
    data = (text or "").encode()
    size = len(data)
    if not size:
        return [0.0] * (len(FEATURES) - 1) + [1.0]
    counts = np.bincount(np.frombuffer(data, dtype=np.uint8), minlength=256)
    small, upper, digits, blanks, marks, other, beyond = np.bincount(_KIND, weights=counts, minlength=7).tolist()
    words = data.split()
    n = max(len(words), 1)
    lines = [line for line in data.split(b"\n") if line]
    pairs = list(zip(words, words[1:], strict=False))
    shouted = sum(word.isupper() for word in words)
    marked = sum(not (word[-1:].isalnum() or word[-1] in b".,;:?'\")-" or word[-1] > 127) for word in words)
    return [
        (small + upper) / size,
        upper / size,
        digits / size,
        blanks / size,
        marks / size,
        other / size,
        beyond / size,
        min((size - blanks) / n, 40.0) / 10,
        sum(len(word) > 14 for word in words) / n,
        len(set(words)) / n,
        len(set(lines)) / max(len(lines), 1),
        np.log1p(min(size / max(len(lines), 1), 1e6)) / 5,
        np.log1p(size) / 10,
        shouted / n,
        marked / n,
        1 - len(set(pairs)) / len(pairs) if pairs else 0.0,
        sum(first == second for first, second in pairs) / n,
        0.0,
    ]


@dataclass(frozen=True)
class Model:
    """score(text) = sum of weights * (features - means) / spreads; cut is the threshold."""

    means: np.ndarray
    spreads: np.ndarray
    weights: np.ndarray
    cut: float

    def chances(self, rows: np.ndarray) -> np.ndarray:
        raw = ((rows - self.means) / self.spreads) @ self.weights - self.cut
        return 1 / (1 + np.exp(-np.clip(raw, -500, 500)))


def _rows(texts: pa.Array) -> np.ndarray:
    """The features of a column of texts, one text in memory at a time."""
    return np.array([features(text.as_py()) for text in texts])


def _measured(texts: DataFrame, extra: list[str]) -> DataFrame:
    """The features of (doc_id, text, ...), with ``doc_id`` and the columns ``extra`` passed on."""
    ship(texts.sparkSession)
    names = ["doc_id", *extra, "features"]
    places = [texts.columns.index(name) for name in ["doc_id", *extra]]
    text_place = texts.columns.index("text")

    def batches(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in source:
            rows = [features(text.as_py()) for text in batch.column(text_place)]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(at) for at in places), pa.array(rows, pa.list_(pa.float64()))], names=names
            )

    passed = ", ".join(f"{name} {texts.schema[name].dataType.simpleString()}" for name in ["doc_id", *extra])
    return texts.mapInArrow(batches, f"{passed}, features array<double>")


def labelled_texts(
    docs: DataFrame, labels: DataFrame, label_col: str = "quality", id_col: str = "doc_id", text_col: str = "text",
    sample: int = SAMPLE,
) -> DataFrame:
    """(doc_id, text, label) of about ``sample`` labelled rows at most, chosen by a hash of their ids.

    Rows without an id or with a label other than 0 and 1 are left out.
    """
    known = labels.select(named(id_col).alias("doc_id"), named(label_col).cast("int").alias("label"))
    known = known.filter("doc_id IS NOT NULL AND label IN (0, 1)")
    every = max(1, -(-known.count() // sample))
    chosen = known.filter(F.pmod(F.xxhash64(F.col("doc_id").cast("string")), F.lit(every)) == 0)
    # At most about ``sample`` short rows, whatever the size of the tables.
    return id_and_text(docs, id_col, text_col).join(F.broadcast(chosen), "doc_id")


def fit(texts: DataFrame, penalty: float = 1e-2, pairs_per_text: int = PAIRS_PER_TEXT, seed: int = 7) -> Model:
    """Fit the weights to preference pairs of (doc_id, text, label).

    Every text takes part in ``pairs_per_text`` pairs with drawn texts of the
    other label. With one label only there is nothing to prefer: all weights
    are 0 and every text scores 0.5.
    """
    table = _measured(texts, ["label"]).toArrow().sort_by([("doc_id", "ascending"), ("label", "ascending")])
    width = len(FEATURES)
    rows = np.array(table["features"].to_pylist(), dtype=float).reshape(-1, width)
    marks = table["label"].to_numpy()
    good, bad = np.flatnonzero(marks == 1), np.flatnonzero(marks == 0)
    if not len(good) or not len(bad):
        return Model(np.zeros(width), np.ones(width), np.zeros(width), 0.0)
    means, spreads = rows.mean(axis=0), rows.std(axis=0)
    spreads[spreads < 1e-9] = 1.0
    scaled = (rows - means) / spreads
    draw = np.random.default_rng(seed)
    winners = np.concatenate([np.repeat(good, pairs_per_text), draw.choice(good, len(bad) * pairs_per_text)])
    losers = np.concatenate([draw.choice(bad, len(good) * pairs_per_text), np.repeat(bad, pairs_per_text)])
    gaps = scaled[winners] - scaled[losers]
    weights = np.zeros(width)
    for _ in range(50):  # Newton steps on the mean logistic loss of the gaps
        chance = 1 / (1 + np.exp(-np.clip(gaps @ weights, -30, 30)))
        slope = gaps.T @ (chance - 1) / len(gaps) + penalty * weights
        curve = (gaps * (chance * (1 - chance))[:, None]).T @ gaps / len(gaps) + penalty * np.eye(width)
        step = np.linalg.solve(curve, slope)
        weights -= step
        if np.abs(step).max() < 1e-8:
            break
    cut = float(np.quantile(scaled @ weights, len(bad) / len(rows)))
    return Model(means, spreads, weights, cut)


def scores(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, score (0 to 1) and predicted (1 from 0.5 on) per row.

    Null and empty texts are scored as empty; ids may be null; repeated rows
    score alike; an empty table gives an empty result.
    """
    texts = id_and_text(docs, id_col, text_col)
    ship(docs.sparkSession)

    def batches(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in source:
            if batch.num_rows:
                found = model.chances(_rows(batch.column(1)))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), pa.array(found), pa.array((found >= 0.5).astype(np.int32))],
                    names=["doc_id", "score", "predicted"],
                )

    kind = texts.schema["doc_id"].dataType.simpleString()
    return texts.mapInArrow(batches, f"doc_id {kind}, score double, predicted int")


def keep_good(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that the model predicts as 1, all columns as they were, without a shuffle."""
    ship(docs.sparkSession)
    place = docs.columns.index(text_col)

    def batches(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in source:
            if batch.num_rows:
                yield batch.filter(pa.array(model.chances(_rows(batch.column(place))) >= 0.5))

    return docs.mapInArrow(batches, docs.schema)
