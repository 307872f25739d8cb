"""Benchmark items in documents: latent semantic retrieval, then exact checks.

Texts are cut into overlapping passages. Their TF-IDF rows over the words of
the benchmark are reduced by a randomised singular value decomposition: every
task multiplies its rows by a random matrix and back, the products add up in a
grouping, and the decomposition of the small sum gives the latent axes. A
passage that shares enough informative features with an item is a candidate, and
one fewer is enough when its latent vector lies near that of the item: the
axes alone lose leaks whose passage holds other weighted words too. Features are
words, and pairs of words that follow each other at once or with one word
between: a paraphrase that swaps an item's rare words keeps pairs of its common
ones, which are rare even where the words are not. A candidate counts when the longest common subsequence of its words covers
enough of the item, or a good part of it together with the item's answer words.

What the driver holds is bounded by the benchmark: about 3.5 KB per distinct
benchmark word while the axes are found (five rows of up to 112 numbers), and
one row of 96 numbers per 48 words of an item, and one count per distinct pair,
at most two per word of an item; never anything per document. What is broadcast
is about 0.4 KB for each word and row, and one number per item and feature.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corvane.llm.bloom import without
from corvane.llm.shingles import chunks, word_hashes
from corvane.llm.tables import id_and_text, named, ship, written

BLOCK = 24  # words; a passage is two neighbouring blocks
RANK = 96
OVERSAMPLED = 16
COSINE = 0.3
COMMON = 0.003  # a feature in a larger share of passages counts only as one of an item's rarest
FEW = 32  # passages; a pair in no more of them counts however small the corpus
SHARED = 3  # informative features that a candidate shares with an item, or all its words; one less at COSINE
PAIR_GAPS = (1, 2)
LCS_SHARE = 0.7
ANSWERED_LCS_SHARE = 0.5
ANSWER_SHARE = 0.6
ANSWER_WORDS = 8
PASSAGES_AT_ONCE = 1024  # compared to all items

# Other ASCII characters than letters, digits and underscores part words.
_PARTED = bytes(byte if byte > 127 or chr(byte).isalnum() or byte == 95 else 32 for byte in range(256))


def plain(text: str) -> bytes:
    """The text in lower case, with spaces for the ASCII characters that part words."""
    return text.lower().encode().translate(_PARTED)


def words_of(text: str) -> list[str]:
    return [word.decode() for word in plain(text).split()]


@dataclass(frozen=True)
class Item:
    item_id: object
    words: tuple[str, ...]
    answer: frozenset[str]


@dataclass
class Index:
    """The benchmark as the search needs it. Rows of ``axes`` and ``weights`` belong to ``words``."""

    items: list[Item]
    words: np.ndarray  # sorted hashes
    weights: np.ndarray  # inverse document frequency over all passages, 0 for common words
    axes: np.ndarray
    vectors: np.ndarray  # one latent vector per query row
    owners: np.ndarray  # the item of each query row
    holders: np.ndarray  # the items that hold a feature, one by one, words before pairs; none for common ones
    holder_ends: np.ndarray  # where those of each feature end
    needed: np.ndarray  # informative features that a candidate shares with each item
    slots: np.ndarray  # hash table of the words, for quick rejection
    pairs: np.ndarray  # sorted hashes of the informative pairs
    pair_slots: np.ndarray


def _slots(words: np.ndarray) -> np.ndarray:
    table = np.zeros(1 << 20, dtype=bool)
    table[(words >> np.uint64(44)).astype(np.int64)] = True
    return table


def _looked_up(hashes: np.ndarray, words: np.ndarray, slots: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions in ``hashes`` that hold a benchmark word, and which word."""
    if not len(words):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    at = np.flatnonzero(slots[(hashes >> np.uint64(44)).astype(np.int64)])
    place = np.searchsorted(words, hashes[at])
    place[place == len(words)] = 0
    same = words[place] == hashes[at]
    return at[same], place[same]


def _paired(hashes: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the ordered pairs of near words within a text, and the place of each first word."""
    ends = np.repeat(np.cumsum(counts), counts)
    places = [np.flatnonzero(np.arange(gap, len(hashes) + gap) < ends) for gap in PAIR_GAPS]
    mixed = [
        ((hashes[at] ^ (hashes[at] >> np.uint64(29))) * np.uint64(0x9E3779B97F4A7C15) + hashes[at + gap])
        * np.uint64(0xC2B2AE3D27D4EB4F)
        for at, gap in zip(places, PAIR_GAPS, strict=True)
    ]
    return np.concatenate(mixed), np.concatenate(places)


def _cells(run: list[bytes], words: np.ndarray, slots: np.ndarray):
    """The TF-IDF matrix of the passages of some texts, without weights, as sorted cells.

    Gives the passage, word and count of each cell, then per text its number of
    words, blocks and first passage.
    """
    return _word_cells(*word_hashes(run), words, slots)


def _word_cells(hashes: np.ndarray, counts: np.ndarray, words: np.ndarray, slots: np.ndarray):
    return _counted(hashes, np.arange(len(hashes)), counts, words, slots)


def _pair_cells(hashes: np.ndarray, counts: np.ndarray, pairs: np.ndarray, slots: np.ndarray):
    """The passage and pair of each cell of the same passages."""
    mixed, places = _paired(hashes, counts)
    return _counted(mixed, places, counts, pairs, slots)[:2]


def _counted(hashes: np.ndarray, places: np.ndarray, counts: np.ndarray, words: np.ndarray, slots: np.ndarray):
    """The cells of features at some places of texts of ``counts`` words."""
    blocks = -(-counts // BLOCK)
    passages = np.where(blocks > 0, np.maximum(blocks - 1, 1), 0)
    firsts = np.cumsum(passages) - passages
    begins = np.cumsum(counts) - counts
    held, place = _looked_up(hashes, words, slots)
    at = places[held]
    text = np.searchsorted(begins + counts, at, side="right")
    block = (at - begins[text]) // BLOCK
    later, earlier = np.minimum(block, passages[text] - 1), np.maximum(block - 1, 0)
    both = later != earlier
    passage = np.concatenate((firsts[text] + later, (firsts[text] + earlier)[both]))
    key = passage * len(words) + np.concatenate((place, place[both]))
    cells, number = np.unique(key, return_counts=True)
    return cells // max(len(words), 1), cells % max(len(words), 1), number, counts, passages, firsts


def _texts(batch: pa.RecordBatch, column: int) -> Iterator[tuple[int, list[bytes]]]:
    for begin, run in chunks(batch.column(column).to_pylist()):
        yield begin, [plain(text.decode()) for text in run]


def _summed(texts: DataFrame, start, add) -> np.ndarray:
    """Sum over all tasks of an array that ``add`` fills from the texts of a task.

    Tasks hand on the array's rows, which a grouping adds up.
    """
    ship(texts.sparkSession)

    def batches(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, seen = start(), False
        for batch in source:
            for _, run in _texts(batch, 0):
                add(total, run)
                seen = True
        filled = np.flatnonzero(total.any(axis=1)) if seen else np.zeros(0, np.int64)
        for begin in range(0, len(filled), 1024):
            rows = filled[begin : begin + 1024]
            yield pa.RecordBatch.from_arrays(
                [pa.array(rows), pa.array(list(total[rows].astype(np.float64)), pa.list_(pa.float64()))],
                names=["row", "cells"],
            )

    parts = texts.select("text").mapInArrow(batches, "row bigint, cells array<double>")
    width = start().shape[1]
    sums = [F.sum(F.get("cells", F.lit(at))).alias(f"c{at}") for at in range(width)]
    total = np.zeros((len(start()), width))
    table = parts.groupBy("row").agg(*sums).toArrow()  # one row per benchmark word
    if table.num_rows:
        total[table["row"].to_numpy()] = np.stack([table[f"c{at}"].to_numpy() for at in range(width)], axis=1)
    return total


def items_of(benchmark: DataFrame, id_col: str = "item_id", text_col: str = "text") -> list[tuple[object, str]]:
    """The items by id, those without id first; the benchmark is a table of questions, small beside any corpus."""
    rows = benchmark.select(named(id_col).alias("item_id"), named(text_col).alias("text")).filter("text IS NOT NULL")
    found = ((row["item_id"], row["text"]) for row in rows.toLocalIterator())
    return sorted(found, key=lambda item: (item[0] is not None, item[1] if item[0] is None else item[0], item[1]))


def build_index(texts: DataFrame, items: list[tuple[object, str]], rank: int = RANK, seed: int = 11) -> Index | None:
    """Weights and latent axes from all passages of (doc_id, text); None without any benchmark word."""
    worded = [(item, tuple(words_of(text))) for item, text in items]
    worded = [(item, words) for item, words in worded if words]
    vocabulary = sorted({word for _, words in worded for word in words})
    if not vocabulary:
        return None
    hashes, _ = word_hashes([word.encode() for word in vocabulary])
    order = np.argsort(hashes)
    words = hashes[order]
    place = {vocabulary[at]: row for row, at in enumerate(order)}
    slots = _slots(words)
    size = len(words)
    spelt = [np.array([words[place[word]] for word in own], dtype=np.uint64) for _, own in worded]
    item_pairs = [_paired(own, np.array([len(own)])) for own in spelt]
    pairs = np.unique(np.concatenate([mixed for mixed, _ in item_pairs]))
    pair_slots = _slots(pairs)

    def count(total, run):
        hashed = word_hashes(run)
        _, word, _, _, passages, _ = _word_cells(*hashed, words, slots)
        _, pair = _pair_cells(*hashed, pairs, pair_slots)
        total[:size, 0] += np.bincount(word, minlength=size)
        total[size, 0] += passages.sum()
        total[size + 1 :, 0] += np.bincount(pair, minlength=len(pairs))

    held = _summed(texts, lambda: np.zeros((size + 1 + len(pairs), 1)), count)[:, 0]
    frequency, passages, pair_frequency = held[:size], held[size], held[size + 1 :]
    weights = (1 + np.log((1 + passages) / (1 + frequency))).astype(np.float32)  # positive also in every passage
    rarest = [
        sorted(set(own), key=lambda word: (frequency[place[word]], word))[:ANSWER_WORDS] for _, own in worded
    ]
    kept = frequency <= COMMON * passages
    kept[[place[word] for own in rarest for word in own]] = True
    weights[~kept] = 0
    width = min(rank + OVERSAMPLED, size)
    noise = np.random.default_rng(seed).standard_normal((size, width)).astype(np.float32)

    def sketch(total, run):
        passage, word, number, *_ = _cells(run, words, slots)
        kept = weights[word] > 0
        passage, word = passage[kept], word[kept]
        if not len(passage):
            return
        value = (number[kept] * weights[word]).astype(np.float32)
        starts = np.flatnonzero(np.concatenate(([True], passage[1:] != passage[:-1])))
        lengths = np.sqrt(np.add.reduceat(value**2, starts))
        value /= np.repeat(lengths, np.diff(np.append(starts, len(value))))
        projected = np.add.reduceat(value[:, None] * noise[word], starts, axis=0)
        spread = value[:, None] * np.repeat(projected, np.diff(np.append(starts, len(value))), axis=0)
        by_word = np.argsort(word, kind="stable")
        word, spread = word[by_word], spread[by_word]
        edges = np.flatnonzero(np.concatenate(([True], word[1:] != word[:-1])))
        total[word[edges]] += np.add.reduceat(spread, edges, axis=0)

    gram = _summed(texts, lambda: np.zeros((size, width), dtype=np.float32), sketch)
    core = noise.T.astype(float) @ gram  # the sketched Gram matrix, for its eigenvectors
    values, vectors = np.linalg.eigh((core + core.T) / 2)
    good = values > max(values.max(), 0) * 1e-9
    whitened = gram @ (vectors[:, good] / np.sqrt(values[good]))
    axes = np.linalg.svd(whitened, full_matrices=False)[0][:, :rank] if good.any() else np.zeros((size, 1))
    found, owners = [], []
    parts = []
    holding, needed = [], []
    own_pairs = [
        _informative_pairs(np.searchsorted(pairs, mixed), first, own, rare, pair_frequency, COMMON * passages)
        for (mixed, first), (_, own), rare in zip(item_pairs, worded, rarest, strict=True)
    ]
    used = np.unique(np.concatenate(own_pairs)).astype(np.int64)
    for at, (item_id, own) in enumerate(worded):
        informative = sorted({place[word] for word in own if weights[place[word]] > 0})
        holding += [(word, at) for word in informative]
        holding += [(size + pair, at) for pair in np.searchsorted(used, own_pairs[at]).tolist()]
        needed.append(min(SHARED, len(informative)))
        parts.append(Item(item_id, own, frozenset(rarest[at])))
        step = 2 * BLOCK
        for begin in range(0, max(len(own) - BLOCK, 1), step):
            row = np.zeros(size)
            for word in own[begin : begin + step]:
                row[place[word]] += weights[place[word]]
            found.append(row @ axes)
            owners.append(at)
    vectors = _unit(np.array(found)).astype(np.float32)
    by_feature = np.array(sorted(holding), dtype=np.int64).reshape(-1, 2)
    ends = np.searchsorted(by_feature[:, 0], np.arange(size + len(used)), side="right")
    return Index(
        parts, words, weights, axes.astype(np.float32), vectors, np.array(owners), by_feature[:, 1], ends,
        np.array(needed), slots, pairs[used], _slots(pairs[used]),
    )


def _informative_pairs(pairs, firsts, words, rare, frequency, common) -> np.ndarray:
    """The pairs of an item that lead to it: those in few passages, and its rarest without any of its rarest words."""
    kept = pairs[frequency[pairs] <= max(common, FEW)]
    plain = np.array([word not in rare for word in words])
    # Pairs lie one gap after the other, each by the place of its first word.
    gaps = np.concatenate([np.full(max(len(words) - gap, 0), gap) for gap in PAIR_GAPS])
    others = np.unique(pairs[plain[firsts] & plain[firsts + gaps]])
    order = np.lexsort((others, frequency[others]))[:ANSWER_WORDS]
    return np.unique(np.concatenate([kept, others[order]])).astype(np.int64)


def _unit(rows: np.ndarray) -> np.ndarray:
    lengths = np.linalg.norm(rows, axis=1, keepdims=True)
    return np.divide(rows, lengths, out=np.zeros_like(rows), where=lengths > 1e-12)


def candidates(run: list[bytes], index: Index, cosine: float) -> list[tuple[int, int, int, float]]:
    """(text, first word, item, cosine) of passages that share enough features with an item."""
    hashed = word_hashes(run)
    passage, word, number, _, passages, firsts = _word_cells(*hashed, index.words, index.slots)
    kept = index.weights[word] > 0
    passage, word, number = passage[kept], word[kept], number[kept]
    pair_passage, pair = _pair_cells(*hashed, index.pairs, index.pair_slots)
    feature = np.concatenate((word, len(index.words) + pair))
    if not len(feature):
        return []
    # The features each passage shares with each item, from the lists of items by feature.
    begins = np.concatenate(([0], index.holder_ends[:-1]))
    lengths = (index.holder_ends - begins)[feature]
    offsets = np.repeat(begins[feature] - (np.cumsum(lengths) - lengths), lengths)
    items = index.holders[offsets + np.arange(lengths.sum())]
    holding = np.repeat(np.concatenate((passage, pair_passage)), lengths)
    pairs, shared = np.unique(holding * len(index.items) + items, return_counts=True)
    rows, items = pairs // len(index.items), pairs % len(index.items)
    close = shared >= index.needed[items] - 1
    rows, items, shared = rows[close], items[close], shared[close]
    if not len(rows):
        return []
    wanted, rows = np.unique(rows, return_inverse=True)
    kept = np.isin(passage, wanted)
    passage, word, number = np.searchsorted(wanted, passage[kept]), word[kept], number[kept]
    latent = np.zeros((len(wanted), index.axes.shape[1]), dtype=np.float32)  # 0 where only pairs are shared
    if len(passage):
        starts = np.flatnonzero(np.concatenate(([True], passage[1:] != passage[:-1])))
        value = (number * index.weights[word]).astype(np.float32)
        latent[passage[starts]] = _unit(np.add.reduceat(value[:, None] * index.axes[word], starts, axis=0))
    queries = np.flatnonzero(np.concatenate(([True], index.owners[1:] != index.owners[:-1])))
    near = np.zeros(len(rows), dtype=np.float32)
    for begin in range(0, len(wanted), PASSAGES_AT_ONCE):
        first, last = np.searchsorted(rows, (begin, begin + PASSAGES_AT_ONCE))
        best = np.maximum.reduceat(latent[begin : begin + PASSAGES_AT_ONCE] @ index.vectors.T, queries, axis=1)
        near[first:last] = best[rows[first:last] - begin, items[first:last]]
    kept = (shared >= index.needed[items]) | (near >= cosine)
    at, items, near = wanted[rows[kept]], items[kept], near[kept]
    texts = np.searchsorted(np.cumsum(passages), at, side="right")
    begins = (at - firsts[texts]) * BLOCK
    return sorted(zip(texts.tolist(), begins.tolist(), items.tolist(), near.astype(float).tolist(), strict=True))


def common_subsequence(first, second) -> int:
    """The length of the longest common subsequence, by bit operations on whole rows."""
    places: dict[str, int] = {}
    for at, word in enumerate(second):
        places[word] = places.get(word, 0) | 1 << at
    row, full = (1 << len(second)) - 1, (1 << len(second)) - 1
    for word in first:
        held = row & places.get(word, 0)
        row = (row + held | row - held) & full
    return len(second) - row.bit_count()


def _verdict(words: list[str], begin: int, item: Item, least: float) -> tuple[float, float]:
    """Share of the item in the common subsequence, and of its answer words, around a passage.

    Both are 0 where the words in common, in any order, show the first to be below ``least``.
    """
    stop = min(len(words), begin + 2 * BLOCK + len(item.words))
    begin = max(0, begin - len(item.words))
    near = words[begin:stop]
    held = set(near)
    if sum(word in held for word in item.words) / len(item.words) < least:
        return 0.0, 0.0
    return (
        common_subsequence(item.words, near) / len(item.words),
        sum(word in held for word in item.answer) / len(item.answer),
    )


def matches(
    docs: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_id_col: str = "item_id",
    item_text_col: str = "text",
    cosine: float = COSINE,
    rank: int = RANK,
    lcs_share: float = LCS_SHARE,
    answered_lcs_share: float = ANSWERED_LCS_SHARE,
    answer_share: float = ANSWER_SHARE,
) -> DataFrame:
    """(doc_id, item_id, begin, cosine, lcs_share, answer_share), one row per document row and item it holds.

    ``begin`` is the first word of the best passage. Of an item's passages the
    one with the largest shares counts, of equal ones the first. Null and empty
    texts and items hold nothing; null document and item ids are passed on; repeated
    rows give repeated results; an empty corpus or benchmark gives an empty
    result.
    """
    spark = docs.sparkSession
    texts = id_and_text(docs, id_col, text_col)
    kinds = texts.schema["doc_id"].dataType.simpleString(), benchmark.schema[item_id_col].dataType
    schema = (
        f"doc_id {kinds[0]}, item_id {kinds[1].simpleString()}, begin int, cosine double, lcs_share double, "
        "answer_share double"
    )
    index = build_index(texts, items_of(benchmark, item_id_col, item_text_col), rank)
    if index is None:
        return spark.createDataFrame([], schema)
    shared = spark.sparkContext.broadcast(index)  # bounded by the benchmark's words and items
    from pyspark.sql.pandas.types import to_arrow_type

    item_type = to_arrow_type(kinds[1])

    def batches(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for batch in source:
            owners, rows = [], []
            for begin, run in _texts(batch, 1):
                split: dict[int, list[str]] = {}
                best: dict[tuple[int, int], tuple] = {}
                for text, at, item, score in candidates(run, known, cosine):
                    if text not in split:
                        split[text] = [word.decode() for word in run[text].split()]
                    share, answered = _verdict(split[text], at, known.items[item], min(lcs_share, answered_lcs_share))
                    if share >= lcs_share or share >= answered_lcs_share and answered >= answer_share:
                        held = (share, answered, -at, score)
                        best[text, item] = max(best.get((text, item), held), held)
                for (text, item), (share, answered, at, score) in sorted(best.items()):
                    owners.append(begin + text)
                    rows.append((known.items[item].item_id, -at, score, share, answered))
            columns = list(zip(*rows, strict=True)) or [[]] * 5
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(pa.array(owners, pa.int64())),
                    pa.array(columns[0], item_type),
                    pa.array(columns[1], pa.int32()),
                    *(pa.array(column, pa.float64()) for column in columns[2:]),
                ],
                names=["doc_id", "item_id", "begin", "cosine", "lcs_share", "answer_share"],
            )

    return texts.mapInArrow(batches, schema)


def keep_clean(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", **options) -> DataFrame:
    """The rows of ``docs`` that hold no item of the benchmark, all columns as they were.

    Rows that share the id of a row with an item go too; rows without id stay.
    """
    held = written(matches(docs, benchmark, id_col, **options).select("doc_id"), "held")
    return without(docs, id_col, held, "doc_id")
