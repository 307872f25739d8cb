"""Nearest neighbours by inner product, through balanced posting lists.

Equal vectors become one class with the ids that could ever be an answer. A
bounded sample of the classes is cut into balanced clusters. Every class goes
into the list of its nearest centroid, and of further ones that are nearly as
near, so that a vector at a boundary is found from either side. The centroids
and their links form a graph in memory; a query walks it and selects the lists
whose centroids are at most a ratio farther than the nearest one. The ratio is
fitted on the sample, so that the lists hold the share ``RECALL`` of the true
neighbours there.

Lists and queries meet in blocks of bounded size. Long lists are dealt out over
several blocks by a hash, so neither a long list nor a much-asked one is one
task. Inner products are Euclidean distances after one more dimension makes all
vectors equally long.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corvane.llm.centroid_graph import CentroidGraph, balanced_clusters
from corvane.llm.tables import named, ship, written

NEAREST = 20
EVERY = 20  # rows whose id this divides are queries
LIST = 1024  # classes per list, as long as there are no more than LISTS of them
LISTS = 2048
SAMPLE_VALUES = 1 << 22  # numbers in the sample that the clusters are fitted on
EDGE, COPIES = 1.05, 3  # a vector also goes into lists up to EDGE times as far, COPIES lists at most
RECALL = 0.98  # of the sample's neighbours that the selected lists hold
JUDGES = 256  # vectors of the sample that the ratio is fitted with
FIRST = 2  # nearest lists, searched before the others
BLOCK = 512  # classes of a list, or queries of a list, in one block
SALTS = 16


@dataclass
class Index:
    """What is broadcast: at most LISTS centroids and their links."""

    graph: CentroidGraph
    longest: float  # largest length of a vector
    ratio: float
    sizes: np.ndarray | None = None  # classes in each list


def flat(column: pa.Array, rows: int) -> np.ndarray:
    """The lists of a column as the rows of a matrix."""
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(rows, -1)


def lengthened(vectors: np.ndarray, longest: float) -> np.ndarray:
    """One more entry makes every vector as long as the longest."""
    rest = np.maximum(longest**2 - (vectors**2).sum(axis=1), 0)
    return np.column_stack((vectors, np.sqrt(rest)))


def directed(queries: np.ndarray, longest: float) -> np.ndarray:
    """Queries of that length, which changes no order of inner products, and a zero entry."""
    scaled = queries * (longest / np.linalg.norm(queries, axis=1))[:, None]
    return np.column_stack((scaled, np.zeros(len(queries))))


def sound_vectors(rows: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(vec_id, vector), one row per id, of the vectors that take part (see :func:`nearest`)."""
    pairs = rows.select(named(id_col).alias("vec_id"), named(vector_col).alias("vector"))
    whole = F.forall("vector", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf"))))
    sound = pairs.filter(F.col("vec_id").isNotNull() & whole & F.exists("vector", lambda c: c != 0))
    lone = sound.groupBy("vec_id").agg(F.min("vector").alias("vector"))
    return written(lone, "vectors")


def classes_of(vectors: DataFrame, most: int) -> DataFrame:
    """(class, vector, ids) of different vectors, with the ``most`` smallest ids of each, ascending.

    The window drops later ids before the shuffle, so a vector that a third of
    all rows share is no more work than any other.
    """
    within = Window.partitionBy("vector").orderBy("vec_id")
    first = vectors.withColumn("place", F.row_number().over(within)).filter(F.col("place") <= most)
    grouped = first.groupBy("vector").agg(F.array_sort(F.collect_list("vec_id")).alias("ids"))
    return written(grouped.select(F.monotonically_increasing_id().alias("class"), "vector", "ids"), "classes")


def fit(classes: DataFrame, list_size: int = LIST, seed: int = 5) -> Index:
    """Clusters, graph and ratio from a sample of at most SAMPLE_VALUES numbers, chosen by a hash."""
    about = classes.agg(
        F.count(F.lit(1)).alias("rows"),
        F.max(F.size("vector")).alias("width"),
        F.max(F.aggregate("vector", F.lit(0.0), lambda sum_, c: sum_ + c.cast("double") ** 2)).alias("square"),
    ).first()
    longest = float(np.sqrt(about["square"]))
    room = max(1, SAMPLE_VALUES // about["width"])
    chosen = classes.select("vector")
    if about["rows"] > room:
        share = int(0.95 * room / about["rows"] * (1 << 30))
        chosen = classes.filter(F.pmod(F.xxhash64("class"), F.lit(1 << 30)) < share).select("vector").limit(room)
    table = chosen.toArrow().combine_chunks()  # at most ``room`` rows
    vectors = flat(table["vector"].combine_chunks(), table.num_rows)
    points = lengthened(vectors, longest)
    lists = min(LISTS, max(1, about["rows"] // list_size))
    graph = CentroidGraph.over(balanced_clusters(points, max(1, len(points) // lists), seed))
    return Index(graph, longest, _ratio(graph, points, vectors, longest, seed))


def _ratio(graph: CentroidGraph, points: np.ndarray, vectors: np.ndarray, longest: float, seed: int) -> float:
    """The distance ratio within which lists hold RECALL of the neighbours of some sampled vectors."""
    judges = np.random.default_rng(seed).choice(len(vectors), min(JUDGES, len(vectors)), replace=False)
    queries = directed(vectors[judges], longest)
    products = vectors[judges] @ vectors.T
    products[np.arange(len(judges)), judges] = -np.inf
    most = min(NEAREST, len(vectors) - 1)
    if most < 1:
        return 1.0
    neighbours = np.argpartition(-products, most - 1, axis=1)[:, :most]
    centres = graph.centroids.astype(float)
    apart = np.sqrt(((queries[:, None, :] - centres[None]) ** 2).sum(2)) if len(centres) <= 64 else np.sqrt(
        np.stack([((centres - query) ** 2).sum(1) for query in queries])
    )
    apart /= apart.min(axis=1, keepdims=True)
    known, place = np.unique(neighbours, return_inverse=True)
    rows, numbers = placements(graph, points[known])
    needed = np.full((len(known), len(judges)), np.inf)
    np.minimum.at(needed, rows, apart[:, numbers].T)
    wanted = needed[place.reshape(neighbours.shape), np.arange(len(judges))[:, None]]
    return float(np.quantile(wanted, RECALL))


def placements(graph: CentroidGraph, points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(point, list) of the lists that hold each point."""
    rows, numbers, distances = graph.near(points, 1, EDGE)
    firsts = np.searchsorted(rows, rows)
    kept = np.arange(len(rows)) - firsts < COPIES
    return rows[kept], numbers[kept]


def postings(classes: DataFrame, index: Index) -> DataFrame:
    """(list, class, first: its smallest id, vector) of every class, once per list that holds it."""
    ship(classes.sparkSession)
    shared = classes.sparkSession.sparkContext.broadcast(index)
    kinds = dict(classes.dtypes)

    def batches(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for batch in source:
            if batch.num_rows:
                points = lengthened(flat(batch.column(2), batch.num_rows), known.longest)
                rows, numbers = placements(known.graph, points)
                held = batch.take(pa.array(rows))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(numbers.astype(np.int32)), *held.columns], names=["list", "class", "first", "vector"]
                )

    rows = classes.select("class", F.get("ids", F.lit(0)).alias("first"), "vector")
    first = dict(rows.dtypes)["first"]
    return rows.mapInArrow(batches, f"list int, class bigint, first {first}, vector {kinds['vector']}")


def selections(asked: DataFrame, index: Index, least: int) -> DataFrame:
    """(list, query, place, vector) of every query, once per list selected for it, ``place`` counting its lists.

    Lists are taken in order of distance up to the ratio, and on until they
    hold ``least`` entries.
    """
    shared = asked.sparkSession.sparkContext.broadcast(index)

    def batches(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for batch in source:
            if not batch.num_rows:
                continue
            points = directed(flat(batch.column(1), batch.num_rows), known.longest)
            reach = 1
            while True:  # more lists where the nearest ones are short
                rows, numbers, _ = known.graph.near(points, reach, known.ratio)
                held = np.bincount(rows, weights=known.sizes[numbers], minlength=len(points))
                if held.min() >= least or reach >= len(known.sizes):
                    break
                reach = min(2 * reach, len(known.sizes))
            taken = batch.take(pa.array(rows))
            place = (np.arange(len(rows)) - np.searchsorted(rows, rows)).astype(np.int32)
            columns = [pa.array(numbers.astype(np.int32)), taken.column(0), pa.array(place), taken.column(1)]
            yield pa.RecordBatch.from_arrays(columns, names=["list", "query", "place", "vector"])

    return asked.select("query", "vector").mapInArrow(
        batches, f"list int, query bigint, place int, vector {dict(asked.dtypes)['vector']}"
    )


def _blocks(rows: DataFrame, key: str, sizes: DataFrame, name: str, *fields: str) -> DataFrame:
    """(list, block, ``name``: an array of the rows) with about BLOCK rows in each array."""
    several = F.ceil(F.col("size") / BLOCK)
    dealt = rows.join(sizes, "list").withColumn("block", F.pmod(F.xxhash64(key), several).cast("int"))
    return dealt.groupBy("list", "block").agg(F.collect_list(F.struct(*fields)).alias(name))


def in_order(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """Inner products of the rows of two matrices, added up entry by entry in double precision."""
    total = np.zeros(len(first))
    for at in range(first.shape[1]):
        total += first[:, at] * second[:, at]
    return total


def _best_in_block(
    queries: np.ndarray, vectors: np.ndarray, bounds: np.ndarray, most: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query, vector, score) of the ``most`` largest inner products of each query that reach its bound, ties included."""
    rough = queries @ vectors.T
    place = max(rough.shape[1] - most, 0)
    least = np.maximum(np.partition(rough, place, axis=1)[:, place], bounds)
    slack = 1e-12 * np.linalg.norm(queries, axis=1) * np.linalg.norm(vectors, axis=1).max()
    rows, columns = np.nonzero(rough >= (least - slack)[:, None])
    scores = in_order(queries[rows], vectors[columns])
    reached = scores >= bounds[rows]
    return rows[reached], columns[reached], scores[reached]


def searched(posted: DataFrame, selected: DataFrame, most: int) -> DataFrame:
    """(query, class, first, score): of every block the ``most`` best that reach the query's ``bound``."""
    sizes = posted.groupBy("list").agg(F.count(F.lit(1)).alias("size"))
    asked = selected.groupBy("list").agg(F.count(F.lit(1)).alias("size"))
    lists = _blocks(posted, "class", sizes, "entries", "class", "first", "vector").drop("block")
    questions = _blocks(selected, "query", asked, "questions", "query", "bound", "vector").drop("block")
    # Blocks are large rows: merged after a shuffle, never broadcast, and split where a list is hot.
    met = lists.hint("merge").join(questions, "list").select("entries", "questions")
    first = dict(posted.dtypes)["first"]

    def batches(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in source:
            for at in range(batch.num_rows):
                entries, questions = batch.column(0)[at].values, batch.column(1)[at].values
                vectors = flat(entries.field("vector"), len(entries))
                asked = flat(questions.field("vector"), len(questions))
                bounds = questions.field("bound").to_numpy(zero_copy_only=False)
                rows, columns, scores = _best_in_block(asked, vectors, bounds, most)
                columns = pa.array(columns)
                yield pa.RecordBatch.from_arrays(
                    [
                        questions.field("query").take(pa.array(rows)),
                        entries.field("class").take(columns),
                        entries.field("first").take(columns),
                        pa.array(scores),
                    ],
                    names=["query", "class", "first", "score"],
                )

    return met.mapInArrow(batches, f"query bigint, class bigint, first {first}, score double")


def _top(rows: DataFrame, tie: str, most: int) -> DataFrame:
    """Of each query the ``most`` rows of largest score, ties to the smallest ``tie``."""
    order = Window.partitionBy("query").orderBy(F.desc("score"), F.asc(tie))
    return rows.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= most)


def _in_two_rounds(posted: DataFrame, selected: DataFrame, most: int) -> DataFrame:
    """:func:`searched` over all selected lists.

    The ``most``-th best score in a query's FIRST nearest lists is a bound that
    answers from its other lists have to reach, so few rows leave their blocks.
    """
    early = selected.filter(F.col("place") < FIRST).withColumn("bound", F.lit(float("-inf")))
    early = written(searched(posted, early, most), "early")
    ranked = _top(early.distinct(), "first", most)
    bounds = ranked.filter(F.col("place") == most).select("query", F.col("score").alias("bound"))
    late = selected.filter(F.col("place") >= FIRST).join(bounds, "query", "left")
    late = late.withColumn("bound", F.coalesce("bound", F.lit(float("-inf"))))
    return early.unionByName(searched(posted, late, most))


def nearest(
    rows: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    most: int = NEAREST,
    every: int = EVERY,
    list_size: int = LIST,
) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``most`` nearest found of each row whose id ``every`` divides.

    Nearness is the inner product of the original vectors in double precision,
    ties go to the smaller id. A query's own id is no answer; with fewer other
    rows there are fewer answers. Rows without an id, vectors that are null or
    zero or hold null or non-finite entries, and those of another length than
    most (of equally frequent lengths the larger counts) take no part. Rows
    that share an id count as one, with the smallest vector. An empty table
    gives an empty result.
    """
    spark = rows.sparkSession
    vectors = sound_vectors(rows, id_col, vector_col)
    widths = vectors.groupBy(F.size("vector").alias("width")).count().orderBy(F.desc("count"), F.desc("width")).limit(2)
    widths = widths.collect()
    kind = dict(vectors.dtypes)["vec_id"]
    if not widths:
        return spark.createDataFrame([], f"query_id {kind}, rank int, vec_id {kind}, score double")
    if len(widths) > 1:
        vectors = vectors.filter(F.size("vector") == widths[0]["width"])
    classes = classes_of(vectors, most + 1)
    index = fit(classes, list_size)
    posted = written(postings(classes, index), "postings")
    sizes = posted.groupBy("list").count().toArrow()  # one row per list
    index.sizes = np.zeros(len(index.graph.centroids))
    index.sizes[sizes["list"].to_numpy()] = sizes["count"].to_numpy()
    queries = vectors.filter(F.col("vec_id") % every == 0)
    asked = written(queries.select("vector").distinct().select(F.monotonically_increasing_id().alias("query"), "vector"),
                    "asked")
    selected = written(selections(asked, index, COPIES * (most + 1)), "selected")
    found = written(_in_two_rounds(posted, selected, most + 1), "found").distinct()
    best = _top(found, "first", most + 1).join(classes.select("class", "ids"), "class")
    hits = _top(best.select("query", "score", F.explode("ids").alias("vec_id")), "vec_id", most + 1)
    hits = hits.groupBy("query").agg(F.array_sort(F.collect_list(F.struct("place", "vec_id", "score"))).alias("hits"))
    answered = written(hits.join(asked, "query").select("vector", "hits"), "answered")
    salted = answered.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    own = queries.select(F.col("vec_id").alias("query_id"), "vector").withColumn(
        "salt", F.pmod(F.xxhash64("query_id"), F.lit(SALTS)).cast("int")
    )
    others = F.filter("hits", lambda hit: hit["vec_id"] != F.col("query_id"))
    ranked = own.join(salted, ["vector", "salt"]).select(
        "query_id", F.posexplode(F.slice(others, 1, most)).alias("rank", "hit")
    )
    return ranked.select("query_id", (F.col("rank") + 1).alias("rank"), F.col("hit.vec_id"), F.col("hit.score"))
