"""Near-duplicates by SuperMinHash, banding, verification and distributed union-find.

SuperMinHash draws, for each element, one random permutation of the slots and
gives its j-th slot a value in [j, j + 1): the ranks of one element are
correlated, which lowers the variance, and once every slot holds a value no
later j can lower any, so most sets stop after one or two steps.

Texts with equal sets form one class, and only classes are compared. Classes
that share a band key are candidates. No pairs are listed within a bucket: its
members are compared to one pivot, and what that comparison tells bounds the
similarity of any two members. Members that the pivot says little about meet
pivots of their own first (:func:`rest_buckets`), so that only few further pairs
have to be compared (:func:`open_pairs`). Every link is confirmed on the full sets.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corvane.llm.bloom import bloom_of, integers, without
from corvane.llm.components import components, first_groups
from corvane.llm.shingles import chunks, mixed, shingle_sets
from corvane.llm.tables import id_and_text, ship, written

BANDS, ROWS = 24, 4
LARGE, COMMON_SHARE = 16, 20  # members of a large group; a shingle is common when one in so many holds it
RESTS = 4  # buckets of a member apart from its pivot
ASKED = 100  # members of a large group that are asked what is common in it
Measure = Callable[[DataFrame], DataFrame]
_EMPTY = np.uint64(0xFFFFFFFFFFFFFFFF)


def super_minhash(elements: np.ndarray, sizes: np.ndarray, slots: int) -> np.ndarray:
    """One row of ``slots`` values per set; an empty set keeps the largest value in each.

    ``elements`` holds the sets one after the other, ``sizes`` their lengths.
    A value holds the step j in its upper and the random fraction in its lower
    32 bits. All sets go through step j together; a set leaves when each of
    its slots is filled.
    """
    count = len(sizes)
    found = np.full(count * slots, _EMPTY, dtype=np.uint64)
    if not len(elements):
        return found.reshape(count, slots)
    owners = np.repeat(np.arange(count), sizes)
    order = None
    for step in range(slots):
        drawn = mixed(elements + np.uint64((step + 1) * 0x9E3779B97F4A7C15 % (1 << 64)))
        chosen = step + (
            ((drawn & np.uint64(0xFFFFFFFF)) * np.uint64(slots - step)) >> np.uint64(32)
        ).astype(np.int64)
        if order is None:
            slot = chosen
        else:
            rows = np.arange(len(elements))
            slot = order[rows, chosen].astype(np.int64)
            order[rows, chosen] = order[:, step]
            order[:, step] = slot
        values = (drawn >> np.uint64(32)) | np.uint64(step << 32)
        np.minimum.at(found, owners * slots + slot, values)
        unfilled = (found.reshape(count, slots) == _EMPTY).any(axis=1)
        going = unfilled[owners]
        if not going.any():
            break
        if order is None:
            first = slot[going]
            order = np.tile(np.arange(slots, dtype=np.uint16), (len(first), 1))
            order[np.arange(len(first)), first] = 0
            order[:, 0] = first
        elif not going.all():
            order = order[going]
        elements, owners = elements[going], owners[going]
    return found.reshape(count, slots)


def band_keys(signatures: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """One 64-bit key per set and band."""
    keys = np.empty((len(signatures), bands), dtype=np.uint64)
    for band in range(bands):
        key = np.full(len(signatures), band + 1, dtype=np.uint64)
        for row in range(rows):
            key = mixed(key * np.uint64(0x9E3779B97F4A7C15) + signatures[:, band * rows + row])
        keys[:, band] = key
    return keys.view(np.int64)


def _by_chunk(rows: DataFrame, fields: list[tuple[str, str]], build) -> DataFrame:
    """``build`` turns a list of texts into the arrays of ``fields``; doc_id is passed on."""
    ship(rows.sparkSession)
    names = ["doc_id", *(name for name, _ in fields)]

    def batches(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in source:
            for begin, texts in chunks(batch.column(1).to_pylist()):
                own = batch.column(0).slice(begin, len(texts))
                yield pa.RecordBatch.from_arrays([own, *build(texts)], names=names)

    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(batches, ", ".join([f"doc_id {kind}", *(f"{name} {of}" for name, of in fields)]))


def _list_array(matrix: np.ndarray) -> pa.Array:
    offsets = np.arange(0, matrix.size + 1, matrix.shape[1], dtype=np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(matrix.reshape(-1)))


def signatures(texts: DataFrame, width: int, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """(doc_id, n_shingles, digest of the set, keys: one per band) of (doc_id, text)."""

    def build(run):
        sets = shingle_sets(run, width)
        digests = [hashlib.blake2b(each.tobytes(), digest_size=16).digest() for each in sets]
        sizes = np.array([len(each) for each in sets], dtype=np.int64)
        keys = band_keys(super_minhash(np.concatenate(sets), sizes, bands * rows), bands, rows)
        return [
            pa.array(sizes),
            pa.array(digests, pa.binary()),
            _list_array(keys),
        ]

    fields = [("n_shingles", "bigint"), ("digest", "binary"), ("keys", "array<bigint>")]
    return _by_chunk(texts, fields, build)


def full_sets(texts: DataFrame, wanted: DataFrame, width: int) -> DataFrame:
    """(doc_id, shingles: the full set as hashes) of the texts whose ids are in ``wanted``.

    A Bloom filter of the ids leaves most other texts where they are read; the
    join then takes out the rest.
    """
    files = texts.sparkSession.sparkContext.broadcast(bloom_of(wanted, "doc_id"))
    ship(texts.sparkSession)

    def batches(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in source:
            batch = batch.filter(pa.compute.is_valid(batch.column(0)))
            batch = batch.filter(pa.array(files.value.holds(integers(batch.column(0))), pa.bool_()))
            for begin, run in chunks(batch.column(1).to_pylist()):
                sets = shingle_sets(run, width)
                offsets = np.concatenate(([0], np.cumsum([len(each) for each in sets]))).astype(np.int32)
                values = np.concatenate(sets).view(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(begin, len(run)),
                        pa.ListArray.from_arrays(pa.array(offsets), pa.array(values)),
                    ],
                    names=["doc_id", "shingles"],
                )

    kind = texts.schema["doc_id"].dataType.simpleString()
    found = texts.mapInArrow(batches, f"doc_id {kind}, shingles array<bigint>").filter(F.size("shingles") > 0)
    return found.join(wanted, "doc_id", "left_semi")


def measured_sets(pairs: DataFrame) -> DataFrame:
    """Replaces the sets ``own`` and ``other`` of pairs by n and m, their sizes, i, that of
    their intersection, and ``rare``: what is only in ``own``, sorted."""
    kept = [name for name in pairs.columns if name not in ("own", "other")]
    return pairs.select(
        *kept,
        F.size("own").alias("n"),
        F.size("other").alias("m"),
        F.size(F.array_intersect("own", "other")).alias("i"),
        F.array_sort(F.array_except("own", "other")).alias("rare"),
    )


def confirmed(pairs: DataFrame, content: DataFrame, percent: int, measure: Measure = measured_sets) -> DataFrame:
    """The pairs (a, b) whose full sets have an intersection of ``percent`` percent of the union."""
    first = content.select(F.col("doc_id").alias("a"), F.col("content").alias("own"))
    second = content.select(F.col("doc_id").alias("b"), F.col("content").alias("other"))
    sized = measure(pairs.join(first, "a").join(second, "b").select("a", "b", "own", "other"))
    return sized.filter(f"100 * i >= {percent} * (n + m - i)").select("a", "b")


def pivots_of(buckets: DataFrame) -> DataFrame:
    """(pivot, doc_id) of every member of a bucket (key, doc_id) and the bucket's pivot.

    Buckets that come with ``members``, their size, are not counted again.

    The pivot is the member whose buckets are largest together: in a group of
    edited copies that is a text close to what they were made from.
    """
    if "members" not in buckets.columns:
        buckets = buckets.join(buckets.groupBy("key").agg(F.count(F.lit(1)).alias("members")), "key")
    weights = buckets.groupBy("doc_id").agg(F.sum("members").alias("weight"))
    weighed = written(buckets.select("key", "doc_id").join(weights, "doc_id"), "weighed")
    chosen = weighed.groupBy("key").agg(F.max(F.struct("weight", "doc_id")).alias("top"))
    met = weighed.join(chosen.select("key", F.col("top.doc_id").alias("pivot")), "key")
    return met.filter("doc_id <> pivot").select("pivot", "doc_id").distinct()


def compared(pairs: DataFrame, content: DataFrame, measure: Measure = measured_sets) -> DataFrame:
    """(pivot, doc_id) with n and m, the sizes of the member's and the pivot's set, i of
    their intersection, and ``rare``: the member's shingles that the pivot lacks, sorted.
    """
    member = content.select("doc_id", F.col("content").alias("own"))
    pivot = content.select(F.col("doc_id").alias("pivot"), F.col("content").alias("other"))
    return measure(pairs.join(member, "doc_id").join(pivot, "pivot").select("pivot", "doc_id", "own", "other"))


def _per_pivot(rows: DataFrame, *results) -> DataFrame:
    """One row per pivot. The second key follows from the first; it makes a join by the pivot
    shuffle both sides anew, so that adaptive execution can split a large group there."""
    return rows.groupBy("pivot", F.pmod(F.xxhash64("pivot"), F.lit(2)).alias("half")).agg(*results).drop("half")


def _widened(tagged: DataFrame) -> DataFrame:
    """The members with i and ``rare`` against their pivot and what many members hold beside it.

    What :func:`open_pairs` concludes holds for any set of shingles in the
    pivot's place. In a large group of edited copies the pivot lacks some of
    what they were made from, which all others share; with those shingles added, what
    is left over are the members' own edits. About ``ASKED`` members per pivot
    are enough to tell what is common; which set comes out only matters for speed.
    So does the order of ``rare``, which is the same for all members of a pivot:
    what no two of these members share comes first, then the rarer before the
    more frequent, so that prefixes have little in common by chance.
    """
    large = _per_pivot(tagged, F.count(F.lit(1)).alias("members")).filter(f"members >= {LARGE}")
    large = large.withColumn("every", F.expr(f"greatest(1, members div {ASKED})"))
    asked = tagged.join(large, "pivot").filter("pmod(xxhash64(doc_id), every) = 0")
    held = asked.select("pivot", "members", "every", F.explode("rare").alias("shingle"))
    held = (
        held.groupBy("pivot", "shingle")
        .agg(F.count(F.lit(1)).alias("holders"), F.max("members").alias("members"), F.max("every").alias("every"))
        .filter("holders > 1")
        .withColumn("common", F.expr(f"{COMMON_SHARE} * holders * every >= members"))
    )
    told = _per_pivot(  # at most the lists of the members asked
        held,
        F.collect_list(F.expr("CASE WHEN common THEN shingle END")).alias("hot"),
        F.array_sort(F.collect_list(F.expr("CASE WHEN NOT common THEN struct(holders, shingle) END"))).alias("known"),
    )
    told = told.withColumn("known", F.transform("known", lambda each: each["shingle"]))
    asked = tagged.join(told, "pivot", "left").withColumn("told", F.col("hot").isNotNull())
    return (
        asked.withColumn("left_over", F.expr("CASE WHEN told THEN array_except(rare, hot) ELSE rare END"))
        .withColumn("i", F.expr("i + size(rare) - size(left_over)"))
        .withColumn(
            "rare",
            F.when(
                F.col("told"), F.concat(F.array_except("left_over", "known"), F.array_intersect("known", "left_over"))
            ).otherwise(F.col("left_over")),
        )
        .drop("hot", "known", "left_over", "told")
    )


def _tagged(stats: DataFrame, groups: DataFrame) -> DataFrame:
    """The members with ``own``, their group, and ``apart``, whether their pivot is in another one."""
    group = groups.select(F.col("node").alias("doc_id"), "component")
    of_pivot = groups.select(F.col("node").alias("pivot"), F.col("component").alias("pivot_group"))
    return (
        stats.join(group, "doc_id", "left")
        .join(of_pivot, "pivot", "left")
        .withColumn("own", F.coalesce("component", "doc_id"))
        .withColumn("apart", F.col("own") != F.coalesce("pivot_group", "pivot"))
        .select("pivot", "doc_id", "n", "i", "rare", "own", "apart")
    )


def rest_buckets(stats: DataFrame, groups: DataFrame) -> DataFrame:
    """(key, doc_id) of the members apart from their pivot, by MinHash of what the pivot lacks.

    A family of copies beside the pivot's own shares most of that. Its members meet a
    pivot of their own in such a bucket, and few pairs of them are left open.
    """
    apart = _tagged(stats, groups).filter("apart AND size(rare) > 0")
    least = [F.array_min(F.transform("rare", lambda rest, at=at: F.xxhash64(rest, F.lit(at)))) for at in range(RESTS)]
    keys = [F.xxhash64("pivot", F.lit(at), key) for at, key in enumerate(least)]
    return apart.select(F.explode(F.array(*keys)).alias("key"), "doc_id").distinct()


def open_pairs(stats: DataFrame, groups: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) of members of one pivot that may be linked, lie in different groups and
    have not been compared.

    Linked members x and y of pivot p have at least need = percent / (100 +
    percent) * (n_x + n_y) shingles in common, at most min(i_x, i_y) of them
    such that p holds. If they share any that p lacks, they share at least s =
    need - min(i_x, i_y) of these. Two lists of o and o' shingles under one
    order that share s of them share one among the first o - s + 1 and o' - s + 1.
    No list of linked sets has to be read further than the prefix of
    n - ceil(n * percent / 100) + 1. If they share none that p lacks, min(i_x, i_y)
    alone reaches the need. At least one of two members in different groups is
    outside the pivot's group, and only such members are looked up.
    """
    tagged = written(_widened(written(_tagged(stats, groups), "compared")), "widened")
    sizes = _per_pivot(tagged, F.count(F.lit(1)).alias("members"), F.max("apart").alias("some_apart"))
    several = sizes.filter("members > 1 AND some_apart").select("pivot")
    prefix = f"cast(n - ceil(n * {percent} / 100) + 1 as int)"
    listed = tagged.join(several, "pivot").select(
        "pivot", "doc_id", "n", "i", "own", "apart",
        F.posexplode(F.expr(f"slice(rare, 1, {prefix})")).alias("place", "shingle"),
    )
    held = listed.select(
        "pivot", "shingle", F.col("doc_id").alias("y"), F.col("n").alias("y_n"), F.col("i").alias("y_i"),
        F.col("own").alias("y_own"), F.col("place").alias("y_place"),
    )
    fits = f"own <> y_own AND doc_id <> y AND 100 * least(n, y_n) >= {percent} * greatest(n, y_n)"
    shared = f"greatest(1, ceil({percent} * (n + y_n) / {100 + percent}) - least(i, y_i))"
    first = f"place + {shared} <= n - i AND y_place + {shared} <= y_n - y_i"
    by_shingle = (
        listed.filter("apart")
        .join(held, ["pivot", "shingle"])
        .filter(f"{fits} AND {first}")
        .select("doc_id", "y")
        .distinct()
    )
    inside = tagged.filter(f"100 * i >= {percent} * n").drop("rare")
    kinds = inside.groupBy("pivot", "n", "i").agg(F.max("apart").alias("some_apart"))
    other = kinds.select("pivot", F.col("n").alias("y_n"), F.col("i").alias("y_i"))
    fitting = (
        kinds.filter("some_apart")
        .join(other, "pivot")
        .filter(f"100 * least(i, y_i) >= {percent} * (n + y_n - least(i, y_i))")
        .select("pivot", "n", "i", "y_n", "y_i")
    )
    members = inside.select(
        "pivot", F.col("n").alias("y_n"), F.col("i").alias("y_i"), F.col("doc_id").alias("y"), F.col("own").alias("y_own"),
    )
    by_size = (
        inside.filter("apart")
        .join(fitting, ["pivot", "n", "i"])
        .join(members, ["pivot", "y_n", "y_i"])
        .filter(fits)
        .select("doc_id", "y")
    )
    pairs = by_shingle.unionByName(by_size)
    return pairs.select(F.least("doc_id", "y").alias("a"), F.greatest("doc_id", "y").alias("b")).distinct()


def link_buckets(
    buckets: DataFrame, content: DataFrame, percent: int, measure: Measure = measured_sets
) -> DataFrame:
    """Confirmed links (a, b), enough to join all that are linked within a bucket (key, doc_id).

    ``content`` holds (doc_id, content); ``measure`` compares two contents.
    """
    stats = written(compared(written(pivots_of(buckets), "pivots"), content, measure), "stats")

    def linked(rows: DataFrame) -> DataFrame:
        ends = F.least("pivot", "doc_id").alias("a"), F.greatest("pivot", "doc_id").alias("b")
        return rows.filter(f"100 * i >= {percent} * (n + m - i)").select(*ends)

    groups = written(first_groups(linked(stats)), "groups")
    families = written(rest_buckets(stats, groups), "family-buckets")
    again = compared(written(pivots_of(families), "family-pivots"), content, measure)
    links = written(linked(stats).unionByName(linked(again)), "pivot-links")
    known = groups.select(F.col("component").alias("a"), F.col("node").alias("b"))
    pairs = written(open_pairs(stats, written(first_groups(links.unionByName(known)), "families"), percent), "pairs")
    return links.unionByName(confirmed(pairs, content, percent, measure))


def link_classes(classes: DataFrame, texts: DataFrame, width: int, percent: int) -> DataFrame:
    """Confirmed links (a, b) between classes (doc_id, keys), enough to join all that are linked."""
    exploded = classes.select(F.explode("keys").alias("key"), "doc_id")
    shared = exploded.groupBy("key").agg(F.count(F.lit(1)).alias("members")).filter("members > 1")
    buckets = written(exploded.join(shared, "key"), "buckets")
    sets = written(full_sets(texts, buckets.select("doc_id").distinct(), width), "sets")
    return link_buckets(buckets, sets.withColumnRenamed("shingles", "content"), percent)


def near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    width: int = 5,
    percent: int = 80,
) -> DataFrame:
    """Per row: doc_id, n_shingles, component_id and kept.

    Two texts are linked when the intersection of their sets of ``width``-word
    shingles is at least ``percent`` percent of the union. ``component_id`` is
    the smallest id reachable over links, ``kept`` marks that row. A text with
    fewer words is one shingle; null texts and texts without words have an
    empty set and no link. A null id has no links, a null ``component_id`` and
    is kept. Rows that share an id count as one node with the links of each;
    an empty table gives an empty result.
    """
    texts = id_and_text(docs, id_col, text_col)
    signed = written(signatures(texts, width), "signatures")
    whole = signed.filter("n_shingles > 0 AND doc_id IS NOT NULL")
    classes = written(
        whole.groupBy("n_shingles", "digest")
        .agg(F.min("doc_id").alias("doc_id"), F.any_value("keys").alias("keys")),
        "classes",
    )
    links = link_classes(classes, texts, width, percent)
    same = whole.select("doc_id", "n_shingles", "digest").join(
        classes.select("n_shingles", "digest", F.col("doc_id").alias("rep")), ["n_shingles", "digest"]
    )
    if not whole.groupBy("doc_id").count().filter("count > 1").isEmpty():
        # An id with several texts belongs to several classes, and joins them.
        members = same.filter("doc_id <> rep").select(F.col("rep").alias("a"), F.col("doc_id").alias("b"))
        links = links.unionByName(members)
    found = components(links).select(F.col("node").alias("rep"), "component")
    placed = same.join(found, "rep", "left").select(
        "doc_id", "n_shingles", F.coalesce("component", "rep").alias("component_id")
    )
    alone = signed.filter("n_shingles = 0 OR doc_id IS NULL").select(
        "doc_id", "n_shingles", F.col("doc_id").alias("component_id")
    )
    return placed.unionByName(alone).select(
        "doc_id", "n_shingles", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept")
    )


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` that stay, one per component, all columns as they were.

    Rows without an id stay; rows that share an id stay or go together.
    """
    gone = written(near_duplicates(docs, id_col, text_col, **options).filter("NOT kept").select("doc_id"), "near")
    return without(docs, id_col, gone, "doc_id")
