"""Exact duplicates by salted, three-stage combining of full texts.

Each map task first merges its own equal texts, tasks that share a salt merge
theirs, and the salt winners of one text meet last. Every stage groups by the
digest and by the text itself, so texts that merely share a digest stay apart.
Hot texts shrink before each shuffle; no group is ever collected.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corvane.llm.tables import id_and_text, named, written

SALTS = 16


def sha256_hex(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


def winners(keyed: DataFrame, salts: int = SALTS) -> DataFrame:
    """One row (digest, keep_id, group_size) per distinct text of (doc_id, text, digest)."""
    salted = (
        keyed.groupBy("digest", "text", F.pmod(F.xxhash64("doc_id"), F.lit(salts)).alias("salt"))
        .agg(F.max("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("rows"))
    )
    return (
        salted.groupBy("digest", "text")
        .agg(F.max("keep_id").alias("keep_id"), F.sum("rows").alias("group_size"))
        .select("digest", "keep_id", "group_size")
    )


def memberships(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    normalise: Callable[[Column], Column] = lambda text: text,
    digest: Callable[[Column], Column] = sha256_hex,
    salts: int = SALTS,
) -> DataFrame:
    """For each row: doc_id, keep_id, group_size, kept and the digest of its text.

    Rows are equal when their texts are identical after ``normalise``; of equal
    rows the largest id stays. A null text counts as empty, empty texts equal
    each other. A null id never wins over another id; a group of null ids only
    has a null ``keep_id`` and keeps its rows. Rows repeated with the same id
    and text each count in ``group_size`` and get the same answer. An empty
    table gives an empty result.
    """
    keyed = id_and_text(docs, id_col, text_col).withColumn("text", F.coalesce(normalise(F.col("text")), F.lit("")))
    keyed = keyed.withColumn("digest", digest(F.col("text")))
    groups = written(winners(keyed, salts), "exact-groups")
    shared = groups.groupBy("digest").count().filter("count > 1").select("digest")
    rows = keyed.select("doc_id", "digest")
    if shared.isEmpty():
        joined = rows.join(groups, "digest")
    else:
        clashing = keyed.join(shared, "digest", "left_semi")
        exact = clashing.groupBy("digest", "text").agg(
            F.max("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size")
        )
        joined = (
            rows.join(groups.join(shared, "digest", "left_anti"), "digest")
            .select("doc_id", "digest", "keep_id", "group_size")
            .unionByName(
                clashing.join(exact, ["digest", "text"]).select("doc_id", "digest", "keep_id", "group_size")
            )
        )
    return joined.select(
        "doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), "digest"
    )


def keep_one(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    normalise: Callable[[Column], Column] = lambda text: text,
    digest: Callable[[Column], Column] = sha256_hex,
    salts: int = SALTS,
) -> DataFrame:
    """One row of ``docs`` per distinct text, that of the largest id, all columns as they were.

    Whole rows go through the stages of :func:`winners`. Null and empty texts
    count as equal; rows that share text and id leave one row, the largest by
    its other columns; a row without id stays only if no row with one is equal.
    """
    body = F.coalesce(normalise(F.coalesce(named(text_col), F.lit(""))), F.lit(""))
    whole = F.struct(*map(named, docs.columns))
    rank = F.struct(named(id_col).alias("id"), whole.alias("row"))
    keyed = docs.select(body.alias("body"), rank.alias("rank")).withColumn("digest", digest(F.col("body")))
    salt = F.pmod(F.xxhash64("rank.id"), F.lit(salts)).alias("salt")
    merged = keyed.groupBy("digest", "body", salt).agg(F.max("rank").alias("rank"))
    return merged.groupBy("digest", "body").agg(F.max("rank").alias("rank")).select("rank.row.*")
