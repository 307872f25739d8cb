"""Phrase collocations by SETM: occurrence relations that are merge-joined, counted and thinned out.

The relation of length k holds (row, spot, id): a phrase of k words that is
frequent in its language begins at that spot of that row. Spots number the
words of a text and skip one where a piece ends, so words of one piece are
neighbours and words of two never are. Relations are written bucketed by row
and sorted by row and spot. Neighbouring phrases of k words that overlap in all
but one make the phrases of k + 1, which is a merge join of the relation with
itself that shuffles nothing. Its groups are counted, and a semi-join with
those that are frequent gives the relation of length k + 1.

Texts are shuffled once, to their buckets; after that only counts are.
"""

from __future__ import annotations

import string
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from corvane.llm.tables import named, written
from corvane.scratch import new_folder, remove_folder

LONGEST, LEAST, SHARE, TOP = 3, 10, 50, 2000
BROADCAST_ROWS = 1 << 20  # of a table of frequent phrases, some 100 MB; larger ones are merge-joined
SALTS = 64
_PIECE_END = "\n"
_PIECE_ENDS = r"[.,;:!?\x0A-\x0D]"
_GAPS = r"[\x20\x09]+"
# One bucket per task, merged as it was sorted: a join on row and spot needs no more than the buckets by row.
_MERGED = {
    "spark.sql.requireAllClusterKeysForCoPartition": "false",
    "spark.sql.legacy.bucketedTableScan.outputOrdering": "true",
}
COUNT = "decimal(18,0)"


@contextmanager
def _settings(spark: SparkSession, values: dict[str, str]) -> Iterator[None]:
    before = {name: spark.conf.get(name) for name in values}
    for name, value in values.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


def _lowered(word: Column) -> Column:
    """A-Z as a-z; ``lower`` does that, and quickly, where all characters are ASCII."""
    plain = F.translate(word, string.ascii_uppercase, string.ascii_lowercase)
    return F.when(F.octet_length(word) == F.char_length(word), F.lower(word)).otherwise(plain)


def _tokens(text: Column) -> Column:
    """Words and piece ends in order; empty tokens are no words."""
    return F.split(F.regexp_replace(text, _PIECE_ENDS, f" {_PIECE_END} "), _GAPS)


def _is_word(token: Column) -> Column:
    return (token != "") & (token != _PIECE_END)


class _Relation:
    """An occurrence relation: a table bucketed by row and sorted by row and spot."""

    def __init__(self, rows: DataFrame, buckets: int):
        self.spark = rows.sparkSession
        self.name = f"corvane_occurrences_{uuid.uuid4().hex}"
        self.folder = new_folder(self.spark, "occurrences")
        writer = rows.write.option("compression", "zstd").option("path", self.folder)
        writer.bucketBy(buckets, "row").sortBy("row", "spot").saveAsTable(self.name)

    def rows(self) -> DataFrame:
        return self.spark.table(self.name)

    def drop(self) -> None:
        self.spark.sql(f"DROP TABLE IF EXISTS {self.name}")
        remove_folder(self.spark, self.folder)


def _frequent_only(rows: DataFrame, groups: DataFrame, keys: list[str], most: int, buckets: int) -> DataFrame:
    """The rows of frequent groups, with the group's id, in their buckets.

    ``groups`` is broadcast up to ``most`` rows. A larger one is merge-joined,
    where adaptive execution splits hot keys, and the rows go back to their buckets.
    """
    if groups.limit(most + 1).count() <= most:
        return rows.join(F.broadcast(groups), keys).select("row", "spot", "id")
    return rows.join(groups.hint("merge"), keys).select("row", "spot", "id").repartition(buckets, "row")


def _numbered(groups: DataFrame, name: str) -> DataFrame:
    return written(groups.withColumn("id", F.monotonically_increasing_id()), name)


def frequent_phrases(
    docs: DataFrame, text_col: str, lang_col: str, longest: int, least: int, broadcast_rows: int = BROADCAST_ROWS
) -> tuple[DataFrame, list[DataFrame]]:
    """((lang, n) of all words, per length (id, lang, phrase, f, first, last) of the frequent phrases).

    ``first`` and ``last`` are the ids of a phrase without its last and without
    its first word, null for single words.
    """
    spark = docs.sparkSession
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    texts = docs.select(F.coalesce(named(lang_col), F.lit("und")).alias("lang"), named(text_col).alias("text"))
    texts = texts.filter("text IS NOT NULL")
    words = texts.select("lang", F.explode(_tokens(F.col("text"))).alias("token")).filter(_is_word(F.col("token")))
    counts = words.groupBy("lang", _lowered(F.col("token")).alias("phrase")).agg(F.count(F.lit(1)).alias("f"))
    counts = written(counts, "words")
    totals = written(counts.groupBy("lang").agg(F.sum("f").alias("n")), "totals")
    nothing = F.lit(None).cast("bigint")
    levels = [_numbered(counts.filter(F.col("f") >= least).select("lang", "phrase", "f", nothing.alias("first"),
                                                                  nothing.alias("last")), "level-1")]
    placed = texts.withColumn("row", F.monotonically_increasing_id()).repartition(buckets, "row")
    tokens = placed.select("row", "lang", F.posexplode(_tokens(F.col("text"))).alias("spot", "token"))
    words = tokens.filter(_is_word(F.col("token"))).select("row", "spot", "lang", _lowered(F.col("token")).alias("phrase"))
    known = levels[0].select("lang", "phrase", "id")
    relation = _Relation(_frequent_only(words, known, ["lang", "phrase"], broadcast_rows, buckets), buckets)
    try:
        for size in range(2, longest + 1):
            with _settings(spark, _MERGED):
                here = relation.rows().withColumnRenamed("id", "first")
                after = relation.rows().select(F.col("row").alias("next_row"), F.col("spot").alias("next_spot"),
                                               F.col("id").alias("last"))
                adjacent = (F.col("row") == F.col("next_row")) & (F.col("spot") + 1 == F.col("next_spot"))
                pairs = here.hint("merge").join(after, adjacent).select("row", "spot", "first", "last")
                groups = pairs.groupBy("first", "last").agg(F.count(F.lit(1)).alias("f")).filter(F.col("f") >= least)
                groups = _numbered(groups, "groups")
                levels.append(_worded(groups, levels[-1], f"level-{size}"))
                if size < longest:
                    known = groups.select("first", "last", "id")
                    shorter = relation
                    relation = _Relation(_frequent_only(pairs, known, ["first", "last"], broadcast_rows, buckets), buckets)
                    shorter.drop()
    finally:
        relation.drop()
    return totals, levels


def _worded(groups: DataFrame, shorter: DataFrame, name: str) -> DataFrame:
    """The groups with their language and words, from those of the two phrases they consist of."""
    head = shorter.select(F.col("id").alias("first"), "lang", F.col("phrase").alias("head"))
    tail = shorter.select(F.col("id").alias("last"), F.substring_index("phrase", " ", -1).alias("word"))
    phrase = F.concat_ws(" ", "head", "word").alias("phrase")
    return written(groups.join(head, "first").join(tail, "last").select("lang", phrase, "f", "first", "last", "id"), name)


def _kept(levels: list[DataFrame], share: int) -> DataFrame:
    """(lang, phrase, size, a) of the candidates that no longer candidate stands for.

    A phrase occurs at least as often as any that holds it, so of all longer
    ones the most frequent is one word longer.
    """
    parts = []
    for size in range(2, len(levels) + 1):
        level = levels[size - 1]
        if size < len(levels):
            longer = levels[size].select(F.explode(F.array("first", "last")).alias("id"), "f")
            most = longer.groupBy("id").agg(F.max("f").alias("most"))
            covered = F.col("most").cast(COUNT) * 100 >= F.col("f").cast(COUNT) * share
            level = level.join(most, "id", "left").filter(F.coalesce(~covered, F.lit(True)))
        parts.append(level.select("lang", "phrase", F.lit(size).alias("size"), F.col("f").alias("a")))
    kept = parts[0]
    for part in parts[1:]:
        kept = kept.unionByName(part)
    return kept


def scored(kept: DataFrame, levels: list[DataFrame]) -> DataFrame:
    """(lang, phrase, a, l, r, score) by the lowest-scoring cut, ties to the earliest."""
    known = levels[0].select("lang", "phrase", "f")
    for level in levels[1:]:
        known = known.unionByName(level.select("lang", "phrase", "f"))
    cuts = kept.withColumn("cut", F.explode(F.sequence(F.lit(1), F.col("size") - 1)))
    cuts = cuts.withColumn("head", F.expr("substring_index(phrase, ' ', cut)"))
    cuts = cuts.withColumn("tail", F.expr("substring_index(phrase, ' ', cut - size)"))
    heads = known.select("lang", F.col("phrase").alias("head"), F.col("f").alias("l"))
    tails = known.select("lang", F.col("phrase").alias("tail"), F.col("f").alias("r"))
    both = cuts.join(heads, ["lang", "head"]).join(tails, ["lang", "tail"])
    score = f"(1000000BD * cast(a as {COUNT}) * cast(a as {COUNT})) div (cast(l as {COUNT}) * cast(r as {COUNT}))"
    best = both.groupBy("lang", "phrase", "a").agg(F.min(F.struct(F.expr(score).alias("score"), "cut", "l", "r")).alias("best"))
    return best.select("lang", "phrase", "a", "best.l", "best.r", "best.score")


def collocations(
    docs: DataFrame,
    text_col: str = "text",
    lang_col: str = "lang",
    longest: int = LONGEST,
    least: int = LEAST,
    share: int = SHARE,
    top: int = TOP,
    broadcast_rows: int = BROADCAST_ROWS,
) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the ``top`` phrases of each language.

    Texts are cut into pieces at ``. , ; : ! ?`` and line ends, and pieces into
    words at spaces and tabs; A-Z count as a-z. Candidates are phrases of two to
    ``longest`` words that occur ``a`` >= ``least`` times within pieces. One is
    left out when a longer candidate that holds it occurs at least ``share``
    percent as often. The score of a cut is 1,000,000 a² / (l r), rounded down,
    with the counts of its two parts; ``n`` counts all words of the language.
    Order: score and a descending, phrase ascending by its bytes.

    A null language is ``und``, a null text has no words, rows that repeat count
    as often as they occur, and without candidates the result is empty. Counts
    are exact up to 18 digits.
    """
    if longest < 2:
        raise ValueError("longest must be 2 or more")
    totals, levels = frequent_phrases(docs, text_col, lang_col, longest, least, broadcast_rows)
    found = scored(_kept(levels, share), levels)
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    # First within shares of a language, so that no task ranks a whole one.
    parts = Window.partitionBy("lang", F.pmod(F.xxhash64("phrase"), F.lit(SALTS))).orderBy(*order)
    first = found.withColumn("rank", F.row_number().over(parts)).filter(F.col("rank") <= top)
    whole = Window.partitionBy("lang").orderBy(*order)
    ranked = first.withColumn("rank", F.row_number().over(whole).cast("bigint")).filter(F.col("rank") <= top)
    return ranked.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
