import math

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corvane.operators import aggregates, joins
from corvane.operators.aggregates import correlation, distinct_by, row_with_least, whole_mean
from corvane.operators.ordering import sample_distinct, sorted_down, top_rows

PLAYERS = [(1, [10, 11, 10]), (2, [11]), (3, []), (4, None), (5, [99]), (6, [None, 12]), (7, [99, 98])]
GUITARS = [(10, "a"), (11, "b"), (12, "c"), (13, "d"), (None, "e")]


@pytest.fixture
def players(spark):
    return spark.createDataFrame(PLAYERS, "id bigint, guitars array<bigint>")


@pytest.fixture
def guitars(spark):
    return spark.createDataFrame(GUITARS, "guitarId bigint, model string")


def test_membership_equals_the_plain_condition(players, guitars, values, plan_of):
    joined = joins.membership_join(players, guitars, "guitars", "guitarId")
    plain = players.join(guitars, F.expr("array_contains(guitars, guitarId)"))
    assert values(joined) == values(plain)
    assert "CartesianProduct" in plan_of(plain)
    assert "NestedLoop" not in plan_of(joined) and "Cartesian" not in plan_of(joined)


def test_full_membership_equals_the_plain_condition(players, guitars, values, plan_of):
    pairs = joins.membership_full_join(players, guitars, "guitars", "id", "guitarId")
    lefts, rights = players.select(F.struct("*").alias("left")), guitars.select(F.struct("*").alias("right"))
    plain = lefts.join(rights, F.expr("array_contains(left.guitars, right.guitarId)"), "full")
    assert values(pairs) == values(plain)
    assert "NestedLoop" not in plan_of(pairs)


LEFT = [(1, "a"), (1, "a"), (2, "b"), (3, "c"), (None, "d"), (None, "d")]
RIGHT = [(1, "x"), (1, "y"), (1, "y"), (4, "z"), (None, "w")]


@pytest.mark.parametrize("how", ["left", "right", "full"])
def test_spread_join_equals_outer_join(spark, values, how):
    left, right = spark.createDataFrame(LEFT, "k int, a string"), spark.createDataFrame(RIGHT, "r int, b string")
    assert values(joins.spread_join(left, right, "k", "r", how)) == values(left.join(right, F.col("k") == F.col("r"), how))


def test_spread_join_is_an_outer_join(spark):
    with pytest.raises(ValueError, match="left, right or full"):
        joins.spread_join(spark.range(1), spark.range(1).toDF("r"), "id", "r", "inner")


def test_without_match_keeps_null_keys(spark, values):
    left, right = spark.createDataFrame(LEFT, "k int, a string"), spark.createDataFrame(RIGHT, "k int, b string")
    assert values(joins.without_match(left, right, "k", "k")) == values(left.join(right, "k", "left_anti"))


def test_pair_join_leaves_the_missing_side_null(spark):
    left, right = spark.createDataFrame(LEFT, "k int, a string"), spark.createDataFrame(RIGHT, "r int, b string")
    rows = joins.pair_join(left, right, "k", "r", "full").collect()
    assert len([r for r in rows if r.left and r.right]) == 6
    assert len([r for r in rows if r.left is None]) == 2
    assert len([r for r in rows if r.right is None]) == 4
    assert len(joins.pair_join(left, right, "k", "r").collect()) == 6


def skewed(spark, setting):
    """Posts of which a third belong to one profile, under settings that call it skew."""
    setting("spark.sql.autoBroadcastJoinThreshold", "-1")
    setting("spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes", "2k")
    setting("spark.sql.adaptive.skewJoin.skewedPartitionFactor", "1.5")
    setting("spark.sql.adaptive.advisoryPartitionSizeInBytes", "4k")
    profiles = spark.range(1000).select(F.col("id").alias("k"), F.concat(F.lit("p"), "id").alias("name"))
    owner = F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 900)
    posts = spark.range(0, 30000, 1, 8).select(owner.alias("owner"), F.col("id").alias("post"))
    return profiles, posts


@pytest.mark.parametrize("how", ["left", "right", "full"])
def test_spread_join_with_one_row_per_key_on_the_right(spark, values, how):
    left = spark.createDataFrame(LEFT, "k int, a string")
    right = spark.createDataFrame([(1, "x"), (4, "z"), (None, "w")], "r int, b string")
    joined = joins.spread_join(left, right, "k", "r", how, unique_right=True)
    assert values(joined) == values(left.join(right, F.col("k") == F.col("r"), how))


def test_full_join_with_a_unique_side_takes_two_joins(spark, setting, plan_of):
    profiles, posts = skewed(spark, setting)
    joined = joins.spread_join(posts, profiles, "owner", "k", "full", unique_right=True)
    plan = plan_of(joined, run=True)
    assert plan.count("SortMergeJoin") == 2 and "skew=true" in plan


@pytest.mark.parametrize("how", ["left", "right", "full"])
def test_hot_key_is_split_in_outer_joins(spark, setting, plan_of, how):
    profiles, posts = skewed(spark, setting)
    if how == "right":
        joined = joins.spread_join(posts, profiles, "owner", "k", how)
        assert "skew=true" in plan_of(joined, run=True)
        assert joined.count() == posts.join(profiles, F.col("k") == F.col("owner"), how).count()
        return
    plain = profiles.join(posts, F.col("k") == F.col("owner"), how)
    assert "skew=true" not in plan_of(plain, run=True)
    joined = joins.spread_join(profiles, posts, "k", "owner", how)
    assert "skew=true" in plan_of(joined, run=True)
    assert joined.count() == plain.count()


def test_hot_key_is_split_in_the_anti_join(spark, setting, plan_of):
    profiles, posts = skewed(spark, setting)
    orphans = joins.without_match(posts, profiles.where("k < 500"), "owner", "k")
    assert "skew=true" in plan_of(orphans, run=True)


def test_lookup_is_a_left_join(spark, values):
    left = spark.createDataFrame(LEFT, "k int, a string")
    right = spark.createDataFrame([(1, "x"), (4, "z"), (None, "w")], "r int, b string")
    assert values(joins.lookup(left, right, "k", "r")) == values(left.join(right, F.col("k") == F.col("r"), "left").drop("r"))


def test_hot_key_is_split_after_a_lookup(spark, setting, plan_of):
    profiles, posts = skewed(spark, setting)
    extra = spark.range(1000).select(F.col("id").alias("r"), (F.col("id") * 2).alias("twice"))
    owners = joins.lookup(profiles, extra, "k", "r")
    plain = profiles.join(extra, F.col("k") == F.col("r"), "left").drop("r")
    assert "skew=true" not in plan_of(posts.join(plain, F.col("owner") == F.col("k")), run=True)
    assert "skew=true" in plan_of(posts.join(owners, F.col("owner") == F.col("k")), run=True)


def test_hot_key_is_split_before_a_grouping_on_the_join_key(spark, setting, plan_of, values):
    profiles, posts = skewed(spark, setting)
    joined = profiles.join(posts, F.col("k") == F.col("owner"))
    grouped = joined.groupBy("k", F.col("post") % 10).count()
    assert "skew=true" in plan_of(grouped, run=True)
    assert sum(row[-1] for row in values(grouped)) == 30000


def test_row_with_least(spark):
    df = spark.createDataFrame([("m", "d1", 3.0), ("m", "d2", 1.0), ("m", "d0", 1.0), ("g", "d3", 9.0)], "s string, d string, p double")
    assert tuple(row_with_least(df, ["p"]).first()) == ("m", "d0", 1.0)
    assert sorted(map(tuple, row_with_least(df, ["p"], ["s"]).collect())) == [("g", "d3", 9.0), ("m", "d0", 1.0)]


def test_distinct_by_always_picks_the_same_row(spark):
    rows = [(i % 5, i, chr(65 + i % 7)) for i in range(100)]
    picks = {
        tuple(sorted(map(tuple, distinct_by(spark.createDataFrame(rows, "k int, v int, t string").repartition(n), ["k"], ["t", "v"]).collect())))
        for n in (1, 3, 7)
    }
    assert len(picks) == 1
    assert next(iter(picks)) == tuple((k, *min((t, v) for kk, v, t in rows if kk == k)[::-1]) for k in range(5))


def test_whole_mean_counts_null_as_zero(spark):
    df = spark.createDataFrame([(10,), (5,), (None,)], "x bigint")
    assert tuple(df.agg(whole_mean(F.col("x")), F.avg("x")).first()) == (5, 7.5)
    assert df.where("x > 99").agg(whole_mean(F.col("x"))).first()[0] is None


def test_correlation(spark):
    rows = [(1.0, 2.0), (2.0, 1.0), (3.0, 5.0), (None, 4.0), (7.0, None)]
    df = spark.createDataFrame(rows, "a double, b double")
    known, zero = df.agg(correlation("a", "b"), correlation("a", "b", nulls_as_zero=True)).first()
    assert math.isclose(zero, df.stat.corr("a", "b"))
    assert math.isclose(known, df.na.drop().stat.corr("a", "b"))


def test_deviation_of_one_row_is_null(spark):
    assert spark.range(1).agg(F.stddev("id")).first()[0] is None


def test_null_sum_and_counts(spark):
    df = spark.createDataFrame([(1, None), (2, 3)], "a int, b int")
    row = df.agg(F.sum(F.col("a") + F.col("b")), F.count("b"), F.count("*")).first()
    assert tuple(row) == (5, 1, 2)


def test_top_rows_need_no_full_sort(spark, plan_of):
    df = spark.range(1000).select("id", (F.col("id") % 10).alias("v"))
    top = top_rows(df, 3, F.desc("v"), F.asc("id"))
    assert "TakeOrderedAndProject" in plan_of(top)
    assert [r.id for r in top.collect()] == [9, 19, 29]


def test_sort_spreads_a_run_of_equal_values(spark, setting):
    setting("spark.sql.adaptive.coalescePartitions.enabled", "false")
    counted = spark.range(0, 20000, 1, 8).select(F.lit(1).alias("n"), F.concat(F.lit("w"), "id").alias("word"))
    sizes = sorted_down(counted, "n").groupBy(F.spark_partition_id()).count().collect()
    assert max(row["count"] for row in sizes) < 10000


@pytest.mark.parametrize("n", [0, 1, 37, 499, 500, 10_000])
@pytest.mark.parametrize("bits", [2, 16])
def test_sample_has_n_distinct_rows(spark, n, bits):
    df = spark.range(1500).select((F.col("id") % 500).alias("a"), F.lit(None).cast("string").alias("b"))
    rows = [tuple(r) for r in sample_distinct(df, n, bits).collect()]
    assert len(rows) == len(set(rows)) == min(n, 500)
    assert {a for a, _ in rows} <= set(range(500))


def test_sample_bounds_its_buckets(spark):
    with pytest.raises(ValueError, match="bits"):
        sample_distinct(spark.range(3), 1, bits=32)


def test_sample_is_repeatable(spark, values):
    df = spark.range(3000).select((F.col("id") % 800).alias("a"))
    assert values(sample_distinct(df.repartition(3), 100)) == values(sample_distinct(df.repartition(5), 100))


def test_sample_shuffles_the_distinct_rows_once(spark, plan_of):
    df = spark.range(3000).select((F.col("id") % 800).alias("a"), F.col("id").cast("string").alias("b"))
    plan = plan_of(sample_distinct(df, 100), run=True)
    assert "ReusedExchange" in plan


def test_struct_types_of_pairs(players, guitars):
    pairs = joins.membership_full_join(players, guitars, "guitars", "id", "guitarId")
    assert [type(f.dataType) for f in pairs.schema] == [T.StructType, T.StructType]


def test_stored_sketches_merge(spark, tmp_path):
    rows = spark.range(20_000).selectExpr("id % 7 AS day", "id * 13 % 5000 AS who")
    aggregates.stored_sketches(rows, "who", "day").write.parquet(str(tmp_path / "sketches"))
    stored = spark.read.parquet(str(tmp_path / "sketches"))
    for days in ((0,), (1, 2, 3), tuple(range(7))):
        exact = rows.where(F.col("day").isin(*days)).select("who").distinct().count()
        found = aggregates.merged_estimate(stored.where(F.col("day").isin(*days))).first()["estimate"]
        assert abs(found - exact) <= 3 * 0.016 * exact
    assert aggregates.merged_estimate(stored.where("day > 90")).first()["estimate"] == 0
