"""Collection-style operations as DataFrame queries."""

from pyspark.sql import functions as F

from corvane.catalogue.registry import query
from corvane.catalogue.views import Views
from corvane.operators.aggregates import row_with_least, whole_mean
from corvane.plans.movies import mean_rating_by_genre
from corvane.scratch import new_folder
from corvane.sinks import files as sinks
from corvane.sources import files as sources


@query("rdd_filter_count", "SELECT count(*) AS n FROM stocks WHERE symbol = 'CLICK'", "stocks")
def filter_and_count(v: Views):
    return v.stocks().where(F.col("symbol") == "CLICK").agg(F.count("*").alias("n"))


@query(
    "rdd_min_by",
    """SELECT symbol, date, price FROM stocks WHERE symbol = 'CLICK' ORDER BY price, date LIMIT 1""",
    "stocks",
)
def cheapest(v: Views):
    priced = v.stocks().where((F.col("symbol") == "CLICK") & F.col("price").isNotNull())
    return row_with_least(priced, ["price", "date"])


@query("rdd_reduce_sum", "SELECT CAST(sum(l_orderkey) AS BIGINT) AS total FROM lineitem")
def reduce_to_sum(v: Views):
    return v.table("lineitem").agg(F.sum("l_orderkey").alias("total"))


@query(
    "rdd_group_avg",
    """SELECT Major_Genre AS genre, round(avg(IMDB_Rating), 4) AS rating FROM movies
       WHERE Major_Genre IS NOT NULL AND IMDB_Rating IS NOT NULL GROUP BY Major_Genre""",
    "movies",
)
def mean_per_group(v: Views):
    return mean_rating_by_genre(v.movies()).withColumn("rating", F.round("rating", 4))


@query(
    "src_range_join_sum",
    """SELECT CAST(sum(a.id) AS BIGINT) AS total FROM (SELECT o_orderkey * 5 AS id FROM orders) a
       JOIN (SELECT o_orderkey * 2 + 1 AS id FROM orders) b ON a.id = b.id""",
)
def join_on_a_computed_key(v: Views):
    keys = v.table("orders").select(F.col("o_orderkey").alias("id"))
    fives = keys.selectExpr("id * 5 AS id")
    odds = keys.selectExpr("id * 2 + 1 AS id")
    return fives.join(odds, "id").agg(F.sum("id").alias("total"))


@query(
    "typed_ops",
    """SELECT count(*) AS cars, count(CASE WHEN coalesce(Horsepower, 0) > 140 THEN 1 END) AS powerful,
         CAST(sum(coalesce(Horsepower, 0)) // count(*) AS BIGINT) AS whole_mean,
         round(avg(Horsepower), 4) AS mean, max(upper(Name)) AS last_name FROM cars""",
    "cars",
)
def collection_functions(v: Views):
    power = F.col("Horsepower")
    return v.cars().agg(
        F.count("*").alias("cars"),
        F.count(F.when(F.coalesce(power, F.lit(0)) > 140, 1)).alias("powerful"),
        whole_mean(power).alias("whole_mean"),
        F.round(F.avg(power), 4).alias("mean"),
        F.max(F.upper("Name")).alias("last_name"),
    )


@query(
    "part_repartition",
    "SELECT symbol, date, price FROM stocks",
    "stocks",
)
def repartition_and_coalesce(v: Views):
    """Written in twice as many files as the session runs tasks at a time, read back in half of them."""
    files = v.spark.sparkContext.defaultParallelism
    path = new_folder(v.spark, "part_repartition")
    sinks.write_parquet(v.stocks(), path, files=2 * files)
    return sources.read_files(v.spark, "parquet", path).coalesce(files)
