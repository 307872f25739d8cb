"""Aggregates."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corvane.catalogue.registry import query
from corvane.catalogue.views import Views
from corvane.functions.labels import post_type_label
from corvane.operators.aggregates import correlation, distinct_by, merged_estimate, stored_sketches
from corvane.scratch import materialise


@query(
    "agg_counts",
    "SELECT count(Major_Genre) AS genres, count(*) AS rows FROM movies",
    "movies",
)
def counts(v: Views):
    return v.movies().agg(F.count("Major_Genre").alias("genres"), F.count("*").alias("rows"))


@query("agg_count_distinct", "SELECT count(DISTINCT Director) AS directors FROM movies", "movies")
def distinct_count(v: Views):
    return v.movies().agg(F.count_distinct("Director").alias("directors"))


@query("agg_approx_distinct", "SELECT TRUE AS within_bound, count(DISTINCT Title) AS exact FROM movies", "movies")
def approximate_distinct_count(v: Views):
    """The sketch keeps within three times its relative deviation of the exact count."""
    deviation = 0.05
    counted = v.movies().agg(
        F.approx_count_distinct("Title", deviation).alias("approximate"), F.count_distinct("Title").alias("exact")
    )
    error = F.abs(F.col("approximate") - F.col("exact"))
    return counted.select((error <= 3 * deviation * F.col("exact")).alias("within_bound"), "exact")


_RANGES = {"first year": (1992, 1992), "three years": (1993, 1995), "all": (1992, 1998), "none": (2090, 2091)}
_RANGE_ROWS = ", ".join(f"('{name}', {low}, {high})" for name, (low, high) in _RANGES.items())


@query(
    "agg_sketch_ranges",
    f"""SELECT name, count(DISTINCT o_custkey) AS exact, TRUE AS within_bound
        FROM (VALUES {_RANGE_ROWS}) ranges(name, low, high) LEFT JOIN orders ON year(o_orderdate) BETWEEN low AND high
        GROUP BY name""",
)
def different_customers_from_stored_sketches(v: Views):
    """Sketches per day are written once; each range of years merges those of its days and reads no order again.

    The exact counts beside them show that the estimates keep within three deviations.
    """
    orders = v.table("orders").select("o_custkey", F.to_date("o_orderdate").alias("day"))
    daily = materialise(stored_sketches(orders, "o_custkey", "day"), "daily-sketches")
    ranges = v.spark.createDataFrame([(name, *years) for name, years in _RANGES.items()], "name string, low int, high int")
    years = ranges.select("name", "low", "high", F.explode(F.sequence("low", "high")).alias("year"))

    def in_range(rows: DataFrame) -> DataFrame:
        return years.join(rows.withColumn("year", F.year("day")), "year", "left")

    estimates = merged_estimate(in_range(daily).select("name", "sketch"), "name")
    exact = in_range(orders).groupBy("name").agg(F.count_distinct("o_custkey").alias("exact"))
    error = F.abs(F.col("estimate") - F.col("exact"))
    bound = error <= 3 * 0.016 * F.col("exact") + 0.5
    return exact.join(estimates, "name").select("name", "exact", bound.alias("within_bound"))


@query(
    "agg_min_max",
    "SELECT min(IMDB_Rating) AS least, max(IMDB_Rating) AS most FROM movies",
    "movies",
)
def least_and_most(v: Views):
    return v.movies().agg(F.min("IMDB_Rating").alias("least"), F.max("IMDB_Rating").alias("most"))


@query(
    "agg_sum_avg",
    """SELECT CAST(sum(US_Gross) AS BIGINT) AS gross, round(avg(Rotten_Tomatoes_Rating), 4) AS mean_rating
       FROM movies""",
    "movies",
)
def sum_and_mean(v: Views):
    return v.movies().agg(
        F.sum("US_Gross").alias("gross"), F.round(F.avg("Rotten_Tomatoes_Rating"), 4).alias("mean_rating")
    )


@query(
    "agg_stddev",
    """SELECT round(avg(Rotten_Tomatoes_Rating), 4) AS mean_rating,
         round(stddev_samp(Rotten_Tomatoes_Rating), 4) AS deviation FROM movies""",
    "movies",
)
def deviation(v: Views):
    rating = F.col("Rotten_Tomatoes_Rating")
    return v.movies().agg(
        F.round(F.mean(rating), 4).alias("mean_rating"), F.round(F.stddev(rating), 4).alias("deviation")
    )


@query(
    "agg_group_short",
    """SELECT g.Major_Genre, g.n, round(a.mean, 4) AS mean
       FROM (SELECT Major_Genre, count(*) AS n FROM movies GROUP BY Major_Genre) g
       JOIN (SELECT Major_Genre, avg(IMDB_Rating) AS mean FROM movies GROUP BY Major_Genre) a
         ON g.Major_Genre IS NOT DISTINCT FROM a.Major_Genre""",
    "movies",
)
def group_shorthand(v: Views):
    both = v.movies().groupBy("Major_Genre").agg({"*": "count", "IMDB_Rating": "avg"})
    return both.select(
        "Major_Genre", F.col("count(1)").alias("n"), F.round("avg(IMDB_Rating)", 4).alias("mean")
    )


@query(
    "agg_group_multi",
    """SELECT Director, round(avg(IMDB_Rating), 4) AS Avg_Rating, CAST(sum(US_Gross) AS BIGINT) AS Total_US_Gross,
         count(*) AS N_Movies FROM movies GROUP BY Director""",
    "movies",
)
def several_per_group(v: Views):
    return (
        v.movies()
        .groupBy("Director")
        .agg(
            F.round(F.avg("IMDB_Rating"), 4).alias("Avg_Rating"),
            F.sum("US_Gross").alias("Total_US_Gross"),
            F.count("*").alias("N_Movies"),
        )
        .orderBy(F.desc_nulls_last("Avg_Rating"), F.asc("Director"))
    )


@query(
    "agg_group_expr",
    """SELECT CAST(year(cts) AS INTEGER) AS year_post,
         CASE post_type WHEN 1 THEN 'photo' WHEN 2 THEN 'video' WHEN 3 THEN 'multy' END AS post_type,
         count(*) AS n FROM posts GROUP BY 1, 2""",
    "posts",
)
def group_by_expressions(v: Views):
    keys = [F.year("cts").alias("year_post"), post_type_label(F.col("post_type")).alias("post_type")]
    return v.posts().groupBy(*keys).agg(F.count("*").alias("n"))


@query(
    "agg_having",
    """SELECT Major_Genre, count(*) AS n FROM movies GROUP BY Major_Genre
       HAVING Major_Genre IS NOT NULL AND count(*) > 1""",
    "movies",
)
def condition_on_groups(v: Views):
    counted = v.movies().groupBy("Major_Genre").agg(F.count("*").alias("n"))
    return counted.where(F.col("Major_Genre").isNotNull() & (F.col("n") > 1))


@query(
    "agg_sum_expr",
    "SELECT CAST(sum(US_Gross + Worldwide_Gross + US_DVD_Sales) AS BIGINT) AS total FROM movies",
    "movies",
)
def sum_of_row_sums(v: Views):
    profit = F.col("US_Gross") + F.col("Worldwide_Gross") + F.col("US_DVD_Sales")
    return v.movies().agg(F.sum(profit).alias("total"))


@query(
    "agg_corr",
    """SELECT round(corr(Rotten_Tomatoes_Rating, IMDB_Rating), 4) AS known_rows,
         round(corr(coalesce(Rotten_Tomatoes_Rating, 0), coalesce(IMDB_Rating, 0)), 4) AS nulls_as_zero FROM movies""",
    "movies",
)
def correlations(v: Views):
    a, b = "Rotten_Tomatoes_Rating", "IMDB_Rating"
    return v.movies().agg(
        F.round(correlation(a, b), 4).alias("known_rows"),
        F.round(correlation(a, b, nulls_as_zero=True), 4).alias("nulls_as_zero"),
    )


@query("set_distinct", "SELECT DISTINCT Major_Genre, Director FROM movies", "movies")
def distinct_rows(v: Views):
    return v.movies().select("Major_Genre", "Director").distinct()


@query(
    "set_drop_duplicates",
    """SELECT Director, Title, US_Gross FROM (SELECT *, row_number() OVER
         (PARTITION BY Director ORDER BY Title, US_Gross) AS place FROM movies) WHERE place = 1""",
    "movies",
)
def one_row_per_key(v: Views):
    movies = v.movies().select("Director", "Title", "US_Gross")
    return distinct_by(movies, ["Director"], ["Title", "US_Gross"])


@query(
    "set_union",
    """SELECT Title, US_Gross AS gross FROM movies UNION ALL SELECT Name, Weight_in_lbs FROM cars
       UNION ALL SELECT Title, US_Gross FROM movies""",
    "movies cars",
)
def append_rows(v: Views):
    movies = v.movies().select("Title", F.col("US_Gross").alias("gross"))
    cars = v.cars().select("Name", "Weight_in_lbs")
    return movies.union(cars).unionByName(movies.select("gross", "Title"))
