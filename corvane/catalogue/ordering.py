"""Sorts, limits and samples."""

from pyspark.sql import functions as F

from corvane.catalogue.registry import query
from corvane.catalogue.views import Views
from corvane.operators.ordering import sample_distinct, top_rows


@query("sort_basic", "SELECT Director, Title, IMDB_Rating FROM movies", "movies")
def several_keys(v: Views):
    movies = v.movies().select("Director", "Title", "IMDB_Rating")
    return movies.orderBy(F.asc("Director"), F.desc("IMDB_Rating"), F.asc("Title"))


@query("sort_nulls_last", "SELECT Title, IMDB_Rating FROM movies", "movies")
def nulls_last(v: Views):
    return v.movies().select("Title", "IMDB_Rating").orderBy(F.desc_nulls_last("IMDB_Rating"), F.asc("Title"))


@query(
    "sort_topk",
    "SELECT Title, IMDB_Rating FROM movies ORDER BY IMDB_Rating DESC NULLS LAST, Title LIMIT 10",
    "movies",
)
def first_ten(v: Views):
    movies = v.movies().select("Title", "IMDB_Rating")
    return top_rows(movies, 10, F.desc_nulls_last("IMDB_Rating"), F.asc("Title"))


@query(
    "sample_distinct",
    """SELECT DISTINCT profile_id, post_type, description, numbr_likes, number_comments FROM posts
       ORDER BY ALL LIMIT 15000000""",
    "posts",
)
def sample(v: Views):
    columns = ["profile_id", "post_type", "description", "numbr_likes", "number_comments"]
    return sample_distinct(v.posts().select(*columns))


@query(
    "sample_distinct_cut",
    """SELECT least(100, count(*)) AS rows, least(100, count(*)) AS distinct_rows, 0 AS foreign_rows
       FROM (SELECT DISTINCT profile_id, post_type FROM posts)""",
    "posts",
)
def sample_below_the_number_of_rows(v: Views):
    """A sample smaller than its input: its size, that no row repeats, that every row is one of the input."""
    posts = v.posts().select("profile_id", "post_type")
    taken = sample_distinct(posts, 100)
    known = posts.distinct().withColumn("known", F.lit(1))
    checked = taken.join(known, ["profile_id", "post_type"], "left")
    return checked.agg(
        F.count("*").alias("rows"),
        F.count_distinct("profile_id", "post_type").alias("distinct_rows"),
        F.count_if(F.col("known").isNull()).cast("int").alias("foreign_rows"),
    )
