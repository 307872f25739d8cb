"""Filters and conditional labels."""

from pyspark.sql import functions as F

from corvane.catalogue.registry import query
from corvane.catalogue.views import Views
from corvane.functions.labels import (
    CHARACTER_RANGES,
    FOLLOWER_RANGES,
    HASHTAG_RANGES,
    country_label,
    post_type_label,
    range_label,
)
from corvane.functions.text import character_count, contains_any, hashtag_count, matches_any

CAR_NAMES = ["Toyota", "Vw", "Ford"]


@query("filter_neq", "SELECT Name, Origin FROM cars WHERE Origin <> 'USA'", "cars")
def not_equal(v: Views):
    return v.cars().where(F.col("Origin") != "USA").select("Name", "Origin")


@query(
    "filter_sql_text",
    "SELECT Name, Horsepower FROM cars WHERE Origin = 'USA' AND Horsepower > 150",
    "cars",
)
def condition_as_text(v: Views):
    return v.cars().filter("Origin = 'USA' and Horsepower > 150").select("Name", "Horsepower")


@query(
    "filter_chain",
    """SELECT Name, Horsepower, Miles_per_Gallon FROM cars
       WHERE Origin = 'USA' AND Horsepower > 150 AND Miles_per_Gallon >= 10 AND Cylinders < 8""",
    "cars",
)
def chained_conditions(v: Views):
    cars = v.cars().filter(F.col("Origin") == "USA").filter(F.col("Horsepower") > 150)
    cars = cars.where((F.col("Miles_per_Gallon") >= 10) & (F.col("Cylinders") < 8))
    return cars.select("Name", "Horsepower", "Miles_per_Gallon")


def _good_movie():
    return ((F.col("Major_Genre") == "ECONOMY") & (F.col("IMDB_Rating") > 7.0)).alias("good_movie")


@query(
    "filter_bool_flag",
    """SELECT Title, Major_Genre = 'ECONOMY' AND IMDB_Rating > 7.0 AS good_movie FROM movies
       WHERE Major_Genre = 'ECONOMY' AND IMDB_Rating > 7.0""",
    "movies",
)
def boolean_column(v: Views):
    return v.movies().select("Title", _good_movie()).where("good_movie")


@query(
    "filter_not",
    """SELECT Title, Major_Genre = 'ECONOMY' AND IMDB_Rating > 7.0 AS good_movie FROM movies
       WHERE NOT (Major_Genre = 'ECONOMY' AND IMDB_Rating > 7.0)""",
    "movies",
)
def negated_boolean_column(v: Views):
    return v.movies().select("Title", _good_movie()).where(~F.col("good_movie"))


@query(
    "filter_nulls",
    """SELECT Title, IMDB_Rating FROM movies WHERE Rotten_Tomatoes_Rating IS NULL AND IMDB_Rating IS NOT NULL""",
    "movies",
)
def null_tests(v: Views):
    movies = v.movies().where(F.col("Rotten_Tomatoes_Rating").isNull() & F.col("IMDB_Rating").isNotNull())
    return movies.select("Title", "IMDB_Rating")


@query("filter_like", "SELECT post_id, description FROM posts WHERE description LIKE '#f%'", "posts")
def prefix_pattern(v: Views):
    return v.posts().where(F.col("description").like("#f%")).select("post_id", "description")


@query(
    "filter_contains_any",
    """SELECT Name FROM cars
       WHERE contains(Name, 'toyota') OR contains(Name, 'vw') OR contains(Name, 'ford')""",
    "cars",
)
def any_substring(v: Views):
    return v.cars().where(contains_any(F.col("Name"), [name.lower() for name in CAR_NAMES])).select("Name")


@query(
    "filter_regex_any",
    "SELECT Name FROM cars WHERE regexp_matches(Name, 'toyota|vw|ford')",
    "cars",
)
def any_pattern(v: Views):
    return v.cars().where(matches_any(F.col("Name"), CAR_NAMES)).select("Name")


@query(
    "filter_hidden_col",
    "SELECT Title, IMDB_Rating FROM movies WHERE Major_Genre = 'ECONOMY' AND IMDB_Rating > 6",
    "movies",
)
def condition_on_a_dropped_column(v: Views):
    movies = v.movies().select("Title", "IMDB_Rating")
    return movies.where((F.col("Major_Genre") == "ECONOMY") & (F.col("IMDB_Rating") > 6))


@query(
    "cond_labels",
    """SELECT post_id, CASE post_type WHEN 1 THEN 'photo' WHEN 2 THEN 'video' WHEN 3 THEN 'multy' END AS post_type,
         NULL AS country FROM posts
       UNION ALL
       SELECT id, NULL, CASE WHEN cd = 'US' THEN 'United States' ELSE cd END FROM locations""",
    "posts locations",
)
def codes_to_labels(v: Views):
    posts = v.posts().select("post_id", post_type_label(F.col("post_type")).alias("post_type"))
    places = v.locations().select(F.col("id").alias("post_id"), country_label(F.col("cd")).alias("country"))
    return posts.unionByName(places, allowMissingColumns=True)


def ranges_sql(column: str, ranges) -> str:
    ends = [
        f"WHEN {column} {f'>= {low}' if high is None else f'BETWEEN {low} AND {high}'} THEN '{label}'"
        for low, high, label in ranges
    ]
    return f"CASE {' '.join(ends)} END"


@query(
    "cond_buckets",
    f"""SELECT post_id, {ranges_sql("numbr_likes", FOLLOWER_RANGES)} AS likes,
          {ranges_sql("length(description)", CHARACTER_RANGES)} AS characters,
          {ranges_sql("len(list_filter(string_split(description, ' '), lambda w: starts_with(w, '#')))", HASHTAG_RANGES)}
            AS hashtags FROM posts""",
    "posts",
)
def numbers_to_ranges(v: Views):
    text = F.col("description")
    return v.posts().select(
        "post_id",
        range_label(F.col("numbr_likes"), FOLLOWER_RANGES).alias("likes"),
        range_label(character_count(text), CHARACTER_RANGES).alias("characters"),
        range_label(hashtag_count(text), HASHTAG_RANGES).alias("hashtags"),
    )
