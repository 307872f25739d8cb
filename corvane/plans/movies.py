"""Movies: good comedies, ratings, profits and release dates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corvane.functions.dates import not_after, parse_date
from corvane.operators.ordering import sorted_down

RELEASE_FORMATS = ["d-MMM-yy", "yyyy-MM-dd", "MMM d yyyy"]


def good_movies(movies: DataFrame, genre: str = "Comedy", above: float = 6.5) -> DataFrame:
    wanted = movies.where((F.col("Major_Genre") == genre) & (F.col("IMDB_Rating") > above))
    shown = wanted.select("Title", F.col("IMDB_Rating").alias("Rating"), F.col("Release_Date").alias("Release"))
    return sorted_down(shown, "Rating")


def mean_rating_by_genre(movies: DataFrame) -> DataFrame:
    rated = movies.where(F.col("Major_Genre").isNotNull() & F.col("IMDB_Rating").isNotNull())
    return rated.groupBy(F.col("Major_Genre").alias("genre")).agg(F.avg("IMDB_Rating").alias("rating"))


def with_release_date(movies: DataFrame, as_of: str) -> DataFrame:
    """Add the release date read from text; two-digit years never lie after ``as_of``."""
    date = parse_date(F.col("Release_Date"), RELEASE_FORMATS)
    return movies.withColumn("Actual_Release", not_after(date, F.lit(as_of).cast("date")))
