"""Jobs to run or submit, with paths as arguments.

    python -m corvane.jobs good-comedies movies.json out/
    python -m corvane.jobs visited-cities locations.csv out/ [--files 1]
    python -m corvane.jobs economic-impact trips/ zones.csv out/
    python -m corvane.jobs sample-posts posts.csv out/ [--rows 15000000]
    python -m corvane.jobs join-posts profiles.csv locations.csv posts.csv out/
    python -m corvane.jobs load "input/*.csv" schema.txt database.table
"""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from corvane.operators.loading import load_with_schema_file
from corvane.operators.ordering import SAMPLE_ROWS, sample_distinct
from corvane.plans import movies, social, trips
from corvane.session import build_session
from corvane.sinks import files as sinks
from corvane.sources import files as sources


def good_comedies(spark: SparkSession, source: str, target: str) -> None:
    sinks.write_json(movies.good_movies(sources.read_json(spark, source)), target)


def visited_cities(spark: SparkSession, source: str, target: str, files: int | None = None) -> None:
    sinks.write_csv(social.visited_cities(sources.read_text_columns(spark, source)), target, mode="append", files=files)


def economic_impact(spark: SparkSession, source: str, zones: str, target: str) -> None:
    zone_table = sources.read_csv(spark, zones, inferSchema=True)
    total = trips.economic_impact_of_history(sources.read_files(spark, "parquet", source), zone_table)
    sinks.write_csv(total, target)


def sample_posts(spark: SparkSession, source: str, target: str, rows: int = SAMPLE_ROWS) -> None:
    sinks.write_csv(sample_distinct(sources.read_text_columns(spark, source), rows), target, sep="\t")


def join_posts(spark: SparkSession, profiles: str, locations: str, posts: str, target: str) -> None:
    joined = social.join_sources(
        sources.read_text_columns(spark, profiles),
        sources.read_text_columns(spark, locations),
        sources.read_posts(spark, posts),
    )
    sinks.write_parquet(joined, target)


def load(spark: SparkSession, source: str, schema: str, table: str) -> None:
    load_with_schema_file(spark, source, schema, table)


JOBS = {
    "good-comedies": (good_comedies, ["source", "target"]),
    "visited-cities": (visited_cities, ["source", "target", "--files"]),
    "economic-impact": (economic_impact, ["source", "zones", "target"]),
    "sample-posts": (sample_posts, ["source", "target", "--rows"]),
    "join-posts": (join_posts, ["profiles", "locations", "posts", "target"]),
    "load": (load, ["source", "schema", "table"]),
}


def main(arguments: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="corvane.jobs")
    parser.add_argument("--input-gb", type=int, help="rough size of the input, sets the shuffle partitions")
    choices = parser.add_subparsers(dest="job", required=True)
    for name, (_, parameters) in JOBS.items():
        command = choices.add_parser(name)
        for parameter in parameters:
            options = {"type": int, "default": argparse.SUPPRESS} if parameter.startswith("--") else {}
            command.add_argument(parameter, **options)
    chosen = vars(parser.parse_args(arguments))
    job, _ = JOBS[chosen.pop("job")]
    size = chosen.pop("input_gb")
    job(build_session("corvane", input_bytes=None if size is None else size << 30), **chosen)


if __name__ == "__main__":
    main()
