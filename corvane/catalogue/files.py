"""Readers and writers: a view is written in one format and read back.

The files go to the folder shared by all executors, a new place per run.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corvane.catalogue.registry import query
from corvane.catalogue.views import Views
from corvane.functions.labels import POST_TYPES
from corvane.plans.social import visited_cities
from corvane.scratch import new_folder
from corvane.sinks import files as sinks
from corvane.sources import files as sources

# The layout of the cars source.
CARS_SCHEMA = (
    "Name string, Miles_per_Gallon double, Cylinders bigint, Displacement double, Horsepower bigint, "
    "Weight_in_lbs bigint, Acceleration double, Year date, Origin string"
)
CARS_SQL = """SELECT Name, Miles_per_Gallon, Cylinders, Displacement, Horsepower, Weight_in_lbs, Acceleration, Year,
    Origin FROM cars"""


def _plain_year(cars: DataFrame) -> DataFrame:
    return cars.withColumn("Year", F.col("Year").cast("string")).select(*[n.split()[0] for n in CARS_SCHEMA.split(", ")])


def _json_cars(v: Views, name: str) -> str:
    path = new_folder(v.spark, name) + ".json"
    sinks.write_json(v.cars(), path)
    return path


@query("src_json", CARS_SQL, "cars")
def json_inferred(v: Views):
    path = _json_cars(v, "src_json")
    schema, _ = sources.infer_json(v.spark, path)
    options = {"path": path, "mode": "FAILFAST"}
    return _plain_year(v.spark.read.format("json").options(**options).schema(schema).load())


@query("src_json_schema", CARS_SQL, "cars")
def json_with_captured_schema(v: Views):
    path = _json_cars(v, "src_json_schema")
    captured = v.spark.read.json(path).schema
    return _plain_year(sources.read_json(v.spark, path, captured))


@query("sink_json", CARS_SQL, "cars")
def json_with_given_schema(v: Views):
    return _plain_year(sources.read_json(v.spark, _json_cars(v, "sink_json"), CARS_SCHEMA, mode="FAILFAST"))


@query(
    "src_json_flags",
    "SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS day, o_orderstatus FROM orders",
)
def json_with_lenient_quotes_and_dates(v: Views):
    path = new_folder(v.spark, "src_json_flags")
    line = F.format_string(
        "{'o_orderkey': %d, 'day': '%s', 'o_orderstatus': '%s'}",
        "o_orderkey",
        F.date_format("o_orderdate", "dd/MM/yyyy"),
        "o_orderstatus",
    )
    v.table("orders").select(line.alias("value")).write.text(path)
    schema = "o_orderkey bigint, day date, o_orderstatus string"
    read = sources.read_json(v.spark, path, schema, dateFormat="dd/MM/yyyy", allowSingleQuotes=True)
    return read.withColumn("day", F.col("day").cast("string"))


@query(
    "src_csv_flags",
    "SELECT symbol, strftime(strptime(date, '%b %d %Y'), '%Y-%m-%d') AS date, price FROM stocks",
    "stocks",
)
def csv_typed(v: Views):
    path = new_folder(v.spark, "src_csv_flags") + ".csv"
    sinks.write_csv(v.stocks(), path)
    schema = "symbol string, date date, price double"
    read = sources.read_csv(v.spark, path, schema, dateFormat="MMM dd yyyy", nullValue="")
    return read.withColumn("date", F.col("date").cast("string"))


@query("src_csv_infer", "SELECT symbol, date, price FROM stocks", "stocks")
def csv_inferred(v: Views):
    path = new_folder(v.spark, "src_csv_infer") + ".csv"
    sinks.write_csv(v.stocks(), path)
    return sources.read_csv(v.spark, path, sources.infer_csv(v.spark, path))


_POSTS_SQL = """SELECT sid, sid_profile, post_id, profile_id, location_id,
    strftime(cts, '%Y-%m-%d %H:%M:%S') AS cts, post_type, {} AS description, numbr_likes, number_comments FROM posts"""


@query("src_tsv_typed", _POSTS_SQL.format("description"), "posts")
def tsv_typed(v: Views):
    path = new_folder(v.spark, "src_tsv_typed") + ".csv"
    sinks.write_csv(v.posts(), path, sep="\t")
    return sources.read_posts(v.spark, path).withColumn("cts", F.date_format("cts", "yyyy-MM-dd HH:mm:ss"))


@query("src_tsv_strings", "SELECT * FROM locations", "locations")
def tsv_as_text(v: Views):
    path = new_folder(v.spark, "src_tsv_strings") + ".csv"
    sinks.write_csv(v.locations(), path, sep="\t")
    return sources.read_text_columns(v.spark, path)


@query("src_by_extension", "SELECT *, 'tsv' AS source FROM locations UNION ALL SELECT *, 'parquet' FROM locations",
       "locations")
def format_by_extension(v: Views):
    folder = new_folder(v.spark, "src_by_extension")
    sinks.write_csv(v.locations(), f"{folder}/places.tsv", sep="\t")
    sinks.write_parquet(v.locations(), f"{folder}/places.parquet")
    tsv = sources.read_by_extension(v.spark, f"{folder}/places.tsv", sep="\t")
    parquet = sources.read_by_extension(v.spark, f"{folder}/places.parquet")
    return tsv.withColumn("source", F.lit("tsv")).unionByName(parquet.withColumn("source", F.lit("parquet")))


@query("src_text", "SELECT name || ' in ' || region AS value FROM locations", "locations")
def text_lines(v: Views):
    path = new_folder(v.spark, "src_text")
    v.locations().select(F.concat("name", F.lit(" in "), "region").alias("value")).write.text(path)
    return sources.read_lines(v.spark, path)


@query("src_text_parse", "SELECT symbol, date, price FROM stocks", "stocks")
def text_split_into_columns(v: Views):
    path = new_folder(v.spark, "src_text_parse")
    sinks.write_csv(v.stocks(), path)
    return sources.read_prices(v.spark, path)


_BAD_ROW = "o_orderkey % 10 = 0"
_ORDERS_SCHEMA = "o_orderkey bigint, o_custkey bigint, o_orderstatus string"


def _orders_with_bad_rows(v: Views) -> str:
    path = new_folder(v.spark, "bad_rows") + ".csv"
    customer = F.when(F.expr(_BAD_ROW), "none").otherwise(F.col("o_custkey").cast("string")).alias("o_custkey")
    sinks.write_csv(v.table("orders").select("o_orderkey", customer, "o_orderstatus"), path)
    return path


@query(
    "src_parse_modes",
    f"""SELECT 'PERMISSIVE' AS mode, o_orderkey, CASE WHEN NOT {_BAD_ROW} THEN o_custkey END AS o_custkey,
          o_orderstatus FROM orders
        UNION ALL SELECT 'DROPMALFORMED', o_orderkey, o_custkey, o_orderstatus FROM orders WHERE NOT {_BAD_ROW}""",
)
def parse_modes(v: Views):
    good, rejects = sources.read_parted(v.spark, "csv", _orders_with_bad_rows(v), _ORDERS_SCHEMA, header=True)
    fitting = [F.lit("PERMISSIVE"), F.lit("DROPMALFORMED")]
    both = good.select(F.explode(F.array(*fitting)).alias("mode"), "*")
    return both.union(rejects.select(fitting[0].alias("mode"), *good.columns))


@query(
    "src_rejects",
    f"""SELECT o_orderkey, CASE WHEN NOT {_BAD_ROW} THEN o_custkey END AS o_custkey, o_orderstatus, {_BAD_ROW} AS rejected,
          CASE WHEN {_BAD_ROW} THEN CAST(o_orderkey AS VARCHAR) || ',none,' || o_orderstatus END AS line
        FROM orders""",
)
def rejected_rows(v: Views):
    good, rejects = sources.read_parted(v.spark, "csv", _orders_with_bad_rows(v), _ORDERS_SCHEMA, header=True)
    kept = good.withColumns({"rejected": F.lit(False), "line": F.lit(None).cast("string")})
    return kept.union(rejects.select(*good.columns, F.lit(True), sources.CORRUPT))


@query(
    "src_literal",
    """SELECT label, label AS label_again, count(*) AS n
       FROM (SELECT CASE post_type WHEN 1 THEN 'photo' WHEN 2 THEN 'video' ELSE 'multy' END AS label FROM posts
             WHERE post_type IN (1, 2, 3)) GROUP BY label""",
    "posts",
)
def literal_rows(v: Views):
    inferred = v.spark.createDataFrame(list(POST_TYPES.items()), ["post_type", "label"])
    typed = v.spark.createDataFrame(list(POST_TYPES.items()), "post_type int, label_again string")
    counted = v.posts().groupBy("post_type").agg(F.count("*").alias("n"))
    return counted.join(inferred, "post_type").join(typed, "post_type").drop("post_type")


@query("sink_parquet", "SELECT symbol, date, price FROM stocks", "stocks")
def parquet_files(v: Views):
    path = new_folder(v.spark, "sink_parquet")
    sinks.write_parquet(v.stocks(), path)
    return sources.read_files(v.spark, "parquet", path)


@query("sink_tsv", _POSTS_SQL.format("description"), "posts")
def tsv_files(v: Views):
    path = new_folder(v.spark, "sink_tsv") + ".csv"
    sinks.write_csv(v.posts(), path, sep="\t")
    read = sources.read_by_extension(v.spark, path, sep="\t", schema=sources.POSTS_SCHEMA)
    return read.withColumn("cts", F.date_format("cts", "yyyy-MM-dd HH:mm:ss"))


@query(
    "sink_single_csv",
    """SELECT CASE WHEN cd = 'US' THEN 'United States' ELSE cd END AS country, city, CAST(count(*) AS INTEGER) AS n_reg
       FROM locations WHERE cd IS NOT NULL AND city IS NOT NULL GROUP BY 1, 2""",
    "locations",
)
def one_csv_file(v: Views):
    path = new_folder(v.spark, "sink_single_csv")
    sinks.write_csv(visited_cities(v.locations()), path, files=1)
    return sources.read_csv(v.spark, path, "country string, city string, n_reg int")


@query("sink_single_parquet", "SELECT cd, count(*) AS n FROM locations GROUP BY cd", "locations")
def one_parquet_file(v: Views):
    path = new_folder(v.spark, "sink_single_parquet")
    sinks.write_parquet(v.locations().groupBy("cd").agg(F.count("*").alias("n")), path, files=1)
    return sources.read_files(v.spark, "parquet", path)


@query(
    "sink_modes",
    "SELECT s_suppkey, s_name FROM supplier UNION ALL SELECT s_suppkey, s_name FROM supplier",
)
def save_modes(v: Views):
    path = new_folder(v.spark, "sink_modes")
    suppliers = v.table("supplier").select("s_suppkey", "s_name")
    nations = v.table("nation").selectExpr("cast(n_nationkey AS bigint) AS s_suppkey", "n_name AS s_name")
    sinks.write_parquet(nations, path, mode="overwrite")
    sinks.write_parquet(suppliers, path, mode="overwrite")
    sinks.write_parquet(suppliers, path, mode="append")
    sinks.write_parquet(nations, path, mode="ignore")
    return sources.read_files(v.spark, "parquet", path)


@query("sink_balanced", "SELECT symbol, date, price FROM stocks", "stocks")
def files_of_even_size(v: Views):
    path = new_folder(v.spark, "sink_balanced")
    sinks.write_balanced(v.stocks(), "parquet", path, ("symbol",))
    return sources.read_files(v.spark, "parquet", path).select("symbol", "date", "price")
