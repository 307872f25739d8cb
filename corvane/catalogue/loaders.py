"""Line clean-up and schema-driven loads."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corvane.catalogue.catalog_tables import tables_database, unique
from corvane.catalogue.registry import query
from corvane.catalogue.social import IMPACT_SQL, JOINED, PROFILE_IMPACT_SQL, WEEKDAY_SQL
from corvane.catalogue.views import Views
from corvane.functions import lines
from corvane.operators import loading
from corvane.plans import social
from corvane.scratch import new_folder
from corvane.sinks import files as sinks

# Orders, moved ten years on, as bicycle-hire lines: a quoted id, two date-times, a bare NULL.
_HIRE_LINE = """concat('"', o_orderkey, '",', o_custkey, ',', date_format(start, 'M/d/yyyy H:mm'), ',',
    o_orderpriority, ',NULL,', date_format(start, 'MM/dd/yyyy HH:mm'), ',', o_orderstatus, ',extra')"""


def _hires(v: Views) -> DataFrame:
    orders = v.table("orders").withColumn("start", F.expr("o_orderdate + INTERVAL 10 YEARS"))
    return orders.select(F.expr(_HIRE_LINE).alias("line"))


def _names(columns: str) -> list[str]:
    return columns.split()


@query(
    "load_parse",
    """SELECT CAST(o_orderkey AS VARCHAR) AS trip, CAST(o_custkey AS VARCHAR) AS bike, o_orderpriority AS note,
         'NULL' AS station FROM orders""",
)
def parse_lines(v: Views):
    fields = lines.fields_by_name(F.col("line"), _names("trip bike start note station"))
    return _hires(v).select(*fields).drop("start")


@query(
    "load_replace_nulls",
    """SELECT CAST(o_orderkey AS VARCHAR) AS trip, o_orderpriority AS note, '' AS station, '' AS station_only
       FROM orders""",
)
def drop_null_words(v: Views):
    names = _names("trip bike start note station")
    everywhere = lines.fields_by_name(lines.drop_null_words(F.col("line")), names)
    fields_only = lines.fields_by_name(lines.drop_null_words(F.col("line"), whole_fields_only=True), names)
    return _hires(v).select(everywhere[0], everywhere[3], everywhere[4], fields_only[4].alias("station_only"))


@query(
    "load_datetime",
    """SELECT CAST(o_orderkey AS VARCHAR) AS trip, strftime(o_orderdate + INTERVAL 10 YEAR, '%Y-%m-%d %H:%M:%S') AS started,
         strftime(o_orderdate + INTERVAL 10 YEAR, '%Y-%m-%d %H:%M:%S') AS ended FROM orders""",
)
def rewrite_datetimes(v: Views):
    line = lines.rewrite_datetimes(F.col("line"))
    fields = lines.fields_by_name(line, _names("trip bike started note station ended"))
    return _hires(v).select(*fields).select("trip", "started", "ended")


@query(
    "load_deconcat",
    """SELECT CASE WHEN o_orderkey % 3 = 0 THEN '9' || lpad(CAST(o_orderkey % 1000000 AS VARCHAR), 6, '0')
           WHEN o_orderkey % 3 = 1 THEN '1' || lpad(CAST(o_orderkey % 10000000 AS VARCHAR), 7, '0')
           ELSE '7' || lpad(CAST(o_orderkey % 1000000 AS VARCHAR), 6, '0') || '12345' END AS trip,
         CASE WHEN o_orderkey % 3 = 2 THEN o_orderpriority ELSE '12345' END AS duration FROM orders""",
)
def split_joined_ids(v: Views):
    line = F.expr(
        """concat(CASE o_orderkey % 3 WHEN 0 THEN concat('9', lpad(o_orderkey % 1000000, 6, '0'))
                 WHEN 1 THEN concat('1', lpad(o_orderkey % 10000000, 7, '0'))
                 ELSE concat('7', lpad(o_orderkey % 1000000, 6, '0')) END, '12345,', o_orderpriority)"""
    )
    mended = v.table("orders").select(lines.split_joined_id(line).alias("line"))
    return mended.select(*lines.fields_by_name(F.col("line"), ["trip", "duration"]))


def _csv(v: Views, df: DataFrame, name: str) -> str:
    path = new_folder(v.spark, name)
    sinks.write_csv(df, path)
    return path


def _load(v: Views, df: DataFrame, layout: str, name: str) -> DataFrame:
    return loading.load_lines(v.spark, _csv(v, df, name), layout, f"{tables_database(v)}.{unique(name)}")


# A null is written as an empty field, which loads as null unless the column is text.
_TEXT_NULLS = "coalesce({0}, '') AS {0}"


@query(
    "load_fixed_layouts",
    f"""SELECT CAST(year AS BIGINT) AS year, {_TEXT_NULLS.format("followers")}, is_business_account,
          {_TEXT_NULLS.format("post_type")}, {_TEXT_NULLS.format("number_characters")},
          {_TEXT_NULLS.format("number_hashtags")}, total_likes, total_comments
        FROM ({PROFILE_IMPACT_SQL})""",
    JOINED,
)
def load_profile_impact(v: Views):
    impact = social.profile_impact_from_sources(v.profiles(), v.locations(), v.posts())
    return _load(v, impact, loading.PROFILE_IMPACT_LAYOUT, "profile_impact")


@query(
    "load_fixed_layouts_impact",
    f"""SELECT CAST(year_post AS BIGINT) AS year_post, {_TEXT_NULLS.format("post_type")},
          CAST(number_likes AS DOUBLE) AS number_likes, CAST(number_comments AS DOUBLE) AS number_comments
        FROM ({IMPACT_SQL})""",
    "posts",
)
def load_impact(v: Views):
    table = _load(v, social.impact_per_type(v.posts()), loading.POST_IMPACT_LAYOUT, "post_impact")
    return table.withColumns({n: F.col(n).cast("double") for n in ("number_likes", "number_comments")})


@query(
    "load_fixed_layouts_weekday",
    f"""SELECT CAST(year_post AS BIGINT) AS year_post, name_day_of_week, CAST(n_reg AS DOUBLE) AS n_reg
        FROM ({WEEKDAY_SQL})""",
    "posts",
)
def load_weekdays(v: Views):
    table = _load(v, social.posts_per_weekday(v.posts()), loading.WEEKDAY_LAYOUT, "weekdays")
    return table.withColumn("n_reg", F.col("n_reg").cast("double"))


@query(
    "load_schema_file",
    """SELECT o_orderkey AS id, o_orderstatus AS status, CASE WHEN o_orderkey % 4 <> 0 THEN o_custkey END AS customer,
         o_orderkey % 2 = 0 AS even, o_totalprice AS price FROM orders""",
)
def load_with_schema_file(v: Views):
    schema_path = new_folder(v.spark, "schema_file")
    text = "id:INTEGER\nstatus:STRING\ncustomer:INTEGER\neven:BOOL\nprice:BIGNUMERIC"
    v.spark.createDataFrame([(text,)], "value string").coalesce(1).write.text(schema_path)
    customer = F.when(F.col("o_orderkey") % 4 != 0, F.col("o_custkey").cast("string")).otherwise("NULL")
    orders = v.table("orders").select(
        F.col("o_orderkey").alias("id"),
        F.col("o_orderstatus").alias("status"),
        customer.alias("customer"),
        (F.col("o_orderkey") % 2 == 0).alias("even"),
        F.col("o_totalprice").cast("decimal(20,2)").alias("price"),
    )
    path = _csv(v, orders, "orders_csv")
    table = loading.load_with_schema_file(v.spark, path, schema_path, f"{tables_database(v)}.{unique('loaded_orders')}")
    return table.withColumn("price", F.col("price").cast("double"))
