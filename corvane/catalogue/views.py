"""Posts, trips, movies, cars, staff … derived from the tables of a data folder.

Each view exists twice: as a DataFrame, and as SQL text for the check engine.
All rows of the base tables take part.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corvane.plans.social import join_sources


def _within_day(moment: str, key: str) -> str:
    """A midnight moment moved to a time of day that follows from the key."""
    return f"timestamp_seconds(unix_timestamp({moment}) + {key} * 7919 % 86400)"


class Views:
    """The tables below ``folder``, and the views over them."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    def posts(self) -> DataFrame:
        return self.table("orders").selectExpr(
            "o_orderkey AS sid",
            "o_custkey * 10 AS sid_profile",
            "cast(o_orderkey AS string) AS post_id",
            "o_custkey AS profile_id",
            "o_orderkey % 90 AS location_id",
            f"CASE WHEN o_orderkey % 97 != 0 THEN {_within_day('o_orderdate', 'o_orderkey')} END AS cts",
            "cast(o_orderkey % 5 AS int) AS post_type",
            """CASE WHEN o_orderkey % 10 = 0 THEN NULL WHEN o_orderkey % 11 = 0 THEN o_orderpriority ELSE concat(
                 '#', lower(o_orderstatus), ' ', o_orderpriority, if(o_orderkey % 13 = 0, '  ', ' '),
                 '#p', o_orderkey % 7, repeat(' #x', cast(o_orderkey % 60 AS int)),
                 repeat(' word', cast(o_orderkey % 50 AS int))) END AS description""",
            "cast(floor(o_totalprice) AS bigint) AS numbr_likes",
            "CASE WHEN o_orderkey % 23 != 0 THEN o_orderkey % 50 END AS number_comments",
        )

    def profiles(self) -> DataFrame:
        return self.table("customer").selectExpr(
            "cast(c_custkey AS string) AS profile_id",
            "lower(c_name) AS profile_name",
            "c_name AS firstname_lastname",
            "CASE WHEN c_custkey % 3 = 0 THEN c_mktsegment END AS description",
            "cast(c_custkey % 500 AS string) AS following",
            "CASE WHEN c_custkey % 19 = 0 THEN 'n/a' ELSE cast(c_custkey * 997 AS string) END AS followers",
            "concat('u/', c_custkey) AS url",
            "concat('2019-0', c_custkey % 10, '-15 10:20:30') AS cts",
            "if(c_mktsegment = 'BUILDING', 'True', 'False') AS is_business_account",
        )

    def locations(self) -> DataFrame:
        nation = self.table("nation")
        return self.table("supplier").join(nation, nation["n_nationkey"] == F.col("s_nationkey")).selectExpr(
            "cast(s_suppkey * 9 div 10 AS string) AS id",
            "s_name AS name",
            "concat(s_suppkey % 40, ' Main St') AS street",
            "cast(s_suppkey % 1000 + 1000 AS string) AS zip",
            "CASE WHEN s_suppkey % 7 != 0 THEN concat('City ', s_suppkey % 30) END AS city",
            "n_name AS region",
            "CASE WHEN s_suppkey % 11 != 0 THEN if(n_regionkey = 1, 'US', n_name) END AS cd",
            "CASE WHEN s_suppkey % 4 = 0 THEN 'unlisted' END AS phone",
            "concat(s_suppkey % 120, '.25') AS lat",
            "if(s_suppkey % 9 = 0, 'west', concat(s_suppkey % 180, '.5')) AS lng",
            "concat('w/', s_suppkey) AS website",
        )

    def joined(self) -> DataFrame:
        return join_sources(self.profiles(), self.locations(), self.posts())

    def trips(self) -> DataFrame:
        return self.table("lineitem").selectExpr(
            "cast(l_suppkey % 27 AS int) AS PULocationID",
            "cast(l_partkey % 26 AS int) AS DOLocationID",
            f"{_within_day('l_shipdate', 'l_orderkey')} AS tpep_pickup_datetime",
            "l_quantity AS trip_distance",
            "l_returnflag AS RatecodeID",
            "l_linenumber AS passenger_count",
            "l_extendedprice AS total_amount",
        )

    def history_trips(self) -> DataFrame:
        return self.trips().selectExpr(
            "tpep_pickup_datetime AS pickup_datetime", "PULocationID AS pickup_taxizone_id", "total_amount"
        )

    def zones(self) -> DataFrame:
        region = self.table("region")
        return self.table("nation").join(region, region["r_regionkey"] == F.col("n_regionkey")).selectExpr(
            "n_nationkey AS LocationID", "r_name AS Borough", "n_name AS Zone", "'Boro Zone' AS service_zone"
        )

    def movies(self) -> DataFrame:
        day = "date_add(date'1990-01-01', cast(p_partkey * 37 % 12000 AS int))"
        return self.table("part").selectExpr(
            "concat(p_name, ',', p_partkey) AS Title",
            f"""CASE WHEN p_partkey % 29 = 0 THEN 'unknown'
                  WHEN p_partkey % 3 = 0 THEN date_format({day}, 'd-MMM-yy')
                  WHEN p_partkey % 3 = 1 THEN date_format({day}, 'yyyy-MM-dd')
                  ELSE date_format({day}, 'MMM d yyyy') END AS Release_Date""",
            "CASE WHEN p_partkey % 13 != 0 THEN p_type END AS Major_Genre",
            "CASE WHEN p_partkey % 11 != 0 THEN p_size / 5 END AS IMDB_Rating",
            "CASE WHEN p_partkey % 3 != 0 THEN cast(p_size AS bigint) * 2 END AS Rotten_Tomatoes_Rating",
            "cast(floor(p_retailprice * 1000) AS bigint) AS US_Gross",
            "cast(floor(p_retailprice) * 3 AS bigint) AS Worldwide_Gross",
            "CASE WHEN p_partkey % 5 != 0 THEN cast(p_size AS bigint) * 100 END AS US_DVD_Sales",
            "CASE WHEN p_partkey % 17 != 0 THEN p_brand END AS Director",
        )

    def cars(self) -> DataFrame:
        return self.table("customer").selectExpr(
            """concat(element_at(array('volkswagen', 'vw', 'ford', 'mercedes-benz', 'toyota', 'Ford'),
                 cast(c_custkey % 6 + 1 AS int)), ' ', c_custkey) AS Name""",
            "CASE WHEN c_custkey % 8 != 0 THEN (c_custkey % 40 + 10) / 2 END AS Miles_per_Gallon",
            "c_custkey % 5 + 4 AS Cylinders",
            "cast(c_custkey % 300 + 100 AS double) AS Displacement",
            "CASE WHEN c_custkey % 7 != 0 THEN c_custkey % 200 + 50 END AS Horsepower",
            "c_custkey * 13 % 3000 + 2000 AS Weight_in_lbs",
            "(c_custkey % 50 + 80) / 10 AS Acceleration",
            "concat(c_custkey % 13 + 1970, '-01-01') AS Year",
            "element_at(array('USA', 'Europe', 'Japan'), c_nationkey % 3 + 1) AS Origin",
        )

    def stocks(self) -> DataFrame:
        return self.table("events").selectExpr(
            "upper(event_type) AS symbol", "date_format(ts, 'MMM dd yyyy') AS date", "value AS price"
        )

    def guitars(self) -> DataFrame:
        return self.table("part").selectExpr(
            "p_partkey AS guitarId", "p_brand AS make", "p_name AS model", "p_type AS guitarType"
        )

    def players(self) -> DataFrame:
        return self.table("customer").selectExpr(
            "c_custkey AS id",
            "c_name AS name",
            """CASE WHEN c_custkey % 10 != 0
                 THEN array(c_custkey * 3, c_custkey * 7 % 4001, cast(c_nationkey AS bigint)) END AS guitars""",
            "c_nationkey + c_custkey % 4 AS band",
        )

    def bands(self) -> DataFrame:
        """One band per supplier; players name only some of them."""
        return self.table("supplier").selectExpr("s_suppkey AS bandId", "s_name AS bandName", "s_nationkey AS town")

    def employees(self) -> DataFrame:
        return self.table("customer").selectExpr(
            "c_custkey AS emp_no", "date_add(date'1998-01-01', cast(c_custkey % 1000 AS int)) AS hire_date"
        )

    def dept_emp(self) -> DataFrame:
        return self.table("customer").selectExpr("c_custkey AS emp_no", "c_nationkey AS dept_no")

    def departments(self) -> DataFrame:
        return self.table("nation").selectExpr("n_nationkey AS dept_no", "n_name AS dept_name")

    def salaries(self) -> DataFrame:
        return self.table("orders").selectExpr("o_custkey AS emp_no", "o_totalprice AS salary")

    def titles(self) -> DataFrame:
        return self.table("orders").selectExpr(
            "o_custkey AS emp_no", "o_orderpriority AS title", "to_date(o_orderdate) AS to_date"
        )

    def dept_manager(self) -> DataFrame:
        return self.table("supplier").selectExpr("s_suppkey * 3 AS emp_no")


SQL_VIEWS = {
    "posts": """
        SELECT o_orderkey AS sid, o_custkey * 10 AS sid_profile, CAST(o_orderkey AS VARCHAR) AS post_id,
          o_custkey AS profile_id, o_orderkey % 90 AS location_id,
          CASE WHEN o_orderkey % 97 <> 0 THEN o_orderdate + to_seconds(o_orderkey * 7919 % 86400) END AS cts,
          CAST(o_orderkey % 5 AS INTEGER) AS post_type,
          CASE WHEN o_orderkey % 10 = 0 THEN NULL WHEN o_orderkey % 11 = 0 THEN o_orderpriority ELSE
            '#' || lower(o_orderstatus) || ' ' || o_orderpriority
            || CASE WHEN o_orderkey % 13 = 0 THEN '  ' ELSE ' ' END || '#p' || CAST(o_orderkey % 7 AS VARCHAR)
            || repeat(' #x', o_orderkey % 60) || repeat(' word', o_orderkey % 50) END AS description,
          CAST(floor(o_totalprice) AS BIGINT) AS numbr_likes,
          CASE WHEN o_orderkey % 23 <> 0 THEN o_orderkey % 50 END AS number_comments
        FROM orders""",
    "profiles": """
        SELECT CAST(c_custkey AS VARCHAR) AS profile_id, lower(c_name) AS profile_name, c_name AS firstname_lastname,
          CASE WHEN c_custkey % 3 = 0 THEN c_mktsegment END AS description,
          CAST(c_custkey % 500 AS VARCHAR) AS following,
          CASE WHEN c_custkey % 19 = 0 THEN 'n/a' ELSE CAST(c_custkey * 997 AS VARCHAR) END AS followers,
          'u/' || CAST(c_custkey AS VARCHAR) AS url,
          '2019-0' || CAST(c_custkey % 10 AS VARCHAR) || '-15 10:20:30' AS cts,
          CASE WHEN c_mktsegment = 'BUILDING' THEN 'True' ELSE 'False' END AS is_business_account
        FROM customer""",
    "locations": """
        SELECT CAST(s_suppkey * 9 // 10 AS VARCHAR) AS id, s_name AS name,
          CAST(s_suppkey % 40 AS VARCHAR) || ' Main St' AS street,
          CAST(s_suppkey % 1000 + 1000 AS VARCHAR) AS zip,
          CASE WHEN s_suppkey % 7 <> 0 THEN 'City ' || CAST(s_suppkey % 30 AS VARCHAR) END AS city,
          n_name AS region,
          CASE WHEN s_suppkey % 11 = 0 THEN NULL WHEN n_regionkey = 1 THEN 'US' ELSE n_name END AS cd,
          CASE WHEN s_suppkey % 4 = 0 THEN 'unlisted' END AS phone,
          CAST(s_suppkey % 120 AS VARCHAR) || '.25' AS lat,
          CASE WHEN s_suppkey % 9 = 0 THEN 'west' ELSE CAST(s_suppkey % 180 AS VARCHAR) || '.5' END AS lng,
          'w/' || CAST(s_suppkey AS VARCHAR) AS website
        FROM supplier JOIN nation ON s_nationkey = n_nationkey""",
    "joined": """
        SELECT CAST(a.profile_id AS BIGINT) AS profile_id, a.profile_name, a.description, a.following,
          TRY_CAST(a.followers AS BIGINT) AS followers, a.url, TRY_CAST(a.cts AS TIMESTAMP) AS timestamp_location,
          TRY_CAST(a.is_business_account AS BOOLEAN) AS is_business_account, b.name AS location_name, b.street,
          b.zip, b.city, b.region, b.cd AS country_code, b.phone, TRY_CAST(b.lat AS DECIMAL(8,6)) AS latitude,
          TRY_CAST(b.lng AS DECIMAL(9,6)) AS longitude, b.website, c.post_id, c.cts AS timestamp_post, c.post_type,
          c.description AS description_post, c.numbr_likes AS number_likes, c.number_comments
        FROM profiles a LEFT JOIN locations b ON a.profile_id = b.id
        LEFT JOIN posts c ON CAST(a.profile_id AS BIGINT) = c.profile_id""",
    "trips": """
        SELECT CAST(l_suppkey % 27 AS INTEGER) AS PULocationID, CAST(l_partkey % 26 AS INTEGER) AS DOLocationID,
          l_shipdate + to_seconds(l_orderkey * 7919 % 86400) AS tpep_pickup_datetime, l_quantity AS trip_distance,
          l_returnflag AS RatecodeID, l_linenumber AS passenger_count, l_extendedprice AS total_amount
        FROM lineitem""",
    "zones": """
        SELECT n_nationkey AS LocationID, r_name AS Borough, n_name AS Zone, 'Boro Zone' AS service_zone
        FROM nation JOIN region ON n_regionkey = r_regionkey""",
    "movies": """
        SELECT p_name || ',' || CAST(p_partkey AS VARCHAR) AS Title,
          CASE WHEN p_partkey % 29 = 0 THEN 'unknown'
            WHEN p_partkey % 3 = 0 THEN CAST(day(d) AS VARCHAR) || strftime(d, '-%b-%y')
            WHEN p_partkey % 3 = 1 THEN strftime(d, '%Y-%m-%d')
            ELSE strftime(d, '%b ') || CAST(day(d) AS VARCHAR) || strftime(d, ' %Y') END AS Release_Date,
          CASE WHEN p_partkey % 13 <> 0 THEN p_type END AS Major_Genre,
          CASE WHEN p_partkey % 11 <> 0 THEN p_size / 5.0::DOUBLE END AS IMDB_Rating,
          CASE WHEN p_partkey % 3 <> 0 THEN CAST(p_size AS BIGINT) * 2 END AS Rotten_Tomatoes_Rating,
          CAST(floor(p_retailprice * 1000) AS BIGINT) AS US_Gross,
          CAST(floor(p_retailprice) * 3 AS BIGINT) AS Worldwide_Gross,
          CASE WHEN p_partkey % 5 <> 0 THEN CAST(p_size AS BIGINT) * 100 END AS US_DVD_Sales,
          CASE WHEN p_partkey % 17 <> 0 THEN p_brand END AS Director
        FROM (SELECT *, DATE '1990-01-01' + CAST(p_partkey * 37 % 12000 AS INTEGER) AS d FROM part)""",
    "cars": """
        SELECT ['volkswagen', 'vw', 'ford', 'mercedes-benz', 'toyota', 'Ford'][c_custkey % 6 + 1]
            || ' ' || CAST(c_custkey AS VARCHAR) AS Name,
          CASE WHEN c_custkey % 8 <> 0 THEN (c_custkey % 40 + 10) / 2.0::DOUBLE END AS Miles_per_Gallon,
          c_custkey % 5 + 4 AS Cylinders, CAST(c_custkey % 300 + 100 AS DOUBLE) AS Displacement,
          CASE WHEN c_custkey % 7 <> 0 THEN c_custkey % 200 + 50 END AS Horsepower,
          c_custkey * 13 % 3000 + 2000 AS Weight_in_lbs, (c_custkey % 50 + 80) / 10.0::DOUBLE AS Acceleration,
          CAST(c_custkey % 13 + 1970 AS VARCHAR) || '-01-01' AS Year,
          ['USA', 'Europe', 'Japan'][c_nationkey % 3 + 1] AS Origin
        FROM customer""",
    "stocks": """
        SELECT upper(event_type) AS symbol, strftime(ts, '%b %d %Y') AS date, value AS price FROM events""",
    "guitars": """
        SELECT p_partkey AS guitarId, p_brand AS make, p_name AS model, p_type AS guitarType FROM part""",
    "players": """
        SELECT c_custkey AS id, c_name AS name,
          CASE WHEN c_custkey % 10 <> 0 THEN [c_custkey * 3, c_custkey * 7 % 4001, c_nationkey] END AS guitars,
          c_nationkey + c_custkey % 4 AS band
        FROM customer""",
    "bands": "SELECT s_suppkey AS bandId, s_name AS bandName, s_nationkey AS town FROM supplier",
    "employees": """
        SELECT c_custkey AS emp_no, DATE '1998-01-01' + CAST(c_custkey % 1000 AS INTEGER) AS hire_date
        FROM customer""",
    "dept_emp": "SELECT c_custkey AS emp_no, c_nationkey AS dept_no FROM customer",
    "departments": "SELECT n_nationkey AS dept_no, n_name AS dept_name FROM nation",
    "salaries": "SELECT o_custkey AS emp_no, o_totalprice AS salary FROM orders",
    "titles": """
        SELECT o_custkey AS emp_no, o_orderpriority AS title, CAST(o_orderdate AS DATE) AS to_date FROM orders""",
    "dept_manager": "SELECT s_suppkey * 3 AS emp_no FROM supplier",
}
