"""SQL text, views, databases and tables."""

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corvane.catalogue.registry import query
from corvane.catalogue.views import Views
from corvane.operators import catalog
from corvane.scratch import new_folder
from corvane.sinks import files as sinks

DATABASE = "corvane_tables"


def tables_database(v: Views) -> str:
    """A database whose managed tables lie in the folder shared by all executors."""
    if not v.spark.catalog.databaseExists(DATABASE):
        catalog.create_database(v.spark, DATABASE, new_folder(v.spark, DATABASE))
    return DATABASE


def unique(name: str) -> str:
    """A name of this call's own: another call must not change what a result still has to read."""
    return f"{name}_{uuid.uuid4().hex[:12]}"


def _suppliers(v: Views) -> DataFrame:
    return v.table("supplier").select("s_suppkey", "s_name")


@query("sql_view_select", "SELECT Name FROM cars WHERE Origin = 'USA'", "cars")
def select_from_a_view(v: Views):
    view = unique("corvane_cars")
    v.cars().createOrReplaceTempView(view)
    return v.spark.sql(f"SELECT Name FROM {view} WHERE Origin = 'USA'")


@query("cat_table", "SELECT s_suppkey, s_name FROM supplier")
def read_a_named_table(v: Views):
    view = unique("corvane_suppliers")
    _suppliers(v).createOrReplaceTempView(view)
    return v.spark.read.table(view)


@query("cat_save_table", "SELECT Title, Major_Genre, IMDB_Rating FROM movies", "movies")
def save_a_managed_table(v: Views):
    movies = v.movies().select("Title", "Major_Genre", "IMDB_Rating")
    return catalog.save_table(movies, f"{tables_database(v)}.{unique('movies')}")


@query(
    "cat_database",
    "SELECT 'corvane_tables' AS current_db, TRUE AS listed, count(*) AS n FROM supplier",
)
def use_a_database(v: Views):
    database, before = tables_database(v), v.spark.catalog.currentDatabase()
    table = unique("used_suppliers")
    catalog.save_table(_suppliers(v), f"{database}.{table}")
    v.spark.sql(f"USE {database}")
    try:
        current = v.spark.sql("SELECT current_database()").first()[0]
        listed = v.spark.sql(f"SHOW DATABASES LIKE '{database}'").count() == 1
        rows = v.spark.table(table)
    finally:
        v.spark.sql(f"USE {before}")
    return rows.agg(F.count("*").alias("n")).select(
        F.lit(current).alias("current_db"), F.lit(listed).alias("listed"), "n"
    )


@query("cat_insert", "SELECT CAST(s_suppkey AS INTEGER) AS id, s_name AS name FROM supplier")
def insert_into_a_table(v: Views):
    table = f"{tables_database(v)}.{unique('persons')}"
    v.spark.sql(f"CREATE TABLE {table} (id integer, name string) USING parquet")
    view = unique("corvane_suppliers")
    _suppliers(v).createOrReplaceTempView(view)
    v.spark.sql(f"INSERT INTO {table} SELECT CAST(s_suppkey AS integer), s_name FROM {view}")
    return v.spark.sql(f"SELECT * FROM {table}")


def _external(v: Views, name: str) -> str:
    """An external table over CSV files of the suppliers."""
    table, path = f"{tables_database(v)}.{unique(name)}", new_folder(v.spark, name)
    sinks.write_csv(_suppliers(v), path)
    catalog.create_external_csv_table(v.spark, table, "s_suppkey bigint, s_name string", path)
    return table


@query(
    "cat_describe",
    """SELECT 'MANAGED' AS kind, count(*) AS n FROM supplier UNION ALL SELECT 'EXTERNAL', count(*) FROM supplier""",
)
def describe_tables(v: Views):
    managed = f"{tables_database(v)}.{unique('described')}"
    catalog.save_table(_suppliers(v), managed)
    counted = [
        v.spark.table(table).agg(F.lit(catalog.table_kind(v.spark, table)).alias("kind"), F.count("*").alias("n"))
        for table in (managed, _external(v, "described_files"))
    ]
    return counted[0].union(counted[1])


@query("cat_external", "SELECT s_suppkey, s_name FROM supplier UNION ALL SELECT s_suppkey, s_name FROM supplier")
def insert_into_an_external_table(v: Views):
    table = _external(v, "external_suppliers")
    view = unique("corvane_suppliers")
    _suppliers(v).createOrReplaceTempView(view)
    v.spark.sql(f"INSERT INTO {table} SELECT s_suppkey, s_name FROM {view}")
    return v.spark.table(table)


@query(
    "cat_transfer",
    """SELECT s_name AS name, 'supplier' AS source FROM supplier UNION ALL SELECT n_name, 'nation' FROM nation
       UNION ALL SELECT s_name, 'supplier view' FROM supplier""",
)
def transfer_tables(v: Views):
    suppliers, nations, view = unique("supplier"), unique("nation"), unique("supplier_view")
    read = lambda name: v.table(name.split("_")[0])
    stored = catalog.transfer_tables(v.spark, read, [suppliers, nations], database=tables_database(v))
    viewed = catalog.transfer_tables(v.spark, read, [view])
    return (
        stored[suppliers].select(F.col("s_name").alias("name"), F.lit("supplier").alias("source"))
        .union(stored[nations].select("n_name", F.lit("nation")))
        .union(viewed[view].select("s_name", F.lit("supplier view")))
    )
