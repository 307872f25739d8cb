"""Databases, managed and external tables, and table transfer."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame, SparkSession


def create_database(spark: SparkSession, name: str, location: str | None = None) -> None:
    """Create a database unless it exists; managed tables go below ``location``."""
    where = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{name}`{where}")


def _versions(spark: SparkSession, table: str) -> str:
    """The folder that holds the versions of a table, beside the folders of its database's tables."""
    known = spark.catalog.getTable(table)
    database = known.namespace[-1]
    return f"{spark.catalog.getDatabase(database).locationUri.rstrip('/')}/{known.name}__versions"


def table_location(spark: SparkSession, table: str) -> str:
    """The folder a table's rows are read from."""
    return spark.sql(f"DESCRIBE EXTENDED {table}").where("col_name = 'Location'").select("data_type").first()[0]


def _point(spark: SparkSession, table: str, folder: str) -> None:
    spark.sql(f"ALTER TABLE {table} SET LOCATION '{folder}'")


def refresh_table(df: DataFrame, table: str) -> DataFrame:
    """Replace all rows of a table of the same columns, and return a scan of it.

    The rows are written to a folder of their own, then one change in the catalog
    points the table there. Whoever asks for the table sees the old or the new rows,
    never none and never a mixture; a reader that began with the old rows goes
    on with them. A load that fails before the change leaves the table as it
    was. Old versions stay until :func:`remove_old_versions`.
    """
    spark = df.sparkSession
    wanted = [(field.name.lower(), field.dataType) for field in df.schema]
    if wanted != [(field.name.lower(), field.dataType) for field in spark.table(table).schema]:
        raise ValueError(f"{table} has other columns; a refresh keeps them")
    folder = f"{_versions(spark, table)}/{uuid.uuid4().hex}"
    df.write.parquet(folder)
    _point(spark, table, folder)
    return spark.table(table)


def remove_old_versions(spark: SparkSession, table: str) -> int:
    """Delete all versions of a table but the current one; run it when no load or old reader is under way."""
    current = table_location(spark, table).rstrip("/").rsplit("/", 1)[-1]
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(_versions(spark, table))
    system = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not system.exists(path):
        return 0
    old = [each.getPath() for each in system.listStatus(path) if each.getPath().getName() != current]
    for each in old:
        system.delete(each, True)
    return len(old)


def save_table(df: DataFrame, table: str, mode: str = "overwrite") -> DataFrame:
    """Write a managed Parquet table and return a scan of it.

    An overwrite of a table with the same columns is a :func:`refresh_table`. One
    with other columns cannot be a single change of the catalog: a new table is
    written first, then the old one is dropped and the new one renamed, so there is a moment without
    the table, and a failure in between leaves the new rows under ``<table>__new_…``.
    """
    spark = df.sparkSession
    if mode != "overwrite" or not spark.catalog.tableExists(table):
        df.write.mode(mode).saveAsTable(table)
        return spark.table(table)
    before = spark.table(table).schema
    if [(f.name.lower(), f.dataType) for f in before] == [(f.name.lower(), f.dataType) for f in df.schema]:
        return refresh_table(df, table)
    staged = f"{table}__new_{uuid.uuid4().hex[:12]}"
    df.write.saveAsTable(staged)
    spark.sql(f"DROP TABLE {table}")
    spark.sql(f"ALTER TABLE {staged} RENAME TO {table}")
    return spark.table(table)


def create_external_csv_table(spark: SparkSession, table: str, columns: str, path: str, header: bool = True) -> None:
    """Declare a table over CSV files; dropping it leaves the files in place."""
    flag = "true" if header else "false"
    spark.sql(f"CREATE TABLE {table} ({columns}) USING csv OPTIONS (header '{flag}', path '{path}')")


def table_kind(spark: SparkSession, table: str) -> str:
    """``MANAGED`` or ``EXTERNAL``, as the description of the table states it."""
    described = spark.sql(f"DESCRIBE EXTENDED {table}")
    return described.where("col_name = 'Type'").select("data_type").first()[0]


def transfer_tables(
    spark: SparkSession,
    read_table: Callable[[str], DataFrame],
    names: Iterable[str],
    database: str | None = None,
) -> dict[str, DataFrame]:
    """Register each source table as a view, or copy it to a table of ``database``.

    ``read_table`` maps a name to a DataFrame, for example
    ``functools.partial(jdbc.read_table, spark, connection)``.
    """
    moved = {}
    for name in names:
        df = read_table(name)
        if database is None:
            df.createOrReplaceTempView(name)
            moved[name] = spark.table(name)
        else:
            moved[name] = save_table(df, f"{database}.{name}")
    return moved
