"""Tables written to a database over JDBC."""

from __future__ import annotations

from pyspark.sql import DataFrame

from corvane.sources.jdbc import Connection


def write_table(
    df: DataFrame, connection: Connection, table: str, mode: str = "errorifexists", sessions: int | None = None
) -> None:
    """Create the table and fill it; ``sessions`` bounds the open database sessions."""
    writer = df.write.format("jdbc").options(**connection.options(table)).mode(mode)
    if sessions is not None:
        writer = writer.option("numPartitions", str(sessions))
    writer.save()
