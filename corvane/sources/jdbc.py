"""Database tables over JDBC."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class Connection:
    """Where a database is and who asks; ``namespace`` prefixes table names."""

    url: str
    driver: str
    user: str | None = None
    password: str | None = field(default=None, repr=False)
    namespace: str = "public"

    def options(self, table: str) -> dict[str, str]:
        named = {"url": self.url, "driver": self.driver, "user": self.user, "password": self.password}
        options = {key: value for key, value in named.items() if value is not None}
        options["dbtable"] = f"{self.namespace}.{table}" if self.namespace else table
        return options


@dataclass(frozen=True)
class Split:
    """How a scan is cut into ranges of a numeric or date column, one query each."""

    column: str
    lower: str
    upper: str
    parts: int

    def options(self) -> dict[str, str]:
        return {
            "partitionColumn": self.column,
            "lowerBound": self.lower,
            "upperBound": self.upper,
            "numPartitions": str(self.parts),
        }


def read_table(
    spark: SparkSession, connection: Connection, table: str, split: Split | None = None, fetch_size: int = 10_000
) -> DataFrame:
    """Scan a table. Without a split one task reads it all, so give one for a large table."""
    options = connection.options(table) | {"fetchsize": str(fetch_size)}
    if split is not None:
        options |= split.options()
    return spark.read.format("jdbc").options(**options).load()
