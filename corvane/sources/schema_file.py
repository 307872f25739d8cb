"""Column names and types kept in a small text file."""

from __future__ import annotations

import ast

from pyspark.sql import SparkSession
from pyspark.sql import types as T

# Warehouse type names and the types they load as.
WAREHOUSE_TYPES = {
    "INTEGER": T.LongType(),
    "STRING": T.StringType(),
    "BOOL": T.BooleanType(),
    "BIGNUMERIC": T.DecimalType(38, 9),
}


def parse_layout(text: str) -> dict[str, str]:
    """Names and type names from a dict literal, ``name:TYPE`` lines or ``name:TYPE,…``."""
    text = text.strip()
    if text.startswith("{"):
        return dict(ast.literal_eval(text))
    parts = [part.strip() for line in text.splitlines() for part in line.split(",")]
    return dict(part.split(":") for part in parts if part)


def layout_text(layout: dict[str, str]) -> str:
    return ",".join(f"{name}:{kind}" for name, kind in layout.items())


def struct_type(layout: str) -> T.StructType:
    """The Spark schema of a layout text; an unknown type name is a ``KeyError``."""
    return T.StructType([T.StructField(name, WAREHOUSE_TYPES[kind]) for name, kind in parse_layout(layout).items()])


def read_schema(spark: SparkSession, path: str) -> T.StructType:
    """The Spark schema a schema file describes, on any file system Spark reads."""
    return struct_type(spark.read.text(path, wholetext=True).first()[0])
