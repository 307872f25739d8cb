"""Schema-driven load of comma-separated files into a typed table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corvane.functions import lines
from corvane.operators.catalog import save_table
from corvane.sources import files
from corvane.sources.schema_file import read_schema, struct_type

# The column layouts of the three published result files.
PROFILE_IMPACT_LAYOUT = (
    "year:INTEGER,followers:STRING,is_business_account:BOOL,post_type:STRING,"
    "number_characters:STRING,number_hashtags:STRING,total_likes:INTEGER,total_comments:INTEGER"
)
POST_IMPACT_LAYOUT = "year_post:INTEGER,post_type:STRING,number_likes:BIGNUMERIC,number_comments:BIGNUMERIC"
WEEKDAY_LAYOUT = "year_post:INTEGER,name_day_of_week:STRING,n_reg:BIGNUMERIC"


def typed_rows(raw: DataFrame, schema: T.StructType, drop_nulls: bool = True) -> DataFrame:
    """Lines of one text column ``line`` as typed rows.

    Text that does not fit its type, the empty text included, becomes null.
    """
    line = lines.drop_null_words(F.col("line")) if drop_nulls else F.col("line")
    values = lines.fields_by_name(line, schema.names)
    return raw.select(
        *[value.try_cast(field.dataType).alias(field.name) for value, field in zip(values, schema, strict=True)]
    )


def load_lines(
    spark: SparkSession, paths: str | list[str], layout: str, table: str, drop_nulls: bool = True
) -> DataFrame:
    """Full-refresh load of delimited files with a ``name:TYPE,…`` layout."""
    raw = files.read_body_lines(spark, paths)
    return save_table(typed_rows(raw, struct_type(layout), drop_nulls), table)


def load_with_schema_file(
    spark: SparkSession, paths: str | list[str], schema_path: str, table: str, drop_nulls: bool = True
) -> DataFrame:
    """Full-refresh load whose column names and types come from a schema file."""
    raw = files.read_body_lines(spark, paths)
    return save_table(typed_rows(raw, read_schema(spark, schema_path), drop_nulls), table)
