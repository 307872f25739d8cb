"""File readers: JSON, CSV, TSV, Parquet and text."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corvane.scratch import new_folder

Schema = T.StructType | str | None
PARSE_MODES = ("PERMISSIVE", "DROPMALFORMED", "FAILFAST")

# The layout of the posts source.
POSTS_SCHEMA = (
    "sid bigint, sid_profile bigint, post_id string, profile_id bigint, location_id bigint, cts timestamp, "
    "post_type int, description string, numbr_likes bigint, number_comments bigint"
)
FORMAT_BY_EXTENSION = {"csv": "csv", "tsv": "csv", "json": "json", "parquet": "parquet", "txt": "text", "orc": "orc"}


def read_files(
    spark: SparkSession, source: str, path: str | list[str], schema: Schema = None, mode: str | None = None, **options
) -> DataFrame:
    """Read ``path`` as the named format, with options as one map.

    Without a schema JSON is inferred by an extra pass over the data, and CSV
    columns are text unless ``inferSchema`` is set; pass a schema, or
    ``samplingRatio``, for large inputs.
    """
    if mode is not None and mode.upper() not in PARSE_MODES:
        raise ValueError(f"mode must be one of {PARSE_MODES}")
    reader = spark.read.format(source).options(**options)
    if mode is not None:
        reader = reader.option("mode", mode)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.load(path)


def read_json(spark: SparkSession, path: str | list[str], schema: Schema = None, **options) -> DataFrame:
    return read_files(spark, "json", path, schema, **options)


def read_csv(
    spark: SparkSession, path: str | list[str], schema: Schema = None, sep: str = ",", header: bool = True, **options
) -> DataFrame:
    return read_files(spark, "csv", path, schema, sep=sep, header=header, **options)


CORRUPT = "corrupt_record"


def read_parted(
    spark: SparkSession, source: str, path: str | list[str], schema: T.StructType | str, **options
) -> tuple[DataFrame, DataFrame]:
    """(good rows, rejects) of text files, in one pass over them.

    Rejects have the columns of ``schema``, null where the text does not fit, the
    whole text as ``corrupt_record`` and the ``file`` it stands in. Good and rejected
    rows together are the records of the files. Both are written to the shared
    folder in the same job, and what follows reads only the one it needs.
    """
    wanted = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    full = T.StructType([*wanted.fields, T.StructField(CORRUPT, T.StringType())])
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT} | options
    rows = read_files(spark, source, path, full, **options)
    bad = F.col(CORRUPT).isNotNull()
    folder = new_folder(spark, "parted")
    marked = rows.withColumn("file", F.when(bad, F.input_file_name())).withColumn("rejected", bad)
    marked.write.partitionBy("rejected").parquet(folder)
    fields = [*full.fields, T.StructField("file", T.StringType()), T.StructField("rejected", T.BooleanType())]
    both = spark.read.schema(T.StructType(fields)).parquet(folder)
    return both.where("NOT rejected").select(*wanted.names), both.where("rejected").select(*full.names, "file")


def infer_json(spark: SparkSession, path: str | list[str]) -> tuple[T.StructType, int]:
    """(schema that fits every record, number of lines that are no JSON object) of files with one record per line.

    All rows are read, once: every task widens the types it meets, and the
    partial results are merged like any aggregate. A field that stands only in the last
    file is part of the schema.
    """
    lines = spark.read.text(path).where("trim(value) <> ''")
    parsed = lines.select(F.try_parse_json("value").alias("record"))
    kind = F.when(F.schema_of_variant("record").startswith("OBJECT"), F.col("record"))
    row = parsed.select(kind.alias("record")).agg(
        F.schema_of_variant_agg("record").alias("shape"), F.count_if(F.col("record").isNull()).alias("odd")
    ).first()
    shape = row["shape"]
    if not shape.startswith("OBJECT"):
        return T.StructType(), row["odd"]
    ddl = re.sub(r"(^|: |ARRAY<)OBJECT<", r"\1STRUCT<", shape)
    ddl = re.sub(r"(: |ARRAY<)(VOID|VARIANT)(?=[,>])", r"\1STRING", ddl)  # nulls only, or values that differ in kind
    return _plain(T._parse_datatype_string(ddl)), row["odd"]


def _plain(kind: T.DataType) -> T.DataType:
    """Decimals, as which fractions are met in variants, as doubles."""
    if isinstance(kind, T.DecimalType):
        return T.DoubleType()
    if isinstance(kind, T.ArrayType):
        return T.ArrayType(_plain(kind.elementType))
    if isinstance(kind, T.StructType):
        return T.StructType([T.StructField(field.name, _plain(field.dataType)) for field in kind])
    return kind


# Narrowest first; a column gets the first type that all its values fit.
CSV_TYPES = ("int", "bigint", "double", "boolean", "date", "timestamp")


def infer_csv(spark: SparkSession, path: str | list[str], sep: str = ",", header: bool = True, **options) -> T.StructType:
    """The schema that fits every row of delimited files, from one pass over all of them.

    Per column an aggregate says which types all values fit, so partial results
    merge; a column without any value is text.
    """
    text = read_csv(spark, path, sep=sep, header=header, **options)

    def fit(name: str, kind: str) -> Column:
        value = F.col(f"`{name}`")
        fitting = value.try_cast(kind).isNotNull()
        if kind == "date":  # a cast would cut a time of day off
            fitting &= F.char_length(F.trim(value)) <= 10
        return fitting | value.isNull()

    fits = [
        F.bool_and(fit(name, kind)).alias(f"{at}_{kind}")
        for at, name in enumerate(text.columns)
        for kind in CSV_TYPES
    ]
    filled = [F.count(f"`{name}`").alias(f"{at}_values") for at, name in enumerate(text.columns)]
    row = text.agg(*filled, *fits).first()
    kinds = [
        next((kind for kind in CSV_TYPES if row[f"{at}_values"] and row[f"{at}_{kind}"]), "string")
        for at in range(len(text.columns))
    ]
    named = zip(text.columns, kinds, strict=True)
    return T.StructType([T.StructField(name, T._parse_datatype_string(kind)) for name, kind in named])


def read_posts(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """The tab-separated posts source, typed; a value that does not fit is null."""
    return read_csv(spark, path, POSTS_SCHEMA, sep="\t", mode="PERMISSIVE")


def read_text_columns(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """A tab-separated source with all columns as text (profiles, locations)."""
    return read_csv(spark, path, sep="\t", mode="PERMISSIVE")


def read_by_extension(
    spark: SparkSession, path: str, sep: str = ",", header: bool = True, schema: Schema = None
) -> DataFrame:
    """Read a file or folder in the format its name ends with."""
    extension = path.rstrip("/").rsplit("/", 1)[-1].rsplit(".", 1)[-1].lower()
    source = FORMAT_BY_EXTENSION.get(extension)
    if source is None:
        raise ValueError(f"no reader for files that end in .{extension}")
    options = {"sep": sep, "header": header} if source == "csv" else {}
    return read_files(spark, source, path, schema, **options)


def read_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """One row per line, column ``value``."""
    return spark.read.text(path)


def read_body_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """The lines of many files without the header line of each, column ``line``.

    The CSV reader drops the header per file. A separator that text never
    holds and quoting switched off keep each line whole and unchanged. Empty
    lines are left out.
    """
    return read_csv(spark, path, "line string", sep="\u0001", quote="", escape="")


def read_prices(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Comma-separated ``symbol,date,price`` lines; symbols are upper case, headers are not."""
    tokens = F.split("value", ",")
    rows = read_lines(spark, path).select(
        F.get(tokens, 0).alias("symbol"), F.get(tokens, 1).alias("date"), F.get(tokens, 2).alias("price")
    )
    return rows.where(F.upper("symbol") == F.col("symbol")).withColumn("price", F.col("price").try_cast("double"))
