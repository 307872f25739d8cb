"""Shared helpers: the two columns an operator reads, and tables written between jobs."""

from __future__ import annotations

import os
import tempfile
import zipfile
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

import corvane
from corvane.scratch import new_folder

ROWS_AT_ONCE = 1000
BYTES_AT_ONCE = 16 << 20
_BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"
_BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"
_shipped: set[str] = set()


def named(name: str) -> Column:
    """The column of exactly this name, dots and all."""
    return F.col("`" + name.replace("`", "``") + "`")


def id_and_text(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Only ``doc_id`` and ``text`` of the input; a null text becomes the empty text.

    Operators start from these two columns, so whatever else the input holds,
    under whatever names, cannot meet the names they use inside.
    """
    return docs.select(
        named(id_col).alias("doc_id"), F.coalesce(named(text_col), F.lit("")).alias("text")
    )


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the folder all executors share and return a scan of it.

    What follows starts from files that outlive every executor.
    """
    spark = df.sparkSession
    path = new_folder(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def rows_at_once(spark: SparkSession, rows: int) -> Iterator[None]:
    """Jobs that start within pass this many rows at once to a worker; for rows of a few numbers."""
    before = spark.conf.get(_BATCH)
    spark.conf.set(_BATCH, str(rows))
    try:
        yield
    finally:
        spark.conf.set(_BATCH, before)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def ship(spark: SparkSession) -> None:
    """Send this package to the Python workers, once per application.

    Functions that run in tasks import it; a cluster need not have it installed.
    The archive goes out through Spark's own file server. Rows hold whole texts,
    so the session also passes fewer of them, and fewer bytes, at once to a worker.
    """
    if spark.conf.get(_BATCH_BYTES) != f"{BYTES_AT_ONCE}b":
        spark.conf.set(_BATCH_BYTES, f"{BYTES_AT_ONCE}b")
    if int(spark.conf.get(_BATCH)) > ROWS_AT_ONCE:
        spark.conf.set(_BATCH, str(ROWS_AT_ONCE))
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    _shipped.add(context.applicationId)
    root = os.path.dirname(os.path.abspath(corvane.__file__))
    path = os.path.join(tempfile.mkdtemp(prefix="corvane-code-"), "corvane.zip")
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as archive:
        for folder, _, names in os.walk(root):
            for name in names:
                if name.endswith(".py"):
                    file = os.path.join(folder, name)
                    archive.write(file, os.path.relpath(file, os.path.dirname(root)))
    context.addPyFile(path)
