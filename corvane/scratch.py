"""Folders for intermediate tables, on storage that every executor sees."""

from __future__ import annotations

import atexit
import contextlib
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"


def shared_folder(spark: SparkSession) -> str:
    """The folder the cluster names in ``spark.checkpoint.dir``.

    Where it names none, the checkpoint folder set at run time counts. A local
    session without either gets a temporary folder as its checkpoint folder; a
    cluster session without either is an error, because a machine-local folder
    would be lost with its executor.
    """
    folder = spark.conf.get(CHECKPOINT_DIR, None) or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder
    if not spark.conf.get("spark.master", "").startswith("local"):
        raise RuntimeError(f"set {CHECKPOINT_DIR} to a folder that all executors share")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="corvane-"))
    return spark.sparkContext.getCheckpointDir()


_RUN = uuid.uuid4().hex
_runs: set[str] = set()


def new_folder(spark: SparkSession, name: str) -> str:
    """A path below the shared folder that nothing else uses.

    All folders of a run lie in one, which goes when the program ends.
    """
    run = f"{shared_folder(spark).rstrip('/')}/corvane/{_RUN}"
    if run not in _runs:
        _runs.add(run)
        atexit.register(_remove, spark, run)
    return f"{run}/{name}-{uuid.uuid4().hex}"


def _remove(spark: SparkSession, run: str) -> None:
    """Delete the folder of this run; whatever keeps that from working, the program is over."""
    with contextlib.suppress(Exception):
        remove_folder(spark, run)


def remove_folder(spark: SparkSession, folder: str) -> None:
    """Delete a folder that :func:`new_folder` named, once nothing reads it any more."""
    if f"/corvane/{_RUN}" not in folder:
        raise ValueError(f"{folder} is no folder of this run")
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def materialise(df: DataFrame, name: str = "table") -> DataFrame:
    """Write ``df`` once and return a scan of the written table.

    Later steps then start from files that outlive any executor, and the
    plan that produced them is not run again.
    """
    spark = df.sparkSession
    path = new_folder(spark, name)
    df.write.parquet(path)
    return spark.read.parquet(path)
