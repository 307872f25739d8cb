"""File writers: JSON, Parquet, CSV and TSV."""

from __future__ import annotations

from pyspark.sql import DataFrame

SAVE_MODES = ("overwrite", "append", "ignore", "errorifexists")


def write_files(df: DataFrame, target: str, path: str, mode: str = "errorifexists", **options) -> None:
    if mode.lower() not in SAVE_MODES:
        raise ValueError(f"mode must be one of {SAVE_MODES}")
    df.write.format(target).mode(mode).options(**options).save(path)


def write_json(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    write_files(df, "json", path, mode)


def _in_files(df: DataFrame, files: int | None) -> DataFrame:
    """``df`` in the partitions that make ``files`` files; as it is when None.

    One file keeps the order of the rows. Its last stage then runs in one task,
    which is the caller's choice for a result known to be small; what comes
    before a shuffle, a sort for instance, still runs in parallel.
    """
    if files is None:
        return df
    return df.coalesce(1) if files == 1 else df.repartition(files)


def write_csv(df: DataFrame, path: str, sep: str = ",", mode: str = "overwrite", files: int | None = None) -> None:
    """Delimited text with a header in each file, in ``files`` files or as many as there are partitions."""
    write_files(_in_files(df, files), "csv", path, mode, sep=sep, header=True)


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite", files: int | None = None) -> None:
    """Snappy Parquet, in ``files`` files or as many as there are partitions."""
    write_files(_in_files(df, files), "parquet", path, mode)


def write_balanced(
    df: DataFrame, target: str, path: str, partition_by: tuple[str, ...] = (), mode: str = "overwrite", **options
) -> None:
    """Files near the advisory size of adaptive execution, whatever the sizes of the partitions.

    The rows are dealt out anew, by the partition columns where there are any, and
    adaptive execution merges small parts and splits large ones, also that of a
    hot partition value. No number of files has to be guessed.
    """
    if mode.lower() not in SAVE_MODES:
        raise ValueError(f"mode must be one of {SAVE_MODES}")
    dealt = df.hint("rebalance", *partition_by)
    dealt.write.format(target).mode(mode).options(**options).partitionBy(*partition_by).save(path)
