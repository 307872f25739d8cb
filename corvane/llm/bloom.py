"""A Bloom filter of fixed size, built by a grouping and broadcast to map tasks.

It thins out rows before a shuffle whose exact join follows. Its size is a
parameter and does not follow the data: with more keys than it can tell apart
it lets more rows through, and the join's result is the same.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corvane.llm.shingles import mixed
from corvane.llm.tables import named, ship

BITS = 1 << 25  # 4 MB
PROBES = 3


def integers(column: pa.Array) -> np.ndarray:
    """64-bit integers of a key column: whole numbers as they are, of anything else a digest."""
    if pa.types.is_integer(column.type):
        return column.cast(pa.int64()).to_numpy(zero_copy_only=False)
    if pa.types.is_binary(column.type) or pa.types.is_large_binary(column.type):
        return np.array([_digest(value) for value in column.to_pylist()], dtype=np.int64)
    return np.array([_digest(str(value).encode()) for value in column.to_pylist()], dtype=np.int64)


def _digest(value: bytes) -> int:
    import xxhash

    return xxhash.xxh3_64_intdigest(value) - (1 << 63)


class Bloom:
    def __init__(self, words: np.ndarray):
        self.words = words

    @staticmethod
    def positions(keys: np.ndarray, bits: int) -> list[np.ndarray]:
        first = mixed(keys.view(np.uint64))
        second = mixed(first + np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)
        return [(first + np.uint64(at) * second) & np.uint64(bits - 1) for at in range(PROBES)]

    def holds(self, keys: np.ndarray) -> np.ndarray:
        """Whether each key may be in the filter; never False for one that is."""
        found = np.ones(len(keys), dtype=bool)
        for at in self.positions(np.ascontiguousarray(keys), len(self.words) * 64):
            found &= (self.words[(at >> np.uint64(6)).astype(np.int64)] >> (at & np.uint64(63)) & np.uint64(1)) == 1
        return found


def bloom_of(keys: DataFrame, column: str, bits: int = BITS) -> Bloom:
    """The filter of all non-null values of a column. ``bits`` is a power of two."""
    ship(keys.sparkSession)

    def batches(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = np.zeros(bits // 64, dtype=np.uint64)
        for batch in source:
            for at in Bloom.positions(integers(batch.column(0)), bits):
                np.bitwise_or.at(words, (at >> np.uint64(6)).astype(np.int64), np.uint64(1) << (at & np.uint64(63)))
        filled = np.flatnonzero(words)
        yield pa.RecordBatch.from_arrays(
            [pa.array(filled.astype(np.int32)), pa.array(words[filled].view(np.int64))], names=["word", "mask"]
        )

    partial = keys.select(named(column)).na.drop().mapInArrow(batches, "word int, mask bigint")
    table = partial.groupBy("word").agg(F.bit_or("mask").alias("mask")).toArrow()  # at most bits / 64 rows
    words = np.zeros(bits // 64, dtype=np.uint64)
    words[table["word"].to_numpy()] = table["mask"].to_numpy().view(np.uint64)
    return Bloom(words)


def without(rows: DataFrame, id_col: str, gone: DataFrame, gone_col: str, bits: int = BITS) -> DataFrame:
    """The rows whose id is not in ``gone``, all columns as they were; rows without an id stay.

    Only rows that the filter of ``gone`` may hold are shuffled for the exact
    anti join, the others pass where they are read.
    """
    gone = gone.select(named(gone_col).alias("corvane_dropped_id")).na.drop().distinct()
    files = rows.sparkSession.sparkContext.broadcast(bloom_of(gone, "corvane_dropped_id", bits))
    place = rows.columns.index(id_col)

    def part(wanted: bool) -> DataFrame:
        def batches(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in source:
                column = batch.column(place)
                held = np.zeros(batch.num_rows, dtype=bool)
                known = column.is_valid().to_numpy(zero_copy_only=False)
                held[known] = files.value.holds(integers(column.drop_null()))
                yield batch.filter(pa.array(held == wanted))

        return rows.mapInArrow(batches, rows.schema)

    unsure = part(True).join(gone, named(id_col) == F.col("corvane_dropped_id"), "left_anti")
    return part(False).unionByName(unsure)
