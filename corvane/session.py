"""Session settings the library relies on."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession

# Runtime settings every analysis assumes: one time zone, SQL-standard errors
# (text is cast with try_cast, so bad input still becomes null), and adaptive
# execution, which re-plans joins by measured size and splits skewed partitions.
# A grouping that could reuse the partitioning of a join would keep a hot key
# in one task; forcing the split adds a shuffle there, only where skew is found.
RUNTIME_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}


def prepare(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a session somebody else started."""
    for name, value in RUNTIME_SETTINGS.items():
        if spark.conf.get(name, None) != value:
            spark.conf.set(name, value)
    return spark


def shuffle_partitions_for(input_bytes: int, bytes_per_task: int = 128 << 20) -> int:
    """Shuffle partitions that keep a task near ``bytes_per_task``.

    Adaptive execution merges partitions that turn out small, but never adds
    any, so a job over much data has to start with enough of them.
    """
    return max(200, -(-input_bytes // bytes_per_task))


def build_session(
    app_name: str, master: str | None = None, input_bytes: int | None = None, **settings: str
) -> SparkSession:
    """Start a session with the runtime settings.

    ``input_bytes``, the rough size of what a job reads, sets the number of
    shuffle partitions. Cluster shape (executors, cores, memory) is left to the
    submit command; ``settings`` takes further options with ``_`` for ``.``.
    """
    options = dict(RUNTIME_SETTINGS)
    if master and master.startswith("local"):
        options |= {"spark.ui.enabled": "false", "spark.sql.shuffle.partitions": str(os.cpu_count() or 8)}
    if input_bytes is not None:
        options["spark.sql.shuffle.partitions"] = str(shuffle_partitions_for(input_bytes))
    options |= {name.replace("_", "."): value for name, value in settings.items()}
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for name, value in options.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()
