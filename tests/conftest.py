import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from corvane.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    warehouse = tempfile.mkdtemp(prefix="corvane-warehouse-")
    session = build_session(
        "tests", "local[8]", spark_sql_warehouse_dir=warehouse, spark_sql_shuffle_partitions="4"
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def setting(spark):
    """Set runtime options for one test."""
    before = {}

    def change(name, value):
        before.setdefault(name, spark.conf.get(name, None))
        spark.conf.set(name, value)

    yield change
    for name, value in before.items():
        spark.conf.unset(name) if value is None else spark.conf.set(name, value)


@pytest.fixture
def plan_of():
    def text(df, run=False):
        if run:
            df.collect()
        execution = df._jdf.queryExecution()
        return execution.executedPlan().toString().split("== Initial Plan ==")[0]

    return text


@pytest.fixture
def values():
    """All rows as sorted tuples."""
    return lambda df: sorted((tuple(row) for row in df.collect()), key=repr)
