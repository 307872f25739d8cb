import os
import uuid
from decimal import Decimal

import pytest

from corvane.operators import catalog, loading
from corvane.sources.schema_file import struct_type


@pytest.fixture
def database(spark, tmp_path):
    name = f"d{uuid.uuid4().hex[:8]}"
    catalog.create_database(spark, name, str(tmp_path / name))
    yield name
    spark.sql(f"DROP DATABASE {name} CASCADE")


def test_dropping_a_managed_table_deletes_its_files(spark, database, tmp_path):
    catalog.save_table(spark.range(3), f"{database}.t")
    assert catalog.table_kind(spark, f"{database}.t") == "MANAGED"
    assert os.path.isdir(tmp_path / database / "t")
    spark.sql(f"DROP TABLE {database}.t")
    assert not os.path.exists(tmp_path / database / "t")


def test_dropping_an_external_table_keeps_its_files(spark, database, tmp_path):
    folder = str(tmp_path / "flights")
    catalog.create_external_csv_table(spark, f"{database}.flights", "origin string, destination string", folder)
    spark.sql(f"INSERT INTO {database}.flights VALUES ('a', 'b'), ('c', 'd')")
    assert catalog.table_kind(spark, f"{database}.flights") == "EXTERNAL"
    assert spark.table(f"{database}.flights").count() == 2
    spark.sql(f"DROP TABLE {database}.flights")
    assert spark.read.csv(folder, header=True).count() == 2


def test_create_database_twice(spark, database):
    catalog.create_database(spark, database)
    assert spark.sql(f"SHOW DATABASES LIKE '{database}'").count() == 1


def test_saving_replaces_or_appends(spark, database):
    table = f"{database}.t"
    catalog.save_table(spark.range(3), table)
    catalog.save_table(spark.range(5), table)
    assert spark.table(table).count() == 5
    assert catalog.save_table(spark.range(2), table, mode="append").count() == 7


def ids(df):
    return sorted(row.id for row in df.collect())


def test_a_refresh_is_one_change(spark, database, monkeypatch):
    table = f"{database}.t"
    catalog.save_table(spark.range(3), table)
    seen = []
    point = catalog._point

    def spied(*given):
        seen.append(ids(spark.table(table)))  # the new rows are written, the table is not changed yet
        point(*given)
        seen.append(ids(spark.table(table)))

    monkeypatch.setattr(catalog, "_point", spied)
    before = spark.table(table)
    catalog.save_table(spark.range(5, 7), table)
    assert seen == [[0, 1, 2], [5, 6]]
    assert ids(before) == [0, 1, 2] and ids(spark.table(table)) == [5, 6]
    catalog.refresh_table(spark.range(9, 10), table)
    assert ids(spark.table(table)) == [9] and catalog.table_kind(spark, table) == "MANAGED"
    assert catalog.remove_old_versions(spark, table) == 1
    assert ids(spark.table(table)) == [9] and catalog.remove_old_versions(spark, table) == 0


@pytest.mark.parametrize("step", ["write", "switch", "after"])
def test_a_refresh_that_fails_leaves_one_state(spark, database, monkeypatch, step):
    table = f"{database}.t"
    catalog.save_table(spark.range(3), table)
    new = spark.range(5, 7)
    point = catalog._point
    if step == "write":
        new = new.selectExpr("CASE WHEN id = 6 THEN cast(raise_error('lost') AS bigint) ELSE id END AS id")
    else:

        def failing(*given):
            if step == "after":
                point(*given)
            raise RuntimeError("lost")

        monkeypatch.setattr(catalog, "_point", failing)
    with pytest.raises(Exception, match="lost"):
        catalog.refresh_table(new, table)
    assert ids(spark.table(table)) == ([5, 6] if step == "after" else [0, 1, 2])
    monkeypatch.setattr(catalog, "_point", point)
    assert ids(catalog.refresh_table(spark.range(1), table)) == [0]


def test_a_refresh_keeps_the_columns(spark, database):
    table = f"{database}.t"
    catalog.save_table(spark.range(3), table)
    with pytest.raises(ValueError, match="other columns"):
        catalog.refresh_table(spark.range(3).selectExpr("cast(id AS string) AS id"), table)
    assert catalog.save_table(spark.range(2).selectExpr("id", "'x' AS more"), table).columns == ["id", "more"]


def test_transfer_to_views_or_tables(spark, database):
    tables = {"staff_a": spark.range(2), "staff_b": spark.range(4)}
    views = catalog.transfer_tables(spark, tables.get, tables)
    assert views["staff_b"].count() == 4 and spark.catalog.tableExists("staff_a")
    assert not spark.catalog.tableExists(f"{database}.staff_a")
    stored = catalog.transfer_tables(spark, tables.get, tables, database)
    assert stored["staff_a"].count() == 2 and catalog.table_kind(spark, f"{database}.staff_a") == "MANAGED"


def test_typed_rows(spark):
    raw = spark.createDataFrame([('"2015",NULL,True,"1.50"',), ("x,a NULL b,maybe,",), ("2016",)], "line string")
    schema = struct_type("year:INTEGER,name:STRING,flag:BOOL,amount:BIGNUMERIC")
    rows = [tuple(r) for r in loading.typed_rows(raw, schema).collect()]
    assert rows == [(2015, "", True, Decimal("1.5")), (None, "a  b", None, None), (2016, None, None, None)]
    kept = loading.typed_rows(raw, schema, drop_nulls=False).first()
    assert kept.name == "NULL"


@pytest.mark.parametrize("schema", ["{'year': 'INTEGER', 'name': 'STRING'}", "year:INTEGER\nname:STRING"])
def test_load_replaces_the_table(spark, database, tmp_path, schema, values):
    (tmp_path / "schema").write_text(schema)
    (tmp_path / "a.csv").write_text("year,name\n2015,x\n")
    (tmp_path / "b.csv").write_text("year,name\n2016,y\n")
    table = f"{database}.loaded"
    for _ in range(2):
        df = loading.load_with_schema_file(spark, str(tmp_path / "*.csv"), str(tmp_path / "schema"), table)
        assert values(df) == [(2015, "x"), (2016, "y")]
        assert df.dtypes == [("year", "bigint"), ("name", "string")]


def test_fixed_layouts():
    names = [struct_type(t).names for t in (loading.PROFILE_IMPACT_LAYOUT, loading.POST_IMPACT_LAYOUT, loading.WEEKDAY_LAYOUT)]
    assert [len(n) for n in names] == [8, 4, 3]
