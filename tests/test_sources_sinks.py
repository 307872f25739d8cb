import datetime
import os

import pytest
from pyspark.sql import functions as F

from corvane import scratch
from corvane.catalogue import queries
from corvane.scratch import materialise, new_folder, shared_folder
from corvane.sinks import files as sinks
from corvane.sinks.jdbc import write_table
from corvane.sources import files, jdbc
from corvane.sources.schema_file import layout_text, parse_layout, read_schema, struct_type


def put(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text)
    return str(path)


def parts(folder, ending):
    return [name for name in os.listdir(folder) if name.startswith("part-") and name.endswith(ending)]


BAD_JSON = '{"a": 1, "b": "x"}\n{"a": 2, "b"\n{"a": 3, "b": "z"}\n'


def test_parse_modes_of_json(spark, tmp_path, values):
    path, schema = put(tmp_path / "bad.json", BAD_JSON), "a bigint, b string"
    assert values(files.read_json(spark, path, schema, mode="PERMISSIVE")) == [(1, "x"), (3, "z"), (None, None)]
    assert values(files.read_json(spark, path, schema, mode="dropMalformed")) == [(1, "x"), (3, "z")]
    with pytest.raises(Exception, match="FAILFAST"):
        files.read_json(spark, path, schema, mode="failFast").collect()
    with pytest.raises(ValueError, match="mode must be one of"):
        files.read_json(spark, path, schema, mode="lenient")


def test_inferred_json_covers_every_file(spark, tmp_path):
    (tmp_path / "parts").mkdir()
    put(tmp_path / "parts" / "one.json", '{"a": 1, "b": "x", "n": {"p": [1]}}\n[1, 2]\n{"a": 3\n\n')
    put(tmp_path / "parts" / "two.json", '{"a": 2.5, "n": {"p": [], "q": null}, "d": "2020-01-01", "u": true}\n{"u": 3}\n')
    schema, odd = files.infer_json(spark, str(tmp_path / "parts"))
    assert odd == 2
    assert schema.simpleString() == "struct<a:double,b:string,d:string,n:struct<p:array<bigint>,q:string>,u:string>"
    good, rejects = files.read_parted(spark, "json", str(tmp_path / "parts"), schema)
    assert sorted((row.a or 0, row.u or "") for row in good.collect()) == [(0, "3"), (1, ""), (2.5, "true")]
    assert sorted(row.corrupt_record for row in rejects.collect()) == ["[1, 2]", '{"a": 3']
    empty = put(tmp_path / "none.json", "\n")
    assert files.infer_json(spark, empty) == (files.T.StructType(), 0)


def test_inferred_csv_covers_every_file(spark, tmp_path):
    (tmp_path / "parts").mkdir()
    head = "i,l,d,b,day,at,t,none\n"
    put(tmp_path / "parts" / "one.csv", head + "1,2,3,true,2020-01-02,2020-01-02 03:04:05,5,\n")
    put(tmp_path / "parts" / "two.csv", head + "2,5000000000,.5,false,2021-01-02,2020-01-02,x,\n,,,,,,,\n")
    schema = files.infer_csv(spark, str(tmp_path / "parts"))
    assert [field.dataType.simpleString() for field in schema] == [
        "int", "bigint", "double", "boolean", "date", "timestamp", "string", "string",
    ]
    assert files.read_csv(spark, str(tmp_path / "parts"), schema, mode="FAILFAST").count() == 3


def test_good_and_rejected_rows_are_all_lines(spark, tmp_path, values):
    lines = ["1,a", "x,b", "3,c,more", "4", "5,", '"6,d']
    path = put(tmp_path / "rows.csv", "n,t\n" + "\n".join(lines) + "\n")
    good, rejects = files.read_parted(spark, "csv", path, "n int, t string", header=True)
    rejected = [row.corrupt_record for row in rejects.collect()]
    assert sorted(rejected) == ['"6,d', "3,c,more", "4", "x,b"]
    assert good.count() + len(rejected) == len(lines) and good.columns == ["n", "t"]
    assert {row.file.rsplit("/", 1)[-1] for row in rejects.collect()} == {"rows.csv"}
    assert rejects.where("corrupt_record = 'x,b'").select("n", "t").first() == (None, "b")
    (tmp_path / "gone").mkdir()
    os.rename(path, tmp_path / "gone" / "rows.csv")  # both were read in one pass, and are kept
    assert good.count() + rejects.count() == len(lines)


def test_balanced_files_under_a_hot_value(spark, tmp_path, setting):
    setting("spark.sql.adaptive.advisoryPartitionSizeInBytes", "200KB")
    rows = spark.range(0, 120_000, 1, 16).selectExpr("if(id % 10 < 8, 'hot', concat('k', id % 5)) AS k", "uuid() AS v")
    path = str(tmp_path / "balanced")
    sinks.write_balanced(rows, "parquet", path, ("k",))
    sizes = {}
    for folder, _, names in os.walk(path):
        sizes |= {os.path.join(folder, name): os.path.getsize(os.path.join(folder, name)) for name in names if name.endswith(".parquet")}
    hot = [size for name, size in sizes.items() if "k=hot" in name]
    assert len(hot) > 5 and max(hot) < 4 * sum(hot) / len(hot)
    assert len(sizes) - len(hot) < 16  # the source has 16 partitions that hold each of the five other values
    assert spark.read.parquet(path).count() == 120_000


def test_json_quotes_and_dates(spark, tmp_path):
    path = put(tmp_path / "q.json", "{'d': '07/08/1998', 'n': 1}\n")
    df = files.read_json(spark, path, "d date, n int", dateFormat="dd/MM/yyyy", allowSingleQuotes=True)
    assert tuple(df.first()) == (datetime.date(1998, 8, 7), 1)


def test_typed_csv(spark, tmp_path, values):
    path = put(tmp_path / "stocks.csv", "symbol,date,price\nMSFT,Jan 01 2000,39.81\nAMZN,Feb 30 2000,\n")
    df = files.read_csv(spark, path, "symbol string, date date, price double", dateFormat="MMM dd yyyy", nullValue="")
    assert values(df) == [("AMZN", None, None), ("MSFT", datetime.date(2000, 1, 1), 39.81)]


def test_posts_source(spark, tmp_path):
    header = "sid\tsid_profile\tpost_id\tprofile_id\tlocation_id\tcts\tpost_type\tdescription\tnumbr_likes\tnumber_comments\n"
    good = "1\t2\tp1\t3\t4\t2015-12-01 10:00:00\t1\t#a b\t5\t6\n"
    bad = "2\tx\tp2\tnone\t\tyesterday\t\t\tmany\t0\n"
    good_row, bad_row = files.read_posts(spark, put(tmp_path / "posts.csv", header + good + bad)).collect()
    assert good_row.cts == datetime.datetime(2015, 12, 1, 10) and good_row.description == "#a b"
    assert (bad_row.sid, bad_row.profile_id, bad_row.cts, bad_row.numbr_likes, bad_row.number_comments) == (2, None, None, None, 0)


def test_reader_by_extension_honours_separator_and_header(spark, tmp_path, values):
    headed = put(tmp_path / "a.csv", "x;y\n1;2\n")
    bare = put(tmp_path / "b.tsv", "1\t2\n3\t4\n")
    assert files.read_by_extension(spark, headed, sep=";").columns == ["x", "y"]
    typed = files.read_by_extension(spark, bare, sep="\t", header=False, schema="p int, q int")
    assert values(typed) == [(1, 2), (3, 4)]
    headed_typed = files.read_by_extension(spark, headed, sep=";", schema="p int, q int")
    assert values(headed_typed) == [(1, 2)]
    with pytest.raises(ValueError, match="no reader"):
        files.read_by_extension(spark, "a/b.xyz")


def test_body_lines_drop_the_header_of_every_file(spark, tmp_path):
    put(tmp_path / "in" / "1.csv", 'year,kind\n2015,"a,b"\n2016,back\\slash\n')
    put(tmp_path / "in" / "2.csv", "year,kind\n2017, padded \nyear,kind\n")
    lines = [r[0] for r in files.read_body_lines(spark, str(tmp_path / "in" / "*.csv")).collect()]
    assert sorted(lines) == ['2015,"a,b"', "2016,back\\slash", "2017, padded ", "year,kind"]


def test_prices_drop_lower_case_headers(spark, tmp_path, values):
    path = put(tmp_path / "stocks.csv", "symbol,date,price\nMSFT,Jan 1 2000,39.81\nIBM,Jan 1 2000,n/a\n")
    assert values(files.read_prices(spark, path)) == [("IBM", "Jan 1 2000", None), ("MSFT", "Jan 1 2000", 39.81)]


@pytest.mark.parametrize("text", ["{'a': 'INTEGER', 'b': 'STRING'}", "a:INTEGER\nb:STRING\n", "a:INTEGER,b:STRING"])
def test_schema_files(spark, tmp_path, text):
    assert layout_text(parse_layout(text)) == "a:INTEGER,b:STRING"
    schema = read_schema(spark, put(tmp_path / "schema.txt", text))
    assert schema.simpleString() == "struct<a:bigint,b:string>"


def test_unknown_type_in_layout():
    with pytest.raises(KeyError):
        struct_type("a:GEOGRAPHY")
    assert struct_type("n:BIGNUMERIC,f:BOOL").simpleString() == "struct<n:decimal(38,9),f:boolean>"


def test_save_modes(spark, tmp_path):
    path, one, two = str(tmp_path / "out"), spark.range(3), spark.range(10, 15)
    sinks.write_parquet(one, path, mode="errorifexists")
    with pytest.raises(Exception, match="already exists"):
        sinks.write_parquet(two, path, mode="errorifexists")
    sinks.write_parquet(two, path, mode="ignore")
    assert spark.read.parquet(path).count() == 3
    sinks.write_parquet(two, path, mode="append")
    assert spark.read.parquet(path).count() == 8
    sinks.write_parquet(two, path, mode="overwrite")
    assert spark.read.parquet(path).count() == 5
    with pytest.raises(ValueError, match="mode must be one of"):
        sinks.write_parquet(two, path, mode="replace")


def test_file_counts(spark, tmp_path):
    df = spark.range(0, 1000, 1, 8)
    sinks.write_parquet(df, str(tmp_path / "thirty"), files=30)
    assert len(parts(tmp_path / "thirty", ".snappy.parquet")) == 30
    sinks.write_files(df.repartition(30).coalesce(15), "parquet", str(tmp_path / "fifteen"))
    assert len(parts(tmp_path / "fifteen", ".parquet")) == 15


@pytest.mark.parametrize("rows", [0, 100, 200_000])
def test_the_caller_sets_the_number_of_files(spark, tmp_path, rows):
    df = spark.range(0, rows, 1, 8)
    sinks.write_csv(df, str(tmp_path / "one"), files=1)
    assert len(parts(tmp_path / "one", ".csv")) == 1
    sinks.write_csv(df, str(tmp_path / "one"), mode="append", files=1)
    assert len(parts(tmp_path / "one", ".csv")) == 2
    sinks.write_parquet(df, str(tmp_path / "parquet"), files=1)
    assert len(parts(tmp_path / "parquet", ".parquet")) == 1
    sinks.write_csv(df, str(tmp_path / "many"))
    assert len(parts(tmp_path / "many", ".csv")) == (8 if rows else 1)
    assert spark.read.parquet(str(tmp_path / "parquet")).count() == rows


def test_repartition_query_writes_the_files_it_names(spark):
    df = queries()["part_repartition"](spark, "/root/testdata/sf0.001")
    files_written = df.inputFiles()
    assert len(files_written) == 2 * spark.sparkContext.defaultParallelism


def test_single_file_keeps_the_order(spark, tmp_path, setting):
    setting("spark.sql.adaptive.coalescePartitions.enabled", "false")
    df = spark.range(0, 1000, 1, 8).select((F.col("id") * 7919 % 1000).alias("n")).orderBy(F.desc("n"))
    assert df.rdd.getNumPartitions() > 1
    sinks.write_csv(df, str(tmp_path / "sorted"), files=1)
    assert [r.n for r in files.read_csv(spark, str(tmp_path / "sorted"), "n int").collect()] == list(range(999, -1, -1))


def test_csv_round_trip(spark, tmp_path, values):
    rows = [("a\tb", 1, None), ('say "x"', 2, ""), ("line", None, "end")]
    df = spark.createDataFrame(rows, "s string, n int, t string")
    sinks.write_csv(df, str(tmp_path / "x"), sep="\t")
    read = files.read_csv(spark, str(tmp_path / "x"), df.schema, sep="\t")
    assert values(read.select("s", "n")) == values(df.select("s", "n"))


def test_written_tables_lie_in_the_shared_folder(spark):
    path = new_folder(spark, "x")
    run, name = path.rsplit("/", 1)
    assert run.startswith(f"{shared_folder(spark)}/corvane/") and name.startswith("x-") and path != new_folder(spark, "x")
    df = materialise(spark.range(5), "five")
    assert df.count() == 5
    assert df.inputFiles()[0].removeprefix("file://").startswith(f"{run}/five-")


def test_the_folder_of_a_run_can_be_removed(spark):
    materialise(spark.range(5), "gone")
    run = new_folder(spark, "x").rsplit("/", 1)[0]
    assert os.path.isdir(run)
    scratch._remove(spark, run)
    assert not os.path.exists(run)


class Session:
    """A session with the given master and settings."""

    def __init__(self, master, named=None, checkpoints=None):
        self.settings = {"spark.master": master, "spark.checkpoint.dir": named}
        self.checkpoints = checkpoints
        self.conf = self.sparkContext = self

    def get(self, name, default):
        return self.settings.get(name, default)

    def getCheckpointDir(self):
        return self.checkpoints

    def setCheckpointDir(self, folder):
        self.checkpoints = folder


def test_shared_folder_of_a_cluster():
    assert shared_folder(Session("yarn", "hdfs://x/c")) == "hdfs://x/c"
    assert shared_folder(Session("yarn", None, "hdfs://x/run")) == "hdfs://x/run"
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_folder(Session("yarn"))


def test_shared_folder_of_a_local_session_is_kept():
    session = Session("local[2]")
    assert shared_folder(session) == shared_folder(session) == session.checkpoints


CONNECTION = jdbc.Connection("jdbc:postgresql://db:5432/hr", "org.postgresql.Driver", "reader", "secret")


def test_connection_options():
    assert CONNECTION.options("employees") == {
        "url": "jdbc:postgresql://db:5432/hr",
        "driver": "org.postgresql.Driver",
        "user": "reader",
        "password": "secret",
        "dbtable": "public.employees",
    }
    assert "secret" not in repr(CONNECTION)
    bare = jdbc.Connection("jdbc:x:y", "d", namespace="")
    assert bare.options("t") == {"url": "jdbc:x:y", "driver": "d", "dbtable": "t"}


class Recorder:
    """Stands in for a reader or writer and keeps what it is told; no database is contacted."""

    def __init__(self):
        self.told = {}

    @property
    def read(self):
        return self

    write = read

    def format(self, name):
        self.told["format"] = name
        return self

    def options(self, **options):
        self.told |= options
        return self

    def option(self, name, value):
        self.told[name] = value
        return self

    def mode(self, mode):
        self.told["mode"] = mode
        return self

    def load(self):
        return self.told

    def save(self):
        self.told["saved"] = True


def test_database_scan_is_split():
    split = jdbc.Split("emp_no", "1", "500000", 64)
    told = jdbc.read_table(Recorder(), CONNECTION, "employees", split)
    assert told["format"] == "jdbc" and told["dbtable"] == "public.employees" and told["fetchsize"] == "10000"
    assert (told["partitionColumn"], told["lowerBound"], told["upperBound"], told["numPartitions"]) == ("emp_no", "1", "500000", "64")
    assert "partitionColumn" not in jdbc.read_table(Recorder(), CONNECTION, "employees")


def test_database_write():
    recorder = Recorder()
    write_table(recorder, CONNECTION, "movies", sessions=8)
    assert recorder.told["saved"] and recorder.told["mode"] == "errorifexists"
    assert recorder.told["dbtable"] == "public.movies" and recorder.told["numPartitions"] == "8"


def test_range_source_ends(spark):
    assert [r.id for r in spark.range(1, 10, 4).collect()] == [1, 5, 9]
    assert spark.range(1, 1_000_001).agg(F.sum("id")).first()[0] == 500000500000


def test_literal_rows(spark):
    inferred = spark.createDataFrame([("Samsung", "Galaxy S10", 12)], ["Make", "Model", "Megapixels"])
    given = spark.createDataFrame([("Samsung", 12)], "Make string, Megapixels int")
    assert inferred.schema.simpleString() == "struct<Make:string,Model:string,Megapixels:bigint>"
    assert given.schema.simpleString() == "struct<Make:string,Megapixels:int>"
