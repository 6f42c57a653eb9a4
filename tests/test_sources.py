import os

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrameReader, DataFrameWriter
from pyspark.sql import functions as F
from pyspark.sql import types as T

from conftest import rows
from lakeops.operators import quality, shape
from lakeops.sinks import jdbc as jdbc_sink
from lakeops.sinks import tables
from lakeops.sources import files, jdbc, metadata

NESTED = (
    T.StructType().add("authorization", T.StructType().add("project_actions", T.ArrayType(T.StringType())))
    .add("name", "string").add("project_id", "string").add("start_date", "timestamp")
)


def put(path, text, encoding="utf-8"):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes(text.encode(encoding))


def test_json_permissive(spark, tmp_path):
    day = tmp_path / "year=2024" / "month=01" / "day=05"
    put(day / "a.json", '{"authorization":{"project_actions":["r","w"]},"name":"x","project_id":"1","start_date":"05/01/2024 10:00"}\n'
                        '{"name":"y","project_id":"2","start_date":"no date"}\n{broken\n{"name":"z","project_id":"3","extra":1}\n')
    df = files.scan_json(spark, str(tmp_path), files.raw_schema(NESTED), "dd/MM/yyyy HH:mm").cache()
    bad = {r["name"]: r[files.CORRUPT] for r in df.collect()}
    assert bad["x"] is None and bad["z"] is None and "no date" in bad["y"] and bad[None] == "{broken"
    assert quality.schema_counts(df).first().asDict() == {"NumRecordsCompliant": 2, "NumRecordsNonCompliant": 2}
    good, wrong = shape.split_compliant(df)
    assert (good.count(), wrong.count(), files.CORRUPT in good.columns) == (2, 2, False)
    renamed = df.withColumn("authorization", F.col("authorization").cast("struct<ProjectActions:array<string>>"))
    assert renamed.where("name = 'x'").first()["authorization"]["ProjectActions"] == ["r", "w"]


def test_delimited_multiline(spark, tmp_path):
    put(tmp_path / "year=2024" / "month=01" / "day=05" / "a.csv", 'id|note|n\n1|"two\nlines"|5\n2|plain|five\n3|a|1|extra\n')
    schema = files.raw_schema(T.StructType.fromDDL("id int, note string, n int"))
    got = {r["id"]: (r["note"], r["n"], r[files.CORRUPT] is None) for r in files.scan_delimited(spark, str(tmp_path), schema).collect()}
    assert got[1] == ("two\nlines", 5, True)
    assert got[2][2] is False and got[3][2] is False


def test_window_filter_prunes_folders(spark, tmp_path):
    for day in ("04", "05", "06"):
        put(tmp_path / "year=2024" / "month=01" / f"day={day}" / "a.json", f'{{"id": {int(day)}}}\n')
    df = files.with_partition_date(files.scan_json(spark, str(tmp_path), files.raw_schema(T.StructType.fromDDL("id int"))), "d")
    one = shape.date_window(df, "d", "2024-01-05")
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: []" not in plan and "make_date" in plan.split("PartitionFilters:")[1]
    assert rows(one, "id") == [(5,)]


def test_provenance_comes_from_the_scan(spark, tmp_path):
    for name, when in (("a", 1_700_000_000), ("b", 1_700_000_060)):
        put(tmp_path / f"{name}.json", '{"id": 1}\n')
        os.utime(tmp_path / f"{name}.json", (when, when))
    df = files.with_provenance(files.scan_json(spark, str(tmp_path), T.StructType.fromDDL("id int")))
    got = {r[0].rsplit("/", 1)[1]: r[1] for r in df.select("__RawFileName", F.unix_timestamp("__RawFileModificationTime")).collect()}
    assert got == {"a.json": 1_700_000_000, "b.json": 1_700_000_060}
    assert files.files_processed(df).count() == 2


def test_xml(spark, tmp_path):
    put(tmp_path / "a.xml", "<items><item><id>1</id><name></name></item><item><id>2</id><name>b</name></item></items>")
    schema = T.StructType.fromDDL("id int, name string")
    assert rows(files.scan_xml(spark, str(tmp_path), "item", schema)) == [(1, None), (2, "b")]
    assert rows(files.scan_xml(spark, str(tmp_path), "item"), "id") == [(1,), (2,)]
    absent = str(tmp_path / "absent")
    assert files.scan_xml(spark, absent, "item", schema, empty_when_missing=True).count() == 0
    with pytest.raises(AnalysisException):
        files.scan_xml(spark, absent, "item", schema)
    with pytest.raises(AnalysisException):
        files.scan_xml(spark, absent, "item", empty_when_missing=True)


def test_schema_from_metadata(spark):
    described = spark.createDataFrame([
        ("f", "id", "Integer", "true"), ("f", "name", "String", None), ("g", "other", "String", "true"), ("h", "x", "Blob", ""),
    ], "FileName string, ColumnName string, DataType string, PrimaryKey string")
    schema, keys = metadata.schema_and_keys(described, "f")
    assert schema.simpleString() == "struct<id:int,name:string>" and keys == ["id"]
    for name in ("h", "nothing"):
        with pytest.raises(ValueError):
            metadata.schema_and_keys(described, name)


def test_western_csv_with_mark_and_day_first_dates(spark, tmp_path):
    from lakeops.durable import materialize
    from lakeops.functions.scalars import day_first
    put(tmp_path / "a.csv", "Activity ID,Note,Start\nA1,café – x,31/01/2024\n,,\nA2,b,13/13/2024\n", "cp1252")
    with files.western_charsets(spark):
        df = materialize(files.scan_cp1252(spark, str(tmp_path / "a.csv")))
    assert spark.conf.get("spark.sql.legacy.javaCharsets") == "false"
    got = df.dropna(how="all").withColumn("Start", day_first(F.col("Start")))
    assert [(r[0], r[1], str(r[2])) for r in got.orderBy("Activity ID").collect()] == [("A1", "café – x", "2024-01-31"), ("A2", "b", "None")]


def test_csv_infers_types_and_parses_dates(spark, tmp_path):
    put(tmp_path / "a.csv", "n,price,sold\n1,2.5,11/16/2006 0:00\n2,,later\n")
    df = files.scan_csv(spark, str(tmp_path / "a.csv"), {"sold": "M/d/yyyy H:mm"})
    assert dict(df.dtypes) == {"n": "int", "price": "double", "sold": "timestamp"}
    assert [str(r["sold"]) for r in df.orderBy("n").collect()] == ["2006-11-16 00:00:00", "None"]


def test_labelled_files(spark, tmp_path):
    for split, label, name in (("train", "cat", "1.jpg"), ("train", "cat", "2.jpg"), ("test", "dog", "3.jpg"), ("test", "dog", "no.txt")):
        put(tmp_path / split / label / name, "x" * 10)
    found = files.scan_labelled_files(spark, str(tmp_path), "*.jpg")
    assert rows(found.groupBy("split", "label").count()) == [("test", "dog", 1), ("train", "cat", 2)]
    assert "content" not in found.columns
    assert rows(files.folder_inventory(found), "files", "bytes") == [(1, 10), (2, 20)]


def test_lines(spark, tmp_path):
    put(tmp_path / "names.txt", "lower\nwords\n")
    assert rows(files.scan_lines(spark, str(tmp_path / "names.txt"))) == [("lower",), ("words",)]


def test_retry_until_it_answers_or_the_budget_ends():
    now, calls = [0.0], []

    def fail_until(n):
        def read():
            calls.append(now[0])
            if len(calls) < n:
                raise ConnectionError("asleep")
            return "rows"
        return read

    def sleep(seconds):
        now[0] += seconds
    assert jdbc.retry_until(fail_until(4), clock=lambda: now[0], sleep=sleep) == "rows"
    assert calls == [0, 10, 20, 30]
    calls.clear()
    with pytest.raises(ConnectionError):
        jdbc.retry_until(fail_until(10_000), clock=lambda: now[0], sleep=sleep)
    assert len(calls) == 13


def test_database_options(spark, monkeypatch):
    """What reaches the reader and the writer; no database is involved."""
    seen = {}
    plain = DataFrameReader.options
    monkeypatch.setattr(DataFrameReader, "options", lambda self, **o: (seen.update(o), plain(self, **o))[1])
    monkeypatch.setattr(DataFrameReader, "load", lambda self: "rows")
    assert jdbc.read_table(spark, "jdbc:x:", "dim", {"user": "u"}, ("id", 1, 100, 8)) == "rows"
    assert seen == {"url": "jdbc:x:", "dbtable": "dim", "user": "u", "partitionColumn": "id", "lowerBound": "1", "upperBound": "100", "numPartitions": "8"}
    sent = {}
    monkeypatch.setattr(DataFrameWriter, "options", lambda self, **o: (sent.update(o), self)[1])
    monkeypatch.setattr(DataFrameWriter, "option", lambda self, k, v: (sent.update({k: v}), self)[1])
    monkeypatch.setattr(DataFrameWriter, "save", lambda self: sent.update(saved=True))
    jdbc_sink.replace_table(spark.range(1), "jdbc:x:", "serving.dim", {"user": "u"}, {"id": "INT"})
    assert sent == {"url": "jdbc:x:", "dbtable": "serving.dim", "truncate": "true", "numPartitions": "8", "user": "u",
                    "createTableColumnTypes": "id INT", "saved": True}


def test_overwrite_leaves_other_partitions_alone(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.createDataFrame([(1, "a"), (2, "b"), (3, "b")], "id int, p string")
    tables.overwrite_partitions(df, path, ["p"])
    before = {f.name: f.read_bytes() for f in (tmp_path / "t" / "p=a").iterdir()}
    tables.overwrite_partitions(spark.createDataFrame([(9, "b"), (8, "c")], "id int, p string"), path, ["p"])
    assert {f.name: f.read_bytes() for f in (tmp_path / "t" / "p=a").iterdir()} == before
    assert rows(spark.read.schema(df.schema).parquet(path)) == [(1, "a"), (8, "c"), (9, "b")]


def test_version_swap_keeps_the_old_files(spark, tmp_path):
    root = str(tmp_path / "dim")
    first = spark.createDataFrame([(1, "a")], "id int, x string")
    tables.create_if_absent(spark, "swap_dim", first.schema, f"{root}/empty")
    tables.point_at(spark, "swap_dim", tables.write_version(first, root))
    # the new version is computed from the table it replaces
    more = spark.table("swap_dim").unionByName(spark.createDataFrame([(2, "b")], first.schema))
    tables.point_at(spark, "swap_dim", tables.write_version(more, root))
    assert rows(spark.table("swap_dim")) == [(1, "a"), (2, "b")]
    spark.sql("DROP TABLE swap_dim")


def test_csv_export_round_trip(spark, tmp_path):
    df = spark.createDataFrame([(1, "a,b"), (2, 'say "x"')], "id int, x string")
    tables.export_csv(df, str(tmp_path / "out"))
    assert rows(files.scan_csv(spark, str(tmp_path / "out"), schema=df.schema)) == rows(df)
