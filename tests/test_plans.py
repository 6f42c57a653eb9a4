import os
import shutil
import threading
import time
from datetime import datetime
from pathlib import Path

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from conftest import rows
from lakeops.durable import shared_folder
from lakeops.operators.merge import merge_actions, upsert, write_merged
from lakeops.operators.quality import DQ_LOG_SCHEMA, DataQualityError, latest_measures
from lakeops.plans import conform, feeds, ingest, reports, serve
from lakeops.sinks import tables

BUSINESS = T.StructType().add("id", "integer").add("name", "string").add("amount", "double")
NOW = datetime(2024, 2, 1, 12)


def raw_file(root, day, name, when, *lines, header="id|name|amount"):
    folder = root / "raw" / "year=2024" / "month=01" / f"day={day}"
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_text("\n".join([header, *lines]) + "\n")
    os.utime(folder / name, (when, when))


@pytest.fixture
def feed(tmp_path):
    return ingest.Feed("people", str(tmp_path / "raw"), str(tmp_path / "cleaned"), str(tmp_path / "log"), BUSINESS, ["id"], multiline=True)


def load(spark, feed, start="2024-01-05T00:00:00Z", end="", now=NOW, mode="partitions"):
    return ingest.ingest_cleaned(spark, feed, *ingest.parse_window(start, end), now, mode)


def test_window_text():
    first, last = ingest.parse_window("2024-01-05T00:00:00.0000000Z")
    assert (first, last) == (datetime(2024, 1, 5), datetime(2024, 1, 6))
    assert ingest.parse_window("2024-01-05T06:00:00Z", "2024-02-01T00:00:00.5Z")[1] == datetime(2024, 2, 1, 0, 0, 0, 500000)
    with pytest.raises(ValueError):
        ingest.parse_window("")


def test_ingest_takes_the_latest_file_version(spark, feed, tmp_path):
    raw_file(tmp_path, "05", "a.csv", 1_700_000_000, "1|old|1.5", '2|"two\nlines"|2')
    raw_file(tmp_path, "05", "b.csv", 1_700_000_060, "1|new|1.5")
    raw_file(tmp_path, "06", "c.csv", 1_700_000_000, "1|other day|3")
    before = set(Path(shared_folder(spark)).iterdir())
    assert load(spark, feed) == {"rows": 2, "files": 2}
    assert set(Path(shared_folder(spark)).iterdir()) == before
    cleaned = spark.read.parquet(feed.cleaned_path)
    assert rows(cleaned, "id", "name") == [(1, "new"), (2, "two\nlines")]
    log = tables.read_log(spark, feed.log_path)
    assert {r["DqCheckType"]: (r["FirstRecordMeasureValue"], r["SecondRecordMeasureValue"]) for r in log.collect()} == {
        "SchemaConsistency": (3, 0), "Duplication": (2, 2), "PrimaryKeyConsistency": (0, 2), "CountIntegrity": (2, 2),
    }
    assert log.schema.names == DQ_LOG_SCHEMA.names
    # again, and then the next day: the first day is replaced by the same rows, then left alone
    load(spark, feed)
    load(spark, feed, "2024-01-06T00:00:00Z")
    assert rows(spark.read.parquet(feed.cleaned_path), "id", "name") == [(1, "new"), (1, "other day"), (2, "two\nlines")]


def test_upsert_updates_by_business_key(spark, feed, tmp_path):
    raw_file(tmp_path, "04", "a.csv", 1_700_000_000, "9|far|9")
    raw_file(tmp_path, "05", "a.csv", 1_700_000_000, "1|a|1", "2|b|2")
    raw_file(tmp_path, "06", "a.csv", 1_700_000_000, "3|c|3")
    raw_file(tmp_path, "07", "a.csv", 1_700_000_000, "4|alone|4")
    load(spark, feed, start="2024-01-04T00:00:00Z", end="2024-01-08T00:00:00Z")
    kept = {f: f.read_bytes() for f in (tmp_path / "cleaned").rglob("*=2024-01-04/*.parquet")}
    for day in ("05", "06", "07"):
        (tmp_path / "raw" / "year=2024" / "month=01" / f"day={day}" / "a.csv").unlink()
    # key 1 comes again on a later day, key 4 leaves its day empty, key 7 is on two days of the batch
    raw_file(tmp_path, "08", "b.csv", 1_700_000_060, "1|changed|4", "4|moved|4", "7|first|5")
    raw_file(tmp_path, "09", "b.csv", 1_700_000_060, "7|last|6")
    done = load(spark, feed, "2024-01-08T00:00:00Z", "2024-01-10T00:00:00Z", now=datetime(2024, 2, 2), mode="upsert")
    assert done["rows"] == 3 and kept and all(f.read_bytes() == b for f, b in kept.items())
    cleaned = spark.read.parquet(feed.cleaned_path)
    day = F.date_format(ingest.DATE, "dd").alias("day")
    assert rows(cleaned.select("id", "name", day)) == [
        (1, "changed", "08"), (2, "b", "05"), (3, "c", "06"), (4, "moved", "08"), (7, "last", "09"), (9, "far", "04")]
    assert cleaned.where("name = 'changed' AND __CreatedOn < __UpdatedOn").count() == 1


@pytest.mark.parametrize("lines, check", [
    (["1|a|not a number"], "SchemaConsistency"),
    (["1|a|1", "1|a|1"], "Duplication"),
    (["1|a|1", "1|b|1"], "PrimaryKeyConsistency"),
])
def test_failed_gate_raises_with_its_log_row(spark, feed, tmp_path, lines, check):
    raw_file(tmp_path, "05", "a.csv", 1_700_000_000, *lines)
    with pytest.raises(DataQualityError) as failed:
        load(spark, feed)
    assert failed.value.log_row["DqCheckType"] == check
    assert tables.read_log(spark, feed.log_path).where(F.col("DqCheckType") == check).count() == 1
    assert not (tmp_path / "cleaned").exists()


def test_the_log_names_the_list_of_files(spark, feed, tmp_path):
    for i in range(3):
        raw_file(tmp_path, "05", f"{i}.csv", 1_700_000_000, f"{i}|a|1")
    assert load(spark, feed)["files"] == 3
    kept = tables.read_log(spark, feed.log_path).first()["DataAssetFilesChecked"]
    count, _, path = kept.partition(" listed in ")
    assert count == "3" and spark.read.parquet(path).count() == 3


def test_history_of_measures(spark):
    from datetime import date
    entries = [("a", "Dup", date(2024, 1, 1), n, NOW.replace(hour=n)) for n in (3, 9, 5)]
    log = spark.createDataFrame(
        [(a, c, d, "x", n, "y", n, t) for a, c, d, n, t in entries],
        "SourceDataAsset string, DqCheckType string, DqCheckDate date, FirstRecordMeasureTitle string, FirstRecordMeasureValue long,"
        "SecondRecordMeasureTitle string, SecondRecordMeasureValue long, __CreatedOn timestamp",
    )
    assert latest_measures(log).first()["FirstRecordMeasureValue"] == 9


def test_conform_and_serve(spark, tmp_path, monkeypatch):
    root, log = str(tmp_path / "dim"), str(tmp_path / "log")
    source = spark.createDataFrame([("k1", "a"), ("k2", None)], "id string, name string")
    conform.conform_scd2(spark, "dim_people", root, source, "id", conform.load_id_for(NOW), NOW, "ERP", log)
    changed = source.withColumn("name", F.coalesce("name", F.lit("named")))
    conform.conform_scd2(spark, "dim_people", root, changed, "id", "later", datetime(2024, 3, 1), "ERP", log)
    assert rows(spark.table("dim_people"), "id", "name", "CurrInd", "LoadID") == [
        ("k1", "a", True, "20240201120000"), ("k2", "named", True, "later"), ("k2", None, False, "20240201120000"),
    ]
    # a source that lost a key leaves more current rows than source rows, which the count gate reports
    with pytest.raises(DataQualityError):
        conform.conform_scd2(spark, "dim_people", root, changed.where("id = 'k1'"), "id", "last", datetime(2024, 4, 1), "ERP", log)
    assert spark.table("dim_people").count() == 3
    sent = []
    monkeypatch.setattr(serve, "replace_table", lambda df, url, name, options, types: sent.append((df.count(), name, types)))
    serve.serve_tables(spark, {"dim_people": "dbo.people"}, "jdbc:x:", {}, {"dim_people": {"id": "VARCHAR(20)"}})
    assert sent == [(3, "dbo.people", {"id": "VARCHAR(20)"})]
    spark.sql("DROP TABLE dim_people")


def test_feeds_are_tried_twice_and_failures_reported(spark):
    tries = {}

    def load_one(name):
        tries[name] = tries.get(name, 0) + 1
        if name == "bad" or (name == "slow" and tries[name] == 1):
            raise RuntimeError("no")
    with pytest.raises(feeds.FeedsFailed) as failed:
        feeds.run_feeds(spark, ["good", "slow", "bad"], load_one)
    assert rows(failed.value.status, "feed", "status", "attempts") == [("bad", "failed", 2), ("good", "loaded", 1), ("slow", "loaded", 2)]
    assert feeds.run_feeds(spark, ["good"], load_one).count() == 1


def test_a_feed_over_its_limit_is_ended_and_tried_again(spark):
    tries = {}

    def load_one(name):
        tries[name] = tries.get(name, 0) + 1
        if name == "hangs once" and tries[name] == 1 or name == "hangs":
            sleeping = F.udf(lambda x: __import__("time").sleep(60) or x)
            spark.range(2).select(sleeping("id")).write.format("noop").mode("overwrite").save()
        spark.range(10).write.format("noop").mode("overwrite").save()
    begun = time.monotonic()
    with pytest.raises(feeds.FeedsFailed) as failed:
        feeds.run_feeds(spark, ["good", "hangs once", "hangs", "also good"], load_one, at_once=3, limit=3)
    assert time.monotonic() - begun < 40
    assert rows(failed.value.status, "feed", "status", "attempts") == [
        ("also good", "loaded", 1), ("good", "loaded", 1), ("hangs once", "loaded", 2), ("hangs", "timed out", 2)]
    assert [r["error"] for r in failed.value.status.collect() if r["error"]] == ["hangs took more than 3 s"]


def test_a_feed_that_hangs_outside_of_spark_is_not_run_twice(spark):
    tries, go_on, later = [], threading.Event(), []

    def load_one(name):
        tries.append(name)
        go_on.wait(30)
        try:
            spark.range(10).write.format("noop").mode("overwrite").save()
            later.append("ran")
        except Exception:
            later.append("cancelled")
    with pytest.raises(feeds.FeedsFailed) as failed:
        feeds.run_feeds(spark, ["stuck"], load_one, limit=0.5, grace=0.5)
    assert rows(failed.value.status, "feed", "status", "attempts") == [("stuck", "timed out", 1)] and tries == ["stuck"]
    go_on.set()
    assert spark.range(3).count() == 3  # the caller's own jobs go on


def test_rows_without_a_key_stay_on_all_days(spark, tmp_path):
    shape = T.StructType().add("id", "integer").add("part", "integer").add("name", "string")
    feed = ingest.Feed("pairs", str(tmp_path / "raw"), str(tmp_path / "cleaned"), str(tmp_path / "log"), shape, ["id", "part"])
    for day in ("05", "06"):
        raw_file(tmp_path, day, "a.csv", 1_700_000_000, f"1|1|key {day}", f"|1|half {day}", f"||none {day}", header="id|part|name")
    assert load(spark, feed, end="2024-01-07T00:00:00Z", mode="upsert")["rows"] == 5
    assert rows(spark.read.parquet(feed.cleaned_path), "name") == [("half 05",), ("half 06",), ("key 06",), ("none 05",), ("none 06",)]
    raw_file(tmp_path, "08", "b.csv", 1_700_000_060, "1|1|key 08", "|1|half 08", header="id|part|name")
    load(spark, feed, "2024-01-08T00:00:00Z", now=datetime(2024, 2, 2), mode="upsert")
    assert rows(spark.read.parquet(feed.cleaned_path), "name") == [
        ("half 05",), ("half 06",), ("half 08",), ("key 08",), ("none 05",), ("none 06",)]


def test_rows_of_the_null_partition_stay(spark, tmp_path):
    shape, path = "id int, v string, p string", str(tmp_path / "table")
    tables.overwrite_partitions(spark.createDataFrame([(1, "a", "x"), (2, "b", None), (3, "c", None), (4, "d", "y")], shape), path, ["p"])
    read = lambda: spark.read.schema(shape).parquet(path)
    batch = spark.createDataFrame([(1, "new", None), (2, "new", None)], shape)
    seen = tables.merge_partitions(read(), batch, ["id"], lambda part: upsert(part, batch, ["id"], F.lit(None)), path, "p")
    assert seen == {"rows": 3}
    assert rows(read(), "id", "v", "p") == [(1, "new", None), (2, "new", None), (3, "c", None), (4, "d", "y")]
    assert not (tmp_path / "table" / "p=x").exists()
    # the null partition itself empties
    moved = spark.createDataFrame([(i, "on", "y") for i in (1, 2, 3)], shape)
    tables.merge_partitions(read(), moved, ["id"], lambda part: upsert(part, moved, ["id"], F.lit(None)), path, "p")
    assert rows(read(), "id", "p") == [(1, "y"), (2, "y"), (3, "y"), (4, "y")] and [p.name for p in (tmp_path / "table").glob("p=*")] == ["p=y"]


def test_gates_count_each_copy_once(spark, feed, tmp_path, monkeypatch):
    """Once the latest rows are written, neither the scan nor the table is read for a count."""
    raw_file(tmp_path, "05", "a.csv", 1_700_000_000, "1|a|1", "2|b|2")
    held = ingest.materialize_measured

    def then_gone(df, name, measures=None):
        made = held(df, name, measures)
        if name == "latest":
            [batch] = Path(shared_folder(spark)).glob("batch-*")
            shutil.rmtree(batch)
        return made
    monkeypatch.setattr(ingest, "materialize_measured", then_gone)
    monkeypatch.setattr(spark.read.__class__, "parquet", unread(spark.read.__class__.parquet, feed.cleaned_path))
    assert load(spark, feed) == {"rows": 2, "files": 1}


def unread(parquet, path):
    def read(self, *paths, **options):
        assert path not in paths, "the table was read"
        return parquet(self, *paths, **options)
    return read


def test_an_earlier_load_that_runs_again_passes_the_key_gate(spark, tmp_path):
    root, log = str(tmp_path / "dim"), str(tmp_path / "log")
    source = spark.createDataFrame([(1, "a"), (2, "b")], "id int, name string")
    loads = [source.withColumn("name", F.concat("name", F.lit(str(i)))) for i in range(3)]
    for i, rows_now in enumerate(loads):
        conform.conform_scd2(spark, "dim_gate", root, rows_now, "id", f"load-{i}", datetime(2024, 1 + i, 1), "ERP", log)
    conform.conform_scd2(spark, "dim_gate", root, loads[2], "id", "load-1", datetime(2024, 5, 1), "ERP", log)
    assert spark.table("dim_gate").select("Skid").distinct().count() == spark.table("dim_gate").count() == 6
    assert tables.read_log(spark, log).where("DqCheckType = 'PrimaryKeyConsistency'").agg(F.sum("FirstRecordMeasureValue")).first()[0] == 0
    spark.sql("DROP TABLE dim_gate")


def test_a_merge_counts_its_actions_as_it_is_written(spark, tmp_path):
    target = spark.createDataFrame([(1, "a"), (2, "b")], "id int, v string")
    batch = spark.createDataFrame([(2, "c"), (3, "d"), (None, "e")], "id int, v string")
    counts = write_merged(merge_actions(target, batch, ["id"], F.lit(None)), lambda df: df.write.parquet(str(tmp_path / "m")))
    assert counts == {"num_inserted_rows": 2, "num_updated_rows": 1, "num_deleted_rows": 0, "num_affected_rows": 3}
    assert spark.read.parquet(str(tmp_path / "m")).columns == ["id", "v"]


def test_milestone_report(spark):
    data = [
        # code, snapshot, baseline, finish, status
        (" AB.31.70 ", "2024-02-01", "2024-05-01", "2024-05-09", "Not Started"),
        ("AB.31.70", "2024-03-01", "2024-05-01", "2024-05-15", "Not Started"),
        ("AB.31.70", "2024-03-01", "2024-04-01", "2024-04-02", "Completed"),
        ("AB.31x70.2", "2024-03-01", None, "2024-06-01", "Completed"),
        ("AB.99", "2024-03-01", "2024-05-01", "2024-05-01", "Completed"),
        (None, "2024-03-01", "2024-05-01", "2024-05-01", "Completed"),
        ("AB.31.70", "2024-04-01", None, None, "Not Started"),
    ]
    df = spark.createDataFrame(data, "code string, snapshot string, base string, finish string, status string")
    df = df.withColumns({c: F.col(c).cast("date") for c in ("snapshot", "base", "finish")})
    out = reports.milestone_variance(df, "code", "snapshot", "base", "finish", "status", F.xxhash64("status"), "31.70")
    assert rows(out, "code", "variance_days", "rag", "ordinal", "reverse_ordinal", "is_current") == [
        ("AB.31.70", 14, "Red", 1, 1, True), ("AB.31.70", 8, "Amber", 0, 2, False), ("AB.31x70.2", 0, "Blue", 1, 1, True),
    ]
    axis = reports.milestone_axis(df.where("base IS NOT NULL"), "base", "finish").orderBy("month_start").collect()
    assert [str(r["month_start"])[:7] for r in axis] == ["2024-03", "2024-04", "2024-05", "2024-06"]
    assert (str(axis[0]["first"]), str(axis[0]["last"]), axis[0]["month"]) == ("2024-04-01", "2024-05-15", "Mar")


def test_milestone_tracker(spark):
    data = [
        (0, "North", "second", "2023-03-01", "2023-05-01", "Open", "Red"), (1, "North", "x" * 120, "2023-01-01", "2023-02-01", "Complete", "Green"),
        (2, "South", "third", "2022-01-01", "2022-01-01", "Amber", "Amber"), (3, "North", "second", "2023-09-01", "2023-09-01", "Open", "Green"),
    ]
    df = spark.createDataFrame(data, "i int, p string, n string, base string, fc string, status string, trend string")
    df = df.withColumns({c: F.col(c).cast("date") for c in ("base", "fc")})
    out = reports.milestone_tracker(df, "p", "n", "base", "fc", "status", "trend", "i").orderBy("slot").collect()
    assert [(r["slot"], r["p"], r["baseline_label"], r["forecast_label"], r["status_colour"], r["arrow"], r["trend_colour"]) for r in out] == [
        (1, "North", "Jan 2023", "Feb 2023", "Blue", "larrow", "Green"),
        (2, "North", "Mar 2023", "May 2023", "Open", "rarrow", "Red"),
        (3, "South", "Jan 2022", "Jan 2022", "Amber", "darrow", "#ff7f0e"),
    ]
    assert out[0]["label"] == "x" * 97 + "..."
