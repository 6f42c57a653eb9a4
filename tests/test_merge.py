import random

import pytest
from pyspark.sql import functions as F

from conftest import rows
from lakeops.durable import materialize
from lakeops.operators import merge


def now():
    return F.lit("2024-02-01").cast("timestamp")


def then():
    return F.lit("2024-01-01").cast("timestamp")


def target(spark):
    df = spark.createDataFrame([(1, "a", 10), (2, "b", 20), (None, "n", 0)], "k int, x string, y int")
    return df.withColumns({"__CreatedOn": then(), "__UpdatedOn": then()})


def test_upsert_updates_all_columns_and_inserts_null_keys(spark):
    batch = spark.createDataFrame([(2, None, 21), (3, "c", 30), (None, "m", 1)], "k int, x string, y int")
    out = merge.upsert(target(spark), batch, ["k"], now())
    assert rows(out, "k", "x", "y") == sorted([(1, "a", 10), (2, None, 21), (3, "c", 30), (None, "n", 0), (None, "m", 1)], key=repr)
    stamps = {r["k"]: (r["__CreatedOn"].month, r["__UpdatedOn"].month) for r in out.where("k IS NOT NULL").collect()}
    assert stamps == {1: (1, 1), 2: (1, 2), 3: (2, 2)}


def test_upsert_twice_equals_once(spark):
    batch = spark.createDataFrame([(2, "z", 21), (3, "c", 30)], "k int, x string, y int")
    once = merge.upsert(target(spark), batch, ["k"], now())
    twice = merge.upsert(once, batch, ["k"], now())
    assert rows(once) == rows(twice)


def test_upsert_fills_columns_the_batch_lacks(spark):
    batch = spark.createDataFrame([(1, 11), (4, 40)], "k int, y int")
    assert rows(merge.upsert(target(spark), batch, ["k"], now()).where("k IN (1, 4)"), "k", "x", "y") == [(1, "a", 11), (4, None, 40)]


def test_duplicate_source_keys_raise(spark):
    batch = spark.createDataFrame([(2, "z", 1), (2, "y", 2)], "k int, x string, y int")
    with pytest.raises(merge.DuplicateKeys):
        merge.upsert(target(spark), batch, ["k"], now())


def test_affected_rows(spark):
    batch = spark.createDataFrame([(2, "z", 1), (3, "y", 2)], "k int, x string, y int")
    counts = merge.affected_rows(merge.merge_actions(target(spark), batch, ["k"], now())).first()
    assert tuple(counts) == (1, 1, 0, 2)


def test_checksum_sees_where_a_null_is(spark):
    df = spark.createDataFrame([("a", None), (None, "a")], "x string, y string")
    assert df.select(merge.row_checksum(["x", "y"]).alias("c")).distinct().count() == 2


def test_null_keys_pass_around_the_joins(spark):
    batch = spark.createDataFrame([(2, "z", 1), (None, "m", 1)], "k int, x string, y int")
    merged = merge.merge_actions(target(spark), batch, ["k"], now())
    assert rows(merged, "k", "x", "__action") == sorted(
        [(1, "a", "keep"), (2, "z", "update"), (None, "n", "keep"), (None, "m", "insert")], key=repr)
    assert "FullOuter" not in merged._jdf.queryExecution().optimizedPlan().toString()


def test_scd2_reads_only_its_own_load_to_guard_a_rerun(spark, tmp_path):
    at = F.lit("2024-01-01").cast("timestamp")
    first = spark.createDataFrame([(1, "a"), (2, "b")], "k int, x string")
    merge.scd2_initial(first, "k", "L1", at, "S").write.parquet(str(tmp_path / "t"))
    table = spark.read.parquet(str(tmp_path / "t"))
    rows_ = merge.scd2_versions(table, first.withColumn("x", F.lit("c")), "k", "L2", now(), "S")
    assert "EqualTo(LoadID,L2)" in rows_._jdf.queryExecution().executedPlan().toString()


def test_scd2_versions_never_overlap(spark):
    """Random batches: one current row per key, versions that follow each other, unique keys."""
    rng = random.Random(3)
    table = None
    for load in range(4):
        keys = rng.sample(range(12), 8)
        batch = spark.createDataFrame([(k, rng.choice("ab") if k % 4 else None) for k in keys], "k int, x string")
        at = F.lit(f"2024-0{load + 1}-01").cast("timestamp")
        new = (
            merge.scd2_initial(batch, "k", f"L{load}", at, "S") if table is None
            else merge.scd2_apply(table, batch, "k", f"L{load}", at, "S")
        )
        table = materialize(new)
        again = merge.scd2_apply(table, batch, "k", f"L{load}", at, "S")
        assert rows(again) == rows(table)
        latest = {r["k"]: r["x"] for r in table.where("CurrInd").collect()}
        assert all(latest[r["k"]] == r["x"] for r in batch.collect())
    per_key = {}
    for r in table.orderBy("k", "ValidFromDt").collect():
        per_key.setdefault(r["k"], []).append(r)
    for versions in per_key.values():
        assert [v["CurrInd"] for v in versions] == [False] * (len(versions) - 1) + [True]
        assert len({v["Ekid"] for v in versions}) == 1
        for old, new in zip(versions, versions[1:]):
            assert old["ValidToDt"] < new["ValidFromDt"]
            assert old["InsertCheckSum"] == new["InsertCheckSum"] and old["RecordCreatedDt"] == new["RecordCreatedDt"]
    skids = [r["Skid"] for r in table.collect()]
    assert sorted(skids) == list(range(1, len(skids) + 1))


def test_scd2_same_load_with_other_rows_leaves_a_current_version(spark):
    at = F.lit("2024-01-01").cast("timestamp")
    one = spark.createDataFrame([(1, "a")], "k int, x string")
    table = materialize(merge.scd2_initial(one, "k", "L", at, "S"))
    again = merge.scd2_apply(table, one.withColumn("x", F.lit("b")), "k", "L", now(), "S")
    assert rows(again, "x", "CurrInd") == [("a", True)]


def test_missing_keys_stay_open(spark):
    first = spark.createDataFrame([(1, "a"), (2, "b")], "k int, x string")
    table = materialize(merge.scd2_initial(first, "k", "L1", then(), "S"))
    later = merge.scd2_apply(table, first.where("k = 1"), "k", "L2", now(), "S")
    assert later.where("CurrInd").count() == 2


def test_inferred_members_once(spark):
    dim = spark.createDataFrame([(1, "a", False)], "k int, x string, unknown boolean")
    facts = spark.createDataFrame([(1,), (5,), (5,), (6,)], "fk int")
    defaults = {"x": F.lit("NA"), "unknown": F.lit(True)}
    once = merge.infer_members(dim, facts, "fk", "k", defaults)
    assert rows(once) == [(1, "a", False), (5, "NA", True), (6, "NA", True)]
    assert rows(merge.infer_members(once, facts, "fk", "k", defaults)) == rows(once)


def test_scd1_duplicates_of_the_last_partition_raise(spark):
    cleaned = spark.createDataFrame([(1, "2024-01-02", "a"), (1, "2024-01-02", "b")], "k int, d string, x string").withColumn("d", F.col("d").cast("date"))
    flat = cleaned.where("false").withColumns({"__UnknownFlag": F.lit(False), "__CreatedOn": now(), "__UpdatedOn": now()})
    with pytest.raises(merge.DuplicateKeys):
        merge.scd1_apply(flat, cleaned, "k", "d", "2024-01-01", "2024-02-01", {"k": -1}, now())
