"""Hot keys: same rows as the plain forms, spread over tasks."""

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from conftest import rows
from lakeops.operators.ranking import latest_per_key
from lakeops.operators.skew import hot_keys, spread_join


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of the rows have key 0, a third no key, the others a key each."""
    return spark.range(900).select(
        F.col("id"),
        F.when(F.col("id") % 3 == 0, F.lit(0)).when(F.col("id") % 3 == 1, F.col("id")).cast("bigint").alias("k"),
        (F.col("id") % 7).alias("v"),
    )


@pytest.fixture(scope="module")
def lookup(spark):
    return spark.range(0, 900, 2).select(F.col("id").alias("k"), (F.col("id") * 10).alias("name"))


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_spread_join_equals_join(skewed, lookup, how):
    spread = spread_join(skewed, lookup, ["k"], how, floor=50)
    assert "__salt" in spread._jdf.queryExecution().toString()
    assert rows(spread) == rows(skewed.join(lookup, ["k"], how).select(spread.columns))


def test_hot_rows_go_to_many_tasks(spark, skewed, lookup):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        at = F.spark_partition_id().alias("p")
        plain = skewed.join(lookup, ["k"], "left").select("k", at)
        spread = spread_join(skewed, lookup, ["k"], "left", floor=50).select("k", at)
        for key in (F.col("k") == 0, F.col("k").isNull()):
            assert plain.where(key).distinct().count() == 1
            assert spread.where(key).distinct().count() > 1
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.enabled")


def test_copies_of_one_row_are_split(spark, lookup):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        copies = spark.range(0, 800, 1, 8).select(F.lit(4).cast("bigint").alias("k"), F.lit("same").alias("x"))
        spread = spread_join(copies, lookup, ["k"], floor=50)
        assert spread.count() == 800
        assert spread.select(F.spark_partition_id()).distinct().count() > 1
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.enabled")


def test_hot_keys_have_parts_by_their_rows(skewed):
    assert {r["k"]: r["__parts"] for r in hot_keys(skewed, ["k"], floor=50).collect()} == {0: 6, None: 6}
    assert hot_keys(skewed, ["k"], floor=500) is None


def test_no_limit_on_the_number_of_hot_keys(spark):
    many = spark.range(30_000).select((F.col("id") % 1500).alias("k"))
    assert hot_keys(many, ["k"], floor=10).count() == 1500


def test_lookups_are_not_brought_to_one_task(skewed, lookup):
    for how in ("inner", "left"):
        plan = spread_join(skewed, lookup.distinct(), ["k"], how)._jdf.queryExecution().executedPlan().toString()
        assert "LocalLimit" not in plan and "SinglePartition" not in plan


@pytest.mark.parametrize("floor", [20, 10_000])
def test_latest_per_key_keeps_ties_and_null_keys(skewed, floor):
    versions = skewed.withColumn("at", F.when(F.col("id") % 5 != 0, F.col("v")))
    by = Window.partitionBy("k").orderBy(F.desc_nulls_last("at"))
    wanted = versions.withColumn("r", F.dense_rank().over(by)).where("r = 1").drop("r")
    assert rows(latest_per_key(versions, ["k"], "at", floor=floor)) == rows(wanted)


def test_latest_per_key_without_any_version(spark):
    df = spark.createDataFrame([(1, None, "a"), (1, None, "b"), (2, 5, "c")], "k int, at int, x string")
    for floor in (1, 100):
        assert rows(latest_per_key(df, ["k"], "at", floor=floor), "x") == [("a",), ("b",), ("c",)]
