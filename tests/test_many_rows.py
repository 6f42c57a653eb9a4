"""First, last and sampled rows where they are too many for one task."""

import pytest
from pyspark.sql import functions as F

from conftest import rows
from lakeops.operators import ranking


@pytest.fixture
def few(monkeypatch):
    monkeypatch.setattr(ranking, "FEW_ROWS", 10)


def table(spark):
    value = F.when(F.col("id") % 7 == 0, None).otherwise(F.pmod(F.xxhash64("id"), F.lit(900)))
    return spark.range(0, 5000, 1, 6).select("id", value.cast("int").alias("v"), F.date_add(F.lit("2024-01-01").cast("date"), F.pmod(F.xxhash64("id"), F.lit(90)).cast("int")).alias("d"), F.md5(F.col("id").cast("string")).alias("s"))


@pytest.mark.parametrize("n", [700, 4999, 9000])
@pytest.mark.parametrize("by", ["v", "d", "s"])
def test_first_and_last(spark, few, n, by):
    df = table(spark)
    plain = df.orderBy(by, "id").collect()
    assert ranking.first_rows(df, [by, "id"], n).collect() == plain[:n]
    assert ranking.last_rows(df, [by, "id"], n).collect() == plain[-n:]
    if by == "v":
        assert ranking.first_rows(df, [F.desc(by), "id"], n).collect() == df.orderBy(F.desc(by), "id").collect()[:n]


@pytest.mark.parametrize("n", [2500, 6000])
def test_sample(spark, few, n):
    df = table(spark)
    assert rows(ranking.sample_rows(df, ["id"], n, 3)) == rows(df.orderBy(ranking.seeded_key(["id"], 3), "id").limit(n))


def test_sample_of_equal_rows(spark, few):
    df = spark.range(0, 1000, 1, 4).select(F.lit(1).alias("id"))
    assert ranking.sample_rows(df, ["id"], 400, 1).count() == 400


def test_no_task_holds_all(spark, few):
    df = table(spark)
    for made in (ranking.first_rows(df, ["v", "id"], 700), ranking.last_rows(df, ["v", "id"], 700), ranking.sample_rows(df, ["id"], 700, 1)):
        plan = made._jdf.queryExecution().executedPlan().toString()
        assert "SinglePartition" not in plan and "Limit" not in plan and "TakeOrdered" not in plan


def test_few_rows_leave_the_rest_out(spark):
    df = table(spark)
    assert ranking._cut(df, "v", 700, False).count() < 1500 and ranking._cut(df, "v", 700, True).count() < 1000


def test_empty(spark, few):
    df = table(spark).limit(0)
    assert ranking.first_rows(df, ["v"], 50).count() == ranking.last_rows(df, ["v"], 50).count() == ranking.sample_rows(df, ["id"], 50, 1).count() == 0
