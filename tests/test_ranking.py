"""Distributed ranks against the single-task window functions they replace."""

import pytest
from helpers import rows
from pyspark.sql import Window
from pyspark.sql import functions as F

from orderlake.operators import dense_rank, median, ntiles


def population(spark, n):
    """A third of the rows share one value, some are NULL, the rest repeat."""
    value = F.expr("CASE WHEN id % 3 = 0 THEN 0D WHEN id % 10 = 1 THEN NULL ELSE (id * 7919) % 97 END")
    return spark.range(n).select(value.alias("v"), F.concat(F.lit("u"), F.col("id")).alias("user_id")).repartition(5)


@pytest.mark.parametrize("n", [0, 1, 2, 4, 5, 7, 23, 1003])
def test_ntiles_equal_the_window(spark, n):
    df = population(spark, n)
    tie = F.col("user_id").asc()
    windows = {"down": [F.col("v").desc(), tie], "up": [F.col("v").asc(), tie]}
    expected = df.withColumns({q: F.ntile(5).over(Window.orderBy(*o)) for q, o in windows.items()})
    actual = ntiles(df, 5, {"down": ("v", True), "up": ("v", False)}, "user_id")
    assert actual.dtypes == expected.dtypes
    assert rows(actual) == rows(expected)


@pytest.mark.parametrize("n", [0, 1, 7, 500])
def test_dense_rank_equals_the_window(spark, n):
    df = population(spark, n)
    expected = df.withColumn("place", F.dense_rank().over(Window.orderBy(F.col("v").desc())))
    assert rows(dense_rank(df, "v", "place")) == rows(expected)


@pytest.mark.parametrize("n", [0, 1, 2, 3, 10, 501])
def test_median_equals_the_aggregate(spark, n):
    df = population(spark, n)
    assert median(df, "v").collect() == df.agg(F.median("v").alias("median")).collect()


@pytest.mark.parametrize("value", ["id * 37 % 100003", "CASE WHEN id < 60000 THEN 5D ELSE id END", "CASE WHEN id % 2 = 0 THEN -1e300 ELSE exp(id / 300) END"])
def test_median_of_many_values(spark, value):
    df = spark.range(200_001).selectExpr(f"cast({value} as double) AS v", "id").repartition(7)
    assert median(df, "v").first()[0] == df.agg(F.median("v")).first()[0]
    even = df.filter("id > 0")
    assert median(even, "v").first()[0] == even.agg(F.median("v")).first()[0]


def test_nothing_runs_before_the_median_is_asked_for(spark):
    before = set(spark.sparkContext.statusTracker().getJobIdsForGroup(None))
    plan = median(population(spark, 100), "v")._jdf.queryExecution().executedPlan().toString()
    assert set(spark.sparkContext.statusTracker().getJobIdsForGroup(None)) == before
    assert "rangepartitioning" not in plan and "NestedLoop" not in plan
