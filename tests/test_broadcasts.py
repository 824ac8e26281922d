"""Sides of joins go through the driver by their measured size only."""

import re

import pytest
from pyspark.sql import functions as F

from measlake.session import MEASURED_BROADCAST, PLANNED_BROADCAST, configure


@pytest.fixture
def planned(spark):
    """The session as its owner has it: Spark's own limit, before a plan is configured."""
    kept = {key: spark.conf.get(key, None) for key in (PLANNED_BROADCAST, MEASURED_BROADCAST)}
    spark.conf.set(PLANNED_BROADCAST, "256k")
    spark.conf.unset(MEASURED_BROADCAST)
    yield spark
    for key, value in kept.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def joined(spark, folder, width):
    """Rows of a small file, each made ``width`` characters long, joined to others."""
    spark.range(2000).write.parquet(folder)
    left = spark.range(3000).withColumn("n", F.col("id") % 2500)
    long = spark.read.parquet(folder).select(F.col("id").alias("k"), F.repeat(F.lit("x"), width).alias("text"))
    return left.join(long, F.col("n") == F.col("k"), "left")


def joins(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    return set(re.findall(r"\w+Join", plan.split("== Initial Plan ==")[0]))


def test_rows_longer_than_their_file_are_not_broadcast(planned, tmp_path):
    df = joined(configure(planned), str(tmp_path / "t"), 1000)
    assert joins(df) == {"SortMergeJoin"}
    assert df.where("text IS NOT NULL").count() == 2500 - 500 + 500
    df.collect()
    assert "BroadcastHashJoin" not in joins(df)


def test_a_side_measured_as_small_is_still_broadcast(planned, tmp_path):
    df = joined(configure(planned), str(tmp_path / "t"), 1)
    df.collect()
    assert joins(df) == {"BroadcastHashJoin"}


def test_the_limit_of_the_session_holds(planned):
    configure(configure(planned))
    assert planned.conf.get(MEASURED_BROADCAST).lower() in ("256k", "262144", "262144b")
    planned.conf.set(PLANNED_BROADCAST, "-1")
    planned.conf.unset(MEASURED_BROADCAST)
    configure(planned)
    assert planned.conf.get(MEASURED_BROADCAST, None) is None
