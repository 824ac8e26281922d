"""Models are parsed on all cores, however few row groups their rows are read from."""

from pyspark.sql import functions as F

from measlake.session import configure
from workloads import models


def test_models_of_one_row_group_are_parsed_by_many_tasks(spark, tmp_path):
    items = spark.range(40).select(
        "id", (F.col("id") + 1).alias("l_orderkey"), F.lit(3).cast("long").alias("l_partkey"),
        F.lit(4).cast("long").alias("l_suppkey"), F.lit(1).alias("l_linenumber"),
        *[F.lit(0.5).alias(c) for c in ("l_quantity", "l_extendedprice", "l_discount", "l_tax")],
        F.lit("R").alias("l_returnflag"), F.lit("F").alias("l_linestatus"),
    ).drop("id")
    items.union(items.limit(2)).coalesce(1).write.parquet(str(tmp_path / "lineitem.parquet"))
    for name in ("param_counts", "layer_stack", "param_resolve", "stack_props", "sample_records"):
        found = getattr(models, name)(configure(spark), str(tmp_path))
        sizes = [row["count"] for row in found.groupBy(F.spark_partition_id()).count().collect()]
        times = 4 if name == "layer_stack" else 1
        assert sum(sizes) == 42 * times
        assert len(sizes) > 4
