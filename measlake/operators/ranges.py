"""Places of rows within their key, without one task per key."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import scratch_path


def numbered(df: DataFrame, keys: list[str], order: list[str], place: str, count: str) -> DataFrame:
    """Add each row's ``place`` in its key's order, from 0, and the key's ``count`` of rows.

    Rows are sorted once over ranges of (keys, order), so a key of any size is as many
    tasks as it needs. A place is that within the range behind the key's rows in the ranges
    before; these are added up over one row per key and range. Ranges are written to the
    shared folder, so that both steps see the same ones. Rows that agree in keys and order are
    in one range and numbered as they come; rows whose key is null have one, too.
    """
    spark = df.sparkSession
    path = scratch_path(spark, "numbered")
    ranged = df.repartitionByRange(*keys, *order).withColumn("_range", F.spark_partition_id())
    ranged.write.parquet(path)
    ranged = spark.read.schema(ranged.schema).parquet(path)
    by_key = Window.partitionBy(*keys)
    before = by_key.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    totals = (
        ranged.groupBy(*keys, "_range")
        .agg(F.count(F.lit(1)).alias("_n"))
        .select(
            F.struct(*keys).alias("_key"),
            F.col("_range").alias("_of"),
            F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"),
            F.sum("_n").over(by_key).alias(count),
        )
    )
    within = F.row_number().over(Window.partitionBy(*keys, "_range").orderBy(*order)) - 1
    same = F.struct(*keys).eqNullSafe(F.col("_key")) & (F.col("_range") == F.col("_of"))
    placed = ranged.withColumn("_place", within).join(totals, same)
    return placed.select(*df.columns, (F.col("_before") + F.col("_place")).alias(place), count)
