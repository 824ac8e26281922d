"""Links between tables.

A parent may own any share of the rows, so ``children`` gives them as rows with
their positions and never gathers them in one cell.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import scratch_path



def children(links: DataFrame, parent: str, child: str, order: str) -> DataFrame:
    """Ordered children of every parent (A2): rows of parent, ``position`` (dense, from 0), child.

    All links are sorted once over ranges of (parent, order), so a parent with
    very many children lies in several ranges. A child's position is its place
    within its range behind the children in the ranges before. The ranges are
    written to the shared folder, so that both steps see the same ones.
    """
    spark = links.sparkSession
    path = scratch_path(spark, "children")
    ranged = (
        links.where(F.col(parent).isNotNull())
        .select(F.col(parent), F.col(child), F.col(order).alias("_order"))
        .repartitionByRange(parent, "_order", child)
        .withColumn("_range", F.spark_partition_id())
    )
    ranged.write.parquet(path)
    ranged = spark.read.schema(ranged.schema).parquet(path)
    before = (
        Window.partitionBy(parent).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    )
    offsets = (
        ranged.groupBy(parent, "_range")
        .agg(F.count(F.lit(1)).alias("_n"))
        .withColumn("_offset", F.coalesce(F.sum("_n").over(before), F.lit(0)))
    )
    within = Window.partitionBy(parent, "_range").orderBy("_order", child)
    placed = ranged.withColumn("_place", F.row_number().over(within) - 1)
    return placed.join(offsets, [parent, "_range"]).select(
        parent, (F.col("_offset") + F.col("_place")).alias("position"), child
    )


def link_rows(df: DataFrame, id_column: str, array_column: str, as_name: str) -> DataFrame:
    """One row per array entry: owner id, ``position`` and the id it names."""
    return df.select(
        F.col(id_column), F.posexplode(array_column).alias("position", as_name)
    ).dropna(subset=[as_name])


def owners_of(
    owners: DataFrame, array_column: str, members: DataFrame, member_id: str
) -> DataFrame:
    """Owners whose array names one of the members.

    The array is exploded and joined on equality; a containment test would
    compare every owner with every member.
    """
    key = "_owner_key"
    named = owners.select(
        F.col("id").alias(key), F.explode(array_column).alias(member_id)
    )
    hits = named.join(members.select(member_id), member_id, "left_semi").select(key).distinct()
    return owners.join(hits, owners["id"] == hits[key], "left_semi")


def members_of(owners: DataFrame, array_column: str, members: DataFrame) -> DataFrame:
    """Member rows with the owner that names them and their position."""
    named = link_rows(owners.withColumnRenamed("id", "owner_id"), "owner_id", array_column, "id")
    return named.join(members, "id")


def with_first_of_group(
    df: DataFrame, key: str, order: list[str], values: dict[str, str]
) -> DataFrame:
    """Give every row the values of its group's first row.

    The first row is found by aggregation and joined back; a window would sort
    a whole group in one task. The joined side has one row per group, so a
    large group's rows may be split over tasks.
    """
    taken = F.struct(*[F.col(source).alias(name) for name, source in values.items()])
    firsts = (
        df.where(F.col(key).isNotNull())
        .groupBy(key)
        .agg(F.min_by(taken, F.struct(*order)).alias("_first"))
        .select(key, *[F.col("_first")[name].alias(name) for name in values])
    )
    # Rows without a key match nothing, so they are kept out of the join.
    joined = df.where(F.col(key).isNotNull()).join(firsts, key, "left")
    alone = df.where(F.col(key).isNull())
    return joined.unionByName(alone, allowMissingColumns=True)
