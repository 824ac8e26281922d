"""First record per key, by aggregation (A1, A3).

``min_by`` combines on the map side, so a key that holds a large share of the
rows sends one candidate per task. A row-number window would send all of them
to one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _order(columns: list[str | Column]) -> Column:
    return F.struct(*[F.col(c) if isinstance(c, str) else c for c in columns])


def first_record(
    df: DataFrame, keys: list[str], order: list[str | Column], values: list[str] | None = None
) -> DataFrame:
    """The first row of each key in the given order. Null keys are dropped."""
    values = values or [c for c in df.columns if c not in keys]
    picked = (
        df.where(" AND ".join(f"`{key}` IS NOT NULL" for key in keys))
        .groupBy(*keys)
        .agg(F.min_by(F.struct(*[F.col(c).alias(c) for c in values]), _order(order)).alias("_row"))
    )
    fields = [c for c in values if c not in keys]
    return picked.select(*keys, *[F.col("_row")[c].alias(c) for c in fields])


def distinct_by_id(parts: list[DataFrame], id_column: str = "id") -> DataFrame:
    """Union of tables, keeping the first row of each id.

    Earlier tables win; within a table the row order is given by ``ord``. Rows
    without an id count as one.
    """
    tagged = [
        part.withColumn("_part", F.lit(position)) for position, part in enumerate(parts)
    ]
    union = tagged[0]
    for part in tagged[1:]:
        union = union.unionByName(part)
    values = [c for c in union.columns if c not in ("_part",)]
    picked = union.groupBy(id_column).agg(
        F.min_by(F.struct(*values), F.struct("_part", "ord")).alias("_row")
    )
    return picked.select(*[F.col("_row")[c].alias(c) for c in values])
