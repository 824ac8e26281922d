"""Log values of each run, ready for a pick by preference.

Only the listed names are kept, before anything is shuffled. One aggregation
then takes the first record of every name, so a run with very many log rows
sends one candidate per name and task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import instruments


def first_logs(logs: DataFrame, keys: list[str], names: list[str], order: list[str]) -> DataFrame:
    """One row per key with the first record of every name, ``log_0`` and so on.

    A record starts with its order columns, so the smallest one is the first.
    """
    record = F.struct(*order, "average_value", "value_numeric")
    firsts = [
        F.min(F.when(F.col("log_name") == name, record)).alias(f"log_{i}")
        for i, name in enumerate(names)
    ]
    return logs.filter(F.col("log_name").isin(*names)).groupBy(*keys).agg(*firsts)


def merge_firsts(firsts: DataFrame, keys: list[str], names: list[str]) -> DataFrame:
    """First records of a wider key from those of narrower ones."""
    return firsts.groupBy(*keys).agg(*[F.min(f"log_{i}").alias(f"log_{i}") for i, _ in enumerate(names)])


def as_values(
    firsts: DataFrame, keys: list[str], names: list[str], prefer_average: bool = True
) -> DataFrame:
    """One row per key with ``log_values``, a map from name to value."""
    entries = F.array(
        *[
            F.struct(
                F.lit(name).alias("name"),
                instruments.log_value(F.col(f"log_{i}"), prefer_average).alias("value"),
            )
            for i, name in enumerate(names)
        ]
    )
    return firsts.select(*keys, F.map_from_entries(entries).alias("log_values"))


def log_values(
    logs: DataFrame,
    keys: list[str],
    names: list[str],
    order: list[str],
    prefer_average: bool = True,
) -> DataFrame:
    """First records per key, turned into values."""
    return as_values(first_logs(logs, keys, names, order), keys, names, prefer_average)
