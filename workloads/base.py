"""Registration and table access."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from measlake.session import configure

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}

INGEST = "w1"
# A fixed ingest time, so that results do not depend on the clock.
INGEST_TIME = "2026-01-02 03:04:05"


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query, with its SQL where there is one."""

    def register(run: Query) -> Query:
        def with_settings(spark: SparkSession, sf_dir: str) -> DataFrame:
            return run(configure(spark), sf_dir)

        QUERIES[name] = with_settings
        if sql is not None:
            SQL[name] = sql
        return run

    return register


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def dealt(rows: DataFrame) -> DataFrame:
    """Narrow rows over all cores, before work that takes long for each of them.

    A file of a few large row groups is read by as many tasks, whatever its rows become.
    """
    return rows.repartition(4 * rows.sparkSession.sparkContext.defaultParallelism)


def ingest_time() -> Column:
    return F.lit(INGEST_TIME).cast("timestamp")


def text(*parts: Column | str) -> Column:
    """Concatenate strings and columns."""
    return F.concat(*[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts])


def composed(df: DataFrame, *columns: Column) -> DataFrame:
    """Columns composed from others, computed once per row like columns of a file."""
    return df.select(F.inline(F.array(F.struct(*columns))))


def sql_id(kind: str, *parts: str) -> str:
    """SQL for the id the library gives to a record."""
    key = " || '|' || ".join([f"'{kind}'", f"'{INGEST}'", *[f"CAST({p} AS VARCHAR)" for p in parts]])
    h = f"sha256({key})"
    return (
        f"({h}[1:8] || '-' || {h}[9:12] || '-' || {h}[13:16] || '-' || {h}[17:20] "
        f"|| '-' || {h}[21:32])"
    )
