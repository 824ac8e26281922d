"""What the operators of this package share."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from measlake.session import configure as base_settings
from measlake.session import scratch_path

# Rows a Python task is handed at once. Texts may be long, so few.
ARROW_ROWS = "500"


def configure(spark: SparkSession) -> SparkSession:
    """Session settings the operators rely on."""
    base_settings(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", ARROW_ROWS)
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return configure(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def kept(df: DataFrame, name: str) -> DataFrame:
    """The rows, written to the shared scratch folder and read back.

    Cuts the lineage: a lost executor costs a reread, not a recomputation.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def text_bytes() -> Column:
    """UTF-8 bytes of a text, a null text being empty."""
    return F.octet_length(F.coalesce(F.col("text"), F.lit("")))


def gathered(
    batches: Iterable[pa.RecordBatch], text: str = "text", target: int = 4 << 20
) -> Iterator[tuple[pa.Table, list[bytes]]]:
    """Rows in runs of about ``target`` bytes of text, with their texts as UTF-8 (null: empty)."""
    held: list[pa.RecordBatch] = []
    texts: list[bytes] = []
    size = 0
    for batch in batches:
        column = batch.column(text).cast(pa.binary())
        first = 0
        for i, value in enumerate(column.to_pylist()):
            texts.append(value or b"")
            size += len(texts[-1])
            if size >= target:
                held.append(batch.slice(first, i + 1 - first))
                yield pa.Table.from_batches(held), texts
                held, texts, size, first = [], [], 0, i + 1
        if first < batch.num_rows:
            held.append(batch.slice(first))
    if texts:
        yield pa.Table.from_batches(held), texts
