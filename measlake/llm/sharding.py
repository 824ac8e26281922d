"""Sharding by sampled splitters: shards of near-equal bytes, each a range of keys.

A record's key is a hash of its text and, behind it, a hash of its id, so equal
texts stand together and a text with very many copies can still be cut between
copies. Keys are sampled with a chance in proportion to size; quantiles of the
sample are the splitters of ranges. Ranges that turn out overfull are sampled
again, more densely, and subdivided. The sample's size is bounded by the number
of ranges, and a bad sample costs balance between tasks, not a wrong result:
shards are cut by exact prefix sums over the ranges.

A null text has no bytes; its record has the fixed overhead alone. Null ids are
allowed. Repeated rows stand together, each with a slot of its own. Other
columns are carried along; those named like the ones made here are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from measlake.llm.common import kept, text_bytes

SHARDS = 24
OVERHEAD = 8
# Ranges per shard, keys sampled per range, rounds of subdividing.
RANGES = 16
SAMPLES = 24
ROUNDS = 3


def key() -> Column:
    """32 hex digits: of the text's hash, then of the id's."""
    text = F.md5(F.coalesce(F.col("text"), F.lit("")))
    of_id = F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("null")))
    return F.concat(F.substring(text, 1, 16), F.substring(of_id, 1, 16))


def sized(docs: DataFrame) -> DataFrame:
    """Adds ``size`` and ``key``."""
    return docs.withColumn("size", text_bytes().cast("long") + OVERHEAD).withColumn("key", key())


def sampled(records: DataFrame, chance: Column) -> list[tuple[str, int]]:
    """Keys drawn with the given chance, with the bytes each stands for."""
    drawn = records.where(F.rand(7) < chance).select("key", (F.col("size") / chance).alias("w"))
    return [(row.key, row.w) for row in drawn.collect()]


def quantiles(sample: list[tuple[str, int]], ranges: int) -> list[str]:
    """Keys that cut the sample into ranges of about equal weight."""
    if not sample:
        return []
    keys, weights = zip(*sorted(sample))
    reached = np.cumsum(weights)
    at = np.searchsorted(reached, reached[-1] * np.arange(1, ranges) / ranges)
    return sorted({keys[i] for i in at.tolist()})


def in_ranges(records: DataFrame, splitters: list[str]) -> DataFrame:
    """Adds ``__range``, the number of splitters that a key is not below."""
    bounds = np.array(splitters, dtype="S32")

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = np.array(batch.column("key").cast(pa.binary()).to_pylist(), dtype="S32")
            found = np.searchsorted(bounds, keys, side="right").astype(np.int32)
            yield batch.append_column("__range", pa.array(found))

    return records.mapInArrow(find, f"{records.schema.simpleString()[7:-1]},__range:int")


def ranges_of(records: DataFrame, shards: int) -> tuple[list[str], list]:
    """Splitters, and per range that has records: its number, bytes, rows, largest record."""
    total = records.agg(F.sum("size")).first()[0]
    if not total:
        return [], []
    wanted = shards * RANGES
    each = total / wanted
    chance = F.least(F.lit(1.0), F.col("size") * SAMPLES / F.lit(each))
    splitters = quantiles(sampled(records.select("key", "size"), chance), wanted)
    for turn in range(ROUNDS + 1):
        found = in_ranges(records.select("key", "size"), splitters)
        totals = sorted(
            found.groupBy("__range")
            .agg(F.sum("size"), F.count(F.lit(1)), F.max("size"), F.min("key"), F.max("key"))
            .collect()
        )
        # A range of one key, or that one record fills, cannot be cut.
        over = [t for t in totals if t[1] > 2 * max(each, t[3]) and t[4] != t[5]]
        if turn == ROUNDS or not over:
            break
        for number, size, *_ in over:
            inside = found.where(F.col("__range") == number)
            chance = F.least(F.lit(1.0), F.col("size") * SAMPLES / F.lit(each))
            splitters += quantiles(sampled(inside, chance), int(size / each) + 1)
        splitters = sorted(set(splitters))
    return splitters, totals


def shard(records: DataFrame, shards: int = SHARDS) -> DataFrame:
    """Records with a size and a key, and for each its shard and slot in it (gapless from 0)."""
    records = records.drop("shard", "slot", "__range")
    splitters, totals = ranges_of(records, shards)
    if not totals:
        return records.withColumns({"shard": F.lit(0), "slot": F.lit(0).cast("long")}).limit(0)
    total = sum(t[1] for t in totals)
    # What stands before each range, as arrays of one entry per range.
    bytes_in, rows_in = [0] * (len(splitters) + 2), [0] * (len(splitters) + 2)
    for number, size, rows, *_ in totals:
        bytes_in[number + 1], rows_in[number + 1] = size, rows
    bytes_before, rows_before = np.cumsum(bytes_in).tolist(), np.cumsum(rows_in).tolist()

    def before(values: list[int]) -> Column:
        return F.element_at(F.lit(values).cast("array<bigint>"), F.col("__range") + 1)

    in_order = Window.partitionBy("__range").orderBy("key", "doc_id", "size")
    reached = F.sum("size").over(in_order.rowsBetween(Window.unboundedPreceding, 0))
    middle = 2 * (before(bytes_before) + reached) - F.col("size")
    numbered = kept(
        in_ranges(records, splitters)
        .withColumn(
            "shard",
            F.least(F.lit(shards - 1), F.floor(middle * shards / (2 * total))).cast("int"),
        )
        .withColumn("slot", before(rows_before) + F.row_number().over(in_order) - 1)
        .drop("__range"),
        "shards",
    )
    firsts = [0] * shards
    for number, first in numbered.groupBy("shard").agg(F.min("slot")).collect():
        firsts[number] = first
    first = F.element_at(F.lit(firsts).cast("array<bigint>"), F.col("shard") + 1)
    return numbered.withColumn("slot", F.col("slot") - first)


def shard_documents(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """The documents with their shard and slot."""
    own = sized(docs.select(F.struct(*docs.columns).alias("__row"), "doc_id", "text"))
    placed = shard(own.drop("text"), shards)
    columns = [F.col("__row").getField(c).alias(c) for c in docs.drop("shard", "slot").columns]
    return placed.select(*columns, "shard", "slot")


def write_shards(placed: DataFrame, path: str) -> None:
    """One folder per shard, rows in the order of their slots within each file."""
    placed.repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot").write.partitionBy(
        "shard"
    ).parquet(path)


def digest(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """Place, size and checksum of every document."""
    records = kept(
        sized(docs.select("doc_id", "text"))
        .withColumn("text_crc32", F.crc32(F.coalesce("text", F.lit("")).cast("binary")))
        .drop("text"),
        "shard-records",
    )
    return shard(records, shards).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )
