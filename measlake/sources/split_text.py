"""Curve files of any size, read by lines in splits.

``reduced_text.read`` takes a file as one cell. Here a file is as many tasks as it
has splits: a line is known by the split it begins in and its place there, so
nothing has to see a whole file. A line carries a byte order mark only if Spark's reader
leaves one; otherwise both readers find the same fields and points.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.text import strip
from ..session import scratch_path
from . import reduced_text
from .files import metadata_path

POINT = ("q", "r", "dr", "dq")


def read_lines(spark: SparkSession, paths: list[str] | str, glob: str | None = None) -> DataFrame:
    """Stripped lines: ``path``, ``split`` (its first byte), ``row`` (rising within it), ``line``."""
    texts = spark.read.text(paths, recursiveFileLookup=True, pathGlobFilter=glob)
    # A split is read from its start to its end by one task, so that the ids of
    # its lines rise, whatever else the task reads.
    return texts.select(
        metadata_path(F.col("_metadata.file_path")).alias("path"),
        F.col("_metadata.file_block_start").alias("split"),
        F.monotonically_increasing_id().alias("row"),
        strip(F.col("value")).alias("line"),
    )


def headers(lines: DataFrame) -> DataFrame:
    """One row per file with the fields of its ``#`` lines, wherever these stand."""
    marked = F.when(F.startswith("line", F.lit("#")), F.struct("split", "row", "line"))
    gathered = lines.groupBy("path").agg(F.sort_array(F.collect_list(marked)).alias("marked"))
    in_order = F.transform("marked", lambda m: m["line"])
    return reduced_text.described(gathered.select("path", reduced_text.header_text(in_order).alias("header")))


def points(lines: DataFrame) -> DataFrame:
    """One row per point: ``path``, ``position`` (dense, from 0), q, r, dr, dq.

    The points of a split are numbered among themselves; the numbers of points in
    the splits before come from a running sum with one row per split. Points
    are parsed once and written to the shared folder, which both steps read.
    """
    spark = lines.sparkSession
    found = lines.select(
        "path", "split", "row", F.inline(reduced_text.curve_points(F.array("line")))
    )
    path = scratch_path(spark, "split-points")
    found.write.parquet(path)
    found = spark.read.schema(found.schema).parquet(path)
    before = Window.partitionBy("path").orderBy("split").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        found.groupBy("path", "split")
        .agg(F.count(F.lit(1)).alias("n"))
        .select("path", "split", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    )
    within = Window.partitionBy("path", "split").orderBy("row")
    placed = found.withColumn("place", F.row_number().over(within) - 1)
    return placed.join(offsets, ["path", "split"]).select(
        "path", (F.col("offset") + F.col("place")).alias("position"), *POINT
    )


def read(spark: SparkSession, paths: list[str] | str, glob: str | None = None) -> tuple[DataFrame, DataFrame]:
    """Headers and points of the curve files under the paths."""
    lines = read_lines(spark, paths, glob)
    return headers(lines), points(lines)
