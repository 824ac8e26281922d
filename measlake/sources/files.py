"""Whole-file reads and the file catalog."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import names


def plain_path(path: Column) -> Column:
    """A local path without the ``file:`` scheme; other schemes are kept."""
    return F.regexp_replace(path, "^file:/+", "/")


def metadata_path(path: Column) -> Column:
    """A plain path from the file metadata column, which is percent-encoded."""
    return plain_path(F.url_decode(F.replace(path, F.lit("+"), F.lit("%2B"))))


def read_texts(spark: SparkSession, paths: list[str] | str, glob: str | None = None) -> DataFrame:
    """One row per file: ``path`` and its whole ``content``."""
    texts = spark.read.text(paths, wholetext=True, recursiveFileLookup=True, pathGlobFilter=glob)
    return texts.select(
        metadata_path(F.col("_metadata.file_path")).alias("path"), F.col("value").alias("content")
    )


def catalog(spark: SparkSession, roots: list[str], recursive: bool = True) -> DataFrame:
    """Every file under the search paths: ``path``, ``length``, ``root_ord``.

    Only the listing is read, no file content. Of two search paths that hold
    the same file the earlier one counts. Spark leaves empty files out.
    """
    parts = []
    for ordinal, root in enumerate(roots):
        listed = (
            spark.read.format("binaryFile")
            .option("recursiveFileLookup", recursive)
            .load(root if recursive else f"{root.rstrip('/')}/*")
        )
        parts.append(
            listed.select(
                plain_path(F.col("path")).alias("path"),
                "length",
                F.lit(ordinal).alias("root_ord"),
            )
        )
    files = parts[0]
    for part in parts[1:]:
        files = files.unionByName(part)
    return files.groupBy("path").agg(
        F.max("length").alias("length"), F.min("root_ord").alias("root_ord")
    )


def with_texts(spark: SparkSession, roots: list[str]) -> DataFrame:
    """Files with the text of those whose kind depends on it (JSON and text).

    Texts are read next to their path, other files are only listed, so nothing
    is joined. ``content`` is null for listed files.
    """
    parts = []
    for ordinal, root in enumerate(roots):
        texts = read_texts(spark, root, glob="*.{[jJ][sS][oO][nN],[tT][xX][tT]}")
        listed = catalog(spark, [root]).filter(
            ~F.lower("path").endswith(".json") & ~F.lower("path").endswith(".txt")
        )
        nothing = F.lit(None).cast("string").alias("content")
        parts += [
            rows.select("path", content, F.lit(ordinal).alias("root_ord"))
            for rows, content in ((texts, F.col("content")), (listed, nothing))
        ]
    files = parts[0]
    for part in parts[1:]:
        files = files.unionByName(part)
    return files


def parquet_dir_of_runs(
    runs: DataFrame, files: DataFrame, base: str, instrument: Column | None = None
) -> DataFrame:
    """Folder that holds a run's Parquet files.

    A folder named after the run comes first, then the base folder itself if
    one of its files carries the number. ``runs`` has ``run_number``; the
    result adds ``parquet_dir``. Numbers are taken from the names once, so the
    lookup is an equi-join.
    """
    base = base.rstrip("/")
    parquet = files.filter(F.lower(F.col("path")).endswith(".parquet")).select(
        names.parent_dir(F.col("path")).alias("dir"), names.file_name(F.col("path")).alias("name")
    )
    in_folder = parquet.filter(names.parent_dir(F.col("dir")) == base).select(
        F.lit(0).alias("rank"), "dir", names.file_name(F.col("dir")).alias("label")
    )
    in_base = parquet.filter(F.col("dir") == base).select(
        F.lit(1).alias("rank"), "dir", F.regexp_replace("name", r"\.[^.]*$", "").alias("label")
    )
    # A run number occurs in a label when it is one of the label's digit
    # windows, so every window becomes a key.
    digits = F.regexp_extract_all("label", F.lit(r"(\d+)"), F.lit(1))
    windows = F.flatten(
        F.transform(
            digits,
            lambda d: F.flatten(
                F.transform(
                    F.sequence(F.lit(1), F.length(d)),
                    lambda a: F.transform(
                        F.sequence(F.lit(1), F.length(d) - a + 1), lambda n: F.substr(d, a, n)
                    ),
                )
            ),
        )
    )
    # Only the numbers asked for are grouped; a short window would gather all folders.
    wanted = runs.select(F.col("run_number").cast("string").alias("run_text")).distinct()
    found = (
        in_folder.unionByName(in_base)
        .distinct()
        .select("rank", "dir", F.explode(F.array_distinct(windows)).alias("run_text"))
        .join(wanted, "run_text", "left_semi")
        .groupBy("run_text")
        .agg(F.min(F.struct("rank", "dir"))["dir"].alias("parquet_dir"))
    )
    return (
        runs.withColumn("run_text", F.col("run_number").cast("string"))
        .join(found, "run_text", "left")
        .drop("run_text")
    )
