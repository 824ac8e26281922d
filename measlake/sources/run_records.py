"""Run metadata, sample identity and instrument logs from Parquet."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StringType, StructField, StructType

from ..functions import names
from ..operators import preference
from ..operators.rows import once
from .files import metadata_path


def _fields(**types) -> StructType:
    return StructType([StructField(name, dtype, True) for name, dtype in types.items()])


# Columns of the three record files.
_KEY = {"instrument_id": StringType(), "run_number": LongType(), "run_id": StringType()}
METADATA = _fields(
    **_KEY,
    title=StringType(),
    start_time=StringType(),
    experiment_identifier=StringType(),
    source_path=StringType(),
)
SAMPLE_IDENTITY = _fields(**_KEY)
LOGS = _fields(
    **_KEY,
    log_name=StringType(),
    device_name=StringType(),
    device_id=StringType(),
    time=DoubleType(),
    value=StringType(),
    value_numeric=DoubleType(),
    average_value=DoubleType(),
    min_value=DoubleType(),
    max_value=DoubleType(),
)

# The record of a run whose number is unknown: the folder's first one.
ANY_RUN = "*"


def record_kind(name: Column) -> Column:
    """Which record a Parquet file holds, by its name."""
    low = F.lower(name)
    return (
        F.when(low.contains("metadata"), F.lit("metadata"))
        .when(low.contains("sample") & ~low.contains("event"), F.lit("sample"))
        .when(low.contains("daslogs"), F.lit("daslogs"))
    )


def _any_case(word: str) -> str:
    return "".join(f"[{c.lower()}{c.upper()}]" for c in word)


def _read(spark: SparkSession, paths: list[str] | str, kind: str, schema: StructType) -> DataFrame:
    """Rows of one kind of file. A column a file lacks reads as null."""
    files = (
        spark.read.schema(schema)
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", f"*{_any_case(kind)}*.parquet")
        .parquet(*([paths] if isinstance(paths, str) else paths))
    )
    located = files.select("*", F.col("_metadata.file_path").alias("_file"), "_metadata.row_index")
    # Of every row, the path is decoded once and taken apart once.
    path = F.col("file_path")
    located = once(located, F.struct(metadata_path(F.col("_file")).alias("file_path")), "file_path")
    parts = F.struct(names.parent_dir(path).alias("dir"), names.file_name(path).alias("_name"))
    named = once(located, parts, "dir", "_name")
    return named.filter(record_kind(F.col("_name")) == kind).select(
        *schema.names, "dir", "file_path", "row_index"
    )


def read_metadata(spark: SparkSession, paths: list[str] | str) -> DataFrame:
    return _read(spark, paths, "metadata", METADATA)


def read_sample_identity(spark: SparkSession, paths: list[str] | str) -> DataFrame:
    return _read(spark, paths, "sample", SAMPLE_IDENTITY)


def read_logs(spark: SparkSession, paths: list[str] | str) -> DataFrame:
    return _read(spark, paths, "daslogs", LOGS)


def scope(run_number: Column) -> Column:
    """Join key of a run inside its folder."""
    return F.coalesce(run_number.cast("string"), F.lit(ANY_RUN))


def _in_scopes(of_runs: DataFrame, of_folders: DataFrame) -> DataFrame:
    """Rows of runs and of whole folders under a common ``scope``."""
    values = [c for c in of_folders.columns if c != "dir"]
    return (
        of_runs.filter(F.col("run_number").isNotNull())
        .select("dir", scope(F.col("run_number")).alias("scope"), *values)
        .unionByName(of_folders.select("dir", F.lit(ANY_RUN).alias("scope"), *values))
    )


def record_of_run(records: DataFrame, as_name: str) -> DataFrame:
    """First record per folder and run, as one struct column.

    A folder's own first record, for runs without a number, is taken from the
    first records of its runs, not from all rows again.
    """
    position = ("file_path", "row_index")
    values = F.struct(*[c for c in records.columns if c not in ("dir", *position)])
    first = F.min(F.struct(*position, values.alias("record"))).alias("first")
    of_runs = records.groupBy("dir", "run_number").agg(first)
    of_folders = of_runs.groupBy("dir").agg(F.min("first").alias("first"))
    return _in_scopes(of_runs, of_folders).select(
        "dir", "scope", F.col("first.record").alias(as_name)
    )


def logs_of_run(logs: DataFrame, names: list[str]) -> DataFrame:
    """Values of the named logs per folder and run, as a map."""
    of_runs = preference.first_logs(logs, ["dir", "run_number"], names, ["file_path", "row_index"])
    of_folders = preference.merge_firsts(of_runs, ["dir"], names)
    return preference.as_values(_in_scopes(of_runs, of_folders), ["dir", "scope"], names)


def log_counts(logs: DataFrame) -> DataFrame:
    """Number of distinct log names per folder and run, and per folder."""
    named = logs.where("log_name IS NOT NULL").select("dir", "run_number", "log_name").distinct()
    count = F.count(F.lit(1)).alias("log_count")
    of_runs = named.groupBy("dir", "run_number").agg(count)
    of_folders = named.select("dir", "log_name").distinct().groupBy("dir").agg(count)
    return _in_scopes(of_runs, of_folders)
