"""Queries over files: composed from the tables, written below the scratch folder, read back."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from measlake.functions import names
from measlake.session import scratch_path
from measlake.sources import files, reduced_text, run_records

from .base import load, query, text

# Spark names its files after this setting of the output format.
NAME = "mapreduce.output.basename"
# Tasks put files in their place, which the driver would do one by one.
IN_TASKS = {"mapreduce.fileoutputcommitter.algorithm.version": "2"}


def dealt(rows: DataFrame) -> DataFrame:
    """Rows by folder over all cores: a file takes some time to write, however short it is."""
    return rows.repartition(rows.sparkSession.sparkContext.defaultParallelism, "set")


def write_curves(spark: SparkSession, sf_dir: str) -> str:
    """A curve file per supplier, in a folder of its own."""
    base = scratch_path(spark, "curve-files")
    n = F.col("s_suppkey")
    content = text(
        "# Experiment IPTS-", F.col("s_nationkey"), " Run ", n + 100000, "\n# Reduction 2.0\n",
        "# Run title: ", F.col("s_name"), "\n# Q [1/Angstrom] R dR dQ\n",
        "0.01 ", n, " 0.1 0.001\n0.02 ", F.round("s_acctbal", 2), " 0.1 0.001\nnot numbers\n0.03 1 0.1 0.001",
    )
    rows = load(spark, sf_dir, "supplier").select(n.alias("set"), content.alias("value"))
    dealt(rows).write.partitionBy("set").options(**{NAME: "REFL_curve", **IN_TASKS}).text(base)
    return base


def folder(path: Column) -> Column:
    """Number of the folder that a file lies in."""
    return F.regexp_extract(path, r"set=(\d+)/", 1).cast("bigint")


_CURVE_FILES_SQL = """
SELECT s_suppkey AS supplier, 'IPTS-' || s_nationkey AS experiment_id, s_suppkey + 100000 AS run_number, s_name AS run_title,
  '2.0' AS reduction_version, 3 AS points, round(s_suppkey + s_acctbal + 1, 2) AS r_sum
FROM supplier
"""


@query("curve_files", _CURVE_FILES_SQL)
def curve_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Curve files read whole: header fields and points of each."""
    found = reduced_text.read(spark, write_curves(spark, sf_dir))
    return found.select(
        folder(F.col("path")).alias("supplier"), "experiment_id", "run_number", "run_title",
        "reduction_version", F.size("q").alias("points"),
        F.round(F.aggregate("r", F.lit(0.0), lambda a, x: a + x), 2).alias("r_sum"),
    )


_CATALOG_SQL = """
SELECT s_suppkey AS supplier, 'reduced' AS file_type, 'IPTS-' || s_nationkey AS proposal, true AS listed FROM supplier
"""


@query("catalog_files", _CATALOG_SQL)
def catalog_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files below a folder, listed, and read where their kind depends on the text."""
    base = write_curves(spark, sf_dir)
    listed = files.catalog(spark, [base]).select("path", (F.col("length") > 0).alias("listed"))
    read = files.with_texts(spark, [base])
    kinds = read.select("path", names.identify(F.col("path"), F.col("content")).alias("i"))
    return kinds.join(listed, "path").select(
        folder(F.col("path")).alias("supplier"), "i.file_type", "i.proposal", "listed"
    )


_RECORD_FILES_SQL = """
WITH o AS (SELECT *, o_custkey % 6 AS folder FROM orders),
l AS (SELECT l_orderkey, max(l_quantity) FILTER (l_linenumber = 1) AS sample_temp, max(l_quantity) FILTER (l_linenumber = 2) AS temp
  FROM lineitem GROUP BY 1)
SELECT o_orderkey, 'run of ' || o_custkey AS title, CASE WHEN folder % 2 = 0 THEN '/raw/' || o_orderkey END AS source_path,
  o_totalprice > 100000 AS has_sample, sample_temp, temp
FROM o LEFT JOIN l ON l_orderkey = o_orderkey
"""


@query("record_files", _RECORD_FILES_SQL)
def record_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Metadata, sample identities and logs of runs from Parquet folders.

    Every folder has files of all three kinds; half of the metadata files lack a
    column.
    """
    base = scratch_path(spark, "record-files")
    orders = load(spark, sf_dir, "orders")
    key, number = F.col("o_orderkey"), F.col("o_custkey") % 6
    keys = [
        number.alias("set"), F.lit("REF_L").alias("instrument_id"), key.alias("run_number"),
        key.cast("string").alias("run_id"),
    ]
    metadata = orders.select(
        *keys,
        text("run of ", F.col("o_custkey")).alias("title"),
        text(F.date_format("o_orderdate", "yyyy-MM-dd"), "T01:02:03Z").alias("start_time"),
        F.lit("IPTS-1").alias("experiment_identifier"),
        text("/raw/", key).alias("source_path"),
    )
    sensor = F.when(F.col("l_linenumber") == 1, F.lit("SampleTemp")).when(
        F.col("l_linenumber") == 2, F.lit("Temp")
    )
    keys_of_logs = ("set", "instrument_id", "run_number", "run_id")
    logs = (
        load(spark, sf_dir, "lineitem")
        .join(orders.select(*keys), F.col("l_orderkey") == F.col("run_number"))
        .groupBy(*keys_of_logs, F.coalesce(sensor, F.lit("Other")).alias("log_name"))
        .agg(F.max("l_quantity").alias("average_value"))
    )

    def write(df: DataFrame, name: str) -> None:
        df.write.mode("append").partitionBy("set").option(NAME, name).parquet(base)

    write(metadata.filter(F.col("set") % 2 == 0), "run_metadata")
    write(metadata.filter(F.col("set") % 2 == 1).drop("source_path"), "run_Metadata")
    write(orders.filter("o_totalprice > 100000").select(*keys), "run_sample")
    write(logs, "run_daslogs")

    records = run_records.record_of_run(run_records.read_metadata(spark, base), "meta")
    samples = run_records.record_of_run(run_records.read_sample_identity(spark, base), "sample")
    values = run_records.logs_of_run(run_records.read_logs(spark, base), ["SampleTemp", "Temp"])
    whole = records.join(samples, ["dir", "scope"], "left").join(values, ["dir", "scope"], "left")
    return whole.filter(F.col("scope") != run_records.ANY_RUN).select(
        F.col("meta.run_number").alias("o_orderkey"), "meta.title", "meta.source_path",
        F.col("sample").isNotNull().alias("has_sample"),
        F.col("log_values")["SampleTemp"].alias("sample_temp"),
        F.col("log_values")["Temp"].alias("temp"),
    )
