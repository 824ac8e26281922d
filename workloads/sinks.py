"""Writing and reading tables back, and export rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from measlake.session import scratch_path
from measlake.sinks import export, json_mirror, tables

from .base import load, query, text

_PARQUET_SQL = """
SELECT CAST(o_orderkey AS VARCHAR) AS id, o_orderpriority AS facility, 'IPTS-' || o_custkey AS proposal_number,
  CAST(year(o_orderdate) AS INTEGER) AS start_year, epoch_us(o_orderdate) AS start_us,
  CAST(NULL AS VARCHAR) AS instrument_name, o_totalprice AS first_q, CAST(2 AS BIGINT) AS points
FROM orders
"""


def order_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders in the shape of run records, with a column that is not declared."""
    orders = load(spark, sf_dir, "orders")
    return orders.select(
        F.col("o_orderkey").alias("id"),
        F.col("o_orderpriority").alias("facility"),
        text("IPTS-", F.col("o_custkey")).alias("proposal_number"),
        F.lit("neutron REFLECTIVITY").alias("technique"),
        F.col("o_orderstatus").alias("instrument"),
        F.col("o_orderkey").cast("string").alias("run_number"),
        F.col("o_orderdate").cast("timestamp").alias("run_start"),
        (F.col("o_orderdate") + F.expr("INTERVAL '0.000250' SECOND")).cast("timestamp").alias("reduction_time"),
        F.array(F.col("o_totalprice"), F.lit(1.0)).alias("q"),
        F.lit(None).cast("string").alias("measurement_geometry"),
    )


@query("partitioned_roundtrip", _PARQUET_SQL)
def partitioned_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Run records written by facility and year, then read back."""
    base = scratch_path(spark, "runs")
    tables.write_table(order_runs(spark, sf_dir), base)
    back = tables.read_table(spark, base, "reflectivity")
    return back.select(
        "id",
        "facility",
        "proposal_number",
        F.year("run_start").alias("start_year"),
        F.unix_micros("run_start").alias("start_us"),
        "instrument_name",
        F.get("q", F.lit(0)).alias("first_q"),
        F.size("q").cast("bigint").alias("points"),
    )


_JSON_SQL = """
SELECT conv_id || '-' || turn AS id, text AS description, CASE WHEN role = 'user' THEN turn + 0.5::DOUBLE END AS temperature,
  role AS medium, CAST(NULL AS DOUBLE) AS pressure, CAST(2 AS BIGINT) AS members
FROM conversations
"""


@query("json_roundtrip", _JSON_SQL)
def json_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversation turns as environment records, written as JSON and read back."""
    turns = load(spark, sf_dir, "conversations")
    base = scratch_path(spark, "environments")
    rows = turns.select(
        text(F.col("conv_id"), "-", F.col("turn")).alias("id"),
        F.col("text").alias("description"),
        F.struct(F.col("role").alias("name")).alias("ambient_medium"),
        F.when(F.col("role") == "user", F.col("turn") + 0.5).alias("temperature"),
        F.array(F.col("conv_id").cast("string"), F.col("role")).alias("measurement_ids"),
    )
    json_mirror.write_json(rows, base, "environment")
    back = json_mirror.read_json(spark, base, "environment")
    return back.select(
        "id",
        "description",
        "temperature",
        F.col("ambient_medium.name").alias("medium"),
        "pressure",
        F.size("measurement_ids").cast("bigint").alias("members"),
    )


_EXPORT_SQL = """
SELECT CAST(o_orderkey AS VARCHAR) AS run_number, 'IPTS-' || o_custkey AS proposal_number, 'Neutron reflectivity' AS technique,
  strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S') || '+00:00' AS run_start,
  strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S') || '.000250+00:00' AS reduction_time,
  o_totalprice + 1 AS q_sum, o_orderstatus AS instrument
FROM orders
"""


@query("export_payload", _EXPORT_SQL)
def export_payload(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Run records shaped for a document store."""
    runs = order_runs(spark, sf_dir).withColumnRenamed("instrument", "instrument_name")
    payload = export.reflectivity_payload(tables.conform(runs, "reflectivity"))
    return payload.select(
        "run_number",
        "proposal_number",
        "technique",
        "run_start",
        "reduction_time",
        F.aggregate("q_1_angstrom", F.lit(0.0), lambda a, x: a + x).alias("q_sum"),
        "instrument",
    )


_ENVIRONMENT_PAYLOAD_SQL = """
SELECT 'cell ' || c_custkey AS description, c_acctbal AS temperature, CAST(o_orderkey AS VARCHAR) AS run, CAST(1 AS BIGINT) AS runs
FROM orders JOIN customer ON c_custkey = o_custkey WHERE c_nationkey <> 3
"""


@query("environment_payload", _ENVIRONMENT_PAYLOAD_SQL)
def environment_payload(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Environments of customers, a document for every order measured under them."""
    environments = load(spark, sf_dir, "customer").filter("c_nationkey <> 3").select(
        F.col("c_custkey").cast("string").alias("id"),
        text("cell ", F.col("c_custkey")).alias("description"),
        F.col("c_acctbal").alias("temperature"),
    )
    runs = load(spark, sf_dir, "orders").select(
        F.col("o_orderkey").cast("string").alias("id"),
        F.col("o_custkey").cast("string").alias("environment_id"),
    )
    found = export.environment_payload(runs, tables.conform(environments, "environment"))
    return found.select(
        "description", "temperature", F.get("measurements_ids", F.lit(0)).alias("run"),
        F.size("measurements_ids").cast("bigint").alias("runs"),
    )


_SAMPLE_PAYLOAD_SQL = """
WITH s AS (SELECT c_custkey, c_mktsegment, CASE WHEN c_nationkey <> 3 THEN [CAST(c_nationkey AS VARCHAR), 'e' || c_custkey] ELSE [NULL] END AS envs FROM customer)
SELECT 'film ' || c_custkey AS description, c_mktsegment AS main_composition, unnest(envs) AS environment FROM s
"""


@query("sample_payload", _SAMPLE_PAYLOAD_SQL)
def sample_payload(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Samples of customers, a document for every environment, and one for those without any."""
    n, nation = F.col("c_custkey"), F.col("c_nationkey")
    both = F.array(nation.cast("string"), text("e", n))
    samples = load(spark, sf_dir, "customer").select(
        n.cast("string").alias("id"),
        text("film ", n).alias("description"),
        F.col("c_mktsegment").alias("main_composition"),
        F.when(nation != 3, both).otherwise(F.array().cast("array<string>")).alias("environment_ids"),
    )
    found = export.sample_payload(tables.conform(samples, "sample"))
    return found.select(
        "description", "main_composition", F.get("environment_ids", F.lit(0)).alias("environment")
    )
