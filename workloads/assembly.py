"""Whole plans: measurements, manifests and run directories to linked tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from measlake import store
from measlake.plans.assemble import assemble, assemble_manifests
from measlake.plans.batch import Batch
from measlake.plans.sources import source_summary
from measlake.plans.workflow import assemble_run_dirs
from measlake.session import scratch_path
from measlake.sinks import ingests, tables
from measlake.sources import fit_model, manifest, reduced_text, run_dirs

from .base import INGEST, composed, dealt, ingest_time, load, query, sql_id, text
from .curves import curve_texts

OPTIONS = {"ingest_id": INGEST}


def joined(name: str) -> Column:
    return F.array_join(name, ",").alias(name)


# --- measurements (L1) --------------------------------------------------------

RECORDS = "/records"


def model_texts(orders: DataFrame) -> DataFrame:
    """A model per order with up to four experiments; one of them fits its curve."""
    count = F.substring("o_orderpriority", 1, 1).cast("int")
    fitting = F.col("o_custkey") % count

    def experiment(i: Column) -> Column:
        level = F.when(i == fitting, F.lit("1.5")).otherwise(F.lit("9"))
        return text(
            '{"sample": {"layers": [{"name": "air", "thickness": 0, "material": {"name": "air"}}, ',
            '{"name": "f', i, '", "thickness": ', F.col("o_custkey") + i + 1, ', "material": {"name": "M', i, '"}}, ',
            '{"name": "Si", "thickness": ', F.col("o_custkey") % 2, ', "material": {"name": "Si"}}]}, ',
            '"probe": {"Q": {"values": [0.05, 0.3]}, "R": {"values": [', level, ", ", level, "]}}}",
        )

    models = F.array_join(F.transform(F.sequence(F.lit(0), count - 1), experiment), ", ")
    content = text('{"libraries": {"bumps": {"version": "1"}}, "object": {"models": [', models, "]}}")
    return composed(
        orders.filter("o_orderpriority != '5-LOW'"),
        text("/m/", F.col("o_orderkey"), ".json").alias("path"),
        content.alias("content"),
        F.lit(None).cast("string").alias("error_content"),
    )


def order_measurements(orders: DataFrame) -> DataFrame:
    """One measurement per order. Open orders have no records."""
    status, customer = F.col("o_orderstatus"), F.col("o_custkey")
    return composed(
        orders,
        F.col("o_orderkey").cast("string").alias("job"),
        text("/IPTS-", customer, "/curves/REFL_", F.col("o_orderkey"), ".txt").alias("reduced"),
        F.when(status != "O", F.lit(f"{RECORDS}/")).alias("parquet"),
        F.when(
            F.col("o_orderpriority") != "5-LOW", text("/m/", F.col("o_orderkey"), ".json")
        ).alias("model"),
        F.when((status == "O") & (customer % 2 == 0), text("cell ", customer)).alias("environment"),
        F.when(customer % 4 == 0, text("/nx/", F.col("o_orderkey"))).alias("nexus_file"),
    )


def order_metadata(orders: DataFrame) -> DataFrame:
    """Metadata records of finished orders."""
    key, customer = F.col("o_orderkey"), F.col("o_custkey")
    return orders.filter("o_orderstatus = 'F'").select(
        F.when(customer % 2 == 0, F.lit("REF_L")).otherwise(F.lit("BL-x")).alias("instrument_id"),
        key.alias("run_number"),
        key.cast("string").alias("run_id"),
        F.when(customer % 3 == 0, F.lit("")).otherwise(text("run of ", customer)).alias("title"),
        text(F.date_format("o_orderdate", "yyyy-MM-dd"), "T01:02:03Z").alias("start_time"),
        text("IPTS-9", customer).alias("experiment_identifier"),
        text("/raw/", key).alias("source_path"),
        F.lit(RECORDS).alias("dir"),
        F.lit("metadata.parquet").alias("file_path"),
        key.alias("row_index"),
    )


def order_logs(items: DataFrame) -> DataFrame:
    """Log records of runs: line 1 to 3 are sensors the instruments know."""
    line, quantity = F.col("l_linenumber"), F.col("l_quantity")
    name = (
        F.when(line == 1, F.lit("SampleTemp"))
        .when(line == 2, F.lit("Temp"))
        .when(line == 3, F.lit("Pressure"))
        .otherwise(F.lit("Other"))
    )
    return items.select(
        F.col("l_orderkey").alias("run_number"),
        name.alias("log_name"),
        F.when(F.col("l_tax") > 0, F.when(quantity > 10, quantity).otherwise(F.lit(0.0))).alias("average_value"),
        F.col("l_discount").alias("value_numeric"),
        F.lit(RECORDS).alias("dir"),
        F.lit("daslogs.parquet").alias("file_path"),
        (F.col("l_partkey") * 1_000_000 + F.col("l_suppkey")).alias("row_index"),
    )


def measurement_batch(spark: SparkSession, sf_dir: str) -> Batch:
    orders = load(spark, sf_dir, "orders")
    items = load(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_discount", "l_tax"
    )
    wide = dealt(orders)
    return assemble(
        manifest.single_jobs(order_measurements(orders)),
        reduced_text.parse(curve_texts(wide).drop("o_orderkey")),
        fit_model.parse(model_texts(wide)),
        order_metadata(orders),
        order_logs(items),
        ingest_time=ingest_time(),
        **OPTIONS,
    )


_L1 = f"""
logs AS (
  SELECT l_orderkey AS k, l_linenumber AS line, CASE WHEN l_tax > 0 THEN CASE WHEN l_quantity > 10 THEN l_quantity ELSE 0 END ELSE l_discount END AS v,
    row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_partkey * 1000000 + l_suppkey) AS n
  FROM lineitem WHERE l_linenumber <= 3),
env AS (SELECT k, max(v) FILTER (line = 1) AS st, max(v) FILTER (line = 2) AS te, max(v) FILTER (line = 3) AS pr FROM logs WHERE n = 1 GROUP BY k),
m AS (
  SELECT o.*, o_orderpriority <> '5-LOW' AS has_model, CAST(o_orderpriority[1:1] AS BIGINT) AS n,
    '/IPTS-' || o_custkey || '/curves/REFL_' || o_orderkey || '.txt' AS reduced,
    o_orderstatus <> 'O' OR o_custkey % 2 = 0 AS has_env, o_orderstatus = 'F' AND o_custkey % 2 = 0 AS special
  FROM orders o),
ids AS (
  SELECT *, CASE WHEN n > 1 THEN o_custkey % n END AS idx, coalesce(CASE WHEN n > 1 THEN o_custkey % n END, 0) AS layer_set,
    {sql_id('run', 'o_orderkey', 'reduced', '0')} AS run_id,
    CASE WHEN has_env THEN {sql_id('environment', 'o_orderkey', '0')} END AS env_id,
    CASE WHEN has_model THEN {sql_id('sample', 'o_orderkey', '0')} END AS sample_id,
    CASE WHEN has_model THEN {sql_id('fit', 'o_orderkey', '0')} END AS fit_id
  FROM m)"""

_L1_RUNS = f"""
WITH {_L1}
SELECT run_id AS id, sample_id, env_id AS environment_id,
  CASE o_orderstatus WHEN 'F' THEN 'IPTS-9' || o_custkey ELSE 'IPTS-' || (o_custkey + 1) END AS proposal_number,
  CASE o_orderstatus WHEN 'F' THEN CAST(o_orderkey AS VARCHAR) ELSE CAST(o_orderkey + 7 AS VARCHAR) END AS run_number,
  CASE WHEN o_orderstatus = 'F' AND o_custkey % 3 <> 0 THEN 'run of ' || o_custkey
       WHEN o_orderstatus = 'P' THEN o_orderpriority ELSE 'title ' || o_orderpriority END AS run_title,
  epoch_us(o_orderdate) + CASE o_orderstatus WHEN 'F' THEN 3723000000 ELSE 244352 END AS start_us,
  CASE WHEN o_custkey % 4 = 0 THEN '/nx/' || o_orderkey WHEN o_orderstatus = 'F' THEN '/raw/' || o_orderkey END AS raw_file_path,
  CASE WHEN o_orderstatus <> 'F' OR o_custkey % 2 = 0 THEN 'REF_L' ELSE 'BL-x' END AS instrument_name,
  CASE WHEN o_orderstatus <> 'F' OR o_custkey % 2 = 0 THEN 'Specular neutron reflectometry' END AS technique_description,
  CASE WHEN has_model THEN 'back reflection' END AS measurement_geometry, CAST(2 AS BIGINT) AS points
FROM ids
"""


@query("measurement_runs", _L1_RUNS)
def measurement_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Run records of one measurement per order."""
    return measurement_batch(spark, sf_dir).reflectivity.select(
        "id", "sample_id", "environment_id", "proposal_number", "run_number", "run_title",
        F.unix_micros("run_start").alias("start_us"), "raw_file_path", "instrument_name",
        "technique_description", "measurement_geometry", F.size("q").cast("bigint").alias("points"),
    )


_L1_ENVS = f"""
WITH {_L1}
SELECT env_id AS id, CASE WHEN o_orderstatus = 'O' THEN 'cell ' || o_custkey ELSE 'Sample cell' END AS description,
  CASE WHEN has_model THEN 'air' END AS ambient,
  CASE WHEN o_orderstatus = 'O' THEN NULL WHEN special THEN nullif(st, 0) ELSE coalesce(st, te) END AS temperature,
  CASE WHEN o_orderstatus = 'O' OR special THEN NULL ELSE pr END AS pressure, run_id AS measurement_ids
FROM ids LEFT JOIN env ON env.k = o_orderkey WHERE has_env
"""


@query("measurement_environments", _L1_ENVS)
def measurement_environments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Environment records with temperature and pressure from the logs."""
    return measurement_batch(spark, sf_dir).environment.select(
        "id", "description", F.col("ambient_medium.name").alias("ambient"), "temperature",
        "pressure", joined("measurement_ids"),
    )


_L1_SAMPLES = f"""
WITH {_L1}
SELECT sample_id AS id, 'M' || layer_set || ' in air' || CASE WHEN o_custkey % 2 = 0 THEN ' on Si' ELSE '' END AS description,
  'M' || layer_set AS main_composition, coalesce(env_id, '') AS environment_ids, fit_id AS fit_ids,
  CAST(3 - CASE WHEN o_custkey % 2 = 0 THEN 1 ELSE 0 END AS BIGINT) AS layers
FROM ids WHERE has_model
"""


@query("measurement_samples", _L1_SAMPLES)
def measurement_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sample records from the dataset each curve matches."""
    return measurement_batch(spark, sf_dir).sample.select(
        "id", "description", "main_composition", joined("environment_ids"), joined("fit_ids"),
        F.size("layers").cast("bigint").alias("layers"),
    )


_L1_FITS = f"""
WITH {_L1}
SELECT fit_id AS id, run_id AS measurement_ids, sample_id, sample_id AS sample_ids,
  CASE WHEN n <= 1 THEN 'single' ELSE 'single_state_coref' END AS fit_strategy, CAST(n AS INTEGER) AS num_experiments,
  CAST(idx AS INTEGER) AS dataset_index, 'f' || layer_set AS film, 'bumps' AS software, 'unknown' AS schema_version
FROM ids WHERE has_model
"""


@query("measurement_fits", _L1_FITS)
def measurement_fits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fit records with the dataset found by curve matching."""
    return measurement_batch(spark, sf_dir).reflectivity_model.select(
        "id", joined("measurement_ids"), "sample_id", joined("sample_ids"), "fit_strategy",
        "num_experiments", "dataset_index", F.get("layers", F.lit(1))["name"].alias("film"),
        "software", "schema_version",
    )


_L1_ISSUES = f"""
WITH {_L1},
e AS (SELECT *, CASE WHEN special THEN nullif(st, 0) ELSE coalesce(st, te) END AS t FROM ids LEFT JOIN env ON env.k = o_orderkey)
SELECT severity, message, count(*) AS n FROM (
  SELECT 'warning' AS severity, 'Dataset ' || (idx + 1) || ' of ' || n || ' is taken, the best match of the curve' AS message FROM e WHERE has_model AND n > 1
  UNION ALL SELECT 'warning', 'A curve of only 2 points' FROM e
  UNION ALL SELECT 'review', 'No model, so no geometry' FROM e WHERE NOT has_model
  UNION ALL SELECT 'review', 'No temperature in the logs (sensors of ' || CASE WHEN special THEN 'REF_L' ELSE 'GENERIC' END || ')'
    FROM e WHERE o_orderstatus <> 'O' AND t IS NULL)
GROUP BY ALL
"""


@query("measurement_issues", _L1_ISSUES)
def measurement_issues(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Warnings and review flags of all measurements, counted."""
    found = measurement_batch(spark, sf_dir).issues
    return found.groupBy("severity", "message").agg(F.count(F.lit(1)).alias("n"))


_L1_SUMMARY = f"""
WITH {_L1}
SELECT CASE o_orderstatus WHEN 'F' THEN CAST(o_orderkey AS VARCHAR) ELSE CAST(o_orderkey + 7 AS VARCHAR) END AS run_number,
  run_id AS id, CAST(2 AS BIGINT) AS num_points, 0.1::DOUBLE AS q_min, 0.2::DOUBLE AS q_max,
  CASE WHEN has_model THEN 'M' || layer_set END AS main_composition,
  CASE WHEN has_model THEN CAST(3 - CASE WHEN o_custkey % 2 = 0 THEN 1 ELSE 0 END AS BIGINT) END AS sample_layers,
  CASE WHEN NOT has_env THEN NULL WHEN o_orderstatus = 'O' THEN 'cell ' || o_custkey ELSE 'Sample cell' END AS environment,
  CASE WHEN o_orderstatus = 'O' THEN NULL WHEN special THEN nullif(st, 0) ELSE coalesce(st, te) END AS temperature,
  CASE WHEN has_model THEN 'bumps' END AS software, CASE WHEN has_model THEN CAST(n AS INTEGER) END AS num_experiments
FROM ids LEFT JOIN env ON env.k = o_orderkey
"""


@query("measurement_summary", _L1_SUMMARY)
def measurement_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Summary of every run over the four tables, written first and read back."""
    base = scratch_path(spark, "measurements")
    tables.write_batch(measurement_batch(spark, sf_dir), base)
    names = ("reflectivity", "sample", "environment", "fit")
    found = store.summary(*[tables.read_table(spark, base, name) for name in names])
    return found.select(
        "run_number", "id", F.col("num_points").cast("bigint").alias("num_points"), "q_min", "q_max",
        "main_composition", F.col("sample_layers").cast("bigint").alias("sample_layers"),
        "environment", "temperature", "software", "num_experiments",
    )


_WARNINGS_SQL = f"""
WITH {_L1},
w AS (
  SELECT o_orderkey, 0 AS position, 'Dataset ' || (idx + 1) || ' of ' || n || ' is taken, the best match of the curve' AS message FROM ids WHERE has_model AND n > 1
  UNION ALL SELECT o_orderkey, 1, 'A curve of only 2 points' FROM ids)
SELECT CAST(o_orderkey AS VARCHAR) AS job, row_number() OVER (PARTITION BY o_orderkey ORDER BY position) - 1 AS position, message,
  count(*) OVER (PARTITION BY o_orderkey) AS warnings FROM w
"""


@query("shown_warnings", _WARNINGS_SQL)
def shown_warnings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every warning of every measurement in order, with their number, from the written issues."""
    path = scratch_path(spark, "issues")
    issues = measurement_batch(spark, sf_dir).issues
    issues.write.parquet(path)
    found = store.shown_warnings(spark.read.schema(issues.schema).parquet(path), ["job"])
    return found.select("job", F.col("position").cast("bigint").alias("position"), "message", "warnings")


_SOURCES_SQL = """
WITH l AS (SELECT l_orderkey AS k, count(DISTINCT least(l_linenumber, 4)) AS n FROM lineitem GROUP BY 1)
SELECT CAST(o_orderkey AS VARCHAR) AS job, true AS has_curve, o_orderstatus = 'F' AS has_metadata, o_orderstatus = 'P' AS has_sample,
  CASE WHEN o_orderstatus = 'O' THEN 0 ELSE coalesce(n, 0) END AS log_count, o_orderpriority <> '5-LOW' AS has_model,
  CASE WHEN o_orderpriority <> '5-LOW' THEN 3 ELSE 0 END AS layer_count,
  CASE WHEN o_orderpriority <> '5-LOW' THEN CAST(o_custkey + 1 + o_custkey % 2 AS DOUBLE) END AS total_thickness
FROM orders LEFT JOIN l ON k = o_orderkey
"""


@query("measurement_sources", _SOURCES_SQL)
def measurement_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What went into the measurement of every order."""
    orders = load(spark, sf_dir, "orders")
    items = load(spark, sf_dir, "lineitem")
    key = F.col("o_orderkey")
    samples = orders.filter("o_orderstatus = 'P'").select(
        F.lit("REF_L").alias("instrument_id"), key.alias("run_number"), key.cast("string").alias("run_id"),
        F.lit(RECORDS).alias("dir"), F.lit("sample.parquet").alias("file_path"), key.alias("row_index"),
    )
    found = source_summary(
        manifest.single_jobs(order_measurements(orders)),
        reduced_text.parse(curve_texts(orders).drop("o_orderkey")),
        fit_model.parse(model_texts(orders)),
        order_metadata(orders),
        order_logs(items),
        samples,
    )
    return found.select(
        "job", "has_curve", "has_metadata", "has_sample", "log_count", "has_model", "layer_count",
        "total_thickness",
    )


# --- manifests (L4) -----------------------------------------------------------


def customer_curves(customers: DataFrame) -> DataFrame:
    """Three curve files per customer, at three levels."""
    each = customers.select("c_custkey", "c_nationkey", F.explode(F.array(*map(F.lit, (1, 2, 3)))).alias("i"))
    level = F.pow(F.lit(10), F.col("i")).cast("int")
    content = text(
        "# Experiment IPTS-", F.col("c_nationkey"), " Run ", F.col("c_custkey") * 10 + F.col("i"),
        "\n0.1 ", level, " 1 1\n0.2 ", level, " 1 1\n",
    )
    return composed(
        each, text("/c/", F.col("c_custkey"), "_", F.col("i"), ".txt").alias("path"), content.alias("content")
    )


def customer_models(customers: DataFrame) -> DataFrame:
    """A model of two experiments per customer, without probes."""
    content = text(
        '{"object": {"models": [{"sample": {"layers": [{"name": "a", "thickness": 5, "material": {"name": "A"}}]}}, ',
        '{"sample": {"layers": [{"name": "b", "thickness": 6, "material": {"name": "B"}}]}}]}}',
    )
    return composed(
        customers,
        text("/m/", F.col("c_custkey"), ".json").alias("path"),
        content.alias("content"),
        F.lit(None).cast("string").alias("error_content"),
    )


def customer_manifests(customers: DataFrame) -> DataFrame:
    """A manifest of three measurements per customer.

    The segment decides what is odd: no output folder, no model at first, or no
    environment for the last measurement.
    """
    n, segment = F.col("c_custkey"), F.col("c_mktsegment")
    model = text('"model": "/m/', n, '.json", "model_dataset_index": 2')
    of_sample = F.when(segment == "BUILDING", F.lit("")).otherwise(text(", ", model))
    last = F.when(segment == "FURNITURE", F.lit("")).otherwise(F.lit(', "environment": "late"'))
    content = text(
        '{"output": "', F.when(segment == "MACHINERY", F.lit("")).otherwise(F.lit("/out")),
        '", "sample": {"description": "', F.when(F.col("c_acctbal") > 0, text("film ", n)).otherwise(F.lit("")), '"', of_sample,
        '}, "measurements": [{"name": "x", "reduced": "/c/', n, '_1.txt", "environment": "early"}, ',
        '{"reduced": "/c/', n, '_2.txt", ', model, "}, ",
        '{"reduced": "/c/', n, '_3.txt", "model": "/m/', n, '.json", "model_dataset_index": 1', last, "}]}",
    )
    return composed(customers, n.cast("string").alias("path"), content.alias("content"))


def manifest_batch(spark: SparkSession, sf_dir: str) -> Batch:
    customers = load(spark, sf_dir, "customer")
    curves = customer_curves(customers)
    models = customer_models(customers)
    existing = curves.select("path").unionByName(models.select("path"))
    return assemble_manifests(
        manifest.parse(customer_manifests(customers)),
        reduced_text.parse(curves),
        fit_model.parse(models),
        existing=existing,
        ingest_time=ingest_time(),
        **OPTIONS,
    )


_L4 = f"""
b AS (
  SELECT c_custkey AS c, c_nationkey, c_acctbal, c_mktsegment AS seg, p.pos AS pos, '/c/' || c_custkey || '_' || (p.pos + 1) || '.txt' AS reduced,
    c_mktsegment = 'BUILDING' AS late_model, c_mktsegment <> 'BUILDING' OR p.pos > 0 AS has_model,
    p.pos = 0 OR (p.pos = 2 AND c_mktsegment <> 'FURNITURE') AS has_env, CASE WHEN p.pos = 2 THEN 0 ELSE 1 END AS idx
  FROM customer, (VALUES (0), (1), (2)) AS p(pos) WHERE c_mktsegment <> 'MACHINERY'),
ids AS (
  SELECT *, {sql_id('run', 'c', 'reduced', 'pos')} AS run_id,
    CASE WHEN has_env THEN {sql_id('environment', 'c', 'pos')} END AS env_id,
    CASE WHEN has_model THEN {sql_id('fit', 'c', 'pos')} END AS fit_id,
    CASE WHEN NOT late_model THEN {sql_id('sample', 'c', '0')} WHEN has_model THEN {sql_id('sample', 'c', 'pos')} END AS sample_id
  FROM b)"""

_L4_RUNS = f"""
WITH {_L4}
SELECT run_id AS id, sample_id, env_id AS environment_id, CAST(c * 10 + pos + 1 AS VARCHAR) AS run_number,
  'IPTS-' || c_nationkey AS proposal_number, CASE WHEN has_model THEN 'front reflection' END AS measurement_geometry FROM ids
"""


@query("manifest_runs", _L4_RUNS)
def manifest_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Run records of all manifests."""
    return manifest_batch(spark, sf_dir).reflectivity.select(
        "id", "sample_id", "environment_id", "run_number", "proposal_number", "measurement_geometry"
    )


_L4_SAMPLES = f"""
WITH {_L4}
SELECT sample_id AS id,
  CASE WHEN NOT late_model AND max(c_acctbal) > 0 THEN 'film ' || c
       WHEN late_model AND max(pos) = 2 THEN 'A in air' ELSE 'B in air' END AS description,
  coalesce(string_agg(env_id, ',' ORDER BY pos), '') AS environment_ids, string_agg(fit_id, ',' ORDER BY pos) AS fit_ids
FROM ids WHERE sample_id IS NOT NULL GROUP BY sample_id, late_model, c
"""


@query("manifest_samples", _L4_SAMPLES)
def manifest_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Samples of all manifests, written once with all their environments."""
    return manifest_batch(spark, sf_dir).sample.select(
        "id", "description", joined("environment_ids"), joined("fit_ids")
    )


_L4_ENVS = f"""
WITH {_L4}
SELECT env_id AS id, CASE WHEN pos = 0 THEN 'early' ELSE 'late' END AS description, run_id AS measurement_ids FROM ids WHERE has_env
"""


@query("manifest_environments", _L4_ENVS)
def manifest_environments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Environments of all manifests."""
    return manifest_batch(spark, sf_dir).environment.select("id", "description", joined("measurement_ids"))


_L4_FITS = f"""
WITH {_L4}
SELECT fit_id AS id, sample_id, run_id AS measurement_ids, CAST(idx AS INTEGER) AS dataset_index,
  CASE WHEN idx = 0 THEN 'a' ELSE 'b' END AS layer FROM ids WHERE has_model
"""


@query("manifest_fits", _L4_FITS)
def manifest_fits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fits of all manifests with the chosen dataset."""
    return manifest_batch(spark, sf_dir).reflectivity_model.select(
        "id", "sample_id", joined("measurement_ids"), "dataset_index",
        F.get("layers", F.lit(0))["name"].alias("layer"),
    )


# --- run directories (L2, L3) -------------------------------------------------


def run_dir_texts(customers: DataFrame) -> DataFrame:
    """A run directory per customer: run info, model and final state.

    The segment decides between one state, two states, distinct samples, an own
    sample description and a single file without a model. Nation 3 names a file
    that does not exist.
    """
    n, segment, nation = F.col("c_custkey"), F.col("c_mktsegment"), F.col("c_nationkey")
    third = F.when(nation == 3, F.lit("/c/none.txt")).otherwise(text("/c/", n, "_3.txt"))
    one, two = text("/c/", n, "_1.txt"), text("/c/", n, "_2.txt")

    def entry(path: Column) -> Column:
        return text('{"file": "', path, '", "label": "l"}')

    flag = F.when(segment == "MACHINERY", F.lit(', "distinct_sample": true')).otherwise(F.lit(""))
    own = F.when(segment == "HOUSEHOLD", F.lit(', "sample_description": "other"')).otherwise(F.lit(""))
    info = (
        F.when(segment == "FURNITURE", text('{"data_file": "', third, '"}'))
        .when(
            segment == "BUILDING",
            text('{"sample_description": "stack ', n, '", "data_files": [', entry(one), ', "', two, '", ', entry(third), "]}"),
        )
        .otherwise(
            text(
                '{"sample_description": "stack ', n, '"', flag, ', "states": [{"name": "s0", "extra_description": "OCV, pH ', nation,
                '", "data_files": [', entry(one), ", ", entry(two), ']}, {"name": "s1", "extra_description": "at -1 V in 0.5 M KOH"', own,
                ', "data_files": ["', third, '"]}]}',
            )
        )
    )
    count = F.when(nation % 2 == 0, F.lit(3)).otherwise(F.lit(2))

    def experiment(i: Column) -> Column:
        level = F.pow(F.lit(10), i).cast("int")
        probe = F.when(nation % 4 == 1, F.lit("")).otherwise(
            text(', "probe": {"Q": {"values": [0.3, 0.05]}, "R": {"values": [', level, ", ", level, "]}}")
        )
        return text(
            '{"sample": {"layers": [{"name": "air", "thickness": 0, "material": {"name": "air"}}, {"name": "e', i,
            '", "thickness": {"__class__": "Reference", "id": "t"}, "material": {"name": "E', i, '"}}]}', probe, "}",
        )

    problem = F.when(
        segment != "FURNITURE",
        text(
            '{"references": {"t": {"name": "th", "fixed": false, "value": ', n, '}}, "object": {"models": [',
            F.array_join(F.transform(F.sequence(F.lit(1), count), experiment), ", "), "]}}",
        ),
    )
    state = text(
        '{"final_chi2": ', F.col("c_acctbal"), ', "state": {"states": [{"extra_description": "OCV, pH ', nation, '"}]}}'
    )
    errors = text('{"th": {"std": ', nation, "}}")
    files = F.array(
        *[
            F.struct(text("/w/", n, "/", name).alias("path"), content.alias("content"))
            for name, content in (
                ("run_info.json", info),
                ("problem.json", problem),
                ("final_state.json", state),
                ("refl1d_output/fit/None-err.json", errors),
                ("refl1d_output/fit/second-err.json", F.lit("{}")),
            )
        ]
    )
    return customers.select(F.inline(files)).filter(F.col("content").isNotNull())


def run_dir_batch(spark: SparkSession, sf_dir: str) -> Batch:
    customers = load(spark, sf_dir, "customer")
    return assemble_run_dirs(
        run_dirs.parse(run_dir_texts(customers)),
        reduced_text.parse(customer_curves(customers)),
        ingest_time=ingest_time(),
        **OPTIONS,
    )


_L2 = f"""
base AS (
  SELECT c_custkey AS c, c_nationkey AS nation, c_acctbal, c_mktsegment AS seg, '/w/' || c_custkey AS job,
    c_mktsegment = 'FURNITURE' AS lone, c_mktsegment = 'BUILDING' AS flat, c_mktsegment NOT IN ('FURNITURE', 'BUILDING') AS explicit,
    CASE WHEN c_nationkey % 2 = 0 THEN 3 ELSE 2 END AS n
  FROM customer WHERE c_nationkey <> 3),
runs0 AS (
  SELECT base.*, f.i AS i, CASE WHEN lone THEN 0 ELSE f.i - 1 END AS pos, CASE WHEN explicit AND f.i = 3 THEN 1 ELSE 0 END AS state,
    '/c/' || c || '_' || f.i || '.txt' AS path,
    CASE WHEN lone OR nation % 4 = 1 OR f.i > n THEN NULL ELSE f.i - 1 END AS matched
  FROM base, (VALUES (1), (2), (3)) AS f(i) WHERE NOT lone OR f.i = 3),
runs AS (
  SELECT *, state = 1 AND seg IN ('MACHINERY', 'HOUSEHOLD') AS own,
    {sql_id('run', 'job', 'path', 'pos')} AS run_id, {sql_id('environment', 'job', 'state')} AS env_id,
    {sql_id('sample', 'job', "'shared'")} AS shared_id, {sql_id('sample', 'job', '1')} AS own_id, {sql_id('fit', 'job', '0')} AS fit_id,
    coalesce(matched, CASE WHEN n = 3 THEN pos END, 0) AS dataset
  FROM runs0),
linked AS (SELECT *, CASE WHEN lone THEN NULL WHEN own THEN own_id ELSE shared_id END AS sample_id FROM runs)"""

_L2_RUNS = f"""
WITH {_L2}
SELECT run_id AS id, sample_id, env_id AS environment_id, CAST(c * 10 + i AS VARCHAR) AS run_number,
  CASE WHEN lone THEN NULL ELSE 'back reflection' END AS measurement_geometry FROM linked
"""


@query("workflow_runs", _L2_RUNS)
def workflow_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Run records of all run directories."""
    return run_dir_batch(spark, sf_dir).reflectivity.select(
        "id", "sample_id", "environment_id", "run_number", "measurement_geometry"
    )


_L2_ENVS = f"""
WITH {_L2}
SELECT env_id AS id, string_agg(run_id, ',' ORDER BY pos) AS measurement_ids, CASE WHEN lone THEN NULL ELSE 'air' END AS ambient,
  CASE WHEN state = 0 THEN 'OCV, pH ' || nation ELSE 'at -1 V in 0.5 M KOH' END AS description,
  CASE WHEN state = 0 THEN 'open_circuit' ELSE 'potentiostatic' END AS control_mode,
  CASE WHEN state = 1 THEN -1.0::DOUBLE END AS potential, CASE WHEN state = 0 THEN CAST(nation AS DOUBLE) END AS ph,
  CASE WHEN state = 1 THEN 'KOH' END AS electrolyte
FROM linked GROUP BY env_id, lone, state, nation
"""


@query("workflow_environments", _L2_ENVS)
def workflow_environments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Environments of all run directories, one per state."""
    return run_dir_batch(spark, sf_dir).environment.select(
        "id", joined("measurement_ids"), F.col("ambient_medium.name").alias("ambient"), "description",
        "control_mode", "potential", F.col("pH").alias("ph"), F.col("electrolyte.name").alias("electrolyte"),
    )


_L2_SAMPLES = f"""
WITH {_L2}
SELECT sample_id AS id, CASE WHEN own AND seg = 'HOUSEHOLD' THEN 'other' ELSE 'stack ' || c END AS description,
  array_to_string(list_distinct_ordered, ',') AS environment_ids,
  CASE WHEN own AND seg = 'HOUSEHOLD' THEN NULL ELSE fit_id END AS fit_ids, main_composition
FROM (SELECT sample_id, own, seg, c, fit_id,
        CASE WHEN count(DISTINCT env_id) = 2 THEN [min(env_id) FILTER (state = 0), min(env_id) FILTER (state = 1)] ELSE [min(env_id)] END AS list_distinct_ordered,
        CASE WHEN c = 0 THEN 'Unknown' WHEN flat THEN 'E' || (max(CASE WHEN pos = 0 THEN coalesce(matched, 0) END) + 1) ELSE 'E1' END AS main_composition
      FROM linked WHERE NOT lone GROUP BY sample_id, own, seg, c, fit_id, flat)
"""


@query("workflow_samples", _L2_SAMPLES)
def workflow_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shared and own samples of all run directories."""
    return run_dir_batch(spark, sf_dir).sample.select(
        "id", "description", joined("environment_ids"), joined("fit_ids"), "main_composition"
    )


_L2_FITS = f"""
WITH {_L2}
SELECT fit_id AS id, string_agg(run_id, ',' ORDER BY pos) AS measurement_ids, shared_id AS sample_id,
  CASE WHEN seg = 'MACHINERY' THEN shared_id || ',' || own_id ELSE shared_id END AS sample_ids,
  CASE WHEN flat THEN 'single_state_coref' ELSE 'multi_state_coref' END AS fit_strategy, c_acctbal AS chi_squared,
  string_agg(CAST(dataset AS VARCHAR), ',' ORDER BY pos) AS datasets, CAST(CASE WHEN flat THEN coalesce(max(matched) FILTER (pos = 0), 0) END AS INTEGER) AS dataset_index,
  round(c + nation, 6)::DOUBLE AS film_and_std
FROM linked WHERE NOT lone GROUP BY fit_id, shared_id, own_id, seg, flat, c_acctbal, c, nation
"""


@query("workflow_fits", _L2_FITS)
def workflow_fits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One fit per run directory with the dataset of every run."""
    film = F.get("layers", F.lit(1))
    return run_dir_batch(spark, sf_dir).reflectivity_model.select(
        "id", joined("measurement_ids"), "sample_id", joined("sample_ids"), "fit_strategy", "chi_squared",
        F.array_join(F.col("datasets.dataset_index"), ",").alias("datasets"), "dataset_index",
        F.round(film["thickness"] + film["thickness_std"], 6).alias("film_and_std"),
    )


_L2_ISSUES = f"""
WITH {_L2}
SELECT severity, message, count(*) AS n FROM (
  SELECT 'error' AS severity, CASE WHEN c_mktsegment IN ('FURNITURE', 'BUILDING') THEN 'There is no file that run_info.json names: /c/none.txt'
    ELSE 'State ''s1'': there is no file /c/none.txt' END AS message FROM customer WHERE c_nationkey = 3
  UNION ALL SELECT 'warning', CASE WHEN matched IS NULL THEN 'None of ' || n || ' datasets matches the curve; the first is taken. Give dataset_index to choose.'
    ELSE 'Dataset ' || (matched + 1) || ' of ' || n || ' is taken, the best match of the curve' END FROM linked WHERE flat AND pos = 0
  UNION ALL SELECT 'warning', 'The model names no known software' FROM linked WHERE NOT lone AND pos = 0
  UNION ALL SELECT 'warning', 'Run ' || (c * 10 + i) || ' matches no dataset (' || n || ' datasets, 3 runs); dataset 0 is taken, its parameters may not be the run''s'
    FROM linked WHERE NOT lone AND matched IS NULL AND n <> 3
  UNION ALL SELECT 'review', 'dataset is a guess' FROM linked WHERE flat AND matched IS NULL AND n <> 3
  UNION ALL SELECT 'review', 'No model, so no geometry' FROM linked WHERE lone
  UNION ALL SELECT 'warning', 'A curve of only 2 points' FROM linked)
GROUP BY ALL
"""


@query("workflow_issues", _L2_ISSUES)
def workflow_issues(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Errors, warnings and review flags of all run directories, counted."""
    found = run_dir_batch(spark, sf_dir).issues
    return found.groupBy("severity", "message").agg(F.count(F.lit(1)).alias("n"))


_OUTCOMES_SQL = """
SELECT CASE WHEN c_nationkey = 3 THEN 'failed' ELSE 'ok' END AS status, CASE WHEN c_nationkey = 3 THEN 1 ELSE 0 END AS exit_code, count(*) AS n
FROM customer GROUP BY ALL
"""


@query("workflow_outcomes", _OUTCOMES_SQL)
def workflow_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Audit rows of all run directories, counted by status."""
    found = run_dir_batch(spark, sf_dir).outcomes
    return found.groupBy("status", "exit_code").agg(F.count(F.lit(1)).alias("n"))


_WRITTEN_SQL = f"""
WITH o AS ({_OUTCOMES_SQL}), i AS ({_L2_ISSUES})
SELECT 'outcome' AS kind, status AS label, CAST(n AS BIGINT) AS n FROM o
UNION ALL SELECT 'issue', severity, CAST(sum(n) AS BIGINT) FROM i GROUP BY severity
"""


@query("batch_outcomes", _WRITTEN_SQL)
def batch_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Outcomes and issues of all run directories, counted from the written tables."""
    batch = run_dir_batch(spark, sf_dir)
    paths = tables.write_batch(batch, scratch_path(spark, "lake"))

    def counted(kind: str, name: str, df: DataFrame, label: str) -> DataFrame:
        rows = spark.read.schema(df.schema).parquet(paths[name])
        return rows.groupBy(F.col(label).alias("label")).agg(F.count(F.lit(1)).alias("n")).select(
            F.lit(kind).alias("kind"), "label", "n"
        )

    outcomes = counted("outcome", "outcomes", batch.outcomes, "status")
    return outcomes.unionByName(counted("issue", "issues", batch.issues, "severity"))


def flawed_batch(spark: SparkSession, sf_dir: str) -> Batch:
    """The customers' manifests, where nation 5 has models cut off and nation 7 lacks a curve."""
    customers = load(spark, sf_dir, "customer")
    key = F.split_part(F.split_part("path", F.lit("/"), F.lit(3)), F.lit("."), F.lit(1))
    nations = customers.select(
        F.col("c_custkey").cast("string").alias("_key"), F.col("c_nationkey").alias("_nation")
    )
    models = customer_models(customers).join(nations, key == F.col("_key"))
    cut = F.when(F.col("_nation") == 5, F.substring("content", 1, 60)).otherwise(F.col("content"))
    models = models.select("path", cut.alias("content"), "error_content")
    curves = customer_curves(customers.filter("c_nationkey <> 7")).unionByName(
        customer_curves(customers.filter("c_nationkey = 7")).filter(~F.col("path").endswith("_2.txt"))
    )
    return assemble_manifests(
        manifest.parse(customer_manifests(customers)),
        reduced_text.parse(curves),
        fit_model.parse(models),
        ingest_time=ingest_time(),
        **OPTIONS,
    )


_FLAWED = f"{_L4}, sound AS (SELECT * FROM ids WHERE c_nationkey NOT IN (5, 7))"

_GATE_SQL = """
SELECT CAST(c_custkey AS VARCHAR) AS job, message FROM (
  SELECT c_custkey, 'No output folder is given' AS message FROM customer WHERE c_mktsegment = 'MACHINERY'
  UNION ALL SELECT c_custkey, 'Not a model that can be read: /m/' || c_custkey || '.json' FROM customer, (VALUES (0), (1), (2)) AS p(pos)
    WHERE c_nationkey = 5 AND c_mktsegment <> 'MACHINERY' AND (pos > 0 OR c_mktsegment <> 'BUILDING')
  UNION ALL SELECT c_custkey, 'There is no file /c/' || c_custkey || '_2.txt' FROM customer WHERE c_nationkey = 7 AND c_mktsegment <> 'MACHINERY')
"""


@query("manifest_gate", _GATE_SQL)
def manifest_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Errors of the manifests that are left out because of themselves or one of their inputs."""
    return flawed_batch(spark, sf_dir).rejected.select("job", "message")


_DANGLING_SQL = f"""
WITH {_FLAWED}
SELECT 'reflectivity.sample_id' AS link, count(sample_id) AS ids, 0 AS dangling FROM sound
UNION ALL SELECT 'reflectivity.environment_id', count(env_id), 0 FROM sound
UNION ALL SELECT 'reflectivity_model.sample_id', count(sample_id), 0 FROM sound WHERE has_model
UNION ALL SELECT 'reflectivity_model.measurement_ids', count(*), 0 FROM sound WHERE has_model
UNION ALL SELECT 'environment.measurement_ids', count(env_id), 0 FROM sound
UNION ALL SELECT 'sample.environment_ids', count(env_id), 0 FROM sound WHERE sample_id IS NOT NULL
UNION ALL SELECT 'sample.fit_ids', count(fit_id), 0 FROM sound
"""


@query("dangling_ids", _DANGLING_SQL)
def dangling_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """For every id column, its ids and how many of them have no row, over the flawed manifests."""
    batch = tables.keep_parents(spark, flawed_batch(spark, sf_dir))
    found = batch.tables()
    named = [
        ("reflectivity", "sample_id", "sample"),
        ("reflectivity", "environment_id", "environment"),
        ("reflectivity_model", "sample_id", "sample"),
        ("reflectivity_model", "measurement_ids", "reflectivity"),
        ("environment", "measurement_ids", "reflectivity"),
        ("sample", "environment_ids", "environment"),
        ("sample", "fit_ids", "reflectivity_model"),
    ]
    parts = []
    for owner, column, target in named:
        ids = F.explode(column) if column.endswith("s") else F.col(column)
        rows = found[owner].select(ids.alias("named")).where("named IS NOT NULL")
        there = found[target].select(F.col("id").alias("_id"))
        joined_rows = rows.join(there, F.col("named") == F.col("_id"), "left")
        parts.append(
            joined_rows.agg(
                F.count(F.lit(1)).alias("ids"), F.count_if(F.col("_id").isNull()).alias("dangling")
            ).select(F.lit(f"{owner}.{column}").alias("link"), "ids", "dangling")
        )
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result


@query("ingest_once", _WRITTEN_SQL)
def ingest_once(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Outcomes and issues of all run directories that are ingested twice under one name."""
    base = scratch_path(spark, "ingests")
    for _ in range(2):
        batch = run_dir_batch(spark, sf_dir)
        ingests.write_ingest(batch, base, OPTIONS["ingest_id"])
    lake = ingests.Snapshot(spark, base)

    def counted(kind: str, name: str, df: DataFrame, label: str) -> DataFrame:
        return lake.report(name, df.schema).groupBy(F.col(label).alias("label")).agg(
            F.lit(kind).alias("kind"), F.count(F.lit(1)).alias("n")
        )

    outcomes = counted("outcome", "outcomes", batch.outcomes, "status")
    return outcomes.unionByName(counted("issue", "issues", batch.issues, "severity"))
