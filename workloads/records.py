"""Run records: first rows, log values, instruments and identity."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from measlake.functions import instruments
from measlake.functions.text import non_empty
from measlake.operators.first_record import first_record
from measlake.operators.preference import log_values
from measlake.records import environment, reflectivity
from measlake.sources import run_dirs

from .base import ingest_time, load, query, text

_FIRST_SQL = """
SELECT user_id, event_type, event_id, value, props FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY event_id) AS n FROM events)
WHERE n = 1
"""


@query("first_record_per_group", _FIRST_SQL)
def first_record_per_group(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First event of every user and type."""
    events = load(spark, sf_dir, "events").select("user_id", "event_type", "event_id", "value", "props")
    return first_record(events, ["user_id", "event_type"], ["event_id"])


# Events as log records: some have no average, NaN or zero.
_LOGS_SQL = """
logs AS (
  SELECT user_id, event_id, event_type,
    CASE WHEN event_id % 5 = 0 THEN NULL WHEN event_id % 7 = 0 THEN 'NaN'::DOUBLE
         WHEN event_id % 3 = 0 THEN 0 ELSE value END AS average_value,
    CASE WHEN event_id % 2 = 0 THEN NULL ELSE value / 2 END AS value_numeric
  FROM events
),
firsts AS (
  SELECT user_id, event_type,
    CASE WHEN average_value IS NULL OR isnan(average_value) THEN value_numeric ELSE average_value END AS v
  FROM (SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY event_id) AS n FROM logs)
  WHERE n = 1
)"""

_PREFERENCE_SQL = f"""
WITH {_LOGS_SQL}
SELECT user_id,
  coalesce(max(v) FILTER (event_type = 'purchase'), max(v) FILTER (event_type = 'view'),
           max(v) FILTER (event_type = 'click')) AS first_value,
  coalesce(nullif(max(v) FILTER (event_type = 'purchase'), 0), nullif(max(v) FILTER (event_type = 'view'), 0),
           nullif(max(v) FILTER (event_type = 'click'), 0)) AS first_non_zero
FROM firsts WHERE event_type IN ('purchase', 'view', 'click') GROUP BY user_id
"""


def event_logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = load(spark, sf_dir, "events")
    n = F.col("event_id")
    average = (
        F.when(n % 5 == 0, F.lit(None).cast("double"))
        .when(n % 7 == 0, F.lit(float("nan")))
        .when(n % 3 == 0, F.lit(0.0))
        .otherwise(F.col("value"))
    )
    return events.select(
        "user_id",
        "event_id",
        F.col("event_type").alias("log_name"),
        average.alias("average_value"),
        F.when(n % 2 != 0, F.col("value") / 2).alias("value_numeric"),
    )


@query("value_by_preference", _PREFERENCE_SQL)
def value_by_preference(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First usable value of each user among ranked log names."""
    names = ("purchase", "view", "click")
    values = log_values(event_logs(spark, sf_dir), ["user_id"], list(names), ["event_id"])
    logs = F.col("log_values")
    return values.select(
        "user_id",
        instruments.preferred(logs, names).alias("first_value"),
        instruments.preferred(logs, names, zero_is_missing=True).alias("first_non_zero"),
    )


_ENVIRONMENT_SQL = f"""
WITH {_LOGS_SQL},
named AS (
  SELECT user_id,
    max(v) FILTER (event_type = 'click') AS sample_temp, max(v) FILTER (event_type = 'view') AS temp,
    max(v) FILTER (event_type = 'purchase') AS pressure
  FROM firsts GROUP BY user_id
),
e AS (
  SELECT user_id, user_id % 3 = 0 AS special,
    CASE WHEN user_id % 3 = 0 THEN nullif(sample_temp, 0) ELSE coalesce(sample_temp, temp) END AS temperature,
    CASE WHEN user_id % 3 = 0 THEN NULL ELSE pressure END AS pressure
  FROM named
)
SELECT user_id, temperature, pressure,
  CASE WHEN special THEN 'REF_L' ELSE 'GENERIC' END AS instrument,
  CASE WHEN temperature IS NULL THEN 'No temperature in the logs (sensors of '
    || CASE WHEN special THEN 'REF_L' ELSE 'GENERIC' END || ')' END AS review,
  CASE user_id % 2 WHEN 0 THEN 'cell ' || user_id ELSE 'Sample cell' END AS description
FROM e
"""


@query("environment_records", _ENVIRONMENT_SQL)
def environment_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Temperature, pressure and description of each user's environment."""
    renamed = F.create_map(
        *[F.lit(x) for x in ("click", "SampleTemp", "view", "Temp", "purchase", "VacuumPressure")],
        *[F.lit(x) for x in ("error", "Other", "signup", "Another")],
    )
    logs = event_logs(spark, sf_dir).withColumn("log_name", F.element_at(renamed, F.col("log_name")))
    wanted = instruments.log_names()
    values = log_values(logs, ["user_id"], wanted, ["event_id"])
    users = load(spark, sf_dir, "events").select("user_id").distinct()
    handler = instruments.resolve(
        F.when(F.col("user_id") % 3 == 0, F.lit("bl4b-2")).otherwise(F.lit("else"))
    )
    rows = users.join(values, "user_id", "left").withColumn("handler", handler)
    logs_col, name = F.col("log_values"), F.col("handler")
    rows = rows.withColumns(
        {
            "temperature": instruments.environment_value(name, logs_col, "temperature_logs"),
            "pressure": instruments.environment_value(name, logs_col, "pressure_logs"),
        }
    )
    given = F.when(F.col("user_id") % 2 == 0, text("cell ", F.col("user_id"))).otherwise(F.lit(""))
    return rows.select(
        "user_id",
        "temperature",
        "pressure",
        name.alias("instrument"),
        environment.temperature_flag(F.lit(True), F.col("temperature"), name)["value"].alias("review"),
        environment.instrument_description(given, name).alias("description"),
    )


_RULES_SQL = """
WITH p AS (
  SELECT p_partkey, CASE p_size % 6 WHEN 0 THEN 'REF_L' WHEN 1 THEN 'ref_l_' || p_brand WHEN 2 THEN 'BL-4B'
    WHEN 3 THEN 'xbl4b' WHEN 4 THEN NULL ELSE p_brand END AS id, p_brand, p_name FROM part
)
SELECT p_partkey, CASE WHEN id IS NULL OR id = p_brand THEN 'GENERIC' ELSE 'REF_L' END AS handler,
  CASE WHEN id IS NULL OR id = p_brand THEN NULL ELSE 6.0::DOUBLE END AS wavelength,
  CASE WHEN p_brand IN ('Brand#1', 'Brand#2') THEN 'A'
       WHEN p_brand = 'Brand#3' THEN 'B'
       WHEN contains(upper(p_brand), 'BRAND#1') OR contains(upper(p_brand), 'BRAND#2') THEN 'A'
       WHEN contains(upper(p_brand), 'BRAND#3') THEN 'B' ELSE 'GENERIC' END AS brand_rule,
  CASE WHEN p_brand IN ('Brand#1', 'Brand#2') OR (p_brand <> 'Brand#3' AND
       (contains(upper(p_brand), 'BRAND#1') OR contains(upper(p_brand), 'BRAND#2'))) THEN 'LabA'
       ELSE 'ORNL' END AS brand_lab
FROM p
"""


@query("rule_resolve", _RULES_SQL)
def rule_resolve(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Instrument rules on ids made from parts, and rules given by the caller."""
    part = load(spark, sf_dir, "part").select("p_partkey", "p_size", "p_brand")
    brand, size = F.col("p_brand"), F.col("p_size") % 6
    given = (
        F.when(size == 0, F.lit("REF_L"))
        .when(size == 1, text("ref_l_", brand))
        .when(size == 2, F.lit("BL-4B"))
        .when(size == 3, F.lit("xbl4b"))
        .when(size == 5, brand)
    )
    own = (
        instruments.Instrument("A", aliases=("Brand#1", "Brand#2"), laboratory="LabA"),
        instruments.Instrument("B", aliases=("Brand#3",)),
    )
    # The names themselves are single letters; only aliases should match here.
    own = tuple(instruments.Instrument(r.aliases[0], r.aliases[1:], laboratory=r.laboratory) for r in own)
    resolved = part.select(
        "p_partkey",
        instruments.resolve(given).alias("handler"),
        instruments.resolve(brand, own).alias("rule"),
    )
    labels = {"Brand#1": "A", "Brand#3": "B"}
    short = F.lit("GENERIC")
    for name, label in labels.items():
        short = F.when(F.col("rule") == name, F.lit(label)).otherwise(short)
    return resolved.select(
        "p_partkey",
        "handler",
        instruments.default_of(F.col("handler"), "wavelength").alias("wavelength"),
        short.alias("brand_rule"),
        instruments.default_of(F.col("rule"), "laboratory", own).alias("brand_lab"),
    )


_IDENTITY_SQL = """
SELECT d.doc_id,
  CASE WHEN l.doc_id IS NOT NULL THEN CASE WHEN l.quality = 1 THEN 'IPTS-' || d.doc_id ELSE 'Unknown' END
       WHEN d.lang = 'en' THEN 'IPTS-1' WHEN d.lang = 'fr' THEN 'IPTS-2' ELSE 'Unknown' END AS proposal_number,
  CASE WHEN l.doc_id IS NOT NULL THEN CAST(d.doc_id AS VARCHAR) WHEN d.lang = 'en' THEN 'm' || d.doc_id
       WHEN d.n_chars % 4 > 0 THEN CAST(d.n_chars % 4 AS VARCHAR) ELSE 'Unknown' END AS run_number,
  CASE WHEN l.doc_id IS NOT NULL AND l.toxic = 1 THEN 'meta title'
       WHEN l.doc_id IS NULL AND d.lang = 'en' THEN 'block title'
       WHEN d.source LIKE '%1' THEN 'header ' || d.lang ELSE 'Unknown' END AS run_title,
  CASE WHEN l.doc_id IS NOT NULL THEN CASE WHEN l.toxic = 1 THEN '2024-01-15 10:30:00' ELSE '2026-01-02 03:04:05' END
       WHEN d.lang = 'en' THEN '2023-02-03 04:05:06'
       WHEN d.lang = 'fr' THEN '2022-01-01 00:00:00' ELSE '2026-01-02 03:04:05' END AS run_start,
  CASE WHEN l.doc_id IS NOT NULL THEN 'INST' WHEN d.source LIKE '%2' THEN 'REF_L' ELSE 'Unknown' END AS instrument,
  CASE WHEN l.doc_id IS NOT NULL AND l.toxic = 0 THEN
         CASE WHEN l.quality = 1 THEN 'Start time cannot be read: later' ELSE 'No start time; the ingest time stands in' END
       WHEN l.doc_id IS NULL AND d.lang NOT IN ('en', 'fr') THEN 'No proposal number; ''Unknown'' stands in'
       ELSE '' END AS notes
FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id
"""


@query("identity_precedence", _IDENTITY_SQL)
def identity_precedence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Run identity from metadata, Meta block or header, in that order."""
    docs = load(spark, sf_dir, "documents").select("doc_id", "lang", "source", "n_chars")
    labels = load(spark, sf_dir, "labels").withColumnRenamed("doc_id", "label_id")
    rows = docs.join(labels, F.col("doc_id") == F.col("label_id"), "left")
    lang, number = F.col("lang"), F.col("doc_id")
    block = F.struct(
        F.when(lang == "en", F.lit("IPTS-1")).alias("experiment"),
        F.when(lang == "en", text("m", number)).alias("run_number"),
        F.when(lang == "en", F.lit("block title")).alias("run_title"),
        F.when(lang == "en", F.lit("2023-02-03T04:05:06Z")).alias("start_time"),
    )
    curve = F.struct(
        F.when(lang == "fr", F.lit("IPTS-2")).alias("experiment_id"),
        (F.col("n_chars") % 4).alias("run_number"),
        F.when(F.col("source").endswith("1"), text("header ", lang)).otherwise(F.lit("")).alias("run_title"),
        F.when(lang == "fr", F.lit("2022-01-01").cast("timestamp")).alias("run_start_time"),
        F.when(F.col("source").endswith("2"), F.lit("/d/Ref-l/x.txt")).otherwise(F.lit("/d/x.txt")).alias("path"),
        block.alias("meta_fields"),
    )
    good, toxic = F.col("quality") == 1, F.col("toxic") == 1
    start = F.when(toxic, F.lit("2024-01-15T10:30:00Z")).when(good, F.lit("later"))
    meta = F.when(
        F.col("label_id").isNotNull(),
        F.struct(
            F.when(good, text("IPTS-", number)).alias("experiment_identifier"),
            number.alias("run_number"),
            F.when(toxic, F.lit("meta title")).otherwise(F.lit("")).alias("title"),
            start.alias("start_time"),
            F.lit(None).cast("string").alias("source_path"),
            F.lit("INST").alias("instrument_id"),
        ),
    )
    who = reflectivity.identity(F.col("c"), F.col("m"), ingest_time())
    named = rows.select("doc_id", curve.alias("c"), meta.alias("m")).withColumn("who", who)
    notes = F.array_compact(
        F.array(*reflectivity.identity_warnings(F.col("c"), F.col("m"), F.col("who")))
    )
    return named.select(
        "doc_id",
        *[F.col(f"who.{c}").alias(c) for c in ("proposal_number", "run_number", "run_title")],
        F.date_format("who.run_start", "yyyy-MM-dd HH:mm:ss").alias("run_start"),
        F.col("who.instrument").alias("instrument"),
        F.array_join(notes, "; ").alias("notes"),
    )


_FIT_STATE_SQL = """
SELECT o_orderkey,
  CASE o_orderstatus WHEN 'F' THEN CASE WHEN o_custkey % 2 = 0 THEN o_totalprice
                                        WHEN o_custkey % 5 = 0 THEN 4.0 ELSE CAST(o_custkey % 5 AS DOUBLE) END
       WHEN 'P' THEN 7.5 END AS chi_squared,
  CASE o_orderstatus WHEN 'F' THEN 'final ' || o_orderpriority WHEN 'P' THEN 'saved ' || o_orderkey END AS text
FROM orders
"""


@query("fit_state", _FIT_STATE_SQL)
def fit_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Goodness of fit and text from final state or checkpoint."""
    orders = load(spark, sf_dir, "orders")
    status, customer = F.col("o_orderstatus"), F.col("o_custkey")
    own = F.when(customer % 2 == 0, text('"final_chi2": ', F.col("o_totalprice"), ", ")).otherwise(F.lit(""))
    final = F.when(
        status == "F",
        text(
            "{", own, '"state": {"best_chi2": ', customer % 5,
            ', "current_chi2": 4, "states": [{"extra_description": "final ', F.col("o_orderpriority"), '"}]}}',
        ),
    )
    saved = F.when(
        status != "O",
        text('{"state": {"best_chi2": 7.5, "states": [{"extra_description": "saved ', F.col("o_orderkey"), '"}, {}]}}'),
    )
    read = orders.select(
        "o_orderkey",
        F.from_json(non_empty(final), run_dirs.STATE_SCHEMA).alias("f"),
        F.from_json(non_empty(saved), run_dirs.STATE_SCHEMA).alias("c"),
    )
    return read.select("o_orderkey", run_dirs.fit_state(F.col("f"), F.col("c")).alias("s")).select(
        "o_orderkey", "s.chi_squared", "s.text"
    )
