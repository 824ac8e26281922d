"""Coverage, summaries, issues and outcomes."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from measlake.functions.text import non_empty
from measlake.operators import coverage, issues, kept_coverage
from measlake.session import scratch_path

from .base import load, query, text

_COVERAGE_SQL = """
WITH t AS (SELECT d.doc_id, d.lang, nullif(d.source, 'src1') AS source, l.quality, nullif(l.toxic, 0) AS toxic
           FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id),
c AS (
  SELECT 'doc_id' AS field, count(doc_id) AS populated, count(*) AS n FROM t
  UNION ALL SELECT 'lang', count(lang), count(*) FROM t UNION ALL SELECT 'source', count(source), count(*) FROM t
  UNION ALL SELECT 'label.quality', count(quality), count(*) FROM t UNION ALL SELECT 'label.toxic', count(toxic), count(*) FROM t
  UNION ALL SELECT 'words', count(*), count(*) FROM t)
SELECT field, populated, n - populated AS missing, round(100.0::DOUBLE * populated / n, 1) AS coverage_pct FROM c
"""


def labelled_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents")
    labels = load(spark, sf_dir, "labels").withColumnRenamed("doc_id", "label_id")
    joined = docs.join(labels, F.col("doc_id") == F.col("label_id"), "left")
    return joined.select(
        "doc_id",
        "lang",
        F.nullif(F.col("source"), F.lit("src1")).alias("source"),
        F.when(
            F.col("label_id").isNotNull(),
            F.struct("quality", F.nullif(F.col("toxic"), F.lit(0)).alias("toxic")),
        ).alias("label"),
        F.filter(F.split("text", " "), lambda w: F.length(w) > 400).alias("words"),
    )


@query("field_coverage", _COVERAGE_SQL)
def field_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Share of rows with a value, per field, of documents with their labels."""
    return coverage.profile(labelled_documents(spark, sf_dir))


_KEPT_COVERAGE_SQL = """
WITH t AS (SELECT d.doc_id, d.lang, nullif(d.source, 'src1') AS source, d.n_chars, l.quality, nullif(l.toxic, 0) AS toxic
           FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id),
c AS (
  SELECT 'doc_id' AS field, count(doc_id) AS populated, count(*) AS n, CAST(min(doc_id) AS DOUBLE) AS low_number,
    CAST(max(doc_id) AS DOUBLE) AS high_number, NULL AS low_text, NULL AS high_text FROM t
  UNION ALL SELECT 'lang', count(lang), count(*), NULL, NULL, min(lang), max(lang) FROM t
  UNION ALL SELECT 'source', count(source), count(*), NULL, NULL, min(source), max(source) FROM t
  UNION ALL SELECT 'label.quality', count(quality), count(*), min(quality), max(quality), NULL, NULL FROM t
  UNION ALL SELECT 'label.toxic', count(toxic), count(*), min(toxic), max(toxic), NULL, NULL FROM t
  UNION ALL SELECT 'words', count(*), count(*), NULL, NULL, NULL, NULL FROM t)
SELECT field, populated, n - populated AS missing, round(100.0::DOUBLE * populated / n, 1) AS coverage_pct,
  low_number, high_number, low_text, high_text FROM c
"""


@query("coverage_after_appends", _KEPT_COVERAGE_SQL)
def coverage_after_appends(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Coverage and bounds of a table after three appends, each of which reads the new files only."""
    docs = labelled_documents(spark, sf_dir)
    table, kept = scratch_path(spark, "lake"), scratch_path(spark, "coverage")
    for turn in range(3):
        docs.filter(F.col("doc_id") % 3 == turn).write.mode("append").parquet(table)
        parts = kept_coverage.refresh(spark, table, kept)
    return kept_coverage.merged(parts)


_RECORD_SQL = """
SELECT d.doc_id,
  CAST(3 + CASE WHEN d.source <> 'src1' THEN 1 ELSE 0 END + CASE WHEN l.doc_id IS NULL THEN 0 ELSE 1 + l.toxic END AS BIGINT) AS populated,
  CAST(CASE WHEN d.source <> 'src1' THEN 0 ELSE 1 END + CASE WHEN l.doc_id IS NULL THEN 1 ELSE 1 - l.toxic END AS BIGINT) AS missing,
  array_to_string(list_filter([CASE WHEN d.source = 'src1' THEN 'source' END, CASE WHEN l.doc_id IS NULL THEN 'label'
    WHEN l.toxic = 0 THEN 'label.toxic' END], lambda x: x IS NOT NULL), ',') AS names
FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id
"""


@query("record_coverage", _RECORD_SQL)
def record_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Filled and missing fields of every labelled document."""
    rows = labelled_documents(spark, sf_dir)
    found = rows.select("doc_id", coverage.record_coverage(rows).alias("c"))
    return found.select(
        "doc_id",
        F.col("c.populated_fields").cast("bigint").alias("populated"),
        F.col("c.missing_fields").cast("bigint").alias("missing"),
        F.array_join("c.missing_field_names", ",").alias("names"),
    )


_SUMMARY_SQL = """
WITH names AS (SELECT DISTINCT user_id, event_type || ':' || json_extract_string(props, '$.k') AS name FROM events)
SELECT user_id, name, count(*) OVER (PARTITION BY user_id) AS name_count FROM names
"""


@query("source_summary", _SUMMARY_SQL)
def source_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every distinct log name of every user, with their number."""
    events = load(spark, sf_dir, "events")
    key = F.get_json_object("props", "$.k")
    logs = events.select("user_id", text(F.col("event_type"), ":", key).alias("log_name"))
    found = coverage.names_per_key(logs, ["user_id"], "log_name")
    return found.select("user_id", F.col("log_name").alias("name"), "name_count")


_HEADER_SUMMARY_SQL = """
SELECT o_orderkey,
  array_to_string(list_filter(['experiment_id', 'run_number', CASE WHEN o_orderstatus <> 'F' THEN 'run_title' END,
    'run_start_time', CASE WHEN o_totalprice > 250000 THEN 'reduction_time' END], lambda x: x IS NOT NULL), ',') AS present,
  array_to_string(list_filter([CASE WHEN o_orderstatus = 'F' THEN 'run_title' END,
    CASE WHEN o_totalprice <= 250000 THEN 'reduction_time' END, 'reduction_version'], lambda x: x IS NOT NULL), ',') AS absent
FROM orders
"""


@query("header_summary", _HEADER_SUMMARY_SQL)
def header_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which header fields a run has, for one run per order."""
    orders = load(spark, sf_dir, "orders")
    curve = F.struct(
        F.col("o_custkey").alias("experiment_id"),
        F.col("o_orderkey").alias("run_number"),
        F.when(F.col("o_orderstatus") != "F", F.col("o_orderpriority")).alias("run_title"),
        F.col("o_orderdate").alias("run_start_time"),
        F.when(F.col("o_totalprice") > 250000, F.col("o_orderdate")).alias("reduction_time"),
        F.lit(None).cast("string").alias("reduction_version"),
    )
    rows = orders.select("o_orderkey", curve.alias("c"))
    found = rows.select("o_orderkey", *coverage.header_fields(F.col("c")))
    return found.select(
        "o_orderkey",
        F.array_join("fields_with_data", ",").alias("present"),
        F.array_join("fields_missing", ",").alias("absent"),
    )


# --- issues -------------------------------------------------------------------

_ISSUES_CTE = """
i AS (
  SELECT l_returnflag, l_orderkey, l_partkey, l_suppkey, l_linenumber,
    list_filter([CASE WHEN l_quantity > 45 THEN 'quantity ' || CAST(CAST(l_quantity AS BIGINT) AS VARCHAR) END,
                 CASE WHEN l_tax = 0 THEN 'no tax' END], lambda x: x IS NOT NULL) AS warnings,
    list_filter([CASE WHEN l_discount = 0 AND l_tax = 0 THEN 'free of charge' END], lambda x: x IS NOT NULL) AS errors,
    CASE WHEN l_discount > 0.08 THEN 'high' END AS discount_flag,
    CASE WHEN l_linenumber = 7 THEN 'last' END AS line_flag
  FROM lineitem)"""

_REVIEW_SQL = f"""
WITH {_ISSUES_CTE}
SELECT l_returnflag, severity, coalesce(field, '') AS field, message, count(*) AS n FROM (
  SELECT l_returnflag, 'warning' AS severity, CAST(NULL AS VARCHAR) AS field, unnest(warnings) AS message FROM i
  UNION ALL SELECT l_returnflag, 'error', NULL, unnest(errors) FROM i
  UNION ALL SELECT l_returnflag, 'review', 'discount', discount_flag FROM i WHERE discount_flag IS NOT NULL
  UNION ALL SELECT l_returnflag, 'review', 'line', line_flag FROM i WHERE line_flag IS NOT NULL)
GROUP BY ALL
"""


def checked_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items with warnings, errors and review flags."""
    items = load(spark, sf_dir, "lineitem")
    quantity = F.col("l_quantity")
    return items.select(
        "l_returnflag", "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber",
        issues.messages(
            F.when(quantity > 45, text("quantity ", quantity.cast("bigint"))),
            F.when(F.col("l_tax") == 0, F.lit("no tax")),
        ).alias("warnings"),
        issues.messages(
            F.when((F.col("l_discount") == 0) & (F.col("l_tax") == 0), F.lit("free of charge"))
        ).alias("errors"),
        issues.review(
            issues.flag(F.col("l_discount") > 0.08, "discount", "high"),
            issues.flag(F.col("l_linenumber") == 7, "line", "last"),
        ).alias("needs_review"),
    )


@query("review_issues", _REVIEW_SQL)
def review_issues(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Issue rows of all line items, counted by kind."""
    rows = issues.explode_issues(checked_items(spark, sf_dir), ["l_returnflag"])
    return rows.groupBy(
        "l_returnflag", "severity", F.coalesce("field", F.lit("")).alias("field"), "message"
    ).agg(F.count(F.lit(1)).alias("n"))


_OUTCOME_SQL = f"""
WITH {_ISSUES_CTE}
SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber,
  CASE WHEN len(errors) > 0 THEN 'failed' ELSE 'ok' END AS status,
  CASE WHEN len(errors) > 0 THEN 1 ELSE 0 END AS exit_code, len(errors) = 0 AS is_complete,
  len(errors) > 0 AS has_errors, discount_flag IS NOT NULL OR line_flag IS NOT NULL AS needs_human_review,
  CASE WHEN len(errors) = 0 THEN 'part,status' ELSE 'part' END AS details,
  array_to_string(list_concat(errors, warnings), ',') AS messages
FROM i
"""


@query("run_outcome", _OUTCOME_SQL)
def run_outcome(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Audit row of every line item: gate, status and non-null details."""
    rows = issues.gate(checked_items(spark, sf_dir))
    fine = F.when(F.size("errors") == 0, F.lit("completed"))
    found = issues.outcome(
        rows, "measlake", "0", {}, {}, {"part": F.col("l_partkey"), "status": fine, "none": F.lit(None)}
    )
    return found.select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "status", "exit_code",
        "is_complete", "has_errors", "needs_human_review",
        F.array_join(F.array_sort(F.map_keys("info")), ",").alias("details"),
        F.array_join("messages.text", ",").alias("messages"),
    )


_STORE_SQL = f"""
WITH {_ISSUES_CTE},
o AS (SELECT l_orderkey AS k, CAST(sum(l_quantity) AS BIGINT) AS version, max(len(errors)) AS failed FROM i JOIN lineitem USING (l_orderkey, l_linenumber, l_partkey, l_suppkey) GROUP BY 1),
known AS (SELECT o_orderkey AS k, CASE WHEN o_custkey % 2 = 0 THEN 0 ELSE 1 END AS changed FROM orders WHERE o_orderstatus = 'F')
SELECT CASE WHEN failed > 0 THEN 'failed' WHEN known.k IS NULL THEN 'ok' WHEN changed = 0 THEN 'skipped' ELSE 'needs-reprocessing' END AS status,
  count(*) AS n
FROM o LEFT JOIN known ON known.k = o.k GROUP BY 1
"""


@query("outcomes_against_store", _STORE_SQL)
def outcomes_against_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Outcomes of orders, of which the finished ones are in the store, half of them changed since."""
    rows = checked_items(spark, sf_dir).withColumn("failing", F.size("errors"))
    quantity = load(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(
        F.sum("l_quantity").cast("bigint").alias("version")
    )
    jobs = rows.groupBy("l_orderkey").agg(F.max("failing").alias("failing")).join(quantity, "l_orderkey")
    jobs = jobs.withColumns(
        {
            "errors": F.when(F.col("failing") > 0, F.array(F.lit("failing item"))).otherwise(issues.no_messages()),
            "warnings": issues.no_messages(),
        }
    )
    outcomes = issues.outcome(jobs, "measlake", "0", {}, {}, {})
    finished = load(spark, sf_dir, "orders").filter("o_orderstatus = 'F'")
    known = finished.join(quantity, F.col("o_orderkey") == F.col("l_orderkey")).select(
        "l_orderkey", (F.col("version") + F.col("o_custkey") % 2).alias("version")
    )
    found = issues.against_store(outcomes, known, "l_orderkey", "version")
    return found.groupBy("status").agg(F.count(F.lit(1)).alias("n"))


_TOTALS_SQL = f"""
WITH {_ISSUES_CTE}
SELECT l_returnflag, count(*) AS measurements, count(discount_flag) AS environments,
  CAST(sum(len(warnings)) AS BIGINT) AS warnings, count(*) FILTER (len(errors) > 0) AS failed FROM i GROUP BY 1
"""


@query("batch_totals", _TOTALS_SQL)
def batch_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts of records, environments and warnings per return flag."""
    rows = checked_items(spark, sf_dir)
    named = rows.withColumn(
        "environment_id", non_empty(F.try_element_at("needs_review", F.lit("discount")))
    )
    return issues.totals(named, "l_returnflag")
