"""Instrument rules that are rows of a table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from measlake.operators import rules

from .base import load, query, text
from .records import _LOGS_SQL, event_logs

_RULE_TABLE_SQL = """
WITH r AS (SELECT s_suppkey, s_name AS name, 'Bl' || s_suppkey AS alias, 'Lab' || s_nationkey AS lab, s_acctbal FROM supplier),
t AS (SELECT s_suppkey, name AS t FROM r UNION ALL SELECT s_suppkey, alias FROM r),
ids AS (
  SELECT o_orderkey, CASE o_orderkey % 6 WHEN 0 THEN 'Supplier#' || lpad(CAST(o_custkey AS VARCHAR), 9, '0')
    WHEN 1 THEN 'at supplier#' || lpad(CAST(o_custkey AS VARCHAR), 9, '0') || '_b' WHEN 2 THEN 'Bl' || (o_custkey % 1000)
    WHEN 3 THEN 'old bl' || o_custkey || '-' || (o_custkey % 7) WHEN 4 THEN NULL ELSE o_orderpriority END AS id FROM orders),
found AS (
  SELECT id, coalesce(max(CASE WHEN id = t THEN s_suppkey END), max(s_suppkey)) AS s_suppkey
  FROM (SELECT DISTINCT id FROM ids) JOIN t ON contains(upper(id), upper(t)) GROUP BY id)
SELECT o_orderkey, coalesce(name, 'GENERIC') AS handler, coalesce(lab, 'ORNL') AS laboratory, s_acctbal AS wavelength
FROM ids LEFT JOIN found ON found.id = ids.id LEFT JOIN r ON r.s_suppkey = found.s_suppkey
"""


def supplier_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A rule for each supplier, later ones first."""
    key = F.col("s_suppkey")
    return load(spark, sf_dir, "supplier").select(
        (-key).alias("ord"),
        F.col("s_name").alias("name"),
        F.array(text("Bl", key)).alias("aliases"),
        text("Lab", F.col("s_nationkey")).alias("laboratory"),
        F.col("s_acctbal").alias("wavelength"),
    )


@query("rule_table", _RULE_TABLE_SQL)
def rule_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rule that the id of every order means, out of one rule per supplier."""
    orders = load(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderpriority")
    customer, kind = F.col("o_custkey"), F.col("o_orderkey") % 6
    padded = F.lpad(customer.cast("string"), 9, "0")
    given = (
        F.when(kind == 0, text("Supplier#", padded))
        .when(kind == 1, text("at supplier#", padded, "_b"))
        .when(kind == 2, text("Bl", customer % 1000))
        .when(kind == 3, text("old bl", customer, "-", customer % 7))
        .when(kind == 5, F.col("o_orderpriority"))
    )
    named = orders.select("o_orderkey", given.alias("id"))
    found = rules.with_rule(named, "id", supplier_rules(spark, sf_dir))
    return found.select(
        "o_orderkey",
        F.col("rule.name").alias("handler"),
        "rule.laboratory",
        "rule.wavelength",
    )


_LOG_RULES_SQL = f"""
WITH {_LOGS_SQL},
n AS (SELECT n_nationkey, CASE n_nationkey % 3 WHEN 0 THEN ['purchase', 'view', 'click'] WHEN 1 THEN ['view', 'error'] ELSE ['click'] END AS names
      FROM nation),
w AS (SELECT u.user_id, n_nationkey % 2 = 0 AS zero, unnest(names) AS event_type, generate_subscripts(names, 1) AS pos
      FROM (SELECT DISTINCT user_id FROM events) u JOIN n ON n_nationkey = u.user_id % 25),
v AS (SELECT w.user_id, pos, CASE WHEN zero THEN nullif(v, 0) ELSE v END AS v FROM w
      JOIN firsts ON firsts.user_id = w.user_id AND firsts.event_type = w.event_type)
SELECT user_id, arg_min(v, pos) AS value FROM v WHERE v IS NOT NULL GROUP BY user_id
"""


@query("logs_by_rule", _LOG_RULES_SQL)
def logs_by_rule(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First usable log of every user, by the names that the rule of the user's nation lists."""
    nation = load(spark, sf_dir, "nation")
    key = F.col("n_nationkey")
    three, two, one = [
        F.array(*map(F.lit, names)) for names in (("purchase", "view", "click"), ("view", "error"), ("click",))
    ]
    table = nation.select(
        key.alias("ord"),
        F.col("n_name").alias("name"),
        F.array().cast("array<string>").alias("aliases"),
        F.when(key % 3 == 0, three).when(key % 3 == 1, two).otherwise(one).alias("temperature_logs"),
        (key % 2 == 0).alias("zero_is_missing"),
    )
    logs = event_logs(spark, sf_dir)
    users = logs.select("user_id").distinct()
    users = users.withColumn("instrument", text("NATION_", F.col("user_id") % 25))
    found = rules.with_rule(users, "instrument", table)
    return rules.values_by_rule(
        found, logs, ["user_id"], F.col("rule.temperature_logs"), F.col("rule.zero_is_missing"), ["event_id"]
    )
