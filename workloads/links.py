"""Links between entities and lookups over them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from measlake import store
from measlake.operators import links
from measlake.operators.first_record import distinct_by_id

from .base import load, query, text

_LINK_SQL = """
SELECT 'environment' AS parent_kind, o_custkey AS parent,
  row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) - 1 AS position, o_orderkey AS child
FROM orders
UNION ALL
SELECT 'sample', c_nationkey, row_number() OVER (PARTITION BY c_nationkey ORDER BY c_custkey) - 1, c_custkey
FROM customer
"""


@query("link_entities", _LINK_SQL)
def link_entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ordered children: orders of a customer, customers of a nation."""
    orders = load(spark, sf_dir, "orders").select(F.col("o_custkey").alias("parent"), "o_orderkey")
    customers = load(spark, sf_dir, "customer").select(
        F.col("c_nationkey").cast("bigint").alias("parent"), "c_custkey"
    )
    parts = [
        ("environment", "o_orderkey", links.children(orders, "parent", "o_orderkey", "o_orderkey")),
        ("sample", "c_custkey", links.children(customers, "parent", "c_custkey", "c_custkey")),
    ]
    both = [
        part.select(F.lit(kind).alias("parent_kind"), "parent", "position", F.col(child).alias("child"))
        for kind, child, part in parts
    ]
    return both[0].unionByName(both[1])


def fits_of_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A fit per customer, over all of the customer's orders."""
    orders = load(spark, sf_dir, "orders").select("o_custkey", "o_orderkey")
    whole = orders.groupBy("o_custkey").agg(F.sort_array(F.collect_list("o_orderkey")).alias("keys"))
    return whole.select(
        text("fit-", F.col("o_custkey")).alias("id"),
        F.transform("keys", lambda x: x.cast("string")).alias("measurement_ids"),
    )


_FITS_SQL = """fits AS (
  SELECT 'fit-' || o_custkey AS id, list(CAST(o_orderkey AS VARCHAR) ORDER BY o_orderkey) AS measurement_ids
  FROM orders GROUP BY o_custkey
)"""

_RUNS_IN_FIT_SQL = f"""
WITH {_FITS_SQL},
named AS (SELECT id AS owner_id, unnest(measurement_ids) AS id, unnest(generate_series(0, len(measurement_ids) - 1)) AS position FROM fits)
SELECT owner_id, CAST(position AS INTEGER) AS position, n.id, o_orderstatus, o_totalprice
FROM named n JOIN orders o ON CAST(o.o_orderkey AS VARCHAR) = n.id
"""


def run_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = load(spark, sf_dir, "orders")
    return orders.withColumn("id", F.col("o_orderkey").cast("string"))


@query("runs_in_fit", _RUNS_IN_FIT_SQL)
def runs_in_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of every fit in the fit's order."""
    runs = run_table(spark, sf_dir).select("id", "o_orderstatus", "o_totalprice")
    return store.runs_in_fits(fits_of_customers(spark, sf_dir), runs)


_FITS_FOR_RUN_SQL = f"""
WITH {_FITS_SQL},
hits AS (SELECT DISTINCT f.id FROM (SELECT id, unnest(measurement_ids) AS m FROM fits) f
         JOIN orders o ON CAST(o.o_orderkey AS VARCHAR) = f.m WHERE o_totalprice > 450000)
SELECT id, array_to_string(measurement_ids, ',') AS members FROM fits WHERE id IN (SELECT id FROM hits)
"""


@query("fits_for_run", _FITS_FOR_RUN_SQL)
def fits_for_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fits that use at least one expensive order."""
    runs = run_table(spark, sf_dir).filter("o_totalprice > 450000").select("id")
    found = store.fits_for_runs(fits_of_customers(spark, sf_dir), runs)
    return found.select("id", F.array_join("measurement_ids", ",").alias("members"))


_STATES_SQL = """
SELECT CAST(c_nationkey AS VARCHAR) AS sample_id, o_orderpriority || '/' || o_orderstatus AS environment_id, count(*) AS runs
FROM orders JOIN customer ON c_custkey = o_custkey GROUP BY 1, 2
"""


@query("states_of_store", _STATES_SQL)
def states_of_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    """States: runs that share sample and environment."""
    orders = load(spark, sf_dir, "orders").select("o_custkey", "o_orderpriority", "o_orderstatus")
    customers = load(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    runs = orders.join(customers, F.col("o_custkey") == F.col("c_custkey")).select(
        F.col("c_nationkey").cast("string").alias("sample_id"),
        text(F.col("o_orderpriority"), "/", F.col("o_orderstatus")).alias("environment_id"),
    )
    return store.states(runs)


_FITTED_SQL = """
SELECT 'f' || l_orderkey || '-' || l_partkey || '-' || l_suppkey || '-' || l_linenumber AS fit_id,
  dataset_pos, layer_number, name, thickness FROM (
  SELECT *, 0 AS dataset_pos, 1 AS layer_number, l_returnflag AS name, l_quantity AS thickness FROM lineitem
  UNION ALL SELECT *, 1, 1, l_linestatus, l_tax FROM lineitem
  UNION ALL SELECT *, 1, 2, l_returnflag, l_discount FROM lineitem)
"""


@query("fitted_layers", _FITTED_SQL)
def fitted_layers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Layers of every dataset of every fit, one row each."""
    items = load(spark, sf_dir, "lineitem")

    def layer(number: int, name: str, thickness: str):
        return F.struct(
            F.lit(number).alias("layer_number"), F.col(name).alias("name"), F.col(thickness).alias("thickness")
        )

    def dataset(index: int, *stack):
        return F.struct(
            F.lit(index).alias("dataset_index"),
            F.col("l_orderkey").cast("string").alias("measurement_id"),
            F.lit("1").alias("run_number"),
            F.array(*stack).alias("layers"),
        )

    fits = items.select(
        text("f", F.col("l_orderkey"), "-", F.col("l_partkey"), "-", F.col("l_suppkey"), "-", F.col("l_linenumber")).alias("id"),
        F.array(
            dataset(0, layer(1, "l_returnflag", "l_quantity")),
            dataset(1, layer(1, "l_linestatus", "l_tax"), layer(2, "l_returnflag", "l_discount")),
        ).alias("datasets"),
    )
    return store.fitted_layers(fits).select("fit_id", "dataset_pos", "layer_number", "name", "thickness")


_FANOUT_SQL = """
WITH firsts AS (
  SELECT o_custkey, o_orderkey AS sample_owner, o_orderpriority AS sample_description FROM (
    SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS n FROM orders) WHERE n = 1)
SELECT o_orderkey, sample_owner, sample_description, o_orderkey = sample_owner AS is_primary
FROM orders JOIN firsts USING (o_custkey)
"""


@query("shared_sample_fanout", _FANOUT_SQL)
def shared_sample_fanout(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first order of a customer owns the sample, all orders link to it."""
    orders = load(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", "o_orderdate", "o_orderpriority")
    linked = links.with_first_of_group(
        orders,
        "o_custkey",
        ["o_orderdate", "o_orderkey"],
        {"sample_owner": "o_orderkey", "sample_description": "o_orderpriority"},
    )
    return linked.select(
        "o_orderkey",
        "sample_owner",
        "sample_description",
        (F.col("o_orderkey") == F.col("sample_owner")).alias("is_primary"),
    )


_DISTINCT_SQL = """
WITH u AS (
  SELECT sha256(text) AS id, 'document' AS origin, doc_id AS ord, 0 AS part FROM documents
  UNION ALL SELECT sha256(text), 'benchmark', item_id, 1 FROM benchmark
  UNION ALL SELECT sha256(text), 'turn', conv_id * 1000 + turn, 2 FROM conversations)
SELECT id, origin, ord FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY part, ord) AS n FROM u) WHERE n = 1
"""


@query("distinct_by_id", _DISTINCT_SQL)
def distinct_by_id_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Union of three tables by the digest of their texts, first one kept."""
    digest = F.sha2("text", 256).alias("id")
    parts = [
        load(spark, sf_dir, "documents").select(digest, F.lit("document").alias("origin"), F.col("doc_id").alias("ord")),
        load(spark, sf_dir, "benchmark").select(digest, F.lit("benchmark").alias("origin"), F.col("item_id").alias("ord")),
        load(spark, sf_dir, "conversations").select(
            digest, F.lit("turn").alias("origin"), (F.col("conv_id") * 1000 + F.col("turn")).alias("ord")
        ),
    ]
    return distinct_by_id(parts)


_SAMPLE_FITS_SQL = """
SELECT CAST(o_custkey AS VARCHAR) AS owner_id, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) - 1 AS position,
  CAST(o_orderkey AS VARCHAR) AS id, o_totalprice AS chi_squared
FROM orders
"""


@query("fits_for_samples", _SAMPLE_FITS_SQL)
def fits_for_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fits that a sample names: the orders of a customer, in order."""
    orders = load(spark, sf_dir, "orders")
    key = F.col("o_orderkey").cast("string")
    whole = orders.groupBy("o_custkey").agg(F.sort_array(F.collect_list("o_orderkey")).alias("keys"))
    samples = whole.select(
        F.col("o_custkey").cast("string").alias("id"),
        F.transform("keys", lambda x: x.cast("string")).alias("fit_ids"),
    )
    fits = orders.select(key.alias("id"), F.col("o_totalprice").alias("chi_squared"))
    found = store.fits_for_samples(samples, fits)
    return found.select("owner_id", F.col("position").cast("bigint").alias("position"), "id", "chi_squared")


_STATE_RUNS_SQL = """
SELECT o_orderkey, 'sample' AS by FROM orders JOIN customer ON c_custkey = o_custkey WHERE c_nationkey = 4
UNION ALL SELECT o_orderkey, 'state' FROM orders JOIN customer ON c_custkey = o_custkey WHERE c_nationkey = 4 AND o_orderstatus = 'F'
"""


@query("runs_of_state", _STATE_RUNS_SQL)
def runs_of_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of one sample, and of one of its states."""
    orders = load(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    customers = load(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    runs = orders.join(customers, F.col("o_custkey") == F.col("c_custkey")).select(
        "o_orderkey",
        F.col("c_nationkey").cast("string").alias("sample_id"),
        F.col("o_orderstatus").alias("environment_id"),
    )
    of_sample = store.runs_of_sample(runs, "4").select("o_orderkey", F.lit("sample").alias("by"))
    of_state = store.runs_of_state(runs, "4", "F").select("o_orderkey", F.lit("state").alias("by"))
    return of_sample.unionByName(of_state)
