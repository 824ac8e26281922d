"""Fit-model files: parameters, layers and stacks, one model per line item."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from measlake.functions import layers
from measlake.records import sample
from measlake.sources import fit_model

from .base import composed, dealt, ingest_time, load, query, text

KEY = ("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber")
KEY_SQL = ", ".join(KEY)


def model_texts(items: DataFrame) -> DataFrame:
    """A model file and its error file per line item.

    Film 1 takes its thickness by reference and its density by value, film 2
    the other way round; the ends are as thick as tax and discount say.
    """
    free = F.when(F.col("l_linestatus") == "F", F.lit("false")).otherwise(F.lit("true"))
    libraries = (
        F.when(F.col("l_returnflag") == "R", F.lit('"refl1d": {"version": "1.2", "schema_version": "d"}, "bumps": {}'))
        .when(F.col("l_returnflag") == "A", F.lit('"bumps": {"version": "0.9"}'))
        .otherwise(F.lit('"other": {}'))
    )
    references = text(
        '"t1": {"__class__": "Parameter", "name": "thick", "fixed": ', free,
        ', "slot": {"value": ', F.col("l_quantity"), '}, "value": -1}, ',
        '"d2": {"name": "dens", "fixed": false, "std": ', F.col("l_tax"),
        ', "value": ', F.col("l_extendedprice"), "}, ",
        '"u": {"name": "unused", "slot": {"value": 3}}',
    )
    stack = text(
        '{"name": "air", "thickness": ', F.col("l_tax"), ', "interface": null, "material": {"name": "air", "rho": 0}}, ',
        '{"name": "Film", "thickness": {"__class__": "Reference", "id": "t1"}, "interface": {"value": 1.5}, ',
        '"material": {"name": "M', F.col("l_suppkey"), '", "rho": {"slot": {"value": ', F.col("l_discount"), "}}}}, ",
        '{"thickness": ', F.col("l_linenumber") * 7, ', "interface": {"__class__": "Reference", "id": "gone", "value": 4}, ',
        '"material": {"name": "P', F.col("l_partkey"), '", "rho": {"__class__": "Reference", "id": "d2"}, "irho": "x"}}, ',
        '{"name": "base", "thickness": {"value": ', F.col("l_discount"), '}, "material": {"name": "Si"}}',
    )
    content = text(
        '{"$schema": "s1", "libraries": {', libraries, '}, "references": {', references,
        '}, "object": {"name": "m", "sample": {"layers": [', stack, "]}}}",
    )
    errors = text('{"thick": {"std": ', F.col("l_tax") * 2, ', "mean": 0}, "dens": {"std": 99}}')
    return composed(
        items,
        *[F.col(k) for k in KEY],
        text("/m/", *[x for k in KEY for x in (F.col(k), "-")], "m.json").alias("path"),
        content.alias("content"),
        errors.alias("error_content"),
    )


def parsed(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = load(spark, sf_dir, "lineitem").select(
        *KEY, "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus"
    )
    return fit_model.parse(model_texts(dealt(items)))


_PARAM_SQL = f"""
SELECT {KEY_SQL}, l_quantity AS film_thickness,
  CASE WHEN l_linestatus = 'F' THEN l_tax * 2 END AS film_thickness_std,
  l_discount AS film_sld, CAST(NULL AS DOUBLE) AS film_sld_std,
  l_linenumber * 7.0::DOUBLE AS second_thickness, 4.0::DOUBLE AS second_interface,
  l_extendedprice AS second_sld, l_tax AS second_sld_std, 0.0::DOUBLE AS second_isld
FROM lineitem
"""


@query("param_resolve", _PARAM_SQL)
def param_resolve(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Values and uncertainties of literal, valued and referenced parameters."""
    m = parsed(spark, sf_dir)
    film, second = F.get("stack", F.lit(1)), F.get("stack", F.lit(2))
    return m.select(
        *KEY,
        film["thickness"].alias("film_thickness"),
        film["thickness_std"].alias("film_thickness_std"),
        film["sld"].alias("film_sld"),
        film["sld_std"].alias("film_sld_std"),
        second["thickness"].alias("second_thickness"),
        second["interface"].alias("second_interface"),
        second["sld"].alias("second_sld"),
        second["sld_std"].alias("second_sld_std"),
        second["isld"].alias("second_isld"),
    )


_COUNTS_SQL = f"""
SELECT {KEY_SQL}, CAST(3 AS BIGINT) AS num_parameters,
  CASE WHEN l_linestatus = 'F' THEN 2 ELSE 1 END AS num_free,
  CASE l_returnflag WHEN 'R' THEN 'refl1d' WHEN 'A' THEN 'bumps' ELSE 'unknown' END AS software,
  CASE l_returnflag WHEN 'R' THEN '1.2' WHEN 'A' THEN '0.9' ELSE 'unknown' END AS version,
  CASE l_returnflag WHEN 'R' THEN 'd' WHEN 'A' THEN 'unknown' ELSE 's1' END AS schema_version
FROM lineitem
"""


@query("param_counts", _COUNTS_SQL)
def param_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Numbers of parameters and software provenance per model."""
    return parsed(spark, sf_dir).select(
        *KEY,
        F.col("num_parameters").cast("bigint").alias("num_parameters"),
        F.col("num_free_parameters").alias("num_free"),
        "software",
        F.col("software_version").alias("version"),
        "schema_version",
    )


_LAYERS_SQL = f"""
SELECT {KEY_SQL}, layer_number, name, thickness, interface, sld FROM (
  SELECT {KEY_SQL}, 1 AS layer_number, 'air' AS name, l_tax AS thickness, 0.0::DOUBLE AS interface, 0.0::DOUBLE AS sld FROM lineitem
  UNION ALL SELECT {KEY_SQL}, 2, 'Film', l_quantity, 1.5::DOUBLE, l_discount FROM lineitem
  UNION ALL SELECT {KEY_SQL}, 3, 'unknown', l_linenumber * 7.0::DOUBLE, 4.0::DOUBLE, l_extendedprice FROM lineitem
  UNION ALL SELECT {KEY_SQL}, 4, 'base', l_discount, 0.0::DOUBLE, 0.0::DOUBLE FROM lineitem)
"""


@query("layer_stack", _LAYERS_SQL)
def layer_stack(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Numbered layers of every model, one row each."""
    m = parsed(spark, sf_dir)
    rows = m.select(*KEY, F.explode(layers.fit_layers(F.col("stack"))).alias("l"))
    return rows.select(*KEY, *[f"l.{c}" for c in ("layer_number", "name", "thickness", "interface", "sld")])


_PROPS_SQL = f"""
SELECT {KEY_SQL}, CAST(4 AS BIGINT) AS num_layers,
  CASE WHEN l_tax = 0 THEN 'air' END AS ambient, CASE WHEN l_discount = 0 THEN 'Si' END AS substrate,
  CAST(CASE WHEN l_tax > 0 THEN 1 ELSE 0 END + 2 + CASE WHEN l_discount > 0 THEN 1 ELSE 0 END AS BIGINT) AS films,
  round(l_tax + l_quantity + l_linenumber * 7 + l_discount, 6) AS total_thickness,
  CASE WHEN l_tax = 0 THEN 'back reflection' ELSE 'front reflection' END AS geometry,
  l_quantity AS named_thickness
FROM lineitem
"""


@query("stack_props", _PROPS_SQL)
def stack_props(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ambient, substrate, films, thickness, geometry and a layer by name."""
    stack = F.col("stack")
    return parsed(spark, sf_dir).select(
        *KEY,
        F.size(stack).cast("bigint").alias("num_layers"),
        layers.ambient(stack)["material"].alias("ambient"),
        layers.substrate(stack)["material"].alias("substrate"),
        F.size(layers.films(stack)).cast("bigint").alias("films"),
        F.round(layers.total_thickness(stack), 6).alias("total_thickness"),
        layers.geometry(stack).alias("geometry"),
        layers.by_name(stack, F.lit("FILM"))["thickness"].alias("named_thickness"),
    )


_SAMPLE_SQL = f"""
WITH m AS (
  SELECT {KEY_SQL}, l_tax, l_discount,
    CASE WHEN l_quantity >= l_linenumber * 7 THEN 'M' || l_suppkey ELSE 'P' || l_partkey END AS main
  FROM lineitem
)
SELECT {KEY_SQL}, main AS main_composition,
  main || ' in ' || 'air' || CASE WHEN l_discount = 0 THEN ' on Si' ELSE '' END AS description,
  CAST(CASE WHEN l_discount = 0 THEN 3 ELSE 4 END AS BIGINT) AS layers,
  CASE WHEN l_discount = 0 THEN 'base' END AS substrate_layer
FROM m
"""


@query("sample_records", _SAMPLE_SQL)
def sample_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sample records from the stacks: composition, description, substrate."""
    none = F.lit(None).cast("string")
    ids = F.array().cast("array<string>")
    m = parsed(spark, sf_dir)
    built = m.select(
        *KEY, *sample.record(F.col("path"), F.col("stack"), none, ids, ids, ingest_time())
    )
    return built.select(
        *KEY,
        "main_composition",
        "description",
        F.size("layers").cast("bigint").alias("layers"),
        F.col("substrate.name").alias("substrate_layer"),
    )


# --- several experiments ------------------------------------------------------


def experiment_texts(orders: DataFrame) -> DataFrame:
    """A model per order with as many experiments as its priority's number."""
    count = F.substring("o_orderpriority", 1, 1).cast("int")

    def experiment(i: Column) -> Column:
        return text(
            '{"sample": {"layers": [{"name": "f', i, '", "thickness": ', F.col("o_custkey") + i,
            ', "material": {"name": "X"}}]}, "probe": {"Q": {"values": [', i, ", ", i + 1,
            ']}, "R": {"values": [', F.col("o_totalprice"), ", 1]}}}",
        )

    models = F.array_join(F.transform(F.sequence(F.lit(1), count), experiment), ", ")
    own = F.when(
        F.col("o_orderstatus") == "F", F.lit('{"layers": [{"name": "own", "thickness": 5}]}')
    ).otherwise(F.lit("null"))
    content = text('{"object": {"sample": ', own, ', "models": [', models, "]}}")
    return composed(
        orders,
        F.col("o_orderkey"),
        text("/m/", F.col("o_orderkey"), ".json").alias("path"),
        content.alias("content"),
        F.lit(None).cast("string").alias("error_content"),
    )


_DATASETS_SQL = """
WITH m AS (SELECT *, CAST(o_orderpriority[1:1] AS BIGINT) AS n FROM orders)
SELECT o_orderkey, n AS num_datasets,
  CASE WHEN o_orderstatus = 'F' THEN 'own' ELSE 'f1' END AS default_layer,
  CASE WHEN n >= 3 THEN 'f3' END AS third_layer,
  round(n * o_custkey + n * (n + 1) / 2, 6) AS thickness_sum,
  2 * n AS knots, n AS q_starts, round(n * o_totalprice, 2) AS r_first_sum
FROM m
"""


@query("model_datasets", _DATASETS_SQL)
def model_datasets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Choice of stack and probe curves of models with several experiments."""
    orders = load(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority", "o_totalprice"
    )
    m = fit_model.parse(experiment_texts(dealt(orders)))
    none, third = F.lit(None).cast("int"), F.lit(2)

    def total(values: Column) -> Column:
        return F.aggregate(values, F.lit(0.0), lambda a, x: a + x)

    firsts = F.transform("datasets", lambda d: F.get(d["layers"], F.lit(0))["thickness"])
    return m.select(
        "o_orderkey",
        F.col("num_experiments").cast("bigint").alias("num_datasets"),
        F.get(layers.select_stack(F.col("stack"), F.col("datasets"), none), F.lit(0))["name"].alias("default_layer"),
        F.get(layers.select_stack(F.col("stack"), F.col("datasets"), third), F.lit(0))["name"].alias("third_layer"),
        F.round(total(firsts), 6).alias("thickness_sum"),
        F.aggregate("datasets", F.lit(0), lambda a, d: a + F.size(d["probe"]["knots"])).cast("bigint").alias("knots"),
        F.size(F.filter("datasets", lambda d: F.get(d["q"], F.lit(0)) >= 1)).cast("bigint").alias("q_starts"),
        F.round(total(F.transform("datasets", lambda d: F.get(d["r"], F.lit(0)))), 2).alias("r_first_sum"),
    )
