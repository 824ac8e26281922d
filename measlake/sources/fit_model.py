"""Fit-model JSON and its error file."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import layers, params
from ..functions.text import let
from ..operators import curve_match
from ..operators.rows import once
from .files import read_texts

# The part of a model file that is read. Parameters are variants,
# because they may be numbers, value objects or references; the file is parsed once.
_LAYERS = layers.parsed_layers("VARIANT")
_VALUES = "STRUCT<values: ARRAY<DOUBLE>>"
_LIBRARY = "STRUCT<version: STRING, schema_version: STRING>"
MODEL = (
    f"`$schema` STRING, libraries STRUCT<refl1d: {_LIBRARY}, bumps: {_LIBRARY}>, "
    f"references {params.REFERENCES}, "
    f"object STRUCT<name: STRING, sample: STRUCT<layers: {_LAYERS}>, "
    f"models: ARRAY<STRUCT<sample: STRUCT<layers: {_LAYERS}>, "
    f"probe: STRUCT<Q: {_VALUES}, R: {_VALUES}>>>>, "
    "_corrupt STRING"
)
_OPTIONS = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"}
ERROR_SUFFIX = "-err.json"
UNKNOWN = "unknown"


def error_path(model_path: Column) -> Column:
    """Where the companion error file of a model lies."""
    return F.concat(F.regexp_replace(model_path, r"(?<=[^/])\.[^./]*$", ""), F.lit(ERROR_SUFFIX))


def with_errors(models: DataFrame, texts: DataFrame) -> DataFrame:
    """Attach each model's companion error file as ``error_content``."""
    companions = texts.filter(F.col("path").endswith(ERROR_SUFFIX)).select(
        F.col("path").alias("_err"), F.col("content").alias("error_content")
    )
    return models.join(companions, error_path(F.col("path")) == F.col("_err"), "left").drop("_err")


def _provenance(libraries: Column, schema: Column) -> list[Column]:
    """Software, its version and the schema version, by preference."""
    first, second = libraries["refl1d"], libraries["bumps"]

    def pick(field: str) -> Column:
        return F.when(first.isNotNull(), F.coalesce(first[field], F.lit(UNKNOWN))).when(
            second.isNotNull(), F.coalesce(second[field], F.lit(UNKNOWN))
        )

    return [
        F.when(first.isNotNull(), F.lit("refl1d"))
        .when(second.isNotNull(), F.lit("bumps"))
        .otherwise(F.lit(UNKNOWN))
        .alias("software"),
        F.coalesce(pick("version"), F.lit(UNKNOWN)).alias("software_version"),
        F.coalesce(pick("schema_version"), schema, F.lit(UNKNOWN)).alias("schema_version"),
    ]


def parse(texts: DataFrame) -> DataFrame:
    """Read ``path``, ``content`` and ``error_content`` into one row per model.

    ``stack`` is ``object.sample``; ``datasets`` holds layers, probe curve and
    interpolation knots of every experiment. Both have resolved parameters.
    """
    keep = [c for c in texts.columns if c not in ("content", "error_content")]
    errors = F.col("error_content") if "error_content" in texts.columns else F.lit(None).cast("string")
    read = F.from_json("content", MODEL, _OPTIONS)
    experiments = F.col("experiments")

    # References and the error file are worked up only where layers are read, within
    # the expression of the layers: a step of its own would cost every model its time.
    def with_parameters(raw: Column, body: Callable[[Column], Column], empty: Column) -> Column:
        listed = F.from_json("error_content", params.ERRORS, {"mode": "PERMISSIVE"})
        listed = F.coalesce(listed, F.create_map().cast(params.ERRORS))
        # By ``let``, since an index reads its map several times and would parse the file each time.
        looked_up = let(let(listed, params.index), lambda e: params.resolve_references(F.col("refs"), e))
        return F.when(F.size(raw) > 0, let(let(looked_up, params.index), body)).otherwise(empty)

    def parts_of(m: Column) -> Column:
        return F.struct(
            F.coalesce(m["references"], F.create_map().cast(params.REFERENCES)).alias("refs"),
            m["object"]["sample"]["layers"].alias("own_layers"),
            m["object"]["models"].alias("experiments"),
            m["object"]["name"].alias("object_name"),
            m["libraries"].alias("libraries"),
            m["$schema"].alias("schema_name"),
            m["_corrupt"].isNotNull().alias("corrupt"),
        )

    # A generator keeps results from being computed again inside the lambdas. A file is
    # parsed within it: as a column, each part read of it would parse it anew.
    parts = (
        "refs", "own_layers", "experiments", "object_name", "libraries", "schema_name", "corrupt",
    )
    referenced = once(texts, let(read, parts_of), *parts).select(
        *keep, "content", errors.alias("error_content"), *parts
    )

    # The object's own stack and the experiments' are apart, so that one alone can be read.
    def dataset(x: Column, parameters: Column) -> Column:
        q, r = x["probe"]["Q"]["values"], x["probe"]["R"]["values"]
        own = layers.from_parsed(x["sample"]["layers"], parameters)
        return F.struct(
            F.coalesce(own, F.array().cast(layers.STACK)).alias("layers"),
            q.alias("q"),
            r.alias("r"),
            curve_match.probe(q, r).alias("probe"),
        )

    own_layers = F.col("own_layers")
    stack = with_parameters(
        own_layers, lambda p: layers.from_parsed(own_layers, p), F.array().cast(layers.STACK)
    )
    datasets = with_parameters(
        experiments,
        lambda p: F.transform(experiments, lambda x: dataset(x, p)),
        F.array().cast(DATASETS),
    )
    return referenced.select(
        *keep,
        F.col("content").alias("model_json"),
        F.when(F.col("corrupt"), F.try_parse_json("content").isNull())
        .otherwise(F.lit(False))
        .alias("malformed"),
        F.col("object_name").alias("model_name"),
        *_provenance(F.col("libraries"), F.col("schema_name")),
        F.coalesce(F.size(experiments), F.lit(0)).alias("num_experiments"),
        F.size("refs").alias("num_parameters"),
        params.free_count(F.col("refs")).alias("num_free_parameters"),
        stack.alias("stack"),
        datasets.alias("datasets"),
    )


DATASETS = (
    f"ARRAY<STRUCT<layers: {layers.STACK}, q: ARRAY<DOUBLE>, r: ARRAY<DOUBLE>, "
    f"probe: {curve_match.PROBE}>>"
)


def read(spark: SparkSession, paths: list[str] | str) -> DataFrame:
    """Model files with their companion error files."""
    texts = read_texts(spark, paths, glob="*.[jJ][sS][oO][nN]")
    return parse(with_errors(texts.filter(~F.col("path").endswith(ERROR_SUFFIX)), texts))
