"""What went into each measurement."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import layers, names
from ..operators import coverage
from ..sources import run_records
from .assemble import join_inputs


def source_summary(
    measurements: DataFrame,
    curves: DataFrame,
    models: DataFrame,
    metadata: DataFrame,
    logs: DataFrame,
    samples: DataFrame,
) -> DataFrame:
    """One row per measurement: which inputs are there and how much they hold.

    ``has_curve`` with its header fields, ``has_metadata``, ``has_sample``,
    ``log_count`` (distinct names), ``has_model``, ``layer_count`` and
    ``total_thickness`` of the layers in use.
    """
    wide = join_inputs(measurements.withColumnRenamed("model", "model_path"), curves, models, metadata)
    own_key = F.concat(F.lit("none:"), F.coalesce("reduced", "job"))
    wide = wide.withColumns(
        {
            "dir": F.coalesce(F.regexp_replace("parquet", "/+$", ""), own_key),
            "scope": run_records.scope(names.run_number(F.col("reduced"))),
        }
    )
    identity = run_records.record_of_run(samples, "identity")
    rows = wide.join(run_records.log_counts(logs), ["dir", "scope"], "left").join(
        identity, ["dir", "scope"], "left"
    )
    model = F.col("model")
    stack = F.when(
        model.isNotNull(),
        layers.select_stack(model["stack"], model["datasets"], F.col("dataset_index")),
    )
    rows = rows.withColumn("stack", stack)
    return rows.select(
        "job",
        "pos",
        F.col("curve").isNotNull().alias("has_curve"),
        *coverage.header_fields(F.col("curve")),
        F.col("meta").isNotNull().alias("has_metadata"),
        F.col("identity").isNotNull().alias("has_sample"),
        F.coalesce("log_count", F.lit(0)).alias("log_count"),
        model.isNotNull().alias("has_model"),
        F.coalesce(F.size("stack"), F.lit(0)).alias("layer_count"),
        F.when(model.isNotNull(), layers.total_thickness(F.col("stack"))).alias("total_thickness"),
    )
