"""Fit records."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..functions import layers
from ..functions.text import non_empty

# Fit strategies.
SINGLE, SINGLE_STATE, MULTI_STATE = "single", "single_state_coref", "multi_state_coref"
NO_SOFTWARE = "The model names no known software"


def strategy(num_experiments: Column) -> Column:
    return F.when(num_experiments <= 1, F.lit(SINGLE)).otherwise(F.lit(SINGLE_STATE))


def dataset(
    index: Column, measurement_id: Column, run_number: Column, chi_squared: Column, stack: Column
) -> Column:
    """One entry of a fit's ``datasets``."""
    return F.struct(
        index.cast("int").alias("dataset_index"),
        measurement_id.alias("measurement_id"),
        run_number.alias("run_number"),
        chi_squared.alias("chi_squared"),
        layers.fit_layers(stack).alias("layers"),
    )


def primary_layers(datasets: Column, index: Column) -> Column:
    """Layers of the dataset in use, else of the first one."""
    same = F.filter(datasets, lambda d: d["dataset_index"].eqNullSafe(index))
    return F.coalesce(F.get(same, F.lit(0)), F.get(datasets, F.lit(0)))["layers"]


def record(
    id_: Column,
    model: Column,
    datasets: Column,
    dataset_index: Column,
    measurement_ids: Column,
    sample_id: Column,
    sample_ids: Column,
    chi_squared: Column,
    fit_strategy: Column,
    ingest_time: Column,
) -> list[Column]:
    """Columns of a fit record; ``model`` is one parsed model file."""
    no_names = F.array().cast("array<string>")
    return [
        id_.alias("id"),
        ingest_time.alias("created_at"),
        measurement_ids.alias("measurement_ids"),
        sample_id.alias("sample_id"),
        sample_ids.alias("sample_ids"),
        fit_strategy.alias("fit_strategy"),
        no_names.alias("shared_parameters"),
        no_names.alias("unshared_parameters"),
        non_empty(model["model_name"]).alias("model_name"),
        model["path"].alias("model_file_path"),
        *[model[c].alias(c) for c in ("software", "software_version", "schema_version")],
        model["num_experiments"].alias("num_experiments"),
        dataset_index.cast("int").alias("dataset_index"),
        model["num_parameters"].alias("num_parameters"),
        model["num_free_parameters"].alias("num_free_parameters"),
        chi_squared.alias("chi_squared"),
        primary_layers(datasets, dataset_index).alias("layers"),
        datasets.alias("datasets"),
        model["model_json"].alias("model_json"),
    ]
