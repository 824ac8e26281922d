"""Sample records."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..functions import layers
from ..functions.text import non_empty


def record(
    id_: Column,
    stack: Column,
    description: Column,
    environment_ids: Column,
    fit_ids: Column,
    ingest_time: Column,
) -> list[Column]:
    """Columns of a sample record built from a layer stack.

    A given description replaces the one derived from the layers.
    """
    return [
        id_.alias("id"),
        ingest_time.alias("created_at"),
        F.coalesce(non_empty(description), layers.description(stack)).alias("description"),
        layers.main_composition(layers.above_substrate(stack)).alias("main_composition"),
        environment_ids.alias("environment_ids"),
        fit_ids.alias("fit_ids"),
        F.transform(layers.above_substrate(stack), layers.sample_layer).alias("layers"),
        layers.sample_layer(layers.substrate(stack)).alias("substrate"),
        F.array().cast("array<string>").alias("publication_ids"),
    ]
