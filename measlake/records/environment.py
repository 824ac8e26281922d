"""Environment records."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..functions import instruments
from ..functions.text import non_empty
from ..operators import issues


def ambient_medium(material: Column) -> Column:
    """The medium around the sample; a record without a model still has the struct."""
    return F.struct(material.alias("name"))


def instrument_description(text: Column, handler: Column) -> Column:
    """The given description, else the instrument's own."""
    return F.coalesce(
        non_empty(text), instruments.default_of(handler, "environment_description")
    )


def record(
    id_: Column,
    description: Column,
    ambient: Column,
    temperature: Column,
    pressure: Column,
    found: Column,
    measurement_ids: Column,
    ingest_time: Column,
) -> list[Column]:
    """Columns of an environment record; ``found`` are the parsed conditions."""
    return [
        id_.alias("id"),
        ingest_time.alias("created_at"),
        description.alias("description"),
        ambient_medium(ambient).alias("ambient_medium"),
        temperature.alias("temperature"),
        pressure.alias("pressure"),
        *[
            found[name].alias(name)
            for name in ("potential", "potential_scale", "control_mode", "electrolyte", "pH")
        ],
        measurement_ids.alias("measurement_ids"),
    ]


def temperature_flag(from_records: Column, temperature: Column, handler: Column) -> Column:
    """Review entry when the logs gave no temperature."""
    return issues.flag(
        from_records & temperature.isNull(),
        "environment_temperature",
        F.format_string("No temperature in the logs (sensors of %s)", handler),
    )
