"""Rows shaped for a document store (K9). Posting them is left to the caller."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Field names of the documents, and the record field they hold.
REFLECTIVITY_FIELDS = {
    "proposal_number": "proposal_number",
    "facility": "facility",
    "instrument": "instrument_name",
    "laboratory": "laboratory",
    "probe": "probe",
    "technique": "technique",
    "technique_description": "technique_description",
    "is_simulated": "is_simulated",
    "run_title": "run_title",
    "run_number": "run_number",
    "run_start": "run_start",
    "raw_file_path": "raw_file_path",
    "q_1_angstrom": "q",
    "r": "r",
    "d_r": "dr",
    "d_q": "dq",
    "measurement_geometry": "measurement_geometry",
    "reduction_time": "reduction_time",
    "reduction_version": "reduction_version",
}
SAMPLE_FIELDS = ("description", "main_composition", "geometry", "layers", "substrate")
ENVIRONMENT_FIELDS = (
    "description",
    "ambient_medium",
    "temperature",
    "pressure",
    "potential",
    "relative_humidity",
)


def capitalised(text: Column) -> Column:
    """First letter upper case, the rest lower case."""
    return F.concat(F.upper(F.left(text, F.lit(1))), F.lower(F.substr(text, F.lit(2))))


def iso_text(time: Column) -> Column:
    """A UTC time in ISO form; microseconds only where there are any."""
    whole = F.date_format(time, "yyyy-MM-dd'T'HH:mm:ss")
    micros = F.pmod(F.unix_micros(time), F.lit(1_000_000))
    fraction = F.when(micros == 0, F.lit("")).otherwise(F.format_string(".%06d", micros))
    return F.concat(whole, fraction, F.lit("+00:00"))


def reflectivity_payload(runs: DataFrame) -> DataFrame:
    special = {
        "technique": capitalised(F.col("technique")),
        "run_start": iso_text(F.col("run_start")),
        "reduction_time": iso_text(F.col("reduction_time")),
    }
    return runs.select(
        *[special.get(name, F.col(source)).alias(name) for name, source in REFLECTIVITY_FIELDS.items()]
    )


def environment_payload(runs: DataFrame, environments: DataFrame) -> DataFrame:
    """Environments, one document per run measured under them."""
    linked = runs.select(F.col("id").alias("_run"), F.col("environment_id").alias("id"))
    return environments.join(linked, "id").select(
        *ENVIRONMENT_FIELDS, F.array("_run").alias("measurements_ids")
    )


def sample_payload(samples: DataFrame) -> DataFrame:
    """Samples, one document per environment they were measured in."""
    rows = samples.select(*SAMPLE_FIELDS, F.explode_outer("environment_ids").alias("_env"))
    return rows.select(*SAMPLE_FIELDS, F.array("_env").alias("environment_ids"))
