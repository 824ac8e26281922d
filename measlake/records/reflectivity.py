"""Run records."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..functions import curves, instruments, layers, names
from ..functions.text import iso_time, non_empty
from ..operators import issues

UNKNOWN = "Unknown"


def identity(curve: Column, meta: Column, ingest_time: Column) -> Column:
    """Proposal, number, title, start, raw file and instrument of a run.

    With a metadata record that record decides, only the title may come from
    the header. Without one the Meta block comes first, then the header lines.
    """
    block = curve["meta_fields"]
    has_meta = meta.isNotNull()

    def choose(with_meta: Column, without: Column) -> Column:
        return F.when(has_meta, with_meta).otherwise(without)

    header_number = F.nullif(curve["run_number"], F.lit(0)).cast("string")
    return F.struct(
        F.coalesce(
            choose(
                non_empty(meta["experiment_identifier"]),
                F.coalesce(block["experiment"], curve["experiment_id"]),
            ),
            F.lit(UNKNOWN),
        ).alias("proposal_number"),
        F.coalesce(
            choose(meta["run_number"].cast("string"), F.coalesce(block["run_number"], header_number)),
            F.lit(UNKNOWN),
        ).alias("run_number"),
        F.coalesce(
            choose(non_empty(meta["title"]), block["run_title"]),
            non_empty(curve["run_title"]),
            F.lit(UNKNOWN),
        ).alias("run_title"),
        F.coalesce(
            choose(
                iso_time(meta["start_time"]),
                F.coalesce(iso_time(block["start_time"]), curve["run_start_time"]),
            ),
            ingest_time,
        ).alias("run_start"),
        F.when(has_meta, meta["source_path"]).alias("raw_file_path"),
        choose(
            meta["instrument_id"],
            F.coalesce(names.instrument_of_path(curve["path"]), F.lit(UNKNOWN)),
        ).alias("instrument"),
    )


def identity_warnings(curve: Column, meta: Column, who: Column) -> list[Column]:
    """Messages about a start time that is missing or unreadable, and the proposal."""
    block_start = curve["meta_fields"]["start_time"]
    has_meta = meta.isNotNull()
    given = non_empty(meta["start_time"])
    return [
        F.when(
            has_meta & given.isNotNull() & iso_time(given).isNull(),
            F.concat(F.lit("Start time cannot be read: "), given),
        ),
        F.when(
            has_meta & given.isNull(), F.lit("No start time; the ingest time stands in")
        ),
        F.when(
            ~has_meta & block_start.isNotNull() & iso_time(block_start).isNull(),
            F.concat(F.lit("Start time of the header cannot be read: "), block_start),
        ),
        F.when(
            ~has_meta & (who["proposal_number"] == UNKNOWN),
            F.lit("No proposal number; 'Unknown' stands in"),
        ),
    ]


def record(
    id_: Column,
    curve: Column,
    who: Column,
    geometry: Column,
    raw_override: Column,
    sample_id: Column,
    environment_id: Column,
    ingest_time: Column,
) -> list[Column]:
    """The 23 columns of a run record."""
    handler = instruments.resolve(who["instrument"])

    def default(attribute: str) -> Column:
        return instruments.default_of(handler, attribute).alias(attribute)

    return [
        id_.alias("id"),
        ingest_time.alias("created_at"),
        who["proposal_number"].alias("proposal_number"),
        default("facility"),
        default("laboratory"),
        default("probe"),
        default("technique"),
        default("technique_description"),
        F.lit(False).alias("is_simulated"),
        who["run_title"].alias("run_title"),
        who["run_number"].alias("run_number"),
        who["run_start"].alias("run_start"),
        F.coalesce(non_empty(raw_override), who["raw_file_path"]).alias("raw_file_path"),
        who["instrument"].alias("instrument_name"),
        geometry.alias("measurement_geometry"),
        curve["reduction_time"].alias("reduction_time"),
        curve["reduction_version"].alias("reduction_version"),
        *[curve[c].alias(c) for c in ("q", "r", "dr", "dq")],
        sample_id.alias("sample_id"),
        environment_id.alias("environment_id"),
    ]


def warnings(curve: Column, meta: Column, who: Column) -> Column:
    """All messages of one run record, in the order the steps happen."""
    return F.concat(
        issues.messages(*identity_warnings(curve, meta, who)),
        curves.curve_warnings(curve["q"], curve["r"], curve["dr"], curve["dq"]),
    )


def geometry_flag(geometry: Column) -> Column:
    return issues.flag(
        geometry.isNull(),
        "measurement_geometry",
        "No model, so no geometry",
    )


def geometry_of(stack: Column) -> Column:
    return layers.geometry(stack)
