"""The files that belong to a run."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import names
from .rows import once

# Single-file slots in listing order and completeness weights.
SLOTS = (
    "reduced_file",
    "raw_file",
    "model_file",
    "metadata_parquet",
    "sample_parquet",
    "users_parquet",
    "daslogs_parquet",
    "instrument_parquet",
)
WEIGHTS = {
    "reduced_file": 0.30,
    "metadata_parquet": 0.25,
    "sample_parquet": 0.15,
    "model_file": 0.15,
    "daslogs_parquet": 0.10,
    "users_parquet": 0.05,
}


def identified(files: DataFrame) -> DataFrame:
    """Files with kind, run, proposal, instrument and slot.

    ``files`` has ``path``, ``content`` (null unless the kind depends on it)
    and ``root_ord``. A file counts for a run only if its own name holds the
    run number, not just its folder's.
    """
    info = names.identify(F.col("path"), F.col("content"))
    found = once(
        files.select("path", "content", "root_ord"),
        info,
        "file_type",
        "run_number",
        "proposal",
        "instrument",
    )
    return with_slots(found)


def with_slots(found: DataFrame) -> DataFrame:
    """Identified files with their slot."""
    name = names.file_name(F.col("path"))
    return found.select(
        "path",
        "root_ord",
        "file_type",
        "run_number",
        "proposal",
        "instrument",
        names.file_slot(F.col("file_type"), name).alias("slot"),
        F.contains(name, F.col("run_number").cast("string")).alias("named_after_run"),
    )


def fileset(found: DataFrame) -> DataFrame:
    """One row per run: first file of every slot, counts and completeness.

    "First" is by search path, then path. Further Parquet files stay rows of
    ``found``; here they are only counted.
    """
    order = F.struct("root_ord", "path")

    def first_in(slot: str) -> Column:
        here = F.col("slot") == slot
        return F.min(F.when(here, order))["path"].alias(slot)

    related = found.filter(F.col("named_after_run") & F.col("slot").isNotNull())
    sets = related.groupBy("run_number").agg(
        F.min("proposal").alias("proposal"),
        *[first_in(slot) for slot in SLOTS],
        F.count_if(F.col("slot") == names.OTHER_SLOT).alias("other_parquet_count"),
    )
    return sets.select(
        "*",
        completeness().alias("completeness"),
        parquet_dir().alias("parquet_dir"),
        *[
            F.col(slot).isNotNull().alias(flag)
            for flag, slot in (
                ("has_reduced", "reduced_file"),
                ("has_model", "model_file"),
                ("has_parquet_metadata", "metadata_parquet"),
            )
        ],
    )


def completeness() -> Column:
    """Weighted share of the slots that are filled."""
    return F.round(
        sum(
            (F.when(F.col(s).isNotNull(), F.lit(w)).otherwise(F.lit(0.0)) for s, w in WEIGHTS.items()),
            F.lit(0.0),
        ),
        2,
    )


def parquet_dir() -> Column:
    """Folder of the first Parquet file available."""
    return F.coalesce(
        *[names.parent_dir(F.col(s)) for s in ("metadata_parquet", "sample_parquet", "daslogs_parquet")]
    )


def available_files(sets: DataFrame, found: DataFrame) -> DataFrame:
    """Long list of a run's files: ``slot_ord``, ``slot``, ``path``."""
    listed = F.array(
        *[
            F.struct(F.lit(i).alias("slot_ord"), F.lit(s).alias("slot"), F.col(s).alias("path"))
            for i, s in enumerate(SLOTS)
        ]
    )
    singles = sets.select("run_number", F.explode(listed).alias("f")).select("run_number", "f.*")
    others = found.filter(F.col("named_after_run") & (F.col("slot") == names.OTHER_SLOT)).select(
        "run_number", F.lit(len(SLOTS)).alias("slot_ord"), "slot", "path"
    )
    return singles.dropna(subset=["path"]).unionByName(others)
