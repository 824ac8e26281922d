"""Related files of every run at once."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import names
from ..operators import fileset
from ..operators.first_record import first_record
from ..sources import files


def discover(catalog: DataFrame) -> tuple[DataFrame, DataFrame]:
    """File sets by run, and the identified files they come from.

    ``catalog`` has ``path``, ``content`` and ``root_ord``. A file found below
    two search paths counts once, for the earlier one; by then its text has
    been reduced to a few columns.
    """
    found = first_record(fileset.identified(catalog), ["path"], ["root_ord"])
    return fileset.fileset(found), found


def discover_under(spark: SparkSession, roots: list[str]) -> tuple[DataFrame, DataFrame]:
    """As ``discover``, over the files below the search paths."""
    return discover(files.with_texts(spark, roots))


def discover_kept(catalog: DataFrame) -> tuple[DataFrame, DataFrame]:
    """As ``discover``, over a kept catalog, whose files are identified already; no text is read."""
    found = fileset.with_slots(catalog)
    return fileset.fileset(found), found


def related_to(sets: DataFrame, known: DataFrame) -> DataFrame:
    """File sets of the runs that some known files belong to."""
    number: Column = names.run_number(F.col("path"))
    runs = known.select(number.alias("run_number")).dropna()
    return sets.join(runs, "run_number", "left_semi")
