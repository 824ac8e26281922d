"""Stable record ids.

A record's id is a digest of what it was made from, so a retried task or a
second action gives the same id, and a parent row can name its children
without collecting them.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

RUN, ENVIRONMENT, SAMPLE, FIT = "run", "environment", "sample", "fit"


def entity_id(kind: str, ingest_id: str, *parts: Column) -> Column:
    """Digest of kind, ingest and natural key, written like a UUID."""
    key = F.concat_ws(
        "|",
        F.lit(kind),
        F.lit(ingest_id),
        *[F.coalesce(part.cast("string"), F.lit("")) for part in parts],
    )
    return F.regexp_replace(
        F.sha2(key, 256),
        "^(.{8})(.{4})(.{4})(.{4})(.{12}).*$",
        "$1-$2-$3-$4-$5",
    )
