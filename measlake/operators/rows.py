"""Row-level helpers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def once(df: DataFrame, value: Column, *fields: str) -> DataFrame:
    """Add the fields of a struct, evaluating it once per row.

    A generator is a boundary the optimizer does not copy expressions across.
    """
    return df.select("*", F.inline(F.array(value))).select(*df.columns, *fields)
