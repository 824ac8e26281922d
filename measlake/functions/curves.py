"""Checks and summaries of curve arrays."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Limits below which a curve is reported.
MIN_POINTS = 10
MIN_Q_MAX = 0.01


def _length(values: Column) -> Column:
    return F.coalesce(F.size(values), F.lit(0))


def num_points(q: Column) -> Column:
    return _length(q)


def q_range(q: Column) -> tuple[Column, Column]:
    """Smallest and largest q, zero for an empty curve."""
    return F.coalesce(F.array_min(q), F.lit(0.0)), F.coalesce(F.array_max(q), F.lit(0.0))


def curve_warnings(q: Column, r: Column, dr: Column, dq: Column) -> Column:
    """Messages about unequal lengths, few points and a tiny q range."""
    nq, nr, ndr, ndq = (_length(values) for values in (q, r, dr, dq))
    low, high = F.array_min(q), F.array_max(q)
    return F.array_compact(
        F.array(
            F.when(
                (nq != nr) | (nq != ndr) | (nq != ndq),
                F.format_string(
                    "Columns differ in length: q %d, r %d, dr %d, dq %d", nq, nr, ndr, ndq
                ),
            ),
            F.when(
                nq < MIN_POINTS,
                F.format_string("A curve of only %d points", nq),
            ),
            F.when(
                high < MIN_Q_MAX,
                F.format_string("All q are small: %.4f to %.4f", low, high),
            ),
        )
    )


def array_summary(values: Column, first: int = 0) -> Column:
    """Length and extremes of a numeric array, and as many first values as asked for."""
    return F.when(
        values.isNotNull(),
        F.struct(
            F.size(values).alias("length"),
            F.array_min(values).alias("min"),
            F.array_max(values).alias("max"),
            F.slice(values, 1, first).alias("first_values"),
        ),
    )
