"""Experimental conditions from a free-text description."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import capture_text

# What counts as a condition in a description.
_OPEN_CIRCUIT = r"(?iU)\bOCV\b|\bOCP\b|open[\s-]?circuit"
_POTENTIAL = r"(?U)([+\-−]?\d+(?:\.\d+)?)\s*V\b"
_ACIDITY = r"(?iU)\bpH\s*=?\s*(\d+(?:\.\d+)?)"
_ELECTROLYTE = r"(?U)(\d+(?:\.\d+)?)\s*M\s+([A-Za-z][A-Za-z0-9()]*)"
# Reference scales, first match wins. Acronyms are case-sensitive.
_SCALES = (
    (r"(?U)\bRHE\b", "RHE"),
    (r"(?U)\bSHE\b", "SHE"),
    (r"(?U)\bNHE\b", "SHE"),
    (r"(?U)\bSCE\b", "SCE"),
    (r"(?iU)Ag\s*/\s*AgCl", "Ag/AgCl"),
    (r"(?iU)Hg\s*/\s*HgSO4", "Hg/HgSO4"),
    (r"(?iU)Hg\s*/\s*HgO", "Hg/HgO"),
)
_DEFAULT_SCALE = "SHE"


def _scale(text: Column) -> Column:
    pick = F
    for pattern, name in _SCALES:
        pick = pick.when(text.rlike(pattern), F.lit(name))
    return pick.otherwise(F.lit(_DEFAULT_SCALE))


def conditions(text: Column) -> Column:
    """Struct of control mode, potential, scale, pH and electrolyte.

    Open circuit wins over a quoted potential. Fields that do not occur in the
    text are null.
    """
    is_open = F.coalesce(text.rlike(_OPEN_CIRCUIT), F.lit(False))
    volts = F.when(~is_open, capture_text(text, _POTENTIAL))
    molar = capture_text(text, _ELECTROLYTE, 1)
    return F.struct(
        F.when(is_open, F.lit("open_circuit"))
        .when(volts.isNotNull(), F.lit("potentiostatic"))
        .alias("control_mode"),
        F.translate(volts, "−", "-").try_cast("double").alias("potential"),
        F.when(volts.isNotNull(), _scale(text)).alias("potential_scale"),
        capture_text(text, _ACIDITY).try_cast("double").alias("pH"),
        F.when(
            molar.isNotNull(),
            F.struct(
                capture_text(text, _ELECTROLYTE, 2).alias("name"),
                molar.try_cast("double").alias("concentration_M"),
            ),
        ).alias("electrolyte"),
    )
