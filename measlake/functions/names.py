"""What file names and texts say: kind, run, proposal, instrument."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import capture_text

# Naming patterns of measurement files, in order of preference.
_RUN_IN_NAME = (r"(?iU)REFL_(\d+)", r"(?iU)REF_L_(\d+)", r"(?U)[_-](\d{5,7})[_.-]")
_RUN_IN_PATH = r"(?U)[_-](\d{5,7})[_.-]"
_RUN_OF_CURVE_FILE = (r"(?iU)REF[L_]*_?(\d{5,7})", r"(?U)(\d{6})")
_PROPOSAL_IN_PATH = r"(?iU)(IPTS-\d+)"
_PROPOSAL_IN_TEXT = r"(?iU)IPTS[- ]?(\d+)"
_INSTRUMENT_IN_PATH = r"(?i)REF[_-]?L"
INSTRUMENT_NAME = "REF_L"
# Marks of a fit model and of a measured curve, within the text and the name.
MODEL_SCHEMA, MODEL_TOOL = '"$schema"', "bumps"
MODEL_PARTS = ('"sample"', '"layers"')
MODEL_LIBRARY = "refl1d"
CURVE_EXPERIMENT = ("# Experiment", "# IPTS")
CURVE_Q, CURVE_Q_BARE = "Q [1/Angstrom]", "Q(1/A)"
CURVE_REDUCTION = "Reduction"
CURVE_NAMES = ("combined_data", "refl_")

REDUCED, RAW_HDF5, PARQUET, MODEL, UNKNOWN = "reduced", "raw_hdf5", "parquet", "model", "unknown"


# Both patterns begin where a segment does and never give back what they took of it;
# tried at every character, a name of n characters costs its square.
def file_name(path: Column) -> Column:
    return F.regexp_extract(path, r"(?<![^/])([^/]*+)/*$", 1)


def parent_dir(path: Column) -> Column:
    return F.regexp_replace(path, r"(?<!/)/++[^/]*+$", "")


def suffix(path: Column) -> Column:
    """Lower-case extension with its dot, empty for dot files and bare names."""
    return F.lower(F.regexp_extract(file_name(path), r"^.+?(\.[^.]+)$", 1))


def run_number(path: Column) -> Column:
    """Run number as the file finder reads it: by name first, then by path."""
    name = file_name(path)
    found = [capture_text(name, pattern) for pattern in _RUN_IN_NAME]
    return F.coalesce(*found, capture_text(path, _RUN_IN_PATH)).try_cast("bigint")


def run_number_of_curve_file(name: Column) -> Column:
    """Run number as the curve reader reads it; differs from ``run_number``."""
    return F.coalesce(*[capture_text(name, p) for p in _RUN_OF_CURVE_FILE]).try_cast("bigint")


def proposal(path: Column, content: Column | None = None) -> Column:
    found = F.upper(capture_text(path, _PROPOSAL_IN_PATH))
    if content is None:
        return found
    number = capture_text(content, _PROPOSAL_IN_TEXT)
    return F.coalesce(found, F.concat(F.lit("IPTS-"), number))


def instrument_of_path(path: Column) -> Column:
    return F.when(path.rlike(_INSTRUMENT_IN_PATH), F.lit(INSTRUMENT_NAME))


def _json_kind(content: Column) -> Column:
    low = F.lower(content)
    is_model = (
        (content.contains(MODEL_SCHEMA) & low.contains(MODEL_TOOL))
        | (content.contains(MODEL_PARTS[0]) & content.contains(MODEL_PARTS[1]))
        | low.contains(MODEL_LIBRARY)
    )
    return F.when(is_model, F.lit(MODEL)).otherwise(F.lit(UNKNOWN))


def _text_kind(name: Column, content: Column) -> Column:
    without_spaces = F.replace(content, F.lit(" "), F.lit(""))
    signs = (
        content.contains(CURVE_EXPERIMENT[0]) | content.contains(CURVE_EXPERIMENT[1]),
        content.contains(CURVE_Q) | without_spaces.contains(CURVE_Q_BARE),
        content.contains(CURVE_REDUCTION),
        *[F.lower(name).contains(mark) for mark in CURVE_NAMES],
    )
    seen = sum((F.coalesce(sign, F.lit(False)).cast("int") for sign in signs), F.lit(0))
    return F.when(seen >= 2, F.lit(REDUCED)).otherwise(F.lit(UNKNOWN))


def file_kind(path: Column, content: Column) -> Column:
    """Kind of a file by suffix, and by its whole text where that is open."""
    ext, name = suffix(path), file_name(path)
    return (
        F.when(ext == ".parquet", F.lit(PARQUET))
        .when(ext.isin(".h5", ".hdf5"), F.lit(RAW_HDF5))
        .when(ext == ".json", _json_kind(content))
        .when(ext == ".txt", _text_kind(name, content))
        .otherwise(F.lit(UNKNOWN))
    )


def identify(path: Column, content: Column) -> Column:
    """Struct of kind, run, proposal and instrument of one file."""
    kind = file_kind(path, content)
    text = F.when(kind == REDUCED, content)
    return F.struct(
        kind.alias("file_type"),
        run_number(path).alias("run_number"),
        proposal(path, text).alias("proposal"),
        instrument_of_path(path).alias("instrument"),
    )


# Slots of a file set and the name parts that select them, in order.
PARQUET_SLOTS = (
    ("metadata", "metadata_parquet"),
    ("sample", "sample_parquet"),
    ("user", "users_parquet"),
    ("daslog", "daslogs_parquet"),
    ("instrument", "instrument_parquet"),
)
OTHER_SLOT = "other_parquet"
KIND_SLOTS = ((REDUCED, "reduced_file"), (RAW_HDF5, "raw_file"), (MODEL, "model_file"))


def file_slot(kind: Column, name: Column) -> Column:
    """Slot a file takes in its run's file set, null for unknown kinds."""
    low = F.lower(name)
    slot = F
    for part, target in PARQUET_SLOTS:
        slot = slot.when(low.contains(part), F.lit(target))
    pick = F.when(kind == PARQUET, slot.otherwise(F.lit(OTHER_SLOT)))
    for value, target in KIND_SLOTS:
        pick = pick.when(kind == value, F.lit(target))
    return pick
