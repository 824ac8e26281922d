"""The four output tables and how a DataFrame is conformed to them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.types import (
    ArrayType,
    BooleanType,
    DataType,
    DoubleType,
    IntegerType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

# Names, types and order of the published tables.
S, D, I, B, TS = StringType(), DoubleType(), IntegerType(), BooleanType(), TimestampType()


def _struct(**fields: DataType) -> StructType:
    return StructType([StructField(name, dtype, True) for name, dtype in fields.items()])


def _note(name: str, dtype: DataType, **metadata: str) -> StructField:
    return StructField(name, dtype, True, metadata)


def _plain(names: str, dtype: DataType) -> list[StructField]:
    return [StructField(name, dtype, True) for name in names.split()]


MATERIAL = _struct(name=S, mass=D, density=D, sld=D, isld=D)
LAYER = _struct(name=S, material=MATERIAL, thickness=D, roughness=D)
ELECTROLYTE = _struct(name=S, concentration_M=D)
LAYER_FIT = _struct(
    layer_number=I,
    name=S,
    thickness=D,
    thickness_std=D,
    interface=D,
    interface_std=D,
    sld=D,
    sld_std=D,
    isld=D,
    isld_std=D,
)
DATASET_FIT = _struct(
    dataset_index=I,
    measurement_id=S,
    run_number=S,
    chi_squared=D,
    layers=ArrayType(LAYER_FIT),
)

REFLECTIVITY = StructType(
    _plain("id", S)
    + _plain("created_at", TS)
    + _plain("proposal_number facility laboratory probe technique technique_description", S)
    + [_note("is_simulated", B, description="True for computed curves")]
    + _plain("run_title run_number", S)
    + _plain("run_start", TS)
    + _plain("raw_file_path instrument_name measurement_geometry", S)
    + _plain("reduction_time", TS)
    + _plain("reduction_version", S)
    + [_note("q", ArrayType(D), units="1/angstrom")]
    + _plain("r dr dq", ArrayType(D))
    + _plain("sample_id environment_id", S)
)

SAMPLE = StructType(
    _plain("id", S)
    + _plain("created_at", TS)
    + _plain("description main_composition geometry", S)
    + _plain("environment_ids fit_ids", ArrayType(S))
    + _plain("layers", ArrayType(LAYER))
    + _plain("substrate", LAYER)
    + _plain("publication_ids", ArrayType(S))
)

ENVIRONMENT = StructType(
    _plain("id", S)
    + _plain("created_at", TS)
    + _plain("description", S)
    + _plain("ambient_medium", MATERIAL)
    + _plain("temperature pressure relative_humidity", D)
    + [
        _note(
            "potential",
            D,
            description="Set potential in volts, against potential_scale",
        )
    ]
    + _plain("potential_scale", S)
    + [_note("control_mode", S, description="e.g. open_circuit, potentiostatic, galvanostatic")]
    + _plain("electrolyte", ELECTROLYTE)
    + _plain("pH", D)
    + _plain("measurement_ids", ArrayType(S))
    + _plain("timestamp", TS)
)

REFLECTIVITY_MODEL = StructType(
    _plain("id", S)
    + _plain("created_at", TS)
    + _plain("measurement_ids", ArrayType(S))
    + _plain("sample_id", S)
    + _plain("sample_ids", ArrayType(S))
    + [_note("fit_strategy", S, description="single | single_state_coref | multi_state_coref")]
    + _plain("shared_parameters unshared_parameters", ArrayType(S))
    + _plain("model_name model_file_path software software_version schema_version", S)
    + _plain("num_experiments", I)
    + [
        _note(
            "dataset_index",
            I,
            description="Which experiment of the model the record shows, from 0; "
            "null if there is one only",
        )
    ]
    + _plain("num_parameters num_free_parameters", I)
    + [_note("chi_squared", D, description="Reduced chi squared of the fit")]
    + _plain("layers", ArrayType(LAYER_FIT))
    + _plain("datasets", ArrayType(DATASET_FIT))
    + _plain("model_json", S)
)

TABLES: dict[str, StructType] = {
    "reflectivity": REFLECTIVITY,
    "sample": SAMPLE,
    "environment": ENVIRONMENT,
    "reflectivity_model": REFLECTIVITY_MODEL,
}
ALIASES = {"fit": "reflectivity_model"}


def table_schema(name: str) -> StructType:
    """Schema of a table, by its name or alias."""
    key = ALIASES.get(name, name)
    if key not in TABLES:
        raise ValueError(f"Unknown table {name!r}, expected one of {sorted([*TABLES, *ALIASES])}")
    return TABLES[key]


def detect_table(df: DataFrame) -> str:
    """The table whose declared columns overlap most with the DataFrame's.

    Only columns that occur in exactly one table decide.
    """
    names = {
        t: {f.name for f in s.fields}
        - {f.name for o, other in TABLES.items() if o != t for f in other.fields}
        for t, s in TABLES.items()
    }
    hits = {t: len(own & set(df.columns)) for t, own in names.items()}
    best = max(hits, key=hits.get)
    if hits[best] == 0:
        raise ValueError("Cannot tell which table these columns belong to")
    return best


def conform(df: DataFrame, table: str | StructType) -> DataFrame:
    """Project a DataFrame to a declared schema (K7), field metadata included.

    Columns and struct fields are matched by name: extras are dropped, absent
    ones are null, the rest is cast.
    """
    return df.to(table_schema(table) if isinstance(table, str) else table)
