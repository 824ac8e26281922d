"""How well the fields of a table are filled, and what went into it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def leaves(schema: StructType, prefix: str = "") -> list[str]:
    """Dotted names of all fields, going into structs but not into arrays."""
    names = []
    for field in schema.fields:
        name = f"{prefix}{field.name}"
        if isinstance(field.dataType, StructType):
            names.extend(leaves(field.dataType, f"{name}."))
        else:
            names.append(name)
    return names


def value_of(name: str) -> Column:
    return F.col(".".join(f"`{part}`" for part in name.split(".")))


def profile(df: DataFrame) -> DataFrame:
    """One row per field: rows with and without a value, and the share filled.

    A single aggregation over the table; an empty list counts as filled.
    """
    names = leaves(df.schema)
    counted = df.agg(
        F.count(F.lit(1)).alias("_rows"),
        *[F.count(value_of(name)).alias(f"_{i}") for i, name in enumerate(names)],
    )
    rows = F.explode(
        F.array(
            *[
                F.struct(
                    F.lit(name).alias("field"), F.col(f"_{i}").cast("bigint").alias("populated")
                )
                for i, name in enumerate(names)
            ]
        )
    )
    share = F.round(100 * F.try_divide(F.col("populated"), F.col("_rows")), 1)
    return (
        counted.select("_rows", rows.alias("_f"))
        .select("_rows", "_f.*")
        .select(
            "field",
            "populated",
            (F.col("_rows") - F.col("populated")).alias("missing"),
            F.coalesce(share, F.lit(0.0)).alias("coverage_pct"),
        )
    )


def record_coverage(df: DataFrame) -> Column:
    """Per record: filled and missing fields, share filled, names missing.

    A struct that is null counts as one missing field.
    """

    def entries(schema: StructType, prefix: str = "") -> list[Column]:
        found = []
        for field in schema.fields:
            name = f"{prefix}{field.name}"
            parent = value_of(prefix[:-1]) if prefix else None
            if isinstance(field.dataType, StructType):
                whole = F.when(value_of(name).isNull(), F.struct(F.lit(name).alias("f"), F.lit(False).alias("ok")))
                found.append(whole if parent is None else F.when(parent.isNotNull(), whole))
                found.extend(entries(field.dataType, f"{name}."))
            else:
                entry = F.struct(F.lit(name).alias("f"), value_of(name).isNotNull().alias("ok"))
                found.append(entry if parent is None else F.when(parent.isNotNull(), entry))
        return found

    listed = F.array_compact(F.array(*entries(df.schema)))
    filled = F.size(F.filter(listed, lambda x: x["ok"]))
    missing = F.transform(F.filter(listed, lambda x: ~x["ok"]), lambda x: x["f"])
    return F.struct(
        filled.alias("populated_fields"),
        F.size(missing).alias("missing_fields"),
        F.round(100 * F.try_divide(filled, F.size(listed)), 1).alias("coverage_pct"),
        missing.alias("missing_field_names"),
    )


def names_per_key(
    logs: DataFrame, keys: list[str], name: str, limit: int | None = None
) -> DataFrame:
    """Every distinct name of every key, a row each, with the key's ``name_count``.

    Names are made distinct by aggregation and counted from there. Only a given
    ``limit`` keeps the first names in order; its window drops the others before
    its shuffle.
    """
    distinct = logs.select(*keys, name).where(
        " AND ".join(f"`{c}` IS NOT NULL" for c in [*keys, name])
    ).distinct()
    counts = distinct.groupBy(*keys).agg(F.count(F.lit(1)).alias("name_count"))
    listed = distinct
    if limit is not None:
        order = Window.partitionBy(*keys).orderBy(name)
        listed = distinct.withColumn("_n", F.row_number().over(order)).where(F.col("_n") <= limit)
        listed = listed.drop("_n")
    return listed.join(counts, keys)


# Header fields whose presence a source summary reports.
HEADER_FIELDS = (
    "experiment_id",
    "run_number",
    "run_title",
    "run_start_time",
    "reduction_time",
    "reduction_version",
)


def header_fields(curve: Column) -> list[Column]:
    """Names of the header fields with and without a value."""

    def pick(wanted: bool) -> Column:
        return F.array_compact(
            F.array(
                *[
                    F.when(
                        curve[name].isNotNull() if wanted else curve[name].isNull(), F.lit(name)
                    )
                    for name in HEADER_FIELDS
                ]
            )
        )

    return [pick(True).alias("fields_with_data"), pick(False).alias("fields_missing")]
