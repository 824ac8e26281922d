"""Layer stacks: building, properties and the views other tables need."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import params
from .text import let

LAYER = (
    "STRUCT<name: STRING, thickness: DOUBLE, thickness_std: DOUBLE, interface: DOUBLE, "
    "interface_std: DOUBLE, material: STRING, sld: DOUBLE, sld_std: DOUBLE, isld: DOUBLE, "
    "isld_std: DOUBLE>"
)
STACK = f"ARRAY<{LAYER}>"


def parsed_layers(parameter: str) -> str:
    """Type of the layers as they are in a model file, with parameters of a type."""
    return (
        f"ARRAY<STRUCT<name: STRING, thickness: {parameter}, interface: {parameter}, "
        f"material: STRUCT<name: STRING, rho: {parameter}, irho: {parameter}>>>"
    )


UNNAMED = "unknown"
# Layer names that say nothing about the material.
GENERIC_NAMES = ("material", "layer", "film")
UNKNOWN_COMPOSITION = "Unknown"
DEFAULT_AMBIENT = "air"


def from_parsed(parsed: Column, parameters: Column) -> Column:
    """Resolved layers from the parsed layers of a model file.

    ``parameters`` are the model's resolved references. The fields of parameters that
    are objects are read for all layers at once, outside the lambda.
    """

    def given(layer: Column) -> list[Column]:
        return [layer["thickness"], layer["interface"], layer["material"]["rho"], layer["material"]["irho"]]

    def build(pair: Column) -> Column:
        layer, objects = pair["layer"], given(pair["objects"])

        def resolved(found: Column) -> Column:
            numbers = []
            for i, name in enumerate(("thickness", "interface", "sld", "isld")):
                value = params.value(given(layer)[i], objects[i], found.getItem(i))
                numbers += [value.alias(name), found.getItem(i)["std"].alias(f"{name}_std")]
            return F.struct(
                F.coalesce(layer["name"], F.lit(UNNAMED)).alias("name"),
                *numbers[:4],
                F.coalesce(layer["material"]["name"], F.lit(UNNAMED)).alias("material"),
                *numbers[4:],
            )

        return let(F.array(*[params.target(fields, parameters) for fields in objects]), resolved)

    objects = parsed.try_cast(parsed_layers(params.OBJECT))
    return F.transform(F.arrays_zip(parsed.alias("layer"), objects.alias("objects")), build)


def select_stack(stack: Column, datasets: Column, index: Column) -> Column:
    """The stack in use (P5): an explicit experiment, else the object's own.

    An index out of range gives an empty stack.
    """
    empty = F.array().cast(STACK)
    chosen = F.coalesce(F.get(datasets, index)["layers"], empty)
    own = F.when(F.size(stack) > 0, stack).otherwise(
        F.coalesce(F.get(datasets, F.lit(0))["layers"], empty)
    )
    return F.when(index.isNotNull(), chosen).otherwise(own)


def first(stack: Column) -> Column:
    return F.get(stack, F.lit(0))


def last(stack: Column) -> Column:
    return F.try_element_at(stack, F.lit(-1))


def ambient(stack: Column) -> Column:
    """First layer if it has no thickness."""
    return F.when(first(stack)["thickness"] == 0, first(stack))


def substrate(stack: Column) -> Column:
    """Last layer if it has no thickness."""
    return F.when(last(stack)["thickness"] == 0, last(stack))


def films(stack: Column) -> Column:
    return F.filter(stack, lambda layer: layer["thickness"] > 0)


def total_thickness(stack: Column) -> Column:
    return F.aggregate(films(stack), F.lit(0.0), lambda total, layer: total + layer["thickness"])


def by_name(stack: Column, name: Column) -> Column:
    """First layer of that name, whatever its case."""
    same = F.filter(stack, lambda layer: F.lower(layer["name"]) == F.lower(name))
    return F.get(same, F.lit(0))


def geometry(stack: Column) -> Column:
    """How the beam meets the stack; null without layers (P25)."""
    return (
        F.when(F.size(stack) == 0, F.lit(None).cast("string"))
        .when(first(stack)["thickness"] == 0, F.lit("back reflection"))
        .when(first(stack).isNotNull(), F.lit("front reflection"))
    )


def above_substrate(stack: Column) -> Column:
    """All layers but a substrate at the end."""
    return F.when(
        last(stack)["thickness"] == 0, F.slice(stack, F.lit(1), F.size(stack) - 1)
    ).otherwise(stack)


def main_composition(stack: Column) -> Column:
    """Material of the thickest layer, the first one on ties (A5)."""
    start = F.struct(F.lit(0.0).alias("thickness"), F.lit(UNKNOWN_COMPOSITION).alias("material"))
    return F.aggregate(
        stack,
        start,
        lambda best, layer: F.when(
            layer["thickness"] > best["thickness"],
            F.struct(layer["thickness"].alias("thickness"), layer["material"].alias("material")),
        ).otherwise(best),
    )["material"]


def sample_layer(layer: Column) -> Column:
    """A layer as the sample table stores it."""
    material = F.struct(
        layer["material"].alias("name"),
        F.lit(None).cast("double").alias("mass"),
        F.lit(None).cast("double").alias("density"),
        layer["sld"].alias("sld"),
        layer["isld"].alias("isld"),
    )
    return F.when(
        layer.isNotNull(),
        F.struct(
            layer["name"].alias("name"),
            material.alias("material"),
            layer["thickness"].alias("thickness"),
            layer["interface"].alias("roughness"),
        ),
    )


def view_for_sample(stack: Column) -> Column:
    """Name, thickness, interface and material of every layer (P10)."""
    return F.transform(
        stack,
        lambda layer: F.struct(
            layer["name"].alias("name"),
            layer["thickness"].alias("thickness"),
            layer["interface"].alias("interface"),
            F.struct(
                layer["material"].alias("composition"),
                layer["sld"].alias("sld"),
                layer["isld"].alias("isld"),
            ).alias("material"),
        ),
    )


def fit_layers(stack: Column) -> Column:
    """Numbered layers with values and uncertainties."""
    return F.transform(
        stack,
        lambda layer, i: F.struct(
            (i + 1).cast("int").alias("layer_number"),
            *[
                layer[name].alias(name)
                for name in (
                    "name",
                    "thickness",
                    "thickness_std",
                    "interface",
                    "interface_std",
                    "sld",
                    "sld_std",
                    "isld",
                    "isld_std",
                )
            ],
        ),
    )


def description(stack: Column) -> Column:
    """``main in ambient on substrate`` in words."""
    base = F.concat(
        main_composition(above_substrate(stack)),
        F.lit(" in "),
        F.coalesce(ambient(stack)["material"], F.lit(DEFAULT_AMBIENT)),
    )
    below = substrate(stack)["material"]
    return F.when(below.isNull(), base).otherwise(F.concat(base, F.lit(" on "), below))


def generic_name_flags(stack: Column) -> Column:
    """Review entries for layers whose names say nothing (D3)."""
    flagged = F.filter(
        F.transform(
            stack,
            lambda layer, i: F.when(
                F.lower(layer["name"]).isin(*GENERIC_NAMES),
                F.struct(
                    F.format_string("layer_%d_name", i).alias("key"),
                    F.format_string(
                        "The name '%s' tells nothing (SLD %.2f, %.1f Å thick)",
                        layer["name"],
                        layer["sld"],
                        layer["thickness"],
                    ).alias("value"),
                ),
            ),
        ),
        lambda entry: entry.isNotNull(),
    )
    return flagged
