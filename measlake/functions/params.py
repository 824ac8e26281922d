"""Fit parameters: numbers, value objects or references.

A map is searched key by key, so that a model with as many parameters as
references would cost their product. Larger maps are looked up in an array of
their entries sorted by key, by halving.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import let

# Fields of a parameter, of a reference and of an error entry.
_SLOT = "slot: STRUCT<value: STRING>, value: STRING"
REFERENCES = f"MAP<STRING, STRUCT<name: STRING, fixed: STRING, std: STRING, {_SLOT}>>"
ERRORS = "MAP<STRING, STRUCT<std: STRING>>"
_REFERENCE_CLASS = "Reference"
OBJECT = f"STRUCT<__class__: STRING, id: STRING, {_SLOT}>"
# A map of up to this size is quicker to search than to sort.
SEARCHED = 32


def index(entries: Column) -> Column:
    """A map, prepared once for many lookups."""
    sorted_entries = F.sort_array(F.map_entries(entries))
    halvings = F.ceil(F.log2(F.size(entries) + F.lit(1.0))).cast("int")
    large = F.size(entries) > SEARCHED
    return F.struct(
        entries.alias("entries"),
        F.when(large, sorted_entries).alias("sorted"),
        F.when(large, F.sequence(F.lit(1), halvings)).alias("steps"),
    )


def find(indexed: Column, key: Column) -> Column:
    """The value of a key, null if it is not there."""
    entries, steps = indexed["sorted"], indexed["steps"]

    def halved(wanted: Column) -> Column:
        def step(state: Column, _: Column) -> Column:
            middle = F.floor((state["low"] + state["high"]) / 2).cast("int")
            below = (state["low"] < state["high"]) & (F.get(entries, middle)["key"] < wanted)
            return F.struct(
                F.when(below, middle + 1).otherwise(state["low"]).alias("low"),
                F.when(below, state["high"]).otherwise(middle).alias("high"),
            )

        start = F.struct(F.lit(0).alias("low"), F.size(entries).alias("high"))
        place = F.aggregate(steps, start, step, lambda state: state["low"])
        return let(F.get(entries, place), lambda e: F.when(e["key"] == wanted, e["value"]))

    return F.when(entries.isNull(), F.try_element_at(indexed["entries"], key)).otherwise(let(key, halved))


def _number(text: Column) -> Column:
    return F.when(text == "true", F.lit(1.0)).otherwise(text.try_cast("double"))


def is_free(reference: Column) -> Column:
    """Whether a referenced parameter was fitted. Unmarked ones are fixed."""
    return F.coalesce(reference["fixed"], F.lit("true")).isin("false", "0", "")


def free_count(references: Column) -> Column:
    return F.size(F.filter(F.map_values(references), is_free))


def _resolved(text: Column, std: Column) -> Column:
    return F.struct(
        F.coalesce(_number(text), F.lit(0.0)).alias("value"), std.try_cast("double").alias("std")
    )


def _own_value(entry: Column) -> Column:
    return F.coalesce(entry["slot"]["value"], entry["value"])


def resolve_references(references: Column, errors: Column) -> Column:
    """Map from reference id to its ``value`` and ``std``, once per model.

    A reference's own ``std`` wins over the error file, which is keyed by
    parameter name and comes as an ``index``. Fixed parameters have none.
    """

    def entry(_: Column, ref: Column) -> Column:
        listed = find(errors, F.coalesce(ref["name"], F.lit("")))["std"]
        return _resolved(
            _own_value(ref), F.when(is_free(ref), F.coalesce(ref["std"], listed))
        )

    return F.transform_values(references, entry)


def target(fields: Column, resolved: Column) -> Column:
    """What a reference, given by its fields, points to among the resolved ones, an ``index``."""
    return F.when(fields["__class__"] == _REFERENCE_CLASS, find(resolved, fields["id"]))


def value(param: Column, fields: Column, found: Column) -> Column:
    """Value of a parameter: a variant, its fields if it is an object, and its ``target``.

    An unknown reference and any other object give their own value. A quoted number
    is a text, which alone can be read as bytes, and a text counts as zero.
    """
    own = F.coalesce(found["value"], _number(_own_value(fields)), F.lit(0.0))
    quoted = F.try_variant_get(param, "$", "binary").isNotNull()
    plain = F.when(quoted, F.lit(0.0)).otherwise(
        F.coalesce(F.try_variant_get(param, "$", "double"), F.lit(0.0))
    )
    return F.when(fields.isNotNull(), own).when(param.isNull(), F.lit(0.0)).otherwise(plain)


def resolve(param: Column, resolved: Column) -> Column:
    """Struct of ``value`` and ``std`` of a parameter given as a variant.

    Only references have a ``std``.
    """

    def of_fields(fields: Column) -> Column:
        def of_target(found: Column) -> Column:
            return F.struct(value(param, fields, found).alias("value"), found["std"].alias("std"))

        return let(target(fields, resolved), of_target)

    return let(F.try_variant_get(param, "$", OBJECT), of_fields)
