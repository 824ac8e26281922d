"""Instrument rules as a table (P19, P20, J2, P21 for any number of rules).

``functions.instruments`` compiles a short fixed list into a ``CASE``. Here rules are
rows: ``ord`` (the order in which they are tried), ``name``, ``aliases`` and any further
columns, which are the defaults. The result is the same: an id that is a name or
an alias means that rule, else the first rule with a name or alias contained in the
id, upper and lower case alike, else the generic one.

Containment by itself would compare every id with every rule. So each text of a
rule is filed under one of its grams, the one that fewest rules have, and only ids
with that gram meet it; a text shorter than a gram is filed under itself. Ids are made
distinct first, so a hot id is resolved once. Rules whose texts consist of the
same few grams throughout are still compared with each id that has those.

A rule without a name is none; empty names and aliases mean nothing. Rules without
``ord`` come last; rules of one ``ord`` are tried by name. Rows that agree in both are
one rule with all their aliases and the smallest of their defaults. An id that is
null means the generic rule.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import asdict, fields
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import instruments

GRAM = 3
_LAST = (1 << 63) - 1


def table_of(spark: SparkSession, known: tuple[instruments.Instrument, ...]) -> DataFrame:
    """Rules of a fixed list as a table, in its order."""
    kinds = {"wavelength": "double", "wavelength_spread": "double", "zero_is_missing": "boolean"}
    kinds |= dict.fromkeys(("aliases", "temperature_logs", "pressure_logs"), "array<string>")
    names = [f.name for f in fields(instruments.Instrument)]
    schema = ", ".join(["ord bigint", *[f"{n} {kinds.get(n, 'string')}" for n in names]])
    rows = [
        (n, *[list(v) if isinstance(v, tuple) else v for v in asdict(rule).values()])
        for n, rule in enumerate(known)
    ]
    return spark.createDataFrame(rows, schema)


def _placed(rules: DataFrame) -> DataFrame:
    return rules.filter("name IS NOT NULL").withColumn(
        "_place", F.struct(F.coalesce(F.col("ord").cast("long"), F.lit(_LAST)).alias("ord"), "name")
    )


def texts_of(rules: DataFrame) -> DataFrame:
    """(text, place): names and aliases with their rule's place in the order."""
    named = F.concat(F.array("name"), F.coalesce("aliases", F.array().cast("array<string>")))
    return (
        _placed(rules)
        .select(F.col("_place").alias("place"), F.explode(named).alias("text"))
        .filter("text <> ''")
    )


def _grams(text: Column, size: int) -> Column:
    starts = F.when(F.length(text) >= size, F.sequence(F.lit(1), F.length(text) - size + 1))
    return F.coalesce(
        F.transform(starts, lambda at: F.substr(text, at, F.lit(size))),
        F.array().cast("array<string>"),
    )


def index_of(texts: DataFrame) -> DataFrame:
    """(gram, text, place): every upper-case text once, under its rarest gram."""
    upper = texts.groupBy(F.upper("text").alias("text")).agg(F.min("place").alias("place"))
    own = F.when(F.length("text") < GRAM, F.array("text")).otherwise(
        F.array_distinct(_grams(F.col("text"), GRAM))
    )
    filed = upper.select("text", "place", F.explode(own).alias("gram"))
    common = filed.groupBy("gram").agg(F.count(F.lit(1)).alias("texts"))
    rarest = F.min_by("gram", F.struct("texts", "gram")).alias("gram")
    return filed.join(common, "gram").groupBy("text", "place").agg(rarest)


def places(ids: DataFrame, rules: DataFrame) -> DataFrame:
    """(id, place) of the rule each distinct ``id`` means; ids without one are left out."""
    texts = texts_of(rules)
    exact = ids.join(texts.withColumnRenamed("text", "id"), "id").select(
        "id", F.lit(0).alias("rank"), "place"
    )
    upper = F.upper("id")
    own = F.concat(*[_grams(upper, size) for size in range(1, GRAM + 1)])
    contained = (
        ids.select("id", F.explode(F.array_distinct(own)).alias("gram"))
        .join(index_of(texts), "gram")
        .filter(upper.contains(F.col("text")))
        .select("id", F.lit(1).alias("rank"), "place")
    )
    first = F.min(F.struct("rank", "place"))
    return exact.unionByName(contained).groupBy("id").agg(first["place"].alias("place"))


def _generic(rules: DataFrame, names: list[str], generic: Mapping[str, Any]) -> Column:
    def value(name: str) -> Column:
        given = generic.get(name)
        found = F.array(*map(F.lit, given)) if isinstance(given, (list, tuple)) else F.lit(given)
        return found.cast(rules.schema[name].dataType).alias(name)

    return F.struct(*map(value, names))


def with_rule(
    df: DataFrame,
    id_column: str,
    rules: DataFrame,
    generic: Mapping[str, Any] = asdict(instruments.GENERIC),
    into: str = "rule",
) -> DataFrame:
    """Add the rule each id means: a struct of its name and defaults.

    ``generic`` gives the values of ids that no rule matches; those it lacks are null.
    """
    names = [c for c in rules.columns if c not in ("ord", "aliases")]
    ids = df.select(F.col(id_column).alias("id")).filter("id IS NOT NULL").distinct()
    defaults = _placed(rules).groupBy(F.col("_place").alias("place")).agg(
        F.min(F.struct(*names)).alias("_rule")
    )
    found = places(ids, rules).join(defaults, "place").select(F.col("id").alias("_id"), "_rule")
    # Ids that are null match nothing, so they are kept out of the join.
    known = df.filter(F.col(id_column).isNotNull())
    known = known.join(found, F.col(id_column) == F.col("_id"), "left").drop("_id")
    unknown = df.filter(F.col(id_column).isNull()).withColumn("_rule", F.lit(None))
    joined = known.unionByName(unknown)
    rule = F.coalesce("_rule", _generic(rules, names, generic))
    return joined.withColumn(into, rule).drop("_rule")


def values_by_rule(
    runs: DataFrame,
    logs: DataFrame,
    keys: list[str],
    names: Column,
    zero_is_missing: Column,
    order: list[str],
    prefer_average: bool = True,
) -> DataFrame:
    """Value of each run's first usable log, by the names of its own rule; a row per run with one.

    ``names`` is an array of log names by preference. The first record of a name counts. First
    records combine before the shuffle, and names that no run asks for are left out before it.
    """
    wanted = runs.select(*keys, zero_is_missing.alias("_zero"), F.posexplode(names).alias("_pos", "log_name"))
    record = F.struct(*order, "average_value", "value_numeric")
    asked = logs.join(wanted.select("log_name").distinct(), "log_name", "left_semi")
    firsts = asked.groupBy(*keys, "log_name").agg(F.min(record).alias("_first"))
    value = instruments.log_value(F.col("_first"), prefer_average)
    value = F.when(F.coalesce("_zero", F.lit(False)), F.nullif(value, F.lit(0.0))).otherwise(value)
    usable = firsts.join(wanted, [*keys, "log_name"]).withColumn("_value", value)
    usable = usable.filter("_value IS NOT NULL")
    return usable.groupBy(*keys).agg(F.min_by("_value", "_pos").alias("value"))
