"""Manifests: one job per sample with its ordered measurements."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import non_empty, not_json
from ..operators import issues

# Fields of a manifest.
MEASUREMENT = (
    "STRUCT<name: STRING, reduced: STRING, parquet: STRING, nexus_file: STRING, "
    "model: STRING, model_dataset_index: INT, environment: STRING>"
)
MANIFEST = (
    "title STRING, output STRING, "
    "sample STRUCT<description: STRING, model: STRING, model_dataset_index: INT>, "
    f"measurements ARRAY<{MEASUREMENT}>"
)


def parse(texts: DataFrame) -> DataFrame:
    """Manifest documents as rows: ``job`` is the document's path."""
    m = F.from_json("content", MANIFEST, {"mode": "PERMISSIVE"})
    broken = F.col("content").isNull() | not_json(F.col("content"))
    return texts.select(
        F.col("path").alias("job"), broken.alias("malformed"), m.alias("m")
    ).select("job", "malformed", "m.*")


def _with_names(measurements: Column) -> Column:
    """Measurements with the default name and an empty curve path filled in."""
    return F.transform(
        F.coalesce(measurements, F.array().cast(f"ARRAY<{MEASUREMENT}>")),
        lambda m, i: F.struct(
            F.coalesce(m["name"], F.format_string("Measurement %d", i + 1)).alias("name"),
            F.coalesce(m["reduced"], F.lit("")).alias("reduced"),
            *[non_empty(m[c]).alias(c) for c in ("parquet", "nexus_file", "model")],
            m["model_dataset_index"].alias("model_dataset_index"),
            m["environment"].alias("environment"),
        ),
    )


def normalise(manifests: DataFrame) -> DataFrame:
    """Manifests with defaults applied (S16). Ones given as a table are never malformed."""
    if "malformed" not in manifests.columns:
        manifests = manifests.withColumn("malformed", F.lit(False))
    return manifests.select(
        "job",
        "malformed",
        "title",
        F.coalesce("output", F.lit("")).alias("output"),
        F.struct(
            F.col("sample.description").alias("description"),
            non_empty(F.col("sample.model")).alias("model"),
            F.col("sample.model_dataset_index").alias("model_dataset_index"),
        ).alias("sample"),
        _with_names(F.col("measurements")).alias("measurements"),
    )


def measurements(manifests: DataFrame) -> DataFrame:
    """One row per measurement: ``job``, ``pos`` and its fields."""
    return manifests.select("job", F.posexplode("measurements").alias("pos", "m")).select(
        "job", "pos", "m.*"
    )


def _bad_index(index: Column) -> Column:
    return index.isNotNull() & (index < 1)


def field_errors(manifests: DataFrame) -> DataFrame:
    """Errors that need no look at the files: ``job``, ``pos``, ``rank``, ``message``.

    ``pos`` is -2 for the manifest and -1 for its sample section.
    """

    def entry(pos: int, rank: int, condition: Column, text: str) -> Column:
        return F.when(
            condition,
            F.struct(
                F.lit(pos).alias("pos"), F.lit(rank).alias("rank"), F.lit(text).alias("message")
            ),
        )

    whole = issues.messages(
        entry(-2, 0, F.col("output") == "", "No output folder is given"),
        entry(-2, 1, F.size("measurements") == 0, "There are no measurements"),
        entry(
            -1,
            1,
            _bad_index(F.col("sample.model_dataset_index")),
            "The sample's dataset index counts from 1",
        ),
    )

    def measured(m: Column, i: Column) -> Column:
        lead = F.concat(F.lit("Measurement '"), m["name"], F.lit("': "))

        def own(rank: int, condition: Column, text: str) -> Column:
            return F.when(
                condition,
                F.struct(
                    i.alias("pos"),
                    F.lit(rank).alias("rank"),
                    F.concat(lead, F.lit(text)).alias("message"),
                ),
            )

        return issues.messages(
            own(0, m["reduced"] == "", "no curve file is named"),
            own(3, _bad_index(m["model_dataset_index"]), "the dataset index counts from 1"),
        )

    every = F.when(
        F.col("malformed"),
        issues.messages(entry(-2, 0, F.lit(True), "The manifest is not JSON")),
    ).otherwise(F.concat(whole, F.flatten(F.transform("measurements", measured))))
    return manifests.select("job", F.explode(every).alias("e")).select("job", "e.*")


def referenced_paths(manifests: DataFrame) -> DataFrame:
    """Every path a manifest names, with the message for a missing one."""
    of_sample = manifests.select(
        "job",
        F.lit(-1).alias("pos"),
        F.lit(0).alias("rank"),
        F.col("sample.model").alias("path"),
        F.concat(F.lit("There is no model of the sample: "), F.col("sample.model")).alias("message"),
    )
    m = measurements(manifests)
    lead = F.concat(F.lit("Measurement '"), F.col("name"), F.lit("': "))

    def named(rank: int, column: str, text: str) -> Column:
        return F.struct(
            F.lit(rank).alias("rank"),
            F.col(column).alias("path"),
            F.concat(lead, F.lit(text), F.col(column)).alias("message"),
        )

    of_measurements = m.select(
        "job",
        "pos",
        F.explode(
            F.array(
                named(0, "reduced", "there is no curve "),
                named(1, "parquet", "there is no folder "),
                named(2, "model", "there is no model "),
            )
        ).alias("p"),
    ).select("job", "pos", "p.*")
    return of_sample.unionByName(of_measurements).filter(
        F.col("path").isNotNull() & (F.col("path") != "")
    )


def known_paths(existing: DataFrame) -> DataFrame:
    """The listed files and all folders they lie in, as ``_known``, without closing slashes."""
    parts = F.split(F.regexp_replace("path", "/+$", ""), "/")
    every = F.transform(
        F.sequence(F.lit(1), F.size(parts)), lambda n: F.array_join(F.slice(parts, 1, n), "/")
    )
    return existing.select(F.explode(every).alias("_known")).where("_known <> ''").distinct()


def validate(manifests: DataFrame, existing: DataFrame | None = None) -> DataFrame:
    """All errors of all manifests (D1). ``existing`` lists the known files."""
    errors = field_errors(manifests)
    if existing is not None:
        named = referenced_paths(manifests).withColumn("_path", F.regexp_replace("path", "/+$", ""))
        known = known_paths(existing)
        missing = named.join(known, F.col("_path") == F.col("_known"), "left_anti")
        errors = errors.unionByName(missing.select("job", "pos", "rank", "message"))
    return errors


def to_jobs(manifests: DataFrame) -> DataFrame:
    """Measurements ready for assembly.

    A measurement's own model and index win over the sample's. The position of
    the sample's owner is known from the manifest alone: it is measurement 0
    when that one has a model.
    """
    flat = manifests.select(
        "job",
        "measurements",
        F.col("sample.description").alias("sample_description"),
        F.col("sample.model").alias("sample_model"),
        F.col("sample.model_dataset_index").alias("sample_index"),
    )
    first = F.get(F.col("measurements"), F.lit(0))
    kinds = F.transform(
        "measurements",
        lambda x: F.struct(
            (x["parquet"].isNotNull() | x["environment"].isNotNull()).alias("has_environment"),
            F.coalesce(x["model"], F.col("sample_model")).isNotNull().alias("has_fit"),
        ),
    )
    rows = flat.withColumns(
        {
            "shares_sample": F.coalesce(first["model"], F.col("sample_model")).isNotNull(),
            "kinds": kinds,
        }
    )
    rows = rows.select("*", F.posexplode("measurements").alias("pos", "m"))
    index = F.coalesce(F.nullif(F.col("m.model_dataset_index"), F.lit(0)), F.col("sample_index"))
    return rows.select(
        "job",
        "pos",
        "shares_sample",
        F.col("m.name").alias("name"),
        F.col("m.reduced").alias("reduced"),
        F.col("m.parquet").alias("parquet"),
        F.col("m.nexus_file").alias("nexus_file"),
        F.coalesce(F.col("m.model"), F.col("sample_model")).alias("model"),
        (index - 1).alias("dataset_index"),
        F.col("m.environment").alias("environment"),
        "sample_description",
        F.lit(None).cast("string").alias("sample_id"),
        F.when(F.col("pos") == 0, F.col("kinds")).alias("siblings"),
    )


def single_jobs(rows: DataFrame) -> DataFrame:
    """Independent measurements: every row is a job of its own (L1).

    ``rows`` has ``job`` and ``reduced``; any other measurement field may be
    missing. ``dataset_index`` counts from 0, ``sample_id`` names an existing
    sample to link to.
    """
    optional = {
        "name": "string",
        "parquet": "string",
        "nexus_file": "string",
        "model": "string",
        "dataset_index": "int",
        "environment": "string",
        "sample_description": "string",
        "sample_id": "string",
    }
    full = rows.withColumns(
        {c: F.lit(None).cast(t) for c, t in optional.items() if c not in rows.columns}
    )
    return full.select(
        "job",
        F.lit(0).alias("pos"),
        F.col("model").isNotNull().alias("shares_sample"),
        "reduced",
        *optional,
        F.array(
            F.struct(
                (F.col("parquet").isNotNull() | F.col("environment").isNotNull()).alias(
                    "has_environment"
                ),
                F.col("model").isNotNull().alias("has_fit"),
            )
        ).alias("siblings"),
    )
