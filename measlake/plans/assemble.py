"""Assembly of measurements into the four tables.

Four equi-joins bring a measurement's curve, metadata, log values and model
together; the records are projections of that one row. Ids are digests of the
job and position, so a sample or environment names its children without a
further shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import conditions, instruments, layers, names
from ..functions.text import let
from ..ids import ENVIRONMENT, FIT, RUN, SAMPLE, entity_id
from ..operators import curve_match, issues
from ..operators.rows import once
from ..records import environment, fit, reflectivity, sample
from ..sources import manifest, run_records
from .batch import Batch, Parents, table

TOOL = "measlake"
VERSION = "0.1.0"


def _as_struct(df: DataFrame, name: str, key: str) -> DataFrame:
    """All columns as one struct, next to the key."""
    return df.select(F.col(key).alias(f"_{name}_key"), F.struct(*df.columns).alias(name))


def join_inputs(
    measurements: DataFrame,
    curves: DataFrame,
    models: DataFrame,
    metadata: DataFrame | None = None,
    logs: DataFrame | None = None,
) -> DataFrame:
    """One row per measurement with ``curve``, ``meta``, ``log_values`` and ``model``."""
    # Rows without records or without a model get a key of their own that
    # matches nothing: null keys would all meet in one partition.
    folder = F.regexp_replace("parquet", "/+$", "")
    own_key = F.concat(F.lit("none:"), F.coalesce("reduced", "job"))
    wide = measurements.withColumns(
        {
            "_dir": F.coalesce(folder, own_key),
            "_scope": run_records.scope(names.run_number(F.col("reduced"))),
            "_model": F.coalesce("model_path", own_key),
        }
    )
    # Narrow inputs first, so that curves and models are moved as little as possible.
    if metadata is None:
        nothing = ", ".join(
            f"{f.name}: {f.dataType.simpleString()}" for f in run_records.METADATA.fields
        )
        wide = wide.withColumn("meta", F.lit(None).cast(f"STRUCT<{nothing}>"))
    else:
        first = run_records.record_of_run(metadata, "meta")
        first = first.withColumnsRenamed({"dir": "_dir", "scope": "_scope"})
        wide = wide.join(first, ["_dir", "_scope"], "left")
    if logs is None:
        wide = wide.withColumn("log_values", F.lit(None).cast("map<string,double>"))
    else:
        values = run_records.logs_of_run(logs, instruments.log_names())
        values = values.withColumnsRenamed({"dir": "_dir", "scope": "_scope"})
        wide = wide.join(values, ["_dir", "_scope"], "left")
    curve = _as_struct(curves, "curve", "path")
    wide = wide.join(curve, F.col("reduced") == F.col("_curve_key"), "left")
    model = _as_struct(models.drop("model_json"), "model", "path")
    return wide.join(model, F.col("_model") == F.col("_model_key"), "left").drop(
        "_curve_key", "_model_key", "_dir", "_scope", "_model"
    )


def _errors() -> Column:
    return issues.messages(
        F.when(
            F.col("curve").isNull(),
            F.when(F.col("reduced").isNull(), F.lit("No curve file is named")).otherwise(
                F.concat(F.lit("There is no file "), F.col("reduced"))
            ),
        ),
        F.when(
            F.col("model_path").isNotNull() & F.col("model").isNull(),
            F.concat(F.lit("There is no file "), F.col("model_path")),
        ),
        F.when(
            F.col("model.malformed"), F.concat(F.lit("Not a model that can be read: "), F.col("model_path"))
        ),
    )


def input_errors(measurements: DataFrame, curves: DataFrame, models: DataFrame) -> DataFrame:
    """Curves and models that are named but not there or not readable.

    ``job``, ``pos``, ``rank``, ``message``, from paths and marks alone: no
    curve or model is moved.
    """
    named = measurements.select(
        "job",
        "pos",
        "reduced",
        F.col("model").alias("model_path"),
        F.coalesce("model", F.concat(F.lit("none:"), F.coalesce("reduced", "job"))).alias("_model"),
    )
    curve = curves.select(F.col("path").alias("_curve")).withColumn("curve", F.lit(True))
    model = models.select(F.col("path").alias("_path"), F.struct("malformed").alias("model"))
    wide = named.join(curve, F.col("reduced") == F.col("_curve"), "left").join(
        model, F.col("_model") == F.col("_path"), "left"
    )
    listed = wide.select("job", "pos", F.posexplode(_errors()).alias("rank", "message"))
    return listed.select("job", F.col("pos").cast("int").alias("pos"), "rank", "message")


def selection_warning(needed: Column, matched: Column, count: Column) -> Column:
    """What is said about an automatic choice of dataset."""
    return F.when(
        needed & matched.isNotNull(),
        F.format_string(
            "Dataset %d of %d is taken, the best match of the curve",
            matched + 1,
            count,
        ),
    ).when(
        needed,
        F.format_string(
            "None of %d datasets matches the curve; the first is taken. "
            "Give dataset_index to choose.",
            count,
        ),
    )


def prepare(wide: DataFrame, ingest_id: str, ingest_time: Column, parse_text: bool) -> DataFrame:
    """Add choice of dataset, layer stack, identity, conditions, ids and issues."""
    needed = F.col("dataset_index").isNull() & (F.col("model.num_experiments") > 1)
    probes = F.transform("model.datasets", lambda d: d["probe"])
    winner = F.when(
        needed, curve_match.closest(F.col("curve.q"), F.col("curve.r"), probes)
    )
    chosen = once(
        wide.withColumn("errors", _errors()),
        # The score is read, then the dataset: each would compare the curve anew.
        let(winner, lambda w: F.struct(curve_match.matched_dataset(w).alias("matched"))),
        "matched",
    )
    index = F.when(needed, F.coalesce("matched", F.lit(0))).otherwise(F.col("dataset_index"))
    text = F.when(F.lit(parse_text), F.col("environment")).cast("string")
    handler = instruments.resolve(F.col("meta.instrument_id"))
    logs = F.col("log_values")

    def reading(attribute: str) -> Column:
        return instruments.environment_value(handler, logs, attribute)

    rows = chosen.withColumns(
        {
            "index": index,
            "selection_note": selection_warning(
                needed, F.col("matched"), F.col("model.num_experiments")
            ),
        }
    )
    rows = rows.withColumns(
        {
            "stack": F.when(
                F.col("model").isNotNull(),
                layers.select_stack(F.col("model.stack"), F.col("model.datasets"), F.col("index")),
            ),
            "who": reflectivity.identity(F.col("curve"), F.col("meta"), ingest_time),
            "found": conditions.conditions(text),
            "handler": handler,
            "temperature": reading("temperature_logs"),
            "pressure": reading("pressure_logs"),
        }
    )
    has_environment = F.col("parquet").isNotNull() | F.col("environment").isNotNull()
    own_sample = F.col("model").isNotNull() & F.when(
        F.col("shares_sample"), F.col("pos") == 0
    ).otherwise(F.lit(True))
    shared = entity_id(SAMPLE, ingest_id, F.col("job"), F.lit(0))
    own = entity_id(SAMPLE, ingest_id, F.col("job"), F.col("pos"))
    rows = rows.withColumns(
        {
            "run_id": entity_id(RUN, ingest_id, F.col("job"), F.col("reduced"), F.col("pos")),
            "environment_id": F.when(
                has_environment, entity_id(ENVIRONMENT, ingest_id, F.col("job"), F.col("pos"))
            ),
            "fit_id": F.when(
                F.col("model").isNotNull(), entity_id(FIT, ingest_id, F.col("job"), F.col("pos"))
            ),
            "owns_sample": F.col("sample_id").isNull() & own_sample,
            "linked_sample_id": F.coalesce(
                "sample_id",
                F.when(F.col("shares_sample"), shared).when(F.col("model").isNotNull(), own),
            ),
        }
    )
    geometry = reflectivity.geometry_of(F.col("stack"))
    no_sample = ~F.col("shares_sample") & F.col("sample_id").isNull() & (F.col("pos") > 0)
    return rows.withColumns(
        {
            "geometry": geometry,
            "warnings": F.concat(
                issues.messages(F.col("selection_note")),
                reflectivity.warnings(F.col("curve"), F.col("meta"), F.col("who")),
                issues.messages(
                    F.when(F.col("model.software") == "unknown", F.lit(fit.NO_SOFTWARE)),
                    F.when(no_sample, F.lit("No sample created by the first measurement")),
                ),
            ),
            "needs_review": F.map_from_entries(
                F.concat(
                    F.array_compact(
                        F.array(
                            reflectivity.geometry_flag(geometry),
                            environment.temperature_flag(
                                F.col("parquet").isNotNull(), F.col("temperature"), F.col("handler")
                            ),
                        )
                    ),
                    F.when(
                        F.col("owns_sample"), layers.generic_name_flags(F.col("stack"))
                    ).otherwise(F.array().cast("array<struct<key:string,value:string>>")),
                )
            ),
        }
    )


def _sibling_ids(kind: str, ingest_id: str, flag: str) -> Column:
    """Ids of the job's records of one kind, in order, as its first row names them."""
    ids = F.transform(
        "siblings",
        lambda s, i: F.when(s[flag], entity_id(kind, ingest_id, F.col("job"), i)),
    )
    return F.array_compact(ids)


def runs_table(good: DataFrame, ingest_time: Column) -> DataFrame:
    columns = reflectivity.record(
        F.col("run_id"),
        F.col("curve"),
        F.col("who"),
        F.col("geometry"),
        F.col("nexus_file"),
        F.col("linked_sample_id"),
        F.col("environment_id"),
        ingest_time,
    )
    return table(good, "reflectivity", columns)


def environments_table(good: DataFrame, ingest_time: Column) -> DataFrame:
    """Environments; a given text only replaces the instrument's own one."""
    description = F.when(
        F.col("parquet").isNotNull(),
        environment.instrument_description(F.col("environment"), F.col("handler")),
    ).otherwise(F.col("environment"))
    columns = environment.record(
        F.col("environment_id"),
        description,
        layers.ambient(F.col("stack"))["material"],
        F.col("temperature"),
        F.col("pressure"),
        F.col("found"),
        F.array("run_id"),
        ingest_time,
    )
    return table(good.filter(F.col("environment_id").isNotNull()), "environment", columns)


def samples_table(good: DataFrame, ingest_id: str, ingest_time: Column) -> DataFrame:
    """Samples; a shared one lists the environments and fits of its whole job."""
    whole_job = F.col("shares_sample")
    every_fit = _sibling_ids(FIT, ingest_id, "has_fit")
    columns = sample.record(
        F.col("linked_sample_id"),
        F.col("stack"),
        F.when(F.col("pos") == 0, F.col("sample_description")),
        F.when(whole_job, _sibling_ids(ENVIRONMENT, ingest_id, "has_environment")).otherwise(
            F.array_compact(F.array("environment_id"))
        ),
        F.when(whole_job, every_fit).otherwise(F.array("fit_id")),
        ingest_time,
    )
    return table(good.filter("owns_sample"), "sample", columns)


def fits_table(good: DataFrame, models: DataFrame, ingest_time: Column) -> DataFrame:
    """Fits; the model's text joins here, where it is written."""
    texts = models.select(F.col("path").alias("_path"), "model_json")
    good = good.filter(F.col("fit_id").isNotNull()).join(
        texts, F.col("model_path") == F.col("_path"), "left"
    )
    good = good.withColumn("model", F.col("model").withField("model_json", F.col("model_json")))
    no_chi = F.lit(None).cast("double")
    only = fit.dataset(
        F.col("index"), F.col("run_id"), F.lit(None).cast("string"), no_chi, F.col("stack")
    )
    columns = fit.record(
        F.col("fit_id"),
        F.col("model"),
        F.array(only),
        F.col("index"),
        F.array("run_id"),
        F.col("linked_sample_id"),
        F.array_compact(F.array("linked_sample_id")),
        no_chi,
        fit.strategy(F.col("model.num_experiments")),
        ingest_time,
    )
    return table(good, "reflectivity_model", columns)


def outcomes_table(rows: DataFrame, dry_run: bool) -> DataFrame:
    done = F.size("errors") == 0
    return issues.outcome(
        issues.gate(rows),
        TOOL,
        VERSION,
        params={
            "reduced_input": F.col("reduced"),
            "model_input": F.col("model_path"),
            "nexus_input": F.col("nexus_file"),
        },
        artifacts={"run_id": F.when(done, F.col("run_id"))},
        info={"ingest_status": F.when(done, F.lit("completed"))},
        dry_run=dry_run,
    )


def assemble(
    measurements: DataFrame,
    curves: DataFrame,
    models: DataFrame,
    metadata: DataFrame | None = None,
    logs: DataFrame | None = None,
    *,
    ingest_id: str,
    ingest_time: Column,
    parse_text: bool = False,
    dry_run: bool = False,
) -> Batch:
    """Measurements and their inputs to the four tables.

    ``measurements`` come from ``manifest.to_jobs`` or ``manifest.single_jobs``.
    A row with an error is left out of the tables and listed in ``issues``.
    """
    named = measurements.withColumnRenamed("model", "model_path")
    wide = join_inputs(named, curves, models, metadata, logs)
    # The chosen stack is on its own; the other experiments end here, with their probes.
    chosen = [c for c in models.columns if c not in ("model_json", "datasets", "stack")]
    rows = prepare(wide, ingest_id, ingest_time, parse_text).withColumn(
        "model",
        F.when(
            F.col("model").isNotNull(), F.struct(*[F.col("model")[c].alias(c) for c in chosen])
        ),
    )
    audited = (
        "job",
        "pos",
        "run_id",
        "reduced",
        "model_path",
        "nexus_file",
        "environment_id",
        "errors",
        "warnings",
        "needs_review",
    )

    def good(p: Parents) -> DataFrame:
        return p["rows"].filter(F.size("errors") == 0)

    return Batch(
        {"rows": lambda _: rows},
        {
            "reflectivity": lambda p: runs_table(good(p), ingest_time),
            "environment": lambda p: environments_table(good(p), ingest_time),
            "sample": lambda p: samples_table(good(p), ingest_id, ingest_time),
            "reflectivity_model": lambda p: fits_table(good(p), models, ingest_time),
            "issues": lambda p: issues.explode_issues(p["rows"].select(*audited), ["job", "pos"]),
            "outcomes": lambda p: outcomes_table(p["rows"].select(*audited), dry_run),
        },
    )


def assemble_manifests(
    manifests: DataFrame,
    curves: DataFrame,
    models: DataFrame,
    metadata: DataFrame | None = None,
    logs: DataFrame | None = None,
    existing: DataFrame | None = None,
    **options,
) -> Batch:
    """Manifests to the four tables (L4).

    A manifest with an error, in itself or in any of its inputs, is not
    assembled at all, so that no id names a record that is not there; its errors
    are in ``rejected``. ``existing`` lists the files that are there.
    """
    normal = manifest.normalise(manifests)
    errors = manifest.validate(normal, existing)
    sound = normal.join(errors.select("job").distinct(), "job", "left_anti")
    unread = input_errors(manifest.to_jobs(sound), curves, models)
    sound = sound.join(unread.select("job").distinct(), "job", "left_anti")
    batch = assemble(manifest.to_jobs(sound), curves, models, metadata, logs, **options)
    batch.rejected = errors.unionByName(unread)
    return batch
