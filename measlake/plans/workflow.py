"""Assembly of fit-workflow run directories (L2, L3).

Single-state directories are directories with one implicit state, so both
kinds share every step. Files are exploded to rows for the joins with their
curves and with the model's probes; only small match results come back per
directory, and they are as many as the directory's own file list.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import conditions, layers
from ..functions.text import let, non_empty
from ..ids import ENVIRONMENT, FIT, RUN, SAMPLE, entity_id
from ..operators import curve_match, issues
from ..operators.rows import once
from ..records import environment, fit, reflectivity, sample
from .assemble import TOOL, VERSION, selection_warning
from .batch import Batch, Parents, table

SHARED = "shared"
# Runs of a directory per join key. A directory with more files gets several
# keys, so its runs are spread over that many groups.
RUNS_PER_CHUNK = 1000


def _chunk(pos: Column) -> Column:
    return F.floor(pos / F.lit(RUNS_PER_CHUNK)).cast("int")


def per_chunk(jobs: DataFrame, file_count: Column) -> DataFrame:
    """A directory's row once for every chunk of its files, as ``chunk``."""
    last = F.greatest(_chunk(file_count - 1), F.lit(0))
    return jobs.select("*", F.explode(F.sequence(F.lit(0), last)).alias("chunk"))


def run_rows(jobs: DataFrame) -> DataFrame:
    """One row per listed file: ``state_ord``, ``pos`` over all states, ``path``."""
    listed = F.flatten(
        F.transform(
            "states",
            lambda s, si: F.transform(
                s["files"], lambda f: F.struct(si.alias("state_ord"), f.alias("path"))
            ),
        )
    )
    rows = jobs.select("job", F.posexplode(listed).alias("pos", "f"))
    return rows.select("job", _chunk(F.col("pos")).alias("chunk"), "pos", "f.*")


def locate_runs(jobs: DataFrame, curves: DataFrame, ingest_time: Column) -> DataFrame:
    """Listed files with their curve and identity."""
    curve = curves.select(F.col("path").alias("_path"), F.struct(*curves.columns).alias("curve"))
    located = run_rows(jobs).join(curve, F.col("path") == F.col("_path"), "left").drop("_path")
    nothing = F.lit(None).cast(
        "STRUCT<instrument_id: STRING, run_number: BIGINT, run_id: STRING, title: STRING, "
        "start_time: STRING, experiment_identifier: STRING, source_path: STRING>"
    )
    return located.withColumn("meta", nothing).withColumn(
        "who", reflectivity.identity(F.col("curve"), F.col("meta"), ingest_time)
    )


def match_runs(located: DataFrame, jobs: DataFrame) -> DataFrame:
    """The dataset each run matches (J6). Of the curve only the result is kept."""
    files = F.aggregate("states", F.lit(0), lambda n, s: n + F.coalesce(F.size(s["files"]), F.lit(0)))
    probes = jobs.select(
        "job",
        F.transform("model.datasets", lambda d: d["probe"]).alias("probes"),
        files.alias("files"),
    )
    probes = per_chunk(probes, F.col("files")).drop("files")
    narrow = located.select(
        "job",
        "chunk",
        "pos",
        "state_ord",
        "path",
        F.col("who.run_number").alias("run_number"),
        F.col("curve").isNull().alias("absent"),
        F.col("curve.q").alias("q"),
        F.col("curve.r").alias("r"),
    )
    winner = curve_match.closest(F.col("q"), F.col("r"), F.col("probes"))
    matched = once(
        narrow.join(probes, ["job", "chunk"]),
        let(winner, lambda w: F.struct(curve_match.matched_dataset(w).alias("matched"))),
        "matched",
    )
    return matched.drop("probes", "q", "r")


def summarise(runs: DataFrame) -> DataFrame:
    """Match results per directory, in file order."""
    fields = ("pos", "state_ord", "path", "absent", "matched", "run_number")
    return runs.groupBy("job").agg(
        F.sort_array(F.collect_list(F.struct(*fields))).alias("runs")
    )


def decide(
    jobs: DataFrame, summary: DataFrame, ingest_id: str, dataset_index: int | None, sample_id: str | None
) -> DataFrame:
    """Everything that holds for a directory as a whole."""
    rows = jobs.join(summary, "job", "left")
    given = F.lit(dataset_index).cast("int")
    count = F.col("model.num_experiments")
    needed = ~F.col("explicit") & given.isNull() & (count > 1)
    first_match = F.get("runs", F.lit(0))["matched"]
    missing = F.transform(
        F.filter(F.coalesce("runs", F.array()), lambda r: r["absent"]),
        lambda r: F.when(
            F.col("explicit"),
            F.concat(
                F.lit("State '"),
                F.coalesce(F.get("states", r["state_ord"])["name"], F.lit("None")),
                F.lit("': there is no file "),
                r["path"],
            ),
        ).otherwise(
            F.concat(
                F.lit("There is no file that run_info.json names: "),
                F.coalesce(r["path"], F.lit("None")),
            )
        ),
    )
    rows = rows.withColumns(
        {
            "errors": F.concat("errors", missing),
            "index": F.when(needed, F.coalesce(first_match, F.lit(0))).otherwise(given),
            "selection_note": selection_warning(needed, first_match, count),
            "has_model": F.col("model").isNotNull(),
        }
    )
    external = F.lit(sample_id).cast("string")
    shared = F.coalesce(
        external, F.when(F.col("has_model"), entity_id(SAMPLE, ingest_id, F.col("job"), F.lit(SHARED)))
    )
    rows = rows.withColumns(
        {
            "stack": F.when(
                F.col("has_model"),
                layers.select_stack(F.col("model.stack"), F.col("model.datasets"), F.col("index")),
            ),
            "shared_sample_id": shared,
            "fit_id": F.when(F.col("has_model"), entity_id(FIT, ingest_id, F.col("job"), F.lit(0))),
        }
    )

    def state_entry(s: Column, i: Column) -> Column:
        own_text = non_empty(s["sample_description"])
        other_text = own_text.isNotNull() & ~own_text.eqNullSafe(F.col("sample_description"))
        owns = F.col("has_model") & ((F.col("distinct_sample") & (i > 0)) | other_text)
        exists = F.col("explicit") | s["extra_description"].isNotNull()
        return F.struct(
            s["extra_description"].alias("text"),
            F.coalesce(own_text, F.col("sample_description")).alias("sample_text"),
            F.coalesce(owns, F.lit(False)).alias("owns_sample"),
            F.when(owns, entity_id(SAMPLE, ingest_id, F.col("job"), i))
            .otherwise(F.col("shared_sample_id"))
            .alias("sample_id"),
            F.when(exists, entity_id(ENVIRONMENT, ingest_id, F.col("job"), i)).alias(
                "environment_id"
            ),
        )

    return rows.withColumn("state_rows", F.transform("states", state_entry))


def run_id(ingest_id: str, job: Column, path: Column, pos: Column) -> Column:
    return entity_id(RUN, ingest_id, job, path, pos)


def _runs(linked: DataFrame, ingest_id: str, ingest_time: Column) -> DataFrame:
    columns = reflectivity.record(
        run_id(ingest_id, F.col("job"), F.col("path"), F.col("pos")),
        F.col("curve"),
        F.col("who"),
        F.col("geometry"),
        F.lit(None).cast("string"),
        F.col("link.s"),
        F.col("link.e"),
        ingest_time,
    )
    return table(linked, "reflectivity", columns)


def _environments(done: DataFrame, ingest_id: str, ingest_time: Column) -> DataFrame:
    # Runs are grouped by state once; a state's row does not carry all runs of its directory.
    own_runs = (
        done.select("job", F.explode("runs").alias("r"))
        .groupBy("job", F.col("r.state_ord").alias("state_ord"))
        .agg(F.sort_array(F.collect_list(F.struct("r.pos", "r.path"))).alias("own_runs"))
    )
    states = done.select(
        "job",
        layers.ambient(F.col("stack"))["material"].alias("ambient"),
        F.posexplode("state_rows").alias("state_ord", "s"),
    ).filter(F.col("s.environment_id").isNotNull())
    rows = states.join(own_runs, ["job", "state_ord"], "left")
    own_ids = F.transform(
        F.coalesce("own_runs", F.array().cast("array<struct<pos:int,path:string>>")),
        lambda r: run_id(ingest_id, F.col("job"), r["path"], r["pos"]),
    )
    nothing = F.lit(None).cast("double")
    return table(
        rows,
        "environment",
        environment.record(
            F.col("s.environment_id"),
            F.col("s.text"),
            F.col("ambient"),
            nothing,
            nothing,
            conditions.conditions(F.col("s.text")),
            own_ids,
            ingest_time,
        ),
    )


def _sample_rows(done: DataFrame, external: bool) -> DataFrame:
    """Own samples of states, and the shared one unless it exists already."""
    every = F.transform(
        F.filter("state_rows", lambda s: s["owns_sample"]),
        lambda s: F.struct(s["sample_id"].alias("id"), s["sample_text"].alias("text")),
    )
    if not external:
        shared = F.struct(
            F.col("shared_sample_id").alias("id"), F.col("sample_description").alias("text")
        )
        every = F.concat(F.array(shared), every)
    return done.filter("has_model").select("*", F.explode(every).alias("owned"))


def _samples(done: DataFrame, external: bool, ingest_time: Column) -> DataFrame:
    # States are grouped by sample once; a sample's row does not carry all states.
    used = (
        done.select("job", F.posexplode("state_rows").alias("state_ord", "s"))
        .groupBy("job", F.col("s.sample_id").alias("_used_id"))
        .agg(F.sort_array(F.collect_list(F.struct("state_ord", "s.environment_id"))).alias("used"))
    )
    owned = _sample_rows(done, external).select(
        "job", "stack", "distinct_sample", "explicit", "shared_sample_id", "fit_id", "owned",
        F.col("owned.id").alias("_used_id"),
    )
    rows = owned.join(used, ["job", "_used_id"], "left")
    linked = F.when(F.col("distinct_sample") & F.col("explicit"), F.col("used").isNotNull()).otherwise(
        F.col("owned.id") == F.col("shared_sample_id")
    )
    return table(
        rows,
        "sample",
        sample.record(
            F.col("owned.id"),
            F.col("stack"),
            F.col("owned.text"),
            F.array_compact(
                F.coalesce(F.col("used.environment_id"), F.array().cast("array<string>"))
            ),
            F.when(linked, F.array("fit_id")),
            ingest_time,
        ),
    )


def _dataset_index(run: Column, count: Column, total: Column) -> Column:
    """Dataset of a run: matched, else by position, else the one in use."""
    return F.coalesce(
        run["matched"], F.when(count == total, run["pos"]), F.col("index"), F.lit(0)
    ).cast("int")


def _ambiguous(run: Column, count: Column, total: Column) -> Column:
    return run["matched"].isNull() & (count != total)


def without_probes(decided: DataFrame) -> DataFrame:
    """Directories with what later steps need of their model: layers, no curves and no text."""
    model = decided.schema["model"].dataType
    chosen = [c for c in model.names if c not in ("model_json", "datasets", "stack")]
    found = F.col("model")
    narrow = F.struct(
        *[found[c].alias(c) for c in chosen],
        F.transform(found["datasets"], lambda d: F.struct(d["layers"].alias("layers"))).alias(
            "datasets"
        ),
    )
    return decided.withColumn("model", F.when(found.isNotNull(), narrow))


def _fits(done: DataFrame, texts: DataFrame, ingest_id: str, ingest_time: Column) -> DataFrame:
    """Fits; the model's text joins here, where it is written."""
    count, total = F.col("model.num_experiments"), F.size("runs")
    no_text, no_chi = F.lit(None).cast("string"), F.lit(None).cast("double")

    def own_id(run: Column) -> Column:
        return run_id(ingest_id, F.col("job"), run["path"], run["pos"])

    def entry(run: Column) -> Column:
        index = _dataset_index(run, count, total)
        stack = F.coalesce(F.get(F.col("model.datasets"), index)["layers"], F.col("stack"))
        return fit.dataset(index, own_id(run), run["run_number"], no_chi, stack)

    only_run = F.get("runs", F.lit(0))
    single = F.array(
        fit.dataset(F.col("index"), own_id(only_run), no_text, F.col("chi_squared"), F.col("stack"))
    )
    per_state = F.array_distinct(F.transform("state_rows", lambda s: s["sample_id"]))
    with_text = done.filter("has_model").join(texts, "job", "left")
    with_text = with_text.withColumn(
        "model", F.col("model").withField("model_json", F.col("model_json"))
    )
    rows = once(
        with_text,
        F.struct(
            F.when(~F.col("explicit") & (total == 1), single)
            .otherwise(F.transform("runs", entry))
            .alias("datasets")
        ),
        "datasets",
    )
    return table(
        rows,
        "reflectivity_model",
        fit.record(
            F.col("fit_id"),
            F.col("model"),
            F.col("datasets"),
            F.col("index"),
            F.transform("runs", own_id),
            F.col("shared_sample_id"),
            F.when(F.col("explicit") & F.col("distinct_sample"), per_state).otherwise(
                F.array_compact(F.array("shared_sample_id"))
            ),
            F.col("chi_squared"),
            F.when(F.col("explicit"), F.lit(fit.MULTI_STATE)).otherwise(fit.strategy(count)),
            ingest_time,
        ),
    )


def _job_issues(done: DataFrame) -> DataFrame:
    """Warnings and review flags that concern the directory as a whole."""
    count, total = F.col("model.num_experiments"), F.size("runs")
    several = F.col("has_model") & (F.col("explicit") | (total > 1))
    unsure = F.when(
        several, F.filter("runs", lambda r: _ambiguous(r, count, total))
    ).otherwise(F.filter("runs", lambda r: F.lit(False)))
    notes = F.transform(
        unsure,
        lambda r: F.format_string(
            "Run %s matches no dataset (%d datasets, %d runs); dataset %d is taken, "
            "its parameters may not be the run's",
            r["run_number"],
            count,
            total,
            _dataset_index(r, count, total),
        ),
    )
    flags = F.transform(
        F.array_distinct(F.transform(unsure, lambda r: r["run_number"])),
        lambda number: F.struct(
            F.concat(F.lit("fit_dataset_"), number).alias("key"),
            F.lit("dataset is a guess").alias("value"),
        ),
    )
    no_flags = F.array().cast("array<struct<key:string,value:string>>")
    ok = F.size("errors") == 0
    return done.select(
        "job",
        F.lit(-1).alias("pos"),
        "errors",
        F.when(
            ok,
            F.concat(
                issues.messages(
                    F.col("selection_note"),
                    F.when(F.col("model.software") == "unknown", F.lit(fit.NO_SOFTWARE)),
                ),
                notes,
            ),
        )
        .otherwise(issues.no_messages())
        .alias("warnings"),
        F.map_from_entries(
            F.when(
                ok,
                F.concat(
                    F.array_compact(
                        F.array(reflectivity.geometry_flag(layers.geometry(F.col("stack"))))
                    ),
                    F.coalesce(layers.generic_name_flags(F.col("stack")), no_flags),
                    F.when(~F.col("explicit"), flags).otherwise(no_flags),
                ),
            ).otherwise(no_flags)
        ).alias("needs_review"),
    )


def _run_issues(linked: DataFrame) -> DataFrame:
    no_review = F.map_from_entries(F.array().cast("array<struct<key:string,value:string>>"))
    return linked.select(
        "job",
        "pos",
        issues.no_messages().alias("errors"),
        reflectivity.warnings(F.col("curve"), F.col("meta"), F.col("who")).alias("warnings"),
        no_review.alias("needs_review"),
    )


def _outcomes(decided: DataFrame, dry_run: bool) -> DataFrame:
    return issues.outcome(
        issues.gate(_job_issues(decided)),
        TOOL,
        VERSION,
        params={"run_dir": F.col("job")},
        artifacts={},
        info={"ingest_status": F.when(F.size("errors") == 0, F.lit("completed"))},
        dry_run=dry_run,
    )


def assemble_run_dirs(
    jobs: DataFrame,
    curves: DataFrame,
    *,
    ingest_id: str,
    ingest_time: Column,
    dataset_index: int | None = None,
    sample_id: str | None = None,
    dry_run: bool = False,
) -> Batch:
    """Run directories (``run_dirs.parse``) and curves to the four tables.

    A directory with an error contributes nothing but its issue.
    """

    def decided(p: Parents) -> DataFrame:
        summary = summarise(match_runs(p["located"], jobs))
        return without_probes(decide(jobs, summary, ingest_id, dataset_index, sample_id))

    def done(p: Parents) -> DataFrame:
        return p["decided"].filter(F.size("errors") == 0)

    def linked(p: Parents) -> DataFrame:
        per_job = done(p).select(
            "job",
            layers.geometry(F.col("stack")).alias("geometry"),
            F.transform(
                "state_rows",
                lambda s: F.struct(s["sample_id"].alias("s"), s["environment_id"].alias("e")),
            ).alias("links"),
            F.size("runs").alias("files"),
        )
        chunks = per_chunk(per_job, F.col("files")).drop("files")
        rows = p["located"].join(chunks, ["job", "chunk"])
        return rows.withColumn("link", F.get("links", F.col("state_ord")))

    texts = jobs.select("job", F.col("model.model_json").alias("model_json"))
    return Batch(
        {"located": lambda _: locate_runs(jobs, curves, ingest_time), "decided": decided},
        {
            "reflectivity": lambda p: _runs(linked(p), ingest_id, ingest_time),
            "sample": lambda p: _samples(done(p), sample_id is not None, ingest_time),
            "environment": lambda p: _environments(done(p), ingest_id, ingest_time),
            "reflectivity_model": lambda p: _fits(done(p), texts, ingest_id, ingest_time),
            "issues": lambda p: issues.explode_issues(
                _job_issues(p["decided"]).unionByName(_run_issues(linked(p))), ["job", "pos"]
            ),
            "outcomes": lambda p: _outcomes(p["decided"], dry_run),
        },
    )
