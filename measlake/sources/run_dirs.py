"""Run directories of a fit workflow, read as one collection."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import non_empty, not_json
from . import fit_model
from .files import read_texts

# Files of a run directory and their fields.
RUN_INFO, PROBLEM, FINAL_STATE = "run_info.json", "problem.json", "final_state.json"
CHECKPOINT = "checkpoints/004_fitting.json"
OUTPUT_DIR = "refl1d_output"
_STATE_FIELDS = "name: STRING, extra_description: STRING, sample_description: STRING"
RUN_INFO_SCHEMA = (
    "data_file STRING, data_files ARRAY<STRING>, sample_description STRING, "
    f"distinct_sample STRING, states ARRAY<STRUCT<{_STATE_FIELDS}, data_files: ARRAY<STRING>>>"
)
STATE_SCHEMA = (
    "final_chi2 DOUBLE, state STRUCT<best_chi2: DOUBLE, current_chi2: DOUBLE, "
    "states: ARRAY<STRUCT<extra_description: STRING>>>"
)
STATES = f"ARRAY<STRUCT<{_STATE_FIELDS}, files: ARRAY<STRING>>>"


def piece(path: Column) -> Column:
    """Which piece of which run directory a file is: struct ``kind``, ``job``."""

    def named(kind: str, pattern: str) -> Column:
        return F.when(
            path.rlike(pattern),
            F.struct(F.lit(kind).alias("kind"), F.regexp_extract(path, pattern, 1).alias("job")),
        )

    return F.coalesce(
        named("errors", rf"^(.*?)/{OUTPUT_DIR}/.*-err\.json$"),
        named("checkpoint", rf"^(.*)/{CHECKPOINT}$"),
        named("run_info", rf"^(.*)/{RUN_INFO}$"),
        named("problem", rf"^(.*)/{PROBLEM}$"),
        named("final_state", rf"^(.*)/{FINAL_STATE}$"),
    )


def bundle(texts: DataFrame) -> DataFrame:
    """One row per run directory with the text of each piece.

    Of several error files the one with the smallest path counts (S14).
    """
    pieces = texts.select("path", "content", piece(F.col("path")).alias("p")).filter(
        F.col("p").isNotNull()
    )

    def text(kind: str, alias: str) -> Column:
        here = F.col("p.kind") == kind
        return F.min_by(F.when(here, F.col("content")), F.when(here, F.col("path"))).alias(alias)

    return pieces.groupBy(F.col("p.job").alias("job")).agg(
        text("run_info", "run_info"),
        text("problem", "problem"),
        text("final_state", "final_state"),
        text("checkpoint", "checkpoint"),
        text("errors", "error_content"),
    )


def fit_state(final: Column, checkpoint: Column) -> Column:
    """Goodness of fit and condition text.

    The final state wins over the checkpoint as a whole. Its own figure comes
    first, then the best one of the state unless it is zero, then the current.
    """

    def of_state(state: Column) -> tuple[Column, Column]:
        chi = F.coalesce(F.nullif(state["best_chi2"], F.lit(0.0)), state["current_chi2"])
        return chi, F.get(state["states"], F.lit(0))["extra_description"]

    final_chi, final_text = of_state(final["state"])
    saved_chi, saved_text = of_state(checkpoint["state"])
    return F.when(
        final.isNotNull(),
        F.struct(
            F.coalesce(final["final_chi2"], final_chi).alias("chi_squared"),
            final_text.alias("text"),
        ),
    ).otherwise(F.struct(saved_chi.alias("chi_squared"), saved_text.alias("text")))


def file_list(entries: Column) -> Column:
    """Data files given as paths or as objects with a ``file`` field."""
    return F.transform(
        entries,
        lambda entry: F.when(
            F.startswith(entry, F.lit("{")), F.get_json_object(entry, "$.file")
        ).otherwise(entry),
    )


def _truthy(text: Column) -> Column:
    return F.coalesce(~text.isin("false", "0", "", "null"), F.lit(False))


def parse(texts: DataFrame) -> DataFrame:
    """One row per run directory: its states, fit state, model and errors.

    A directory without explicit states has one implicit state with the flat
    list of files and the fit's condition text.
    """
    permissive = {"mode": "PERMISSIVE"}
    # The checkpoint only matters without a final state.
    broken = F.array_compact(
        F.array(
            F.when(not_json(F.col("run_info")), F.lit(RUN_INFO)),
            F.when(not_json(F.col("final_state")), F.lit(FINAL_STATE)).when(
                F.col("final_state").isNull() & not_json(F.col("checkpoint")), F.lit(CHECKPOINT)
            ),
        )
    )
    read = bundle(texts).select(
        "job",
        F.col("run_info").alias("run_info_text"),
        broken.alias("broken"),
        F.from_json("run_info", RUN_INFO_SCHEMA, permissive).alias("info"),
        fit_state(
            F.from_json("final_state", STATE_SCHEMA, permissive),
            F.from_json("checkpoint", STATE_SCHEMA, permissive),
        ).alias("fit_state"),
        F.concat(F.col("job"), F.lit(f"/{PROBLEM}")).alias("path"),
        F.col("problem").alias("content"),
        "error_content",
        F.col("problem").isNotNull().alias("has_model"),
    )
    parsed = fit_model.parse(read)
    info = F.col("info")
    model_fields = [c for c in parsed.columns if c not in read.columns or c == "path"]
    explicit = F.coalesce(F.size(info["states"]) > 0, F.lit(False))
    flat = F.when(F.size(info["data_files"]) > 0, file_list(info["data_files"])).otherwise(
        F.array_compact(F.array(non_empty(info["data_file"])))
    )
    named_states = F.transform(
        info["states"],
        lambda s: F.struct(
            *[s[c].alias(c) for c in ("name", "extra_description", "sample_description")],
            F.filter(
                F.coalesce(file_list(s["data_files"]), F.array().cast("array<string>")),
                lambda f: F.coalesce(f != "", F.lit(False)),
            ).alias("files"),
        ),
    )
    only_state = F.array(
        F.struct(
            F.lit(None).cast("string").alias("name"),
            F.col("fit_state.text").alias("extra_description"),
            F.lit(None).cast("string").alias("sample_description"),
            flat.alias("files"),
        )
    )
    return parsed.select(
        "job",
        explicit.alias("explicit"),
        F.when(explicit, named_states.cast(STATES)).otherwise(only_state.cast(STATES)).alias("states"),
        non_empty(info["sample_description"]).alias("sample_description"),
        _truthy(info["distinct_sample"]).alias("distinct_sample"),
        F.col("fit_state.chi_squared").alias("chi_squared"),
        F.when(F.col("has_model"), F.struct(*model_fields)).alias("model"),
        F.col("run_info_text").isNull().alias("no_run_info"),
        "broken",
    ).select("*", _errors().alias("errors")).drop("broken")


def _errors() -> Column:
    """Everything that is wrong with a directory itself."""
    unread = F.col("no_run_info") | F.array_contains("broken", RUN_INFO)
    empty = F.filter("states", lambda s: F.size(s["files"]) == 0)
    of_states = F.transform(
        empty,
        lambda s: F.when(
            F.col("explicit"),
            F.concat(F.lit("State '"), F.coalesce(s["name"], F.lit("None")), F.lit("' lists no data files")),
        ).otherwise(F.concat(F.col("job"), F.lit(f"/{RUN_INFO} lists no data files"))),
    )
    nothing = F.array().cast("array<string>")
    return F.concat(
        F.array_compact(
            F.array(
                F.when(F.col("no_run_info"), F.concat(F.col("job"), F.lit(f" has no {RUN_INFO}"))),
                F.when(
                    F.col("model.malformed"),
                    F.concat(F.lit("Not a model that can be read: "), F.col("model.path")),
                ),
            )
        ),
        F.transform("broken", lambda name: F.concat(F.col("job"), F.lit("/"), name, F.lit(" is not JSON"))),
        F.when(unread, nothing).otherwise(of_states),
    )


def read(spark: SparkSession, root: str) -> DataFrame:
    """All run directories under a root."""
    return parse(read_texts(spark, root, glob="*.json"))
