"""Warnings, errors, review flags and the gate."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Outcome states and the name of the outcome layout.
OK, FAILED, SKIPPED, DRY_RUN, REPROCESS = "ok", "failed", "skipped", "dry-run", "needs-reprocessing"


def messages(*candidates: Column) -> Column:
    """Array of the messages that apply."""
    return F.array_compact(F.array(*candidates))


def no_messages() -> Column:
    return F.array().cast("array<string>")


def review(*entries: Column) -> Column:
    """Map of review flags from (key, value) structs; nulls are left out."""
    return F.map_from_entries(F.array_compact(F.array(*entries)))


def flag(condition: Column, key: Column | str, text: Column | str) -> Column:
    key = F.lit(key) if isinstance(key, str) else key
    text = F.lit(text) if isinstance(text, str) else text
    return F.when(condition, F.struct(key.alias("key"), text.alias("value")))


def explode_issues(df: DataFrame, keys: list[str]) -> DataFrame:
    """Long table of issues: keys, ``severity``, ``position``, ``field``, ``message``."""
    position = F.lit(None).cast("string")

    def entries(column: str, severity: str) -> Column:
        return F.transform(
            F.coalesce(F.col(column), no_messages()),
            lambda text, i: F.struct(
                F.lit(severity).alias("severity"),
                i.alias("position"),
                position.alias("field"),
                text.alias("message"),
            ),
        )

    flags = F.transform(
        F.map_entries("needs_review"),
        lambda entry, i: F.struct(
            F.lit("review").alias("severity"),
            i.alias("position"),
            entry["key"].alias("field"),
            entry["value"].alias("message"),
        ),
    )
    every = F.concat(
        entries("errors", "error"), entries("warnings", "warning"), F.coalesce(flags, F.array())
    )
    return df.select(*keys, F.explode(every).alias("_i")).select(*keys, "_i.*")


def gate(df: DataFrame) -> DataFrame:
    """Add ``is_complete``, ``has_errors``, ``needs_human_review``."""
    return df.withColumns(
        {
            "has_errors": F.size("errors") > 0,
            "is_complete": F.size("errors") == 0,
            "needs_human_review": F.size(F.map_keys("needs_review")) > 0,
        }
    )


def without_nulls(values: Column) -> Column:
    """A map without its null values."""
    return F.map_filter(values, lambda _, value: value.isNotNull())


def outcome(
    df: DataFrame,
    tool: str,
    version: str,
    params: dict[str, Column],
    artifacts: dict[str, Column],
    info: dict[str, Column],
    dry_run: bool = False,
) -> DataFrame:
    """Audit row per record: status, exit code and non-null details."""

    def details(values: dict[str, Column]) -> Column:
        pairs = [x for key, value in values.items() for x in (F.lit(key), value.cast("string"))]
        return without_nulls(F.create_map(*pairs).cast("map<string,string>"))

    done = F.lit(DRY_RUN if dry_run else OK)
    failed = F.size("errors") > 0
    return df.withColumns(
        {
            "tool": F.lit(tool),
            "tool_version": F.lit(version),
            "status": F.when(failed, F.lit(FAILED)).otherwise(done),
            "exit_code": F.when(failed, F.lit(1)).otherwise(F.lit(0)),
            "params": details(params),
            "artifacts": details(artifacts),
            "info": details(info),
            "messages": F.transform(
                F.concat("errors", "warnings"), lambda text: F.struct(text.alias("text"))
            ),
        }
    )


def against_store(outcomes: DataFrame, known: DataFrame, key: str, version: str) -> DataFrame:
    """Outcomes of jobs that an earlier ingest may have done already.

    ``known`` has the ``key`` and ``version`` of what is in the store, one row
    per key. The same version is skipped, another one needs reprocessing; jobs
    that failed, and dry runs, stay what they are. Null keys are never known.
    """
    earlier = known.select(F.col(key).alias("_key"), F.col(version).alias("_version"))
    named = outcomes.join(earlier, F.col(key) == F.col("_key"), "left")
    same = F.col("_version").eqNullSafe(F.col(version))
    status = (
        F.when((F.col("status") != OK) | F.col("_key").isNull(), F.col("status"))
        .when(same, F.lit(SKIPPED))
        .otherwise(F.lit(REPROCESS))
    )
    return named.withColumn("status", status).drop("_key", "_version")


def totals(df: DataFrame, key: str) -> DataFrame:
    """Counts per batch: records, environments and warnings."""
    return df.groupBy(key).agg(
        F.count(F.lit(1)).alias("measurements"),
        F.count("environment_id").alias("environments"),
        F.sum(F.size("warnings")).cast("bigint").alias("warnings"),
        F.count_if(F.size("errors") > 0).alias("failed"),
    )
