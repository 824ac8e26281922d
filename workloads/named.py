"""Queries over files known by name: models with error files, run directories."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from measlake.session import scratch_path
from measlake.sinks.named_files import write_named
from measlake.sources import fit_model, run_dirs

from .base import load, query, text


def number() -> Column:
    return F.col("s_suppkey")


def nation() -> Column:
    return F.col("s_nationkey")


def file(name: str, content: Column, where: Column | None = None) -> Column:
    """A file in the supplier's folder, if the condition holds."""
    path = text("supplier ", number(), "/", name)
    return F.struct(path.alias("path"), (content if where is None else F.when(where, content)).alias("content"))


def write_all(spark: SparkSession, sf_dir: str, files: list[Column]) -> str:
    suppliers = load(spark, sf_dir, "supplier")
    return write_named(suppliers.select(F.inline(F.array(*files))), scratch_path(spark, "named"))


def supplier_of(path: str) -> Column:
    return F.regexp_extract(path, r"/supplier (\d+)", 1).cast("bigint")


def model_text() -> Column:
    return text(
        '{"references": {"t": {"name": "film thick", "fixed": false, "slot": {"value": ', number(), '}}, ',
        '"u": {"name": "unused", "value": 1}}, "object": {"name": "', F.col("s_name"), '", "sample": {"layers": [',
        '{"name": "air", "thickness": 0}, {"name": "film", "thickness": {"__class__": "Reference", "id": "t"}, ',
        '"material": {"rho": ', F.round("s_acctbal", 2), '}}, {"name": "Si", "thickness": 0}]}}}',
    )


_MODELS_SQL = """
SELECT s_suppkey AS supplier, s_name AS model_name, CAST(s_suppkey AS DOUBLE) AS thickness, round(s_acctbal, 2) AS sld,
  CASE WHEN s_suppkey % 3 = 0 THEN s_nationkey / 4.0::DOUBLE END AS thickness_std, 1 AS free
FROM supplier
"""


@query("model_files", _MODELS_SQL)
def model_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Model files with their companion error files, read from disk; two of three have none."""
    errors = text('{"film thick": {"std": ', nation() / 4.0, "}}")
    base = write_all(
        spark,
        sf_dir,
        [
            file("fit.v1.json", model_text()),
            file("fit.v1-err.json", errors, number() % 3 == 0),
            file("fit-err.json", F.lit('{"film thick": {"std": 999}}')),
        ],
    )
    film = F.get("stack", F.lit(1))
    return fit_model.read(spark, base).select(
        supplier_of("path").alias("supplier"),
        "model_name",
        film["thickness"].alias("thickness"),
        film["sld"].alias("sld"),
        film["thickness_std"].alias("thickness_std"),
        F.col("num_free_parameters").alias("free"),
    )


_RUN_DIRS_SQL = """
SELECT s_suppkey AS supplier, CASE WHEN s_suppkey % 5 = 4 THEN 0 ELSE 2 END AS data_files,
  CASE WHEN s_suppkey % 2 = 0 THEN s_nationkey + 0.5::DOUBLE ELSE s_nationkey + 0.25::DOUBLE END AS chi_squared,
  CASE WHEN s_suppkey % 2 = 0 THEN 'at OCV' ELSE 'saved' END AS state_text,
  CASE WHEN s_suppkey % 7 <> 0 THEN CAST(s_suppkey AS DOUBLE) END AS thickness,
  CASE WHEN s_suppkey % 7 <> 0 AND s_suppkey % 3 = 0 THEN 1.0::DOUBLE WHEN s_suppkey % 7 <> 0 THEN 2.0::DOUBLE END AS thickness_std,
  CASE WHEN s_suppkey % 5 = 4 THEN 'run_info.json lists no data files' ELSE '' END AS errors
FROM supplier
"""


@query("run_dir_files", _RUN_DIRS_SQL)
def run_dir_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Run directories read from disk; pieces are missing from some, and error files come in twos."""
    state = text('{"state": {"best_chi2": 0, "current_chi2": ', nation() + 0.25, ', "states": [{"extra_description": "saved"}]}}')
    final = text('{"final_chi2": ', nation() + 0.5, ', "state": {"states": [{"extra_description": "at OCV"}]}}')
    names = text('{"data_files": ["/c/', number(), '.txt", {"file": "/c/b.txt"}]}')
    error = '{"film thick": {"std": %d}}'
    base = write_all(
        spark,
        sf_dir,
        [
            file("run_info.json", F.when(number() % 5 == 4, "{}").otherwise(names)),
            file("problem.json", model_text(), number() % 7 != 0),
            file("final_state.json", final, number() % 2 == 0),
            file("checkpoints/004_fitting.json", state),
            file("refl1d_output/a/x-err.json", F.lit(error % 1), number() % 3 == 0),
            file("refl1d_output/b/x-err.json", F.lit(error % 2)),
        ],
    )
    film = F.get("model.stack", F.lit(1))
    only = F.get("states", F.lit(0))
    return run_dirs.read(spark, base).select(
        supplier_of("job").alias("supplier"),
        F.size(only["files"]).alias("data_files"),
        "chi_squared",
        only["extra_description"].alias("state_text"),
        film["thickness"].alias("thickness"),
        film["thickness_std"].alias("thickness_std"),
        F.regexp_replace(F.array_join("errors", "; "), "[^;]*/", "").alias("errors"),
    )
