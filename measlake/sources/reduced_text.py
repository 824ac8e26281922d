"""Reduced curve files: ``#`` header lines and Q R dR dQ columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import any_time, capture_text, non_empty, strip, to_number
from ..operators.rows import once
from .files import read_texts

# Header lines the reader knows. White space may cross line ends.
_EXPERIMENT = r"(?iU)Experiment\s+(IPTS-\d+)\s+Run\s+(\d+)"
_REDUCTION = r"(?idmU)Reduction\s+(.+)$"
_TITLE = r"(?idmU)Run title:\s*(.+)$"
_START = r"(?idmU)Run start time:\s*(.+)$"
_REDUCED_AT = r"(?idmU)Reduction time:\s*(.+)$"
_META = r"(?idmU)^Meta\s*:\s*(\{.*)$"
_RUN_TABLE = r"(?dmU)^\s*\d+\s+\d+\s+([\d.eE+-]+)"


def split_lines(content: Column) -> Column:
    """Stripped, non-empty lines of a text, whatever its line ends are."""
    lines = F.split(F.regexp_replace(content, r"\r\n?", "\n"), "\n")
    return F.filter(F.transform(lines, strip), lambda line: line != "")


def header_text(lines: Column) -> Column:
    """The ``#`` lines without the mark, joined again."""
    marked = F.filter(lines, lambda line: F.startswith(line, F.lit("#")))
    return F.array_join(F.transform(marked, lambda line: strip(F.substring(line, 2, 2**31 - 1))), "\n")


def curve_points(lines: Column) -> Column:
    """Array of (q, r, dr, dq) of the rows whose first four tokens are numbers."""
    rows = F.filter(lines, lambda line: ~F.startswith(line, F.lit("#")))
    tokens = F.filter(F.transform(rows, lambda row: F.split(row, r"(?U)\s+")), lambda t: F.size(t) >= 4)
    points = F.transform(
        tokens,
        lambda t: F.struct(
            *[to_number(t.getItem(i)).alias(name) for i, name in enumerate(("q", "r", "dr", "dq"))]
        ),
    )
    return F.filter(
        points,
        lambda p: p["q"].isNotNull() & p["r"].isNotNull() & p["dr"].isNotNull() & p["dq"].isNotNull(),
    )


def parse(texts: DataFrame) -> DataFrame:
    """Read ``path`` and ``content`` into one row per curve file."""
    keep = [c for c in texts.columns if c != "content"]
    # Each step's results are used several times by the next one.
    lines = once(texts, F.struct(split_lines(F.col("content")).alias("lines")), "lines")
    parts = once(
        lines.select(*keep, "lines"),
        F.struct(
            header_text(F.col("lines")).alias("header"),
            curve_points(F.col("lines")).alias("points"),
        ),
        "header",
        "points",
    )
    fields = described(parts.select(*keep, "header", "points"))
    return fields.select(
        *[c for c in fields.columns if c != "points"],
        *[F.col("points")[c].alias(c) for c in ("q", "r", "dr", "dq")],
    )


def described(parts: DataFrame) -> DataFrame:
    """Replace ``header``, the joined header lines, by the fields found in it."""
    keep = [c for c in parts.columns if c != "header"]
    header = F.col("header")
    found = once(
        parts,
        F.struct(
            strip(capture_text(header, _START)).alias("start"),
            strip(capture_text(header, _REDUCED_AT)).alias("reduced"),
            F.try_parse_json(capture_text(header, _META)).alias("meta"),
        ),
        "start",
        "reduced",
        "meta",
    )

    def meta_text(name: str) -> Column:
        return F.try_variant_get("meta", f"$.{name}", "string")

    return found.select(
        *keep,
        capture_text(header, _EXPERIMENT, 1).alias("experiment_id"),
        capture_text(header, _EXPERIMENT, 2).try_cast("bigint").alias("run_number"),
        strip(capture_text(header, _REDUCTION)).alias("reduction_version"),
        strip(capture_text(header, _TITLE)).alias("run_title"),
        any_time(F.col("start")).alias("run_start_time"),
        any_time(F.col("reduced")).alias("reduction_time"),
        "meta",
        F.struct(
            non_empty(meta_text("experiment")).alias("experiment"),
            meta_text("run_number").alias("run_number"),
            non_empty(meta_text("run_title")).alias("run_title"),
            non_empty(meta_text("start_time")).alias("start_time"),
        ).alias("meta_fields"),
        F.filter(
            F.transform(F.regexp_extract_all(header, F.lit(_RUN_TABLE), F.lit(1)), to_number),
            lambda angle: angle.isNotNull(),
        ).alias("two_theta"),
    )


def read(spark: SparkSession, paths: list[str] | str) -> DataFrame:
    """Curve files under the paths, one row each."""
    return parse(read_texts(spark, paths))
