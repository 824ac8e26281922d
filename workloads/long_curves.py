"""Curves as rows: files read in splits, and curve matching over ranges."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from measlake.operators import long_match
from measlake.session import scratch_path
from measlake.sources import split_text

from .base import load, query, text
from .curves import _MATCH_SQL
from .scans import IN_TASKS, NAME, folder

ORDER = ("l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice")


def write_long_curves(spark: SparkSession, sf_dir: str) -> str:
    """A curve file per supplier, with a line per order line: points, notes and other lines."""
    base = scratch_path(spark, "long-curves")
    lines = load(spark, sf_dir, "lineitem")
    point = text(
        "  ", F.col("l_quantity"), "\t", F.col("l_extendedprice"), " ", F.col("l_discount"), " ", F.col("l_tax")
    )
    line = (
        F.when(F.col("l_linenumber") == 5, F.lit("not a point"))
        .when(F.col("l_linenumber") == 6, text("# Run title: order ", F.col("l_orderkey")))
        .otherwise(point)
    )
    heads = load(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("set"),
        F.array(F.lit(-1.0), *[F.lit(0.0)] * 3).alias("order"),
        text("# Experiment IPTS-", F.col("s_nationkey"), " Run ", F.col("s_suppkey")).alias("value"),
    )
    rows = lines.select(
        F.col("l_suppkey").alias("set"), F.array(*[F.col(c).cast("double") for c in ORDER]).alias("order"), line
    )
    whole = heads.union(rows).repartition("set").sortWithinPartitions("set", "order")
    whole.drop("order").write.partitionBy("set").options(**{NAME: "REFL_long", **IN_TASKS}).text(base)
    return base


_SPLIT_SQL = """
WITH placed AS (
  SELECT l_suppkey AS supplier, l_quantity AS q, l_extendedprice AS r, row_number() OVER (
    PARTITION BY l_suppkey ORDER BY l_orderkey, l_linenumber, l_quantity, l_extendedprice) - 1 AS position
  FROM lineitem WHERE l_linenumber NOT IN (5, 6)
),
titles AS (
  SELECT l_suppkey AS supplier, 'order ' || min(l_orderkey) AS run_title FROM lineitem WHERE l_linenumber = 6 GROUP BY 1
)
SELECT supplier, position, q, r, 'IPTS-' || s_nationkey AS experiment_id, run_title
FROM placed JOIN supplier ON s_suppkey = supplier LEFT JOIN titles USING (supplier)
"""


@query("split_curve_points", _SPLIT_SQL)
def split_curve_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Points of curve files read in splits, in the order of their file, with fields of the header."""
    headers, points = split_text.read(spark, write_long_curves(spark, sf_dir))
    return points.join(headers.select("path", "experiment_id", "run_title"), "path").select(
        folder(F.col("path")).alias("supplier"), "position", "q", "r", "experiment_id", "run_title"
    )


def knot(dataset: int, pos: Column, r: str) -> Column:
    q = (F.col("i") + 1) / F.lit(100.0)
    return F.struct(F.lit(dataset).alias("dataset"), pos.alias("pos"), q.alias("q"), F.col(r).alias("r"))


@query("long_curve_match", _MATCH_SQL)
def long_curve_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Curve matching as in ``curve_match``, with points and knots as rows."""
    vectors = load(spark, sf_dir, "embeddings")
    values = vectors.select("vec_id", "label", F.posexplode("embedding").alias("i", "v")).select(
        "vec_id", "label", "i", (2 + F.col("v").cast("double")).alias("r")
    )
    points = values.select(F.col("vec_id").alias("run"), ((F.col("i") + 1.5) / F.lit(100.0)).alias("q"), "r")
    curves = values.groupBy(F.col("label").alias("model"), "i").agg(
        F.min("r").alias("low"), F.avg("r").alias("mean"), F.max("r").alias("high")
    )
    # The last dataset is listed from high to low q.
    i = F.col("i")
    knots = curves.select("model", F.inline(F.array(knot(0, i, "low"), knot(1, i, "mean"), knot(2, -i, "high"))))
    runs = vectors.select(F.col("vec_id").alias("run"), F.col("label").alias("model"))
    won = long_match.best(long_match.scores(points, knots, runs))
    return won.select(F.col("run").alias("vec_id"), "dataset", F.round("score", 6).alias("score"), "matched")
