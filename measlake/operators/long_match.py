"""Curve matching for curves of any length (J6, A6, W2, T1 over rows).

``curve_match`` takes a curve as one row's array. Here points and knots are rows.
For each pair of a run and a dataset both lie on one line in order of q, cut into
ranges over all pairs, so that a long pair is many tasks. Within a range, the last knot
before a point and the first one behind it are running values; across ranges they
are carried over by a table with one row per pair and range. Scores are those of
``curve_match``. A run that shares its model with others brings the knots once more.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import scratch_path
from .curve_match import MIN_R, matched_dataset, range_distance

PAIR = ("run", "dataset")
# Place on the line: points without a position, then by q; points before knots that equal them.
ORDER = ("placed", "q", "kind", "tie")
_POINT, _KNOT = 0, 1


def knot_rows(models: DataFrame, key: str, datasets: Column) -> DataFrame:
    """Rows of knots from an array of datasets with arrays ``q`` and ``r``."""
    each = models.select(F.col(key).alias("model"), F.posexplode(datasets).alias("dataset", "d"))
    pairs = F.arrays_zip(F.col("d")["q"].alias("q"), F.col("d")["r"].alias("r"))
    return each.select("model", "dataset", F.posexplode(pairs).alias("pos", "z")).select(
        "model", "dataset", "pos", "z.q", "z.r"
    )


def _number(q: str) -> Column:
    return F.when(~F.isnan(q), F.col(q))


def probes_of(knots: DataFrame) -> DataFrame:
    """One row per dataset: range, direction, number of knots, whether some have no position."""
    known = F.col("q").isNotNull() & F.col("r").isNotNull()
    return knots.groupBy("model", "dataset").agg(
        F.min(_number("q")).alias("probe_min"),
        F.max(_number("q")).alias("probe_max"),
        (F.min_by("q", "pos") <= F.max_by("q", "pos")).alias("ascending"),
        F.count_if(known).alias("knots"),
        F.coalesce(F.bool_or(known & F.isnan("q")), F.lit(False)).alias("unplaced"),
        (F.count("q") > 0).alias("some_q"),
        (F.count("r") > 0).alias("some_r"),
    )


def line_of(points: DataFrame, knots: DataFrame, pairs: DataFrame) -> DataFrame:
    """Points and knots of every pair in one order, cut into ranges; written, read back."""
    usable = pairs.filter("knots >= 2")
    on_line = points.filter("q IS NOT NULL").join(usable.select(*PAIR, "unplaced"), "run")
    nothing = F.lit(None).cast("double")
    marks = on_line.select(
        *PAIR,
        (~F.isnan("q")).cast("int").alias("placed"),
        "q",
        F.lit(_POINT).alias("kind"),
        nothing.alias("tie"),
        "r",
        "unplaced",
    )
    known = knots.filter("q IS NOT NULL AND r IS NOT NULL AND NOT isnan(q)")
    anchors = known.join(usable.select(*PAIR, "model", "ascending"), ["model", "dataset"]).select(
        *PAIR,
        F.lit(1).alias("placed"),
        "q",
        F.lit(_KNOT).alias("kind"),
        F.when(F.col("ascending"), F.col("pos").cast("double")).otherwise(F.col("r")).alias("tie"),
        "r",
        F.lit(False).alias("unplaced"),
    )
    spark = points.sparkSession
    path = scratch_path(spark, "match-line")
    line = marks.unionByName(anchors).repartitionByRange(*PAIR, *ORDER)
    line = line.withColumn("range", F.spark_partition_id())
    line.write.parquet(path)
    return spark.read.schema(line.schema).parquet(path)


def bracketed(line: DataFrame) -> DataFrame:
    """Points with the knot before them (``low``) and at or behind them (``high``)."""
    knot = F.when(F.col("kind") == _KNOT, F.struct("q", "r"))
    place = F.when(F.col("kind") == _KNOT, F.struct("q", "tie"))
    ends = line.groupBy(*PAIR, "range").agg(
        F.min_by(knot, place).alias("first"), F.max_by(knot, place).alias("last")
    )

    def carried(end: str, order: Column) -> Column:
        earlier = Window.partitionBy(*PAIR).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
        return F.last(end, ignorenulls=True).over(earlier)

    ends = ends.select(
        *PAIR,
        "range",
        carried("last", F.asc("range")).alias("from_before"),
        carried("first", F.desc("range")).alias("from_behind"),
    )

    def running(order: list[Column]) -> Column:
        so_far = Window.partitionBy(*PAIR, "range").orderBy(*order)
        so_far = so_far.rowsBetween(Window.unboundedPreceding, Window.currentRow)
        return F.last(knot, ignorenulls=True).over(so_far)

    # Both directions run forward over the sorted rows; a frame that ends at the
    # last row would be summed up anew for every row.
    near = line.withColumn("low", running([F.asc(c) for c in ORDER])).withColumn(
        "high", running([F.desc(c) for c in ORDER])
    )
    return near.filter(F.col("kind") == _POINT).join(ends, [*PAIR, "range"]).select(
        *PAIR,
        "q",
        "r",
        "unplaced",
        F.coalesce("low", "from_before").alias("low"),
        F.coalesce("high", "from_behind").alias("high"),
    )


def curve_errors(points: DataFrame) -> DataFrame:
    """Mean relative distance to the line through the knots, for pairs with points inside."""
    low, high, q, r = F.col("low"), F.col("high"), F.col("q"), F.col("r")
    share = F.coalesce(F.try_divide(q - low["q"], high["q"] - low["q"]), F.lit(0.5))
    value = F.when(low.isNull(), high["r"]).otherwise(low["r"] + share * (high["r"] - low["r"]))
    value = F.when(F.isnan(q) & F.col("unplaced"), F.lit(float("nan"))).otherwise(value)
    outside = high.isNull() | (low.isNull() & (q < high["q"]))
    distance = F.abs(value - r) / F.greatest(F.abs(r), F.lit(MIN_R))
    inside = points.filter(~outside).select(*PAIR, distance.alias("distance"))
    # A distance that is missing makes the mean missing, as it does for arrays.
    mean = F.when(F.count("distance") == F.count(F.lit(1)), F.avg("distance"))
    return inside.groupBy(*PAIR).agg(mean.alias("error"))


def scores(points: DataFrame, knots: DataFrame, runs: DataFrame) -> DataFrame:
    """(run, dataset, score) of each run against the datasets of its model.

    ``points``: run, q, r. ``knots``: model, dataset, pos, q, r. ``runs``: run,
    model. A run without points and a dataset without q or r have no score.
    """
    spans = points.groupBy("run").agg(F.min(_number("q")).alias("low"), F.max(_number("q")).alias("high"))
    probes = probes_of(knots).filter("some_q AND some_r")
    pairs = runs.select("run", "model").join(spans, "run").join(probes, "model")
    errors = curve_errors(bracketed(line_of(points.select("run", "q", "r"), knots, pairs)))
    by_range = range_distance(F.col("low"), F.col("high"), F.col("probe_min"), F.col("probe_max"))
    score = F.when(F.col("error") < F.lit(float("inf")), F.col("error")).otherwise(by_range)
    return pairs.join(errors, list(PAIR), "left").select(*PAIR, score.alias("score"))


def best(scored: DataFrame) -> DataFrame:
    """(run, dataset, score, matched): lowest score, first dataset on ties."""
    won = F.min(F.when(F.col("score").isNotNull(), F.struct("score", "dataset")))
    return scored.groupBy("run").agg(won.alias("won")).filter("won IS NOT NULL").select(
        "run",
        F.col("won.dataset").alias("dataset"),
        F.col("won.score").alias("score"),
        matched_dataset(F.col("won")).alias("matched"),
    )
