"""Kept coverage parts and places over ranges, against the direct forms."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from measlake import store
from measlake.operators import coverage, kept_coverage, ranges


def table(spark, start, stop):
    n = F.col("id")
    return spark.range(start, stop).select(
        F.when(n % 3 > 0, n).alias("n"),
        F.when(n % 5 > 0, F.struct(F.when(n % 2 > 0, n.cast("string")).alias("a.b"), (n / 2).alias("half"))).alias("s"),
        F.when(n % 7 == 0, F.lit(float("nan"))).otherwise(n.cast("double")).alias("x"),
        F.array().alias("none"),
    )


def profiles(spark, parts, path):
    whole = coverage.profile(spark.read.option("mergeSchema", True).parquet(path))
    found = kept_coverage.merged(parts).select(*whole.columns)
    return sorted(map(tuple, found.collect())), sorted(map(tuple, whole.collect()))


def test_after_appends(spark, tmp_path):
    path, kept = f"{tmp_path}/t", f"{tmp_path}/k"
    for turn in range(3):
        rows = table(spark, turn * 50, turn * 50 + 50).drop("s")
        (rows.withColumn("late", F.lit("z")) if turn == 2 else rows).write.mode("append").parquet(path)
        parts = kept_coverage.refresh(spark, path, kept)
        found, wanted = profiles(spark, parts, path)
        assert found == wanted
    ends = {r.field: r for r in kept_coverage.merged(parts).collect()}
    assert (ends["n"].low_number, ends["n"].high_number) == (1.0, 149.0)
    assert (ends["x"].low_number, ends["x"].high_number) == (1.0, 149.0)
    assert (ends["late"].low_text, ends["late"].populated, ends["late"].missing) == ("z", 50, 100)
    assert len(list((tmp_path / "k").iterdir())) == 3
    kept_coverage.refresh(spark, path, kept)
    assert len(list((tmp_path / "k").iterdir())) == 3


def test_only_new_files_are_read_and_old_ones_forgotten(spark, tmp_path):
    path, kept = f"{tmp_path}/t", f"{tmp_path}/k"
    table(spark, 0, 40).drop("s").coalesce(1).write.parquet(path)
    kept_coverage.refresh(spark, path, kept)
    table(spark, 40, 60).drop("s").coalesce(1).write.mode("overwrite").parquet(path)
    found, wanted = profiles(spark, kept_coverage.refresh(spark, path, kept), path)
    assert found == wanted


def test_nested_fields(spark, tmp_path):
    path, kept = f"{tmp_path}/t", f"{tmp_path}/k"
    rows = table(spark, 0, 30).withColumn("s", F.struct(F.col("s.half").alias("half"), F.lit("q").alias("t")))
    rows.write.parquet(path)
    found, wanted = profiles(spark, kept_coverage.refresh(spark, path, kept), path)
    assert found == wanted


def test_places_over_ranges(spark):
    """One key holds most of the rows; null keys and equal rows have places, too."""
    rows = spark.range(3000).select(
        F.when(F.col("id") % 10 == 0, F.col("id") % 4).when(F.col("id") % 10 < 9, 7).alias("k"),
        (F.col("id") % 1000).alias("a"),
    )
    found = ranges.numbered(rows, ["k"], ["a"], "place", "n")
    plain = rows.withColumn("place", F.row_number().over(Window.partitionBy("k").orderBy("a")) - 1)
    plain = plain.withColumn("n", F.count(F.lit(1)).over(Window.partitionBy("k")))
    assert found.exceptAll(plain).isEmpty() and plain.exceptAll(found).isEmpty()


def test_warnings_in_order(spark):
    rows = [("j", p, q, f"m{p}{q}", "warning") for p in range(3) for q in range(4)] + [("j", 0, 9, "e", "error")]
    issues = spark.createDataFrame(rows, "job string, pos int, position int, message string, severity string")
    whole = sorted(map(tuple, store.shown_warnings(issues, ["job"]).collect()))
    assert whole == [("j", n, f"m{n // 4}{n % 4}", 12) for n in range(12)]
    assert sorted(map(tuple, store.shown_warnings(issues, ["job"], 2).collect())) == whole[:2]
