"""The path of a record's file is taken apart once per row, in time linear in its length."""

import itertools

from pyspark.sql import functions as F

from measlake.functions import names
from measlake.sources import run_records


def test_a_path_is_decoded_once_per_row(spark, tmp_path):
    rows = spark.range(3).selectExpr("'REF_L' AS instrument_id", "id AS run_number", "CAST(id AS STRING) AS run_id")
    rows.coalesce(1).write.option("mapreduce.output.basename", "run_sample").parquet(str(tmp_path / "a b"))
    found = run_records.read_sample_identity(spark, str(tmp_path))
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.lower().count("decode") == 1
    folder = str(tmp_path / "a b")
    assert {(r.run_number, r.dir, r.file_path.startswith(f"{folder}/run_sample")) for r in found.collect()} == {
        (n, folder, True) for n in range(3)
    }


def test_names_and_folders_are_those_of_the_plain_patterns(spark):
    paths = ["".join(p) for n in range(6) for p in itertools.product("/a\n\r.", repeat=n)]
    paths += ["/" + "x" * 200 + "/b c.txt", "//a//b//", "s3a://b/c/d.parquet"]
    rows = spark.createDataFrame([(p,) for p in paths], "path string")
    path = F.col("path")
    wrong = rows.filter(
        (names.file_name(path) != F.regexp_extract(path, r"([^/]*)/*$", 1))
        | (names.parent_dir(path) != F.regexp_replace(path, r"/+[^/]*$", ""))
    )
    assert wrong.collect() == []
