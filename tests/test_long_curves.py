"""Curves as rows against the same curves as arrays."""

import contextlib
import math
import random

import pytest
from conftest import curve_text
from pyspark.sql import functions as F
from test_curve_match import SCHEMA, expected, random_case

from measlake.operators import curve_match, long_match
from measlake.sources import reduced_text, split_text

FIELDS = ["experiment_id", "run_number", "reduction_version", "run_title", "run_start_time", "two_theta"]


@contextlib.contextmanager
def settings(spark, values):
    before = {key: spark.conf.get(key) for key in values}
    for key, value in values.items():
        spark.conf.set(key, value)
    yield spark
    for key, value in before.items():
        spark.conf.set(key, value)


@pytest.fixture
def small_splits(spark):
    with settings(spark, {"spark.sql.files.maxPartitionBytes": "700", "spark.sql.files.openCostInBytes": "1"}):
        yield spark


@pytest.fixture(params=["2", "9"])
def ranges(spark, request):
    """That many ranges, which Spark does not join although they are small."""
    values = {"spark.sql.shuffle.partitions": request.param, "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    with settings(spark, values):
        yield int(request.param)


def write(folder):
    rnd = random.Random(1)
    (folder / "a").mkdir()
    texts = {
        "one.txt": curve_text(run=1, n=400, meta={"run_number": 9}),
        "a/two.txt": curve_text(run=2, n=150).replace("\n", "\r\n"),
        "three.txt": "# only a header\n\n",
        "four.txt": "\n \n",
        "six%20é.txt": "1 2 3 4\r5 6 7 8\rx\r# late note",
    }
    lines = curve_text(run=5, n=300).split("\n")
    for _ in range(200):
        lines.insert(rnd.randrange(5, len(lines)), rnd.choice(["", "# note", "1 2 3", "a b c d", "1_0 2 3 4 5 6", " 1 2 3 nan "]))
    texts["five.txt"] = "\n".join(lines)
    for name, content in texts.items():
        (folder / name).write_bytes(content.encode())
    return [str(folder / name) for name in texts]


def test_split_files_equal_whole_files(small_splits, tmp_path):
    spark = small_splits
    paths = write(tmp_path)
    whole = {row.path: row for row in reduced_text.read(spark, str(tmp_path)).collect()}
    lines = split_text.read_lines(spark, str(tmp_path))
    assert lines.select("path", "split").distinct().filter(F.col("path").endswith("five.txt")).count() > 10
    headers, points = split_text.read(spark, str(tmp_path))
    found = {row.path: row for row in headers.collect()}
    assert set(found) == set(whole) == set(paths)
    curves = {path: [] for path in paths}
    for row in points.orderBy("path", "position").collect():
        assert row.position == len(curves[row.path])
        curves[row.path].append((row.q, row.r, row.dr, row.dq))
    for path in paths:
        assert [found[path][name] for name in FIELDS] == [whole[path][name] for name in FIELDS]
        listed = list(zip(whole[path].q, whole[path].r, whole[path].dr, whole[path].dq))
        assert repr(curves[path]) == repr(listed)


def test_no_lines(spark, tmp_path):
    lines = spark.createDataFrame([], "path string, split bigint, row bigint, line string")
    assert split_text.headers(lines).collect() == []
    assert split_text.points(lines).collect() == []


def as_rows(spark, cases):
    points = [(i, float(x), float(y)) for i, (q, r, _) in enumerate(cases) for x, y in zip(q, r)]
    knots = [
        (i, d, k, float(x), float(y))
        for i, (_, _, probes) in enumerate(cases)
        for d, (q, r) in enumerate(probes)
        for k, (x, y) in enumerate(zip(q, r))
    ]
    return (
        spark.createDataFrame(points, "run int, q double, r double").repartition(3),
        spark.createDataFrame(knots, "model int, dataset int, pos int, q double, r double").repartition(3),
        spark.createDataFrame([(i, i) for i in range(len(cases))], "run int, model int"),
    )


def as_arrays(spark, cases):
    rows = [(i, q, r, [{"q": a, "r": b} for a, b in probes]) for i, (q, r, probes) in enumerate(cases)]
    probes = F.transform("d", lambda d: curve_match.probe(d["q"], d["r"]))
    scored = curve_match.scores(F.col("q"), F.col("r"), probes)
    df = spark.createDataFrame(rows, SCHEMA).select("id", F.explode(scored).alias("s"))
    return {(row.id, row.s.dataset): row.s.score for row in df.collect()}


def close(a, b):
    return a is b is None or (None not in (a, b) and (math.isclose(a, b, rel_tol=1e-9) or a != a and b != b))


def test_rows_score_as_arrays(spark, ranges):
    """With nine ranges a pair lies in several of them."""
    rng = random.Random(ranges)
    cases = [random_case(rng) for _ in range(60)]
    nan = math.nan
    cases += [
        ([0.5, nan, 1.0], [1.0, 1.0, 1.0], [([0.4, 0.8, 1.2], [1.0, 2.0, 3.0])]),
        ([0.5, nan, 1.0], [1.0, 1.0, 1.0], [([0.4, nan, 1.2], [1.0, 2.0, 3.0])]),
        ([0.5, 0.7], [nan, 1.0], [([0.4, 0.8], [1.0, nan]), ([0.5, 0.5, 0.7], [3.0, 1.0, 2.0])]),
    ]
    scored = long_match.scores(*as_rows(spark, cases))
    found = {(row.run, row.dataset): row.score for row in scored.collect()}
    wanted = as_arrays(spark, cases)
    assert set(found) == set(wanted)
    assert [key for key in wanted if not close(found[key], wanted[key])] == []
    won = {row.run: row.matched for row in long_match.best(scored).collect()}
    assert all(won.get(i) == expected(*case) for i, case in enumerate(cases[:60]))


def test_one_pair_lies_in_all_ranges(spark, ranges):
    points = spark.range(20000).select(
        F.lit(1).alias("run"), (F.col("id") / 20000 + 0.25).alias("q"), F.lit(2.0).alias("r")
    )
    # One knot far below and one far above: every range needs one from elsewhere.
    knots = spark.createDataFrame(
        [(1, 0, 0, 0.0, 1.0), (1, 0, 1, 2.0, 1.0)], "model int, dataset int, pos int, q double, r double"
    )
    runs = spark.createDataFrame([(1, 1)], "run int, model int")
    pairs = runs.join(long_match.probes_of(knots), "model")
    line = long_match.line_of(points, knots, pairs)
    sizes = line.groupBy("range").count().collect()
    assert len(sizes) == ranges and max(row["count"] for row in sizes) < 40000 / ranges
    assert [tuple(row) for row in long_match.scores(points, knots, runs).collect()] == [(1, 0, 0.5)]


def test_knots_from_arrays(spark):
    datasets = "array(named_struct('q', array(1d, 2d), 'r', array(3d)), named_struct('q', array(5d), 'r', array(6d)))"
    models = spark.range(1).select(F.lit("m").alias("key"), F.expr(datasets).alias("d"))
    found = [tuple(row) for row in long_match.knot_rows(models, "key", F.col("d")).collect()]
    assert found == [("m", 0, 0, 1.0, 3.0), ("m", 0, 1, 2.0, None), ("m", 1, 0, 5.0, 6.0)]
