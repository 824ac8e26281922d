"""Numbers, times and curve texts."""

import datetime
import math

import pytest
from conftest import curve_text
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from measlake.functions.text import any_time, iso_time, strip, to_number
from measlake.sources import reduced_text


def column(spark, values, fn):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    return [r.x for r in df.select("i", fn(F.col("v")).alias("x")).orderBy("i").collect()]


def python_number(token):
    try:
        return float(token)
    except ValueError:
        return None


def same(a, b):
    return a == b or (a is not None and b is not None and math.isnan(a) and math.isnan(b))


TOKENS = [
    "1", "-1.5", "+.5", "5.", ".", "1e5", "1E-3", "1e", "e5", "1.0d", "1f", "0x10", "1_0", "1__0", "_1",
    "1_000.5_0e1_0", "nan", "NaN", "-nan", "inf", "+Infinity", "-inf", "infin", "", "abc", "1,5", "--1", "1-2", "１",
]


def test_numbers_follow_python(spark):
    got = column(spark, TOKENS[:-1], to_number)
    for token, value in zip(TOKENS, got):
        assert same(value, python_number(token)), token


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(alphabet="0123456789+-._eEdfxinaINF", max_size=8), min_size=20, max_size=60))
def test_numbers_follow_python_on_random_tokens(spark, tokens):
    for token, value in zip(tokens, column(spark, tokens, to_number)):
        assert same(value, python_number(token)), token


def test_strip_takes_any_white_space(spark):
    assert column(spark, ["\t a b\r\n", " x ", ""], strip) == ["a b", "x", ""]


def test_times(spark):
    values = [
        "2026-03-30T09:52:00.244352667", "2024-01-15T10:30:00Z", "2024-01-15 10:30", "2024-01-15T10:30:00+02:00",
        "Mon Apr 27 17:40:41 2026", "27 Apr 2026 17:40:41", "04/27/2026 17:40:41", "20240115T103000", "soon", "", None,
    ]
    d = datetime.datetime
    got = column(spark, values, any_time)
    assert got == [
        d(2026, 3, 30, 9, 52, 0, 244352), d(2024, 1, 15, 10, 30), d(2024, 1, 15, 10, 30), d(2024, 1, 15, 8, 30),
        d(2026, 4, 27, 17, 40, 41), d(2026, 4, 27, 17, 40, 41), d(2026, 4, 27, 17, 40, 41), d(2024, 1, 15, 10, 30),
        None, None, None,
    ]
    assert column(spark, ["10:30", "2024", "Mon Apr 27 17:40:41 2026"], iso_time) == [None, None, None]


def parse_one(spark, content, path="/x/REFL_1.txt"):
    df = spark.createDataFrame([(path, content)], "path string, content string")
    return reduced_text.parse(df).collect()[0]


def test_curve_text(spark):
    meta = {"experiment": "IPTS-9", "run_number": "12", "run_title": "t", "start_time": "2026-03-30T09:52:00.244352667", "scale": {"a": 25.0}}
    row = parse_one(spark, curve_text(run=12, n=30, meta=meta))
    assert row.experiment_id == "IPTS-77" and row.run_number == 12
    assert row.reduction_version == "3.1" and row.run_title == "title 12"
    assert row.run_start_time == datetime.datetime(2024, 5, 6, 7, 8, 9, 123456)
    assert row.meta_fields.experiment == "IPTS-9" and row.meta_fields.run_number == "12"
    assert row.two_theta == [1.25] and len(row.q) == 30 and row.q[0] == 0.01


def test_white_space_in_patterns_crosses_lines(spark):
    text = "# combined data from reflectivity reduction\n# Datafile created by Q\n# Experiment IPTS-5\n# Run 6\n0.1 1 1 1\n"
    row = parse_one(spark, text)
    assert row.reduction_version == "Datafile created by Q"
    assert (row.experiment_id, row.run_number) == ("IPTS-5", 6)


@pytest.mark.parametrize("meta", ["{not valid json,,,", "[1]", "{}"])
def test_odd_meta_is_tolerated(spark, meta):
    row = parse_one(spark, f"# Meta:{meta}\n# Experiment IPTS-1 Run 1\n1 2 3 4\n")
    assert row.meta_fields.experiment is None and row.experiment_id == "IPTS-1" and row.q == [1.0]


def test_rows_that_are_not_data_are_skipped(spark):
    text = "# h\r\n1 2 3 4\r\n\r\n1 2 3\r\n a b c d\r\n1 nan inf 4 5 6\r\n1_0 1 1 1\r\n1.0d 1 1 1\r\n"
    row = parse_one(spark, text)
    assert row.q == [1.0, 1.0, 10.0] and math.isnan(row.r[1]) and row.dr[1] == math.inf
    assert row.run_title is None and row.meta is None


def test_empty_file(spark):
    row = parse_one(spark, "")
    assert row.q == [] and row.experiment_id is None and row.two_theta == []
