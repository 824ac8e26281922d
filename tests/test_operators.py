"""First rows, preference, links, issues, coverage and file sets."""

import json
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from measlake import store
from measlake.functions import instruments, names
from measlake.operators import coverage, issues, links
from measlake.operators.first_record import distinct_by_id, first_record
from measlake.operators.preference import log_values
from measlake.plans import discovery
from measlake.sources import files, manifest, run_records
from measlake.session import remove_scratch, scratch_path


def test_first_record_by_order(spark):
    rows = [("a", 2, "x"), ("a", 1, None), ("b", 1, "y"), (None, 0, "z")]
    df = spark.createDataFrame(rows, "k string, n int, v string").repartition(3)
    got = {r.k: (r.n, r.v) for r in first_record(df, ["k"], ["n"]).collect()}
    assert got == {"a": (1, None), "b": (1, "y")}


def test_distinct_by_id_keeps_the_first(spark):
    def part(rows):
        return spark.createDataFrame(rows, "id string, ord int, v string")

    out = distinct_by_id([part([("a", 0, "1"), (None, 1, "2")]), part([("a", 0, "3"), ("b", 1, "4"), (None, 2, "5")])])
    assert sorted((r.v for r in out.collect())) == ["1", "2", "4"]


def test_log_preference(spark):
    nan = float("nan")
    rows = [
        (1, "Temp", 0, 5.0, 1.0), (1, "Temp", 1, 6.0, 1.0), (1, "SampleTemp", 2, nan, 3.0), (1, "Other", 0, 9.0, 9.0),
        (2, "SampleTemp", 0, None, None), (2, "Temp", 0, 0.0, 4.0), (3, "SampleTemp", 0, 0.0, 4.0),
    ]
    logs = spark.createDataFrame(rows, "run int, log_name string, n int, average_value double, value_numeric double")
    values = log_values(logs, ["run"], instruments.log_names(), ["n"])

    def pick(handler):
        col = instruments.environment_value(F.lit(handler), F.col("log_values"), "temperature_logs")
        return {r.run: r.t for r in values.select("run", col.alias("t")).collect()}

    assert pick("GENERIC") == {1: 3.0, 2: 0.0, 3: 0.0}
    assert pick("REF_L") == {1: 3.0, 2: None, 3: None}
    numbers = log_values(logs, ["run"], ["Temp"], ["n"], prefer_average=False)
    assert {r.run: r.log_values["Temp"] for r in numbers.collect()} == {1: 1.0, 2: 4.0}


def test_children(spark):
    rows = [("p", f"c{i}", i) for i in reversed(range(2500))] + [("q", "x", 3), (None, "y", 1)]
    df = spark.createDataFrame(rows, "parent string, child string, ord int").repartition(4)
    found = sorted((r.parent, r.position, r.child) for r in links.children(df, "parent", "child", "ord").collect())
    assert found == [*(("p", i, f"c{i}") for i in range(2500)), ("q", 0, "x")]
    assert links.children(df.limit(0), "parent", "child", "ord").collect() == []


def test_first_of_group(spark):
    df = spark.createDataFrame([("a", 2, "x"), ("a", 1, "y"), ("b", 5, "z"), (None, 1, "w")], "g string, n int, v string")
    out = links.with_first_of_group(df, "g", ["n"], {"owner": "n", "text": "v"})
    assert {(r.g, r.n): (r.owner, r.text) for r in out.collect()} == {("a", 2): (1, "y"), ("a", 1): (1, "y"), ("b", 5): (5, "z"), (None, 1): (None, None)}


def test_issue_rows_gate_and_outcome(spark):
    rows = [(1, ["w1", "w2"], [], {"f": "look"}), (2, [], ["bad"], {}), (3, [], [], {})]
    df = spark.createDataFrame(rows, "id int, warnings array<string>, errors array<string>, needs_review map<string,string>")
    found = {(r.id, r.severity, r.field, r.message) for r in issues.explode_issues(df, ["id"]).collect()}
    assert found == {(1, "warning", None, "w1"), (1, "warning", None, "w2"), (1, "review", "f", "look"), (2, "error", None, "bad")}
    gated = {r.id: (r.is_complete, r.has_errors, r.needs_human_review) for r in issues.gate(df).collect()}
    assert gated == {1: (True, False, True), 2: (False, True, False), 3: (True, False, False)}
    out = issues.outcome(df, "t", "1", {"a": F.col("id"), "b": F.lit(None)}, {}, {})
    got = {r.id: (r.status, r.exit_code, r.params) for r in out.collect()}
    assert got == {1: ("ok", 0, {"a": "1"}), 2: ("failed", 1, {"a": "2"}), 3: ("ok", 0, {"a": "3"})}
    dry = issues.outcome(df, "t", "1", {}, {}, {}, dry_run=True).filter("id = 3").first()
    assert dry.status == "dry-run"


def test_coverage(spark):
    df = spark.createDataFrame(
        [(1, None, (1.0, None), []), (None, "x", None, None), (3, "y", (None, None), [1])],
        "a int, b string, s struct<x:double,y:double>, l array<int>",
    )
    got = {r.field: (r.populated, r.missing, r.coverage_pct) for r in coverage.profile(df).collect()}
    assert got == {"a": (2, 1, 66.7), "b": (2, 1, 66.7), "s.x": (1, 2, 33.3), "s.y": (0, 3, 0.0), "l": (2, 1, 66.7)}
    rows = df.select("b", coverage.record_coverage(df).alias("c")).collect()
    by_b = {r.b: (r.c.populated_fields, r.c.missing_field_names) for r in rows}
    assert by_b == {None: (3, ["b", "s.y"]), "x": (1, ["a", "s", "l"]), "y": (3, ["s.x", "s.y"])}
    assert coverage.profile(df.limit(0)).count() == 5


def test_names_per_key(spark):
    rows = [(1, f"n{i:03d}") for i in range(70)] * 2 + [(2, "a"), (2, None)]
    df = spark.createDataFrame(rows, "run int, name string")
    got = sorted((r.run, r.name, r.name_count) for r in coverage.names_per_key(df, ["run"], "name").collect())
    assert got == [*((1, f"n{i:03d}", 70) for i in range(70)), (2, "a", 1)]
    few = coverage.names_per_key(df, ["run"], "name", limit=3).collect()
    assert sorted((r.run, r.name) for r in few) == [(1, "n000"), (1, "n001"), (1, "n002"), (2, "a")]


def test_marks_beyond_the_head_of_a_file(spark):
    late = "x" * 5000
    lines = "nothing\n" * 40
    rows = [
        ("/a/m.json", "{" + late + '"$schema": "BUMPS"}'),
        ("/a/IPTS-/x.txt", lines + "# Experiment\n" + late + "\nReduction IPTS 77"),
        ("/a/y.txt", lines + "# Experiment"),
    ]
    df = spark.createDataFrame(rows, "path string, content string")
    found = [r.i for r in df.select(names.identify(F.col("path"), F.col("content")).alias("i")).collect()]
    assert [i.file_type for i in found] == ["model", "reduced", "unknown"]
    assert found[1].proposal == "IPTS-77"


def test_every_warning_is_listed(spark):
    rows = [("j", i // 3, i % 3, "warning", f"w{i}") for i in range(8)] + [("j", 0, 0, "error", "e")]
    df = spark.createDataFrame(rows, "job string, pos int, position int, severity string, message string")
    found = store.shown_warnings(df, ["job"])
    assert sorted((r.position, r.message, r.warnings) for r in found.collect()) == [(i, f"w{i}", 8) for i in range(8)]
    assert store.shown_warnings(df, ["job"], limit=5).count() == 5


def test_manifest_defaults_and_errors(spark):
    doc = {"output": "o", "measurements": [{"reduced": "/a"}, {"name": "n", "reduced": "", "model_dataset_index": 0}]}
    texts = spark.createDataFrame([("j", json.dumps(doc))], "path string, content string")
    normal = manifest.normalise(manifest.parse(texts))
    rows = manifest.measurements(normal).orderBy("pos").collect()
    assert [r.name for r in rows] == ["Measurement 1", "n"] and rows[1].reduced == ""
    messages = [r.message for r in manifest.validate(normal).orderBy("pos", "rank").collect()]
    assert messages == ["Measurement 'n': no curve file is named", "Measurement 'n': the dataset index counts from 1"]


def write(path, text="x"):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text)


def test_discovery_on_disk(spark, tmp_path):
    one, two = tmp_path / "one", tmp_path / "two"
    write(two / "REFL_301122_a.txt", "# Experiment IPTS-3\nReduction")
    write(one / "deep" / "REFL_301122_b.txt", "# Experiment IPTS-4\nReduction")
    write(one / "model_301122.json", '{"sample": {"layers": []}}')
    write(one / "x_301122_metadata.parquet")
    write(one / "x_301122_events.parquet")
    write(one / "x_301122_more.parquet")
    write(one / "run_301122_" / "unrelated.parquet")
    write(one / "REFL_99.txt", "# Experiment\nReduction")
    sets, found = discovery.discover_under(spark, [str(one), str(two)])
    rows = {r.run_number: r for r in sets.collect()}
    assert set(rows) == {301122, 99}
    row = rows[301122]
    assert row.reduced_file == str(one / "deep" / "REFL_301122_b.txt") and row.proposal == "IPTS-3"
    assert row.model_file and row.raw_file is None and row.other_parquet_count == 2
    assert row.completeness == 0.7 and row.parquet_dir == str(one)
    known = spark.createDataFrame([("/z/REF_L_99.h5",)], "path string")
    assert [r.run_number for r in discovery.related_to(sets, known).collect()] == [99]


def test_parquet_dirs(spark):
    listed = spark.createDataFrame([(p,) for p in ["/b/run_123456_x/a.parquet", "/b/run_123456_a/a.parquet", "/b/k_777777.parquet", "/b/run_888/x.txt"]], "path string")
    runs = spark.createDataFrame([(123456,), (777777,), (888,), (345,)], "run_number bigint")
    got = {r.run_number: r.parquet_dir for r in files.parquet_dir_of_runs(runs, listed, "/b/").collect()}
    assert got == {123456: "/b/run_123456_a", 777777: "/b", 888: None, 345: "/b/run_123456_a"}


def test_record_files_by_name(spark):
    names = ["X_Metadata.parquet", "sample.parquet", "sample_events.parquet", "daslogs.parquet", "users.parquet"]
    df = spark.createDataFrame([(i, n) for i, n in enumerate(names)], "i int, n string")
    got = [r.k for r in df.select("i", run_records.record_kind(F.col("n")).alias("k")).orderBy("i").collect()]
    assert got == ["metadata", "sample", None, "daslogs", None]


class SessionWith:
    """As much of a session as the scratch folder needs."""

    def __init__(self, master, **settings):
        self.sparkContext = type("Context", (), {"master": master})
        self.conf = settings


def test_scratch_path_uses_the_shared_folder(spark):
    assert "/spot-" in scratch_path(spark, "spot")
    shared = SessionWith("yarn", **{"spark.checkpoint.dir": "/shared/x/"})
    assert scratch_path(shared, "spot").startswith("/shared/x/spot-")
    with pytest.raises(ValueError):
        scratch_path(SessionWith("yarn"), "spot")


def test_scratch_of_this_process_alone_is_removed(tmp_path):
    shared = SessionWith("yarn", **{"spark.checkpoint.dir": f"{tmp_path}"})
    remove_scratch(SessionWith("yarn", **{"spark.checkpoint.dir": f"{tmp_path}/none"}))
    own = Path(scratch_path(shared, "spot"))
    (own / "part").mkdir(parents=True)
    (tmp_path / "spot-other-1").mkdir()
    remove_scratch(shared)
    assert [p.name for p in tmp_path.iterdir()] == ["spot-other-1"]
