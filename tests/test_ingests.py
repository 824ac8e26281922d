"""Ingests that count whole or not at all."""

import pytest
from test_workflow import CURVES, FINAL, OTHER, STACK, model, probe_of, run

from measlake.sinks import ingests
from measlake.sources import files

TABLES = ("reflectivity", "sample", "environment", "reflectivity_model")


def batch_of(spark, ingest, name="a"):
    pieces = {
        f"/w/{name}/run_info.json": {"data_files": ["/c/REFL_1.txt", "/c/REFL_2.txt"]},
        f"/w/{name}/final_state.json": FINAL,
        f"/w/{name}/problem.json": model([STACK, OTHER], [probe_of(), probe_of(scale=4.0)]),
        f"/w/{name}-bad/run_info.json": {},
    }
    return run(spark, ingest, pieces, CURVES)


def counts(lake):
    return [lake.read(name).count() for name in TABLES]


def test_an_ingest_counts_once_and_whole(spark, ingest, tmp_path, monkeypatch):
    base = str(tmp_path / "lake")
    empty = ingests.Snapshot(spark, base)
    assert counts(empty) == [0, 0, 0, 0]
    assert empty.report("issues", "message string").collect() == []

    # A run that stops between two tables leaves nothing to be seen.
    write = ingests.write_table

    def stops(df, base, table, **options):
        if table == "environment":
            raise RuntimeError("lost")
        return write(df, base, table, **options)

    monkeypatch.setattr(ingests, "write_table", stops)
    with pytest.raises(RuntimeError):
        ingests.write_ingest(batch_of(spark, ingest), base, "week 1/é")
    assert counts(ingests.Snapshot(spark, base)) == [0, 0, 0, 0]
    monkeypatch.setattr(ingests, "write_table", write)

    paths = ingests.write_ingest(batch_of(spark, ingest), base, "week 1/é")
    first = ingests.Snapshot(spark, base)
    assert counts(first) == [2, 1, 1, 1]
    assert ingests.write_ingest(batch_of(spark, ingest), base, "week 1/é") == paths
    assert ingests.entries(spark, base).count() == len(paths) == 6

    # Readers keep what they hold; the next list has both.
    ingests.write_ingest(batch_of(spark, {**ingest, "ingest_id": "i2"}, "b"), base, "week 2")
    assert counts(first) == [2, 1, 1, 1]
    both = ingests.Snapshot(spark, base)
    assert counts(both) == [4, 2, 2, 2]
    assert both.read("fit").count() == 2
    assert both.read("reflectivity", years=[1999]).count() == 0
    assert both.report("outcomes", "job string, status string").count() == 4

    stopped = ingests.stopped_attempts(spark, base, files.catalog(spark, [base])).collect()
    assert {row.attempt.split("/")[-3] for row in stopped} == {"reflectivity", "sample"}
    assert not {row.attempt for row in stopped} & set(paths.values())
    assert ingests.changed_tables(spark, base).collect() == []
    spark.createDataFrame([("x",)], "job string").write.mode("append").parquet(both.paths("outcomes")[0])
    assert [row.table for row in ingests.changed_tables(spark, base).collect()] == ["outcomes"]


def test_the_first_of_two_at_a_time_counts(spark, ingest, tmp_path, monkeypatch):
    base = str(tmp_path)
    ingests.write_ingest(batch_of(spark, ingest), base, "x")
    # The second did not see the first when it began.
    monkeypatch.setattr(ingests.Snapshot, "__init__", lambda self, *_: setattr(self, "tables", {}))
    with pytest.raises(Exception, match="(?i)exists"):
        ingests.write_ingest(batch_of(spark, ingest), base, "x")
    monkeypatch.undo()
    assert counts(ingests.Snapshot(spark, base)) == [2, 1, 1, 1]
