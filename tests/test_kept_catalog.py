"""A second listing reads only what changed."""

import os

import pytest
from pyspark.sql import functions as F

from measlake.plans import discovery
from measlake.sources import files, kept_catalog

CURVE = "# Experiment IPTS-7 Run 200001\n# Q [1/Angstrom] R\n"


def write(base, **named):
    for name, content in named.items():
        path = base / name.replace("__", "/").replace("_dot_", ".")
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_text(content)


def rows(df):
    return {r.path.split("lake/")[1]: r for r in df.collect()}


def states(df):
    return {name: r.state for name, r in rows(df).items()}


@pytest.fixture
def lake(tmp_path):
    base = tmp_path / "lake"
    write(base, a__REFL_200001_dot_txt=CURVE, a__deep__er__m_dot_json='{"refl1d": 1}', b__r_200001_dot_parquet="p")
    write(base, b__empty_dot_txt="", b___hidden="x", c__sp_ce_dot_dat="x")
    (base / "b" / ".dot").write_text("x")
    return base


def test_listing_is_that_of_spark_with_empty_files(spark, lake):
    found = rows(kept_catalog.list_files(spark, [f"{lake}"]))
    whole = rows(files.catalog(spark, [f"{lake}"]))
    assert set(found) == set(whole) | {"b/empty.txt"}
    assert all(found[name].length == r.length for name, r in whole.items())
    twice = rows(kept_catalog.list_files(spark, [f"{lake}/b", f"{lake}"]))
    assert set(twice) == set(found)
    assert twice["b/empty.txt"].root_ord == 0 and twice["c/sp_ce.dat"].root_ord == 1


def test_second_listing(spark, lake, tmp_path):
    base = f"{tmp_path}/catalog"
    first = kept_catalog.refresh(spark, [f"{lake}"], base)
    assert set(states(first).values()) == {"added"}
    kinds = {name: r.file_type for name, r in rows(first).items()}
    assert kinds["a/REFL_200001.txt"] == "reduced" and kinds["a/deep/er/m.json"] == "model"
    assert kinds["b/r_200001.parquet"] == "parquet" and kinds["b/empty.txt"] == "unknown"
    write(lake, a__deep__er__m_dot_json='{"other": 11}', d__new_dot_txt=CURVE)
    os.remove(lake / "c" / "sp_ce.dat")
    second = kept_catalog.refresh(spark, [f"{lake}"], base)
    found = states(second)
    assert found.pop("a/deep/er/m.json") == "changed" and found.pop("d/new.txt") == "added"
    assert found.pop("c/sp_ce.dat") == "gone" and set(found.values()) == {"same"}
    assert rows(second)["a/deep/er/m.json"].file_type == "unknown"
    assert set(rows(kept_catalog.read(spark, base))) == set(states(second)) - {"c/sp_ce.dat"}
    third = kept_catalog.refresh(spark, [f"{lake}"], base)
    assert set(states(third).values()) == {"same"} and "c/sp_ce.dat" not in states(third)
    assert kept_catalog.versions(base) == [1, 2, 3]


def test_unchanged_texts_are_not_read(spark, lake):
    listed = kept_catalog.list_files(spark, [f"{lake}"])
    known = kept_catalog.refreshed(None, listed).withColumn("file_type", F.lit("as stored"))
    write(lake, d__new_dot_txt=CURVE)
    found = rows(kept_catalog.refreshed(known, kept_catalog.list_files(spark, [f"{lake}"])))
    assert found.pop("d/new.txt").file_type == "reduced"
    assert {r.file_type for r in found.values()} == {"as stored"}


def test_a_version_that_was_not_ended_does_not_count(spark, lake, tmp_path):
    base = tmp_path / "catalog"
    kept_catalog.refresh(spark, [f"{lake}"], f"{base}")
    (base / "version=2").mkdir()
    found = kept_catalog.refresh(spark, [f"{lake}"], f"{base}")
    assert set(states(found).values()) == {"same"}
    assert kept_catalog.versions(f"{base}") == [1, 3]


def test_empty_folders_and_missing_roots(spark, tmp_path):
    (tmp_path / "lake").mkdir()
    assert kept_catalog.refresh(spark, [f"{tmp_path}/lake"], f"{tmp_path}/catalog").count() == 0
    with pytest.raises(Exception, match="not_there"):
        kept_catalog.list_files(spark, [f"{tmp_path}/not_there"]).collect()


def test_a_file_gone_before_it_is_read(spark, lake):
    listed = kept_catalog.list_files(spark, [f"{lake}"])
    os.remove(lake / "a" / "REFL_200001.txt")
    assert "a/REFL_200001.txt" not in rows(kept_catalog.refreshed(None, listed))


def test_file_sets_without_reading_texts(spark, lake, tmp_path):
    stored = kept_catalog.refresh(spark, [f"{lake}"], f"{tmp_path}/catalog").drop("state")
    sets, _ = discovery.discover_kept(stored)
    wanted, _ = discovery.discover_under(spark, [f"{lake}"])
    columns = ["run_number", "reduced_file", "model_file", "completeness"]
    assert sets.select(columns).collect() == wanted.select(columns).collect()
