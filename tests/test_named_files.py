"""Files written under given names and read back."""

import pytest
from pyspark.sql import functions as F

from measlake.sinks.named_files import inside, store_of, write_named
from measlake.sources.files import read_texts

FILES = "path string, content string"


def test_files_have_their_names_and_texts(spark, tmp_path):
    texts = {"a/one.json": "{}", "a/b c/zwei é%.txt": "é\n" * 5000, "top.txt": "x", "./a/./dot.txt": "y"}
    rows = [*texts.items(), ("nothing.txt", None)]
    base = write_named(spark.createDataFrame(rows, FILES).repartition(3), f"file:{tmp_path}/new")
    # Again, as a task that runs twice does.
    write_named(spark.createDataFrame(rows, FILES), base)
    found = {row.path: row.content for row in read_texts(spark, base).collect()}
    plain = {f"{tmp_path}/new/{path.replace('./', '')}": content for path, content in texts.items()}
    assert found == plain
    assert not [p for p in tmp_path.rglob("*") if p.name.startswith(".")]


def test_other_columns_and_no_rows(spark, tmp_path):
    more = spark.createDataFrame([("x.txt", "x", 1)], FILES + ", n int").select(F.lit(2).alias("m"), "*")
    write_named(more, str(tmp_path / "more"))
    assert (tmp_path / "more" / "x.txt").read_text() == "x"
    write_named(spark.createDataFrame([], FILES), str(tmp_path / "none"))


@pytest.mark.parametrize("path", [None, "", "/a", "../a", "a/../../b", ".", "a/"])
def test_paths_stay_in_the_folder(path):
    with pytest.raises(ValueError):
        inside(path)


def test_overwriting_is_refused(spark, tmp_path):
    write_named(spark.createDataFrame([("x", "x")], FILES), str(tmp_path))
    with pytest.raises(Exception, match="append"):
        spark.createDataFrame([("x", "x")], FILES).write.format("named_files").mode("overwrite").save(str(tmp_path))


def test_paths_of_stores():
    assert store_of("file:/a/b")[1] == store_of("/a/b")[1] == "/a/b"
