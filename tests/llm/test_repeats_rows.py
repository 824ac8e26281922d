"""Repeated passages in rows without an id, with one id many times, and around frequent strings."""

import hashlib
import random
import re

import numpy as np
import plain
import pytest
from pyspark.sql import functions as F

from measlake.llm import repeats
from measlake.llm.common import configure, kept

COLUMNS = "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"
ROWS = "doc_id long, text string"


def found(spark, rows, kind=ROWS):
    table = spark.createDataFrame(rows, kind).repartition(3)
    result = repeats.digest(repeats.cut_repeats(table))
    return plain.in_order([tuple(row) for row in result.select(*COLUMNS).collect()])


def passage(rnd, length=300):
    return "".join(rnd.choice("abcdefghijklmnopqrstuvwxyz ") for _ in range(length))


def test_only_the_text_that_is_a_copy_goes(spark):
    configure(spark)
    x, y, z = (passage(random.Random(i)) for i in range(3))
    for rows in ([(1, x), (5, x), (5, y)], [(1, x), (None, x), (None, y), (None, z)]):
        assert found(spark, rows) == plain.in_order(plain.repeats(rows))
    removed = {row[0]: row[2] for row in found(spark, [(1, x), (2, y), (2, x)])}
    assert removed == {1: 0, 2: 300} or removed == {1: 0, 2: 0}


def random_rows(seed, count=200):
    rnd = random.Random(seed)
    shared = [passage(rnd, rnd.randint(40, 90)) for _ in range(8)]
    rows = []
    for i in range(count):
        doc_id = rnd.choice([None, 7, 8]) if rnd.random() < 0.3 else i
        if rows and rnd.random() < 0.25:
            rows.append((doc_id, rnd.choice(rows)[1]))
        else:
            parts = [rnd.choice([passage(rnd, rnd.randint(0, 60)), rnd.choice(shared)]) for _ in range(4)]
            rows.append((doc_id, "".join(parts)))
    return rows + [(None, None), (9, ""), (9, None)] + [(None, rows[3][1])] * 5 + [(7, rows[5][1])] * 5


@pytest.mark.parametrize("chunk,bucket,frequent", [(1 << 22, 500_000, 5000), (3_000, 40, 5000), (3_000, 40, 2)])
def test_rows_without_or_with_repeated_ids(spark, monkeypatch, chunk, bucket, frequent):
    configure(spark)
    monkeypatch.setattr(repeats, "CHUNK", chunk)
    monkeypatch.setattr(repeats, "BUCKET", bucket)
    monkeypatch.setattr(repeats, "FREQUENT", frequent)
    monkeypatch.setattr(repeats, "HEAVY", 2)
    rows = random_rows(chunk + frequent)
    assert found(spark, rows) == plain.in_order(plain.repeats(rows))


def test_equal_rows_are_counted(spark, monkeypatch):
    configure(spark)
    monkeypatch.setattr(repeats, "TIMES", 3)
    text = passage(random.Random(3))
    rows = [(None, text)] * 11 + [(4, text)] * 2 + [(2, text[:100])]
    assert found(spark, rows) == plain.in_order(plain.repeats(rows))


def test_ids_that_are_no_integers_count_as_null(spark):
    configure(spark)
    text = passage(random.Random(4))
    rows = found(spark, [("x", text), ("12", text), ("3", "short")], "doc_id string, text string")
    assert [(row[0], row[2]) for row in rows] == [("12", 0), ("3", 0), ("x", 300)]


def test_rows_of_one_byte(spark, monkeypatch):
    """Every place of such a text is an anchor; all of it but in the first text goes."""
    configure(spark)
    size = 300_000
    rows = [(1, "a" * size), (2, "a" * size + "b"), (3, "c" * 10 + "a" * size)]
    result = {row[0]: row[1:] for row in found(spark, rows)}
    digest = lambda text: hashlib.sha256(text).hexdigest()
    assert result[1] == (size, 0, 0, digest(b"a" * size))
    assert result[2] == (size + 1, size, 1, digest(b"b"))
    assert result[3] == (size + 10, size, 1, digest(b"c" * 10))


def test_collapsed_places():
    places = np.array([3, 4, 5, 9, 10, 12])
    document = np.array([0, 0, 1, 1, 1, 1])
    hashes = np.array([8, 8, 8, 8, 7, 7], dtype=np.uint64)
    assert repeats.collapsed(places, document, hashes).tolist() == [0, 2, 3, 4, 5]
    assert repeats.collapsed(places[:0], document[:0], hashes[:0]).tolist() == []


def exchanges(spark, folder, rows):
    """Shuffles planned for rows that come once each."""
    configure(spark)
    table = spark.createDataFrame(rows, ROWS).repartition(3)
    table.selectExpr("doc_id", "doc_id AS rank", "text", "unhex(md5(text)) AS print").write.parquet(folder)
    docs = spark.read.parquet(folder)
    counts = docs.groupBy("doc_id", "rank", "print").agg(F.count(F.lit(1)).alias("n"))
    once = repeats.once_each(docs, kept(counts.where("n > 1"), "test-twins"))
    plan = once._jdf.queryExecution().executedPlan().toString()
    times = sorted((row.doc_id, row.text, row.n) for row in once.collect())
    return len(re.findall(r"\bExchange hashpartitioning", plan)), times


def test_texts_do_not_move_for_few_equal_rows(spark, tmp_path, monkeypatch):
    rows = [(i, f"text {i}") for i in range(40)] + [(7, "text 7")] * 2
    expected = sorted((i, f"text {i}", 3 if i == 7 else 1) for i in range(40))
    # One for the equal rows themselves.
    assert exchanges(spark, str(tmp_path / "few"), rows) == (1, expected)
    monkeypatch.setattr(repeats, "TWINS", 0)
    moved, times = exchanges(spark, str(tmp_path / "many"), rows)
    assert moved > 1 and times == expected
