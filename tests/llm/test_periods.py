"""Runs of words against a search over all starts and periods."""

import hashlib
import random
import zlib

import numpy as np

from measlake.llm import periods
from measlake.llm.common import configure

WORDS = "doc_id bigint, text string"


def plain(words):
    found = []
    for period in range(1, len(words) // 4 + 1):
        start = 0
        while start + period < len(words):
            end = start
            while end + period < len(words) and words[end] == words[end + period]:
                end += 1
            length = end - start + period
            stretch = words[start : start + length]
            least = all(stretch[p:] != stretch[:-p] for p in range(1, period))
            if end > start and length >= max(6, 4 * period) and least:
                found.append((start, length, period))
            start = max(end, start + 1)
    return sorted(found, key=lambda run: (run[0], run[2]))


def plain_row(doc_id, text):
    words = [w for w in (text or "").encode().split() if w]
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    g, n = h // 10, len(words)
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = plain(words)
    gone = {i for start, length, period in runs for i in range(start + period, start + length)}
    best = min(runs, key=lambda run: (-run[1], run[0], run[2]), default=(None, None, None))
    lines = "".join(f"{start},{length},{period}\n" for start, length, period in runs)
    left = b" ".join(w for i, w in enumerate(words) if i not in gone)
    exponent = None if best[0] is None else 1000 * best[1] // best[2]
    return (
        doc_id, len(runs), *best, exponent, hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(left).hexdigest()
    )


def result(docs):
    found = periods.digest(periods.find_runs(periods.with_repeats(docs)))
    names = "doc_id n_runs start length period exponent_milli runs_sha256 collapsed_sha256".split()
    return [tuple(row) for row in found.select(*names).collect()]


def random_words(rnd, most=70):
    words = [rnd.randrange(rnd.choice([1, 2, 3, 40])) for _ in range(rnd.randint(0, most))]
    for _ in range(rnd.randint(0, 3) if words else 0):
        first, period = rnd.randrange(len(words)), rnd.randint(1, 9)
        for i in range(first, min(len(words), first + rnd.randint(0, 40))):
            words[i] = words[first + (i - first) % period]
    return words


def test_runs_equal_a_search_of_all():
    rnd = random.Random(11)
    for _ in range(1500):
        words = random_words(rnd)
        assert periods.find(np.array(words, dtype=np.int64)) == plain(words), words


def test_candidates_lose_no_run():
    rnd = random.Random(12)
    for _ in range(500):
        words = random_words(rnd, 200)
        stretches = periods.candidates(np.array(words, dtype=np.int64))
        for start, length, _ in plain(words):
            assert any(a <= start and start + length <= b for a, b in stretches)


def test_squares_name_the_smallest_period():
    words = [1, 2, 3, 1, 2, 3, 1, 2, 3, 7, 7, 7, 7]
    assert set(periods.squares(words)) >= {(5, 3), (10, 1)}
    assert {period for _, period in periods.squares([5] * 30)} == {1}


def test_query_equals_plain(spark):
    configure(spark)
    rnd = random.Random(13)
    rows = [(i, " ".join(f"w{w}" for w in random_words(rnd, 300))) for i in range(400)]
    rows += [(None, None), (None, "a a a a a a a"), (7, None), (7, ""), (7, " \t\n "), (7, "é é x")]
    rows += [(8, "one  two\tthree\x0b" * 9), (8, "one  two\tthree\x0b" * 9), (9, "z " * 40000)]
    rows += [(i, None) for i in range(400, 460)] + [(i, " ") for i in range(460, 500)]
    docs = spark.createDataFrame(rows, WORDS)
    key = lambda row: tuple(str(v) for v in row)
    expected = [
        plain_row(i, t) if len(t or "") < 70000 else (9, 1, 0, 40000, 1, 40000000, sha("0,40000,1\n"), sha("z"))
        for i, t in rows
    ]
    assert zlib.crc32(b"9") % 10 != 0
    assert sorted(result(docs), key=key) == sorted(expected, key=key)


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def test_empty_table_and_other_columns(spark):
    configure(spark)
    assert result(spark.createDataFrame([], WORDS)) == []
    more = spark.createDataFrame([(1, "a b", "x", 2)], WORDS + ", runs string, n int")
    assert result(more) == [plain_row(1, "a b")]
    assert periods.find_runs(more).columns == ["doc_id", "runs", "collapsed"]
