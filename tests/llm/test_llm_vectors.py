"""Searches over vectors against brute force."""

import math
import os

import duckdb
import numpy as np
import pytest
from check_oracle import compare, connect, run_sql

from measlake.llm import ann, exact_topk, queries, vectors
from measlake.llm.common import configure

SF_DIR = "/root/testdata/sf0.001"


def awkward_vectors():
    """(vec_id, embedding): ties, repeated rows, zeros, and vectors that take no part."""
    draw = np.random.default_rng(4)
    rows = []
    for i in range(200):
        rows.append((i, [float(np.float32(x)) for x in draw.standard_normal(8) / 3]))
    for i in range(200, 260):  # one vector many times, among the queries too
        rows.append((i, list(rows[50][1])))
    rows += [
        (300, None),
        (301, []),
        (302, [1.0] * 7 + [None]),
        (303, [math.nan] + [1.0] * 7),
        (304, [math.inf] + [1.0] * 7),
        (305, [0.0] * 8),
        (350, [0.0] * 8),
        (400, [0.5, -0.25]),
        (401, [0.5, 0.25]),
        (402, [-0.5, 0.25]),
        (None, [0.1] * 8),
        (450, None),
        rows[7],
        rows[100],
    ]
    return rows


def table(spark, rows):
    configure(spark)
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(3)
    return df.selectExpr("*", "'own' AS block", "'own' AS ids", "'own' AS score", "'own' AS rank")


def usable(rows):
    own = {}
    for i, v in rows:
        if i is not None and v and all(x is not None and math.isfinite(x) for x in v):
            own[i] = np.array(v, dtype=np.float32).astype(float)
    return own


def brute(own, every, k, score):
    out = {}
    for q, a in own.items():
        if q % every == 0:
            found = [(-score(a, b), i) for i, b in own.items() if i != q and len(a) == len(b)]
            out[q] = [(i, -s) for s, i in sorted(found)[:k]]
    return out


def by_query(df):
    out = {}
    for r in sorted(df.collect()):
        out.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert r.rank == len(out[r.query_id])
    return out


def inner(a, b):
    return int(np.floor(256 * a) @ np.floor(256 * b))


@pytest.mark.parametrize("block,group,leaf,sample", [(1024, 128, 32, 2048), (16, 4, 2, 20)])
def test_exact_top_k(spark, monkeypatch, block, group, leaf, sample):
    monkeypatch.setattr(exact_topk, "BLOCK", block)
    monkeypatch.setattr(exact_topk, "GROUP", group)
    monkeypatch.setattr(exact_topk, "LEAF", leaf)
    monkeypatch.setattr(exact_topk, "SAMPLE", sample)
    rows = awkward_vectors()
    found = by_query(exact_topk.top_k(table(spark, rows), 50, 5))
    wanted = {q: b for q, b in brute(usable(rows), 50, 5, inner).items() if b}
    assert found == wanted
    nothing = table(spark, rows).limit(0)
    assert exact_topk.top_k(nothing, 50, 5).collect() == []
    assert all(len(b) == 2 for b in by_query(exact_topk.top_k(table(spark, rows[-7:]), 400, 5)).values())


def test_cover_tree_covers():
    values = np.random.default_rng(5).standard_normal((500, 3))
    root = exact_topk.cover_tree(values, np.arange(500))
    todo, leaves = [root], []
    while todo:
        node = todo.pop()
        away = np.linalg.norm(values[node.members] - node.centre, axis=1)
        assert away.max() <= node.radius + 1e-12
        own = sorted([*node.loose.tolist(), *(m for c in node.children for m in c.members.tolist())])
        assert own == sorted(node.members.tolist())
        for i, a in enumerate(node.children):
            assert a.radius <= node.radius / 2
            for b in node.children[:i]:
                assert np.linalg.norm(a.centre - b.centre) > node.radius / 2
        leaves += node.loose.tolist()
        todo += node.children
    assert sorted(leaves) == list(range(500)) and len(root.children) > 1


def test_pruning_prunes():
    """Queries far from the data do not reach its leaves once they have better candidates."""
    draw = np.random.default_rng(6)
    near, far = draw.standard_normal((200, 4)) + 50, draw.standard_normal((200, 4)) - 50
    queries_ = (np.arange(10), draw.standard_normal((10, 4)) + 50)
    tree = exact_topk.cover_tree(queries_[1], np.arange(10))
    best = vectors.Best(3)
    floor = np.full(10, -np.inf)
    for ids, data in ((np.arange(1000, 1200), near), (np.arange(2000, 2200), far)):
        node = exact_topk.cover_tree(data, np.arange(200))
        before = {q: list(b) for q, b in best.found.items()}
        exact_topk.search(queries_, tree, (ids, data), node, floor, best)
    assert before == best.found


def test_exact_top_k_query(spark):
    if not os.path.isdir(SF_DIR):
        pytest.skip("tables are not there")
    df = queries.QUERIES["op4_exact_topk"](spark, SF_DIR)
    rows = [tuple(r) for r in df.collect()]
    sql = queries.SQL["op4_exact_topk"]
    assert compare(df.columns, rows, *run_sql(connect(SF_DIR), sql)) == ""


def cosine(a, b):
    if not a.any() or not b.any():
        return -2.0
    return float(a @ b / np.sqrt((a @ a) * (b @ b)))


def recall(found, wanted):
    hits = sum(len({i for i, _ in found.get(q, [])} & {i for i, _ in b}) for q, b in wanted.items())
    return hits / max(1, sum(len(b) for b in wanted.values()))


def test_neighbours(spark, monkeypatch):
    rows = awkward_vectors()
    own = {i: v for i, v in usable(rows).items() if v.any()}
    wanted = {q: b for q, b in brute(own, 50, 5, cosine).items() if b}
    for block in (ann.BLOCK, 32):
        monkeypatch.setattr(ann, "BLOCK", block)
        found = by_query(ann.nearest(table(spark, rows), 50, 5))
        assert recall(found, wanted) > 0.9
        assert {q: len(b) for q, b in found.items()} == {q: len(b) for q, b in wanted.items()}
        for q, b in found.items():
            assert all(math.isclose(s, cosine(own[q], own[i]), abs_tol=1e-12) for i, s in b)
        # Equal vectors come by their ids.
        assert [i for i, _ in found[50]] == [200, 201, 202, 203, 204]
    assert ann.nearest(table(spark, rows).limit(0), 50, 5).collect() == []


def test_neighbours_query(spark):
    larger = "/root/testdata/sf0.1"
    if not os.path.isdir(larger):
        pytest.skip("tables are not there")
    found = by_query(queries.QUERIES["op5_approximate_neighbours"](spark, larger))
    rows = duckdb.sql(f"SELECT vec_id, embedding FROM '{larger}/embeddings.parquet' ORDER BY 1")
    rows = rows.fetchnumpy()
    ids, values = rows["vec_id"], np.stack(rows["embedding"]).astype(float)
    values /= np.linalg.norm(values, axis=1, keepdims=True)
    wanted = {}
    for q in np.flatnonzero(ids % 50 == 0):
        scores = values @ values[q]
        scores[q] = -2
        wanted[int(ids[q])] = [(int(ids[i]), scores[i]) for i in np.lexsort((ids, -scores))[:5]]
    assert recall(found, wanted) > 0.9
