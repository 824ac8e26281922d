"""Queries whose k-th nearest is only just within the first radius, and larger tables."""

import numpy as np
from test_llm_vectors import brute, by_query, cosine, recall, usable

from measlake.llm import ann, vectors
from measlake.llm.common import configure


def run(spark, rows, every, partitions=2):
    configure(spark)
    rows = spark.sparkContext.parallelize(rows, partitions)
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    return by_query(ann.nearest(df, every, 5))


def test_five_of_five_near_ones(spark):
    """Groups of six: each has five near ones, and all others are far away."""
    draw = np.random.default_rng(10)
    rows = []
    for group in range(300):
        centre = draw.standard_normal(64)
        for member in range(6):
            rows.append((group * 6 + member, (centre + draw.standard_normal(64) / 8).tolist()))
    assert len(rows) <= ann.SAMPLE
    found = run(spark, rows, 6)
    assert found.keys() == set(range(0, 1800, 6))
    assert recall(found, brute(usable(rows), 6, 5, cosine)) == 1


def test_windows_double_for_queries_with_fewer_than_k():
    """A query gets k, or all there are, if asked to be filled."""
    values = np.array([[1.0, 0.5], [-1.0, -0.5], [0.5, -1.0], [1.0, 0.25]])
    ids = np.arange(4)
    placed = (ann.units(values) @ ann.directions(2)).T
    order = np.argsort(placed, axis=1)
    index = ann.Index(ids, values, order, np.take_along_axis(placed, order, axis=1))
    best = vectors.Best(5)
    index.search(ids[:1], values[:1], placed.T[:1], best, np.array([1.0]), fill=False)
    assert best.found.get(0, []) == []
    index.search(ids[:1], values[:1], placed.T[:1], best, np.array([1.0]), fill=True)
    assert [i for _, i in best.found[0]] == [3, 2, 1]


def test_recall_beyond_the_sample(spark):
    """Five times as many vectors as the sample holds."""
    draw = np.random.default_rng(11)
    centres = draw.standard_normal((40, 64))
    values = centres[draw.integers(0, 40, 10_240)] + draw.standard_normal((10_240, 64)) / 2
    rows = [(i, v.tolist()) for i, v in enumerate(values)]
    found = run(spark, rows, 200, 4)
    own = usable(rows)
    units = np.stack([own[i] / np.linalg.norm(own[i]) for i in range(len(rows))])
    wanted = {}
    for q in range(0, len(rows), 200):
        scores = units @ units[q]
        scores[q] = -2
        wanted[q] = [(int(i), 0.0) for i in np.argsort(-scores)[:5]]
    assert all(len(found[q]) == 5 for q in wanted)
    share = recall(found, wanted)
    print("recall on 10,240 vectors:", share)
    assert share > 0.9


def test_hashing_finds_the_neighbours_without_the_sample(spark, monkeypatch):
    """With a sample of 100 the radius is wide, and collisions alone give the candidates."""
    draw = np.random.default_rng(12)
    rows = [(i, v.tolist()) for i, v in enumerate(draw.standard_normal((1500, 32)))]
    wanted = brute(usable(rows), 20, 5, cosine)
    monkeypatch.setattr(ann, "SAMPLE", 100)
    found = run(spark, rows, 20)
    assert all(len(found[q]) == 5 for q in wanted)
    assert recall(found, wanted) > 0.9


def test_verified_vectors_are_few():
    """In clustered vectors most of a block is never verified."""
    draw = np.random.default_rng(13)
    centres = draw.standard_normal((40, 64))
    values = centres[draw.integers(0, 40, 4000)] + draw.standard_normal((4000, 64)) / 4
    ids = np.arange(4000)
    placed = (ann.units(values) @ ann.directions(64)).T
    order = np.argsort(placed, axis=1)
    index = ann.Index(ids, values, order, np.take_along_axis(placed, order, axis=1))
    units = ann.units(values)
    scores = units[:40] @ units.T
    scores[np.arange(40), np.arange(40)] = -2
    floors = np.sort(scores, axis=1)[:, -5]
    best = vectors.Best(5)
    verified = index.search(ids[:40], values[:40], placed.T[:40], best, floors)
    assert verified < 0.1 * 40 * 4000
    hits = sum(len({i for _, i in best.found[q]} & set(np.argsort(-scores[q])[:5])) for q in range(40))
    assert hits > 0.9 * 200
