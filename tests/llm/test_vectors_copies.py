"""Queries that lie among copies of themselves, all in one block."""

import numpy as np
import pytest
from test_llm_vectors import brute, by_query, cosine, inner, recall, usable

from measlake.llm import ann, exact_topk, vectors
from measlake.llm.common import configure


def copies(near):
    """More vectors than the sample holds, and copies: 61 equal ones, or 100 near ones."""
    draw = np.random.default_rng(7)
    rows = [(10_000 + i, v) for i, v in enumerate(draw.standard_normal((2100, 8)) / 3)]
    centre = draw.standard_normal(8) + 2
    if near:
        rows += [(i, centre + draw.standard_normal(8) / 200) for i in range(100)]
    else:
        rows += [(i, centre) for i in range(61)]
    return [(i, [float(np.float32(x)) for x in v]) for i, v in rows]


def one_partition(spark, rows):
    configure(spark)
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>").coalesce(1)


@pytest.mark.parametrize("near", [False, True])
def test_exact_among_copies(spark, near):
    rows = copies(near)
    assert len(rows) > exact_topk.SAMPLE
    found = by_query(exact_topk.top_k(one_partition(spark, rows), 50, 5))
    assert found == brute(usable(rows), 50, 5, inner)


@pytest.mark.parametrize("near", [False, True])
def test_neighbours_among_copies(spark, near):
    rows = copies(near)
    found = by_query(ann.nearest(one_partition(spark, rows), 50, 5))
    wanted = {q: b for q, b in brute(usable(rows), 50, 5, cosine).items() if q < 100}
    own = {q: found[q] for q in wanted}
    assert all(len(b) == 5 for b in own.values())
    if near:
        assert recall(own, wanted) == 1
    else:
        assert {q: [i for i, _ in b] for q, b in own.items()} == {
            0: [1, 2, 3, 4, 5],
            50: [0, 1, 2, 3, 4],
        }


def test_own_id_takes_no_place():
    best = vectors.Best(5)
    ids = np.arange(30)
    best.offer(0, 100.0 - ids, ids)
    assert [i for _, i in best.found[0]] == [1, 2, 3, 4, 5]
