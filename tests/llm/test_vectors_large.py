"""Exact search over vectors whose products leave the range of exact doubles."""

import numpy as np
import pytest
from test_llm_vectors import by_query

from measlake.llm import exact_topk
from measlake.llm.common import configure


def wanted(own, every, k):
    out = {}
    ints = {i: [int(np.floor(256 * x)) for x in v] for i, v in own.items()}
    for q, a in ints.items():
        if q % every == 0:
            found = [(-sum(x * y for x, y in zip(a, b)), i) for i, b in ints.items() if i != q]
            out[q] = [(i, -s) for s, i in sorted(found)[:k]]
    return out


def search(spark, rows, kind="double"):
    configure(spark)
    df = spark.createDataFrame(rows, f"vec_id long, embedding array<{kind}>").repartition(3)
    return by_query(exact_topk.top_k(df, 10, 5))


@pytest.mark.parametrize("sample", [2048, 20, 3])
def test_large_components(spark, monkeypatch, sample):
    monkeypatch.setattr(exact_topk, "SAMPLE", sample)
    monkeypatch.setattr(exact_topk, "BLOCK", 64)
    monkeypatch.setattr(exact_topk, "LEAF", 4)
    draw = np.random.default_rng(8)
    own = {}
    for i in range(150):
        own[i] = (draw.standard_normal(8) * 10.0 ** draw.integers(-1, 6)).tolist()
    for i in range(150, 190):  # scores that differ beyond the 53rd bit only
        own[i] = [1e6 + (i % 7) / 256, 1e6, 3 / 256, -1e6, 1e6, 1e6, 2 / 256, i / 256]
    for i in range(190, 230):  # copies
        own[i] = own[150]
    assert search(spark, list(own.items())) == wanted(own, 10, 5)


def test_first_component_beyond_the_old_limit(spark):
    own = {i: [float(np.float32(x)) for x in v] for i, v in enumerate(np.eye(12) / 4)}
    own[10] = [262144.0] + [0.5] * 11
    own[11] = [300000.0] + [0.25] * 11
    assert search(spark, list(own.items()), "float") == wanted(own, 10, 5)


def test_scores_beyond_longs(spark):
    own = {i: [1.0 + i, 2.0] for i in range(1, 9)}
    own[10] = [1.0, 1.0]
    # Far below: not among the five best, so its score is never told.
    assert search(spark, [*own.items(), (9, [-1e30, 0.0])]) == wanted(own, 10, 5)
    with pytest.raises(Exception, match="leaves the range of a long"):
        search(spark, [*own.items(), (9, [1e30, 0.0])])
    with pytest.raises(Exception, match="leaves the range of a long"):
        search(spark, [(10, [1.0, 1.0]), (9, [-1e30, 0.0])])


def test_integers_of_any_size():
    q = np.array([2.0**40, -3.0, 1e30])
    x = np.array([[2.0**40, 1.0, 1e30], [1.0, 2.0, 0.0]])
    assert exact_topk.integers(q, x).tolist() == [2**80 - 3 + int(1e30) ** 2, 2**40 - 6]
    assert exact_topk.below(2**53 + 1) == 2.0**53
    assert exact_topk.below(-(2**53) - 1) == -(2.0**53) - 2
