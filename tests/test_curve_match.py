"""The curve matcher against a point-by-point statement of its rules."""

import math
import random

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from measlake.operators import curve_match


def interpolated(knots, x):
    """Value of a line through sorted knots; the leftmost knot on ties."""
    at = next((i for i, (q, _) in enumerate(knots) if q >= x), None)
    if at is None or (at == 0 and x < knots[0][0]):
        return None
    if at == 0:
        return knots[0][1]
    (q0, r0), (q1, r1) = knots[at - 1], knots[at]
    return r0 + (x - q0) / (q1 - q0) * (r1 - r0)


def expected(q, r, probes):
    found = []
    for index, (probe_q, probe_r) in enumerate(probes):
        if not q or not probe_q or not probe_r:
            continue
        score = abs(min(q) - min(probe_q)) / max(min(q), 1e-10) + abs(max(q) - max(probe_q)) / max(max(q), 1e-10)
        if len(q) == len(r) and len(probe_q) >= 2:
            pairs = list(zip(probe_q, probe_r))
            knots = sorted(pairs, key=lambda p: p[0]) if probe_q[0] <= probe_q[-1] else sorted(pairs)
            errors = [abs(v - y) / max(abs(y), 1e-12) for x, y in zip(q, r) if (v := interpolated(knots, x)) is not None]
            if errors and sum(errors) / len(errors) < math.inf:
                score = sum(errors) / len(errors)
        if not math.isnan(score):
            found.append((score, index))
    if not found or min(found)[0] >= 0.5:
        return None
    return min(found)[1]


SCHEMA = "id int, q array<double>, r array<double>, d array<struct<q:array<double>,r:array<double>>>"


def matched(spark, cases):
    rows = [(i, q, r, [{"q": a, "r": b} for a, b in probes]) for i, (q, r, probes) in enumerate(cases)]
    df = spark.createDataFrame(rows, SCHEMA)
    probes = F.transform("d", lambda d: curve_match.probe(d["q"], d["r"]))
    winner = curve_match.best(curve_match.scores(F.col("q"), F.col("r"), probes))
    return {r.id: r.m for r in df.select("id", curve_match.matched_dataset(winner).alias("m")).collect()}


def random_case(rng):
    n, digits = rng.choice([0, 1, 2, 5, 30]), rng.choice([1, 3])
    q = sorted(round(rng.uniform(0.5, 2), digits) for _ in range(n))
    r = [rng.choice([0.0, 1.0, rng.random() + 0.5]) for _ in q]
    if n and rng.random() < 0.1:
        r[0] = math.nan
    probes = []
    for _ in range(rng.choice([1, 3, 5])):
        m, digits = rng.choice([0, 1, 2, 10, 40]), rng.choice([1, 3])
        probe_q = sorted(round(rng.uniform(0.3, 2.5), digits) for _ in range(m))
        probe_r = [rng.random() + 0.5 for _ in probe_q]
        if rng.random() < 0.3:
            probe_q.reverse()
        probes.append((probe_q, probe_r))
    if rng.random() < 0.3:
        probes.append(probes[0])
    return q, r, probes


def test_random_curves(spark):
    rng = random.Random(11)
    cases = [random_case(rng) for _ in range(250)]
    got = matched(spark, cases)
    want = {i: expected(*case) for i, case in enumerate(cases)}
    assert got == want
    assert 20 < sum(v is not None for v in want.values()) < 230


grid = st.lists(st.sampled_from([0.1, 0.2, 0.25, 0.3, 0.4]), max_size=6).map(sorted)


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(grid, st.lists(grid, min_size=1, max_size=3), st.booleans()), min_size=10, max_size=25))
def test_coarse_grids(spark, drawn):
    cases = []
    for q, probe_grids, down in drawn:
        probes = [(g[::-1] if down else g, [1.0 + i / 7 for i, _ in enumerate(g)]) for g in probe_grids]
        cases.append((q, [1.0 + x for x in q], probes))
    assert matched(spark, cases) == {i: expected(*case) for i, case in enumerate(cases)}


def test_named_cases(spark):
    line = ([0.1, 0.2, 0.3], [1.0, 2.0, 3.0])
    cases = [
        ([0.15, 0.25], [1.5, 2.5], [([0.1, 0.2], [9.0, 9.0]), line]),
        ([0.15], [1.5], [line, line]),  # first one on ties
        ([0.15, 0.25], [1.5, 2.5], [(line[0][::-1], line[1][::-1])]),  # descending
        ([5.0, 6.0], [1.0, 1.0], [([5.0], [3.0])]),  # one knot: by range, 0 + 1/6
        ([5.0, 6.0], [1.0, 1.0], [line]),  # disjoint and far
        ([], [], [line]),
        ([0.15], [1.5], []),
        ([0.1, 0.2], [1.0], [([0.1, 0.2], [1.0, 5.0])]),  # unequal lengths: by range
        ([0.15, 0.25], [1.5, 2.5], [([0.1, 0.2, 0.3], [1.0, 2.0])]),  # probe without its last value
    ]
    got = matched(spark, cases)
    assert [got[i] for i in range(len(cases))] == [1, 0, 0, 0, None, None, None, 0, 0]


def test_nan_point_takes_the_first_knot(spark):
    cases = [([0.1, math.nan], [1.0, 1.0], [([0.1, 0.2], [1.0, 9.0])])]
    assert matched(spark, cases) == {0: 0}


def pruned(spark, cases):
    rows = [(i, q, r, [{"q": a, "r": b} for a, b in probes]) for i, (q, r, probes) in enumerate(cases)]
    probes = F.transform("d", lambda d: curve_match.probe(d["q"], d["r"]))
    df = spark.createDataFrame(rows, SCHEMA)
    all_scores = curve_match.scores(F.col("q"), F.col("r"), F.col("p"))
    df = df.withColumn("p", probes).select(
        "id",
        curve_match.best(all_scores).alias("best"),
        curve_match.closest(F.col("q"), F.col("r"), F.col("p")).alias("closest"),
        F.transform("p", lambda p: curve_match.error_bound(curve_match.outline(F.col("q"), F.col("r")), p["envelope"])).alias("bounds"),
        all_scores.alias("scores"),
    )
    return df.collect()


def check_pruned(rows):
    for row in rows:
        won = row.best or (None, None)
        found = row.closest or (None, None)
        assert repr((won[0], won[1])) == repr((found[0], found[1])), row.id
        for score, dataset in row.scores or ():
            # A bound holds for whatever decides.
            assert score is None or math.isnan(score) or row.bounds[dataset] <= score


def test_closest_is_the_best_of_all(spark):
    rng = random.Random(21)
    cases = [random_case(rng) for _ in range(150)]
    nan, inf = math.nan, math.inf
    far = [([0.1 * k for k in range(1, 40)], [float(d)] * 39) for d in (9, 1, 30, 1, 2, 500)]
    q = [0.5 + 0.01 * k for k in range(100)]
    cases += [
        (q, [1.1] * 100, far),
        (q, [1.0] * 100, far),
        (q, [1e200] * 100, far),
        (q, [-2.0] * 100, far),
        (q, [0.0] * 100, far),
        (q, [nan] * 100, far),
        (q, [1.0] * 99, far),
        (q[:1], [2.0], far),
        ([9.0, 9.5], [1.0, 1.0], far),
        (q, [1.0] * 100, [(q, [inf] * 100), (q, [nan] * 100), (q, [1.5] * 100)]),
        (q, [1.0] * 100, [([0.5, nan, 1.5], [5.0, 5.0, 5.0]), (q, [1.5] * 100)]),
    ]
    rows = pruned(spark, cases)
    check_pruned(rows)
    found = {row.id: row.closest for row in rows}
    assert found[150]["compared"] < found[150]["usable"] == 6
    assert found[151]["dataset"] == 1


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(seed=st.integers(0, 10**6))
def test_bounds_hold_on_steep_curves(spark, seed):
    rng = random.Random(seed)
    cases = []
    for _ in range(25):
        q = sorted(rng.uniform(0, 1) for _ in range(rng.randint(1, 60)))
        r = [math.exp(-8 * x) * rng.choice([1, -1, 1.01, 3]) for x in q]
        probes = []
        for _ in range(5):
            at = sorted(rng.uniform(-0.1, rng.choice([0.5, 1.1])) for _ in range(rng.randint(2, 50)))
            probes.append((at, [math.exp(-8 * x) * rng.choice([1, 2, 0.2, -1]) for x in at]))
        cases.append((q, r, probes))
    check_pruned(pruned(spark, cases))
