"""Match measured curves to the datasets of a fit model.

A measured curve and a probe curve are each one row's arrays. Both are put on
one sorted line per pair, and a single pass over it interpolates the probe at
every measured point. Nothing is exploded, so the only shuffle is the join
that brings a curve and its model together.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..functions.text import let

# Guards against division by zero and the acceptance limit.
MIN_Q = 1e-10
MIN_R = 1e-12
ACCEPT_BELOW = 0.5

# A point of the sorted line: larger q first; on equal q knots come before
# points and later knots before earlier ones.
_ITEM = "STRUCT<down: DOUBLE, kind: INT, back: INT, q: DOUBLE, r: DOUBLE, q0: DOUBLE, r0: DOUBLE>"
_PIECE = "STRUCT<q_from: DOUBLE, q_to: DOUBLE, low: DOUBLE, high: DOUBLE>"
PROBE = (
    f"STRUCT<knots: ARRAY<{_ITEM}>, q_min: DOUBLE, q_max: DOUBLE, usable: BOOLEAN, envelope: ARRAY<{_PIECE}>>"
)
# Parts that a curve and a probe are summed up in for lower bounds.
PIECES = 16
# Beyond this size a mean distance could overflow, and then the range decides instead.
_BOUNDED = 1e100
# Rounding may put an interpolated value outside its knots.
_SLACK = 1 - 1e-9
_KNOT, _POINT = 0, 1


def _bounds(q: Column) -> tuple[Column, Column]:
    numbers = F.filter(q, lambda x: ~F.isnan(x))
    return F.array_min(numbers), F.array_max(numbers)


def _has_values(values: Column) -> Column:
    return F.coalesce(F.size(values) > 0, F.lit(False))


def probe(q: Column, r: Column) -> Column:
    """A dataset's curve, prepared once per model: knots with their left neighbour.

    Knots are in ascending q. An ascending probe keeps its order on ties, any
    other one orders ties by r. Of a few knots, the envelope is made where it is asked for.
    """
    pairs = F.filter(
        F.transform(
            F.arrays_zip(q.alias("q"), r.alias("r")),
            lambda z, i: F.struct(
                z["q"].alias("q"),
                F.when(F.get(q, F.lit(0)) <= F.try_element_at(q, F.lit(-1)), i.cast("double"))
                .otherwise(z["r"])
                .alias("tie"),
                z["r"].alias("r"),
            ),
        ),
        lambda z: z["q"].isNotNull() & z["r"].isNotNull(),
    )

    def knots(line: Column) -> Column:
        return F.transform(
            line,
            lambda k, i: F.struct(
                (-k["q"]).alias("down"),
                F.lit(_KNOT).alias("kind"),
                (-i).alias("back"),
                k["q"].alias("q"),
                k["r"].alias("r"),
                F.get(line, i - 1)["q"].alias("q0"),
                F.get(line, i - 1)["r"].alias("r0"),
            ),
        )

    low, high = _bounds(q)
    usable = _has_values(q) & _has_values(r)

    def prepared(line: Column) -> Column:
        return F.struct(
            line.alias("knots"),
            low.alias("q_min"),
            high.alias("q_max"),
            usable.alias("usable"),
            F.when(F.size(line) > PIECES, envelope(line)).alias("envelope"),
        )

    return let(let(F.sort_array(pairs), knots), prepared)


def _in_pieces(items: Column, piece: Callable[[Column], Column]) -> Column:
    """One value for each of at most ``PIECES`` slices of equal length.

    ``items`` is read for each slice, so it is to be a column or a lambda's variable.
    """

    def cut(step: Column) -> Column:
        count = F.when(step > 0, F.ceil(F.size(items) / step)).otherwise(0).cast("int")
        starts = F.slice(F.sequence(F.lit(0), F.lit(PIECES - 1)), F.lit(1), count)
        return F.transform(starts, lambda i: let(F.slice(items, i * step + 1, step), piece))

    return let(F.ceil(F.size(items) / F.lit(PIECES)).cast("int"), cut)


def envelope(knots: Column) -> Column:
    """Lowest and highest value of the line through the knots, piece by piece.

    Null if a knot has no finite place and size; then no lower bound holds.
    """

    def piece(part: Column) -> Column:
        first = F.get(part, F.lit(0))
        return F.struct(
            F.coalesce(first["q0"], first["q"]).alias("q_from"),
            F.try_element_at(part, F.lit(-1))["q"].alias("q_to"),
            F.least(F.array_min(part["r"]), first["r0"]).alias("low"),
            F.greatest(F.array_max(part["r"]), first["r0"]).alias("high"),
        )

    sound = F.forall(knots, lambda k: (F.abs(k["r"]) <= _BOUNDED) & ~F.isnan(k["q"]))
    return F.when(sound & (F.size(knots) >= 2), _in_pieces(knots, piece))


def outline(q: Column, r: Column) -> Column:
    """A measured curve in parts: range of q, of r, number of points, largest size of r.

    Null if a point has no place or no finite size, or the lengths differ.
    """

    def piece(part: Column) -> Column:
        return F.struct(
            F.array_min(part["q"]).alias("q_from"),
            F.array_max(part["q"]).alias("q_to"),
            F.array_min(part["r"]).alias("low"),
            F.array_max(part["r"]).alias("high"),
            F.size(part).alias("n"),
            F.greatest(F.array_max(F.transform(part["r"], F.abs)), F.lit(MIN_R)).alias("peak"),
        )

    def of_pairs(pairs: Column) -> Column:
        sound = F.forall(pairs, lambda p: F.coalesce((F.abs(p["r"]) <= _BOUNDED) & ~F.isnan(p["q"]), F.lit(False)))
        return F.when(sound, _in_pieces(pairs, piece))

    return F.when(F.size(q) == F.size(r), let(F.arrays_zip(q.alias("q"), r.alias("r")), of_pairs))


def error_bound(parts: Column, pieces: Column) -> Column:
    """What the mean relative distance of a curve to a probe is at least (0 if nothing is known).

    A part that lies in the probe's range counts with the gap between its values
    and those of the pieces above it; any other part that touches the range may
    add points without distance. Without a part inside there may be no point to
    compare, and then the range decides.
    """
    first = F.get(pieces, F.lit(0))["q_from"]
    last = F.try_element_at(pieces, F.lit(-1))["q_to"]
    zero = F.lit(0.0)

    def add(state: Column, part: Column) -> Column:
        above = F.filter(pieces, lambda p: (p["q_to"] >= part["q_from"]) & (p["q_from"] <= part["q_to"]))
        gap = F.greatest(F.array_min(above["low"]) - part["high"], part["low"] - F.array_max(above["high"]), zero)
        inside = (part["q_from"] >= first) & (part["q_to"] <= last)
        touching = (part["q_to"] >= first) & (part["q_from"] <= last)
        return F.struct(
            (state["total"] + F.when(inside, part["n"] * gap / part["peak"]).otherwise(zero)).alias("total"),
            (state["n"] + F.when(touching, part["n"]).otherwise(0)).alias("n"),
        )

    start = F.struct(zero.alias("total"), F.lit(0).alias("n"))
    bound = F.aggregate(parts, start, add, lambda s: F.try_divide(s["total"], s["n"]) * _SLACK)
    return F.coalesce(F.when(parts.isNotNull() & pieces.isNotNull(), bound), zero)


def points(q: Column, r: Column) -> Column:
    """A measured curve in the same form as the knots."""
    nothing = F.lit(None).cast("double")
    return F.transform(
        F.arrays_zip(q.alias("q"), r.alias("r")),
        lambda z: F.struct(
            (-z["q"]).alias("down"),
            F.lit(_POINT).alias("kind"),
            F.lit(0).alias("back"),
            z["q"].alias("q"),
            z["r"].alias("r"),
            nothing.alias("q0"),
            nothing.alias("r0"),
        ),
    )


def curve_error(curve: Column, knots: Column) -> Column:
    """Mean relative distance of the points to the interpolated knots.

    Null when no point lies inside the probe's range.
    """
    start = F.struct(
        F.lit(None).cast(_ITEM).alias("knot"), F.lit(0.0).alias("total"), F.lit(0).alias("n")
    )

    def step(state: Column, item: Column) -> Column:
        knot = state["knot"]
        share = F.coalesce(
            F.try_divide(item["q"] - knot["q0"], knot["q"] - knot["q0"]), F.lit(0.5)
        )
        value = F.when(knot["q0"].isNull(), knot["r"]).otherwise(
            knot["r0"] + share * (knot["r"] - knot["r0"])
        )
        distance = F.abs(value - item["r"]) / F.greatest(F.abs(item["r"]), F.lit(MIN_R))
        outside = knot.isNull() | (knot["q0"].isNull() & (item["q"] < knot["q"]))
        return (
            F.when(
                item["kind"] == _KNOT,
                F.struct(item.alias("knot"), state["total"].alias("total"), state["n"].alias("n")),
            )
            .when(outside, state)
            .otherwise(
                F.struct(
                    knot.alias("knot"),
                    (state["total"] + distance).alias("total"),
                    (state["n"] + 1).alias("n"),
                )
            )
        )

    return F.aggregate(
        F.sort_array(F.concat(knots, curve)),
        start,
        step,
        lambda state: F.try_divide(state["total"], state["n"]),
    )


def range_distance(q_min: Column, q_max: Column, probe_min: Column, probe_max: Column) -> Column:
    """How far the ends of two curves lie apart, relative to the measured one."""
    floor = F.lit(MIN_Q)
    return F.abs(q_min - probe_min) / F.greatest(q_min, floor) + F.abs(
        q_max - probe_max
    ) / F.greatest(q_max, floor)


def _run(q: Column, r: Column) -> Column:
    """What all comparisons of a curve share."""
    low, high = _bounds(q)
    return F.struct(
        points(q, r).alias("curve"),
        low.alias("low"),
        high.alias("high"),
        (F.size(q) == F.size(r)).alias("even"),
    )


def _score(run: Column, item: Column) -> Column:
    """The exact score of one probe."""
    error = F.when(run["even"] & (F.size(item["knots"]) >= 2), curve_error(run["curve"], item["knots"]))
    by_range = range_distance(run["low"], run["high"], item["q_min"], item["q_max"])
    return let(error, lambda e: F.when(e < F.lit(float("inf")), e).otherwise(by_range))


def scores(q: Column, r: Column, probes: Column) -> Column:
    """Array of (score, dataset) of one curve against all probes of its model."""

    def against_all(run: Column) -> Column:
        def score(item: Column, i: Column) -> Column:
            found = F.struct(_score(run, item).alias("score"), i.cast("int").alias("dataset"))
            return F.when(item["usable"], found)

        return F.filter(F.transform(probes, score), lambda s: s.isNotNull())

    return F.when(_has_values(q), let(_run(q, r), against_all))


def closest(q: Column, r: Column, probes: Column) -> Column:
    """The ``best`` of ``scores``, comparing only probes that can still win.

    Probes come in the order of their lower bounds; one whose bound is above the best
    score so far is passed by. A curve of no more points than a bound has pieces is
    compared with all of them, which takes no longer than their bounds.
    ``compared`` and ``usable`` count the probes.
    """
    start = F.struct(
        F.lit(None).cast("double").alias("score"),
        F.lit(None).cast("int").alias("dataset"),
        F.lit(0).alias("compared"),
    )

    def against_some(shared: Column) -> Column:
        run, items = shared["run"], shared["probes"]

        def bound(item: Column) -> Column:
            few = F.when(F.size(item["knots"]) <= PIECES, envelope(item["knots"]))
            pieces = let(F.coalesce(item["envelope"], few), lambda p: error_bound(shared["parts"], p))
            return F.when(shared["parts"].isNull(), F.lit(0.0)).otherwise(pieces)

        bounds = F.filter(
            F.transform(
                items,
                lambda item, i: F.when(
                    item["usable"],
                    F.struct(bound(item).alias("bound"), i.cast("int").alias("dataset")),
                ),
            ),
            lambda b: b.isNotNull(),
        )

        def step(state: Column, item: Column) -> Column:
            def choose(score: Column) -> Column:
                wins = score.isNotNull() & (
                    state["score"].isNull()
                    | (score < state["score"])
                    | ((score == state["score"]) & (item["dataset"] < state["dataset"]))
                )
                return F.struct(
                    F.when(wins, score).otherwise(state["score"]).alias("score"),
                    F.when(wins, item["dataset"]).otherwise(state["dataset"]).alias("dataset"),
                    (state["compared"] + 1).alias("compared"),
                )

            passed = F.coalesce(item["bound"] > state["score"], F.lit(False))
            exact = _score(run, F.get(items, item["dataset"]))
            return F.when(passed, state).otherwise(let(exact, choose))

        def compared(bounds: Column) -> Column:
            return F.aggregate(
                F.sort_array(bounds),
                start,
                step,
                lambda s: F.struct(
                    s["score"].alias("score"),
                    s["dataset"].alias("dataset"),
                    s["compared"].alias("compared"),
                    F.size(bounds).alias("usable"),
                ),
            )

        return let(bounds, compared)

    # What the lambdas read more than once, worked out once.
    parts = F.when(F.size(q) > PIECES, outline(q, r))
    shared = F.struct(_run(q, r).alias("run"), parts.alias("parts"), probes.alias("probes"))
    return F.when(_has_values(q), let(shared, against_some))


def best(scored: Column) -> Column:
    """Lowest score, first dataset on ties. A missing score never wins."""
    real = F.filter(scored, lambda s: s["score"].isNotNull())
    return F.array_min(real)


def matched_dataset(winner: Column) -> Column:
    """Index of the winning dataset if it is close enough, else null."""
    return F.when(winner["score"] < ACCEPT_BELOW, winner["dataset"])
