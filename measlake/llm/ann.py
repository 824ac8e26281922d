"""Approximate nearest neighbours by cosine, with collision-counting hashing.

Vectors are scaled to length one, where cosine and distance give the same order,
and projected on ``PROJECTIONS`` random directions. For every block of vectors
the index holds each projection as an array of its own, sorted. A query opens a
window around itself in each of them, and a vector collides with it once for
every window that holds it. Windows are as wide as the radius in question, so a
vector at that distance collides in a known share of them; the radius grows step
by step towards the distance of the query's k-th nearest so far (virtual
rehashing: the arrays stay, windows widen). Vectors that collide often enough to
be within the radius, but for a chance of ``MISS``, are verified by their exact
cosine. A query is done with a block when the radius has reached its k-th
nearest. A bounded sample tells a distance within which there are k, so that no
radius needs to go beyond it; its vectors are candidates only as all others are.
Queries that after all blocks have fewer than k within that distance were let
down by chance; they are asked once more, with windows twice as wide, which
double further while a task has fewer than k of its blocks.

Every vector is in the index; there is no cap on candidates. Rows without an id,
vectors that are null, empty or zero or hold null or non-finite components, take
no part. Vectors of different lengths do not meet. Rows that share an id count
as one candidate, with the best score among them. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import cache
from statistics import NormalDist

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from measlake.llm.common import kept
from measlake.llm.vectors import Best, Blocks, mapped, matrices, ranked, sample

PROJECTIONS = 96
MISS = 0.02
# Radii as shares of the distance of the k-th nearest so far.
STEPS = (0.5, 0.75, 1.0)
SAMPLE = 2048
BLOCK = 4096
# Queries in a row, so that a block is sent once for so many, and at a time in a search.
GROUP = 4096
TURN = 128
SHARDS = 32
SEED = 11


def directions(length: int) -> np.ndarray:
    """Random directions, the same wherever they are made."""
    return np.random.default_rng(SEED).standard_normal((length, PROJECTIONS))


@cache
def threshold() -> int:
    """Collisions that a vector at the radius reaches but for a chance of ``MISS``."""
    normal = NormalDist()
    hit = 2 * normal.cdf(1) - 1
    spread = (PROJECTIONS * hit * (1 - hit)) ** 0.5
    return int(PROJECTIONS * hit + normal.inv_cdf(MISS) * spread)


def cosines(query: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Cosines row by row, so that equal vectors get equal scores wherever they stand."""
    inner = (values * query).sum(axis=1)
    lengths = np.sqrt((values * values).sum(axis=1)) * np.sqrt((query * query).sum())
    return inner / lengths


def units(values: np.ndarray) -> np.ndarray:
    """Vectors scaled to length one; by the largest component first, against overflow."""
    values = values / np.abs(values).max(axis=1, keepdims=True)
    return values / np.linalg.norm(values, axis=1, keepdims=True)


def distance(cosine: float) -> float:
    return max(0.0, 2 - 2 * cosine) ** 0.5


class Hits:
    """Collisions of one query with the vectors of one block."""

    def __init__(self, index: Index, query: int, vector: np.ndarray, best: Best):
        self.index, self.query, self.vector, self.best = index, query, vector, best
        self.count = np.zeros(len(index.ids), dtype=np.int64)
        self.seen = np.zeros(len(index.ids), dtype=bool)

    def add(self, ends: list[tuple[np.ndarray, np.ndarray]]) -> None:
        """Count what the windows gained, and verify what has enough collisions now."""
        gained = [
            order[a:b]
            for first, last in ends
            for order, a, b in zip(self.index.order, first.tolist(), last.tolist())
        ]
        self.count += np.bincount(np.concatenate(gained), minlength=len(self.count))
        fresh = np.flatnonzero((self.count >= threshold()) & ~self.seen)
        if len(fresh):
            self.seen[fresh] = True
            scores = cosines(self.vector, self.index.values[fresh])
            self.best.offer(self.query, scores, self.index.ids[fresh])


class Index:
    """Sorted projections of one block."""

    def __init__(self, ids: np.ndarray, values: np.ndarray, order: np.ndarray, line: np.ndarray):
        self.ids, self.values, self.order, self.line = ids, values, order, line

    def search(
        self,
        ids: np.ndarray,
        vectors: np.ndarray,
        places: np.ndarray,
        best: Best,
        floors: np.ndarray,
        fill: bool = False,
    ) -> int:
        """Offer what collides often enough, until the radius reaches the k-th nearest.

        Gives the number of vectors verified. With ``fill``, windows start at twice the radius
        and double while a query has fewer than k.
        """
        goals = np.array(
            [distance(best.worst(q, f)) + 1e-9 for q, f in zip(ids.tolist(), floors.tolist())]
        )
        # Ends of all windows: by step, projection and query.
        low = [[a.searchsorted(p) for a, p in zip(self.line, places.T - s * goals)] for s in STEPS]
        high = [
            [a.searchsorted(p, "right") for a, p in zip(self.line, places.T + s * goals)]
            for s in STEPS
        ]
        low, high = np.array(low), np.array(high)
        verified = 0
        for n, query in enumerate(ids.tolist()):
            hits = Hits(self, query, vectors[n], best)
            if fill:
                self.fill(hits, goals[n], places[n])
            else:
                self.widen(hits, goals[n], low[:, :, n], high[:, :, n], floors[n])
            verified += int(hits.seen.sum())
        return verified

    def widen(
        self, hits: Hits, goal: float, low: np.ndarray, high: np.ndarray, floor: float
    ) -> None:
        """The windows of one query, step by step."""
        for step, share in enumerate(STEPS):
            if step == 0:
                hits.add([(low[0], high[0])])
            else:
                hits.add([(low[step], low[step - 1]), (high[step - 1], high[step])])
            if share * goal >= distance(hits.best.worst(hits.query, floor)) + 1e-9:
                break

    def fill(self, hits: Hits, radius: float, place: np.ndarray) -> None:
        """Windows twice as wide, and again while the query has fewer than k."""
        while not hits.seen.all():
            radius *= 2
            hits.count[:] = 0
            low = [a.searchsorted(p - radius) for a, p in zip(self.line, place)]
            high = [a.searchsorted(p + radius, "right") for a, p in zip(self.line, place)]
            hits.add([(np.array(low), np.array(high))])
            if hits.best.whole(hits.query):
                break


def nearest(vectors: DataFrame, every: int, k: int) -> DataFrame:
    """The k nearest found for each vector whose id is divisible by ``every``, itself left out."""
    drawn = {}
    for length, (ids, values) in sample(vectors, SAMPLE).items():
        firsts = np.unique(ids, return_index=True)[1]
        firsts = firsts[np.abs(values[firsts]).max(axis=1) > 0]
        if len(firsts):
            drawn[length] = (ids[firsts], units(values[firsts]))

    names = ["length", "shard", "block", "ids", "values", "order", "line"]

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blocks = Blocks(BLOCK)
        part, made = TaskContext.get().partitionId(), 0

        def out(found: Iterator[tuple]) -> Iterator[pa.RecordBatch]:
            nonlocal made
            for (length,), ids, values in found:
                placed = (units(values) @ directions(length)).T
                order = np.argsort(placed, axis=1, kind="stable").astype(np.uint16)
                line = np.take_along_axis(placed, order.astype(np.int64), axis=1)
                # Small partitions of one block each are dealt over all shards, too.
                row = [length, (part + made) % SHARDS, (part << 32) + made]
                row += [ids.tobytes(), values.tobytes()]
                row += [order.tobytes(), line.tobytes()]
                yield pa.RecordBatch.from_arrays([pa.array([v]) for v in row], names=names)
                made += 1

        for batch in batches:
            for ids, values in matrices(batch):
                some = np.abs(values).max(axis=1) > 0
                if some.any():
                    yield from out(blocks.add((values.shape[1],), ids[some], values[some]))
        yield from out(blocks.rest())

    narrow = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding")
    index = kept(
        narrow.mapInArrow(
            build,
            "length long, shard long, block long, ids binary, values binary, order binary, line binary",
        ),
        "ann-index",
    )

    asked = ["q_length", "q_ids", "q_values", "floor"]

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        groups = Blocks(GROUP)

        def out(found: Iterator[tuple]) -> Iterator[pa.RecordBatch]:
            for (length,), ids, values in found:
                # A cosine that k others of the sample reach; the true k-th is no less.
                floor = np.full(len(ids), -1.0)
                if length in drawn and len(drawn[length][0]) > k:
                    sample_ids, sample_units = drawn[length]
                    for i in range(0, len(ids), TURN):
                        scores = units(values[i : i + TURN]) @ sample_units.T
                        scores[ids[i : i + TURN, None] == sample_ids] = -2
                        floor[i : i + TURN] = np.sort(scores, axis=1)[:, -k] - 1e-9
                row = [length, ids.tobytes(), values.tobytes(), floor.tobytes()]
                yield pa.RecordBatch.from_arrays([pa.array([v]) for v in row], names=asked)

        for batch in batches:
            for ids, values in matrices(batch):
                some = np.abs(values).max(axis=1) > 0
                if some.any():
                    yield from out(groups.add((values.shape[1],), ids[some], values[some]))
        yield from out(groups.rest())

    def meeting(fill: bool) -> Callable:
        def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            best, goals = Best(k), {}
            last, found = None, None

            def told() -> pa.RecordBatch:
                rows = best.drain(pa.float64())
                floors = [goals[q] for q in rows.column("query_id").to_pylist()]
                goals.clear()
                return rows.append_column("floor", pa.array(floors, pa.float64()))

            for batch in batches:
                for row in batch.to_pylist():
                    length = row["length"]
                    if row["block"] != last:
                        last = row["block"]
                        ids = np.frombuffer(row["ids"], dtype=np.int64)
                        found = Index(
                            ids,
                            np.frombuffer(row["values"]).reshape(len(ids), -1),
                            np.frombuffer(row["order"], dtype=np.uint16).reshape(PROJECTIONS, -1),
                            np.frombuffer(row["line"]).reshape(PROJECTIONS, -1),
                        )
                    asking = np.frombuffer(row["q_ids"], dtype=np.int64)
                    queries = np.frombuffer(row["q_values"]).reshape(-1, length)
                    floors = np.frombuffer(row["floor"])
                    goals.update(zip(asking.tolist(), floors.tolist()))
                    for i in range(0, len(asking), TURN):
                        turn = slice(i, i + TURN)
                        places = units(queries[turn]) @ directions(length)
                        found.search(asking[turn], queries[turn], places, best, floors[turn], fill)
                    if len(goals) >= best.most:
                        yield told()
            yield told()

        return meet

    def hits(queries: DataFrame, fill: bool) -> DataFrame:
        # Queries meet all blocks, in blocks: a group of queries goes to every shard of the index.
        groups = queries.mapInArrow(
            ask, "q_length long, q_ids binary, q_values binary, floor binary"
        ).withColumn("q_shard", F.explode(F.expr(f"sequence(0L, {SHARDS - 1}L)")))
        pairs = index.join(
            groups, (F.col("length") == F.col("q_length")) & (F.col("shard") == F.col("q_shard"))
        )
        return mapped(pairs, meeting(fill), "query_id long, vec_id long, score double, floor double")

    queries = narrow.where(F.col("vec_id") % every == 0)
    first = kept(hits(queries, False), "ann-first")
    within = first.where(F.col("score") >= F.col("floor")).groupBy("query_id")
    served = within.agg(F.count_distinct("vec_id").alias("n")).where(F.col("n") >= k)
    served = served.select(F.col("query_id").alias("vec_id"))
    second = hits(queries.join(served, "vec_id", "left_anti"), True)
    return ranked(first.unionByName(second), k)
