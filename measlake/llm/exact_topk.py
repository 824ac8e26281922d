"""Exact top-k search by inner product, with cover trees over queries and data.

Queries and data are indexed together. A bounded sample gives the pivots of the
upper level: each vector belongs to its nearest pivot, and every pivot has a
covering radius over all its vectors. Below, the vectors of a pivot lie in blocks
of bounded size, each with a cover tree of its own: the children of a node are
centres further apart than half its radius, and cover its vectors.

A query's k-th best score among the sample bounds its k-th best of all from
below. A group of queries goes only to pivots, and within a block only down to
nodes, whose best possible score with the group reaches the worst of these
bounds, which rise as better candidates are found. The rest is pruned; nothing
else is left out, so the result is exact.

Components are floor(scale * x). Rows without an id, vectors that are null or
empty or hold null or non-finite components, take no part. Vectors of different
lengths do not meet. Rows that share an id count as one candidate, with the best
score among them. Other columns are not read.

Scores are exact integers. Where doubles may round them, pruning allows for the
error, and what is left is scored in integers. A score among the k best that
leaves the range of a long is an error, as in SQL, and so is a component that
leaves the range of doubles when scaled.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from measlake.llm.common import kept
from measlake.llm.vectors import Best, Blocks, Bundle, mapped, matrices, ranked, sample

SCALE = 256
SAMPLE = 2048
PIVOTS = 16
BLOCK = 1024
GROUP = 128
LEAF = 32
# Sums of products are exact in doubles, and in longs, below these.
EXACT = 2.0**53
LONG = 2**63


@dataclass
class Node:
    """A centre, the radius that covers all its vectors, and its parts."""

    centre: np.ndarray
    radius: float
    members: np.ndarray
    children: list[Node]
    loose: np.ndarray  # members that are in no child


def spread_out(values: np.ndarray, count: int) -> np.ndarray:
    """Vectors that are far from each other: each the farthest from those before."""
    chosen = [0]
    away = np.linalg.norm(values - values[0], axis=1)
    while len(chosen) < min(count, len(values)) and away.max() > 0:
        chosen.append(int(away.argmax()))
        away = np.minimum(away, np.linalg.norm(values - values[chosen[-1]], axis=1))
    return values[chosen]


def cover_tree(values: np.ndarray, members: np.ndarray) -> Node:
    """Cover tree of the members; nodes are halved in radius from level to level."""
    centre = values[members[0]]
    away = np.linalg.norm(values[members] - centre, axis=1)
    root = Node(centre, float(away.max()), members, [], members)
    todo = [root]
    while todo:
        node = todo.pop()
        if len(node.members) <= LEAF or node.radius == 0 or not np.isfinite(node.radius):
            continue
        left, loose = node.members, []
        while len(left):
            centre = values[left[0]]
            away = np.linalg.norm(values[left] - centre, axis=1)
            near = away <= node.radius / 2
            if near.sum() == 1:
                loose.append(left[:1])
            else:
                child = Node(centre, float(away[near].max()), left[near], [], left[near])
                node.children.append(child)
                todo.append(child)
            left = left[~near]
        node.loose = np.concatenate(loose) if loose else left
    return root


def scaled(values: np.ndarray, scale: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        out = np.floor(values * scale)
    if not np.isfinite(out).all():
        raise ValueError("a component leaves the range of doubles when scaled")
    return out


def rounding(length: int, q_norms: np.ndarray, norms: np.ndarray) -> np.ndarray:
    """How far products of these vectors in doubles may be off, with room to spare."""
    return (length + 8) * 2.0**-51 * q_norms[:, None] * norms


def integers(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Exact products of one vector with many: longs, or Python's integers where they are larger."""
    if np.linalg.norm(q) * np.linalg.norm(x, axis=1).max() < LONG / 2 and (
        max(np.abs(q).max(), np.abs(x).max()) < LONG / 2
    ):
        return x.astype(np.int64) @ q.astype(np.int64)
    own = [int(a) for a in q.tolist()]
    found = [sum(a * int(b) for a, b in zip(own, row)) for row in x.tolist()]
    return np.array([*found, None], dtype=object)[:-1]


def below(score: float) -> float:
    """A score as a double, rounded down."""
    near = float(score)
    return near if near <= score else float(np.nextafter(near, -np.inf))


def search(
    queries: Bundle, query_tree: Node, data: Bundle, data_tree: Node, floor: np.ndarray, best: Best
) -> None:
    """Walk both trees, skipping pairs of nodes that cannot matter to any query of the pair."""
    query_ids, q = queries
    ids, x = data
    worst = np.array([below(best.worst(i, w)) for i, w in zip(query_ids.tolist(), floor.tolist())])
    q_norms, norms = np.linalg.norm(q, axis=1), np.linalg.norm(x, axis=1)
    exact = q_norms.max() * norms.max() < EXACT

    def reach(a: Node, b: Node) -> float:
        na, nb = np.linalg.norm(a.centre), np.linalg.norm(b.centre)
        more = na * b.radius + nb * a.radius + a.radius * b.radius
        # The error grows with the sizes, not with their sum, which may cancel.
        return float(a.centre @ b.centre + more + 1e-9 * (1 + na * nb + more))

    def compare(rows: np.ndarray, cols: np.ndarray) -> None:
        scores = q[rows] @ x[cols].T
        if exact:
            hits = scores >= worst[rows][:, None]
        else:
            most = scores + rounding(q.shape[1], q_norms[rows], norms[cols])
            hits = ~(most < worst[rows][:, None])
        for i in np.flatnonzero(hits.any(axis=1)).tolist():
            r, hit = rows[i], hits[i]
            query = int(query_ids[r])
            own = scores[i][hit] if exact else integers(q[r], x[cols[hit]])
            best.offer(query, own, ids[cols[hit]])
            worst[r] = below(best.worst(query, float(floor[r])))

    stack = [(query_tree, data_tree)]
    while stack:
        a, b = stack.pop()
        if reach(a, b) < worst[a.members].min():
            continue
        if not a.children and not b.children:
            compare(a.members, b.members)
        elif b.children and (not a.children or b.radius >= a.radius):
            if len(b.loose):
                compare(a.members, b.loose)
            # The most promising child is taken first, from the top of the stack.
            stack += sorted(((a, c) for c in b.children), key=lambda p: reach(*p))
        else:
            if len(a.loose):
                stack.append((Node(a.centre, a.radius, a.loose, [], a.loose), b))
            stack += [(c, b) for c in a.children]


def drained(best: Best) -> pa.RecordBatch:
    """All rows of ``best``, with scores as longs."""
    for query, rows in best.found.items():
        if any(-s >= LONG for s, _ in rows):
            raise ValueError(f"a score of {query} leaves the range of a long")
    return best.drain(pa.int64(), lambda s: int(s) if s >= -LONG else None)


def top_k(vectors: DataFrame, every: int, k: int, scale: int = SCALE) -> DataFrame:
    """The k best of all vectors for each one whose id is divisible by ``every``, itself left out."""
    drawn = {}
    for length, (ids, values) in sample(vectors, SAMPLE).items():
        # Repeated rows of a candidate count once.
        firsts = np.unique(ids, return_index=True)[1]
        drawn[length] = (ids[firsts], scaled(values[firsts], scale))
    pivots = {length: spread_out(values, PIVOTS) for length, (_, values) in drawn.items()}

    def pivots_of(length: int) -> np.ndarray:
        return pivots.get(length, np.zeros((1, length)))

    names = ["length", "cell", "radius", "block", "ids", "values"]
    schema = "length long, cell long, radius double, block long, ids binary, values binary"

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blocks = Blocks(BLOCK)
        number = TaskContext.get().partitionId() << 32

        def out(found: Iterator[tuple]) -> Iterator[pa.RecordBatch]:
            nonlocal number
            for (length, cell), ids, values in found:
                away = np.linalg.norm(values - pivots_of(length)[cell], axis=1)
                row = [length, cell, away.max(), number, ids.tobytes(), values.tobytes()]
                yield pa.RecordBatch.from_arrays([pa.array([v]) for v in row], names=names)
                number += 1

        for batch in batches:
            for ids, values in matrices(batch):
                values = scaled(values, scale)
                centres = pivots_of(values.shape[1])
                # Nearest by |x|^2 - 2 x.p + |p|^2, whose first part is the same for all.
                cells = ((centres**2).sum(axis=1) - 2 * values @ centres.T).argmin(axis=1)
                for cell in np.unique(cells).tolist():
                    own = cells == cell
                    key = (values.shape[1], cell)
                    yield from out(blocks.add(key, ids[own], values[own]))
        yield from out(blocks.rest())

    narrow = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding")
    index = kept(narrow.mapInArrow(build, schema), "cover-blocks")
    # One number per length and pivot.
    radii = {
        (r.length, r.cell): r.radius
        for r in index.groupBy("length", "cell").agg(F.max("radius").alias("radius")).collect()
    }

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        groups = Blocks(GROUP)

        def out(found: Iterator[tuple]) -> Iterator[pa.RecordBatch]:
            for (length, _), ids, values in found:
                floor = np.full(len(ids), -np.inf)
                norms = np.linalg.norm(values, axis=1)
                if length in drawn and len(drawn[length][0]) > k:
                    sample_ids, sample_values = drawn[length]
                    scores = values @ sample_values.T
                    sample_norms = np.linalg.norm(sample_values, axis=1)
                    if not norms.max() * sample_norms.max() < EXACT:
                        scores -= rounding(length, norms, sample_norms)
                        scores[np.isnan(scores)] = -np.inf
                    scores[ids[:, None] == sample_ids] = -np.inf
                    floor = np.sort(scores, axis=1)[:, -k]
                centres = pivots_of(length)
                for cell, centre in enumerate(centres):
                    if (length, cell) not in radii:
                        continue
                    more = norms * radii[length, cell]
                    most = values @ centre + more
                    most += 1e-9 * (1 + norms * np.linalg.norm(centre) + more)
                    some = ~(most < floor)
                    if some.any():
                        row = [length, cell, ids[some].tobytes(), values[some].tobytes()]
                        row.append(floor[some].tobytes())
                        yield pa.RecordBatch.from_arrays(
                            [pa.array([v]) for v in row],
                            names=["q_length", "q_cell", "q_ids", "q_values", "floor"],
                        )

        for batch in batches:
            for row in batch.select(["length", "cell", "ids", "values"]).to_pylist():
                ids = np.frombuffer(row["ids"], dtype=np.int64)
                values = np.frombuffer(row["values"]).reshape(len(ids), -1)
                own = ids % every == 0
                if own.any():
                    key = (row["length"], row["cell"])
                    yield from out(groups.add(key, ids[own], values[own]))
        yield from out(groups.rest())

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = Best(k)
        last, data, tree = None, None, None
        for batch in batches:
            for row in batch.to_pylist():
                if row["block"] != last:
                    last = row["block"]
                    ids = np.frombuffer(row["ids"], dtype=np.int64)
                    data = (ids, np.frombuffer(row["values"]).reshape(len(ids), -1))
                    tree = cover_tree(data[1], np.arange(len(ids)))
                ids = np.frombuffer(row["q_ids"], dtype=np.int64)
                queries = (ids, np.frombuffer(row["q_values"]).reshape(len(ids), -1))
                query_tree = cover_tree(queries[1], np.arange(len(ids)))
                search(queries, query_tree, data, tree, np.frombuffer(row["floor"]), best)
                if best.full():
                    yield drained(best)
        yield drained(best)

    groups = mapped(
        index, route, "q_length long, q_cell long, q_ids binary, q_values binary, floor binary"
    )
    pairs = index.drop("radius").join(
        groups, (F.col("length") == F.col("q_length")) & (F.col("cell") == F.col("q_cell"))
    )
    # Scores below the range of a long are null, which ranks last.
    found = ranked(mapped(pairs, meet, "query_id long, vec_id long, score long"), k)
    outside = F.raise_error(F.lit("a score leaves the range of a long")).cast("long")
    return found.withColumn("score", F.when(F.col("score").isNull(), outside).otherwise(F.col("score")))


SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS DOUBLE)) AS e
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.vec_id AS query_id, d.vec_id, CAST(list_inner_product(q.e, d.e) AS BIGINT) AS score
  FROM v q JOIN v d ON q.vec_id <> d.vec_id
  WHERE q.vec_id % 50 = 0),
r AS (
  SELECT query_id,
    CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
    vec_id, score
  FROM s)
SELECT * FROM r WHERE rank <= 5
"""
