"""Vectors in blocks: rows that each hold many vectors of one length.

Null vectors, empty ones, and ones with null or non-finite components are left
out, as are rows without an id. Vectors of different lengths never meet.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

Bundle = tuple[np.ndarray, np.ndarray]


def matrices(batch: pa.RecordBatch) -> Iterator[Bundle]:
    """Ids and vectors (as doubles) of a batch of (id, array), per length of vector."""
    ids, column = batch.column(0), batch.column(1)
    there = np.asarray(ids.is_valid()) & np.asarray(column.is_valid())
    ids = ids.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
    flat = column.flatten().cast(pa.float64()).to_numpy(zero_copy_only=False)
    # flatten() skips null lists; their lengths count as zero.
    lengths = np.asarray(column.value_lengths().fill_null(0)).astype(np.int64)
    starts = np.cumsum(lengths) - lengths
    for length in np.unique(lengths[there & (lengths > 0)]).tolist():
        rows = np.flatnonzero(there & (lengths == length))
        found = flat[starts[rows][:, None] + np.arange(length)]
        good = np.isfinite(found).all(axis=1)
        if good.any():
            yield ids[rows[good]], found[good]


def sample(vectors: DataFrame, size: int) -> dict[int, Bundle]:
    """At most ``size`` rows, in the order of a hash of their ids, by length of vector."""
    rows = (
        vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding")
        .where("vec_id IS NOT NULL AND size(embedding) > 0")
        .orderBy(F.xxhash64("vec_id"), "vec_id")
        .limit(size)
        .toArrow()
    )
    found: dict[int, list[Bundle]] = {}
    for batch in rows.combine_chunks().to_batches():
        for ids, values in matrices(batch):
            found.setdefault(values.shape[1], []).append((ids, values))
    return {
        length: (np.concatenate([i for i, _ in parts]), np.concatenate([v for _, v in parts]))
        for length, parts in found.items()
    }


class Blocks:
    """Collects vectors by key and gives them back in blocks of ``size``."""

    def __init__(self, size: int) -> None:
        self.size = size
        self.held: dict[tuple, list[Bundle]] = {}

    def add(self, key: tuple, ids: np.ndarray, values: np.ndarray) -> Iterator[tuple]:
        parts = self.held.setdefault(key, [])
        parts.append((ids, values))
        if sum(len(p[0]) for p in parts) >= self.size:
            ids, values = map(np.concatenate, zip(*parts))
            whole = len(ids) // self.size * self.size
            for i in range(0, whole, self.size):
                yield key, ids[i : i + self.size], values[i : i + self.size]
            self.held[key] = [(ids[whole:], values[whole:])] if whole < len(ids) else []

    def rest(self) -> Iterator[tuple]:
        for key, parts in self.held.items():
            if parts:
                yield key, *map(np.concatenate, zip(*parts))


class Best:
    """The best ``k`` per query so far, kept over all blocks a task sees.

    Hands out and forgets everything when it holds ``most`` queries, so that its
    size does not grow with the input; the ranking over all tasks follows.
    """

    def __init__(self, k: int, most: int = 50_000) -> None:
        self.k, self.most = k, most
        self.found: dict[int, list[tuple]] = {}

    def worst(self, query: int, least: float) -> float:
        rows = self.found.get(query)
        return max(least, -rows[-1][0]) if rows and len(rows) == self.k else least

    def whole(self, query: int) -> bool:
        return len(self.found.get(query, [])) == self.k

    def offer(self, query: int, scores: np.ndarray, ids: np.ndarray) -> None:
        rows = dict((i, s) for s, i in self.found.get(query, []))
        # Before any cut: the query itself must not take a place.
        others = ids != query
        scores, ids = scores[others], ids[others]
        if len(scores) > 4 * self.k:
            if scores.dtype == object:  # integers of any size
                order = np.array(sorted(range(len(ids)), key=lambda i: (-scores[i], ids[i])))
            else:
                order = np.lexsort((ids, -scores))
            scores, ids = scores[order], ids[order]
            # Repeated rows may fill the first places; distinct ids are wanted.
            firsts = np.sort(np.unique(ids, return_index=True)[1])[: self.k]
            scores, ids = scores[firsts], ids[firsts]
        for score, i in zip(scores.tolist(), ids.tolist()):
            if -score < rows.get(i, float("inf")):
                rows[i] = -score
        self.found[query] = sorted((s, i) for i, s in rows.items())[: self.k]

    def full(self) -> bool:
        return len(self.found) >= self.most

    def drain(self, score_type: pa.DataType, kind: Callable = float) -> pa.RecordBatch:
        """All rows, their scores made by ``kind`` from numbers."""
        rows = [(q, i, kind(-s)) for q, best in self.found.items() for s, i in best]
        self.found = {}
        types = [pa.int64(), pa.int64(), score_type]
        columns = list(zip(*rows)) if rows else [(), (), ()]
        return pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(columns, types)], names=["query_id", "vec_id", "score"]
        )


def ranked(candidates: DataFrame, k: int) -> DataFrame:
    """The best ``k`` of (query_id, vec_id, score), ties to smaller ids."""
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        candidates.groupBy("query_id", "vec_id")
        .agg(F.max("score").alias("score"))
        .withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )


def mapped(df: DataFrame, run: Callable, schema: str, rows: int = 8) -> DataFrame:
    """mapInArrow; ``run`` is handed its input in batches of at most ``rows`` rows."""

    def small(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return run(b.slice(i, rows) for b in batches for i in range(0, b.num_rows, rows))

    return df.mapInArrow(small, schema)
