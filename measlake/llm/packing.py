"""Packing documents into sequences of a fixed number of tokens.

A document's tokens are cut into full sequences, and what is left over into
pieces of an eighth of a sequence at most. These are packed in groups of about
``GROUP`` tokens by Karmarkar-Karp differencing over all windows of the group at
once (in its balanced form, which starts from tuples of as many pieces as there
are windows): the two partial partitions with the widest spread are merged so
that the fullest window of one meets the emptiest of the other, until one
partition is left. If a window then exceeds the capacity, the group gets
another window.

A group lies within one input partition, so nothing is shuffled, a task holds
one group at a time, and a task that is run again numbers its sequences alike.

A null or empty text has the end id alone. Equal rows are packed each. A null
id is passed on. Other columns of the input are not read.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from measlake.llm.common import gathered
from measlake.llm.tokens import encoder

CAPACITY = 2048
GROUP = 1 << 20
END = 1
# Sequences a task may number; the number of its partition stands above them.
PER_TASK = 1 << 40


def differenced(sizes: np.ndarray, windows: int) -> tuple[np.ndarray, np.ndarray]:
    """Sizes of the windows, and a matrix with the items of window j in column j (-1: none)."""
    order = np.argsort(-sizes, kind="stable")
    rows = np.concatenate([order, np.full(-len(order) % windows, -1)]).reshape(-1, windows)
    padded = np.append(sizes, 0)
    heap = []
    for i, row in enumerate(rows):
        sums = padded[row]
        heap.append((int(sums.min() - sums.max()), i, sums, row[None, :]))
    heapq.heapify(heap)
    count = len(heap)
    while len(heap) > 1:
        _, _, a, a_items = heapq.heappop(heap)
        _, _, b, b_items = heapq.heappop(heap)
        fullest, emptiest = np.argsort(-a, kind="stable"), np.argsort(b, kind="stable")
        sums = a[fullest] + b[emptiest]
        items = np.vstack([a_items[:, fullest], b_items[:, emptiest]])
        heapq.heappush(heap, (int(sums.min() - sums.max()), count, sums, items))
        count += 1
    return heap[0][2], heap[0][3]


def windows_of(sizes: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, int]:
    """Window and offset of each item, and the number of windows.

    No item is larger than the capacity.
    """
    if not len(sizes):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), 0
    windows = max(1, -(-int(sizes.sum()) // capacity))
    while True:
        sums, items = differenced(sizes, windows)
        if sums.max() <= capacity:
            break
        windows += 1
    lengths = np.append(sizes, 0)[items]
    begins = np.cumsum(lengths, axis=0) - lengths
    window, offset = np.zeros(len(sizes), np.int64), np.zeros(len(sizes), np.int64)
    there = items >= 0
    window[items[there]] = np.broadcast_to(np.arange(windows), items.shape)[there]
    offset[items[there]] = begins[there]
    return window, offset, windows


def pack(
    docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, group: int = GROUP, end: int = END
) -> DataFrame:
    """Pieces of all documents: doc_id, start, length, doc_tokens, ids, sequence_id, offset.

    ``ids`` holds a piece's tokens as little-endian unsigned 32-bit numbers;
    ``tokenizer`` is the path of a file for the tokenizers library. Ids of
    sequences are not gapless; offsets within one are.
    """
    small = max(1, capacity // 8)
    closing = np.array([end], dtype="<u4").tobytes()
    names = ["doc_id", "start", "length", "doc_tokens", "ids", "sequence_id", "offset"]
    id_type = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {id_type}, start long, length long, doc_tokens long, ids binary, " + (
        "sequence_id long, offset long"
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer).encode
        sequence = (TaskContext.get().partitionId() if TaskContext.get() else 0) * PER_TASK
        kind = None
        held: list[tuple] = []
        tokens = 0

        def batch(pieces: list[tuple]) -> pa.RecordBatch:
            columns = [list(c) for c in zip(*pieces)]
            types = [kind, *[pa.int64()] * 3, pa.binary(), *[pa.int64()] * 2]
            return pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, types)], names=names
            )

        def packed() -> pa.RecordBatch:
            nonlocal sequence
            window, offset, windows = windows_of(np.array([p[2] for p in held]), capacity)
            pieces = [
                (*p, w, o)
                for p, w, o in zip(held, (window + sequence).tolist(), offset.tolist())
            ]
            sequence += windows
            return batch(pieces)

        for rows, texts in gathered(batches, target=1 << 20):
            kind = rows.schema.field("doc_id").type
            encoded = encode([t.decode("utf-8", "replace") for t in texts])
            full = []
            for doc_id, ids in zip(rows.column("doc_id").to_pylist(), encoded):
                ids += closing
                total = len(ids) // 4
                whole = total // capacity * capacity
                for start in range(0, whole, capacity):
                    part = ids[4 * start : 4 * (start + capacity)]
                    full.append((doc_id, start, capacity, total, part, sequence, 0))
                    sequence += 1
                for start in range(whole, total, small):
                    part = ids[4 * start : 4 * min(start + small, total)]
                    held.append((doc_id, start, len(part) // 4, total, part))
                    tokens += len(part) // 4
                if tokens >= group:
                    yield packed()
                    held, tokens = [], 0
            if full:
                yield batch(full)
        if held:
            yield packed()

    return docs.select("doc_id", "text").mapInArrow(run, schema)


def digest(pieces: DataFrame) -> DataFrame:
    """The pieces with a checksum in place of their tokens."""
    return pieces.select(
        "doc_id",
        "start",
        "length",
        F.crc32("ids").alias("ids_crc32"),
        "doc_tokens",
        "sequence_id",
        "offset",
    )
