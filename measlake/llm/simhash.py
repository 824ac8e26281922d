"""Near-duplicates by SimHash, with the points of a covering code as meeting places.

A fingerprint has 64 bits, one for each bit that more than half of the hashes of
a text's shingles have set. Fingerprints link if few bits differ.

The bits are cut into blocks of odd length. All combinations of all-zero and
all-one blocks are a code that covers every fingerprint: its home anchor has in
each block what most of the block's bits are. Whoever is within ``bits`` of a
fingerprint lives at an anchor that ``bits`` flips can lead to, that is, at one
whose distance is within the covering distance plus the threshold. Fingerprints
visit all those anchors, and are compared with the ones that live there. Of two
that link, the one with the smaller home anchor visits the other, so a visit to
smaller anchors is not needed.

Equal fingerprints are merged before. The number of blocks follows the number of
fingerprints, so that a few live at each anchor. An anchor with very many is
compared by quarters of the fingerprint: two that differ in three bits have a
quarter in common. Each anchor gives a spanning forest of its links, not all
pairs; components come from those.

Texts: A-Z is lowered, words are separated by U+0020 and U+0009 to U+000D. Fewer
words than a shingle has are one shingle; no words, null or empty, give the
fingerprint zero, which links like any other. Equal rows share a fingerprint.
Null ids are no candidates for the smallest id of a component. Other columns are
not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from measlake.llm.common import gathered, kept
from measlake.llm.components import components

SHINGLE = 3
BITS = 3
SEED = 42
HOME = 16  # fingerprints that live at an anchor, about
VISITS = 500_000  # visits a task compares at once, about
BATCH = 20_000
CROWD = 4096
LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


def fingerprint(text: bytes, shingle: int = SHINGLE, seed: int = SEED) -> int:
    """SimHash of a text in UTF-8."""
    words = text.translate(LOWER).split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = [0, *(ends[:-1] + 1).tolist()]
    ends = ends.tolist()[shingle - 1 :] or [len(joined)]
    counts = np.zeros(64, dtype=np.int64)
    for i in range(0, len(ends), 1 << 16):
        hashes = [
            xxhash.xxh64_intdigest(joined[a:b], seed)
            for a, b in zip(starts[i : i + (1 << 16)], ends[i : i + (1 << 16)])
        ]
        bits = np.unpackbits(np.array(hashes, dtype="<u8").view(np.uint8), bitorder="little")
        counts += bits.reshape(-1, 64).sum(axis=0, dtype=np.int64)
    high = np.packbits(2 * counts > len(ends), bitorder="little")
    return int(high.view("<u8")[0])


def with_fingerprints(docs: DataFrame, shingle: int = SHINGLE, column: str = "fp") -> DataFrame:
    """Adds the fingerprint of ``text`` as a signed long."""
    docs = docs.drop(column)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, texts in gathered(batches):
            found = np.array([fingerprint(t, shingle) for t in texts], dtype=np.uint64)
            added = rows.append_column(column, pa.array(found.view(np.int64)))
            yield from added.combine_chunks().to_batches()

    return docs.mapInArrow(run, f"{docs.schema.simpleString()[7:-1]},{column}:bigint")


def block_lengths(count: int) -> list[int]:
    """Lengths of the blocks, all odd; an even number of blocks that covers 64 bits."""
    blocks = max(2, min(64, math.ceil(math.log2(max(2, count / HOME)))))
    blocks += blocks % 2
    length = 64 // blocks
    length -= 1 - length % 2
    longer = (64 - blocks * length) // 2
    return [length + 2] * longer + [length] * (blocks - longer)


def visits(
    prints: np.ndarray, lengths: list[int], bits: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Index of the fingerprint, anchor, and whether it is the home, of every visit."""
    home = np.zeros(len(prints), dtype=np.uint64)
    costs = np.zeros((len(lengths), len(prints)), dtype=np.int8)
    low = 0
    for j, length in enumerate(lengths):
        part = (prints >> np.uint64(low)) & np.uint64((1 << length) - 1)
        ones = np.bitwise_count(part).astype(np.int8)
        half = length // 2
        home |= (ones > half).astype(np.uint64) << np.uint64(j)
        # Flips after which the block's majority is the other one.
        costs[j] = np.where(ones > half, ones - half, half + 1 - ones)
        low += length
    index, anchor = np.arange(len(prints)), home.copy()
    spent = np.zeros(len(prints), dtype=np.int8)
    for j in range(len(lengths)):
        total = spent + costs[j][index]
        more = total <= bits
        index = np.concatenate([index, index[more]])
        anchor = np.concatenate([anchor, anchor[more] ^ np.uint64(1 << j)])
        spent = np.concatenate([spent, total[more]])
    wanted = anchor >= home[index]
    index, anchor = index[wanted], anchor[wanted]
    return index, anchor, anchor == home[index]


def forest(living: np.ndarray, guests: np.ndarray, bits: int) -> list[tuple[int, int]]:
    """Edges that span the links among those living here, and of guests with them."""
    everyone = np.concatenate([living, guests])
    label = np.arange(len(everyone))

    def compare(own: np.ndarray, others: np.ndarray) -> None:
        for i in own:
            near = others[np.bitwise_count(everyone[others] ^ everyone[i]) <= bits]
            labels = np.unique(label[near])
            if len(labels) > 1:
                label[np.isin(label, labels)] = labels[0]

    own, all_here = np.arange(len(living)), np.arange(len(everyone))
    if len(everyone) <= CROWD or bits > 3:
        compare(own, all_here)
    else:
        for quarter in range(4):
            part = (everyone >> np.uint64(16 * quarter)) & np.uint64(0xFFFF)
            order = np.argsort(part, kind="stable")
            for group in np.split(order, np.flatnonzero(np.diff(part[order])) + 1):
                compare(group[group < len(living)], group)
    linked = np.flatnonzero(label != all_here)
    return [(int(everyone[i]), int(everyone[label[i]])) for i in linked]


def links(prints: DataFrame, count: int, bits: int = BITS) -> DataFrame:
    """Edges (a, b) whose components are those of all links among the distinct ``fp``."""
    lengths = block_lengths(count)
    one = visits(np.random.default_rng(0).integers(0, 2**63, 256, dtype=np.uint64), lengths, bits)
    buckets = max(1, round(count * len(one[0]) / 256 / VISITS))

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []

        def out() -> pa.RecordBatch:
            found = np.concatenate(held).view(np.uint64)
            index, anchor, living = visits(found, lengths, bits)
            mixed = (anchor * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(32)
            bucket = (mixed % np.uint64(buckets)).astype(np.int64)
            order = np.argsort(bucket, kind="stable")
            cuts = np.flatnonzero(np.diff(bucket[order])) + 1
            groups = np.split(order, cuts)
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([int(bucket[g[0]]) for g in groups], pa.int64()),
                    pa.array([anchor[g].tobytes() for g in groups], pa.binary()),
                    pa.array([found[index[g]].tobytes() for g in groups], pa.binary()),
                    pa.array([living[g].tobytes() for g in groups], pa.binary()),
                ],
                names=["bucket", "anchors", "prints", "living"],
            )

        for batch in batches:
            held.append(batch.column(0).to_numpy(zero_copy_only=False))
            if sum(map(len, held)) >= BATCH:
                yield out()
                held = []
        if sum(map(len, held)):
            yield out()

    def meet(rows: pd.DataFrame) -> pd.DataFrame:
        anchors = np.frombuffer(b"".join(rows["anchors"]), dtype=np.uint64)
        found = np.frombuffer(b"".join(rows["prints"]), dtype=np.uint64)
        living = np.frombuffer(b"".join(rows["living"]), dtype=bool)
        order = np.lexsort((~living, anchors))
        anchors, found, living = anchors[order], found[order], living[order]
        edges: list[tuple[int, int]] = []
        starts = np.append(np.flatnonzero(np.diff(anchors, prepend=~anchors[:1])), len(anchors))
        homes = np.add.reduceat(living, starts[:-1], dtype=np.int64)
        for a, b, n in zip(starts[:-1].tolist(), starts[1:].tolist(), homes.tolist()):
            if n and b - a > 1:
                edges += forest(found[a : a + n], found[a + n : b], bits)
        pairs = np.array(edges, dtype=np.uint64).reshape(-1, 2).view(np.int64)
        return pd.DataFrame({"a": pairs[:, 0], "b": pairs[:, 1]})

    packed = prints.select("fp").mapInArrow(
        spread, "bucket long, anchors binary, prints binary, living binary"
    )
    return packed.groupBy("bucket").applyInPandas(meet, "a long, b long")


def classes(docs: DataFrame, bits: int = BITS) -> DataFrame:
    """(fp, root, component_id) per distinct fingerprint of (doc_id, fp).

    ``root`` names the component; ``component_id`` is its smallest id.
    """
    firsts = kept(docs.groupBy("fp").agg(F.min("doc_id").alias("first")), "simhash-prints")
    edges = kept(links(firsts, firsts.count(), bits), "simhash-links")
    found = components(edges, "simhash-components")
    rooted = firsts.join(found, F.col("fp") == F.col("node"), "left").select(
        "fp", "first", F.coalesce("root", "fp").alias("root")
    )
    smallest = rooted.groupBy(F.col("root").alias("of")).agg(F.min("first").alias("component_id"))
    return kept(
        rooted.join(smallest, F.col("root") == F.col("of")).select("fp", "root", "component_id"),
        "simhash-classes",
    )


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, bits: int = BITS) -> DataFrame:
    """Each document's fingerprint and component."""
    prints = kept(
        with_fingerprints(docs.select("doc_id", "text"), shingle).drop("text"), "simhash-docs"
    )
    named = classes(prints, bits).withColumnRenamed("fp", "of")
    return prints.join(named, F.col("fp") == F.col("of")).select(
        "doc_id",
        F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        "component_id",
    )


def one_of_each(docs: DataFrame, shingle: int = SHINGLE, bits: int = BITS) -> DataFrame:
    """The documents without near-duplicates: of each component the row with the smallest id."""
    rows = kept(
        with_fingerprints(docs, shingle, "__fp").withColumn(
            "__row", F.monotonically_increasing_id()
        ),
        "simhash-rows",
    )
    narrow = rows.select("doc_id", F.col("__fp").alias("fp"), "__row")
    named = classes(narrow, bits).withColumnRenamed("fp", "of")
    stay = (
        narrow.join(named, F.col("fp") == F.col("of"))
        .where(F.col("doc_id").eqNullSafe(F.col("component_id")))
        .groupBy("root")
        .agg(F.min("__row").alias("__row"))
    )
    return rows.join(stay.select("__row"), "__row", "left_semi").select(*docs.columns)
