"""Passages that documents repeat, found by a sampled enhanced suffix array.

A byte goes if a string of ``LEAST`` bytes that covers it also starts in a
document with a smaller id. Sorting all suffixes would move the corpus many
times over; it is enough to sort those that start at anchors. A position is an
anchor if the hash of the ``GRAM`` bytes behind it is the least of some window of
consecutive positions, with windows such that every string of ``LEAST`` bytes
holds a whole one: equal strings have their anchors at equal places.

1. Each chunk of documents sends the hashes of its anchors to buckets, which
   answer with those that more than one document has.
2. For these, each chunk sends what can lie in one string with the anchor, once
   per distinct context, in the name of the smallest document that has it.
3. Each bucket sorts the contexts by what follows the anchor start, and scans
   the common prefixes of neighbours with a stack into the tree of common-prefix
   intervals. An interval is a repeated string with all its occurrences. What
   stands before the anchor tells apart, step by step to the left, which of them
   extend alike: a group that is whole and differs in the next byte is a maximal
   repeat. In each, all but the smallest document's occurrences are repeats.
4. Each chunk marks and cuts its documents.

Chunks and buckets are of bounded size and grow in number. A passage that very
many documents share comes once from each chunk. Anchors with a very frequent
hash, where contexts may differ without end (the edge of a footer, a long row of one
byte), send no contexts: every string of ``LEAST`` bytes around them goes to
a bucket of its own hash, once per chunk. Chunks are drawn by id and text, so rows
without an id, or with one repeated id, spread; rows equal in both are one row with a
count. Exact copies in larger ids are known beforehand by their hash and sent
nowhere. The documents' own shuffle is one exchange that all passes read. What is
not bounded is one text: a chunk holds it whole, with up to some hundred bytes
for each of its anchors.

A null text is empty. A null id, or one that is no integer, counts as larger than all
others. Documents that share an id do not shorten each other. Texts below ``LEAST``
bytes stay whole. Other columns are not read.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from numpy.lib.stride_tricks import sliding_window_view
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from measlake.llm.common import kept, text_bytes

LEAST = 50
GRAM = 18
CHUNK = 4 << 20
BUCKET = 500_000  # anchors
# A hash is frequent from so many chunks on, each counting as often as it has HEAVY or more of it.
FREQUENT = 5_000
HEAVY = 64
SLICE = 1 << 17
PER_ANCHOR = (LEAST - GRAM + 2) / 2
LAST = (1 << 63) - 1
TIMES = 4096
# Equal rows whose ids and hashes are at most so many bytes go to every task, so that no text moves for them.
TWINS = 4 << 20

BASE = 0xD6E8FEB86659FD93
OTHER_BASE = 0xA0761D6478BD642F
MIX = np.uint64(0x9E3779B97F4A7C15)


def unpacked(data: bytes, size: int) -> tuple:
    return pickle.loads(pa.decompress(data, decompressed_size=size, codec="zstd", asbytes=True))


def rows_of(rows: list[tuple[int, int, tuple[int, bytes]]], names: list[str]) -> pa.Table:
    return pa.table(
        {
            names[0]: pa.array([row[0] for row in rows], pa.int32()),
            names[1]: pa.array([row[1] for row in rows], pa.int32()),
            "bytes": pa.array([row[2][0] for row in rows], pa.int64()),
            "data": pa.array([row[2][1] for row in rows], pa.binary()),
        }
    )


def blob(*arrays: object) -> tuple[int, bytes]:
    """Length and compressed form of arrays."""
    raw = pickle.dumps(arrays, protocol=5)
    return len(raw), pa.compress(raw, codec="zstd", asbytes=True)


def arrays_of(table: pa.Table) -> Iterator[tuple]:
    """Key columns and arrays of each row."""
    for row in table.to_pylist():
        first, second = list(row.values())[:2]
        yield first, second, *unpacked(row["data"], row["bytes"])


def steps(ascending: np.ndarray) -> np.ndarray:
    """Differences of ascending numbers: small ones, which compress well."""
    return np.diff(ascending, prepend=ascending.dtype.type(0))


class Chunk:
    """The documents of a chunk, one behind the other, in the order of their ids."""

    def __init__(self, table: pa.Table, gram: int, least: int) -> None:
        ranks = table.column("rank").to_numpy()
        self.prints = table.column("print").to_pylist()
        texts = [t or b"" for t in table.column("text").cast(pa.binary()).to_pylist()]
        self.order = np.argsort(ranks, kind="stable")
        self.ranks = ranks[self.order]
        self.texts = [texts[i] for i in self.order.tolist()]
        self.data = np.frombuffer(b"".join(self.texts), dtype=np.uint8)
        self.ends = np.cumsum([len(t) for t in self.texts]).astype(np.int64)
        self.starts = self.ends - np.array([len(t) for t in self.texts], dtype=np.int64)
        self.gram, self.least = gram, least

    def document(self, places: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.ends, places, side="right")

    def among(self, rows: pa.Table) -> np.ndarray:
        """Which documents are among rows of rank and print."""
        known = set(zip(rows.column("rank").to_pylist(), rows.column("print").to_pylist()))
        own = zip(self.ranks.tolist(), (self.prints[i] for i in self.order.tolist()))
        return np.fromiter((pair in known for pair in own), dtype=bool, count=len(self.texts))

    def hashes(self, places: np.ndarray) -> np.ndarray:
        """Hashes of the grams at the places."""
        total = np.zeros(len(places), dtype=np.uint64)
        for first in range(0, len(places), SLICE):
            part = places[first : first + SLICE]
            sums = np.zeros(len(part), dtype=np.uint64)
            for i in range(self.gram):
                sums = sums * np.uint64(BASE) + (self.data[part + i].astype(np.uint64) + np.uint64(1))
            total[first : first + SLICE] = finished(sums)
        return total

    def strings(self, places: np.ndarray) -> tuple[np.ndarray, ...]:
        """Starts of all strings that hold a gram at one of the places and do not cross documents.

        Also which distinct string each start has; and two hashes and the smallest rank of each
        distinct string, by hash.
        """
        document = self.document(places)
        low = np.maximum(places - (self.least - self.gram), self.starts[document])
        high = np.minimum(places, self.ends[document] - self.least) + 1
        some = low < high
        edges = np.zeros(len(self.data) + 1, dtype=np.int32)
        np.add.at(edges, low[some], 1)
        np.add.at(edges, high[some], -1)
        starts = np.flatnonzero(np.cumsum(edges[:-1], dtype=np.int32))
        one, other = (np.zeros(len(starts), dtype=np.uint64) for _ in range(2))
        for first in range(0, len(self.data), SLICE):
            a, b = np.searchsorted(starts, [first, first + SLICE])
            if a < b:
                part = self.data[first : first + SLICE + self.least - 1]
                one[a:b] = rolling(part, self.least)[starts[a:b] - first]
                other[a:b] = rolling(part, self.least, OTHER_BASE)[starts[a:b] - first]
        # Starts ascend with the ids, so the first of equal strings is of the smallest document.
        order = np.lexsort((other, one))
        one, other = one[order], other[order]
        begins = np.append(True, (one[1:] != one[:-1]) | (other[1:] != other[:-1]))[: len(one)]
        which = np.empty(len(starts), dtype=np.int64)
        which[order] = np.cumsum(begins) - 1
        firsts = starts[order[begins]]
        return starts, which, one[begins], other[begins], self.ranks[self.document(firsts)]

    def anchors(self) -> np.ndarray:
        """Places of all anchors. No gram crosses documents."""
        window = self.least - self.gram + 1
        found = []
        for first in range(0, len(self.data), SLICE):
            low = max(0, first - window + 1)
            high = min(len(self.data), first + SLICE + window - 1 + self.gram - 1)
            if high - low < self.gram:
                continue
            grams = rolling(self.data[low:high], self.gram)
            key = (grams >> np.uint64(32)).astype(np.uint32)
            # Grams that would run over the end of a document are never the least.
            most = np.uint32(0xFFFFFFFF)
            np.minimum(key, most - np.uint32(1), out=key)
            a, b = np.searchsorted(self.ends, [low, high + self.gram])
            for end in self.ends[a : b + 1].tolist():
                key[max(0, end - self.gram + 1 - low) : max(0, end - low)] = most
            pad = np.full(window - 1, most)
            least = swept(np.concatenate([pad, key, pad]), window, np.minimum)
            # least[i] is of the window that ends at i; the largest of those that hold i.
            chosen = key == swept(least, window, np.maximum)
            chosen &= key != most
            places = np.flatnonzero(chosen) + low
            found.append(places[(places >= first) & (places < first + SLICE)])
        return np.concatenate(found) if found else np.zeros(0, np.int64)

    def contexts(self, places: np.ndarray) -> tuple[np.ndarray, ...]:
        """Bytes before (nearest first) and from each place, and how many there are of each."""
        document = self.document(places)
        reach = self.least - self.gram
        before = np.minimum(places - self.starts[document], reach)
        behind = np.minimum(self.ends[document] - places, self.least)
        wide = np.concatenate([np.zeros(reach, np.uint8), self.data, np.zeros(self.least, np.uint8)])
        left = sliding_window_view(wide, reach)[places][:, ::-1]
        right = sliding_window_view(wide, self.least)[places + reach]
        left = np.where(np.arange(reach) < before[:, None], left, np.uint8(0))
        right[np.arange(self.least) >= behind[:, None]] = 0
        return left, right, before.astype(np.uint8), behind.astype(np.uint8)


def finished(sums: np.ndarray) -> np.ndarray:
    sums = (sums ^ (sums >> np.uint64(31))) * MIX
    return sums ^ (sums >> np.uint64(29))


def rolling(data: np.ndarray, length: int, with_base: int = BASE) -> np.ndarray:
    """Hash of the ``length`` bytes at every place, put together from powers of two."""
    part = data.astype(np.uint64) + np.uint64(1)
    have, base = 1, with_base
    total, done = None, 0
    while True:
        if length & have:
            if total is None:
                total = part
            else:
                # The part stands before what is there already.
                count = len(data) - done - have + 1
                factor = np.uint64(pow(with_base, done, 1 << 64))
                total = part[:count] * factor + total[have : have + count]
            done += have
        if done == length:
            return finished(total)
        part = part[:-have] * np.uint64(base) + part[have:]
        have, base = 2 * have, base * base % (1 << 64)


def swept(values: np.ndarray, window: int, join: np.ufunc) -> np.ndarray:
    """The join over every ``window`` consecutive values."""
    count, size = len(values) - window + 1, 1
    while 2 * size <= window:
        values = join(values[:-size], values[size:])
        size *= 2
    return join(values[:count], values[window - size : window - size + count])


def common(values: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Length of what each row has in common with the row before (0 for the first)."""
    out = np.zeros(len(values), dtype=np.int64)
    if len(values) > 1:
        differ = values[1:] != values[:-1]
        first = np.where(differ.any(axis=1), differ.argmax(axis=1), values.shape[1])
        out[1:] = np.minimum(first, np.minimum(lengths[1:], lengths[:-1]))
    return out


def sorted_by(values: np.ndarray, lengths: np.ndarray, before: np.ndarray | None = None) -> np.ndarray:
    """Order of the rows as strings, shorter before longer; within ``before``, if given."""
    wide = -(-values.shape[1] // 8) * 8
    padded = np.zeros((len(values), wide), dtype=np.uint8)
    padded[:, : values.shape[1]] = values
    words = padded.view(">u8").astype(np.uint64)
    keys = [lengths, *(words[:, i] for i in range(words.shape[1] - 1, -1, -1))]
    return np.lexsort(keys if before is None else [*keys, before])


def intervals(prefix: np.ndarray, least: int) -> list[tuple[int, int, int, int]]:
    """First row, end, depth and depth of the parent of each common-prefix interval.

    ``prefix`` has for each row what it has in common with the row before.
    """
    found = []
    stack: list[tuple[int, int]] = []  # first row, depth
    for row, depth in enumerate([*prefix.tolist(), 0]):
        first = row - 1
        while stack and stack[-1][1] > depth:
            first, deep = stack.pop()
            parent = max(depth, stack[-1][1] if stack else 0)
            found.append((first, row, deep, max(parent, least - 1)))
        if depth >= least and (not stack or stack[-1][1] < depth):
            stack.append((first, depth))
    return found


def repeated(
    left: np.ndarray, right: np.ndarray, before: np.ndarray, behind: np.ndarray, ranks: np.ndarray,
    gram: int, least: int,
) -> np.ndarray:
    """For each context a number whose bit o says that the string which starts o bytes before the
    anchor also starts in a smaller document."""
    masks = np.zeros(len(ranks), dtype=np.uint64)
    order = sorted_by(right, behind)
    tree = intervals(common(right[order], behind[order].astype(np.int64)), gram)
    if not tree:
        return masks
    first, end, depth, parent = np.array(tree, dtype=np.int64).T
    # Strings that start o before the anchor need least - o bytes from it on; for these
    # numbers of bytes the rows that agree are the ones of the interval.
    low, high = least - depth, np.minimum(least - gram, least - 1 - parent)
    some = low <= high
    first, end, low, high = first[some], end[some], low[some], high[some]
    sizes = end - first
    of = np.repeat(np.arange(len(first)), sizes)
    within = np.arange(len(of)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    rows = order[first[of] + within]
    again = sorted_by(left[rows], before[rows], of)
    rows, of = rows[again], of[again]
    same = common(left[rows], before[rows].astype(np.int64))
    same[np.flatnonzero(np.diff(of, prepend=-1))] = -1
    enough, rank = before[rows], ranks[rows]
    for o in range(least - gram + 1):
        at = np.flatnonzero((low[of] <= o) & (o <= high[of]))
        if not len(at):
            continue
        # Intervals are in or out as a whole, so neighbours stay neighbours.
        begins = np.flatnonzero(same[at] < o)
        smallest = np.minimum.reduceat(rank[at], begins)
        smallest = np.repeat(smallest, np.diff(np.append(begins, len(at))))
        hit = (rank[at] > smallest) & (enough[at] >= o)
        np.bitwise_or.at(masks, rows[at[hit]], np.uint64(1 << o))
    return masks


def collapsed(places: np.ndarray, document: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """First of each row of neighbouring places with one hash in one document."""
    alike = (np.diff(places) == 1) & (hashes[1:] == hashes[:-1]) & (document[1:] == document[:-1])
    return np.flatnonzero(np.append(True, ~alike)[: len(places)])


def found_in(values: np.ndarray, among: np.ndarray) -> np.ndarray:
    """Which values are among ascending ones."""
    if not len(among):
        return np.zeros(len(values), dtype=bool)
    there = np.zeros(len(values), dtype=bool)
    for first in range(0, len(values), SLICE):
        part = values[first : first + SLICE]
        at = np.minimum(np.searchsorted(among, part), len(among) - 1)
        there[first : first + SLICE] = among[at] == part
    return there


def grouped_by_bucket(bucket: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    order = np.argsort(bucket, kind="stable")
    cuts = np.flatnonzero(np.diff(bucket[order])) + 1
    for rows in np.split(order, cuts) if len(order) else []:
        yield int(bucket[rows[0]]), rows


def once_each(docs: DataFrame, twins: DataFrame) -> DataFrame:
    """Rows equal in id and text once, with their number ``n``.

    ``twins`` is written already, so its size is measured: a small one, as usual, moves no texts.
    """
    named = twins.select(
        F.col("doc_id").alias("twin_id"), F.col("rank").alias("twin_rank"), F.col("print").alias("twin_print"), "n"
    )
    width = F.coalesce(F.octet_length(F.col("doc_id").cast("string")), F.lit(0)) + 64
    if (twins.agg(F.sum(width)).first()[0] or 0) <= TWINS:
        named = F.broadcast(named)
    same = F.col("doc_id").eqNullSafe(F.col("twin_id")) & (F.col("rank") == F.col("twin_rank"))
    same &= F.col("print") == F.col("twin_print")
    single = docs.join(named, same, "left_anti").withColumn("n", F.lit(1).cast("long"))
    several = docs.join(named, same).groupBy("doc_id", "rank", "print", "n").agg(F.first("text").alias("text"))
    return single.unionByName(several)


def cut_repeats(docs: DataFrame, least: int = LEAST, gram: int = GRAM) -> DataFrame:
    """Per document: doc_id, n_bytes, spans removed (start and end in bytes), bytes that remain."""
    docs = docs.select(
        "doc_id",
        F.coalesce(F.col("doc_id").try_cast("long"), F.lit(LAST)).alias("rank"),
        F.coalesce("text", F.lit("")).alias("text"),
    ).withColumn("print", F.unhex(F.md5("text")))
    total = docs.agg(F.sum(text_bytes())).first()[0] or 0
    chunks = total // CHUNK + 1
    buckets = int(total / PER_ANCHOR / BUCKET) + 1
    chunk_of = F.pmod(F.xxhash64("rank", "print"), F.lit(chunks)).cast("int")
    prints = kept(
        docs.groupBy("doc_id", "rank", "print").agg(F.count(F.lit(1)).alias("n")), "repeats-prints"
    )
    # Written first, so that the join below may split a text with very many copies.
    firsts = kept(
        prints.groupBy("print")
        .agg(F.min("rank").alias("first"), F.count(F.lit(1)).alias("rows"))
        .where("rows > 1")
        .drop("rows"),
        "repeats-firsts",
    )
    copies = kept(
        prints.join(firsts, "print")
        .where("rank > first")
        .select(chunk_of.alias("chunk"), "rank", "print")
        .distinct(),
        "repeats-copies",
    )
    twins = kept(prints.where("n > 1"), "repeats-twins")
    docs = once_each(docs, twins).withColumn("chunk", chunk_of)

    def bucket_of(hashes: np.ndarray) -> np.ndarray:
        return ((hashes >> np.uint64(32)) % np.uint64(buckets)).astype(np.int32)

    # The whole hash goes no further than to choose a bucket and, in it, a 32-bit number.
    def short(hashes: np.ndarray) -> np.ndarray:
        return (hashes & np.uint64(0xFFFFFFFF)).astype(np.uint32)

    def seeds(key: tuple, texts: pa.Table, dropped: pa.Table) -> pa.Table:
        number = key[0].as_py()
        chunk = Chunk(texts, gram, least)
        skipped = chunk.among(dropped)
        places = chunk.anchors()
        document = chunk.document(places)
        there = ~skipped[document]
        places, document = places[there], document[there]
        hashes = chunk.hashes(places)
        heads = collapsed(places, document, hashes)
        times = np.diff(np.append(heads, len(places)))
        hashes, rank = hashes[heads], chunk.ranks[document[heads]]
        # Places ascend with the ranks, and stable sorting keeps that.
        order = np.argsort(hashes, kind="stable")
        found, rank, times = hashes[order], rank[order], times[order]
        begins = np.flatnonzero(np.diff(found, prepend=~found[:1]))
        distinct = found[begins]
        lasts = np.append(begins[1:], len(found)) - 1
        several = rank[begins] != rank[lasts] if len(found) else np.zeros(0, bool)
        count = np.add.reduceat(times, begins) if len(found) else times
        rows = [(buckets + number, number, blob(steps(places), skipped))]
        for bucket, own in grouped_by_bucket(bucket_of(distinct)):
            values, heavy = short(distinct[own]), count[own] >= HEAVY
            more = several[own]
            parts = values[~more], values[more], values[heavy], count[own][heavy]
            rows.append((bucket, number, blob(*parts)))
        return rows_of(rows, ["bucket", "chunk"])

    def shared(key: tuple, table: pa.Table) -> pa.Table:
        bucket = key[0].as_py()
        if bucket >= buckets:
            return table.select(["chunk", "bucket", "bytes", "data"])
        sent = list(arrays_of(table))
        every = [a for _, _, one, more, *_ in sent for a in (one, more, more)]
        values, counts = np.unique(np.concatenate(every), return_counts=True)
        often = values[counts > 1]
        for _, _, _, _, heavy, count in sent:
            np.add.at(counts, np.searchsorted(values, heavy), count)
        frequent = values[counts >= FREQUENT]
        rows = []
        for _, number, one, more, *_ in sent:
            known = np.concatenate([one[found_in(one, often)], more])
            if len(known):
                rows.append((number, bucket, blob(known, known[found_in(known, frequent)])))
        return rows_of(rows, ["chunk", "bucket"])

    def distinct_contexts(chunk: Chunk, places: np.ndarray) -> tuple:
        """Contexts of the places, the first place of each distinct one, and which one each has."""
        parts = chunk.contexts(places)
        wide = np.concatenate([parts[0], parts[1], parts[2][:, None], parts[3][:, None]], axis=1)
        keys = np.ascontiguousarray(wide).view(f"V{wide.shape[1]}").ravel()
        # Places ascend with the ids, so the first of equal contexts is of the smallest document.
        _, first, which = np.unique(keys, return_index=True, return_inverse=True)
        by_place = np.argsort(first)
        number = np.empty(len(first), dtype=np.int64)
        number[by_place] = np.arange(len(first))
        return parts, first[by_place], number[which]

    def ask(key: tuple, texts: pa.Table, table: pa.Table) -> pa.Table:
        number = key[0].as_py()
        chunk = Chunk(texts, gram, least)
        wanted, often = ([np.zeros(0, np.uint64)] for _ in range(2))
        for _, bucket, *arrays in arrays_of(table):
            if bucket >= buckets:
                places, skipped = np.cumsum(arrays[0]), arrays[1]
            else:
                for values, to in zip(arrays, (wanted, often)):
                    to.append(values.astype(np.uint64) | np.uint64(bucket << 32))
        hashes = chunk.hashes(places)
        bucket = bucket_of(hashes)
        full = short(hashes).astype(np.uint64) | (bucket.astype(np.uint64) << np.uint64(32))
        frequent = found_in(full, np.sort(np.concatenate(often)))
        there = found_in(full, np.sort(np.concatenate(wanted))) & ~frequent
        crowded = places[frequent]
        places, bucket = places[there], bucket[there]
        rows = [(buckets + number, number, blob(steps(places), steps(crowded), skipped))]
        if len(crowded):
            _, _, one, other, rank = chunk.strings(crowded)
            for to, own in grouped_by_bucket(bucket_of(one)):
                rows.append((to, number, blob(one[own], other[own], rank[own], steps(own))))
        if len(places):
            (left, right, before, behind), first, _ = distinct_contexts(chunk, places)
            ranks = chunk.ranks[chunk.document(places)]
            for to, own in grouped_by_bucket(bucket[first]):
                at = first[own]
                parts = left[at], right[at], before[at], behind[at]
                rows.append((to, number, blob(*parts, steps(ranks[at]), steps(own))))
        return rows_of(rows, ["bucket", "chunk"])

    def answer(key: tuple, table: pa.Table) -> pa.Table:
        bucket = key[0].as_py()
        if bucket >= buckets:
            return table.select(["chunk", "bucket", "bytes", "data"])
        contexts, strings = [], []
        for _, number, *arrays in arrays_of(table):
            (strings if len(arrays) == 4 else contexts).append((number, arrays))
        rows, at = [], 0
        if strings:
            one, other, rank = (np.concatenate([a[i] for _, a in strings]) for i in range(3))
            order = np.lexsort((rank, other, one))
            heads = np.flatnonzero(
                np.append(True, np.diff(one[order]).astype(bool) | np.diff(other[order]).astype(bool))
            )
            smallest = np.repeat(rank[order][heads], np.diff(np.append(heads, len(order))))
            later = np.empty(len(order), dtype=bool)
            later[order] = rank[order] > smallest
            for number, arrays in strings:
                own = later[at : at + len(arrays[0])]
                at += len(own)
                if own.any():
                    rows.append((number, bucket, blob(steps(np.cumsum(arrays[3])[own]))))
        sent = [(number, *a[:4], *map(np.cumsum, a[4:])) for number, a in contexts]
        if not sent:
            return rows_of(rows, ["chunk", "bucket"])
        parts = [np.concatenate(p) for p in zip(*(s[1:6] for s in sent))]
        masks = repeated(*parts, gram, least)
        at = 0
        for number, *_, numbers in sent:
            own = masks[at : at + len(numbers)]
            at += len(own)
            hit = own > 0
            if hit.any():
                rows.append((number, bucket, blob(steps(numbers[hit]), own[hit])))
        return rows_of(rows, ["chunk", "bucket"])

    id_type = docs.schema["doc_id"].dataType.simpleString()
    span_type = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))

    def cut(texts: pa.Table, table: pa.Table) -> pa.Table:
        chunk = Chunk(texts, gram, least)
        sent, known = [], []
        for _, bucket, *arrays in arrays_of(table):
            if bucket >= buckets:
                places, crowded, skipped = np.cumsum(arrays[0]), np.cumsum(arrays[1]), arrays[2]
            elif len(arrays) == 1:
                known.append(np.cumsum(arrays[0]))
            else:
                sent.append(arrays)
        size = len(chunk.data)
        edges = np.zeros(size + 1, dtype=np.int32)
        if len(crowded):
            starts, which, one, _, rank = chunk.strings(crowded)
            elsewhere = np.zeros(len(one), dtype=bool)
            for numbers in known:
                elsewhere[numbers] = True
            hit = elsewhere[which] | (chunk.ranks[chunk.document(starts)] > rank[which])
            edges[starts[hit]] += 1
            edges[starts[hit] + least] -= 1
        if len(places):
            (_, _, before, behind), first, which = distinct_contexts(chunk, places)
            masks = np.zeros(len(first), dtype=np.uint64)
            for numbers, values in sent:
                masks[np.cumsum(numbers)] = values
            ranks = chunk.ranks[chunk.document(places)]
            own = masks[which]
            # The same context in a smaller document of this chunk: all strings repeat it.
            later = ranks > ranks[first][which]
            for o in range(least - gram + 1):
                fits = (before >= o) & (behind >= least - o)
                hit = fits & (later | (own >> np.uint64(o) & np.uint64(1) > 0))
                begins = np.unique(places[hit] - o)
                # A start may be found from several anchors; how often does not matter.
                edges[begins] += 1
                edges[begins + least] -= 1
        gone = np.cumsum(edges[:-1]) > 0
        for i in np.flatnonzero(skipped).tolist():
            if chunk.ends[i] - chunk.starts[i] >= least:
                gone[chunk.starts[i] : chunk.ends[i]] = True
        spans, remaining = [], []
        for a, b in zip(chunk.starts.tolist(), chunk.ends.tolist()):
            own = gone[a:b]
            if own.any():
                turns = np.flatnonzero(np.diff(own.astype(np.int8), prepend=0, append=0))
                spans.append(
                    [{"start": s, "end": e} for s, e in turns.reshape(-1, 2).tolist()]
                )
                remaining.append(chunk.data[a:b][~own].tobytes())
            else:
                spans.append([])
                remaining.append(chunk.data[a:b].tobytes())
        return pa.table(
            {
                "doc_id": texts.column("doc_id").take(pa.array(chunk.order)),
                "n": texts.column("n").take(pa.array(chunk.order)),
                "n_bytes": pa.array(chunk.ends - chunk.starts),
                "spans": pa.array(spans, span_type),
                "remaining": pa.array(remaining, pa.binary()),
            }
        )

    by_chunk = docs.groupBy("chunk")
    to_bucket = "bucket int, chunk int, bytes long, data binary"
    to_chunk = "chunk int, bucket int, bytes long, data binary"
    sent = by_chunk.cogroup(copies.groupBy("chunk")).applyInArrow(seeds, to_bucket)
    known = sent.groupBy("bucket").applyInArrow(shared, to_chunk)
    asked = by_chunk.cogroup(known.groupBy("chunk")).applyInArrow(ask, to_bucket)
    answers = asked.groupBy("bucket").applyInArrow(answer, to_chunk)
    found = by_chunk.cogroup(answers.groupBy("chunk")).applyInArrow(
        cut,
        f"doc_id {id_type}, n long, n_bytes long, spans array<struct<start:bigint,end:bigint>>, "
        "remaining binary",
    )
    # Two steps, so that no array grows with the number of equal rows alone.
    columns = ["doc_id", "n_bytes", "spans", "remaining"]
    steps_of = F.sequence(F.lit(0).cast("long"), F.col("n") - 1, F.lit(TIMES).cast("long"))
    found = found.select(*columns, "n", F.explode(steps_of).alias("from"))
    times = F.least(F.lit(TIMES), F.col("n") - F.col("from")).cast("int")
    return found.select(*columns, F.explode(F.array_repeat(F.lit(0), times)).alias("again")).drop("again")


def digest(found: DataFrame) -> DataFrame:
    return found.select(
        "doc_id",
        "n_bytes",
        (F.col("n_bytes") - F.length("remaining")).alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"),
        F.sha2("remaining", 256).alias("kept_sha256"),
    )
