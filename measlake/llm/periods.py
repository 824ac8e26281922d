"""Runs of words that repeat with a period, and texts without the repeats.

A run is a stretch of words with smallest period q (words q apart are equal) that
no neighbouring word extends, of at least four periods and six words.

Method: a suffix automaton of the words. Its states, linked to their longest
suffix in another class, form a tree; the path from a prefix's state to the root
holds all suffixes of that prefix. Appending word i accesses that path as a
link-cut tree does: the preferred-path segments on it, each of one last end
position j, are told and then recoloured with i. If strings of a segment are as
long as d = i - j, the last 2d words are a square, and d is its smallest period,
since a smaller one would have left a later colour. Squares are extended to runs
by comparing words d apart, once per run. The tree is complete before the first
access, so paths are split by size (heavy children) and each keeps its segments
as a stack, top of the path first: the same segments as with splay trees, and as
few (a logarithm of the length, amortised).

The automaton is built only over stretches that can hold a run: in a run each
three words in a row recur at least twice more, at distances of at most a quarter
of its length. Other words are never part of one, so nothing is lost.

Words are runs of bytes other than space and 0x09 to 0x0D. A null text has none:
no runs, empty collapsed text. Rows are independent: equal ids and copies are
judged each, null ids too. Extra columns are left out of the result. Memory grows with
one document's longest such stretch (some 600 bytes a word), never with the table.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from measlake.llm.common import gathered

PERIODS = 4
LEAST = 6
# A stretch that is still shrinking after so many passes is searched as it is.
PASSES = 8
RUNS = "array<struct<start: bigint, length: bigint, period: bigint>>"


def candidates(ids: np.ndarray) -> list[tuple[int, int]]:
    """Stretches [first, end) outside of which no word is part of a run."""
    found, todo = [], [(0, len(ids), 0)]
    while todo:
        first, end, passes = todo.pop()
        if end - first < LEAST:
            continue
        part = ids[first:end].astype(np.uint64)
        grams = part[:-2] * np.uint64(0x9E3779B97F4A7C15)
        grams ^= part[1:-1] * np.uint64(0xC2B2AE3D27D4EB4F)
        grams += part[2:] * np.uint64(0x165667B19E3779F9)
        order = np.argsort(grams, kind="stable")
        grams = grams[order]
        near = (grams[1:] == grams[:-1]) & (np.diff(order) <= (end - first) // PERIODS)
        thrice = np.flatnonzero(near[1:] & near[:-1])
        if not len(thrice):
            continue
        inside = np.zeros(end - first + 2, dtype=bool)
        for place in (order[thrice], order[thrice + 1], order[thrice + 2]):
            for step in range(3):
                inside[place + step + 1] = True
        edges = np.flatnonzero(inside[1:] != inside[:-1])
        parts = [(first + int(a), first + int(b)) for a, b in zip(edges[::2], edges[1::2])]
        if parts == [(first, end)] or passes == PASSES:
            found += [part for part in parts if part[1] - part[0] >= LEAST]
        else:
            todo += [(a, b, passes + 1) for a, b in parts]
    return sorted(found)


def automaton(words: list[int]) -> tuple[list[int], list[int], list[int]]:
    """Suffix automaton: link and longest string of each state, and each prefix's state."""
    steps: list[dict[int, int]] = [{}]
    links, sizes, prefixes = [-1], [0], []
    last = 0
    for word in words:
        state = len(links)
        steps.append({})
        sizes.append(sizes[last] + 1)
        links.append(0)
        at = last
        while at >= 0 and word not in steps[at]:
            steps[at][word] = state
            at = links[at]
        if at >= 0:
            to = steps[at][word]
            if sizes[to] != sizes[at] + 1:
                clone = len(links)
                steps.append(steps[to].copy())
                sizes.append(sizes[at] + 1)
                links.append(links[to])
                links[to] = clone
                while at >= 0 and steps[at].get(word) == to:
                    steps[at][word] = clone
                    at = links[at]
                to = clone
            links[state] = to
        prefixes.append(state)
        last = state
    return links, sizes, prefixes


def path_heads(links: list[int], sizes: list[int]) -> list[int]:
    """The state nearest to the root on each state's path; paths follow the larger subtree."""
    order = np.argsort(np.array(sizes), kind="stable").tolist()
    below, heavy = [1] * len(links), [-1] * len(links)
    largest = [0] * len(links)
    for state in reversed(order[1:]):
        parent = links[state]
        below[parent] += below[state]
        if below[state] > largest[parent]:
            largest[parent], heavy[parent] = below[state], state
    heads = list(range(len(links)))
    for state in order[1:]:
        if heavy[links[state]] == state:
            heads[state] = heads[links[state]]
    return heads


def squares(words: list[int]) -> Iterator[tuple[int, int]]:
    """(last word, period) of squares; every run of two periods has one."""
    links, sizes, prefixes = automaton(words)
    heads = path_heads(links, sizes)
    segments: dict[int, list[tuple[int, int]]] = {}
    for i, state in enumerate(prefixes):
        while state > 0:
            head, length = heads[state], sizes[state]
            stack = segments.setdefault(head, [])
            told = 0
            while stack and told < length:
                deepest, end = stack[-1]
                told = min(deepest, length)
                if told >= i - end:
                    yield i, i - end
                if deepest <= length:
                    stack.pop()
            stack.append((length, i))
            state = links[head]


def agreeing(one: np.ndarray, other: np.ndarray) -> int:
    """How many first words agree."""
    done, step = 0, 64
    while done < len(one):
        differ = np.flatnonzero(one[done : done + step] != other[done : done + step])
        if len(differ):
            return done + int(differ[0])
        done, step = done + step, step * 2
    return len(one)


def find(ids: np.ndarray) -> list[tuple[int, int, int]]:
    """(start, length, period) of all runs, by start and period."""
    found = []
    for first, end in candidates(ids):
        part = ids[first:end]
        reached: dict[int, int] = {}
        for i, period in squares(part.tolist()):
            if period * PERIODS > len(part) or reached.get(period, -1) >= i:
                continue
            middle = i + 1 - period
            ahead = agreeing(part[middle : len(part) - period], part[middle + period :])
            behind = agreeing(part[:middle][::-1], part[period : middle + period][::-1])
            reached[period] = i + ahead
            length = behind + period + ahead
            if length >= max(LEAST, PERIODS * period):
                found.append((first + middle - behind, length, period))
    return sorted(found, key=lambda run: (run[0], run[2]))


def of_text(text: bytes) -> tuple[list[tuple[int, int, int]], bytes]:
    """The runs of a text, and its words without those a run repeats, one space between."""
    words = text.split()
    first_of: dict[bytes, int] = {}
    ids = np.fromiter(map(first_of.setdefault, words, count()), dtype=np.int64, count=len(words))
    runs = find(ids)
    if runs:
        repeated = np.zeros(len(words) + 1, dtype=np.int64)
        for start, length, period in runs:
            repeated[start + period] += 1
            repeated[start + length] -= 1
        kept = np.flatnonzero(np.cumsum(repeated[:-1]) == 0).tolist()
        words = [words[i] for i in kept]
    return runs, b" ".join(words)


def find_runs(docs: DataFrame) -> DataFrame:
    """doc_id, ``runs`` by start and period, and ``collapsed``, the text without repeats."""
    docs = docs.select("doc_id", "text")
    kind = pa.list_(pa.struct([(name, pa.int64()) for name in ("start", "length", "period")]))

    def search(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, texts in gathered(batches):
            runs, collapsed = zip(*map(of_text, texts))
            named = [[dict(zip(("start", "length", "period"), run)) for run in one] for one in runs]
            yield from pa.table(
                {
                    "doc_id": rows.column("doc_id"),
                    "runs": pa.array(named, type=kind),
                    "collapsed": pa.array(collapsed, type=pa.binary()).cast(pa.string()),
                }
            ).to_batches()

    id_type = docs.schema["doc_id"].dataType.simpleString()
    return docs.mapInArrow(search, f"doc_id {id_type}, runs {RUNS}, collapsed string")


def with_repeats(docs: DataFrame) -> DataFrame:
    """The documents with periods put into the words of a tenth of them, chosen by their id.

    Rows without an id stay as they are.
    """
    chosen = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    words = F.array_remove(F.split("text", r"[\x20\x09-\x0D]+"), "")
    rows = docs.select("doc_id", "text", chosen.alias("h"), F.floor(chosen / 10).alias("g"))
    drawn = rows.where("h % 10 = 0").withColumn("words", words)
    sized = drawn.withColumn("n", F.size("words").cast("long")).where("n > 0")
    first = sized.withColumn("a", F.expr("g % n"))
    spaced = first.withColumn("p", F.expr("1 + (n - a) DIV (3 + g % 8)"))

    def word(i: Column) -> Column:
        repeated = F.col("a") + (i - F.col("a")) % F.col("p")
        return F.get("words", F.when(i >= F.col("a"), repeated).otherwise(i).cast("int"))

    places = F.sequence(F.lit(0).cast("long"), F.col("n") - 1)
    changed = spaced.select("doc_id", F.array_join(F.transform(places, word), " ").alias("text"))
    blank = drawn.where(F.coalesce(F.size("words"), F.lit(0)) <= 0).select("doc_id", "text")
    others = rows.where("h IS NULL OR h % 10 <> 0").select("doc_id", "text")
    return others.union(blank).union(changed)


def digest(found: DataFrame) -> DataFrame:
    """Number of runs, the longest one, and digests of runs and collapsed text."""
    longest = F.array_max(
        F.transform("runs", lambda r: F.struct(r["length"], -r["start"], -r["period"]))
    )
    line = lambda r: F.concat_ws(",", r["start"], r["length"], r["period"])
    lines = F.array_join(F.transform("runs", lambda r: F.concat(line(r), F.lit("\n"))), "")
    best = found.withColumn("best", longest).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        (-F.col("best.col2")).alias("start"),
        F.col("best.length").alias("length"),
        (-F.col("best.col3")).alias("period"),
        F.sha2(lines, 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
    return best.withColumn("exponent_milli", F.expr("1000 * length DIV period"))
