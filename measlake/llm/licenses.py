"""License notices in texts, found by MinHash bands over overlapping windows.

Words are runs of letters and digits, lowered; a shingle is five words, or all
words of a notice that has fewer. A document holds a notice if a run of its
shingles, a quarter longer than the notice, contains at least ``SHARE`` of the
notice's shingles, and, word for word, each of the phrases that the notice has in
double braces: versions, and what else tells licenses apart. Notices of up to
eight words are so found word for word, or nearly.

Every run lies in a window of two steps, a step being the next power of two;
windows overlap by one step. A window's MinHash values are compared with the
notice's, a band being one value. A window that holds the notice has at least a
known similarity to it, and there are as many bands as make the chance that all
differ at most ``MISS``. Windows that agree in some band are verified by exact
containment.

All runs of a notice that do not overlap are told, best first, then first; the
digest counts a notice once per text, with its first best run, and counts all
runs apart. Null and empty texts hold no notice. Repeated rows give repeated
results. Null ids are passed on. Other columns are not read.
"""

from __future__ import annotations

import math
import re
import string
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from importlib import resources

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from measlake.llm.common import gathered
from measlake.llm.words import SLICE, Words, kinds_of

SHINGLE = 5
SHARE = 0.8
MISS = 1e-6
SEED = 5
LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
KINDS = kinds_of(string.ascii_lowercase + string.digits)
WORD = re.compile(rb"[a-z0-9\x80-\xff]+")

MARK = re.compile(r"\{\{(.*?)\}\}", re.DOTALL)


def shipped() -> dict[str, str]:
    """Notices by name, as their licenses word them: the texts in the folder ``notices``."""
    texts = {}
    for file in sorted(resources.files("measlake.llm").joinpath("notices").iterdir(), key=lambda f: f.name):
        if file.name == "short.txt":
            for part in file.read_text(encoding="utf-8").split("\n== ")[1:]:
                name, text = part.split("\n", 1)
                texts[name.strip()] = text.strip()
        elif file.name.endswith(".txt"):
            texts[file.name.removesuffix(".txt")] = file.read_text(encoding="utf-8")
    return texts


NOTICES = shipped()


@dataclass(frozen=True)
class Template:
    """A notice: its shingles as words, how many shingles a run of it has, and its phrases."""

    name: str
    width: int
    shingles: frozenset[tuple[bytes, ...]]
    run: int
    least: int
    phrases: tuple[tuple[bytes, ...], ...] = ()


def words_of(text: str) -> list[bytes]:
    return WORD.findall(text.encode().translate(LOWER))


def template(name: str, text: str) -> Template:
    words = words_of(text)
    phrases = tuple(dict.fromkeys(tuple(words_of(m)) for m in MARK.findall(text)))
    width = min(SHINGLE, len(words))
    count = len(words) - width + 1
    shingles = frozenset(tuple(words[i : i + width]) for i in range(count))
    least = math.ceil(SHARE * len(shingles))
    return Template(name, width, shingles, count + count // 4, least, phrases)


def shingled(hashes: np.ndarray, firsts: np.ndarray, width: int) -> np.ndarray:
    """A 32-bit number per word for the shingle it begins; 0 where it would leave its text."""
    total = np.zeros(len(hashes), dtype=np.uint64)
    for i in range(width):
        total[: len(hashes) - i] = total[: len(hashes) - i] * np.uint64(0xD6E8FEB86659FD93) + (
            hashes[i:]
        )
    total = (total ^ (total >> np.uint64(29))) * np.uint64(0x9E3779B97F4A7C15)
    out = (total >> np.uint64(32)).astype(np.uint32) | np.uint32(1)
    for i in range(width - 1):
        ends = firsts[1:] - 1 - i
        out[ends[ends >= firsts[:-1]]] = 0
    return out


def permuted(values: np.ndarray, factor: np.uint32, shift: np.uint32) -> np.ndarray:
    """One of the MinHash orders of 32-bit numbers; missing ones (0) come last."""
    mixed = (values ^ shift) * factor
    mixed ^= mixed >> np.uint32(15)
    mixed *= np.uint32(0x85EBCA6B)
    mixed[values == 0] = 0xFFFFFFFF
    return mixed


class Scanner:
    """Finds the notices in many texts at once."""

    def __init__(self, notices: dict[str, str]) -> None:
        self.templates = [template(name, text) for name, text in notices.items()]
        self.words = Words(KINDS)
        random = np.random.default_rng(SEED)
        # Notices of one shingle width and step share their windows, and all of a width its orders.
        self.classes: dict[tuple[int, int], list[int]] = {}
        for i, t in enumerate(self.templates):
            step = 1 << (t.run - 1).bit_length()
            self.classes.setdefault((t.width, step), []).append(i)
        self.counts: dict[tuple[int, int], int] = {}
        for (width, step), own in self.classes.items():
            window = 2 * step if step > 1 else 1
            like = min(
                t.least / (window + len(t.shingles) - t.least)
                for t in (self.templates[i] for i in own)
            )
            count = 1 if like >= 1 else math.ceil(math.log(MISS) / math.log(1 - like))
            self.counts[width, step] = count
        self.orders: dict[int, list[tuple[np.uint32, np.uint32]]] = {}
        for width in sorted({width for width, _ in self.classes}):
            count = max(c for (w, _), c in self.counts.items() if w == width)
            self.orders[width] = [
                (np.uint32(a | 1), np.uint32(b))
                for a, b in random.integers(0, 2**32, (count, 2), dtype=np.uint32).tolist()
            ]
        self.values = {}
        for (width, step), own in self.classes.items():
            orders = self.orders[width][: self.counts[width, step]]
            values = []
            for i in own:
                texts = [b" ".join(s) for s in self.templates[i].shingles]
                hashes, firsts = self.words(texts)
                shingles = shingled(hashes, firsts, width)
                values.append([permuted(shingles, *o).min() for o in orders])
            self.values[width, step] = np.array(values)

    def candidates(self, shingles: np.ndarray, width: int) -> dict[int, np.ndarray]:
        """By step: which windows (rows) agree with which notices (columns) in some band."""
        steps = sorted(step for w, step in self.classes if w == width)
        agree = {
            step: np.zeros((-(-len(shingles) // step), len(self.classes[width, step])), dtype=bool)
            for step in steps
        }
        for j, order in enumerate(self.orders[width]):
            least, size = permuted(shingles, *order), 1
            for step in steps:
                while size < step:
                    if len(least) % 2:
                        least = np.append(least, np.uint32(0xFFFFFFFF))
                    least, size = np.minimum(least[::2], least[1::2]), 2 * size
                if j >= self.counts[width, step]:
                    continue
                windows = least
                if step > 1:
                    windows = least.copy()
                    windows[:-1] = np.minimum(least[:-1], least[1:])
                for i, value in enumerate(self.values[width, step][:, j]):
                    agree[step][:, i] |= windows == value
        return agree

    def __call__(self, texts: list[bytes]) -> list[list[tuple[int, int, int, float]]]:
        """Per text: notice, first word and end of each run's matches, share contained.

        In the order of the notices, and for each the best first.
        """
        texts = [t.translate(LOWER) for t in texts]
        hashes, firsts = self.words(texts)
        # Where in a text a notice may be: pieces of (first, end) words, by text and notice.
        places: dict[tuple[int, int], list[tuple[int, int]]] = {}
        if not len(hashes):
            return [[] for _ in texts]
        for width in self.orders:
            shingles = shingled(hashes, firsts, width)
            for step, agree in self.candidates(shingles, width).items():
                own = self.classes[width, step]
                for row, column in np.argwhere(agree).tolist():
                    low = row * step
                    high = min((row + 2) * step if step > 1 else row + 1, len(hashes))
                    # The window may hold the end of one text and the begin of others.
                    first = int(np.searchsorted(firsts, low, side="right")) - 1
                    last = int(np.searchsorted(firsts, high - 1, side="right")) - 1
                    for text in range(first, last + 1):
                        begin, end = int(firsts[text]), int(firsts[text + 1])
                        piece = (max(low, begin) - begin, min(high, end) - begin)
                        if piece[1] - piece[0] >= self.templates[own[column]].least:
                            places.setdefault((text, own[column]), []).append(piece)
        found: list[list[tuple[int, int, int, float]]] = [[] for _ in texts]
        text, words = -1, []
        for (place, notice), pieces in sorted(places.items()):
            if place != text:
                text, words = place, WORD.findall(texts[place])
            t = self.templates[notice]
            own = [r for low, high in joined(pieces) for r in runs(t, words, low, high)]
            own.sort(key=lambda r: (-r[2], r[0]))
            found[text] += [(notice, *r) for r in own]
        return found


def joined(pieces: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Pieces in order, overlapping and adjoining ones as one."""
    out: list[tuple[int, int]] = []
    for low, high in sorted(pieces):
        if out and low <= out[-1][1]:
            out[-1] = (out[-1][0], max(high, out[-1][1]))
        else:
            out.append((low, high))
    return out


def starts_of(phrase: tuple[bytes, ...], words: list[bytes], low: int, high: int) -> list[int]:
    """Places from ``low`` to ``high`` where the phrase stands in the words."""
    size = len(phrase)
    return [
        i for i in range(low, min(high, len(words)) - size + 1) if tuple(words[i : i + size]) == phrase
    ]


def counted(t: Template, own: list[tuple[bytes, ...]], at: list[int]) -> Iterator[tuple[int, int]]:
    """For each place in ``at``: how many of the notice's shingles the run from there has."""
    seen: Counter = Counter()
    last = 0
    for n, i in enumerate(at):
        while last < len(at) and at[last] < i + t.run:
            seen[own[at[last]]] += 1
            last += 1
        yield len(seen), n
        seen[own[i]] -= 1
        if not seen[own[i]]:
            del seen[own[i]]


def runs(
    t: Template, words: list[bytes], low: int, high: int
) -> list[tuple[int, int, float]]:
    """Runs among the shingles that begin from ``low`` to ``high``, without overlap, best first.

    Each with its first matching word, the end of the last that adds to its share,
    and the share of the notice's shingles it has; only those with a share that is
    large enough, and with all phrases.
    """
    high = min(high, len(words) - t.width + 1)
    own = [tuple(words[i : i + t.width]) for i in range(low, max(low, high))]
    at = [i for i, s in enumerate(own) if s in t.shingles]
    if len(at) < t.least:
        return []
    phrases = [(len(p), starts_of(p, words, low, high + t.run + t.width)) for p in t.phrases]
    enough = sorted((-count, n) for count, n in counted(t, own, at) if count >= t.least)
    # Ends of the runs taken, by their starts; none overlap.
    begins: list[int] = []
    ends: list[int] = []
    out = []
    for count, n in enough:
        first, end = low + at[n], low + at[n] + t.run + t.width - 1
        place = bisect_left(begins, first + 1)
        if place and ends[place - 1] > first:
            continue
        places = ((size, found, bisect_left(found, first)) for size, found in phrases)
        if not all(p < len(found) and found[p] + size <= end for size, found, p in places):
            continue
        seen, last = set(), n
        while len(seen) < -count:
            seen.add(own[at[last]])
            last += 1
        end = low + at[last - 1] + t.width
        if place < len(begins) and begins[place] < end:
            continue
        begins.insert(place, first)
        ends.insert(place, end)
        out.append((first, end, -count / len(t.shingles)))
    return out


def contained(t: Template, words: list[bytes], low: int, high: int) -> tuple | None:
    """First best run among the shingles that begin from ``low`` to ``high``, if there is one."""
    found = runs(t, words, low, high)
    return found[0] if found else None


def find_licenses(docs: DataFrame, notices: dict[str, str] = NOTICES) -> DataFrame:
    """Each document's id and its ``licenses``: name, first word, end (exclusive), share.

    One for each run of a notice; in the order of the notices, and the best first.
    ``notices`` are texts by name, with phrases that must be there in double braces.
    """
    names = list(notices)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(notices)
        for rows, texts in gathered(batches, target=SLICE):
            found = [
                [{"name": names[i], "start": a, "end": b, "share": s} for i, a, b, s in spans]
                for spans in scanner(texts)
            ]
            kind = pa.struct(
                [
                    ("name", pa.string()),
                    ("start", pa.int64()),
                    ("end", pa.int64()),
                    ("share", pa.float64()),
                ]
            )
            ids = rows.column("doc_id").combine_chunks()
            yield pa.RecordBatch.from_arrays(
                [ids, pa.array(found, pa.list_(kind))], names=["doc_id", "licenses"]
            )

    schema = f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, " + (
        "licenses array<struct<name:string,start:bigint,end:bigint,share:double>>"
    )
    return docs.select("doc_id", "text").mapInArrow(scan, schema)


def digest(found: DataFrame) -> DataFrame:
    """Number of notices per document, the best run of each as text, and number of all runs."""
    # The first of a name is its best run.
    best = F.filter(
        "licenses",
        lambda x, i: (i == 0) | (F.get("licenses", i - 1)["name"] != x["name"]),
    )
    joined = F.array_join(
        F.transform(
            "best",
            lambda x: F.concat_ws(
                ":",
                x["name"],
                x["start"].cast("string"),
                x["end"].cast("string"),
                F.format_number(x["share"], 3),
            ),
        ),
        ",",
    )
    return found.select("doc_id", best.alias("best"), F.size("licenses").alias("n_runs")).select(
        "doc_id",
        F.size("best").cast("long").alias("n_licenses"),
        joined.alias("licenses"),
        F.col("n_runs").cast("long").alias("n_runs"),
    )
