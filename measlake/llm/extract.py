"""Main texts of web pages: what a host repeats from page to page goes, unique runs stay.

Method: a suffix array per host. A page is a stream of tokens, its tags and its
texts; the streams of a host's pages are joined, the suffixes sorted by their
first five tokens, and neighbours that agree in all five are one interval. An
interval with two distinct pages is a repeated string, and every text it covers is
boilerplate. Pages are distinct if their longest texts differ, so that copies of an article
do not make each other boilerplate.

A host may hold any share of the pages, so its array is not one group. Every task
sorts the suffixes of the pages it reads and hands on one row per interval: a key of
host and string with the smallest and largest page seen. Equal keys meet by
hash, and combine before they are shuffled; an interval of the whole host has two
pages exactly if its smallest and largest differ. Nothing else depends on which
pages a task has read.

What is repeated is then checked against the markup: texts in an article or main
element stay even if other pages have them, since passages are shared; menus,
headers, footers, sidebars, notices, adverts, forms, scripts, styles and reader
comments (by element, class, id or role) go even if they are unique. So only texts
that the markup does not place, on pages without an article, ask for their
intervals; the array itself is of all tokens. Where markup and repetition agree nothing is asked.

Blocks are the texts between tags of block level; a line break is white space.
Null html and pages without such text give an empty text. Pages without a host
in their url count as one host. Equal rows are each returned. Extra columns are
left out of the result. A page is held whole by a task; unclosed elements end with
their parent, unclosed comments and scripts with the page.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from measlake.llm.common import gathered, kept
from measlake.llm.markup import Page

# Tokens that a repeated string has at least.
LENGTH = 5
# Tasks start a new suffix array after so many bytes of html.
JOINED = 8 << 20
FACTORS = np.array(
    [[pow(base, k + 1, 1 << 64) for k in range(LENGTH)] for base in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)],
    dtype=np.uint64,
)


def windows(stream: list[int]) -> np.ndarray:
    """The first tokens of each suffix that has enough of them."""
    if len(stream) < LENGTH:
        return np.zeros((0, LENGTH), dtype=np.uint64)
    tokens = np.array(stream, dtype=np.uint64)
    return np.lib.stride_tricks.sliding_window_view(tokens, LENGTH)


def keys(strings: np.ndarray, hosts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two numbers for each host and string."""
    found = []
    for factors in FACTORS:
        mixed = ((strings ^ (strings >> np.uint64(29))) * factors).sum(axis=1, dtype=np.uint64)
        mixed = (mixed ^ (hosts * factors[0])) * factors[1]
        found.append((mixed ^ (mixed >> np.uint64(32))).view(np.int64))
    return found[0], found[1]


def intervals(pages: list[Page], hosts: list[int]) -> tuple[np.ndarray, ...]:
    """Two keys, smallest and largest page of each interval of the pages' suffix array."""
    parts = [windows(page.stream) for page in pages]
    counts = [len(part) for part in parts]
    strings = np.concatenate(parts)
    host = np.repeat(np.array(hosts, dtype=np.int64).view(np.uint64), counts)
    page = np.repeat(np.array([p.identity() for p in pages], dtype=np.uint64).view(np.int64), counts)
    columns = np.column_stack([host, strings])
    order = np.lexsort(columns.T[::-1])
    columns, page = columns[order], page[order]
    first = np.flatnonzero(np.append(True, (columns[1:] != columns[:-1]).any(axis=1)))
    if not len(columns):
        first = first[:0]
    low = np.minimum.reduceat(page, first) if len(first) else page
    high = np.maximum.reduceat(page, first) if len(first) else page
    return (*keys(columns[first, 1:], columns[first, 0]), low, high)


def repeated_strings(pages: DataFrame) -> DataFrame:
    """(a, b): keys of the strings that two distinct pages of a host have."""

    def sort(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, sources in gathered(batches, "html", JOINED):
            parsed = [Page(source.decode(errors="replace")) for source in sources]
            hosts = rows.column("host").to_pylist()
            found = intervals(parsed, hosts)
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in found], ["a", "b", "low", "high"])

    local = pages.select("host", "html").mapInArrow(sort, "a bigint, b bigint, low bigint, high bigint")
    merged = local.groupBy("a", "b").agg(F.min("low").alias("low"), F.max("high").alias("high"))
    return merged.where("low <> high").select("a", "b")


def covered_places(pages: DataFrame, repeated: DataFrame) -> DataFrame:
    """(row, row2, places): texts of a page that the markup does not place and a repeated string covers."""

    def ask(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, sources in gathered(batches, "html", JOINED):
            out: list[list[np.ndarray]] = []
            ids = [rows.column(name).to_numpy() for name in ("host", "row", "row2")]
            for i, source in enumerate(sources):
                page = Page(source.decode(errors="replace"))
                strings = windows(page.stream)
                places = np.array(page.unsure(), dtype=np.int64)
                at = (places[:, None] - np.arange(LENGTH)).ravel()
                place = np.repeat(places, LENGTH)
                there = (at >= 0) & (at < len(strings))
                at, place = at[there], place[there]
                host, row, row2 = (np.full(len(at), column[i], dtype=np.int64) for column in ids)
                out.append([*keys(strings[at], host.view(np.uint64)), row, row2, place])
            joined = [np.concatenate(column) for column in zip(*out)]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in joined], ["a", "b", "row", "row2", "place"])

    asked = pages.select("host", "html", "row", "row2").mapInArrow(
        ask, "a bigint, b bigint, row bigint, row2 bigint, place bigint"
    )
    # A page's own tokens bound its places.
    found = asked.join(repeated, ["a", "b"], "left_semi").groupBy("row", "row2")
    return found.agg(F.collect_set("place").alias("places"))


def main_texts(pages: DataFrame) -> DataFrame:
    """page_id, url and the page's main ``text``."""
    host = F.regexp_extract(F.coalesce("url", F.lit("")), r"^[A-Za-z][A-Za-z0-9+.\-]*://([^/?#]*)", 1)
    row = F.xxhash64("page_id", "url", "html")
    pages = pages.select(
        "page_id",
        "url",
        "html",
        F.xxhash64(F.lower(host)).alias("host"),
        row.alias("row"),
        F.xxhash64(F.lit(1), "html", "url", "page_id").alias("row2"),
    )
    repeated = kept(repeated_strings(pages), "extract-repeated")
    covered = kept(covered_places(pages, repeated), "extract-covered")
    joined = pages.drop("host").join(covered, ["row", "row2"], "left").select("page_id", "url", "html", "places")

    def write(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, sources in gathered(batches, "html"):
            places = rows.column("places").to_pylist()
            texts = [
                Page(source.decode(errors="replace")).kept(set(own or ())) for source, own in zip(sources, places)
            ]
            columns = [rows.column("page_id"), rows.column("url"), pa.array(texts, type=pa.string())]
            yield from pa.table(columns, names=["page_id", "url", "text"]).to_batches()

    kind = {f.name: f.dataType.simpleString() for f in joined.schema}
    return joined.mapInArrow(write, f"page_id {kind['page_id']}, url {kind['url']}, text string")


def digest(texts: DataFrame) -> DataFrame:
    return texts.withColumn("n_chars", F.length("text").cast("long"))
