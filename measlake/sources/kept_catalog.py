"""A catalog of files that is kept, so that a new listing reads only what changed.

``files.catalog`` lists and ``files.with_texts`` reads everything each time. Here a
listing goes level by level: the folders of a level are listed in tasks, one call
each, so neither files nor folders pass the driver. It is joined with the stored
catalog by path: a file is ``added``, ``changed`` (other length or time), ``same`` or ``gone``.
Texts are read of added and changed files only; what is known of the others comes from
the stored catalog. A version is a table of its own, complete or not there, and holds
the rows of gone files once, so that it tells what changed.

Hidden names (a leading dot, or a leading underscore without ``=``) are not listed, as
Spark does not; empty files are, unlike there. A file that disappears between
listing and reading is left out. Of two search paths with one file the earlier counts.
A file that is written anew with the same length within the clock of the file
system is not seen as changed.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import names
from ..operators.rows import once
from ..session import scratch_path
from ..sinks.named_files import store_of

LISTED = "path string, length bigint, modified timestamp, root_ord int"
ADDED, CHANGED, SAME, GONE = "added", "changed", "same", "gone"
_FACTS = ("length", "modified", "root_ord")
_ENTRIES = f"{LISTED}, folder boolean"


def hidden(name: str) -> bool:
    return name.startswith(".") or (name.startswith("_") and "=" not in name)


def _entries(folders: DataFrame, may_be_gone: bool) -> DataFrame:
    """What lies in each of the folders."""
    kinds = [pa.string(), pa.int64(), pa.timestamp("us", "UTC"), pa.int32(), pa.bool_()]
    titles = [part.split()[0] for part in _ENTRIES.split(", ")]

    def listing(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                store, base = store_of(row["path"])
                rows = [
                    (
                        f"{row['path'].rstrip('/')}/{info.base_name}",
                        info.size,
                        info.mtime,
                        row["root_ord"],
                        info.type == fs.FileType.Directory,
                    )
                    for info in store.get_file_info(fs.FileSelector(base, allow_not_found=may_be_gone))
                    if not hidden(info.base_name)
                ]
                columns = list(zip(*rows)) or [()] * len(kinds)
                arrays = [pa.array(c, kind) for c, kind in zip(columns, kinds)]
                yield pa.RecordBatch.from_arrays(arrays, names=titles)

    tasks = max(folders.sparkSession.sparkContext.defaultParallelism, 1)
    return folders.select("path", "root_ord").repartition(tasks, "path").mapInArrow(listing, _ENTRIES)


def _kept(df: DataFrame, name: str) -> DataFrame:
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def list_files(spark: SparkSession, roots: list[str]) -> DataFrame:
    """Every file below the search paths; one job per level of folders."""
    folders = spark.createDataFrame(list(zip(roots, range(len(roots)))), "path string, root_ord int")
    found = spark.createDataFrame([], LISTED)
    below = False
    while not folders.isEmpty():
        level = _kept(_entries(folders, may_be_gone=below), "listing")
        found = found.unionByName(level.filter("NOT folder").drop("folder"))
        folders, below = level.filter("folder"), True
    latest = F.max(F.struct("modified", "length"))
    return found.groupBy("path").agg(
        latest["length"].alias("length"),
        latest["modified"].alias("modified"),
        F.min("root_ord").alias("root_ord"),
    )


def changes(stored: DataFrame, listed: DataFrame) -> DataFrame:
    """Files of both with their ``state``; facts of the listing, else the stored ones.

    Further columns of ``stored`` are kept where the file is the same or gone, and null elsewhere.
    """
    further = [c for c in stored.columns if c not in ("path", "state", *_FACTS)]
    old = stored.select("path", F.struct(*_FACTS, *further).alias("old"))
    new = listed.select("path", F.struct(*_FACTS).alias("new"))
    before, now = F.col("old"), F.col("new")
    alike = before["length"].eqNullSafe(now["length"]) & before["modified"].eqNullSafe(now["modified"])
    state = (
        F.when(before.isNull(), ADDED).when(now.isNull(), GONE).when(alike, SAME).otherwise(CHANGED)
    )
    known = F.col("state").isin(SAME, GONE)
    return (
        old.join(new, "path", "full_outer")
        .withColumn("state", state)
        .select(
            "path",
            "state",
            *[F.when(now.isNull(), before[c]).otherwise(now[c]).alias(c) for c in _FACTS],
            *[F.when(known, before[c]).alias(c) for c in further],
        )
    )


def with_texts(files: DataFrame) -> DataFrame:
    """Files with their whole ``content``, read in tasks, one file in memory at a time."""

    def reading(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for n, path in enumerate(batch.column("path").to_pylist()):
                store, name = store_of(path)
                try:
                    with store.open_input_stream(name, compression=None) as stream:
                        text = stream.read().decode(errors="replace")
                except FileNotFoundError:
                    continue
                yield batch.slice(n, 1).append_column("content", pa.array([text], pa.string()))

    schema = files.withColumn("content", F.lit("")).schema
    return files.mapInArrow(reading, schema)


def identified(fresh: DataFrame) -> DataFrame:
    """New and changed files with kind, run, proposal and instrument; texts where these depend on them."""
    by_text = F.lower(names.suffix(F.col("path"))).isin(".json", ".txt")
    nothing = F.lit(None).cast("string").alias("content")
    texts = with_texts(fresh.filter(by_text)).unionByName(fresh.filter(~by_text).select("*", nothing))
    info = names.identify(F.col("path"), F.col("content"))
    return once(texts, info, "file_type", "run_number", "proposal", "instrument").drop("content")


def refreshed(stored: DataFrame | None, listed: DataFrame) -> DataFrame:
    """The catalog after a new listing: every file once, with its state; gone files are in it, too."""
    if stored is None:
        stored = listed.limit(0)
    delta = changes(stored.filter(F.col("state") != GONE) if "state" in stored.columns else stored, listed)
    delta = _kept(delta, "catalog-changes")
    fresh = F.col("state").isin(ADDED, CHANGED)
    found = identified(delta.filter(fresh).select("path", "state", *_FACTS))
    return found.unionByName(delta.filter(~fresh), allowMissingColumns=True).select(found.columns)


def versions(base: str) -> list[int]:
    """Complete versions of a kept catalog, a few entries."""
    store, folder = store_of(base)
    found = store.get_file_info(fs.FileSelector(folder, allow_not_found=True))
    numbers = [int(f.base_name.split("=")[1]) for f in found if f.base_name.startswith("version=")]
    done = [store.get_file_info(f"{folder}/version={n}/_SUCCESS").type for n in numbers]
    return sorted(n for n, kind in zip(numbers, done) if kind == fs.FileType.File)


def read_version(spark: SparkSession, base: str, number: int) -> DataFrame:
    """A version with the rows of files that had gone."""
    return spark.read.parquet(f"{base.rstrip('/')}/version={number}")


def read(spark: SparkSession, base: str) -> DataFrame:
    """Files of the last version."""
    return read_version(spark, base, versions(base)[-1]).filter(F.col("state") != GONE)


def refresh(spark: SparkSession, roots: list[str], base: str) -> DataFrame:
    """List the search paths, write the next version of the catalog below ``base``, and read it.

    A version that was begun and not ended keeps its number; the next one gets a later one. Of
    two that refresh at once the second fails, as its folder is there.
    """
    done = versions(base)
    stored = read_version(spark, base, done[-1]) if done else None
    store, folder = store_of(base)
    there = store.get_file_info(fs.FileSelector(folder, allow_not_found=True))
    begun = [int(f.base_name.split("=")[1]) for f in there if f.base_name.startswith("version=")]
    number = max(begun, default=0) + 1
    found = refreshed(stored, list_files(spark, roots))
    found.write.mode("error").parquet(f"{base.rstrip('/')}/version={number}")
    return read_version(spark, base, number)
