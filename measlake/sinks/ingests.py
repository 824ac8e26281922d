"""Ingests that are seen whole or not at all (K1-K6).

``write_batch`` appends table by table: a run that stops between tables leaves
runs without fits, and doing it again doubles rows. Here every attempt writes its
tables to folders of its own; what counts is the list of ingests, one entry each,
written last. Readers take the tables of a list they hold, so that an ingest which is
added meanwhile does not show. A stopped attempt is in no list, and an ingest that is
in the list is not written again.

An entry has a row per table with path, number of rows and a digest of the rows,
taken from what was written. The list has a few rows per ingest, and paths are
given to Spark as folders are listed anyway. Folders of stopped attempts stay
until ``stopped_attempts`` are removed by who owns the lake.
"""

from __future__ import annotations

import posixpath
import uuid
from urllib.parse import quote

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..plans.batch import Batch
from ..schemas import ALIASES, TABLES
from .tables import keep_parents, read_folders, write_table

LISTED = "ingest_id string, table string, path string, rows bigint, digest decimal(38,0)"
ENTRIES, DATA = "ingests", "data"


def entries(spark: SparkSession, base: str) -> DataFrame:
    """Tables of all ingests; those of stopped attempts are not among them."""
    try:
        found = spark.read.schema(LISTED).parquet(f"{base.rstrip('/')}/{ENTRIES}/*")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        found = spark.createDataFrame([], LISTED)
    return found


def table_base(base: str, table: str) -> str:
    return posixpath.join(base.rstrip("/"), DATA, ALIASES.get(table, table))


class Snapshot:
    """The ingests of a lake at the time this was made."""

    def __init__(self, spark: SparkSession, base: str) -> None:
        self.spark, self.base = spark, base
        self.tables: dict[str, dict[str, str]] = {}
        for row in entries(spark, base).select("ingest_id", "table", "path").collect():
            self.tables.setdefault(row.ingest_id, {})[row.table] = row.path

    def paths(self, table: str) -> list[str]:
        name = ALIASES.get(table, table)
        return sorted(own[name] for own in self.tables.values() if name in own)

    def read(self, table: str, years: list[int] | None = None) -> DataFrame:
        """A table over all ingests."""
        return read_folders(self.spark, table_base(self.base, table), self.paths(table), table, years)

    def report(self, table: str, schema: str) -> DataFrame:
        """Issues, outcomes or errors over all ingests."""
        paths = self.paths(table)
        if not paths:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*paths)


def written(spark: SparkSession, table: str, path: str) -> DataFrame:
    """Rows of one folder. A laid out table without rows has no file to tell its schema."""
    return read_folders(spark, path, [path], table) if table in TABLES else spark.read.parquet(path)


def described(rows: DataFrame) -> DataFrame:
    """Number of rows and a digest that does not depend on their order."""
    row = F.xxhash64(F.to_json(F.struct("*"))).cast("decimal(38,0)")
    return rows.agg(F.count(F.lit(1)).alias("rows"), F.coalesce(F.sum(row), F.lit(0)).alias("digest"))


def write_ingest(batch: Batch, base: str, ingest_id: str, **options) -> dict[str, str]:
    """Write a batch as one ingest; its folders by table. Nothing is done if it is there already."""
    spark = batch.reflectivity.sparkSession
    there = Snapshot(spark, base).tables.get(ingest_id)
    if there is not None:
        return there
    name = quote(ingest_id, safe="")
    attempt = f"ingest={name}/attempt={uuid.uuid4().hex}"
    done = keep_parents(spark, batch)
    paths = {}
    for table, df in done.tables().items():
        path = f"{table_base(base, table)}/{attempt}"
        paths[ALIASES.get(table, table)] = write_table(df, base, table, mode="error", path=path, **options)
    for table, df in done.reports().items():
        paths[table] = f"{table_base(base, table)}/{attempt}"
        df.write.parquet(paths[table])
    found = []
    for table, path in paths.items():
        rows, digest = described(written(spark, table, path)).first()
        found.append((ingest_id, table, path, rows, digest))
    # The folder is new, or somebody else was first; then this attempt counts for nothing.
    entry = posixpath.join(base.rstrip("/"), ENTRIES, name)
    spark.createDataFrame(found, LISTED).coalesce(1).write.mode("error").parquet(entry)
    return paths


def changed_tables(spark: SparkSession, base: str) -> DataFrame:
    """Listed tables whose rows are no longer those of the entry."""
    listed = entries(spark, base)
    now = []
    for row in listed.select("ingest_id", "table", "path").collect():
        same = described(written(spark, row.table, row.path))
        now.append(same.select(F.lit(row.path).alias("path"), F.struct("rows", "digest").alias("now")))
    if not now:
        return listed
    found = now[0]
    for one in now[1:]:
        found = found.union(one)
    return listed.join(found, "path").filter(F.struct("rows", "digest") != F.col("now")).select(*listed.columns)


def stopped_attempts(spark: SparkSession, base: str, files: DataFrame) -> DataFrame:
    """Folders of attempts that no entry names, from a ``files.catalog`` of the lake."""
    folder = rf"{DATA}/[^/]+/ingest=[^/]+/attempt=[^/]+"
    attempt = F.regexp_extract("path", f"^(.*/{folder})/", 1)
    written = files.select(attempt.alias("attempt")).filter("attempt <> ''").distinct()
    # Entries may carry a scheme that the catalog leaves out.
    named = entries(spark, base).select(F.regexp_extract("path", f"({folder})$", 1).alias("own")).distinct()
    own = F.regexp_extract("attempt", f"({folder})$", 1)
    return written.join(named, own == F.col("own"), "left_anti")
