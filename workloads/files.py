"""File names, file sets and manifests."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from measlake.functions import names
from measlake.operators import fileset
from measlake.plans import discovery
from measlake.session import scratch_path
from measlake.sinks.named_files import write_named
from measlake.sources import files, manifest
from measlake.sources import kept_catalog as kept_files

from .base import composed, load, query, text

_NAMES_SQL = """
SELECT page_id,
  CASE page_id % 5 WHEN 0 THEN 100000 + page_id WHEN 1 THEN 200000 + page_id WHEN 2 THEN 30000 + page_id
    WHEN 3 THEN 400000 + page_id END AS run_number,
  CASE page_id % 5 WHEN 0 THEN 100000 + page_id WHEN 1 THEN 200000 + page_id WHEN 2 THEN NULL
    WHEN 3 THEN NULL WHEN 4 THEN 123456 END AS curve_run_number,
  CASE WHEN page_id % 2 = 0 THEN 'IPTS-' || page_id END AS proposal,
  CASE WHEN page_id % 5 < 2 OR page_id % 3 = 0 THEN 'REF_L' END AS instrument
FROM pages
"""


def page_paths():
    """A path per page: five ways to name a run, some below a proposal folder."""
    n = F.col("page_id")
    name = (
        F.when(n % 5 == 0, text("refl_", n + 100000, "_auto.txt"))
        .when(n % 5 == 1, text("REF_L_", n + 200000, ".nxs.h5"))
        .when(n % 5 == 2, text("scan-", n + 30000, ".", "json"))
        .when(n % 5 == 3, F.lit("notes.md"))
        .otherwise(F.lit("data123456789.dat"))
    )
    top = F.when(n % 2 == 0, text("/ipts-", n)).otherwise(F.lit("/open"))
    below = F.when(n % 3 == 0, F.lit("/REF-L")).otherwise(F.lit("/x"))
    run_dir = F.when(n % 5 == 3, text("/run_", n + 400000, "_out")).otherwise(F.lit(""))
    return text(top, below, run_dir, "/", name)


@query("run_numbers", _NAMES_SQL)
def run_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Run numbers by both readers, proposal and instrument of a path per page."""
    pages = composed(
        load(spark, sf_dir, "pages"), F.col("page_id"), page_paths().alias("path")
    )
    path = F.col("path")
    return pages.select(
        "page_id",
        names.run_number(path).alias("run_number"),
        names.run_number_of_curve_file(names.file_name(path)).alias("curve_run_number"),
        names.proposal(path).alias("proposal"),
        names.instrument_of_path(path).alias("instrument"),
    )


_KIND_SQL = r"""
WITH p AS (
  SELECT page_id, page_id % 8 AS k, html, url FROM pages
)
SELECT page_id,
  CASE k WHEN 0 THEN 'reduced' WHEN 1 THEN 'unknown' WHEN 2 THEN 'parquet' WHEN 3 THEN 'raw_hdf5'
    WHEN 4 THEN 'model' WHEN 5 THEN CASE WHEN page_id % 3 = 0 OR contains(lower(html), 'refl1d') THEN 'model' ELSE 'unknown' END
    WHEN 6 THEN 'unknown' ELSE 'reduced' END AS file_type,
  CASE WHEN k = 0 THEN 100000 + page_id WHEN k = 7 THEN NULL WHEN k IN (1, 2, 3, 4, 5) THEN 100000 + page_id END AS run_number,
  CASE k WHEN 0 THEN 'IPTS-' || page_id END AS proposal
FROM p
"""


def kind_files(pages: DataFrame) -> DataFrame:
    """A file per page; its text is the whole page behind or before some marks."""
    n, html = F.col("page_id"), F.col("html")
    k = n % 8
    path = (
        F.when(k == 0, text("/a/REFL_", n + 100000, "_combined_data.TXT"))
        .when(k == 1, text("/a/x_", n + 100000, "_.txt"))
        .when(k == 2, text("/a/x_", n + 100000, "_.parquet"))
        .when(k == 3, text("/a/x_", n + 100000, ".nxs.h5"))
        .when(k == 4, text("/a/x_", n + 100000, "_m.json"))
        .when(k == 5, text("/a/x_", n + 100000, "_p.json"))
        .when(k == 6, F.lit("/a/.txt"))
        .otherwise(F.lit("/a/other.txt"))
    )
    content = (
        F.when(k == 0, text("# IPTS ipts ", n, "\n", html))
        .when(k == 1, text("nothing\n", html))
        .when(k == 4, text('{"sample": {"layers": []}}', html))
        .when(k == 5, text(html, F.when(n % 3 == 0, F.lit("refl1d")).otherwise(F.lit(""))))
        .when(k == 7, text("# Experiment\n Q ( 1 / A )\n", html))
    )
    return composed(pages, n.alias("page_id"), path.alias("path"), content.alias("content"))


@query("classify_files", _KIND_SQL)
def classify_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Kind, run and proposal of a file per page."""
    pages = load(spark, sf_dir, "pages").select("page_id", "html")
    info = kind_files(pages).select("page_id", names.identify(F.col("path"), F.col("content")).alias("i"))
    return info.select("page_id", "i.file_type", "i.run_number", "i.proposal")


# --- file sets ----------------------------------------------------------------

_SET_SQL = """files AS (
  SELECT page_id, 100000 + page_id // 12 AS run_number, page_id % 12 AS k, page_id % 3 AS root_ord,
    CASE page_id % 12 WHEN 0 THEN 'REFL_' || (100000 + page_id // 12) || '_combined_data.txt'
      WHEN 1 THEN 'r_' || (100000 + page_id // 12) || '_.nxs.h5' WHEN 2 THEN 'r_' || (100000 + page_id // 12) || '_model.json'
      WHEN 3 THEN 'r_' || (100000 + page_id // 12) || '_metadata.parquet' WHEN 4 THEN 'r_' || (100000 + page_id // 12) || '_sample.parquet'
      WHEN 5 THEN 'r_' || (100000 + page_id // 12) || '_users.parquet' WHEN 6 THEN 'r_' || (100000 + page_id // 12) || '_daslogs.parquet'
      WHEN 7 THEN 'r_' || (100000 + page_id // 12) || '_instrument.parquet' WHEN 8 THEN 'r_' || (100000 + page_id // 12) || '_events.parquet'
      WHEN 9 THEN 'r_' || (100000 + page_id // 12) || '_metadata.parquet' WHEN 10 THEN 'r_' || (100000 + page_id // 12) || '_sample_metadata.parquet'
      ELSE 'metadata.parquet' END AS name
  FROM pages WHERE url LIKE '%e%'
),
located AS (SELECT *, '/r' || root_ord || '/run_' || run_number || '_/' || name AS path FROM files WHERE k < 11),
slots AS (
  SELECT *, CASE k WHEN 0 THEN 'reduced_file' WHEN 1 THEN 'raw_file' WHEN 2 THEN 'model_file' WHEN 4 THEN 'sample_parquet'
    WHEN 5 THEN 'users_parquet' WHEN 6 THEN 'daslogs_parquet' WHEN 7 THEN 'instrument_parquet'
    WHEN 8 THEN 'other_parquet' ELSE 'metadata_parquet' END AS slot FROM located),
sets AS (
  SELECT run_number,
    arg_min(path, (root_ord, path)) FILTER (slot = 'reduced_file') AS reduced_file,
    arg_min(path, (root_ord, path)) FILTER (slot = 'raw_file') AS raw_file,
    arg_min(path, (root_ord, path)) FILTER (slot = 'model_file') AS model_file,
    arg_min(path, (root_ord, path)) FILTER (slot = 'metadata_parquet') AS metadata_parquet,
    arg_min(path, (root_ord, path)) FILTER (slot = 'sample_parquet') AS sample_parquet,
    arg_min(path, (root_ord, path)) FILTER (slot = 'users_parquet') AS users_parquet,
    arg_min(path, (root_ord, path)) FILTER (slot = 'daslogs_parquet') AS daslogs_parquet,
    arg_min(path, (root_ord, path)) FILTER (slot = 'instrument_parquet') AS instrument_parquet,
    count(*) FILTER (slot = 'other_parquet') AS other_parquet_count
  FROM slots GROUP BY run_number)"""

_FILESET_SQL = f"""
WITH {_SET_SQL}
SELECT run_number, reduced_file, raw_file, model_file, metadata_parquet, other_parquet_count,
  round(CASE WHEN reduced_file IS NULL THEN 0 ELSE 0.30::DOUBLE END + CASE WHEN metadata_parquet IS NULL THEN 0 ELSE 0.25::DOUBLE END
    + CASE WHEN sample_parquet IS NULL THEN 0 ELSE 0.15::DOUBLE END + CASE WHEN model_file IS NULL THEN 0 ELSE 0.15::DOUBLE END
    + CASE WHEN daslogs_parquet IS NULL THEN 0 ELSE 0.10::DOUBLE END + CASE WHEN users_parquet IS NULL THEN 0 ELSE 0.05::DOUBLE END, 2) AS completeness,
  regexp_replace(coalesce(metadata_parquet, sample_parquet, daslogs_parquet), '/[^/]*$', '') AS parquet_dir,
  reduced_file IS NOT NULL AS has_reduced, model_file IS NOT NULL AS has_model, metadata_parquet IS NOT NULL AS has_parquet_metadata
FROM sets
"""


def page_catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files of runs, twelve pages to a run; some are of no known kind."""
    pages = load(spark, sf_dir, "pages")
    n = F.col("page_id")
    run = F.floor(n / 12) + 100000
    endings = (
        "_.nxs.h5", "_model.json", "_metadata.parquet", "_sample.parquet", "_users.parquet",
        "_daslogs.parquet", "_instrument.parquet", "_events.parquet", "_metadata.parquet",
        "_sample_metadata.parquet",
    )
    name = F.when(n % 12 == 0, text("REFL_", run, "_combined_data.txt"))
    for i, ending in enumerate(endings):
        name = name.when(n % 12 == i + 1, text("r_", run, ending))
    name = name.otherwise(F.lit("metadata.parquet"))
    name = F.when(F.col("url").contains("e"), name).otherwise(text(name, ".dat"))
    content = F.when(
        n % 12 == 2, text('{"libraries": {"refl1d": {}}}', F.col("html"))
    ).when(n % 12 == 0, F.col("html"))
    return composed(
        pages,
        text("/r", n % 3, "/run_", run, "_/", name).alias("path"),
        content.alias("content"),
        (n % 3).alias("root_ord"),
    )


@query("fileset_completeness", _FILESET_SQL)
def fileset_completeness(spark: SparkSession, sf_dir: str) -> DataFrame:
    """File set of every run at once."""
    sets, _ = discovery.discover(page_catalog(spark, sf_dir))
    return sets.select(
        "run_number", "reduced_file", "raw_file", "model_file", "metadata_parquet",
        "other_parquet_count", "completeness", "parquet_dir", "has_reduced", "has_model",
        "has_parquet_metadata",
    )


_AVAILABLE_SQL = f"""
WITH {_SET_SQL}
SELECT run_number, slot, path FROM (
  SELECT run_number, 'reduced_file' AS slot, reduced_file AS path FROM sets
  UNION ALL SELECT run_number, 'raw_file', raw_file FROM sets
  UNION ALL SELECT run_number, 'model_file', model_file FROM sets
  UNION ALL SELECT run_number, 'metadata_parquet', metadata_parquet FROM sets
  UNION ALL SELECT run_number, 'sample_parquet', sample_parquet FROM sets
  UNION ALL SELECT run_number, 'users_parquet', users_parquet FROM sets
  UNION ALL SELECT run_number, 'daslogs_parquet', daslogs_parquet FROM sets
  UNION ALL SELECT run_number, 'instrument_parquet', instrument_parquet FROM sets
  UNION ALL SELECT run_number, slot, path FROM slots WHERE slot = 'other_parquet')
WHERE path IS NOT NULL
"""


@query("available_files", _AVAILABLE_SQL)
def available_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All files of every run by slot, further Parquet files included."""
    sets, found = discovery.discover(page_catalog(spark, sf_dir))
    return fileset.available_files(sets, found).select("run_number", "slot", "path")


_DIRS_SQL = """
WITH files AS (
  SELECT CASE WHEN page_id % 4 = 0 THEN '/base' ELSE '/base/run' || (5000 + page_id // 6) || CASE page_id % 4 WHEN 1 THEN '_a' ELSE '' END END AS dir,
    'p' || page_id || 'x' || (9000 + page_id) AS stem
  FROM pages WHERE page_id % 4 < 3),
labels AS (
  SELECT 0 AS rank, dir, regexp_extract(dir, '([^/]*)$', 1) AS label FROM files WHERE dir <> '/base'
  UNION SELECT 1, dir, stem FROM files WHERE dir = '/base'),
hits AS (
  SELECT r.page_id, arg_min(l.dir, (l.rank, l.dir)) AS parquet_dir
  FROM pages r JOIN labels l ON contains(l.label, CAST(5000 + r.page_id * 2 AS VARCHAR)) GROUP BY 1)
SELECT page_id, 5000 + page_id * 2 AS run_number, parquet_dir FROM pages LEFT JOIN hits USING (page_id)
"""


@query("parquet_dirs", _DIRS_SQL)
def parquet_dirs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Folder of a run's Parquet files, for one run per page."""
    pages = load(spark, sf_dir, "pages").select("page_id")
    n = F.col("page_id")
    mark = F.when(n % 4 == 1, F.lit("_a")).otherwise(F.lit(""))
    folder = F.when(n % 4 == 0, F.lit("/base")).otherwise(text("/base/run", F.floor(n / 6) + 5000, mark))
    ending = F.when(n % 4 == 3, F.lit(".txt")).otherwise(F.lit(".parquet"))
    listed = pages.select(text(folder, "/p", n, "x", n + 9000, ending).alias("path"))
    runs = pages.select("page_id", (n * 2 + 5000).alias("run_number"))
    return files.parquet_dir_of_runs(runs, listed, "/base")


# --- manifests ----------------------------------------------------------------

_MANIFEST_SQL = """
SELECT doc_id AS job, 0 AS pos, 'first ' || lang AS name, '/c/' || doc_id AS reduced,
  '/m/' || source AS model, 0 AS dataset_index, CAST(NULL AS VARCHAR) AS environment, true AS shares_sample FROM documents
UNION ALL SELECT doc_id, 1, 'Measurement 2', '/c/' || (doc_id + 1), '/m/own', 4, 'env ' || source, true FROM documents
UNION ALL SELECT doc_id, 2, 'Measurement 3', '', '/m/' || source, 0, '', true FROM documents WHERE lang = 'en'
"""


def manifest_texts(documents: DataFrame) -> DataFrame:
    """A manifest per document; English ones have a measurement without a curve."""
    n, source = F.col("doc_id"), F.col("source")
    third = F.when(F.col("lang") == "en", F.lit(', {"environment": "", "model": ""}')).otherwise(F.lit(""))
    content = text(
        '{"title": "t", "output": "', F.when(n % 10 == 0, F.lit("")).otherwise(F.lit("/out")),
        '", "sample": {"description": "d", "model": "/m/', source, '", "model_dataset_index": 1}, "measurements": [',
        '{"name": "first ', F.col("lang"), '", "reduced": "/c/', n, '", "model_dataset_index": 0}, ',
        '{"reduced": "/c/', n + 1, '", "model": "/m/own", "model_dataset_index": 5, "environment": "env ', source, '"}',
        third, "]}",
    )
    return documents.select(n.cast("string").alias("path"), content.alias("content"))


def manifests(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = load(spark, sf_dir, "documents").select("doc_id", "lang", "source")
    return manifest.normalise(manifest.parse(manifest_texts(documents)))


@query("manifest_table", _MANIFEST_SQL)
def manifest_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Measurements of every manifest with defaults and overrides applied."""
    jobs = manifest.to_jobs(manifests(spark, sf_dir))
    return jobs.select(
        F.col("job").cast("bigint").alias("job"),
        "pos", "name", "reduced", "model", "dataset_index", "environment", "shares_sample",
    )


_VALIDATION_SQL = """
WITH known AS (SELECT '/c/' || doc_id AS path FROM labels UNION SELECT '/m/' || source FROM documents WHERE lang = 'de')
SELECT doc_id AS job, -2 AS pos, 'No output folder is given' AS message FROM documents WHERE doc_id % 10 = 0
UNION ALL SELECT doc_id, -1, 'There is no model of the sample: /m/' || source FROM documents WHERE '/m/' || source NOT IN (SELECT path FROM known)
UNION ALL SELECT doc_id, 0, 'Measurement ''first ' || lang || ''': the dataset index counts from 1' FROM documents
UNION ALL SELECT doc_id, 0, 'Measurement ''first ' || lang || ''': there is no curve /c/' || doc_id FROM documents WHERE '/c/' || doc_id NOT IN (SELECT path FROM known)
UNION ALL SELECT doc_id, 1, 'Measurement ''Measurement 2'': there is no curve /c/' || (doc_id + 1) FROM documents WHERE '/c/' || (doc_id + 1) NOT IN (SELECT path FROM known)
UNION ALL SELECT doc_id, 1, 'Measurement ''Measurement 2'': there is no model /m/own' FROM documents
UNION ALL SELECT doc_id, 2, 'Measurement ''Measurement 3'': no curve file is named' FROM documents WHERE lang = 'en'
"""


@query("manifest_validation", _VALIDATION_SQL)
def manifest_validation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Errors of every manifest, with the labelled documents as known files."""
    labelled = load(spark, sf_dir, "labels").select(text("/c/", F.col("doc_id")).alias("path"))
    german = load(spark, sf_dir, "documents").filter("lang = 'de'").select(text("/m/", F.col("source")).alias("path"))
    errors = manifest.validate(manifests(spark, sf_dir), labelled.unionByName(german).distinct())
    return errors.select(F.col("job").cast("bigint").alias("job"), "pos", "message")


_KEPT_SQL = """
WITH p AS (SELECT page_id, length(html) AS n, strlen(html) AS bytes, page_id % 4 AS kind, page_id % 5 = 0 AS late, page_id % 7 = 0 AS other FROM pages),
f AS (SELECT *, '/run_' || (200000 + page_id) || '_/' || CASE kind WHEN 0 THEN 'REFL_' || (200000 + page_id) || '_combined_data.txt'
    WHEN 1 THEN 'm' || page_id || '.json' WHEN 2 THEN 'r_' || (200000 + page_id) || '_metadata.parquet' ELSE 'notes.dat' END AS name FROM p),
t AS (SELECT *, bytes + CASE WHEN kind = 1 THEN 8 ELSE 0 END AS length,
    CASE kind WHEN 0 THEN 'reduced' WHEN 1 THEN 'model' WHEN 2 THEN 'parquet' ELSE 'unknown' END AS file_type FROM f)
SELECT name, CASE WHEN other THEN 'gone' WHEN late THEN 'added' WHEN page_id % 3 = 1 THEN 'changed' ELSE 'same' END AS state,
  length + CASE WHEN NOT other AND NOT late AND page_id % 3 = 1 THEN 4 ELSE 0 END AS length, file_type,
  200000 + page_id AS run_number
FROM t
"""


@query("kept_catalog", _KEPT_SQL)
def kept_catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A kept catalog after a second listing, when files were added, changed, and gone with their folder."""
    pages = load(spark, sf_dir, "pages")
    n = F.col("page_id")
    run = (n + 200000).cast("string")
    kind = n % 4
    name = (
        F.when(kind == 0, text("REFL_", run, "_combined_data.txt"))
        .when(kind == 1, text("m", n, ".json"))
        .when(kind == 2, text("r_", run, "_metadata.parquet"))
        .otherwise(F.lit("notes.dat"))
    )
    content = F.when(kind == 1, F.concat(F.lit("{refl1d}"), "html")).otherwise(F.col("html"))
    files = pages.select("page_id", text("run_", run, "_/", name).alias("path"), content.alias("content"))
    late, other = n % 5 == 0, n % 7 == 0
    first, second, catalog = [scratch_path(spark, part) for part in ("first", "second", "catalog")]
    write_named(files.filter(~late & ~other), first)
    write_named(files.filter(other), second)
    kept_files.refresh(spark, [first, second], catalog)
    write_named(files.filter(late & ~other), first)
    changed = files.filter(~late & ~other & (n % 3 == 1))
    write_named(changed.select("path", F.concat("content", F.lit("more")).alias("content")), first)
    found = kept_files.refresh(spark, [first], catalog)
    return found.select(
        F.regexp_extract("path", "(/run_[^/]*/[^/]*)$", 1).alias("name"), "state", "length", "file_type", "run_number"
    )
