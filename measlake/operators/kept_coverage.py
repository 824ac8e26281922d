"""Coverage of a growing table from parts per file that are kept (A10).

``coverage.profile`` reads a whole table each time. Here every file has a part: its rows,
and per field the number with a value and the bounds. Parts are added up, so after an
append only the new files are read. Parts of files that are gone or were written
anew no longer count. A field that some files lack is missing in all their rows, as
it is when the table is read as one.

Bounds are those of numbers (as doubles, without NaN), times (seconds since 1970) and texts; other fields
have none. An empty list counts as filled. A table without rows has no fields here.
"""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, DateType, NumericType, StringType, StructType, TimestampType

from ..sources import files, kept_catalog
from .coverage import leaves, value_of

FILE = ("path", "length", "modified")
BOUNDS = ("low_number", "high_number", "low_text", "high_text")
PARTS = (
    "path string, length bigint, modified timestamp, field string, populated bigint, "
    "low_number double, high_number double, low_text string, high_text string"
)
# The part of a file that counts its rows has no field name.
ROWS = ""


def type_of(schema: StructType, name: str) -> DataType:
    kind: DataType = schema
    for part in name.split("."):
        kind = kind[part].dataType
    return kind


def _bounds(kind: DataType, value: Column) -> list[Column]:
    number = text = None
    if isinstance(kind, NumericType):
        number = F.nanvl(value.cast("double"), F.lit(None).cast("double"))
    elif isinstance(kind, (DateType, TimestampType)):
        number = value.cast("timestamp").cast("double")
    elif isinstance(kind, StringType):
        text = value
    ends = []
    for name, of in zip(BOUNDS, (number, number, text, text)):
        nothing = F.lit(None).cast("double" if name.endswith("number") else "string")
        end = F.min if name.startswith("low") else F.max
        ends.append((nothing if of is None else end(of)).alias(name))
    return ends


def parts_of(df: DataFrame, file: str) -> DataFrame:
    """One row per file and field, from one aggregation over rows with their ``file``."""
    schema = StructType([f for f in df.schema.fields if f.name != file])
    names = leaves(schema)
    entry = [
        F.struct(F.count(value_of(n)).alias("populated"), *_bounds(type_of(schema, n), value_of(n)))
        for n in names
    ]
    counted = df.groupBy(F.col(file).alias("path")).agg(
        F.struct(F.count(F.lit(1)).alias("populated"), *_bounds(schema, F.lit(None))).alias("_rows"),
        *[e.alias(f"_{i}") for i, e in enumerate(entry)],
    )
    listed = [F.struct(F.lit(ROWS).alias("field"), "_rows.*")] + [
        F.struct(F.lit(n).alias("field"), f"_{i}.*") for i, n in enumerate(names)
    ]
    return counted.select("path", F.inline(F.array(*listed)))


def merged(parts: DataFrame) -> DataFrame:
    """Coverage and bounds of every field over all files, in the form of ``coverage.profile``."""
    fields = parts.groupBy("field").agg(
        F.sum("populated").alias("populated"),
        *[(F.min if b.startswith("low") else F.max)(b).alias(b) for b in BOUNDS],
    )
    # One row per field by now.
    all_rows = F.max(F.when(F.col("field") == ROWS, F.col("populated"))).over(Window.partitionBy(F.lit(0)))
    share = F.round(100 * F.try_divide(F.col("populated"), F.col("_rows")), 1)
    return (
        fields.withColumn("_rows", all_rows)
        .filter(F.col("field") != ROWS)
        .select(
            "field",
            "populated",
            (F.col("_rows") - F.col("populated")).alias("missing"),
            F.coalesce(share, F.lit(0.0)).alias("coverage_pct"),
            *BOUNDS,
        )
    )


def kept_parts(spark: SparkSession, kept: str) -> DataFrame:
    try:
        return spark.read.schema(PARTS).parquet(f"{kept.rstrip('/')}/*")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], PARTS)


def refresh(spark: SparkSession, table: str, kept: str) -> DataFrame:
    """Read the files of a table that have no part yet, keep their parts, give those of all its files.

    Names of new files pass the driver, as all of a table's do when Spark reads it.
    """
    listed = kept_catalog.list_files(spark, [table]).select(*FILE)
    listed = listed.filter(F.col("path").endswith(".parquet"))
    known = kept_parts(spark, kept)
    fresh = listed.join(known.filter(F.col("field") == ROWS), list(FILE), "left_anti")
    paths = [row.path for row in fresh.select("path").collect()]
    if paths:
        rows = spark.read.option("mergeSchema", True).parquet(*paths)
        own = files.metadata_path(F.col("_metadata.file_path")).alias("_file")
        found = parts_of(rows.select("*", own), "_file").join(listed, "path")
        # A folder per refresh; two at once keep the same parts twice, which are made one below.
        found.select(*[p.split()[0] for p in PARTS.split(", ")]).write.parquet(
            f"{kept.rstrip('/')}/parts-{uuid.uuid4().hex}"
        )
        known = kept_parts(spark, kept)
    return known.join(listed, list(FILE), "left_semi").dropDuplicates([*FILE, "field"])
