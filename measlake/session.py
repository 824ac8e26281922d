"""Session settings and the shared scratch folder."""

from __future__ import annotations

import functools
import re
import tempfile
import uuid

from pyarrow import fs
from pyspark.sql import SparkSession

from .sinks.named_files import store_of

# Runtime settings every plan relies on: UTC timestamps, and joins that AQE may
# split on hot keys even when a later step would have to shuffle once more.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Many small files: a task reads dozens of them and lists hundreds of folders,
    # where Spark's own settings make a task of every few files and of every folder.
    "spark.sql.files.openCostInBytes": "256k",
    "spark.sql.sources.parallelPartitionDiscovery.parallelism": "200",
}
PLANNED_BROADCAST = "spark.sql.autoBroadcastJoinThreshold"
MEASURED_BROADCAST = "spark.sql.adaptive.autoBroadcastJoinThreshold"


def measure_broadcasts(spark: SparkSession) -> None:
    """Broadcast a side of a join by its measured size only, up to the session's own limit.

    Before a plan runs, Spark goes by the size of the compressed files and by 20
    bytes for any text, whatever a row is parsed or exploded to: 900,000 models of
    a 9 MB file count as less than 10 MB and are 1.6 GB, all through the driver.
    """
    limit = spark.conf.get(PLANNED_BROADCAST)
    if limit != "-1":
        if spark.conf.get(MEASURED_BROADCAST, None) is None:
            spark.conf.set(MEASURED_BROADCAST, limit)
        spark.conf.set(PLANNED_BROADCAST, "-1")


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a session somebody else created."""
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    measure_broadcasts(spark)
    return spark


def local_session(
    cores: str = "*",
    shuffle_partitions: int = 8,
    memory: str = "8g",
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """A single-machine session for tests and the bench."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("measlake")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        # Recording the caller of every column expression slows plan building.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    if "spark.checkpoint.dir" not in (extra or {}):
        builder = builder.config("spark.checkpoint.dir", own_folder())
    for key, value in {**RUNTIME_CONF, **(extra or {})}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    measure_broadcasts(spark)
    return spark


@functools.cache
def own_folder() -> str:
    """A folder of this process, for a session on one machine."""
    return tempfile.mkdtemp(prefix="measlake-")


# Part of the names of all folders this process leaves in the shared one.
RUN = uuid.uuid4().hex


def scratch_base(spark: SparkSession) -> str:
    """The folder for intermediate tables: the shared one, named by ``spark.checkpoint.dir``.

    A session on one machine that does not name one gets a folder of its own, once.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base is None:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir must name a shared folder on a cluster")
        base = own_folder()
    return base.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new folder for an intermediate table."""
    return f"{scratch_base(spark)}/{name}-{RUN}-{uuid.uuid4().hex}"


def remove_scratch(spark: SparkSession) -> None:
    """Remove the intermediate tables of this process, and no others.

    For the driver program to call, which owns them, when its results are written: DataFrames
    made before may still read from there.
    """
    store, folder = store_of(scratch_base(spark))
    for info in store.get_file_info(fs.FileSelector(folder, allow_not_found=True)):
        if f"-{RUN}-" in info.base_name and info.type == fs.FileType.Directory:
            store.delete_dir(info.path)
