"""Queries over many small files write and read them in few tasks, and on all cores."""

from measlake.session import configure, scratch_path
from workloads import scans


def test_files_are_written_over_all_cores(spark, tmp_path):
    suppliers = spark.createDataFrame(
        [(i, f"name {i}", i % 5, i / 4) for i in range(40)],
        "s_suppkey long, s_name string, s_nationkey int, s_acctbal double",
    )
    suppliers.coalesce(1).write.parquet(str(tmp_path / "supplier.parquet"))
    base = scans.write_curves(spark, str(tmp_path))
    names = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(base).select("path").collect()
    assert len(names) == 40
    assert len({row.path.split("REFL_curve-")[1][:5] for row in names}) > 1


def test_a_task_reads_many_small_files(spark):
    folder = scratch_path(spark, "small")
    spark.range(200).repartition(200).write.parquet(folder)
    assert configure(spark).read.parquet(folder).rdd.getNumPartitions() <= 3
