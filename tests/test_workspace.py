from pathlib import Path
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from wellspring.workspace import scratch, scratch_scope, spread, stage, stage_measured


def fake(master, checkpoint=None):
    context = SimpleNamespace(
        master=master, applicationId=f"app-{master}", getConf=lambda: {"spark.checkpoint.dir": checkpoint}
    )
    return SimpleNamespace(conf=SimpleNamespace(get=lambda key, default: None), sparkContext=context)


def test_scratch_lies_in_the_folder_the_session_names(spark):
    root = spark.conf.get("spark.checkpoint.dir")
    path = scratch(spark, "x")
    assert path.startswith(f"{root}/wellspring/{spark.sparkContext.applicationId}/x-")
    assert path != scratch(spark, "x")
    assert scratch(fake("yarn", "hdfs://shared/"), "x").startswith("hdfs://shared/wellspring/app-yarn/x-")


def test_a_cluster_must_name_a_folder_and_a_local_session_need_not():
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        scratch(fake("spark://host:7077"), "x")
    first, second = scratch(fake("local[2]"), "x"), scratch(fake("local[2]"), "x")
    assert Path(first).parent == Path(second).parent


def test_staged_tables_end_the_lineage(spark):
    table, seen = stage_measured(
        spark.range(10).withColumn("r", F.rand()), "t", n=F.count(F.lit(1)), top=F.max("id")
    )
    assert seen == {"n": 10, "top": 9}
    assert table.collect() == table.collect()
    plan = table._jdf.queryExecution().executedPlan().toString()
    assert "FileScan parquet" in plan and "rand" not in plan


def test_scope_deletes_its_tables_even_after_an_error(spark):
    kept = stage(spark.range(3), "t")
    with pytest.raises(RuntimeError), scratch_scope(spark):
        gone = stage(spark.range(3), "t").inputFiles()[0]
        raise RuntimeError
    assert not Path(gone.removeprefix("file://")).exists()
    assert kept.count() == 3


def test_spread_leaves_a_wide_scan_alone(spark):
    cores = spark.sparkContext.defaultParallelism
    narrow, wide = spark.range(0, 100, 1, 1), spark.range(0, 100, 1, cores + 3)
    assert spread(narrow, "id").rdd.getNumPartitions() == cores
    assert spread(wide, "id") is wide
