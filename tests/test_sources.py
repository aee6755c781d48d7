"""Reading, writing and the shared folder."""

import glob

import pytest
from pyspark.sql import functions as F

from gaugeworks.sources.shared import materialise, shared_folder
from gaugeworks.sources.tables import publish_table, read_table, register_views, write_table
from plan_text import optimised_plan


def test_partition_columns_keep_their_types(spark, tmp_path):
    df = spark.createDataFrame(
        [("01", 2024, 1), ("02", 2025, 2), (None, 2025, 3)], "code string, ano int, v int"
    )
    stored = publish_table(df, str(tmp_path / "t"), ["ano", "code", "absent"])
    assert stored.schema.simpleString() == df.schema.simpleString()
    assert sorted((tuple(r) for r in stored.collect()), key=str) == sorted(
        (tuple(r) for r in df.collect()), key=str
    )
    pruned = stored.filter("ano = 2024")
    assert len(pruned.inputFiles()) == 3 and pruned.count() == 1
    plan = pruned._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(ano" in plan


def test_writes_are_rebalanced_into_few_files(spark, tmp_path):
    df = spark.range(4000, numPartitions=16).select((F.col("id") % 3).alias("ano"), "id")
    write_table(df, str(tmp_path / "t"), ["ano"])
    assert len(glob.glob(str(tmp_path / "t/ano=*/*.parquet"))) == 3


def test_overwrite_replaces(spark, tmp_path):
    path = str(tmp_path / "t")
    write_table(spark.range(5), path)
    write_table(spark.range(2), path)
    assert read_table(spark, path).count() == 2


def test_csv_with_and_without_schema(spark, tmp_path):
    path = str(tmp_path / "c")
    spark.createDataFrame([(1, "x"), (2, None)], "n int, t string").write.option(
        "header", True
    ).csv(path)
    typed = read_table(spark, path, "csv", "n int, t string")
    assert sorted(tuple(r) for r in typed.collect()) == [(1, "x"), (2, None)]
    assert {f.dataType.simpleString() for f in read_table(spark, path, "csv").schema} == {"string"}


def test_views(spark):
    register_views(spark, {"some_mart": spark.range(3)})
    assert spark.sql("SELECT count(*) AS n FROM some_mart").first().n == 3


def test_stored_tables_have_a_known_size_and_no_lineage(spark):
    df = spark.range(10).withColumn("v", F.col("id") * 2)
    stored = materialise(df, "numbers")
    assert sorted(tuple(r) for r in stored.collect()) == [(i, i * 2) for i in range(10)]
    assert "Range" not in optimised_plan(stored)
    size = stored._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
    assert int(str(size)) < 100_000


def test_shared_folder_comes_from_the_session(spark):
    base = spark.conf.get("spark.checkpoint.dir")
    first, second = shared_folder(spark, "x"), shared_folder(spark, "x")
    assert first.startswith(base) and first != second


class FakeSession:
    """Only the settings of a session."""

    def __init__(self, master):
        self.conf = {"spark.master": master}


def test_a_cluster_without_a_shared_folder_is_refused():
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_folder(FakeSession("spark://somewhere:7077"), "x")
    local = FakeSession("local[2]")
    one, two = shared_folder(local, "x"), shared_folder(local, "x")
    assert one != two and one.rsplit("/", 1)[0] == two.rsplit("/", 1)[0]
