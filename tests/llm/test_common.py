import time

from pyspark.sql import functions as F

from deedmill.llm.common import CLEANUP, checkpoint
from deedmill.llm.components import components


def _shuffle_files(spark) -> set[str]:
    files = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {name for i in range(files.size()) if (name := files.apply(i).getName()).startswith("shuffle_")}


def _left(spark, before: set[str]) -> set[str]:
    """Shuffle files that a step leaves; they are removed in the background."""
    for _ in range(50):
        if not (left := _shuffle_files(spark) - before):
            break
        time.sleep(0.2)
    return left


def test_steps_leave_no_shuffle_files(spark):
    before, setting = _shuffle_files(spark), spark.conf.get(CLEANUP)
    rows = spark.range(1000).withColumn("g", F.col("id") % 7)
    counted = checkpoint(rows.groupBy("g").count().repartition(3, "count"))
    edges = rows.where("g > 0").selectExpr("id AS a", "id - 1 AS b")
    found = components(edges)
    assert _left(spark, before) == set()
    assert spark.conf.get(CLEANUP) == setting
    assert counted.agg(F.sum("count")).first()[0] == 1000
    assert {r.node: r.root for r in found.collect()} == {i: i - i % 7 for i in range(1000) if i % 7}
