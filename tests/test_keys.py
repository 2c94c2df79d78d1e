import random

from pyspark.sql import functions as F

from checks import registry
from checks.registry import PAIR
from deedmill.operators.keys import number_keys, ranked_keys
from deedmill.operators.levels import Level
from deedmill.plans import report

TINY = "/root/testdata/sf0.001"


def unstaged(df, name):
    return df.cache()


def test_ranks_keep_the_order_of_keys(spark):
    rng = random.Random(3)
    rows = [(rng.choice(["b", "a", "é", "", None]), rng.choice([3, -1, 10, None])) for _ in range(500)]
    df = spark.createDataFrame(rows, "x string, y int").repartition(6)
    got = sorted((r.n, r.x, r.y) for r in ranked_keys(df, ["x", "y"], "n", unstaged).collect())
    want = sorted({r for r in rows if None not in r}, key=lambda r: (r[0].encode(), r[1]))
    assert got == [(i + 1, *r) for i, r in enumerate(want)]


def test_rows_without_a_whole_key_have_no_number(spark):
    df = spark.createDataFrame([("a", 1, 5), ("a", None, 6), (None, 1, 7), ("a", 1, 8), ("b", 1, 9)], "x string, y int, z int")
    own = Level("own", ("x", "y"), False, False, 0.8, 0.1)
    out, numbered = number_keys(df, [own], unstaged)
    assert {r.z: r[own.number] for r in out.collect()} == {5: 1, 6: None, 7: None, 8: 1, 9: 2}
    assert set(out.columns) == {"x", "y", "z", own.number} and numbered["own"].count() == 2
    assert number_keys(df.limit(0), [own], unstaged)[0].collect() == []


def test_report_by_two_columns(spark, tmp_path):
    df = registry.prepared(spark, TINY, *report.COLUMNS).cache()
    path = report.run_reports(df, str(tmp_path / "out"), levels=[PAIR], grains=["Overall"])["pair"]
    wide = spark.read.parquet(path)
    assert wide.columns[:5] == ["Type", "Period", "location", "project_type", "city"]
    got = {(r.city, r.location, r.project_type): (r.total_transactions, r.total_sales) for r in wide.collect()}
    sale = df.filter("property_category = 'Sale' AND location IS NOT NULL AND project_type IS NOT NULL")
    want = sale.groupBy("city", "location", "project_type").agg(F.count("document_no").alias("n"), F.sum("agreement_price").alias("s")).collect()
    assert got == {(r.city, r.location, r.project_type): (r.n, r.s) for r in want}
    rows = [(r.city, r.location, r.project_type) for r in wide.collect()]
    assert rows == sorted(rows)
    df.unpersist()
