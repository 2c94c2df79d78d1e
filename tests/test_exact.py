import math
import random
from decimal import ROUND_HALF_EVEN, Decimal

import pytest
from pyspark.sql import functions as F

from deedmill.functions import exact
from deedmill.operators import callbacks


def summed(df):
    once = df.groupBy("k", "half").agg(*exact.sums("x", F.col("x")))
    out = once.groupBy("k").agg(*exact.merged("x")).select("k", exact.rounded("x").alias("x"), exact.total("x").alias("t"))
    return {r.k: (r.x, r.t) for r in out.collect()}


def test_sums_are_the_same_in_any_partitioning_and_exact(spark):
    rng = random.Random(1)
    rows = [(i % 3, i % 2, round(rng.uniform(-1, 1) * 10 ** rng.choice([2, 6, 11, 15]), 3)) for i in range(3000)] + [(7, 0, None)]
    df = spark.createDataFrame(rows, "k int, half int, x double")
    found = [summed(df.repartition(n)) for n in (1, 3, 8)]
    assert found[0] == found[1] == found[2] and found[0][7] == (None, None)
    for k in range(3):
        total = sum(Decimal(repr(x)) for key, _, x in rows if key == k)
        # A double of this size holds no more than a few decimals; the sum of what it holds is exact.
        held = sum(math.floor(x) + Decimal(round((x - math.floor(x)) * 1e9)) / 10**9 for key, _, x in rows if key == k)
        assert found[0][k][1] == held and abs(held - total) < 1
        assert found[0][k][0] == float(held.quantize(Decimal("0.01"), ROUND_HALF_EVEN))


def test_ties_round_to_even(spark):
    df = spark.createDataFrame([(1, 0, 0.1), (1, 1, 0.025), (2, 0, 0.1), (2, 0, 0.035)], "k int, half int, x double")
    assert {k: x for k, (x, _) in summed(df).items()} == {1: 0.12, 2: 0.14}


def test_totals_beyond_a_bigint_fail(spark):
    df = spark.createDataFrame([(1, 0, 9e18)] * 3, "k int, half int, x double")
    with pytest.raises(Exception, match="OVERFLOW|overflow"):
        summed(df)


def test_whole_groups_equal_pandas(spark):
    def median_gap(key, batches):
        values = [v for batch in batches for v in batch.column("v").to_pylist()]
        assert values == sorted(values)
        gaps = sorted(b - a for a, b in zip(values, values[1:], strict=False))
        return [(len(values), gaps[len(gaps) // 2] if gaps else None)]

    rng = random.Random(2)
    keys = [("a", 1.0)] * 4000 + [("a", None), (None, None), ("b", math.nan), ("b", math.nan), ("b", 2.0)] * 40
    rows = [(*k, rng.randrange(10_000)) for k in keys]
    df = spark.createDataFrame(rows, "k string, f double, v int").repartition(5)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "100")
    try:
        got = callbacks.per_whole_group(df, ["k", "f"], ["v"], median_gap, "n int, gap int", ["v"]).collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    pandas = df.toPandas().sort_values("v").groupby(["k", "f"], dropna=False)["v"]
    text = lambda k: str(tuple(None if x is None else str(x) for x in k))
    found = {text((r.k, r.f)): (r.n, r.gap) for r in got}
    assert len(got) == len({text(k) for k in keys}) == 5
    whole = {}
    for *k, v in rows:
        whole.setdefault(text(k), []).append(v)
    for k, values in whole.items():
        values.sort()
        gaps = sorted(b - a for a, b in zip(values, values[1:], strict=False))
        assert found[k] == (len(values), gaps[len(gaps) // 2])
    assert pandas.ngroups >= 4


def test_a_function_may_stop_early_and_yield_many_rows(spark):
    def firsts(key, batches):
        for v in next(batches).column("v").to_pylist()[:2]:
            yield (v,)

    df = spark.range(5000).selectExpr("id % 3 AS k", "id AS v")
    got = callbacks.per_whole_group(df, ["k"], ["v"], firsts, "v bigint", ["v"]).collect()
    assert sorted(map(tuple, got)) == [(k, k + 3 * i) for k in range(3) for i in range(2)]
    assert callbacks.per_whole_group(df.limit(0), ["k"], ["v"], firsts, "v bigint").collect() == []


def test_memory_is_bounded_by_a_batch(spark):
    """A group of most rows goes through a worker that may not grow by what the group holds."""
    import resource

    def peak(key, batches):
        before = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss
        n = sum(len(v) for batch in batches for v in batch.column("v").to_pylist())
        yield (n, (resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - before) // 1024)

    df = spark.range(60_000).selectExpr("if(id % 10 = 0, id % 7, 100) AS k", "repeat('x', 4000) AS v")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "500")
    try:
        got = {r.k: r for r in callbacks.per_whole_group(df, ["k"], ["v"], peak, "n bigint, mb bigint").collect()}
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert got[100].n == 54_000 * 4000 and got[100].mb < 60
