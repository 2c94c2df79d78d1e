import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from checks import registry
from deedmill.operators import prepare
from deedmill.sources.reconcile import CLASH, MISSING, WIDENED, Finding, common_type, reconcile

TINY = "/root/testdata/sf0.001"


@pytest.mark.parametrize(
    "a, b, common",
    [
        (T.IntegerType(), T.LongType(), T.LongType()), (T.ByteType(), T.DoubleType(), T.DoubleType()),
        (T.LongType(), T.DoubleType(), None), (T.FloatType(), T.DoubleType(), T.DoubleType()),
        (T.DecimalType(10, 2), T.IntegerType(), T.DecimalType(12, 2)), (T.DecimalType(38, 2), T.DecimalType(38, 9), None),
        (T.DateType(), T.TimestampType(), T.TimestampType()), (T.StringType(), T.IntegerType(), None),
        (T.NullType(), T.StringType(), T.StringType()), (T.StringType(), T.StringType(), T.StringType()),
    ],
)
def test_common_type(a, b, common):
    assert common_type(a, b) == common_type(b, a) == common


def test_three_cities_of_different_schemas(spark, tmp_path):
    parts = {
        "pune": spark.createDataFrame([(1, "a", 5)], "id int, Name string, price int"),
        "thane": spark.createDataFrame([(1 << 40, None, "x7")], "id long, name string, price string"),
        "dubai": spark.createDataFrame([(2, 1.5)], "id short, area double"),
    }
    loads = {}
    for name, df in parts.items():
        df.write.parquet(str(tmp_path / name))
        loads[name] = spark.read.parquet(str(tmp_path / name))
    stacked, findings = reconcile(loads)
    assert dict(stacked.dtypes) == {"id": "bigint", "name": "string", "price": "string", "area": "double"}
    rows = {tuple(r) for r in stacked.collect()}
    assert rows == {(1, "a", "5", None), (1 << 40, None, "x7", None), (2, None, None, 1.5)}
    assert set(findings) == {
        Finding("pune", "id", WIDENED, "int", "bigint"), Finding("dubai", "id", WIDENED, "smallint", "bigint"),
        Finding("dubai", "name", MISSING, None, "string"), Finding("pune", "price", CLASH, "int", "string"),
        Finding("thane", "price", CLASH, "string", "string"), Finding("dubai", "price", MISSING, None, "string"),
        Finding("pune", "area", MISSING, None, "double"), Finding("thane", "area", MISSING, None, "double"),
    }
    one, none = reconcile({"pune": loads["pune"]})
    assert none == [] and one.columns == ["id", "name", "price"]
    with pytest.raises(ValueError, match="differ only in case"):
        reconcile({"twice": loads["pune"].toDF("a", "b", "c").select("a", F.col("b").alias("A"))})
    with pytest.raises(ValueError, match="no loads"):
        reconcile({})


def test_audit_counts_in_the_pass_that_uses_the_rows(spark):
    raw = registry.raw(spark, TINY).withColumn("floor_no", F.when(F.col("floor_no") == "7", "attic").otherwise(F.col("floor_no")))
    raw = raw.drop("transaction_date")
    sheet = registry.property_labels(spark).filter("property_type_raw <> 'Shop'")
    audit = Observation("load")
    out = prepare.prepare(raw, registry.bhk_labels(spark), sheet, audit=audit)
    assert not [c for c in out.columns if c.startswith("_")]
    n = out.filter("floor_no IS NULL OR floor_no < 1000").count()
    assert n == raw.count()
    counts = audit.get
    assert counts["rows"] == counts["missing_transaction_date"] == n
    assert counts["unknown_floors"] == raw.filter("floor_no = 'attic'").count() > 0
    assert counts["unmapped_types"] == raw.filter("trim(property_type_raw) = 'Shop'").count() > 0
    with pytest.raises(Exception, match="unknown floor: attic"):
        prepare.prepare(raw, registry.bhk_labels(spark), registry.property_labels(spark)).select("floor_no").collect()
