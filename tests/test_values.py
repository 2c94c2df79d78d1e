import pytest
from pyspark.sql import functions as F

from deedmill.functions.values import buyer_ages, price_label, round2, title, to_number


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()["x"]


@pytest.mark.parametrize(
    ("text", "ages"),
    [
        ("1) नाव:-राम वय:-३५; पत्ता:-पुणे 2) नाव:-सीता वय:-42 पत्ता:-x 3) नाव:-y 00 पत्ता:-q 4) z 51 प्लॉट नं", [35, 42, 51]),
        ("1) वय:29 पत्ता 2) 44 -,", [29, 44]),
        ("no buyers", []),
        ("", []),
        (None, []),
    ],
)
def test_buyer_ages(spark, text, ages):
    assert one(spark, buyer_ages(F.lit(text).cast("string"))) == ages


@pytest.mark.parametrize("text", ["2bhk", "1.5BR ", ">3br", "row_house", "triplex apartment", "flat/shop", "o'neil"])
def test_title_is_that_of_python(spark, text):
    assert one(spark, title(F.lit(text))) == text.title()


@pytest.mark.parametrize(
    ("amount", "label"),
    [(1.45e7, "1.45 Cr"), (1e7, "1.00 Cr"), (9999999.0, "100.00 L"), (5e5, "5.00 L"), (99999.0, "100.00 K"), (0.0, "0.00 K")],
)
def test_price_label(spark, amount, label):
    assert one(spark, price_label(F.lit(amount))) == label


def test_price_label_rounds_as_printf(spark):
    amounts = [6553500.0, 12500.0, 112500.0, 1234567.0, 87654321.0, 250.0, 1125.0]
    rows = spark.createDataFrame([(a,) for a in amounts], "a double").select("a", price_label(F.col("a")).alias("x"))
    for a, x in rows.collect():
        by, unit = (1e7, "Cr") if a >= 1e7 else (1e5, "L") if a >= 1e5 else (1e3, "K")
        assert x == f"{a / by:.2f} {unit}"


@pytest.mark.parametrize(
    ("text", "number"), [("12", 12.0), (" 1e3 ", 1000.0), ("NA", None), ("", None), ("NaN", None), ("12d", None), ("5f", None)]
)
def test_to_number(spark, text, number):
    assert one(spark, to_number(F.lit(text))) == number


@pytest.mark.parametrize(("x", "y"), [(0.125, 0.12), (0.375, 0.38), (-0.125, -0.12), (2.0 / 3, 0.67), (1e15, 1e15)])
def test_round2(spark, x, y):
    assert one(spark, round2(F.lit(x))) == y
