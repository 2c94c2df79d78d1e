import pytest
from pyspark.errors import PySparkException

from checks.registry import bhk_labels, property_labels
from deedmill.config import CityParams, Settings
from deedmill.operators import prepare
from deedmill.sources.labels import clean_label_map, read_label_sheet

SCHEMA = (
    "document_no string, city string, property_category string, property_type string, property_type_raw string, "
    "project_type string, bhk_br string, net_carpet_area_sqmt double, agreement_price string, floor_no string, "
    "purchaser_name string, buyer_pincode string"
)


def row(**changes):
    base = dict(document_no="d", city="Pune", property_category="Sale", property_type="Flat", property_type_raw="Flat",
                project_type="Residential", bhk_br="2 bhk", net_carpet_area_sqmt=100.0, agreement_price="1000000",
                floor_no="5", purchaser_name=None, buyer_pincode="400001")
    return {**base, **changes}


def run(spark, *rows, settings=None):
    df = spark.createDataFrame([tuple(r.values()) for r in rows], SCHEMA)
    return prepare.prepare(df, bhk_labels(spark), property_labels(spark), settings or Settings()).collect()


def test_measures(spark):
    (r,) = run(spark, row())
    assert r.carpet_sqft == pytest.approx(1076.4)
    assert r.saleable_sqft == pytest.approx(135.0)
    assert r.rate_on_net_ca == pytest.approx(1e6 / 1076.4)
    assert r.rate_on_sa == pytest.approx(1e6 / 135)
    assert (r.floor_no, r.bhk_br, r.property_type_raw, r.buyer_pincode, r.age) == (5.0, "2Br", "Flat", 400001.0, [])


def test_blank_junk_and_other_categories(spark):
    zero, junk, lease = run(
        spark,
        row(net_carpet_area_sqmt=0.0),
        row(agreement_price="NA", buyer_pincode="N/A", bhk_br="9 bhk", property_type_raw=None),
        row(property_category="Lease"),
    )
    assert (zero.carpet_sqft, zero.saleable_sqft, zero.rate_on_net_ca) == (None, None, None)
    assert (junk.agreement_price, junk.buyer_pincode, junk.bhk_br, junk.property_type_raw) == (None, None, None, "Others")
    assert (lease.agreement_price, lease.rate_on_sa) == (None, None)


def test_nan_is_missing(spark):
    (r,) = run(spark, row(net_carpet_area_sqmt=float("nan")))
    assert r.net_carpet_area_sqmt is None and r.carpet_sqft is None


@pytest.mark.parametrize(("name", "floor"), [("Ground", 0.0), ("Terrace", None), ("Terrace Floor", 0.0), ("4 & 5", 4.0), ("-1", -1.0), (None, None)])
def test_floors(spark, name, floor):
    assert run(spark, row(floor_no=name))[0].floor_no == floor


def test_unknown_floor_fails(spark):
    with pytest.raises(PySparkException, match="unknown floor: Attic"):
        run(spark, row(floor_no="Attic"))


def test_project_type_takes_the_label_as_entered(spark):
    rows = run(spark, row(project_type=" ", property_type_raw="Flat"), row(project_type=None, property_type_raw="SHOP"), row(project_type="X"))
    assert [r.project_type for r in rows] == ["Residential", "Other", "X"]


def test_loading_rules(spark):
    other = row(property_type="Others", city="Nowhere")
    assert run(spark, other)[0].saleable_sqft == pytest.approx(135.0)
    assert run(spark, other, settings=Settings(residential_rule="types"))[0].saleable_sqft == pytest.approx(140.0)
    assert run(spark, other, settings=Settings(saleable_unit="sqft"))[0].saleable_sqft == pytest.approx(135.0 * 10.764)


def test_unmapped_type_fails_and_is_listed(spark):
    with pytest.raises(PySparkException, match="unmapped property type: Warehouse"):
        run(spark, row(property_type_raw="warehouse"))
    df = spark.createDataFrame([("zoo",), ("flat ",), (" warehouse",), ("",)], "property_type_raw string")
    with pytest.raises(ValueError, match=r"\['Warehouse', 'Zoo'\]"):
        prepare.check_property_types(df, property_labels(spark))


def test_missing_columns_become_null(spark):
    df = spark.createDataFrame([("d", "Pune", "Sale")], "Document_No string, City string, Property_Category string")
    (r,) = prepare.prepare(df, bhk_labels(spark), property_labels(spark)).collect()
    assert (r.document_no, r.age, r.carpet_sqft, r.floor_no, r.project_type) == ("d", [], None, None, "Other")


def test_label_map_keeps_the_last_new_value(spark):
    df = spark.createDataFrame([(1, " 2bhk", "2br"), (2, "2BHK ", "two br"), (3, "2bhk", "2Br")], "line int, k string, v string")
    assert [tuple(r) for r in clean_label_map(df, "k", "v", "line").collect()] == [("2Bhk", "Two Br")]


def test_label_sheet_from_csv(spark, tmp_path):
    path = tmp_path / "labels.csv"
    path.write_text("BHK,standard_label,note\n1 bhk,1br,x\n 1 BHK ,1Br,y\n>3 bhk,>3br,z\n")
    rows = read_label_sheet(spark, str(path), "BHK", "standard_label").orderBy("BHK").collect()
    assert [tuple(r) for r in rows] == [("1 Bhk", "1Br"), (">3 Bhk", ">3Br")]


def test_label_sheets_of_a_folder_count_in_order_of_their_names(spark, tmp_path):
    (tmp_path / "a.csv").write_text("BHK,standard_label\n1 bhk,first\n" + "9 bhk,x\n" * 5000)
    (tmp_path / "b.csv").write_text("BHK,standard_label\n1 bhk,last\n")
    rows = read_label_sheet(spark, str(tmp_path), "BHK", "standard_label").orderBy("BHK").collect()
    assert [tuple(r) for r in rows] == [("1 Bhk", "Last"), ("9 Bhk", "X")]


def test_lookups_never_multiply_rows(spark):
    twice = spark.createDataFrame([("1 bhk", "1Br"), ("1 BHK ", "1Br"), (None, "x")], "BHK string, standard_label string")
    df = spark.createDataFrame([("1 Bhk",)], "bhk_br string")
    assert [tuple(r) for r in prepare.map_bedrooms(df, twice).collect()] == [("1Br",)]
    clash = spark.createDataFrame([("1 bhk", "1Br"), ("1 BHK ", "2Br")], "BHK string, standard_label string")
    with pytest.raises(PySparkException, match="two labels for"):
        prepare.map_bedrooms(df, clash).collect()


def test_settings_are_checked():
    with pytest.raises(ValueError, match="min_area must be less"):
        Settings(cities={"X": CityParams(min_area=500, max_area=500)})
    with pytest.raises(ValueError, match="residential_rule"):
        Settings(residential_rule="?")
