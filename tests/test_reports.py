import glob
import json
import time

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from checks import registry
from checks.compare import canonical, connect
from deedmill.operators.levels import CITY, LOCATION, PROJECT, Level
from deedmill.operators import percentiles
from deedmill.plans import report
from deedmill.plans.jobs import side_by_side
from deedmill.sources import sinks, star
from deedmill.sources.staging import shared_folder
from deedmill.sources.transactions import list_cities, load_transactions, range_predicates

TINY = "/root/testdata/sf0.001"
SAMPLE = ["load_city", "buyer_ages", "derived_columns", "avg_carpet_bhk", "rate_sa_pt", "area_pt_avg_sales", "price_bhk",
          "pincode_stats", "da_registered", "report_union", "fuzzy_labels", "normalize_labels", "floor_p90_rate", "prevailing_rate"]


@pytest.fixture(scope="module")
def sql():
    return connect(TINY)


@pytest.mark.parametrize("name", SAMPLE)
def test_query_matches_sql(spark, sql, name):
    got = entry.queries()[name](spark, TINY).toPandas()
    want = sql.execute(entry.oracle_sql()[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert canonical(got) == canonical(want)


def test_entry_and_names(spark):
    out = entry.entry(spark)
    assert {"Type", "Period", "proj_id", "flat_sold_igr", "2br_sold_igr", "pincode_stats"} <= set(out.columns)
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_wide_equals_long(spark):
    df = registry.prepared(spark, TINY, *report.COLUMNS).cache()
    wide = {r["city_id"]: r for r in report.wide_report(df, CITY, "Overall").collect()}
    long = report.long_report(df, CITY).filter("grain = 'Overall'").collect()
    names = report.wide_columns(report.segment_labels(report.report_cells(df, CITY, grains=["Overall"])))
    seen = 0
    for r in long:
        name, kind, nested = names[r.kind, r.segment, r.metric]
        cell = wide[r.key_id][name]
        if nested:
            assert json.loads(cell)[r.bucket] == pytest.approx(r.value)
        else:
            assert cell == (r.text if kind == report.TEXT else r.value)
        seen += 1
    assert seen > 1000
    df.unpersist()


def test_bedroom_order():
    names = [f"{b}_sold_igr" for b in ("2br", "<1br", ">3br", "1.5br", "4br", "1br")] + ["total", "1br_total_agreement_price"]
    assert report.bedroom_order(names) == [
        "total", "<1br_sold_igr", "1br_sold_igr", "1br_total_agreement_price", "1.5br_sold_igr", "2br_sold_igr", ">3br_sold_igr", "4br_sold_igr",
    ]


def test_names_that_clash_are_kept_apart():
    names = report.wide_columns({"property_type": ["Flat", "FLAT"], "bhk_br": ["Flat"]})
    columns = [n for n, _, _ in names.values()]
    assert len(columns) == len(set(columns))
    assert names["bhk_br", "Flat", "sold_igr"][0] == "flat_sold_igr_bhk"
    assert {names["property_type", s, "sold_igr"][0] for s in ("Flat", "FLAT")} == {"flat_sold_igr", "flat_sold_igr_2"}


def test_stack_and_blank(spark):
    a = spark.createDataFrame([(1, 0.0)], "k int, x double")
    b = spark.createDataFrame([(2, "q")], "k int, y string")
    rows = report.stack([report.blank_zeros(a, ["x"]), b]).orderBy("k").collect()
    assert [tuple(r) for r in rows] == [(1, None, None), (2, None, "q")]


def test_load_transactions(spark):
    table = star.transactions(spark, TINY, ["document_no", "city_id"])
    cities = star.cities(spark, TINY)
    assert [r.city_name for r in list_cities(cities).collect()] == ["Dubai", "Mumbai", "Nagpur", "Pune", "Thane"]
    with pytest.warns(UserWarning, match="agreement_price"):
        some = load_transactions(table, cities, ["Pune"])
    assert {r.city for r in some.select("city").distinct().collect()} == {"Pune"}
    with pytest.warns(UserWarning):
        assert load_transactions(table, cities).count() == table.count()


@pytest.mark.parametrize("low, high, slices", [(0, 100, 4), (0, 2, 16), (5, 5, 3), (1, 9, 1)])
def test_database_slices_take_every_row_once(spark, low, high, slices):
    conditions = range_predicates("k", low, high, slices)
    df = spark.createDataFrame([(k,) for k in [None, *range(-5, 110)]], "k int")
    assert sum(df.filter(c).count() for c in conditions) == 116 and len(conditions) <= slices


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([(1, "a")], "k int, `1.5br_x` string").withColumn("m", F.create_map(F.lit("b"), F.lit(1.0)))
    assert sinks.save_report(df, str(tmp_path / "p")) == "parquet"
    assert spark.read.parquet(str(tmp_path / "p")).columns == df.columns
    assert sinks.save_report(df, str(tmp_path / "c"), "csv") == "csv"
    assert spark.read.csv(str(tmp_path / "c"), header=True).first().m == '{"b":1.0}'
    with pytest.raises(ValueError):
        sinks.save_report(df, str(tmp_path / "x"), "xlsx")


def test_labels_of_other_rows_make_no_columns(spark):
    df = registry.prepared(spark, TINY, *report.COLUMNS).filter("city_id = 1")
    leased = df.limit(3).withColumns({"property_category": F.lit("Lease"), "property_type": F.lit("Barn"), "bhk_br": F.lit("9Br")})
    wide = report.wide_report(df.unionByName(leased), PROJECT, "Overall")
    assert not [c for c in wide.columns if c.startswith(("barn_", "9br_"))]
    assert any(c.startswith("flat_") for c in wide.columns)


def test_own_levels_keep_their_names(spark):
    df = registry.prepared(spark, TINY, *registry.KEYS, *registry.PRICES, "property_type", "location_id")
    own = Level("micro", "location_id", False, False, 0.855, 0.07)
    rates = percentiles.rate_percentiles(df, [own, CITY], ["rate_sa_pt"])
    seen = {(r.level, r.dist, r.kind) for r in rates.select("level", "dist", "kind").distinct().collect()}
    assert seen == {("micro", "rate_sa_pt", "property_type"), ("city", "rate_sa_pt", "property_type")}
    text = percentiles.with_prevailing(rates, [own, CITY]).filter("level = 'micro' AND grain = 'Overall'").first()
    assert text.most_prevailing_rate_range == f"{int(text.p85_5 * (1 - 0.07))}-{int(text.p85_5 * (1 + 0.07))}"


def test_run_reports(spark, tmp_path):
    df = registry.prepared(spark, TINY, *report.COLUMNS)
    staged = lambda: set(glob.glob(shared_folder(spark).removeprefix("file:") + "/stages-*/rows"))
    before = staged()
    out = report.run_reports(df, str(tmp_path / "out"), levels=[CITY], grains=["Overall", "YoY"])
    rows = spark.read.parquet(out["city"])
    assert {r.Type for r in rows.select("Type").distinct().collect()} == {"Overall", "YoY"}
    assert rows.filter("Type = 'Overall'").count() == 5 and "year" in rows.columns
    assert PROJECT.name not in out
    assert [r.Type for r in rows.collect()] == sorted(r.Type for r in rows.collect())
    assert staged() == before


def test_one_failing_level_leaves_the_others(spark, tmp_path):
    df = registry.prepared(spark, TINY, *report.COLUMNS).withColumn("ward", F.col("location"))
    ward = Level("ward", "ward", False, False, 0.80, 0.10)  # texts that are no numbers
    with pytest.raises(report.ReportsFailed, match="ward") as caught:
        report.run_reports(df, str(tmp_path / "out"), levels=[ward, CITY], grains=["Overall"])
    assert set(caught.value.written) == {"city"} and set(caught.value.failed) == {"ward"}
    assert "report of level 'ward'" in caught.value.failed["ward"].__notes__
    assert spark.read.parquet(caught.value.written["city"]).count() == 5
    assert not (tmp_path / "out" / "ward").exists() or not list((tmp_path / "out" / "ward").glob("*.parquet"))


def test_jobs_fail_and_stop_alone(spark):
    def slow():
        return spark.range(4).repartition(4).mapInArrow(sleeping, "id long").count()

    def sleeping(batches):
        time.sleep(60)
        yield from batches

    start = time.monotonic()
    done, failed = side_by_side(spark, {"quick": lambda: spark.range(3).count(), "bad": lambda: 1 // 0, "slow": slow}, timeout=8)
    assert done == {"quick": 3} and set(failed) == {"bad", "slow"}
    assert isinstance(failed["bad"], ZeroDivisionError) and "cancel" in str(failed["slow"]).lower()
    assert 8 <= time.monotonic() - start < 40
    assert spark.range(5).count() == 5 and not spark.sparkContext.getJobTags()


def test_reports_of_all_levels_at_once_equal_single_ones(spark, tmp_path):
    df = registry.prepared(spark, TINY, *report.COLUMNS).cache()
    out = report.run_reports(df, str(tmp_path / "out"))
    for level, grain in ((LOCATION, "QoQ"),):
        one = report.wide_report(df, level, grain)
        both = spark.read.parquet(out[level.name]).filter(F.col("Type") == grain).select(*[f"`{c}`" for c in one.columns])
        assert sorted(map(str, both.collect())) == sorted(map(str, one.collect()))
    df.unpersist()


def test_long_reports_shuffle_a_family_of_small_keys_once(spark):
    df = registry.prepared(spark, TINY, *report.COLUMNS)
    plan = report.long_report(df, PROJECT, grains=["YoY"])._jdf.queryExecution().executedPlan().toString()
    # By key, for totals, rates and four distributions; nothing that is grouped by the constant level shuffles again.
    assert plan.count("REPARTITION_BY_NUM") == 6
    assert "hashpartitioning(project" not in plan and "grain#" not in "".join(x for x in plan.splitlines() if "Exchange" in x)


def test_cells_meet_without_a_further_shuffle(spark):
    df = registry.prepared(spark, TINY, *report.COLUMNS)
    plan = report.report_cells(df, PROJECT, grains=["YoY"])._jdf.queryExecution().executedPlan().toString().splitlines()
    union = next(i for i, line in enumerate(plan) if line.strip(" :+-") == "Union")
    assert not [line for line in plan[:union] if "Exchange" in line]


def test_cells_are_laid_out_in_slices(spark, monkeypatch):
    df = registry.prepared(spark, TINY, *report.COLUMNS).cache()
    whole = report.wide_report(df, PROJECT, "YoY").collect()
    monkeypatch.setattr(report, "LAID", 7)
    assert report.wide_report(df, PROJECT, "YoY").collect() == whole
    df.unpersist()


def test_layout_of_cells():
    kind = pa.list_(pa.struct([("name", pa.string()), ("bucket", pa.string()), ("cell", pa.string())]))
    rows = pa.array(
        [[("d", "b", "2"), ("n", None, "3.0"), ("d", "a", "1"), ("x", None, "9")], None, [], [("t", None, "q"), ("d", "c", "5")]],
        kind,
    )
    found = {"n": ("count", pa.int64()), "d": ("dist", pa.string()), "t": ("text", pa.string()), "o": ("other", pa.float64())}
    out = {name: column.to_pylist() for name, column in report.laid_out(rows, found, {"dist"}).items()}
    assert out == {
        "count": [3, None, None, None], "dist": ['{"a": 1, "b": 2}', None, None, '{"c": 5}'], "text": [None, None, None, "q"], "other": [None] * 4,
    }
    later = report.laid_out(rows.slice(3), found, {"dist"})
    assert later["dist"].to_pylist() == ['{"c": 5}']
