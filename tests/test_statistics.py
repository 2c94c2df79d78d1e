import math
from decimal import Decimal

import numpy as np
import pandas as pd
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from deedmill.config import DEFAULTS
from deedmill.functions import bins
from deedmill.functions.values import round2
from deedmill.operators import buyers, callbacks, fuzzy, levels, percentiles, ranges, specs, totals
from deedmill.operators.levels import CITY, LOCATION, PROJECT

SCHEMA = (
    "document_no string, city string, city_id int, loc_id int, proj_id long, manual_processed string, property_category string, "
    "transaction_type string, property_type string, bhk_br string, property_type_raw string, project_type string, year int, quarter string, "
    "net_carpet_area_sqmt double, carpet_sqft double, agreement_price double, rate_on_net_ca double, rate_on_sa double, "
    "floor_no double, age array<int>, buyer_pincode double, transaction_date string"
)


def row(i=0, **changes):
    base = dict(document_no=f"d{i}", city="Thane", city_id=3, loc_id=1, proj_id=1, manual_processed="Yes", property_category="Sale",
                transaction_type="Sale", property_type="Flat", bhk_br="2Br", property_type_raw="Flat", project_type="Residential", year=2020,
                quarter="2020-Q1", net_carpet_area_sqmt=50.0, carpet_sqft=538.2, agreement_price=5e6, rate_on_net_ca=9000.0, rate_on_sa=9000.0,
                floor_no=1.0, age=[30], buyer_pincode=400001.0, transaction_date="2020-01-01")
    return {**base, **changes}


def frame(spark, rows):
    return spark.createDataFrame([tuple(r.values()) for r in rows], SCHEMA)


def buckets(spark, block, column, values, level, **more):
    df = frame(spark, [row(i, **{column: v}, **more) for i, v in enumerate(values)])
    table = ranges.range_table(ranges.range_cells(df, [block], [level]), [level], blocks=[block])
    table = table.filter("grain = 'Overall' AND kind = 'property_type' AND NOT priced")
    return {r.bucket: r.unit_sold for r in table.collect()}


def test_fixed_area_edges(spark):
    got = buckets(spark, "area", "carpet_sqft", [199.9, 200.0, 4500.0, 4599.0, 4600.0], LOCATION)
    assert got == {"200-400": 1, "4400-4600": 2}


def test_fixed_rate_edges(spark):
    got = buckets(spark, "rate", "rate_on_net_ca", [1999.0, 2000.0, 39999.0, 40000.0], CITY)
    assert got == {"<2000": 1, "2000-3000": 1, "39000-40000": 1, ">40000": 1}


def test_fixed_price_edges(spark):
    values = [499999.0, 500000.0, 2500000.0, 2500001.0, 15000000.0, 15000001.0]
    got = buckets(spark, "price", "agreement_price", values, CITY, city="Pune")
    assert got == {"< 5.00 L": 1, "5.00 L - 25.00 L": 2, "25.00 L - 45.00 L": 1, "1.45 Cr - 1.65 Cr": 1, "> 1.50 Cr": 1}


def test_age_edges(spark):
    df = frame(spark, [row(0, age=[24, 25, 54]), row(1, age=[55]), row(2, age=[])])
    table = ranges.range_table(ranges.range_cells(df, ["age"], [PROJECT]), [PROJECT], blocks=["age"])
    got = {r.bucket: (r.unit_sold, r.total_sales) for r in table.filter("grain = 'YoY' AND kind = 'bhk_br'").collect()}
    assert got == {"<25": (1, 5e6), "25-30": (1, 5e6), "50-55": (1, 5e6), ">55": (1, 5e6)}


def reference_cut(values, edges):
    labels = [f"<{edges[0]}", *[f"{a}-{b}" for a, b in zip(edges, edges[1:])], f">{edges[-1]}"]
    cut = pd.cut(pd.Series(values), [-math.inf, *edges, math.inf], right=False, labels=labels)
    return {k: v for k, v in cut.value_counts().to_dict().items() if v}


def price_numbers(values, low, high, step):
    """Numbers of closed price buckets by a table of their edges; None below and above."""
    edges = np.arange(low, high + 2 * step, step)
    at = np.maximum(np.searchsorted(edges, values, side="left") - 1, 0)
    return [None if v < low or v > high else int(i) for v, i in zip(values, at, strict=True)]


def test_mean_bins_match_pandas(spark):
    rng = np.random.default_rng(7)
    area = [float(x) for x in rng.gamma(4, 200, 300)]
    m = int(round(np.mean(area), -2))
    assert buckets(spark, "area", "carpet_sqft", area, PROJECT) == reference_cut(area, [m + 200 * o for o in range(-2, 3)])
    rate = [float(x) for x in rng.gamma(4, 3000, 300)] + [9000.0, 12000.0]
    m = int(round(np.mean(rate) / 1000) * 1000)
    assert buckets(spark, "rate", "rate_on_net_ca", rate, PROJECT) == reference_cut(rate, [m + 1000 * o for o in range(-3, 4)])
    price = [1e6, 4e6, 8e6, 8_000_001.0, 1.2e7, 1.6e7, 16_000_001.0, 2e7, 2.3e7]
    # The mean is 12 million within a step.
    assert round(np.mean(price) / 2e6) * 2_000_000 == 12_000_000
    assert buckets(spark, "price", "agreement_price", price, PROJECT) == {
        "< 80.00 L": 2, "80.00 L - 1.00 Cr": 2, "1.00 Cr - 1.20 Cr": 1, "1.40 Cr - 1.60 Cr": 1, "> 1.60 Cr": 3,
    }


def test_priced_rows_have_their_own_mean(spark):
    rows = [row(0, carpet_sqft=300.0, agreement_price=None), row(1, carpet_sqft=5000.0), row(2, carpet_sqft=5100.0)]
    table = ranges.range_table(ranges.range_cells(frame(spark, rows), ["area"], [PROJECT]), [PROJECT], blocks=["area"])
    table = table.filter("grain = 'Overall' AND kind = 'property_type'")
    got = {(r.priced, r.bucket): r.unit_sold for r in table.collect()}
    assert got == {(False, "<3100"): 1, (False, ">3900"): 2, (True, "5000-5200"): 2}


@settings(max_examples=8, deadline=None)
@given(st.lists(st.integers(0, 60_000_000), min_size=1, max_size=50), st.sampled_from([(500_000, 15_000_000), (200_000, 10_000_000), (500_000, 50_000_000)]))
def test_price_bucket_numbers(spark, values, bounds):
    low, high = bounds
    step = 2_000_000
    values += [low - 1, low, low + step, low + step + 1, high, high + 1]
    df = spark.createDataFrame([(i, float(v)) for i, v in enumerate(values)], "i int, v double")
    number = bins.fixed_price(F.col("v"), F.lit(low), F.lit(high), step)
    got = [r[0] for r in df.orderBy("i").select(number).collect()]
    assert [None if abs(n) == bins.HIGH else n for n in got] == price_numbers(values, low, high, step)


@pytest.mark.parametrize("cells", [1, 4096])
def test_percentiles_match_numpy(spark, cells, monkeypatch):
    monkeypatch.setattr(percentiles, "CELLS_PER_OCTAVE", cells)
    rng = np.random.default_rng(3)
    data = {"hot": rng.lognormal(9, 0.5, 5000), "dup": rng.integers(0, 5, 400).astype(float), "one": np.array([4.2]),
            "two": np.array([1.0, 9.0]), "neg": rng.normal(0, 50, 301)}
    rows = [(k, None if k == "dup" else 1, float(v)) for k, vs in data.items() for v in vs] + [("hot", 1, None)]
    df = spark.createDataFrame(rows, "k string, z int, v double").repartition(5)
    ps = {"a": 0.5, "b": 0.75, "c": 0.8, "d": 0.9, "e": 0.0, "f": 1.0}
    got = {r.k: r for r in percentiles.exact_percentiles(df, ["k", "z"], "v", ps, "mean").collect()}
    assert set(got) == set(data)
    for k, vs in data.items():
        assert got[k].n == len(vs)
        assert got[k]["mean"] == pytest.approx(vs.mean())
        for name, p in ps.items():
            assert got[k][name] == pytest.approx(np.quantile(vs, p), rel=1e-12, abs=1e-12)


@pytest.mark.parametrize(("gathered", "cells"), [(300_000, 32), (100, 1), (0, 32)])
def test_rates_of_small_and_large_keys(spark, gathered, cells, monkeypatch):
    """Small keys are ranked where one shuffle put them, large ones by cells; both as numpy does."""
    monkeypatch.setattr(percentiles, "GATHERED", gathered)
    monkeypatch.setattr(percentiles, "CELLS_PER_OCTAVE", cells)
    rng = np.random.default_rng(5)
    rows = [row(i, proj_id=0 if i % 2 else i % 40, year=2020 + i % 3, quarter=None if i % 9 == 0 else "2020-Q1", floor_no=float(i % 7),
                rate_on_net_ca=float(rng.integers(1, 300)), rate_on_sa=None if i % 5 == 0 else float(i)) for i in range(600)]
    df = frame(spark, rows).repartition(3)
    out = percentiles.rate_percentiles(df, [PROJECT, CITY])
    want, table = {}, pd.DataFrame(rows)
    spans = {"Overall": lambda t: t.year * 0, "YoY": lambda t: t.year, "QoQ": lambda t: t.quarter}
    for (level, key), (grain, span), (dist, value) in [
        (a, b, c) for a in (("project", "proj_id"), ("city", "city_id")) for b in spans.items()
        for c in (("rate_nca_pt", "rate_on_net_ca"), ("rate_sa_pt", "rate_on_sa"), ("rate_nca_bhk", "rate_on_net_ca"), ("floor_pt", "rate_on_net_ca"))
    ]:
        t = table.dropna(subset=[value]).assign(span=span, floor=(table.floor_no // 5 * 5) if dist == "floor_pt" else -1)
        for k, g in t.groupby([key, "span", "floor"]):
            period = "Overall" if grain == "Overall" else str(k[1])
            want[level, k[0], grain, period, dist, int(k[2])] = (len(g), *np.quantile(g[value], [0.5, 0.75, 0.9]), g[value].mean())
    got = {(r.level, r.key_id, r.grain, r.period, r.dist, -1 if r.floor_from is None else r.floor_from): (r.n, r.p50, r.p75, r.p90, r["mean"]) for r in out.collect()}
    assert set(got) == set(want)
    for k, values in want.items():
        assert got[k] == pytest.approx(values)


def test_prevailing_floor_and_chart_rates(spark):
    rates = [10.0, 20.0, 35.0, 47.0, 90.0, 91.5, 120.0]
    floors = [0.0, 4.0, 5.0, None, -1.0, 7.0, 23.0]
    df = frame(spark, [row(i, rate_on_net_ca=r, floor_no=f) for i, (r, f) in enumerate(zip(rates, floors))])
    out = percentiles.rate_percentiles(df, [CITY]).filter("grain = 'QoQ'").cache()
    assert percentiles.prevailing_rates(out, [CITY]).first().most_prevailing_rate_range == "82-100"
    assert {r.bucket: r.value for r in percentiles.floor_wise_p90(out).collect()} == {"0-5": 19.0, "5-10": 85.85, "20-25": 120.0}
    assert percentiles.chart_p90(out).first().p90_rate == pytest.approx(102.9)


def test_null_keys_drop_out_of_their_level_and_grain(spark):
    rows = [row(0), row(1, proj_id=None), row(2, loc_id=None), row(3, year=None), row(4, manual_processed="No"), row(5, property_type=None),
            row(6, property_category="Lease", agreement_price=None)]
    df = frame(spark, rows)
    got = {(r.level, r.grain): r.total_transactions for level in levels.LEVELS for r in totals_of(df, level)}
    assert got["project", "Overall"] == 4 and got["project", "YoY"] == 3
    assert got["location", "Overall"] == 5 and got["city", "Overall"] == 6
    pt = totals.segment_totals(df, [CITY], ["property_type"]).filter("grain = 'Overall'").collect()
    assert [(r.segment, r.sold_igr) for r in pt] == [("Flat", 5)]


def totals_of(df, level):
    missing = {"index": 1, "project_name": "p", "location": "l", "location_id": 1, "project_lat": 1.0, "project_lng": 1.0,
               "location_lat": 1.0, "location_lng": 1.0}
    df = df.withColumns({k: F.lit(v) for k, v in missing.items()})
    return totals.base_totals(df, level).collect()


def test_first_values_skip_nulls(spark):
    rows = [row(1), row(2), row(3)]
    df = frame(spark, rows).withColumns(
        {
            "location": F.when(F.col("document_no") == "d1", None).otherwise(F.col("document_no")),
            "location_lat": F.lit(1.0),
            "location_lng": F.lit(2.0),
        }
    )
    assert {r.location for r in totals.base_totals(df, LOCATION).collect()} == {"d2"}


@pytest.mark.parametrize(
    ("types", "label"),
    [(["Residential", "Commercial", "Other"], "Residential + Commercial"), (["Other"], "Other"), (["Commercial", None], "Commercial")],
)
def test_project_type_label(spark, types, label):
    df = frame(spark, [row(i, project_type=t) for i, t in enumerate(types)])
    assert totals_of(df, CITY)[0].project_type == label


def test_mean_carpet_takes_all_labels_only_for_projects(spark):
    df = frame(spark, [row(0), row(1, bhk_br="Shop", carpet_sqft=100.0)])
    out = totals.segment_totals(df, [PROJECT, CITY], ["bhk_br"]).filter("grain = 'Overall' AND avg_carpet_area_in_sqft IS NOT NULL")
    got = {(r.level, r.segment): r.avg_carpet_area_in_sqft for r in out.collect()}
    assert got == {("project", "2Br"): 538.2, ("project", "Shop"): 100.0, ("city", "2Br"): 538.2}


def test_development_agreements_need_sales(spark):
    deal = "Development Agreement"
    df = frame(spark, [row(0), row(1, transaction_type=deal, property_category="Other"), row(2, loc_id=2, transaction_type=deal, property_category="Lease")])
    got = {r.key_id: r.no_of_da_registered for r in totals.development_agreements(df, [LOCATION]).filter("grain = 'Overall'").collect()}
    assert got == {1: 1}


def test_pincode_share_counts_all_rows(spark):
    df = frame(spark, [row(0), row(1), row(2, buyer_pincode=400002.0), row(3, buyer_pincode=None)])
    got = {r.pincode: r.pct_of_total_transactions for r in buyers.pincode_stats(df, [CITY]).filter("grain = 'Overall'").collect()}
    assert got == {400001: 50.0, 400002: 25.0}


def test_top_pincodes_break_ties_by_pincode(spark):
    rows = [row(i, buyer_pincode=400000.0 + i % 14) for i in range(30)]
    got = buyers.top_pincodes(frame(spark, rows), 10, [CITY]).filter("grain = 'Overall'").orderBy("rank").collect()
    assert [r.pincode for r in got] == [400000, 400001, *range(400002, 400010)]
    assert [r["count"] for r in got] == [3, 3] + [2] * 8


def test_counts_of_buckets_add_up(spark):
    rng = np.random.default_rng(1)
    rows = [row(i, agreement_price=float(p)) for i, p in enumerate(rng.integers(1, 6_000_000, 200) * 10)]
    for level in levels.LEVELS:
        assert sum(buckets_of(spark, rows, level).values()) == 200


def buckets_of(spark, rows, level):
    table = ranges.range_table(ranges.range_cells(frame(spark, rows), ["price"], [level]), [level], blocks=["price"])
    return {r.bucket: r.unit_sold for r in table.filter("grain = 'Overall' AND kind = 'property_type'").collect()}


@pytest.mark.parametrize(("gathered", "block"), [(60, "area"), (0, "rate"), (300_000, "area")])
def test_ranges_of_small_and_large_keys(spark, gathered, block, monkeypatch):
    """Small keys are counted where one shuffle put them, large ones before they are shuffled; both alike."""
    monkeypatch.setattr(ranges, "GATHERED", gathered)
    rng = np.random.default_rng(2)
    rows = [row(i, proj_id=0 if i % 2 else i % 20, loc_id=None if i % 11 == 0 else i % 4, year=2020 + i % 2, quarter=None if i % 7 == 0 else "2020-Q1", age=[i % 60 + 20],
                agreement_price=None if i % 9 == 0 else float(rng.integers(1, 30_000_000)), carpet_sqft=float(rng.integers(100, 7000))) for i in range(300)]
    df = frame(spark, rows).repartition(3)
    want = ranges.range_table(ranges.range_cells(df, [block]), blocks=[block]).collect()
    assert sorted(map(str, ranges.range_tables(df, [block]).collect())) == sorted(map(str, want))
    some = ranges.range_tables(df, [block], grains=["YoY"]).collect()
    assert sorted(map(str, some)) == sorted(str(r) for r in want if r.grain == "YoY")


def test_grains_are_counted_alone(spark):
    df = frame(spark, [row(i, year=2020 + i % 3, quarter=f"2020-Q{i % 4 + 1}", buyer_pincode=400000.0 + i % 5) for i in range(40)])
    for function, levels_ in ((totals.segment_totals, [CITY, PROJECT]), (totals.label_counts, [CITY]), (totals.development_agreements, [CITY]), (buyers.pincode_stats, [CITY])):
        whole = function(df, levels_).collect()
        for grain in ("Overall", "QoQ"):
            some = function(df, levels_, grains=[grain]).collect()
            assert sorted(map(str, some)) == sorted(str(r) for r in whole if r.grain == grain)


def test_area_metric_rejects_unknown_names(spark):
    with pytest.raises(ValueError, match="median"):
        ranges.area_metric(spark.range(1), "median")


def test_callbacks_do_not_depend_on_partitions(spark):
    df = spark.range(5000).select((F.col("id") % 3).alias("k"), F.when(F.col("id") % 7 == 0, None).otherwise(F.lit("s")).alias("s"), F.col("id").cast("double").alias("v"))

    def partial(x):
        return pd.DataFrame({"n": [len(x)], "top": [x["v"].max()]})

    def merge(x):
        return pd.DataFrame({"n": [x["n"].sum()], "top": [x["top"].max()]})

    results = []
    for parts in (1, 9):
        out = callbacks.per_group(df.repartition(parts), ["k", "s"], ["v"], partial, merge, "n bigint, top double", salt=4)
        results.append(sorted((r.k, str(r.s), r.n, r.top) for r in out.collect()))
    want = df.groupBy("k", "s").agg(F.count(F.lit(1)).alias("n"), F.max("v").alias("top")).collect()
    assert results[0] == results[1] == sorted((r.k, str(r.s), r.n, r.top) for r in want)


@pytest.mark.parametrize("share_rows", [40, 200_000])
def test_callbacks_fold_a_group_once(spark, share_rows, monkeypatch):
    monkeypatch.setattr(callbacks, "SHARE_ROWS", share_rows)
    # 600 groups of 5 rows that are far apart in 12 partitions, and one group of 500 rows.
    df = spark.range(3500).select(F.when(F.col("id") < 3000, F.col("id") % 600).otherwise(-1).alias("k"), F.col("id").alias("v")).repartition(12)
    calls = spark.sparkContext.accumulator(0)

    def partial(x):
        calls.add(1)
        return pd.DataFrame({"n": [len(x)], "total": [x["v"].sum()]})

    def merge(x):
        return pd.DataFrame({"n": [x["n"].sum()], "total": [x["total"].sum()]})

    got = callbacks.per_group(df, ["k"], ["v"], partial, merge, "n bigint, total bigint").collect()
    want = df.groupBy("k").agg(F.count(F.lit(1)).alias("n"), F.sum("v").alias("total")).collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, want))
    assert 601 <= calls.value <= 650


def test_fuzzy_labels(spark):
    df = spark.createDataFrame([("Flat",), ("Flats",), ("House Row",), ("Xyzzy",), (None,)], "t string")
    known = ["Flat", "Row House", "Shop"]
    got = {r.label: (r.match, round(r.score, 1)) for r in fuzzy.closest_labels(df, "t", known).collect()}
    assert got["Flats"] == ("Flat", 88.9) and got["House Row"] == ("Row House", 100.0) and got["Xyzzy"][0] == "Others"
    assert sorted(str(r.t) for r in fuzzy.normalize_labels(df, "t", known).collect()) == ["Flat", "Flat", "None", "Others", "Row House"]


@settings(max_examples=6, deadline=None)
@given(st.lists(st.text("ab c🙂é", max_size=80), min_size=1, max_size=12), st.lists(st.text("ab c🙂é", max_size=80), min_size=1, max_size=6))
def test_fuzzy_scores(spark, names, known):
    """Scores against the textbook table of common subsequences."""

    def common(a, b):
        table = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                table[i + 1][j + 1] = table[i][j] + 1 if x == y else max(table[i][j + 1], table[i + 1][j])
        return table[-1][-1]

    known = list(dict.fromkeys(known))
    want = {}
    for name in set(names) - set(known):
        a, scores = " ".join(sorted(name.split())), []
        for k in known:
            b = " ".join(sorted(k.split()))
            scores.append(200 * common(a, b) / (len(a) + len(b)) if a or b else 100.0)
        want[name] = (known[scores.index(max(scores))] if max(scores) >= 80 else "Others", max(scores))
    got = fuzzy.closest_labels(spark.createDataFrame([(n,) for n in names], "t string"), "t", known).collect()
    assert {r.label: (r.match, pytest.approx(r.score)) for r in got} == want


def test_states_of_any_type(spark):
    df = spark.range(100).select((F.col("id") % 2).alias("k"), F.col("id").alias("v"))
    one = lambda x: pd.DataFrame({"total": [Decimal(int(x["v"].sum()))], "tags": [[{"a": 1}]]})
    both = lambda x: pd.DataFrame({"total": [sum(x["total"], Decimal(0))], "tags": [[{"a": 1}]]})
    out = callbacks.per_group(df, ["k"], ["v"], one, both, "total decimal(10,2), tags array<struct<a: int>>")
    assert {r.k: r.total for r in out.collect()} == {0: Decimal(2450), 1: Decimal(2500)}


def test_rounding_is_stable_under_noise(spark):
    x = spark.range(1).select(round2(F.lit(1062.945)).alias("a"), round2(F.lit(1062.9449999999999)).alias("b")).first()
    assert x.a == x.b == 1062.94


def test_bins_constants():
    assert bins.area_cell(DEFAULTS) == 100


@pytest.mark.parametrize("gathered", [0, 3, 10**6])
def test_specifications_of_small_and_large_keys(spark, gathered, monkeypatch):
    monkeypatch.setattr(ranges, "GATHERED", gathered)
    rows = [row(i, carpet_sqft=150.0 + 37 * (i % 9), agreement_price=1e6 * (i % 5) if i % 4 else None, proj_id=i % 3) for i in range(24)]
    chosen = [specs.RangeSpec("mean", "area", 200), specs.RangeSpec("priced", "area", 100, priced=True), specs.RangeSpec("fixed", "area", 100, specs.FIXED, 200, 400)]
    out = specs.range_stats(frame(spark, rows), chosen, [PROJECT]).filter("grain = 'Overall' AND kind = 'property_type'").collect()
    sold = {name: sum(r.unit_sold for r in out if r.spec == name) for name in ("mean", "priced", "fixed")}
    assert sold["mean"] == 24 and sold["priced"] == sum(bool(r["agreement_price"]) for r in rows)
    assert sold["fixed"] == sum(200 <= r["carpet_sqft"] < 400 for r in rows)


def test_specifications_of_one_level_shuffle_once(spark):
    df = frame(spark, [row(i) for i in range(4)])
    plan = specs.range_stats(df, [specs.RangeSpec("mean", "area", 200)], [PROJECT])._jdf.queryExecution().executedPlan().toString()
    assert [line.strip(" :+-*0123456789()") for line in plan.splitlines() if "Exchange" in line and "REPARTITION_BY_NUM" not in line] == []
