"""One query per operator, each over the whole derived transactions."""

from __future__ import annotations

import uuid
from collections.abc import Callable

import pandas as pd
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from deedmill.config import DEFAULTS, PARAM_COLUMNS
from deedmill.functions.local import local_table
from deedmill.functions.values import buyer_ages, price_label, round2, to_number
from deedmill.operators import buyers, callbacks, fuzzy, keys, levels, percentiles, prepare, ranges, specs, totals
from deedmill.operators.levels import BEDROOM, CITY, LEVELS, LOCATION, PERIOD_KEY, PROJECT, PROPERTY, SEGMENT_KEY
from deedmill.plans import report
from deedmill.sources import labels, reconcile, star
from deedmill.sources import transactions as source
from deedmill.sources.staging import Stages, shared_folder

import pyarrow as pa

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

KEYS = ["city", "city_id", "loc_id", "proj_id", "manual_processed", "property_category", "year", "quarter"]
PRICES = ["agreement_price", "net_carpet_area_sqmt", "carpet_sqft", "rate_on_net_ca", "rate_on_sa"]
SEGMENTS = ["property_type", "bhk_br"]
# Derived column -> raw columns it is made of, beyond itself
RAW = {
    "carpet_sqft": ["net_carpet_area_sqmt"],
    "saleable_sqft": ["net_carpet_area_sqmt", "property_type"],
    "rate_on_net_ca": ["agreement_price", "net_carpet_area_sqmt"],
    "rate_on_sa": ["agreement_price", "net_carpet_area_sqmt", "property_type"],
    "age": ["purchaser_name"],
    "project_type": ["property_type_raw"],
}


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def bhk_labels(spark: SparkSession) -> DataFrame:
    columns = {"BHK": list(star.BHK_LABELS), "standard_label": list(star.BHK_LABELS.values())}
    return local_table(spark, columns, dict.fromkeys(columns, pa.string()))


def property_labels(spark: SparkSession) -> DataFrame:
    columns = {
        "property_type_raw": list(star.PROPERTY_LABELS),
        "property_type_refined": list(star.PROPERTY_LABELS.values()),
    }
    return local_table(spark, columns, dict.fromkeys(columns, pa.string()))


def raw(spark: SparkSession, directory: str, *columns: str) -> DataFrame:
    return star.transactions(spark, directory, columns or None)


def prepared(spark: SparkSession, directory: str, *columns: str) -> DataFrame:
    """Prepared transactions with the named columns only."""
    needed = dict.fromkeys([*columns, "city", "property_category"])
    inputs = dict.fromkeys(c for name in needed for c in [name, *RAW.get(name, [])] if c in star.EXPRESSIONS)
    return prepare.prepare(
        raw(spark, directory, *inputs), bhk_labels(spark), property_labels(spark), DEFAULTS, [*needed]
    )


# --- sources and lookups ----------------------------------------------------------------------


@query
def city_list(spark, d):
    return source.list_cities(star.cities(spark, d))


@query
def load_city(spark, d):
    table = raw(spark, d).drop("city")
    out = source.load_transactions(table, star.cities(spark, d), ["Pune", "Dubai"])
    return out.select("document_no", "city_id", "city", "proj_id", "property_category", "agreement_price", "year")


def _sheet(spark: SparkSession, d: str, key: str, key_sql: str, value: str, value_sql: str) -> DataFrame:
    """A lookup sheet with one line per part, so with many repeats."""
    return spark.read.parquet(f"{d}/part.parquet").selectExpr(
        f"{key_sql} AS {key}", f"{value_sql} AS {value}", "p_partkey AS line"
    )


@query
def stacked_loads(spark, d):
    """Loads of three cities whose schemas differ: a widened number, a clash of types, a missing column, other cases."""
    table = raw(spark, d, "document_no", "city_id", "city", "index", "net_carpet_area_sqmt", "agreement_price", "year")
    pune = table.filter("city = 'Pune'").withColumn("agreement_price", F.col("agreement_price").try_cast("double")).withColumnRenamed("year", "YEAR")
    thane = table.filter("city = 'Thane'").withColumn("net_carpet_area_sqmt", F.col("net_carpet_area_sqmt").cast("int")).drop("year")
    dubai = table.filter("city = 'Dubai'").withColumns({"index": F.col("index").cast("int"), "year": F.col("year").cast("bigint")})
    stacked, _ = reconcile.reconcile({"pune": pune, "thane": thane, "dubai": dubai})
    # The clash made texts of the prices, in two notations.
    return stacked.withColumn("agreement_price", to_number(F.col("agreement_price")))


@query
def load_audit(spark, d):
    """What a load's own pass counted: rows, missing values, unmapped types and unknown floors, with a short label sheet."""
    sheet = property_labels(spark).filter("property_type_raw NOT IN ('Row_House', 'Shop')")
    audit = Observation("load")
    # A floor that no list knows.
    rows = raw(spark, d).withColumn("floor_no", F.when(F.col("floor_no") == "7", "attic").otherwise(F.col("floor_no")))
    prepare.prepare(rows, bhk_labels(spark), sheet, audit=audit).write.format("noop").mode("overwrite").save()
    counts = audit.get
    return local_table(spark, {name: [n] for name, n in counts.items()}, dict.fromkeys(counts, pa.int64()))


@query
def bhk_lookup(spark, d):
    sheet = _sheet(spark, d, "BHK", star.RAW_BHK, "standard_label", "concat(' ', CAST(p_size % 6 AS STRING), 'br ')")
    return labels.clean_label_map(sheet, "BHK", "standard_label", "line")


@query
def prop_lookup(spark, d):
    refined = "CASE WHEN p_size < 25 THEN lower(p_type) ELSE concat(p_type, '_x') END"
    sheet = _sheet(spark, d, "property_type_raw", star.RAW_TYPE, "property_type_refined", refined)
    return labels.clean_label_map(sheet, "property_type_raw", "property_type_refined", "line")


@query
def city_params(spark, d):
    cities = star.cities(spark, d).withColumnRenamed("city_name", "city")
    return prepare.with_city_params(cities).select("city_id", "city", *PARAM_COLUMNS)


# --- preparation ------------------------------------------------------------------------------


@query
def floor_normalise(spark, d):
    out = prepare.with_floors(raw(spark, d, "floor_no", "property_category").withColumn("floor_name_raw", F.col("floor_no")))
    return out.groupBy("floor_name_raw", "floor_no").agg(F.count(F.lit(1)).alias("n"))


@query
def buyer_ages_query(spark, d):
    rows = raw(spark, d, "purchaser_name").select(F.explode(buyer_ages(F.col("purchaser_name"))).alias("age"))
    return rows.groupBy("age").agg(F.count(F.lit(1)).alias("n"))


QUERIES["buyer_ages"] = QUERIES.pop("buyer_ages_query")


@query
def derived_columns(spark, d):
    names = ["document_no", "agreement_price", "carpet_sqft", "saleable_sqft", "rate_on_net_ca", "rate_on_sa", "buyer_pincode"]
    out = prepared(spark, d, *names)
    rounded = ["carpet_sqft", "saleable_sqft", "rate_on_net_ca", "rate_on_sa"]
    return out.select("document_no", "agreement_price", "buyer_pincode", *[round2(F.col(c)).alias(c) for c in rounded])


@query
def project_type_fill(spark, d):
    out = prepared(spark, d, "project_type", "property_type_raw")
    return out.groupBy("project_type", "property_type_raw").agg(F.count(F.lit(1)).alias("n"))


@query
def bhk_mapped(spark, d):
    rows = raw(spark, d, "bhk_br").withColumn("raw", F.col("bhk_br"))
    return prepare.map_bedrooms(rows, bhk_labels(spark)).groupBy("raw", "bhk_br").agg(F.count(F.lit(1)).alias("n"))


@query
def prop_mapped(spark, d):
    rows = raw(spark, d, "property_type_raw").withColumn("raw", F.col("property_type_raw"))
    mapped = prepare.map_property_types(rows, property_labels(spark))
    return mapped.groupBy("raw", "property_type_raw").agg(F.count(F.lit(1)).alias("n"))


@query
def prop_unmapped(spark, d):
    known = property_labels(spark).filter(~F.col("property_type_raw").isin("Shop", "Row_House"))
    return prepare.unmapped_property_types(raw(spark, d, "property_type_raw"), known)


@query
def fuzzy_labels(spark, d):
    """Part names by the closest property label."""
    names = spark.read.parquet(f"{d}/part.parquet").select(F.initcap(F.concat_ws(" ", "p_type", "p_name")).alias("label"))
    known = ["Standard Part", "Part Small", "Promo", "Economy Part 7", "Large"]
    return fuzzy.closest_labels(names, "label", known, 60).select("label", "match", round2(F.col("score")).alias("score"))


@query
def normalize_labels(spark, d):
    """Raw property types with typing errors, replaced by the closest known label."""
    rows = raw(spark, d, "property_type_raw").select(F.concat("property_type_raw", F.lit("x")).alias("label"))
    out = fuzzy.normalize_labels(rows, "label", ["Flat", "Apartment", "Row House", "Shop"], 70)
    return out.groupBy("label").agg(F.count(F.lit(1)).alias("n"))


@query
def mask_summary(spark, d):
    return levels.mask_summary(prepared(spark, d, *KEYS, *PRICES, "bhk_br"))


@query
def price_labels(spark, d):
    amount = to_number(F.col("agreement_price"))
    rows = raw(spark, d, "agreement_price").select(price_label(amount).alias("label"))
    return rows.groupBy("label").agg(F.count(F.lit(1)).alias("n"))


# --- totals -----------------------------------------------------------------------------------

_BASE = ["document_no", "agreement_price", "carpet_sqft", "floor_no", "transaction_date", "project_type"]


def _base(level, *attributes: str) -> Query:
    def run(spark, d):
        return totals.base_totals(prepared(spark, d, *KEYS, *_BASE, *attributes), level)

    return run


QUERIES["project_base"] = _base(PROJECT, "index", "project_name", "location", "location_id", "project_lat", "project_lng")
QUERIES["location_base"] = _base(LOCATION, "location", "location_lat", "location_lng")
QUERIES["city_base"] = _base(CITY)


@query
def project_type_label(spark, d):
    rows = prepared(spark, d, *KEYS, "project_type")
    return (
        levels.by_level(rows)
        .groupBy("level", "city", "key_id")
        .agg(
            totals.project_type_label(
                F.bool_or(F.col("project_type") == "Residential"), F.bool_or(F.col("project_type") == "Commercial")
            ).alias("project_type")
        )
    )


def _segment_totals(spark, d, kind):
    return totals.segment_totals(prepared(spark, d, *KEYS, *PRICES, "document_no", kind), kinds=[kind])


_TOTALS = ["sold_igr", "total_agreement_price", "avg_agreement_price", "ca_consumed_sqft_igr"]


@query
def segment_pt(spark, d):
    return _segment_totals(spark, d, PROPERTY).select(*SEGMENT_KEY, *_TOTALS)


@query
def segment_bhk(spark, d):
    return _segment_totals(spark, d, BEDROOM).select(*SEGMENT_KEY, *_TOTALS).filter("sold_igr IS NOT NULL")


@query
def avg_carpet_bhk(spark, d):
    out = _segment_totals(spark, d, BEDROOM).select(*SEGMENT_KEY, "avg_carpet_area_in_sqft")
    return out.filter(F.col("avg_carpet_area_in_sqft").isNotNull())


@query
def txn_sale_by_raw_type(spark, d):
    return totals.sales_by_raw_type(prepared(spark, d, *KEYS, "document_no", "property_type_raw"))


@query
def txn_by_category(spark, d):
    return totals.documents_by_category(prepared(spark, d, *KEYS, "document_no"))


@query
def da_registered(spark, d):
    return totals.development_agreements(prepared(spark, d, *KEYS, "transaction_type"))


# --- rates ------------------------------------------------------------------------------------


def _rates(spark, d, name):
    columns = [*KEYS, *PRICES, percentiles.DISTRIBUTIONS[name][0], *(["floor_no"] if name == "floor_pt" else [])]
    return percentiles.rate_percentiles(prepared(spark, d, *columns), names=[name], keep=Stages(spark).stage)


@query
def rate_nca_pt(spark, d):
    return percentiles.rate_stats(_rates(spark, d, "rate_nca_pt"), "rate_nca_pt")


@query
def rate_sa_pt(spark, d):
    return percentiles.rate_stats(_rates(spark, d, "rate_sa_pt"), "rate_sa_pt")


@query
def rate_nca_bhk(spark, d):
    return percentiles.rate_stats(_rates(spark, d, "rate_nca_bhk"), "rate_nca_bhk")


@query
def rate_p90_mma(spark, d):
    return percentiles.chart_p90(_rates(spark, d, "rate_nca_pt")).withColumn("p90_rate", round2(F.col("p90_rate")))


@query
def prevailing_rate(spark, d):
    return percentiles.prevailing_rates(_rates(spark, d, "rate_nca_pt"))


@query
def floor_p90_rate(spark, d):
    return percentiles.floor_wise_p90(_rates(spark, d, "floor_pt"))


# --- distributions ----------------------------------------------------------------------------


def _table(spark, d, block, kind):
    columns = [*KEYS, *PRICES, kind, *(["age"] if block == "age" else [])]
    # Read three times: to count keys, and for small and large ones.
    rows = Stages(spark).stage(prepared(spark, d, *columns), "rows")
    return ranges.range_tables(rows, [block], kinds=[kind])


def _area(kind, metric) -> Query:
    return lambda spark, d: ranges.area_metric(_table(spark, d, "area", kind), metric)


for _name, _kind in (("pt", PROPERTY), ("bhk", BEDROOM)):
    for _metric in ranges.AREA_METRICS:
        QUERIES[f"area_{_name}_{_metric}"] = _area(_kind, _metric)


def _range(block, function, kind) -> Query:
    return lambda spark, d: function(_table(spark, d, block, kind))


for _block, _function in (("price", ranges.price_ranges), ("rate", ranges.rate_ranges), ("age", ranges.age_ranges)):
    QUERIES[f"{_block}_pt"] = _range(_block, _function, PROPERTY)
    QUERIES[f"{_block}_bhk"] = _range(_block, _function, BEDROOM)


@query
def rate_count_pt(spark, d):
    out = ranges.rate_ranges(_table(spark, d, "rate", PROPERTY))
    return out.select(*SEGMENT_KEY, "bucket", F.col("unit_sold").alias("total_unit_sold_in_rate_range"))


# --- buyers and callbacks ---------------------------------------------------------------------


@query
def pincode_stats(spark, d):
    return buyers.pincode_stats(prepared(spark, d, *KEYS, *PRICES, "buyer_pincode"))


@query
def top10_pincodes(spark, d):
    return buyers.top_pincodes(prepared(spark, d, *KEYS, *PRICES, "buyer_pincode"))


@query
def custom_group_fn(spark, d):
    """A user-written statistic per project and property type: spread of prices."""
    rows = levels.by_level(prepared(spark, d, *KEYS, *PRICES, "property_type"), [PROJECT]).filter(levels.masks()["valid_price"])

    def partial(frame: pd.DataFrame) -> pd.DataFrame:
        price = frame["agreement_price"]
        return pd.DataFrame({"n": [len(price)], "low": [price.min()], "high": [price.max()]})

    def merge(states: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"n": [states["n"].sum()], "low": [states["low"].min()], "high": [states["high"].max()]})

    keys = ["city", "key_id", "property_type"]
    out = callbacks.per_group(rows, keys, ["agreement_price"], partial, merge, "n bigint, low double, high double")
    return out.select(*keys, "n", (F.col("high") - F.col("low")).alias("price_spread"))


AREA_SPECS = [
    specs.RangeSpec("mean_200", "area", 200),
    specs.RangeSpec("mean_350_priced", "area", 350, priced=True),
    specs.RangeSpec("fixed_150", "area", 150, specs.FIXED, 300, 1700),
]
OTHER_SPECS = [
    specs.RangeSpec("price_fixed", "price", 1_500_000, specs.FIXED, 500_000, 9_000_000),
    specs.RangeSpec("price_mean", "price", 3_000_000),
    specs.RangeSpec("rate_fixed", "rate", 700, specs.FIXED, 1400, 9000),
    specs.RangeSpec("rate_mean", "rate", 2500),
]


@query
def range_specs(spark, d):
    """Three distributions of the carpet area, by strategies, steps and bounds of their own, from one pass."""
    return specs.range_stats(prepared(spark, d, *KEYS, *PRICES, *SEGMENTS), AREA_SPECS, [CITY, PROJECT])


@query
def range_specs_mixed(spark, d):
    """Prices and rates by specifications of their own."""
    return specs.range_stats(prepared(spark, d, *KEYS, *PRICES, *SEGMENTS), OTHER_SPECS, [CITY, LOCATION])


@query
def whole_group_fn(spark, d):
    """A user-written statistic that needs a whole ordered group: the longest row of rising prices by city and property type."""
    rows = levels.by_level(prepared(spark, d, *KEYS, *PRICES, "property_type", "transaction_date", "document_no"), [CITY])

    def longest_rise(key: tuple, batches) -> list[tuple]:
        n = best = run = 0
        last = None
        for batch in batches:
            for price in batch.column("agreement_price").to_pylist():
                run = run + 1 if last is not None and price > last else 1
                best, last, n = max(best, run), price, n + 1
        return [(n, best)]

    names, order = ["city", "key_id", "property_type"], ["transaction_date", "document_no", "agreement_price"]
    return callbacks.per_whole_group(
        rows.filter(levels.masks()["valid_price"]), names, ["agreement_price"], longest_rise, "n bigint, longest_rise bigint", order
    )


# --- reports ----------------------------------------------------------------------------------


def _report(level, grain) -> Query:
    return lambda spark, d: report.wide_report(prepared(spark, d, *report.COLUMNS), level, grain)


def _long(level) -> Query:
    def run(spark, d):
        stages = Stages(spark)
        rows = stages.stage(report.report_rows(prepared(spark, d, *report.COLUMNS), [level]), "rows")
        return report.long_report(rows, level, keep=stages.stage)

    return run


for _level in LEVELS:
    QUERIES[f"report_{_level.name}_long"] = _long(_level)
    for _grain, _suffix in (("Overall", ""), ("YoY", "_yoy"), ("QoQ", "_qoq")):
        QUERIES[f"report_{_level.name}{_suffix}"] = _report(_level, _grain)


MICRO = levels.Level("micro", "location_id", False, False, 0.85, 0.07, (("location", "location"),))


@query
def report_custom_level(spark, d):
    """A level of the user's own: another key, percentile and band."""
    return _long(MICRO)(spark, d)


PAIR = levels.Level("pair", ("location", "project_type"), False, False, 0.85, 0.07)


@query
def report_two_keys(spark, d):
    """All metrics by two text columns, whose keys are numbered in their order."""
    stages = Stages(spark)
    rows, numbered = keys.number_keys(prepared(spark, d, *report.COLUMNS), [PAIR], stages.stage)
    rows = stages.stage(report.report_rows(rows, [PAIR]), "rows")
    return keys.with_key_columns(report.long_report(rows, PAIR, keep=stages.stage), PAIR, numbered)


@query
def run_all_reports(spark, d):
    """The full run: three levels by three grains, written, and the totals read back from the files."""
    path = f"{shared_folder(spark)}/reports-{uuid.uuid4().hex}"
    written = report.run_reports(prepared(spark, d, *report.COLUMNS), path)
    parts = []
    for level in LEVELS:
        out = spark.read.parquet(written[level.name])
        parts.append(out.select(
            F.lit(level.name).alias("level"), "Type", F.col(level.key).alias("key_id"), "city", "year", "quarter",
            "total_sales", "total_transactions", "max_floor", "project_type",
        ))
    return report.stack(parts)


@query
def report_union(spark, d):
    """City totals of the three grains under one another, columns matched by name."""
    rows = totals.base_totals(prepared(spark, d, *KEYS, *_BASE), CITY)
    frames = []
    for grain, column in (("Overall", None), ("YoY", "year"), ("QoQ", "quarter")):
        part = rows.filter(F.col("grain") == grain).select(
            F.lit(grain).alias("Type"), "key_id", "period", "total_sales", "total_transactions"
        )
        frames.append(part.withColumnRenamed("period", column) if column else part.drop("period"))
    return report.stack(frames)


@query
def blank_zeros(spark, d):
    rows = totals.base_totals(prepared(spark, d, *KEYS, *_BASE), CITY)
    return report.blank_zeros(rows, ["total_sales", "max_floor"]).select(*PERIOD_KEY, "total_sales", "max_floor")


@query
def report_columns(spark, d):
    """Columns of the project report in output order, with the number of filled cells."""
    wide = QUERIES["report_project"](spark, d)
    names = wide.columns
    filled = wide.agg(*[F.count(F.col(f"`{c}`")).alias(f"c{i}") for i, c in enumerate(names)])
    entries = [F.struct(F.lit(i).alias("position"), F.lit(c).alias("name"), F.col(f"c{i}").alias("filled")) for i, c in enumerate(names)]
    return filled.select(F.explode(F.array(*entries)).alias("e")).select("e.*")
