"""From raw transactions to typed ones with derived columns and standard labels."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from deedmill.config import (
    COMMERCIAL_TYPES,
    DEFAULTS,
    EXPECTED_COLUMNS,
    PARAM_COLUMNS,
    RESIDENTIAL_TYPES,
    SQFT_PER_SQM,
    Settings,
    city_params_table,
    floor_table,
)
from deedmill.functions.values import buyer_ages, label_key, no_nan, strip, title, to_number

_OPTIONAL = {
    "floor_no": "string",
    "purchaser_name": "string",
    "net_carpet_area_sqmt": "double",
    "agreement_price": "double",
    "property_type": "string",
    "buyer_pincode": "double",
    "transaction_type": "string",
    "bhk_br": "string",
}


def lower_names(df: DataFrame) -> DataFrame:
    return df.toDF(*[c.lower() for c in df.columns])


def with_missing(df: DataFrame) -> DataFrame:
    """Absent optional columns as nulls, NaN as null."""
    for name, kind in _OPTIONAL.items():
        if name not in df.columns:
            df = df.withColumn(name, F.lit(None).cast(kind))
    if "property_type_raw" not in df.columns:
        df = df.withColumn("property_type_raw", F.lit(None).cast("string"))
        if "project_type" not in df.columns:
            df = df.withColumn("project_type", F.lit("Other"))
    doubles = [f.name for f in df.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))]
    return df.withColumns({c: no_nan(F.col(c).cast("double")) for c in doubles})


# Flags of rows that an audit counts instead of failing the job.
UNKNOWN_FLOOR, UNMAPPED_TYPE = "_unknown_floor", "_unmapped_type"


def with_floors(df: DataFrame, audited: bool = False) -> DataFrame:
    """``floor_no`` as a number; a name that is in no list and no number fails the job, or is null and flagged if audited."""
    raw = F.col("floor_no").cast("string")
    number = to_number(raw)
    unknown = raw.isNotNull() & number.isNull() & (F.lower(strip(raw)) != "nan")
    floors = floor_table(df.sparkSession).withColumn("known", F.lit(True))
    joined = df.join(floors, raw == F.col("floor_name"), "left")
    if audited:
        joined = joined.withColumn(UNKNOWN_FLOOR, F.col("known").isNull() & F.coalesce(unknown, F.lit(False)))
        unknown = F.lit(False)
    return (
        joined.withColumn(
            "floor_no",
            F.when(F.col("known"), F.col("floor_number"))
            .when(unknown, F.raise_error(F.concat(F.lit("unknown floor: "), raw)).cast("double"))
            .otherwise(number),
        )
        .drop("floor_name", "floor_number", "known")
    )


def with_city_params(df: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    """Loading factors and range bounds of the row's city, defaults where a city has none."""
    params = city_params_table(df.sparkSession, settings)
    joined = df.drop(*PARAM_COLUMNS).join(params, "city", "left")
    return joined.withColumns(
        {p: F.coalesce(F.col(p), F.lit(float(getattr(settings.default_city, p)))) for p in PARAM_COLUMNS}
    )


def with_measures(df: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    """Price, areas, rates and pincode as numbers. Needs the city parameters."""
    sale = F.col("property_category") == "Sale"
    kinds = {f.name: f.dataType for f in df.schema.fields}

    def number(name: str) -> Column:
        return F.col(name).cast("double") if isinstance(kinds[name], T.NumericType) else to_number(F.col(name))

    area = F.col("net_carpet_area_sqmt").cast("double")
    residential = ["Flat", "Others"] if settings.residential_rule == "listed" else RESIDENTIAL_TYPES
    loading = F.when(F.col("property_type").isin(residential), F.col("residential_loading")).otherwise(
        F.col("commercial_loading")
    )
    base = area if settings.saleable_unit == "sqm" else area * SQFT_PER_SQM
    zero = F.lit(0.0)
    return (
        df.withColumns(
            {
                "net_carpet_area_sqmt": area,
                "agreement_price": F.when(sale, number("agreement_price")),
                "buyer_pincode": number("buyer_pincode"),
                "carpet_sqft": F.nullif(area * SQFT_PER_SQM, zero),
                "saleable_sqft": F.nullif(base * loading, zero),
            }
        )
        .withColumns(
            {
                "rate_on_net_ca": F.when(sale, F.col("agreement_price") / F.col("carpet_sqft")),
                "rate_on_sa": F.when(sale, F.col("agreement_price") / F.col("saleable_sqft")),
            }
        )
    )


def with_project_type(df: DataFrame) -> DataFrame:
    """Blank project types by the raw property type, as it was entered."""
    raw = F.col("property_type_raw")
    by_raw = (
        F.when(raw.isin(RESIDENTIAL_TYPES), "Residential").when(raw.isin(COMMERCIAL_TYPES), "Commercial").otherwise("Other")
    )
    given = F.col("project_type") if "project_type" in df.columns else F.lit(None).cast("string")
    blank = given.isNull() | (strip(given) == "")
    return df.withColumn("project_type", F.when(blank, by_raw).otherwise(given))


def _lookup(labels: DataFrame, key: str, value: str) -> DataFrame:
    """Lookup by comparison form, one row per key; title case and lower case tell the same labels apart.

    A key with two different labels fails the job: which one counts is for the sheet's reader to say,
    see :func:`deedmill.sources.labels.clean_label_map`.
    """
    pairs = labels.select(label_key(F.col(key)).alias("_key"), F.col(value).alias("_label")).filter("_key IS NOT NULL")
    first, last = F.min("_label"), F.max("_label")
    clash = F.raise_error(F.concat(F.lit("two labels for: "), F.first("_key"))).cast("string")
    return pairs.groupBy("_key").agg(F.when(first == last, first).when(first.isNotNull(), clash).alias("_label"))


def map_bedrooms(df: DataFrame, labels: DataFrame) -> DataFrame:
    """``bhk_br`` as its standard label, null where there is none."""
    lookup = _lookup(labels, "BHK", "standard_label")
    joined = df.join(lookup, label_key(F.col("bhk_br")) == F.col("_key"), "left")
    return joined.withColumn("bhk_br", F.col("_label")).drop("_key", "_label")


def _type_key(c: Column) -> Column:
    key = label_key(c)
    return F.when(key.isNull() | key.isin("", "nan", "none"), "others").otherwise(key)


def map_property_types(df: DataFrame, labels: DataFrame, audited: bool = False) -> DataFrame:
    """``property_type_raw`` as its standard label; a label without one fails the job, or is null and flagged if audited."""
    lookup = _lookup(labels, "property_type_raw", "property_type_refined").withColumn("_known", F.lit(True))
    key = _type_key(F.col("property_type_raw"))
    error = F.raise_error(F.concat(F.lit("unmapped property type: "), title(key))).cast("string")
    joined = df.join(lookup, key == F.col("_key"), "left")
    if audited:
        joined = joined.withColumn(UNMAPPED_TYPE, F.col("_known").isNull())
        error = F.lit(None).cast("string")
    return joined.withColumn(
        "property_type_raw", F.when(F.col("_known"), F.col("_label")).otherwise(error)
    ).drop("_key", "_label", "_known")


def unmapped_property_types(df: DataFrame, labels: DataFrame) -> DataFrame:
    """Distinct raw property types, in title case, that the lookup does not hold."""
    seen = df.select(_type_key(F.col("property_type_raw")).alias("_key")).distinct()
    lookup = _lookup(labels, "property_type_raw", "property_type_refined")
    return seen.join(lookup, "_key", "left_anti").select(title(F.col("_key")).alias("property_type_raw"))


def check_property_types(df: DataFrame, labels: DataFrame) -> None:
    """Raise with the sorted list of all unmapped property types, if there are any."""
    names = [r[0] for r in unmapped_property_types(df, labels).orderBy("property_type_raw").toLocalIterator()]
    if names:
        raise ValueError(f"unmapped property types: {names}")


AUDITED = ("rows", "unknown_floors", "unmapped_types", "unpriced_sales")


def _observed(df: DataFrame, audit: Observation) -> DataFrame:
    """Counts AUDITED, and missing_<column> for each expected column (all rows where the column is absent)."""
    rows = F.count(F.lit(1))
    flag = lambda name: F.count_if(name) if name in df.columns else F.lit(0).cast("bigint")
    unpriced = F.count_if((F.col("property_category") == "Sale") & F.col("agreement_price").isNull())
    counts = [rows.alias("rows"), flag(UNKNOWN_FLOOR).alias("unknown_floors"), flag(UNMAPPED_TYPE).alias("unmapped_types"), unpriced.alias("unpriced_sales")]
    for column in EXPECTED_COLUMNS:
        counts.append((F.count_if(f"_no_{column}") if f"_no_{column}" in df.columns else rows).alias(f"missing_{column}"))
    return df.observe(audit, *counts).drop(UNKNOWN_FLOOR, UNMAPPED_TYPE, *[f"_no_{c}" for c in EXPECTED_COLUMNS])


def prepare(
    df: DataFrame,
    bhk_labels: DataFrame,
    property_labels: DataFrame,
    settings: Settings = DEFAULTS,
    columns: Iterable[str] | None = None,
    audit: Observation | None = None,
) -> DataFrame:
    """All steps, or those that the named columns need.

    Spark prunes columns, but it cannot drop a lookup join on its own, so a job that needs few
    columns names them.

    With an ``audit``, unmapped property types and unknown floors are null instead of failing the job, and the
    pass that first uses the result counts them on its way: see ``AUDITED``. No extra job reads the rows.
    """
    wanted = None if columns is None else set(columns)

    def needs(*names: str) -> bool:
        return wanted is None or bool(wanted & set(names))

    df = lower_names(df)
    if audit is not None:
        given = [c for c in EXPECTED_COLUMNS if c in df.columns]
        df = df.withColumns({f"_no_{c}": F.col(c).isNull() for c in given})
    df = with_missing(df)
    if needs("age"):
        df = df.withColumn("age", buyer_ages(F.col("purchaser_name")))
    if needs("floor_no"):
        df = with_floors(df, audit is not None)
    df = with_measures(with_city_params(df, settings), settings)
    if needs("project_type"):
        df = with_project_type(df)
    if needs("bhk_br"):
        df = map_bedrooms(df, bhk_labels)
    if needs("property_type_raw"):
        df = map_property_types(df, property_labels, audit is not None)
    if audit is not None:
        df = _observed(df, audit)
    return df if wanted is None else df.select(*[c for c in df.columns if c in wanted])
